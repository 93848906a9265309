"""Layout items to typed blocks and elements: flattening, typing, markdown lines, section carry, caption links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from layoutgraph.functions import text as T

TEXT_KEYS = ["text", "table_body", "table_html", "latex", "formula", "equation"]


def distinct_rows(df: DataFrame, key: str) -> DataFrame:
    """One row a key, its delivery with the latest ingested_at where there is that column (equal deliveries fall together);
    null keys are left out."""
    rows = df.filter(F.col(key).isNotNull())
    if "ingested_at" not in df.columns:
        return rows.dropDuplicates([key])
    rest = [c for c in df.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.coalesce(F.col("ingested_at").cast("timestamp"), F.lit(0).cast("timestamp"))).alias("_d")).select(*[F.col(c) if c == key else F.col(f"_d.{c}") for c in df.columns])


def flatten_items(parsed: DataFrame, json: str = "json", keys: list[str] | None = None) -> DataFrame:
    """Layout items of parser output, one row an item: (keys..., item_idx, page_idx, item).

    Three shapes are read: a list of items, a list of pages of items, or an object holding such a list under pdf_info,
    pages or content; what the first entry is decides. An item without page_idx takes its page's position. Anything
    else, or invalid JSON, gives no rows.
    """
    keys = keys or [c for c in parsed.columns if c != json]
    data = F.try_parse_json(F.col(json))
    kind = lambda v: F.schema_of_variant(v)
    inner = F.coalesce(*[F.try_variant_get(F.col("d"), f"$.{k}", "variant") for k in ("pdf_info", "pages", "content")])
    rows = parsed.select(*keys, data.alias("d")).withColumn("d", F.when(kind(F.col("d")).startswith("OBJECT"), inner).otherwise(F.col("d")))
    rows = rows.filter(kind(F.col("d")).startswith("ARRAY"))
    first = F.try_variant_get("d", "$[0]", "variant")
    rows = rows.select(*keys, F.col("d"), kind(first).startswith("ARRAY").alias("paged"))
    each = parsed.sparkSession.tvf.variant_explode
    outer = rows.lateralJoin(each(F.col("d").outer())).select(*keys, "paged", F.col("pos").alias("outer_pos"), F.col("value").alias("v"))
    flat = outer.filter("not paged").select(*keys, "outer_pos", F.lit(0).alias("inner_pos"), F.col("v").alias("item"), F.lit(None).cast("int").alias("page"))
    paged = outer.filter("paged").lateralJoin(each(F.col("v").outer())).select(*keys, "outer_pos", F.col("pos").alias("inner_pos"), F.col("value").alias("item"), F.col("outer_pos").alias("page"))
    items = flat.unionByName(paged).filter(kind(F.col("item")).startswith("OBJECT"))
    order = Window.partitionBy(*keys).orderBy("outer_pos", "inner_pos")
    given = F.coalesce(*[F.try_variant_get("item", f"$.{k}", "int") for k in ("page_idx", "page_number", "page")])
    return items.select(*keys, (F.row_number().over(order) - 1).alias("item_idx"), F.coalesce(given, "page", F.lit(0)).alias("page_idx"), "item")


def item_text(item: Column) -> Column:
    """The first non-blank text of an item: the usual keys, content as a string, or content's parts."""
    def get(path: str) -> Column:
        value = T.strip(F.try_variant_get(item, path, "string"))
        return F.when(value != "", value)

    return F.coalesce(*[get(f"$.{k}") for k in TEXT_KEYS], F.when(F.schema_of_variant(F.try_variant_get(item, "$.content", "variant")) == "STRING", get("$.content")), *[get(f"$.content.{k}_content") for k in ("title", "paragraph", "table", "formula")], F.lit(""))


def element_type(raw: Column, text: Column, has_image: Column, has_table: Column, has_formula: Column, has_level: Column) -> Column:
    """Type of an item by ordered rules; an unknown type stays as it is."""
    raw = F.lower(F.coalesce(raw, F.lit("text")))
    return (
        F.when(raw.isin("image", "img", "figure") | has_image, "figure")
        .when((raw == "table") | has_table, "table")
        .when(raw.isin("formula", "equation", "inline_equation", "interline_equation") | has_formula, "formula")
        .when(raw.isin("title", "heading", "header") | has_level, "title")
        .when(raw.isin("caption", "figure_caption", "table_caption") | T.is_caption(text), "caption")
        .when(raw.isin("list", "list_item"), "list")
        .when(raw.isin("paragraph", "para"), "text")
        .when(raw == "", "text")
        .otherwise(raw)
    )


def items_to_elements(items: DataFrame) -> DataFrame:
    """Elements of flattened items: typed, numbered over the kept ones, with section carry and reference label.

    Items without text are dropped unless they are figures, tables or formulas. Expects source_hash, item_idx,
    page_idx, item.
    """
    get = lambda k, t="string": F.try_variant_get("item", f"$.{k}", t)
    some = lambda *ks: F.coalesce(*[F.when(T.strip(get(k)) != "", get(k)) for k in ks]).isNotNull()
    text = item_text(F.col("item"))
    typed = items.withColumn("text", text).withColumn(
        "element_type",
        element_type(F.coalesce(get("type"), get("block_type")), F.col("text"), some("img_path", "image_path"), some("table_body", "table_html"), some("latex", "formula", "equation"), F.coalesce(get("text_level", "int"), F.lit(0)) != 0),
    )
    caption = F.coalesce(*[F.when(F.schema_of_variant(F.try_variant_get("item", f"$.{k}", "variant")).startswith("ARRAY"), F.array_join(F.filter(F.try_variant_get("item", f"$.{k}", "array<string>"), lambda s: T.strip(s) != ""), " ")).otherwise(get(k)) for k in ("image_caption", "table_caption", "caption")], F.lit(""))
    kept = typed.filter((F.col("text") != "") | F.col("element_type").isin("figure", "table", "formula"))
    order = Window.partitionBy("source_hash").orderBy("item_idx")
    carried = F.last(F.when(F.col("element_type") == "title", T.strip_wrappers(F.col("text"))), True).over(order)
    number = F.lpad((F.row_number().over(order) - 1).cast("string"), 4, "0")
    side = lambda *names: F.coalesce(*[F.try_variant_get("item", f"$.bbox.{n}", "double") for n in names], F.lit(0.0))
    boxed = F.schema_of_variant(F.try_variant_get("item", "$.bbox", "variant")).startswith("OBJECT")
    named = F.when(boxed, F.array(side("x0", "left"), side("y0", "top"), side("x1", "right"), side("y1", "bottom")))
    bbox = F.coalesce(F.slice(F.try_variant_get("item", "$.bbox", "array<double>"), 1, 4), named, F.array(*[F.lit(0.0)] * 4))
    return kept.select(
        "source_hash", F.concat(F.substring("source_hash", 1, 8), F.lit("_el_"), number).alias("element_id"), "element_type", "text", F.col("page_idx").alias("page_number"), bbox.alias("bbox"), F.col("item_idx").alias("block_index"),
        caption.alias("caption"), T.ref_label(F.coalesce(F.when(caption != "", caption), F.col("text"))).alias("ref_label"), F.coalesce(get("img_path"), get("image_path")).alias("image_path"), F.coalesce(get("table_body"), get("table_html")).alias("table_html"),
        F.coalesce(get("latex"), get("formula"), get("equation")).alias("formula"), F.coalesce(carried, F.lit("")).alias("section_title"), get("text_level", "int").alias("text_level"),
    )


def items_to_blocks(items: DataFrame) -> DataFrame:
    """Text blocks of flattened items: figures and blanks left out, block_index = item index (so with gaps)."""
    elements = items_to_elements(items)
    return elements.filter((F.col("element_type") != "figure") & (F.col("text") != "")).select("source_hash", F.col("element_type").alias("block_type"), F.col("text").alias("content"), "page_number", "bbox", "block_index")


def markdown_blocks(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of markdown text: a heading line is a block, a blank line ends a paragraph; (key, block_index, block_type,
    content). Null or blank texts give no block."""
    lines = documents.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("no", "raw")).withColumn("line", T.strip(F.col("raw")))
    order = Window.partitionBy(key).orderBy("no")
    head, blank = F.col("line").startswith("#"), F.col("line") == ""
    after = F.lag(F.when(head | blank, 1).otherwise(0), 1, 1).over(order)
    starts = F.when(head | (~blank & (after == 1)), 1).otherwise(0)
    grouped = lines.withColumn("grp", F.sum(starts).over(order)).filter(~blank)
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "line"))), lambda s: s["line"]), "\n")
    blocks = grouped.groupBy(key, "grp").agg(content.alias("lines"), F.max(head).alias("title"))
    return blocks.select(key, (F.col("grp") - 1).cast("int").alias("block_index"), F.when(F.col("title"), "title").otherwise("text").alias("block_type"), F.when(F.col("title"), T.strip(F.regexp_replace("lines", "^[# ]+", ""))).otherwise(F.col("lines")).alias("content"))


def markdown_elements(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Elements of markdown blocks (key, block_index, block_type, content), for documents without layout items: typed by the
    same rules, with section carry and reference label; everything stands on page 0."""
    no = F.lit(False)
    text = T.strip_wrappers(F.col("content"))
    typed = blocks.withColumns({"text": text, "element_type": element_type(F.col("block_type"), F.col("content"), no, no, no, no)})
    order = Window.partitionBy(key).orderBy("block_index")
    carried = F.last(F.when(F.col("element_type") == "title", F.col("text")), True).over(order)
    number = F.lpad((F.row_number().over(order) - 1).cast("string"), 4, "0")
    none = F.lit(None).cast("string")
    return typed.select(
        key, F.concat(F.substring(F.col(key).cast("string"), 1, 8), F.lit("_el_"), number).alias("element_id"), "element_type", "text", F.lit(0).alias("page_number"), F.array(*[F.lit(0.0)] * 4).alias("bbox"), "block_index", F.lit("").alias("caption"),
        T.ref_label(F.col("text")).alias("ref_label"), none.alias("image_path"), none.alias("table_html"), none.alias("formula"), F.coalesce(carried, F.lit("")).alias("section_title"), F.lit(None).cast("int").alias("text_level"),
    )


def section_carry(elements: DataFrame) -> DataFrame:
    """(element_id, section): the last title at or before each element, in reading order; '' before the first."""
    order = Window.partitionBy("source_hash").orderBy("block_index", "element_id")
    title = F.last(F.when(F.col("element_type") == "title", T.strip_wrappers(F.col("text"))), True).over(order)
    return elements.select("element_id", F.coalesce(title, F.lit("")).alias("section"))


def caption_links(elements: DataFrame, reach: int = 3) -> DataFrame:
    """(caption_id, target_id, distance): each caption with the nearest figure or table of its page within ``reach``
    blocks, of the kind its label names; a tie goes to the one before it, then to the smaller index and id."""
    label = F.coalesce(F.col("ref_label"), F.lit(""))
    label = F.when(label == "", T.ref_label(F.col("text"))).otherwise(label)
    captions = elements.filter("element_type = 'caption'").select("source_hash", "page_number", F.col("element_id").alias("caption_id"), F.col("block_index").alias("at"), label.alias("label"))
    targets = elements.filter(F.col("element_type").isin("figure", "table")).select("source_hash", "page_number", F.col("element_id").alias("target_id"), F.col("element_type").alias("kind"), F.col("block_index").alias("there"))
    wanted = F.when(F.col("label").startswith("рис.") | F.col("label").startswith("figure"), F.col("kind") == "figure").when(F.col("label").startswith("табл.") | F.col("label").startswith("table"), F.col("kind") == "table").otherwise(F.lit(True))
    near = captions.join(targets, ["source_hash", "page_number"]).filter(wanted & (F.abs(F.col("there") - F.col("at")) <= reach)).withColumn("distance", F.abs(F.col("there") - F.col("at")))
    best = Window.partitionBy("caption_id").orderBy("distance", (F.col("there") > F.col("at")).cast("int"), "there", "target_id")
    return near.withColumn("r", F.row_number().over(best)).filter("r = 1").select("caption_id", "target_id", F.col("distance").cast("int").alias("distance"))


def target_captions(links: DataFrame, elements: DataFrame) -> DataFrame:
    """(target_id, caption_id): of the captions that chose a target, the first in reading order keeps it."""
    order = elements.select(F.col("element_id").alias("caption_id"), "block_index")
    return links.join(order, "caption_id").groupBy("target_id").agg(F.min_by("caption_id", F.struct("block_index", "caption_id")).alias("caption_id"))
