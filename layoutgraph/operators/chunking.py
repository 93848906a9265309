"""Section and sliding-window chunking of blocks.

Sections and headings are window expressions. Packing is a non-associative running sum over a section's or a document's
sentences, so it is a fold over one array; arrays are bounded by the length of one document's text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from layoutgraph.functions import text as T

def titled_blocks(blocks: DataFrame, elements: DataFrame | None = None) -> DataFrame:
    """Non-blank blocks in reading order with level, title and section number (0 = before the first heading).

    The level of a heading block is taken from the title element at the same block_index where one is given (the last
    such element wins)."""
    rows = blocks.filter(F.col("source_hash").isNotNull()).withColumn("txt", T.strip(F.coalesce("content", F.lit("")))).filter("txt <> ''")
    if elements is not None:
        levels = elements.filter("element_type = 'title' and metadata.text_level is not null").groupBy("source_hash", F.coalesce("source_block_index", "block_index").alias("block_index")).agg(F.max_by(F.col("metadata.text_level"), "element_id").cast("int").alias("text_level"))
        rows = rows.join(levels, ["source_hash", "block_index"], "left")
    else:
        rows = rows.withColumn("text_level", F.lit(None).cast("int"))
    rows = rows.withColumn("level", T.title_level(F.col("content"), F.col("block_type"), F.col("text_level")))
    order = Window.partitionBy("source_hash").orderBy("block_index", "block_id")
    return rows.withColumn("section", F.sum(F.when(F.col("level") > 0, 1).otherwise(0)).over(order).cast("int")).withColumn("title", F.when(F.col("level") > 0, T.clean_title(F.col("content"))))


def sections(titled: DataFrame) -> DataFrame:
    """Sections with body: title, level, hierarchy, pages, indices and the body's records in order.

    A heading without body gives no section but stays in the hierarchy of those below it: a section's hierarchy holds, of
    the headings before it, each that no later heading of its level or above has closed."""
    heads = titled.filter("level > 0").select("source_hash", "section", "level", "title", F.col("block_index").alias("title_index"), F.col("page_number").alias("title_page"))
    listed = heads.groupBy("source_hash").agg(F.array_sort(F.collect_list(F.struct("section", "level", "title"))).alias("hs"))
    start = F.struct(F.expr("cast(array() as array<struct<level:int,title:string>>)").alias("open"), F.expr("cast(array() as array<array<string>>)").alias("out"))

    def step(acc, h):
        still = F.array_append(F.filter(acc["open"], lambda o: o["level"] < h["level"]), F.struct(h["level"].alias("level"), h["title"].alias("title")))
        return F.struct(still.alias("open"), F.array_append(acc["out"], F.transform(still, lambda o: o["title"])).alias("out"))

    stacks = listed.select("source_hash", F.explode(F.arrays_zip(F.transform("hs", lambda h: h["section"]).alias("section"), F.aggregate("hs", start, step)["out"].alias("hierarchy"))).alias("z")).select("source_hash", "z.section", "z.hierarchy")
    heads = heads.join(stacks, ["source_hash", "section"])
    body = titled.filter("level = 0").groupBy("source_hash", "section").agg(
        F.array_sort(F.collect_list(F.struct("block_index", "block_id", F.col("txt").alias("text"), F.col("page_number").alias("page"), F.coalesce("block_type", F.lit("text")).alias("kind")))).alias("records")
    )
    return body.join(heads, ["source_hash", "section"], "left").select(
        "source_hash", "section", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("level", F.lit(0)).alias("level"), "title_index", "title_page", F.coalesce("hierarchy", F.array().cast("array<string>")).alias("hierarchy"), "records"
    )


def _pack(units: Column, limit: int) -> Column:
    """Greedy packing: array of arrays of units; a piece is closed when the next unit would pass the limit."""
    empty = F.expr("cast(array() as array<array<int>>)")
    start = F.struct(empty.alias("done"), F.expr("cast(array() as array<int>)").alias("cur"), F.lit(0).alias("sum"), F.lit(0).alias("i"))

    def step(acc, u):
        full = (acc["sum"] + u["tokens"] > limit) & (F.size(acc["cur"]) > 0)
        return F.struct(
            F.when(full, F.array_append(acc["done"], acc["cur"])).otherwise(acc["done"]).alias("done"), F.when(full, F.array(acc["i"])).otherwise(F.array_append(acc["cur"], acc["i"])).alias("cur"),
            F.when(full, u["tokens"]).otherwise(acc["sum"] + u["tokens"]).alias("sum"), (acc["i"] + 1).alias("i"),
        )

    return F.aggregate(units, start, step)


def section_chunks(secs: DataFrame, max_tokens: int = 512, min_tokens: int = 50) -> DataFrame:
    """Chunks of sections, numbered within the document before any filter.

    A body of at most ``max_tokens`` is one chunk; a longer one is packed by sentences. Each piece repeats the title. A
    last piece under ``min_tokens`` is appended to the one before it. Columns: source_hash, chunk_no, chunk_id, title,
    hierarchy, text, token_count, page_start, page_end, block_indices, has_equations, has_tables.
    """
    full = F.array_join(F.transform("records", lambda r: r["text"]), "\n")
    unit = F.flatten(
        F.transform("records", lambda r: F.transform(T.sentences(r["text"]), lambda s: F.struct(s.alias("text"), T.token_estimate(s).alias("tokens"), r["block_index"].alias("block_index"), r["page"].alias("page"), r["kind"].alias("kind"))))
    )
    rows = secs.withColumn("full", full).withColumn("fits", T.token_estimate(full) <= max_tokens)
    one = rows.filter("fits").select(
        "source_hash", "section", F.lit(0).alias("piece"), "title", "title_index", "hierarchy", F.col("full").alias("body"), F.array_min(F.array_compact(F.array_append(F.transform("records", lambda r: r["page"]), F.col("title_page")))).alias("page_start"),
        F.array_max(F.array_compact(F.array_append(F.transform("records", lambda r: r["page"]), F.col("title_page")))).alias("page_end"), F.transform("records", lambda r: r["block_index"]).alias("indices"), F.transform("records", lambda r: r["kind"]).alias("kinds"), F.lit(0).alias("small"),
    )
    many = rows.filter("not fits").withColumn("units", unit).withColumn("acc", _pack(F.col("units"), max_tokens))
    pieces = F.when(F.size("acc.cur") > 0, F.array_append("acc.done", F.col("acc.cur"))).otherwise(F.col("acc.done"))
    many = many.withColumn("small", ((F.col("acc.sum") < min_tokens) & (F.size("acc.done") > 0)).cast("int")).withColumn("n", F.size(pieces)).select("*", F.posexplode(pieces).alias("piece", "ids"))
    mine = F.transform("ids", lambda i: F.element_at("units", i + 1))
    many = many.withColumn("mine", mine).select(
        "source_hash", "section", "piece", "title", "title_index", "hierarchy", F.array_join(F.transform("mine", lambda u: u["text"]), " ").alias("body"), F.array_min(F.transform("mine", lambda u: u["page"])).alias("page_start"), F.array_max(F.transform("mine", lambda u: u["page"])).alias("page_end"),
        F.transform("mine", lambda u: u["block_index"]).alias("indices"), F.transform("mine", lambda u: u["kind"]).alias("kinds"), F.when(F.col("piece") == F.col("n") - 1, F.col("small")).otherwise(0).alias("small"),
    )
    both = one.unionByName(many)
    text = T.strip(F.when(F.col("title") != "", F.concat("title", F.lit("\n\n"), "body")).otherwise(F.col("body")))
    indices = F.array_distinct(F.when(F.col("title_index").isNotNull(), F.concat(F.array("title_index"), "indices")).otherwise(F.col("indices")))
    raw = both.select("source_hash", "section", (F.col("piece") - F.col("small")).alias("piece"), F.col("small").alias("part"), "title", "hierarchy", text.alias("text"), "page_start", "page_end", indices.alias("block_indices"), "kinds")
    joined = raw.groupBy("source_hash", "section", "piece").agg(F.array_sort(F.collect_list(F.struct("part", "text", "block_indices", "kinds"))).alias("p"), F.first("title").alias("title"), F.first("hierarchy").alias("hierarchy"), F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"))
    order = Window.partitionBy("source_hash").orderBy("section", "piece")
    kinds = F.flatten(F.transform("p", lambda x: x["kinds"]))
    out = joined.select(
        "source_hash", (F.row_number().over(order) - 1).cast("int").alias("chunk_no"), "title", "hierarchy", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"), "page_start", "page_end", F.array_distinct(F.flatten(F.transform("p", lambda x: x["block_indices"]))).alias("block_indices"),
        (F.array_contains(kinds, "equation") | F.array_contains(kinds, "formula")).alias("has_equations"), F.array_contains(kinds, "table").alias("has_tables"),
    )
    return out.withColumn("chunk_id", F.concat(F.substring("source_hash", 1, 8), F.lit("_"), F.lpad(F.col("chunk_no").cast("string"), 4, "0"))).withColumn("token_count", T.token_estimate(F.col("text")))


def add_overlap(chunks: DataFrame, sentences: int = 2) -> DataFrame:
    """Each chunk of a document starts with the last ``sentences`` sentences of the one before it, itself overlapped
    already, so this is a fold over the document's chunks. Adds overlap_prev and overlap_next; tokens are counted anew."""
    cols = [c for c in chunks.columns if c not in ("source_hash", "token_count")]
    docs = chunks.groupBy("source_hash").agg(F.array_sort(F.collect_list(F.struct("chunk_no", *[c for c in cols if c != "chunk_no"]))).alias("cs"))

    def last(text):
        s = T.sentences(text)
        return F.array_join(F.slice(s, F.greatest(F.lit(1), F.size(s) - (sentences - 1)), F.lit(sentences)), " ")

    def step(acc, c):
        before = F.when(F.size(acc) > 0, last(F.element_at(acc, -1))).otherwise(F.lit(""))
        return F.array_append(acc, F.when(F.coalesce(before, F.lit("")) != "", F.concat(before, F.lit("\n"), c["text"])).otherwise(c["text"]))

    folded = docs.withColumn("texts", F.aggregate("cs", F.expr("cast(array() as array<string>)"), step))
    rows = folded.select("source_hash", F.size("cs").alias("n"), F.posexplode(F.arrays_zip("cs", "texts")).alias("i", "z"))
    rest = [F.col(f"z.cs.{c}").alias(c) for c in cols if c != "text"]
    had = F.length("z.texts") > F.length("z.cs.text")
    flagged = rows.select("source_hash", *rest, F.col("z.texts").alias("text"), had.alias("overlap_prev"), "i", "n")
    order = Window.partitionBy("source_hash").orderBy("chunk_no")
    return flagged.withColumn("overlap_next", F.coalesce(F.lead("overlap_prev").over(order), F.lit(False))).withColumn("token_count", T.token_estimate(F.col("text"))).drop("i", "n")


def keep_chunks(chunks: DataFrame, least: int = 10) -> DataFrame:
    """Non-blank chunks of at least ``least`` tokens; ids stay as they are, with gaps."""
    return chunks.filter((T.strip(F.col("text")) != "") & (F.col("token_count") >= least))


def sliding_chunks(blocks: DataFrame, window: int = 512, step: int = 384) -> DataFrame:
    """Sliding windows over a document's sentences: (source_hash, chunk_no, chunk_id, text, token_count, overlap_prev,
    overlap_next). A chunk is closed at ``window`` tokens; sentences of window - step tokens are then dropped from its
    front, the rest opens the next chunk; what remains at the end is a chunk of its own."""
    text = T.strip(F.coalesce("content", F.lit("")))
    docs = blocks.filter(F.col("source_hash").isNotNull() & (text != "")).groupBy("source_hash").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_index", "block_id", "content"))), lambda r: r["content"]), "\n").alias("full"))
    docs = docs.withColumn("s", T.sentences(F.col("full"))).withColumn("t", F.transform("s", T.token_estimate))
    start = F.struct(F.expr("cast(array() as array<struct<a:int,b:int>>)").alias("done"), F.lit(0).alias("first"), F.lit(0).alias("sum"), F.lit(0).alias("i"))

    def close(acc, t):
        total, here = acc["sum"] + t, acc["i"]
        ends = total >= window
        # drop sentences from the front until window - step tokens are gone
        drop = F.aggregate(
            F.slice(F.col("t"), acc["first"] + 1, here - acc["first"] + 1), F.struct(F.lit(0).alias("k"), F.lit(0).alias("gone")),
            lambda d, x: F.when(d["gone"] < window - step, F.struct((d["k"] + 1).alias("k"), (d["gone"] + x).alias("gone"))).otherwise(d),
        )
        return F.struct(
            F.when(ends, F.array_append(acc["done"], F.struct(acc["first"].alias("a"), here.alias("b")))).otherwise(acc["done"]).alias("done"), F.when(ends, acc["first"] + drop["k"]).otherwise(acc["first"]).alias("first"), F.when(ends, total - drop["gone"]).otherwise(total).alias("sum"), (here + 1).alias("i"),
        )

    folded = docs.withColumn("acc", F.aggregate("t", start, close))
    spans = F.when(F.col("acc.first") < F.col("acc.i"), F.array_append("acc.done", F.struct(F.col("acc.first").alias("a"), (F.col("acc.i") - 1).alias("b")))).otherwise(F.col("acc.done"))
    closed = F.size("acc.done")
    rows = folded.withColumn("closed", closed).select("source_hash", "s", "closed", F.posexplode(spans).alias("chunk_no", "x"))
    out = rows.select("source_hash", "chunk_no", T.strip(F.array_join(F.slice("s", F.col("x.a") + 1, F.col("x.b") - F.col("x.a") + 1), " ")).alias("text"), (F.col("chunk_no") > 0).alias("overlap_prev"), (F.col("chunk_no") < F.col("closed")).alias("overlap_next"))
    return out.withColumn("chunk_id", F.concat(F.substring("source_hash", 1, 8), F.lit("_sw"), F.lpad(F.col("chunk_no").cast("string"), 4, "0"))).withColumn("token_count", T.token_estimate(F.col("text")))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """One row: counts, sum, mean, least and most tokens, and how many hold equations or tables; zeros when empty."""
    tokens = F.coalesce("token_count", F.lit(0))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return chunks.agg(F.count(F.lit(1)).alias("chunks"), zero(F.sum(tokens)).alias("tokens"), F.round(F.coalesce(F.avg(tokens), F.lit(0.0)), 4).alias("mean_tokens"), zero(F.min(tokens)).alias("least"), zero(F.max(tokens)).alias("most"), zero(F.count_if("has_equations")).alias("with_equations"), zero(F.count_if("has_tables")).alias("with_tables"))


def chunk_histogram(chunks: DataFrame) -> DataFrame:
    """(bucket, n) of token counts: <100, 100-300, 300-500, 500+."""
    t = F.coalesce("token_count", F.lit(0))
    bucket = F.when(t < 100, "<100").when(t < 300, "100-300").when(t < 500, "300-500").otherwise("500+")
    return chunks.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
