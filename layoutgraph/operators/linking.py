"""Linking graph: documents, chunks, elements and entities as nodes, typed weighted edges, ranked DISCUSSED_NEAR links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from layoutgraph.functions import text as T

STRUCTURED = ["figure", "caption", "table", "formula"]  # fixed values


def doc_node(doc: Column) -> Column:
    return F.concat(F.lit("doc::"), F.coalesce(doc, F.lit("")))


def chunk_node(c: Column) -> Column:
    return F.concat(F.lit("chunk::"), c)


def element_node(e: Column) -> Column:
    return F.concat(F.lit("element::"), e)


def entity_node() -> Column:
    return F.concat_ws("::", F.lit("entity"), F.coalesce("source_doc", F.lit("")), F.coalesce("entity_type", F.lit("UNKNOWN")), F.coalesce("normalized", F.lower("text"), F.lit("")))


def element_label() -> Column:
    some = lambda c, n: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.substring(c, 1, n))
    return F.coalesce(F.when(F.coalesce("ref_label", F.lit("")) != "", F.col("ref_label")), some("caption", 80), some("text", 80), F.col("element_id"))


def registry(elements: DataFrame, *others: DataFrame) -> DataFrame:
    """Every element once: parsed ones first, then ones only known from elsewhere (shared exhibits, summaries in chunks or
    entities), in the order given; what they lack is null."""
    both = elements.withColumn("origin", F.lit(0))
    for k, other in enumerate(others, 1):
        both = both.unionByName(other.withColumn("origin", F.lit(k)), allowMissingColumns=True)
    first = Window.partitionBy("element_id").orderBy("origin", F.col("source_hash").asc_nulls_last())
    return both.filter("element_id is not null").withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r", "origin")


def nodes(documents: DataFrame, chunks: DataFrame, elements: DataFrame, entities: DataFrame) -> DataFrame:
    """(id, node_type, label, doc, section, page_start, page_end, ref, caption)."""
    none = F.lit(None)
    s, i = lambda c: c.cast("string"), lambda c: c.cast("int")
    label = F.when(F.coalesce("section_title", F.lit("")) != "", F.substring("section_title", 1, 80)).otherwise(F.col("chunk_id"))
    parts = [
        documents.select(doc_node(F.col("source_doc")).alias("id"), F.lit("document").alias("node_type"), F.coalesce("source_doc", F.lit("")).alias("label"), F.col("source_doc").alias("doc"), s(none).alias("section"), i(none).alias("page_start"), i(none).alias("page_end"), s(none).alias("ref"), s(none).alias("caption")).distinct(),
        chunks.select(chunk_node(F.col("chunk_id")).alias("id"), F.lit("chunk").alias("node_type"), label.alias("label"), F.col("source_doc").alias("doc"), F.col("section_title").alias("section"), "page_start", "page_end", s(none).alias("ref"), s(none).alias("caption")),
        elements.select(element_node(F.col("element_id")).alias("id"), F.coalesce("element_type", F.lit("unknown")).alias("node_type"), element_label().alias("label"), F.col("source_doc").alias("doc"), F.col("section_title").alias("section"), F.col("page_number").alias("page_start"), F.col("page_number").alias("page_end"), F.col("ref_label").alias("ref"), "caption"),
        entities.select(entity_node().alias("id"), F.lit("entity").alias("node_type"), F.coalesce("text", F.lit("")).alias("label"), F.col("source_doc").alias("doc"), F.col("section_title").alias("section"), "page_start", "page_end", s(none).alias("ref"), s(none).alias("caption")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merge_edges(edges: DataFrame) -> DataFrame:
    """Edges by (source, target, relation) with summed weight and evidence; loops are dropped."""
    return edges.filter("source <> target").groupBy("source", "target", "relation").agg(F.sum("weight").alias("weight"), F.sum("evidence").alias("evidence"))


def structural_edges(documents: DataFrame, chunks: DataFrame, elements: DataFrame, entities: DataFrame) -> DataFrame:
    """All relations but DISCUSSED_NEAR: CONTAINS_CHUNK, CONTAINS_ELEMENT, HAS_CAPTION, CAPTION_OF, EXTRACTED_FROM,
    RELATED_TO, MENTIONED_IN. Both ends must exist; a figure and its caption both state HAS_CAPTION, which adds up."""
    have = elements.select("element_id")
    edge = lambda df, a, b, rel: df.select(a.alias("source"), b.alias("target"), F.lit(rel).alias("relation"), F.lit(1.0).alias("weight"), F.lit(1).cast("long").alias("evidence"))
    c = F.col
    linked = elements.select("element_id", c("metadata.caption_element_id").alias("cap"), c("metadata.linked_element_id").alias("linked"))
    caps = linked.filter("cap is not null").join(have.withColumnRenamed("element_id", "cap"), "cap", "left_semi")
    links = linked.filter("linked is not null").join(have.withColumnRenamed("element_id", "linked"), "linked", "left_semi")
    of_chunk = lambda col: chunks.select("chunk_id", F.explode(F.array_distinct(col)).alias("element_id")).join(have, "element_id", "left_semi")
    of_entity = entities.select(entity_node().alias("ent"), F.explode(F.array_distinct("source_element_ids")).alias("element_id")).join(have, "element_id", "left_semi")
    mentioned = entities.select(entity_node().alias("ent"), F.explode("chunk_ids").alias("chunk_id")).join(chunks.select("chunk_id"), "chunk_id", "left_semi")
    parts = [
        edge(chunks.filter("source_doc is not null"), doc_node(c("source_doc")), chunk_node(c("chunk_id")), "CONTAINS_CHUNK"), edge(elements.filter("coalesce(source_doc, '') <> ''"), doc_node(c("source_doc")), element_node(c("element_id")), "CONTAINS_ELEMENT"),
        edge(caps, element_node(c("element_id")), element_node(c("cap")), "HAS_CAPTION"), edge(links, element_node(c("linked")), element_node(c("element_id")), "HAS_CAPTION"), edge(links, element_node(c("element_id")), element_node(c("linked")), "CAPTION_OF"),
        edge(of_chunk("source_element_ids"), chunk_node(c("chunk_id")), element_node(c("element_id")), "EXTRACTED_FROM"), edge(of_chunk("related_element_ids"), chunk_node(c("chunk_id")), element_node(c("element_id")), "RELATED_TO"),
        edge(of_entity, c("ent"), element_node(c("element_id")), "EXTRACTED_FROM"), edge(mentioned, c("ent"), chunk_node(c("chunk_id")), "MENTIONED_IN"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return merge_edges(out)


def discussed_near(entities: DataFrame, elements: DataFrame, chunks: DataFrame) -> DataFrame:
    """Candidates (element_id, element_type, ent, entity_label, score_e4, evidence, reasons) of structured elements.

    A reason scores 2.0 (source) or 1.0 (related) + 0.15 per entity chunk (8 at most) + 2.0 per chunk whose source the
    element is and 1.0 per chunk related to it + 0.4 for the same section + 0.6 for the same page + 0.35 * min(confidence,
    1); reasons add up. Scores are long ten-thousandths, so sums don't depend on their order. Evidence: matching chunks,
    else the first three. A missing confidence scores 0; missing entity pages are the element's own.
    """
    el = elements.filter(F.col("element_type").isin(STRUCTURED)).select("element_id", "element_type", F.col("section_title").alias("esec"), "page_number")
    own = entities.select(entity_node().alias("ent"), F.coalesce(F.concat(F.lit("="), "normalized"), F.lit("")).alias("rec"), F.coalesce("text", F.lit("")).alias("entity_label"), "confidence", "section_title", "page_start", "page_end", "chunk_ids", "source_element_ids", "related_element_ids")
    reason = lambda col, name, base: own.select("*", F.explode(F.array_distinct(col)).alias("element_id")).drop("source_element_ids", "related_element_ids").withColumns({"reason": F.lit(name), "base": F.lit(base).cast("long")})
    named = reason("source_element_ids", "source_element", 20000).unionByName(reason("related_element_ids", "related_element", 10000)).join(el, "element_id")
    # two records may share a node (one without a normalized name); each scores by its own chunks
    per_chunk = named.select("ent", "rec", "element_id", "reason", F.explode(F.array_distinct("chunk_ids")).alias("chunk_id")).join(chunks.select("chunk_id", F.col("source_element_ids").alias("cs"), F.col("related_element_ids").alias("cr")), "chunk_id")
    inside = F.coalesce(F.array_contains("cs", F.col("element_id")), F.lit(False))
    near = F.coalesce(F.array_contains("cr", F.col("element_id")), F.lit(False))
    hits = per_chunk.filter(inside | near).groupBy("ent", "rec", "element_id", "reason").agg(F.sum(F.when(inside, 20000).otherwise(0) + F.when(near, 10000).otherwise(0)).alias("plus"), F.collect_set("chunk_id").alias("matched"))
    rows = named.join(hits, ["ent", "rec", "element_id", "reason"], "left")
    section = F.when((F.coalesce("section_title", F.lit("")) != "") & (F.col("section_title") == F.col("esec")), 4000).otherwise(0)
    start = F.coalesce("page_start", "page_number")
    page = F.when(F.col("page_number").between(start, F.coalesce("page_end", start)), 6000).otherwise(0)
    conf = F.when(F.isnan("confidence"), 0.0).otherwise(F.coalesce("confidence", F.lit(0.0)))
    sure = F.round(F.least(conf, F.lit(1.0)) * 3500).cast("long")
    score = F.col("base") + F.least(F.size("chunk_ids"), F.lit(8)) * 1500 + F.coalesce("plus", F.lit(0)) + section + page + sure
    found = F.when(F.size(F.coalesce("matched", F.array().cast("array<string>"))) > 0, F.col("matched")).otherwise(F.slice("chunk_ids", 1, 3))
    return rows.groupBy("element_id", "element_type", "ent").agg(F.max("entity_label").alias("entity_label"), F.sum(score).cast("long").alias("score_e4"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(found)))).alias("evidence"), F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"))


def ranked_links(candidates: DataFrame, n: int = 12) -> DataFrame:
    """The ``n`` best candidates of each element by score, evidence and label (n <= 0: all)."""
    order = Window.partitionBy("element_id").orderBy(F.desc("score_e4"), F.desc(F.size("evidence")), "entity_label", "ent")
    ranked = candidates.withColumn("rank", F.row_number().over(order))
    return ranked if n <= 0 else ranked.filter(F.col("rank") <= n)


def near_edges(ranked: DataFrame) -> DataFrame:
    score = F.col("score_e4") / 10000
    return ranked.select(F.col("ent").alias("source"), element_node(F.col("element_id")).alias("target"), F.lit("DISCUSSED_NEAR").alias("relation"), F.greatest(score, F.lit(1.0)).alias("weight"), F.greatest(F.size("evidence"), F.lit(1)).cast("long").alias("evidence"))


def near_details(ranked: DataFrame, most: int = 12) -> DataFrame:
    """DISCUSSED_NEAR edges with what they rest on: (source, target, score_e4, reasons, evidence: at most ``most`` chunks)."""
    return ranked.select(F.col("ent").alias("source"), element_node(F.col("element_id")).alias("target"), "score_e4", "reasons", F.slice("evidence", 1, most).alias("evidence"))


def node_type_counts(nodes_: DataFrame) -> DataFrame:
    return nodes_.groupBy("node_type").agg(F.count(F.lit(1)).alias("n"))


def relation_targets(nodes_: DataFrame, edges: DataFrame) -> DataFrame:
    """(relation, target_type, n)."""
    kinds = nodes_.groupBy(F.col("id").alias("target")).agg(F.min("node_type").alias("target_type"))
    return edges.join(kinds, "target", "left").groupBy("relation", F.coalesce("target_type", F.lit("unknown")).alias("target_type")).agg(F.count(F.lit(1)).alias("n"))


def link_summary(nodes_: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes by the types a report names, and links by relation and target."""
    kinds = ("document", "entity", "chunk", "figure", "caption", "table", "formula")
    n = nodes_.agg(F.count(F.lit(1)).alias("nodes"), *[F.count_if(F.col("node_type") == k).alias(k + "_nodes") for k in kinds])
    t = relation_targets(nodes_, edges)
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("long")
    rel, to = F.col("relation"), F.col("target_type")
    e = t.agg(
        total(F.lit(True)).alias("edges"), total(rel == "HAS_CAPTION").alias("caption_links"), total(rel == "RELATED_TO").alias("chunk_related_links"), total((rel == "DISCUSSED_NEAR") & (to == "figure")).alias("entity_figure_links"),
        total((rel == "DISCUSSED_NEAR") & (to == "table")).alias("entity_table_links"),
    )
    return n.crossJoin(e)  # two tables of one row


def relation_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("relation").agg(F.count(F.lit(1)).alias("n"), F.sum("evidence").alias("evidence"))


def link_metrics(candidates: DataFrame, n: int = 12) -> DataFrame:
    """One row: candidates, kept and pruned by the limit of ``n`` an element."""
    per = candidates.groupBy("element_id").agg(F.count(F.lit(1)).alias("k"))
    kept = F.col("k") if n <= 0 else F.least("k", F.lit(n))
    return per.agg(F.coalesce(F.sum("k"), F.lit(0)).cast("long").alias("candidates"), F.coalesce(F.sum(kept), F.lit(0)).cast("long").alias("kept")).withColumn("pruned", F.greatest(F.lit(0), F.col("candidates") - F.col("kept")).cast("long"))


# ---- views of the graph: which nodes and edges a reader sees ----------------------------------------------------------

CAPTION_EDGES = ["HAS_CAPTION", "CAPTION_OF"]


def view_elements(nodes_: DataFrame, edges: DataFrame, kinds: list[str]) -> DataFrame:
    """(id): nodes that DISCUSSED_NEAR joins with an element of ``kinds``, and the caption neighbours of those elements."""
    wanted = nodes_.filter(F.col("node_type").isin(kinds)).select("id")
    near = edges.filter("relation = 'DISCUSSED_NEAR'").join(wanted.withColumnRenamed("id", "target"), "target", "left_semi")
    base = near.select(F.col("source").alias("id")).unionByName(near.select(F.col("target").alias("id"))).distinct()
    caps = edges.filter(F.col("relation").isin(CAPTION_EDGES))
    around = caps.join(base.withColumnRenamed("id", "source"), "source", "left_semi").select(F.col("target").alias("id")).unionByName(caps.join(base.withColumnRenamed("id", "target"), "target", "left_semi").select(F.col("source").alias("id")))
    return base.unionByName(around).distinct()


def view_core(nodes_: DataFrame, edges: DataFrame) -> DataFrame:
    """(id): the figure and table views with documents and titles."""
    plain = nodes_.filter(F.col("node_type").isin("document", "title")).select("id")
    return view_elements(nodes_, edges, ["figure", "table"]).unionByName(plain).distinct()


def view_focus(edges: DataFrame, node: str) -> DataFrame:
    """(id): a node, its neighbours, and one caption hop from those."""
    one = edges.filter((F.col("source") == node) | (F.col("target") == node))
    base = one.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    caps = edges.filter(F.col("relation").isin(CAPTION_EDGES))
    hop = caps.join(base.withColumnRenamed("id", "source"), "source", "left_semi").select(F.col("target").alias("id")).unionByName(caps.join(base.withColumnRenamed("id", "target"), "target", "left_semi").select(F.col("source").alias("id")))
    return base.unionByName(hop).distinct()


def view_scope(nodes_: DataFrame, section: str | None = None, page: int | None = None) -> DataFrame:
    """Nodes of a section and/or page; documents always pass."""
    keep = F.lit(True)
    if section is not None:
        keep = keep & F.coalesce(F.col("section") == section, F.lit(False))
    if page is not None:
        keep = keep & F.coalesce(F.lit(page).between(F.col("page_start"), F.col("page_end")), F.lit(False))
    return nodes_.filter((F.col("node_type") == "document") | keep)


def view_search(nodes_: DataFrame, query: str) -> DataFrame:
    """Nodes with the words in label, reference, section, caption, type or id, ignoring case."""
    hay = F.lower(F.concat_ws(" ", "label", "ref", "section", "caption", "node_type", "id"))
    return nodes_.filter(hay.contains(query.lower()))


def visible_edges(edges: DataFrame, ids: DataFrame, relations: list[str] | None = None) -> DataFrame:
    """Edges with both ends visible and, unless all are asked for, of the given relations."""
    kept = edges if relations is None else edges.filter(F.col("relation").isin(relations))
    return kept.join(ids.select(F.col("id").alias("source")), "source", "left_semi").join(ids.select(F.col("id").alias("target")), "target", "left_semi")


def artifact_checks(edges: DataFrame, metrics: DataFrame, n: int = 12) -> DataFrame:
    """(check, ok): invariants of the graph and its counters."""
    m = metrics.select(F.explode(F.array(F.struct(F.lit("kept_within_candidates").alias("check"), (F.col("kept") <= F.col("candidates")).alias("ok")), F.struct(F.lit("pruned_is_difference").alias("check"), (F.col("pruned") == F.greatest(F.lit(0), F.col("candidates") - F.col("kept"))).alias("ok")))).alias("c")).select("c.*")
    loops = edges.agg((F.count_if(F.col("source") == F.col("target")) == 0).alias("ok")).select(F.lit("no_loops").alias("check"), "ok")
    light = edges.agg((F.count_if(F.col("weight") < 1) == 0).alias("ok")).select(F.lit("weights_from_one").alias("check"), "ok")
    per = edges.filter("relation = 'DISCUSSED_NEAR'").groupBy("target").count().agg((F.coalesce(F.max("count"), F.lit(0)) <= n).alias("ok")).select(F.lit("links_within_limit").alias("check"), "ok")
    return m.unionByName(loops).unionByName(light).unionByName(per)
