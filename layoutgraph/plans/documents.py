"""Queries of the document and graph operators over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from layoutgraph.functions import text as T
from layoutgraph.operators import chunking, cleaning, cograph, cooccur, entities as E, linking as L, provenance as P, resolve as R, structure as S
from layoutgraph.plans.session import cut
from layoutgraph.sources.tables import table


def _blocks(spark, sf):
    return S.distinct_rows(table(spark, sf, "blocks"), "block_id")


def _elements(spark, sf):
    return S.distinct_rows(table(spark, sf, "elements"), "element_id")


def _chunks(spark, sf):
    return S.distinct_rows(table(spark, sf, "chunks"), "chunk_id")


def _mentions(spark, sf):
    """The latest delivery of every mention."""
    order = Window.partitionBy("mention_id").orderBy(F.col("ingested_at").desc_nulls_last(), F.col("confidence").desc_nulls_last(), F.col("normalized").desc_nulls_last())
    return table(spark, sf, "entities").filter("mention_id is not null").withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def _csv(c: str):
    return F.array_join(F.array_sort(c), ",")


# structure -------------------------------------------------------------------------------------------------------------


def md_blocks(spark, sf):
    return S.markdown_blocks(table(spark, sf, "documents"))


def md_elements(spark, sf):
    """Elements of documents that have markdown alone."""
    return S.markdown_elements(S.markdown_blocks(table(spark, sf, "documents"))).select("doc_id", "block_index", "element_type", "text", "ref_label", "section_title")


def element_types(spark, sf):
    b = _blocks(spark, sf)
    no = F.lit(False)
    return b.select("block_id", S.element_type(F.col("block_type"), F.col("content"), no, no, no, no).alias("element_type"))


def ref_labels(spark, sf):
    return _blocks(spark, sf).select("block_id", T.is_caption(F.col("content")).alias("is_caption"), T.ref_label(F.col("content")).alias("ref_label"))


def strip_wrappers(spark, sf):
    return _blocks(spark, sf).select("block_id", T.strip_wrappers(F.col("content")).alias("inner_text"))


def section_carry(spark, sf):
    return S.section_carry(_elements(spark, sf))


def caption_links(spark, sf):
    return S.caption_links(_elements(spark, sf))


def target_captions(spark, sf):
    e = _elements(spark, sf)
    return S.target_captions(S.caption_links(e), e)


def flatten_items(spark, sf):
    """Blocks written as parser JSON, a page list per document, and read back."""
    b = _blocks(spark, sf).filter("content is not null and block_type is not null")
    pages = b.groupBy("source_hash", "page_number").agg(F.array_sort(F.collect_list(F.struct("block_index", "block_id", F.col("block_type").alias("type"), F.col("content").alias("text")))).alias("items"))
    docs = pages.groupBy("source_hash").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "items"))), lambda p: p["items"]).alias("pages"))
    items = S.flatten_items(docs.select("source_hash", F.to_json("pages").alias("json")))
    return items.select("source_hash", "item_idx", F.try_variant_get("item", "$.block_id", "string").alias("block_id"), S.item_text(F.col("item")).alias("item_text"))


# cleaning --------------------------------------------------------------------------------------------------------------


def clean_blocks(spark, sf):
    return cleaning.clean_blocks(_blocks(spark, sf)).select("block_id")


def block_type_counts(spark, sf):
    return cleaning.type_counts(_blocks(spark, sf))


def total_pages(spark, sf):
    return cleaning.total_pages(_blocks(spark, sf), _elements(spark, sf))


def missing_pages(spark, sf):
    return cleaning.missing_pages(_blocks(spark, sf), _elements(spark, sf))


def parse_validation(spark, sf):
    return cleaning.parse_validation(_blocks(spark, sf), _elements(spark, sf))


# chunking --------------------------------------------------------------------------------------------------------------


def token_estimate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


def sentence_split(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("sentence_no", "sentence"))


def _titled(spark, sf):
    return chunking.titled_blocks(_blocks(spark, sf), _elements(spark, sf))


def title_levels(spark, sf):
    return _titled(spark, sf).select("block_id", "level", F.coalesce("title", F.lit("")).alias("title"))


def section_groups(spark, sf):
    t = _titled(spark, sf)
    body = F.when(F.col("level") == 0, 1).otherwise(0)
    return t.groupBy("source_hash", "section").agg(F.sum(body).alias("blocks"), F.min("page_number").alias("page_start"), F.max("page_number").alias("page_end")).filter("blocks > 0")


def heading_hierarchy(spark, sf):
    return chunking.sections(_titled(spark, sf)).select("source_hash", "section", F.array_join("hierarchy", " > ").alias("hierarchy"))


def _section_chunks(spark, sf):
    return chunking.section_chunks(chunking.sections(_titled(spark, sf)))


def section_chunks(spark, sf):
    return _section_chunks(spark, sf).select("chunk_id", "text", "token_count", "page_start", "page_end", F.array_join(F.transform("block_indices", lambda x: x.cast("string")), ",").alias("block_indices"))


def chunk_overlap(spark, sf):
    return chunking.keep_chunks(chunking.add_overlap(_section_chunks(spark, sf))).select("chunk_id", "text", "token_count", "overlap_prev", "overlap_next")


def sliding_chunks(spark, sf):
    return chunking.sliding_chunks(_blocks(spark, sf)).select("chunk_id", "text", "token_count", "overlap_prev", "overlap_next")


def chunk_stats(spark, sf):
    return chunking.chunk_stats(_chunks(spark, sf))


def chunk_histogram(spark, sf):
    return chunking.chunk_histogram(_chunks(spark, sf))


# provenance ------------------------------------------------------------------------------------------------------------


def chunk_source_blocks(spark, sf):
    return P.source_blocks(_chunks(spark, sf), _blocks(spark, sf))


def chunk_source_elements(spark, sf):
    return P.source_elements(_chunks(spark, sf), _elements(spark, sf))


def chunk_related_elements(spark, sf):
    return P.related_elements(_chunks(spark, sf), _elements(spark, sf))


def text_containment_blocks(spark, sf):
    return P.blocks_in_text(_chunks(spark, sf), _blocks(spark, sf))


def mention_provenance(spark, sf):
    m = E.rule_mentions(_chunks(spark, sf))
    out = P.mention_provenance(m, _chunks(spark, sf))
    return out.select("chunk_id", "ord", "text", "page_start", "page_end", F.coalesce("section_title", F.lit("")).alias("section_title"))


# entities --------------------------------------------------------------------------------------------------------------


def normalize_entities(spark, sf):
    return _mentions(spark, sf).filter("text is not null").select("mention_id", T.normalize_entity(F.col("text")).alias("name"))


def entity_context(spark, sf):
    first = _mentions(spark, sf).select("mention_id", F.col("text").alias("name"), F.try_element_at(T.split_ids(F.col("chunk_id")), F.lit(1)).alias("chunk_id")).filter("chunk_id is not null and name <> ''")
    return first.join(_chunks(spark, sf).select("chunk_id", "text"), "chunk_id").select("mention_id", T.context(F.col("text"), F.col("name")).alias("context"))


def sentence_context(spark, sf):
    return E.sentence_context(_mentions(spark, sf).filter("text is not null"), _chunks(spark, sf))


def lang_detect(spark, sf):
    return _chunks(spark, sf).filter("text is not null").select("chunk_id", T.dominant_language(F.col("text")).alias("language"))


def text_segments(spark, sf):
    return _chunks(spark, sf).filter("text is not null").select("chunk_id", F.posexplode(T.segments(F.col("text"), 800, 700)).alias("segment_no", "segment"))


def rule_mentions(spark, sf):
    return E.rule_mentions(_chunks(spark, sf))


def filter_noise(spark, sf):
    return E.drop_noise(_mentions(spark, sf)).select("mention_id")


def _entities(spark, sf):
    return E.deduplicate(E.drop_noise(_mentions(spark, sf)))


def dedup_entities(spark, sf):
    return _entities(spark, sf).select("source_doc", "normalized", "entity_type", "text", "confidence", F.array_join("chunk_ids", ",").alias("chunk_ids"), "page_start", "page_end", F.array_join("related_element_ids", ",").alias("related_element_ids"), "mentions")


def ranked_entities(spark, sf):
    return E.ranked(_entities(spark, sf)).select("source_doc", "normalized", "entity_type", F.col("place").cast("long").alias("place"))


def entity_type_counts(spark, sf):
    return E.type_counts(_entities(spark, sf))


def noise_reasons(spark, sf):
    return _mentions(spark, sf).groupBy(F.coalesce(R.noise_reason(), F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def clean_entities(spark, sf):
    return R.strict_entities(_mentions(spark, sf)).select("mention_id")


def _strict(spark, sf):
    """Entities of the strict filter, materialised: they feed several joins."""
    return cut(E.deduplicate(R.strict_entities(_mentions(spark, sf))), "entities")


def fuzzy_pairs(spark, sf):
    return R.similar_names(R.strict_entities(_mentions(spark, sf)).select(F.col("normalized").alias("name")))


def fuzzy_pairs_baseline(spark, sf):
    return R.similar_names(R.baseline_entities(_mentions(spark, sf)).select(F.col("normalized").alias("name")), strict=False)


def _clusters(ents):
    names = ents.filter("normalized is not null").groupBy(F.col("normalized").alias("name")).agg(F.count(F.lit(1)).alias("size"), F.min("first_mention").alias("first"))
    return R.greedy_clusters(names, R.similar_names(names))


def entity_clusters(spark, sf):
    return _clusters(_strict(spark, sf))


def _resolved(spark, sf):
    ents = _strict(spark, sf)
    return cut(R.resolved_entities(ents, _clusters(ents)), "resolved")


def resolve_entities(spark, sf):
    return _resolved(spark, sf).select("normalized", "text", "entity_type", "confidence", "frequency", F.size("chunk_ids").alias("chunks"), F.size("source_docs").alias("docs"), F.array_join("aliases", "|").alias("aliases"))


def resolved_refs(spark, sf):
    return R.related_refs(_resolved(spark, sf), _elements(spark, sf)).select("normalized", F.array_join("refs", "|").alias("refs"))


# co-occurrence graph ---------------------------------------------------------------------------------------------------


def _members(spark, sf):
    m = R.strict_entities(_mentions(spark, sf)).select(F.explode(T.split_ids(F.col("chunk_id"))).alias("c"), "normalized")
    return cooccur.baskets(m, "c", "normalized")


def cooccurrence_edges(spark, sf):
    return cograph.edges(_members(spark, sf))


def clean_graph_edges(spark, sf):
    return cograph.edges(_members(spark, sf), 2)


def graph_isolates(spark, sf):
    m = _members(spark, sf)
    return cograph.isolates(m.select("item").distinct(), cograph.edges(m, 2))


def graph_degrees(spark, sf):
    return cograph.degrees(cograph.edges(_members(spark, sf), 2))


def graph_density(spark, sf):
    m = _members(spark, sf)
    return cograph.density(m.select("item"), cograph.edges(m, 2))


def graph_components(spark, sf):
    return cograph.connected(cograph.edges(_members(spark, sf), 2))


def _ranks(spark, sf):
    """Twenty rounds, as the SQL states them; without rounds given, pagerank goes on until the ranks settle."""
    return cograph.pagerank(cograph.edges(_members(spark, sf), 2), rounds=20, tolerance=0)


def pagerank_top(spark, sf):
    return cograph.top_ranked(_ranks(spark, sf), 10)


def component_sizes(spark, sf):
    return cograph.group_sizes(graph_components(spark, sf), "component")


def community_sizes(spark, sf):
    return cograph.group_sizes(graph_communities(spark, sf), "community")


def graph_metrics(spark, sf):
    return cograph.metrics(cut(cograph.edges(_members(spark, sf), 2), "edges"))


def graph_louvain(spark, sf):
    return cograph.louvain(cograph.edges(_members(spark, sf), 2))


def edge_chunks(spark, sf):
    return cograph.edge_chunks(_members(spark, sf), 2).select("a", "b", "weight", F.array_join("chunks", ",").alias("chunks"))


def resolved_graph_nodes(spark, sf):
    return cograph.entity_nodes(_resolved(spark, sf)).select("item", "label", "entity_type", "frequency", "aliases", "engines", "source_element_count", "related_element_count")


def resolved_graph_edges(spark, sf):
    return cograph.edges(cograph.entity_members(_resolved(spark, sf)), 2)


def resolved_top(spark, sf):
    return R.by_frequency(_resolved(spark, sf), 20).select("normalized", "frequency")


def graph_pagerank(spark, sf):
    return _ranks(spark, sf).select("item", F.round("rank", 6).alias("rank"))


def graph_communities(spark, sf):
    return cograph.communities(cograph.edges(_members(spark, sf), 2))


def graph_heavy(spark, sf):
    """Edges of at least 3 chunks between names in at least 10."""
    m = _members(spark, sf)
    nodes = m.groupBy("item").agg(F.count(F.lit(1)).alias("frequency"))
    return cograph.heavy(nodes, cograph.edges(m), 10, 3)[1]


# linking graph ---------------------------------------------------------------------------------------------------------


def _documents(spark, sf):
    return table(spark, sf, "parsed_docs").filter("source_hash is not null").groupBy("source_hash").agg(F.min("source_doc").alias("source_doc"))


def _registry(spark, sf):
    shared = S.distinct_rows(table(spark, sf, "shared_elements"), "element_id")
    return L.registry(_elements(spark, sf), shared).join(_documents(spark, sf), "source_hash", "left")


def element_registry(spark, sf):
    return _registry(spark, sf).select("element_id", "element_type", F.coalesce("source_doc", F.lit("")).alias("source_doc"), L.element_label().alias("label"))


def link_nodes(spark, sf):
    return L.nodes(_documents(spark, sf), _chunks(spark, sf), _registry(spark, sf), _entities(spark, sf))


def _candidates(spark, sf):
    return L.discussed_near(_entities(spark, sf), _registry(spark, sf), _chunks(spark, sf))


def discussed_near_topn(spark, sf):
    return L.ranked_links(_candidates(spark, sf)).select("element_id", "ent", F.col("score_e4"), F.size("evidence").cast("long").alias("evidence"), F.col("rank").cast("long").alias("rank"), "reasons")


def near_details(spark, sf):
    return L.near_details(L.ranked_links(_candidates(spark, sf))).select("source", "target", "score_e4", "reasons", F.array_join("evidence", ",").alias("evidence"))


def node_type_counts(spark, sf):
    return L.node_type_counts(link_nodes(spark, sf))


def relation_targets(spark, sf):
    return L.relation_targets(*_graph(spark, sf))


def link_summary(spark, sf):
    return L.link_summary(*_graph(spark, sf))


def link_metrics(spark, sf):
    return L.link_metrics(_candidates(spark, sf))


def _structural(spark, sf):
    return L.structural_edges(_documents(spark, sf), _chunks(spark, sf), _registry(spark, sf), _entities(spark, sf))


def link_edges(spark, sf):
    return _structural(spark, sf)


def _graph(spark, sf):
    """Nodes and all edges, materialised once for a view."""
    near = L.near_edges(L.ranked_links(_candidates(spark, sf)))
    return cut(link_nodes(spark, sf), "nodes"), cut(_structural(spark, sf).unionByName(near), "edges")


def relation_counts(spark, sf):
    near = L.near_edges(L.ranked_links(_candidates(spark, sf)))
    return L.relation_counts(_structural(spark, sf).unionByName(near))


def view_figures(spark, sf):
    return L.view_elements(*_graph(spark, sf), ["figure"])


def view_tables(spark, sf):
    return L.view_elements(*_graph(spark, sf), ["table"])


def view_core(spark, sf):
    return L.view_core(*_graph(spark, sf))


def view_core_edges(spark, sf):
    nodes, edges = _graph(spark, sf)
    return L.visible_edges(edges, L.view_core(nodes, edges), ["DISCUSSED_NEAR", *L.CAPTION_EDGES]).select("source", "target", "relation")


def view_focus(spark, sf):
    """The neighbourhood of the first standard exhibit."""
    return L.view_focus(_graph(spark, sf)[1], "element::shared_el_0000")


def view_page(spark, sf):
    return L.view_scope(link_nodes(spark, sf), page=2).select("id")


def view_section(spark, sf):
    return L.view_scope(link_nodes(spark, sf), section="Summary of findings").select("id")


def view_search(spark, sf):
    return L.view_search(link_nodes(spark, sf), "Value at Risk").select("id")


def artifact_checks(spark, sf):
    _, edges = _graph(spark, sf)
    return L.artifact_checks(edges, L.link_metrics(_candidates(spark, sf)))


ALL = [
    md_blocks, md_elements, element_types, ref_labels, strip_wrappers, section_carry, caption_links, target_captions, flatten_items, clean_blocks, block_type_counts, total_pages, missing_pages, parse_validation, token_estimate, sentence_split, title_levels, section_groups, heading_hierarchy,
    section_chunks, chunk_overlap, sliding_chunks, chunk_stats, chunk_histogram, chunk_source_blocks, chunk_source_elements, chunk_related_elements, text_containment_blocks, mention_provenance, normalize_entities, entity_context, sentence_context, lang_detect, text_segments, rule_mentions,
    filter_noise, dedup_entities, ranked_entities, entity_type_counts, noise_reasons, clean_entities, fuzzy_pairs, fuzzy_pairs_baseline, entity_clusters, resolve_entities, resolved_refs, cooccurrence_edges, clean_graph_edges, graph_isolates, graph_degrees, graph_density, graph_components,
    graph_pagerank, pagerank_top, component_sizes, community_sizes, graph_metrics, graph_louvain, edge_chunks, resolved_graph_nodes, resolved_graph_edges, resolved_top, near_details, node_type_counts, relation_targets, link_summary, graph_communities, graph_heavy, element_registry, link_nodes, discussed_near_topn, link_metrics, link_edges, relation_counts, view_figures, view_tables, view_core, view_core_edges, view_focus, view_page, view_section, view_search, artifact_checks,
]
QUERIES = {f.__name__: f for f in ALL}
