"""The whole way from parser output to graphs, each phase written once and read by the next.

    python -m layoutgraph.plans.pipeline PARSER_OUTPUT OUT [--recogniser MODULE:FACTORY] [--max-tokens 512] [--min-weight 1] [--top-n 12]
"""

from __future__ import annotations

import argparse
import importlib
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from layoutgraph.functions import text as T
from layoutgraph.operators import chunking, cleaning, cograph, entities as E, linking as L, provenance as P, resolve as R, structure as S
from layoutgraph.plans.session import build_session, cut, release
from layoutgraph.sources import export, layout


def run(spark: SparkSession, parsed: DataFrame, out: str, max_tokens: int = 512, min_tokens: int = 50, overlap: int = 2, min_weight: int = 1, top_n: int = 12, recogniser: Callable[[], E.Recogniser] | None = None, engine: str = "custom") -> dict[str, DataFrame]:
    """``parsed``: (source_hash, source_doc, json) and, if there, markdown, which is read where the layout JSON gives no item.
    A source_hash given twice counts once, by its least source_doc. Writes and returns elements, blocks, chunks, mentions,
    failures, entities, resolved, co_nodes, co_edges, link_nodes, link_edges and link_summary below ``out``.

    ``recogniser`` makes the recogniser of mentions, once per Python worker; ``engine`` is its name in the mentions.
    Without one the rule of the fixtures is used, which finds single words in ASCII letters only, and a warning says so.
    """
    made: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        made[name] = spark.read.schema(df.schema).parquet(f"{out}/{name}")
        return made[name]

    if "markdown" not in parsed.columns:
        parsed = parsed.withColumn("markdown", F.lit(None).cast("string"))
    parsed = cut(parsed.groupBy("source_hash").agg(F.min(F.struct("source_doc", "json", "markdown")).alias("d")).select("source_hash", "d.*"), "parsed")
    docs = parsed.select("source_hash", "source_doc")
    items = cut(S.flatten_items(parsed.filter("json is not null").select("source_hash", "json")), "items")
    without = parsed.filter("markdown is not null").join(S.items_to_blocks(items).select("source_hash").distinct(), "source_hash", "left_anti")
    written = S.markdown_blocks(without, "source_hash", "markdown")
    restored = S.markdown_elements(written, "source_hash")
    elements = S.items_to_elements(items).join(restored.select("source_hash").distinct(), "source_hash", "left_anti").unionByName(restored)
    links = S.caption_links(elements)
    targets = S.target_captions(links, elements)
    elements = elements.join(links.select(F.col("caption_id").alias("element_id"), F.col("target_id").alias("linked_element_id")), "element_id", "left").join(targets.select(F.col("target_id").alias("element_id"), F.col("caption_id").alias("caption_element_id")), "element_id", "left")
    elements = elements.withColumn("metadata", F.struct("caption_element_id", "linked_element_id", F.when(F.col("linked_element_id").isNotNull(), "caption_of").alias("relation"), "text_level")).drop("caption_element_id", "linked_element_id", "text_level")
    elements = keep("elements", elements.withColumn("source_block_index", F.col("block_index")))
    from_text = restored.select("source_hash", F.col("element_type").alias("block_type"), F.col("text").alias("content"), "page_number", "bbox", "block_index")
    blocks = S.items_to_blocks(items).unionByName(from_text).withColumn("block_id", F.concat(F.substring("source_hash", 1, 8), F.lit("_b"), F.lpad(F.col("block_index").cast("string"), 4, "0")))
    blocks = keep("blocks", cleaning.clean_blocks(blocks))
    chunks = chunking.section_chunks(chunking.sections(chunking.titled_blocks(blocks, elements)), max_tokens, min_tokens)
    chunks = chunking.keep_chunks(chunking.add_overlap(chunks, overlap)).withColumnsRenamed({"title": "section_title", "hierarchy": "section_hierarchy"}).join(docs, "source_hash")
    source = P.source_elements(chunks, elements)
    listed = lambda df, name: df.groupBy("chunk_id").agg(F.array_sort(F.collect_list("element_id")).alias(name))
    none = F.array().cast("array<string>")
    chunks = chunks.join(listed(source, "source_element_ids"), "chunk_id", "left").join(listed(P.related_elements(chunks, elements, source), "related_element_ids"), "chunk_id", "left")
    chunks = keep("chunks", chunks.withColumns({c: F.coalesce(c, none) for c in ("source_element_ids", "related_element_ids")}))
    if recogniser is None:
        warnings.warn("no recogniser given: the fixtures' rule finds capitalised words of ASCII letters only", stacklevel=2)
        found = E.rule_mentions(chunks).withColumn("confidence", F.lit(0.85))
    else:
        made_now = cut(E.recognise(chunks, recogniser, engine), "recognised")
        keep("failures", E.failures(made_now))
        found = made_now.filter(F.col("entity_type") != E.FAILED)
    found = found.withColumn("normalized", T.normalize_entity(F.col("text")))
    found = P.mention_provenance(found, chunks.drop("text")).join(chunks.select("chunk_id", "source_doc", F.col("text").alias("whole")), "chunk_id")
    found = found.withColumn("context", T.context(F.col("whole"), F.col("text"))).drop("whole")
    # ids in reading order: documents by hash prefix, then chunks, then mentions; first-wins rules follow them
    document = F.conv(F.substring(F.md5("source_doc"), 1, 7), 16, 10).cast("long")
    chunk_no = F.try_to_number(F.regexp_extract("chunk_id", r"(\d+)$", 1), F.lit("999999")).cast("long")
    found = found.withColumn("mention_id", document * F.lit(1 << 35) + F.coalesce(chunk_no, F.lit(0)) * F.lit(1 << 18) + F.col("ord"))
    mentions = keep("mentions", found)
    entities = keep("entities", E.deduplicate(E.drop_noise(mentions)))
    strict = R.strict_entities(entities)
    names = strict.groupBy(F.col("normalized").alias("name")).agg(F.count(F.lit(1)).alias("size"), F.min("first_mention").alias("first"))
    clusters = R.greedy_clusters(names, R.similar_names(names))
    resolved = keep("resolved", R.resolved_entities(strict, clusters))
    edges = keep("co_edges", cograph.edges(cograph.entity_members(resolved), min_weight))
    placed_in = cograph.degrees(edges).select("item", "degree").join(cograph.louvain(edges), "item")
    keep("co_nodes", cograph.entity_nodes(resolved).join(placed_in, "item", "left").withColumn("degree", F.coalesce("degree", F.lit(0))))
    placed = elements.join(docs, "source_hash", "left")
    ranked = L.ranked_links(L.discussed_near(entities, placed, chunks), top_n)
    nodes = keep("link_nodes", L.nodes(docs, chunks, placed, entities))
    keep("link_edges", L.structural_edges(docs, chunks, placed, entities).unionByName(L.near_edges(ranked)))
    keep("link_summary", L.link_summary(nodes, made["link_edges"]))
    return made


def load_factory(name: str) -> Callable[[], E.Recogniser]:
    """The recogniser factory at ``MODULE:NAME``."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser()
    p.add_argument("parser_output")
    p.add_argument("out")
    p.add_argument("--max-tokens", type=int, default=512)
    p.add_argument("--min-weight", type=int, default=1)
    p.add_argument("--top-n", type=int, default=12)
    p.add_argument("--recogniser", metavar="MODULE:FACTORY", help="makes an object with extract(text, chunk_id); without it only the fixtures' rule for ASCII words")
    a = p.parse_args(argv)
    factory = load_factory(a.recogniser) if a.recogniser else None
    spark = build_session()
    # documents of one layout are still different documents, so the name goes into the hash
    parsed = layout.parser_output(spark, a.parser_output).select(F.md5(F.concat_ws("\0", "doc", "json", "markdown")).alias("source_hash"), F.col("doc").alias("source_doc"), "json", "markdown")
    made = run(spark, parsed, a.out, max_tokens=a.max_tokens, min_weight=a.min_weight, top_n=a.top_n, recogniser=factory, engine=a.recogniser or "rule")
    export.write_graphml(made["link_nodes"], made["link_edges"], f"{a.out}/graphml")
    export.write_graphml(made["co_nodes"], made["co_edges"], f"{a.out}/co_graphml", node_id="item", source="a", target="b", directed=False)
    for row in made["link_summary"].collect():  # one row
        print(row.asDict())
    release(spark)


if __name__ == "__main__":
    main()
