"""Queries of problems 2, 3 and 5 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layoutgraph.llm import names, surprise, topn
from layoutgraph.operators import cooccur
from layoutgraph.plans.session import cut
from layoutgraph.sources.tables import table


def p2_best_mentions(spark: SparkSession, sf: str) -> DataFrame:
    found = topn.best_mentions(table(spark, sf, "entities"), 5)
    return found.select("element_id", "mention_id", "confidence", F.col("rank").cast("long").alias("rank"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return topn.best_mentions(table(spark, sf, "entities"), 5).select("element_id", "mention_id")


def _chunk_count(spark: SparkSession, sf: str) -> int:
    return table(spark, sf, "chunks").agg(F.countDistinct("chunk_id")).first()[0]


def p3_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair with its counts, the count expected by chance, tail probability and false-discovery rate."""
    members = cut(cooccur.mention_baskets(table(spark, sf, "entities")), "members")
    return surprise.surprise(cut(cooccur.pair_counts(members, _chunk_count(spark, sf)), "pairs"), members)


def p3_pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    members = cooccur.mention_baskets(table(spark, sf, "entities"))
    return cooccur.pair_counts(members, _chunk_count(spark, sf))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs more frequent than the null model expects, of those the ones the definition names (an exact check)."""
    n = _chunk_count(spark, sf)
    sure = p3_pairs(spark, sf).filter("n_ab > expected")
    return sure.filter((F.col("n_ab") >= 4) & (F.col("n_ab") * F.lit(n) >= 8 * F.col("n_a") * F.col("n_b"))).select(F.col("a").alias("normalized_a"), F.col("b").alias("normalized_b"))


def p5_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Every PERSON or ORG spelling with its class, the class's size and the number of its links."""
    classed = names.classes(table(spark, sf, "entities"))
    sizes = classed.groupBy("kind", "cls").agg(F.count(F.lit(1)).alias("spellings"))
    return classed.join(sizes, ["kind", "cls"]).select("value", "kind", "cls", "spellings", (F.col("spellings") - 1).alias("links"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return names.variant_pairs(names.classes(table(spark, sf, "entities")))


QUERIES = {"p5_found": p5_found, "p5_classes": p5_classes, "p2_found": p2_found, "p2_best_mentions": p2_best_mentions, "p3_found": p3_found, "p3_pairs": p3_pairs, "p3_pair_counts": p3_pair_counts}

_BEST = """
WITH latest AS (
  SELECT mention_id, confidence, normalized, related_element_ids FROM (
    SELECT *, row_number() OVER (PARTITION BY mention_id ORDER BY ingested_at DESC NULLS LAST, confidence DESC NULLS LAST, normalized DESC NULLS LAST) AS r
    FROM entities WHERE mention_id IS NOT NULL) WHERE r = 1),
named AS (
  SELECT DISTINCT mention_id, confidence, normalized, element_id
  FROM (SELECT mention_id, confidence, normalized, unnest(related_element_ids) AS element_id FROM latest)
  WHERE element_id IS NOT NULL AND trim(element_id) <> '' AND confidence IS NOT NULL AND NOT isnan(confidence) AND confidence BETWEEN 0 AND 1),
ranked AS (
  SELECT element_id, mention_id, confidence,
         row_number() OVER (PARTITION BY element_id ORDER BY confidence DESC, normalized ASC NULLS LAST, mention_id) AS rank
  FROM named)
"""
_PAIRS = """
WITH m AS (
  SELECT DISTINCT trim(c) AS basket, normalized AS item
  FROM (SELECT unnest(string_split(chunk_id, ',')) AS c, normalized FROM entities)
  WHERE trim(c) <> '' AND normalized IS NOT NULL AND trim(normalized) <> ''),
f AS (SELECT item, count(*) AS k FROM m GROUP BY item),
p AS (SELECT x.item AS a, y.item AS b, count(*) AS n_ab FROM m x JOIN m y ON x.basket = y.basket AND x.item < y.item GROUP BY ALL),
n AS (SELECT count(DISTINCT chunk_id) AS n FROM chunks)
"""
SQL = {
    "p2_found": _BEST + "SELECT element_id, mention_id FROM ranked WHERE rank <= 5",
    "p2_best_mentions": _BEST + "SELECT element_id, mention_id, confidence, rank FROM ranked WHERE rank <= 5",
    "p3_found": _PAIRS + "SELECT a AS normalized_a, b AS normalized_b FROM p JOIN f fa ON a = fa.item JOIN f fb ON b = fb.item, n WHERE n_ab >= 4 AND n_ab * n >= 8 * fa.k * fb.k",
    "p3_pair_counts": _PAIRS + "SELECT a, b, n_ab, fa.k AS n_a, fb.k AS n_b FROM p JOIN f fa ON a = fa.item JOIN f fb ON b = fb.item",
}
