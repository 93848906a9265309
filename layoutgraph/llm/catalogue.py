"""Queries of the operators of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from layoutgraph.llm import language, leakage, markup, ocr, packing, problems, sentences, toxicity
from layoutgraph.sources.tables import table


def _languages(spark: SparkSession, sf: str) -> DataFrame:
    chunks = table(spark, sf, "chunks")
    return language.languages(chunks, sentences.fit(chunks, table(spark, sf, "entities")))


def p1_languages(spark: SparkSession, sf: str) -> DataFrame:
    return _languages(spark, sf).select("chunk_id", "declared", "lang", "confidence")


def p1_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _languages(spark, sf).select("chunk_id", F.explode("runs").alias("r")).select("chunk_id", "r.*")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return language.wrong_labels(_languages(spark, sf))


def p4_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return sentences.sentences(table(spark, sf, "chunks"), table(spark, sf, "entities"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return p4_sentences(spark, sf).drop("unit_no")


def _markup(spark: SparkSession, sf: str) -> DataFrame:
    return markup.records(table(spark, sf, "blocks"), table(spark, sf, "elements"))


def p6_units(spark: SparkSession, sf: str) -> DataFrame:
    return markup.units(_markup(spark, sf))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return p6_units(spark, sf).drop("text")


def p6_clean(spark: SparkSession, sf: str) -> DataFrame:
    return markup.unique_text(_markup(spark, sf))


def _scans(spark: SparkSession, sf: str) -> DataFrame:
    return ocr.noise(table(spark, sf, "blocks"), table(spark, sf, "entities"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return _scans(spark, sf).select("rec_table", "rec_id", F.explode("noise").alias("noise")).distinct()


def p7_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return _scans(spark, sf).filter(F.size("noise") > 0).select("rec_table", "rec_id", "text").distinct()


def p8_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(packing.token_counts(table(spark, sf, "documents")), table(spark, sf, "containers"))


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill_report(p8_packing(spark, sf), table(spark, sf, "containers"))


def p9_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p9_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's length before and after its repeats of test passages are cut out."""
    documents = table(spark, sf, "documents")
    cleaned = leakage.without_leaks(documents.withColumn("before", F.length("text")), leakage.leaks(documents, table(spark, sf, "eval_items")))
    return cleaned.select("doc_id", "before", F.length("text").alias("after"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p9_leaks(spark, sf).select("doc_id", "item_id").distinct()


def p10_scores(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return toxicity.scores(documents, toxicity.fit(documents, table(spark, sf, "content_labels")))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.flagged(p10_scores(spark, sf))


def p10_rates(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.rates(p10_scores(spark, sf))


_QUERIES = [p1_found, p1_languages, p1_runs, p4_found, p4_sentences, p6_found, p6_units, p6_clean, p7_found, p7_repaired, p8_packing, p8_fill, p9_found, p9_leaks, p9_clean, p10_found, p10_scores, p10_rates]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return problems.QUERIES | {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return problems.SQL
