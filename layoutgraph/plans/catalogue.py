"""All core queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from layoutgraph.plans import documents, documents_sql


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return documents.cooccurrence_edges(spark, sf).orderBy(F.desc("weight"), "a", "b").limit(50)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return documents.QUERIES


def oracle_sql() -> dict[str, str]:
    return documents_sql.SQL
