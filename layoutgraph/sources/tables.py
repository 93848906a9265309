"""Readers for the Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of ``folder``. Column pruning and filters reach the scan; nothing is inferred or cached."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
