"""Incremental ingestion: parser output arriving as JSON files becomes blocks and elements, document by document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from layoutgraph.operators import structure

INPUT = "source_hash string, json string, arrived_at timestamp"


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Layout JSON lines (source_hash, json, arrived_at) as they arrive; a document delivered again within a day is
    dropped by its hash, and state older than that is let go."""
    rows = spark.readStream.schema(INPUT).json(folder)
    return rows.withWatermark("arrived_at", "1 day").dropDuplicatesWithinWatermark(["source_hash"])


def write_structure(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Blocks and elements of each micro-batch below ``folder``. A batch that is run again after a failure overwrites its
    own partition, so each document stands once."""

    def batch(df: DataFrame, number: int) -> None:
        items = structure.flatten_items(df.select("source_hash", "json"))
        items = items.persist()
        for name, table in (("elements", structure.items_to_elements(items)), ("blocks", structure.items_to_blocks(items))):
            table.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        items.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(stream: DataFrame, window: str = "1 hour") -> DataFrame:
    """(start, documents): documents per window of arrival."""
    return stream.groupBy(F.window("arrived_at", window).alias("w")).agg(F.count(F.lit(1)).alias("documents")).select(F.col("w.start").alias("start"), "documents")
