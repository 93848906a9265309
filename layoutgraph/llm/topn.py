"""Problem 2: the N best items of every group, by descending score bands.

The rows are written once as a table partitioned by score band (equal-depth, best band first). Bands are
processed from the top; groups that already hold N rows are anti-joined away, so lower bands shrink to the
groups that still need items. What survives are at most the rows down to each group's boundary band; there the
exact tie rule ranks them, with a per-partition limit of N rows a group before the only wide shuffle, so a group
of millions of rows never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from layoutgraph.plans.session import cut, new_table_path


def top_n_per_group(rows: DataFrame, group: str, score: str, ties: list[Column], n: int, bands: int = 4, rank: str = "rank") -> DataFrame:
    """The ``n`` rows of each ``group`` with the highest ``score``; equal scores in the order of ``ties``.

    Rows whose group or score is null or NaN don't compete. ``ties`` must make the order total for a unique result;
    exact copies of a row each take a place. An empty input gives an empty result. Result: the columns of
    ``rows`` and ``rank`` (1 = best), which must not be a column already.
    """
    if rank in rows.columns:
        raise ValueError(f"rows already have a column {rank}")
    spark = rows.sparkSession
    band = "_band"
    while band in rows.columns:
        band += "_"
    rows = rows.filter(F.col(group).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    shares = [k / bands for k in range(1, bands)]
    edges = rows.agg(F.percentile_approx(score, shares, 1000).alias("e")).first()["e"] or []
    number = F.lit(0)
    for edge in sorted(set(edges), reverse=True):  # band 0 is the best; a score equal to an edge stays above it
        number = number + (F.col(score) < F.lit(edge)).cast("int")
    path = new_table_path(spark, "bands")
    schema = rows.withColumn(band, number).schema
    rows.withColumn(band, number).write.partitionBy(band).parquet(path)
    stored = spark.read.schema(schema).parquet(path)

    kept, progress = None, None
    count = len(set(edges)) + 1
    for b in range(count):
        part = stored.filter(F.col(band) == b)
        if progress is not None:
            part = part.join(progress.filter(F.col("_n") >= n).select(group), group, "left_anti").select(*stored.columns)
        kept = part if kept is None else kept.unionByName(part)
        if b + 1 < count:
            counts = part.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
            if progress is not None:
                counts = counts.unionByName(progress).groupBy(group).agg(F.sum("_n").alias("_n"))
            progress = cut(counts, "filled")
    order = Window.partitionBy(group).orderBy(F.col(score).desc(), *ties)
    return kept.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= n).drop(band)


def latest_deliveries(mentions: DataFrame) -> DataFrame:
    """One row per mention_id: its delivery with the latest ingested_at (null counts as the earliest; equal times:
    the higher confidence, then the greater normalized). Rows without a mention_id name no mention and are left out."""
    payload = ["confidence", "normalized", "related_element_ids"]
    best = F.max_by(
        F.struct(*payload),
        F.struct(F.coalesce("ingested_at", F.lit("0001-01-01").cast("timestamp_ntz")), F.coalesce("confidence", F.lit(float("-inf"))), F.coalesce("normalized", F.lit(""))),
    )
    return mentions.filter("mention_id is not null").groupBy("mention_id").agg(best.alias("d")).select("mention_id", "d.*")


def best_mentions(mentions: DataFrame, n: int = 5, bands: int = 4) -> DataFrame:
    """The ``n`` best mentions of every element named in related_element_ids: (element_id, mention_id, confidence,
    normalized, rank). Blank or null ids name nothing; an id twice in one array counts once; a mention whose latest
    delivery has a confidence that is null, NaN or outside 0 to 1 doesn't compete."""
    latest = latest_deliveries(mentions.select("mention_id", "confidence", "normalized", "related_element_ids", F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at")))
    named = F.array_distinct(F.filter("related_element_ids", lambda x: x.isNotNull() & x.rlike(r"\S")))
    rows = latest.filter(F.col("confidence").between(0.0, 1.0)).select("mention_id", "confidence", "normalized", F.explode(named).alias("element_id"))
    return top_n_per_group(rows, "element_id", "confidence", [F.col("normalized").asc_nulls_last(), F.col("mention_id").asc()], n, bands)
