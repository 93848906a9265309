"""Block cleaning, document counts and parse validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from layoutgraph.functions import text as T

#: Patterns of noise blocks (bare numbers, page marks, watermarks), searched in the stripped text.
NOISE = [r"^\d+$", r"^page\s*\d+", r"^стр\.\s*\d+", r"^\s*[-–—]\s*\d+\s*[-–—]\s*$", r"confidential|draft|watermark"]
REPEATS = 3


def clean_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks without blanks, noise, and the third and later block of a document with the same first 100 characters.
    Null contents count as blank."""
    text = T.strip(F.coalesce("content", F.lit("")))
    noisy = F.lit(False)
    for pattern in NOISE:
        noisy = noisy | F.col("_t").rlike("(?iu)" + pattern)
    kept = blocks.withColumn("_t", text).filter((F.col("_t") != "") & ~noisy)
    order = Window.partitionBy("source_hash", F.substring("_t", 1, 100)).orderBy("block_index", "block_id")
    return kept.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") < REPEATS).drop("_t", "_r")


def total_pages(blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """(source_hash, pages): the highest page of any block or element, plus one."""
    pages = blocks.select("source_hash", "page_number").unionByName(elements.select("source_hash", "page_number"))
    return pages.groupBy("source_hash").agg((F.coalesce(F.max("page_number"), F.lit(0)) + 1).cast("int").alias("pages"))


def type_counts(blocks: DataFrame) -> DataFrame:
    """(source_hash, block_type, n); a null type counts as unknown."""
    return blocks.groupBy("source_hash", F.coalesce("block_type", F.lit("unknown")).alias("block_type")).agg(F.count(F.lit(1)).alias("n"))


def parse_validation(blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """Warnings of each document as flags and counts: pages without a block, more than a tenth of blocks under five
    characters, a mean text block under 20 characters, tables without table signs, images but no figure."""
    text = F.coalesce("content", F.lit(""))
    per = blocks.groupBy("source_hash").agg(
        F.count(F.lit(1)).alias("blocks"), F.countDistinct("page_number").alias("pages_with_blocks"), F.count_if(F.length(T.strip(text)) < 5).alias("short"),
        F.avg(F.when(F.col("block_type") == "text", F.length(text))).alias("mean_text"), F.count_if((F.col("block_type") == "table") & ~text.contains("|") & ~text.contains("<")).alias("plain_tables"),
    )
    images = elements.groupBy("source_hash").agg(F.count_if(F.col("image_path").isNotNull()).alias("images"), F.count_if(F.col("element_type") == "figure").alias("figures"))
    return per.join(total_pages(blocks, elements), "source_hash").join(images, "source_hash", "left").select(
        "source_hash", (F.col("pages") - F.col("pages_with_blocks")).cast("int").alias("missing_pages"), (F.col("short") > F.col("blocks") * 0.1).alias("many_short"), (F.coalesce("mean_text", F.lit(99.0)) < 20).alias("short_text"),
        F.col("plain_tables").cast("long").alias("plain_tables"), ((F.coalesce("images", F.lit(0)) > 0) & (F.coalesce("figures", F.lit(0)) == 0)).alias("images_without_figures"),
    )


def missing_pages(blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """(source_hash, page_number) of pages below the total that no block stands on."""
    every = total_pages(blocks, elements).select("source_hash", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)).alias("page_number"))
    return every.join(blocks.select("source_hash", "page_number").distinct(), ["source_hash", "page_number"], "left_anti")
