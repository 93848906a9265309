"""Readers of source files and parser output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

SUFFIXES = ["pdf", "docx", "pptx", "xlsx", "png", "jpg", "jpeg"]  # fixed values


def supported(path: Column) -> Column:
    """Whether a path is an input: a known suffix in any case, not a lock or hidden file."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).isin(SUFFIXES) & ~name.startswith("~$") & ~name.startswith(".")


def source_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, doc_name, source_hash, size) of the supported files below a folder; the hash is the MD5 of the bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).filter(supported(F.col("path")))
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", F.regexp_replace(name, r"\.[^.]+$", "").alias("doc_name"), F.md5("content").alias("source_hash"), F.col("length").alias("size"))


def new_files(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files whose hash isn't among the parsed ones (by content, so files of one name in two folders don't collide)."""
    return files.join(done.select("source_hash").distinct(), "source_hash", "left_anti")


def parser_output(spark: SparkSession, folder: str) -> DataFrame:
    """(doc, json, markdown): of each document's folder the preferred JSON (content list, its second form, the middle
    file, any other that isn't a model file) and its markdown; a folder named auto comes first."""
    texts = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(folder).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    parts = F.split("path", "/")
    file = F.element_at(parts, -1)
    parent = F.element_at(parts, -2)
    doc = F.when(parent == "auto", F.element_at(parts, -3)).otherwise(parent)
    rank = (
        F.when(file.endswith("_content_list.json"), 0).when(file.endswith("_content_list_v2.json"), 1).when(file.endswith("_middle.json"), 2)
        .when(file.endswith(".json") & ~file.contains("model"), 3).when(file.endswith(".md"), 4)
    )
    rows = texts.select(doc.alias("doc"), "text", rank.alias("rank"), (parent != "auto").cast("int").alias("deep"), "path").filter("rank is not null")
    best = Window.partitionBy("doc", F.col("rank") == 4).orderBy("deep", "rank", "path")
    one = rows.withColumn("r", F.row_number().over(best)).filter("r = 1")
    return one.groupBy("doc").agg(F.max(F.when(F.col("rank") < 4, F.col("text"))).alias("json"), F.max(F.when(F.col("rank") == 4, F.col("text"))).alias("markdown"))
