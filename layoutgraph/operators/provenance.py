"""Which blocks and elements a chunk or mention comes from. Every join carries the document's key, so range conditions
stay residual filters of hash joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layoutgraph.functions import text as T

STRUCTURED = ["figure", "caption", "table", "formula"]  # fixed values
NEAR_BLOCKS = 1


def element_block(elements: DataFrame) -> DataFrame:
    return elements.withColumn("at", F.coalesce("source_block_index", "block_index").cast("int"))


def source_blocks(chunks: DataFrame, blocks: DataFrame) -> DataFrame:
    """(chunk_id, ord, block_id, preview): the blocks of a chunk's block_indices, in that order."""
    at = chunks.select("chunk_id", "source_hash", F.posexplode(F.array_distinct("block_indices")).alias("ord", "block_index"))
    return at.join(blocks.select("source_hash", "block_index", "block_id", "content"), ["source_hash", "block_index"]).select("chunk_id", "ord", "block_id", F.substring(T.strip(F.col("content")), 1, 180).alias("preview"))


def source_elements(chunks: DataFrame, elements: DataFrame) -> DataFrame:
    """(chunk_id, element_id): elements made from a block of the chunk."""
    at = chunks.select("chunk_id", "source_hash", F.explode(F.array_distinct("block_indices")).alias("at"))
    return at.join(element_block(elements).select("source_hash", "at", "element_id"), ["source_hash", "at"]).select("chunk_id", "element_id").distinct()


def related_elements(chunks: DataFrame, elements: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """(chunk_id, element_id): structured sources and what they link to; structured elements of the chunk's pages which
    share its section or stand within one block of it, and what they link to; structured elements linked to a source."""
    sources = sources if sources is not None else source_elements(chunks, elements)
    el = element_block(elements).select("source_hash", "element_id", "element_type", "page_number", "at", "section_title", F.col("metadata.linked_element_id").alias("linked"), F.col("metadata.caption_element_id").alias("captioned"))
    structured = el.filter(F.col("element_type").isin(STRUCTURED))
    hops = lambda df: df.select("chunk_id", F.explode(F.array("linked", "captioned")).alias("element_id")).filter("element_id is not null")
    src = sources.join(el, "element_id")
    own = src.filter(F.col("element_type").isin(STRUCTURED)).select("chunk_id", "element_id")
    c = chunks.select(
        "chunk_id", "source_hash", "page_start", "page_end", F.array_compact(F.array_append(F.coalesce("section_hierarchy", F.array().cast("array<string>")), F.col("section_title"))).alias("sections"), F.array_min("block_indices").alias("lo"), F.array_max("block_indices").alias("hi"),
    )
    c = c.filter("page_start <= page_end").withColumn("page_number", F.explode(F.sequence("page_start", "page_end")))
    close = F.coalesce(F.array_contains("sections", F.col("section_title")), F.lit(False)) | F.coalesce(F.col("at").between(F.col("lo") - NEAR_BLOCKS, F.col("hi") + NEAR_BLOCKS), F.lit(False))
    around = c.join(structured, ["source_hash", "page_number"]).filter(close)
    reverse = sources.select("chunk_id", F.col("element_id").alias("linked")).join(structured.select("element_id", "linked"), "linked").select("chunk_id", "element_id")
    every = own.unionByName(hops(src)).unionByName(around.select("chunk_id", "element_id")).unionByName(hops(around)).unionByName(reverse).distinct()
    return every.join(el.select("element_id"), "element_id", "left_semi").select("chunk_id", "element_id")


def blocks_in_text(chunks: DataFrame, blocks: DataFrame, probe: int = 160) -> DataFrame:
    """(chunk_id, block_index): blocks whose text, or its first ``probe`` characters, stands in the chunk's text."""
    b = blocks.select("source_hash", "block_index", T.strip(F.coalesce("content", F.lit(""))).alias("block_text")).filter("block_text <> ''")
    met = chunks.select("chunk_id", "source_hash", "text").join(b, "source_hash")
    return met.filter(F.col("text").contains(F.substring("block_text", 1, probe))).select("chunk_id", "block_index").distinct()


def mention_provenance(mentions: DataFrame, chunks: DataFrame) -> DataFrame:
    """Mentions (chunk_id, ...) with the pages, section, blocks and element ids of their chunk."""
    inherited = chunks.select("chunk_id", "page_start", "page_end", "section_title", "block_indices", "source_element_ids", "related_element_ids")
    return mentions.join(inherited, "chunk_id", "left")


def summaries(elements: DataFrame) -> DataFrame:
    """Short forms of elements: previews of text and table, optional fields as they are."""
    return elements.select("element_id", "element_type", "page_number", "ref_label", "caption", F.substring(F.coalesce("text", F.lit("")), 1, 180).alias("preview"), F.substring("table_html", 1, 240).alias("table_preview"), "image_path", "formula", "section_title")
