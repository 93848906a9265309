"""Mentions to entities: recognisers, noise filters, deduplication, context and counts."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from layoutgraph.functions import text as T

#: Names that are no entities.
STOP_NAMES = ["р", "г", "ed", "vol", "no", "pp", "chapter", "глава", "стр", "рис", "табл", "см", "т.е", "и т.д", "etc", "e.g", "i.e", "the", "a", "an", "и", "в", "на", "по", "из", "к", "с"]
#: Labels of recogniser models and the types they stand for.
MODEL_TYPES = {
    "PER": "PERSON", "PERSON": "PERSON", "ORG": "ORG", "LOC": "LOCATION", "GPE": "LOCATION", "DATE": "DATE", "MONEY": "MONEY", "PRODUCT": "PRODUCT", "EVENT": "EVENT", "WORK_OF_ART": "WORK", "FAC": "FACILITY", "NORP": "GROUP", "CARDINAL": "NUMBER", "ORDINAL": "NUMBER", "PERCENT": "PERCENT",
}
LABEL_TYPES = {
    "person": "PERSON", "organization": "ORG", "financial model": "CONCEPT", "financial instrument": "CONCEPT", "economic concept": "CONCEPT", "formula": "FORMULA", "date": "DATE", "location": "LOCATION", "publication": "WORK", "university": "ORG",
}

FAILED = "FAILED"
MENTION_SCHEMA = "chunk_id string, ord int, text string, entity_type string, confidence double, start_char int, end_char int, engine string"


class Recogniser(Protocol):
    """Anything with extract(text, chunk_id) -> iterable of (text, entity_type, confidence, start_char, end_char)."""

    def extract(self, text: str, chunk_id: str): ...


def recognise(chunks: DataFrame, factory: Callable[[], Recogniser], engine: str, types: dict[str, str] | None = None, upper_unknown: bool = False) -> DataFrame:
    """Mentions of every chunk by a recogniser that is made once per Python worker. A chunk on which it fails gives one row
    of type FAILED with the error as its text (see failures); the others go on. ``types`` maps a model's labels
    (MODEL_TYPES, LABEL_TYPES; see map_labels)."""

    def run(batches: Iterator[pd.DataFrame]):
        recogniser = factory()
        for pdf in batches:
            out = []
            for chunk, text in zip(pdf.chunk_id, pdf.text):
                try:
                    hits = list(recogniser.extract(text or "", chunk))
                except Exception as error:
                    out.append((chunk, -1, f"{type(error).__name__}: {error}", FAILED, None, None, None, engine))
                    continue
                out += [(chunk, n, *hit, engine) for n, hit in enumerate(hits)]
            yield pd.DataFrame(out, columns=["chunk_id", "ord", "text", "entity_type", "confidence", "start_char", "end_char", "engine"])

    found = chunks.select("chunk_id", "text").mapInPandas(run, MENTION_SCHEMA)
    if types is None:
        return found
    label = F.col("entity_type")
    return found.withColumn("entity_type", F.when(label == FAILED, label).otherwise(map_labels(label, types, upper_unknown)))


def failures(found: DataFrame) -> DataFrame:
    """(chunk_id, engine, error) of the chunks on which a recogniser failed."""
    return found.filter(F.col("entity_type") == FAILED).select("chunk_id", "engine", F.col("text").alias("error"))


def candidate_filter(found: DataFrame, chunks: DataFrame | None = None, least_chunk: int = 20, least: int = 2, most: int = 100, threshold: float = 0.4) -> DataFrame:
    """Candidates worth keeping: of chunks of at least ``least_chunk`` characters (where ``chunks`` is given), names of
    ``least`` to ``most`` characters, confidence at or above ``threshold`` (an unknown one passes), no failures."""
    kept = found.filter((F.col("entity_type") != FAILED) & F.length(T.strip(F.col("text"))).between(least, most) & (F.coalesce("confidence", F.lit(1.0)) >= threshold))
    if chunks is not None:
        kept = kept.join(chunks.filter(F.length(T.strip(F.col("text"))) >= least_chunk).select("chunk_id"), "chunk_id", "left_semi")
    return kept


def unite(*found: DataFrame) -> DataFrame:
    """Mentions of several recognisers together, numbered anew in each chunk: by recogniser as given, then as found."""
    out = None
    for k, df in enumerate(found):
        part = df.withColumn("_from", F.lit(k))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    order = Window.partitionBy("chunk_id").orderBy("_from", "ord")
    return out.withColumn("ord", (F.row_number().over(order) - 1).cast("int")).drop("_from")


def rule_mentions(chunks: DataFrame) -> DataFrame:
    """Mentions by rule, in the JVM: capitalised words of four Latin letters or more, edge punctuation off. The type
    follows from the first letter and the length, so SQL can state the same."""
    words = chunks.select("chunk_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"[ \n\t\r]+")).alias("ord", "w"))
    name = F.regexp_replace("w", r"^[.,;:!?()\[\]{}\"'«»“”]+|[.,;:!?()\[\]{}\"'«»“”]+$", "")
    kind = F.when(F.substring("text", 1, 1) < "H", "PERSON").when(F.length("text") >= 9, "ORG").otherwise("CONCEPT")
    return words.select("chunk_id", "ord", name.alias("text")).filter(F.col("text").rlike("^[A-Z][a-z]{3,}$")).withColumn("entity_type", kind)


def map_labels(label: Column, types: dict[str, str], upper_unknown: bool = False) -> Column:
    """Type of a model's label; an unknown label passes, in capitals if asked."""
    mapping = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return F.coalesce(F.element_at(mapping, label), F.upper(label) if upper_unknown else label)


def parse_answer(answer: str | None) -> list[tuple[str, str, float]]:
    """(text, type, confidence) out of a language model's answer: fences off, JSON, else the first bracketed span; what is
    no object with a text is skipped; type UNKNOWN and confidence 0.9 unless given."""
    body = re.sub(r"^\s*```\w*\s*|\s*```\s*$", "", answer or "")
    data = None
    for piece in [body, *re.findall(r"\[.*\]", body, re.S)[:1]]:
        try:
            data = json.loads(piece)
            break
        except ValueError:
            continue
    out = []
    for item in data if isinstance(data, list) else []:
        if isinstance(item, dict) and str(item.get("text") or "").strip():
            out.append((str(item["text"]).strip(), str(item.get("type") or item.get("entity_type") or "UNKNOWN"), float(item.get("confidence", 0.9) or 0.9)))
    return out


def drop_noise(mentions: DataFrame, least: int = 2) -> DataFrame:
    """Without names that are too short or long, mere numbers (unless of a numeric type), and stop names."""
    name = T.strip(F.coalesce("text", F.lit("")))
    number = name.rlike(r"^[\d.,\s]+$") & ~F.coalesce("entity_type", F.lit("")).isin("DATE", "NUMBER", "MONEY")
    return mentions.filter((F.length(name) >= least) & ~number & ~F.coalesce("normalized", F.lit("")).isin(STOP_NAMES) & (F.length(name) <= 200))


def deduplicate(mentions: DataFrame) -> DataFrame:
    """Entities by (source_doc, normalized, entity_type): the most confident mention's text and context, chunk ids in the
    order of mentions, page range, united element ids. NaN confidence counts as none; mention_id gives the order.

    Columns used: mention_id, text, normalized, entity_type, confidence, chunk_id, source_doc, context, page_start,
    page_end, section_title, source_element_ids, related_element_ids; engine and block_indices where they are there. Groups
    are kept apart by null keys too.
    """
    conf = F.when(F.isnan("confidence"), None).otherwise(F.col("confidence"))
    order = F.struct(F.coalesce(conf, F.lit(-1.0)), -F.col("mention_id"))
    ids = lambda c: F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("mention_id", F.coalesce(c, F.array().cast("array<string>")).alias("x")))), lambda s: s["x"])))
    more = []
    if "engine" in mentions.columns:
        more.append(F.array_sort(F.collect_set("engine")).alias("engines"))
    if "block_indices" in mentions.columns:
        more.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set("block_indices")))).alias("block_indices"))
    return mentions.withColumn("_chunks", T.split_ids(F.col("chunk_id"))).groupBy("source_doc", "normalized", "entity_type").agg(
        F.max_by("text", order).alias("text"), F.max(conf).alias("confidence"), F.max_by("context", order).alias("context"), F.max_by("section_title", order).alias("section_title"), ids(F.col("_chunks")).alias("chunk_ids"),
        F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), ids(F.col("source_element_ids")).alias("source_element_ids"), ids(F.col("related_element_ids")).alias("related_element_ids"), F.count(F.lit(1)).alias("mentions"), F.min("mention_id").alias("first_mention"), *more,
    )


def sentence_context(mentions: DataFrame, chunks: DataFrame) -> DataFrame:
    """(mention_id, sentence): the sentence of the first named chunk in which a mention's name first stands."""
    first = mentions.select("mention_id", "text", F.try_element_at(T.split_ids(F.col("chunk_id")), F.lit(1)).alias("chunk_id")).filter("chunk_id is not null")
    met = first.join(chunks.select("chunk_id", T.sentences(F.col("text")).alias("ss")), "chunk_id")
    return met.select("mention_id", F.coalesce(F.try_element_at(F.filter("ss", lambda s: s.contains(F.col("text"))), F.lit(1)), F.lit("")).alias("sentence"))


def type_counts(entities: DataFrame) -> DataFrame:
    return entities.groupBy(F.coalesce("entity_type", F.lit("UNKNOWN")).alias("entity_type")).agg(F.count(F.lit(1)).alias("n"))


def ranked(entities: DataFrame) -> DataFrame:
    """Entities in order of confidence (descending), type and name, with their place in their document."""
    order = Window.partitionBy("source_doc").orderBy(F.col("confidence").desc_nulls_last(), F.col("entity_type").asc_nulls_last(), F.col("normalized").asc_nulls_last())
    return entities.withColumn("place", F.row_number().over(order))
