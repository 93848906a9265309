"""Column functions on text: tokens, captions, wrappers, titles, sentences, entity names. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Caption words, the upper-case letters a sentence may start with, characters trimmed off names.
CAPTION = r"^\s*(рисунок|рис\.?|figure|fig\.?|таблица|табл\.?|table)\s*[\-–—№#]*\s*(\d+(?:[.\-–]\d+)?|[ivxlcdm]+)?"
SENTENCE_BREAK = r"(?<=[.!?])\s+(?=[A-ZА-ЯЁ\d\"«])"
EDGE_SIGNS = ".,;:!?()[]{}\"'«»“”"
CYRILLIC = "[а-яА-ЯёЁ]"

_WRAPPED = r"(?s)^(\*\*|__|\*|_)(.*)\1$"


def strip(c: Column) -> Column:
    """Without white space at both ends (trim() takes blanks only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def token_estimate(c: Column) -> Column:
    """Words times 1.5 where any Cyrillic letter stands, else 1.3; at least 1. Null text counts as empty."""
    text = F.coalesce(c, F.lit(""))
    words = F.size(F.regexp_extract_all(text, F.lit(r"(\S+)"), F.lit(1)))
    factor = F.when(text.rlike(CYRILLIC), F.lit(1.5)).otherwise(F.lit(1.3))
    return F.greatest(F.lit(1), (words * factor).cast("int"))


def strip_wrappers(c: Column) -> Column:
    """Without a leading heading sign and one pair of emphasis marks around the whole."""
    text = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"^\s{0,3}#{1,6}\s*", "")
    return strip(F.regexp_replace(text, _WRAPPED, "$2"))  # the first mark that stands at both ends


def is_caption(c: Column) -> Column:
    """Whether the text starts like a caption; the number is optional."""
    return strip_wrappers(c).rlike("(?iu)" + CAPTION)


def ref_label(c: Column) -> Column:
    """Reference of a caption: kind (рис., figure, табл., table) and number; '' if it is none."""
    text = F.lower(strip_wrappers(c))
    kind = F.regexp_replace(F.regexp_extract(text, CAPTION, 1), r"\.$", "")
    number = F.coalesce(F.regexp_extract(text, CAPTION, 2), F.lit(""))
    norm = F.when(kind.isin("рис", "рисунок"), "рис.").when(kind.isin("fig", "figure"), "figure").when(kind.isin("табл", "таблица"), "табл.").otherwise("table")
    return F.when(kind == "", F.lit("")).otherwise(strip(F.concat(norm, F.lit(" "), number)))


def sentences(c: Column) -> Column:
    """Array of sentences: cut at white space between a final sign and a capital, digit or opening quote."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), SENTENCE_BREAK), strip), lambda s: s != "")


def is_upper(c: Column) -> Column:
    return (F.upper(c) == c) & (F.lower(c) != c)


def title_level(content: Column, block_type: Column, text_level: Column) -> Column:
    """0 for body text; else the number of heading signs (at most 4), the given level, or 2."""
    text = strip(F.coalesce(content, F.lit("")))
    signs = F.length(text) - F.length(F.regexp_replace(text, "^#+", ""))
    title = (F.coalesce(block_type, F.lit("")) == "title") | ((F.length(text) < 100) & is_upper(text))
    return F.when(text.startswith("#"), F.least(signs, F.lit(4))).when(F.coalesce(text_level, F.lit(0)) != 0, text_level.cast("int")).when(title, F.lit(2)).otherwise(F.lit(0)).cast("int")


def clean_title(c: Column) -> Column:
    """Heading text without heading signs and one pair of emphasis marks."""
    text = strip(F.regexp_replace(strip(F.coalesce(c, F.lit(""))), "^#+", ""))
    return strip(F.regexp_replace(F.regexp_replace(text, r"^(?:\*{1,3}|_{1,3})$", ""), _WRAPPED, "$2"))


def normalize_entity(c: Column) -> Column:
    """White space collapsed, edge punctuation off, lower case. A blank before stripped punctuation stays."""
    text = strip(F.regexp_replace(c, r"\s+", " "))
    edge = r"[.,;:!?()\[\]{}\"'«»“”]+"
    return F.lower(F.regexp_replace(text, f"^{edge}|{edge}$", ""))


def dominant_language(c: Column) -> Column:
    """ru where Cyrillic letters outnumber Latin ones, else en."""
    return F.when(F.regexp_count(c, F.lit("[а-яА-ЯёЁ]")) > F.regexp_count(c, F.lit("[a-zA-Z]")), "ru").otherwise("en")


def context(text: Column, name: Column, window: int = 150) -> Column:
    """``window`` characters on both sides of the first occurrence (exact, else ignoring case), with dots where cut;
    '' if there is none."""
    exact = F.instr(text, name)
    pos = F.when(exact > 0, exact).otherwise(F.instr(F.lower(text), F.lower(name)))
    start = F.greatest(F.lit(0), pos - 1 - window)
    end = F.least(F.length(text), pos - 1 + F.length(name) + window)
    piece = strip(text.substr(start + 1, end - start))
    dotted = F.concat(F.when(start > 0, "...").otherwise(""), piece, F.when(end < F.length(text), "...").otherwise(""))
    return F.when(F.coalesce(pos, F.lit(0)) == 0, F.lit("")).otherwise(dotted)


def segments(c: Column, size: int, step: int) -> Column:
    """Character windows with overlap; one window if the text isn't longer than ``size``."""
    starts = F.when(F.length(c) <= size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.length(c) - 1, F.lit(step)))
    return F.transform(starts, lambda i: c.substr(i + 1, F.lit(size)))


def split_ids(c: Column) -> Column:
    """Array of the non-blank parts of a comma-joined list."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip), lambda s: s != "")
