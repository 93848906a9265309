"""Cross-document resolution: entity filters, similar names by blocking, greedy star clusters, resolved entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from layoutgraph.functions import text as T
from layoutgraph.plans.session import cut

SKIP_TYPES = ["NUMBER", "PERCENT", "QUANTITY", "MONEY"]  # fixed values
#: Noise patterns of the baseline filter and of the strict one, known acronyms, short names kept, stop names.
BASE_NOISE = [r"\\(end|begin|frac|sigma|alpha|beta|sum|left|right)\b", r"^[\d\s\+\-\*\/\=\{\}\(\)\[\]\\.,;:]+$", r"^[A-Z]{1,2}\d+$", r"Add\s*Sk", r"^[а-яa-z]{1,2}$"]
STRICT_NOISE = [
    r"\\[a-zA-Z]+", r"\$[^$]+\$", r"\{[^}]*\}", r"\\begin|\\end", r"^Add\s*Sk", r"山", r"^[\d\s\+\-\*\/\=\{\}\(\)\[\]\\.,;:<>^_|~]+$", r"^\d+\s*[\+\-\*/]", r"sigma|varepsilon|alpha|beta|gamma|delta|lambda|mu\b", r"^[A-Za-z]{1,2}$", r"^[А-Яа-яёЁ]{1,2}$", r"textstyle|mathsf|operatorname", r"^[\s\-–—]+$",
]
ACRONYMS = ["CAPM", "APT", "WACC", "SML", "CML", "OLS", "ANOVA", "GDP", "USA", "EU"]
SHORT_KEPT = ["capm", "apt", "wacc"]
STRICT_STOP = [
    "add skills", "add sk", "add skобмениваются", "add skiкупленная", "adalisa", "adalиса", "ohn", "mehee", "kak", "ang", "takxe", "tako", "tohho", "aoxoahoctn", "noptpeng", "noptpeni", "paccmotpnm", "otcytctbnn", "heto", "netopryembimn",
    "bce", "bcex", "oha", "ann", "ana bcex", "teky山ag", "ueha aktnba", "teky山ag ueha aktnba", "koappnuneht", "koppenauna", "koappnunehtbi", "ctpaxobka", "bblnnahat", "bblnnat", "bennunhbi", "aktib", "aktibob", "cymmaph0", "ctoumoctb", "paktophoie",
    "hababaet", "mokho", "hado", "ecnn", "moaenh", "moaenn", "bbnhat", "\\dots", "\\mathsf", "\\varepsilon", "\\textstyle", "\\operatorname", "naba 10", "naba 12",
]


def _any(c: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | c.rlike("(?iu)" + p)
    return out


def noise_reason(min_confidence: float | None = None) -> Column:
    """Why the baseline filter drops an entity: skip_type, too_short, noise_pattern, too_long, or null if it is kept. The
    first rule that holds counts. ``min_confidence`` is off unless given."""
    name = T.strip(F.coalesce("text", F.lit("")))
    out = F.when(F.coalesce("entity_type", F.lit("")).isin(SKIP_TYPES), "skip_type").when(F.length(name) < 3, "too_short").when(_any(name, BASE_NOISE), "noise_pattern").when(F.length(name) > 100, "too_long")
    if min_confidence is not None:
        out = out.when(F.coalesce("confidence", F.lit(0.0)) < min_confidence, "low_confidence")
    return out


def baseline_entities(entities: DataFrame, min_confidence: float | None = None) -> DataFrame:
    return entities.filter(noise_reason(min_confidence).isNull())


def strict_entities(entities: DataFrame) -> DataFrame:
    """The strict filter: types, stop names, length 3 to 100, noise patterns, mostly-capital strings that are no known
    acronym, and short Latin words."""
    name = T.strip(F.coalesce("text", F.lit("")))
    norm = F.coalesce("normalized", F.lower(name))
    capitals = F.regexp_count(name, F.lit(r"\p{Lu}")) / F.greatest(F.length(name), F.lit(1))
    shouting = (capitals > 0.5) & (F.length(name) > 4) & ~F.upper(name).isin(ACRONYMS)
    return entities.filter(~F.coalesce("entity_type", F.lit("")).isin(SKIP_TYPES) & ~norm.isin(STRICT_STOP) & F.length(name).between(3, 100) & ~_any(name, STRICT_NOISE) & ~shouting & ~(norm.rlike("^[a-z]{3,4}$") & ~norm.isin(SHORT_KEPT)))


def similar_names(names: DataFrame, strict: bool = True) -> DataFrame:
    """(a, b), a < b: names where one contains the other, or whose edit distance is at most 2 and under a fifth of the
    longer. Strict: containment from 4 characters, edits from 6; baseline: 3 and 5. Column: name, distinct and not null.

    Candidates come from blocking that misses none: a name contained in another shares all its grams with it, so they meet
    at the rarest of them; of a name cut in three, one piece survives two edits, moved by two places at most, so names
    meet at the piece, its place and the length of the shorter, and no key holds more than fits all three. The planner takes
    a list of grams or pieces to be as small as the names it is made from, so these joins are never left to a broadcast.
    """
    least = 4 if strict else 3
    edit = 6 if strict else 5
    base = cut(names.select("name").filter(F.col("name").isNotNull()).distinct().withColumn("n", F.length("name")), "names")
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("n") - least + 1), lambda i: F.col("name").substr(i, F.lit(least))))
    held = base.filter(F.col("n") >= least).select("name", "n", F.explode(grams).alias("gram"))
    common = held.groupBy("gram").agg(F.count(F.lit(1)).alias("k"))
    rarest = held.join(common.hint("merge"), "gram").groupBy("name", "n").agg(F.min(F.struct("k", "gram")).alias("g")).select(F.col("name").alias("short"), F.col("n").alias("ns"), F.col("g.gram").alias("gram"))
    inside = rarest.join(held.withColumnsRenamed({"name": "long", "n": "nl"}).hint("merge"), "gram").filter((F.col("short") != F.col("long")) & (F.col("ns") <= F.col("nl")) & F.col("long").contains(F.col("short"))).select(F.least("short", "long").alias("a"), F.greatest("short", "long").alias("b"))
    # distance 1 needs 6 characters in the longer, distance 2 needs 11; pieces are cut from the shorter
    words = base.filter(F.col("n") >= edit)

    def cuts(n: Column) -> Column:
        third = F.floor(n / 3).cast("int")
        return F.array(F.struct(F.lit(1).alias("at"), third.alias("len")), F.struct((third + 1).alias("at"), third.alias("len")), F.struct((third * 2 + 1).alias("at"), (n - third * 2).alias("len")))

    def moved(ns: Column, c: Column) -> Column:
        fits = F.filter(F.sequence(c["at"] - 2, c["at"] + 2), lambda t: (t > 0) & (t + c["len"] - 1 <= F.col("n")))
        return F.transform(fits, lambda t: F.struct(F.col("name").substr(t, c["len"]).alias("piece"), c["at"].alias("at"), ns.alias("ns")))

    pieces = words.select("name", F.col("n").alias("ns"), F.explode(cuts(F.col("n"))).alias("c")).select("name", "ns", F.col("c.at").alias("at"), F.col("name").substr(F.col("c.at"), F.col("c.len")).alias("piece"))
    shorter = F.sequence(F.greatest(F.col("n") - 2, F.lit(edit)), F.col("n"))
    spans = words.select(F.col("name").alias("other"), F.col("n").alias("no"), F.explode(F.array_distinct(F.flatten(F.transform(shorter, lambda ns: F.flatten(F.transform(cuts(ns), lambda c: moved(ns, c))))))).alias("s")).select("other", "no", "s.piece", "s.at", "s.ns")
    met = pieces.join(spans.hint("merge"), ["piece", "at", "ns"]).filter(F.col("name") != F.col("other")).select("name", "other", "no").distinct()
    distance = F.levenshtein("name", "other", 2)
    edits = met.withColumn("d", distance).filter((F.col("d") >= 0) & (F.col("d") / F.col("no") < 0.2)).select(F.least("name", "other").alias("a"), F.greatest("name", "other").alias("b"))
    return inside.unionByName(edits).distinct()


def greedy_clusters(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """(name, canonical): names in order of size (descending), then of first appearance; one that no earlier canonical name
    is similar to is canonical, another belongs to its earliest similar canonical name. Stars, not components.

    ``names``: (name, size, first). Decided in rounds: a name whose earlier neighbours are all decided is decided; the
    rank order makes each round settle at least the first undecided name of every component, so rounds go on until none
    is left; a name given twice could wait for itself, which is an error.
    """
    order = F.struct((-F.col("size")).alias("s"), F.col("first").alias("f"), F.col("name").alias("n"))
    ranked = cut(names.select("name", order.alias("rk")), "ranks")
    x, y = ranked.select(F.col("name").alias("a"), F.col("rk").alias("ra")), ranked.select(F.col("name").alias("b"), F.col("rk").alias("rb"))
    both = pairs.filter("a <> b").join(x.hint("merge"), "a").join(y.hint("merge"), "b")
    earlier = cut(both.select(F.when(F.col("ra") < F.col("rb"), F.col("b")).otherwise(F.col("a")).alias("name"), F.when(F.col("ra") < F.col("rb"), F.col("a")).otherwise(F.col("b")).alias("before"), F.least("ra", "rb").alias("rk")), "earlier")
    state = cut(ranked.join(earlier.select("name").distinct().withColumn("waits", F.lit(True)), "name", "left").select("name", F.when(F.col("waits").isNull(), F.col("name")).alias("canonical"), F.col("waits").isNull().alias("done")), "state")
    last = None
    while undecided := state.filter("not done").count():
        if undecided == last:
            raise ValueError(f"{undecided} names wait for one another")
        last = undecided
        seen = earlier.join(state.select(F.col("name").alias("before"), F.col("done").alias("bdone"), F.col("canonical").alias("bcanon")), "before")
        seen = seen.groupBy("name").agg(F.min(F.when(F.col("bdone") & (F.col("bcanon") == F.col("before")), F.struct("rk", "before"))).alias("star"), F.min(F.when(~F.col("bdone"), F.col("rk"))).alias("open"))
        # settled once no undecided neighbour could come before the earliest canonical one
        ready = F.col("open").isNull() | (F.col("star").isNotNull() & (F.col("star.rk") < F.col("open")))
        state = cut(state.join(seen, "name", "left").select("name", F.when(F.col("done"), F.col("canonical")).when(ready, F.coalesce(F.col("star.before"), F.col("name"))).alias("canonical"), (F.col("done") | F.coalesce(ready, F.lit(True))).alias("done")), "state")
    return state.select("name", "canonical")


def resolved_entities(entities: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row per canonical name: the commonest text and type (first seen wins a tie), highest confidence, frequency (entity
    records, not mentions), sorted chunks and documents, longest context, five aliases, and the united element ids, section
    titles, recognisers and block indices (of those columns that ``entities`` has). Expects first_mention for order."""
    rows = entities.filter(F.col("normalized").isNotNull()).join(clusters.withColumnsRenamed({"name": "normalized"}), "normalized")

    def modal(column: str) -> DataFrame:
        counts = rows.groupBy("canonical", column).agg(F.count(F.lit(1)).alias("k"), F.min("first_mention").alias("f"))
        return counts.groupBy("canonical").agg(F.max_by(column, F.struct("k", -F.col("f"), column)).alias(f"best_{column}"))

    longest = F.max_by("context", F.struct(F.length("context"), -F.col("first_mention")))
    main = rows.groupBy("canonical").agg(
        F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("frequency"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("chunk_ids")))).alias("chunk_ids"), F.array_sort(F.collect_set("source_doc")).alias("source_docs"), longest.alias("context"),
        F.array_sort(F.collect_set("text")).alias("texts"), F.array_distinct(F.flatten(F.collect_set("source_element_ids"))).alias("source_element_ids"), F.array_distinct(F.flatten(F.collect_set("related_element_ids"))).alias("related_element_ids"),
        F.array_sort(F.collect_set(F.when(F.col("section_title") != "", F.col("section_title")) if "section_title" in entities.columns else F.lit(None).cast("string"))).alias("section_titles"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("engines" if "engines" in entities.columns else F.lit(None).cast("array<string>"))))).alias("engines"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("block_indices" if "block_indices" in entities.columns else F.lit(None).cast("array<int>"))))).alias("block_indices"),
    )
    out = main.join(modal("text"), "canonical").join(modal("entity_type"), "canonical", "left")
    return out.select(F.col("canonical").alias("normalized"), F.col("best_text").alias("text"), F.col("best_entity_type").alias("entity_type"), "confidence", "frequency", "chunk_ids", "source_docs", F.substring("context", 1, 300).alias("context"), F.slice(F.array_except("texts", F.array("best_text")), 1, 5).alias("aliases"), "source_element_ids", "related_element_ids", "section_titles", "engines", "block_indices")


def by_frequency(resolved: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent resolved entities, in order; equal frequencies by name."""
    return resolved.orderBy(F.desc("frequency"), "normalized").limit(k)


def related_refs(resolved: DataFrame, elements: DataFrame, element_type: str | None = None) -> DataFrame:
    """(normalized, refs): labels of the elements related to each resolved entity, of one type if given."""
    label = F.coalesce(*[F.when(T.strip(F.col(c)) != "", F.col(c)) for c in ("ref_label", "caption", "text")], F.col("element_id"))
    chosen = elements if element_type is None else elements.filter(F.col("element_type") == element_type)
    at = resolved.select("normalized", F.explode("related_element_ids").alias("element_id"))
    return at.join(chosen.select("element_id", label.alias("label")).hint("merge"), "element_id").groupBy("normalized").agg(F.array_sort(F.collect_set("label")).alias("refs"))
