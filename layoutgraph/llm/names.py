"""Problem 5: spellings of people's and organisations' names that mean the same one.

A name is brought to Latin letters (romanisation, look-alike letters, accents, words broken at a hyphen) and cut into
words and initials. Each name has one telling word, a surname or an organisation's own word; the other words are its
given name or what kind of organisation it is. Telling words within one edit of each other are found by a
symmetric-delete index: words that share a form with one letter deleted meet, and every such meeting place holds at
most (length + 1) * alphabet words, so no group grows with the data. The other words are aligned by optimal
assignment, permitting initials, abbreviations, nicknames and slips. Common words and kinds of organisation are tables that
are joined, so any number of them counts. Names with a full given name form classes (connected components of the index);
names with only initials, or a surname alone, join the class that fits them best.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, functions as F, Window

from layoutgraph.operators.components import components
from layoutgraph.operators.resolve import greedy_clusters
from layoutgraph.plans.session import cut

FAR = 1e6  # cost of two words that don't match

#: Romanisation, look-alikes by script, titles and legal forms, given names with their short and Russian
#: forms, words of organisations with their Russian forms.
ROMAN = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґ", "a b v g d e e zh z i i k l m n o p r s t u f kh ts ch sh shch - y - e yu ya i yi ye g".split(" ")))
TO_LATIN = dict(zip("аеосрхуіцвнкмтʌı", "aeocpxyiubhkmtli"))
TO_CYRILLIC = dict(zip("aeocpxyhnkmtbiuʌ", "аеосрхуникмтвіцл"))
SIGNS_LATIN = dict(zip("015964!|378", "olsgbail" + "zto"))
SIGNS_CYRILLIC = dict(zip("04369!|", "очзбділ"))
TITLES = set("prof professor dr doctor mr mrs ms miss sir gov governor president akad akademik doc dots gn gzha herr frau dipl ing hon rev capt lt col jr sr phd md mme mlle don dona senor senora sr sra".split())
LEGAL = set("inc ltd llc llp plc corp co company limited incorporated gmbh ag sa srl spa nv bv oy ab pty ooo ao zao pao oao tov the".split())
GIVEN = """
alexander aleksandr alexandre alejandro alex sasha sanya; robert rob bob bobby bert; william uilyam bill billy will uill willy; elizabeth elizabet liz lizzie beth betty liza; henrietta genrietta hetty khetti getti;
charlotte sharlotta sharlotte lottie lotti; tatiana tatyana tanya tania; olga olya olia; nikolai nikolay nicolas nicholas kolya kolia nick; ekaterina katerina catherine katherine katya katia kate; dmitri dmitrii dmitry dmitriy dima mitya;
vladislav vlad vladik; zacharias zakhariya zachary zack zak zach; frederick frederik frederic fred freddie; gregory gregori grigori greg; jonathan dzhonatan jon john dzhon jonny; samuel samuil sam sem sammy; margaret margarita maggie meggi meg peggy;
ludmila lyudmila lucy lyuda lyusi mila luda; ivan vanya vania; michael mikhail misha mike; maria mariya mary masha; anna anya ann; andrew andrei andrey andy; peter petr pyotr pete; george georgi georgy yuri; james jim jimmy; thomas tom tommy; joseph iosif joe;
richard dick rick; edward eduard ed eddie ted; alexandra aleksandra; sergei sergey seryozha; vladimir volodya vova; natalia natalya natasha; irina ira; svetlana sveta; paul pavel pasha; daniel danila dan danny; david dave; stephen stepan steven steve
"""
ORG_WORDS = """
energy energo; holding kholding; insurance strakhovaya strakhovoi; group gruppa; capital kapital; management menedzhment; statistical statisticheskoe statisticheskii; bureau byuro; research issledovatelskii issledovatelskaya;
institute institut; commercial kommercheskii; bank; university universitet; company kompaniya; agency agentstvo; fund fond; central tsentralnyi; national natsionalnyi; investment investitsionnyi; trust trast; partners partnery; international mezhdunarodnyi
"""
CANON_GIVEN = {form: row.split()[0] for row in GIVEN.replace("\n", " ").split(";") if row.strip() for form in row.split()}
CANON_ORG = {form: row.split()[0] for row in ORG_WORDS.replace("\n", " ").split(";") if row.strip() for form in row.split()}
#: First letters of the Russian forms, romanised, where they differ from the canonical name's.
RUSSIAN_INITIAL = {"william": "u", "henrietta": "g", "charlotte": "sh", "jonathan": "d", "elizabeth": "e", "james": "d", "joseph": "i", "george": "g"}


def clean_word(word: str) -> str:
    """A word in one script without look-alikes, accents or signs, romanised."""
    cyr = sum("Ѐ" <= ch < "԰" for ch in word)
    latin = sum(ch.isalpha() and ord(ch) < 0x250 for ch in word)
    word = word.replace("lı", "h")
    if cyr > latin:
        word = "".join(TO_CYRILLIC.get(ch, SIGNS_CYRILLIC.get(ch, ch)) for ch in word)
    else:
        word = "".join(TO_LATIN.get(ch, SIGNS_LATIN.get(ch, ch)) for ch in word)
    word = "".join(ROMAN.get(ch, ch) for ch in word)
    return "".join(ch for ch in unicodedata.normalize("NFKD", word) if ch.isalpha() and ord(ch) < 0x250)


_BROKEN = re.compile(r"(?<=\w)[-‐‑¬­]\s+(?=\w)|­|¬")
_PIECE = re.compile(r"[^\s.,;:«»\"“”„()\[\]‐‑-]+|[,.]")


def split_name(value: str) -> tuple[list[str], list[str], bool]:
    """(words, initials, whether a comma follows the first word). Initials keep 'c:' in front where they are Cyrillic."""
    low = unicodedata.normalize("NFC", value.lower())
    low = _BROKEN.sub("", low)
    words, initials, comma = [], [], False
    for piece in _PIECE.findall(low):
        if piece == ",":
            comma = comma or len(words) == 1
        elif piece != ".":
            if sum(ch.isalpha() for ch in piece) == 1 and len(piece) == 1:
                initials.append(("c:" if "Ѐ" <= piece < "԰" else "") + clean_word(piece))
            else:
                w = clean_word(piece)
                if len(w) == 1:
                    initials.append(w)
                elif w:
                    words.append(w)
    return words, initials, comma


def near(a: str, b: str) -> bool:
    """At most one insertion, deletion, substitution or exchange of neighbours apart."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > 1:
        return False
    k = 0
    while k < min(la, lb) and a[k] == b[k]:
        k += 1
    if la == lb:
        return a[k + 1 :] == b[k + 1 :] or (a[k : k + 2] == b[k : k + 2][::-1] and a[k + 2 :] == b[k + 2 :])
    return a[k + 1 :] == b[k:] if la > lb else a[k:] == b[k + 1 :]


#: Letter groups that are one letter in the other script, or read as one.
GROUPS = [("shch", "ŝ"), ("sh", "š"), ("ch", "č"), ("zh", "ž"), ("kh", "ĥ"), ("ts", "ċ"), ("ya", "ă"), ("yu", "ŭ")]


def readings(word: str) -> tuple[str, str, str]:
    """A word as it stands, with the groups of other scripts as single letters, and with rn read as m. One slip in
    either script, or one misreading, is one edit in one of these."""
    short = word
    for group, letter in GROUPS:
        short = short.replace(group, letter)
    return word, short, word.replace("rn", "m")


def same_but_slip(a: str, b: str) -> bool:
    return any(near(p, q) for p, q in zip(readings(a), readings(b)))


def deletes(word: str) -> set[str]:
    """The word and its forms with one letter deleted. Two words within one edit share one of these, but for an
    exchange of neighbours, which shares the form without either letter too."""
    return {word, *(word[:k] + word[k + 1 :] for k in range(len(word)))}


def word_readings(words: DataFrame, common: DataFrame) -> DataFrame:
    """(kind, w, canon, weight) of distinct ``words`` (kind, w): canonical form, and how many partners the word has by
    ``common`` (kind, w, k), found also through one slip; 0 for a word that is not common; the fixed lists outweigh counts.

    Of the common words one slip away, in the order of the first form with one letter deleted that they share, one is taken
    that outweighs the best so far four times.
    """
    lists = [(kind, w, canon) for kind, known in (("PERSON", CANON_GIVEN), ("ORG", CANON_ORG)) for w, canon in known.items()]
    fixed = words.sparkSession.createDataFrame(lists, "kind string, w string, canon string")
    count = F.coalesce("k", F.lit(0)).cast("long")
    asked = cut(words.join(common, ["kind", "w"], "left").join(F.broadcast(fixed), ["kind", "w"], "left").select("kind", "w", "canon", count.alias("own")), "asked")

    @F.pandas_udf("array<string>")
    def shorter(s: pd.Series) -> pd.Series:
        return s.map(lambda w: sorted(deletes(w)))

    @F.pandas_udf("array<string>")
    def shorter_or_misread(s: pd.Series) -> pd.Series:
        return s.map(lambda w: sorted(deletes(w) | {w.replace("rn", "m")}))

    @F.pandas_udf("boolean")
    def slipped(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([near(p, q) or p.replace("rn", "m") == q for p, q in zip(a, b)], dtype=bool)

    listed = fixed.join(common, ["kind", "w"], "left").select("kind", "w", "canon", (count + 500_000).alias("weight"))
    counted = common.filter("k >= 6").join(F.broadcast(fixed), ["kind", "w"], "left_anti").select("kind", "w", F.col("w").alias("canon"), F.col("k").cast("long").alias("weight"))
    index = listed.unionByName(counted).filter(F.length("w") >= 4).select("kind", F.col("w").alias("to"), "canon", "weight", F.explode(shorter("w")).alias("form"))
    open_words = asked.filter(F.col("canon").isNull() & (F.length("w") >= 4)).select("kind", "w", "own", F.explode(shorter_or_misread("w")).alias("form"))
    # the forms are many times the words that the planner sees, so they aren't broadcast
    met = open_words.join(index.hint("merge"), ["kind", "form"]).filter((F.col("w") != F.col("to")) & (F.col("weight") > F.col("own") * 4))
    met = met.groupBy("kind", "w", "own", "to", "canon", "weight").agg(F.min("form").alias("form")).filter(slipped("w", "to"))
    found = met.groupBy("kind", "w", "own").agg(F.array_sort(F.collect_list(F.struct("form", "to", "canon", "weight"))).alias("all"))
    start = F.struct(F.lit("").alias("canon"), F.col("own").alias("weight"))
    best = F.aggregate("all", start, lambda b, x: F.when(x["weight"] > b["weight"] * 4, F.struct(x["canon"].alias("canon"), x["weight"].alias("weight"))).otherwise(b))
    best = found.select("kind", "w", best.alias("best"))
    canon = F.coalesce("canon", "best.canon", "w")
    weight = F.when(F.col("canon").isNotNull(), F.col("own") + 1_000_000).otherwise(F.coalesce("best.weight", "own"))
    return asked.join(best, ["kind", "w"], "left").select("kind", "w", canon.alias("canon"), weight.alias("weight"))


def abbreviates(short: str, full: str) -> bool:
    """Whether ``short`` may stand for ``full``: an initial, a beginning, or letters of it in order from its first."""
    if not short or short[0] != full[0] or len(short) >= len(full):
        return False
    at = 0
    for ch in short:
        at = full.find(ch, at) + 1
        if not at:
            return False
    return True


def cost(a: str, b: str) -> float:
    """What it costs to read the word ``a`` as ``b``; FAR if they don't match."""
    if a == b:
        return 0.0
    if len(a) > 3 and near(a, b):
        return 0.5
    return 1.0 if abbreviates(a, b) else FAR


def align(words: list[str], phrase: list[str]) -> float:
    """Cost of the best assignment of ``words`` to the words of ``phrase`` (0 = the same words); inf without one."""
    n = len(words)
    if n != len(phrase):
        return float("inf")
    costs = [[cost(a, b) for b in phrase] for a in words]
    if any(min(row) >= FAR for row in costs):
        return float("inf")
    total = assign([[c + 0.01 * (i != j) for j, c in enumerate(row)] for i, row in enumerate(costs)])
    return total if total < FAR else float("inf")  # the sum tells whether words had to be taken that don't match


def assign(costs: list[list[float]]) -> float:
    """The least sum of a square table with one entry a row and column: shortest augmenting paths with potentials."""
    n = len(costs)
    of_row, of_col, owner = [0.0] * n, [0.0] * (n + 1), [-1] * (n + 1)  # column n is where a path starts
    for row in range(n):
        owner[n], at = row, n
        best, came, done = [float("inf")] * n, [n] * n, [False] * (n + 1)
        while owner[at] >= 0:
            done[at], r = True, owner[at]
            step, nearest = float("inf"), -1
            for c in range(n):
                if not done[c]:
                    reduced = costs[r][c] - of_row[r] - of_col[c]
                    if reduced < best[c]:
                        best[c], came[c] = reduced, at
                    if best[c] < step:
                        step, nearest = best[c], c
            for c in range(n + 1):
                if done[c]:
                    of_row[owner[c]] += step
                    of_col[c] -= step
                elif c < n:
                    best[c] -= step
            at = nearest
        while at != n:
            owner[at] = owner[came[at]]
            at = came[at]
    return sum(costs[owner[c]][c] for c in range(n))


def asked_keys(word: str) -> list[str]:
    """A word that ``cost`` matches with another shares one of these with ``target_keys`` of the other: a form with one
    letter deleted, or its first, second and last letter, which stand in what it abbreviates in this order."""
    short = word if len(word) < 3 else word[:2] + word[-1]
    return ["=" + d for d in sorted(deletes(word) if len(word) > 3 else {word})] + ["<" + short]


def target_keys(word: str) -> list[str]:
    later: set[str] = set()
    pairs: set[str] = set()
    for ch in word[1:]:
        pairs |= {x + ch for x in later}
        later.add(ch)
    return ["=" + d for d in sorted(deletes(word))] + ["<" + word[:1] + x for x in ["", *sorted(later), *sorted(pairs)]]


def alignments(asked: DataFrame, phrases: DataFrame) -> DataFrame:
    """(p, q, cost): all phrases ``q`` that a group of words ``p`` can be aligned with, and the cost. Both columns are of
    distinct strings, words with one blank between.

    Each word of ``p`` matches a word of ``q``, so it is enough to look where the word of ``p`` does that fewest phrases
    hold a match of; words that match are found through ``asked_keys`` and ``target_keys``.
    """

    def words_of(df: DataFrame, column: str, word: str) -> DataFrame:
        split = F.split(column, " ")
        return df.select(column, F.size(split).alias("size"), F.explode(F.array_distinct(split)).alias(word))

    @F.pandas_udf("array<string>")
    def keys_a(s: pd.Series) -> pd.Series:
        return s.map(asked_keys)

    @F.pandas_udf("array<string>")
    def keys_b(s: pd.Series) -> pd.Series:
        return s.map(target_keys)

    @F.pandas_udf("boolean")
    def match(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([cost(x, y) < FAR for x, y in zip(a, b)], dtype=bool)

    @F.pandas_udf("double")
    def costs(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([align(x.split(" "), y.split(" ")) for x, y in zip(a, b)], dtype=float)

    of_p, of_q = cut(words_of(asked, "p", "a"), "askedwords"), cut(words_of(phrases, "q", "b"), "phrasewords")
    x = of_p.select("a").distinct().select("a", F.explode(keys_a("a")).alias("key"))
    y = of_q.select("b").distinct().select("b", F.explode(keys_b("b")).alias("key"))
    longer = F.col("key").startswith("=") | (F.length("a") < F.length("b"))
    alike = cut(x.join(y.hint("merge"), "key").filter(longer).select("a", "b").distinct().filter(match("a", "b")), "alike")
    held = of_q.groupBy("size", "b").agg(F.count(F.lit(1)).alias("k"))
    load = alike.join(held, "b").groupBy("size", "a").agg(F.sum("k").alias("k"))
    fewest = of_p.join(load, ["size", "a"], "left").groupBy("p", "size").agg(F.min(F.struct("k", "a")).alias("least"), F.count("k").alias("found"), F.count(F.lit(1)).alias("words"))
    fewest = fewest.filter("found = words").select("p", "size", F.col("least.a").alias("a"))
    met = fewest.join(alike, "a").join(of_q, ["size", "b"]).select("p", "q").distinct()
    return met.withColumn("cost", costs("p", "q")).filter(F.col("cost") < FAR)


def kinds_of_organisation(phrases: DataFrame, aligned: DataFrame) -> DataFrame:
    """(q, count): the ``phrases`` (p, count), most frequent first and then by name, but for those that abbreviate a more
    frequent one of them, which are no kind of their own. ``aligned``: from ``alignments``."""
    x, y = phrases.withColumnRenamed("count", "cp"), phrases.withColumnsRenamed({"p": "q", "count": "cq"})
    before = aligned.join(x, "p").join(y, "q").filter((F.col("cq") > F.col("cp")) | ((F.col("cq") == F.col("cp")) & (F.col("q") < F.col("p"))))
    stars = greedy_clusters(phrases.select(F.col("p").alias("name"), F.col("count").alias("size"), F.lit(0).alias("first")), before.select(F.col("p").alias("a"), F.col("q").alias("b")))
    return phrases.join(stars.filter("name = canonical").select(F.col("name").alias("p")), "p").select(F.col("p").alias("q"), "count")


def read_person(words: list[str], initials: list[str], comma: bool, canonical: list[tuple[str, int]]) -> tuple[str, str, str]:
    """(surname, canonical given name or '', initial of the given name or ''). ``canonical``: each word's form and weight."""
    read = [(w, *r) for w, r in zip(words, canonical) if w not in TITLES] or [(w, *r) for w, r in zip(words, canonical)]
    first = initials[0] if initials else ""
    if not read:
        return "", "", first
    if len(read) == 1:
        return read[0][0], "", first
    if comma:
        at = 1
    else:
        at = max(range(len(read)), key=lambda k: (read[k][2], -k))
    rest = [k for k in range(len(read)) if k != at]
    surname = min(rest, key=lambda k: (read[k][2], -len(read[k][0])))
    given = read[at][1]
    return read[surname][0], given, given[:1]


def read_org(words: list[str], initials: list[str], canonical: list[tuple[str, int]]) -> tuple[str, str, str | None]:
    """(own word, its other words in canonical form, the same if it tells a kind of organisation: all of them are common
    words). ``canonical``: each word's form and weight."""
    named = [(w, *r) for w, r in zip(words, canonical) if w not in LEGAL]
    common = [canon for _, canon, weight in named if weight >= 6]
    phrase = " ".join(common) if common and len(common) == len(named) - 1 else None
    read = named or [(w, *r) for w, r in zip(words, canonical)]
    letters = [i.removeprefix("c:") for i in initials]
    if not read:
        return "", " ".join(letters), phrase
    own = min(range(len(read)), key=lambda k: (read[k][2] >= 500_000, read[k][2] if len(read[k][0]) > 4 else 10**5, k))
    rest = [canon if weight >= 6 else w for k, (w, canon, weight) in enumerate(read) if k != own]
    return read[own][0], " ".join(rest + letters), phrase


def classes(mentions: DataFrame) -> DataFrame:
    """(value, kind, cls): the class of every distinct normalized value of PERSON and ORG rows.

    Null and blank values, and values without a letter, have no class. A value that rows of both types carry has a class
    for each. Columns used: normalized, entity_type, source_doc.
    """
    rows = mentions.filter(F.col("entity_type").isin("PERSON", "ORG") & F.col("normalized").rlike(r"\S")).select(F.col("normalized").alias("value"), F.col("entity_type").alias("kind"), F.col("source_doc").alias("doc"))

    def parse(batches):
        for pdf in batches:
            names = [split_name(v) for v in pdf.value]
            yield pdf.assign(words=[w for w, _, _ in names], initials=[i for _, i, _ in names], comma=[c for _, _, c in names])

    # every name is parsed once
    values = cut(rows.groupBy("value", "kind").agg(F.count(F.lit(1)).alias("n")).mapInPandas(parse, "value string, kind string, n long, words array<string>, initials array<string>, comma boolean"), "names")
    listed = lambda words: F.array(*[F.lit(w) for w in sorted(words)])
    parts = values.select("kind", F.array_distinct(F.filter("words", lambda w: ~F.array_contains(listed(TITLES | LEGAL), w))).alias("ws")).filter(F.size("ws") >= 2)
    pairs = parts.select("kind", F.explode("ws").alias("w"), "ws").select("kind", "w", F.array_join(F.array_sort(F.array_except("ws", F.array("w"))), " ").alias("others"))
    common = pairs.groupBy("kind", "w").agg(F.countDistinct("others").alias("k")).filter("k >= 3")
    spread = values.select("*", F.posexplode_outer("words").alias("at", "w"))
    weighed = word_readings(spread.filter("w is not null").select("kind", "w").distinct(), cut(common, "common"))
    reading = F.array_sort(F.collect_list(F.when(F.col("w").isNotNull(), F.struct("at", "canon", "weight")))).alias("reading")
    told = spread.join(weighed, ["kind", "w"], "left").groupBy("value", "kind").agg(*[F.first(c).alias(c) for c in ("n", "words", "initials", "comma")], reading)
    told = told.select("value", "kind", "n", "words", "initials", "comma", F.col("reading.canon").alias("canons"), F.col("reading.weight").alias("weights"))

    def read(batches):
        for pdf in batches:
            out = []
            for value, kind, n, words, initials, comma, canons, weights in zip(*[pdf[c] for c in pdf.columns]):
                canonical = list(zip(canons, weights))
                if kind == "PERSON":
                    (token, group, initial), phrase = read_person(list(words), list(initials), comma, canonical), None
                else:
                    (token, group, phrase), initial = read_org(list(words), list(initials), canonical), ""
                if token:
                    out.append((value, kind, n, token, group, initial, phrase))
            yield pd.DataFrame(out, columns=["value", "kind", "n", "token", "grp", "initial", "phrase"])

    told = cut(told.mapInPandas(read, "value string, kind string, n long, token string, grp string, initial string, phrase string"), "told")

    # organisations whose other words are those of a kind, in another order, shortened or with slips
    phrases = cut(told.filter("phrase is not null").groupBy(F.col("phrase").alias("p")).count().filter("count >= 2"), "phrases")
    aligned = cut(alignments(told.filter("kind = 'ORG' and grp <> ''").select(F.col("grp").alias("p")).union(phrases.select("p")).distinct(), phrases.select(F.col("p").alias("q"))), "aligned")
    kinds = kinds_of_organisation(phrases, aligned)
    fitting = aligned.join(kinds, "q").groupBy("p").agg(F.min(F.struct("cost", -F.col("count"), "q")).alias("best")).select(F.lit("ORG").alias("kind"), F.col("p").alias("grp"), F.col("best.q").alias("q"))
    parsed = cut(told.join(fitting, ["kind", "grp"], "left").select("value", "kind", "n", "token", F.coalesce("q", "grp").alias("grp"), "initial"), "parsed")

    # telling words within one edit, through the forms with one letter deleted
    @F.pandas_udf("array<string>")
    def forms(s: pd.Series) -> pd.Series:
        return s.map(lambda w: sorted({d for r in readings(w) for d in deletes(r)}) if len(w) >= 5 else [w])

    tokens = parsed.select("kind", "token").distinct()
    index = tokens.select("kind", "token", F.explode(forms("token")).alias("form"))
    met = index.alias("x").join(index.alias("y"), ["kind", "form"]).filter("x.token < y.token").select("kind", F.col("x.token").alias("t1"), F.col("y.token").alias("t2")).distinct()

    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same_but_slip(p, q) for p, q in zip(a, b)], dtype=bool)

    linked = cut(met.filter(close("t1", "t2")), "near")

    # classes of names with a full given name (people) or kind (organisations)
    full = parsed.filter("grp <> '' or kind = 'ORG'")
    node = F.concat_ws("\t", "kind", "token", "grp")
    nodes = full.groupBy("kind", "token", "grp").agg(F.sum("n").alias("n")).withColumn("id", node)
    left = linked.join(nodes.select("kind", F.col("token").alias("t1"), "grp"), ["kind", "t1"])
    links = left.join(nodes.select("kind", F.col("token").alias("t2"), "grp"), ["kind", "t2", "grp"]).select(F.concat_ws("\t", "kind", "t1", "grp").alias("a"), F.concat_ws("\t", "kind", "t2", "grp").alias("b"))
    found = components(nodes, links)
    whole = cut(nodes.join(found, "id").select("kind", "token", "grp", "n", "cls"), "classes")
    of_full = full.join(whole.select("kind", "token", "grp", "cls"), ["kind", "token", "grp"]).select("value", "kind", "cls")

    # initials, or a surname alone: the class that fits best by surname, then by documents in common, then by weight
    bare = parsed.filter("grp = '' and kind = 'PERSON'").select("value", "token", "initial")
    around = linked.filter("kind = 'PERSON'").select(F.col("t1").alias("token"), F.col("t2").alias("other")).unionByName(linked.filter("kind = 'PERSON'").select(F.col("t2").alias("token"), F.col("t1").alias("other")))
    around = around.withColumn("far", F.lit(1)).unionByName(tokens.filter("kind = 'PERSON'").select("token", F.col("token").alias("other"), F.lit(0).alias("far")))
    russian = F.create_map(*[F.lit(x) for pair in RUSSIAN_INITIAL.items() for x in pair])
    people = whole.filter("kind = 'PERSON'").select(F.col("token").alias("other"), "grp", "cls", "n")
    fits = (F.col("initial") == "") | (F.when(F.col("initial").startswith("c:"), F.coalesce(F.element_at(russian, F.col("grp")), F.substring("grp", 1, 1))).otherwise(F.substring("grp", 1, 1)) == F.regexp_replace("initial", "^c:", ""))
    options = cut(bare.join(around, "token").join(people, "other").filter(fits).groupBy("value", "cls").agg(F.min("far").alias("far"), F.sum("n").alias("n")), "options")
    # documents are looked at for the options alone, so a document that names everyone multiplies nothing
    people_docs = rows.filter("kind = 'PERSON' and doc is not null")
    docs_of_class = people_docs.join(of_full.filter("kind = 'PERSON'").select("value", "cls"), "value").select("cls", "doc").distinct()
    asked = options.select("value", "cls").join(people_docs.select("value", "doc").distinct(), "value")
    shared_docs = asked.join(docs_of_class, ["cls", "doc"]).groupBy("value", "cls").agg(F.count(F.lit(1)).alias("docs"))
    ranked = options.join(shared_docs, ["value", "cls"], "left").withColumn("r", F.row_number().over(Window.partitionBy("value").orderBy("far", F.desc_nulls_last("docs"), F.desc("n"), "cls")))
    chosen = ranked.filter("r = 1").select("value", "cls")
    alone = bare.join(chosen, "value", "left").select("value", F.lit("PERSON").alias("kind"), F.coalesce("cls", F.concat(F.lit("PERSON\t"), "token", F.lit("\t?"), F.regexp_replace("initial", "^c:", ""))).alias("cls"))
    return of_full.unionByName(alone)


def variant_pairs(classed: DataFrame) -> DataFrame:
    """(normalized_a, normalized_b), a < b: all pairs of different values of a class."""
    x = classed.select(F.col("value").alias("normalized_a"), "cls", "kind")
    y = classed.select(F.col("value").alias("normalized_b"), "cls", "kind")
    return x.join(y, ["cls", "kind"]).filter("normalized_a < normalized_b").select("normalized_a", "normalized_b").distinct()
