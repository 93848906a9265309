"""Problem 7: noise in text from scanned pages.

An averaged-perceptron character editor decides for every suspicious place of a word whether to keep it or to put back
the letter it was misread from (a replacement, or one with a deletion or insertion where letter groups are involved), and
for every hyphen at a line end whether to join the lines. It is trained here on words of the corpus with misreadings
put in by a fixed list of look-alikes. Word frequencies over the whole corpus serve as features, from a table of hashed
counts that holds every word.

Running headers and page numbers are decided by a second averaged perceptron, on how a line looks, where its like stands
on the pages of its document and on how many. It learns from weak labels counted over all lines: lines at the edge of
several pages against lines that stand once. They are removed before the text is read as paragraphs.
"""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from layoutgraph.plans.bounded import most_frequent
from layoutgraph.plans.session import cut

LEXICON_BITS = 22  # cells of the table of word counts
TRAIN_WORDS = 6_000  # most frequent words that misreadings are put into; they label themselves
TIMES = 8  # a word that one misreading makes out of one so many times as frequent is no word

#: Letters and what scanners read in their place.
LOOKALIKES = {
    "a": "а", "b": "6", "c": "с", "e": "е", "g": "9", "h": "lı һ", "i": "! і 1", "l": "1", "m": "rn", "o": "о 0", "p": "р", "s": "5 ѕ",
    "u": "ц", "x": "х", "y": "у", "z": "2", "B": "8 В", "E": "Е", "A": "А", "C": "С", "H": "Н", "I": "1 !", "K": "К", "M": "М", "O": "0 О", "P": "Р", "S": "5", "T": "Т", "X": "Х", "G": "6",
    "а": "a", "б": "6", "е": "e", "з": "3", "и": "n u", "к": "k", "л": "ʌ", "н": "h", "о": "o 0", "п": "n", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ч": "4", "ь": "b", "і": "i 1", "в": "b",
    "А": "A", "В": "B 8", "Е": "E", "З": "3", "К": "K", "М": "M", "Н": "H", "О": "O 0", "Р": "P", "С": "C", "Т": "T", "Х": "X", "Ч": "4", "Б": "6",
}
READ_AS: dict[str, list[str]] = defaultdict(list)
for _letter, _groups in LOOKALIKES.items():
    for _g in _groups.split():
        READ_AS[_g].append(_letter)
_LATIN, _CYRILLIC = "A-Za-zÀ-ɏ", "Ѐ-ӿ"
_SUSPECT = re.compile(rf"[{_LATIN}][{_CYRILLIC}]|[{_CYRILLIC}][{_LATIN}]|[{_LATIN}{_CYRILLIC}][0-9!|](?=[{_LATIN}{_CYRILLIC}])|(?<![\w.,!|])[0-9!](?=[{_LATIN}{_CYRILLIC}]{{2}})|[{_LATIN}{_CYRILLIC}]{{2}}[0-9](?![\w.,])|[ʌı]|rn")
_WORD = re.compile(rf"[{_LATIN}{_CYRILLIC}ʌ0-9!|]+")
_TRIM = re.compile(r"^[!|]+(?![a-zа-я])|[!|]+$")
_HYPHEN = re.compile(rf"([{_LATIN}{_CYRILLIC}ʌ0-9!]+)([-‐‑¬­])[ \t]*\r?\n[ \t]*([{_LATIN}{_CYRILLIC}ʌ0-9!]+)")
_HYPHEN_END = re.compile(rf"([{_LATIN}{_CYRILLIC}ʌ!]{{2,}})[-‐‑¬­]\s*$")
_MARKUP = re.compile(r"<[^<>\n]*>|\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?|&[#A-Za-z0-9]+;|```.*?```|~~~.*?~~~|<(?:syntaxhighlight|pre|code)\b.*?</(?:syntaxhighlight|pre|code)>|\\begin\{verbatim\}.*?\\end\{verbatim\}|[$][^$\n]*[$]|\S*[_{}^=]\S*", re.S)


def script_of(ch: str) -> str:
    o = ord(ch)
    if not ch.isalpha():
        return "#" if ch.isdigit() else "."
    return "l" if o < 0x250 else "c" if 0x400 <= o < 0x530 else "o"


def _kind(ch: str) -> str:
    if not ch:
        return "$"
    return script_of(ch) + ("U" if ch.isupper() else "")


def _hash(word: str) -> int:
    """Spark's xxhash64 of a string, as an unsigned number."""
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42)


class Lexicon:
    """Counts of all words in a table of fixed size: a word's two cells hold quarter steps of the binary logarithm of the
    highest count that met them, and the lower one is taken."""

    def __init__(self, cells: np.ndarray | None = None):
        self.cells = np.zeros(1 << LEXICON_BITS, np.uint8) if cells is None else cells

    def get(self, word: str, default: int = 0) -> int:
        h = _hash(word)
        v = min(self.cells[h & ((1 << LEXICON_BITS) - 1)], self.cells[(h >> LEXICON_BITS) & ((1 << LEXICON_BITS) - 1)])
        return int(2 ** ((int(v) - 1) / 4) + 0.5) if v else default

    @staticmethod
    def of(words: DataFrame) -> "Lexicon":
        """The table of ``words`` (w, n); at most one number a cell reaches the driver."""
        mask = (1 << LEXICON_BITS) - 1
        h = F.xxhash64("w")
        cells = F.array(h.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(h, LEXICON_BITS).bitwiseAND(F.lit(mask)))
        level = F.least(F.lit(255), F.floor(F.log2("n") * 4) + 1).cast("short")
        rows = words.select(F.explode(cells).alias("cell"), level.alias("v")).select(F.col("cell").cast("int").alias("cell"), "v").groupBy("cell").agg(F.max("v").alias("v")).toPandas()
        out = Lexicon()
        out.cells[rows["cell"].to_numpy(np.int64)] = rows["v"].to_numpy(np.uint8)
        return out


class Editor:
    """Averaged perceptron over edit candidates of a word and over joins at line ends."""

    def __init__(self, lexicon: "dict[str, int] | Lexicon"):
        self.lexicon = lexicon
        self.weights: dict[str, float] = {}
        self.memo: dict[str, tuple[tuple[int, str, str], ...]] = {}
        self.levels: dict[str, int] = {}

    def _level(self, word: str, blind: bool = False) -> int:
        if blind:
            return 0
        found = self.levels.get(word)
        if found is None:
            n = self.lexicon.get(word.lower(), 0)
            found = 0 if n < 2 else min(6, int(math.log2(n) / 1.7) + 1)
            if len(self.levels) > 300_000:
                self.levels.clear()
            self.levels[word] = found
        return found

    def candidates(self, word: str) -> list[tuple[int, str, str]]:
        """(position, group as read, letter it may stand for)."""
        out = []
        for i in range(len(word)):
            for size in (1, 2):
                g = word[i : i + size]
                if len(g) == size:
                    before, after = word[i - 1 : i], word[i + size : i + size + 1]
                    # a capital doesn't follow a small letter, nor a small one stand between capitals
                    out += [(i, g, c) for c in READ_AS.get(g, ()) if not (c.isupper() and before.islower()) and not (c.islower() and before.isupper() and after.isupper())]
        return out

    def features(self, word: str, place: tuple[int, str, str], blind: bool = False) -> list[str]:
        i, g, c = place
        rest = word[:i] + word[i + len(g) :]
        latin = sum(script_of(ch) == "l" for ch in rest)
        cyr = sum(script_of(ch) == "c" for ch in rest)
        main = "l" if latin > cyr else "c" if cyr > latin else "="
        left, right = word[i - 1 : i], word[i + len(g) : i + len(g) + 1]
        fixed = word[:i] + c + word[i + len(g) :]
        a, b = self._level(fixed, blind), self._level(word, blind)
        odd = "".join(script_of(ch) for ch in g)
        fits = script_of(c) == main
        case = "u" if c.isupper() else "l"
        around = ("u" if left.isupper() else "l" if left.islower() else "-") + ("u" if right.isupper() else "l" if right.islower() else "-")
        letters = min(4, latin + cyr)
        same = odd[0] == main and len(g) == 1
        fix = f"{fits}{same}"
        return [
            "bias", f"op {g}>{c}", f"fit {fix} {odd}", f"near {_kind(left)} {_kind(right)} {odd}", f"size {letters} {odd}", f"lex {a} {b} {fix}", f"lexop {a > b} {len(g)} {a >= 3} {b >= 2}",
            f"oplex {g}>{c} {a >= 2} {b >= 2}", f"case {case} {around} {odd} {fits}", f"end {not right} {word.isupper()} {odd}", f"blend {min(latin, cyr)} {fits} {odd}",
        ]

    def score(self, word: str, place, blind: bool = False) -> float:
        w = self.weights
        return sum(w.get(f, 0.0) for f in self.features(word, place, blind))

    def edits(self, word: str) -> tuple[tuple[int, str, str], ...]:
        """The edits of a word: at each place of the candidates that beat keeping it the best."""
        found = self.memo.get(word)
        if found is None:
            best: dict[int, tuple[tuple[int, float], tuple[int, str, str]]] = {}
            for place in self.candidates(word):
                s = self.score(word, place)
                if s > 0:
                    i, g, c = place
                    known = self._level(word[:i] + c + word[i + len(g) :])
                    if g == "rn" and not known:  # any word may hold these; only a known one tells
                        continue
                    key = (known, s)  # of several letters, the one that makes a known word
                    if i not in best or key > best[i][0]:
                        best[i] = (key, place)
            found = tuple(best[i][1] for i in sorted(best))
            if len(self.memo) > 300_000:
                self.memo.clear()
            self.memo[word] = found
        return found

    def join_features(self, left: str, sign: str, right: str, blind: bool = False) -> list[str]:
        joined, compound = self._level(left + right, blind), self._level(f"{left}-{right}", blind)
        shape = f"{_kind(left[-1:])} {_kind(right[:1])}"
        alone = self._level(left, blind) >= 2 and self._level(right, blind) >= 2
        return ["join", f"sign {sign}", f"jshape {shape} {left.isupper()}", f"jlex {joined} {compound > 0}", f"jc {compound}", f"jsolo {alone} {joined > 0} {compound > 0}", f"js {sign} {shape} {compound > 0}"]

    def joins(self, left: str, sign: str, right: str) -> bool:
        w = self.weights
        return sum(w.get(f, 0.0) for f in self.join_features(left, sign, right)) > 0

    def train(self, words: list[str], keep: list[str], rounds: int = 4, seed: int = 7) -> "Editor":
        """``words``: clean words to misread and to break; ``keep``: tokens with digits or signs which are right."""
        rng = random.Random(seed)
        examples: list[tuple[list[str], bool]] = []
        compounds = [k for k in keep if "-" in k]
        keep = [k for k in keep if "-" not in k]
        for word in words + keep * 2:
            code = not word.isalpha()
            for variant in dict.fromkeys((word, word.capitalize(), word.upper()) if not code else (word.upper(),)):
                blind = rng.random() < 0.4
                for place in self.candidates(variant):
                    examples.append((self.features(variant, place, blind), False))
                if code or len(word) < 3:
                    continue
                at = [i for i, ch in enumerate(variant) if ch in LOOKALIKES]
                for i in {*rng.sample(at, min(2, len(at))), *at[-1:]}:
                    g = rng.choice(LOOKALIKES[variant[i]].split())
                    noisy = variant[:i] + g + variant[i + 1 :]
                    for place in self.candidates(noisy):
                        right = place[0] == i and place[1] == g and place[2] == variant[i]
                        if right or not i <= place[0] < i + len(g):
                            examples.append((self.features(noisy, place, blind), right))
                if len(word) >= 4:
                    k = rng.randrange(2, len(word) - 1)
                    examples.append((self.join_features(variant[:k], rng.choice("---‐¬­"), variant[k:], blind), True))
        for c in compounds:
            left, _, right = c.partition("-")
            for _ in range(3):
                examples.append((self.join_features(left, "-", right), False))
        for word in words:  # hyphenated names whose parts are words or names of their own
            examples.append((self.join_features(word.capitalize(), "-", rng.choice(words).capitalize(), rng.random() < 0.5), False))
            examples.append((self.join_features(word.upper(), "-", rng.choice("XYZ")), False))
        weights, totals, stamp, t = defaultdict(float), defaultdict(float), defaultdict(int), 0
        for _ in range(rounds):
            rng.shuffle(examples)
            for feats, right in examples:
                t += 1
                if (sum(weights[f] for f in feats) > 0) != right:
                    step = 1.0 if right else -1.0
                    for f in feats:
                        totals[f] += (t - stamp[f]) * weights[f]
                        stamp[f] = t
                        weights[f] += step
        self.weights = {f: (totals[f] + (t - stamp[f]) * w) / max(1, t) for f, w in weights.items()}
        return self

    def __getstate__(self):
        return {"lexicon": self.lexicon, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state, memo={}, levels={})


def misread_words(editor: Editor, text: str) -> list[tuple[int, int, str]]:
    """(start, end, repaired word) of the misread words of a text."""
    out, done = [], -1
    masked = None
    for m in _SUSPECT.finditer(text):
        if m.start() < done:
            continue
        if masked is None:
            masked = [x.span() for x in _MARKUP.finditer(text)] if any(c in text for c in "<\\&`~$_{}^=") else []
        if any(a <= m.start() < b for a, b in masked):
            continue
        a, b = m.start(), m.end()
        while a and _WORD.match(text[a - 1]):
            a -= 1
        while b < len(text) and _WORD.match(text[b]):
            b += 1
        done = b
        while b > a and text[b - 1] in "!|":
            b -= 1
        while a < b and text[a] == "|":
            a += 1
        word = text[a:b]
        if sum(ch.isalpha() for ch in word) < 2:
            continue
        edits = editor.edits(word)
        if edits:
            fixed, at = "", 0
            for i, g, c in edits:
                if i >= at:
                    fixed += word[at:i] + c
                    at = i + len(g)
            out.append((a, b, fixed + word[at:]))
    return out


def broken_words(editor: Editor, text: str, block: bool) -> list[tuple[int, int, str]]:
    """(start, end, replacement) of words hyphenated at a line end, or at the end of the block (end replaced by '')."""
    out = []
    if "\n" in text:
        for m in _HYPHEN.finditer(text):
            if editor.joins(m.group(1), m.group(2), m.group(3)):
                out.append((m.start(2), m.start(3), ""))
    if block and text and text.rstrip()[-1:] in "-‐‑¬­":
        m = _HYPHEN_END.search(text)
        if m:
            out.append((m.end(1), len(text), ""))
    return out


def repair(editor: Editor, text: str) -> str:
    """Continuous text: words joined and put right, line breaks inside paragraphs turned into blanks."""
    changes = sorted(broken_words(editor, text, False))
    for a, b, new in reversed(changes):
        text = text[:a] + new + text[b:]
    for a, b, new in reversed(misread_words(editor, text)):
        text = text[:a] + new + text[b:]
    return re.sub(r"[ \t]*\n(?!\n)[ \t]*", " ", re.sub(r"\n[ \t]*\n\s*", "\n\n", text)).replace(" \n", "\n").strip()


# ---- furniture: page numbers and running headers, by page position -------------------------------------------------

#: Forms of a page number on a line of its own.
PAGE_NUMBER = r"^\s*(?:\[\s*\d{1,4}\s*\]|[-–—]\s*\d{1,4}\s*[-–—]|\d{1,4}|\d{1,4}\s*/\s*\d{1,4}|(?iu:p|pp|page|seite|стр|с|s|pág)\.?\s*\d{1,4}(?:\s*(?iu:of|из|von|de|/)\s*\d{1,4})?)\s*$"
_FOLD_FROM, _FOLD_TO = "0оo1lıi!іи5ѕ9g6бbеeаaсcрpцuхxуyʌлhнзkкtтmмnп4ч3", "ooolllllllssgggbbbeeaaccppuuxxyyллннзккттммnnччз"


def line_key(line: Column) -> Column:
    """A line with digits and look-alikes folded, so that a header repeats in spite of its page number and misreadings."""
    low = F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))
    low = F.regexp_replace(low, r"(?<![\p{L}])\d+(?![\p{L}])", "#")
    return F.translate(F.regexp_replace(F.regexp_replace(low, "lı", "h"), "rn", "m"), _FOLD_FROM, _FOLD_TO)


_EDGE_KINDS = ("text", "header")
_NUMBER_FORMS = {"bracket": r"^\s*\[", "dash": r"^\s*[-–—]", "word": r"^\s*\p{L}", "of": r"\d\s*/", "bare": r"\d"}


def line_features(line: Column, kind: Column, page: Column, alone: Column) -> Column:
    """How a line looks, as words: its page number form and whether that counts this page, its end, its start, its length."""
    number = line.rlike(PAGE_NUMBER)
    form = F.lit("num:other")
    for name, pattern in reversed(_NUMBER_FORMS.items()):
        form = F.when(line.rlike(pattern), F.lit(f"num:{name}")).otherwise(form)
    digits = F.try_to_number(F.regexp_extract(line, r"\d+", 0), F.lit("9999")).cast("int")
    match = F.when(page.isNull(), F.lit("match:?")).when(digits.isin(-1) | digits.isNull(), F.lit("match:n")).when((digits == page) | (digits == page + 1), F.lit("match:y")).otherwise(F.lit("match:n"))
    flag = lambda name, test: F.when(test, F.lit(f"{name}:1")).otherwise(F.lit(f"{name}:0"))
    return F.concat_ws(
        " ", F.when(number, form).otherwise(F.lit("num:none")), F.when(number, match).otherwise(F.lit("match:-")), flag("alone", alone), flag("end", line.rlike(r"[.!?।。！？:;,]\s*$")), flag("hyphen", line.rlike(r"[-‐‑¬­]\s*$") & ~number),
        flag("letters", line.rlike(r"\p{L}{3}")), flag("mark", line.rlike(r"^\s*(?:[#|+*•–\\<$\[{=~`-]|\d+[.)] )") & ~number), flag("short", F.length(F.trim(line)).between(4, 90)), flag("prose", kind.isin(*_EDGE_KINDS)), flag("list", kind == "list"),
    )


def block_lines(blocks: DataFrame) -> DataFrame:
    """Blocks with the first and the last line: features of each, and the key under which it repeats (null where a line is too
    long or holds no word)."""
    rows = blocks.withColumn("lines", F.when(F.col("content").isNotNull(), F.filter(F.split(F.col("content"), r"\r?\n"), lambda x: x.rlike(r"\S"))))
    kind, page, one = F.coalesce("block_type", F.lit("text")), F.col("page_number").cast("int"), F.size("lines") == 1
    for name, at in (("first", 1), ("last", -1)):
        line = F.try_element_at("lines", F.lit(at))
        given = F.size("lines") > (0 if at == 1 else 1)
        keyed = given & F.length(F.trim(line)).between(4, 90) & line.rlike(r"\p{L}{3}")
        rows = rows.withColumn(f"{name}_looks", F.when(given, line_features(line, kind, page, one))).withColumn(f"{name}_key", F.when(keyed, line_key(line)))
    return rows.drop("lines")


def line_places(rows: DataFrame) -> DataFrame:
    """(source_hash, key, places): on how many pages of its document a line's like stands, on how many of them at the top or
    the bottom, and whether it is a title, list or table somewhere."""
    edges = rows.filter("source_hash is not null").groupBy("source_hash", "page_number").agg(F.min("block_index").alias("lo"), F.max("block_index").alias("hi"))
    sides = F.explode(F.array(*[F.struct(F.col(f"{n}_key").alias("key"), F.lit(n == "first").alias("upper")) for n in ("first", "last")]))
    kind = F.coalesce("block_type", F.lit("text"))
    places = rows.filter("source_hash is not null").select("source_hash", "page_number", "block_index", kind.alias("kind"), sides.alias("s"), F.col("last_key").isNull().alias("only")).select("source_hash", "page_number", "block_index", "kind", "only", "s.key", "s.upper").filter("key is not null")
    placed = places.join(edges, ["source_hash", "page_number"], "left")
    edge = ((F.col("block_index") == F.col("lo")) & F.col("upper")) | ((F.col("block_index") == F.col("hi")) & (~F.col("upper") | F.col("only")))
    prose = F.col("kind").isin(*_EDGE_KINDS)
    stats = placed.groupBy("source_hash", "key").agg(F.countDistinct(F.when(prose, F.col("page_number"))).alias("pages"), F.countDistinct(F.when(prose & F.coalesce(edge, F.lit(False)), F.col("page_number"))).alias("edges"), F.max(~prose).alias("other"))
    more = lambda c, k: F.when(F.col(c) >= k, F.lit(f"{c}{k}:1")).otherwise(F.lit(f"{c}{k}:0"))
    # a page number holds no word, so its like is nowhere; lines that stand once say so
    return stats.select("source_hash", "key", F.concat_ws(" ", more("pages", 2), more("pages", 3), more("edges", 1), more("edges", 2), F.when(F.col("other"), F.lit("other:1")).otherwise(F.lit("other:0"))).alias("places"))


NOWHERE = "pages2:0 pages3:0 edges1:0 edges2:0 other:0"


def weak_label(looks: str, places: str) -> str | None:
    """header, number or body where that is nearly sure, else None."""
    f = set(looks.split()) | set(places.split())
    if "num:none" not in f:
        if "prose:0" in f and "list:0" in f:
            return "body"
        if "match:y" in f:  # counts this page
            return "number"
        if "num:bare" in f:
            return "body" if "match:n" in f else None
        return "number" if "alone:1" in f and "match:n" in f else None
    if "pages2:0" in f or "other:1" in f or "prose:0" in f or "end:1" in f or "mark:1" in f or "hyphen:1" in f or "letters:0" in f or "short:0" in f:
        return "body"
    return "header" if {"pages3:1", "edges2:1"} <= f else None


class Furniture:
    """Averaged perceptron with three classes over a line's looks and places."""

    CLASSES = ("body", "header", "number")

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}
        self.memo: dict[tuple[str, str], str] = {}

    @staticmethod
    def features(looks: str, places: str) -> list[str]:
        words = looks.split() + places.split()
        pick = lambda *names: "&".join(w for w in words if w.split(":")[0] in names)
        return ["bias", *words, pick("num", "match", "alone"), pick("num", "match", "list"), pick("pages2", "end"), pick("pages2", "mark"), pick("pages2", "other"), pick("pages2", "edges1", "other"), pick("pages2", "prose"), pick("pages2", "hyphen"), pick("num", "pages2")]

    def __call__(self, looks: str | None, places: str | None) -> str:
        if not looks:
            return "body"
        key = (looks, places or NOWHERE)
        found = self.memo.get(key)
        if found is None:
            feats = self.features(*key)
            found = max(self.CLASSES, key=lambda c: sum(self.weights.get((c, f), 0.0) for f in feats))
            self.memo[key] = found
        return found

    def train(self, counted: list[tuple[str, str, int]], rounds: int = 20) -> "Furniture":
        """``counted``: (looks, places, how many lines). A kind of line counts by the logarithm of its number."""
        examples = [(self.features(a, b), y, 1 + math.log2(n)) for a, b, n in sorted(counted) if (y := weak_label(a, b))]
        weights, sums, t = defaultdict(float), defaultdict(float), 0
        rng = random.Random(3)
        for _ in range(rounds):
            rng.shuffle(examples)
            for feats, y, n in examples:
                t += 1
                got = max(self.CLASSES, key=lambda c: (sum(weights[c, f] for f in feats), c != y))
                if got != y:
                    for f in feats:
                        for c, sign in ((y, n), (got, -n)):
                            weights[c, f] += sign
                            sums[c, f] += sign * t
        self.weights = {k: w - sums[k] / (t + 1) for k, w in weights.items()}
        return self

    def __getstate__(self):
        return {"weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state, memo={})


def furniture(blocks: DataFrame) -> tuple[DataFrame, Furniture]:
    """Blocks with looks and places of their first and last lines, and the perceptron that judges them."""
    rows = block_lines(blocks)
    slim = cut(rows.drop("content"), "lines")
    places = cut(line_places(slim), "places")
    # lines without a key match nothing; keys of their own keep a large document's from meeting in one task
    spread = lambda c: F.coalesce(c, F.concat(F.lit("\0"), F.coalesce("block_id", F.lit(""))))

    def placed(df: DataFrame) -> DataFrame:
        for name in ("first", "last"):
            at = places.select("source_hash", F.col("key").alias(f"{name}_key"), F.col("places").alias(f"{name}_places"))
            df = df.withColumn(f"{name}_key", spread(F.col(f"{name}_key"))).join(at, ["source_hash", f"{name}_key"], "left")
        return df.drop("first_key", "last_key")

    sides = F.explode(F.array(*[F.struct(F.col(f"{n}_looks").alias("looks"), F.coalesce(f"{n}_places", F.lit(NOWHERE)).alias("places")) for n in ("first", "last")]))
    counted = placed(slim).select(sides.alias("s")).select("s.*").filter("looks is not null").groupBy("looks", "places").agg(F.count(F.lit(1)).alias("n"))
    # kinds of lines: a few words of two or three forms each, so their number is fixed
    return placed(rows), Furniture().train([(r["looks"], r["places"], r["n"]) for r in counted.collect()])


def word_counts(blocks: DataFrame, mentions: DataFrame) -> DataFrame:
    """(w, n) over all rows: pure words of one script, and compounds with a hyphen. A word seen once tells nothing and is
    left out."""
    texts = blocks.select(F.col("content").alias("t")).unionByName(mentions.select(F.col("text").alias("t")))
    word = rf"(?<![\p{{L}}\p{{N}}_-])(?:[a-zß-ɏ]{{2,24}}|[а-яёіїєґ]{{2,24}}|[a-z]{{1,24}}-[a-z]{{1,24}}|[a-z]{{2,6}}[0-9])(?![\p{{L}}\p{{N}}_-])"
    found = texts.select(F.explode(F.regexp_extract_all(F.lower("t"), F.lit(word), F.lit(0))).alias("w"))
    return found.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")


def clean_words(words: DataFrame) -> DataFrame:
    """Without words that one misreading makes out of a word TIMES as frequent: in a large corpus misread words are frequent
    too."""
    shared = words.sparkSession.sparkContext.broadcast(Lexicon.of(words))

    def keep(batches):
        counts, reader = shared.value, Editor({})
        for pdf in batches:
            good = [not any(counts.get(w[:i] + c + w[i + len(g) :]) >= TIMES * n for i, g, c in reader.candidates(w)) for w, n in zip(pdf.w, pdf.n)]
            yield pdf[good]

    return words.mapInPandas(keep, "w string, n long")


def fit(blocks: DataFrame, mentions: DataFrame, train_words: int = TRAIN_WORDS) -> Editor:
    """An editor trained on the ``train_words`` most frequent words and half as many tokens with a digit or a hyphen."""
    words = cut(clean_words(cut(word_counts(blocks, mentions), "words")), "lexicon")
    plain = F.col("w").rlike(r"^\p{L}+$")
    pure = [r["w"] for r in most_frequent(words.filter(plain), "n", train_words)]
    keep = [r["w"] for r in most_frequent(words.filter(~plain), "n", train_words // 2)]
    return Editor(Lexicon.of(words)).train(pure, keep)


def noise(blocks: DataFrame, mentions: DataFrame, editor: Editor | None = None) -> DataFrame:
    """(rec_table, rec_id, noise, text): kinds of noise of each block and mention, and the repaired text.

    noise is an array out of broken_word, misread_char, running_header and page_number. Null ids and null texts give
    no row; an empty text has no noise; exact copies of a row give one row each, alike.
    """
    editor = editor or fit(blocks, mentions)
    placed, judge = furniture(blocks.select("block_id", "source_hash", "block_type", "content", "page_number", "block_index"))
    shared = blocks.sparkSession.sparkContext.broadcast((editor, judge))
    sides = ["first_looks", "first_places", "last_looks", "last_places"]
    rows = placed.filter("block_id is not null and content is not null").select(F.lit("blocks").alias("rec_table"), F.col("block_id").alias("rec_id"), F.col("content").alias("text"), *sides, F.coalesce("block_type", F.lit("text")).isin("text", "header", "list").alias("prose"))
    none = F.lit(None).cast("string")
    names = mentions.filter("mention_id is not null and text is not null").select(F.lit("entities").alias("rec_table"), F.col("mention_id").cast("string").alias("rec_id"), "text", *[none.alias(c) for c in sides], F.lit(True).alias("prose"))

    def run(batches):
        ed, judge = shared.value
        for pdf in batches:
            kinds, texts = [], []
            for table, text, fl, fp, ll, lp, prose in zip(pdf.rec_table, pdf.text, *[pdf[c] for c in sides], pdf.prose):
                found, body = [], text
                if misread_words(ed, text):
                    found.append("misread_char")
                if table == "blocks":
                    lines = text.split("\n")
                    full = [k for k, x in enumerate(lines) if x.strip()]
                    drop = set()
                    for k, looks, places in ((full[0], fl, fp), (full[-1], ll, lp)) if full else ():
                        kind = judge(looks, places)
                        if kind != "body":
                            drop.add(k)
                            found.append("page_number" if kind == "number" else "running_header")
                    if drop:
                        body = "\n".join(x for k, x in enumerate(lines) if k not in drop)
                if body and broken_words(ed, body, table == "blocks" and prose):
                    found.append("broken_word")
                kinds.append(sorted(set(found)))
                texts.append(repair(ed, body) if found or (prose and "\n" in body and table == "entities") else body)
            yield pd.DataFrame({"rec_table": pdf.rec_table, "rec_id": pdf.rec_id, "noise": kinds, "text": texts})

    return rows.unionByName(names).mapInPandas(run, "rec_table string, rec_id string, noise array<string>, text string")
