"""Problem 1: the language of documents and of the runs of sentences in them, by language-bitmask n-gram filters.

One bit-sliced Bloom filter holds every n-gram of every language: a slot is a mask with one bit a language, and the
AND of an n-gram's slots says in which languages it occurs. A sentence's popcounts per language, corrected for the
filter's false positives, decide. Names, numbers and terms that occur in several languages set several bits and so
favour none.

The filter is trained here, on a bounded sample of labelled texts: an n-gram belongs to the languages in which it is
at least SHARE times as frequent as where it is most frequent. Labels are wrong now and then, so the sample is
labelled again, sentence by sentence, by the filter it gave, and the filter is built again from that.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from layoutgraph.llm import sentences as S
from layoutgraph.plans.bounded import samples

LANGUAGES = ["en", "ru", "uk", "de", "fr", "es", "zh", "ja", "th", "hi"]
#: Other forms of the ten labels (three letters, English and own names), in lower case.
FORMS = {
    "en": "eng english", "ru": "rus russian русский", "uk": "ukr ukrainian українська украинский", "de": "deu ger german deutsch",
    "fr": "fra fre french français francais", "es": "spa spanish español espanol castellano", "zh": "zho chi cmn chinese 中文 汉语 漢語",
    "ja": "jpn japanese 日本語", "th": "tha thai ไทย ภาษาไทย", "hi": "hin hindi हिन्दी हिंदी",
}
CANON = {form: lang for lang, forms in FORMS.items() for form in [lang, *forms.split()]}

#: Russian and Ukrainian are also written in Latin letters: their training texts count a second time, romanised, as
#: classes of their own, which are reported as the language. A common romanisation.
ROMAN = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґ", "a b v g d e yo zh z i y k l m n o p r s t u f kh ts ch sh shch  y ' e yu ya i yi ye g".split(" ")))
_ROMAN = str.maketrans(ROMAN)
CLASSES = [*LANGUAGES, "ru", "uk"]
ROMANISED = {LANGUAGES.index("ru"): 10, LANGUAGES.index("uk"): 11}

GRAMS = (2, 3, 5)
SLOTS = 1 << 20
PROBES = 2
SHARE_FIRST, SHARE = 0.4, 0.12  # the first round must bear wrong labels
PER_LABEL = 300  # labelled texts a language that the filter is trained on
MIN_LETTERS = 6  # a sentence with fewer takes the language of its neighbours
BLOCK = 1 << 15  # characters looked up at a time, so that the vectors stay in the processor's cache
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def canonical(label: str | None) -> str | None:
    """The ten codes' form of a label; None if it is null, blank or und; other labels as they are, in lower case."""
    if label is None:
        return None
    low = label.strip().lower()
    if low in ("", "und", "unknown", "none", "null", "zxx", "mul"):
        return None
    return CANON.get(low) or CANON.get(low.replace("_", "-").split("-")[0]) or low


_TABLE: np.ndarray | None = None


def _table() -> np.ndarray:
    """Code point of the basic plane -> the letter in lower case; a blank for all but letters, marks and apostrophes."""
    table = np.full(0x10000, 32, np.uint16)
    for o in range(0x10000):
        ch = chr(o)
        if ch.isalpha() or 0x900 <= o < 0xE80 and not ch.isdigit() or ch == "'":
            low = ch.lower()
            table[o] = ord(low) if len(low) == 1 else o
    return table


def _points(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letters of all units with single blanks in between, number of the unit each belongs to)."""
    global _TABLE
    if _TABLE is None:
        _TABLE = _table()
    raw = np.frombuffer("".join(f" {u} " for u in units).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(units), dtype=np.int32), np.array([len(u) + 2 for u in units], np.int64))
    points = np.where(raw < 0x10000, _TABLE[np.minimum(raw, 0xFFFF)], 32)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32) | (owner[1:] != owner[:-1])
    return points[keep].astype(np.uint64), owner[keep]


def _mix(h: np.ndarray, k: int) -> np.ndarray:
    h = h * _MULT[k]
    return h ^ (h >> np.uint64(31))


def _hashes(points: np.ndarray, owner: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of GRAMS: (hash of every n-gram, number of its unit). Longer ones are built from shorter ones."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int32)
    out = dict.fromkeys(GRAMS, none)
    if len(points) < 2:
        return out
    two = _mix((points[:-1] << np.uint64(16)) | points[1:], 0)
    three = _mix(two[:-1] ^ (points[2:] << np.uint64(20)), 1)
    five = _mix(three[:-2] ^ (three[2:] >> np.uint64(9)), 2) if len(three) > 2 else none[0]
    for n, h in ((2, two), (3, three), (5, five)):
        if len(h):
            inside = owner[: len(h)] == owner[n - 1 :]
            out[n] = h[inside], owner[: len(h)][inside]
    return out


def gram_hashes(units: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every n-gram, number of the unit it stands in), in the order of units."""
    return _hashes(*_points(units))[n]


_PACK = 6  # counters of ten bits in a 64-bit number
_RUN = 1000  # n-grams added up before a counter could overflow
_PACKED: dict[int, np.ndarray] = {}


def _packed(size: int) -> np.ndarray:
    """Mask -> its bits as counters packed into 64-bit numbers."""
    if size not in _PACKED:
        bits = (np.arange(1 << size)[:, None] >> np.arange(size)) & 1
        words = -(-size // _PACK)
        table = np.zeros((1 << size, words), np.uint64)
        for b in range(size):
            table[:, b // _PACK] |= bits[:, b].astype(np.uint64) << np.uint64(10 * (b % _PACK))
        _PACKED[size] = table
    return _PACKED[size]


def _slots(h: np.ndarray, probe: int) -> np.ndarray:
    x = h * _MULT[probe % 3]
    return ((x ^ (x >> np.uint64(29))) & np.uint64(SLOTS - 1)).astype(np.int32)


def _blocks(units: list[str]) -> list[list[str]]:
    """Units in blocks of about BLOCK characters, at least one block."""
    block = np.cumsum([len(u) + 2 for u in units]) // BLOCK
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(units)]
    return [units[a:b] for a, b in zip(cuts, cuts[1:])]


class MaskFilter:
    """Bit-sliced Bloom filter over language sets. Its size is fixed: SLOTS masks of 16 bits."""

    def __init__(self, members: list[np.ndarray]):
        self.masks = np.zeros(SLOTS, np.uint16)
        for bit, h in enumerate(members):
            for p in range(PROBES):
                self.masks[_slots(h, p)] |= np.uint16(1 << bit)
        fill = np.array([((self.masks >> np.uint16(b)) & np.uint16(1)).mean() for b in range(len(members))])
        self.false_rate = fill**PROBES

    def counts(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(units x languages) corrected popcounts, and the numbers of n-grams and of letters of each unit."""
        parts = [self._counts(block) for block in _blocks(units)]
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _counts(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        points, at = _points(units)
        size = len(self.false_rate)
        table = _packed(size)
        seen, n = np.zeros((len(units), size), np.float64), np.zeros(len(units))
        for h, owner in _hashes(points, at).values():
            if not len(h):
                continue
            mask = self.masks[_slots(h, 0)]
            for p in range(1, PROBES):
                mask &= self.masks[_slots(h, p)]
            change = np.concatenate([[True], owner[1:] != owner[:-1]])
            change[::_RUN] = True
            starts = np.flatnonzero(change)
            whose = owner[starts]
            for w in range(table.shape[1]):
                sums = np.add.reduceat(table[mask, w], starts)
                for b in range(w * _PACK, min(size, (w + 1) * _PACK)):
                    count = (sums >> np.uint64(10 * (b % _PACK))) & np.uint64(1023)
                    seen[:, b] += np.bincount(whose, weights=count, minlength=len(units))
            n += np.bincount(owner, minlength=len(units))
        letters = np.bincount(at, weights=(points != 32) & (points != 39), minlength=len(units))
        return np.maximum(0.0, (seen - n[:, None] * self.false_rate) / (1 - self.false_rate)), n, letters


def romanise(text: str) -> str:
    return text.lower().translate(_ROMAN)


def merged(counts: np.ndarray) -> np.ndarray:
    """Popcounts of the ten languages: of a language and its romanised class the larger one."""
    out = counts[:, : len(LANGUAGES)].copy()
    for own, roman in ROMANISED.items():
        out[:, own] = np.maximum(out[:, own], counts[:, roman])
    return out


def _members(units: list[str], labels: np.ndarray, share: float = SHARE) -> list[np.ndarray]:
    """N-grams of each class, by their share of the class's units."""
    roman = [k for k, b in enumerate(labels.tolist()) if b in ROMANISED and any("а" <= ch <= "я" for ch in units[k])]
    units = units + [romanise(units[k]) for k in roman]
    labels = np.concatenate([labels, np.array([ROMANISED[int(labels[k])] for k in roman], np.int64)])
    sizes = np.bincount(labels, minlength=len(CLASSES))
    out: list[list[np.ndarray]] = [[] for _ in CLASSES]
    for n in GRAMS:  # one length at a time keeps the driver's memory low
        h, owner = gram_hashes(units, n)
        order = np.argsort(h)
        h, owner = h[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        grams = h[new]
        # once a unit: an n-gram and its unit as one number
        pairs = np.sort((np.cumsum(new) - 1) * len(units) + owner)
        first = np.ones(len(pairs), bool)
        first[1:] = pairs[1:] != pairs[:-1]
        at, owner = np.divmod(pairs[first], len(units))
        counts = np.bincount(at * len(CLASSES) + labels[owner], minlength=len(grams) * len(CLASSES)).reshape(-1, len(CLASSES))
        rates = np.where(counts >= np.where(sizes > 40, 2, 1), counts / np.maximum(1, sizes), 0).astype(np.float32)
        top = rates.max(1)
        for b in range(len(CLASSES)):
            out[b].append(grams[(rates[:, b] > 0) & (rates[:, b] >= share * top)])
    return [np.concatenate(x) for x in out]



def train(texts: list[str], labels: list[str], model: S.BoundaryModel, rounds: int = 3) -> MaskFilter:
    units, marks = [], []
    for text, label in zip(texts, labels):
        for a, b in S.chunk_units(model, text):
            units.append(text[a:b])
            marks.append(LANGUAGES.index(label))
    marks = np.array(marks, np.int64)
    found = MaskFilter(_members(units, marks, SHARE_FIRST)) if units else MaskFilter([np.zeros(0, np.uint64)] * len(CLASSES))
    for _ in range(rounds - 1):
        if not units:
            break
        parts = [found.counts(units[k : k + 5000]) for k in range(0, len(units), 5000)]
        counts, n = merged(np.concatenate([p[0] for p in parts])), np.concatenate([p[1] for p in parts])
        best = counts.argmax(1)
        ranked = np.sort(counts, 1)
        sure = (ranked[:, -1] > 1.15 * ranked[:, -2] + 2) & (n > 20)
        keep = [u for u, s in zip(units, sure) if s]
        if not keep:
            break
        found = MaskFilter(_members(keep, best[sure]))
    return found


def fit(chunks: DataFrame, model: S.BoundaryModel, per_label: int = PER_LABEL) -> MaskFilter:
    """Train on at most ``per_label`` texts of each of the ten languages, chosen by hash."""
    forms = F.create_map(*[F.lit(x) for pair in CANON.items() for x in pair])
    low = F.lower(F.trim("lang"))
    label = F.coalesce(F.element_at(forms, low), F.element_at(forms, F.split(F.regexp_replace(low, "_", "-"), "-")[0]))
    rows = chunks.filter("lang is not null and text is not null").select("text", label.alias("label")).filter("label is not null")
    texts, labels = [], []
    found = samples(rows, per_label, "label", "text")
    for lang in LANGUAGES:
        for r in found.get(lang, []):
            texts.append(r["text"])
            labels.append(lang)
    return train(texts, labels, model)


def label_units(found: MaskFilter, groups: list[list[str]]) -> list[list[tuple[str, float]]]:
    """(language, confidence) of each unit of each group of neighbouring units."""
    flat = [u for g in groups for u in g]
    if not flat:
        return [[] for _ in groups]
    counts, n, letters = found.counts(flat)
    counts, weak = merged(counts), letters < MIN_LETTERS
    sizes = np.array([len(g) for g in groups])
    own = np.repeat(np.arange(len(groups)), sizes)
    # a group's main language is told by its units with letters, or by all where none has enough
    told = np.bincount(own, weights=~weak, minlength=len(groups)) > 0
    used = ~weak | ~told[own]
    total = np.stack([np.bincount(own, weights=counts[:, k] * used, minlength=len(groups)) for k in range(counts.shape[1])], 1)
    main, rows = total.argmax(1)[own], np.arange(len(flat))
    best = counts.argmax(1)
    # what tells the languages apart must not be a few n-grams; else the neighbours' language holds
    best = np.where(weak | (counts[rows, best] - counts[rows, main] < np.maximum(3.0, 0.06 * n)), main, best)
    high = counts[rows, best]
    rest = counts.copy()
    rest[rows, best] = -1.0
    top = high + rest.max(1)
    sure = np.round(np.where(top > 0, high / np.where(top > 0, top, 1.0), 0.0), 4)
    marks = [(LANGUAGES[k], c) for k, c in zip(best.tolist(), sure.tolist())]
    ends = np.cumsum(sizes).tolist()
    return [marks[e - k : e] for e, k in zip(ends, sizes.tolist())]


def languages(chunks: DataFrame, model: S.BoundaryModel | None = None, found: MaskFilter | None = None) -> DataFrame:
    """One row per distinct chunk_id: chunk_id, declared (canonical label), lang and confidence of the whole text, and
    runs: array of (start_char, end_char, lang, confidence), maximal runs of body sentences in one language.

    Null ids and null texts give no row; a text without a body has no runs and takes its title's language; a text
    without letters has a null lang and confidence 0.
    """
    model = model or S.fit(chunks, None)
    found = found or fit(chunks, model)
    shared = chunks.sparkSession.sparkContext.broadcast((model, found))
    one = chunks.filter("chunk_id is not null and text is not null").groupBy("chunk_id").agg(F.max(F.struct("text", "lang")).alias("t")).select("chunk_id", "t.*")

    def run(batches):
        m, f = shared.value
        for pdf in batches:
            spans, groups = [], []
            for text in pdf.text:
                body = S.body_units(m, text)
                spans.append(body)
                groups.append([text[a:b] for a, b in body] if body else ([text.strip()] if text.strip() else []))
            rows = []
            for rec, label, text, body, units, marks in zip(pdf.chunk_id, pdf.lang, pdf.text, spans, groups, label_units(f, groups)):
                runs, weight, sure = [], {}, {}
                for (lang, conf), u in zip(marks, units):
                    weight[lang] = weight.get(lang, 0) + len(u)
                    sure[lang] = sure.get(lang, 0.0) + conf * len(u)
                for (a, b), (lang, conf) in zip(body, marks):
                    if runs and runs[-1][2] == lang:
                        runs[-1][3] = (runs[-1][3] * (runs[-1][1] - runs[-1][0]) + conf * (b - a)) / (b - runs[-1][0])
                        runs[-1][1] = b
                    else:
                        runs.append([a, b, lang, conf])
                main = max(weight, key=weight.get) if weight and any(ch.isalpha() for ch in text) else None
                total = round(sure[main] / sum(weight.values()), 4) if main else 0.0
                rows.append((rec, canonical(label if isinstance(label, str) else None), main, total, [{"start_char": a, "end_char": b, "lang": g, "confidence": round(c, 4)} for a, b, g, c in runs]))
            yield pd.DataFrame(rows, columns=["chunk_id", "declared", "lang", "confidence", "runs"])

    return one.mapInPandas(run, "chunk_id string, declared string, lang string, confidence double, runs array<struct<start_char:int,end_char:int,lang:string,confidence:double>>")


def wrong_labels(labelled: DataFrame) -> DataFrame:
    """(chunk_id, lang): the languages of whole body sentences of chunks whose label is missing, names another language
    than the text's, or whose body has sentences in several languages."""
    found = F.array_distinct(F.transform("runs", lambda r: r["lang"]))
    case = F.col("declared").isNull() | (F.size("langs") > 1) | (F.col("declared") != F.col("langs")[0])
    return labelled.select("chunk_id", "declared", found.alias("langs")).filter(F.size("langs") > 0).filter(case).select("chunk_id", F.explode("langs").alias("lang"))
