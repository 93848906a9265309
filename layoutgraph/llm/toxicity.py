"""Problem 10: abusive, hateful and sexual content, by non-negative positive-unlabelled learning.

One linear classifier a category, in numpy, over hashed letter n-grams of sentences. Confirmed examples are sentences of
documents a rater gave the category; the sentences of documents rated clean, among which some positives were overlooked,
stand for unlabelled text, and the risk on them is corrected by the share of positives and kept from turning negative.
Both come from a bounded sample of rated documents. Which sentence of a confirmed document is meant isn't known, and
raters err: the first round picks sentences by how rare their letters are in the whole corpus (counted over all
documents) and by how much oftener confirmed documents hold them; the second adds what the classifier finds in them.

Letters are compared by skeleton: case, accents, doubled letters, signs and blanks between letters, digits and letters
of other scripts that look alike are folded before n-grams are taken, so masked spellings meet their plain forms.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from layoutgraph.plans.bounded import sample

CATEGORIES = ("abusive", "hateful", "sexual")
BITS = 18  # cells of the classifier
CORPUS_BITS = 20  # cells of the corpus table
PICK_BITS = 22  # cells of the tables that picks are made by
MIN_GRAMS = 16  # shorter units are scaled as if they had as many
MAX_LABELLED = 8_000  # rated documents the classifiers are trained on, chosen by hash
MAX_CHARS = 16_000_000  # and their characters, on average
UNLABELLED = 12_000  # sentences of documents rated clean, half of them from the novel layer, weighted back to its share
STEPS, ROUNDS = 45, 2
RARE, FEW = 0.002, 5.0  # a 4-gram met fewer times than this share of the documents, or fewer times than this, is rare
NOVEL = 0.98  # quantile of novelty beyond which a sentence may be what a document was rated for
LIFT = 8.0  # least lift of a novel sentence
SUPPORT, SURE = 3.0, 20.0  # documents and lift that tell without novelty
PRIOR = 3.0  # positives among the unlabelled for each picked one
FOUND = 0.3  # probability at which a later round picks
RIVAL = 2.0  # weight of a sentence picked for another category
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]

#: Letters of other scripts, digits and signs that look like a letter.
_ALIKE = {
    "a": "аα@4", "b": "вβ8", "c": "сç", "e": "еёэ3зєε", "h": "нһ", "i": "ilіїι1!|lιíì", "k": "кκ", "m": "мμ", "o": "оο0ø", "p": "рρ", "s": "ѕ5$", "t": "тτ", "u": "иuцμ", "x": "хχ", "y": "уγ", "n": "п",
}
_SPLIT = re.compile(r"(?<=[.!?…।。！？])[\"»”“’)\]」』]*(?:\s+(?=[^\sa-zа-яё]|[a-z][A-Z])|(?<=[。！？」]))|\n+")

#: Abbreviations of three letters or more after which a sentence goes on.
_ABBREVIATIONS = "fig figs sec app dev approx resp etc vol prof abb kap bzw vgl tab env chap tabl cap pág aprox откл прим рис табл прил тыс руб млн млрд акад проф напр розд див пор грн"
_SHORT = re.compile(rf"(?<![\w#*.@$-])(?:[^\W\d_]{{1,2}}|{'|'.join(_ABBREVIATIONS.split())})\.$", re.I)
_SPACED = re.compile(r"(?:[\s.-][^\W\d_]){2}\.$")  # a word written letter by letter


def _table() -> np.ndarray:
    """Code point -> folded code point, 0 for what is dropped; letters and digits of the basic plane."""
    table = np.zeros(0x10000, np.uint16)
    for o in range(0x10000):
        ch = chr(o)
        if ch.isalpha() or 0x900 <= o < 0xE80:
            base = unicodedata.normalize("NFD", ch.lower())[0]
            table[o] = ord(base) if ord(base) < 0x10000 else 0
    for letter, group in _ALIKE.items():
        for ch in group:
            table[ord(ch)] = ord(letter)
            if ch.upper() != ch and len(ch.upper()) == 1:
                table[ord(ch.upper())] = ord(letter)
    table[ord("l")] = table[ord("L")] = ord("i")
    return table


_TABLE: np.ndarray | None = None


def sentences_of(text: str | None) -> list[str]:
    """Pieces of a text, about a sentence each; a piece that ends in a short word with a full stop goes on."""
    out: list[str] = []
    glue = False
    for s in _SPLIT.split(text) if text else []:
        if s and not s.isspace():
            if glue:
                out[-1] += " " + s
            else:
                out.append(s)
            glue = _SHORT.search(s) is not None and _SPACED.search(s) is None and len(out[-1]) < 600
    return out


def grams(units: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """For each of GRAMS: (hash of every n-gram, number of its unit), in the order of units. Four folded letters fill 64
    bits; a 7-gram is the 4-gram at its start mixed with the one three letters on."""
    global _TABLE
    if _TABLE is None:
        _TABLE = _table()
    lengths = np.array([len(u) for u in units], np.int64)
    points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(units), dtype=np.int32), lengths)
    folded = np.where(points < 0x10000, _TABLE[np.minimum(points, 0xFFFF)], 0)
    keep = folded > 0
    folded, owner = folded[keep].astype(np.uint64), owner[keep]
    if len(folded):
        fresh = np.ones(len(folded), bool)
        fresh[1:] = (folded[1:] != folded[:-1]) | (owner[1:] != owner[:-1])
        folded, owner = folded[fresh], owner[fresh]
    if len(folded) < 4:
        none = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        return none, none
    two = (folded[:-1] << np.uint64(16)) | folded[1:]
    four = ((two[:-2] << np.uint64(32)) | two[2:]) * _MIX[0]
    four ^= four >> np.uint64(29)
    four *= _MIX[1]
    inside = owner[: len(four)] == owner[3:]
    seven = (four[:-3] ^ (four[3:] >> np.uint64(7))) * _MIX[2]
    whole = owner[: len(seven)] == owner[len(owner) - len(seven) :]
    return (four[inside], owner[: len(four)][inside]), (seven[whole], owner[: len(seven)][whole])


def _cells(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int32)


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by owner; owners are in order."""
    out = np.zeros((n, *values.shape[1:]))
    if len(owner):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        out[owner[starts]] = np.add.reduceat(values, starts, axis=0)
    return out


def gram_counts(texts: list[str]) -> np.ndarray:
    """How often each cell of the corpus table is met by a 4-gram of the texts."""
    return np.bincount(_cells(grams(texts)[0][0], CORPUS_BITS), minlength=1 << CORPUS_BITS)


def rare_below(documents: int) -> float:
    return max(FEW, RARE * documents)


class Background:
    """Which 4-grams are rare in the corpus: see rare_below. Fixed size."""

    def __init__(self, counts: np.ndarray, documents: int):
        self.rare = counts < rare_below(documents)

    def novelty(self, units: list[str]) -> np.ndarray:
        """Share of rare 4-grams in each unit; a short unit counts as one of MIN_GRAMS."""
        h, owner = grams(units)[0]
        n = np.bincount(owner, minlength=len(units))
        return np.bincount(owner, weights=self.rare[_cells(h, CORPUS_BITS)], minlength=len(units)) / np.maximum(n, MIN_GRAMS)


class Rows:
    """Units as sparse rows, each scaled to unit length."""

    def __init__(self, units: list[str]):
        parts = grams(units)
        owner = np.concatenate([p[1] for p in parts])
        order = np.argsort(owner, kind="stable")
        self.n, self.owner = len(units), owner[order]
        self.index = np.concatenate([_cells(p[0], BITS) for p in parts])[order]
        self.scale = 1 / np.sqrt(np.maximum(np.bincount(self.owner, minlength=self.n), MIN_GRAMS))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return _sums(w[self.index], self.owner, self.n) * self.scale

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, weights=(g * self.scale)[self.owner], minlength=1 << BITS)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_nnpu(positive: Rows, unlabelled: Rows, prior: float, weight: np.ndarray | None = None, steps: int = STEPS, rate: float = 0.2, decay: float = 1e-6) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the PU risk prior*R+(P) + R-(U) - prior*R-(P) under the logistic loss, by Adam over
    all rows, averaged over the second half of the steps. ``weight``: the unlabelled rows' shares of the population.
    Where the corrected part R-(U) - prior*R-(P) would turn negative, which only overfitting can do, the correction is
    left out of that step, so the risk stays non-negative."""
    share = np.full(unlabelled.n, 1 / max(1, unlabelled.n)) if weight is None else weight / weight.sum()
    w, b = np.zeros(1 << BITS), -3.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    mean_w, mean_b, kept = np.zeros_like(w), 0.0, 0
    for t in range(1, steps + 1):
        zp, zu = positive.dot(w) + b, unlabelled.dot(w) + b
        sp, su = _sigmoid(zp), _sigmoid(zu)
        corrected = (share * np.logaddexp(0, zu)).sum() - prior * np.logaddexp(0, zp).mean()
        gp = -prior * (1 - sp) / max(1, positive.n)
        if corrected >= 0:
            gp = gp - prior * sp / max(1, positive.n)
        gu = su * share
        grad = positive.back(gp) + unlabelled.back(gu) + decay * w
        gb = gp.sum() + gu.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
        b -= rate * 0.1 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-7)
        if t > steps // 2:
            mean_w += w
            mean_b += b
            kept += 1
    return mean_w / max(1, kept), mean_b / max(1, kept)


class Classifier:
    """Weights of the three categories; size fixed by BITS."""

    def __init__(self):
        self.w = np.zeros((1 << BITS, len(CATEGORIES)), np.float32)
        self.b = np.full(len(CATEGORIES), -5.0)

    def score(self, units: list[str]) -> np.ndarray:
        """(units x categories) probabilities."""
        total, n = np.zeros((len(units), len(CATEGORIES))), np.zeros(len(units))
        for h, owner in grams(units) if units else ():
            total += _sums(self.w[_cells(h, BITS)], owner, len(units))
            n += np.bincount(owner, minlength=len(units))
        return _sigmoid(total / np.sqrt(np.maximum(n, MIN_GRAMS))[:, None] + self.b)


def _chunks(doc: np.ndarray, size: int = 20_000):
    """Slices of units, each of whole documents; ``doc`` is in order."""
    at = 0
    while at < len(doc):
        end = min(len(doc), at + size)
        while end < len(doc) and doc[end] == doc[end - 1]:
            end += 1
        yield slice(at, end)
        at = end


def pick_sentences(units: list[str], doc: np.ndarray, rated: np.ndarray, novelty: np.ndarray) -> list[np.ndarray]:
    """For each category the sentences that confirmed documents were most likely rated for.

    ``doc``: number of each unit's document, in order; ``rated``: (documents x categories). A sentence's lift is the mean
    over its 7-grams of how much oftener documents of the category hold them than documents without any. Of each
    document that bears the category, one sentence is picked: the one of highest lift among those whose 7-grams are
    known from SUPPORT documents of the category on average and whose lift is SURE or more, else the most novel one, if
    its novelty is beyond the NOVEL quantile and its lift LIFT or more. Others were rated wrongly."""
    clean = ~rated.any(1)
    kinds = [*rated.T, clean]
    held = np.zeros((len(kinds), 1 << PICK_BITS), np.float32)
    for part in _chunks(doc):
        h, owner = grams(units[part])[1]
        key = np.unique(_cells(h, PICK_BITS).astype(np.int64) * len(rated) + doc[part][owner])
        cells, docs = key // len(rated), key % len(rated)
        for k, members in enumerate(kinds):
            np.add.at(held[k], cells[members[docs]], 1)
    base = (held[-1] + 0.5) / max(1, clean.sum())
    lift, support = np.zeros((len(units), rated.shape[1])), np.zeros((len(units), rated.shape[1]))
    for part in _chunks(doc):
        h, owner = grams(units[part])[1]
        cell = _cells(h, PICK_BITS)
        n = np.maximum(np.bincount(owner, minlength=len(units[part])), 1)
        for c in range(rated.shape[1]):
            own = held[c][cell]
            ratio = np.log(np.maximum(own / max(1, rated[:, c].sum()), 1e-6) / base[cell])
            lift[part, c] = np.bincount(owner, weights=ratio, minlength=len(n)) / n
            support[part, c] = np.bincount(owner, weights=own, minlength=len(n)) / n
    least = max(np.quantile(novelty, NOVEL), 1e-9) if len(novelty) else 1.0
    found = []
    for c in range(rated.shape[1]):
        known = (support[:, c] >= SUPPORT) & (lift[:, c] >= np.log(SURE))
        of = np.flatnonzero(rated[doc, c] & (known | ((novelty >= least) & (lift[:, c] >= np.log(LIFT)))))
        of = of[np.lexsort((of, -np.where(known[of], lift[of, c], novelty[of]), ~known[of], doc[of]))]
        found.append(of[np.concatenate([[True], doc[of][1:] != doc[of][:-1]])] if len(of) else of)
    return found


def train(rated: list[tuple[str, set[str]]], background: Background | None = None, seed: int = 5) -> Classifier:
    """``rated``: (text, labels of its raters). The unlabelled part of the risk are the sentences of documents rated clean,
    in two layers, novel ones and others, each sampled and weighted back to its share. The prior of a category is PRIOR
    times the share of its picked sentences, as raters overlook some."""
    model = Classifier()
    if not rated:
        return model
    background = background or Background(gram_counts([t for t, _ in rated]), len(rated))
    rng = np.random.default_rng(seed)
    units, doc = [], []
    for k, (text, _) in enumerate(rated):
        found = sentences_of(text)
        units += found
        doc += [k] * len(found)
    if not units:
        return model
    doc_of = np.array(doc, np.int64)
    marks = np.array([[c in labels for c in CATEGORIES] for _, labels in rated])
    novelty = np.concatenate([background.novelty(units[i : i + 20_000]) for i in range(0, len(units), 20_000)])
    picked = pick_sentences(units, doc_of, marks, novelty)
    novel = novelty >= np.quantile(novelty, NOVEL)
    calm = ~marks.any(1)[doc_of]
    chosen, weight = [], []
    for layer in (np.flatnonzero(calm & novel), np.flatnonzero(calm & ~novel)):
        part = rng.choice(layer, min(len(layer), UNLABELLED // 2), replace=False) if len(layer) else layer
        chosen.append(part)
        weight.append(np.full(len(part), len(layer) / max(1, len(part))))
    pool, share = np.concatenate(chosen), np.concatenate(weight)
    rows = Rows([units[i] for i in pool])
    for r in range(ROUNDS):
        if r:  # what the classifier of the round before finds in documents that bear the category
            near = np.flatnonzero(marks[doc_of].any(1))
            p = model.score([units[i] for i in near])
            best = (p >= p.max(1, keepdims=True)) & (p >= FOUND) & marks[doc_of[near]]
            picked = [np.union1d(old, near[best[:, c]]) for c, old in enumerate(picked)]
        for c in range(len(CATEGORIES)):
            if len(picked[c]):
                rival = np.setdiff1d(np.concatenate([picked[o] for o in range(len(CATEGORIES)) if o != c]), picked[c])
                mine = Rows([units[i] for i in picked[c]])
                others = rows if not len(rival) else Rows([units[i] for i in np.concatenate([pool, rival])])
                prior = min(0.2, max(0.004, PRIOR * len(picked[c]) / len(units)))
                model.w[:, c], model.b[c] = fit_nnpu(mine, others, prior, np.concatenate([share, np.full(len(rival), RIVAL)]))
    return model


def corpus(documents: DataFrame) -> Background:
    """Rare 4-grams, counted over all documents; at most 2^CORPUS_BITS sums reach the driver."""

    def count(batches):
        total = np.zeros(1 << CORPUS_BITS, np.int64)
        for pdf in batches:
            total += gram_counts(pdf.text.tolist())
        at = np.flatnonzero(total)
        yield pd.DataFrame({"cell": at.astype(np.int32), "n": total[at]})

    texts = documents.filter("text is not null")
    sums = texts.select("text").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    # only whether a cell is rare matters, so no more than the frequent ones are sent
    n = texts.count()
    frequent = sums.filter(F.col("n") >= rare_below(n)).select("cell").toPandas()
    counts = np.zeros(1 << CORPUS_BITS)
    counts[frequent["cell"].to_numpy(np.int64)] = rare_below(n)
    return Background(counts, n)


def fit(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Classifier:
    """Train on at most ``max_labelled`` rated documents, up to half of them rated positive, and fewer where they are long:
    what reaches the driver is bounded by MAX_CHARS too."""
    given = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.collect_set("label").alias("labels"))
    texts = documents.filter("text is not null and doc_id is not null").select("doc_id", "text")
    positive = F.arrays_overlap("labels", F.array(*[F.lit(c) for c in CATEGORIES]))
    joined = texts.join(given, "doc_id").withColumn("positive", positive)
    mean = joined.agg(F.avg(F.length("text"))).first()[0] or 1.0
    limit = max(1, min(max_labelled, int(MAX_CHARS / max(mean, 1.0))))
    best = sample(joined.filter("positive"), limit // 2, "doc_id")
    rated = [(r["text"], set(r["labels"])) for r in best + sample(joined.filter("not positive"), limit - len(best), "doc_id")]
    return train(rated, corpus(documents)) if rated else Classifier()


def scores(documents: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, source and, for each category, the highest probability of a sentence (of which no other category is
    likelier). Null, empty and very long texts are scored alike, sentence by sentence; a null text scores 0."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for pdf in batches:
            units, owner = [], []
            for k, text in enumerate(pdf.text):
                s = sentences_of(text)
                units += s
                owner += [k] * len(s)
            best = np.zeros((len(pdf), len(CATEGORIES)))
            if units:
                p = m.score(units)
                p = np.where(p >= p.max(1, keepdims=True), p, 0.0)
                np.maximum.at(best, np.array(owner), p)
            yield pd.DataFrame({"doc_id": pdf.doc_id, "source": pdf.source, **{name: best[:, c].round(4) for c, name in enumerate(CATEGORIES)}})

    return documents.select("doc_id", "source", "text").mapInPandas(run, "doc_id long, source string, " + ", ".join(f"{c} double" for c in CATEGORIES))


def flagged(scored: DataFrame, threshold: float = 0.4) -> DataFrame:
    """(doc_id, category) of every document with a sentence above the threshold."""
    found = F.filter(F.array(*[F.when(F.col(c) >= threshold, F.lit(c)) for c in CATEGORIES]), lambda x: x.isNotNull())
    return scored.filter("doc_id is not null").select("doc_id", F.explode(found).alias("category")).distinct()


def rates(scored: DataFrame, threshold: float = 0.4) -> DataFrame:
    """Per source and category: documents, how many are flagged, and the rate. A null source is a source of its own."""
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("category"), (F.col(c) >= threshold).cast("long").alias("hit")) for c in CATEGORIES]))
    counted = scored.select("source", kinds.alias("k")).groupBy("source", "k.category").agg(F.count(F.lit(1)).alias("documents"), F.sum("k.hit").alias("flagged"))
    return counted.withColumn("rate", F.round(F.col("flagged") / F.col("documents"), 6))
