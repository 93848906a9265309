"""Problem 9: passages of held-out test items inside documents.

The normalised word n-grams of the test passages form a hash set which is broadcast; document words are mapped to
the passages' vocabulary and rolled through the same hash, so a document costs one dictionary look-up a word and
vector arithmetic. Documents with a hit are verified by aligning their words with the passage.

With errors in at most one of eight words, a repeat of 15 or more words holds an unbroken run of at least five:
L words with e <= L/8 errors leave a run of ceil((L-e)/(e+1)), which is smallest, five, for L = 16. Seeds of four
words therefore miss none. Such a repeat holds at least L-4e-3 seeds, hence five or more (L = 16, e = 2); passages with
fewer hits in a document are not aligned.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

SEED = 4
MIN_WORDS = 15
ONE_ERROR_IN = 8
MIN_SEEDS = 5
BLOCK_CHARS = 8_000_000  # characters of passages in one broadcast hash set

_BREAK = re.compile(r"(?<=\w)[-‐‑¬­][ \t]*\r?\n\s*(?=\w)")
_DROP = re.compile(r"[­​‌⁠]|(?<=\w)[-‐‑¬'’ʼ](?=\w)")
_WORD = re.compile(r"[^\W_]+")


_HYPHENS = re.compile(r"(?<=\w)[-‐‑¬\u00ad][ \t]*\r?\n\s*(?=\w)|[\u00ad\u200b\u200c\u2060]|(?<=\w)[-‐‑¬'’ʼ](?=\w)")


def normal_words(text: str) -> list[str]:
    """Lower-case words; hyphens, soft hyphens and apostrophes inside a word, also at a line end, are dropped."""
    text = text.lower()
    if "\n" in text:
        text = _BREAK.sub("", text)
    return _WORD.findall(_DROP.sub("", text))


def word_spans(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end) of the same words in the text as it stands."""
    low, origin = text.lower(), None
    if len(low) != len(text):  # few letters have two in lower case
        origin = [k for k, ch in enumerate(text) for _ in ch.lower()] + [len(text)]
        low = "".join(ch.lower() for ch in text)
    out: list[tuple[str, int, int]] = []
    joined = {m.start(): m.end() for m in _HYPHENS.finditer(low)}
    last = -1
    for m in _WORD.finditer(low):
        a, b = m.span()
        at = last
        while at in joined:
            at = joined[at]
        if out and at == a and a > last:
            out[-1] = (out[-1][0] + m.group(), out[-1][1], b)
        else:
            out.append((m.group(), a, b))
        last = b
    return out if origin is None else [(w, origin[a], origin[b - 1] + 1) for w, a, b in out]


def _roll(ids: np.ndarray, n: int) -> np.ndarray:
    h = np.zeros(len(ids) - n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[k : len(ids) - n + 1 + k].astype(np.uint64)
        h ^= h >> np.uint64(29)
    return h


def _spans(width: np.ndarray, most: int):
    """(low, high): cuts of an array into pieces whose widths sum to about ``most``."""
    if len(width):
        piece = np.cumsum(width) // most
        cuts = np.flatnonzero(np.diff(piece)) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(width)])


class PassageIndex:
    """Vocabulary and n-gram hash set of a bounded block of passages."""

    def __init__(self, items: list[tuple[int, str]], seed: int = SEED):
        self.seed = seed
        self.items = [(i, normal_words(p)) for i, p in items]
        self.vocabulary: dict[str, int] = {}
        for _, words in self.items:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for k, (_, words) in enumerate(self.items):
            ids = np.array([self.vocabulary[w] for w in words], np.int64)
            if len(ids) >= max(seed, MIN_WORDS):
                h = np.unique(_roll(ids, seed))
                hashes.append(h)
                owners.append(np.full(len(h), k))
        h, own = np.concatenate(hashes), np.concatenate(owners)
        order = np.lexsort((own, h))
        # the passages of a hash are owners[starts[i] : starts[i + 1]]
        self.owners = own[order]
        self.hashes, starts = np.unique(h[order], return_index=True)
        self.starts = np.append(starts, len(h))

    def hits(self, texts: list[str]) -> dict[tuple[int, int], list[int]]:
        """(text no., passage no.) -> word positions of seeds, for the pairs with MIN_SEEDS of them or more."""
        get, ids, starts = self.vocabulary.get, [], [0]
        for t in texts:
            ids += [get(w, 0) for w in normal_words(t)] if t else []
            ids.append(0)
            starts.append(len(ids))
        out: dict[tuple[int, int], list[int]] = {}
        if len(ids) < self.seed or not len(self.hashes):
            return out
        arr, begins = np.array(ids, np.int64), np.array(starts)
        full = np.flatnonzero(np.convolve(arr > 0, np.ones(self.seed, int), "valid") == self.seed)
        if not len(full):
            return out
        h = _roll(arr, self.seed)[full]
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        hit = self.hashes[at] == h
        pos, at = full[hit], at[hit]
        doc = np.searchsorted(begins, pos, "right") - 1
        # a gram that many passages hold: count pairs by blocks of hits, so that no block outgrows a few million pairs
        width = self.starts[at + 1] - self.starts[at]
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for lo, hi in _spans(width, 2_000_000):
            pair = self._pairs(at[lo:hi], doc[lo:hi])[0]
            new, k = np.unique(np.concatenate([keys, pair]), return_inverse=True)
            counts = np.bincount(k, weights=np.concatenate([counts, np.ones(len(pair))]), minlength=len(new))
            keys = new
        keys = keys[counts >= MIN_SEEDS]
        for lo, hi in _spans(width, 2_000_000):
            pair, which = self._pairs(at[lo:hi], doc[lo:hi])
            wanted = np.isin(pair, keys)
            for key, p in zip(pair[wanted].tolist(), pos[lo:hi][which[wanted]].tolist()):
                d, k = divmod(key, len(self.items))
                out.setdefault((d, k), []).append(p - starts[d])
        return out

    def _pairs(self, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text no. * passages + passage no., number of the hit) of every passage of every hit."""
        width = self.starts[at + 1] - self.starts[at]
        which = np.repeat(np.arange(len(at)), width)
        first = np.repeat(self.starts[at] - np.concatenate([[0], np.cumsum(width)[:-1]]), width) if len(at) else np.zeros(0, np.int64)
        return doc[which] * len(self.items) + self.owners[np.arange(len(which)) + first], which

    def verify(self, words: list[str], k: int, seeds: list[int]) -> tuple[int, int, int, int] | None:
        """(words repeated, errors, first word, end word) of the best repeat of passage k near the seeds, or None."""
        passage, best = self.items[k][1], None
        reach, groups = len(passage) + 8, []
        for s in sorted(seeds):
            if groups and s - groups[-1][1] <= reach:
                groups[-1][1] = s
            else:
                groups.append([s, s])
        for lo, hi in groups:
            a, b = max(0, lo - reach), min(len(words), hi + reach)
            blocks = [x for x in SequenceMatcher(None, passage, words[a:b], False).get_matching_blocks() if x.size]
            for i in range(len(blocks)):
                matched = 0
                for j in range(i, len(blocks)):
                    if j > i:
                        gap_p = blocks[j].a - blocks[j - 1].a - blocks[j - 1].size
                        gap_d = blocks[j].b - blocks[j - 1].b - blocks[j - 1].size
                        if gap_d > gap_p + 3:  # other text in between
                            break
                    matched += blocks[j].size
                    length = blocks[j].a + blocks[j].size - blocks[i].a
                    errors = length - matched
                    if length >= MIN_WORDS and errors * ONE_ERROR_IN <= length and (best is None or length - errors > best[0] - best[1]):
                        best = (length, errors, a + blocks[i].b, a + blocks[j].b + blocks[j].size)
        return best


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, words, errors, start_char, end_char): each document with each passage it repeats, and where the
    longest repeat stands in the text (code points, end exclusive).

    Null, empty or short texts and passages repeat nothing; rows without an id are left out; repeated documents count
    each, an item given twice counts once. The passages are broadcast in blocks of at most BLOCK_CHARS characters (a
    single longer passage is a block of its own), one scan a block.
    """
    given = items.filter("item_id is not null and passage is not null").select("item_id", "passage").distinct()
    total = given.agg(F.sum(F.length("passage"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_CHARS))
    schema = "doc_id long, item_id long, words int, errors int, start_char int, end_char int"
    docs, out = documents.filter("doc_id is not null and text is not null").select("doc_id", "text"), None
    for b in range(blocks):
        rows = given.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "passage").collect()
        index = documents.sparkSession.sparkContext.broadcast(PassageIndex([(r["item_id"], r["passage"]) for r in rows]))

        def scan(batches, index=index):
            for pdf in batches:
                texts, ids, found = pdf.text.tolist(), pdf.doc_id.tolist(), []
                hits = index.value.hits(texts)
                words = {d: normal_words(texts[d]) for d in {d for d, _ in hits}}
                spans = {}
                for (d, k), seeds in hits.items():
                    best = index.value.verify(words[d], k, seeds)
                    if best:
                        if d not in spans:
                            spans[d] = word_spans(texts[d])
                        found.append((ids[d], index.value.items[k][0], best[0], best[1], spans[d][best[2]][1], spans[d][best[3] - 1][2]))
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "words", "errors", "start_char", "end_char"])

        part = docs.mapInPandas(scan, schema)
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(documents: DataFrame, found: DataFrame, whole: bool = False) -> DataFrame:
    """``documents`` without the repeats of ``found`` (leaks): their spans are cut out of the text, or with ``whole`` the
    documents are left out. Spans that overlap are cut once; all other rows and columns stay as they are. A document whose
    id is given several times loses the same spans in each row."""
    if whole:
        return documents.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*documents.columns)
    spans = found.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start_char", "end_char"))).alias("_spans"))
    none = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def step(acc, s):
        kept = F.when(s["start_char"] > acc["at"], F.concat(acc["text"], F.col("text").substr(acc["at"] + 1, s["start_char"] - acc["at"]))).otherwise(acc["text"])
        return F.struct(kept.alias("text"), F.greatest(acc["at"], s["end_char"]).alias("at"))

    folded = F.aggregate("_spans", none, step, lambda acc: F.concat(acc["text"], F.col("text").substr(acc["at"] + 1, F.length("text"))))
    joined = documents.join(spans, "doc_id", "left")
    return joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(folded)).select(*documents.columns)
