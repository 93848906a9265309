"""Problem 4: sentence boundaries in any script, by a hidden-event n-gram language model.

Boundary events are hidden tokens between words. The model holds P(event | two words before) and P(next word |
event), each interpolated down to word shapes. It is trained here without labels, by expectation maximisation on counts
over all texts: every place is brought to its key (the words around it; places one word apart form one key), keys are
counted once over the whole corpus, and each round reads the counts. Ends and starts of texts are certain boundaries,
every other place gets its forward-backward posterior as a fractional count. The model is a table of CELLS hashed
counts, so its size doesn't follow the corpus.

Places are those after sentence-final punctuation, and in text without such punctuation (Thai) after blanks. A stretch of
LONG words or more without any final sign is unpunctuated: there every gap between words (characters, in scripts without
blanks) is a place, judged by how often the word before ends and the word after starts a unit in the corpus. Places inside
matched quotation marks or brackets are none, so a quoted remark stays in its sentence. A word is known by its last 40
characters on the left of a place and its first 24 on the right.
"""

from __future__ import annotations

import re
import struct
from collections import Counter
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from layoutgraph.plans.session import cut

#: Sentence-final signs, closing and paired signs, the Thai range.
_FINAL, _WIDE, _CLOSE, _THAI = ".!?…।॥", "。！？", "\"'»”“’)\\]}」』）】*_", "฀-๿"
_TIGHT = "\"'»”’)\\]}」』）】"  # what may close before a word without a blank; “ would open there
_PAIRS = {"«": "»", "„": "“”", "“": "”", "「": "」", "『": "』", "(": ")", "（": "）", "[": "]", "【": "】"}
_QUOTE = re.compile(r"[«»„“”「」『』()（）\[\]【】\"]")
# one set of signs in front lets the search skip to the next sign
_PLACES = rf"[{_FINAL}{_WIDE}](?:(?<=[{_FINAL}])[{_FINAL}]*[{_CLOSE}]*(?=\s)|(?<=[{_WIDE}])[{_WIDE}]*[{_TIGHT}]*|(?<=[^\W_]{{2}}[{_FINAL}])[{_FINAL}]*[{_TIGHT}]*(?=[^\W\d_a-zа-яёіїєґ]))"
_SPACED = re.compile(_PLACES)
_SPACED_THAI = re.compile(rf"{_PLACES}|(?<=\S)(?=\s+[{_THAI}])|(?<=\S)(?=\s+[^\W\d_a-zа-яёіїєґ]\w)")
_HAS_THAI = re.compile(f"[{_THAI}]")
_DIGITS = re.compile(r"\d+(?:[.,:]\d+)*")
_INITIALS = re.compile(r"^[\"«„“(]*(?:[^\W\d_]\.){1,3}$")
_TITLE_END = re.compile(r"\n[ \t]*\n")
_WIDE_CHAR = re.compile(r"[぀-ヿ㐀-鿿＀-￯]")
_UNSPACED = f"぀-ヿ㐀-鿿{_THAI}"
_GAP_TOKEN = re.compile(rf"[{_UNSPACED}][\u0e31\u0e34-\u0e3a\u0e47-\u0e4e]*|[^\s{_UNSPACED}]+")
_RUN = re.compile(rf"[{_UNSPACED}]{{2,}}")
_SIGNS = ".!?…।॥。！？,;:、，；：\"'»«”“„’()[]{}」「』『）（】【*_—–-"
_ANY_FINAL = re.compile(f"[{_FINAL}{_WIDE}]")

CELLS = 1 << 22  # hashed counts of the model
ROUNDS = 6
LONG = 60  # words (two characters of an unspaced script count as one) without a final sign
GAP = 0.9  # posterior asked for at a gap of an unpunctuated stretch
STRICT, SEEN = 0.98, 5.0  # where a blank alone would end a sentence: posterior asked for, and starts seen with the next word
RARE_END = 0.02  # there, the share of its occurrences in which the word before must end a unit


def quoted_spans(text: str, cut_start: bool = False, cut_end: bool = False) -> list[tuple[int, int]]:
    """Spans between matched quotation marks or brackets, outermost ones; unmatched signs open nothing, but where the
    text is cut off, a remark may have begun before it or end after it."""
    stack, spans = [], []
    for m in _QUOTE.finditer(text):
        c, i = m.group(), m.start()
        if c == '"':
            before = text[i - 1] if i else " "
            after = text[i + 1] if i + 1 < len(text) else " "
            opens = (before.isspace() or before in "([—–-*_") and not after.isspace()
            if not opens or (stack and stack[-1][0] == '"'):
                at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == '"'), None)
                if at is not None:
                    spans.append((stack[at][1], i))
                    del stack[at:]
                elif cut_start and not spans and not stack:
                    spans.append((-1, i))
                continue
            stack.append((c, i))
        else:
            at = next((k for k in range(len(stack) - 1, -1, -1) if c in _PAIRS.get(stack[k][0], "")), None)
            if at is not None:
                spans.append((stack[at][1], i))
                del stack[at:]
            elif c in _PAIRS:
                stack.append((c, i))
            elif cut_start and c in "»”」』" and not spans and not stack:
                spans.append((-1, i))
    if cut_end and stack and stack[0][0] in "«„“「『\"":
        spans.append((stack[0][1], len(text) + 1))
    spans.sort()
    outer: list[tuple[int, int]] = []
    for a, b in spans:
        if not outer or a > outer[-1][1]:
            outer.append((a, b))
    return outer


def _symbol(word: str) -> str:
    if "." in word and _INITIALS.match(word):
        return "<init>"
    return _DIGITS.sub("#", word)


def _shape(word: str) -> str:
    for ch in word:
        if ch.isalpha():
            o = ord(ch)
            script = "l" if o < 0x370 else "c" if o < 0x530 else "d" if 0x900 <= o < 0x980 else "t" if 0xE00 <= o < 0xE80 else "w"
            return script + ("U" if ch.isupper() else "l" if ch.islower() else "o")
        if ch.isdigit():
            return "#"
    return word[:1] or "$"


_MEMO = 1 << 16  # words of which the normal form is remembered


@lru_cache(_MEMO)
def _before(word: str) -> tuple[str, str | None]:
    """(word in front of a place, the piece before it where the script has no blanks)."""
    tail = word[-12:]
    if not tail.isascii() and (_WIDE_CHAR.search(tail) or _HAS_THAI.search(tail)):
        word = _DIGITS.sub("#", word)
        return word[-4:], word[-7:-4]
    return _symbol(word.lower()) if "." not in word or not _INITIALS.match(word) else "<init>", None


@lru_cache(_MEMO)
def _second(word: str) -> str:
    return _symbol(word).lower()


@lru_cache(_MEMO)
def _after(word: str) -> str:
    if not word.isascii() and (_WIDE_CHAR.search(word) or _HAS_THAI.match(word[0])):
        return _DIGITS.sub("#", word)[:4]
    return _symbol(word)


def _left(text: str, end: int, low: int) -> tuple[str, str, int]:
    """(word before, the one before it, start of the first) of a position; pieces of unspaced scripts stand for words."""
    parts = text[max(low, end - 160) : end].rsplit(None, 2)
    word = parts[-1][-40:] if parts else ""
    w1, w2 = _before(word)
    if w2 is None:
        w2 = _second(parts[-2][-24:]) if len(parts) > 1 else ""
    return w1, w2, end - len(word)


def _right(text: str, start: int) -> str:
    n = len(text)
    while start < n and text[start].isspace():
        start += 1
    word = text[start : start + 24].split(None, 1)
    return _after(word[0]) if word else ""


def candidates(text: str, low: int, high: int, cut_start: bool = False, cut_end: bool = False) -> list[tuple[int, str, str, str, bool]]:
    """Places in text[low:high] where a boundary may stand: (position, word before, word before that, word after,
    whether the place before it is one word away)."""
    pattern = _SPACED_THAI if not text.isascii() and _HAS_THAI.search(text) else _SPACED
    spans = quoted_spans(text[low:high], cut_start, cut_end) if _QUOTE.search(text, low, high) else []
    out, k, last = [], 0, -1
    for m in pattern.finditer(text, low, high):
        end = m.end()
        if end >= high:
            break
        while k < len(spans) and spans[k][1] + low < end - 1:
            k += 1
        if k < len(spans) and spans[k][0] + low < m.start() and end - 1 < spans[k][1] + low:
            continue
        w1, w2, at = _left(text, end, low)
        out.append((end, w1, w2, _right(text, end), last >= 0 and (at <= last or text[last:at].isspace())))
        last = end
    return out


def _ends(place) -> bool:
    """Whether a final sign or a script without such signs makes the place likely; bare blanks need a surer posterior."""
    return place[1].rstrip(_CLOSE)[-1:] in _FINAL + _WIDE or bool(_HAS_THAI.match(place[3])) or place[1] == "<init>"


def gap_word(piece: str, last: bool) -> str:
    """What a gap knows of the text beside it: the word without signs, in lower case, or two characters of an unspaced
    script."""
    word = piece.strip().strip(_SIGNS)
    if word and ("\u0e00" <= word[-1 if last else 0] < "\u0e80" or _WIDE_CHAR.match(word[-1 if last else 0])):
        return word[-2:] if last else word[:2]
    return _symbol(word).lower()


def _cell(key: str) -> int:
    return crc32(key.encode("utf-8", "surrogatepass")) & (CELLS - 1)


class Counts:
    """Weights of (no boundary, boundary) by hashed key, and their totals over words and over gaps."""

    def __init__(self):
        self.table = np.zeros((CELLS, 2), np.float32)
        self.total = np.zeros(4)  # next words without and with a boundary before; gaps, boundaries among them

    def add(self, cells: np.ndarray, no: np.ndarray | None, yes: np.ndarray | None) -> None:
        for k, n in enumerate((no, yes)):
            if n is not None:
                np.add.at(self.table[:, k], cells, n)

    def used(self) -> np.ndarray:
        """Cells that hold something."""
        return np.flatnonzero(self.table.view(np.uint64)).astype(np.int32)

    def __getstate__(self):
        at = self.used()
        return {"at": at, "values": self.table[at], "total": self.total}

    def __setstate__(self, state):
        self.table = np.zeros((CELLS, 2), np.float32)
        self.table[state["at"]] = state["values"]
        self.total = state["total"]


class BoundaryModel:
    """Interpolated n-gram counts with hidden boundary events."""

    def __init__(self, counts: Counts):
        self.counts = counts
        self.memo: dict[tuple[str, str, str], float] = {}

    def seen(self, nxt: str) -> float:
        """How often units start with the word."""
        return float(self.counts.table[_cell("n" + nxt), 1])

    def ends_unit(self, place: tuple[int, str, str, str, bool], p: float, threshold: float = 0.5) -> bool:
        """Whether a place of posterior ``p`` ends a unit. Where it is a blank alone, a surer posterior is asked for, the next
        word must have started units, and the word before, where it is one of a script with blanks, must end some."""
        if _ends(place):
            return p > threshold
        if p <= STRICT or self.seen(place[3]) < SEEN:
            return False
        every, ends = self.counts.table[_cell("e" + gap_word(place[1], True))].tolist()
        return bool(_HAS_THAI.search(place[1][-1:])) or ends >= RARE_END * every

    def odds_cells(self, c1, c2, c3, cn, cs) -> np.ndarray:
        """odds() by the cells of the histories, the next word and its shape."""
        table, total = self.counts.table, self.counts.total
        p = np.full(len(c1), 0.5)
        for c, k in ((c1, 2.0), (c2, 3.0), (c3, 3.0)):
            no, yes = table[c].astype(float).T
            p = np.where(no + yes > 0, (yes + k * p) / (no + yes + k), p)
        (n_shape, b_shape), (n_word, b_word) = table[cs].astype(float).T, table[cn].astype(float).T
        b = (b_word + 0.06 * ((b_shape + 0.1) / (total[1] + 2))) / (total[1] + 3)
        n = (n_word + 0.06 * ((n_shape + 0.1) / (total[0] + 2))) / (total[0] + 3)
        p = np.clip(p, 1e-4, 1 - 1e-4)
        return p * b / np.maximum((1 - p) * n, 1e-12)

    def odds(self, w1: str, w2: str, nxt: str) -> float:
        """P(boundary, next word | history) : P(no boundary, next word | history)."""
        key = (w1, w2, nxt)
        found = self.memo.get(key)
        if found is not None:
            return found
        table, total = self.counts.table, self.counts.total
        p = 0.5
        for history, k in ((f"1{w1[-2:]}", 2.0), (f"2{w1}", 3.0), (f"3{w2}\x1f{w1}", 3.0)):
            no, yes = table[_cell(history)].tolist()
            if no or yes:
                p = (yes + k * p) / (no + yes + k)
        n_shape, b_shape = table[_cell("s" + _shape(nxt))].tolist()
        n_word, b_word = table[_cell("n" + nxt)].tolist()
        word = 0.02  # share of a word within its shape, the same for both events
        b_shape, n_shape = (b_shape + 0.1) / (total[1] + 2), (n_shape + 0.1) / (total[0] + 2)
        b = (b_word + 3 * b_shape * word) / (total[1] + 3)
        n = (n_word + 3 * n_shape * word) / (total[0] + 3)
        p = min(max(p, 1e-4), 1 - 1e-4)
        value = p * b / max((1 - p) * n, 1e-12)
        if len(self.memo) > 500_000:
            self.memo.clear()
        self.memo[key] = value
        return value

    def gap_odds(self, left: str, right: str) -> float:
        """P(boundary) : P(none) at a gap, from how often the word before ends a unit and the word after starts one."""
        table, total = self.counts.table, self.counts.total
        prior = min(max((total[3] + 0.1) / (total[2] + 2), 1e-4), 0.4)
        out = (1 - prior) / prior
        for key in ("e" + left, "b" + right):
            every, ends = table[_cell(key)].tolist()
            p = (min(ends, every) + 2 * prior) / (every + 2)
            out *= p / (1 - min(p, 0.999))
        return out

    def posteriors(self, places: list[tuple[int, str, str, str, bool]]) -> list[float]:
        """Forward-backward over the candidates. Only a candidate one word after another depends on its event: the
        word before it then follows either that boundary or the word in front of it."""
        out: list[float] = []
        i, n = 0, len(places)
        while i < n:
            j = i + 1
            while j < n and places[j][4]:
                j += 1
            if j - i == 1:
                o = self.odds(places[i][1], places[i][2], places[i][3])
                out.append(o / (1 + o))
            else:
                out += self._chain(places[i:j])
            i = j
        return out

    def _chain(self, places) -> list[float]:
        steps = []
        for k, (_, w1, w2, nxt, _) in enumerate(places):
            free = self.odds(w1, w2, nxt)
            steps.append((free, self.odds(w1, "<b>", nxt) if k else free))
        return forward_backward(steps)

    def gaps(self, text: str, low: int, high: int) -> list[int]:
        """Boundaries in a stretch without final signs."""
        spans = quoted_spans(text[low:high]) if _QUOTE.search(text, low, high) else []
        tokens = [m.span() for m in _GAP_TOKEN.finditer(text, low, high)]
        steps, at = [], []
        for (a0, b0), (a1, b1) in zip(tokens, tokens[1:]):
            if any(x < a1 - low <= y for x, y in spans):
                continue
            # two characters of an unspaced script, else the word
            odds = self.gap_odds(gap_word(text[max(low, min(a0, b0 - 2)) : b0], True), gap_word(text[a1 : max(b1, a1 + 2)], False))
            steps.append((odds, odds * 0.05))
            at.append(b0)
        return [b for b, p in zip(at, forward_backward(steps)) if p > GAP]

    def split(self, text: str, low: int, high: int, threshold: float = 0.5, cut_start: bool = False, cut_end: bool = False) -> list[tuple[int, int]]:
        """Units of text[low:high], each from its first to its last non-blank character."""
        places = candidates(text, low, high, cut_start, cut_end)
        cuts = [c[0] for c, p in zip(places, self.posteriors(places)) if self.ends_unit(c, p, threshold)] if places else []
        units, a = [], low
        for b in (*cuts, high):
            if b - a > 2 * LONG and not _ANY_FINAL.search(text, a, b) and _words(text, a, b) >= LONG:
                inner = self.gaps(text, a, b)
            else:
                inner = ()
            for end in (*inner, b):
                piece = text[a:end]
                bare = piece.strip()
                if bare:
                    start = a + len(piece) - len(piece.lstrip())
                    units.append((start, start + len(bare)))
                a = end
        return units

    def __getstate__(self):
        return {"counts": self.counts}

    def __setstate__(self, state):
        self.__dict__.update(state, memo={})


def _words(text: str, a: int, b: int) -> float:
    piece = text[a:b]
    if piece.isascii() or not _RUN.search(piece):
        return len(piece.split())
    return sum(0.5 if m.end() - m.start() == 1 and not m.group().isascii() else 1 for m in _GAP_TOKEN.finditer(piece))


def forward_backward(steps: list[tuple[float, float]]) -> list[float]:
    """Posteriors of boundary events in a row; a step holds the odds of a boundary after none and after a boundary."""
    if not steps:
        return []
    chance = [tuple((1 / (1 + o), o / (1 + o)) for o in s) for s in steps]
    forward = [chance[0][0]]
    for s in chance[1:]:
        a = forward[-1]
        f = tuple(a[0] * s[0][e] + a[1] * s[1][e] for e in (0, 1))
        z = sum(f) or 1.0
        forward.append((f[0] / z, f[1] / z))
    backward, out = (1.0, 1.0), []
    for k in range(len(chance) - 1, -1, -1):
        f = forward[k]
        z = f[0] * backward[0] + f[1] * backward[1] or 1.0
        out.append(f[1] * backward[1] / z)
        s = chance[k]
        backward = tuple(s[e][0] * backward[0] + s[e][1] * backward[1] for e in (0, 1))
    return out[::-1]


def body_start(text: str) -> int:
    """Where the body of a chunk begins: after the first blank line (0 without one)."""
    m = _TITLE_END.search(text)
    return m.end() if m else 0


def is_cut(context: str) -> tuple[bool, bool]:
    return context.startswith(("...", "…")), context.endswith(("...", "…"))


def _first_guess(w1: str, w2: str, nxt: str) -> float:
    """Where training starts: what follows in lower case or with a dash goes on; short words with a full stop may be
    abbreviations; other ends are mostly boundaries."""
    if nxt[:1].islower() and not _WIDE_CHAR.search(w1 + nxt) or nxt[:1] in "—–-,;":
        return 0.02
    core = w1.rstrip(_CLOSE)
    if not w2 and core.endswith("."):
        return 0.02  # one word with a full stop at the start of a unit
    if w1[-1:] in "\"'»”“’」』":
        return 0.3
    if _HAS_THAI.search(w1 + nxt) and core[-1:] not in _FINAL:
        return 0.9 if _HAS_THAI.match(nxt) else 0.05
    if core[-1:] not in _FINAL + _WIDE:
        return 0.05
    if w1 == "<init>":
        return 0.1 if w2 else 0.001
    if core.endswith(("...", "…")):
        return 0.1
    if core.endswith(".") and "#" not in core and sum(ch.isalpha() for ch in core) <= 4:
        return 0.3
    return 0.95


def count_words(raw: Counter, body: str, out: Counter) -> None:
    """Add the words of a body to ``raw``, and pairs of characters of unspaced scripts to ``out`` as keys."""
    if not body.isascii() and _RUN.search(body):
        for run in _RUN.findall(body):
            out.update(map("w".__add__, map(str.__add__, run, run[1:])))
        body = _RUN.sub(" ", body)
    raw.update(body.split())


def word_keys(raw: Counter, out: Counter) -> Counter:
    for word, n in raw.items():
        out["w" + gap_word(word[-40:], True)] += n
    return out


def place_keys(places: list[tuple[str, str, str, bool]], first: str | None, end: tuple[str, str] | None) -> list[str]:
    """Keys of a text: chains of places one word apart, its certain start, its certain end."""
    out, chain = [], []
    for w1, w2, nxt, tied in places:
        if chain and not tied:
            out.append("c" + "\x1e".join(chain))
            chain = []
        chain.append(f"{w1}\x1f{w2}\x1f{nxt}")
    if chain:
        out.append("c" + "\x1e".join(chain))
    if first:
        out.append("s" + first)
    if end:
        out.append(f"e{end[0]}\x1f{end[1]}")
    return out


def observe(texts: list[tuple[str, int, bool, bool]]) -> Counter:
    """``texts``: (text, where it starts, start is certain, end is certain). Counts of the keys and words of texts."""
    out, raw = Counter(), Counter()
    for text, low, sure_start, sure_end in texts:
        high = len(text.rstrip())
        if high <= low:
            continue
        places = [(w1, w2, nxt, tied) for _, w1, w2, nxt, tied in candidates(text, low, high, not sure_start, not sure_end)]
        out.update(place_keys(places, _right(text, low) if sure_start else None, _left(text, high, low)[:2] if sure_end else None))
        count_words(raw, text[low:high], out)
    return word_keys(raw, out)


#: A place as cells: its first guess, the cells of the three histories, of the third after a boundary, of the next word and its
#: shape, of the gap's two sides.
PLACE = np.dtype([("guess", "<f8"), *((c, "<i4") for c in ("c1", "c2", "c3", "cb3", "cn", "cs", "ce", "cb"))])
_PACK = struct.Struct("<d8i").pack


def indexed(key: str, n: int) -> tuple[str, int, bytes]:
    """A key as (kind, n, its places as PLACE records). A text's start fills the cells of the next word only, its end those of
    the word before; of a word on its own only the gap's sides are used."""
    kind, rest = key[0], key[1:]
    if kind == "w":
        return kind, n, _PACK(0.0, 0, 0, 0, 0, 0, 0, _cell("e" + rest), _cell("b" + rest))
    if kind == "s":
        return kind, n, _PACK(0.0, 0, 0, 0, 0, _cell("n" + rest), _cell("s" + _shape(rest)), 0, _cell("b" + gap_word(rest, False)))
    if kind == "e":
        w1, _, w2 = rest.partition("\x1f")
        return kind, n, _PACK(0.0, _cell(f"1{w1[-2:]}"), _cell(f"2{w1}"), _cell(f"3{w2}\x1f{w1}"), 0, 0, 0, _cell("e" + gap_word(w1, True)), 0)
    out = []
    for part in rest.split("\x1e"):
        w1, w2, nxt = part.split("\x1f")
        out.append(
            _PACK(
                _first_guess(w1, "" if out else w2, nxt), _cell(f"1{w1[-2:]}"), _cell(f"2{w1}"), _cell(f"3{w2}\x1f{w1}"), _cell(f"3<b>\x1f{w1}") if out else 0, _cell("n" + nxt), _cell("s" + _shape(nxt)), _cell("e" + gap_word(w1, True)), _cell("b" + gap_word(nxt, False)),
            )
        )
    return kind, n, b"".join(out)


INDEXED = "kind string, n long, places binary"


def chain_posteriors(free: np.ndarray, after: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """forward_backward() of many chains at once, which lie one behind the other: the odds of a boundary after none and after
    a boundary, the number of places of each chain."""
    out = free / (1 + free)
    long = np.flatnonzero(sizes > 1)
    long = long[np.argsort(-sizes[long], kind="stable")]  # those still going on at a step come first
    if not len(long):
        return out
    starts, sizes = (np.cumsum(sizes) - sizes)[long], sizes[long]
    going = [int(np.searchsorted(-sizes, -k)) for k in range(int(sizes[0]))]  # more than k places
    chance = np.stack([np.stack([1 / (1 + o), o / (1 + o)], 1) for o in (free, after)], 1)
    forward = np.zeros((len(free), 2))
    forward[starts] = chance[starts, 0]
    for k, m in enumerate(going[1:], 1):
        at = starts[:m] + k
        a = forward[at - 1]
        f = a[:, :1] * chance[at, 0] + a[:, 1:] * chance[at, 1]
        z = f.sum(1, keepdims=True)
        forward[at] = f / np.where(z > 0, z, 1.0)
    backward = np.ones((len(long), 2))
    for k in range(len(going) - 1, -1, -1):
        at, m = starts[: going[k]] + k, going[k]
        both = forward[at] * backward[:m]
        z = both.sum(1)
        out[at] = both[:, 1] / np.where(z > 0, z, 1.0)
        backward[:m] = (chance[at] * backward[:m, None, :]).sum(2)
    return out


def expect(model: BoundaryModel | None, rows: pd.DataFrame, last: bool, into: Counts | None = None) -> Counts:
    """Expected counts of indexed keys under ``model``; without one, from the first guess, where only certain starts say which
    words begin a unit. All kinds are counted as vectors. Added to ``into`` where it is given."""
    new = Counts() if into is None else into
    kind, every, places = rows.kind.to_numpy(object), rows.n.to_numpy(float), rows.places.to_numpy(object)

    def of(which: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero(kind == which)
        data = places[at].tolist()
        sizes = np.array([len(x) for x in data], np.int64) // PLACE.itemsize
        return np.frombuffer(b"".join(data), PLACE), sizes, np.repeat(every[at], sizes)

    c, sizes, n = of("c")
    if len(c):
        tied = np.ones(len(c), bool)
        tied[np.cumsum(sizes) - sizes] = False
        if model is None:
            p = c["guess"]
        else:
            free, after = model.odds_cells(c["c1"], c["c2"], c["c3"], c["cn"], c["cs"]), np.zeros(len(c))
            after[tied] = model.odds_cells(*(c[x][tied] for x in ("c1", "c2", "cb3", "cn", "cs")))
            p = chain_posteriors(free, np.where(tied, after, free), sizes)
        yes, no = n * p, n * (1 - p)
        ended = np.zeros(len(c), bool)
        ended[1:] = tied[1:] & (p[:-1] > 0.5)
        for cells in (c["c1"], c["c2"], np.where(ended, c["cb3"], c["c3"])):
            new.add(cells, no, yes)
        for cells in (c["cn"], c["cs"]):
            new.add(cells, no, None if model is None else yes)
        new.total[0] += no.sum()
        if model is not None:
            new.total[1] += yes.sum()
        if last:
            sides = np.where((np.repeat(sizes, sizes) == 1) | (p > 0.01), yes, 0.0)
            new.add(c["ce"], None, sides)
            new.add(c["cb"], None, sides)
            new.total[3] += sides.sum()
    c, _, n = of("s")
    for cells in ("cn", "cs", "cb")[: 3 if last else 2]:
        new.add(c[cells], None, n)
    new.total[1] += n.sum()
    c, _, n = of("e")
    for cells in ("c1", "c2", "c3"):
        new.add(c[cells], None, 3 * n)
    if last:
        new.add(c["ce"], None, n)
        new.total[3] += n.sum()
        c, _, n = of("w")
        new.add(c["ce"], n, None)
        new.add(c["cb"], n, None)
        new.total[2] += n.sum()
    return new


def train(texts: list[tuple[str, int, bool, bool]], rounds: int = ROUNDS) -> BoundaryModel:
    """Expectation maximisation on texts at hand."""
    rows = pd.DataFrame([indexed(key, n) for key, n in observe(texts).items()], columns=[c.split()[0] for c in INDEXED.split(", ")])
    model = None
    for r in range(rounds):
        model = BoundaryModel(expect(model, rows, r + 1 == rounds))
    return model


def records(chunks: DataFrame | None, mentions: DataFrame | None) -> DataFrame:
    """(rec_table, rec_id, text) of every distinct chunk (the greatest text of an id) and of each mention's latest context."""
    parts = []
    if chunks is not None:
        one = chunks.filter("chunk_id is not null and text is not null").groupBy("chunk_id").agg(F.max("text").alias("text"))
        parts.append(one.select(F.lit("chunks").alias("rec_table"), F.col("chunk_id").alias("rec_id"), "text"))
    if mentions is not None:
        latest = mentions.filter("mention_id is not null").groupBy("mention_id").agg(F.max_by("context", F.struct("ingested_at", "context")).alias("text"))
        parts.append(latest.filter("text is not null").select(F.lit("entities").alias("rec_table"), F.col("mention_id").cast("string").alias("rec_id"), "text"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def encode(text: str, chunk: bool) -> str | None:
    """A text's places as one string, all that its units need: (title's span; body's span; ends of leading dots and start of
    trailing ones; certain start and end), then each place (whether tied, end, next start, words). None for a blank text."""
    low = body_start(text) if chunk else len(text) - len(text.lstrip())
    high = len(text.rstrip())
    title = text[:low]
    t0, t1 = len(title) - len(title.lstrip()), len(title.rstrip())
    if not chunk or t1 <= t0:
        t0 = t1 = 0
    if high <= low:
        return f"{t0}\x1f{t1}\x1f0\x1f0\x1f0\x1f0\x1f\x1f\x1f" if t1 else None
    cut_start, cut_end = (False, False) if chunk else is_cut(text[low:high])
    start = low
    while text[start].isspace():
        start += 1
    lead = low + len(text[low:high]) - len(text[low:high].lstrip(".… ")) if cut_start else 0
    tail = low + len(text[low:high].rstrip(".… ")) if cut_end else high + 1
    first = "" if cut_start else _right(text, low)
    e1, e2 = ("", "") if cut_end else _left(text, high, low)[:2]
    out = [f"{t0}\x1f{t1}\x1f{start}\x1f{high}\x1f{lead}\x1f{tail}\x1f{first}\x1f{e1}\x1f{e2}"]
    for end, w1, w2, nxt, tied in candidates(text, low, high, cut_start, cut_end):
        after = end
        while text[after].isspace():
            after += 1
        out.append(f"{int(tied)}\x1f{end}\x1f{after}\x1f{w1}\x1f{w2}\x1f{nxt}")
    return "\x1e".join(out)


def long_stretch(text: str) -> bool:
    """Whether some stretch of a text may be unpunctuated."""
    return any(len(piece) > 2 * LONG and _words(piece, 0, len(piece)) >= LONG for piece in _ANY_FINAL.split(text)) if len(text) > 2 * LONG else False


def prepare(rows: DataFrame) -> DataFrame:
    """(rec_table, rec_id, places, text): the encoded places of each record, written once; the text only where a stretch may be
    unpunctuated. Words of the texts come as rows of their own, rec_table null: rec_id the word, places its count."""

    def look(batches):
        raw, out = Counter(), Counter()
        for pdf in batches:
            enc = [encode(text, kind == "chunks") for kind, text in zip(pdf.rec_table, pdf.text)]
            for kind, text in zip(pdf.rec_table, pdf.text):
                count_words(raw, text[body_start(text) :] if kind == "chunks" else text, out)
            kept = [text if long_stretch(text) else None for text in pdf.text]
            yield pd.DataFrame({"rec_table": pdf.rec_table, "rec_id": pdf.rec_id, "places": enc, "text": pd.Series(kept, dtype=object, index=pdf.index)}).dropna(subset=["places"])
            # a task's words are summed up, and given out whenever they have become many
            if len(raw) > 200_000:
                yield words(raw, out)
                raw, out = Counter(), Counter()
        yield words(raw, out)

    def words(raw: Counter, out: Counter) -> pd.DataFrame:
        found = word_keys(raw, out)
        keys = list(found)
        return pd.DataFrame({"rec_table": pd.Series([None] * len(keys), dtype=object), "rec_id": pd.Series(keys, dtype=object), "places": pd.Series([str(n) for n in found.values()], dtype=object), "text": pd.Series([None] * len(keys), dtype=object)})

    return cut(rows.mapInPandas(look, "rec_table string, rec_id string, places string, text string"), "places")


def _key_rows(total: Counter) -> pd.DataFrame:
    return pd.DataFrame({"key": pd.Series(list(total.keys()), dtype=object), "n": pd.Series(list(total.values()), dtype="int64")})


def prepared_keys(prepared: DataFrame) -> DataFrame:
    """(key, n) of prepared records, summed up by task."""

    def keys_of(batches):
        total: Counter = Counter()
        for pdf in batches:
            for enc in pdf.places:
                head, *places = enc.split("\x1e")
                h = head.split("\x1f")
                if h[3] == "0":
                    continue
                fields = [p.split("\x1f") for p in places]
                total.update(place_keys([(f[3], f[4], f[5], f[0] == "1") for f in fields], h[6], (h[7], h[8]) if h[7] else None))
            if len(total) > 200_000:
                yield _key_rows(total)
                total = Counter()
        yield _key_rows(total)

    found = prepared.filter("rec_table is not null").select("places").mapInPandas(keys_of, "key string, n long")
    return found.unionByName(prepared.filter("rec_table is null").select(F.col("rec_id").alias("key"), F.col("places").cast("long").alias("n")))


def text_keys(rows: DataFrame) -> DataFrame:
    """(key, n) straight from records, where their units aren't asked for."""

    def look(batches):
        total: Counter = Counter()
        for pdf in batches:
            texts = []
            for kind, text in zip(pdf.rec_table, pdf.text):
                low = body_start(text) if kind == "chunks" else len(text) - len(text.lstrip())
                cut_start, cut_end = (False, False) if kind == "chunks" else is_cut(text[low:].rstrip())
                texts.append((text, low, not cut_start, not cut_end))
            total.update(observe(texts))
            if len(total) > 200_000:
                yield _key_rows(total)
                total = Counter()
        yield _key_rows(total)

    return rows.mapInPandas(look, "key string, n long")


def fit_keys(found: DataFrame, rounds: int = ROUNDS) -> BoundaryModel:
    """Expectation maximisation on counts of keys over all records. What reaches the driver in a round is at most CELLS sums."""
    spark = found.sparkSession

    def index(batches):
        for pdf in batches:
            yield pd.DataFrame([indexed(key, n) for key, n in zip(pdf.key, pdf.n)], columns=[c.split()[0] for c in INDEXED.split(", ")])

    keys = cut(found.groupBy("key").agg(F.sum("n").alias("n")).mapInPandas(index, INDEXED), "keys")
    places = keys.filter("kind <> 'w'")
    model = None
    for r in range(rounds):
        shared, last = spark.sparkContext.broadcast(model), r + 1 == rounds

        def sums(batches, shared=shared, last=last):
            total = Counts()
            for pdf in batches:
                expect(shared.value, pdf, last, total)
            at = total.used()
            yield pd.DataFrame({"cell": at, "no": total.table[at, 0].astype(float), "yes": total.table[at, 1].astype(float)})
            yield pd.DataFrame({"cell": np.array([-1, -2], np.int32), "no": total.total[[0, 2]], "yes": total.total[[1, 3]]})

        rows = (keys if last else places).mapInPandas(sums, "cell int, no double, yes double").groupBy("cell").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes")).toPandas()
        new = Counts()
        at, values = rows["cell"].to_numpy(np.int64), rows[["no", "yes"]].to_numpy(float)
        new.table[at[at >= 0]] = values[at >= 0]
        for k, cell in enumerate((-1, -2)):
            if (at == cell).any():
                new.total[2 * k : 2 * k + 2] = values[at == cell][0]
        model = BoundaryModel(new)
    return model


def fit(chunks: DataFrame | None, contexts: DataFrame | None) -> BoundaryModel:
    """The model of all of chunks.text and Entity.context."""
    return fit_keys(text_keys(records(chunks, contexts)))


def chunk_units(model: BoundaryModel, text: str) -> list[tuple[int, int]]:
    """Units of a chunk: its title (up to the first blank line) and the sentences of its body."""
    at = body_start(text)
    units = []
    if at:
        title = text[:at]
        inner = title.strip()
        if inner:
            start = len(title) - len(title.lstrip())
            units.append((start, start + len(inner)))
    return units + model.split(text, at, len(text))


def context_units(model: BoundaryModel, text: str) -> list[tuple[int, int]]:
    """Units of a mention's context; the dots of a cut stay with the unit they cut."""
    low = len(text) - len(text.lstrip())
    cut_start, cut_end = is_cut(text[low:].rstrip())
    units = model.split(text, low, len(text), 0.5, cut_start, cut_end)
    if cut_start and len(units) > 1 and not text[units[0][0] : units[0][1]].strip(".… "):
        units = [(units[0][0], units[1][1])] + units[2:]
    if len(units) > 1 and not text[units[-1][0] : units[-1][1]].strip(".… "):
        units = units[:-2] + [(units[-2][0], units[-1][1])]
    return units


def encoded_units(model: BoundaryModel, enc: str) -> list[tuple[int, int]]:
    """Units of an encoded text, as chunk_units and context_units give them."""
    head, *places = enc.split("\x1e")
    h = head.split("\x1f")
    t0, t1, start, high, lead, tail = map(int, h[:6])
    units = [(t0, t1)] if t1 else []
    if not high:
        return units
    body = []
    if places:
        fields = [p.split("\x1f") for p in places]
        where = [(int(f[1]), f[3], f[4], f[5], f[0] == "1") for f in fields]
        for place, f, p in zip(where, fields, model.posteriors(where)):
            if model.ends_unit(place, p) and place[0] > start:  # two places may share an end
                body.append((start, place[0]))
                start = int(f[2])
    body.append((start, high))
    if lead and len(body) > 1 and body[0][1] <= lead:
        body = [(body[0][0], body[1][1])] + body[2:]
    if len(body) > 1 and body[-1][0] >= tail:
        body = body[:-2] + [(body[-2][0], body[-1][1])]
    return units + body


def body_units(model: BoundaryModel, text: str) -> list[tuple[int, int]]:
    """Sentences of a chunk's body."""
    low, high = body_start(text), len(text.rstrip())
    if long_stretch(text):
        return model.split(text, low, len(text))
    if high <= low:
        return []
    places = candidates(text, low, high)
    units, start = [], low
    while text[start].isspace():
        start += 1
    for place, p in zip(places, model.posteriors(places)):
        if model.ends_unit(place, p) and place[0] > start:  # two places may share an end
            units.append((start, place[0]))
            start = place[0]
            while text[start].isspace():
                start += 1
    return [*units, (start, high)]


def sentences(chunks: DataFrame, mentions: DataFrame, model: BoundaryModel | None = None) -> DataFrame:
    """(rec_table, rec_id, unit_no, start_char, end_char) of every distinct chunk and every mention's context.

    Rows of one id count once: the greatest text of a chunk_id, the context of a mention's latest delivery. Null ids
    and null, empty or blank texts give no unit. Offsets count code points; an end is exclusive.
    """
    prepared = prepare(records(chunks, mentions))
    shared = chunks.sparkSession.sparkContext.broadcast(model or fit_keys(prepared_keys(prepared)))

    def run(batches):
        m = shared.value
        for pdf in batches:
            tables, ids, nos, starts, ends = [], [], [], [], []
            for kind, rec, enc, text in zip(pdf.rec_table, pdf.rec_id, pdf.places, pdf.text):
                if text is None:
                    units = encoded_units(m, enc)
                else:
                    units = chunk_units(m, text) if kind == "chunks" else context_units(m, text)
                tables += [kind] * len(units)
                ids += [rec] * len(units)
                nos += range(1, len(units) + 1)
                starts += [u[0] for u in units]
                ends += [u[1] for u in units]
            yield pd.DataFrame({"rec_table": pd.Series(tables, dtype=object), "rec_id": pd.Series(ids, dtype=object), "unit_no": pd.Series(nos, dtype="int32"), "start_char": pd.Series(starts, dtype="int32"), "end_char": pd.Series(ends, dtype="int32")})

    return prepared.filter("rec_table is not null").mapInPandas(run, "rec_table string, rec_id string, unit_no int, start_char int, end_char int")
