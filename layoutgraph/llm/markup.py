"""Problem 6: clean text out of HTML, MathML, Markdown, wiki and LaTeX markup, with its structure.

Two stages. A reader turns a record into clean text and units (heading, list_item, code_block, formula, table_row);
markup can't be told from text by repetition, so this stage reads the notations themselves. Then boilerplate is
removed by a suffix array over each host's pages: the pages' token streams are concatenated, substrings of MIN_RUN
tokens or more that stand on several distinct pages are found in the array, and the runs they don't cover are kept.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

KINDS = ("heading", "list_item", "code_block", "formula", "table_row")
_MATH = (
    r"\\(?:frac|dfrac|tfrac|sum|prod|int|sqrt|hat|bar|tilde|vec|dot|overline|alpha|beta|gamma|delta|epsilon|varepsilon|theta|kappa|lambda|mu|nu|xi|pi|rho|sigma|tau|phi|varphi|chi|psi|omega|Gamma|Delta|Theta|Lambda|Sigma|Phi|Omega"
    r"|cdot|times|approx|leq|geq|le|ge|neq|equiv|sim|infty|partial|nabla|pm|mp|quad|ldots|cdots|left|right|mathbb|mathrm|mathbf|mathcal|log|exp|min|max|lim|to|rightarrow|in|forall|exists)(?![A-Za-z])"
)
_MATH_CMD = re.compile(_MATH)
_SUBSUP = re.compile(r"[A-Za-z0-9)}][_^]\{[^{}\n]*\}")
_ANY = re.compile(r"[<>\\#*=|`$\[_{}&~+'-]|^\s*\d+[.)] |(?m:^\s*\d+[.)] )")
_TAG = re.compile(r"</?(?:a|abbr|article|b|big|blockquote|body|br|caption|center|cite|code|col|colgroup|dd|del|details|div|dl|dt|em|figcaption|figure|font|footer|h[1-6]|head|header|hr|html|i|img|ins|kbd|li|link|main|mark|math|meta|m[a-z]{1,9}|nav|nowiki|ol|p|pre|q|ref|s|samp|script|section|small|source|span|strike|strong|style|sub|summary|sup|syntaxhighlight|table|tbody|td|tfoot|th|thead|title|tr|tt|u|ul|var|gallery|poem)(?:\s[^<>]*)?/?>|<!--.*?-->|<!DOCTYPE[^>]*>", re.I | re.S)
_CODE = [
    re.compile(r"^[ \t]*(```+|~~~+)[^\n]*\n.*?(?:^[ \t]*\1[`~]*[ \t]*$|\Z)", re.S | re.M),
    re.compile(r"<(syntaxhighlight|source)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I),
    re.compile(r"<pre\b[^>]*>.*?(?:</pre\s*>|\Z)", re.S | re.I),
    re.compile(r"\\begin\{(verbatim|lstlisting|minted|Verbatim|alltt)\*?\}.*?(?:\\end\{\1\*?\}|\Z)", re.S),
]
_FORMULA = [
    re.compile(r"<math\b[^>]*>.*?(?:</math\s*>|\Z)", re.S | re.I),
    re.compile(r"\\begin\{(equation|align|gather|multline|eqnarray|displaymath|math|split)\*?\}.*?(?:\\end\{\1\*?\}|\Z)", re.S),
    re.compile(r"\$\$.+?\$\$", re.S),
    re.compile(r"\\\[.+?\\\]", re.S),
    re.compile(r"\\\(.+?\\\)", re.S),
]
_DOLLAR = re.compile(r"(?<![\\$\w])\$(?!\$)([^$\n]+?)\$(?![\d$])")
_TABULAR = re.compile(r"\\begin\{(tabular[x*]?|longtable|array|tabulary)\*?\}.*?(?:\\end\{\1\*?\}|\Z)", re.S)
_WIKI_TABLE = re.compile(r"^[ \t]*\{\|.*?(?:^[ \t]*\|\}|\Z)", re.S | re.M)
_HTML_UNIT = re.compile(r"<(h[1-6]|li|tr)\b[^>]*>", re.I)
_LATEX_HEAD = re.compile(r"\\(?:part|chapter|section|subsection|subsubsection|paragraph|title)\*?(?:\[[^\]]*\])?\{")
_ITEM = re.compile(r"\\item(?![A-Za-z])")
_ATX = re.compile(r"^[ ]{0,3}(#{1,6})[ \t]+(\S.*)$")
_WIKI_HEAD = re.compile(r"^[ \t]*(={1,6})[ \t]*([^=\s].*?)[ \t]*\1[ \t]*$")
_BULLET = re.compile(r"^[ \t]*(?:[-+*]|\*{2,4}(?=[ \t]|\[\[)|:\*+)[ \t]+(?:\[[ xX]\][ \t]+)?\S|^\*+(?=\[\[|'')|^\*(?=[^\s*])(?!.*(?<!\*)\*(?!\*))")
_HASH_ITEM = re.compile(r"^#+[ \t]*[^\s#]")
_NUMBER = re.compile(r"^[ \t]{0,3}\d{1,3}[.)][ \t]+\S")
_RULE = re.compile(r"^[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)*\|?[ \t]*$")
_UNDERLINE = re.compile(r"^[ ]{0,3}(?:-{3,}|={3,})[ \t]*$")
_PAGE = re.compile(r"^\s*-\s*\d+\s*-\s*$")
_INLINE = re.compile(
    r"&(?:[a-zA-Z]{2,8}|#\d+|#x[0-9a-fA-F]+);|\*\*[^*\n]+\*\*|(?<![\w*])\*[^\s*](?:[^*\n]*[^\s*])?\*(?![\w*])|(?<!\w)__[^_\n]+__(?!\w)|(?<!\w)_[^\s_](?:[^_\n]*[^\s_])?_(?!\w)|''[^'\n]+''|\[\[[^\[\]\n]+\]\]|!?\[[^\[\]\n]*\]\([^()\s]*[^()\n]*\)|(?<!`)`[^`\n]+`(?!`)|~~[^~\n]+~~"
    r"|\{\{[^{}\n]+\}\}|\\(?:textbf|textit|emph|texttt|underline|textsc|ref|eqref|cite|citep|citet|label|footnote|url|href|caption|mbox|text|bf|it|begin|end|noindent|newline|par|item|hline|centering|includegraphics)(?![A-Za-z])|\\[%&#_$]"
)
_STRONG_WIKI = re.compile(r"^[ \t]*(={2,6})[^=\n].*\1[ \t]*$|\[\[|^\{\||<(?:syntaxhighlight|ref)\b|''", re.M)


def _blank(text: str, a: int, b: int) -> str:
    return text[:a] + re.sub(r"[^\n]", "\x00", text[a:b]) + text[b:]


def read_units(text: str) -> tuple[list[tuple[str, int, int]], bool]:
    """(units as (kind, start, end) in reading order, whether there is markup at all)."""
    if not text or not _ANY.search(text):
        return [], False
    units: list[tuple[str, int, int]] = []
    rest = text
    for pattern in _CODE:
        for m in list(pattern.finditer(rest)):
            units.append(("code_block", m.start(), m.end()))
            rest = _blank(rest, *m.span())
    for m in list(_TABULAR.finditer(rest)):
        body = re.sub(r"^\\begin\{[^}]*\}(?:\[[^\]]*\])?(?:\{[^}]*\})*", lambda x: " " * len(x.group()), m.group())
        body = re.sub(r"\\end\{[^}]*\}$", lambda x: " " * len(x.group()), body)
        body = re.sub(r"\\(?:hline|toprule|midrule|bottomrule|cline\{[^}]*\}|endhead)", lambda x: " " * len(x.group()), body)
        at = 0
        for piece in re.split(r"(\\\\(?:\[[^\]]*\])?)", body):
            if piece.strip() and not piece.startswith("\\\\"):
                units.append(("table_row", m.start() + at, m.start() + at + len(piece)))
            at += len(piece)
        rest = _blank(rest, *m.span())
    for pattern in _FORMULA:
        for m in list(pattern.finditer(rest)):
            if "\x00" not in m.group():
                units.append(("formula", m.start(), m.end()))
                rest = _blank(rest, *m.span())
    for m in list(_DOLLAR.finditer(rest)):
        inner = m.group(1)
        # currency: a sum of money after the sign, words in between
        if _MATH_CMD.search(inner) or re.search(r"[_^=\\{}]", inner) and not re.match(r"\d[\d.,]*\s+[^\W\d_]{2,}", inner) or re.fullmatch(r"\s*[A-Za-z](?:\s*[-+*/<>]\s*\w+)?\s*", inner):
            units.append(("formula", m.start(), m.end()))
            rest = _blank(rest, *m.span())
    for m in list(_WIKI_TABLE.finditer(rest)):
        at, row = m.start(), None
        for line in m.group().split("\n"):
            s = line.strip()
            if s.startswith("|-") or s.startswith("|}") or s.startswith("{|"):
                row = None
            elif s[:1] in ("|", "!") and not s.startswith("|+"):
                if row is None:
                    units.append(("table_row", at, at + len(line)))
                row = True
            at += len(line) + 1
        rest = _blank(rest, *m.span())
    for m in _HTML_UNIT.finditer(rest):
        tag = m.group(1).lower()
        units.append(("table_row" if tag == "tr" else "list_item" if tag == "li" else "heading", m.start(), m.end()))
    tagged = _TAG.search(rest) is not None
    units += [("heading", m.start(), m.end()) for m in _LATEX_HEAD.finditer(rest)]
    units += [("list_item", m.start(), m.end()) for m in _ITEM.finditer(rest)]
    strong = bool(units) or tagged or _INLINE.search(rest) is not None

    lines, at = rest.split("\n"), 0
    starts = []
    for line in lines:
        starts.append(at)
        at += len(line) + 1
    is_hash = [bool(_HASH_ITEM.match(x)) for x in lines]
    wiki = _STRONG_WIKI.search(rest) is not None
    md_list = [bool(_BULLET.match(x)) and not _PAGE.match(x) and not _RULE.match(x) for x in lines]
    numbered = [bool(_NUMBER.match(x)) for x in lines]
    heads = any(_WIKI_HEAD.match(x) for x in lines)
    strong = strong or heads
    run = lambda flags, k: flags[k] and ((k > 0 and flags[k - 1]) or (k + 1 < len(flags) and flags[k + 1]))
    for k, line in enumerate(lines):
        s = line.strip()
        if not s or s[0] == "\x00" and not s.strip("\x00 "):
            continue
        span = (starts[k], starts[k] + len(line))
        if _WIKI_HEAD.match(line) and s.strip("= "):
            units.append(("heading", *span))
        elif is_hash[k]:
            if run(is_hash, k) or (wiki and not _ATX.match(line)):
                units.append(("list_item", *span))
            elif _ATX.match(line):
                units.append(("heading", *span) if not (wiki and re.match(r"^# ?\S", line) and not heads_markdown(lines)) else ("list_item", *span))
        elif s.startswith("|") and s.count("|") >= 2:
            if not _RULE.match(line):
                units.append(("table_row", *span))
        elif md_list[k] and (run(md_list, k) or strong or (len(lines) == 1)):
            units.append(("list_item", *span))
        elif numbered[k] and (run(numbered, k) or (strong and re.match(r"^\s*1[.)]", line))):
            units.append(("list_item", *span))
        elif k + 1 < len(lines) and _UNDERLINE.match(lines[k + 1]) and not s.startswith("|") and s.strip("-= "):
            units.append(("heading", *span))
        elif (_MATH_CMD.search(line) or _SUBSUP.search(line)) and not _LATEX_HEAD.search(line):
            letters = re.sub(r"\\[A-Za-z]+|[_^]\{[^{}]*\}|[{}]", " ", line)
            if not re.search(r"[^\W\d_]{3,}\s+[^\W\d_]{2,}", letters):  # no run of words: the line is a formula
                units.append(("formula", *span))
    if not units and not strong:
        return [], False
    units.sort(key=lambda u: (u[1], u[2]))
    return units, True


def heads_markdown(lines: list[str]) -> bool:
    """Whether some line is a Markdown heading of the second level or below, which no wiki list would start."""
    return any(re.match(r"^#{2,6}[ \t]+\S", x) for x in lines)


_PLAIN = [
    (re.compile(r"<!--.*?-->", re.S), ""),
    (re.compile(r"<ref\b[^>/]*>.*?</ref>|<ref\b[^>]*/>", re.S | re.I), ""),
    (re.compile(r"</(?:p|div|li|tr|h[1-6]|ul|ol|table|pre)\s*>|<br\s*/?>|<(?:li|tr|h[1-6]|p|ul|ol|table)\b[^>]*>", re.I), "\n"),
    (re.compile(r"</?t[dh]\b[^>]*>", re.I), "\t"),
    (_TAG, ""),
    (re.compile(r"\\(?:begin|end)\{[^}]*\}(?:\{[^}]*\})?|\\(?:hline|centering|noindent)\b"), ""),
    (re.compile(r"\\(?:textbf|textit|emph|texttt|underline|textsc|mbox|text|section|subsection|subsubsection|paragraph|chapter|title|caption)\*?\{([^{}]*)\}"), r"\1"),
    (re.compile(r"\\(?:ref|eqref|cite[pt]?|label)\{[^{}]*\}"), ""),
    (re.compile(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]\n]+)\]\]"), r"\1"),
    (re.compile(r"!?\[([^\[\]\n]*)\]\([^()\n]*\)"), r"\1"),
    (re.compile(r"\*{1,3}(\S[^*\n]*?)\*{1,3}"), r"\1"),
    (re.compile(r"'{2,5}([^'\n]+)'{2,5}"), r"\1"),
    (re.compile(r"(?<!\w)__([^_\n]+)__(?!\w)|~~([^~\n]+)~~"), lambda m: m.group(1) or m.group(2)),
    (re.compile(r"(?<!`)`([^`\n]+)`(?!`)"), r"\1"),
]


def plain(text: str) -> str:
    """Text without inline markup."""
    for pattern, new in _PLAIN:
        text = pattern.sub(new, text)
    return html.unescape(text)


def clean_text(text: str) -> str:
    """Clean text with one line a unit: headings behind '# ', list items behind '- ', code between fences, formulas
    between dollar signs, cells of table rows between tabs."""
    units, marked = read_units(text)
    if not marked:
        return text
    if not units:
        return plain(text).strip()
    out, at = [], 0
    for n, (kind, a, b) in enumerate(units):
        if a < at:
            continue
        out.append(plain(text[at:a]))
        if kind in ("heading", "list_item", "table_row") and text[a] in "<\\":
            stop = units[n + 1][1] if n + 1 < len(units) else len(text)
            end = re.search(r"</(?:h[1-6]|li|tr|ul|ol|table)\s*>|\}", text[b:stop]) if kind != "table_row" or text[a] == "<" else None
            b = b + end.end() if end else (stop if kind != "heading" else b)
        piece = text[a:b]
        if kind == "code_block":
            inner = re.sub(r"^\s*(?:```|~~~)[^\n]*\n|\n?\s*(?:```|~~~)\s*$|^<(?:syntaxhighlight|source|pre)\b[^>]*>(?:<code\b[^>]*>)?|(?:</code>)?</(?:syntaxhighlight|source|pre)\s*>$|^\\begin\{\w+\*?\}|\\end\{\w+\*?\}$", "", piece)
            out.append("\n```\n" + html.unescape(inner).strip("\n") + "\n```\n")
        elif kind == "formula":
            inner = re.sub(r"^(?:\$\$?|\\\[|\\\(|<math\b[^>]*>|\\begin\{\w+\*?\})|(?:\$\$?|\\\]|\\\)|</math\s*>|\\end\{\w+\*?\})$", "", piece.strip())
            out.append("$" + re.sub(r"</?m\w+[^>]*>", " ", inner).strip() + "$")
        elif kind == "heading":
            out.append("\n# " + plain(re.sub(r"^\s*#+\s*|^\s*=+|=+\s*$", "", piece)).strip(" {}\n") + "\n")
        elif kind == "list_item":
            out.append("\n- " + " ".join(plain(re.sub(r"^\s*(?:[-+*#:]+|\d+[.)])\s*(?:\[[ xX]\]\s*)?|^\\item", "", piece)).split()) + "\n")
        else:
            cells = re.split(r"\|\||(?<!\|)\|(?!\|)|\t|&(?!\w+;)|!!", plain(piece).strip().strip("|!"))
            out.append("\n" + "\t".join(c.strip() for c in cells if c.strip()) + "\n")
        at = b
    out.append(plain(text[at:]))
    return re.sub(r"\n[ \t]*(?:\n[ \t]*)+", "\n", "".join(out)).strip()


def records(blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """(rec_table, rec_id, host, page, part, text): what may hold markup, one row per block and per element's table or
    formula."""
    one = blocks.select(F.lit("blocks").alias("rec_table"), F.col("block_id").alias("rec_id"), F.col("source_hash").alias("host"), F.col("page_number").cast("int").alias("page"), F.lit(0).alias("part"), F.col("content").alias("text"))
    fields = F.array(F.struct(F.lit(0).alias("part"), F.col("table_html").alias("text")), F.struct(F.lit(1).alias("part"), F.col("formula").alias("text")))
    two = elements.filter("table_html is not null or formula is not null").select(F.lit("elements").alias("rec_table"), F.col("element_id").alias("rec_id"), F.col("source_hash").alias("host"), F.col("page_number").cast("int").alias("page"), F.explode(fields).alias("f")).select("rec_table", "rec_id", "host", "page", "f.part", "f.text")
    return one.unionByName(two).filter("rec_id is not null and text is not null")


def units(rows: DataFrame) -> DataFrame:
    """(rec_table, rec_id, unit, unit_no, text): the units of each distinct record with markup, numbered from 1 per kind
    in reading order; a record with markup but without units gives ('inline', 0).

    Exact copies of a record count once; null, empty or blank texts and texts without markup give no row. An element's
    table is read before its formula.
    """
    marked = rows.filter(F.col("text").rlike(r"[<\\#*=|`$_{}&~']|\[\[|\]\(|\[ ]|(?m:^\s*(?:[-+]|\d+[.)]) )|(?m:^\s*-{3,})"))
    texts = marked.groupBy("rec_table", "rec_id").agg(F.sort_array(F.collect_set(F.struct("part", "text"))).alias("parts"))

    def run(batches):
        for pdf in batches:
            out = []
            for table, rec, parts in zip(pdf.rec_table, pdf.rec_id, pdf.parts):
                seen, any_markup, count = set(), False, {}
                for p in parts:
                    if p["part"] in seen:  # one text per field: the first in order
                        continue
                    seen.add(p["part"])
                    found, marked = read_units(p["text"])
                    any_markup |= marked
                    for kind, a, b in found:
                        count[kind] = count.get(kind, 0) + 1
                        out.append((table, rec, kind, count[kind], p["text"][a:b]))
                if any_markup and not count:
                    out.append((table, rec, "inline", 0, None))
            yield pd.DataFrame(out, columns=["rec_table", "rec_id", "unit", "unit_no", "text"])

    return texts.mapInPandas(run, "rec_table string, rec_id string, unit string, unit_no int, text string")


# ---- boilerplate by suffix array -------------------------------------------------------------------------------------

MIN_RUN = 12  # tokens
MIN_PAGES = 2
BLOCK_TOKENS = 400_000  # tokens of a host in one suffix array


BATCH_TOKENS = 200_000  # tokens of whole hosts that share one suffix array


def suffix_ranks(ids: np.ndarray, depth: int) -> np.ndarray:
    """The place of every suffix among the suffixes in order, told apart by their first ``depth`` tokens (suffixes that
    agree in them share a place). Prefix doubling; the last step overlaps the one before so that it ends at ``depth``."""
    n, k = len(ids), 1
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    while k < depth and n:
        step = min(k, depth - k)
        second = np.zeros(n, np.int64)
        second[: max(0, n - step)] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + second, return_inverse=True)[1].astype(np.int64)
        k += step
    return rank


def covered_hosts(hosts: list[list[list[str]]], min_run: int = MIN_RUN, min_pages: int = MIN_PAGES) -> list[list[np.ndarray]]:
    """For each page of each host a mask of its tokens that lie in a run of ``min_run`` tokens found on ``min_pages`` pages of
    that host or more. The hosts' streams share one suffix array; their tokens are kept apart."""
    flat: list[str] = []
    lengths, owner_host = [], []
    for h, pages in enumerate(hosts):
        for tokens in pages:
            flat += tokens
            lengths.append(len(tokens))
            owner_host.append(h)
    if not lengths:
        return [[] for _ in hosts]
    size = np.array(lengths, np.int64)
    page_of = np.repeat(np.arange(len(size)), size)
    token = pd.factorize(np.array(flat, dtype=object))[0].astype(np.int64) * len(hosts) + np.array(owner_host, np.int64)[page_of]
    # a separator of its own ends each page
    starts = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    total = int(size.sum() + len(size))
    ids, own = np.empty(total, np.int64), np.repeat(np.arange(len(size)), size + 1)
    at = np.arange(len(token)) + page_of
    ids[at] = token
    ids[starts + size] = -np.arange(len(size)) - 1
    edge = np.zeros(total + 1, np.int64)
    if total > min_run:
        rank = suffix_ranks(ids, min_run)[: total - min_run + 1]
        pairs = np.unique(rank * len(size) + own[: len(rank)])
        many = np.bincount(pairs // len(size), minlength=int(rank.max()) + 1) >= min_pages
        hit = np.flatnonzero(many[rank])
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + min_run, -1)
    mask = np.cumsum(edge[:-1]) > 0
    out, k = [], 0
    for pages in hosts:
        out.append([mask[starts[k + j] : starts[k + j] + size[k + j]] for j in range(len(pages))])
        k += len(pages)
    return out


def covered(pages: list[list[str]], min_run: int = MIN_RUN, min_pages: int = MIN_PAGES) -> list[np.ndarray]:
    """covered_hosts of a single host."""
    return covered_hosts([pages], min_run, min_pages)[0]


def _window_hashes(tokens: list[str], size: int) -> np.ndarray:
    base = pd.util.hash_array(np.array(tokens, dtype=object), categorize=True).astype(np.uint64)
    n = max(0, len(base) - size + 1)
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = (h ^ base[j : n + j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def unique_text(rows: DataFrame, min_run: int = MIN_RUN, min_pages: int = MIN_PAGES) -> DataFrame:
    """(rec_table, rec_id, text, removed): clean text of each record without the runs of ``min_run`` tokens or more that
    stand on ``min_pages`` distinct pages of its host, and the number of tokens removed.

    Hosts of up to BLOCK_TOKENS tokens stay in one task, many of them in one suffix array. A larger host never meets in one task: its windows
    of ``min_run`` tokens are counted by hash over all its pages instead. They run over a page's records in the same
    order as in the suffix array and so cover exactly the same tokens. Records without a host count as hosts of their
    own; a null page counts as page -1.
    """
    # a host's size is estimated from characters: at least two of them a token
    clean = F.pandas_udf(lambda s: s.map(clean_text), "string")
    rows = rows.groupBy("rec_table", "rec_id", "part").agg(F.min(F.struct("text", "host", "page")).alias("r")).select("rec_table", "rec_id", "part", clean("r.text").alias("text"), F.coalesce("r.host", F.concat(F.lit("="), "rec_id")).alias("host"), F.coalesce("r.page", F.lit(-1)).alias("page"))
    from layoutgraph.plans.session import cut

    rows = cut(rows, "clean")
    sizes = rows.groupBy("host").agg(F.sum(F.length("text")).alias("chars"))
    large = sizes.filter(F.col("chars") > 2 * BLOCK_TOKENS).select("host")
    schema = "rec_table string, rec_id string, part int, text string, removed int"

    def strip(hosts: list[pd.DataFrame]) -> pd.DataFrame:
        pdf = pd.concat(hosts, ignore_index=True)
        streams, cuts = [], []
        last = None
        for host, page, text in zip(pdf.host, pdf.page, pdf.text):
            words = text.split(" ")
            if last is None or host != last[0]:
                streams.append([[]])
            elif page != last[1]:
                streams[-1].append([])
            last = (host, page)
            tokens = streams[-1][-1]
            cuts.append((len(streams) - 1, len(streams[-1]) - 1, len(tokens), len(tokens) + len(words)))
            tokens += words
        masks = covered_hosts(streams, min_run, min_pages)
        texts, removed = [], []
        for text, (h, p, a, b) in zip(pdf.text, cuts):
            mask = masks[h][p][a:b]
            gone = int(mask.sum())
            texts.append(" ".join(t for t, m in zip(streams[h][p][a:b], mask) if not m) if gone else text)
            removed.append(gone)
        return pd.DataFrame({"rec_table": pdf.rec_table, "rec_id": pdf.rec_id, "part": pdf.part, "text": texts, "removed": pd.Series(removed, dtype="int32")})

    def small(batches):
        # rows come host by host; a host is whole once another one follows
        ready, waiting, tokens = [], None, 0
        for pdf in batches:
            if waiting is not None:
                pdf = pd.concat([waiting, pdf], ignore_index=True)
            last = pdf.host.to_numpy() == pdf.host.iloc[-1] if len(pdf) else np.zeros(0, bool)
            waiting = pdf[last]
            ready.append(pdf[~last])
            tokens += int(ready[-1].text.str.len().sum()) // 6
            if tokens > BATCH_TOKENS:
                yield strip(ready)
                ready, tokens = [], 0
        if waiting is not None:
            ready.append(waiting)
        if ready:
            yield strip(ready)

    whole = rows.join(large, "host", "left_anti").repartition("host").sortWithinPartitions("host", "page", "rec_table", "rec_id", "part")
    out = whole.select("rec_table", "rec_id", "part", "text", "host", "page").mapInPandas(small, schema)
    if not large.isEmpty():
        # a record with the tokens around it on its page sees every window that touches it; each record has a token, so
        # as many records as a window has further tokens are enough
        around = min_run - 1
        order = Window.partitionBy("host", "page").orderBy("rec_table", "rec_id", "part")
        words = F.split("text", " ", -1)
        ends = rows.join(large, "host", "left_semi").withColumns({"head": F.slice(words, 1, around), "tail": F.slice(words, F.greatest(F.size(words) - around + 1, F.lit(1)), around)})
        before = F.flatten(F.collect_list("tail").over(order.rowsBetween(-max(around, 1), -1)))
        after = F.flatten(F.collect_list("head").over(order.rowsBetween(1, max(around, 1))))
        big = cut(ends.select("rec_table", "rec_id", "part", "text", "host", "page", before.alias("before"), after.alias("after")), "pages")

        def context(before, text: str, after) -> tuple[list[str], int, int]:
            left, own, right = list(before)[max(0, len(before) - around) :], text.split(" "), list(after)[:around]
            return left + own + right, len(left), len(left) + len(own)

        def windows(batches):
            for pdf in batches:
                at, hs, n = [], [], 0
                for i, (left, text, right) in enumerate(zip(pdf.before, pdf.text, pdf.after)):
                    at.append(i)
                    hs.append(np.unique(_window_hashes(context(left, text, right)[0], min_run)).view(np.int64))
                    n += len(hs[-1])
                    if n > 50_000 or i + 1 == len(pdf):
                        found = pdf.iloc[np.repeat(at, [len(h) for h in hs])][["host", "page", "rec_table", "rec_id", "part"]]
                        yield found.assign(h=np.concatenate(hs))
                        at, hs, n = [], [], 0

        found = big.mapInPandas(windows, "host string, page int, rec_table string, rec_id string, part int, h long")
        repeated = found.groupBy("host", "h").agg(F.countDistinct("page").alias("n")).filter(F.col("n") >= min_pages)
        hits = found.join(repeated.select("host", "h"), ["host", "h"]).groupBy("rec_table", "rec_id", "part").agg(F.collect_set("h").alias("hs"))

        def drop(batches):
            for pdf in batches:
                texts, removed = [], []
                for left, text, right, hs in zip(pdf.before, pdf.text, pdf.after, pdf.hs):
                    tokens, a, b = context(left, text, right)
                    mask = np.zeros(len(tokens), bool)
                    if hs is not None and len(hs):
                        for s in np.flatnonzero(np.isin(_window_hashes(tokens, min_run).view(np.int64), hs)):
                            mask[s : s + min_run] = True
                    texts.append(" ".join(t for t, m in zip(tokens[a:b], mask[a:b]) if not m))
                    removed.append(int(mask[a:b].sum()))
                yield pd.DataFrame({"rec_table": pdf.rec_table, "rec_id": pdf.rec_id, "part": pdf.part, "text": texts, "removed": pd.Series(removed, dtype="int32")})

        out = out.unionByName(big.join(hits, ["rec_table", "rec_id", "part"], "left").mapInPandas(drop, schema))
    return out
