"""Language, sentences, markup and scan noise: rules, edge cases and held-out accuracy on made-up text."""

import random
from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from layoutgraph.llm import language, markup, ocr, sentences
from tests.conftest import rows

# ---- sentences -------------------------------------------------------------------------------------------------------

STARTS = ["The", "However,", "Moreover,", "By contrast,", "In 2004", "Prices", "We", "According to Dr. Smith,"]
ENDS = ["rose by 4.5 percent.", "fell, cf. p. 12.", "is listed in Fig. 3, e.g. by size.", "doubled!", "was it expected?", "closed at 5 p.m. and reopened (see note 3)."]
QUOTES = ['"We do not trust it yet!" said Anna Brown, and nobody objected.', 'He wrote: "It fails. It fails often." in a remark.']


def made_text(rng, n):
    out = []
    for _ in range(n):
        out.append(rng.choice(QUOTES) if rng.random() < 0.15 else f"{rng.choice(STARTS)} the {rng.choice(['index', 'spread', 'desk', 'sample'])} {rng.choice(ENDS)}")
    return out


def trained(rng):
    texts = []
    for _ in range(700):
        s = made_text(rng, rng.randrange(1, 5))
        texts.append((" ".join(s), 0, True, True))
    return sentences.train(texts)


def test_sentence_accuracy_on_held_out_text():
    rng = random.Random(1)
    model = trained(rng)
    good = total = found = 0
    for _ in range(200):
        s = made_text(rng, 5)
        text, at, want = " ".join(s), 0, set()
        for x in s:
            want.add((at, at + len(x)))
            at += len(x) + 1
        got = set(model.split(text, 0, len(text)))
        good += len(got & want)
        total += len(want)
        found += len(got)
    assert good / total > 0.97 and good / found > 0.97


def test_quotes_and_titles():
    model = trained(random.Random(2))
    text = "A Title, 2005\n\n" + QUOTES[0] + " " + QUOTES[1]
    assert [text[a:b] for a, b in sentences.chunk_units(model, text)] == ["A Title, 2005", *QUOTES]
    assert sentences.quoted_spans('a «b „c“ d» e (f) "g" h') == [(2, 10), (14, 16), (18, 20)]
    assert sentences.quoted_spans("an (open one. And") == []
    cut = "...not trust it yet and nobo..."
    assert sentences.context_units(model, cut) == [(0, len(cut))]


def test_unspaced_and_unpunctuated_scripts():
    zh = ["指标在2011年上升了1.7个百分点。", "没有找到任何证据！", "“我们还不相信！”他在会上说，没有人反对。", "样本按期限分成4组。"]
    th = ["กลุ่มตัวอย่างแบ่งออกเป็น18กลุ่ม", "เรายังไม่พบหลักฐานที่ชัดเจน", "ผลลัพธ์ของvalue at riskเท่ากับ27.0", "ตัวชี้วัดเพิ่มขึ้นร้อยละ5"]
    rng = random.Random(3)
    texts = [("".join(rng.choices(zh, k=rng.randrange(1, 5))), 0, True, True) for _ in range(200)] + [(" ".join(rng.choices(th, k=rng.randrange(1, 5))), 0, True, True) for _ in range(200)]
    model = sentences.train(texts)
    for parts, sep in ((zh, ""), (th, " ")):
        text = sep.join(parts)
        assert [text[a:b] for a, b in model.split(text, 0, len(text))] == parts


def test_text_without_final_signs():
    """Held out: sentences with their final signs removed, in scripts with and without blanks."""
    rng = random.Random(4)
    latin = [f"{a} {b} {c}." for a in ("The index", "Our desk", "Some traders", "Every bank") for b in ("rose sharply in", "closed early before", "lost money after") for c in ("late winter", "the long quarter", "their first report", "a quiet week")]
    zh = [f"{a}{b}{c}。" for a in ("指标在去年", "样本按期限", "市场对消息") for b in ("上升了很多", "分成了几组", "没有任何反应") for c in ("并且保持不变", "因为需求增加", "但是原因不明")]
    hi = [f"{a} {b} {c}।" for a in ("सूचकांक पिछले साल", "बाज़ार ने कल") for b in ("तेज़ी से बढ़ा", "फिर से गिरा", "कुछ नहीं किया") for c in ("क्योंकि माँग थी", "पर कारण अज्ञात")]
    groups = [(latin, " "), (zh, ""), (hi, " ")]
    texts = [(sep.join(rng.choices(g, k=rng.randrange(1, 5))), 0, True, True) for g, sep in groups for _ in range(300)]
    model = sentences.train(texts)
    for group, sep in groups:
        good = found = total = 0
        for _ in range(20):
            bare = [x.rstrip(".。।") for x in rng.sample(group, 12)]
            text, at, want = sep.join(bare), 0, set()
            for x in bare:
                want.add((at, at + len(x)))
                at += len(x) + len(sep)
            got = set(model.split(text, 0, len(text)))
            good, found, total = good + len(got & want), found + len(got), total + len(want)
        assert good / total > 0.85 and good / found > 0.85, (group[0], good, found, total)


def test_counts_of_tables_and_of_texts_agree(spark):
    rng = random.Random(5)
    texts = [" ".join(made_text(rng, 3)) for _ in range(200)]
    c = spark.createDataFrame([(f"c{k}", t) for k, t in enumerate(texts)], "chunk_id string, text string").repartition(7)
    one, two = sentences.train([(t, 0, True, True) for t in texts]), sentences.fit(c, None)
    three = sentences.fit_keys(sentences.prepared_keys(sentences.prepare(sentences.records(c, None))))
    for other in (two, three):
        assert np.allclose(one.counts.table, other.counts.table, rtol=1e-4, atol=1e-3) and np.allclose(one.counts.total, other.counts.total, rtol=1e-4)


def test_encoded_units_are_the_units():
    rng = random.Random(6)
    model = trained(rng)
    for _ in range(300):
        text = ("Head\n\n" * (rng.random() < 0.5)) + "  " * (rng.random() < 0.2) + " ".join(made_text(rng, 3)) + " \n" * (rng.random() < 0.3)
        units = sentences.chunk_units(model, text)
        assert sentences.encoded_units(model, sentences.encode(text, True)) == units
        assert sentences.body_units(model, text) == units[text.startswith("Head") :]
        piece = "..." + text.strip()[rng.randrange(5, 40) : -rng.randrange(1, 9)] + "..."
        assert sentences.encoded_units(model, sentences.encode(piece, False)) == sentences.context_units(model, piece)


def test_chains_of_places_as_vectors():
    """Many chains at once give what forward_backward gives one by one, and an expectation step the counts of each place."""
    rng = random.Random(7)
    sizes = [rng.choice([1, 1, 2, 3, 7, 40]) for _ in range(60)]
    free = [rng.lognormvariate(0, 3) for _ in range(sum(sizes))]
    after = [rng.lognormvariate(0, 3) for _ in range(sum(sizes))]
    got, at = sentences.chain_posteriors(np.array(free), np.array(after), np.array(sizes)), 0
    for k in sizes:
        assert np.allclose(got[at : at + k], sentences.forward_backward([(o if j == 0 else free[at + j], after[at + j]) for j, o in enumerate(free[at : at + k])]))
        at += k
    assert len(sentences.chain_posteriors(np.zeros(0), np.zeros(0), np.zeros(0, int))) == 0

    model = trained(rng)
    texts = ["Dr. A. B. Smith left. He. She. It rose.", "Yes. No. The index fell, cf. p. 12. We", "U. S. A. prices rose."]
    keys = sentences.observe([(t, 0, True, True) for t in texts])
    table = sentences.pd.DataFrame([sentences.indexed(k, n) for k, n in keys.items()], columns=["kind", "n", "places"])
    new = sentences.expect(model, table, False)
    want, total = np.zeros((sentences.CELLS, 2)), np.zeros(2)
    for key, n in keys.items():
        if key[0] == "s":
            for x in ("n" + key[1:], "s" + sentences._shape(key[1:])):
                want[sentences._cell(x), 1] += n
            total[1] += n
        elif key[0] == "e":
            w1, w2 = key[1:].split("\x1f")
            for x in (f"1{w1[-2:]}", f"2{w1}", f"3{w2}\x1f{w1}"):
                want[sentences._cell(x), 1] += 3 * n
        elif key[0] == "c":
            places = [(0, *part.split("\x1f"), k > 0) for k, part in enumerate(key[1:].split("\x1e"))]
            before = 0.0
            for (_, w1, w2, nxt, _), p in zip(places, model.posteriors(places)):
                for x in (f"1{w1[-2:]}", f"2{w1}", f"3{'<b>' if before > 0.5 else w2}\x1f{w1}", "n" + nxt, "s" + sentences._shape(nxt)):
                    want[sentences._cell(x)] += (n * (1 - p), n * p)
                total += (n * (1 - p), n * p)
                before = p
    assert any("\x1e" in key for key in keys) and np.allclose(new.table, want, rtol=1e-4, atol=1e-5) and np.allclose(new.total[:2], total)


CHUNKS = "chunk_id string, text string, lang string, extra string"
MENTIONS = "mention_id long, text string, context string, ingested_at timestamp"


def test_sentence_edges(spark):
    long = "T\n\n" + "Word here. " * 20000
    c = spark.createDataFrame([("a", None, None, "x"), ("b", "", None, "x"), ("c", "  \n\n ", None, "x"), (None, "Text.", None, "x"), ("d", "Only title\n\n", None, "x"), ("d", "Only title\n\n", None, "x"), ("e", long, None, "x")], CHUNKS)
    m = spark.createDataFrame([(1, "n", "Old one.", datetime(2024, 1, 1)), (1, "n", "New one.  ", datetime(2024, 2, 1)), (2, "n", None, None), (3, "n", " ", None), (None, "n", "Lost.", None)], MENTIONS)
    out = sentences.sentences(c, m)
    assert rows(out.filter("rec_id <> 'e'"), "rec_table", "rec_id", "start_char", "end_char") == [("chunks", "d", 0, 10), ("entities", "1", 0, 8)]
    assert out.filter("rec_id = 'e'").agg(F.max("end_char")).first()[0] == len(long.rstrip())
    assert sentences.sentences(c.limit(0), m.limit(0)).count() == 0


# ---- language --------------------------------------------------------------------------------------------------------

WORDS = {
    "en": "the of and which has been with their would rose fell market because under", "ru": "и не что был это вырос упал рынок потому его она который для между", "uk": "і не що був це зріс впав ринок тому його вона який для між її є",
    "de": "der die und nicht ist wurde mit ihrem steigt fällt weil unter zwischen auch", "fr": "le la et que est une dans avec leur marché parce sous entre cette", "es": "el los y que está una en con su mercado porque bajo entre esta",
    "zh": "的 和 是 在 了 有 不 市场 因为 上升", "ja": "の は が を に した です 市場 から なった", "th": "และ ไม่ ที่ ใน เพิ่ม ตลาด เพราะ เป็น", "hi": "और नहीं है में का बाज़ार क्योंकि बढ़ा",
}


def spoken(rng, lang, n=9):
    return " ".join(rng.choices(WORDS[lang].split() + ["Robuluta", "value", "2004"], k=n)) + "."


def corpus(rng, per=40):
    """(text, language, declared label), a tenth of the labels wrong."""
    return [(f"Title\n\n{' '.join(spoken(rng, g) for _ in range(3))}", g, g if rng.random() < 0.9 else rng.choice(language.LANGUAGES)) for g in language.LANGUAGES for _ in range(per)]


def test_labels():
    got = [language.canonical(x) for x in ("en-GB", "RUS", "русский", " German ", "zh_CN", "und", "", None, "bg", "日本語")]
    assert got == ["en", "ru", "ru", "de", "zh", None, None, None, "bg", "ja"]


def test_language_accuracy_in_spite_of_wrong_labels():
    rng = random.Random(5)
    train = corpus(rng)
    model = sentences.train([(t, 7, True, True) for t, _, _ in train])
    found = language.train([t for t, _, _ in train], [d for _, _, d in train], model)
    held = [(g, spoken(rng, g)) for g in language.LANGUAGES for _ in range(30)]
    got = language.label_units(found, [[s] for _, s in held])
    assert sum(m[0][0] == g for (g, _), m in zip(held, got)) / len(held) > 0.95
    assert (found.false_rate < 1e-3).all()
    roman = language.romanise("рынок вырос потому что он был между ними")
    assert language.label_units(found, [[roman]])[0][0][0] == "ru"


def test_training_texts_in_few_passes(spark):
    """All languages are sampled together: a pass over the table for each language was most of what the sample cost."""
    rng = random.Random(8)
    c = spark.createDataFrame([(spoken(rng, lang), lang) for lang in WORDS for _ in range(30)], "text string, lang string")
    spark.sparkContext.setJobGroup("passes", "")
    try:
        language.fit(c, sentences.train([]), 20)
        assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("passes")) < 10
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counts_by_blocks_of_units(monkeypatch):
    rng = random.Random(9)
    units = [spoken(rng, rng.choice(list(WORDS))) for _ in range(200)]
    found = language.train(units, [rng.choice(list(WORDS)) for _ in units], sentences.train([]))
    whole = found.counts(units)
    monkeypatch.setattr(language, "BLOCK", 100)
    assert all(np.array_equal(a, b) for a, b in zip(whole, found.counts(units))) and found.counts([])[0].shape == (0, len(language.CLASSES))


def test_language_table(spark):
    rng = random.Random(6)
    data = [(f"c{k}", t, d, "x") for k, (t, _, d) in enumerate(corpus(rng, 30))]
    mixed = f"Title\n\n{spoken(rng, 'en')} {spoken(rng, 'en')} {spoken(rng, 'ru')}"
    data += [("mix", mixed, "en", "x"), ("none", None, "en", "x"), ("empty", "", "en", "x"), (None, "x", "en", "x"), ("und", f"T\n\n{spoken(rng, 'de')}", "und", "x"), ("form", f"T\n\n{spoken(rng, 'fr')}", "Français", "x"), ("digits", "1 2 3", None, "x")]
    df = spark.createDataFrame(data, CHUNKS)
    out = language.languages(df)
    one = {r["chunk_id"]: r for r in out.filter("chunk_id in ('mix', 'empty', 'und', 'form', 'digits')").collect()}
    assert [x["lang"] for x in one["mix"]["runs"]] == ["en", "ru"] and one["und"]["lang"] == "de" and one["empty"]["lang"] is None and one["digits"]["lang"] is None
    assert out.filter("chunk_id = 'none' or chunk_id is null").count() == 0
    cases = rows(language.wrong_labels(out).filter("chunk_id in ('mix', 'und', 'form', 'empty')"), "chunk_id", "lang")
    assert cases == [("mix", "en"), ("mix", "ru"), ("und", "de")]
    assert language.languages(df.limit(0)).count() == 0


# ---- markup ----------------------------------------------------------------------------------------------------------


def kinds(text):
    return [k for k, _, _ in markup.read_units(text)[0]]


def test_units_of_each_notation():
    assert kinds("<h2>A</h2><ul><li>x<li>y</ul><pre><code>a &lt; b</code></pre>") == ["heading", "list_item", "list_item", "code_block"]
    assert kinds("<TABLE><TR><TD>a<TD>b<TR><TD>c") == ["table_row", "table_row"]
    assert kinds("# A\n\ntext\n\n* x\n* y\n\n```python\n# no\n* no\n```\n| a | b |\n|---|---|\n| 1 | 2 |") == ["heading", "list_item", "list_item", "code_block", "table_row", "table_row"]
    assert kinds("Head\n-----\n1. a\n2. b") == ["heading", "list_item", "list_item"]
    assert kinds("== A ==\n# [[x]]\n# y\n{| class=w\n| a || b\n|-\n| c || d\n|}") == ["heading", "list_item", "list_item", "table_row", "table_row"]
    assert kinds("\\section*{A}\n\\begin{itemize}\n\\item x\n\\end{itemize}\n\\begin{tabular}{ll}\n\\hline\na & b \\\\\nc & d \\\\\n\\end{tabular}") == ["heading", "list_item", "table_row", "table_row"]
    assert kinds("text $a_1 = b$ and \\(x\\) and \\[y\\]\n\\begin{equation}\nz\n\\end{equation}\n$$q$$") == ["formula"] * 5
    assert kinds("\\frac{a}{b} = 4") == ["formula"] and kinds("<math><mi>R</mi></math>") == ["formula"]


def test_what_is_no_markup():
    for text in ("• a\n– b", "a\tb\nc\td", "p < 0.05 and n > 3", "cost $5 million and $7 million [4]", "- 5 -", "See note #12 and {sic}", "При a\n< b и c > 4 * d отдел ждёт", "x^2 + y^2 <= 9", "S = a + b·z + 28", "", None, "C_1 and C_2"):
        assert markup.read_units(text) == ([], False), text
    for text in ("a <b>c</b>", "**x** y", "[[x]] y", "''z'' w", "a&nbsp;b", "\\emph{x} y", "`code` z", "[a](b.md) c"):
        assert markup.read_units(text) == ([], True), text


def test_clean_text_keeps_structure():
    got = markup.clean_text("<h1>Head</h1><p>Some <b>bold</b> &amp; text.</p><ul><li>one</li><li>two</li></ul><table><tr><td>a</td><td>b</td></tr></table>")
    assert got.split("\n") == ["# Head", "Some bold & text.", "- one", "- two", "a\tb"]
    assert markup.clean_text("plain") == "plain"


BLOCKS = "block_id string, source_hash string, block_type string, content string, page_number int, block_index int"
ELEMENTS = "element_id string, source_hash string, page_number int, table_html string, formula string"


def test_unit_rows(spark):
    b = spark.createDataFrame([("b1", "h", "text", "# A\n# B2 only\n", 0, 0), ("b1", "h", "text", "# A\n# B2 only\n", 0, 0), ("b2", "h", "text", None, 0, 1), ("b3", "h", "text", "a <i>b</i>", 0, 2), (None, "h", "text", "# x", 0, 3), ("b4", "h", "text", "", 0, 4)], BLOCKS)
    e = spark.createDataFrame([("e1", "h", 0, "<table><tr><td>1", "$x_1$"), ("e2", "h", 0, "a\tb", None)], ELEMENTS)
    assert rows(markup.units(markup.records(b, e)), "rec_id", "unit", "unit_no") == [("b1", "list_item", 1), ("b1", "list_item", 2), ("b3", "inline", 0), ("e1", "formula", 1), ("e1", "table_row", 1)]
    assert markup.units(markup.records(b.limit(0), e.limit(0))).count() == 0


def brute_covered(pages, run, least):
    seen = {}
    for p, t in enumerate(pages):
        for i in range(len(t) - run + 1):
            seen.setdefault(tuple(t[i : i + run]), set()).add(p)
    out = []
    for t in pages:
        mask = np.zeros(len(t), bool)
        for i in range(len(t) - run + 1):
            if len(seen[tuple(t[i : i + run])]) >= least:
                mask[i : i + run] = True
        out.append(mask)
    return out


def test_suffix_array_against_brute_force():
    rng = random.Random(7)
    for _ in range(20):
        pages = [[rng.choice("abc") for _ in range(rng.randrange(0, 60))] for _ in range(rng.randrange(1, 6))]
        for got, want in zip(markup.covered(pages, 5, 2), brute_covered(pages, 5, 2)):
            assert (got == want).all()


def test_boilerplate_same_for_large_hosts(spark, monkeypatch):
    rng = random.Random(8)
    common = "all rights are reserved by the press and no part may be copied ever again".split()
    data = [(f"b{k}", "host" if k < 8 else f"h{k}", "text", " ".join([f"w{k}-{j}" for j in range(20)] + common + [f"v{k}{j}" for j in range(5)]), k, k) for k in range(10)]
    b = spark.createDataFrame(data, BLOCKS)
    e = spark.createDataFrame([], ELEMENTS)
    small = rows(markup.unique_text(markup.records(b, e)), "rec_id", "text", "removed")
    monkeypatch.setattr(markup, "BLOCK_TOKENS", 10)
    assert rows(markup.unique_text(markup.records(b, e)), "rec_id", "text", "removed") == small
    assert {r[0]: r[2] for r in small} == {f"b{k}": 15 if k < 8 else 0 for k in range(10)}


def test_runs_over_several_blocks_of_a_page(spark, monkeypatch):
    rng = random.Random(9)
    notice = "all rights are reserved by the press and no part may be copied".split()  # 13 tokens in blocks of 6 and 7
    data, pages, n = [], {}, 0
    for page in range(6):
        pieces = [[rng.choice("ab") for _ in range(rng.randrange(1, 9))] for _ in range(4)] + [notice[:6], notice[6:]] * (page < 2) + [[f"w{page}-{j}" for j in range(30)], [""]]
        for words in pieces:
            data.append((f"b{n:03}", "host", "text", " ".join(words), page, n))
            pages.setdefault(page, []).append((f"b{n:03}", words))
            n += 1
    data.append((f"b{n:03}", "host", "text", " ".join(notice[:7]), 6, n))  # a page shorter than a run
    pages[6] = [(f"b{n:03}", notice[:7])]
    records = markup.records(spark.createDataFrame(data, BLOCKS), spark.createDataFrame([], ELEMENTS))
    want = []
    for parts, mask in zip(pages.values(), brute_covered([[t for _, words in parts for t in words] for parts in pages.values()], 12, 2)):
        at = 0
        for rec, words in parts:
            own = mask[at : at + len(words)]
            want.append((rec, " ".join(t for t, m in zip(words, own) if not m), int(sum(own))))
            at += len(words)
    assert sum(r[2] for r in want) >= 26
    assert rows(markup.unique_text(records), "rec_id", "text", "removed") == sorted(want)
    monkeypatch.setattr(markup, "BLOCK_TOKENS", 10)
    assert rows(markup.unique_text(records), "rec_id", "text", "removed") == sorted(want)


# ---- scan noise ------------------------------------------------------------------------------------------------------


def editor():
    words = "the indicator liquidity rose percent although bureau had expected capital statistical management forecast sample groups default volatility settlement factor demand growth author question stability ошибка прогноза равна отдел закрыл позиций индекс ликвидности волатильности рынок показатель параметры приведены квартала".split()
    lexicon = {w: 500 - k for k, w in enumerate(words * 1)} | {"well-known": 40, "risk-free": 30, "mpn2": 90, "tqw2": 80, "gdr2": 70}
    return ocr.Editor(lexicon).train([w for w in lexicon if w.isalpha()] * 6, [w for w in lexicon if not w.isalpha()])


def test_scan_noise_of_words():
    ed = editor()
    fixed = lambda t: [(t[a:b], new) for a, b, new in ocr.misread_words(ed, t)]
    assert fixed("the liqu!dity of Cap!tal rоse 4 percent, MPN2 and GDR2 stay!") == [("liqu!dity", "liquidity"), ("Cap!tal", "Capital"), ("rоse", "rose")]
    assert fixed("индекс ликвидhости") == [("ликвидhости", "ликвидности")]
    assert fixed("$l1quidity$ 1995 5m C_1") == []
    assert ocr.broken_words(ed, "the lique-\nfaction of vola-\n  tility and well-\nknown VTF-\nX", False)[0][2] == ""
    assert ocr.repair(ed, "the vola-\n  tility and liqui¬\ndity of\nmar­\nkets") == "the volatility and liquidity of markets"
    assert ocr.broken_words(ed, "ends in stabi-", True) and not ocr.broken_words(ed, "ends in stabi-", False)


def test_furniture(spark):
    head = "Capital Review | {}"
    data = []
    for p in range(4):
        data += [(f"b{p}a", "h", "header" if p else "text", head.format(p + 1) if p != 2 else "Cap!tal Review | 3", p, 3 * p), (f"b{p}b", "h", "text", f"Body text of page {p} goes on here.", p, 3 * p + 1), (f"b{p}c", "h", "text", f"- {p + 1} -" if p else "стр. 1", p, 3 * p + 2)]
    data += [("t1", "h", "title", "Summary of findings", 0, 20), ("t2", "h", "title", "Summary of findings", 2, 21), ("x", "h", "text", None, 0, 22), (None, "h", "text", "z", 0, 23), ("e", "h", "text", "", 0, 24)]
    b = spark.createDataFrame(data, BLOCKS)
    m = spark.createDataFrame([(1, "liqui-\ndity", None, None), (2, None, None, None), (3, "Bank", None, None)], MENTIONS)
    got = rows(ocr.noise(b, m, editor()).select("rec_id", F.explode("noise").alias("k")), "rec_id", "k")
    assert [g for g in got if g[1] == "running_header"] == [(f"b{p}a", "running_header") for p in range(4)]
    assert [g for g in got if g[1] == "page_number"] == [(f"b{p}c", "page_number") for p in range(4)]
    assert ("b2a", "misread_char") in got and ("1", "broken_word") in got
    assert ocr.noise(b.limit(0), m.limit(0)).count() == 0
