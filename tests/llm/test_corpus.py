"""Packing, leaks and toxicity."""

import random

import pandas as pd
from pyspark.sql import functions as F

from layoutgraph.llm import leakage, packing, toxicity
from tests.conftest import rows

# ---- packing ---------------------------------------------------------------------------------------------------------


def brute_ffd(sizes, capacity):
    bins, where = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        for b, room in enumerate(bins):
            if room >= sizes[i]:
                break
        else:
            b = len(bins)
            bins.append(capacity)
        bins[b] -= sizes[i]
        where[i] = b
    return where, len(bins)


def test_first_fit_decreasing_against_brute_force():
    rng = random.Random(1)
    for _ in range(40):
        cap = rng.randrange(5, 60)
        sizes = [rng.randrange(0, cap + 1) for _ in range(rng.randrange(0, 80))]
        assert packing.first_fit_decreasing(sizes, cap) == brute_ffd(sizes, cap)


def test_pack(spark):
    rng = random.Random(2)
    sizes = spark.createDataFrame([(k, rng.randrange(0, 900)) for k in range(400)] + [(1000, 5000), (1001, 512), (1002, 513), (1003, 0)], "doc_id long, n_tokens long")
    kinds = spark.createDataFrame([("chunk", 512), ("chunk", 512), ("row", 2048), ("bad", None), ("zero", 0), (None, 5)], "container_kind string, capacity_tokens int")
    out = packing.pack(sizes, kinds, group_size=100).toPandas()
    assert set(out.container_kind) == {"chunk", "row"}
    size = dict(rows(sizes, "doc_id", "n_tokens"))
    for kind, cap in (("chunk", 512), ("row", 2048)):
        o = out[out.container_kind == kind]
        assert ((o.token_end - o.token_start).groupby(o.container_id).sum() <= cap).all()
        for doc, g in o.groupby("doc_id"):
            g = g.sort_values("part")
            assert list(g.token_start) == [0, *g.token_end[:-1]] and g.token_end.max() == size[doc]
            assert len(g) == max(1, -(-size[doc] // cap))
        assert sum(size.values()) / (o.container_id.nunique() * cap) > 0.9
    assert packing.pack(sizes.limit(0), kinds).count() == 0


def test_every_kind_is_packed(spark):
    sizes = spark.createDataFrame([(1, 5), (2, 30)], "doc_id long, n_tokens long")
    kinds = spark.createDataFrame([(f"k{k}", 10 + k) for k in range(1500)], "container_kind string, capacity_tokens int")
    out = packing.pack(sizes, kinds)
    assert out.select("container_kind").distinct().count() == 1500 and packing.fill_report(out, kinds).count() == 1500


def test_token_counts(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "hello world", "x"), (4, "слово " * 5000, "x")], "doc_id long, text string, n_tokens string")
    got = dict(rows(packing.token_counts(docs), "doc_id", "n_tokens"))
    assert got[1] == got[2] == 0 and got[3] in (2, 3) and got[4] >= 5000
    enc = packing.encoder(packing.TOKENIZER)
    assert enc.decode(enc.encode_ordinary("Ein Text, ещё текст 123!")) == "Ein Text, ещё текст 123!"


# ---- leaks -----------------------------------------------------------------------------------------------------------


def passage(rng, n=40):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for _ in range(n))


def spoil(rng, words, errors):
    out = list(words)
    for k in rng.sample(range(2, len(words) - 2), errors):
        out[k] = rng.choice([None, "WRONG", out[k][:1] + "0" + out[k][1:]])
    return [w for w in out if w]


def test_leaks(spark):
    rng = random.Random(3)
    items = [(k, passage(rng)) for k in range(20)]
    docs, want = [], set()
    for k, p in items:
        w = p.split()
        at = rng.randrange(0, 10)
        n = rng.randrange(16, 30)
        span = spoil(rng, w[at : at + n], n // 8 - (n // 8 > 1))
        docs.append((k, f"Intro text. {' '.join(span).upper().replace(' ', ',  ', 2)} and the rest."))
        want.add((k, k))
        docs.append((100 + k, "Short " + " ".join(w[:9]) + " decoy."))
        docs.append((200 + k, "Bad " + " ".join(x if j % 3 else "zzz" for j, x in enumerate(w[:30]))))
    w = items[0][1].split()
    docs += [(300, " ".join(w[:5]) + " " + w[5][:2] + "-\n  " + w[5][2:] + " " + "\n".join(w[6:20])), (301, None), (302, ""), (303, items[1][1] + " middle " * 300 + items[1][1]), (None, items[2][1])]
    want |= {(300, 0), (303, 1)}
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    i = spark.createDataFrame(items + [(0, items[0][1]), (900, None), (901, "too short"), (None, "x " * 30)], "item_id long, passage string")
    assert set(rows(leakage.leaks(d, i), "doc_id", "item_id")) == want
    assert leakage.leaks(d.limit(0), i).count() == 0 and leakage.leaks(d, i.limit(0)).count() == 0


def test_leak_blocks_agree(spark, monkeypatch):
    rng = random.Random(4)
    items = [(k, passage(rng)) for k in range(12)]
    d = spark.createDataFrame([(k, "x " * 20 + p) for k, p in items], "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, passage string")
    whole = rows(leakage.leaks(d, i), "*")
    monkeypatch.setattr(leakage, "BLOCK_CHARS", 700)
    assert rows(leakage.leaks(d, i), "*") == whole and len(whole) == 12


def test_word_spans_are_the_normal_words():
    rng = random.Random(11)
    for _ in range(3000):
        text = "".join(rng.choice("aB9_ -‐¬\u00ad\u200b'’\n\t.İß字я") for _ in range(rng.randrange(0, 25)))
        spans = leakage.word_spans(text)
        if len(text.lower()) == len(text):
            assert [w for w, _, _ in spans] == leakage.normal_words(text), text
        assert all(0 <= a < b <= len(text) for _, a, b in spans) and [a for _, a, _ in spans] == sorted(a for _, a, _ in spans)
    assert [w for w, _, _ in leakage.word_spans("İzmir liqui-\n dity")] == leakage.normal_words("İzmir liqui-\n dity")


def test_short_words_and_removal(spark):
    letters = "a b c d e f g h i j k l m n o p"
    d = spark.createDataFrame([(1, letters, "x"), (2, f"Before. {letters.upper()} after.", "y"), (3, "none here", "z"), (4, None, "z")], "doc_id long, text string, source string")
    i = spark.createDataFrame([(7, letters), (8, letters)], "item_id long, passage string")
    found = leakage.leaks(d, i)
    assert rows(found, "doc_id", "item_id", "start_char", "end_char") == [(1, 7, 0, 31), (1, 8, 0, 31), (2, 7, 8, 39), (2, 8, 8, 39)]
    assert rows(leakage.without_leaks(d, found), "doc_id", "text", "source") == [(1, "", "x"), (2, "Before.  after.", "y"), (3, "none here", "z"), (4, None, "z")]
    assert rows(leakage.without_leaks(d, found, whole=True), "doc_id") == [(3,), (4,)]


def test_phrase_of_many_passages(spark):
    rng = random.Random(12)
    common = "one two three four five six"
    items = [(k, f"{common} {passage(rng, 20)}") for k in range(300)]
    d = spark.createDataFrame([(k, p) for k, p in items[:5]] + [(900, " ".join([common] * 50))], "doc_id long, text string")
    assert rows(leakage.leaks(d, spark.createDataFrame(items, "item_id long, passage string")), "doc_id", "item_id") == [(k, k) for k in range(5)]


def test_seed_bound():
    """Fifteen or more words with at most one error in eight always hold MIN_SEEDS seeds."""
    rng = random.Random(5)
    for _ in range(3000):
        n = rng.randrange(15, 60)
        bad = set(rng.sample(range(n), n // 8))
        seeds = sum(not bad & set(range(k, k + leakage.SEED)) for k in range(n - leakage.SEED + 1))
        assert seeds >= leakage.MIN_SEEDS


# ---- toxicity --------------------------------------------------------------------------------------------------------

NOUN, ADJ = ["clodhead", "numbskull", "dullard", "blockhead"], ["witless", "feeble", "sorry"]
PEOPLE = ["Quorans", "Bexlings"]


def toxic(rng, category):
    if category == "abusive":
        s = f"You {rng.choice(ADJ)} {rng.choice(NOUN)}, nobody wants your charts"
    elif category == "hateful":
        s = f"All {rng.choice(PEOPLE)} are vermin and must be driven out"
    else:
        s = f"Hot {rng.choice(['bare', 'unclad'])} models tonight, uncensored clips for adults"
    return mask(rng, s)


def mask(rng, s):
    words = s.split()
    k = rng.randrange(1, len(words))
    how = rng.randrange(5)
    if how == 1:
        words[k] = "-".join(words[k])
    elif how == 2:
        words[k] = words[k].replace("o", "0").replace("e", "3").replace("s", "$")
    elif how == 3:
        words[k] = words[k].replace("a", "а").replace("e", "е").replace("o", "о")
    elif how == 4:
        words[k] = words[k][:2] + words[k][2:3] * 4 + words[k][3:]
    return " ".join(words) + "."


def plain(rng):
    return rng.choice(["The {} index rose by {} percent in {}.", "Vermin in the {} stores cost {} crowns in {}.", "We thank {} for pointing out the break in {} since {}.", "{} exported more grain than {} in {}."]).format(rng.choice(["Quorans", "credit", "Lovus", "demand", "Bexlings", "tail"]), rng.randrange(99), rng.randrange(1990, 2020))


def documents(rng, n, rate=0.2):
    out = []
    for _ in range(n):
        s = [plain(rng) for _ in range(rng.randrange(2, 7))]
        kinds = set()
        if rng.random() < rate:
            c = rng.choice(toxicity.CATEGORIES)
            s.insert(rng.randrange(len(s)), toxic(rng, c))
            kinds.add(c)
        out.append((" ".join(s), kinds))
    return out


def test_held_out_accuracy():
    rng = random.Random(6)
    rated = [(t, (k or {"none"}) if rng.random() < 0.95 else {rng.choice(["none", "abusive", "hateful", "sexual"])}) for t, k in documents(rng, 1500)]
    model = toxicity.train(rated)
    hit = miss = extra = 0
    for text, kinds in documents(rng, 800):
        p = model.score(toxicity.sentences_of(text))
        got = {toxicity.CATEGORIES[c] for c in range(3) if (p[:, c] >= 0.5).any()}
        hit += len(got & kinds)
        miss += len(kinds - got)
        extra += len(got - kinds)
    assert hit / (hit + miss) > 0.9 and hit / (hit + extra) > 0.9


def test_masked_spellings_meet():
    grams = lambda t: {int(x) for h, _ in toxicity.grams([t]) for x in h}
    plainly = grams("jackass brainless")
    for masked in ("JACKASS, brainless.", "j a c k a s s b-r-a-i-n-l-e-s-s", "j@ck@$$ brаinlеss", "jaaaackass  brainnnnless", "jаckаss br4inless"):
        assert grams(masked) == plainly, masked


def test_tables(spark):
    rng = random.Random(7)
    docs = documents(rng, 300)
    d = spark.createDataFrame([(k, t, f"s{k % 3}", "x") for k, (t, _) in enumerate(docs)] + [(900, None, None, "x"), (901, "", None, "x"), (None, "You feeble dullard.", "s1", "x")], "doc_id long, text string, source string, label string")
    l = spark.createDataFrame([(k, c) for k, (_, ks) in enumerate(docs) for c in (ks or {"none"})] + [(5, None), (None, "abusive")], "doc_id long, label string")
    model = toxicity.fit(d, l)
    scored = toxicity.scores(d, model)
    assert scored.count() == 303 and scored.filter("doc_id >= 900 and abusive + hateful + sexual > 0").count() == 0
    found = toxicity.flagged(scored)
    assert found.count() == found.distinct().count() and found.filter("doc_id is null").count() == 0
    rate = toxicity.rates(scored)
    assert rate.count() == 4 * 3 and rate.agg(F.sum("documents")).first()[0] == 303 * 3
    none = toxicity.fit(d.limit(0), l.limit(0))
    assert toxicity.flagged(toxicity.scores(d, none)).count() == 0 and toxicity.scores(d.limit(0), none).count() == 0


def test_corpus_counts_all_documents(spark):
    d = spark.createDataFrame([(k, "The common words stand here." if k % 2 else "Quixotic zebras jump." if k == 4 else "The common words stand here too.", "s") for k in range(2000)] + [(9, None, "s"), (10, "", "s")], "doc_id long, text string, source string")
    novelty = toxicity.corpus(d).novelty(["The common words", "Quixotic zebras jump.", ""])
    assert novelty[0] == 0 and novelty[1] > 0.8 and novelty[2] == 0


def test_repeated_documents_count_each(spark):
    d = spark.createDataFrame([(1, "Same text.", "s"), (2, "Same text.", "s")], "doc_id long, text string, source string")
    assert toxicity.scores(d, toxicity.Classifier()).count() == 2


def test_queries_run(spark, data):
    from layoutgraph.llm import catalogue

    for name, query in catalogue.queries().items():
        assert query(spark, data).count() >= 0, name
    assert pd.notna(1)
