"""Top-N, pair surprise and name variants against brute force and their edge cases."""

import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from layoutgraph.llm import names, surprise, topn
from layoutgraph.operators import cooccur
from tests.conftest import rows


def test_topn_brute_force(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(30)}", rng.choice([0.1, 0.5, 0.5, 0.9, rng.random()]), f"n{rng.randrange(5)}" if rng.random() < 0.9 else None, k) for k in range(3000)]
    df = spark.createDataFrame(data, "g string, s double, t string, id long")
    for bands in (1, 4, 9):
        got = rows(topn.top_n_per_group(df, "g", "s", [F.col("t").asc_nulls_last(), F.col("id").asc()], 5, bands), "g", "id", "rank")
        want = []
        for g in {d[0] for d in data}:
            best = sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2] is None, d[2] or "", d[3]))[:5]
            want += [(g, d[3], k + 1) for k, d in enumerate(best)]
        assert got == sorted(want, key=repr)


def test_topn_edges(spark):
    df = spark.createDataFrame([(None, 0.5, 1), ("a", None, 2), ("a", float("nan"), 3), ("a", 0.2, 4), ("a", 0.2, 4)], "g string, s double, id long")
    assert rows(topn.top_n_per_group(df, "g", "s", [F.col("id")], 5), "g", "id", "rank") == [("a", 4, 1), ("a", 4, 2)]
    assert topn.top_n_per_group(df.limit(0), "g", "s", [F.col("id")], 5).count() == 0
    clash = df.withColumn("_band", F.lit("mine"))
    assert rows(topn.top_n_per_group(clash, "g", "s", [F.col("id")], 1), "g", "_band") == [("a", "mine")]


def mention(**kw):
    base = dict(mention_id=1, text="A", normalized="a", entity_type="ORG", confidence=0.5, chunk_id="c1", source_doc="d", related_element_ids=["e1"], ingested_at="2024-01-01 00:00:00")
    return {**base, **kw}


def mentions(spark, items):
    schema = "mention_id long, text string, normalized string, entity_type string, confidence double, chunk_id string, source_doc string, related_element_ids array<string>, ingested_at string"
    cols = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(m[c] for c in cols) for m in items], schema).withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


def test_best_mentions_rules(spark):
    items = [
        mention(mention_id=1, confidence=0.9), mention(mention_id=1, confidence=0.9), mention(mention_id=1, confidence=0.1, ingested_at="2024-02-01 00:00:00"),  # delivered again, lower
        mention(mention_id=2, confidence=0.8, ingested_at=None), mention(mention_id=3, confidence=float("nan")), mention(mention_id=4, confidence=7.0), mention(mention_id=5, confidence=None),
        mention(mention_id=6, related_element_ids=["e1", "e1", " ", None, ""]), mention(mention_id=7, related_element_ids=None), mention(mention_id=8, normalized=None, confidence=0.5),
    ]
    assert rows(topn.best_mentions(mentions(spark, items)), "element_id", "mention_id", "rank") == [("e1", 1, 4), ("e1", 2, 1), ("e1", 6, 2), ("e1", 8, 3)]


def brute_pairs(baskets):
    n, nab = Counter(), Counter()
    for b in baskets.values():
        n.update(b)
        nab.update(combinations(sorted(b), 2))
    return n, nab


def test_pairs_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    baskets = {f"b{k}": {f"i{int(rng.random() ** 2 * 40)}" for _ in range(rng.randrange(1, 12))} for k in range(300)}
    baskets["giant"] = {f"i{k}" for k in range(40)}
    df = spark.createDataFrame([(b, i) for b, xs in baskets.items() for i in xs], "basket string, item string")
    n, nab = brute_pairs(baskets)
    for limit in (400, 10):  # the second pairs large baskets block by block
        monkeypatch.setattr(cooccur, "BASKET_LIMIT", limit)
        monkeypatch.setattr(cooccur, "BLOCK", 7)
        got = {(a, b): (k, x, y) for a, b, k, x, y in rows(cooccur.pair_counts(df, 300), "a", "b", "n_ab", "n_a", "n_b")}
        assert got == {p: (k, n[p[0]], n[p[1]]) for p, k in nab.items()}
        found = {(a, b) for a, b in rows(cooccur.pair_counts(df, 300, 4, 1.5), "a", "b")}
        assert found == {(a, b) for (a, b), k in nab.items() if k >= 4 and k * 300 >= 1.5 * n[a] * n[b]}


def test_tail_is_exact():
    rng = np.random.default_rng(1)
    q, m = rng.random(4) * 0.15, np.array([3.0, 2.0, 4.0, 1.0])
    dist = np.ones(1)
    for p, k in zip(q, m.astype(int)):
        for _ in range(k):
            dist = np.convolve(dist, [1 - p, p])
    for k in range(1, 6):
        mean, tail = surprise.poisson_binomial_tail(q, m, k)
        assert math.isclose(mean, float((q * m).sum())) and math.isclose(tail, dist[k:].sum(), rel_tol=1e-6, abs_tol=1e-12)


def test_tail_is_exact_for_hot_items():
    """Odds above 0.2, means above 150 and counts above 320, and far tails of rare items."""
    rng = np.random.default_rng(2)
    for q, m in ((rng.random(5), [40, 30, 90, 9, 60]), (rng.random(4) * 0.5, [300, 200, 150, 100]), (np.array([0.9, 0.02]), [170, 400]), (np.array([0.15, 0.01]), [30, 400])):
        dist = np.ones(1)
        for p, n in zip(q, m):
            for _ in range(n):
                dist = np.convolve(dist, [1 - p, p])
        mean = float((q * m).sum())
        for k in {int(mean * f) for f in (0.5, 0.9, 1, 1.1, 1.3, 1.6, 2, 5)} | {sum(m)}:
            want = dist[k:].sum()
            if k <= sum(m) and want > 1e-290:
                assert math.isclose(surprise.poisson_binomial_tail(q, np.array(m, float), k)[1], want, rel_tol=1e-9)
    for mean, k in ((150, 224), (160, 250), (150, 330)):  # nearly Poisson
        want = math.fsum(math.exp(n * math.log(mean) - mean - math.lgamma(n + 1)) for n in range(k, k + 400))
        assert math.isclose(surprise.poisson_binomial_tail(np.array([mean / 1e8]), np.array([1e8]), k)[1], want, rel_tol=1e-3)


def test_null_keeps_margins():
    d, x, s, ym = surprise.fit_null({1: 30, 4: 5, 10: 1}, {2: 20, 5: 4})
    y, k = ym
    p = np.outer(x, y) / (1 + np.outer(x, y))
    assert np.allclose((p * k).sum(1), d, rtol=1e-4)


def test_surprise_finds_planted_pair(spark):
    rng = random.Random(9)
    baskets = {k: set(rng.sample(range(60), 4)) for k in range(400)}
    for k in range(40):
        baskets[k] |= {100, 101}
    df = spark.createDataFrame([(str(b), f"i{i}") for b, xs in baskets.items() for i in xs], "basket string, item string")
    pairs = cooccur.pair_counts(df, 400)
    out = surprise.surprise(pairs, df).toPandas().set_index(["a", "b"])
    assert len(out) == pairs.count() and out.q_value.between(0, 1).all()
    assert out.loc[("i100", "i101"), "q_value"] < 1e-6 and (out.drop(("i100", "i101")).q_value > 0.01).mean() > 0.98
    assert surprise.surprise(cooccur.pair_counts(df.limit(0), 0), df.limit(0)).count() == 0


def test_near_is_one_edit():
    assert all(names.near(a, b) for a, b in [("abc", "abc"), ("abc", "abd"), ("abc", "acb"), ("abc", "ab"), ("abc", "xabc")])
    assert not any(names.near(a, b) for a, b in [("abc", "bca"), ("abcd", "badc"), ("abc", "abcde"), ("abc", "xyz")])


def test_deletes_miss_no_neighbour():
    rng = random.Random(2)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(5, 8))) for _ in range(250)}
    for a, b in combinations(sorted(words), 2):
        if names.near(a, b):
            assert names.deletes(a) & names.deletes(b), (a, b)


def test_assignment_against_brute_force():
    from itertools import permutations

    rng = random.Random(8)
    for _ in range(200):
        n = rng.randrange(0, 6)
        costs = [[rng.choice([0.0, 0.5, 1.0, 3.0, 1e6]) + rng.random() for _ in range(n)] for _ in range(n)]
        want = min(sum(costs[i][p[i]] for i in range(n)) for p in permutations(range(n)))
        assert math.isclose(names.assign(costs), want, abs_tol=1e-6)
    long = [f"word{k}x" for k in range(9)]
    assert names.align(long[::-1], long) < 0.1 and names.align(["zzzz", *long[1:]], long) == float("inf")


def test_alignment():
    assert names.align(["mgmt", "cap"], ["capital", "management"]) < 3
    assert names.align(["e", "h"], ["energy", "holding"]) < 3
    assert names.align(["r", "i"], ["energy", "holding"]) == float("inf")
    assert names.abbreviates("bk", "bank") and not names.abbreviates("kb", "bank")


def variants(spark, people, orgs=()):
    items = [mention(mention_id=k, normalized=v, entity_type="PERSON", source_doc=d) for k, (v, d) in enumerate(people)] + [mention(mention_id=900 + k, normalized=v, entity_type="ORG") for k, v in enumerate(orgs)]
    return set(rows(names.variant_pairs(names.classes(mentions(spark, items))), "normalized_a", "normalized_b"))


def pairs_of(*groups):
    return {tuple(sorted(p)) for g in groups for p in combinations(g, 2)}


def test_name_variants(spark):
    robert = ["robert parapusanov", "bob parapusanov", "r. parapusanov", "parapusanov, robert", "robert parap- usanov", "роберт парапусанов", "roobert parapusanov", "robert parapu5anov"]
    maria = ["margaret mekoletes", "мэгги меколетес", "margaret k. mekoletes"]
    other = ["olga mekoletes", "ольга меколетес"]
    bank = ["toluroko commercial bank", "the toluroko commercial bank", "toluroko commercial bank ltd", "толуроко коммерческий банк", "commercial bank toluroko", "toluroko c.b", "toluroko-commercial-bank"]
    fund = ["toluroko energy holding", "ооо «толуроко энерго холдинг"]
    base = [f"{w} commercial bank" for w in ("sezokusi", "fesomitre", "votrusepa")] + [f"{w} energy holding" for w in ("sezokusi", "gikresure", "limestutu")]
    people = [(v, "d1") for v in robert + maria] + [(v, "d2") for v in other]
    got = variants(spark, people, bank + fund + base * 2)
    assert got == pairs_of(robert, maria, other, bank, fund)


def test_surname_alone_goes_by_documents(spark):
    people = [("margaret mekoletes", "a"), ("margaret mekoletes", "b"), ("robert mekoletes", "c"), ("prof. mekoletes", "c")]
    assert variants(spark, people) == {("prof. mekoletes", "robert mekoletes")}


def test_name_edge_cases(spark):
    people = [(None, "d"), ("  ", "d"), ("...", "d"), ("x" * 5000, "d"), ("anna", "d"), ("anna", "d")]
    assert variants(spark, people) == set()
    assert names.classes(mentions(spark, [mention()]).limit(0)).count() == 0


def sequential_reading(kind, word, partners):
    """(canonical form, weight) of a word, one candidate after the other."""
    known = {"PERSON": names.CANON_GIVEN, "ORG": names.CANON_ORG}[kind]
    own = partners.get((kind, word), 0)
    if word in known:
        return known[word], 1_000_000 + own
    best = ("", own)
    if len(word) >= 4:
        targets = sorted(w for w in {*known, *(w for k, w in partners if k == kind and partners[k, w] >= 6)} if len(w) >= 4)
        for d in sorted(names.deletes(word) | {word.replace("rn", "m")}):
            for w in targets:
                if d in names.deletes(w) and w != word and (names.near(w, word) or w == word.replace("rn", "m")):
                    weight = partners.get((kind, w), 0) + (500_000 if w in known else 0)
                    if weight > best[1] * 4:
                        best = (w, weight)
    return (known.get(best[0], best[0]), best[1]) if best[0] else (word, own)


def test_word_readings_one_by_one(spark):
    rng = random.Random(4)
    pool = ["".join(rng.choice("abrnm") for _ in range(rng.randrange(2, 8))) for _ in range(400)] + ["robert", "robet", "bank", "bamk", "bnak", "energo", "enegro", "rnaria", "maria"]
    words = sorted({(rng.choice(["PERSON", "ORG"]), w) for w in pool})
    partners = {key: rng.choice([3, 5, 6, 30, 200, 1000]) for key in words if rng.random() < 0.6}
    common = spark.createDataFrame([(k, w, n) for (k, w), n in partners.items()], "kind string, w string, k long")
    got = {(r["kind"], r["w"]): (r["canon"], r["weight"]) for r in names.word_readings(spark.createDataFrame(words, "kind string, w string"), common).collect()}
    assert got == {key: sequential_reading(*key, partners) for key in words}


def test_alignments_and_kinds_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["energy", "enrgy", "eenrgy", "energies", "holding", "hldng", "bank", "bnak", "bk", "commercial", "cml", "capital", "cap", "group"]
    made = {" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 4))) for _ in range(150)}
    counts = {p: rng.randrange(2, 9) for p in sorted(made)}
    asked = made | {"", "b", "b c", " b", "e h", "x", "h e b", "energy x", "bank bank b"}
    aligned = names.alignments(spark.createDataFrame([(p,) for p in sorted(asked)], "p string"), spark.createDataFrame([(p,) for p in sorted(made)], "q string"))
    cost = lambda p, q: names.align(p.split(" "), q.split(" "))
    assert rows(aligned, "p", "q", "cost") == sorted(((p, q, cost(p, q)) for p in asked for q in made if cost(p, q) < 1e6), key=repr)
    kinds = []
    for p in sorted(made, key=lambda p: (-counts[p], p)):
        if not any(cost(p, q) < 1e6 for q in kinds):
            kinds.append(p)
    phrases = spark.createDataFrame([(p, n) for p, n in counts.items()], "p string, count long")
    assert rows(names.kinds_of_organisation(phrases, aligned), "q") == sorted(((q,) for q in kinds), key=repr)


def test_any_number_of_common_words(spark):
    """20,000 words with seven partners each don't keep words with six from counting."""
    letters = "bcdfghjklmnpqrstvwxz"
    words = [a + "o" + b + "u" + c + "i" + d for a in letters for b in letters for c in letters for d in letters][::8]
    people = [" ".join([*words[k : k + 20], f"qy{n}".translate(str.maketrans("0123456", "abcdefg")) * 2]) for k in range(0, 20_000, 20) for n in range(7)]
    orgs = [f"{own} kyrbano velmyta" for own in ("toluroko", "sezokusi", "fesomitre", "votrusepa", "gikresure", "limestutu")]
    items = [mention(normalized=v, entity_type="PERSON", source_doc=None) for v in people] + [mention(normalized=v) for v in [*orgs, "velmyta kyrbano toluroko"]]
    classed = dict(rows(names.classes(mentions(spark, items)).filter("kind = 'ORG'"), "value", "cls"))
    assert len(words) == 20_000 and len(set(classed.values())) == 6
    assert classed["velmyta kyrbano toluroko"] == classed["toluroko kyrbano velmyta"]


def test_any_number_of_kinds_of_organisation(spark):
    """2,000 kinds with three names each don't keep a kind with two from being known."""
    letters = "bcdfghjklmnpqrstvwxz"
    words = [a + "a" + b + "e" + a + "a" + b for a in letters for b in letters][::6]
    kinds = list(combinations(words, 2))[:2_000]
    own = [a + "o" + b + "u" + c + "i" + d for a in letters for b in letters for c in letters for d in letters][::26]
    orgs = [f"{own[3 * k + n]} {a} {b}" for k, (a, b) in enumerate(kinds) for n in range(3)]
    rare = [f"{w} {words[-1]} {words[-2]}" for w in ("toluroko", "sezokusi")]
    other = f"toluroko {words[-2]} {words[-1]}"
    classed = dict(rows(names.classes(mentions(spark, [mention(normalized=v) for v in [*orgs, *rare, other]])), "value", "cls"))
    assert len(kinds) == 2_000 and classed[other] == classed[rare[0]] != classed[rare[1]]
