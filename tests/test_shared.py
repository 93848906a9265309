"""Shared pieces: components, pair counts, bounded results, intermediate tables."""

from pyspark.sql import functions as F

from layoutgraph.operators import components
from tests.conftest import rows


def test_components(spark):
    nodes = spark.createDataFrame([(f"n{k:02d}",) for k in range(20)], "id string")
    edges = spark.createDataFrame([(f"n{k:02d}", f"n{k + 1:02d}") for k in range(10)] + [("n15", "n12")], "a string, b string")
    got = dict(rows(components.components(nodes, edges), "id", "cls"))
    assert {got[f"n{k:02d}"] for k in range(11)} == {"n00"} and got["n15"] == "n12" and got["n19"] == "n19"


def test_bounded_results(spark):
    from layoutgraph.plans.bounded import most_frequent, sample

    df = spark.range(5000).withColumn("n", F.col("id") % 50)
    got = sample(df, 400, "id")
    assert 250 < len(got) <= 400 and got == sample(df, 400, "id") and len(sample(df, 5000, "id")) == 5000 and sample(df.limit(0), 5, "id") == []
    top = most_frequent(df, "n", 250)
    assert len(top) == 250 and [r["n"] for r in top] == [49] * 100 + [48] * 100 + [47] * 50
    assert [r["id"] for r in most_frequent(df, "n", 3)] == [49, 99, 149] and most_frequent(df.limit(0), "n", 9) == []
    alike = df.withColumn("t", F.lit("same"))
    assert len(sample(alike, 10, "t")) == 10
    spread = [sorted(r["id"] for r in sample(df.repartition(k), 300, "id")) for k in (1, 9)]
    assert spread[0] == spread[1]


def test_samples_are_the_sample_of_each_value(spark):
    from layoutgraph.plans.bounded import sample, samples

    df = spark.range(3000).selectExpr("case when id < 2000 then 'many' when id < 2010 then 'few' when id < 2500 then 'alike' else 'more' end as kind", "if(id between 2010 and 2499, 0, id) as id")
    got = samples(df, 100, "kind", "id")
    assert set(got) == {"many", "few", "alike", "more"} and len(got["few"]) == 10 and len(got["alike"]) == 100
    for kind, found in got.items():
        assert sorted(found) == sorted(sample(df.filter(df.kind == kind), 100, "id"))
    assert samples(df.limit(0), 100, "kind", "id") == {} and samples(df, 0, "kind", "id")["many"] == []


def test_pairs_of_large_baskets(spark, monkeypatch):
    from layoutgraph.operators import cooccur

    df = spark.createDataFrame([(b, f"i{k}") for b in ("x", "y") for k in range(30)], "basket string, item string")
    small = rows(cooccur.pair_counts(df, 2), "a", "b", "n_ab")
    monkeypatch.setattr(cooccur, "BASKET_LIMIT", 10)
    monkeypatch.setattr(cooccur, "BLOCK", 7)
    assert rows(cooccur.pair_counts(df, 2), "a", "b", "n_ab") == small and len(small) == 435


def test_tables_are_released(spark):
    import os

    from layoutgraph.plans import session

    session.cut(spark.range(3), "release")
    path = session._written[-1]
    kept = list(session._written[:-1])
    session._written[:] = [path]
    assert os.path.isdir(path)
    session.release(spark)
    session._written[:] = kept
    assert not os.path.exists(path)


def test_components_until_settled(spark):
    nodes = spark.createDataFrame([(k,) for k in range(20)], "id long")
    edges = spark.createDataFrame([(k, k + 1) for k in range(19)], "a long, b long")
    assert {r[1] for r in rows(components.components(nodes, edges), "id", "cls")} == {0}
