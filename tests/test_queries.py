"""Every core query with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from layoutgraph.plans import catalogue

SQL = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def canon(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, data, name):
    df = catalogue.queries()[name](spark, data)
    cols = sorted(df.columns)
    got = sorted(tuple(map(canon, r)) for r in df.select(*cols).collect())
    res = con.execute(SQL[name])
    have = [d[0] for d in res.description]
    assert sorted(have) == cols
    assert got == sorted(tuple(canon(r[have.index(c)]) for c in cols) for r in res.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(SQL)))
def test_runs(spark, data, name):
    assert catalogue.queries()[name](spark, data).count() >= 0


def test_partitions_do_not_matter(spark, data):
    from tests.conftest import rows

    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    for n in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append([rows(catalogue.queries()[q](spark, data), "*") for q in ("section_chunks", "entity_clusters", "dedup_entities")])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]
