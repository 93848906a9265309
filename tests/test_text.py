import pytest
from pyspark.sql import functions as F

from layoutgraph.functions import text as T


def values(spark, fn, items):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(items)], "k int, x string")
    return [r[0] for r in df.orderBy("k").select(fn(F.col("x"))).collect()]


def test_tokens(spark):
    assert values(spark, T.token_estimate, ["", None, "one", "a b c d", "раз два", "  a  b  "]) == [1, 1, 1, 5, 3, 2]


def test_wrappers(spark):
    got = values(spark, T.strip_wrappers, ["## **Bold**", "__x__", "*a*", "**a*", "**", "***", "plain", None, "### _q_ ", "**bold** not"])
    assert got == ["Bold", "x", "a", "*a", "", "*", "plain", "", "q", "**bold** not"]


def test_captions(spark):
    texts = ["Рис. 3. Схема", "РИСУНОК 4", "Fig. 2-1 Plot", "Table IV costs", "табл. 5", "tables of law", "text", None, "**Figure 7**"]
    assert values(spark, T.ref_label, texts) == ["рис. 3", "рис. 4", "figure 2-1", "table iv", "табл. 5", "table", "", "", "figure 7"]
    assert values(spark, T.is_caption, ["figured", "Tablet", "the table"]) == [True, True, False]


def test_sentences(spark):
    got = values(spark, T.sentences, ['One. Two! «Три?» Да. 5 is odd', "e.g. small", "", None])
    assert got == [["One.", "Two!", "«Три?» Да.", "5 is odd"], ["e.g. small"], [], []]


def test_titles(spark):
    df = spark.createDataFrame([("### A", "text", None), ("####### B", "text", None), ("Plain", "title", None), ("Plain", "title", 3), ("ALL CAPS", "text", None), ("body text", "text", None), (None, None, None)], "c string, t string, l int")
    assert [r[0] for r in df.select(T.title_level(F.col("c"), F.col("t"), F.col("l"))).collect()] == [3, 4, 2, 3, 2, 0, 0]
    assert values(spark, T.clean_title, ["## **A b**", "*", "***", "_x_"]) == ["A b", "", "", "x"]


def test_names(spark):
    assert values(spark, T.normalize_entity, ["  CAPM. ", "«Банк  России»", "CAPM .", "(a)"]) == ["capm", "банк россии", "capm ", "a"]


def test_context(spark):
    df = spark.createDataFrame([("x" * 200 + " Alpha " + "y" * 200, "alpha"), ("Alpha", "Alpha"), ("none", "zzz")], "t string, n string")
    got = [r[0] for r in df.select(T.context(F.col("t"), F.col("n"), 3)).collect()]
    assert got == ["...xx Alpha yy...", "Alpha", ""]


@pytest.mark.parametrize("size,step", [(10, 7), (5, 5)])
def test_segments(spark, size, step):
    text = "abcdefghijklmnopqrstuvwxyz"
    want = [text] if len(text) <= size else [text[i : i + size] for i in range(0, len(text), step)]
    assert values(spark, lambda c: T.segments(c, size, step), [text])[0] == want


def test_language_and_ids(spark):
    assert values(spark, T.dominant_language, ["abc где", "abcd где", "где"]) == ["en", "en", "ru"]
    assert values(spark, T.split_ids, ["a, b,,c ", "", None]) == [["a", "b", "c"], [], []]
