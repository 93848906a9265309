"""Sources, sinks, streaming and the whole pipeline."""

import json
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from layoutgraph.plans import pipeline
from layoutgraph.sources import export, layout
from layoutgraph.streaming import ingest
from tests.conftest import rows

DOC = [
    {"type": "text", "text": "# Overview", "text_level": 1, "page_idx": 0},
    {"type": "text", "text": "Markowitz wrote on portfolio choice and Sharpe followed him. Markowitz and Sharpe are often named together in reports.", "page_idx": 0},
    {"type": "image", "img_path": "images/a.png", "page_idx": 0},
    {"type": "text", "text": "Figure 1. Frontier", "page_idx": 0},
]


def test_sources(spark, tmp_path):
    for name in ("a.pdf", "b.PDF", "~$c.docx", ".d.pdf", "e.txt", "sub/f.png"):
        p = tmp_path / "in" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(name.encode())
    files = layout.source_files(spark, str(tmp_path / "in"))
    assert [r[0] for r in rows(files, "doc_name")] == ["a", "b", "f"]
    done = files.filter("doc_name = 'a'").select("source_hash")
    assert [r[0] for r in rows(layout.new_files(files, done), "doc_name")] == ["b", "f"]


def test_parser_output(spark, tmp_path):
    for doc, name, text in (("x", "auto/x_content_list.json", "[1]"), ("x", "x_middle.json", "[2]"), ("x", "auto/x.md", "# m"), ("y", "y_model.json", "[3]"), ("y", "y.md", "only")):
        p = tmp_path / doc / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    assert rows(layout.parser_output(spark, str(tmp_path)), "doc", "json", "markdown") == [("x", "[1]", "# m"), ("y", None, "only")]


def test_pipeline_and_exports(spark, tmp_path):
    parsed = spark.createDataFrame([("a" * 32, "one", json.dumps(DOC)), ("b" * 32, "two", json.dumps(DOC))], "source_hash string, source_doc string, json string")
    made = pipeline.run(spark, parsed, str(tmp_path / "out"))
    assert made["elements"].count() == 8 and made["chunks"].count() == 2
    assert {r["text"] for r in made["resolved"].collect()} >= {"Markowitz", "Sharpe"}
    assert ("markowitz", "sharpe", 2) in rows(made["co_edges"], "a", "b", "weight")
    assert {"DISCUSSED_NEAR", "HAS_CAPTION", "MENTIONED_IN"} <= {r[0] for r in rows(made["link_edges"], "relation")}
    export.write_graphml(made["link_nodes"], made["link_edges"], str(tmp_path / "g"))
    text = "\n".join(p.read_text().rstrip("\n") for p in sorted((tmp_path / "g").glob("part-*")))
    root = ET.fromstring(text)
    ns = "{http://graphml.graphdrawing.org/xmlns}"
    assert len(root.findall(f".//{ns}node")) == made["link_nodes"].count() and len(root.findall(f".//{ns}edge")) == made["link_edges"].count()
    export.write_html(made["link_nodes"], made["link_edges"], str(tmp_path / "v.html"))
    assert "Markowitz" in (tmp_path / "v.html").read_text()
    export.write_tables({"chunks": made["chunks"]}, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json/chunks")).count() == 2


class Names:
    """A recogniser of known names in any script."""

    def extract(self, text, chunk_id):
        return [(n, kind, 0.7, text.index(n), text.index(n) + len(n)) for n, kind in (("Иван Петров", "PERSON"), ("Банк России", "ORG"), ("清华大学", "ORG"), ("ЦБ", "ORG")) if n in text]


def test_pipeline_with_recogniser(spark, tmp_path):
    doc = [{"type": "text", "text": "# Обзор", "text_level": 1, "page_idx": 0}, {"type": "text", "text": "Иван Петров пишет, что Банк России и 清华大学 изучают риск. ЦБ с этим согласен, как и другие участники рынка.", "page_idx": 0}]
    parsed = spark.createDataFrame([("c" * 32, "три", json.dumps(doc))], "source_hash string, source_doc string, json string")
    made = pipeline.run(spark, parsed, str(tmp_path / "out"), recogniser=Names, engine="names")
    assert rows(made["mentions"], "text", "entity_type", "confidence", "engine") == sorted((n, k, 0.7, "names") for n, k in (("Иван Петров", "PERSON"), ("Банк России", "ORG"), ("清华大学", "ORG"), ("ЦБ", "ORG")))
    assert ("банк россии", "иван петров", 1) in rows(made["co_edges"], "a", "b", "weight")
    assert made["link_edges"].filter("relation = 'MENTIONED_IN'").count() >= 4
    assert pipeline.load_factory("tests.test_pipeline:Names").__name__ == "Names"


def test_html_refuses_large_views(spark, tmp_path):
    nodes = spark.range(20).select(F.col("id").cast("string").alias("id"), F.lit("entity").alias("node_type"))
    edges = spark.range(20).select(F.col("id").cast("string").alias("source"), F.lit("x").alias("target"), F.lit("R").alias("relation"), F.lit(1.0).alias("weight"))
    try:
        export.write_html(nodes, edges, str(tmp_path / "v.html"), limit=10)
        raise AssertionError
    except ValueError:
        pass


def test_streaming(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = lambda h: json.dumps({"source_hash": h, "json": json.dumps(DOC), "arrived_at": "2024-01-01T00:00:00Z"}) + "\n"
    (tmp_path / "in/1.json").write_text(line("a" * 32) + line("a" * 32))
    run = lambda: ingest.write_structure(ingest.read_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    (tmp_path / "in/2.json").write_text(line("b" * 32) + line("a" * 32))
    run()
    assert rows(spark.read.parquet(str(tmp_path / "out/elements")).groupBy("source_hash").count(), "source_hash", "count") == [("a" * 32, 4), ("b" * 32, 4)]


def test_pipeline_reads_markdown_and_twins(spark, tmp_path):
    doc = json.dumps([{"type": "text", "text": "Head", "text_level": 1, "page_idx": 0}, {"type": "text", "text": "Some Bank wrote this long sentence about the market and its many risks.", "page_idx": 0}])
    md = "# Overview\n\nAnother Company wrote this other long sentence about the market and its many risks."
    parsed = spark.createDataFrame([("a" * 32, "one", doc, None), ("b" * 32, "two", doc, None), ("c" * 32, "three", None, md), ("d" * 32, "four", "[]", md), ("e" * 32, "five", None, None)], "source_hash string, source_doc string, json string, markdown string")
    made = pipeline.run(spark, parsed, str(tmp_path / "out"))
    assert rows(made["chunks"].groupBy("source_doc").count(), "source_doc", "count") == [("four", 1), ("one", 1), ("three", 1), ("two", 1)]
    assert made["elements"].groupBy("element_id").count().filter("count > 1").count() == 0
    assert made["link_summary"].first()["document_nodes"] == 5 and "degree" in made["co_nodes"].columns and "community" in made["co_nodes"].columns
    lines = [r[1] for r in export.graphml_lines(made["co_nodes"], made["co_edges"], "item", "a", "b", directed=False).orderBy("ord").collect()]
    assert any('edgedefault="undirected"' in x for x in lines)
