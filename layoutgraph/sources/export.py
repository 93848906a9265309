"""Writers: tables as JSON or Parquet, graphs as GraphML, JSON lines and a self-contained HTML page.

GraphML and JSON of a graph are written by Spark, one line a node or edge, so a graph of any size can be exported; only
the HTML page, which a browser has to hold, asks for a bounded view.
"""

from __future__ import annotations

import html
import json
import os

from pyspark.sql import DataFrame, functions as F

HTML_LIMIT = 5_000  # edges of a page; a larger view is refused, not cut
COLORS = {"document": "#555555", "chunk": "#2f6fb0", "entity": "#3a8f3a", "figure": "#b8452a", "table": "#9c7a00", "caption": "#7a5ab0", "formula": "#a03070", "title": "#2a8f8f"}


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "json") -> None:
    """Each table below ``folder``, nested columns kept."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).save(f"{folder}/{name}")


def _xml(c):
    out = F.coalesce(c.cast("string"), F.lit(""))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def _plain(df: DataFrame, c: str):
    """Scalars as they are, null as '', anything nested as JSON."""
    kind = dict(df.dtypes)[c]
    return F.coalesce(F.to_json(c) if kind.startswith(("array", "struct", "map")) else F.col(c).cast("string"), F.lit(""))


def graphml_lines(nodes: DataFrame, edges: DataFrame, node_id: str = "id", source: str = "source", target: str = "target", directed: bool = True) -> DataFrame:
    """(ord, line): a GraphML document, header first."""
    nk = [c for c in nodes.columns if c != node_id]
    ek = [c for c in edges.columns if c not in (source, target)]
    spark = nodes.sparkSession
    keys = [f'<key id="n_{c}" for="node" attr.name="{c}" attr.type="string"/>' for c in nk] + [f'<key id="e_{c}" for="edge" attr.name="{c}" attr.type="string"/>' for c in ek]
    head = ['<?xml version="1.0" encoding="UTF-8"?>', '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">', *keys, f'<graph edgedefault="{"directed" if directed else "undirected"}">']
    first = spark.createDataFrame([(k, line) for k, line in enumerate(head)], "ord long, line string")
    data = lambda df, p, cols: [F.concat(F.lit(f'<data key="{p}_{c}">'), _xml(_plain(df, c)), F.lit("</data>")) for c in cols]
    ns = nodes.select(F.lit(10**6).alias("ord"), F.concat(F.lit('<node id="'), _xml(F.col(node_id)), F.lit('">'), *data(nodes, "n", nk), F.lit("</node>")).alias("line"))
    es = edges.select(F.lit(2 * 10**6).alias("ord"), F.concat(F.lit('<edge source="'), _xml(F.col(source)), F.lit('" target="'), _xml(F.col(target)), F.lit('">'), *data(edges, "e", ek), F.lit("</edge>")).alias("line"))
    last = spark.createDataFrame([(3 * 10**6, "</graph>"), (3 * 10**6 + 1, "</graphml>")], "ord long, line string")
    return first.unionByName(ns).unionByName(es).unionByName(last)


def write_graphml(nodes: DataFrame, edges: DataFrame, folder: str, **names: str | bool) -> None:
    """GraphML as ordered part files below ``folder``; their concatenation is the document."""
    graphml_lines(nodes, edges, **names).orderBy("ord", "line").select("line").write.mode("overwrite").text(folder)


def graph_json(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with a colour by type and edges with a key, each one JSON string a row."""
    color = F.create_map(*[F.lit(x) for pair in COLORS.items() for x in pair])
    n = nodes.withColumn("color", F.coalesce(F.try_element_at(color, F.col("node_type")), F.lit("#777777")))
    e = edges.withColumn("key", F.concat_ws("|", "source", "target", "relation"))
    return n.select(F.to_json(F.struct(*n.columns)).alias("json")), e.select(F.to_json(F.struct(*e.columns)).alias("json"))


def write_html(nodes: DataFrame, edges: DataFrame, path: str, title: str = "Graph", limit: int = HTML_LIMIT) -> None:
    """A page that lists nodes and edges of a view with a text filter, without outside scripts."""
    if edges.limit(limit + 1).count() > limit or nodes.limit(limit + 1).count() > limit:
        raise ValueError(f"a page holds at most {limit} nodes and edges; narrow the view first")
    n, e = graph_json(nodes, edges)
    data = json.dumps({"nodes": [json.loads(r[0]) for r in n.collect()], "edges": [json.loads(r[0]) for r in e.collect()]}, ensure_ascii=False).replace("</", "<\\/")
    page = (
        f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><input id=q placeholder=filter><ul id=out></ul>"
        f"<script>const g={data};const out=document.getElementById('out');function show(q){{out.textContent='';for(const x of g.edges)"
        "{const t=x.source+' \\u2192 '+x.target+' ('+x.relation+', '+x.weight+')';if(t.toLowerCase().includes(q)){const li=document.createElement('li');li.textContent=t;out.append(li)}}}"
        "document.getElementById('q').oninput=ev=>show(ev.target.value.toLowerCase());show('')</script>"
    )
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(page)
