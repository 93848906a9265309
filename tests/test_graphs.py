"""Entities, resolution, co-occurrence graph and linking graph."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from layoutgraph.operators import cograph, entities as E, linking as L, resolve as R
from layoutgraph.plans import catalogue
from layoutgraph.plans.session import cut
from tests.conftest import rows

MENTIONS = "mention_id long, text string, normalized string, entity_type string, confidence double, chunk_id string, source_doc string, context string, page_start int, page_end int, section_title string, source_element_ids array<string>, related_element_ids array<string>"


def test_deduplicate(spark):
    df = spark.createDataFrame(
        [(1, "CAPM", "capm", "CONCEPT", 0.8, "c1", "d", "x", 2, 2, "S", ["e1"], ["f1"]), (2, "Capm", "capm", "CONCEPT", 0.9, "c2,c1", "d", "y", 1, 3, "T", ["e2", "e1"], None), (3, "capm", "capm", "CONCEPT", 0.9, "c3", "d", "z", None, None, None, [], ["f1", "f2"]), (4, "x", None, None, float("nan"), None, None, None, None, None, None, None, None)],
        MENTIONS,
    )
    got = {r["normalized"]: r for r in E.deduplicate(df).collect()}
    one = got["capm"]
    assert (one["text"], one["confidence"], one["context"], one["chunk_ids"], one["page_start"], one["page_end"], one["source_element_ids"], one["related_element_ids"], one["mentions"]) == ("Capm", 0.9, "y", ["c1", "c2", "c3"], 1, 3, ["e1", "e2"], ["f1", "f2"], 3)
    assert got[None]["confidence"] is None and got[None]["chunk_ids"] == []


def test_noise_filters(spark):
    names = ["a", "12.5", "рис", "x" * 201, "CAPM", "Beta Fund", "ARIMA", "nyse", "\\frac{a}", "Delta", "AB1"]
    df = spark.createDataFrame([(k, n, n.lower(), "CONCEPT") for k, n in enumerate(names)] + [(99, "12.5", "12.5", "DATE"), (98, "seven", "seven", "NUMBER"), (97, None, None, None)], "mention_id long, text string, normalized string, entity_type string")
    kept = lambda d: [r[0] for r in rows(d, "text")]
    assert kept(E.drop_noise(df)) == ["12.5", "AB1", "ARIMA", "Beta Fund", "CAPM", "Delta", "\\frac{a}", "nyse", "seven"]
    assert kept(R.strict_entities(df)) == ["AB1", "CAPM", "рис"]
    reasons = dict(rows(df.select("mention_id", R.noise_reason().alias("r")), "mention_id", "r"))
    assert reasons[98] == "skip_type" and reasons[0] == "too_short" and reasons[1] == "noise_pattern" and reasons[3] == "too_long" and reasons[4] is None


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a):
        cur = [i + 1]
        for j, y in enumerate(b):
            cur.append(min(prev[j + 1] + 1, cur[-1] + 1, prev[j] + (x != y)))
        prev = cur
    return prev[-1]


def similar(a, b, inside, edit):
    if min(len(a), len(b)) >= inside and (a in b or b in a):
        return True
    return min(len(a), len(b)) >= edit and lev(a, b) <= 2 and lev(a, b) / max(len(a), len(b)) < 0.2


def random_names(rng, n):
    base = ["".join(rng.choice("abcd") for _ in range(rng.randrange(3, 16))) for _ in range(n)]
    out = set(base)
    for w in base:
        k = rng.randrange(len(w))
        out |= {w[:k] + rng.choice("abcd") + w[k + 1 :], w[:k] + w[k + 1 :], w + " holding"}
    return sorted(x for x in out if x)


def test_similar_names_against_brute_force(spark):
    words = random_names(random.Random(1), 60)
    df = spark.createDataFrame([(w,) for w in words] + [(None,), (words[0],)], "name string")
    for strict, inside, edit in ((True, 4, 6), (False, 3, 5)):
        want = {(a, b) for a, b in combinations(words, 2) if similar(a, b, inside, edit)}
        assert set(rows(R.similar_names(df, strict), "a", "b")) == want


def test_greedy_clusters_against_plain_python(spark):
    rng = random.Random(6)
    for trial in range(3):
        names = [f"n{k}" for k in range(30)]
        size = {n: rng.randrange(1, 4) for n in names}
        pairs = {tuple(sorted(rng.sample(names, 2))) for _ in range(35)}
        order = sorted(names, key=lambda n: (-size[n], names.index(n)))
        merged: dict[str, str] = {}
        for i, a in enumerate(order):
            if a in merged:
                continue
            for b in order[i + 1 :]:
                if b not in merged and tuple(sorted((a, b))) in pairs:
                    merged[b] = a
        want = {(n, merged.get(n, n)) for n in names}
        df = spark.createDataFrame([(n, size[n], names.index(n)) for n in names], "name string, size long, first long")
        assert set(rows(R.greedy_clusters(df, spark.createDataFrame(list(pairs), "a string, b string")), "name", "canonical")) == want


def test_long_chain_of_similar_names(spark):
    """Each round settles one name of a chain; none may be left without a canonical name."""
    names = [f"n{k:02}" for k in range(54)]
    df = spark.createDataFrame([(n, 1, k) for k, n in enumerate(names)], "name string, size long, first long").coalesce(1)
    pairs = spark.createDataFrame(list(zip(names, names[1:])), "a string, b string").coalesce(1)
    assert rows(R.greedy_clusters(df, pairs), "name", "canonical") == [(n, names[k - k % 2]) for k, n in enumerate(names)]


def test_cooccurrence_graph(spark):
    m = spark.createDataFrame([("c1", "a"), ("c1", "b"), ("c2", "a"), ("c2", "b"), ("c2", "d"), ("c3", "e")], "basket string, item string")
    edges = cograph.edges(m, 2)
    assert rows(edges, "a", "b", "weight") == [("a", "b", 2)]
    assert rows(cograph.isolates(m.select("item").distinct(), edges), "item") == [("d",), ("e",)]
    assert rows(cograph.density(m.select("item"), cograph.edges(m)), "nodes", "edges", "density", "mean_degree", "max_degree") == [(4, 3, 0.5, 1.5, 2)]


def test_graph_metrics(spark):
    pairs = [("a", "b", 5), ("b", "c", 5), ("a", "c", 5), ("c", "d", 1), ("d", "e", 5), ("x", "y", 1)]
    edges = spark.createDataFrame(pairs, "a string, b string, weight long")
    assert dict(rows(cograph.connected(edges), "item", "component")) == {**{k: "a" for k in "abcde"}, "x": "x", "y": "x"}
    rank = {n: 1 / 7 for n in "abcdexy"}
    out = {n: sum(w for a, b, w in pairs if n in (a, b)) for n in rank}
    for _ in range(20):
        new = {n: 0.15 / 7 for n in rank}
        for a, b, w in pairs:
            new[a] += 0.85 * rank[b] * w / out[b]
            new[b] += 0.85 * rank[a] * w / out[a]
        rank = new
    got = dict(rows(cograph.pagerank(edges, rounds=20, tolerance=0), "item", "rank"))
    assert all(abs(got[n] - rank[n]) < 1e-9 for n in rank)
    com = dict(rows(cograph.communities(edges), "item", "community"))
    assert com["a"] == com["b"] == com["c"] and com["d"] == com["e"] and com["x"] == com["y"] and com["x"] != com["a"]
    none = edges.limit(0)
    assert cograph.pagerank(none).count() == 0 and cograph.connected(none).count() == 0 and cograph.communities(none).count() == 0


META = "struct<caption_element_id:string,linked_element_id:string,relation:string,text_level:int>"


def linking_case(spark, ents, chunk_source, chunk_related):
    el = spark.createDataFrame([("h", "d", "fig", "figure", "F", 2, None, None, "S", ("cap", None, None, None)), ("h", "d", "cap", "caption", "C", 2, None, None, "S", (None, "fig", "caption_of", None))], f"source_hash string, source_doc string, element_id string, element_type string, text string, page_number int, ref_label string, caption string, section_title string, metadata {META}")
    ch = spark.createDataFrame([(f"c{k}", "h", "d", "S", 2, 2, s, r) for k, (s, r) in enumerate(zip(chunk_source, chunk_related))], "chunk_id string, source_hash string, source_doc string, section_title string, page_start int, page_end int, source_element_ids array<string>, related_element_ids array<string>")
    en = spark.createDataFrame(ents, "source_doc string, normalized string, entity_type string, text string, confidence double, section_title string, page_start int, page_end int, chunk_ids array<string>, source_element_ids array<string>, related_element_ids array<string>")
    docs = spark.createDataFrame([("h", "d")], "source_hash string, source_doc string")
    return docs, ch, el, en


def test_linking_scores(spark):
    ents = [("d", "arima", "CONCEPT", "ARIMA", 0.9, None, None, None, ["c0"], ["cap"], ["fig"])]
    docs, ch, el, en = linking_case(spark, ents, [["cap"]], [["fig"]])
    cand = L.discussed_near(en, el, ch)
    assert rows(cand, "element_id", "score_e4", "reasons") == [("cap", 50650, "source_element"), ("fig", 30650, "related_element")]
    edges = L.structural_edges(docs, ch, el, en).unionByName(L.near_edges(L.ranked_links(cand)))
    got = {(r["relation"]): r for r in edges.collect()}
    assert {"MENTIONED_IN", "DISCUSSED_NEAR", "HAS_CAPTION", "CAPTION_OF", "CONTAINS_CHUNK", "CONTAINS_ELEMENT", "EXTRACTED_FROM", "RELATED_TO"} == set(got)
    assert got["HAS_CAPTION"]["weight"] == 2.0
    assert rows(L.link_metrics(cand), "candidates", "kept", "pruned") == [(2, 2, 0)]
    assert all(r[1] for r in rows(L.artifact_checks(edges, L.link_metrics(cand)), "check", "ok"))


def test_linking_top_n(spark):
    ents = [("d", n.lower(), "CONCEPT", n, 0.9, "S", 2, 2, [f"c{k}"], [], ["fig"]) for k, n in enumerate(["VAR", "ARIMA", "MAPE"])]
    docs, ch, el, en = linking_case(spark, ents, [[]] * 3, [["fig"]] * 3)
    cand = L.discussed_near(en, el, ch)
    assert [r[0] for r in rows(L.ranked_links(cand, 2), "entity_label")] == ["ARIMA", "MAPE"]
    assert rows(L.link_metrics(cand, 2), "candidates", "kept", "pruned") == [(3, 2, 1)]
    assert L.ranked_links(cand, 0).count() == 3


def test_views(spark):
    ents = [("d", "arima", "CONCEPT", "ARIMA", 0.9, "S", 2, 2, ["c0"], [], ["fig"])]
    docs, ch, el, en = linking_case(spark, ents, [[]], [["fig"]])
    nodes = L.nodes(docs, ch, el, en)
    edges = L.structural_edges(docs, ch, el, en).unionByName(L.near_edges(L.ranked_links(L.discussed_near(en, el, ch))))
    ent = "entity::d::CONCEPT::arima"
    assert [r[0] for r in rows(L.view_elements(nodes, edges, ["figure"]), "id")] == ["element::cap", "element::fig", ent]
    assert [r[0] for r in rows(L.view_core(nodes, edges), "id")] == ["doc::d", "element::cap", "element::fig", ent]
    assert {r[0] for r in rows(L.view_search(nodes, "arim"), "id")} == {ent}
    assert {r[0] for r in rows(L.view_scope(nodes, page=3), "id")} == {"doc::d"}
    assert L.view_focus(edges, ent).count() == 4
    assert {r[2] for r in rows(L.visible_edges(edges, L.view_core(nodes, edges), ["HAS_CAPTION"]), "source", "target", "relation")} == {"HAS_CAPTION"}


class Keyword:
    def extract(self, text, chunk_id):
        if chunk_id == "bad":
            raise ValueError
        if "CAPM" in text:
            yield ("CAPM", "CONCEPT", 0.9, text.index("CAPM"), text.index("CAPM") + 4)


def test_recogniser(spark):
    df = spark.createDataFrame([("c1", "The CAPM model"), ("c2", "none"), ("bad", "CAPM"), ("c3", None)], "chunk_id string, text string")
    found = E.recognise(df, Keyword, "rule")
    assert rows(E.failures(found), "chunk_id") == [("bad",)]
    assert rows(E.candidate_filter(found), "chunk_id", "text", "start_char", "engine") == [("c1", "CAPM", 4, "rule")]


def test_model_answers():
    assert E.parse_answer('```json\n[{"text": "CAPM", "type": "CONCEPT"}, 3, {"type": "X"}]\n```') == [("CAPM", "CONCEPT", 0.9)]
    assert E.parse_answer('Sure: [{"text": "A", "confidence": 0.5}] done') == [("A", "UNKNOWN", 0.5)]
    assert E.parse_answer("no") == [] and E.parse_answer(None) == []


def test_resolved(spark):
    df = spark.createDataFrame([("d1", "capm", "CONCEPT", "CAPM", 0.5, "long context", ["c1"], 1), ("d2", "capm", "ORG", "Capm", 0.9, "x", ["c2"], 2), ("d1", "capms", "CONCEPT", "CAPMs", 0.4, None, ["c1"], 3)], "source_doc string, normalized string, entity_type string, text string, confidence double, context string, chunk_ids array<string>, first_mention long").withColumns({"source_element_ids": F.array().cast("array<string>"), "related_element_ids": F.array().cast("array<string>")})
    cl = spark.createDataFrame([("capm", "capm"), ("capms", "capm")], "name string, canonical string")
    r = R.resolved_entities(df, cl).first()
    assert (r["text"], r["entity_type"], r["confidence"], r["frequency"], r["chunk_ids"], r["source_docs"], r["context"], r["aliases"]) == ("CAPM", "CONCEPT", 0.9, 3, ["c1", "c2"], ["d1", "d2"], "long context", ["CAPMs", "Capm"])


def test_pagerank_settles(spark):
    edges = spark.createDataFrame([("a", "b", 5), ("b", "c", 5), ("c", "d", 1), ("d", "e", 5)], "a string, b string, weight long")
    short, long = (dict(rows(cograph.pagerank(edges, **kw), "item", "rank")) for kw in ({}, {"rounds": 150, "tolerance": 0}))
    assert all(abs(short[k] - long[k]) < 1e-4 for k in long)
    assert rows(cograph.top_ranked(cograph.pagerank(edges), 2), "item") == [("b",), ("d",)]


def test_metrics_row(spark):
    edges = spark.createDataFrame([("a", "b", 5), ("b", "c", 5), ("x", "y", 1)], "a string, b string, weight long")
    assert rows(cograph.metrics(edges), "nodes", "edges", "density", "mean_degree", "max_degree", "max_degree_node", "components", "largest_component") == [(5, 3, 0.3, 1.2, 2, "b", 2, 3)]
    assert rows(cograph.metrics(edges.limit(0)), "nodes", "max_degree_node", "components") == [(0, None, 0)]


def test_louvain(spark):
    rng = random.Random(4)
    groups = [[f"{g}{k}" for k in range(8)] for g in "abcd"]
    pairs = {p: 3 for g in groups for p in combinations(g, 2) if rng.random() < 0.8} | {("a0", "b0"): 1, ("b1", "c1"): 1, ("c2", "d2"): 1, ("a3", "d3"): 1}
    edges = spark.createDataFrame([(a, b, w) for (a, b), w in pairs.items()], "a string, b string, weight long")
    found = cograph.louvain(edges)
    assert dict(rows(found, "item", "community")) == {n: g[0] for g in groups for n in g}
    want = sum(w for (a, b), w in pairs.items() if a[0] == b[0]) / sum(pairs.values()) - sum((sum(w * ((a[0] == g) + (b[0] == g)) for (a, b), w in pairs.items()) / 2 / sum(pairs.values())) ** 2 for g in "abcd")
    assert abs(cograph.modularity(edges, found) - want) < 1e-9
    noisy = spark.createDataFrame([(f"n{a:02}", f"n{b:02}", rng.randrange(1, 4)) for a, b in {tuple(sorted(rng.sample(range(60), 2))) for _ in range(200)}], "a string, b string, weight long")
    assert cograph.modularity(noisy, cograph.louvain(noisy)) >= cograph.modularity(noisy, cograph.communities(noisy)) - 1e-9
    assert cograph.louvain(edges.limit(0)).count() == 0


def test_edge_chunks_and_resolved_nodes(spark):
    members = spark.createDataFrame([("c1", "a"), ("c1", "b"), ("c2", "b"), ("c2", "a"), ("c3", "a")], "basket string, item string")
    assert rows(cograph.edge_chunks(members), "a", "b", "weight", "chunks") == [("a", "b", 2, ["c1", "c2"])]


def test_recogniser_failures_and_unions(spark):
    class Picky:
        def extract(self, text, chunk_id):
            if "boom" in text:
                raise RuntimeError("no model")
            return [(w, "ORG", 0.3 if w == "Weak" else 0.9, 0, 4) for w in text.split() if w[0].isupper()]

    chunks = spark.createDataFrame([("c1", "The Bank of somewhere Weak"), ("c2", "boom boom boom boom boom"), ("c3", "Short")], "chunk_id string, text string")
    found = E.recognise(chunks, Picky, "picky")
    assert rows(E.failures(found), "chunk_id", "error") == [("c2", "RuntimeError: no model")]
    assert rows(E.candidate_filter(found, chunks), "chunk_id", "text") == [("c1", "Bank"), ("c1", "The")]
    named = E.recognise(chunks, Picky, "picky", types={"ORG": "COMPANY"})
    assert {r["entity_type"] for r in named.collect()} == {"COMPANY", "FAILED"}
    both = E.unite(E.candidate_filter(found), E.candidate_filter(found).limit(1))
    assert sorted(r["ord"] for r in both.filter("chunk_id = 'c1'").collect()) == list(range(both.filter("chunk_id = 'c1'").count()))


def test_link_summary(spark):
    nodes = spark.createDataFrame([("d", "document"), ("e", "entity"), ("f", "figure"), ("t", "table"), ("c", "caption")], "id string, node_type string")
    edges = spark.createDataFrame([("e", "f", "DISCUSSED_NEAR"), ("e", "t", "DISCUSSED_NEAR"), ("f", "c", "HAS_CAPTION"), ("e", "gone", "RELATED_TO")], "source string, target string, relation string")
    one = L.link_summary(nodes, edges).first().asDict()
    assert (one["nodes"], one["edges"], one["figure_nodes"], one["caption_links"], one["chunk_related_links"], one["entity_figure_links"], one["entity_table_links"]) == (5, 4, 1, 1, 1, 1, 1)
    assert ("RELATED_TO", "unknown", 1) in rows(L.relation_targets(nodes, edges), "relation", "target_type", "n")
    assert L.link_summary(nodes.limit(0), edges.limit(0)).first()["edges"] == 0


def joins_by_broadcast(df):
    """Broadcasts in the plan of small tables under Spark's own threshold, where a list's size is guessed from its source."""
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_grams_and_pieces_are_not_broadcast(spark):
    df = spark.createDataFrame([(w,) for w in random_names(random.Random(3), 20)], "name string")
    for strict in (True, False):
        assert joins_by_broadcast(R.similar_names(df, strict)) == 0


def test_ranks_of_names_are_not_broadcast(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(R, "cut", lambda df, label: (seen.setdefault(label, joins_by_broadcast(df)), cut(df, label))[1])
    df = spark.createDataFrame([("ab", 2, 0), ("abc", 1, 1)], "name string, size long, first long")
    pairs = spark.createDataFrame([("ab", "abc")], "a string, b string")
    assert rows(R.greedy_clusters(df, pairs), "name", "canonical") == [("ab", "ab"), ("abc", "ab")]
    assert seen["earlier"] == 0


def test_related_elements_are_not_broadcast(spark, tmp_path):
    """A short table of long lists: what the planner takes for small is the table."""
    spark.createDataFrame([("x", ["e1", "e2"]), ("y", ["e1"])], "normalized string, related_element_ids array<string>").write.parquet(f"{tmp_path}/r")
    el = spark.createDataFrame([("e1", "figure", "Fig. 1", None, "t"), ("e2", "table", None, "C", "t")], "element_id string, element_type string, ref_label string, caption string, text string")
    refs = R.related_refs(spark.read.parquet(f"{tmp_path}/r"), el)
    assert rows(refs, "normalized", "refs") == [("x", ["C", "Fig. 1"]), ("y", ["Fig. 1"])]
    assert joins_by_broadcast(refs) == 0


@pytest.mark.parametrize("name", ["fuzzy_pairs_baseline", "resolved_graph_edges", "resolved_refs", "resolve_entities", "resolved_graph_nodes", "resolved_top"])
def test_resolution_builds_no_list_on_the_driver(spark, data, monkeypatch, name):
    """The pairs of names behind each query; where they feed clusters, it is stopped once they are planned."""

    class Planned(Exception):
        pass

    def stop(df, label):
        if label != "earlier":
            return cut(df, label)
        raise Planned(joins_by_broadcast(df))

    monkeypatch.setattr(R, "cut", stop)
    try:
        found = joins_by_broadcast(catalogue.queries()[name](spark, data))
    except Planned as planned:
        found = planned.args[0]
    assert found == 0
