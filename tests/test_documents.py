"""Structure, cleaning, chunking and provenance on small hand-made documents, and folds against plain Python."""

import json
import random
import re

from pyspark.sql import functions as F

from layoutgraph.operators import chunking, cleaning, provenance, structure, structure as S
from tests.conftest import rows

ITEMS = [
    {"type": "text", "text": "# Overview", "text_level": 1, "page_idx": 0, "bbox": [0, 0, 1, 1]},
    {"type": "text", "text": "Body of the report.", "page_idx": 0, "bbox": [0, 1, 1, 2]},
    {"type": "image", "img_path": "images/a.png", "image_caption": [], "page_idx": 0, "bbox": [0, 2, 1, 3]},
    {"type": "text", "text": "*Рис. 1. Схема потоков*", "page_idx": 0, "bbox": [0, 3, 1, 4]},
    {"type": "table", "table_body": "<table></table>", "table_caption": ["Табл. 1. Данные"], "page_idx": 1, "bbox": [0, 0, 1, 1]},
    {"type": "text", "text": "   ", "page_idx": 1},
]


def parsed(spark, *docs):
    return spark.createDataFrame([(f"hash{k:08d}", json.dumps(d, ensure_ascii=False) if not isinstance(d, str) else d) for k, d in enumerate(docs)], "source_hash string, json string")


def test_shapes_of_parser_output(spark):
    paged = [[{"type": "text", "text": "a"}], [{"type": "text", "text": "b"}, {"type": "text", "text": "c", "page_idx": 7}]]
    df = parsed(spark, ITEMS, paged, {"pdf_info": [{"type": "text", "text": "x"}]}, {"other": 1}, [], "not json", "[1, 2]")
    got = rows(structure.flatten_items(df), "source_hash", "item_idx", "page_idx")
    assert [g for g in got if g[0] == "hash00000001"] == [("hash00000001", 0, 0), ("hash00000001", 1, 1), ("hash00000001", 2, 7)]
    assert [g for g in got if g[0] == "hash00000002"] == [("hash00000002", 0, 0)]
    assert {g[0] for g in got} == {"hash00000000", "hash00000001", "hash00000002"}


def test_typed_elements_and_links(spark):
    items = structure.flatten_items(parsed(spark, ITEMS))
    e = structure.items_to_elements(items)
    assert rows(e, "element_id", "element_type", "ref_label", "section_title") == [
        ("hash0000_el_0000", "title", "", "Overview"), ("hash0000_el_0001", "text", "", "Overview"), ("hash0000_el_0002", "figure", "", "Overview"), ("hash0000_el_0003", "caption", "рис. 1", "Overview"), ("hash0000_el_0004", "table", "табл. 1", "Overview"),
    ]
    links = structure.caption_links(e)
    assert rows(links, "caption_id", "target_id") == [("hash0000_el_0003", "hash0000_el_0002")]
    assert rows(structure.target_captions(links, e), "target_id", "caption_id") == [("hash0000_el_0002", "hash0000_el_0003")]
    assert [r[0] for r in rows(structure.items_to_blocks(items), "block_index")] == [0, 1, 3, 4]


def test_markdown(spark):
    df = spark.createDataFrame([(1, "intro\nline\n\n# Head #\nbody\n\n\nlast"), (2, None), (3, "   \n\n"), (4, "##\nx")], "doc_id long, text string")
    assert rows(structure.markdown_blocks(df), "doc_id", "block_index", "block_type", "content") == [(1, 0, "text", "intro\nline"), (1, 1, "title", "Head #"), (1, 2, "text", "body"), (1, 3, "text", "last"), (4, 0, "title", ""), (4, 1, "text", "x")]


def blocks(spark, items, h="h1"):
    """(type, content) or (type, content, page) in order."""
    data = [(f"{h}_{k:03d}", h, i[0], i[1], i[2] if len(i) > 2 else 0, k) for k, i in enumerate(items)]
    return spark.createDataFrame(data, "block_id string, source_hash string, block_type string, content string, page_number int, block_index int")


def test_clean_blocks(spark):
    b = blocks(spark, [("text", "keep"), ("text", "12"), ("text", "Page 4 of 5"), ("text", "стр. 3"), ("text", "- 5 -"), ("text", "a DRAFT here"), ("text", " "), (None, None), ("header", "H"), ("header", "H"), ("header", "H")])
    assert [r[0] for r in rows(cleaning.clean_blocks(b), "block_id")] == ["h1_000", "h1_008", "h1_009"]


def py_tokens(t):
    return max(1, int(len(re.findall(r"\S+", t)) * (1.5 if re.search("[а-яА-ЯёЁ]", t) else 1.3)))


def py_sentences(t):
    return [s.strip() for s in re.split(r'(?<=[.!?])\s+(?=[A-ZА-ЯЁ\d"«])', t) if s.strip()]


def random_doc(rng, n):
    out = []
    for _ in range(n):
        if rng.random() < 0.25:
            out.append(("title", "#" * rng.randrange(1, 4) + " " + rng.choice(["One", "Two", "Три"])))
        else:
            out.append((rng.choice(["text", "table", "formula"]), " ".join(rng.choice(["Go on", "Дело идёт", "X"]) + " " + " ".join("word" for _ in range(rng.randrange(1, 9))) + rng.choice([".", "!", "?"]) for _ in range(rng.randrange(1, 7))), rng.randrange(4)))
    return out


def py_section_chunks(doc, limit, least):
    """Sections with body, greedy pieces, a short tail joined to the piece before it."""
    secs, cur, stack = [], {"title": "", "at": None, "h": [], "recs": [], "tp": None}, []
    for k, item in enumerate(doc):
        text, page = item[1].strip(), item[2] if len(item) > 2 else 0
        if text.startswith("#"):
            secs.append(cur)
            level, title = min(4, len(text) - len(text.lstrip("#"))), text.lstrip("#").strip()
            stack = [x for x in stack if x[0] < level] + [(level, title)]
            cur = {"title": title, "at": k, "h": [x[1] for x in stack], "recs": [], "tp": page}
        else:
            cur["recs"].append((text, k, page))
    out = []
    for s in secs + [cur]:
        if not s["recs"]:
            continue
        named = lambda body: (s["title"] + "\n\n" + body if s["title"] else body).strip()
        head = [s["at"]] if s["at"] is not None else []
        whole = "\n".join(r[0] for r in s["recs"])
        if py_tokens(whole) <= limit:
            pages = [r[2] for r in s["recs"]] + ([s["tp"]] if s["tp"] is not None else [])
            out.append((named(whole), min(pages), max(pages), head + [r[1] for r in s["recs"]], s["h"]))
            continue
        pieces, now, size = [], [], 0
        for text, k, page in s["recs"]:
            for sent in py_sentences(text):
                if now and size + py_tokens(sent) > limit:
                    pieces.append(now)
                    now, size = [], 0
                now.append((sent, k, page))
                size += py_tokens(sent)
        tail = bool(pieces) and size < least
        made = [(named(" ".join(u[0] for u in p)), min(u[2] for u in p), max(u[2] for u in p), list(dict.fromkeys(head + [u[1] for u in p]))) for p in pieces + [now]]
        if tail:
            a, b = made[-2], made.pop()
            made[-1] = (a[0] + "\n" + b[0], min(a[1], b[1]), max(a[2], b[2]), list(dict.fromkeys(a[3] + b[3])))
        out += [(*m, s["h"]) for m in made]
    return out


def test_section_chunks_against_plain_python(spark):
    rng = random.Random(11)
    docs = {f"hash{k:04d}": random_doc(rng, rng.randrange(1, 25)) for k in range(12)}
    df = None
    for h, d in docs.items():
        b = blocks(spark, d, h)
        df = b if df is None else df.unionByName(b)
    for limit, least in ((25, 8), (60, 50), (512, 50)):
        got = chunking.section_chunks(chunking.sections(chunking.titled_blocks(df)), limit, least).toPandas()
        for h, d in docs.items():
            mine = got[got.source_hash == h].sort_values("chunk_no")
            want = py_section_chunks(d, limit, least)
            assert [tuple([r.text, r.page_start, r.page_end, list(r.block_indices), list(r.hierarchy)]) for r in mine.itertuples()] == [tuple(w) for w in want]


def test_overlap_against_plain_python(spark):
    rng = random.Random(4)
    texts = [" ".join(f"S{rng.randrange(99)} goes on." for _ in range(rng.randrange(1, 5))) for _ in range(7)]
    df = spark.createDataFrame([("h", k, f"c{k}", t) for k, t in enumerate(texts)] + [("solo", 0, "s0", "Only one.")], "source_hash string, chunk_no int, chunk_id string, text string").withColumn("token_count", F.lit(1))
    want = list(texts)
    for k in range(len(want) - 1):
        want[k + 1] = " ".join(py_sentences(want[k])[-2:]) + "\n" + want[k + 1]
    got = chunking.add_overlap(df).orderBy("source_hash", "chunk_no").collect()
    assert [r["text"] for r in got if r["source_hash"] == "h"] == want
    assert [(r["overlap_prev"], r["overlap_next"]) for r in got] == [(k > 0, k < 6) for k in range(7)] + [(False, False)]


def py_sliding(text, window, step):
    out, cur, total = [], [], 0
    for s in py_sentences(text):
        cur.append(s)
        total += py_tokens(s)
        if total >= window:
            out.append(" ".join(cur))
            gone = 0
            while cur and gone < window - step:
                gone += py_tokens(cur.pop(0))
            total -= gone
    return out + ([" ".join(cur)] if cur else [])


def test_sliding_against_plain_python(spark):
    rng = random.Random(8)
    docs = {f"hash{k:04d}": [(t, c) for t, c, *_ in random_doc(rng, 14)] for k in range(6)}
    df = None
    for h, d in docs.items():
        b = blocks(spark, d, h)
        df = b if df is None else df.unionByName(b)
    for window, step in ((30, 20), (64, 48), (5000, 3750)):
        got = chunking.sliding_chunks(df, window, step).toPandas()
        for h, d in docs.items():
            assert list(got[got.source_hash == h].sort_values("chunk_no").text) == py_sliding("\n".join(x[1] for x in d), window, step)


def test_empty_tables(spark):
    none = blocks(spark, [("text", "x")]).limit(0)
    assert chunking.section_chunks(chunking.sections(chunking.titled_blocks(none))).count() == 0
    assert chunking.sliding_chunks(none).count() == 0 and cleaning.clean_blocks(none).count() == 0
    stats = chunking.chunk_stats(none.select(F.lit(1).alias("token_count"), F.lit(True).alias("has_equations"), F.lit(False).alias("has_tables"))).first()
    assert tuple(stats) == (0, 0, 0.0, 0, 0, 0, 0)


def test_provenance(spark):
    meta = "struct<caption_element_id:string,linked_element_id:string,relation:string,text_level:int>"
    el = spark.createDataFrame(
        [("e0", "h", "text", 0, 0, None, None, "S", None), ("e1", "h", "figure", 0, 1, None, None, "S", ("e2", None, None, None)), ("e2", "h", "caption", 0, 2, None, "Fig", "S", (None, "e1", "caption_of", None)), ("e9", "h", "table", 5, 40, None, None, "T", None)],
        f"element_id string, source_hash string, element_type string, page_number int, block_index int, source_block_index int, caption string, section_title string, metadata {meta}",
    )
    c = spark.createDataFrame([("c0", "h", 0, 0, "S", ["S"], [0, 2], "text of zero and two")], "chunk_id string, source_hash string, page_start int, page_end int, section_title string, section_hierarchy array<string>, block_indices array<int>, text string")
    assert rows(provenance.source_elements(c, el), "element_id") == [("e0",), ("e2",)]
    assert rows(provenance.related_elements(c, el), "element_id") == [("e1",), ("e2",)]
    b = blocks(spark, [("text", "text of zero"), ("text", "absent"), ("text", " and two ")], "h")
    assert rows(provenance.blocks_in_text(c, b), "block_index") == [(0,), (2,)]
    assert rows(provenance.source_blocks(c, b), "ord", "block_id", "preview") == [(0, "h_000", "text of zero"), (1, "h_002", "and two")]


def test_deep_headings(spark):
    rows_ = [("title", "#" * 4 + f" T{k}") if k % 2 == 0 else ("text", f"body {k}") for k in range(4)]
    b = blocks(spark, [*rows_])
    e = spark.createDataFrame([("h1", f"e{k}", "title", 2 * k, {"text_level": 10 + k}) for k in range(2)], "source_hash string, element_id string, element_type string, block_index int, metadata struct<text_level:int>").withColumn("source_block_index", F.col("block_index"))
    plain = b.withColumn("content", F.regexp_replace("content", "^#+ ", ""))
    got = chunking.sections(chunking.titled_blocks(plain, e)).orderBy("section").select(F.array_join("hierarchy", " > ")).collect()
    assert [r[0] for r in got] == ["T0", "T0 > T2"]


def test_markdown_elements(spark):
    d = spark.createDataFrame([("k1", "# Head\n\nFigure 1. A chart\n\nplain text"), ("k2", None), ("k3", "")], "doc_id string, text string")
    got = S.markdown_elements(S.markdown_blocks(d)).orderBy("block_index").collect()
    assert [(r["element_id"], r["element_type"], r["text"], r["section_title"]) for r in got][0] == ("k1_el_0000", "title", "Head", "Head")
    assert [r["element_type"] for r in got] == ["title", "caption", "text"] and got[1]["ref_label"].startswith("figure 1")


def test_bbox_forms(spark):
    df = parsed(spark, [{"type": "text", "text": "a", "bbox": {"x0": 1, "y0": 2, "x1": 3, "y1": 4}}, {"type": "text", "text": "b", "bbox": {"left": 5, "top": 6, "right": 7, "bottom": 8}}, {"type": "text", "text": "c", "bbox": [1, 2, 3, 4, 9]}, {"type": "text", "text": "d"}])
    got = S.items_to_elements(S.flatten_items(df)).orderBy("block_index").collect()
    assert [list(r["bbox"]) for r in got] == [[1, 2, 3, 4], [5, 6, 7, 8], [1, 2, 3, 4], [0, 0, 0, 0]]


def test_latest_delivery_counts(spark):
    df = spark.createDataFrame([("a", "old", "2024-01-01"), ("a", "new", "2024-02-01"), ("b", "only", None), (None, "x", None)], "k string, v string, at string").withColumn("ingested_at", F.col("at").cast("timestamp_ntz")).drop("at")
    assert rows(S.distinct_rows(df, "k"), "k", "v") == [("a", "new"), ("b", "only")]


def test_noise_reasons_and_missing_pages(spark):
    from layoutgraph.operators import cleaning, resolve as R

    e = spark.createDataFrame([("7", "NUMBER", "7"), ("ab", "ORG", "ab"), ("AB1", "ORG", "ab1"), ("x" * 101, "ORG", "x"), ("Bank", "ORG", "bank")], "text string, entity_type string, normalized string")
    assert [r[0] for r in e.select(R.noise_reason()).collect()] == ["skip_type", "too_short", "noise_pattern", "too_long", None]
    b = spark.createDataFrame([("h", 0), ("h", 3)], "source_hash string, page_number int")
    assert rows(cleaning.missing_pages(b, b.filter("page_number = 1")), "source_hash", "page_number") == [("h", 1), ("h", 2)]
