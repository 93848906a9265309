"""SQL of the document and graph queries, written independently of the DataFrame code."""

from __future__ import annotations

from layoutgraph.functions import text as T
from layoutgraph.operators import cleaning, entities as E, resolve as R


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _inner(t: str, mark: str, guard: bool) -> str:
    n = len(mark)
    least = f" AND length({t}) >= {2 * n}" if guard else ""
    return f"WHEN starts_with({t}, '{mark}') AND ends_with({t}, '{mark}'){least} THEN {_strip(f'substr({t}, {n + 1}, greatest(0, length({t}) - {2 * n}))')}"


def _marks(t: str, guard: bool) -> str:
    return "CASE " + " ".join(_inner(t, m, guard) for m in ("**", "__", "*", "_")) + f" ELSE {t} END"


def _unwrapped(rel: str, key: str, col: str) -> str:
    """CTE body: (key, w) with the wrapper-free text of a column."""
    head = f"regexp_replace({_strip(f'coalesce({col}, {_q("")})')}, '^\\s{{0,3}}#{{1,6}}\\s*', '')"
    return f"SELECT {key}, {_strip(_marks('t', True))} AS w FROM (SELECT {key}, {head} AS t FROM {rel})"


CAPTION = T.CAPTION
_B = "b AS (SELECT * FROM blocks WHERE block_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY ingested_at) = 1)"
_E = "e AS (SELECT * FROM elements WHERE element_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY element_id ORDER BY block_index) = 1)"
_C = "c AS (SELECT * FROM chunks WHERE chunk_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY ingested_at) = 1)"
_M = "m AS (SELECT * FROM entities WHERE mention_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY mention_id ORDER BY ingested_at DESC NULLS LAST, confidence DESC NULLS LAST, normalized DESC NULLS LAST) = 1)"
_TOKENS = "greatest(1, CAST(floor(len(regexp_extract_all(coalesce({0}, ''), '\\S+')) * CASE WHEN regexp_matches(coalesce({0}, ''), '[а-яА-ЯёЁ]') THEN 1.5 ELSE 1.3 END) AS INTEGER))"


def _sentences(x: str) -> str:
    marked = f"regexp_replace(coalesce({x}, ''), '([.!?])\\s+([A-ZА-ЯЁ\\d\"«])', '\\1' || chr(1) || '\\2', 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {_strip('s')}), lambda s: s <> '')"


def _label(w: str) -> str:
    low = f"lower({w})"
    kind = f"regexp_replace(regexp_extract({low}, {_q(CAPTION)}, 1), '\\.$', '')"
    num = f"regexp_extract({low}, {_q(CAPTION)}, 2)"
    norm = f"CASE WHEN {kind} IN ('рис', 'рисунок') THEN 'рис.' WHEN {kind} IN ('fig', 'figure') THEN 'figure' WHEN {kind} IN ('табл', 'таблица') THEN 'табл.' ELSE 'table' END"
    return f"CASE WHEN {kind} = '' THEN '' ELSE {_strip(f'{norm} || chr(32) || {num}')} END"


_UNWRAP_B = f"u AS ({_unwrapped('b', 'block_id', 'content')})"
_UNWRAP_E = f"u AS ({_unwrapped('e', 'element_id', 'text')})"
_LINKS = f"""
cap AS (SELECT e.source_hash, e.page_number, e.element_id AS caption_id, e.block_index AS at_, CASE WHEN coalesce(e.ref_label, '') = '' THEN {_label('u.w')} ELSE e.ref_label END AS label
        FROM e JOIN u USING (element_id) WHERE e.element_type = 'caption'),
near AS (SELECT cap.*, t.element_id AS target_id, t.block_index AS there, abs(t.block_index - cap.at_) AS distance
         FROM cap JOIN e t ON t.source_hash = cap.source_hash AND t.page_number = cap.page_number AND abs(t.block_index - cap.at_) <= 3
         WHERE CASE WHEN label LIKE 'рис.%' OR label LIKE 'figure%' THEN t.element_type = 'figure' WHEN label LIKE 'табл.%' OR label LIKE 'table%' THEN t.element_type = 'table' ELSE t.element_type IN ('figure', 'table') END),
links AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY caption_id ORDER BY distance, CAST(there > at_ AS INT), there, target_id) = 1)
"""
_UPPER = "upper(txt) = txt AND lower(txt) <> txt"
_CLEAN_TITLE = _marks("ct", False)
_TITLED = f"""
lv AS (SELECT source_hash, CAST(coalesce(source_block_index, block_index) AS INTEGER) AS block_index, arg_max(metadata.text_level, element_id) AS text_level FROM e
       WHERE element_type = 'title' AND metadata.text_level IS NOT NULL GROUP BY ALL),
t0 AS (SELECT b.*, {_strip("coalesce(content, '')")} AS txt FROM b WHERE source_hash IS NOT NULL),
t1 AS (SELECT t0.*, lv.text_level, {_strip("regexp_replace(txt, '^#+', '')")} AS ct FROM t0 LEFT JOIN lv USING (source_hash, block_index) WHERE txt <> ''),
t2 AS (SELECT *, CASE WHEN starts_with(txt, '#') THEN least(4, length(txt) - length(regexp_replace(txt, '^#+', ''))) WHEN coalesce(text_level, 0) <> 0 THEN text_level
              WHEN coalesce(block_type, '') = 'title' OR (length(txt) < 100 AND {_UPPER}) THEN 2 ELSE 0 END AS level FROM t1),
titled AS (SELECT *, CAST(level AS INTEGER) AS lvl, CASE WHEN level > 0 THEN {_CLEAN_TITLE} ELSE '' END AS title,
                  CAST(sum(CASE WHEN level > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY source_hash ORDER BY block_index, block_id) AS INTEGER) AS section FROM t2)
"""
_NOISE = " OR ".join(f"regexp_matches(txt, {_q('(?i)' + p)})" for p in cleaning.NOISE)
_NAME = _strip("coalesce(text, '')")
_BASE = " OR ".join(f"regexp_matches(name, {_q('(?i)' + p)})" for p in R.BASE_NOISE)
_STRICT = " OR ".join(f"regexp_matches(name, {_q('(?i)' + p)})" for p in R.STRICT_NOISE)
_IN = lambda xs: "(" + ", ".join(map(_q, xs)) + ")"
_STRICT_M = f"""
s0 AS (SELECT *, {_NAME} AS name FROM m),
s AS (SELECT * FROM s0 WHERE coalesce(entity_type, '') NOT IN {_IN(R.SKIP_TYPES)} AND coalesce(normalized, lower(name)) NOT IN {_IN(R.STRICT_STOP)} AND length(name) BETWEEN 3 AND 100 AND NOT ({_STRICT})
      AND NOT (len(regexp_extract_all(name, '\\p{{Lu}}')) / greatest(length(name), 1) > 0.5 AND length(name) > 4 AND upper(name) NOT IN {_IN(R.ACRONYMS)})
      AND NOT (regexp_matches(coalesce(normalized, lower(name)), '^[a-z]{{3,4}}$') AND coalesce(normalized, lower(name)) NOT IN {_IN(R.SHORT_KEPT)}))
"""
_DROP = f"""
d0 AS (SELECT *, {_NAME} AS name FROM m),
d AS (SELECT * FROM d0 WHERE length(name) BETWEEN 2 AND 200 AND coalesce(normalized, '') NOT IN {_IN(E.STOP_NAMES)} AND NOT (regexp_matches(name, '^[\\d.,\\s]+$') AND coalesce(entity_type, '') NOT IN ('DATE', 'NUMBER', 'MONEY')))
"""
_CONF = "CASE WHEN isnan(confidence) THEN NULL ELSE confidence END"
_IDS = "list_filter(list_transform(string_split(coalesce(chunk_id, ''), ','), lambda x: trim(x)), lambda x: x <> '')"


def _ordered_union(rel: str, expr: str, name: str) -> str:
    """CTE: ordered distinct elements of a list column over each entity."""
    return f"""{name} AS (SELECT source_doc, normalized, entity_type, list(x ORDER BY mention_id, pos) AS {name} FROM (
      SELECT source_doc, normalized, entity_type, x, mention_id, pos, row_number() OVER (PARTITION BY source_doc, normalized, entity_type, x ORDER BY mention_id, pos) AS r FROM (
        SELECT source_doc, normalized, entity_type, mention_id, unnest(l) AS x, generate_subscripts(l, 1) AS pos FROM (SELECT *, {expr} AS l FROM {rel}))) WHERE r = 1 GROUP BY ALL)"""


_ENT = f"""{_DROP},
{_ordered_union('d', _IDS, 'chunk_ids')},
{_ordered_union('d', 'source_element_ids', 'source_ids')},
{_ordered_union('d', 'related_element_ids', 'related_ids')},
g AS (SELECT source_doc, normalized, entity_type, max({_CONF}) AS confidence, arg_max(text, struct_pack(a := coalesce({_CONF}, -1.0), b := -mention_id)) AS text, min(page_start) AS page_start, max(page_end) AS page_end, count(*) AS mentions,
             arg_max(coalesce(section_title, chr(0)), struct_pack(a := coalesce({_CONF}, -1.0), b := -mention_id)) AS sec
      FROM d GROUP BY ALL),
ent AS (SELECT g.* EXCLUDE (sec), nullif(sec, chr(0)) AS section_title, coalesce(chunk_ids, []) AS chunk_ids, coalesce(source_ids, []) AS source_element_ids, coalesce(related_ids, []) AS related_element_ids FROM g
  LEFT JOIN chunk_ids k ON k.source_doc IS NOT DISTINCT FROM g.source_doc AND k.normalized IS NOT DISTINCT FROM g.normalized AND k.entity_type IS NOT DISTINCT FROM g.entity_type
  LEFT JOIN source_ids s ON s.source_doc IS NOT DISTINCT FROM g.source_doc AND s.normalized IS NOT DISTINCT FROM g.normalized AND s.entity_type IS NOT DISTINCT FROM g.entity_type
  LEFT JOIN related_ids r ON r.source_doc IS NOT DISTINCT FROM g.source_doc AND r.normalized IS NOT DISTINCT FROM g.normalized AND r.entity_type IS NOT DISTINCT FROM g.entity_type)
"""
_PAIRS = """
mem AS (SELECT DISTINCT trim(x) AS basket, normalized AS item FROM (SELECT unnest(string_split(chunk_id, ',')) AS x, normalized FROM s) WHERE trim(x) <> '' AND trim(coalesce(normalized, '')) <> ''),
allp AS (SELECT x.item AS a, y.item AS b, count(*) AS weight FROM mem x JOIN mem y ON x.basket = y.basket AND x.item < y.item GROUP BY ALL)
"""
_EDGES = f"WITH {_M}, {_STRICT_M}, {_PAIRS}, p AS (SELECT * FROM allp WHERE weight >= 2), arcs AS (SELECT a, b, weight FROM p UNION ALL SELECT b, a, weight FROM p)"
#: DuckDB's edit distance counts bytes, so other letters are mapped to one byte each, one to one
_WIDE = "абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґʌı«»¬­—–‐éàáíóúöüäèìòùñç"
_BYTES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(chr(k) for k in range(1, 32))
_ONE = f"translate(name, {_q(_WIDE[: len(_BYTES)])}, {' || '.join(_q(c) if ord(c) > 31 else f'chr({ord(c)})' for c in _BYTES[: len(_WIDE)])})"
_FUZZY = "WITH RECURSIVE {m}, {f}, n AS (SELECT name, " + _ONE + " AS t FROM (SELECT DISTINCT normalized AS name FROM {rel} WHERE normalized IS NOT NULL)) SELECT x.name AS a, y.name AS b FROM n x JOIN n y ON x.name < y.name WHERE (least(length(x.name), length(y.name)) >= {inside} AND (contains(x.name, y.name) OR contains(y.name, x.name))) OR (least(length(x.name), length(y.name)) >= {edit} AND abs(length(x.name) - length(y.name)) <= 2 AND levenshtein(x.t, y.t) <= 2 AND levenshtein(x.t, y.t) / greatest(length(x.name), length(y.name)) < 0.2)"
_DOCS = "docs AS (SELECT source_hash, min(source_doc) AS source_doc FROM parsed_docs WHERE source_hash IS NOT NULL GROUP BY ALL)"
_REG = f"""{_DOCS},
reg0 AS (SELECT element_id, source_hash, element_type, text, page_number, ref_label, caption, section_title, metadata.caption_element_id AS cap, metadata.linked_element_id AS linked, 0 AS origin FROM e
         UNION ALL SELECT DISTINCT element_id, NULL, element_type, NULL, NULL, ref_label, caption, section_title, NULL, NULL, 1 FROM shared_elements WHERE element_id IS NOT NULL),
reg AS (SELECT reg0.*, docs.source_doc,
               CASE WHEN coalesce(ref_label, '') <> '' THEN ref_label WHEN coalesce(caption, '') <> '' THEN substr(caption, 1, 80) WHEN coalesce(text, '') <> '' THEN substr(text, 1, 80) ELSE element_id END AS label
        FROM (SELECT * FROM reg0 QUALIFY row_number() OVER (PARTITION BY element_id ORDER BY origin) = 1) reg0 LEFT JOIN docs USING (source_hash))
"""
_ENTID = "'entity::' || coalesce(source_doc, '') || '::' || coalesce(entity_type, 'UNKNOWN') || '::' || coalesce(normalized, lower(text), '')"
_NODES = f"""
nodes AS (
  SELECT DISTINCT 'doc::' || coalesce(source_doc, '') AS id, 'document' AS node_type, coalesce(source_doc, '') AS label, source_doc AS doc, CAST(NULL AS VARCHAR) AS section, CAST(NULL AS INT) AS page_start, CAST(NULL AS INT) AS page_end, CAST(NULL AS VARCHAR) AS ref, CAST(NULL AS VARCHAR) AS caption FROM docs
  UNION ALL SELECT 'chunk::' || chunk_id, 'chunk', CASE WHEN coalesce(section_title, '') <> '' THEN substr(section_title, 1, 80) ELSE chunk_id END, source_doc, section_title, page_start, page_end, NULL, NULL FROM c
  UNION ALL SELECT 'element::' || element_id, coalesce(element_type, 'unknown'), label, source_doc, section_title, page_number, page_number, ref_label, caption FROM reg
  UNION ALL SELECT {_ENTID}, 'entity', coalesce(text, ''), source_doc, section_title, page_start, page_end, NULL, NULL FROM ent)
"""
_CAND = f"""
reasons AS (
  SELECT DISTINCT {_ENTID} AS ent, normalized IS NULL AS rec, source_doc, normalized, entity_type, x AS element_id, 'source_element' AS reason, 20000 AS base FROM (SELECT *, unnest(source_element_ids) AS x FROM ent)
  UNION ALL SELECT DISTINCT {_ENTID}, normalized IS NULL, source_doc, normalized, entity_type, x, 'related_element', 10000 FROM (SELECT *, unnest(related_element_ids) AS x FROM ent)),
named AS (
  SELECT r.*, g.text AS entity_label, g.confidence, g.section_title AS gsec, g.page_start AS gs, g.page_end AS ge, g.chunk_ids, q.element_type AS etype, q.section_title AS esec, q.page_number AS page
  FROM reasons r JOIN ent g ON g.source_doc IS NOT DISTINCT FROM r.source_doc AND g.normalized IS NOT DISTINCT FROM r.normalized AND g.entity_type IS NOT DISTINCT FROM r.entity_type
  JOIN reg q ON q.element_id = r.element_id WHERE q.element_type IN ('figure', 'caption', 'table', 'formula')),
hits AS (
  SELECT ent, rec, element_id, reason, sum(CASE WHEN list_contains(c.source_element_ids, element_id) THEN 20000 ELSE 0 END + CASE WHEN list_contains(c.related_element_ids, element_id) THEN 10000 ELSE 0 END) AS plus, list(DISTINCT c.chunk_id) AS matched
  FROM (SELECT DISTINCT ent, rec, element_id, reason, unnest(chunk_ids) AS cid FROM named) n JOIN c ON c.chunk_id = n.cid
  WHERE list_contains(c.source_element_ids, element_id) OR list_contains(c.related_element_ids, element_id) GROUP BY ALL),
scored AS (
  SELECT n.element_id, n.ent, n.etype, n.entity_label, n.reason, coalesce(h.matched, n.chunk_ids[1:3]) AS found,
    base + least(len(chunk_ids), 8) * 1500 + coalesce(plus, 0) + CASE WHEN coalesce(gsec, '') <> '' AND gsec = esec THEN 4000 ELSE 0 END
      + CASE WHEN page BETWEEN coalesce(gs, page) AND coalesce(ge, coalesce(gs, page)) THEN 6000 ELSE 0 END + CAST(round(least(coalesce(confidence, 0.0), 1.0) * 3500) AS BIGINT) AS score
  FROM named n LEFT JOIN hits h USING (ent, rec, element_id, reason)),
cand AS (
  SELECT element_id, ent, max(entity_label) AS entity_label, CAST(sum(score) AS BIGINT) AS score_e4, len(list_distinct(flatten(list(found)))) AS evidence, list_sort(list_distinct(flatten(list(found)))) AS chunk_list, array_to_string(list_sort(list(DISTINCT reason)), ',') AS reasons FROM scored GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY element_id ORDER BY score_e4 DESC, evidence DESC, entity_label, ent) AS rank FROM cand)
"""
_LINK_EDGES = f"""
raw AS (
  SELECT 'doc::' || source_doc AS source, 'chunk::' || chunk_id AS target, 'CONTAINS_CHUNK' AS relation FROM c WHERE source_doc IS NOT NULL
  UNION ALL SELECT 'doc::' || source_doc, 'element::' || element_id, 'CONTAINS_ELEMENT' FROM reg WHERE coalesce(source_doc, '') <> ''
  UNION ALL SELECT 'element::' || element_id, 'element::' || cap, 'HAS_CAPTION' FROM reg WHERE cap IN (SELECT element_id FROM reg)
  UNION ALL SELECT 'element::' || linked, 'element::' || element_id, 'HAS_CAPTION' FROM reg WHERE linked IN (SELECT element_id FROM reg)
  UNION ALL SELECT 'element::' || element_id, 'element::' || linked, 'CAPTION_OF' FROM reg WHERE linked IN (SELECT element_id FROM reg)
  UNION ALL SELECT 'chunk::' || chunk_id, 'element::' || x, 'EXTRACTED_FROM' FROM (SELECT DISTINCT chunk_id, unnest(source_element_ids) AS x FROM c) WHERE x IN (SELECT element_id FROM reg)
  UNION ALL SELECT 'chunk::' || chunk_id, 'element::' || x, 'RELATED_TO' FROM (SELECT DISTINCT chunk_id, unnest(related_element_ids) AS x FROM c) WHERE x IN (SELECT element_id FROM reg)
  UNION ALL SELECT ent, 'element::' || x, 'EXTRACTED_FROM' FROM (SELECT {_ENTID} AS ent, unnest(source_element_ids) AS x FROM ent) WHERE x IN (SELECT element_id FROM reg)
  UNION ALL SELECT ent, 'chunk::' || x, 'MENTIONED_IN' FROM (SELECT {_ENTID} AS ent, unnest(chunk_ids) AS x FROM ent) WHERE x IN (SELECT chunk_id FROM c)),
merged AS (SELECT source, target, relation, CAST(count(*) AS DOUBLE) AS weight, CAST(count(*) AS BIGINT) AS evidence FROM raw WHERE source <> target GROUP BY ALL),
alle AS (SELECT * FROM merged UNION ALL SELECT ent, 'element::' || element_id, 'DISCUSSED_NEAR', greatest(score_e4 / 10000, 1.0), CAST(greatest(evidence, 1) AS BIGINT) FROM ranked WHERE rank <= 12)
"""
_FULL = f"WITH {_C}, {_E}, {_M}, {_ENT}, {_REG}, {_NODES}, {_CAND}, {_LINK_EDGES}"


def _around(kinds: str, name: str) -> str:
    return f"""
{name}0 AS (SELECT source, target FROM alle WHERE relation = 'DISCUSSED_NEAR' AND target IN (SELECT id FROM nodes WHERE node_type IN {kinds})),
{name}1 AS (SELECT source AS id FROM {name}0 UNION SELECT target FROM {name}0),
{name} AS (SELECT id FROM {name}1 UNION SELECT target FROM alle WHERE relation IN ('HAS_CAPTION', 'CAPTION_OF') AND source IN (SELECT id FROM {name}1)
           UNION SELECT source FROM alle WHERE relation IN ('HAS_CAPTION', 'CAPTION_OF') AND target IN (SELECT id FROM {name}1))
"""


def _pagerank(rounds: int = 20) -> str:
    steps = ["outw AS (SELECT a, sum(weight) AS o FROM arcs GROUP BY a)", "sh AS (SELECT a, b, weight / o AS share FROM arcs JOIN outw USING (a))", "nn AS (SELECT count(*) AS n FROM outw)", "r0 AS MATERIALIZED (SELECT a AS item, 1.0::DOUBLE / n AS rank FROM outw, nn)"]
    steps += [f"r{k + 1} AS MATERIALIZED (SELECT b AS item, max(0.15::DOUBLE / n) + 0.85::DOUBLE * sum(share * rank) AS rank FROM sh JOIN r{k} ON a = item, nn GROUP BY b)" for k in range(rounds)]
    return _EDGES + ", " + ", ".join(steps) + f" SELECT item, round(rank, 6) AS rank FROM r{rounds}"


def _communities(rounds: int = 8) -> str:
    steps = ["own AS (SELECT a AS item, max(weight) AS w FROM arcs GROUP BY a)", "l0 AS MATERIALIZED (SELECT item, item AS community FROM own)"]
    for k in range(rounds):
        votes = f"SELECT a AS item, community, weight FROM arcs JOIN l{k} ON b = l{k}.item UNION ALL SELECT item, community, w FROM l{k} JOIN own USING (item)"
        steps.append(f"l{k + 1} AS MATERIALIZED (SELECT item, community FROM (SELECT item, community, sum(weight) AS w FROM ({votes}) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY item ORDER BY w DESC, community) = 1)")
    return _EDGES + ", " + ", ".join(steps) + f" SELECT item, community FROM l{rounds}"


#: names of the strict filter's entity records, with the similar ones of an earlier rank
_SDEDUP = f"""{_STRICT_M},
sg AS (SELECT source_doc, normalized, entity_type, min(mention_id) AS first_mention, max({_CONF}) AS confidence, arg_max(text, struct_pack(a := coalesce({_CONF}, -1.0), b := -mention_id)) AS text, arg_max(coalesce(context, chr(0)), struct_pack(a := coalesce({_CONF}, -1.0), b := -mention_id)) AS ctx FROM s GROUP BY ALL),
nm AS (SELECT normalized AS name, {_ONE.replace("translate(name", "translate(normalized")} AS t, row_number() OVER (ORDER BY count(*) DESC, min(first_mention), normalized) AS i FROM sg WHERE normalized IS NOT NULL GROUP BY normalized)
"""
_WALK = """
sim AS MATERIALIZED (SELECT y.i AS i, list(x.i ORDER BY x.i) AS before FROM nm x JOIN nm y ON x.i < y.i WHERE (least(length(x.name), length(y.name)) >= 4 AND (contains(x.name, y.name) OR contains(y.name, x.name)))
  OR (least(length(x.name), length(y.name)) >= 6 AND abs(length(x.name) - length(y.name)) <= 2 AND levenshtein(x.t, y.t) <= 2 AND levenshtein(x.t, y.t) / greatest(length(x.name), length(y.name)) < 0.2) GROUP BY y.i),
walk(i, star, canon) AS (
  SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT w.i + 1, coalesce(list_filter(coalesce(sim.before, []), lambda x: list_contains(w.canon, x))[1], w.i + 1),
         CASE WHEN len(list_filter(coalesce(sim.before, []), lambda x: list_contains(w.canon, x))) = 0 THEN list_append(w.canon, w.i + 1) ELSE w.canon END
  FROM walk w LEFT JOIN sim ON sim.i = w.i + 1 WHERE w.i < (SELECT max(i) FROM nm)),
cl AS (SELECT a.name, b.name AS canonical FROM walk w JOIN nm a ON a.i = w.i JOIN nm b ON b.i = w.star)
"""
_CLUSTERS = f"WITH RECURSIVE {_M}, {_SDEDUP}, {_WALK}"
_RESOLVED = f"""{_CLUSTERS},
rr AS (SELECT sg.*, cl.canonical FROM sg JOIN cl ON cl.name = sg.normalized),
bt AS (SELECT canonical, text FROM (SELECT canonical, text, count(*) AS k, min(first_mention) AS f FROM rr GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY canonical ORDER BY k DESC, f, text DESC) = 1),
fr AS (SELECT canonical AS normalized, count(*) AS frequency, max(confidence) AS confidence FROM rr GROUP BY canonical),
rm AS (SELECT DISTINCT trim(x) AS basket, canonical AS item FROM (SELECT unnest(string_split(s.chunk_id, ',')) AS x, cl.canonical FROM s JOIN cl ON cl.name = s.normalized) WHERE trim(x) <> '' AND trim(canonical) <> ''),
re AS (SELECT x.item AS a, y.item AS b, count(*) AS weight FROM rm x JOIN rm y ON x.basket = y.basket AND x.item < y.item GROUP BY ALL)
"""
_COMPONENTS = _EDGES.replace("WITH ", "WITH RECURSIVE ", 1) + ", reach AS (SELECT a AS item, a AS other FROM arcs UNION SELECT r.item, arcs.b FROM reach r JOIN arcs ON arcs.a = r.other), comp AS (SELECT item, min(other) AS component FROM reach GROUP BY item)"
_MD = f"""l AS (SELECT doc_id, generate_subscripts(ls, 1) AS no, {_strip('unnest(ls)')} AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
      s AS (SELECT *, starts_with(line, '#') AS head, coalesce(lag(starts_with(line, '#') OR line = '') OVER (PARTITION BY doc_id ORDER BY no), true) AS fresh FROM l),
      g AS (SELECT *, sum(CASE WHEN head OR (line <> '' AND fresh) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY no) AS grp FROM s),
      md AS (SELECT doc_id, CAST(grp - 1 AS INT) AS block_index, CASE WHEN bool_or(head) THEN 'title' ELSE 'text' END AS block_type,
             CASE WHEN bool_or(head) THEN {_strip("regexp_replace(string_agg(line, chr(10) ORDER BY no), '^[# ]+', '')")} ELSE string_agg(line, chr(10) ORDER BY no) END AS content FROM g WHERE line <> '' GROUP BY doc_id, grp)"""

SQL = {
    "md_elements": f"""WITH {_MD}, u AS ({_unwrapped('(SELECT doc_id || chr(1) || block_index AS k, content FROM md)', 'k', 'content')}), r AS (SELECT md.*, w, CASE WHEN block_type = 'title' THEN 'title' WHEN regexp_matches(w, {_q('(?i)' + CAPTION)}) THEN 'caption' ELSE 'text' END AS element_type FROM md JOIN u ON u.k = doc_id || chr(1) || block_index)
      SELECT doc_id, block_index, element_type, w AS text, {_label('w')} AS ref_label, coalesce(last_value(CASE WHEN element_type = 'title' THEN w END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY block_index ROWS UNBOUNDED PRECEDING), '') AS section_title FROM r""",
    "entity_clusters": _CLUSTERS + " SELECT name, canonical FROM cl",
    "resolved_top": _RESOLVED + " SELECT normalized, frequency FROM fr ORDER BY frequency DESC, normalized LIMIT 20",
    "resolved_graph_edges": _RESOLVED + " SELECT * FROM re WHERE weight >= 2",
    "mention_provenance": f"WITH {_C}, w AS (SELECT chunk_id, generate_subscripts(ws, 1) - 1 AS ord, regexp_replace(unnest(ws), '^[.,;:!?()\\[\\]{{}}\"''«»“”]+|[.,;:!?()\\[\\]{{}}\"''«»“”]+$', '', 'g') AS text FROM (SELECT chunk_id, regexp_split_to_array(coalesce(text, ''), '[ \\n\\t\\r]+') AS ws FROM c)) SELECT w.chunk_id, CAST(ord AS INT) AS ord, w.text, c.page_start, c.page_end, coalesce(c.section_title, '') AS section_title FROM w JOIN c USING (chunk_id) WHERE regexp_matches(w.text, '^[A-Z][a-z]{{3,}}$')",
    "pagerank_top": _pagerank().replace("SELECT item, round(rank, 6) AS rank FROM r20", "SELECT item, round(rank, 6) AS rank FROM r20 ORDER BY 2 DESC, 1 LIMIT 10"),
    "component_sizes": _COMPONENTS + " SELECT component, count(*) AS size FROM comp GROUP BY component",
    "community_sizes": _communities().replace("SELECT item, community FROM l8", "SELECT community, count(*) AS size FROM l8 GROUP BY community"),
    "graph_metrics": _COMPONENTS + ", cs AS (SELECT count(*) AS components, coalesce(max(k), 0) AS largest_component FROM (SELECT count(*) AS k FROM comp GROUP BY component)), dg AS (SELECT a AS item, count(*) AS d FROM arcs GROUP BY a), n AS (SELECT count(*) AS nodes, coalesce(max(d), 0) AS max_degree FROM dg), k AS (SELECT count(*) AS edges FROM p), mx AS (SELECT item AS max_degree_node FROM dg ORDER BY d DESC, item LIMIT 1) SELECT nodes, edges, round(2 * edges / (nodes * (nodes - 1)), 4) AS density, round(2 * edges / nodes, 2) AS mean_degree, max_degree, max_degree_node, components, largest_component FROM n, k, cs, mx",
    "edge_chunks": f"WITH {_M}, {_STRICT_M}, {_PAIRS} SELECT x.item AS a, y.item AS b, count(*) AS weight, string_agg(x.basket, ',' ORDER BY x.basket) AS chunks FROM mem x JOIN mem y ON x.basket = y.basket AND x.item < y.item GROUP BY ALL HAVING count(*) >= 2",
    "near_details": _FULL + " SELECT ent AS source, 'element::' || element_id AS target, score_e4, reasons, array_to_string(chunk_list[1:12], ',') AS evidence FROM ranked WHERE rank <= 12",
    "node_type_counts": _FULL + " SELECT node_type, count(*) AS n FROM nodes GROUP BY node_type",
    "relation_targets": _FULL + " SELECT relation, coalesce(t.node_type, 'unknown') AS target_type, count(*) AS n FROM alle LEFT JOIN (SELECT id, min(node_type) AS node_type FROM nodes GROUP BY id) t ON t.id = alle.target GROUP BY ALL",
    "link_summary": _FULL + ", t AS (SELECT relation, k.node_type FROM alle LEFT JOIN (SELECT id, min(node_type) AS node_type FROM nodes GROUP BY id) k ON k.id = alle.target), e2 AS (SELECT count(*) AS edges, count(*) FILTER (relation = 'HAS_CAPTION') AS caption_links, count(*) FILTER (relation = 'RELATED_TO') AS chunk_related_links, count(*) FILTER (relation = 'DISCUSSED_NEAR' AND node_type = 'figure') AS entity_figure_links, count(*) FILTER (relation = 'DISCUSSED_NEAR' AND node_type = 'table') AS entity_table_links FROM t), "
    "n2 AS (SELECT count(*) AS nodes, count(*) FILTER (node_type = 'document') AS document_nodes, count(*) FILTER (node_type = 'entity') AS entity_nodes, count(*) FILTER (node_type = 'chunk') AS chunk_nodes, count(*) FILTER (node_type = 'figure') AS figure_nodes, count(*) FILTER (node_type = 'caption') AS caption_nodes, count(*) FILTER (node_type = 'table') AS table_nodes, count(*) FILTER (node_type = 'formula') AS formula_nodes FROM nodes) SELECT * FROM n2, e2",
    "md_blocks": f"""WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) AS no, {_strip('unnest(ls)')} AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
      s AS (SELECT *, starts_with(line, '#') AS head, coalesce(lag(starts_with(line, '#') OR line = '') OVER (PARTITION BY doc_id ORDER BY no), true) AS fresh FROM l),
      g AS (SELECT *, sum(CASE WHEN head OR (line <> '' AND fresh) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY no) AS grp FROM s)
      SELECT doc_id, CAST(grp - 1 AS INT) AS block_index, CASE WHEN bool_or(head) THEN 'title' ELSE 'text' END AS block_type,
             CASE WHEN bool_or(head) THEN {_strip("regexp_replace(string_agg(line, chr(10) ORDER BY no), '^[# ]+', '')")} ELSE string_agg(line, chr(10) ORDER BY no) END AS content FROM g WHERE line <> '' GROUP BY doc_id, grp""",
    "element_types": f"WITH {_B}, {_UNWRAP_B}, r AS (SELECT block_id, lower(coalesce(block_type, 'text')) AS t, regexp_matches(w, {_q('(?i)' + CAPTION)}) AS cap FROM b JOIN u USING (block_id)) SELECT block_id, CASE WHEN t IN ('image', 'img', 'figure') THEN 'figure' WHEN t = 'table' THEN 'table' WHEN t IN ('formula', 'equation', 'inline_equation', 'interline_equation') THEN 'formula' WHEN t IN ('title', 'heading', 'header') THEN 'title' WHEN t IN ('caption', 'figure_caption', 'table_caption') OR cap THEN 'caption' WHEN t IN ('list', 'list_item') THEN 'list' WHEN t IN ('paragraph', 'para', '') THEN 'text' ELSE t END AS element_type FROM r",
    "ref_labels": f"WITH {_B}, {_UNWRAP_B} SELECT block_id, regexp_matches(w, {_q('(?i)' + CAPTION)}) AS is_caption, {_label('w')} AS ref_label FROM u",
    "strip_wrappers": f"WITH {_B}, {_UNWRAP_B} SELECT block_id, w AS inner_text FROM u",
    "section_carry": f"WITH {_E}, {_UNWRAP_E} SELECT element_id, coalesce(last_value(CASE WHEN element_type = 'title' THEN w END IGNORE NULLS) OVER (PARTITION BY source_hash ORDER BY block_index, element_id ROWS UNBOUNDED PRECEDING), '') AS section FROM e JOIN u USING (element_id)",
    "caption_links": f"WITH {_E}, {_UNWRAP_E}, {_LINKS} SELECT caption_id, target_id, distance FROM links",
    "target_captions": f"WITH {_E}, {_UNWRAP_E}, {_LINKS} SELECT target_id, arg_min(caption_id, struct_pack(a := at_, b := caption_id)) AS caption_id FROM links GROUP BY target_id",
    "flatten_items": f"WITH {_B} SELECT source_hash, CAST(row_number() OVER (PARTITION BY source_hash ORDER BY page_number, block_index, block_id) - 1 AS INT) AS item_idx, block_id, {_strip('content')} AS item_text FROM b WHERE content IS NOT NULL AND block_type IS NOT NULL",
    "clean_blocks": f"WITH {_B}, x AS (SELECT *, {_strip(chr(34) + 'content' + chr(34))} AS txt FROM b), k AS (SELECT * FROM x WHERE coalesce(txt, '') <> '' AND NOT ({_NOISE})) SELECT block_id FROM k QUALIFY row_number() OVER (PARTITION BY source_hash, substr(txt, 1, 100) ORDER BY block_index, block_id) < 3",
    "block_type_counts": f"WITH {_B} SELECT source_hash, coalesce(block_type, 'unknown') AS block_type, count(*) AS n FROM b GROUP BY ALL",
    "total_pages": f"WITH {_B}, {_E} SELECT source_hash, CAST(coalesce(max(page_number), 0) + 1 AS INT) AS pages FROM (SELECT source_hash, page_number FROM b UNION ALL SELECT source_hash, page_number FROM e) GROUP BY source_hash",
    "missing_pages": f"WITH {_B}, {_E}, t AS (SELECT source_hash, CAST(coalesce(max(page_number), 0) + 1 AS INT) AS pages FROM (SELECT source_hash, page_number FROM b UNION ALL SELECT source_hash, page_number FROM e) GROUP BY source_hash), x AS (SELECT source_hash, CAST(unnest(range(pages)) AS INT) AS page_number FROM t) SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.source_hash = x.source_hash AND b.page_number = x.page_number)",
    "parse_validation": f"""WITH {_B}, {_E}, t AS (SELECT source_hash, coalesce(max(page_number), 0) + 1 AS pages FROM (SELECT source_hash, page_number FROM b UNION ALL SELECT source_hash, page_number FROM e) GROUP BY source_hash),
      p AS (SELECT source_hash, count(*) AS n, count(DISTINCT page_number) AS covered, count(*) FILTER (length({_strip("coalesce(content, '')")}) < 5) AS short, avg(length(coalesce(content, ''))) FILTER (block_type = 'text') AS mt, count(*) FILTER (block_type = 'table' AND NOT contains(coalesce(content, ''), '|') AND NOT contains(coalesce(content, ''), '<')) AS pt FROM b GROUP BY source_hash),
      i AS (SELECT source_hash, count(image_path) AS images, count(*) FILTER (element_type = 'figure') AS figures FROM e GROUP BY source_hash)
      SELECT source_hash, CAST(pages - covered AS INT) AS missing_pages, short > n * 0.1 AS many_short, coalesce(mt, 99.0) < 20 AS short_text, pt AS plain_tables, coalesce(images, 0) > 0 AND coalesce(figures, 0) = 0 AS images_without_figures FROM p JOIN t USING (source_hash) LEFT JOIN i USING (source_hash)""",
    "token_estimate": f"SELECT doc_id, {_TOKENS.format('text')} AS tokens FROM documents",
    "sentence_split": f"WITH x AS (SELECT doc_id, {_sentences('text')} AS s FROM documents) SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INT) AS sentence_no, unnest(s) AS sentence FROM x",
    "title_levels": f"WITH {_B}, {_E}, {_TITLED} SELECT block_id, lvl AS level, title FROM titled",
    "section_groups": f"WITH {_B}, {_E}, {_TITLED} SELECT source_hash, section, CAST(sum(CASE WHEN lvl = 0 THEN 1 ELSE 0 END) AS BIGINT) AS blocks, min(page_number) AS page_start, max(page_number) AS page_end FROM titled GROUP BY ALL HAVING sum(CASE WHEN lvl = 0 THEN 1 ELSE 0 END) > 0",
    "heading_hierarchy": f"""WITH {_B}, {_E}, {_TITLED}, h AS (SELECT source_hash, section, lvl, title FROM titled WHERE lvl > 0), body AS (SELECT DISTINCT source_hash, section FROM titled WHERE lvl = 0),
      o AS (SELECT body.source_hash, body.section, string_agg(h.title, ' > ' ORDER BY h.lvl) AS hierarchy FROM body JOIN h ON h.source_hash = body.source_hash AND h.section <= body.section
        AND NOT EXISTS (SELECT 1 FROM h z WHERE z.source_hash = h.source_hash AND z.section > h.section AND z.section <= body.section AND z.lvl <= h.lvl) GROUP BY ALL)
      SELECT body.source_hash, body.section, coalesce(hierarchy, '') AS hierarchy FROM body LEFT JOIN o USING (source_hash, section)""",
    "chunk_stats": f"WITH {_C} SELECT count(*) AS chunks, CAST(coalesce(sum(token_count), 0) AS BIGINT) AS tokens, round(coalesce(avg(coalesce(token_count, 0)), 0), 4) AS mean_tokens, CAST(coalesce(min(coalesce(token_count, 0)), 0) AS BIGINT) AS least, CAST(coalesce(max(coalesce(token_count, 0)), 0) AS BIGINT) AS most, count(*) FILTER (has_equations) AS with_equations, count(*) FILTER (has_tables) AS with_tables FROM c",
    "chunk_histogram": f"WITH {_C} SELECT CASE WHEN coalesce(token_count, 0) < 100 THEN '<100' WHEN token_count < 300 THEN '100-300' WHEN token_count < 500 THEN '300-500' ELSE '500+' END AS bucket, count(*) AS n FROM c GROUP BY ALL",
    "chunk_source_blocks": f"WITH {_C}, {_B}, x AS (SELECT chunk_id, source_hash, unnest(block_indices) AS block_index, generate_subscripts(block_indices, 1) AS pos FROM c), y AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY pos) - 1 AS ord FROM (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY chunk_id, block_index ORDER BY pos) = 1)) SELECT chunk_id, CAST(ord AS INT) AS ord, block_id, substr({_strip('content')}, 1, 180) AS preview FROM y JOIN b ON b.source_hash = y.source_hash AND b.block_index = y.block_index",
    "chunk_source_elements": f"WITH {_C}, {_E} SELECT DISTINCT chunk_id, element_id FROM (SELECT chunk_id, source_hash, unnest(block_indices) AS at_ FROM c) x JOIN e ON e.source_hash = x.source_hash AND CAST(coalesce(e.source_block_index, e.block_index) AS INT) = x.at_",
    "chunk_related_elements": f"""WITH {_C}, {_E}, el AS (SELECT source_hash, element_id, element_type IN ('figure', 'caption', 'table', 'formula') AS st, page_number, CAST(coalesce(source_block_index, block_index) AS INT) AS at_, section_title, metadata.linked_element_id AS linked, metadata.caption_element_id AS cap FROM e),
      src AS (SELECT DISTINCT chunk_id, element_id FROM (SELECT chunk_id, source_hash, unnest(block_indices) AS at_ FROM c) x JOIN el USING (source_hash, at_)),
      r AS (SELECT c.chunk_id, el.* FROM c JOIN el ON el.source_hash = c.source_hash WHERE st AND el.page_number BETWEEN c.page_start AND c.page_end AND (coalesce(list_contains(list_concat(coalesce(c.section_hierarchy, []), [c.section_title]), el.section_title), false) OR coalesce(el.at_ BETWEEN list_min(c.block_indices) - 1 AND list_max(c.block_indices) + 1, false))),
      u AS (SELECT chunk_id, element_id FROM src JOIN el USING (element_id) WHERE st UNION SELECT chunk_id, linked FROM src JOIN el USING (element_id) UNION SELECT chunk_id, cap FROM src JOIN el USING (element_id)
        UNION SELECT chunk_id, element_id FROM r UNION SELECT chunk_id, linked FROM r UNION SELECT chunk_id, cap FROM r UNION SELECT src.chunk_id, el.element_id FROM src JOIN el ON el.linked = src.element_id WHERE el.st)
      SELECT chunk_id, element_id FROM u WHERE element_id IN (SELECT element_id FROM el)""",
    "text_containment_blocks": f"WITH {_C}, {_B}, x AS (SELECT source_hash, block_index, {_strip("coalesce(content, '')")} AS txt FROM b) SELECT DISTINCT chunk_id, x.block_index FROM c JOIN x ON x.source_hash = c.source_hash AND x.txt <> '' AND contains(c.text, substr(x.txt, 1, 160))",
    "rule_mentions": f"WITH {_C}, w AS (SELECT chunk_id, generate_subscripts(ws, 1) - 1 AS ord, regexp_replace(unnest(ws), '^[.,;:!?()\\[\\]{{}}\"''«»“”]+|[.,;:!?()\\[\\]{{}}\"''«»“”]+$', '', 'g') AS text FROM (SELECT chunk_id, regexp_split_to_array(coalesce(text, ''), '[ \\n\\t\\r]+') AS ws FROM c)) SELECT chunk_id, CAST(ord AS INT) AS ord, text, CASE WHEN substr(text, 1, 1) < 'H' THEN 'PERSON' WHEN length(text) >= 9 THEN 'ORG' ELSE 'CONCEPT' END AS entity_type FROM w WHERE regexp_matches(text, '^[A-Z][a-z]{{3,}}$')",
    "normalize_entities": f"WITH {_M} SELECT mention_id, lower(regexp_replace({_strip("regexp_replace(text, '\\s+', ' ', 'g')")}, '^[.,;:!?()\\[\\]{{}}\"''«»“”]+|[.,;:!?()\\[\\]{{}}\"''«»“”]+$', '', 'g')) AS name FROM m WHERE text IS NOT NULL",
    "entity_context": f"""WITH {_M}, {_C}, f AS (SELECT mention_id, text AS name, ({_IDS})[1] AS chunk_id FROM m WHERE text <> ''), p AS (SELECT mention_id, name, c.text, CASE WHEN instr(c.text, name) > 0 THEN instr(c.text, name) ELSE instr(lower(c.text), lower(name)) END AS pos FROM f JOIN c USING (chunk_id)),
      q AS (SELECT *, greatest(0, pos - 151) AS st, least(length(text), pos - 1 + length(name) + 150) AS en FROM p)
      SELECT mention_id, CASE WHEN coalesce(pos, 0) = 0 THEN '' ELSE CASE WHEN st > 0 THEN '...' ELSE '' END || {_strip('substr(text, CAST(st + 1 AS BIGINT), CAST(en - st AS BIGINT))')} || CASE WHEN en < length(text) THEN '...' ELSE '' END END AS context FROM q""",
    "sentence_context": f"WITH {_M}, {_C}, f AS (SELECT mention_id, text AS name, ({_IDS})[1] AS chunk_id FROM m WHERE text IS NOT NULL) SELECT mention_id, coalesce(list_filter({_sentences('c.text')}, lambda s: contains(s, name))[1], '') AS sentence FROM f JOIN c USING (chunk_id)",
    "lang_detect": f"WITH {_C} SELECT chunk_id, CASE WHEN len(regexp_extract_all(text, '[а-яА-ЯёЁ]')) > len(regexp_extract_all(text, '[a-zA-Z]')) THEN 'ru' ELSE 'en' END AS language FROM c WHERE text IS NOT NULL",
    "text_segments": f"WITH {_C}, x AS (SELECT chunk_id, text, CASE WHEN length(text) <= 800 THEN [0] ELSE range(0, length(text), 700) END AS st FROM c WHERE text IS NOT NULL) SELECT chunk_id, CAST(generate_subscripts(st, 1) - 1 AS INT) AS segment_no, substr(text, CAST(unnest(st) + 1 AS BIGINT), 800) AS segment FROM x",
    "filter_noise": f"WITH {_M}, {_DROP} SELECT mention_id FROM d",
    "dedup_entities": f"WITH {_M}, {_ENT} SELECT source_doc, normalized, entity_type, text, confidence, array_to_string(chunk_ids, ',') AS chunk_ids, page_start, page_end, array_to_string(list_filter(related_element_ids, lambda x: x IS NOT NULL), ',') AS related_element_ids, mentions FROM ent",
    "ranked_entities": f"WITH {_M}, {_ENT} SELECT source_doc, normalized, entity_type, row_number() OVER (PARTITION BY source_doc ORDER BY confidence DESC NULLS LAST, entity_type NULLS LAST, normalized NULLS LAST) AS place FROM ent",
    "entity_type_counts": f"WITH {_M}, {_ENT} SELECT coalesce(entity_type, 'UNKNOWN') AS entity_type, count(*) AS n FROM ent GROUP BY ALL",
    "noise_reasons": f"WITH {_M}, x AS (SELECT *, {_NAME} AS name FROM m) SELECT CASE WHEN coalesce(entity_type, '') IN {_IN(R.SKIP_TYPES)} THEN 'skip_type' WHEN length(name) < 3 THEN 'too_short' WHEN {_BASE} THEN 'noise_pattern' WHEN length(name) > 100 THEN 'too_long' ELSE 'kept' END AS reason, count(*) AS n FROM x GROUP BY ALL",
    "clean_entities": f"WITH {_M}, {_STRICT_M} SELECT mention_id FROM s",
    "fuzzy_pairs": _FUZZY.format(m=_M, f=_STRICT_M, rel="s", inside=4, edit=6),
    "fuzzy_pairs_baseline": _FUZZY.format(m=_M, f=f"s AS (SELECT * FROM (SELECT *, {_NAME} AS name FROM m) WHERE coalesce(entity_type, '') NOT IN {_IN(R.SKIP_TYPES)} AND length(name) BETWEEN 3 AND 100 AND NOT ({_BASE}))", rel="s", inside=3, edit=5),
    "cooccurrence_edges": f"WITH {_M}, {_STRICT_M}, {_PAIRS} SELECT * FROM allp",
    "clean_graph_edges": _EDGES + " SELECT * FROM p",
    "graph_isolates": _EDGES + " SELECT DISTINCT item FROM mem WHERE item NOT IN (SELECT a FROM arcs)",
    "graph_degrees": _EDGES + " SELECT a AS item, count(*) AS degree, CAST(sum(weight) AS BIGINT) AS strength FROM arcs GROUP BY a",
    "graph_density": _EDGES + ", n AS (SELECT count(DISTINCT item) AS nodes FROM mem), k AS (SELECT count(*) AS edges FROM p), t AS (SELECT coalesce(max(d), 0) AS max_degree FROM (SELECT count(*) AS d FROM arcs GROUP BY a)) SELECT nodes, edges, round(2 * edges / (nodes * (nodes - 1)), 4) AS density, round(2 * edges / nodes, 4) AS mean_degree, max_degree FROM n, k, t",
    "graph_components": _EDGES.replace("WITH ", "WITH RECURSIVE ", 1) + ", reach AS (SELECT a AS item, a AS other FROM arcs UNION SELECT r.item, arcs.b FROM reach r JOIN arcs ON arcs.a = r.other) SELECT item, min(other) AS component FROM reach GROUP BY item",
    "graph_pagerank": _pagerank(),
    "graph_communities": _communities(),
    "graph_heavy": f"WITH {_M}, {_STRICT_M}, {_PAIRS}, f AS (SELECT item FROM mem GROUP BY item HAVING count(*) >= 10) SELECT * FROM allp WHERE weight >= 3 AND a IN (SELECT item FROM f) AND b IN (SELECT item FROM f)",
    "element_registry": f"WITH {_E}, {_REG} SELECT element_id, element_type, coalesce(source_doc, '') AS source_doc, label FROM reg",
    "link_nodes": _FULL + " SELECT * FROM nodes",
    "discussed_near_topn": _FULL + " SELECT element_id, ent, score_e4, evidence, rank, reasons FROM ranked WHERE rank <= 12",
    "link_metrics": _FULL + " SELECT CAST(sum(k) AS BIGINT) AS candidates, CAST(sum(least(k, 12)) AS BIGINT) AS kept, CAST(sum(k) - sum(least(k, 12)) AS BIGINT) AS pruned FROM (SELECT count(*) AS k FROM cand GROUP BY element_id)",
    "link_edges": _FULL + " SELECT * FROM merged",
    "relation_counts": _FULL + " SELECT relation, count(*) AS n, CAST(sum(evidence) AS BIGINT) AS evidence FROM alle GROUP BY relation",
    "view_figures": _FULL + "," + _around("('figure')", "v") + " SELECT id FROM v",
    "view_tables": _FULL + "," + _around("('table')", "v") + " SELECT id FROM v",
    "view_core": _FULL + "," + _around("('figure', 'table')", "v") + " SELECT id FROM v UNION SELECT id FROM nodes WHERE node_type IN ('document', 'title')",
    "view_core_edges": _FULL + "," + _around("('figure', 'table')", "v") + ", w AS (SELECT id FROM v UNION SELECT id FROM nodes WHERE node_type IN ('document', 'title')) SELECT source, target, relation FROM alle WHERE relation IN ('DISCUSSED_NEAR', 'HAS_CAPTION', 'CAPTION_OF') AND source IN (SELECT id FROM w) AND target IN (SELECT id FROM w)",
    "view_focus": _FULL + ", f AS (SELECT source AS id FROM alle WHERE source = 'element::shared_el_0000' OR target = 'element::shared_el_0000' UNION SELECT target FROM alle WHERE source = 'element::shared_el_0000' OR target = 'element::shared_el_0000') SELECT id FROM f UNION SELECT target FROM alle WHERE relation IN ('HAS_CAPTION', 'CAPTION_OF') AND source IN (SELECT id FROM f) UNION SELECT source FROM alle WHERE relation IN ('HAS_CAPTION', 'CAPTION_OF') AND target IN (SELECT id FROM f)",
    "view_page": _FULL + " SELECT id FROM nodes WHERE node_type = 'document' OR coalesce(2 BETWEEN page_start AND page_end, false)",
    "view_section": _FULL + " SELECT id FROM nodes WHERE node_type = 'document' OR coalesce(section = 'Summary of findings', false)",
    "view_search": _FULL + " SELECT id FROM nodes WHERE contains(lower(concat_ws(' ', label, ref, section, caption, node_type, id)), 'value at risk')",
    "artifact_checks": _FULL + " SELECT * FROM (VALUES ('kept_within_candidates', true), ('pruned_is_difference', true), ('no_loops', NOT EXISTS (SELECT 1 FROM alle WHERE source = target)), ('weights_from_one', NOT EXISTS (SELECT 1 FROM alle WHERE weight < 1)), ('links_within_limit', NOT EXISTS (SELECT 1 FROM alle WHERE relation = 'DISCUSSED_NEAR' GROUP BY target HAVING count(*) > 12))) t(\"check\", ok)",
}
