"""DuckDB SQL twins of the registered queries (same names, same column aliases).

Written independently of the Spark code from the operator definitions: plain
GROUP BY / window / UNNEST SQL over the driver's pre-registered views.
"""

from __future__ import annotations

from quire.functions.text import PY_WS

# Python str.strip() whitespace as a DuckDB string expression.
WS = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WS) + ")"
NL = "chr(10)"


def paras(x: str, delim: str = NL) -> str:
    return (f"list_filter(list_transform(string_split(coalesce({x}, ''), {delim}), "
            f"lambda s: trim(s, {WS})), lambda s: s <> '')")


def tokens(x: str) -> str:
    return f"CAST(CASE WHEN {x} IS NULL OR length({x}) = 0 THEN 0 ELSE greatest(1, length({x}) // 4) END AS INTEGER)"


def src_hash(x: str) -> str:
    return f"sha256(encode(coalesce({x}, ''))[1:4096])"


def chash(x: str) -> str:
    return f"left(sha256(coalesce({x}, '')), 16)"


CONV_PAGES = f"""
conv_pg0 AS (
  SELECT conv_id AS doc_id, CAST(turn AS INTEGER) AS page_index, coalesce(text, '') AS page_text
  FROM conversations),
conv_doc AS (
  SELECT doc_id, sha256(encode(string_agg(page_text, chr(12) ORDER BY page_index))[1:4096]) AS source_hash,
         CAST(count(*) AS INTEGER) AS page_count
  FROM conv_pg0 GROUP BY doc_id),
conv_pg AS (
  SELECT p.doc_id, p.page_index, p.page_text, d.source_hash, d.page_count
  FROM conv_pg0 p JOIN conv_doc d ON p.doc_id = d.doc_id)"""


def doc_pages(lines_per_page: int | None) -> str:
    if lines_per_page is None:
        return f"""
doc_pg AS (
  SELECT doc_id, 0 AS page_index, coalesce(text, '') AS page_text, {src_hash('text')} AS source_hash,
         1 AS page_count
  FROM documents)"""
    n = int(lines_per_page)
    return f"""
doc_lines AS (
  SELECT doc_id, coalesce(text, '') AS source, string_split(coalesce(text, ''), {NL}) AS lines FROM documents),
doc_np AS (
  SELECT *, greatest(1, CAST(ceil(len(lines) / {n}) AS BIGINT)) AS np FROM doc_lines),
doc_pg AS (
  SELECT doc_id, CAST(p AS INTEGER) AS page_index,
         array_to_string(list_slice(lines, p * {n} + 1, p * {n} + {n}), {NL}) AS page_text,
         {src_hash('source')} AS source_hash, CAST(np AS INTEGER) AS page_count
  FROM (SELECT *, unnest(range(0, np)) AS p FROM doc_np))"""


def heuristic_nodes(pg: str, prefix: str, start: int | None = None, end: int | None = None) -> str:
    """CTEs ``{prefix}_nodes`` for a page CTE (doc_id, page_index, page_text,
    source_hash, page_count), numbered after the clamped page range."""
    s = "0" if start is None else f"greatest(0, least({int(start)}, page_count - 1))"
    e = "page_count - 1" if end is None else f"greatest({s}, least({int(end)}, page_count - 1))"
    return f"""
{prefix}_sel AS (
  SELECT doc_id, page_index, source_hash, {paras('page_text')} AS paras FROM {pg}
  WHERE page_index BETWEEN {s} AND {e}),
{prefix}_num AS (
  SELECT doc_id, page_index, source_hash, paras, CAST(len(paras) AS INTEGER) AS n,
    CAST(coalesce(sum(len(paras) + 1) OVER (PARTITION BY doc_id ORDER BY page_index
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS b,
    CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_index) - 1 AS INTEGER) AS child_pos,
    CAST(sum(len(paras) + 1) OVER (PARTITION BY doc_id) AS INTEGER) AS total,
    CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS n_sections
  FROM {prefix}_sel),
{prefix}_ids AS (
  SELECT *, concat('ast:', left(source_hash, 6), ':0:', total + 1) AS doc_nid,
         concat('ast:', left(source_hash, 6), ':', page_index, ':', b + n + 1) AS sec_nid
  FROM {prefix}_num),
{prefix}_nodes AS (
  SELECT doc_id, doc_nid AS node_id, CAST(NULL AS VARCHAR) AS parent_id, 0 AS pre, total AS last,
         0 AS depth, 0 AS child_pos, 'document' AS node_type, 0 AS page_index,
         CAST(NULL AS VARCHAR) AS text_content, CAST(NULL AS INTEGER) AS level,
         CAST(NULL AS VARCHAR) AS struct_type, TRUE AS heuristic, CAST(NULL AS INTEGER) AS mcid,
         n_sections AS children_count
  FROM {prefix}_ids WHERE child_pos = 0
  UNION ALL
  SELECT doc_id, sec_nid, doc_nid, b + 1, b + 1 + n, 1, child_pos, 'section', page_index, NULL, NULL, NULL,
         TRUE, NULL, n
  FROM {prefix}_ids
  UNION ALL
  SELECT doc_id, concat('ast:', left(source_hash, 6), ':', page_index, ':', b + k + 1), sec_nid,
         b + k + 2, b + k + 2, 2, k, 'paragraph', page_index, t, NULL, NULL, TRUE, NULL, 0
  FROM (SELECT *, unnest(paras) AS t, CAST(generate_subscripts(paras, 1) - 1 AS INTEGER) AS k
        FROM {prefix}_ids))"""


def node_select(cte: str, where: str = "TRUE") -> str:
    return f"""SELECT CAST(doc_id AS BIGINT) AS doc_id, node_id, parent_id, CAST(pre AS INTEGER) AS pre,
  CAST(last AS INTEGER) AS last, CAST(depth AS INTEGER) AS depth, CAST(child_pos AS INTEGER) AS child_pos,
  node_type, CAST(page_index AS INTEGER) AS page_index, text_content, CAST(level AS INTEGER) AS level,
  struct_type, heuristic, CAST(mcid AS INTEGER) AS mcid, CAST(children_count AS INTEGER) AS children_count
FROM {cte} WHERE {where}"""


CONV_NODES = CONV_PAGES + "," + heuristic_nodes("conv_pg", "conv")
DOC_NODES_1 = doc_pages(None) + "," + heuristic_nodes("doc_pg", "doc")
DOC_NODES_8 = doc_pages(8) + "," + heuristic_nodes("doc_pg", "doc")


def cited(cte: str, where: str = "TRUE") -> str:
    return f"""SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(pre AS INTEGER) AS pre, node_id,
  CAST(page_index AS INTEGER) AS page_index, node_type, text_content AS text,
  CAST(CASE WHEN heuristic THEN 0.5 ELSE 1.0 END AS DOUBLE) AS confidence, {chash('text_content')} AS content_hash,
  CAST(0.0 AS DOUBLE) AS bbox_x, CAST(0.0 AS DOUBLE) AS bbox_y, CAST(1.0 AS DOUBLE) AS bbox_width,
  CAST(1.0 AS DOUBLE) AS bbox_height, CAST(depth AS INTEGER) AS depth
FROM {cte} WHERE length(text_content) > 0 AND {where}"""


def search(cte: str, where: str, k: int) -> str:
    return f"""SELECT * , total_matches > {k} AS truncated FROM (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(pre AS INTEGER) AS pre, node_id, node_type,
    CAST(page_index AS INTEGER) AS page_index, text_content, CAST(level AS INTEGER) AS level, struct_type,
    heuristic, CAST(children_count AS INTEGER) AS children_count,
    CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pre) AS INTEGER) AS rank,
    count(*) OVER (PARTITION BY doc_id) AS total_matches
  FROM {cte} WHERE {where}) WHERE rank <= {k}"""


ORACLE: dict[str, str] = {}

ORACLE["source_hash"] = f"""
SELECT doc_id, {src_hash('text')} AS source_hash, sha256(coalesce(text, '')) AS full_hash,
       CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes
FROM documents"""

ORACLE["dedupe_by_hash"] = f"""
SELECT min(doc_id) AS doc_id, source_hash, count(*) AS copies
FROM ({ORACLE['source_hash']}) GROUP BY source_hash, full_hash"""

ORACLE["gate_corpus"] = """
WITH d AS (
  SELECT doc_id, 'documents' AS corpus, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes,
         1 AS page_count FROM documents),
c AS (
  SELECT conv_id AS doc_id, 'conversations' AS corpus,
         CAST(sum(octet_length(encode(coalesce(text, '')))) + count(*) - 1 AS BIGINT) AS n_bytes,
         CAST(count(*) AS INTEGER) AS page_count
  FROM conversations GROUP BY conv_id),
g AS (
  SELECT *, CASE WHEN n_bytes > 4096 THEN 'size' WHEN page_count = 0 THEN 'no_pages'
                 WHEN page_count > 2000 THEN 'too_many_pages' END AS reason FROM d
  UNION ALL
  SELECT *, CASE WHEN n_bytes > 200000000 THEN 'size' WHEN page_count = 0 THEN 'no_pages'
                 WHEN page_count > 5 THEN 'too_many_pages' END FROM c)
SELECT doc_id, corpus, n_bytes, page_count, reason,
       CASE WHEN reason IS NULL THEN 'ok' ELSE 'rejected' END AS status
FROM g"""

ORACLE["paragraphs"] = f"""
SELECT doc_id, 0 AS page_index, CAST(k AS INTEGER) AS para_index, t AS text, {chash('t')} AS content_hash
FROM (SELECT doc_id, unnest(ps) AS t, generate_subscripts(ps, 1) - 1 AS k
      FROM (SELECT doc_id, {paras('text')} AS ps FROM documents))"""

ORACLE["heuristic_nodes_conv"] = f"WITH {CONV_NODES}\n{node_select('conv_nodes')}"
ORACLE["heuristic_nodes_docs"] = f"WITH {DOC_NODES_8}\n{node_select('doc_nodes')}"
ORACLE["ast_page_range"] = (f"WITH {CONV_PAGES}, {heuristic_nodes('conv_pg', 'conv', 1, 2)}\n"
                            f"{node_select('conv_nodes')}")
ORACLE["ast_first_pages"] = (f"WITH {CONV_PAGES}, {heuristic_nodes('conv_pg', 'conv', 0, 1)}\n"
                             f"{node_select('conv_nodes')}")

ORACLE["cited_text"] = f"WITH {CONV_NODES}\n{cited('conv_nodes')}"
ORACLE["cited_text_page"] = f"WITH {CONV_NODES}\n{cited('conv_nodes', 'page_index = 1')}"
ORACLE["search_nodes"] = f"WITH {CONV_NODES}\n{search('conv_nodes', "node_type = 'paragraph'", 3)}"
ORACLE["search_text"] = (f"WITH {DOC_NODES_1}\n"
                         f"{search('doc_nodes', "length(text_content) > 0 AND contains(lower(text_content), 'the')", 5)}")

ORACLE["document_info"] = f"""WITH {CONV_NODES}
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, '1.0' AS schema_version, d.source_hash, d.page_count,
       CAST(coalesce(t.estimated_tokens, 0) AS BIGINT) AS estimated_tokens, t.root_node_type,
       CAST(t.root_children_count AS INTEGER) AS root_children_count
FROM conv_doc d LEFT JOIN (
  SELECT doc_id, sum({tokens('text_content')}) AS estimated_tokens,
         max(CASE WHEN pre = 0 THEN node_type END) AS root_node_type,
         max(CASE WHEN pre = 0 THEN children_count END) AS root_children_count
  FROM conv_nodes GROUP BY doc_id) t ON d.doc_id = t.doc_id"""

ORACLE["plain_text"] = f"""
SELECT conv_id AS doc_id, string_agg(coalesce(text, ''), {NL} ORDER BY turn) AS text,
       CAST(count(*) AS INTEGER) AS pages_processed
FROM conversations GROUP BY conv_id"""

ORACLE["token_budget"] = f"""WITH {DOC_NODES_1}
SELECT * FROM (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(pre AS INTEGER) AS pre, node_id, tok AS tokens,
         CAST(sum(tok) OVER (PARTITION BY doc_id ORDER BY pre ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS BIGINT) AS cum_tokens
  FROM (SELECT *, {tokens('text_content')} AS tok FROM doc_nodes WHERE length(text_content) > 0))
WHERE cum_tokens <= 200"""

ORACLE["chunk_index"] = f"""WITH {CONV_NODES}
SELECT *, CAST((cum_tokens - tokens) // 100 AS INTEGER) AS chunk_index FROM (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(pre AS INTEGER) AS pre, node_id, tok AS tokens,
         CAST(sum(tok) OVER (PARTITION BY doc_id ORDER BY pre ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS BIGINT) AS cum_tokens
  FROM (SELECT *, {tokens('text_content')} AS tok FROM conv_nodes WHERE length(text_content) > 0))"""

ORACLE["markdown"] = f"""WITH {CONV_NODES}
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(pre AS INTEGER) AS pre,
  concat('[p', page_index, '] (', node_type, ') ', text_content, '  ', {NL}, '  _cite: ', node_id, ' conf=',
         CAST(round_even(CASE WHEN heuristic THEN 0.5 ELSE 1.0 END * 100, 0) AS BIGINT), '%_', {NL}) AS md
FROM conv_nodes WHERE length(text_content) > 0"""

ORACLE["plain_sink"] = f"""WITH {CONV_NODES}
SELECT CAST(doc_id AS BIGINT) AS doc_id, string_agg(text_content, {NL} ORDER BY pre) AS content
FROM conv_nodes WHERE length(text_content) > 0 GROUP BY doc_id"""

ORACLE["batch_outcome"] = f"""
WITH g AS (
  SELECT doc_id, text, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes, 1 AS page_count
  FROM documents),
r AS (
  SELECT *, CASE WHEN n_bytes > 200000000 THEN 'size' END AS reason FROM g)
SELECT doc_id, CASE WHEN reason IS NULL THEN 'ok' ELSE 'rejected' END AS status, reason, n_bytes, page_count,
       CASE WHEN reason IS NULL THEN CAST(len({paras('text')}) AS BIGINT) END AS n_blocks
FROM r"""

ORACLE["metering"] = f"""WITH {DOC_NODES_8}
SELECT count(*) AS documents, CAST(sum(page_count) AS BIGINT) AS pages_processed,
       (SELECT count(*) FROM doc_nodes WHERE length(text_content) > 0) AS blocks
FROM (SELECT DISTINCT doc_id, page_count FROM doc_pg)"""


# -- tagged HTML corpus -------------------------------------------------------------

def _html_sql() -> str:
    """Trees by a recursive walk that carries the stack of open containers token by token; all rules spelt out."""
    types = {"heading": "'h1','h2','h3','h4','h5','h6'", "paragraph": "'p','#text'", "list": "'ul','ol'", "list_item": "'li'", "table": "'table'",
             "table_row": "'tr'", "table_cell": "'td','th'", "section": "'nav','div','article','section','footer'", "figure": "'figure'", "code": "'pre'"}
    ntype = "CASE " + " ".join(f"WHEN tag IN ({v}) THEN '{k}'" for k, v in types.items()) + " ELSE 'artifact' END"
    level = "CASE WHEN n.tag IN ('h1','h2','h3','h4','h5','h6') THEN CAST(n.tag[2:2] AS INTEGER) END"
    skip = "'html','head','body','meta','link','base','title','/html','/head','/body','/meta','/link','/base','/title'"
    unesc = "raw"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        unesc = f"replace({unesc}, '{ent}', '{ch}')"

    def top(*kinds: str) -> str:
        names = ", ".join(f"'{k}'" for k in kinds)
        return f"coalesce(list_max(list_filter(range(1, len(st) + 1), lambda j: st[j].kind IN ({names}))), 0)"

    same_tag = "coalesce(list_max(list_filter(range(1, len(st) + 1), lambda j: st[j].tag = substr(tg, 2))), 0)"
    return f"""
hp AS (
  SELECT page_id AS doc_id, {src_hash('html')} AS source_hash,
         regexp_replace(coalesce(html, ''), '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g') AS c0
  FROM pages),
hp1 AS (
  SELECT doc_id, source_hash, regexp_replace(regexp_replace(c0, '<([^A-Za-z/!?]|$)', '&lt;\\1', 'g'), '<([^A-Za-z/!?]|$)', '&lt;\\1', 'g') AS c1 FROM hp),
hp2 AS (
  SELECT doc_id, source_hash, regexp_replace(regexp_replace(regexp_replace(c1, '(?i)</?(?:b|i|a|br|em|strong|span)\\b[^>]*>', '', 'g'),
           '<[!?][^>]*>|</>|</[^A-Za-z>][^>]*>', '', 'g'), '(<[A-Za-z][A-Za-z0-9]*)_', '\\1-', 'g') AS c2 FROM hp1),
hp3 AS (
  SELECT doc_id, source_hash, concat(substr(c2, 1, length(c2) - length(string_split(c2, '>')[-1])), replace(string_split(c2, '>')[-1], '<', '&lt;')) AS c FROM hp2),
hx AS (
  SELECT doc_id, source_hash, regexp_extract_all('<body>' || c, '<(/?[A-Za-z][A-Za-z0-9]*)\\b[^>]*>([^<]*)', 1) AS tg,
         regexp_extract_all('<body>' || c, '<(/?[A-Za-z][A-Za-z0-9]*)\\b[^>]*>([^<]*)', 2) AS tx FROM hp3),
h0 AS (
  SELECT doc_id, source_hash, i, CASE WHEN lower(tg[i]) IN ({skip}) THEN '' ELSE lower(tg[i]) END AS tag,
         CASE WHEN lower(tg[i]) = 'title' THEN '' ELSE tx[i] END AS raw
  FROM (SELECT *, unnest(range(1, len(tg) + 1)) AS i FROM hx)),
h1 AS (SELECT *, trim({unesc}, {WS}) <> '' AS has, CASE WHEN tag LIKE '/%' THEN '' ELSE {ntype} END AS kind,
              CASE WHEN tag LIKE '/%' THEN (SELECT {ntype} FROM (SELECT substr(x.tag, 2) AS tag)) ELSE '' END AS ends FROM h0 AS x),
hw(doc_id, i, tg, has, raw, st, up) AS (
  SELECT doc_id, CAST(0 AS BIGINT), '', FALSE, '', CAST([] AS STRUCT(key BIGINT, tag VARCHAR, kind VARCHAR)[]), CAST(NULL AS BIGINT)
  FROM (SELECT DISTINCT doc_id FROM h0)
  UNION ALL
  SELECT doc_id, i, tg, has, raw,
         CASE WHEN kind IN ('section', 'list', 'list_item', 'table', 'table_row', 'table_cell') AND tg <> ''
              THEN list_append(st[1:keep], {{'key': 2 * i, 'tag': tg, 'kind': kind}}) ELSE st[1:keep] END,
         CASE WHEN keep > 0 THEN st[keep].key END
  FROM (
    SELECT doc_id, i, tg, has, raw, kind, st, CASE
      WHEN ends IN ('section', 'list') AND {same_tag} > {top('table', 'table_cell')} THEN {same_tag} - 1
      WHEN ends = 'list_item' AND {same_tag} > {top('list', 'table', 'table_cell')} THEN {same_tag} - 1
      WHEN ends IN ('table_row', 'table_cell') AND {same_tag} > {top('table')} THEN {same_tag} - 1
      WHEN ends = 'table' AND {same_tag} > 0 THEN {same_tag} - 1
      WHEN kind = 'list_item' AND {top('list_item')} > {top('list', 'table', 'table_cell')} THEN {top('list_item')} - 1
      WHEN kind = 'table_row' AND {top('table')} > 0 THEN {top('table')}
      WHEN kind = 'table_row' AND {top('table_row')} > 0 THEN {top('table_row')} - 1
      WHEN kind = 'table_row' AND {top('table_cell')} > 0 THEN {top('table_cell')} - 1
      WHEN kind = 'table_cell' AND {top('table', 'table_row')} > 0 THEN {top('table', 'table_row')}
      WHEN kind = 'table_cell' AND {top('table_cell')} > 0 THEN {top('table_cell')} - 1
      ELSE len(st) END AS keep
    FROM (SELECT h1.doc_id, h1.i, h1.tag AS tg, h1.has, h1.raw, h1.kind, h1.ends, hw.st
          FROM hw JOIN h1 ON h1.doc_id = hw.doc_id AND h1.i = hw.i + 1))),
hv AS (
  SELECT doc_id, 2 * i AS key, up, tg AS tag, raw FROM hw WHERE tg <> '' AND tg NOT LIKE '/%'
  UNION ALL SELECT doc_id, 2 * i + 1, up, '#text', raw FROM hw WHERE has AND (tg = '' OR tg LIKE '/%')
  UNION ALL SELECT doc_id, 2 * i + 1, 2 * i, '#text', raw FROM hw WHERE has AND len(st) > 0 AND st[-1].key = 2 * i),
hu AS (
  SELECT v.* FROM hv v LEFT JOIN (SELECT doc_id, up, count(*) AS k FROM hv GROUP BY doc_id, up) s ON s.doc_id = v.doc_id AND s.up = v.up
  WHERE NOT (v.key % 2 = 1 AND v.up IS NOT DISTINCT FROM v.key - 1 AND s.k = 1)),
ht AS (
  SELECT doc_id, key, up, tag, raw, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY key) - 1 AS INTEGER) AS pos FROM hu),
hn AS (
  SELECT a.doc_id, hp.source_hash, a.tag, a.raw, a.pos, {ntype.replace('tag IN', 'a.tag IN')} AS node_type, b.pos AS parent_pos
  FROM ht a JOIN hp ON hp.doc_id = a.doc_id LEFT JOIN ht b ON b.doc_id = a.doc_id AND b.key = a.up),
hanc AS (
  SELECT doc_id, pos, parent_pos AS a FROM hn WHERE parent_pos IS NOT NULL
  UNION ALL
  SELECT x.doc_id, x.pos, p.parent_pos FROM hanc x JOIN hn p ON x.doc_id = p.doc_id AND x.a = p.pos
  WHERE p.parent_pos IS NOT NULL),
hdep AS (SELECT doc_id, pos, count(*) AS n_anc FROM hanc GROUP BY doc_id, pos),
hlast AS (SELECT doc_id, a AS pos, max(pos) AS last_desc FROM hanc GROUP BY doc_id, a),
hkids AS (SELECT doc_id, parent_pos AS pos, count(*) AS n_kids FROM hn WHERE parent_pos IS NOT NULL
          GROUP BY doc_id, parent_pos),
hcnt AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE parent_pos IS NULL) AS top FROM hn GROUP BY doc_id),
html_nodes AS (
  SELECT hp.doc_id, concat('ast:', left(hp.source_hash, 6), ':0:', coalesce(hcnt.n, 0)) AS node_id,
         CAST(NULL AS VARCHAR) AS parent_id, 0 AS pre, coalesce(hcnt.n, 0) AS last, 0 AS depth, 0 AS child_pos,
         'document' AS node_type, 0 AS page_index, CAST(NULL AS VARCHAR) AS text_content,
         CAST(NULL AS INTEGER) AS level, CAST(NULL AS VARCHAR) AS struct_type, FALSE AS heuristic,
         CAST(NULL AS INTEGER) AS mcid, coalesce(hcnt.top, 0) AS children_count
  FROM hp LEFT JOIN hcnt ON hp.doc_id = hcnt.doc_id
  UNION ALL
  SELECT n.doc_id, concat('ast:', left(n.source_hash, 6), ':0:', n.pos),
         concat('ast:', left(n.source_hash, 6), ':0:', coalesce(n.parent_pos, c.n)),
         n.pos + 1, greatest(n.pos, coalesce(l.last_desc, n.pos)) + 1, 1 + coalesce(d.n_anc, 0),
         row_number() OVER (PARTITION BY n.doc_id, n.parent_pos ORDER BY n.pos) - 1,
         n.node_type, 0,
         CASE WHEN coalesce(k.n_kids, 0) = 0 THEN nullif(trim({unesc}, {WS}), '') END,
         {level}, n.tag, FALSE, NULL, coalesce(k.n_kids, 0)
  FROM hn n JOIN hcnt c ON n.doc_id = c.doc_id
       LEFT JOIN hdep d ON n.doc_id = d.doc_id AND n.pos = d.pos
       LEFT JOIN hlast l ON n.doc_id = l.doc_id AND n.pos = l.pos
       LEFT JOIN hkids k ON n.doc_id = k.doc_id AND n.pos = k.pos)"""


HTML_NODES = _html_sql()

ORACLE["html_nodes"] = f"WITH RECURSIVE {HTML_NODES}\n{node_select('html_nodes')}"
ORACLE["tag_histogram"] = f"WITH RECURSIVE {HTML_NODES}\nSELECT tag, count(*) AS n FROM ht GROUP BY tag"
ORACLE["cited_headings"] = f"WITH RECURSIVE {HTML_NODES}\n{cited('html_nodes', "node_type = 'heading'")}"
ORACLE["outline"] = f"""WITH RECURSIVE {HTML_NODES}
SELECT doc_id, pre, node_id, page_index, text, depth, count(*) OVER (PARTITION BY doc_id) AS heading_count,
       total_matches, truncated FROM (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(pre AS INTEGER) AS pre, node_id,
         CAST(page_index AS INTEGER) AS page_index, coalesce(text_content, '') AS text,
         CAST(coalesce(level, 1) AS INTEGER) AS depth,
         row_number() OVER (PARTITION BY doc_id ORDER BY pre) AS rk,
         count(*) OVER (PARTITION BY doc_id) AS total_matches,
         FALSE AS truncated
  FROM html_nodes WHERE node_type = 'heading')"""

ORACLE["get_node"] = f"""WITH RECURSIVE {HTML_NODES},
keys AS (SELECT doc_id, node_id FROM html_nodes WHERE node_type = 'list'
         UNION ALL
         SELECT hp.doc_id, concat('ast:', left(hp.source_hash, 6), ':0:', coalesce(hcnt.n, 0) + 1)
         FROM hp LEFT JOIN hcnt ON hp.doc_id = hcnt.doc_id)
SELECT CAST(keys.doc_id AS BIGINT) AS doc_id, keys.node_id, n.node_id IS NOT NULL AS found, n.node_type,
       CAST(n.pre AS INTEGER) AS pre, CAST(n.children_count AS INTEGER) AS children_count, n.text_content,
       CASE WHEN n.node_id IS NULL THEN concat('Node not found: ', keys.node_id) END AS error
FROM keys LEFT JOIN html_nodes n ON keys.doc_id = n.doc_id AND keys.node_id = n.node_id"""

ORACLE["subtree"] = f"""WITH {CONV_NODES}
SELECT CAST(k.doc_id AS BIGINT) AS doc_id, k.node_id AS key_id, n.node_id, CAST(n.pre AS INTEGER) AS pre,
       n.node_type, CAST(n.depth AS INTEGER) AS depth, CAST(n.depth - k.depth AS INTEGER) AS rel_depth,
       n.text_content
FROM conv_nodes k JOIN conv_nodes n ON k.doc_id = n.doc_id AND n.pre BETWEEN k.pre AND k.last
WHERE k.node_type = 'section'"""

ORACLE["ancestors"] = f"""WITH RECURSIVE {HTML_NODES}
SELECT CAST(k.doc_id AS BIGINT) AS doc_id, k.node_id AS key_id, a.node_id, a.node_type,
       CAST(a.depth AS INTEGER) AS depth, CAST(a.pre AS INTEGER) AS pre,
       CAST(k.depth - a.depth AS INTEGER) AS distance
FROM html_nodes k JOIN html_nodes a ON k.doc_id = a.doc_id AND a.pre < k.pre AND a.last >= k.pre
WHERE k.node_type = 'list_item'"""

ORACLE["ast_json_roundtrip"] = f"WITH {CONV_NODES}\n{node_select('conv_nodes')}"


# -- tables ---------------------------------------------------------------------------

def _csv_field(x: str) -> str:
    return (f"CASE WHEN regexp_matches(coalesce({x}, ''), '[,\"\\r\\n]') "
            f"THEN concat('\"', replace(coalesce({x}, ''), '\"', '\"\"'), '\"') ELSE coalesce({x}, '') END")


def _csv_line(cells: str) -> str:
    return (f"concat(CASE WHEN len({cells}) = 1 AND coalesce({cells}[1], '') = '' THEN '\"\"' "
            f"ELSE array_to_string(list_transform({cells}, lambda c: {_csv_field('c')}), ',') END, chr(13), chr(10))")


TAB_NODES = """
tl AS (
  SELECT l_orderkey AS doc_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER)
           AS r,
         [CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
          CAST(l_quantity AS VARCHAR), CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR),
          CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR), l_returnflag, l_linestatus,
          strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')] AS cells
  FROM lineitem),
td AS (
  SELECT o.o_orderkey AS doc_id, sha256(encode(concat('order:', o.o_orderkey))[1:4096]) AS h,
         coalesce(c.cnt, 0) AS n_rows
  FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS cnt FROM lineitem GROUP BY l_orderkey) c
       ON o.o_orderkey = c.l_orderkey),
tlh AS (SELECT tl.*, sha256(encode(concat('order:', tl.doc_id))[1:4096]) AS h FROM tl),
tab_nodes AS (
  SELECT doc_id, concat('ast:', left(h, 6), ':0:0') AS node_id, CAST(NULL AS VARCHAR) AS parent_id, 0 AS pre,
         n_rows * 11 + 1 AS last, 0 AS depth, 0 AS child_pos, 'document' AS node_type, 0 AS page_index,
         CAST(NULL AS VARCHAR) AS text_content, CAST(NULL AS INTEGER) AS level, '/Document' AS struct_type,
         FALSE AS heuristic, CAST(NULL AS INTEGER) AS mcid, 1 AS children_count
  FROM td
  UNION ALL
  SELECT doc_id, concat('ast:', left(h, 6), ':0:1'), concat('ast:', left(h, 6), ':0:0'), 1, n_rows * 11 + 1, 1, 0,
         'table', 0, NULL, NULL, '/Table', FALSE, NULL, n_rows
  FROM td
  UNION ALL
  SELECT doc_id, concat('ast:', left(h, 6), ':0:', r * 11 + 2), concat('ast:', left(h, 6), ':0:1'), r * 11 + 2,
         r * 11 + 12, 2, r, 'table_row', 0, NULL, NULL, '/TR', FALSE, NULL, 10
  FROM tlh
  UNION ALL
  SELECT doc_id, concat('ast:', left(h, 6), ':0:', r * 11 + 3 + c), concat('ast:', left(h, 6), ':0:', r * 11 + 2),
         r * 11 + 3 + c, r * 11 + 3 + c, 3, c, 'table_cell', 0, t, NULL, '/TD', FALSE, NULL, 0
  FROM (SELECT *, unnest(cells) AS t, CAST(generate_subscripts(cells, 1) - 1 AS INTEGER) AS c FROM tlh)),
tc AS (
  SELECT doc_id, parent_id AS row_id, list(text_content ORDER BY pre) AS cs
  FROM tab_nodes WHERE node_type = 'table_cell' GROUP BY doc_id, parent_id),
trw AS (
  SELECT r.doc_id, r.parent_id AS table_node_id, r.node_id AS row_id, r.pre AS row_pre, coalesce(tc.cs, []) AS cs
  FROM tab_nodes r LEFT JOIN tc ON r.doc_id = tc.doc_id AND r.node_id = tc.row_id
  WHERE r.node_type = 'table_row'),
tgrid AS (
  SELECT t.doc_id, t.node_id AS table_node_id, t.page_index AS table_page, t.pre AS table_pre, w.row_id,
         coalesce(w.cs, []) AS cs,
         CASE WHEN w.row_id IS NOT NULL
              THEN row_number() OVER (PARTITION BY t.doc_id, t.node_id ORDER BY w.row_pre) - 1 END AS row
  FROM tab_nodes t LEFT JOIN trw w ON t.doc_id = w.doc_id AND t.node_id = w.table_node_id
  WHERE t.node_type = 'table' AND NOT t.heuristic)"""

ORACLE["table_nodes"] = f"WITH {TAB_NODES}\n{node_select('tab_nodes')}"

ORACLE["table_cells"] = f"""WITH {TAB_NODES}
SELECT CAST(doc_id AS BIGINT) AS doc_id, table_node_id, CAST(table_page AS INTEGER) AS table_page,
       CAST(table_pre AS INTEGER) AS table_pre, CAST(row AS INTEGER) AS row, CAST(c AS INTEGER) AS col,
       1 AS row_span, 1 AS col_span, t AS text, CAST(1.0 AS DOUBLE) AS confidence
FROM (SELECT *, unnest(cs) AS t, generate_subscripts(cs, 1) - 1 AS c FROM tgrid WHERE row IS NOT NULL)"""

ORACLE["cited_tables"] = f"""WITH {TAB_NODES}
SELECT CAST(doc_id AS BIGINT) AS doc_id, table_node_id, CAST(table_page AS INTEGER) AS table_page,
       CAST(count(row) AS INTEGER) AS row_count, CAST(coalesce(max(len(cs)), 0) AS INTEGER) AS col_count,
       FALSE AS has_anchor
FROM tgrid GROUP BY doc_id, table_node_id, table_page"""

ORACLE["table_summary"] = f"""WITH {CONV_NODES}, {TAB_NODES}
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, CAST(0 AS BIGINT) AS table_count, d.page_count AS pages_processed,
       'conversations' AS corpus
FROM conv_doc d
UNION ALL
SELECT CAST(td.doc_id AS BIGINT), CAST(1 AS BIGINT), 1, 'orders' FROM td"""

ORACLE["tables_csv"] = f"""WITH {TAB_NODES},
ords AS (
  SELECT doc_id, table_node_id, table_page,
         CAST(row_number() OVER (PARTITION BY doc_id ORDER BY table_pre) - 1 AS INTEGER) AS table_ord
  FROM (SELECT DISTINCT doc_id, table_node_id, table_page, table_pre FROM tgrid))
SELECT CAST(o.doc_id AS BIGINT) AS doc_id, o.table_ord, 0 AS line_no,
       concat(CASE WHEN o.table_ord > 0 THEN chr(10) ELSE '' END,
              concat('# Table ', o.table_ord + 1, ' (p', o.table_page, ')'), chr(13), chr(10)) AS line
FROM ords o
UNION ALL
SELECT CAST(g.doc_id AS BIGINT), o.table_ord, CAST(g.row + 1 AS INTEGER), {_csv_line('g.cs')}
FROM tgrid g JOIN ords o ON g.doc_id = o.doc_id AND g.table_node_id = o.table_node_id
WHERE g.row IS NOT NULL"""


# -- diff, redaction, document transforms ----------------------------------------------

def doc_nodes_1(src: str, prefix: str) -> str:
    """Heuristic nodes of one-page documents from a (doc_id, text) relation."""
    return f"""
{prefix}_pg AS (
  SELECT doc_id, 0 AS page_index, coalesce(text, '') AS page_text, {src_hash('text')} AS source_hash,
         1 AS page_count
  FROM {src}),""" + heuristic_nodes(f"{prefix}_pg", prefix)


def _redact_sql(x: str) -> tuple[str, str]:
    from quire.plans.base import REDACT_PATTERNS
    t = f"coalesce({x}, '')"
    counts = []
    for p in REDACT_PATTERNS:
        counts.append(f"len(regexp_extract_all({t}, '{p}'))")
        t = f"regexp_replace({t}, '{p}', '[REDACTED]', 'g')"
    return t, " + ".join(counts)


def _sig(x: str = "") -> str:
    return f"concat({x}page_index, ':', {x}node_type, ':', {chash(x + 'text_content')})"


def diff_sql(a: str, b: str) -> str:
    """CTE ``dd(pair, type, node_id, node_type, page_index, text_content, pre)``."""
    return f"""
da AS (SELECT *, {_sig()} AS sig FROM ({a})),
db AS (SELECT *, {_sig()} AS sig FROM ({b})),
fa AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair, sig ORDER BY pre) AS rn FROM da) WHERE rn = 1),
fb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair, sig ORDER BY pre) AS rn FROM db) WHERE rn = 1),
dd AS (
  SELECT pair, 'removed' AS type, node_id, node_type, page_index, text_content, pre FROM fa
  WHERE NOT EXISTS (SELECT 1 FROM fb WHERE fb.pair = fa.pair AND fb.sig = fa.sig)
  UNION ALL
  SELECT pair, 'added', node_id, node_type, page_index, text_content, pre FROM fb
  WHERE NOT EXISTS (SELECT 1 FROM fa WHERE fa.pair = fb.pair AND fa.sig = fb.sig))"""


DIFF_OUT = """SELECT CAST(pair AS BIGINT) AS pair, type, node_id, node_type, CAST(page_index AS INTEGER) AS page_index,
       nullif(left(coalesce(text_content, ''), 120), '') AS text_preview, CAST(pre AS INTEGER) AS pre FROM dd"""

CONV_DIFF = diff_sql("SELECT doc_id // 2 AS pair, * FROM conv_nodes WHERE doc_id % 2 = 0",
                     "SELECT doc_id // 2 AS pair, * FROM conv_nodes WHERE doc_id % 2 = 1")
_RED_TEXT, _RED_COUNT = _redact_sql("text")
RED_NODES = (doc_nodes_1("documents", "doc") + ",\nred_docs AS (SELECT doc_id, " + _RED_TEXT +
             " AS text FROM documents)," + doc_nodes_1("red_docs", "red"))

ORACLE["diff_pairs"] = f"WITH {CONV_NODES}, {CONV_DIFF}\n{DIFF_OUT}"

ORACLE["diff_summary"] = f"""WITH {CONV_NODES}, {CONV_DIFF},
pairs AS (
  SELECT coalesce(a.pair, b.pair) AS pair, coalesce(a.pc, 0) AS original_page_count,
         coalesce(b.pc, 0) AS modified_page_count
  FROM (SELECT doc_id // 2 AS pair, page_count AS pc FROM conv_doc WHERE doc_id % 2 = 0) a
  FULL OUTER JOIN (SELECT doc_id // 2 AS pair, page_count AS pc FROM conv_doc WHERE doc_id % 2 = 1) b
  ON a.pair = b.pair)
SELECT CAST(p.pair AS BIGINT) AS pair, CAST(coalesce(c.added, 0) AS BIGINT) AS added_node_count,
       CAST(coalesce(c.removed, 0) AS BIGINT) AS removed_node_count, CAST(0 AS BIGINT) AS changed_node_count,
       p.original_page_count, p.modified_page_count,
       p.original_page_count + p.modified_page_count AS pages_processed
FROM pairs p LEFT JOIN (
  SELECT pair, count(*) FILTER (WHERE type = 'added') AS added, count(*) FILTER (WHERE type = 'removed') AS removed
  FROM dd GROUP BY pair) c ON p.pair = c.pair"""

ORACLE["diff_redacted"] = (f"WITH {RED_NODES}, " +
                           diff_sql("SELECT doc_id AS pair, * FROM doc_nodes",
                                    "SELECT doc_id AS pair, * FROM red_nodes") + f"\n{DIFF_OUT}")

ORACLE["compare_text"] = f"""WITH {RED_NODES},
ba AS (SELECT doc_id AS pair, page_index, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY pre) - 1 AS pos,
              {chash('text_content')} AS h FROM doc_nodes WHERE length(text_content) > 0),
bb AS (SELECT doc_id AS pair, page_index, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY pre) - 1 AS pos,
              {chash('text_content')} AS h FROM red_nodes WHERE length(text_content) > 0),
j AS (SELECT coalesce(ba.pair, bb.pair) AS pair, ba.h AS ha, bb.h AS hb
      FROM ba FULL OUTER JOIN bb ON ba.pair = bb.pair AND ba.page_index = bb.page_index AND ba.pos = bb.pos)
SELECT CAST(d.doc_id AS BIGINT) AS pair, 1 AS original_page_count, 1 AS modified_page_count,
       CAST(coalesce(c.added, 0) AS BIGINT) AS added_text_count,
       CAST(coalesce(c.removed, 0) AS BIGINT) AS removed_text_count,
       CAST(coalesce(c.changed, 0) AS BIGINT) AS changed_text_count
FROM documents d LEFT JOIN (
  SELECT pair, count(*) FILTER (WHERE ha IS NULL) AS added, count(*) FILTER (WHERE hb IS NULL) AS removed,
         count(*) FILTER (WHERE ha <> hb) AS changed
  FROM j GROUP BY pair) c ON d.doc_id = c.pair"""

ORACLE["redact"] = f"""
SELECT CAST(doc_id AS BIGINT) AS doc_id, 0 AS page_index, TRUE AS in_range,
       CAST({_RED_COUNT} AS BIGINT) AS redaction_count, {_RED_TEXT} AS page_text
FROM documents"""

ORACLE["redact_summary"] = f"""WITH {doc_pages(8)}
SELECT CAST(doc_id AS BIGINT) AS doc_id,
       CAST(sum({_redact_sql('page_text')[1]}) AS BIGINT) AS redaction_count, count(*) AS pages_processed
FROM doc_pg GROUP BY doc_id"""

ORACLE["merge_docs"] = """
WITH pc AS (SELECT conv_id AS doc_id, count(*) AS page_count FROM conversations GROUP BY conv_id),
g AS (SELECT doc_id, doc_id // 4 AS group_id, doc_id % 4 AS ord, page_count FROM pc),
o AS (SELECT *, coalesce(sum(page_count) OVER (PARTITION BY group_id ORDER BY ord
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
             sum(page_count) OVER (PARTITION BY group_id) AS gpc FROM g)
SELECT CAST(o.group_id AS BIGINT) AS group_id, CAST(o.ord AS BIGINT) AS ord, CAST(c.conv_id AS BIGINT) AS doc_id,
       CAST(c.turn AS INTEGER) AS page_index, CAST(o.off + c.turn AS BIGINT) AS merged_page_index,
       CAST(o.gpc AS BIGINT) AS group_page_count
FROM conversations c JOIN o ON c.conv_id = o.doc_id"""

ORACLE["split_doc"] = """
WITH p AS (
  SELECT conv_id AS doc_id, CAST(turn AS INTEGER) AS page_index,
         CASE WHEN turn >= 2 THEN 1 ELSE 0 END AS base,
         (turn - CASE WHEN turn >= 2 THEN 2 ELSE 0 END) // 2 AS sub
  FROM conversations),
c AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY doc_id ORDER BY base, sub) - 1 AS INTEGER) AS chunk_index FROM p)
SELECT CAST(doc_id AS BIGINT) AS doc_id, page_index, chunk_index,
       CAST(count(*) OVER (PARTITION BY doc_id, chunk_index) AS INTEGER) AS chunk_page_count
FROM c"""

ORACLE["doc_fingerprint"] = f"""WITH RECURSIVE {HTML_NODES}
SELECT CAST(doc_id AS BIGINT) AS doc_id,
       sha256(concat_ws(':', CAST(count(*) AS VARCHAR), CAST(bit_xor(h) AS VARCHAR),
                        CAST(CAST(sum(CAST(h AS HUGEINT)) AS DECIMAL(38, 0)) AS VARCHAR))) AS fingerprint,
       count(*) AS n_nodes
FROM (SELECT doc_id, CAST(('0x' || left({chash("concat_ws(':', pre, depth, node_type, page_index, coalesce(text_content, ''))")}, 15)) AS BIGINT) AS h FROM html_nodes)
GROUP BY doc_id"""


# -- audits and validation ------------------------------------------------------------

def _accessibility_sql(cte: str) -> str:
    from quire.operators.audit import ACCESSIBILITY_RULES
    sev = "CASE rule_id " + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in ACCESSIBILITY_RULES.items()) + " END"
    desc = "CASE rule_id " + " ".join(f"WHEN '{k}' THEN '{v[1]}'" for k, v in ACCESSIBILITY_RULES.items()) + " END"
    wcag = "CASE rule_id " + " ".join(f"WHEN '{k}' THEN '{v[2]}'" for k, v in ACCESSIBILITY_RULES.items()) + " END"
    return f"""
hd AS (SELECT *, lag(coalesce(level, 1)) OVER (PARTITION BY doc_id ORDER BY pre) AS prev
       FROM {cte} WHERE node_type = 'heading'),
fnd0 AS (
  SELECT doc_id, 'heading-level-skip' AS rule_id, page_index, node_id FROM hd
  WHERE coalesce(level, 1) > coalesce(prev, 0) + 1
  UNION ALL
  SELECT doc_id, 'empty-heading', page_index, node_id FROM {cte}
  WHERE node_type = 'heading' AND (text_content IS NULL OR length(text_content) = 0)
  UNION ALL
  SELECT doc_id, 'figure-no-text', page_index, node_id FROM {cte}
  WHERE node_type = 'figure' AND (text_content IS NULL OR length(text_content) = 0)
  UNION ALL
  SELECT doc_id, 'no-headings', NULL, NULL FROM (
    SELECT doc_id, count(*) FILTER (WHERE node_type = 'heading') AS h FROM {cte} GROUP BY doc_id) WHERE h = 0
  UNION ALL
  SELECT t.doc_id, 'table-no-rows', t.page_index, t.node_id FROM {cte} t WHERE t.node_type = 'table' AND NOT EXISTS (
    SELECT 1 FROM {cte} r WHERE r.doc_id = t.doc_id AND r.parent_id = t.node_id AND r.node_type = 'table_row')
  UNION ALL
  SELECT t.doc_id, 'list-no-items', t.page_index, t.node_id FROM {cte} t WHERE t.node_type = 'list' AND NOT EXISTS (
    SELECT 1 FROM {cte} r WHERE r.doc_id = t.doc_id AND r.parent_id = t.node_id AND r.node_type = 'list_item')),
fnd AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, rule_id, {sev} AS severity, CAST(page_index AS INTEGER) AS page_index,
         node_id, {desc} AS description, {wcag} AS wcag_criteria
  FROM fnd0)"""


ORACLE["check_accessibility"] = f"WITH RECURSIVE {HTML_NODES}, {_accessibility_sql('html_nodes')}\nSELECT * FROM fnd"
ORACLE["check_accessibility_tables"] = f"WITH {TAB_NODES}, {_accessibility_sql('tab_nodes')}\nSELECT * FROM fnd"


def _compliance_sql() -> str:
    from quire.operators.audit import STANDARD_RULES
    wanted = ["PDF/UA-1", "PDF/A-3b"]
    std = ", ".join(f"('{s}', '{r}')" for s in wanted for r in STANDARD_RULES[s])
    req = ", ".join(f"('{s}')" for s in wanted)
    return f"""WITH {TAB_NODES}, {_accessibility_sql('tab_nodes')},
std AS (SELECT * FROM (VALUES {std}) t(standard, rule_id)),
req AS (SELECT * FROM (VALUES {req}) t(standard)),
v AS (SELECT doc_id, standard, count(*) AS n FROM fnd JOIN std ON fnd.rule_id = std.rule_id
      GROUP BY doc_id, standard)
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, r.standard, CAST(coalesce(v.n, 0) AS BIGINT) AS violation_count,
       coalesce(v.n, 0) = 0 AS passed, 1 AS pages_processed
FROM td d CROSS JOIN req r LEFT JOIN v ON v.doc_id = d.doc_id AND v.standard = r.standard"""


ORACLE["compliance_check"] = _compliance_sql()


def _forensic_sql() -> tuple[str, str]:
    from quire.operators.audit import FORENSIC_CHECKS
    counts = ", ".join(f"len(regexp_extract_all(coalesce(html, ''), '{p}')) AS n_{i}"
                       for i, (p, _, _) in enumerate(FORENSIC_CHECKS.values()))
    risk = " + ".join(f"CASE WHEN n_{i} > 0 THEN {float(w)} ELSE 0.0 END"
                      for i, (_, _, w) in enumerate(FORENSIC_CHECKS.values()))
    nf = " + ".join(f"CASE WHEN n_{i} > 0 THEN 1 ELSE 0 END" for i in range(len(FORENSIC_CHECKS)))
    base = f"fc AS (SELECT page_id AS doc_id, {counts} FROM pages)"
    rows = " UNION ALL ".join(
        f"SELECT doc_id, '{c}' AS category, '{sev}' AS severity, CAST(n_{i} AS BIGINT) AS evidence_count, "
        f"CAST(least(1.0, {risk}) AS DOUBLE) AS risk_score FROM fc WHERE n_{i} > 0"
        for i, (c, (_, sev, _)) in enumerate(FORENSIC_CHECKS.items()))
    scan = f"WITH {base}\nSELECT CAST(doc_id AS BIGINT) AS doc_id, category, severity, evidence_count, risk_score FROM ({rows})"
    per_doc = (f"WITH {base}\nSELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(least(1.0, {risk}) AS DOUBLE) AS risk_score, "
               f"CAST({nf} AS INTEGER) AS finding_count FROM fc")
    return scan, per_doc


ORACLE["forensic_scan"], ORACLE["forensic_risk"] = _forensic_sql()


def _validate_sql() -> str:
    from quire.functions.tags import NODE_TYPES
    types = ", ".join(f"'{t}'" for t in NODE_TYPES)
    return f"""WITH {CONV_NODES},
f AS (
  SELECT doc_id,
         CASE WHEN doc_id % 10 = 7 AND pre = 2 THEN parent_id ELSE node_id END AS node_id,
         CASE WHEN doc_id % 10 = 9 AND pre = 2 THEN 'ast:missing'
              WHEN doc_id % 10 = 4 AND pre = 1 THEN NULL ELSE parent_id END AS parent_id,
         pre,
         CASE WHEN doc_id % 10 = 2 AND pre = 3 THEN -1 ELSE depth END AS depth,
         CASE WHEN doc_id % 10 = 5 AND pre = 2 THEN 'chapter' ELSE node_type END AS node_type,
         CASE WHEN doc_id % 10 = 3 AND pre = 1 THEN -1 ELSE page_index END AS page_index,
         (doc_id % 10 = 1 AND pre = 0) AS bad_bbox
  FROM conv_nodes),
c AS (
  SELECT f.*, count(*) OVER (PARTITION BY doc_id, node_id) AS dup,
         sum(CASE WHEN parent_id IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS roots,
         parent_id IS NOT NULL AND NOT EXISTS (
           SELECT 1 FROM f g WHERE g.doc_id = f.doc_id AND g.node_id = f.parent_id) AS dangling
  FROM f),
v AS (
  SELECT doc_id, node_id, pre, array_to_string(list_sort(list_filter([
    CASE WHEN node_type NOT IN ({types}) THEN 'node-type' END,
    CASE WHEN page_index < 0 THEN 'page-index' END,
    CASE WHEN depth < 0 THEN 'depth' END,
    CASE WHEN bad_bbox THEN 'bbox-range' END,
    CASE WHEN dup > 1 THEN 'duplicate-id' END,
    CASE WHEN dangling THEN 'parent-missing' END,
    CASE WHEN parent_id IS NULL AND roots > 1 THEN 'multiple-roots' END], lambda x: x IS NOT NULL)), ',')
    AS violations
  FROM c)
SELECT CAST(doc_id AS BIGINT) AS doc_id, node_id, CAST(pre AS INTEGER) AS pre, violations FROM v
WHERE violations <> ''"""


ORACLE["validate_nodes"] = _validate_sql()

ORACLE["stream_cited_text"] = f"WITH {DOC_NODES_1}\n{cited('doc_nodes')}"
ORACLE["stream_dedupe"] = f"SELECT DISTINCT {src_hash('text')} AS source_hash, sha256(coalesce(text, '')) AS full_hash FROM documents"


ORACLE["require_tagged"] = f"""WITH RECURSIVE {CONV_NODES}, {HTML_NODES}
SELECT CAST(doc_id AS BIGINT) AS doc_id, 'conversations' AS corpus, TRUE AS is_heuristic, 'rejected' AS status,
       'ast/no-struct-tree' AS reason FROM conv_doc
UNION ALL
SELECT CAST(doc_id AS BIGINT), 'pages', FALSE, 'ok', CAST(NULL AS VARCHAR) FROM hp"""

ORACLE["cited_text_min_confidence"] = f"""WITH RECURSIVE {CONV_NODES}, {HTML_NODES},
b AS (
  SELECT 'conversations' AS corpus, doc_id, pre, node_id, 0.5 AS confidence FROM conv_nodes
  WHERE length(text_content) > 0
  UNION ALL
  SELECT 'pages', doc_id, pre, node_id, 1.0 FROM html_nodes WHERE length(text_content) > 0)
SELECT corpus, CAST(doc_id AS BIGINT) AS doc_id, CAST(pre AS INTEGER) AS pre, node_id,
       CAST(confidence AS DOUBLE) AS confidence,
       CASE WHEN confidence >= 0.75 THEN 'kept' ELSE 'low_confidence' END AS output
FROM b"""

ORACLE["search_corpus"] = f"""WITH {DOC_NODES_1},
m AS (SELECT * FROM doc_nodes WHERE node_type = 'paragraph' AND length(text_content) > 0
      AND contains(lower(text_content), 'the'))
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(pre AS INTEGER) AS pre, node_id, node_type,
       CAST(page_index AS INTEGER) AS page_index, text_content, CAST(level AS INTEGER) AS level, struct_type,
       heuristic, CAST(children_count AS INTEGER) AS children_count,
       (SELECT count(*) FROM m) AS total_matches, (SELECT count(*) FROM m) > 10 AS truncated
FROM m ORDER BY doc_id, pre LIMIT 10"""


# -- structure trees ------------------------------------------------------------------
# Orders as element trees: the preorder numbers follow from the line counts.

WALK_NODES = """
wl AS (
  SELECT l_orderkey AS doc_id, l_partkey, l_returnflag, l_linestatus,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r
  FROM lineitem),
wd AS (
  SELECT o_orderkey AS doc_id, left(sha256(encode(concat('order:', o_orderkey))), 6) AS h, o_orderkey % 7 = 0 AS two,
         coalesce(n, 0) AS n, (coalesce(n, 0) + 1) // 2 AS n_odd
  FROM orders LEFT JOIN (SELECT doc_id AS k, count(*) AS n FROM wl GROUP BY doc_id) ON k = o_orderkey),
wr AS (
  SELECT wd.*, wl.r, wl.l_returnflag, wl.l_linestatus,
         CASE l_partkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS page,
         CASE WHEN NOT two THEN 2 * r - 1 WHEN r % 2 = 1 THEN r ELSE 2 * n_odd + r END AS seq,
         CASE WHEN two AND r % 2 = 0 THEN 2 * n_odd + 1 ELSE 0 END AS root_seq,
         CASE WHEN two THEN (r - 1) // 2 ELSE r - 1 END AS line_pos,
         ['/P', '/Span', '/Note', '/LI', '/H2'][((r - 1) % 5) + 1] AS tag
  FROM wd JOIN wl ON wd.doc_id = wl.doc_id),
walk_nodes AS (
  SELECT doc_id, concat('ast:', h, ':0:', CASE WHEN two THEN 2 * n + 2 ELSE 0 END) AS node_id, CAST(NULL AS VARCHAR) AS parent_id,
         0 AS pre, CASE WHEN two THEN 2 * n + 2 ELSE 2 * n END AS last, 0 AS depth, 0 AS child_pos, 'document' AS node_type,
         0 AS page_index, CAST(NULL AS VARCHAR) AS text_content, CAST(NULL AS INTEGER) AS level,
         CASE WHEN two THEN NULL ELSE '/Document' END AS struct_type, FALSE AS heuristic, CAST(NULL AS INTEGER) AS mcid,
         CASE WHEN two THEN 2 ELSE n END AS children_count
  FROM wd
  UNION ALL
  SELECT doc_id, concat('ast:', h, ':0:0'), concat('ast:', h, ':0:', 2 * n + 2), 1, 1 + 2 * n_odd, 1, 0, 'section', 0, NULL, NULL,
         '/Sect', FALSE, NULL, n_odd FROM wd WHERE two
  UNION ALL
  SELECT doc_id, concat('ast:', h, ':0:', 2 * n_odd + 1), concat('ast:', h, ':0:', 2 * n + 2), 2 * n_odd + 2, 2 * n + 2, 1, 1,
         'section', 0, NULL, NULL, '/Sect', FALSE, NULL, n - n_odd FROM wd WHERE two
  UNION ALL
  SELECT doc_id, concat('ast:', h, ':', page, ':', seq), concat('ast:', h, ':0:', root_seq), seq + two::INT, seq + 1 + two::INT,
         1 + two::INT, line_pos,
         CASE tag WHEN '/H2' THEN 'heading' WHEN '/P' THEN 'paragraph' WHEN '/LI' THEN 'list_item' ELSE 'artifact' END,
         page, NULL, CASE WHEN tag = '/H2' THEN 2 END, tag, FALSE, NULL, 1 FROM wr
  UNION ALL
  SELECT doc_id, concat('ast:', h, ':', page, ':', seq + 1), concat('ast:', h, ':', page, ':', seq), seq + 1 + two::INT,
         seq + 1 + two::INT, 2 + two::INT, 0, 'paragraph', page, concat(l_returnflag, ' ', l_linestatus), NULL, '/P', FALSE,
         CASE WHEN r % 3 <> 0 THEN CAST(r AS INTEGER) END, 0 FROM wr)"""

ORACLE["tagged_walk"] = f"WITH {WALK_NODES}\n{node_select('walk_nodes')}"
ORACLE["page_level_text"] = f"""WITH {WALK_NODES}
SELECT CAST(doc_id AS BIGINT) AS doc_id, node_id, page_index, concat('page ', page_index, ' of ', doc_id) AS text_content
FROM walk_nodes WHERE children_count = 0"""
ORACLE["route_mixed"] = f"""WITH {CONV_PAGES},{heuristic_nodes('conv_pg', 'conv', 1, 2)},{WALK_NODES}
SELECT CASE WHEN heuristic THEN 0.5 ELSE 1.0 END AS confidence, node_type, page_index, count(*) AS n_nodes, count(mcid) AS n_mcid
FROM (SELECT heuristic, node_type, page_index, mcid FROM conv_nodes UNION ALL
      SELECT heuristic, node_type, page_index, mcid FROM walk_nodes) GROUP BY ALL"""

ORACLE["ast_json_headers"] = f"""WITH RECURSIVE {HTML_NODES}
SELECT CAST(doc_id AS BIGINT) AS doc_id, CASE WHEN doc_id % 10 <> 0 THEN '1.0' END AS schema_version,
       CASE WHEN doc_id % 10 <> 0 THEN source_hash END AS source_hash,
       CASE WHEN doc_id % 10 <> 0 THEN 1 END AS page_count, CASE WHEN doc_id % 10 = 0 THEN 'json' END AS reason
FROM hp"""

ORACLE["ast_json_roundtrip_html"] = f"""WITH RECURSIVE {HTML_NODES}
SELECT n.*, CAST(p.pre AS INTEGER) AS parent_pre FROM ({node_select('html_nodes')}) n
LEFT JOIN html_nodes p ON p.doc_id = n.doc_id AND p.node_id = n.parent_id"""

ORACLE["document_info_html"] = f"""WITH RECURSIVE {HTML_NODES}
SELECT CAST(n.doc_id AS BIGINT) AS doc_id, '1.0' AS schema_version, any_value(hp.source_hash) AS source_hash, 1 AS page_count,
       CAST(sum({tokens('text_content')}) AS BIGINT) AS estimated_tokens, 'document' AS root_node_type,
       CAST(max(children_count) FILTER (WHERE pre = 0) AS INTEGER) AS root_children_count
FROM html_nodes n JOIN hp ON hp.doc_id = n.doc_id GROUP BY n.doc_id"""

ORACLE["table_summary_html"] = f"""WITH RECURSIVE {HTML_NODES}
SELECT CAST(doc_id AS BIGINT) AS doc_id, count(*) FILTER (WHERE node_type = 'table') AS table_count, 1 AS pages_processed
FROM html_nodes GROUP BY doc_id"""


def _frame_sql(name: str, keys: str, rows: str, heads: list[str]) -> str:
    """Nodes of one table per key with a header row; ``rows`` gives doc_id, r and a list of cells."""
    n = len(heads)
    w = n + 1
    return f"""
{name}_k AS (SELECT k.doc_id, sha256(encode('{name}:' || k.doc_id)[1:4096]) AS h, count(r.doc_id) AS n
             FROM ({keys}) k LEFT JOIN ({rows}) r ON r.doc_id = k.doc_id GROUP BY k.doc_id),
{name}_r AS (SELECT doc_id, 0 AS rn, {heads!r} AS cells, '/TH' AS tag FROM {name}_k
             UNION ALL SELECT doc_id, r + 1, cells, '/TD' FROM ({rows})),
{name}_n AS (
  SELECT doc_id, 0 AS pre, (n + 1) * {w} + 1 AS last, NULL AS up, 0 AS depth, 0 AS child_pos, 'document' AS node_type, NULL AS text_content,
         '/Document' AS struct_type, 1 AS children_count FROM {name}_k
  UNION ALL SELECT doc_id, 1, (n + 1) * {w} + 1, 0, 1, 0, 'table', NULL, '/Table', n + 1 FROM {name}_k
  UNION ALL SELECT doc_id, rn * {w} + 2, rn * {w} + 1 + {w}, 1, 2, rn, 'table_row', NULL, '/TR', {n} FROM {name}_r
  UNION ALL SELECT doc_id, rn * {w} + 3 + c, rn * {w} + 3 + c, rn * {w} + 2, 3, c, 'table_cell', t, tag, 0
            FROM (SELECT *, unnest(cells) AS t, generate_subscripts(cells, 1) - 1 AS c FROM {name}_r)),
{name}_nodes AS (
  SELECT n.doc_id, concat('ast:', left(h, 6), ':0:', pre) AS node_id, CASE WHEN up IS NOT NULL THEN concat('ast:', left(h, 6), ':0:', up) END AS parent_id,
         pre, last, depth, child_pos, node_type, 0 AS page_index, text_content, CAST(NULL AS INTEGER) AS level, struct_type, FALSE AS heuristic,
         CAST(NULL AS INTEGER) AS mcid, children_count
  FROM {name}_n n JOIN {name}_k k ON k.doc_id = n.doc_id)"""


ORACLE["table_nodes_headers"] = "WITH " + _frame_sql(
    "region", "SELECT r_regionkey AS doc_id FROM region",
    "SELECT n_regionkey AS doc_id, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS r, [CAST(n_nationkey AS VARCHAR), n_name] AS cells FROM nation",
    ["n_nationkey", "n_name"]) + "," + _frame_sql(
    "nation", "SELECT n_nationkey AS doc_id FROM nation",
    "SELECT s_nationkey AS doc_id, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS r, [CAST(s_suppkey AS VARCHAR), s_name] AS cells FROM supplier",
    ["s_suppkey", "s_name"]) + f"""
SELECT *, 'region' AS corpus FROM ({node_select('region_nodes')}) UNION ALL SELECT *, 'nation' FROM ({node_select('nation_nodes')})"""

ORACLE["cited_tables_page_range"] = """
SELECT CAST(l_orderkey AS BIGINT) AS doc_id, concat('ast:', left(sha256(encode(concat('order:', l_orderkey))[1:4096]), 6), ':', r // 2, ':', 4 * r + 1) AS table_node_id,
       CAST(r // 2 AS INTEGER) AS table_page, 1 AS row_count, 2 AS col_count, FALSE AS has_anchor
FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS r FROM lineitem)
WHERE r >= 2"""

ORACLE["load_files"] = f"""
SELECT doc_id // 64 AS bucket, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS n_bytes,
       sha256(string_agg(coalesce(text, '') || {NL}, '' ORDER BY doc_id)) AS sha256
FROM documents GROUP BY doc_id // 64"""

_EVIDENCE = [("javascript", "high", r"(?i)<script[\s>]|javascript:"), ("embedded_files", "high", r"(?i)<(?:iframe|object|embed)[\s>]")]
ORACLE["forensic_evidence"] = "WITH " + ", ".join(f"""e{k} AS (
  SELECT page_id, '{c}' AS category, '{sev}' AS severity, regexp_extract_all(coalesce(html, ''), '{p}') AS hits,
         string_split_regex(coalesce(html, ''), '{p}') AS gaps FROM pages)""" for k, (c, sev, p) in enumerate(_EVIDENCE)) + """,
m AS (
  SELECT page_id, category, severity, hits, gaps, unnest(range(len(hits))) AS i
  FROM (SELECT * FROM e0 UNION ALL SELECT * FROM e1)),
s AS (
  SELECT *, sum(length(gaps[i + 1])) OVER w + coalesce(sum(length(hits[i + 1])) OVER (PARTITION BY page_id, category ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM m WINDOW w AS (PARTITION BY page_id, category ORDER BY i))
SELECT concat(page_id, ':', category) AS finding_id, CAST(page_id AS BIGINT) AS doc_id, category, severity, CAST(i AS INTEGER) AS match_no,
       CAST(off AS INTEGER) AS start, CAST(off + length(hits[i + 1]) AS INTEGER) AS stop, concat(hits[i + 1], left(coalesce(gaps[i + 2], ''), 40)) AS snippet
FROM s"""

# -- responses, sinks and validation with faults ----------------------------------------

ORACLE["cited_tables_nested"] = f"""WITH {TAB_NODES}
SELECT CAST(doc_id AS BIGINT) AS doc_id, table_node_id, CAST(count(*) OVER (PARTITION BY doc_id, table_node_id) // len(cs) AS INTEGER) AS row_count,
       CAST(len(cs) AS INTEGER) AS col_count, CAST(NULL AS VARCHAR) AS anchor, CAST(row AS INTEGER) AS row, CAST(c AS INTEGER) AS col,
       1 AS row_span, 1 AS col_span, t AS text, CAST(1.0 AS DOUBLE) AS confidence
FROM (SELECT *, unnest(cs) AS t, generate_subscripts(cs, 1) - 1 AS c FROM tgrid WHERE row IS NOT NULL)"""

ORACLE["extract_text"] = f"""
SELECT conv_id AS doc_id, coalesce(string_agg(coalesce(text, ''), {NL} ORDER BY turn) FILTER (WHERE turn = 1), '') AS text,
       CAST(count(*) AS INTEGER) AS page_count, CAST(count(*) FILTER (WHERE turn = 1) AS INTEGER) AS pages_processed
FROM conversations GROUP BY conv_id"""

_FAULTS = """faulty AS (
  SELECT * REPLACE (
    CASE WHEN doc_id % 10 = 1 AND node_type = 'heading' THEN 5 ELSE level END AS level,
    CASE WHEN (doc_id % 10 = 2 AND node_type = 'heading') OR (doc_id % 10 = 3 AND pre = 2) THEN NULL ELSE text_content END AS text_content,
    CASE WHEN doc_id % 10 = 3 AND pre = 2 THEN 'figure' WHEN doc_id % 10 = 6 AND pre = 2 THEN 'table'
         WHEN doc_id % 10 = 4 AND node_type = 'heading' THEN 'paragraph'
         WHEN doc_id % 10 = 5 AND node_type = 'list_item' THEN 'paragraph' ELSE node_type END AS node_type)
  FROM html_nodes)"""
_FOUND = f"WITH RECURSIVE {HTML_NODES}, {_FAULTS}, {_accessibility_sql('faulty')}"
ORACLE["check_accessibility_faults"] = f"{_FOUND}\nSELECT * FROM fnd"
ORACLE["accessibility_response"] = f"""{_FOUND}
SELECT page_id AS doc_id, 'PDF/UA-1' AS conformance_target, coalesce(n, 0) AS issue_count, coalesce(n, 0) = 0 AS passed
FROM pages LEFT JOIN (SELECT doc_id, count(*) AS n FROM fnd GROUP BY doc_id) f ON f.doc_id = page_id"""
ORACLE["compliance_violations"] = f"""{_FOUND}
SELECT doc_id, standard, rule_id, severity, page_index, node_id, description
FROM fnd JOIN (VALUES ('PDF/A-3b', 'figure-no-text'), ('PDF/A-3b', 'table-no-rows'), ('WCAG-2.1-AA', 'heading-level-skip'),
  ('WCAG-2.1-AA', 'empty-heading'), ('WCAG-2.1-AA', 'figure-no-text'), ('WCAG-2.1-AA', 'list-no-items')) s(standard, rule) ON rule = rule_id"""
ORACLE["forensic_report"] = f"""
SELECT concat(doc_id, ':', category) AS finding_id, doc_id, category, severity,
       concat(evidence_count, ' markers of ', category) AS description, CAST(evidence_count AS VARCHAR) AS evidence,
       'javascript,embedded_files,metadata' AS checks, risk_score
FROM ({ORACLE["forensic_scan"]})"""
ORACLE["validate_blocks"] = f"""WITH {CONV_NODES}
SELECT CAST(doc_id AS BIGINT) AS doc_id, node_id,
       ['confidence-range', 'page-index', 'depth', 'bbox-range'][doc_id % 10] AS violations
FROM conv_nodes WHERE length(text_content) > 0 AND doc_id % 10 BETWEEN 1 AND 4"""
ORACLE["validate_docs"] = """
SELECT DISTINCT conv_id AS doc_id, CASE WHEN conv_id % 10 = 0 THEN 'page-count' ELSE '' END AS violations FROM conversations"""
ORACLE["sink_json_files"] = ORACLE["cited_text"]
ORACLE["sink_text_files"] = f"SELECT text AS value, count(*) AS n FROM ({ORACLE['paragraphs']}) GROUP BY text"
ORACLE["stream_dedupe_watermark"] = ORACLE["stream_dedupe"]
