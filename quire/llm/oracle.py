"""DuckDB SQL twins of the queries that SQL can express."""

from __future__ import annotations

from quire.llm.licenses import TEMPLATES, TEXTS

ORACLE: dict[str, str] = {}

# op10: every 35-word window as a string, counted over all documents.
ORACLE["op10_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT rid, s, array_to_string(w[s:s + 34], ' ') AS t
  FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS s FROM d)),
rep AS (
  SELECT rid, s FROM (SELECT rid, s, count(*) OVER (PARTITION BY t) AS n FROM win) WHERE n > 1),
gone AS (
  SELECT DISTINCT rid, unnest(range(s, s + 35)) AS pos FROM rep),
words AS (
  SELECT rid, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d),
kept AS (
  SELECT words.rid, count(*) AS n, string_agg(word, ' ' ORDER BY words.pos) AS t
  FROM words LEFT JOIN gone ON words.rid = gone.rid AND words.pos = gone.pos
  WHERE gone.rid IS NULL GROUP BY words.rid)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.rid = kept.rid
"""

# op8: digests of the whole payloads, the smallest page of equal ones, and the
# place of every capture by (URL key, time, page); time follows the page id.
ORACLE["op8_warc"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, lower(regexp_replace(coalesce(url, ''), '#.*$', '', 's')) AS u FROM pages),
k AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest, u,
         regexp_replace(regexp_extract(u, '^[a-z][a-z0-9+.-]*://([^/?:]*)', 1), '^www\.', '') AS host,
         regexp_replace(u, '^[a-z][a-z0-9+.-]*://[^/?]*', '') AS rest
  FROM p),
f AS (
  SELECT *, CASE WHEN host = '' THEN u ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || rest END AS url_key,
         CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS first
  FROM k)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, url_key,
       row_number() OVER (ORDER BY encode(url_key), page_id) AS position, false AS damaged
FROM f
"""

# op5: every turn quotes the whole of the turn before; the message replied to is the
# latest earlier turn of the conversation with the same lines.
ORACLE["op5_quotation_linking"] = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, trim(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(13)) AS body FROM conversations),
l AS (
  SELECT conv_id, turn, role, body, list_filter(list_transform(string_split(body, chr(10)),
         lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))), lambda x: x <> '') AS lines FROM m),
q AS (
  SELECT m.conv_id, m.turn, p.lines, pp.lines AS lines2
  FROM m JOIN l p ON p.conv_id = m.conv_id AND p.turn = m.turn - 1
  LEFT JOIN l pp ON pp.conv_id = m.conv_id AND pp.turn = m.turn - 2),
near AS (
  SELECT q.conv_id, q.turn, max(l.turn) AS origin FROM q JOIN l ON l.conv_id = q.conv_id AND l.lines = q.lines AND l.turn < q.turn
  WHERE len(q.lines) > 0 GROUP BY q.conv_id, q.turn),
par AS (
  SELECT m.conv_id, m.turn, m.role, m.body, near.origin AS parent_turn,
         CASE WHEN near.origin IS NULL THEN NULL ELSE m.conv_id END AS parent_conv,
         CASE WHEN near.origin IS NULL THEN NULL ELSE 1.0 END AS share,
         CAST(CASE WHEN len(q.lines) > 0 THEN 1 + CASE WHEN len(q.lines2) > 0 THEN 1 ELSE 0 END ELSE 0 END AS INT) AS n_quotes
  FROM m LEFT JOIN q ON q.conv_id = m.conv_id AND q.turn = m.turn
  LEFT JOIN near ON near.conv_id = m.conv_id AND near.turn = m.turn),
tree AS (
  SELECT conv_id, turn, conv_id AS thread_conv, turn AS thread_turn, CAST(0 AS BIGINT) AS depth FROM par WHERE parent_turn IS NULL
  UNION ALL
  SELECT par.conv_id, par.turn, tree.thread_conv, tree.thread_turn, tree.depth + 1
  FROM par JOIN tree ON par.parent_conv = tree.conv_id AND par.parent_turn = tree.turn)
SELECT par.conv_id, par.turn, par.role, par.body, coalesce(par.n_quotes, 0) AS n_quotes, par.parent_conv, par.parent_turn, par.share,
       tree.thread_conv, tree.thread_turn, tree.depth,
       row_number() OVER (PARTITION BY tree.thread_conv, tree.thread_turn ORDER BY tree.depth, par.conv_id, par.turn) AS reply_no
FROM par JOIN tree ON par.conv_id = tree.conv_id AND par.turn = tree.turn
"""

# op9: every span of a notice's length, and whole licence files, against the templates, then the
# nearest directory above with a licence file.  The templates are the operator's input.
_TEMPLATES = ", ".join(f"({k}, {k >= len(TEMPLATES)}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES + TEXTS))
_STOP = "('a','an','and','any','are','as','at','be','by','for','in','is','it','may','not','of','on','or','the','this','to','under','with','you')"
_TERMS = r"""regexp_extract_all(regexp_replace(lower({}), '(spdx-license-identifier:)[\x20\t]+', '\1', 'g'),
  'spdx-license-identifier:[a-z0-9]+(?:[.+-][a-z0-9]+)*|[a-z0-9]+(?:[.+-][a-z0-9]+)*')"""
ORACLE["op9_license_scan"] = rf"""
WITH t(template, is_text, licence, body) AS (VALUES {_TEMPLATES}),
tt AS (SELECT template, is_text, licence, unnest({_TERMS.format('body')}) AS term FROM t),
tf AS (SELECT template, is_text, licence, term, count(*) AS tf FROM tt WHERE term NOT IN {_STOP} GROUP BY ALL),
idf AS (SELECT term, ln(((SELECT count(*) FROM t) + 1) / (count(DISTINCT template) + 1)) + 1 AS idf FROM tf GROUP BY term),
other AS (SELECT ln(count(*) + 1) + 1 AS idf FROM t),
tw AS (SELECT template, is_text, licence, term, tf, (1 + ln(tf)) * idf AS w FROM tf JOIN idf USING (term)),
tn AS (SELECT template, sqrt(sum(w * w)) AS norm, CAST(sum(tf) AS BIGINT) AS size, least(2, count(*)) AS least_shared FROM tw GROUP BY template),
post AS (SELECT template, is_text, licence, term, size, least_shared, w / norm AS weight FROM tw JOIN tn USING (template)),
f AS (
  SELECT doc_id, text, CASE WHEN doc_id % 48 = 0 THEN source || '/LICENSE-' || doc_id
    WHEN doc_id % 48 = 16 THEN source || '/' || lang || '/LICENSE-' || doc_id
    WHEN doc_id % 48 = 32 THEN source || '/' || lang || '/' || doc_id // 256 || '/LICENSE-' || doc_id
    ELSE source || '/' || lang || '/' || doc_id // 256 || '/' || doc_id || '.txt' END AS path FROM documents),
raw AS (SELECT doc_id, path, unnest(l) AS term, unnest(range(len(l))) AS place FROM (SELECT doc_id, path, {_TERMS.format('text')} AS l FROM f)),
tok AS (
  SELECT doc_id, path, term, row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS p, count(*) OVER (PARTITION BY doc_id) AS total
  FROM raw WHERE term NOT IN {_STOP}),
near AS (
  SELECT doc_id, template, total, size, term, least_shared, unnest(range(greatest(p - size + 1, 0), p + 1)) AS unit
  FROM tok JOIN post USING (term) WHERE NOT is_text),
u AS (
  SELECT doc_id, template, unit, size FROM near WHERE unit + size <= total OR unit = 0
  GROUP BY doc_id, template, unit, size, least_shared HAVING count(DISTINCT term) >= least_shared),
ut AS (
  SELECT u.doc_id, path, template, unit, term FROM u JOIN tok ON tok.doc_id = u.doc_id AND p >= unit AND p < unit + size
  UNION ALL SELECT doc_id, path, template, -1, term FROM tok, (SELECT DISTINCT template FROM post WHERE is_text) WHERE doc_id % 16 = 0),
uf AS (SELECT doc_id, path, template, unit, term, count(*) AS tf FROM ut GROUP BY ALL),
uw AS (SELECT doc_id, path, template, unit, term, (1 + ln(tf)) * coalesce(idf.idf, (SELECT idf FROM other)) AS w FROM uf LEFT JOIN idf USING (term)),
s AS (
  SELECT doc_id, path, unit, max(t.licence) AS licence, round(sum(w * coalesce(weight, 0)) / sqrt(sum(w * w)), 9) AS score
  FROM uw LEFT JOIN post USING (template, term) JOIN t USING (template)
  GROUP BY doc_id, path, unit, template HAVING round(sum(w * coalesce(weight, 0)) / sqrt(sum(w * w)), 9) >= 0.6),
own AS (
  SELECT doc_id, path, arg_min(licence, (-score, licence)) AS licence, max(score) AS score, count(DISTINCT unit) AS n_units
  FROM s GROUP BY ALL),
grants AS (
  SELECT regexp_replace(path, '/[^/]*$', '') AS granted, arg_min(licence, (-score, licence)) AS licence
  FROM own WHERE doc_id % 16 = 0 GROUP BY ALL),
dirs AS (SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS directory FROM f),
passed AS (
  SELECT directory, arg_max(licence, length(granted)) AS licence, arg_max(granted, length(granted)) AS from_directory
  FROM dirs JOIN grants ON directory = granted OR starts_with(directory, granted || '/') GROUP BY directory)
SELECT f.doc_id, f.path, own.licence AS own_licence, own.score, coalesce(own.n_units, 0) AS n_units,
       coalesce(own.licence, passed.licence) AS licence, CASE WHEN own.licence IS NULL THEN passed.from_directory END AS from_directory
FROM f LEFT JOIN own ON own.doc_id = f.doc_id LEFT JOIN passed ON passed.directory = regexp_replace(f.path, '/[^/]*$', '')
"""

# op12: texts are equal after lower-casing A-Z; the largest id of a group stays.
ORACLE["op12_exact_dedup"] = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""

# op13: all levels of all trees by plain recursion, siblings by index, the tampered leaf folded level by level.
ORACLE["op13_merkle_manifest"] = """
WITH RECURSIVE f AS (
  SELECT doc_id, lang, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         CAST(n_chars AS VARCHAR) AS n, CAST(n_chars + 1 AS VARCHAR) AS n1, coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents),
bytes AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents),
crc(doc_id, s, i, k, v) AS (
  SELECT doc_id, s, CAST(1 AS BIGINT), 0, xor(4294967295, CAST(ascii(s[1]) AS BIGINT)) FROM bytes
  UNION ALL
  SELECT doc_id, s, CASE WHEN k = 7 THEN i + 1 ELSE i END, (k + 1) % 8,
         CASE WHEN k = 7 AND i < length(s) THEN xor(CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, CAST(ascii(s[i + 1]) AS BIGINT))
              ELSE CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END END
  FROM crc WHERE i <= length(s)),
hit AS (SELECT doc_id, xor(v, 4294967295) % 7 = 0 AS tampered FROM crc WHERE i = length(s) + 1),
leaves AS (
  SELECT f.doc_id, lang, sha256(head || coalesce(strlen(n) || ':' || n, '-') || tail) AS leaf,
         sha256(head || coalesce(CASE WHEN tampered THEN strlen(n1) || ':' || n1 ELSE strlen(n) || ':' || n END, '-') || tail) AS claim,
         row_number() OVER (PARTITION BY lang ORDER BY f.doc_id) - 1 AS idx
  FROM f JOIN hit ON hit.doc_id = f.doc_id),
level(lang, l, idx, h) AS (
  SELECT lang, 0, idx, leaf FROM leaves
  UNION ALL
  SELECT lang, any_value(l) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS width FROM level) WHERE width > 1 GROUP BY lang, idx // 2),
subroots AS (SELECT lang, arg_max(h, l) AS subroot, max(l) AS height FROM level GROUP BY lang),
tops AS (SELECT *, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS idx FROM subroots),
top(l, idx, h) AS (
  SELECT 0, idx, subroot FROM tops
  UNION ALL
  SELECT any_value(l) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS width FROM top) WHERE width > 1 GROUP BY idx // 2),
whole AS (SELECT arg_max(h, l) AS root, max(l) AS height FROM top),
path AS (
  SELECT leaves.doc_id, level.l AS step, level.h, level.idx < (leaves.idx >> level.l) AS is_left
  FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang
  JOIN level ON level.lang IS NOT DISTINCT FROM leaves.lang AND level.l < subroots.height AND level.idx = xor(leaves.idx >> level.l, 1)
  UNION ALL
  SELECT leaves.doc_id, tops.height + top.l, top.h, top.idx < (tops.idx >> top.l)
  FROM leaves JOIN tops ON tops.lang IS NOT DISTINCT FROM leaves.lang JOIN whole ON true
  JOIN top ON top.l < whole.height AND top.idx = xor(tops.idx >> top.l, 1)),
proof AS (SELECT doc_id, sha256(string_agg(h, '' ORDER BY step)) AS proof_sha256 FROM path GROUP BY doc_id),
fold(doc_id, step, h) AS (
  SELECT doc_id, CAST(0 AS BIGINT), claim FROM leaves
  UNION ALL
  SELECT fold.doc_id, fold.step + 1, CASE WHEN path.h IS NULL THEN sha256(fold.h) WHEN is_left THEN sha256(path.h || fold.h) ELSE sha256(fold.h || path.h) END
  FROM fold JOIN leaves ON leaves.doc_id = fold.doc_id JOIN tops ON tops.lang IS NOT DISTINCT FROM leaves.lang JOIN whole ON true
  LEFT JOIN path ON path.doc_id = fold.doc_id AND path.step = fold.step
  WHERE fold.step < tops.height + whole.height)
SELECT leaves.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded.h AS folded_root, folded.h = root AS verified
FROM leaves JOIN tops ON tops.lang IS NOT DISTINCT FROM leaves.lang JOIN whole ON true
LEFT JOIN proof ON proof.doc_id = leaves.doc_id
JOIN (SELECT doc_id, arg_max(h, step) AS h FROM fold GROUP BY doc_id) AS folded ON folded.doc_id = leaves.doc_id
"""
