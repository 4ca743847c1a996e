"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

# Unsigned crc32 of an ASCII text: a table of 256 remainders, then one step a character.
CRC_TABLE = """crc_bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_bits WHERE k < 8),
crc AS (SELECT LIST(c ORDER BY i) AS tab FROM crc_bits WHERE k = 8)"""


def crc32(text: str) -> str:
    codes = f"list_transform(range(1, length({text}) + 1), lambda p: CAST(ascii(substr({text}, p, 1)) AS BIGINT))"
    step = "xor(c >> 8, tab[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {step}), 4294967295)"


def _value(cost: str, audit: str) -> str:
    return f"{{'c': CAST({cost} AS BIGINT), 'a': {audit}}}"


def _turn_repair() -> str:
    """Damage, faults, and the cheapest edits by costs of suffixes over the grammar's states, from the last turn back."""
    def drop(v: str) -> str:
        return _value(f"4 + {v}.c", f"'D' || {v}.a")

    def take(v: str, role: str, reroles: bool = True) -> str:
        match = f"f.initial = '{role}'"
        lost = "3" if reroles else "NULL"
        body = _value(f"f.cut + CASE WHEN {match} THEN 0 ELSE 3 END + {v}.c", f"CASE WHEN {match} THEN 'K' ELSE 'R' END || {v}.a")
        return f"CASE WHEN NOT f.forced{'' if lost == '3' else f' AND {match}'} THEN {body} END"

    def insert(v: str) -> str:
        return _value(f"3 + {v}.c", f"'I' || {v}.a")
    end, one, two = _value("0", "''"), _value("3", "'I'"), _value("6", "'II'")
    return f"""
WITH RECURSIVE {CRC_TABLE},
k AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
  COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS id FROM conversations),
h AS (SELECT k.*, {crc32('id')} % 20 AS harm FROM k, crc),
d AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
  CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  UNNEST(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE harm <> 0),
o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS i,
  substr(role, 1, 1) AS initial FROM d),
g AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
  WHEN ROW_NUMBER() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '-' END AS fault,
  LAG(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
f AS (SELECT *, fault IN ('b', 'd') AS forced, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS cut FROM g),
n AS (SELECT conv_id, MAX(i) AS n, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (WHERE fault = 'b') AS blank,
  COUNT(*) FILTER (WHERE fault = 'd') AS duplicate, COUNT(*) FILTER (WHERE fault = 't') AS truncated,
  COUNT(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
s(conv_id, i, v0, vs, vu, va) AS (
  SELECT conv_id, n + 1, {end}, {two}, {one}, {end} FROM n
  UNION ALL
  SELECT conv_id, i, list_min([b0, {insert('u')}]), list_min([bs, {insert('u')}]), u, list_min([ba, {insert('bu')}])
  FROM (SELECT *, list_min([bu, {insert('ba')}]) AS u FROM (
    SELECT s.conv_id, f.i, list_min([{drop('s.v0')}, {take('s.vs', 's', False)}, {take('s.vu', 'u')}]) AS b0,
      list_min([{drop('s.vs')}, {take('s.vu', 'u')}]) AS bs, list_min([{drop('s.vu')}, {take('s.va', 'a')}]) AS bu,
      list_min([{drop('s.va')}, {take('s.vu', 'u')}]) AS ba
    FROM s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i - 1) x) y),
e AS (SELECT conv_id, v0.c AS cost, v0.a AS audit, length(replace(v0.a, 'D', '')) AS made FROM s WHERE i = 1),
p AS (SELECT conv_id, audit, made, UNNEST(range(1, length(audit) + 1)) AS place FROM e),
q AS (SELECT *, substr(audit, place, 1) AS edit, length(replace(substr(audit, 1, place), 'I', '')) AS i,
  length(replace(substr(audit, 1, place), 'D', '')) - 1 - made % 2 AS j FROM p),
t AS (SELECT q.conv_id, string_agg(CASE WHEN edit = 'K' THEN f.role WHEN j % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
  CASE WHEN edit = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY place) AS whole
  FROM q LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM q.conv_id AND f.i = q.i WHERE edit <> 'D' GROUP BY q.conv_id)
SELECT c.conv_id, COALESCE(n.gaps, 0) AS gaps, COALESCE(n.blank, 0) AS blank, COALESCE(n.duplicate, 0) AS duplicate, COALESCE(n.truncated, 0) AS truncated,
  COALESCE(n.illegal, 0) AS illegal, COALESCE(e.cost, 0) AS cost, COALESCE(e.audit, '') AS audit, sha256(COALESCE(t.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""


def _merkle() -> str:
    """Both trees level by level, siblings by a window over each run, and the fold along every leaf's path."""
    def field(c: str) -> str:
        return f"COALESCE(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    run = "PARTITION BY tree, source, lvl, idx // 16 ORDER BY idx"
    return f"""
WITH RECURSIVE {CRC_TABLE},
l AS (SELECT d.*, {leaf('text')} AS leaf, CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS other
  FROM documents d, crc),
pos AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, COUNT(*) OVER (PARTITION BY source) AS size FROM l),
low(source, lvl, idx, size, h) AS (
  SELECT source, 0, place, size, leaf FROM pos
  UNION ALL
  SELECT source, lvl + 1, idx // 16, (size + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM low WHERE size > 1 GROUP BY ALL),
subs AS (SELECT source, h AS subroot, ROW_NUMBER() OVER (ORDER BY source NULLS FIRST) - 1 AS place, COUNT(*) OVER () AS size FROM low WHERE size = 1),
high(lvl, idx, size, h) AS (
  SELECT 0, place, size, subroot FROM subs
  UNION ALL
  SELECT lvl + 1, idx // 16, (size + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM high WHERE size > 1 GROUP BY ALL),
nodes AS (SELECT 0 AS tree, source, lvl, idx, size, h FROM low UNION ALL SELECT 1, NULL, lvl, idx, size, h FROM high),
sides AS (SELECT tree, source, lvl, idx,
  COALESCE(string_agg(h, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
  COALESCE(string_agg(h, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM nodes WHERE size > 1),
heights AS (SELECT source, MAX(lvl) AS own FROM low GROUP BY source),
start AS (SELECT ROW_NUMBER() OVER () AS id, p.doc_id, p.leaf, p.other, p.source, p.place, s.place AS source_place, s.subroot, r.h AS root, t.own
  FROM pos p JOIN subs s ON s.source IS NOT DISTINCT FROM p.source JOIN heights t ON t.source IS NOT DISTINCT FROM p.source, high r WHERE r.size = 1),
path(id, step, node, proof) AS (
  SELECT id, 0, other, '' FROM start
  UNION ALL
  SELECT p.id, p.step + 1, sha256(x.before || p.node || x.after), p.proof || x.before || x.after
  FROM path p JOIN start b ON b.id = p.id JOIN sides x ON x.tree = CASE WHEN p.step < b.own THEN 0 ELSE 1 END
    AND x.source IS NOT DISTINCT FROM CASE WHEN p.step < b.own THEN b.source END
    AND x.lvl = CASE WHEN p.step < b.own THEN p.step ELSE p.step - b.own END
    AND x.idx = CASE WHEN p.step < b.own THEN b.place // CAST(pow(16, p.step) AS BIGINT) ELSE b.source_place // CAST(pow(16, p.step - b.own) AS BIGINT) END),
last AS (SELECT id, arg_max(node, step) AS node, arg_max(proof, step) AS proof FROM path GROUP BY id)
SELECT b.doc_id, b.leaf, b.subroot, b.root, sha256(z.proof) AS proof_sha256, z.node AS folded_root, z.node = b.root AS verified
FROM start b JOIN last z ON z.id = b.id"""


TURN_REPAIR = _turn_repair()
MERKLE = _merkle()
