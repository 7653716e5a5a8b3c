"""DuckDB SQL for results that their contracts fix, whatever the method: plain comparisons of everything with everything."""

from __future__ import annotations

#: The table of CRC-32, and the sum of a list of bytes, which DuckDB has no function for.
_CRC_TABLE = "crct AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t)"


def _crc32(text: str) -> str:
    """Of a text's UTF-8; t is the table's column."""
    found = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {found}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_WORDS = r"'[^\x20\x09-\x0D]+'"

SHARDS = f"""
WITH {_CRC_TABLE}, s AS (SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, {_crc32("coalesce(text, '')")} AS crc FROM documents, crct),
x AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS nth FROM s),
y AS (SELECT *, CAST(least((upto - size) * 24 // total, 23) AS INTEGER) AS shard FROM x)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY nth) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM y
"""

#: Of links (a, b) the smallest end that each end reaches.
_REACHED = "e AS (SELECT a, b FROM links UNION SELECT b, a FROM links), reach(v, u) AS (SELECT a, b FROM e UNION SELECT v, b FROM reach JOIN e ON u = a), root AS (SELECT v, min(u) AS m FROM reach GROUP BY v)"

SIMILAR = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_WORDS}) AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_ JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 75 * (p.n + q.n - common)), {_REACHED}
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN root ON v = doc_id
"""

NEAR_VECTORS = f"""
WITH RECURSIVE g AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
sound AS (SELECT * FROM g WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM sound p JOIN sound q ON p.label = q.label AND p.vec_id < q.vec_id AND len(p.x) = len(q.x) WHERE list_cosine_similarity(p.x, q.x) >= 0.98), {_REACHED},
c AS (SELECT a, count(*) AS k FROM e GROUP BY a)
SELECT vec_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept FROM g LEFT JOIN root ON v = vec_id LEFT JOIN c ON c.a = vec_id
"""

REPEATED_BYTES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS (SELECT doc_id, c, substr(h, 2000 * c + 1, 2198) AS s FROM (SELECT doc_id, h, unnest(range(0, strlen(h) // 2000 + 1)) AS c FROM d)),
w AS (SELECT doc_id, 1000 * c + j AS i, substr(s, 2 * j + 1, 200) AS k FROM (SELECT doc_id, c, s, unnest(range(0, least(1000, strlen(s) // 2 - 99))) AS j FROM part)),
f AS (SELECT k, min(ROW(doc_id, i)) AS first FROM w GROUP BY k HAVING count(*) > 1),
bad AS (SELECT doc_id, i FROM w JOIN f USING (k) WHERE ROW(doc_id, i) > first),
runs AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM bad)),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, run),
cuts AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans UNION ALL SELECT doc_id, coalesce(max(b), 0), strlen(h) // 2 FROM (SELECT doc_id, any_value(h) AS h, max(b) AS b FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id) GROUP BY doc_id, h),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM cuts JOIN d USING (doc_id) GROUP BY doc_id),
t AS (SELECT doc_id, sum(b - a) AS n, count(*) AS c FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(c, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, ''))) AS kept_sha256 FROM d LEFT JOIN t USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _leaf(text: str) -> str:
    said = lambda c: f"coalesce(concat(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR), ':', CAST({c} AS VARCHAR)), '-')" if c != "x" else ""
    fields = [f"CASE WHEN {c} IS NULL THEN '-' ELSE {said(c)} END" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256(concat({', '.join(fields)}))"


def _levels(name: str, leaves: str) -> str:
    """name: level, grp, i, h, n of every node above leaves (grp, i, h, n), runs of 16 being one node; name_s with what stands
    left and right of each in its run."""
    return f"""{name}(level, grp, i, h, n) AS (SELECT 0, grp, i, h, n FROM {leaves} UNION ALL SELECT level + 1, grp, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM {name} WHERE n > 1 GROUP BY level, grp, i // 16, n),
{name}_s AS (SELECT *, concat(coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''), '|', coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')) AS sides
  FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY level, grp, i // 16 ORDER BY i))"""


_FOLD = "list_reduce(list_prepend({leaf}, sides), lambda a, s: sha256(concat(split_part(s, '|', 1), a, split_part(s, '|', 2))))"

MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE}, l AS (SELECT doc_id, coalesce('=' || source, '') AS grp, {_leaf("text")} AS h, CASE WHEN coalesce({_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0, false) THEN {_leaf(_lower("text"))} ELSE {_leaf("text")} END AS changed FROM documents, crct),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY grp) AS n FROM l), {_levels("nodes", "placed")},
tops AS (SELECT grp AS name, h AS subroot, '' AS grp, row_number() OVER (ORDER BY encode(grp)) - 1 AS i, count(*) OVER () AS n, h FROM nodes WHERE n = 1), {_levels("uppers", "tops")},
own AS (SELECT p.doc_id, p.grp, p.i, list(s.sides ORDER BY s.level) AS sides FROM placed p JOIN nodes_s s ON s.grp = p.grp AND s.i = p.i // CAST(16 ** s.level AS BIGINT) GROUP BY ALL),
more AS (SELECT t.name AS grp, list(s.sides ORDER BY s.level) AS sides FROM tops t JOIN uppers_s s ON s.i = t.i // CAST(16 ** s.level AS BIGINT) GROUP BY ALL),
all_ AS (SELECT p.*, subroot, (SELECT h FROM uppers WHERE n = 1) AS root, list_concat(coalesce(own.sides, []), coalesce(more.sides, [])) AS sides FROM placed p JOIN tops ON tops.name = p.grp LEFT JOIN own ON own.grp = p.grp AND own.i = p.i LEFT JOIN more ON more.grp = p.grp)
SELECT doc_id, h AS leaf, subroot, root, sha256(replace(array_to_string(sides, ''), '|', '')) AS proof_sha256, {_FOLD.format(leaf="changed")} AS folded_root, {_FOLD.format(leaf="changed")} = root AS verified FROM all_
"""

QUALITY_BASE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
l AS (SELECT doc_id, nth, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY nth) AS again FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS nth FROM d) WHERE regexp_matches(line, {_WORDS})),
dup AS (SELECT doc_id, count(*) AS n FROM l WHERE again > 1 GROUP BY doc_id),
w AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM w) WHERE c > 1),
rep AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS i FROM r) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, len(ws) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(ws) AS base_failed
FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)
"""
