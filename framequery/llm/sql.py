"""SQL that says the same as a registered query, for DuckDB."""

from __future__ import annotations

#: The CRC-32 table, one row of 256 numbers, from its polynomial.
_CRC_TABLE = """
crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
)"""


def _crc(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes; needs crc_table beside it."""
    steps = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce({steps}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"


def importance_sql() -> str:
    """Operator 11: words, word pairs, buckets, gains and scores, each as a grouped table."""
    words = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = f"translate({{}}, '{''.join(map(chr, range(65, 91)))}', '{''.join(map(chr, range(97, 123)))}')"
    return f"""
WITH {_CRC_TABLE.strip()},
texts AS (
  SELECT doc_id, false AS target, regexp_extract_all({lower.format("coalesce(text, '')")}, '{words}') AS w FROM documents
  UNION ALL SELECT NULL, true, regexp_extract_all({lower.format("coalesce(text, '')")}, '{words}') FROM benchmark
),
features AS MATERIALIZED (
  SELECT doc_id, target, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM texts
),
hashed AS MATERIALIZED (SELECT f, {_crc("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM features), crc_table),
bucketed AS MATERIALIZED (SELECT doc_id, target, bucket FROM features JOIN hashed USING (f)),
counted AS (SELECT bucket, count(*) FILTER (NOT target) AS s, count(*) FILTER (target) AS t FROM bucketed GROUP BY bucket),
totals AS (SELECT sum(s)::BIGINT + 10000 AS s_all, sum(t)::BIGINT + 10000 AS t_all FROM counted),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * s_all)::DOUBLE / ((s + 1) * t_all)::DOUBLE))::BIGINT AS gain FROM counted, totals
),
summed AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS g FROM bucketed JOIN gains USING (bucket) WHERE NOT target GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, CASE WHEN n IS NULL THEN 0 ELSE (g - ((g % n) + n) % n) // n END AS weight,
    ('0x' || sha256('7:' || d.doc_id)[1:8])::BIGINT AS h
  FROM documents d LEFT JOIN summed s ON d.doc_id = s.doc_id
),
final AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM final WHERE n_features >= 39
)
SELECT f.doc_id, f.n_features::BIGINT AS n_features, f.weight::BIGINT AS weight, f.score::BIGINT AS score,
  CASE WHEN r.r <= 25 * r.n // 100 THEN r.r END::BIGINT AS rank
FROM final f LEFT JOIN ranked r USING (doc_id)
"""


def shards_sql() -> str:
    """Operator 12: bytes below each group of equal texts and each row in key order, and the shard of the middle byte."""
    return f"""
WITH {_CRC_TABLE.strip()},
keyed AS (
  SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) + 16 AS size,
    md5(coalesce(text, ''))[1:15] AS a, md5(coalesce(doc_id::VARCHAR, ''))[1:15] AS b
  FROM documents
),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY a)::BIGINT AS group_size, max(size) OVER () AS largest, sum(size) OVER ()::BIGINT AS total,
    sum(size) OVER (ORDER BY a, b ROWS UNBOUNDED PRECEDING)::BIGINT - size AS below
  FROM keyed
),
units AS (
  SELECT *, CASE WHEN group_size <= largest THEN 2 * min(below) OVER (PARTITION BY a) + group_size ELSE 2 * below + size END AS middle FROM summed
),
placed AS (SELECT *, (middle * 40 - 1) // (2 * total) AS shard FROM units)
SELECT doc_id, size::BIGINT AS size, {_crc("text")}::BIGINT AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY a, b) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM placed, crc_table
"""


def manifest_sql() -> str:
    """Operator 13: trees level by level, proofs as joins of levels, and every document's claim folded up again."""

    def leaf(n_chars: str) -> str:
        values = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"

    def tree(name: str, start: str) -> str:
        return f"""
{name}(level, lang, pos, n, h) AS (
  SELECT 0, {start}
  UNION ALL
  SELECT level + 1, lang, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY level, lang, pos // 2, n
)"""

    def folded(name: str, nodes: str, start: str) -> str:
        return f"""
{name}(doc_id, level, lang, pos, n, h, proof) AS (
  {start}
  UNION ALL
  SELECT f.doc_id, f.level + 1, f.lang, f.pos // 2, (f.n + 1) // 2,
    sha256(CASE WHEN f.pos % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END), f.proof || coalesce(s.h, '')
  FROM {name} f LEFT JOIN {nodes} s ON s.level = f.level AND s.lang IS NOT DISTINCT FROM f.lang AND s.pos = xor(f.pos, 1)
  WHERE f.n > 1
)"""

    return f"""
WITH RECURSIVE {_CRC_TABLE.strip()},
leaves AS MATERIALIZED (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n, {leaf("n_chars")} AS h,
    CASE WHEN {_crc("doc_id::VARCHAR")} % 7 = 0 THEN {leaf("n_chars + 1")} END AS claim
  FROM documents, crc_table
),
{tree("nodes", "lang, pos, n, h FROM leaves").strip()},
subroots AS MATERIALIZED (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
),
{tree("upper_nodes", "NULL::VARCHAR, pos, n, h FROM subroots").strip()},
whole AS (SELECT h AS root FROM upper_nodes WHERE n = 1),
{folded("folds", "nodes", "SELECT doc_id, 0, lang, pos, n, coalesce(claim, h), '' FROM leaves").strip()},
{folded("upper_folds", "upper_nodes", "SELECT f.doc_id, 0, NULL::VARCHAR, s.pos, s.n, f.h, f.proof FROM folds f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1").strip()}
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM upper_folds f JOIN leaves l USING (doc_id) JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang, whole
WHERE f.n = 1
"""
