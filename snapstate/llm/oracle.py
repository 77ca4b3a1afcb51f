"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from .mixing import SCHEDULES, segments

EXACT = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""


def _jump(shards: int) -> str:
    """The shard b of each distinct doc_id. The shard number grows with every step, so `shards` + 1 steps reach the end."""
    sql = "(SELECT doc_id, CASE WHEN k < 0 THEN k::HUGEINT + 18446744073709551616 ELSE k::HUGEINT END AS s, 0::BIGINT AS b, false AS stop FROM (SELECT DISTINCT doc_id, coalesce(doc_id, 0) AS k FROM documents))"
    for _ in range(shards + 1):
        sql = f"(SELECT doc_id, (s * 2862933555777941757 + 1) % 18446744073709551616 AS s, b, stop FROM {sql})"
        sql = f"(SELECT doc_id, s, b, stop, floor((b + 1) * (2147483648.0::DOUBLE / ((s // 8589934592)::DOUBLE + 1.0::DOUBLE))) AS j FROM {sql})"
        sql = f"(SELECT doc_id, s, CASE WHEN stop OR j >= {shards} THEN b ELSE j::BIGINT END AS b, stop OR j >= {shards} AS stop FROM {sql})"
    return f"SELECT doc_id, b::INTEGER AS b FROM {sql}"


SHARDS = f"""
WITH RECURSIVE steps(i, c, k) AS (SELECT range::BIGINT, range::BIGINT, 0 FROM range(256)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS l FROM steps WHERE k = 8),
d AS (SELECT doc_id, encode(coalesce(text, '')) AS t, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS o FROM documents),
e AS (SELECT doc_id, o, octet_length(t) + 1 AS size, list_transform(regexp_extract_all(hex(t), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM d),
f AS (SELECT doc_id, o, size, xor(list_reduce(bytes, lambda s, x: xor(s >> 8, l[(xor(s, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32 FROM e, crc),
eight AS ({_jump(8)}), nine AS ({_jump(9)})
SELECT f.doc_id, size, text_crc32, 'key' AS law, eight.b AS shard, nine.b AS grown_shard,
       row_number() OVER (PARTITION BY eight.b ORDER BY o) - 1 AS slot
FROM f JOIN eight ON f.doc_id IS NOT DISTINCT FROM eight.doc_id JOIN nine ON f.doc_id IS NOT DISTINCT FROM nine.doc_id
"""


def _time(share: str, kind: str) -> str:
    cases = ""
    for i, knots in enumerate(SCHEDULES):
        inner = ""
        for s in segments(knots):
            rest = f"greatest({share} - {s['c0']!r}::DOUBLE, 0.0::DOUBLE)"
            root = f"sqrt(greatest({s['w0'] ** 2!r}::DOUBLE + {rest} * {2 * (s['w1'] - s['w0']) / s['len']!r}::DOUBLE, 0.0::DOUBLE))"
            inner += f" WHEN {share} < {s['c1']!r}::DOUBLE THEN {s['t0']!r}::DOUBLE + CASE WHEN {rest} > 0 THEN {rest} * 2 / ({root} + {s['w0']!r}::DOUBLE) ELSE 0.0::DOUBLE END"
        cases += f" WHEN {kind} = {i} THEN CASE{inner} ELSE 1.0::DOUBLE END"
    return f"CASE{cases} END"


MIXING = rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS o FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS z FROM d GROUP BY source),
k AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER AS kind FROM s),
w AS (SELECT *, [5, 2, 1][kind + 1]::BIGINT AS w, 3 * z AS cap FROM k),
l AS (SELECT *, cap::DOUBLE / w AS ratio,
        ((SELECT sum(z)::BIGINT FROM s) - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
t AS (SELECT source, z, kind, least(cap::DOUBLE, coalesce((SELECT arg_min(level, ratio) FROM l WHERE level <= ratio), 0.0::DOUBLE) * w) AS target FROM l),
p AS (SELECT d.*, t.z, t.kind, t.target, round(t.target)::BIGINT AS words,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, d.id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, ((words // greatest(z, 1)) * size + least(greatest(words % greatest(z, 1) - before, 0), size))::BIGINT AS taken FROM p),
c AS (SELECT id, o, source, kind, copy, (copy * z + before)::DOUBLE / greatest(target, 1.0::DOUBLE) AS share
      FROM (SELECT *, unnest(range(CASE WHEN taken > 0 THEN (taken - 1) // size + 1 ELSE 0 END)) AS copy FROM q)),
m AS (SELECT id, copy, time, row_number() OVER (ORDER BY time, o, source NULLS LAST, copy, id) - 1 AS position FROM (SELECT *, {_time("share", "kind")} AS time FROM c))
SELECT doc_id, size, z AS source_size, target, taken, round(time, 6) AS first_time, position FROM q LEFT JOIN m ON q.id = m.id AND m.copy = 0
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_bloom_exact_dedup": EXACT, "op6_jump_hash_shards": SHARDS, "op8_curriculum_mixing": MIXING}
