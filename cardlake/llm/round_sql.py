"""DuckDB SQL of the sharding, clustering and coding queries: iterations as recursion or as a chain."""

# The search state is (low, high) with a greedy filling under way at (pos, used).
SHARDS_SQL = """
WITH RECURSIVE r AS (
  SELECT doc_id, text, CAST(coalesce(strlen(text), 0) + 16 AS BIGINT) AS size, coalesce(sha256(text), '') AS h
  FROM documents
),
g AS (SELECT h, CAST(sum(size) AS BIGINT) AS s, CAST(sum(sum(size)) OVER (ORDER BY h) AS BIGINT) AS p FROM r GROUP BY h),
b AS (SELECT list(p ORDER BY p) AS ps, list({'p': p, 's': s}) AS sized, max(p) AS total, max(s) AS largest, (max(p) + 39) // 40 AS mean FROM g),
search(lo, hi, pos, used) AS (
  SELECT mean, mean + largest, CAST(0 AS BIGINT), 0 FROM b
  UNION ALL
  SELECT CASE WHEN nxt < total AND used = 39 THEN mid + 1 ELSE lo END, CASE WHEN nxt >= total THEN mid ELSE hi END,
    CASE WHEN nxt >= total OR used = 39 THEN 0 ELSE nxt END, CASE WHEN nxt >= total OR used = 39 THEN 0 ELSE used + 1 END
  FROM (SELECT *, coalesce(list_max(list_filter(ps, lambda p: p <= pos + mid)), 0) AS nxt
        FROM (SELECT *, (lo + hi) // 2 AS mid FROM search, b WHERE lo < hi))
),
cap AS (SELECT lo AS c FROM search WHERE lo >= hi),
rest(j, e) AS (
  SELECT 0, total FROM b
  UNION ALL
  SELECT j + 1, CASE WHEN e <= c THEN 0 ELSE list_min(list_filter(ps, lambda p: p >= e - c)) END FROM rest, b, cap WHERE j < 39
),
last(j, l) AS (
  SELECT 0, total FROM b
  UNION ALL
  SELECT j + 1, coalesce(list_max(list_filter(ps, lambda p: p < l)), 0) FROM last, b WHERE j < 39
),
cut(i, pos) AS (
  SELECT 0, CAST(0 AS BIGINT)
  UNION ALL
  SELECT i + 1, least(greatest(CASE WHEN x - low <= high - x THEN low ELSE high END, e, one),
                      coalesce(list_max(list_filter(ps, lambda p: p <= pos + c)), 0), greatest(l, one))
  FROM (SELECT *, coalesce(list_max(list_filter(ps, lambda p: p <= x)), 0) AS low,
          CASE WHEN x <= 0 THEN 0 ELSE list_min(list_filter(ps, lambda p: p >= x)) END AS high,
          CASE WHEN pos >= total THEN total ELSE list_min(list_filter(ps, lambda p: p > pos)) END AS one
        FROM (SELECT *, pos + list_min(list_transform(range(least(40 - i, len(big) + 1)),
                lambda m: (total - pos - coalesce(list_sum(big[1:m]), 0) + 39 - i - m) // (40 - i - m))) AS x
              FROM (SELECT *, list_reverse_sort(list_transform(list_filter(sized, lambda z: z.p > pos), lambda z: z.s)) AS big
                    FROM cut, b, cap, rest, last WHERE i < 39 AND rest.j = 39 - i AND last.j = 39 - i)))
),
placed AS (SELECT h, CAST((SELECT count(*) FROM cut WHERE i > 0 AND pos < g.p) AS INT) AS shard FROM g),
crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
)
SELECT doc_id, size, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
      regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
    lambda c, x: xor(t[1 + (xor(c, x) & 255)], c >> 8))) AS text_crc32,
  'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST) - 1 AS slot,
  CAST(NULL AS INT) AS grown_shard
FROM r JOIN placed USING (h), crc
"""

_MEAN = "(s - ((s % n) + n) % n) // n"  # floor, also of negative sums
_SQUARES = "CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
_WHOLE = "list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _nearest(i: int, part: str) -> str:
    """a<i>: the nearest entry of c<i> for each row of v (of a part)."""
    return f"""a{i} AS MATERIALIZED (SELECT rid, {part}min({{'d': {_SQUARES}, 'c': c.c}}) AS m
  FROM v JOIN c{i} c ON {"v.part = c.part" if part else "true"} GROUP BY rid{", v.part" if part else ""})"""


def _means(i: int, part: str) -> str:
    """c<i + 1>: the floors of the means."""
    using = "part, c" if part else "c"
    return f"""c{i + 1} AS MATERIALIZED (SELECT {using}, coalesce(q.x, o.x) AS x FROM c{i} o LEFT JOIN (
    SELECT {using}, list({_MEAN} ORDER BY k) AS x FROM (
      SELECT {using}, k, CAST(sum(e) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT {"part, " if part else ""}m.c AS c, unnest(x) AS e, generate_subscripts(x, 1) AS k
        FROM v JOIN a{i} USING ({"rid, part" if part else "rid"})) GROUP BY ALL) GROUP BY ALL) q USING ({using}))"""


def _rounds(n: int, part: str) -> str:
    return ",\n".join([f"{_nearest(i, part)},\n{_means(i, part)}" for i in range(n)] + [_nearest(n, part)])


CENTROIDS_SQL = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, {_WHOLE.format(scale=64)} AS x
  FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x FROM v WHERE vec_id IS NOT NULL
  QUALIFY c < 16),
{_rounds(3, "")},
names AS (SELECT c, sha256(array_to_string(x, ',')) AS centroid_sha256 FROM c3)
SELECT vec_id, CAST(m.c AS INT) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(m.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM v JOIN a3 USING (rid) JOIN names ON names.c = m.c
"""

CODEBOOKS_SQL = f"""
WITH w AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, {_WHOLE.format(scale=4096)} AS x
  FROM embeddings WHERE {_FINITE}),
v AS MATERIALIZED (SELECT rid, vec_id, part, x[part * (len(x) // 8) + 1:(part + 1) * (len(x) // 8)] AS x
  FROM w, range(8) t(part)),
f AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS c, rid FROM w QUALIFY c < 16),
c0 AS MATERIALIZED (SELECT part, c, x FROM v JOIN f USING (rid)),
{_rounds(6, "v.part, ")},
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, c)) AS codebooks_sha256 FROM c6),
coded AS (SELECT rid, string_agg(printf('%02x', m.c), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM a6 GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM w JOIN coded USING (rid), book
"""
