"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

from lakegate.llm.mixing import BLOCK_WORDS, BUCKETS, GOLDEN_31, MAX_REPEAT, WEIGHTS
from lakegate.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

NEAR_DEDUP = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN lowest ON lowest.a = d.doc_id
"""

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size, md5(CAST(doc_id AS VARCHAR)) AS k
  FROM documents),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY CAST('0x' || k[1:4] AS INTEGER) % {BUCKETS}, k, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM sized),
totals AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM sized GROUP BY source),
capped AS (
  SELECT *, {list(map(float, WEIGHTS))}[1 + i % {len(WEIGHTS)}]::DOUBLE AS w, {float(MAX_REPEAT)}::DOUBLE * source_size AS cap FROM totals),
rated AS (
  SELECT *, cap / w AS ratio, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM capped),
common AS (SELECT first(rate ORDER BY ratio, i) AS c FROM rated WHERE rate <= ratio),
targets AS (
  SELECT source, i, source_size, CASE WHEN rate > ratio THEN cap ELSE least(cap, c * w) END AS target FROM rated, common),
goals AS (
  SELECT i, source_size::BIGINT AS n, floor(target + 0.5)::BIGINT AS goal, CAST(ceil(source_size / {BLOCK_WORDS}.0) AS BIGINT) AS b
  FROM targets WHERE source_size > 0),
wanted AS (
  SELECT i, b, goal % n % {BLOCK_WORDS} AS part, goal // n * b + goal % n // {BLOCK_WORDS} AS whole FROM goals),
slotted AS (SELECT *, whole + CASE WHEN part > 0 THEN 1 ELSE 0 END AS slots FROM wanted),
overall AS (SELECT sum(slots)::BIGINT AS t FROM slotted),
ends AS (
  SELECT i, CASE WHEN lead(i) OVER (ORDER BY i) IS NULL THEN 'infinity'::DOUBLE
    ELSE sum(slots) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) END AS e FROM slotted WHERE slots > 0),
points AS (
  SELECT s AS slot, ((s % 2147483648) * {GOLDEN_31} % 2147483648 + 0.5::DOUBLE) / 2147483648.0::DOUBLE * t::DOUBLE AS u
  FROM overall, range(0, t) r(s)),
hits AS (
  SELECT i, row_number() OVER (PARTITION BY i ORDER BY slot) - 1 AS rank
  FROM (SELECT slot, min(i) AS i FROM points JOIN ends ON e > u GROUP BY slot)),
got AS (SELECT i, count(*) AS n FROM hits GROUP BY i),
ranks AS (
  SELECT i, rank FROM hits JOIN slotted USING (i) WHERE rank < slots
  UNION ALL
  SELECT i, unnest(range(coalesce(n, 0)::BIGINT, slots::BIGINT)) FROM slotted LEFT JOIN got USING (i)),
used AS (
  SELECT i, rank % b AS block, CASE WHEN rank < whole THEN {BLOCK_WORDS} ELSE part END AS words, count(*) AS times
  FROM ranks JOIN slotted USING (i) GROUP BY ALL),
pieces AS (
  SELECT doc_id, source, pos, size, unnest(range(CAST(pos // {BLOCK_WORDS} AS BIGINT),
    CAST((pos + size - 1) // {BLOCK_WORDS} AS BIGINT) + 1)) AS block FROM placed WHERE size > 0),
taken AS (
  SELECT doc_id, sum(greatest(least(pos + size, block * {BLOCK_WORDS} + words) - greatest(pos, block * {BLOCK_WORDS}), 0) * times) AS taken
  FROM pieces JOIN targets t ON t.source IS NOT DISTINCT FROM pieces.source JOIN used USING (i, block) GROUP BY doc_id)
SELECT p.doc_id, p.size::BIGINT AS size, t.source_size::BIGINT AS source_size, t.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM placed p JOIN targets t ON t.source IS NOT DISTINCT FROM p.source LEFT JOIN taken k ON k.doc_id = p.doc_id
"""

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines),
shared AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT keyed.*, last IS NOT NULL AND last <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

EXACT_DEDUP = f"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS t FROM documents),
grouped AS (
  SELECT doc_id, t, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY t) AS group_size FROM normal)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM grouped
"""



def _vector_codes(parts: int, entries: int, rounds: int, scale: int) -> str:
    """One pair of tables per round: the entry of each part, and the entries moved to the means."""
    nearest = """
{a} AS (
  SELECT r, cells.p, min(list_sum(list_transform(range(1, w + 1),
    lambda i: (cells.v[i] - {c}.v[i]) * (cells.v[i] - {c}.v[i]))) * {entries} + e)::BIGINT AS m
  FROM cells JOIN {c} ON {c}.p = cells.p, dims GROUP BY r, cells.p),"""
    moved = """
{n} AS (
  SELECT p, e, list(v ORDER BY i) AS v FROM (
    SELECT {c}.p, {c}.e, i, coalesce(floor_div(s, n), {c}.v[i]) AS v
    FROM {c} CROSS JOIN (SELECT unnest(range(1, w + 1)) AS i FROM dims)
    LEFT JOIN (SELECT p, m % {entries} AS e, i, sum(x)::BIGINT AS s, count(*) AS n
      FROM (SELECT r, p, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM cells) JOIN {a} USING (r, p)
      GROUP BY ALL) means USING (p, e, i)) GROUP BY p, e),"""
    steps = "".join(nearest.format(a=f"a{k}", c=f"c{k}", entries=entries)
                    + (moved.format(a=f"a{k}", c=f"c{k}", n=f"c{k + 1}", entries=entries) if k < rounds else "")
                    for k in range(rounds + 1))
    steps = steps.replace("floor_div(s, n)", "(s - ((s % n) + n) % n) // n")
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding AS x, row_number() OVER () AS r FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
dims AS (SELECT greatest(1, (max(len(x)) + {parts - 1}) // {parts}) AS w FROM kept),
cells AS (
  SELECT r, p, list_transform(range(1, w + 1), lambda i: coalesce(floor({scale} * x[p * w + i]::DOUBLE), 0)::BIGINT) AS v
  FROM kept, dims, range({parts}) t(p)),
first AS (
  SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, list_transform(x, lambda y: floor({scale} * y::DOUBLE))) - 1 AS e
  FROM kept QUALIFY e < {entries}),
c0 AS (SELECT p, e, v FROM cells JOIN first USING (r)),{steps}
codes AS (
  SELECT r, string_agg(format('{{:02x}}', m % {entries}), '' ORDER BY p) AS code, sum(m // {entries})::BIGINT AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256
FROM kept JOIN codes USING (r)
"""


ORACLES = {
    "op1_near_dedup": NEAR_DEDUP,
    "op4_mixing": MIXING,
    "op5_line_dedup": LINE_DEDUP,
    "op10_exact_dedup": EXACT_DEDUP,
    "op13_vector_codes": _vector_codes(PARTS, ENTRIES, ROUNDS, SCALE),
}
