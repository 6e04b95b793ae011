"""SQL for DuckDB that gives the rows of those queries that SQL can express."""

from logweir.llm.mixing import ROUNDS, number

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"

LINE_DEDUP = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, i, ws, md5(array_to_string(ws, ' ')) AS f
      FROM (SELECT doc_id, i, regexp_extract_all(line, {_WORD}) AS ws FROM lines) WHERE len(ws) >= 1),
v AS (SELECT doc_id, i, k, md5(array_to_string(ws[1:k-1] || ws[k+1:], ' ')) AS v
      FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS k FROM e WHERE len(ws) >= 8)),
gone AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY f ORDER BY doc_id, i) AS r FROM e) WHERE r > 1
  UNION SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k, v ORDER BY doc_id, i) AS r FROM v) WHERE r > 1
  UNION SELECT v.doc_id, v.i FROM v JOIN e ON v.v = e.f WHERE (e.doc_id, e.i) < (v.doc_id, v.i)
  UNION SELECT e.doc_id, e.i FROM v JOIN e ON v.v = e.f WHERE (v.doc_id, v.i) < (e.doc_id, e.i)),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
         string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS rest
  FROM lines l LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(rest, '') END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents LEFT JOIN kept USING (doc_id)
"""

MINHASH = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLD}, {_WORD}) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k+4], ' '))
                               WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reached(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b, root FROM reached JOIN links ON a = doc_id),
least AS (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN n USING (doc_id)
"""

TOP_K = rf"""
WITH t AS (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all({_FOLD}, {_WORD})) AS w FROM documents) GROUP BY ALL),
d AS (SELECT doc_id, sum(tf) AS dl FROM t GROUP BY doc_id),
g AS (SELECT (SELECT count(*) FROM documents) AS n, greatest(1.0, (SELECT sum(dl) FROM d)::DOUBLE / (SELECT count(*) FROM documents)) AS av),
f AS (SELECT w, count(*) AS df FROM t GROUP BY w),
p AS (SELECT doc_id, w, ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
               / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl::DOUBLE / av)) AS s
      FROM t JOIN f USING (w) JOIN d USING (doc_id), g),
q AS (SELECT doc_id AS query_id, w FROM t WHERE doc_id % 50 = 0),
h AS (SELECT query_id, doc_id, round(sum(s ORDER BY w), 6) AS score FROM q JOIN p USING (w) GROUP BY ALL)
SELECT query_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS r FROM h) WHERE r <= 10
"""

SUFFIX_DEDUP = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS x
      FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 99, 0))) AS i FROM b)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS r FROM s) WHERE r > 1),
marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS new FROM again),
runs AS (SELECT doc_id, i, count(*) FILTER (WHERE new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM runs GROUP BY doc_id, run),
gaps AS (SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS y FROM spans),
kept AS (SELECT doc_id, any_value(h) AS h, string_agg(substr(h, 2 * y + 1, 2 * (a - y)), '' ORDER BY a) AS lead, max(z) AS z,
                sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans
         FROM gaps JOIN b USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(b.h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN b.h ELSE lead || substr(b.h, 2 * z + 1) END)) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id)
"""


def _permuted() -> str:
    """The swap-or-not rounds, a table each; the last one has the block of every slot."""
    tables = ["q0 AS MATERIALIZED (SELECT rank, blocks, j % blocks AS p, j // blocks AS turn FROM slots)"]
    for r in range(ROUNDS):
        centre = f"(({number('rank', 'turn', str(r), '1')} * 2147483648 + {number('rank', 'turn', str(r), '2')}) % blocks + blocks - p) % blocks"
        bit = number("rank", "turn", str(r), "greatest(p, c)")
        tables.append(f"c{r} AS MATERIALIZED (SELECT *, {centre} AS c FROM q{r})")
        tables.append(f"q{r + 1} AS MATERIALIZED (SELECT rank, blocks, turn, CASE WHEN {bit} // 64 % 2 = 1 THEN c ELSE p END AS p FROM c{r})")
    return ",\n".join(tables)


_U = f"({number('shard', 'draw', '3')} * 2147483648 + {number('shard', 'draw', '4')}) % parts"

MIX = rf"""
WITH sized AS (SELECT row_number() OVER () AS id, doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank, source_size * 3.0::DOUBLE AS top FROM sources),
weighed AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight FROM ranked),
filled AS (
  SELECT *, row_number() OVER o AS ord,
         sum(source_size) OVER () - coalesce(sum(top) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM weighed WINDOW o AS (ORDER BY top / weight, rank)),
cut AS (SELECT ord AS c_ord, lft AS c_lft, rest AS c_rest FROM filled WHERE lft * weight <= top * rest ORDER BY ord LIMIT 1),
target AS (SELECT rank, source, source_size, n_docs, CASE WHEN ord >= c_ord THEN c_lft * weight / c_rest ELSE top END AS target FROM filled, cut),
wanted AS (SELECT *, (source_size + 63) // 64 AS blocks, target * ((source_size + 63) // 64) / source_size AS want FROM target WHERE source_size > 0),
whole AS (SELECT *, sum(want) OVER () AS everything, greatest(1, round(sum(want) OVER ()))::BIGINT AS n_slots FROM wanted),
sharded AS (SELECT *, (n_slots + 4095) // 4096 AS shards FROM whole),
kinds AS (
  SELECT rank, blocks, want, everything, 0 AS kind, 0 AS low, shards - 1 AS high, 4096::BIGINT AS width FROM sharded
  UNION ALL SELECT rank, blocks, want, everything, 1, shards - 1, shards, n_slots - (shards - 1) * 4096 FROM sharded),
based AS (SELECT *, floor(want / everything * width)::BIGINT AS base, want / everything * width AS expected FROM kinds WHERE high > low),
parted AS (SELECT *, floor((expected - base) * 1000000000)::BIGINT + 1 AS part FROM based),
drawn AS (
  SELECT *, greatest(0, width - sum(base) OVER (PARTITION BY kind))::BIGINT AS draws, (sum(part) OVER (PARTITION BY kind ORDER BY rank))::BIGINT AS upto,
         (sum(part) OVER (PARTITION BY kind))::BIGINT AS parts FROM parted),
sure AS (SELECT rank, unnest(range(low, high)) AS shard, base AS c FROM drawn),
lots AS (
  SELECT kind, shard, {_U} AS u FROM (
    SELECT kind, parts, shard, unnest(range(draws)) AS draw FROM (
      SELECT DISTINCT kind, parts, draws, unnest(range(low, high)) AS shard FROM drawn))),
extra AS (SELECT rank, shard, 1 AS c FROM lots JOIN drawn USING (kind) WHERE u >= upto - part AND u < upto),
counts AS (SELECT rank, shard, sum(c)::BIGINT AS c FROM (SELECT * FROM sure UNION ALL SELECT * FROM extra) GROUP BY ALL HAVING sum(c) > 0),
numbered AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY rank ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM counts),
slots AS (
  SELECT rank, blocks, j FROM (SELECT rank, first + unnest(range(c)) AS j FROM numbered) JOIN wanted USING (rank) WHERE j < blocks * 3),
{_permuted()},
picks AS (SELECT rank, p AS block, count(*) AS times FROM q{ROUNDS} GROUP BY ALL),
placed AS (
  SELECT id, rank, size, (coalesce(sum(size) OVER (PARTITION BY rank ORDER BY bucket, doc_id NULLS FIRST, size, id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start
  FROM (SELECT s.*, t.rank, {number('coalesce(doc_id & 9223372036854775807, 0)')} % (n_docs // 4096 + 1) AS bucket
        FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source)),
pieces AS (SELECT id, rank, start, size, unnest(range(start // 64, (start + size - 1) // 64 + 1)) AS block FROM placed WHERE size > 0),
taken AS (
  SELECT id, sum(times * (least(start + size, (block + 1) * 64) - greatest(start, block * 64)))::BIGINT AS taken
  FROM pieces JOIN picks USING (rank, block) GROUP BY id)
SELECT doc_id, s.source, size, source_size, target, coalesce(taken, 0) AS taken
FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN taken USING (id)
"""

_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

RANKED = rf"""
WITH items AS (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL),
q AS (SELECT item_id, term, count(*) AS times
      FROM (SELECT item_id, unnest(regexp_extract_all({_FOLD}, {_TERM})) AS term FROM items) GROUP BY ALL),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_FOLD}, {_TERM}) AS ws
         FROM documents WHERE doc_id IS NOT NULL),
sizes AS (SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n FROM docs WHERE len(ws) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
p AS (SELECT r, term, count(*) AS tf
      FROM (SELECT r, unnest(ws) AS term FROM docs) SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM p, total GROUP BY term, n_docs),
impacts AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS impact
            FROM p JOIN sizes USING (r) JOIN w USING (term), total),
scores AS (SELECT item_id, r, doc_id, CAST(sum(times * impact) AS BIGINT) AS score
           FROM q JOIN impacts USING (term) GROUP BY ALL),
best AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank,
                doc_id, score FROM scores WHERE score > 0)
SELECT * FROM best WHERE rank <= 20
"""
