"""DuckDB SQL for the queries that SQL can express over whole tables. The others are held
against plain versions in tests."""

from __future__ import annotations

_WORDS = (
    "list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '')"
)

_JACCARD = f"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (SELECT doc_id, {_WORDS} AS ws FROM lowered),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * o >= 85 * (p.n + q.n - o)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)"""

_WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS hex
  FROM pages),
bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
    lpad(bin(strpos('0123456789abcdef', hex[i]) - 1), 4, '0')), '') AS b FROM payloads),
placed AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first,
    array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
      1 + 16 * b[5 * i + 1]::INT + 8 * b[5 * i + 2]::INT + 4 * b[5 * i + 3]::INT
        + 2 * b[5 * i + 4]::INT + b[5 * i + 5]::INT]), '') AS payload_digest
  FROM bits)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, true AS intact
FROM placed"""

_REPEATS = f"""
WITH words AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(ws[s:s + 34], ' ') AS w
  FROM words, unnest(range(1, len(ws) - 33)) t(s)),
repeated AS (
  SELECT doc_id, s FROM windows
  WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
gone AS (
  SELECT doc_id, list(DISTINCT s + i) AS places FROM repeated, range(35) r(i) GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(len(places), 0) AS n_removed,
    list_filter(ws, lambda x, i: NOT list_contains(coalesce(places, []), i)) AS rest
  FROM words LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256 FROM kept"""

# Texts as hexadecimal digits: byte b of a text is digits 2b + 1 and 2b + 2.
_FACTORS = """
WITH texts AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
stretches AS (
  SELECT doc_id, len(x) // 2 AS n, 500 * c AS first, substr(x, 1000 * c + 1, 1198) AS y
  FROM texts, unnest(range(0, 1 + len(x) // 1000)) t(c)),
strings AS MATERIALIZED (
  SELECT doc_id, first + i AS s, md5_number(substr(y, 2 * i + 1, 200)) AS w
  FROM stretches, range(500) t(i) WHERE first + i + 100 <= n),
earliest AS (SELECT w, min({'doc_id': doc_id, 's': s}) AS one FROM strings GROUP BY w HAVING count(*) > 1),
late AS (
  SELECT doc_id, s FROM strings JOIN earliest USING (w) WHERE {'doc_id': doc_id, 's': s} <> one),
runs AS (
  SELECT doc_id, s, CASE WHEN s <= 100 + lag(s) OVER (PARTITION BY doc_id ORDER BY s) THEN 0 ELSE 1 END AS fresh
  FROM late),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM runs),
spans AS (SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM numbered GROUP BY ALL),
gaps AS (
  SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM spans
  UNION ALL SELECT doc_id, 0, min(a) FROM spans GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(x, 2 * a + 1, coalesce(2 * (b - a), len(x))), '' ORDER BY a, b) AS rest
  FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id),
counted AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(rest, x))) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)"""

_COLLOCATIONS = """
WITH lowered AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\n\v\f\r]')) AS piece FROM lowered),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces),
counts AS MATERIALIZED (
  SELECT lang, k, array_to_string(ws[s:s + k - 1], ' ') AS phrase, count(*) AS f
  FROM words, range(1, 6) x(k), unnest(range(1, len(ws) - k + 2)) t(s) GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
phrases AS MATERIALIZED (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM counts WHERE k > 1 AND f >= 100),
inner_ones AS (
  SELECT lang, array_to_string(ws[s:s + m - 1], ' ') AS phrase, max(a) AS most
  FROM phrases, range(2, 5) x(m), unnest(range(1, k - m + 2)) t(s) WHERE m < k GROUP BY ALL),
cuts AS (
  SELECT p.lang, p.phrase, p.a, n, c, f.f AS l, r.f AS r,
    CAST((1000::HUGEINT * p.a * n) // (f.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM phrases p LEFT JOIN inner_ones i ON i.lang = p.lang AND i.phrase = p.phrase
  JOIN totals ON totals.lang = p.lang, range(1, 5) x(c)
  JOIN counts f ON f.lang = p.lang AND f.phrase = array_to_string(p.ws[:c], ' ')
  JOIN counts r ON r.lang = p.lang AND r.phrase = array_to_string(p.ws[c + 1:], ' ')
  WHERE c < p.k AND (most IS NULL OR 100 * most < 100 * p.a)),
lowest AS (SELECT lang, phrase, a, n, min({'score': score, 'c': c, 'l': l, 'r': r}) AS cut FROM cuts GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, encode(phrase)) AS rank,
    phrase, a, cut.l AS l, cut.r AS r, CAST(n AS BIGINT) AS n, cut.score AS score
  FROM lowest)
SELECT * FROM ranked WHERE rank <= 2000"""


def _codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """All rounds written out: assignments a0 to a{rounds}, codebooks c0 to c{rounds}."""
    steps = [f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT vec_id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x
  FROM kept, range({parts}) t(p)),
c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS j, x AS y
  FROM cut WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, p, min({{'d': list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'j': j}}) AS best
  FROM cut JOIN c{r} USING (p) GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""
s{r} AS MATERIALIZED (
  SELECT p, best.j AS j, i, sum(x[i]) AS s, count(*) AS n
  FROM a{r} JOIN cut USING (vec_id, p), unnest(range(1, len(x) + 1)) t(i) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (
  SELECT p, j, coalesce(list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) FILTER (s IS NOT NULL), any_value(y)) AS y
  FROM c{r} LEFT JOIN s{r} USING (p, j) GROUP BY p, j)""")
    steps.append(f"""
done AS (
  SELECT vec_id, string_agg(printf('%02x', best.j), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM done JOIN kept USING (vec_id), books""")
    return ",".join(steps[:-1]) + "," + steps[-1]


def registered() -> dict[str, str]:
    return {
        "op5_jaccard_join": _JACCARD,
        "op6_warc": _WARC,
        "op9_substring_dedup": _REPEATS,
        "op11_previous_factors": _FACTORS,
        "op12_collocations": _COLLOCATIONS,
        "op13_vector_codes": _codes(),
    }
