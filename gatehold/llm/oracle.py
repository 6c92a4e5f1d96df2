"""DuckDB SQL with the expected rows of the queries that SQL can express."""

from __future__ import annotations

OP10 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (
  SELECT doc_id, i, list_aggregate(words[i:i + 7], 'string_agg', ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM g) WHERE k > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM again, range(8) AS r(j) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
  FROM (SELECT doc_id, unnest(lines) AS line FROM w)),
passed AS (
  SELECT doc_id, sum(n) AS n FROM lines
  WHERE NOT (100 * (length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) > 20 * n
          OR 100 * (length(line) - length(replace(line, '!', ''))) > 30 * n
          OR (n < 4 AND NOT regexp_matches(line, '[.!?:;…"''”’»)\]][\x20\x09-\x0D]*$'))
          OR regexp_matches(lower(line), 'all rights reserved|click here|cookie policy|enable javascript|privacy policy|sign up for|subscribe to our|terms of service|terms of use'))
  GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(list_aggregate(words, 'string_agg', '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, coalesce(passed.n, 0) AS n_passed
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN passed USING (doc_id))
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * n_passed >= 50 * n_words AS kept
FROM m
"""

OP12 = """
WITH t AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS tokens, sha256('1:' || doc_id) AS h
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
d AS (
  SELECT *, len(tokens) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM d),
p AS (
  SELECT *, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle,
         array_to_string(tokens[b + 1:], '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


def _op13(rounds: int = 6) -> str:
    """Rounds written out one after another: a{r} assigns the parts to the entries of b{r}, b{r + 1} takes the means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min({{'d': d, 'e': e}}) AS m
  FROM (SELECT vec_id, parts.p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM parts JOIN b{r} ON parts.p = b{r}.p)
  GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""
s{r} AS MATERIALIZED (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
  FROM (SELECT p, m.e AS e, i, sum(x[i]) AS s, count(*) AS n FROM a{r}, range(1, 1 + len(x)) AS g(i) GROUP BY ALL)
  GROUP BY p, e),
b{r + 1} AS MATERIALIZED (
  SELECT b{r}.p, b{r}.e, coalesce(list_transform(s{r}.c, lambda y: CAST(y AS BIGINT)), b{r}.c) AS c
  FROM b{r} LEFT JOIN s{r} ON b{r}.p = s{r}.p AND b{r}.e = s{r}.e)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS x FROM kept, range(8) AS r(p)),
b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)),
{",".join(steps).strip()},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id),
books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), books
"""


ORACLE_SQL = {"op10_quality_rules": OP10, "op12_fill_in_middle": OP12, "op13_vector_codes": _op13()}
