"""Query op12: spelling variants of all words of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from atrium.llm import variants
from atrium.llm.common import table
from atrium.llm.q_trie import CRC_TABLE

#: One run in so many loses a code point.
MODULUS = 31


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"), MODULUS)


OP12_SQL = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
r AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY 1, 2),
b AS (SELECT r.*, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x, crc.t AS tab FROM r, crc),
h AS (SELECT run, k, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, length(x) // 2), lambda i: CAST(('0x' || x[2 * i + 1:2 * i + 2]) AS BIGINT))),
        lambda c, y: xor(c >> 8, tab[CAST((xor(c, y) & 255) + 1 AS INT)])), 4294967295) AS h FROM b),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT k, CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM h)
      WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
d AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, CAST(unnest(range(length(word))) AS INT) AS i FROM w)),
p AS (SELECT a.word, b.word AS other, b.n AS m FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT w.word, d.word, d.n FROM w JOIN d ON d.rest = w.word
      UNION SELECT d.word, w.word, w.n FROM w JOIN d ON d.rest = w.word),
s AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS best, max(m) AS best_n FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form, CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n FROM w LEFT JOIN s ON s.word = w.word),
t AS (SELECT word, word AS at_word, form AS nxt, 0 AS step FROM f UNION ALL SELECT t.word, f.word, f.form, step + 1 FROM t JOIN f ON f.word = t.nxt)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, t.at_word AS root FROM f JOIN t ON t.word = f.word AND t.nxt IS NULL
"""
