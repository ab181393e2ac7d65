"""Query op4: near duplicates among all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from atrium.llm.common import table
from atrium.llm.neardup import Settings, near_duplicates


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Settings(width=3, percent=85))


OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
classes AS (SELECT MIN(doc_id) AS rep, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
shingles AS (SELECT rep, n, UNNEST(s) AS g FROM classes),
links AS (
  SELECT a.rep AS x, b.rep AS y FROM shingles a JOIN shingles b ON a.g = b.g AND a.rep < b.rep
  WHERE 100 * LEAST(a.n, b.n) >= 85 * GREATEST(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * COUNT(*) >= 85 * (a.n + b.n - COUNT(*))),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT rep AS x, rep AS y FROM classes UNION SELECT r.x, l.y FROM reach r JOIN both_ways l ON r.y = l.x),
homes AS (SELECT x AS rep, MIN(y) AS component FROM reach GROUP BY x)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, COALESCE(h.component, d.doc_id) AS component_id, d.doc_id = COALESCE(h.component, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN homes h USING (rep)
"""
