"""Query op9: quality rules over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atrium.llm import quality
from atrium.llm.common import table


def verdicts(labels: DataFrame) -> DataFrame:
    """The least quality that a label gives each document."""
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), verdicts(table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *quality.FEATURES, "base_failed", "kept")


#: The same rules, crossed ratios and fitted threshold; crc32 comes from its rule, byte by byte, over distinct words.
OP9_SQL = r"""
WITH steps AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, COALESCE(text, '') AS text, (16 * (instr('0123456789abcdef', substr(md5(COALESCE(text, '')), 1, 1)) - 1) + instr('0123456789abcdef', substr(md5(COALESCE(text, '')), 2, 1)) - 1) % 8 AS fold FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
windows AS (SELECT doc_id, UNNEST(range(1, len(w) - 1)) AS i, UNNEST(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w WHERE len(w) >= 3),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM again, range(3) AS r(k) GROUP BY doc_id),
base AS (SELECT w.doc_id, w.w, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, COALESCE(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered c USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
tokens AS (SELECT doc_id, UNNEST(w) AS x, UNNEST(range(1, len(w) + 1)) AS i FROM w),
hexed AS (SELECT x, hex(encode(x)) AS h FROM (SELECT DISTINCT x FROM tokens)),
crcs AS (SELECT x, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda j: 16 * (instr('0123456789ABCDEF', substr(h, 2 * j + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(h, 2 * j + 2, 1)) - 1)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS c FROM hexed, steps),
hashed AS (SELECT doc_id, i, c, LEAD(c) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM tokens JOIN crcs USING (x)),
grams AS (SELECT doc_id, c % 65536 AS bucket FROM hashed UNION ALL SELECT doc_id, (c * 31 + after) % 65536 FROM hashed WHERE after IS NOT NULL),
verdicts AS (SELECT doc_id, MIN(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
every AS (SELECT bucket, COUNT(*) AS n FROM grams GROUP BY bucket),
parts AS (SELECT bucket, fold, COUNT(*) AS good FROM grams JOIN verdicts USING (doc_id) JOIN d USING (doc_id) WHERE quality = 1 GROUP BY bucket, fold),
goods AS (SELECT COALESCE(SUM(good), 0) AS good FROM parts),
shares AS (SELECT f.fold, (ANY_VALUE(goods.good) - COALESCE(SUM(p.good), 0)) / GREATEST((SELECT SUM(n) FROM every), 1)::DOUBLE AS share FROM goods, range(8) AS f(fold) LEFT JOIN parts p ON p.fold = f.fold GROUP BY f.fold),
whole AS (SELECT bucket, SUM(good) AS good FROM parts GROUP BY bucket),
ratios AS (SELECT e.bucket, s.fold, CASE WHEN share > 0 THEN LN((COALESCE(w.good, 0) - COALESCE(p.good, 0) + share) / (e.n + 1.0::DOUBLE) / share) ELSE 0 END AS ratio
  FROM every e CROSS JOIN shares s LEFT JOIN whole w ON w.bucket = e.bucket LEFT JOIN parts p ON p.bucket = e.bucket AND p.fold = s.fold),
scores AS (SELECT g.doc_id, AVG(ratio) AS score FROM grams g JOIN d USING (doc_id) JOIN ratios r ON r.bucket = g.bucket AND r.fold = d.fold GROUP BY g.doc_id),
known AS (SELECT FLOOR(score / 0.01::DOUBLE) AS step, COUNT(*) FILTER (quality = 1) AS good, COUNT(*) FILTER (quality <> 1) AS junk FROM judged JOIN scores USING (doc_id) JOIN verdicts USING (doc_id) WHERE NOT base_failed GROUP BY step),
sums AS (SELECT SUM(good) AS n_good, SUM(junk) AS n_junk FROM known),
cuts AS (SELECT step, (SUM(good) OVER (ORDER BY step) - good) * n_junk + (n_junk - SUM(junk) OVER (ORDER BY step) + junk) * n_good AS errors FROM known, sums),
best AS (SELECT MAX(step) AS last FROM cuts WHERE errors = (SELECT MIN(errors) FROM cuts)),
threshold AS (SELECT CASE WHEN COALESCE(n_good, 0) = 0 THEN -1e300 WHEN n_junk = 0 THEN (SELECT MIN(step) FROM known WHERE good > 0) * 0.01::DOUBLE
  ELSE (COALESCE((SELECT MAX(step + 1) FROM known WHERE step < last), last) + last) / 2 * 0.01::DOUBLE END AS least FROM sums, best)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND s.score >= least AS kept FROM judged j CROSS JOIN threshold LEFT JOIN scores s USING (doc_id)
"""
