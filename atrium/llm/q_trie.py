"""Query op13: the prefix trie of rebuilt conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atrium.llm import trie
from atrium.llm.common import materialize, remainder, table

#: So many neighbouring ids share the beginning of the first; a conversation takes 0 to 3 turns of it.
SHARED, MOST = 20, 4


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, members): turns (conv_id, own, at, digest, words) of the rebuilt conversations, and all conv_ids.

    A conversation begins with the first h turns of conversation c - c % 20 and goes on with its own after h.
    """
    turns = materialize(trie.turns_of(conversations), "numbered")
    members = turns.where("at = 1").select("conv_id")
    taken = members.select("conv_id", (F.col("conv_id") - F.col("conv_id") % SHARED).alias("base"), remainder("conv_id", MOST).alias("h"))
    first = turns.where((F.col("at") < MOST) & (F.col("conv_id") % SHARED == 0)).withColumnRenamed("conv_id", "base")
    begun = first.join(taken, "base").where("at <= h").select("conv_id", F.lit(0).alias("own"), "at", "digest", "words")
    rest = turns.where(F.col("at") > remainder("conv_id", MOST)).select("conv_id", F.lit(1).alias("own"), "at", "digest", "words")
    return materialize(begun.unionByName(rest), "rebuilt"), members


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = rebuilt(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(turns, members, order=("own", "at"))


#: The crc32 of an ASCII text `x`, byte by byte by a table that the recursion of the polynomial gives.
CRC_TABLE = "SELECT list(CAST(c AS BIGINT) ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))"


def crc32(x: str, tab: str) -> str:
    """SQL of the unsigned crc32 of the ASCII text x; tab is CRC_TABLE's list."""
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({x}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: xor(c >> 8, {tab}[CAST((xor(c, b) & 255) + 1 AS INT)])), 4294967295)"


OP13_SQL = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations WHERE conv_id IS NOT NULL),
b AS (SELECT conv_id, {crc32('CAST(conv_id AS VARCHAR)', 'tab')} % 4 AS h FROM (SELECT DISTINCT conv_id, crc.t AS tab FROM t, crc)),
s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS d, role, text FROM (
        SELECT b.conv_id, 0 AS own, pos, role, text FROM b JOIN t ON t.conv_id = b.conv_id - b.conv_id % 20 AND pos <= h
        UNION ALL SELECT b.conv_id, 1, pos, role, text FROM b JOIN t ON t.conv_id = b.conv_id AND pos > h)),
p AS (SELECT conv_id, d, d - 1 AS up, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
        list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS path FROM s
      UNION ALL SELECT conv_id, 0, -1, 0, [] FROM b),
n AS (SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS own FROM p GROUP BY path),
k AS (SELECT n.*, u.conv_id AS parent_conv_id, u.path AS up_path FROM n LEFT JOIN n u ON n.depth > 0 AND u.path = n.path[1:n.depth - 1] AND u.depth = n.depth - 1),
c AS (SELECT k.*, (SELECT count(*) FROM k x WHERE x.up_path = k.path) AS n_children FROM k),
e AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, max_by(path, d) AS path FROM p GROUP BY conv_id) GROUP BY path)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, c.parent_conv_id, c.n_convs, c.n_children,
       CAST((SELECT count(*) FROM c x WHERE x.n_children = 0 AND x.path[1:c.depth] = c.path) AS BIGINT) AS n_leaves,
       CAST((SELECT sum(x.own) FROM c x WHERE x.path[1:c.depth] = c.path) AS BIGINT) AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM c LEFT JOIN e ON e.path = c.path
"""
