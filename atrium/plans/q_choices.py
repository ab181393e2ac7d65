"""Queries of the answer-choice generators; right answers come from the given tables."""

from pyspark.sql import functions as F

from atrium.functions import choices as C
from atrium.operators import templates as T
from atrium.plans.registry import query
from atrium.plans.scenes import scene


def joined(c, name):
    return F.array_join(c, "|").alias(name)


def parts(spark, sf_dir):
    return scene(spark, sf_dir, "part")[0].select(F.col("p_partkey").alias("id"))


TWO = "CASE WHEN {a} = '{x}' THEN '{x}|{y}' ELSE '{y}|{x}' END"


@query("SELECT p_partkey AS id, " + ", ".join(TWO.format(a=f"(CASE WHEN p_partkey % 3 = 0 THEN '{y}' ELSE '{x}' END)", x=x, y=y) + f" AS {n}" for n, x, y in (("yes_no", "yes", "no"), ("same", "same", "different"), ("complete", "complete", "incomplete"), ("continuous", "continuous", "separate"))) + " FROM {part}")
def binary_choices(spark, sf_dir):
    p = parts(spark, sf_dir)
    answer = lambda x, y: F.when(F.col("id") % 3 == 0, y).when(F.col("id") % 3 == 1, x)  # noqa: E731  (a null answer is the first)
    kinds = (("yes_no", "binary_yes_no", "yes", "no"), ("same", "binary_same_different", "same", "different"), ("complete", "binary_complete_incomplete", "complete", "incomplete"), ("continuous", "binary_continuous_separate", "continuous", "separate"))
    return p.select("id", *(joined(C.build_choices(g, answer(x, y)), n) for n, g, x, y in kinds))


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN o_orderpriority || '|' || o_orderstatus ELSE o_orderstatus || '|' || o_orderpriority END AS pair FROM {orders}""")
def pair_choices(spark, sf_dir):
    a, b, k = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey")
    right = F.when(k % 2 == 0, a).otherwise(b)
    return scene(spark, sf_dir, "orders")[0].select(k.alias("id"), joined(C.build_choices("pair_from_triple", right, a, F.when(k % 7 != 0, b)), "pair"))


@query("""WITH d AS (SELECT object_id AS id, label, CASE object_id % 3 WHEN 0 THEN [] WHEN 1 THEN ['Bed', label, 'sofa', 'bed'] ELSE ['desk', 'chair', 'tv', 'box'] END AS given, ['bed', 'sofa', 'plant', 'lamp', 'sofa'] AS others FROM {objects}),
k AS (SELECT id, label, list_filter(given, lambda c: lower(c) <> lower(label)) AS kept, list_filter(others, lambda c: c <> label) AS rest FROM d)
SELECT id, label || '|' || CASE WHEN len(kept) > 0 THEN array_to_string(list_slice(CASE WHEN id % 3 = 1 AND len(kept) = 3 THEN kept ELSE kept END, 1, 3), '|') ELSE array_to_string(list_slice(CASE WHEN label = 'sofa' THEN ['bed', 'plant', 'lamp'] ELSE list_filter(['bed', 'sofa', 'plant', 'lamp'], lambda c: c <> label) END, 1, 3), '|') END AS choices FROM k""")
def label_choices(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    none = F.array().cast("array<string>")
    given = F.when(F.col("object_id") % 3 == 0, none).when(F.col("object_id") % 3 == 1, F.array(F.lit("Bed"), F.col("label"), F.lit("sofa"), F.lit("bed"))).otherwise(F.array(*map(F.lit, ("desk", "chair", "tv", "box"))))
    others = F.array(*map(F.lit, ("bed", "sofa", "plant", "lamp", "sofa")))
    return o.select(F.col("object_id").alias("id"), joined(C.build_choices("similar_aabb_labels", F.col("label"), given, others), "choices"))


def pool_sql(values, pool, default):
    answer = f"COALESCE(list_extract([{', '.join('NULL' if v is None else repr(v) for v in values)}], CAST(p_partkey % {len(values)} AS INT) + 1), '{default}')"
    return f"array_to_string(list_prepend({answer}, list_filter([{', '.join(repr(p) for p in pool)}], lambda x: x <> {answer})), '|')"


POOLS = {
    "directional_choices": (("left", "behind", "above", None), ("left", "right", "ahead", "behind")),
    "count_and_arrangement": (("single", "multiple", "row", None), ("single", "multiple")),
    "contact_relations": (("beside", "above", "inside", "touching"), ("touching", "resting_on", "beside", "above")),
    "config_shapes": (("ring", "row", "arc", None), ("row", "cluster", "ring", "L-shape")),
}


@query("SELECT p_partkey AS id, " + ", ".join(f"{pool_sql(v, p, p[0])} AS {n}" for n, (v, p) in POOLS.items()) + " FROM {part}")
def pool_choices(spark, sf_dir):
    at = lambda values: F.get(F.array(*map(F.lit, values)), (F.col("id") % len(values)).cast("int"))
    return parts(spark, sf_dir).select("id", *(joined(C.build_choices(n, at(v)), n) for n, (v, _) in POOLS.items()))


@query("""WITH c AS (SELECT o_orderkey AS id, CAST(o_orderkey % 7 AS INT) AS c FROM {orders})
SELECT id, CASE WHEN c = 6 THEN 'many' ELSE c || '|' || array_to_string(list_filter([c - 1, c + 1, c + 2], lambda x: x >= 0 AND x <> c), '|') END AS counts,
array_to_string(list_prepend(LEAST(c, 5), list_transform(list_slice(list_sort(list_transform(list_filter(range(6), lambda x: x <> LEAST(c, 5)), lambda x: [ABS(x - LEAST(c, 5)), x])), 1, 3), lambda p: p[2])), '|') AS near FROM c""")
def count_choices(spark, sf_dir):
    c = (F.col("o_orderkey") % 7).cast("int")
    return scene(spark, sf_dir, "orders")[0].select(F.col("o_orderkey").alias("id"), joined(C.build_choices("count_range", F.when(c == 6, "many").otherwise(c.cast("string"))), "counts"), joined(C.build_choices("neighbouring_counts", F.least(c, F.lit(5))), "near"))


@query("""WITH m AS (SELECT object_id AS id, CAST(ROUND(100 * max_z) AS INT) AS m FROM {objects}), v AS (SELECT id, m, list_distinct_ordered FROM (SELECT id, m, list_transform([0, 25, -25, 50, -50, 75, -75, 100], lambda d: GREATEST(m + d, 0)) AS l, list_filter(l, lambda x, i: list_position(l, x) = i) AS list_distinct_ordered FROM m))
SELECT id, array_to_string(list_transform(list_slice(list_distinct_ordered, 1, 4), lambda x: CASE WHEN x % 100 = 0 THEN CAST(x // 100 AS VARCHAR) WHEN x % 10 = 0 THEN (x // 100) || '.' || ((x % 100) // 10) ELSE (x // 100) || '.' || lpad(CAST(x % 100 AS VARCHAR), 2, '0') END || 'm'), '|') AS meters FROM v""")
def meter_choices(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    return o.select(F.col("object_id").alias("id"), joined(C.build_choices("meters", F.round("max_z", 2)), "meters"))


@query("""WITH d AS (SELECT p_partkey AS id, CAST(p_partkey % 191 AS INT) - 95 AS d FROM {part})
SELECT id, array_to_string(list_transform(list_slice(list_filter([d, d + 20, d - 20, d + 40, d - 40, d + 60, d - 60], lambda x: ABS(x) <= 100), 1, 4), lambda x: x || ' degrees'), '|') AS degrees FROM d""")
def degree_choices(spark, sf_dir):
    return parts(spark, sf_dir).select("id", joined(C.build_choices("degrees", (F.col("id") % 191 - 95).cast("double")), "degrees"))


@query("""SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'up-front|down-front|up-back|up' WHEN 1 THEN 'left|right|front|up' WHEN 2 THEN 'back-right|front-right|back-left|back' ELSE 'up-front-left|down-front-left|up-back-left|up-front-right' END AS directions FROM {part}""")
def direction_choices(spark, sf_dir):
    at = F.get(F.array(*map(F.lit, ("up-front", "left", "back-right", "up-front-left"))), (F.col("id") % 4).cast("int"))
    return parts(spark, sf_dir).select("id", joined(C.build_choices("direction_distractors", at), "directions"))


@query("""SELECT o_orderkey AS id, o_orderpriority || '|' || CASE o_orderkey % 3 WHEN 0 THEN 'None of the above|None of the above|None of the above' WHEN 1 THEN 'x|None of the above|None of the above' ELSE 'x|y|z' END AS padded,
CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority || '|p|q' END AS properties FROM {orders}""")
def text_choices(spark, sf_dir):
    k, right = F.col("o_orderkey"), F.col("o_orderpriority")
    none = F.array().cast("array<string>")
    others = F.when(k % 3 == 0, none).when(k % 3 == 1, F.array(F.lit("x"), right)).otherwise(F.array(*map(F.lit, ("x", "y", "z", "w"))))
    return scene(spark, sf_dir, "orders")[0].select(k.alias("id"), joined(C.build_choices("padded_text", right, others), "padded"), joined(C.build_choices("label_face_choices", F.when(k % 5 != 0, right), F.array(F.lit("p"), right, F.lit("q"))), "properties"))


@query("""WITH h AS (SELECT o_orderkey AS id, (11 * 31 + o_orderkey) % 1000003 AS t FROM {orders}), c AS (SELECT id, UNNEST(['a', 'b', 'c', 'd']) AS c, UNNEST([((t + i * 7919) * 104729) % 1000003 FOR i IN [1, 2, 3, 4]]) AS h, UNNEST([1, 2, 3, 4]) AS i FROM h)
SELECT id, string_agg(c, '|' ORDER BY h, i) AS shuffled FROM c GROUP BY id""")
def shuffled_choices(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), joined(T.shuffled(F.array(*map(F.lit, "abcd")), F.col("o_orderkey")), "shuffled"))
