"""Queries over pairs and groups of objects of one room."""

from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators import groups
from atrium.operators import objects as O
from atrium.functions import labels as L
from atrium.plans.label_sql import LAB
from atrium.plans.q_objects import ROOMED, r6, roomed
from atrium.plans.registry import query

CENTER = "(({p}min_{a} + {p}max_{a}) / 2)"


def sq(*axes):
    return " + ".join(f"(a.c{x} - b.c{x}) * (a.c{x} - b.c{x})" for x in axes)


def box_gap(*axes):
    return " + ".join(f"POW(GREATEST(0.0, a.min_{x} - b.max_{x}, b.min_{x} - a.max_{x}), 2)" for x in axes)


C = f"{ROOMED}, c AS (SELECT *, (min_x + max_x) / 2 AS cx, (min_y + max_y) / 2 AS cy, (min_z + max_z) / 2 AS cz, max_x - min_x AS dx, max_y - min_y AS dy, max_z - min_z AS dz FROM roomed)"
PAIRS = f"{C}, p AS (SELECT a.scene_id, a.room_id, a.object_id AS a_id, b.object_id AS b_id, a.label AS a_label, b.label AS b_label, SQRT({sq('x', 'y')}) AS xy, SQRT({sq('x', 'y', 'z')}) AS d3, SQRT({box_gap('x', 'y', 'z')}) AS gap, SQRT({box_gap('x', 'y')}) AS gap_xy, b.cx - a.cx AS ex, b.cy - a.cy AS ey, GREATEST(0.0, LEAST(a.max_x, b.max_x) - GREATEST(a.min_x, b.min_x)) * GREATEST(0.0, LEAST(a.max_y, b.max_y) - GREATEST(a.min_y, b.min_y)) AS overlap, a.dx AS adx, a.dy AS ady, a.dz AS adz, b.dx AS bdx, b.dy AS bdy, b.dz AS bdz FROM c a JOIN c b ON a.scene_id = b.scene_id AND a.room_id = b.room_id AND a.object_id < b.object_id)"


def pairs(spark, sf_dir):
    return O.object_pairs(roomed(spark, sf_dir))


@query(f"WITH {PAIRS} SELECT room_id, a_label, b_label, COUNT(*) AS n, ROUND(MIN(xy), 6) AS min_xy, ROUND(AVG(d3), 5) AS avg_3d, ROUND(MAX(gap), 6) AS max_gap, ROUND(MAX(gap_xy), 6) AS max_gap_xy, ROUND(SUM(overlap), 4) AS overlap FROM p GROUP BY room_id, a_label, b_label")
def object_pair_distances(spark, sf_dir):
    p = pairs(spark, sf_dir)
    return p.groupBy("room_id", "a_label", "b_label").agg(
        F.count("*").alias("n"), r6(F.min(G.xy_distance("a_", "b_")), "min_xy"), F.round(F.avg(G.center_distance("a_", "b_")), 5).alias("avg_3d"),
        r6(F.max(G.box_distance("a_", "b_")), "max_gap"), r6(F.max(G.box_distance("a_", "b_", ("x", "y"))), "max_gap_xy"), F.round(F.sum(G.overlap_xy("a_", "b_")), 4).alias("overlap"),
    )


@query(f"WITH {PAIRS}, q AS (SELECT a_id AS object_id, gap FROM p UNION ALL SELECT b_id, gap FROM p) SELECT object_id, ROUND(MIN(gap), 6) AS d FROM q GROUP BY object_id")
def nearest_object(spark, sf_dir):
    return O.nearest_object(pairs(spark, sf_dir)).select("object_id", r6(F.col("d"), "d"))


@query(f"WITH {PAIRS} SELECT room_id, ROUND(MAX(d3), 6) AS d FROM p GROUP BY room_id")
def farthest_pair(spark, sf_dir):
    return O.farthest_pair(pairs(spark, sf_dir)).select("room_id", r6(F.col("d"), "d"))


@query(f"""WITH {PAIRS} SELECT room_id, CASE WHEN ABS(ex) >= ABS(ey) THEN CASE WHEN ex >= 0 THEN 'east' ELSE 'west' END ELSE CASE WHEN ey >= 0 THEN 'north' ELSE 'south' END END AS relation, COUNT(*) AS n FROM p GROUP BY 1, 2""")
def axis_relations(spark, sf_dir):
    dx, dy = G.center("x", "b_") - G.center("x", "a_"), G.center("y", "b_") - G.center("y", "a_")
    return pairs(spark, sf_dir).groupBy("room_id", G.axis_relation(dx, dy).alias("relation")).agg(F.count("*").alias("n"))


COMPASS = "['east', 'northeast', 'north', 'northwest', 'west', 'southwest', 'south', 'southeast']"


@query(f"""WITH {PAIRS}, g AS (SELECT room_id, DEGREES(ATAN2(ey, ex)) AS a FROM p) SELECT room_id, {COMPASS}[CAST(FLOOR(CASE WHEN a < 0 THEN a + 360 ELSE a END / 45.0 + 0.5) AS INT) % 8 + 1] AS relation, COUNT(*) AS n FROM g GROUP BY 1, 2""")
def compass_relations(spark, sf_dir):
    dx, dy = G.center("x", "b_") - G.center("x", "a_"), G.center("y", "b_") - G.center("y", "a_")
    return pairs(spark, sf_dir).groupBy("room_id", G.compass8(dx, dy).alias("relation")).agg(F.count("*").alias("n"))


SIDES = "list_sort([{p}dx / SQRT({p}dx * {p}dx + {p}dy * {p}dy + {p}dz * {p}dz), {p}dy / SQRT({p}dx * {p}dx + {p}dy * {p}dy + {p}dz * {p}dz), {p}dz / SQRT({p}dx * {p}dx + {p}dy * {p}dy + {p}dz * {p}dz)])"
SHAPED = f"{PAIRS}, s AS (SELECT *, {SIDES.format(p='a')} AS sa, {SIDES.format(p='b')} AS sb FROM p), shaped AS (SELECT *, list_distance(sa, sb) AS shape FROM s)"


@query(f"""WITH {SHAPED} SELECT a_id, b_id, ROUND(shape, 6) AS shape FROM shaped WHERE shape <= 0.18 AND GREATEST(adx * ady * adz, bdx * bdy * bdz) <= 2.5 * LEAST(adx * ady * adz, bdx * bdy * bdz)""")
def similar_shapes(spark, sf_dir):
    return pairs(spark, sf_dir).where(G.similar_shape("a_", "b_")).select(F.col("a_object_id").alias("a_id"), F.col("b_object_id").alias("b_id"), r6(G.shape_distance("a_", "b_"), "shape"))


@query(f"WITH {LAB}, {PAIRS} SELECT a_label, b_label, comparable, close, COUNT(*) AS n FROM p JOIN lp ON a_label = la AND b_label = lb GROUP BY 1, 2, 3, 4")
def comparable_labels(spark, sf_dir):
    p = O.object_pairs(L.with_groups(roomed(spark, sf_dir)))
    return p.groupBy("a_label", "b_label", L.comparable().alias("comparable"), L.close().alias("close")).agg(F.count("*").alias("n"))


DISTRACTORS = """q AS (SELECT scene_id, a_id AS object_id, a_label AS me, b_label AS label, ROUND(shape, 9) AS shape FROM shaped WHERE a_label <> b_label UNION ALL SELECT scene_id, b_id, b_label, a_label, ROUND(shape, 9) FROM shaped WHERE a_label <> b_label),
m AS (SELECT scene_id, object_id, label, alike, MIN(shape) AS shape FROM q JOIN lp ON me = la AND label = lb WHERE confusable GROUP BY 1, 2, 3, 4),
o AS (SELECT *, BOOL_OR(alike) OVER (PARTITION BY scene_id, object_id) AS any_alike FROM m),
ranked AS (SELECT scene_id, object_id, label, ROW_NUMBER() OVER (PARTITION BY scene_id, object_id ORDER BY shape, label) AS rank FROM o WHERE alike OR NOT any_alike)"""


@query(f"WITH {LAB}, {SHAPED}, {DISTRACTORS} SELECT object_id, rank, label FROM ranked WHERE rank <= 3")
def distractor_labels(spark, sf_dir):
    return O.distractor_labels(roomed(spark, sf_dir)).select("object_id", "rank", "label")


@query(f"WITH {PAIRS}, q AS (SELECT a_id AS object_id, xy FROM p UNION ALL SELECT b_id, xy FROM p) SELECT object_id, ROUND(MIN(xy), 6) AS d FROM q GROUP BY object_id")
def nearest_in_cells(spark, sf_dir):
    return O.nearest_in_cells(roomed(spark, sf_dir)).select("object_id", r6(F.col("d"), "d"))


@query(f"""WITH {PAIRS}, n AS (SELECT * FROM p WHERE a_label <> b_label AND d3 <= 1.5)
SELECT x.a_id, x.b_id, y.b_id AS c_id, ROUND(GREATEST(x.d3, y.d3, z.d3), 6) AS spread FROM n x JOIN n y ON x.room_id = y.room_id AND x.b_id = y.a_id JOIN n z ON z.room_id = x.room_id AND z.a_id = x.a_id AND z.b_id = y.b_id""")
def object_triples(spark, sf_dir):
    t = O.near_triples(roomed(spark, sf_dir), 1.5)
    return t.select(F.col("a_object_id").alias("a_id"), F.col("b_object_id").alias("b_id"), F.col("c_object_id").alias("c_id"), r6(F.greatest("d_ab", "d_bc", "d_ac"), "spread"))


@query(f"""WITH {C} SELECT a.room_id, COUNT(*) AS n, ROUND(SUM((GREATEST(a.max_x, b.max_x) - LEAST(a.min_x, b.min_x)) * (GREATEST(a.max_y, b.max_y) - LEAST(a.min_y, b.min_y))), 3) AS area
FROM c a JOIN c b ON a.room_id = b.room_id AND a.object_id < b.object_id AND a.label = b.label GROUP BY 1""")
def union_boxes(spark, sf_dir):
    p = pairs(spark, sf_dir).where("a_label = b_label").select("room_id", *G.union_box("a_", "b_"))
    return p.groupBy("room_id").agg(F.count("*").alias("n"), F.round(F.sum(G.footprint()), 3).alias("area"))


BOXD = "ROUND(SQRT(" + " + ".join(f"POW(GREATEST(0.0, {{a}}.min_{x} - {{b}}.max_{x}, {{b}}.min_{x} - {{a}}.max_{x}), 2)" for x in "xyz") + "), 9)"
LONG = "GREATEST({0}.max_x - {0}.min_x, {0}.max_y - {0}.min_y, {0}.max_z - {0}.min_z)"


def group_sql(k):
    """SQL of all sets of k objects of a room, and why each is no group."""
    names = "abcde"[:k]
    pairs = [BOXD.format(a=p, b=q) for i, p in enumerate(names) for q in names[i + 1 :]]
    sizes = [LONG.format(n) for n in names]
    joins = " ".join(f"JOIN roomed {q} ON {q}.scene_id = {p}.scene_id AND {q}.room_id = {p}.room_id AND {q}.object_id > {p}.object_id" for p, q in zip(names, names[1:]))
    ratio = lambda some: f"GREATEST({', '.join(some)}) / (LEAST({', '.join(some)}) + 1e-12)"
    reach, grown = ("3.0", "TRUE") if k == 2 else ("2.0", " AND ".join(f"{ratio(sizes[:n])} <= 2.5" for n in range(2, k)))
    two = "WHEN big - small > 2.0 THEN 'dim_diff' ", "WHEN wide > LEAST(3.0, 1.5 * mean) THEN 'out_of_dyn_range' "
    more = two if k == 2 else ("", "")
    one = (lambda f, xs: f"{f}({', '.join(xs)})") if k > 2 else (lambda f, xs: xs[0])
    return f"""WITH {ROOMED}, s AS (SELECT {', '.join(f'{n}.object_id AS {n}_id' for n in names)}, {one('LEAST', pairs)} AS near, {one('GREATEST', pairs)} AS wide, GREATEST({', '.join(sizes)}) AS big, LEAST({', '.join(sizes)}) AS small, ({' + '.join(sizes)}) / {k} AS mean FROM roomed a {joins} WHERE {one('GREATEST', pairs)} <= {reach} AND {grown})
SELECT {" || '-' || ".join(f'{n}_id' for n in names)} AS members, ROUND(near, 6) AS nearest, ROUND(wide, 6) AS widest, CASE WHEN big / (small + 1e-12) > 2.5 THEN 'size_ratio' {more[0]}WHEN near < GREATEST(0.1, 0.2 * mean) THEN 'too_close' {more[1]}END AS reason FROM s"""


def group_rows(spark, sf_dir, k):
    return groups.object_groups(roomed(spark, sf_dir), k).select(F.array_join(F.col("members").cast("array<string>"), "-").alias("members"), r6(F.col("nearest"), "nearest"), r6(F.col("widest"), "widest"), "reason")


@query(group_sql(2))
def object_groups_of_two(spark, sf_dir):
    return group_rows(spark, sf_dir, 2)


@query(group_sql(3))
def object_groups_of_three(spark, sf_dir):
    return group_rows(spark, sf_dir, 3)


@query(f"SELECT LENGTH(members) - LENGTH(REPLACE(members, '-', '')) + 1 AS size, reason, COUNT(*) AS n, ROUND(MIN(nearest), 6) AS nearest FROM ({group_sql(4)}) GROUP BY 1, 2")
def object_groups_of_four(spark, sf_dir):
    """Counts by reject reason: sets of four are many."""
    return groups.object_groups(roomed(spark, sf_dir), 4).groupBy(F.size("members").cast("long").alias("size"), "reason").agg(F.count("*").alias("n"), r6(F.min("nearest"), "nearest"))
