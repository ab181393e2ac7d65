"""Queries of the validators of a first view, and of relations between views and objects."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators import objects as O
from atrium.operators import predicates as P
from atrium.operators import validators as N
from atrium.operators import views as V
from atrium.plans.q_views import OK, VIS, view_pairs_of, visibility
from atrium.plans.registry import query
from atrium.plans.scenes import scene

#: Each view with the first three objects it can see of its room (s, b and c; a stands for s) and its scene's first door.
FIELDS = ("px", "py", "pz", "cam_fx", "cam_fy", "cam_fz", "room_id")
SEEN = ("object_id", "n_visible", "occluded", "n_corners", "box_w", "box_h", "mean_u", "mean_v", *(f"{n}_{a}" for a in "xyz" for n in ("min", "max")))
HALF = "DEGREES(ATAN(1.25))"


def instances(spark, sf_dir):
    vis = visibility(spark, sf_dir).withColumn("k_", F.row_number().over(Window.partitionBy("scene_id", "view_id").orderBy("object_id")))
    first = {p: F.max(F.when(F.col("k_") == k, F.struct(*SEEN))).alias(p) for k, p in enumerate("sbc", 1)}
    rows = vis.where("k_ <= 3").groupBy("scene_id", "view_id", *FIELDS).agg(*first.values()).where("s IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL")
    flat = rows.select("scene_id", "view_id", *FIELDS, *(F.col(f"{p}.{c}").alias(f"{p}_{c}") for p in "sbc" for c in SEEN))
    doors = scene(spark, sf_dir, "portals")[0].groupBy("scene_id").agg(F.min(F.struct("portal_id", "x", "y", "room_a")).alias("d")).select("scene_id", F.col("d.x").alias("door_x"), F.col("d.y").alias("door_y"), F.col("d.room_a").alias("room_a"))
    return flat.join(doors, "scene_id")


def sees(p, corners, most):
    return f"({p}.n_visible >= {corners} AND {p}.occluded <= {most})"


def level(x, y):
    size = f"(SQRT(POW(s.gx, 2) + POW(s.gy, 2)) * SQRT(POW({x}, 2) + POW({y}, 2)))"
    return f"CASE WHEN SQRT(POW({x}, 2) + POW({y}, 2)) >= 1e-6 THEN DEGREES(ACOS(GREATEST(-1.0, LEAST(1.0, (s.gx * ({x}) + s.gy * ({y})) / {size})))) END"


def facing(nx, ny):
    return f"DEGREES(ACOS(GREATEST(-1.0, LEAST(1.0, ((s.px - s.cx) * {nx} + (s.py - s.cy) * {ny}) / s.distance))))"


def graded(x, most):
    return f"CASE WHEN {x} <= {most} THEN 1.0 - 0.5 * {x} / {most} END"


FACED = f"CASE WHEN door > {HALF} THEN NULL WHEN door <= 15 THEN 1.0 WHEN door <= 35 THEN 0.7 ELSE 0.5 END"
SCORES = {
    "target_invisible_at_init": f"CASE WHEN {sees('s', 2, 0.95)} OR {sees('s', 4, 0.3)} THEN NULL WHEN target IS NULL THEN CASE WHEN {sees('s', 1, 0.95)} THEN 0.6 ELSE 0.4 END WHEN NOT {sees('s', 1, 0.95)} THEN CASE WHEN target <= 50 THEN 0.8 ELSE 0.3 END WHEN target <= 20 THEN 1.0 WHEN target <= 35 THEN 0.7 WHEN target <= 50 THEN 0.4 ELSE 0.1 END",
    "portal_invisible_at_init": FACED,
    "target_invisible_from_room_a": f"CASE WHEN s.room_id <> room_a OR {sees('s', 3, 0.4)} THEN NULL ELSE {FACED} END",
    "max_both_pairs_visible_at_init": f"CASE WHEN {sees('s', 4, 0.3)} AND {sees('b', 4, 0.3)} AND {sees('c', 4, 0.3)} THEN NULL WHEN {sees('s', 3, 0.5)} AND {sees('s', 4, 0.3)} AND ({sees('b', 4, 0.3)} OR {sees('c', 4, 0.3)}) THEN 1.0 WHEN {sees('s', 3, 0.5)} THEN 0.7 ELSE [0.1, 0.3, 0.4, 0.4][1 + (s.n_corners > 0)::INT + (b.n_corners > 0)::INT + (c.n_corners > 0)::INT] END",
    "max_init_separation_frac": f"CASE WHEN s.n_corners = 0 OR b.n_corners = 0 THEN 0.3 ELSE {graded('SQRT(POW(s.mean_u - b.mean_u, 2) + POW(s.mean_v - b.mean_v, 2)) / 400', 0.25)} END",
    "min_init_occlusion_fraction": "CASE WHEN s.occluded >= 0.3 THEN 0.5 + 0.5 * s.occluded END",
    "max_init_back_angle_deg": graded(facing(0, 1), 70.0),
    "label_side_visible_at_init": "CASE WHEN COS(RADIANS(side)) > 0.5 THEN NULL ELSE 0.5 + 0.5 * ABS(COS(RADIANS(side))) END",
    "only_one_face_visible_at_init": "CASE WHEN ABS(COS(RADIANS(front))) >= 0.3 THEN ABS(COS(RADIANS(front))) END",
    "init_apparent_size_ratio_min": "CASE WHEN s.box_w * s.box_h > 1 AND b.box_w * b.box_h > 1 AND s.box_w * s.box_h / NULLIF(b.box_w * b.box_h, 0) BETWEEN 0.5 AND 2.5 THEN 1.0 - 0.5 * ABS(LN(s.box_w * s.box_h / NULLIF(b.box_w * b.box_h, 0)) - LN(1.25) / 2) / (LN(5.0) / 2) END",
    "min_projection_ambiguity_deg": graded("LEAST(east, 180 - east)", 40.0),
    "init_ordering_ambiguous": f"CASE WHEN apart IS NULL THEN 0.0 WHEN apart <= 8 THEN 1.0 - 0.5 * apart / 8 END",
    "max_init_lateral_angle_deg": "CASE WHEN pair IS NULL THEN 0.0 WHEN LEAST(pair, 180 - pair) <= 35 THEN 1.0 - 0.5 * LEAST(pair, 180 - pair) / 35 END",
    "path_portals_not_all_visible_at_init": f"CASE WHEN door <= {HALF} THEN 0.2 WHEN door > 150 THEN 0.4 ELSE 1.0 END",
    "passage_not_orthogonally_visible_at_init": "CASE WHEN door <= 15 THEN 0.3 WHEN door <= 30 THEN 0.4 ELSE 1.0 END",
}
LONG = "SQRT(POW({0}.cx - s.px, 2) + POW({0}.cy - s.py, 2))"
APART = f"CASE WHEN LEAST({LONG.format('s')}, {LONG.format('b')}) >= 1e-6 THEN DEGREES(ACOS(GREATEST(-1.0, LEAST(1.0, ((s.cx - s.px) * (b.cx - s.px) + (s.cy - s.py) * (b.cy - s.py)) / ({LONG.format('s')} * {LONG.format('b')}))))) END"


@query(f"""WITH {VIS}, k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY scene_id, view_id ORDER BY object_id) AS k FROM vis), d AS (SELECT scene_id, ARG_MIN(x, portal_id) AS dx, ARG_MIN(y, portal_id) AS dy, ARG_MIN(room_a, portal_id) AS room_a FROM {{portals}} GROUP BY 1),
a AS (SELECT s AS s, b AS b, c AS c, s.view_id, room_a, {level('s.cx - s.px', 's.cy - s.py')} AS target, {level('dx - s.px', 'dy - s.py')} AS door, {facing(1, 0)} AS side, {facing(0, 1)} AS front, {level('1', '0')} AS east, {APART} AS apart, {level('b.cx - s.cx', 'b.cy - s.cy')} AS pair
  FROM k s JOIN k b USING (scene_id, view_id) JOIN k c USING (scene_id, view_id) JOIN d USING (scene_id) WHERE s.k = 1 AND b.k = 2 AND c.k = 3),
t AS (SELECT view_id, {', '.join(f'{sql} AS {n}' for n, sql in SCORES.items())} FROM a)
SELECT view_id, {', '.join(f'ROUND({n}, 5) AS {n}' for n in SCORES)}, {' OR '.join(f'{n} IS NULL' for n in list(SCORES)[:6])} AS rejected, ROUND({' + '.join(list(SCORES)[:6])}, 5) AS score FROM t""")
def init_validators(spark, sf_dir):
    door, none = (F.col("door_x"), F.col("door_y")), F.lit(0.0)
    north, east = (none, F.lit(1.0), none), (F.lit(1.0), none, none)
    args = {
        "target_invisible_at_init": (True, "s_"), "portal_invisible_at_init": (True, *door), "target_invisible_from_room_a": (True, F.col("room_id") == F.col("room_a"), *door, "s_"),
        "max_both_pairs_visible_at_init": (False,), "max_init_separation_frac": (0.25, "s_", "b_"), "min_init_occlusion_fraction": (0.3, "s_"), "max_init_back_angle_deg": (70.0, north, "s_"),
        "label_side_visible_at_init": (False, east, "s_"), "only_one_face_visible_at_init": (True, north, "s_"), "init_apparent_size_ratio_min": (0.5, 2.5, "s_", "b_"),
        "min_projection_ambiguity_deg": (40.0, F.lit(1.0), none), "init_ordering_ambiguous": (True, "s_", "b_"), "max_init_lateral_angle_deg": (35.0, "s_", "b_"),
        "path_portals_not_all_visible_at_init": (True, *door), "passage_not_orthogonally_visible_at_init": (True, *door),
    }
    made = instances(spark, sf_dir).withColumns({f: N.VALIDATORS[f](*a) for f, a in args.items()})
    total = N.total_score({f: F.col(f) for f in list(args)[:6]} | {"unknown_field": F.lit(1.0)})
    return made.select("view_id", *(F.round(f, 5).alias(f) for f in args), total["rejected"].alias("rejected"), F.round(total["score"], 5).alias("score"))


@query(f"""WITH {VIS} SELECT view_id, label, ROUND(CASE WHEN COUNT(*) FILTER (n_visible >= 1 AND occluded <= 0.95) = 0 OR COUNT(*) FILTER (NOT (n_visible >= 3 AND occluded <= 0.4)) < 1 THEN NULL ELSE COUNT(*) FILTER (NOT (n_visible >= 3 AND occluded <= 0.4)) / COUNT(*) END, 5) AS score FROM vis GROUP BY 1, 2""")
def init_occluded_counts(spark, sf_dir):
    return visibility(spark, sf_dir).groupBy("view_id", "label").agg(F.round(N.VALIDATORS["min_init_occluded_count"](1), 5).alias("score"))


@query(f"""WITH {VIS}, z AS (SELECT view_id, label, BOOL_OR(n_visible >= 1 AND occluded <= 0.95) AS seen FROM vis GROUP BY 1, 2)
SELECT view_id, ROUND(CASE WHEN COUNT(*) FILTER (seen) = 0 OR COUNT(*) FILTER (NOT seen) < 2 THEN NULL ELSE COUNT(*) FILTER (NOT seen) / COUNT(*) END, 5) AS score FROM z GROUP BY 1""")
def init_hidden_zones(spark, sf_dir):
    """Zones are the labels of a view's room."""
    zones = visibility(spark, sf_dir).groupBy("view_id", "label").agg(F.bool_or(P.visible("", 1, 0.95)).alias("seen"))
    return zones.groupBy("view_id").agg(F.round(N.VALIDATORS["min_zones_invisible_at_init"](2, F.col("seen")), 5).alias("score"))


AXES = {"r": "{0}x * rx + {0}y * ry", "u": "{0}x * ux + {0}y * uy + {0}z * uz", "f": "{0}x * gx + {0}y * gy + {0}z * gz"}
REL = "CASE WHEN ABS(r) > 0.05 THEN CASE WHEN r > 0 THEN 'left' ELSE 'right' END END", "CASE WHEN ABS(f) > 0.05 THEN CASE WHEN f < 0 THEN 'front' ELSE 'back' END END", "CASE WHEN ABS(u) > 0.05 THEN CASE WHEN u > 0 THEN 'above' ELSE 'below' END END"


@query(f"""WITH {VIS}, q AS (SELECT * FROM vis WHERE {OK}), d AS (SELECT a.view_id, a.object_id AS a_id, b.object_id AS b_id, a.label AS a_label, b.label AS b_label, ROUND(SQRT(POW(a.cx - b.cx, 2) + POW(a.cy - b.cy, 2) + POW(a.cz - b.cz, 2)), 9) AS d, b.cx - a.cx AS ox, b.cy - a.cy AS oy, b.cz - a.cz AS oz, a.rx, a.ry, a.ux, a.uy, a.uz, a.gx, a.gy, a.gz FROM q a JOIN q b USING (view_id) WHERE a.object_id < b.object_id),
m AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY view_id ORDER BY d DESC, a_id, b_id) AS k FROM d), e AS (SELECT *, {', '.join(f'{t.format("o")} AS {n}' for n, t in AXES.items())} FROM m WHERE k = 1),
l AS (SELECT *, array_to_string(list_filter([{', '.join(REL)}], lambda x: x IS NOT NULL)[1:2], '-') AS rel FROM e)
SELECT view_id, a_id, b_id, rel, 'In the image, where is the ' || b_label || ' relative to the ' || a_label || '?' AS question FROM l WHERE rel <> ''""")
def relative_position_items(spark, sf_dir):
    """Of each view its two visible objects farthest from each other, and where the second is seen from the first."""
    vis = visibility(spark, sf_dir).where(P.visible())
    cams = [f"cam_{m}{a}" for m in "fru" for a in "xyz" if (m, a) != ("r", "z")]
    pairs = view_pairs_of(vis, *cams).withColumn("d_", F.round(G.center_distance("a_", "b_"), 9))
    rank = F.row_number().over(Window.partitionBy("scene_id", "view_id").orderBy(F.desc("d_"), "a_object_id", "b_object_id"))
    best = pairs.withColumn("k_", rank).where("k_ = 1")
    o = {a: G.center(a, "b_") - G.center(a, "a_") for a in "xyz"}
    on = lambda m: sum((o[a] * F.col(f"cam_{m}{a}") for a in "xyz" if (m, a) != ("r", "z")), F.lit(0.0))
    rel = best.withColumn("rel", G.relative_label(on("r"), on("u"), on("f"))).where("rel IS NOT NULL")
    return rel.select("view_id", F.col("a_object_id").alias("a_id"), F.col("b_object_id").alias("b_id"), "rel", F.concat(F.lit("In the image, where is the "), "b_label", F.lit(" relative to the "), "a_label", F.lit("?")).alias("question"))


@query("""WITH n AS (SELECT a.view_id, a.tx - a.px AS fx, a.ty - a.py AS fy, a.tz - a.pz AS fz, b.tx - b.px AS gx, b.ty - b.py AS gy, b.px - a.px AS dx, b.py - a.py AS dy, b.pz - a.pz AS dz FROM {views} a JOIN {views} b ON a.scene_id = b.scene_id AND b.view_id = a.view_id + 1),
c AS (SELECT *, SQRT(fx * fx + fy * fy + fz * fz) + 1e-8 AS fn, SQRT(fx * fx + fy * fy) AS ln, SQRT(dx * dx + dy * dy + dz * dz) AS n, (dx * fx + dy * fy + dz * fz) / fn AS f, (dx * fy - dy * fx) / ln AS r, (dx * -fx * fz + dy * -fy * fz) / (ln * fn) + dz * ln / fn AS u, DEGREES(ATAN2(fx * gy - fy * gx, fx * gx + fy * gy)) AS yaw, DEGREES(ATAN2(fx * dy - fy * dx, fx * dx + fy * dy)) AS toward FROM n)
SELECT view_id, ROUND(GREATEST(-100, LEAST(100, yaw)), 5) AS yaw, CASE WHEN ABS(toward) > 90 THEN CASE WHEN toward > 0 THEN 'LeftBack' ELSE 'RightBack' END WHEN toward > 0 THEN 'Left' ELSE 'Right' END AS side,
CASE WHEN n < 1e-6 THEN 'same' ELSE concat_ws('-', CASE WHEN ABS(u) / n >= 0.3 THEN CASE WHEN u > 0 THEN 'above' ELSE 'below' END END, CASE WHEN ABS(f) / n >= 0.3 THEN CASE WHEN f > 0 THEN 'front' ELSE 'back' END END, CASE WHEN ABS(r) / n >= 0.3 THEN CASE WHEN r > 0 THEN 'right' ELSE 'left' END END) END AS direction FROM c""")
def view_to_view(spark, sf_dir):
    """Each view and the next of its scene: turn, side and direction in the first one's axes."""
    views = V.with_camera(scene(spark, sf_dir, "views")[0])
    a, b = (O.prefixed(views, p, ("scene_id",)).withColumn("n_", F.col(f"{p}view_id") + k) for p, k in (("a_", 1), ("b_", 0)))
    d = {x: F.col(f"b_p{x}") - F.col(f"a_p{x}") for x in "xyz"}
    on = lambda m: sum((d[x] * F.col(f"a_cam_{m}{x}") for x in "xyz" if (m, x) != ("r", "z")), F.lit(0.0))
    yaw = G.yaw_between(*(F.col(f"{p}_cam_f{x}") for p in "ab" for x in "xy"))
    bearing = G.signed_yaw(F.col("a_cam_fx"), F.col("a_cam_fy"), d["x"], d["y"])
    return a.join(b, ["scene_id", "n_"]).select(F.col("a_view_id").alias("view_id"), F.round(yaw, 5).alias("yaw"), G.side_label(bearing).alias("side"), G.camera_direction(on("r"), on("u"), on("f")).alias("direction"))


@query("""WITH k AS (SELECT scene_id, view_id, CAST(ROUND_EVEN(px / 0.25, 0) AS BIGINT) AS x, CAST(ROUND_EVEN(py / 0.25, 0) AS BIGINT) AS y, CAST(ROUND_EVEN(pz / 0.25, 0) AS BIGINT) AS z, CAST(ROUND_EVEN(DEGREES(ATAN2(ty - py, tx - px)) / 15, 0) AS BIGINT) AS yaw FROM {views})
SELECT MIN(view_id) AS view_id, COUNT(*) AS n FROM k GROUP BY scene_id, x, y, z, yaw""")
def distinct_poses(spark, sf_dir):
    """Views of a scene with one rounded pose are one."""
    views = scene(spark, sf_dir, "views")[0]
    yaw = F.degrees(F.atan2(F.col("ty") - F.col("py"), F.col("tx") - F.col("px")))
    keyed = views.select("scene_id", "view_id", G.pose_key(F.col("px"), F.col("py"), F.col("pz"), yaw).alias("k")).select("scene_id", "view_id", *(F.col(f"k.{c}").cast("long").alias(c) for c in ("x", "y", "z", "yaw")))
    return keyed.groupBy("scene_id", "x", "y", "z", "yaw").agg(F.min("view_id").alias("view_id"), F.count("*").alias("n")).select("view_id", "n")
