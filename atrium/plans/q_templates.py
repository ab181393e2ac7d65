"""Queries of the task templates: all qualifying instances of every scene, with their answers."""

from pyspark.sql import functions as F

from atrium.functions import labels as L
from atrium.operators import objects as O
from atrium.operators import tasks
from atrium.operators import templates as T
from atrium.plans.label_sql import LAB, named
from atrium.plans.q_objects import ROOMED, r6, roomed
from atrium.plans.q_pairs import DISTRACTORS, SHAPED
from atrium.plans.q_tasks import REACH
from atrium.plans.q_views import BLOCKERS, TOUCH, placed, slabs
from atrium.plans.registry import query
from atrium.plans.scenes import scene

#: c2: candidate objects with centre, sides, volume and what their label is.
C2 = f"{LAB}, {ROOMED}, c2 AS (SELECT r.*, lab.* EXCLUDE (label), (min_x + max_x) / 2 AS cx, (min_y + max_y) / 2 AS cy, (min_z + max_z) / 2 AS cz, max_x - min_x AS dx, max_y - min_y AS dy, max_z - min_z AS dz, (max_x - min_x) * (max_y - min_y) * (max_z - min_z) AS v FROM roomed r JOIN lab USING (label))"
D3 = "SQRT(POW({a}.cx - {b}.cx, 2) + POW({a}.cy - {b}.cy, 2) + POW({a}.cz - {b}.cz, 2))"
SAME_ROOM = "a.scene_id = b.scene_id AND a.room_id = b.room_id"


def unit(p):
    return f"list_sort([{p}.dx / SQRT({p}.dx * {p}.dx + {p}.dy * {p}.dy + {p}.dz * {p}.dz), {p}.dy / SQRT({p}.dx * {p}.dx + {p}.dy * {p}.dy + {p}.dz * {p}.dz), {p}.dz / SQRT({p}.dx * {p}.dx + {p}.dy * {p}.dy + {p}.dz * {p}.dz)])"


def similar(most, ratio):
    return f"(list_distance({unit('a')}, {unit('b')}) <= {most} AND GREATEST(a.v, b.v) <= {ratio} * LEAST(a.v, b.v))"


def drawn(*keys):
    total = "17"
    for k in keys:
        total = f"(({total}) * 31 + ({k}) * 7919) % 1000003"
    return f"(({total}) % 100 < 40)"


def joined(name="choices"):
    return F.array_join(name, "|").alias(name)


@query(f"WITH {LAB}, {SHAPED}, {DISTRACTORS} SELECT object_id AS target_id, o.label AS gt_answer, o.label || '|' || string_agg(r.label, '|' ORDER BY rank) AS choices FROM ranked r JOIN {{objects}} o USING (object_id) WHERE rank <= 3 GROUP BY object_id, o.label")
def t01_category(spark, sf_dir):
    return T.category(roomed(spark, sf_dir)).select("target_id", "gt_answer", joined())


@query(f"""WITH {C2} SELECT a.object_id AS obj_a_id, b.object_id AS obj_b_id, CASE WHEN a.v > b.v THEN a.label ELSE b.label END AS gt_answer FROM c2 a JOIN c2 b ON {SAME_ROOM} AND a.object_id < b.object_id JOIN lp ON la = a.label AND lb = b.label
WHERE a.label <> b.label AND close AND NOT a.fine AND NOT b.fine AND a.v >= 0.02 AND b.v >= 0.02 AND GREATEST(a.v, b.v) / LEAST(a.v, b.v) BETWEEN 1.15 AND 1.5
AND NOT (a.label IN ({named(L.OBVIOUSLY_LARGE)}) AND b.label IN ({named(L.OBVIOUSLY_SMALL)})) AND NOT (b.label IN ({named(L.OBVIOUSLY_LARGE)}) AND a.label IN ({named(L.OBVIOUSLY_SMALL)}))""")
def t04_larger(spark, sf_dir):
    return T.larger(roomed(spark, sf_dir)).select("obj_a_id", "obj_b_id", "gt_answer")


REFERRED = f"""c2 a JOIN c2 b ON {SAME_ROOM} AND a.object_id < b.object_id JOIN lp ON la = a.label AND lb = b.label JOIN c2 s ON s.scene_id = a.scene_id AND s.room_id = a.room_id AND s.label <> a.label AND s.label <> b.label WHERE comparable"""


@query(f"""WITH {C2}, d AS (SELECT s.object_id AS subject_id, a.object_id AS ref_b_id, b.object_id AS ref_c_id, a.label AS al, b.label AS bl, {D3.format(a='s', b='a')} AS da, {D3.format(a='s', b='b')} AS db FROM {REFERRED}
AND NOT s.fine AND NOT a.fine AND NOT b.fine AND s.v >= 0.03 AND a.v >= 0.03 AND b.v >= 0.03 AND len(s.g) > 0 AND (list_has_any(s.g, list_concat(a.g, b.g)) OR (s.v >= 0.04 AND (s.mark OR s.v >= 0.12))))
SELECT subject_id, ref_b_id, ref_c_id, CASE WHEN da < db THEN al ELSE bl END AS gt_answer FROM d WHERE LEAST(da, db) >= 0.001 AND GREATEST(da, db) >= 1.3 * LEAST(da, db)""")
def t05_closer(spark, sf_dir):
    return T.closer(roomed(spark, sf_dir)).select("subject_id", "ref_b_id", "ref_c_id", "gt_answer")


@query(f"""WITH o AS (SELECT *, GREATEST(max_x - min_x, max_y - min_y) AS size FROM {{objects}} WHERE label IN ({named(L.MOVEABLE)})) SELECT portal_id, object_id, CASE WHEN width - size > 0 THEN 'yes' ELSE 'no' END AS gt_answer, ROUND(width - size, 6) AS margin
FROM {{portals}} JOIN o USING (scene_id) WHERE width BETWEEN 0.55 AND 2.5 AND size BETWEEN 0.3 AND 3.0 AND width - size BETWEEN -0.4 AND 0.6""")
def t06_clearance(spark, sf_dir):
    portals, objects = scene(spark, sf_dir, "portals", "objects")
    return T.clearance(portals, objects).select(F.col("bottleneck_0_id").alias("portal_id"), F.col("target_id").alias("object_id"), "gt_answer", r6(F.col("clearance_margin_m"), "margin"))


@query(f"""WITH {C2}, k0 AS (SELECT * FROM c2 WHERE NOT fine AND v >= 0.02), m AS (SELECT a.scene_id, a.object_id AS seed_id, b.object_id, b.label, b.cx, b.cy, ROUND(SQRT(POW(a.cx - b.cx, 2) + POW(a.cy - b.cy, 2)), 9) AS d FROM k0 a JOIN k0 b ON {SAME_ROOM} AND list_has_any(a.g, b.g)),
l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY scene_id, seed_id, label ORDER BY d, object_id) AS k FROM m WHERE d <= 2.8 OR object_id = seed_id), g AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY scene_id, seed_id ORDER BY d, object_id) AS j FROM l WHERE k = 1),
h AS (SELECT * FROM g WHERE j <= 5), s AS (SELECT scene_id, seed_id, COUNT(*) AS n, AVG(cx) AS mx, AVG(cy) AS my, VAR_POP(cx) AS a, VAR_POP(cy) AS c, COVAR_POP(cx, cy) AS b FROM h GROUP BY 1, 2),
r AS (SELECT s.*, (SELECT MAX(SQRT(POW(h.cx - s.mx, 2) + POW(h.cy - s.my, 2))) FROM h WHERE h.scene_id = s.scene_id AND h.seed_id = s.seed_id) AS radius, SQRT(POW(a - c, 2) / 4 + b * b) AS half, (a + c) / 2 AS mid FROM s)
SELECT seed_id, n, CASE WHEN CASE WHEN mid + half > 0 THEN SQRT(GREATEST(0.0, mid - half) / (mid + half)) ELSE 0 END < 0.1 THEN 'yes' ELSE 'no' END AS gt_answer FROM r WHERE n >= 3 AND ROUND(radius, 9) <= 2.2""")
def t08_straight_line(spark, sf_dir):
    return T.straight_line(roomed(spark, sf_dir)).select("seed_id", F.size("group_ids").cast("long").alias("n"), "gt_answer")


@query(f"""WITH {C2}, p AS (SELECT a.object_id AS a_id, b.object_id AS b_id FROM c2 a JOIN c2 b ON {SAME_ROOM} AND a.object_id < b.object_id JOIN lp ON la = a.label AND lb = b.label
WHERE close AND SQRT(POW(a.cx - b.cx, 2) + POW(a.cy - b.cy, 2)) <= 1.2 AND ABS(a.cz - b.cz) <= 0.8 AND (a.label = b.label OR {similar(0.16, 2.0)}))
SELECT a_id AS pair_a_id, b_id AS pair_b_id, 'multiple' AS gt_answer FROM p UNION ALL SELECT DISTINCT a_id, a_id, 'single' FROM p WHERE {drawn('a_id')}""")
def t11_single_or_multiple(spark, sf_dir):
    return T.single_or_multiple(roomed(spark, sf_dir)).select("pair_a_id", "pair_b_id", "gt_answer")


OCC = f"""{C2}, {BLOCKERS}, pr AS (SELECT a.scene_id, a.room_id, a.object_id AS occluder_id, b.object_id, b.label, b.v, b.dx, b.dy, b.dz, {D3.format(a='a', b='b')} AS far, a.cx + (a.cx - b.cx) / far * 1.5 AS px, a.cy + (a.cy - b.cy) / far * 1.5 AS py, CAST(0.8 AS DOUBLE) AS pz, b.cx AS tx, b.cy AS ty, b.cz AS tz,
  b.min_x, b.max_x, b.min_y, b.max_y, b.min_z, b.max_z FROM c2 a JOIN c2 b ON {SAME_ROOM} AND a.object_id <> b.object_id WHERE a.occ AND NOT b.flat AND NOT b.fine AND b.v >= 0.01 AND b.v <= 1.2 * a.v),
ok AS (SELECT * FROM pr v WHERE far >= 0.001 AND EXISTS (SELECT 1 FROM {{rooms}} r WHERE r.scene_id = v.scene_id AND px >= x0 AND px < x1 AND py >= y0 AND py < y1)
  AND NOT EXISTS (SELECT 1 FROM roomed o WHERE o.scene_id = v.scene_id AND ((v.px BETWEEN o.min_x AND o.max_x AND v.py BETWEEN o.min_y AND o.max_y AND v.pz BETWEEN o.min_z AND o.max_z) OR POW(v.px - (o.min_x + o.max_x) / 2, 2) + POW(v.py - (o.min_y + o.max_y) / 2, 2) < 0.04))),
cam AS (SELECT *, SQRT(POW(tx - px, 2) + POW(ty - py, 2) + POW(tz - pz, 2)) + 1e-8 AS size, (tx - px) / size AS gx, (ty - py) / size AS gy, (tz - pz) / size AS gz, SQRT(gx * gx + gy * gy) AS lev, gy / lev AS rx, -gx / lev AS ry, ry * gz AS ux, -rx * gz AS uy, rx * gy - ry * gx AS uz FROM ok),
cor AS (SELECT *, (x - px) * gx + (y - py) * gy + (z - pz) * gz AS depth, ROUND((200.0 - 160.0 * ((x - px) * rx + (y - py) * ry) / depth) * 1e6) / 1e6 AS u, ROUND((200.0 + 160.0 * ((x - px) * ux + (y - py) * uy + (z - pz) * uz) / depth) * 1e6) / 1e6 AS w FROM
  (SELECT *, UNNEST([min_z + LEAST(dz / 2 * 0.05, 0.05), max_z - LEAST(dz / 2 * 0.05, 0.05)]) AS z FROM (SELECT *, UNNEST([min_y + LEAST(dy / 2 * 0.05, 0.05), max_y - LEAST(dy / 2 * 0.05, 0.05)]) AS y FROM (SELECT *, UNNEST([min_x + LEAST(dx / 2 * 0.05, 0.05), max_x - LEAST(dx / 2 * 0.05, 0.05)]) AS x FROM cam)))),
fr AS (SELECT * FROM cor WHERE depth > 1e-6 AND u >= 0 AND u < 400 AND w >= 0 AND w < 400),
ray AS (SELECT s.occluder_id, s.object_id, s.x, s.y, s.z, {slabs()} FROM fr s JOIN bl b ON s.scene_id = b.scene_id AND s.object_id <> b.object_id WHERE NOT ({TOUCH})),
hid AS (SELECT occluder_id, object_id, COUNT(DISTINCT (x, y, z)) AS blocked FROM ray WHERE enter_ <= leave_ AND enter_ >= 0 AND leave_ * way > 0.001 AND enter_ * way <= way - GREATEST(0.001, 0.02 * way) GROUP BY 1, 2),
nf AS (SELECT occluder_id, object_id, COUNT(*) AS inside FROM fr GROUP BY 1, 2),
op AS (SELECT cam.scene_id, cam.room_id, occluder_id, object_id, cam.label FROM cam LEFT JOIN nf USING (occluder_id, object_id) LEFT JOIN hid USING (occluder_id, object_id) WHERE inside IS NULL OR COALESCE(blocked, 0) / inside >= 0.6)"""


def occluded(spark, sf_dir):
    objects, walls, rooms = scene(spark, sf_dir, "objects", "walls", "rooms")
    return T.occluded_pairs(roomed(spark, sf_dir), O.with_polygons(rooms), O.blockers_of(objects, walls))


@query(f"WITH {OCC} SELECT occluder_id, object_id FROM op")
def occluded_pairs(spark, sf_dir):
    return occluded(spark, sf_dir).select("occluder_id", "object_id")


@query(f"WITH {OCC} SELECT occluder_id AS front_id, object_id AS back_id, 'continuous' AS gt_answer FROM op")
def t13_continuous(spark, sf_dir):
    return T.continuous(occluded(spark, sf_dir)).select("front_id", "back_id", "gt_answer")


@query(f"""WITH {OCC}, dc AS (SELECT op.occluder_id, a.object_id, MIN(b.label) AS decoy FROM op JOIN c2 a USING (object_id) JOIN c2 b ON {SAME_ROOM} JOIN lp ON la = a.label AND lb = b.label
WHERE b.object_id <> a.object_id AND b.object_id <> op.occluder_id AND a.label <> b.label AND ({similar(0.25, 3.0)} OR confusable) GROUP BY 1, 2), w AS (SELECT op.*, decoy, {drawn('op.occluder_id', 'op.object_id')} AND decoy IS NOT NULL AS absent FROM op LEFT JOIN dc USING (occluder_id, object_id))
SELECT occluder_id, CASE WHEN NOT absent THEN object_id ELSE -1 END AS target_id, CASE WHEN absent THEN decoy ELSE label END AS target_label, CASE WHEN absent THEN 'no' ELSE 'yes' END AS gt_answer FROM w""")
def t17_hidden_exists(spark, sf_dir):
    return T.hidden_exists(occluded(spark, sf_dir), roomed(spark, sf_dir)).select("occluder_id", F.coalesce("target_id", F.lit(-1)).alias("target_id"), "target_label", "gt_answer")


@query(f"""WITH {OCC} SELECT DISTINCT op.occluder_id, op.object_id AS target_id, a.label AS gt_answer FROM op JOIN c2 a USING (object_id) JOIN c2 b ON {SAME_ROOM} JOIN lp ON la = a.label AND lb = b.label WHERE a.label <> b.label AND confusable""")
def t18_hidden_category(spark, sf_dir):
    return T.hidden_category(occluded(spark, sf_dir), roomed(spark, sf_dir)).select("occluder_id", "target_id", "gt_answer")


@query(f"WITH {OCC} SELECT occluder_id, object_id AS target_id, 'complete' AS gt_answer, 'complete|broken|partial' AS choices FROM op")
def t19_completeness(spark, sf_dir):
    return T.completeness(occluded(spark, sf_dir)).select("occluder_id", "target_id", "gt_answer", joined())


@query("""SELECT object_id AS target_id, CASE object_id % 9 WHEN 0 THEN 'left' WHEN 1 THEN 'back' ELSE 'top' END AS label_side, CASE WHEN object_id % 2 = 0 THEN 'text ' || object_id ELSE 'unknown' END AS gt_answer FROM {objects} WHERE object_id % 9 < 3""")
def t15_face_text(spark, sf_dir):
    k = F.col("object_id")
    side = F.when(k % 9 == 0, "left").when(k % 9 == 1, "back").when(k % 9 == 2, "top").when(k % 9 == 3, "front")
    rows = scene(spark, sf_dir, "objects")[0].withColumns({"label_side": side, "label_face_text": F.when(k % 2 == 0, F.concat(F.lit("text "), k.cast("string")))})
    return T.face_text(rows).select("target_id", "label_side", "gt_answer")


@query("SELECT DISTINCT scene_id, t AS template_id, r AS reason FROM {rooms}, (VALUES ('T14', 'needs front_normal'), ('T16', 'needs front_normal and front_back_diff_flag')) n(t, r)")
def t14_t16_unmet(spark, sf_dir):
    return T.unmet(scene(spark, sf_dir, "rooms")[0])


@query(f"""WITH {C2} SELECT a.object_id AS target_id, a.label AS gt_answer, a.label || '|' || ARG_MIN(b.label, b.object_id) AS choices FROM c2 a JOIN c2 b ON {SAME_ROOM} JOIN lp ON la = a.label AND lb = b.label
WHERE a.label <> b.label AND close AND NOT a.fine AND a.v >= 0.02 GROUP BY 1, 2""")
def t20_bearing_search(spark, sf_dir):
    return T.bearing_search(roomed(spark, sf_dir)).select("target_id", "gt_answer", joined())


@query(f"""WITH {C2}, d AS (SELECT s.object_id AS reference_id, a.object_id AS obj_a_id, b.object_id AS obj_b_id, a.label AS al, b.label AS bl, {D3.format(a='s', b='a')} AS da, {D3.format(a='s', b='b')} AS db FROM {REFERRED}
AND NOT s.fine AND s.v >= 0.04 AND (s.mark OR s.v >= 0.12) AND NOT a.fine AND NOT b.fine AND a.v >= 0.02 AND b.v >= 0.02)
SELECT reference_id, obj_a_id, obj_b_id, CASE WHEN da < db THEN al ELSE bl END AS gt_answer FROM d WHERE ABS(da - db) >= 0.4 AND LEAST(da, db) > 1e-6 AND GREATEST(da, db) >= 1.25 * LEAST(da, db)""")
def t21_nearest_of_two(spark, sf_dir):
    return T.nearest_of_two(roomed(spark, sf_dir)).select("reference_id", "obj_a_id", "obj_b_id", "gt_answer")


@query(f"""WITH {C2} SELECT portal_id, b.object_id AS target_id, b.label AS target_label, 'yes' AS gt_answer FROM {{portals}} p JOIN c2 b ON b.scene_id = p.scene_id AND b.room_id = p.room_b
UNION ALL SELECT DISTINCT portal_id, -1, a.label, 'no' FROM {{portals}} p JOIN c2 a ON a.scene_id = p.scene_id AND a.room_id = p.room_a WHERE EXISTS (SELECT 1 FROM c2 b WHERE b.scene_id = p.scene_id AND b.room_id = p.room_b)
AND NOT EXISTS (SELECT 1 FROM c2 b WHERE b.scene_id = p.scene_id AND b.room_id = p.room_b AND b.label = a.label)""")
def t23_next_room(spark, sf_dir):
    return T.next_room(scene(spark, sf_dir, "portals")[0], roomed(spark, sf_dir)).select("portal_id", F.coalesce("target_id", F.lit(-1)).alias("target_id"), "target_label", "gt_answer")


@query("""WITH b AS (SELECT v.view_id, p.portal_id, DEGREES(ATAN2((tx - px) * (p.y - py) - (ty - py) * (p.x - px), (tx - px) * (p.x - px) + (ty - py) * (p.y - py))) AS yaw FROM {views} v JOIN {rooms} r ON r.scene_id = v.scene_id AND px >= x0 AND px < x1 AND py >= y0 AND py < y1
JOIN {portals} p ON p.scene_id = v.scene_id AND p.room_a = r.room_id) SELECT view_id, portal_id, CASE WHEN ABS(yaw) <= 30 THEN 'ahead' WHEN ABS(yaw) >= 150 THEN 'behind' WHEN yaw > 0 THEN 'left' ELSE 'right' END AS gt_answer FROM b""")
def t24_door_direction(spark, sf_dir):
    return T.door_direction(scene(spark, sf_dir, "portals")[0], placed(spark, sf_dir)).select("view_id", "portal_id", "gt_answer")


HIDES = " OR ".join(f"(list_contains(o.g, '{g}') AND list_has_any(h.g, [{named(names)}]))" for g, names in L.HIDES.items())


@query(f"""WITH {C2}, nn AS (SELECT a.scene_id, a.label, a.object_id AS seed_id, b.object_id, b.cx, b.cy, b.cz, ROW_NUMBER() OVER (PARTITION BY a.scene_id, a.label, a.object_id ORDER BY ROUND(SQRT(POW(a.cx - b.cx, 2) + POW(a.cy - b.cy, 2)), 9), b.object_id) AS k FROM c2 a JOIN c2 b ON a.scene_id = b.scene_id AND a.label = b.label),
m AS (SELECT scene_id, label, seed_id, COUNT(*) AS n, AVG(cx) AS mx, AVG(cy) AS my, AVG(cz) AS mz, MIN(object_id) AS first_id, LIST(cx) AS xs, LIST(cy) AS ys FROM nn WHERE k <= 6 GROUP BY 1, 2, 3),
r AS (SELECT *, ROUND(list_max(list_transform(range(1, n + 1), lambda i: SQRT(POW(xs[i] - mx, 2) + POW(ys[i] - my, 2)))), 6) AS radius FROM m WHERE n >= 3),
t AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY scene_id, label ORDER BY radius, seed_id) AS k FROM r WHERE radius <= 2.0), h AS (SELECT t.*, f.room_id, f.g FROM t JOIN c2 f ON f.object_id = t.first_id WHERE k = 1),
o2 AS (SELECT h.scene_id, h.label, h.n, o.object_id AS occluder_id, SQRT(o.dx * o.dx + o.dy * o.dy + o.dz * o.dz) AS diag, SQRT(POW(o.cx - h.mx, 2) + POW(o.cy - h.my, 2) + POW(o.cz - h.mz, 2)) AS far FROM h JOIN c2 o ON o.scene_id = h.scene_id AND o.room_id = h.room_id AND o.label <> h.label WHERE {HIDES})
SELECT scene_id, label AS target_label, ARG_MIN(occluder_id, (ROUND(far - 0.15 * diag, 9), occluder_id)) AS occluder_id, CAST(n AS VARCHAR) AS gt_answer FROM o2 WHERE diag >= 0.6 AND far < 1.8 GROUP BY scene_id, label, n""")
def t26_hidden_count(spark, sf_dir):
    return T.hidden_count(roomed(spark, sf_dir)).select("scene_id", "target_label", "occluder_id", "gt_answer")


@query(f"""WITH {C2}, n AS (SELECT scene_id, room_id, label, COUNT(*) AS n FROM c2 GROUP BY 1, 2, 3) SELECT a.room_id AS zone_a_id, b.room_id AS zone_b_id, a.label AS target_label, EXISTS (SELECT 1 FROM {{portals}} p WHERE p.scene_id = a.scene_id AND ((p.room_a = a.room_id AND p.room_b = b.room_id) OR (p.room_b = a.room_id AND p.room_a = b.room_id))) AS connected,
CAST(a.n + b.n AS VARCHAR) AS gt_answer FROM n a JOIN n b ON a.scene_id = b.scene_id AND a.label = b.label AND a.room_id < b.room_id WHERE a.n <= 5 AND b.n <= 5""")
def t27_two_rooms(spark, sf_dir):
    return T.two_rooms(roomed(spark, sf_dir), tasks.room_edges(scene(spark, sf_dir, "portals")[0])).select("zone_a_id", "zone_b_id", "target_label", "connected", "gt_answer")


BESIDE = " OR ".join(f"(list_contains(a.g, '{x}') AND list_contains(b.g, '{y}')) OR (list_contains(a.g, '{y}') AND list_contains(b.g, '{x}'))" for x, y in L.BESIDE_GROUPS)


def rests(top, bottom):
    return f"(ov > 0.01 AND ABS({bottom}.max_z - {top}.min_z) < 0.08 AND {top}.label IN ({named(L.SUPPORTED)}) AND {bottom}.label IN ({named(L.SUPPORTS)}) AND {top}.dx * {top}.dy <= 0.75 * {bottom}.dx * {bottom}.dy)"


@query(f"""WITH {C2}, p AS (SELECT a.object_id AS a_id, b.object_id AS b_id, GREATEST(0.0, LEAST(a.max_x, b.max_x) - GREATEST(a.min_x, b.min_x)) * GREATEST(0.0, LEAST(a.max_y, b.max_y) - GREATEST(a.min_y, b.min_y)) AS ov,
CASE WHEN {rests('b', 'a')} THEN 'under' WHEN {rests('a', 'b')} THEN 'resting_on' WHEN SQRT(POW(GREATEST(0.0, a.min_x - b.max_x, b.min_x - a.max_x), 2) + POW(GREATEST(0.0, a.min_y - b.max_y, b.min_y - a.max_y), 2)) <= 0.2 AND ABS(a.min_z - b.min_z) < 0.1
 AND a.label IN ({named(L.BESIDE)}) AND b.label IN ({named(L.BESIDE)}) AND ({BESIDE}) AND ov <= 0.05 * LEAST(a.dx * a.dy, b.dx * b.dy) THEN 'beside' END AS rel FROM c2 a JOIN c2 b ON a.scene_id = b.scene_id AND a.object_id < b.object_id)
SELECT CASE WHEN rel = 'under' THEN b_id ELSE a_id END AS obj_a_id, CASE WHEN rel = 'under' THEN a_id ELSE b_id END AS obj_b_id, CASE WHEN rel = 'under' THEN 'resting_on' ELSE rel END AS gt_answer FROM p WHERE rel IS NOT NULL""")
def t29_contact(spark, sf_dir):
    return T.contact(roomed(spark, sf_dir)).select("obj_a_id", "obj_b_id", "gt_answer")


@query(f"""WITH RECURSIVE {REACH}, whole AS (SELECT DISTINCT r.scene_id, r.room_id AS start, o.room_id AS room FROM {{rooms}} r JOIN {{rooms}} o USING (scene_id)),
full_(scene_id, start, room) AS (SELECT scene_id, room_id, room_id FROM {{rooms}} UNION SELECT f.scene_id, f.start, e.dst FROM full_ f JOIN e ON f.scene_id = e.scene_id AND f.room = e.src)
SELECT f.start, f.room AS end_room, x.room_id AS excluded, CASE WHEN EXISTS (SELECT 1 FROM reach r WHERE r.scene_id = f.scene_id AND r.start = f.start AND r.blocked = x.room_id AND r.room = f.room) THEN 'yes' ELSE 'no' END AS gt_answer
FROM full_ f JOIN {{rooms}} x ON x.scene_id = f.scene_id WHERE f.start <> f.room AND x.room_id <> f.start AND x.room_id <> f.room AND EXISTS (SELECT 1 FROM full_ g WHERE g.scene_id = f.scene_id AND g.room = x.room_id)""")
def t32_without_passing(spark, sf_dir):
    portals, rooms = scene(spark, sf_dir, "portals", "rooms")
    edges = tasks.room_edges(portals)
    whole = tasks.reachable(edges, rooms.select("scene_id", F.col("room_id").alias("start"), F.lit(None).cast("bigint").alias("blocked")))
    return T.without_passing(whole, tasks.reachable(edges, tasks.starts(rooms))).select("start", F.col("end").alias("end_room"), "excluded", "gt_answer")


@query("""SELECT portal_id AS passage_id, a AS agent_type, CASE WHEN width >= w + 0.05 THEN 'yes' ELSE 'no' END AS gt_answer FROM {portals}, (VALUES ('wheelchair', 0.65::DOUBLE), ('person', 0.55), ('large_box', 0.8)) t(a, w) WHERE width BETWEEN 0.4 AND 2.5""")
def t33_passable(spark, sf_dir):
    return T.passable(scene(spark, sf_dir, "portals")[0]).select("passage_id", "agent_type", "gt_answer")
