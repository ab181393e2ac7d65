"""Queries over single objects and rooms."""

from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.functions import labels as L
from atrium.operators import objects as O
from atrium.plans.label_sql import LAB, named
from atrium.plans.registry import query
from atrium.plans.scenes import scene

#: Objects with the room that their centre is in: rectangles take their lower sides in.
ROOMED = """roomed AS (SELECT o.*, r.room_id FROM {objects} o JOIN {rooms} r ON o.scene_id = r.scene_id
  AND (min_x + max_x) / 2 >= x0 AND (min_x + max_x) / 2 < x1 AND (min_y + max_y) / 2 >= y0 AND (min_y + max_y) / 2 < y1)"""


def roomed(spark, sf_dir):
    objects, rooms = scene(spark, sf_dir, "objects", "rooms")
    return O.with_room(objects, O.with_polygons(rooms))


def r6(c, name):
    return F.round(c, 6).alias(name)


@query("""SELECT object_id, ROUND((min_x + max_x) / 2, 6) AS cx, ROUND((min_y + max_y) / 2, 6) AS cy, ROUND((min_z + max_z) / 2, 6) AS cz,
  ROUND((max_x - min_x) * (max_y - min_y) * (max_z - min_z), 6) AS volume, ROUND(GREATEST(max_x - min_x, max_y - min_y, max_z - min_z), 6) AS longest,
  ROUND(LEAST(max_x - min_x, max_y - min_y, max_z - min_z), 6) AS shortest, ROUND(GREATEST(max_x - min_x, max_y - min_y), 6) AS xy_max,
  ROUND((max_x - min_x) * (max_y - min_y), 6) AS footprint FROM {objects}""")
def object_dims(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    return o.select("object_id", *(r6(G.center(a), f"c{a}") for a in "xyz"), r6(G.volume(), "volume"), r6(G.longest(), "longest"), r6(G.shortest(), "shortest"), r6(G.xy_max_dim(), "xy_max"), r6(G.footprint(), "footprint"))


@query("SELECT object_id, label FROM {objects} WHERE LOWER(label) NOT IN ('lamp', 'table lamp', 'book')")
def valid_objects(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    return O.valid_objects(o).select("object_id", "label")


@query(f"SELECT scene_id, COUNT(*) AS n FROM {{objects}} WHERE LOWER(label) NOT IN ({named((*L.STRUCTURAL, *L.GENERIC))}) GROUP BY scene_id")
def candidate_objects(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    return O.candidate_objects(o).groupBy("scene_id").agg(F.count("*").alias("n"))


@query(f"""WITH {LAB}, v AS (SELECT object_id, fine, mark, (max_x - min_x) * (max_y - min_y) * (max_z - min_z) AS v FROM {{objects}} JOIN lab USING (label))
SELECT object_id, NOT fine AND v >= 0.04 AS meaningful, NOT fine AND v >= 0.04 AND (mark OR v >= 0.12) AS landmark FROM v""")
def landmarks(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    return o.select("object_id", O.is_meaningful(0.04).alias("meaningful"), O.is_landmark().alias("landmark"))


@query(f"WITH {LAB} SELECT label, array_to_string(list_sort(g), ',') AS groups, array_to_string(list_sort(ap), ',') AS looks, mark, occ FROM lab")
def label_group_table(spark, sf_dir):
    labels = O.candidate_objects(scene(spark, sf_dir, "objects")[0]).select("label").distinct()
    of = lambda table: F.array_join(F.array_sort(L.groups(F.col("label"), table)), ",")
    return labels.select("label", of(L.SEMANTIC).alias("groups"), of(L.APPEARANCE).alias("looks"), L.matches(F.col("label"), L.LANDMARK).alias("mark"), L.matches(F.col("label"), L.OCCLUDERS).alias("occ"))


REASONS = """d AS (SELECT object_id, label, max_x - min_x AS a, max_y - min_y AS b, max_z - min_z AS c FROM {objects}),
reasons AS (SELECT object_id, label, CASE WHEN label IN ('wall', 'floor', 'ceiling', 'room', 'lamp', 'table lamp', 'book', 'curtain', 'candle', 'rug') THEN 'blacklisted' WHEN LEAST(a, b, c) < 0.2 THEN 'too_small_side'
  WHEN GREATEST(a, b, c) > 0.9 THEN 'too_large' WHEN a * b * c < 0.1 THEN 'too_small_volume' WHEN LEAST(a, b, c) < 0.05 * GREATEST(a, b, c) THEN 'too_flat' END AS reason FROM d)"""


@query(f"WITH {REASONS} SELECT object_id, reason FROM reasons")
def object_filter_reason(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    return o.select("object_id", O.reject_reason(min_side=0.2, max_side=0.9).alias("reason"))


@query(f"""WITH {REASONS}, n AS (SELECT reason, label, COUNT(*) AS "count" FROM reasons WHERE reason IS NOT NULL GROUP BY reason, label),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY reason ORDER BY "count" DESC, label) AS rank FROM n) SELECT * FROM k WHERE rank <= 3""")
def reject_report(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    return O.reject_report(o.select("label", O.reject_reason(min_side=0.2, max_side=0.9).alias("reason")).where("reason IS NOT NULL"), 3)


@query(f"WITH {ROOMED} SELECT o.object_id, r.room_id FROM {{objects}} o LEFT JOIN roomed r USING (object_id)")
def assign_room(spark, sf_dir):
    objects, rooms = scene(spark, sf_dir, "objects", "rooms")
    centers = objects.withColumns({"cx": G.center("x"), "cy": G.center("y")})
    return O.assign_room(centers, O.with_polygons(rooms), "object_id", "cx", "cy").select("object_id", "room_id")


@query(f"""WITH {ROOMED} SELECT object_id, COUNT(*) OVER (PARTITION BY scene_id, label) = 1 AS unique_in_scene,
  COUNT(*) OVER (PARTITION BY scene_id, room_id, label) = 1 AS unique_in_room FROM roomed""")
def unique_objects(spark, sf_dir):
    return O.unique_objects(roomed(spark, sf_dir)).select("object_id", "unique_in_scene", "unique_in_room")


@query(f"WITH {ROOMED} SELECT scene_id, room_id, label, COUNT(*) AS n FROM roomed GROUP BY scene_id, room_id, label HAVING COUNT(*) >= 2")
def label_groups_min(spark, sf_dir):
    return roomed(spark, sf_dir).groupBy("scene_id", "room_id", "label").agg(F.count("*").alias("n")).where("n >= 2")


@query("SELECT label, COUNT(*) AS n, array_to_string(list_sort(LIST(object_id)), ',') AS ids FROM {objects} GROUP BY label")
def objects_by_category(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    return o.groupBy("label").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("object_id")).cast("array<string>"), ",").alias("ids"))


@query(f"""WITH {ROOMED}, c AS (SELECT scene_id, room_id, label, COUNT(*) AS n FROM roomed GROUP BY scene_id, room_id, label)
SELECT a.scene_id, a.label, a.room_id AS room_a, b.room_id AS room_b, a.n AS n_a, b.n AS n_b FROM c a JOIN c b
ON a.scene_id = b.scene_id AND a.label = b.label AND a.room_id < b.room_id WHERE a.n <= 12 AND b.n <= 12""")
def zone_counts(spark, sf_dir):
    return O.zone_counts(roomed(spark, sf_dir), 12)


NAMES = " UNION ALL ".join(f"SELECT {i} AS i, '{n}' AS name, [{named(words)}] AS words" for i, (n, words) in enumerate(L.ROOM_NAMES.items()))


@query(f"""WITH {ROOMED}, k AS ({NAMES}), l AS (SELECT scene_id, room_id, list_distinct(LIST(label)) AS l FROM roomed GROUP BY scene_id, room_id),
sc AS (SELECT scene_id, room_id, name, i, len(list_intersect(l, words)) AS s FROM l CROSS JOIN k),
best AS (SELECT scene_id, room_id, ARG_MIN(name, (-s, i)) AS name, MAX(s) AS s FROM sc GROUP BY 1, 2),
b AS (SELECT r.scene_id, r.room_id, CASE WHEN s >= 2 THEN name ELSE 'room ' || ROW_NUMBER() OVER (PARTITION BY r.scene_id ORDER BY r.room_id) END AS base FROM {{rooms}} r LEFT JOIN best USING (scene_id, room_id)),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY scene_id, base ORDER BY room_id) AS n, COUNT(*) OVER (PARTITION BY scene_id, base) AS m FROM b)
SELECT scene_id, room_id, CASE WHEN m > 1 THEN base || ' ' || n ELSE base END AS name FROM n""")
def room_names(spark, sf_dir):
    (rooms,) = scene(spark, sf_dir, "rooms")
    return O.room_names(roomed(spark, sf_dir), rooms)


@query("""SELECT r.scene_id, ROUND(MIN(x0), 6) AS x0, ROUND(MAX(x1), 6) AS x1, ROUND(MIN(y0), 6) AS y0, ROUND(MAX(y1), 6) AS y1, ANY_VALUE(o.top) AS top FROM {rooms} r
JOIN (SELECT scene_id, ROUND(MAX(max_z), 6) AS top FROM {objects} GROUP BY scene_id) o USING (scene_id) GROUP BY r.scene_id""")
def scene_bounds(spark, sf_dir):
    rooms, objects = scene(spark, sf_dir, "rooms", "objects")
    top = objects.groupBy("scene_id").agg(r6(F.max("max_z"), "top"))
    sides = rooms.groupBy("scene_id").agg(r6(F.min("x0"), "x0"), r6(F.max("x1"), "x1"), r6(F.min("y0"), "y0"), r6(F.max("y1"), "y1"))
    return sides.join(top, "scene_id")


MEMBERS = f"{ROOMED}, members AS (SELECT scene_id, room_id, label, object_id, (min_x + max_x) / 2 AS x, (min_y + max_y) / 2 AS y FROM roomed)"


def members(spark, sf_dir):
    return roomed(spark, sf_dir).select("scene_id", "room_id", "label", "object_id", G.center("x").alias("x"), G.center("y").alias("y"))


@query(f"""WITH {MEMBERS}, m AS (SELECT scene_id, room_id, label, AVG(x) AS mx, AVG(y) AS my FROM members GROUP BY scene_id, room_id, label),
d AS (SELECT members.*, mx, my, ROUND(SQRT((x - mx) * (x - mx) + (y - my) * (y - my)), 9) AS d FROM members JOIN m USING (scene_id, room_id, label))
SELECT scene_id, room_id, label, ROUND(MAX(d), 6) AS radius, ROUND(AVG(x), 6) AS mx, ROUND(AVG(y), 6) AS my FROM d GROUP BY scene_id, room_id, label""")
def group_shape(spark, sf_dir):
    out = O.group_shape(members(spark, sf_dir), ["scene_id", "room_id", "label"])
    return out.select("scene_id", "room_id", "label", r6(F.col("radius"), "radius"), r6(F.col("mx"), "mx"), r6(F.col("my"), "my"))


@query(f"""WITH {MEMBERS}, c AS (SELECT scene_id, room_id, label, VAR_POP(x) AS a, VAR_POP(y) AS c, COVAR_POP(x, y) AS b FROM members GROUP BY scene_id, room_id, label),
e AS (SELECT *, (a + c) / 2 AS m, SQRT((a - c) * (a - c) / 4 + b * b) AS h FROM c)
SELECT scene_id, room_id, label, ROUND(CASE WHEN m + h > 0 THEN SQRT(GREATEST(0.0, m - h) / (m + h)) ELSE 0.0 END, 5) AS ratio FROM e""")
def group_axis(spark, sf_dir):
    return O.group_axis(members(spark, sf_dir), ["scene_id", "room_id", "label"]).withColumn("ratio", F.round("ratio", 5))


@query("""SELECT v.view_id FROM {views} v WHERE NOT EXISTS (SELECT 1 FROM {objects} o WHERE o.scene_id = v.scene_id
  AND (px - (min_x + max_x) / 2) * (px - (min_x + max_x) / 2) + (py - (min_y + max_y) / 2) * (py - (min_y + max_y) / 2) < 0.04)""")
def far_from_objects(spark, sf_dir):
    views, objects = scene(spark, sf_dir, "views", "objects")
    return O.far_from_objects(views, objects, 0.2).select("view_id")


IN_ROOM = "EXISTS (SELECT 1 FROM {{rooms}} r WHERE r.scene_id = v.scene_id AND px >= x0 AND px < x1 AND py >= y0 AND py < y1)".replace("{{", "{").replace("}}", "}")
INSIDE = "o.scene_id = v.scene_id AND px BETWEEN min_x - {t} AND max_x + {t} AND py BETWEEN min_y - {t} AND max_y + {t} AND pz BETWEEN min_z - {t} AND max_z + {t}"


@query("SELECT v.view_id FROM {views} v WHERE " + IN_ROOM + " AND NOT EXISTS (SELECT 1 FROM {objects} o WHERE " + INSIDE.format(t=0.0) + ") AND NOT EXISTS (SELECT 1 FROM {objects} o WHERE o.scene_id = v.scene_id AND POW(px - (min_x + max_x) / 2, 2) + POW(py - (min_y + max_y) / 2, 2) < 0.04)")
def valid_positions(spark, sf_dir):
    views, rooms, objects = scene(spark, sf_dir, "views", "rooms", "objects")
    return O.valid_positions(views, O.with_polygons(rooms), objects).select("view_id")


@query("SELECT v.view_id FROM {views} v WHERE " + IN_ROOM + " AND NOT EXISTS (SELECT 1 FROM (SELECT * FROM {objects} UNION ALL BY NAME SELECT * FROM {walls}) o WHERE " + INSIDE.format(t=0.25) + ")")
def legal_positions(spark, sf_dir):
    views, rooms, objects, walls = scene(spark, sf_dir, "views", "rooms", "objects", "walls")
    return O.legal_positions(views, O.with_polygons(rooms), objects, walls, 0.25).select("view_id")


@query("SELECT scene_id, COUNT(*) AS n, COUNT(*) FILTER (label = 'wall') AS walls FROM (SELECT * FROM {objects} UNION ALL BY NAME SELECT * FROM {walls}) GROUP BY scene_id")
def all_blockers(spark, sf_dir):
    objects, walls = scene(spark, sf_dir, "objects", "walls")
    return O.blockers_of(objects, walls).groupBy("scene_id").agg(F.count("*").alias("n"), F.count_if(F.col("label") == "wall").alias("walls"))


@query("""WITH b AS (SELECT scene_id, MIN(min_x) AS ax, MAX(max_x) AS bx, MIN(min_y) AS ay, MAX(max_y) AS cy FROM {objects} GROUP BY scene_id)
SELECT v.view_id FROM {views} v JOIN b USING (scene_id) WHERE px BETWEEN ax - 0.5 AND bx + 0.5 AND py BETWEEN ay - 0.5 AND cy + 0.5
AND NOT EXISTS (SELECT 1 FROM {objects} o WHERE """ + INSIDE.format(t=0.0) + ")")
def pose_in_bounds(spark, sf_dir):
    views, objects = scene(spark, sf_dir, "views", "objects")
    bounds = objects.groupBy("scene_id").agg(F.min("min_x").alias("ax"), F.max("max_x").alias("bx"), F.min("min_y").alias("ay"), F.max("max_y").alias("cy"))
    within = views.join(bounds, "scene_id").where("px BETWEEN ax - 0.5 AND bx + 0.5 AND py BETWEEN ay - 0.5 AND cy + 0.5")
    return O.outside_boxes(within, objects, 0.0).select("view_id")


@query("""SELECT scene_id, object_id, 'object' AS kind, ROUND(max_x - min_x, 6) AS dx, ROUND(max_y - min_y, 6) AS dy FROM {objects}
UNION ALL SELECT scene_id, portal_id, 'portal', 0.1, ROUND(width, 6) FROM {portals}""")
def targets_with_portals(spark, sf_dir):
    objects, portals = scene(spark, sf_dir, "objects", "portals")
    return O.targets(objects, portals).select("scene_id", "object_id", "kind", r6(G.dim("x"), "dx"), r6(G.dim("y"), "dy"))


@query("""SELECT p.room_a, o.object_id, ROUND(width - LEAST(max_x - min_x, max_y - min_y), 6) AS margin FROM {portals} p JOIN {objects} o USING (scene_id)
WHERE o.label IN ('chair', 'table', 'sofa') AND width - LEAST(max_x - min_x, max_y - min_y) BETWEEN -0.4 AND 0.6""")
def clearance_pairs(spark, sf_dir):
    portals, objects = scene(spark, sf_dir, "portals", "objects")
    margin = F.col("width") - F.least(G.dim("x"), G.dim("y"))
    moveable = objects.where(F.col("label").isin("chair", "table", "sofa"))
    return portals.join(moveable, "scene_id").where(margin.between(-0.4, 0.6)).select("room_a", "object_id", r6(margin, "margin"))


@query(f"""WITH {ROOMED}, have AS (SELECT DISTINCT scene_id, room_id, label FROM roomed)
SELECT a.room_id AS room_a, b.room_id AS room_b, a.label FROM have a JOIN {{rooms}} b ON a.scene_id = b.scene_id AND a.room_id <> b.room_id
WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.scene_id = b.scene_id AND h.room_id = b.room_id AND h.label = a.label)""")
def absent_label_decoys(spark, sf_dir):
    (rooms,) = scene(spark, sf_dir, "rooms")
    have = roomed(spark, sf_dir).select("scene_id", "room_id", "label").distinct()
    a = have.withColumnRenamed("room_id", "room_a").join(rooms.select("scene_id", F.col("room_id").alias("room_b")), "scene_id").where("room_a <> room_b")
    return a.join(have.select("scene_id", F.col("room_id").alias("room_b"), "label"), ["scene_id", "room_b", "label"], "left_anti").select("room_a", "room_b", "label")


@query("SELECT object_id FROM {objects} EXCEPT ALL SELECT object_id FROM {objects} WHERE max_z - min_z >= 0.3")
def removed_objects(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    return o.select("object_id").exceptAll(o.where(G.dim("z") >= 0.3).select("object_id"))


@query("""SELECT object_id, ROUND(SQRT(SUM(d * d)), 6) AS d FROM (SELECT object_id, UNNEST([GREATEST(0.0, min_x - 3.0, 3.0 - max_x), GREATEST(0.0, min_y - 2.5, 2.5 - max_y), GREATEST(0.0, min_z - 0.8, 0.8 - max_z)]) AS d FROM {objects}) GROUP BY object_id""")
def point_box_distance(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    return o.select("object_id", r6(G.point_box_distance(F.lit(3.0), F.lit(2.5), F.lit(0.8)), "d"))


@query(f"WITH {ROOMED} SELECT object_id, ROUND(LEAST((min_x + max_x) / 2 - x0, x1 - (min_x + max_x) / 2, (min_y + max_y) / 2 - y0, y1 - (min_y + max_y) / 2), 6) AS d FROM roomed JOIN {{rooms}} USING (scene_id, room_id)")
def room_edge_distance(spark, sf_dir):
    (rooms,) = scene(spark, sf_dir, "rooms")
    poly = O.with_polygons(rooms).select("scene_id", "room_id", "poly")
    o = roomed(spark, sf_dir).withColumns({"cx": G.center("x"), "cy": G.center("y")}).join(poly, ["scene_id", "room_id"])

    def edge(i):
        a, b = F.get("poly", i), F.get("poly", (i + 1) % F.size("poly"))
        return G.segment_distance(F.col("cx"), F.col("cy"), a["x"], a["y"], b["x"], b["y"])

    return o.select("object_id", r6(F.array_min(F.transform(F.sequence(F.lit(0), F.size("poly") - 1), edge)), "d"))
