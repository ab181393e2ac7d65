"""Queries of the view generators, two views a target, and SQL that draws and tests the same candidates."""

from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators import generators as V
from atrium.operators import objects as O
from atrium.plans.q_objects import ROOMED, roomed
from atrium.plans.registry import query
from atrium.plans.scenes import scene

N = 2
DRAWS = ", ".join(f"((s.key * 7919 + t.i * {m} + {104729 * k}) % 1000003) / 1000003.0::DOUBLE AS u{k}" for k, m in enumerate((618034, 754878, 569840), 1))
IN_ROOM = "r.scene_id = p.scene_id AND p.px >= r.x0 AND p.px < r.x1 AND p.py >= r.y0 AND p.py < r.y1"
VALID = f"""ok AS (SELECT p.* FROM pt p SEMI JOIN {{rooms}} r ON {IN_ROOM} ANTI JOIN {{objects}} o ON o.scene_id = p.scene_id AND (POW(p.px - (o.min_x + o.max_x) / 2, 2) + POW(p.py - (o.min_y + o.max_y) / 2, 2) < 0.2::DOUBLE * 0.2::DOUBLE
  OR (p.px BETWEEN o.min_x AND o.max_x AND p.py BETWEEN o.min_y AND o.max_y AND 0.8::DOUBLE BETWEEN o.min_z AND o.max_z)))"""
SHOWN = "key, i, ROUND(px, 6) AS px, ROUND(py, 6) AS py, ROUND(tx, 6) AS tx, ROUND(ty, 6) AS ty"
FIRST = f"SELECT {SHOWN} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY scene_id, key ORDER BY i) AS k FROM ok) WHERE k <= {N}"
PAIRS = f"""{ROOMED}, q AS (SELECT a.scene_id, (a.object_id * 1000003 + b.object_id) % 2147483647 AS key, (a.min_x + a.max_x) / 2 AS ax_, (a.min_y + a.max_y) / 2 AS ay_, (b.min_x + b.max_x) / 2 AS bx_, (b.min_y + b.max_y) / 2 AS by_,
  (ax_ + bx_) / 2 AS mx, (ay_ + by_) / 2 AS my, SQRT(POW(bx_ - ax_, 2) + POW(by_ - ay_, 2)) AS size FROM roomed a JOIN roomed b ON a.scene_id = b.scene_id AND a.room_id = b.room_id AND b.object_id = a.object_id + 1)"""
OBJECT = "SELECT scene_id, object_id AS key, (min_x + max_x) / 2 AS ox, (min_y + max_y) / 2 AS oy, ox AS lx, oy AS ly, 1.0::DOUBLE AS ex, 0.0::DOUBLE AS ey FROM {objects}"
GROUP = f"""{ROOMED}, g AS (SELECT scene_id, MIN(object_id) AS key, COUNT(*) AS n, AVG((min_x + max_x) / 2) AS ox, AVG((min_y + max_y) / 2) AS oy, ATAN2(2 * COVAR_POP((min_x + max_x) / 2, (min_y + max_y) / 2), VAR_POP((min_x + max_x) / 2) - VAR_POP((min_y + max_y) / 2)) / 2 AS turn
  FROM roomed GROUP BY scene_id, room_id, label)"""
PORTAL = "SELECT scene_id, portal_id AS key, x AS ox, y AS oy, x AS lx, y AS ly, {bx} AS ex, {by} AS ey, room_a AS wanted_id FROM {{portals}}"


def polar(source, dist, angles=(0, 360), signed="1", flip="1", keep="TRUE", before=""):
    """SQL of `generators.polar` over a source of targets."""
    sign = "CASE WHEN u3 < 0.5 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END"
    signed, flip = sign if signed == "u3" else "1", sign if flip == "u3" else "1"
    return f"""WITH {before + ', ' if before else ''}src AS ({source}), dr AS (SELECT s.*, t.i, {DRAWS} FROM src s, range({20 * N}) t(i)),
an AS (SELECT *, RADIANS({angles[0]}::DOUBLE + u1 * ({angles[1]}::DOUBLE - {angles[0]}::DOUBLE)) * {signed} AS angle, {dist[0]}::DOUBLE + u2 * ({dist[1]}::DOUBLE - {dist[0]}::DOUBLE) AS d, ex * {flip} AS cx, ey * {flip} AS cy FROM dr),
pt AS (SELECT * FROM (SELECT *, ox + d * (cx * COS(angle) - cy * SIN(angle)) AS px, oy + d * (cx * SIN(angle) + cy * COS(angle)) AS py, lx AS tx, ly AS ty FROM an) WHERE {keep}), {VALID} {FIRST}"""


def shown(views):
    return views.select("key", "i", *(F.round(c, 6).alias(c) for c in ("px", "py", "tx", "ty")))


def scenery(spark, sf_dir):
    rooms, objects = scene(spark, sf_dir, "rooms", "objects")
    return O.with_polygons(rooms), objects


def neighbours(spark, sf_dir):
    """Pairs of objects of one room with ids that follow each other: one row per object."""
    r = roomed(spark, sf_dir)
    keep = ("scene_id", "room_id")
    after = O.prefixed(r, "b_", keep).withColumn("before_", F.col("b_object_id") - 1)
    return O.prefixed(r, "a_", keep).withColumn("before_", F.col("a_object_id")).join(after, [*keep, "before_"])


def groups(spark, sf_dir):
    """Objects of one label in a room, each group with its least id as key."""
    r = roomed(spark, sf_dir).select("scene_id", "room_id", "label", "object_id", G.center("x").alias("x"), G.center("y").alias("y"))
    return r.join(r.groupBy("scene_id", "room_id", "label").agg(F.min("object_id").alias("key")), ["scene_id", "room_id", "label"])


def triples(spark, sf_dir):
    """Three objects of a room with ids that follow each other, as groups."""
    r = roomed(spark, sf_dir).select("scene_id", "room_id", "object_id", G.center("x").alias("x"), G.center("y").alias("y"))
    members = r.withColumn("key", F.explode(F.sequence(F.col("object_id") - 2, F.col("object_id"))))
    whole = members.groupBy("scene_id", "room_id", "key").agg(F.count("*").alias("n")).where("n = 3").select("scene_id", "room_id", "key")
    return members.join(whole, ["scene_id", "room_id", "key"])


@query(polar(OBJECT, (0.8, 3)))
def region_around_object(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("around_object", objects, rooms, objects, n=N))


MIDDLE = "SELECT *, mx AS ox, my AS oy, mx AS lx, my AS ly, {} AS ex, {} AS ey FROM q WHERE {}"
EAST = MIDDLE.format("1.0::DOUBLE", "0.0::DOUBLE", "TRUE")
ALONG = MIDDLE.format("(bx_ - ax_) / size", "(by_ - ay_) / size", "size >= 1e-6")


@query(polar(EAST, (0.8, 4), before=PAIRS))
def region_around_pair(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("around_pair", neighbours(spark, sf_dir), rooms, objects, n=N))


DA, DB = (f"SQRT(POW(px - {p}x_, 2) + POW(py - {p}y_, 2))" for p in "ab")


@query(polar(EAST, (0.8, 4), keep=f"{DA} >= 0.2 AND {DB} >= 0.2 AND ABS(LN({DA} / {DB})) <= 0.5", before=PAIRS))
def region_equidistant_to_pair(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("equidistant_to_pair", neighbours(spark, sf_dir), rooms, objects, n=N))


@query(polar(PORTAL.format(bx="nx", by="ny"), (0.3, 2), (-15, 15), flip="u3"))
def region_orthogonal_to_portal(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("orthogonal_to_portal", scene(spark, sf_dir, "portals")[0], rooms, objects, n=N))


@query(polar("SELECT *, ox AS lx, oy AS ly, COS(turn) AS ex, SIN(turn) AS ey FROM g WHERE n >= 2", (1, 4), (30, 75), signed="u3", before=GROUP))
def region_breaking_projection(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("view_breaking_projection", groups(spark, sf_dir), rooms, objects, n=N))


@query(polar("SELECT *, ox AS lx, oy AS ly, 1.0::DOUBLE AS ex, 0.0::DOUBLE AS ey FROM g", (1.5, 4), before=GROUP))
def region_with_separation(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("view_with_separation", groups(spark, sf_dir), rooms, objects, n=N))


TRIPLE = f"""{ROOMED}, g AS (SELECT a.scene_id, a.object_id AS key, AVG((b.min_x + b.max_x) / 2) AS ox, AVG((b.min_y + b.max_y) / 2) AS oy FROM roomed a JOIN roomed b ON a.scene_id = b.scene_id AND a.room_id = b.room_id AND b.object_id BETWEEN a.object_id AND a.object_id + 2 GROUP BY 1, 2 HAVING COUNT(*) = 3)"""


@query(polar("SELECT *, ox AS lx, oy AS ly, 1.0::DOUBLE AS ex, 0.0::DOUBLE AS ey FROM g", (0.8, 5), before=TRIPLE))
def region_of_triple(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("view_of_triple", triples(spark, sf_dir), rooms, objects, n=N, dist=(0.8, 5.0)))


@query(polar(ALONG, (1, 3), (30, 90), signed="u3", before=PAIRS))
def region_behind_front_object(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("behind_front_object", neighbours(spark, sf_dir), rooms, objects, n=N))


@query(polar("SELECT *, ax_ AS ox, ay_ AS oy, bx_ AS lx, by_ AS ly, (bx_ - ax_) / size AS ex, (by_ - ay_) / size AS ey FROM q WHERE size >= 1e-6", (0.5, 3), (-60, 60), before=PAIRS))
def region_around_occluder_back(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("around_occluder_back", neighbours(spark, sf_dir), rooms, objects, n=N))


@query(polar(ALONG, (0.5, 3), (0, 30), signed="u3", before=PAIRS))
def region_orthogonal_to_segment(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("orthogonal_to_segment", neighbours(spark, sf_dir), rooms, objects, n=N))


@query(polar(OBJECT.replace("1.0::DOUBLE AS ex, 0.0::DOUBLE AS ey", "0.0::DOUBLE AS ex, -1.0::DOUBLE AS ey"), (0.5, 2.5), (-45, 45)))
def region_behind_object_face(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    faces = objects.withColumns({"bx": F.lit(0.0), "by": F.lit(-1.0)})
    return shown(V.sample_region("behind_object_face", faces, rooms, objects, n=N))


OWN = "EXISTS (SELECT 1 FROM {rooms} r WHERE r.scene_id = own.scene_id AND r.room_id = wanted_id AND px >= r.x0 AND px < r.x1 AND py >= r.y0 AND py < r.y1)"


def own_room(sql):
    """The polar SQL with candidates in the wanted room alone."""
    return sql.replace("FROM an) WHERE TRUE)", f"FROM an) own WHERE {OWN})")


@query(own_room(polar(PORTAL.format(bx="1.0::DOUBLE", by="0.0::DOUBLE"), (0.5, 3))))
def region_near_portal_in_room(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    portals = scene(spark, sf_dir, "portals")[0].withColumn("wanted_id", F.col("room_a"))
    return shown(V.sample_region("near_portal_in_room_a", portals, rooms, objects, n=N))


@query(polar(PORTAL.format(bx="1.0::DOUBLE", by="0.0::DOUBLE"), (0.5, 2.5)))
def region_near_portal_facing(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    portals = scene(spark, sf_dir, "portals")[0].withColumn("wanted_id", F.lit(None).cast("long"))
    return shown(V.sample_region("near_portal_facing", portals, rooms, objects, n=N, dist=(0.5, 2.5)))


def placed(source, tx, ty, before=""):
    """SQL of `generators.places` over a source (scene_id, key, room bounds, mx, my)."""
    return f"""WITH {before + ', ' if before else ''}src AS ({source}), dr AS (SELECT s.*, t.i, {DRAWS} FROM src s, range({20 * N}) t(i)),
pt AS (SELECT *, {tx} AS tx, {ty} AS ty FROM (SELECT *, wx0 + u1 * (wx1 - wx0) AS px, wy0 + u2 * (wy1 - wy0) AS py FROM dr)), {VALID} {FIRST}"""


ROOM = "SELECT scene_id, room_id AS key, x0 AS wx0, x1 AS wx1, y0 AS wy0, y1 AS wy1, (x0 + x1) / 2 AS mx, (y0 + y1) / 2 AS my FROM {rooms}"
FAR = "SQRT(POW(mx - px, 2) + POW(my - py, 2)) > 0.1"


def room_rows(rooms):
    return rooms.select("scene_id", F.col("room_id").alias("key"), F.col("room_id").alias("wanted_id"))


@query(placed(ROOM, f"CASE WHEN {FAR} THEN mx ELSE px + COS(RADIANS(u3 * 360)) END", f"CASE WHEN {FAR} THEN my ELSE py + SIN(RADIANS(u3 * 360)) END"))
def region_inside_room(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("inside_room", room_rows(rooms), rooms, objects, n=N))


@query(placed(ROOM, "px + SIN(RADIANS(u3 * 360))", "py + COS(RADIANS(u3 * 360))"))
def region_room_positions(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("room_positions", room_rows(rooms), rooms, objects, n=N))


SECTOR = "SELECT o.scene_id, o.object_id AS key, (min_x + max_x) / 2 AS lx, (min_y + max_y) / 2 AS ly, x0 AS wx0, x1 AS wx1, y0 AS wy0, y1 AS wy1 FROM roomed o JOIN {rooms} r ON o.scene_id = r.scene_id AND o.room_id = r.room_id"
TURN = "RADIANS(-40.0::DOUBLE + u3 * 80.0::DOUBLE)"
DX, DY = (f"((l{a} - p{a}) / (SQRT(POW(lx - px, 2) + POW(ly - py, 2)) + 1e-9))" for a in "xy")


@query(placed(SECTOR, f"px + {DX} * COS({TURN}) - {DY} * SIN({TURN})", f"py + {DX} * SIN({TURN}) + {DY} * COS({TURN})", before=ROOMED))
def region_bearing_sector(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    rows = roomed(spark, sf_dir).select("scene_id", F.col("object_id").alias("key"), F.col("room_id").alias("wanted_id"), G.center("x").alias("lx"), G.center("y").alias("ly"))
    return shown(V.sample_region("bearing_sector_in_room", rows, rooms, objects, n=N))


@query(f"""WITH src AS ({OBJECT}), pt AS (SELECT *, ox + r * COS(a) AS px, oy + r * SIN(a) AS py, ox AS tx, oy AS ty FROM (SELECT src.*, q.i * 16 + t.i AS i, q.r, RADIANS(360.0::DOUBLE * t.i / 16) AS a FROM src, (VALUES (0, 0.8::DOUBLE), (1, 1.2), (2, 1.8), (3, 2.6), (4, 3.5)) q(i, r), range(16) t(i))), {VALID}
SELECT key, COUNT(*) AS n, CAST(SUM(i) AS BIGINT) AS total, ROUND(MIN(px), 6) AS px, ROUND(MAX(py), 6) AS py FROM ok GROUP BY scene_id, key""")
def anchor_rings(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    out = V.sample_region("anchor_rings", V.of_objects(objects), rooms, objects)
    return out.groupBy("scene_id", "key").agg(F.count("*").alias("n"), F.sum("i").alias("total"), F.round(F.min("px"), 6).alias("px"), F.round(F.max("py"), 6).alias("py")).drop("scene_id")


@query(f"""WITH src AS ({OBJECT}), dr AS (SELECT s.*, t.i, {DRAWS} FROM src s, range(8) t(i)), pt AS (SELECT *, ox + GREATEST(0.3::DOUBLE, 1.25::DOUBLE + u1 * 0.5::DOUBLE) * COS(RADIANS(45.0::DOUBLE * i)) AS px, oy + GREATEST(0.3::DOUBLE, 1.25::DOUBLE + u1 * 0.5::DOUBLE) * SIN(RADIANS(45.0::DOUBLE * i)) AS py, ox AS tx, oy AS ty FROM dr), {VALID} SELECT {SHOWN} FROM ok""")
def ring_positions(spark, sf_dir):
    rooms, objects = scenery(spark, sf_dir)
    return shown(V.sample_region("ring_positions", V.of_objects(objects), rooms, objects))


@query("SELECT view_id, t.i AS heading, ROUND(px + COS(RADIANS(45.0::DOUBLE * t.i)), 6) AS tx, ROUND(py + SIN(RADIANS(45.0::DOUBLE * t.i)), 6) AS ty FROM {views}, range(8) t(i)")
def eight_headings(spark, sf_dir):
    out = V.sample_region("eight_headings", scene(spark, sf_dir, "views")[0].select("view_id", "px", "py", "pz"))
    return out.select("view_id", "heading", F.round("tx", 6).alias("tx"), F.round("ty", 6).alias("ty"))


@query("""WITH n AS (SELECT a.view_id, t.i AS frame, t.i / 11.0::DOUBLE AS t, a.px AS ax, b.px AS bx, a.ty AS ay, b.ty AS by_ FROM {views} a JOIN {views} b ON a.scene_id = b.scene_id AND b.view_id = a.view_id + 1, range(12) t(i))
SELECT view_id, frame, ROUND((1 - t) * ax + t * bx, 6) AS px, ROUND((1 - t) * ay + t * by_, 6) AS ty FROM n""")
def preset_paths(spark, sf_dir):
    views = scene(spark, sf_dir, "views")[0].select("scene_id", "view_id", *V.VIEW)
    a, b = (O.prefixed(views, p, ("scene_id",)).withColumn("n_", F.col(f"{p}view_id") + k) for p, k in (("a_", 1), ("b_", 0)))
    return V.straight_path(a.join(b, ["scene_id", "n_"])).select(F.col("a_view_id").alias("view_id"), "frame", F.round("px", 6).alias("px"), F.round("ty", 6).alias("ty"))


PRESET_ROWS = ", ".join(f"('{n}', {x}::DOUBLE, {y}::DOUBLE, {z}::DOUBLE)" for n, (x, y, z) in V.PRESETS.items())


@query(f"""WITH d AS (SELECT preset, x / SQRT(x * x + y * y + z * z) AS dx, y / SQRT(x * x + y * y + z * z) AS dy, z / SQRT(x * x + y * y + z * z) AS dz FROM (VALUES {PRESET_ROWS}) t(preset, x, y, z)),
s AS (SELECT o.*, d.*, (min_x + max_x) / 2 AS cx, (min_y + max_y) / 2 AS cy, (min_z + max_z) / 2 AS cz, GREATEST(max_x - min_x, max_y - min_y, max_z - min_z) AS big, LEAST(CASE WHEN ABS(dx) >= 1e-9 THEN (max_x - min_x) / 2 / ABS(dx) ELSE 1e9 END, CASE WHEN ABS(dy) >= 1e-9 THEN (max_y - min_y) / 2 / ABS(dy) ELSE 1e9 END, CASE WHEN ABS(dz) >= 1e-9 THEN (max_z - min_z) / 2 / ABS(dz) ELSE 1e9 END) + GREATEST(0.001, 0.01 * big) AS begin_, GREATEST(0.2, 0.2 * big) AS step FROM {{objects}} o, d),
k AS (SELECT *, begin_ + t.i * step AS far, cx + dx * far AS px, cy + dy * far AS py, cz + dz * far AS pz, CASE WHEN ABS(dz) > 0.999999 THEN 1.0 ELSE -dy / SQRT(dx * dx + dy * dy) END AS rx, CASE WHEN ABS(dz) > 0.999999 THEN 0.0 ELSE dx / SQRT(dx * dx + dy * dy) END AS ry, -ry * dz AS ux, rx * dz AS uy, ry * dx - rx * dy AS uz FROM s, range(40) t(i)),
c AS (SELECT object_id, preset, i, far, px, py, pz, UNNEST([min_x, max_x, min_x, max_x, min_x, max_x, min_x, max_x]) - px AS x, UNNEST([min_y, min_y, max_y, max_y, min_y, min_y, max_y, max_y]) - py AS y, UNNEST([min_z, min_z, min_z, min_z, max_z, max_z, max_z, max_z]) - pz AS z, rx, ry, ux, uy, uz, dx, dy, dz FROM k),
f AS (SELECT object_id, preset, MIN(i) AS steps FROM (SELECT object_id, preset, i FROM c GROUP BY ALL HAVING BOOL_AND(x * -dx + y * -dy + z * -dz > 1e-6 AND ABS(160.0 * (x * rx + y * ry) / (x * -dx + y * -dy + z * -dz)) < 200 AND ABS(160.0 * (x * ux + y * uy + z * uz) / (x * -dx + y * -dy + z * -dz)) < 200)) GROUP BY 1, 2),
w AS (SELECT k.object_id, k.preset, k.i, f.steps, EXISTS (SELECT 1 FROM {{objects}} b WHERE b.scene_id = k.scene_id AND k.px BETWEEN b.min_x AND b.max_x AND k.py BETWEEN b.min_y AND b.max_y AND k.pz BETWEEN b.min_z AND b.max_z) AS inside, EXISTS (SELECT 1 FROM {{rooms}} r WHERE r.scene_id = k.scene_id AND k.px >= r.x0 AND k.px < r.x1 AND k.py >= r.y0 AND k.py < r.y1) AS home, far FROM k JOIN f ON f.object_id = k.object_id AND f.preset = k.preset AND k.i <= f.steps)
SELECT object_id, preset, steps, CASE WHEN BOOL_OR(inside) THEN 'blocked' WHEN NOT BOOL_AND(home) THEN 'outside' END AS reason, CASE WHEN NOT BOOL_OR(inside) AND BOOL_AND(home) THEN ROUND(MAX(far), 6) END AS far FROM w GROUP BY 1, 2, 3""")
def preset_views(spark, sf_dir):
    """Twenty preset views of each object; the SQL tries step by step."""
    rooms, objects = scenery(spark, sf_dir)
    out = V.preset_views(objects, rooms, objects)
    far = F.sqrt(sum(((F.col(f"p{a}") - F.col(f"t{a}")) * (F.col(f"p{a}") - F.col(f"t{a}")) for a in "xyz"), F.lit(0.0)))
    return out.select("object_id", "preset", F.col("steps").cast("long").alias("steps"), "reason", F.round(far, 6).alias("far"))
