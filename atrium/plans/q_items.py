"""Queries from template instances to task items: three tasks of each template and scene, as a run asks for."""

from pyspark.sql import functions as F

from atrium.functions import text as X
from atrium.operators import catalog as C
from atrium.operators import feasibility as E
from atrium.operators import objects as O
from atrium.operators import templates as T
from atrium.plans import q_templates, registry
from atrium.plans.q_generators import DRAWS
from atrium.plans.q_objects import roomed
from atrium.plans.q_views import BLOCKERS, CAMERA, CORNERED, RAYED
from atrium.plans.registry import query
from atrium.plans.scenes import ctes, scene

#: Tasks of a template and scene, and candidate views of a slot.
TASKS, VIEWS = 3, 8
FOLD = "4398046511093"


def wanted(spark, sf_dir):
    """The instances that a run takes, of four templates."""
    r = T.grouped(roomed(spark, sf_dir))
    made = [E.instances_of(T.category(r), "T01", ("target_id",)), E.instances_of(T.larger(r), "T04", ("obj_a_id", "obj_b_id")), E.instances_of(T.closer(r), "T05", ("subject_id", "ref_b_id", "ref_c_id")), E.instances_of(T.nearest_of_two(r), "T21", {"obj_a_id": "obj_a_id", "obj_b_id": "obj_b_id", "reference_id": "reference_id", "group_centroid_proxy": "reference_id"})]
    rows = made[0]
    for m in made[1:]:
        rows = rows.unionByName(m)
    return E.drawn_instances(rows, TASKS)


def planned(spark, sf_dir, upto):
    specs = C.parse()
    objects, rooms, walls = scene(spark, sf_dir, "objects", "rooms", "walls")
    return E.planned(wanted(spark, sf_dir), C.tables(spark, specs), specs, O.with_polygons(rooms), objects, O.blockers_of(objects, walls), VIEWS, upto)


def oracle(name):
    return registry.oracle(name)


def fold(number, *ids):
    total = str(number)
    for i in ids:
        total = f"((({total}) * 1000003 + {i}) % {FOLD})"
    return total


def of(template, ids, names, rows):
    """SQL of a template's instances with their bindings as lists."""
    key = fold(int(template[1:]), *(f"t.{i}" for i in ids))
    return f"SELECT o.scene_id, '{template}' AS template_id, {key} AS key, t.gt_answer, [{', '.join(repr(n) for n in names)}] AS names, [{', '.join('t.' + c for c in names.values())}] AS ids FROM ({rows}) t JOIN objects o ON o.object_id = t.{ids[0]}"


def same(*names):
    return {n: n for n in names}


#: The slots of the four templates and their predicates, as their specifications say them.
SLOTS = """sl(template_id, slot_id, place, quality, kind, named, near, far, low_z, high_z) AS (VALUES ('T01', 'identity_view', 0, NULL, '', ['target_id'], 1.0::DOUBLE, 3.0::DOUBLE, 1.0::DOUBLE, 1.8::DOUBLE), ('T04', 'equidistant_pair_view', 0, 'balance', 'even', ['obj_a_id', 'obj_b_id'], 0.8, 4.0, 0.8, 0.8),
  ('T05', 'AB_view', 0, NULL, '', ['subject_id', 'ref_b_id'], 0.8, 4.0, 0.8, 0.8), ('T05', 'AC_view', 1, NULL, '', ['subject_id', 'ref_c_id'], 0.8, 4.0, 0.8, 0.8), ('T21', 'comparison_view', 0, NULL, '', ['obj_a_id', 'obj_b_id', 'reference_id'], 0.8, 5.0, 0.8, 0.8)),
pr(template_id, slot_id, pred, kind, first, second, x, y) AS (VALUES ('T01', 'identity_view', 0, 'visible', 'target_id', NULL, 4.0::DOUBLE, 0.4::DOUBLE), ('T01', 'identity_view', 1, 'distance', 'target_id', NULL, 1.0, 3.0), ('T01', 'identity_view', 2, 'aspect', 'target_id', NULL, 0.3, NULL), ('T01', 'identity_view', 3, 'centered', 'target_id', NULL, 25, NULL), ('T01', 'identity_view', 4, 'scale', 'target_id', NULL, 0.08, 0.6),
  ('T04', 'equidistant_pair_view', 0, 'pair', 'obj_a_id', 'obj_b_id', 4, 0.3), ('T04', 'equidistant_pair_view', 1, 'aspect', 'obj_a_id', NULL, 0.25, NULL), ('T04', 'equidistant_pair_view', 2, 'aspect', 'obj_b_id', NULL, 0.25, NULL), ('T04', 'equidistant_pair_view', 3, 'distance', 'obj_a_id', NULL, 0.8, 4.0), ('T04', 'equidistant_pair_view', 4, 'distance', 'obj_b_id', NULL, 0.8, 4.0),
  ('T05', 'AB_view', 0, 'pair', 'subject_id', 'ref_b_id', 4, 0.3), ('T05', 'AB_view', 1, 'centered', 'subject_id', NULL, 40, NULL), ('T05', 'AC_view', 0, 'pair', 'subject_id', 'ref_c_id', 4, 0.3), ('T05', 'AC_view', 1, 'centered', 'subject_id', NULL, 40, NULL),
  ('T21', 'comparison_view', 0, 'pair', 'obj_a_id', 'obj_b_id', 4, 0.3), ('T21', 'comparison_view', 1, 'visible', 'reference_id', NULL, 2, 0.5), ('T21', 'comparison_view', 2, 'centered', 'reference_id', NULL, 40, NULL))"""


def chain():
    """SQL up to what every candidate view of a slot sees (vis) and which slots it meets (met)."""
    text = lambda name: oracle(name)
    union = " UNION ALL ".join((of("T01", ("target_id",), same("target_id"), text("t01_category")), of("T04", ("obj_a_id", "obj_b_id"), same("obj_a_id", "obj_b_id"), text("t04_larger")), of("T05", ("subject_id", "ref_b_id", "ref_c_id"), same("subject_id", "ref_b_id", "ref_c_id"), text("t05_closer")), of("T21", ("obj_a_id", "obj_b_id", "reference_id"), same("obj_a_id", "obj_b_id", "reference_id"), text("t21_nearest_of_two"))))
    valid = """SEMI JOIN rooms r ON r.scene_id = p.scene_id AND p.px >= r.x0 AND p.px < r.x1 AND p.py >= r.y0 AND p.py < r.y1 ANTI JOIN objects o ON o.scene_id = p.scene_id AND (POW(p.px - (o.min_x + o.max_x) / 2, 2) + POW(p.py - (o.min_y + o.max_y) / 2, 2) < 0.2::DOUBLE * 0.2::DOUBLE
  OR (p.px BETWEEN o.min_x AND o.max_x AND p.py BETWEEN o.min_y AND o.max_y AND p.pz BETWEEN o.min_z AND o.max_z))"""
    return f"""every AS ({union}), ti AS MATERIALIZED (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY scene_id, template_id ORDER BY (key * 7919) % 1000003, key) AS k FROM every) WHERE k <= {TASKS}),
bd AS (SELECT scene_id, template_id, key, UNNEST(names) AS name, UNNEST(ids) AS object_id FROM ti), {SLOTS},
tg AS (SELECT b.scene_id, b.template_id, b.key AS own, s.slot_id, ANY_VALUE(s.kind) AS kind, (b.key * 31 + ANY_VALUE(s.place)) % {FOLD} AS key, ANY_VALUE(near) AS near, ANY_VALUE(far) AS far, ANY_VALUE(low_z) AS low_z, ANY_VALUE(high_z) AS high_z, AVG((min_x + max_x) / 2) AS ox, AVG((min_y + max_y) / 2) AS oy,
  MAX((min_x + max_x) / 2) FILTER (name = s.named[1]) AS ax_, MAX((min_y + max_y) / 2) FILTER (name = s.named[1]) AS ay_, MAX((min_x + max_x) / 2) FILTER (name = s.named[2]) AS bx_, MAX((min_y + max_y) / 2) FILTER (name = s.named[2]) AS by_
  FROM bd b JOIN sl s ON s.template_id = b.template_id AND list_contains(s.named, b.name) JOIN objects o ON o.scene_id = b.scene_id AND o.object_id = b.object_id GROUP BY b.scene_id, b.template_id, b.key, s.slot_id),
dr AS (SELECT s.*, t.i, {DRAWS} FROM tg s, range({20 * VIEWS}) t(i)),
pt AS (SELECT *, ox + d * COS(a) AS px, oy + d * SIN(a) AS py, low_z + u3 * (high_z - low_z) AS pz, ox AS tx, oy AS ty, low_z + u3 * (high_z - low_z) AS tz FROM (SELECT *, RADIANS(u1 * 360.0::DOUBLE) AS a, near + u2 * (far - near) AS d FROM dr)),
po AS (SELECT *, SQRT(POW(px - ax_, 2) + POW(py - ay_, 2)) AS da, SQRT(POW(px - bx_, 2) + POW(py - by_, 2)) AS db FROM pt),
ev AS (SELECT * FROM po WHERE kind = '' OR (da >= 0.2 AND db >= 0.2 AND ABS(LN(da / db)) <= 0.5)),
cn AS MATERIALIZED (SELECT scene_id, template_id, own AS key, slot_id AS grp, i, px, py, pz, tx, ty, tz FROM (SELECT p.*, ROW_NUMBER() OVER (PARTITION BY p.scene_id, p.template_id, p.own, p.slot_id ORDER BY p.i) AS n FROM ev p {valid}) WHERE n <= {VIEWS})"""


def name(v="v"):
    return f"{v}.template_id || ':' || {v}.key || ':' || {v}.grp || ':' || {v}.i"


def looking(source, objects, out):
    """SQL of what the views of `source` see of (scene_id, template_id, key, grp, object_id) in `objects`, as `out`; rows have their view_id."""
    return f"""{out} AS MATERIALIZED (WITH vr AS MATERIALIZED (SELECT scene_id, {name('v')} AS view_id, template_id, key, grp, px, py, pz, tx, ty, tz, {CAMERA} FROM {source} v),
vo AS MATERIALIZED (SELECT vr.* EXCLUDE (template_id, key, grp), o.object_id, o.label, 0 AS room_id, min_x, max_x, min_y, max_y, min_z, max_z FROM vr JOIN {objects} w ON w.scene_id = vr.scene_id AND w.template_id = vr.template_id AND w.key = vr.key AND w.grp = vr.grp JOIN objects o ON o.scene_id = w.scene_id AND o.object_id = w.object_id), {CORNERED}, {RAYED} SELECT * FROM vis)"""


def met(source, tried, vis, out):
    """SQL of the slots (template_id, key, grp, slot_id in `tried`) met at the views of `source`, which see `vis`."""
    see = lambda p: f"LEFT JOIN {vis} {p} ON {p}.scene_id = v.scene_id AND {p}.view_id = {name()} AND {p}.object_id = {p}b.object_id"
    both = lambda c, o: f"(a.n_visible >= {c} AND a.occluded <= {o} AND b.n_visible >= {c} AND b.occluded <= {o})"
    return f"""{out} AS MATERIALIZED (WITH pv AS (SELECT v.scene_id, v.template_id, v.key, v.grp, v.i, t.slot_id, pr.kind, COALESCE(CASE pr.kind WHEN 'visible' THEN a.n_visible >= x AND a.occluded <= y WHEN 'pair' THEN {both('x', 'y')} WHEN 'distance' THEN a.distance BETWEEN x AND y
  WHEN 'aspect' THEN a.n_corners >= 4 AND LEAST(a.box_w, a.box_h) >= 0.001 AND LEAST(a.box_w, a.box_h) / GREATEST(a.box_w, a.box_h) >= x WHEN 'centered' THEN a.angle <= x WHEN 'scale' THEN a.n_corners >= 2 AND a.box_w * a.box_h / 160000.0 BETWEEN x AND y END, FALSE) AS ok,
  COALESCE(pr.kind = 'pair' AND {both(3, 0.4)} AND LEAST(a.distance, b.distance) >= 0.2 AND ABS(LN(a.distance / b.distance)) <= 0.5, FALSE) AS even FROM {source} v JOIN {tried} t ON t.scene_id = v.scene_id AND t.template_id = v.template_id AND t.key = v.key AND t.grp = v.grp JOIN pr ON pr.template_id = v.template_id AND pr.slot_id = t.slot_id
  LEFT JOIN bd ab ON ab.scene_id = v.scene_id AND ab.template_id = v.template_id AND ab.key = v.key AND ab.name = pr.first LEFT JOIN bd bb ON bb.scene_id = v.scene_id AND bb.template_id = v.template_id AND bb.key = v.key AND bb.name = pr.second {see('a')} {see('b')})
SELECT s.*, sl.place, k >= n AS ok, k >= 0.5 * n AS almost, CASE WHEN sl.quality = 'balance' THEN even ELSE k >= n END AS strict FROM (SELECT scene_id, template_id, key, grp, i, slot_id, COUNT(*) AS n, COUNT(*) FILTER (ok) AS k, BOOL_OR(even) AS even FROM pv GROUP BY ALL) s JOIN sl ON sl.template_id = s.template_id AND sl.slot_id = s.slot_id)"""


OWN = "tr AS (SELECT ti.scene_id, ti.template_id, key, a.slot_id AS grp, b.slot_id FROM ti JOIN sl a ON a.template_id = ti.template_id JOIN sl b ON b.template_id = ti.template_id), ob AS (SELECT DISTINCT t.scene_id, t.template_id, t.key, t.grp, b.object_id FROM tr t JOIN pr ON pr.template_id = t.template_id AND pr.slot_id = t.slot_id JOIN bd b ON b.scene_id = t.scene_id AND b.template_id = t.template_id AND b.key = t.key AND (b.name = pr.first OR b.name = pr.second))"


def feasible_sql():
    return f"""WITH {BLOCKERS}, {chain()}, {OWN}, {looking('cn', 'ob', 'vis')}, {met('cn', 'tr', 'vis', 'met')},
gd AS (SELECT scene_id, template_id, key, slot_id, COUNT(*) AS n FROM met WHERE ok AND grp = slot_id GROUP BY ALL)
SELECT ti.scene_id, ti.template_id, ti.key, COUNT(*) AS n_slots, COUNT(g.n) AS n_met, CAST(COALESCE(SUM(g.n), 0) AS BIGINT) AS n_views, ARG_MIN(sl.slot_id, place) FILTER (g.n IS NULL) AS missing
FROM ti JOIN sl ON sl.template_id = ti.template_id LEFT JOIN gd g ON g.scene_id = ti.scene_id AND g.template_id = ti.template_id AND g.key = ti.key AND g.slot_id = sl.slot_id GROUP BY ti.scene_id, ti.template_id, ti.key"""


def named(sql):
    """The SQL with the derived views that it stands on."""
    return sql.replace("objects o ", "{objects} o ").replace("rooms r ", "{rooms} r ")


@query(named(feasible_sql()))
def feasible_slots(spark, sf_dir):
    """Relational division: the instances every slot of which some candidate view meets, and what the others lack."""
    return planned(spark, sf_dir, "feasible")["feasible"]


SAME = "{0}.scene_id = {1}.scene_id AND {0}.template_id = {1}.template_id AND {0}.key = {1}.key"
#: Roles of the objects in validators, and which of them the first view shows.
ROLE = "ro(template_id, name, role, anchor) AS (VALUES ('T01', 'target_id', 1, TRUE), ('T04', 'obj_a_id', 1, TRUE), ('T04', 'obj_b_id', 2, TRUE), ('T05', 'subject_id', 1, TRUE), ('T05', 'ref_b_id', 2, FALSE), ('T05', 'ref_c_id', 3, FALSE), ('T21', 'obj_a_id', 1, TRUE), ('T21', 'obj_b_id', 2, TRUE), ('T21', 'reference_id', 3, TRUE))"
TURN = "DEGREES(ACOS(GREATEST(-1.0, LEAST(1.0, ((r1.cx - v.px) * (r2.cx - v.px) + (r1.cy - v.py) * (r2.cy - v.py)) / (SQRT(POW(r1.cx - v.px, 2) + POW(r1.cy - v.py, 2)) * SQRT(POW(r2.cx - v.px, 2) + POW(r2.cy - v.py, 2)))))))"


def free(z):
    """SQL conditions of a valid position p at height z."""
    return f"""SEMI JOIN rooms r ON r.scene_id = p.scene_id AND p.px >= r.x0 AND p.px < r.x1 AND p.py >= r.y0 AND p.py < r.y1 ANTI JOIN objects o ON o.scene_id = p.scene_id AND (POW(p.px - (o.min_x + o.max_x) / 2, 2) + POW(p.py - (o.min_y + o.max_y) / 2, 2) < 0.2::DOUBLE * 0.2::DOUBLE
  OR (p.px BETWEEN o.min_x AND o.max_x AND p.py BETWEEN o.min_y AND o.max_y AND {z} BETWEEN o.min_z AND o.max_z))"""


def first_sql():
    """CTEs up to fv, the best first view of each instance and how its candidates fared; after `chain`."""
    role = lambda k: f"LEFT JOIN rb r{k}b ON {SAME.format(f'r{k}b', 'v')} AND r{k}b.role = {k} LEFT JOIN visi r{k} ON r{k}.scene_id = v.scene_id AND r{k}.view_id = {name()} AND r{k}.object_id = r{k}b.object_id"
    shows = " OR ".join(f"COALESCE(r{k}b.anchor AND (r{k}.n_corners > 0 OR (r{k}.n_visible >= 1 AND r{k}.occluded <= 0.95)), FALSE)" for k in (1, 2, 3))
    seen = lambda k, n, o: f"COALESCE(r{k}.n_visible >= {n} AND r{k}.occluded <= {o}, FALSE)"
    with_b, with_c, clear = f"({seen(1, 4, 0.3)} AND {seen(2, 4, 0.3)})", f"({seen(1, 4, 0.3)} AND {seen(3, 4, 0.3)})", seen(1, 3, 0.5)
    partial = " + ".join(f"CASE WHEN COALESCE(r{k}.n_corners, 0) > 0 THEN 1 ELSE 0 END" for k in (1, 2, 3))
    ratio = "((r1.box_w * r1.box_h) / (r2.box_w * r2.box_h))"
    return f"""{ROLE}, rb AS (SELECT b.scene_id, b.template_id, b.key, ro.role, ro.anchor, b.object_id, (min_x + max_x) / 2 AS cx, (min_y + max_y) / 2 AS cy, (min_z + max_z) / 2 AS cz FROM bd b JOIN ro ON ro.template_id = b.template_id AND ro.name = b.name JOIN objects o ON o.scene_id = b.scene_id AND o.object_id = b.object_id),
an AS (SELECT scene_id, template_id, key, ROUND(AVG(cx), 9) AS cx, ROUND(AVG(cy), 9) AS cy, ROUND(AVG(cz), 9) AS cz FROM rb WHERE anchor GROUP BY ALL),
rd AS (SELECT s.*, t.i, {DRAWS} FROM (SELECT *, room_id AS key FROM rooms) s, range(260) t(i)), rp AS (SELECT scene_id, key AS room_id, i, x0 + u1 * (x1 - x0) AS px, y0 + u2 * (y1 - y0) AS py FROM rd),
rs AS (SELECT * FROM (SELECT p.*, ROW_NUMBER() OVER (PARTITION BY p.scene_id, p.room_id ORDER BY p.i) AS n FROM rp p {free('0.8::DOUBLE')}) WHERE n <= 13),
rg AS (SELECT an.*, q.i * 16 + t.i AS i, cx + q.r * COS(RADIANS(360.0::DOUBLE * t.i / 16)) AS px, cy + q.r * SIN(RADIANS(360.0::DOUBLE * t.i / 16)) AS py FROM an, (VALUES (0, 0.8::DOUBLE), (1, 1.2), (2, 1.8), (3, 2.6), (4, 3.5)) q(i, r), range(16) t(i)),
iv AS MATERIALIZED (SELECT scene_id, template_id, key, 'init' AS grp, i, px, py, 0.8::DOUBLE AS pz, cx AS tx, cy AS ty, cz AS tz FROM (SELECT an.*, rs.room_id * 1000 + rs.i AS i, rs.px, rs.py FROM an JOIN rs USING (scene_id) UNION ALL SELECT scene_id, template_id, key, cx, cy, cz, 1000000000000000 + i, px, py FROM rg p {free('0.8::DOUBLE')}) WHERE SQRT(POW(cx - px, 2) + POW(cy - py, 2)) >= 1e-6),
ib AS (SELECT DISTINCT scene_id, template_id, key, 'init' AS grp, object_id FROM bd), it AS (SELECT ti.scene_id, ti.template_id, key, 'init' AS grp, slot_id FROM ti JOIN sl ON sl.template_id = ti.template_id),
{looking('iv', 'ib', 'visi')}, {met('iv', 'it', 'visi', 'imet')},
isc AS (SELECT v.scene_id, v.template_id, v.key, v.i, ({shows}) AS shown, CASE v.template_id WHEN 'T04' THEN COALESCE(r1.box_w * r1.box_h <= 1 OR r2.box_w * r2.box_h <= 1 OR {ratio} NOT BETWEEN 0.7 AND 1.4, TRUE) WHEN 'T05' THEN {with_b} AND {with_c} WHEN 'T21' THEN COALESCE({TURN} > 8, FALSE) ELSE FALSE END AS rejected,
  CASE v.template_id WHEN 'T04' THEN 1 - 0.5 * ABS(LN({ratio}) - LN(0.7 * 1.4) / 2) / (LN(1.4 / 0.7) / 2) WHEN 'T05' THEN CASE WHEN {clear} AND ({with_b} OR {with_c}) THEN 1.0 WHEN {clear} THEN 0.7 WHEN {partial} >= 2 THEN 0.4 WHEN {partial} = 1 THEN 0.3 ELSE 0.1 END WHEN 'T21' THEN COALESCE(1 - 0.5 * {TURN} / 8, 0) ELSE 0 END AS validator FROM iv v {role(1)} {role(2)} {role(3)}),
ik AS (SELECT s.*, k.n, k.strict, k.almost, CASE WHEN NOT shown THEN 'hidden' WHEN strict >= n THEN 'winning' WHEN rejected THEN 'rejected' ELSE 'accepted' END AS kind, ROUND(1 + 0.5 * almost / n + validator, 9) AS total FROM isc s JOIN (SELECT scene_id, template_id, key, i, COUNT(*) AS n, COUNT(*) FILTER (strict) AS strict, COUNT(*) FILTER (almost) AS almost FROM imet GROUP BY ALL) k ON {SAME.format('k', 's')} AND k.i = s.i),
fc AS (SELECT scene_id, template_id, key, COUNT(*) AS n_examined, {', '.join(f"COUNT(*) FILTER (kind = '{k}') AS n_{k}" for k in ('hidden', 'winning', 'rejected', 'accepted'))}, MAX(total) FILTER (kind = 'accepted') AS score, ARG_MAX(i, (total, -i)) FILTER (kind = 'accepted') AS i FROM ik GROUP BY ALL),
fv AS MATERIALIZED (SELECT ti.scene_id, ti.template_id, ti.key, {', '.join(f'COALESCE(n_{k}, 0) AS n_{k}' for k in ('examined', 'hidden', 'winning', 'rejected', 'accepted'))}, score, f.i, v.px, v.py, v.pz, v.tx, v.ty, v.tz FROM ti LEFT JOIN fc f ON {SAME.format('f', 'ti')} LEFT JOIN iv v ON {SAME.format('v', 'ti')} AND v.i = f.i)"""


@query(named(f"""WITH {BLOCKERS}, {chain()}, {first_sql()} SELECT * EXCLUDE (score, px, py, pz, tx, ty, tz), ROUND(score, 6) AS score, ROUND(px, 6) AS px, ROUND(py, 6) AS py, ROUND(tz, 6) AS tz FROM fv"""))
def first_views(spark, sf_dir):
    """The best first view of each instance, which fails some slot, with the counts of what became of its candidates."""
    out = planned(spark, sf_dir, "first")["first"]
    return out.select(*E.KEY, *(f"n_{k}" for k in ("examined", "hidden", "winning", "rejected", "accepted")), "i", *(F.round(c, 6).alias(c) for c in ("score", "px", "py", "tz")))


def way_sql():
    """CTEs up to wy, the way of each instance over its slots; orders of one or two slots are written out."""
    d = lambda a, b: f"ROUND(SQRT(POW({a}.px - {b}.px, 2) + POW({a}.py - {b}.py, 2)), 9)"
    return f"""{OWN}, {looking('cn', 'ob', 'vis')}, {met('cn', 'tr', 'vis', 'met')},
pl AS MATERIALIZED (SELECT c.*, m.place, m.whole FROM cn c JOIN (SELECT scene_id, template_id, key, grp, i, MAX(place) FILTER (slot_id = grp) AS place, BOOL_OR(strict) FILTER (slot_id = grp) AS own, BOOL_AND(strict) AS whole FROM met GROUP BY ALL) m ON {SAME.format('m', 'c')} AND m.grp = c.grp AND m.i = c.i WHERE m.own),
gd AS (SELECT scene_id, template_id, key, slot_id, COUNT(*) AS n FROM met WHERE ok AND grp = slot_id GROUP BY ALL),
fs AS (SELECT ti.scene_id, ti.template_id, ti.key, ARG_MIN(sl.slot_id, place) FILTER (g.n IS NULL) AS missing FROM ti JOIN sl ON sl.template_id = ti.template_id LEFT JOIN gd g ON {SAME.format('g', 'ti')} AND g.slot_id = sl.slot_id GROUP BY ti.scene_id, ti.template_id, ti.key),
bg AS (SELECT f.* FROM fv f JOIN fs ON {SAME.format('fs', 'f')} WHERE f.i IS NOT NULL AND fs.missing IS NULL),
od(template_id, o, one, two) AS (VALUES ('T01', 0, 0, NULL), ('T04', 0, 0, NULL), ('T21', 0, 0, NULL), ('T05', 0, 0, 1), ('T05', 1, 1, 0)),
w1 AS (SELECT b.scene_id, b.template_id, b.key, od.o, ANY_VALUE(od.two) AS two, MIN(ROUND({d('p', 'b')}, 9)) AS d, ARG_MIN(p, ({d('p', 'b')}, p.i)) AS a FROM bg b JOIN od ON od.template_id = b.template_id JOIN pl p ON {SAME.format('p', 'b')} AND p.place = od.one GROUP BY b.scene_id, b.template_id, b.key, od.o),
w2 AS (SELECT w.scene_id, w.template_id, w.key, w.o, MIN(ROUND(SQRT(POW(p.px - w.a.px, 2) + POW(p.py - w.a.py, 2)), 9)) AS d, ARG_MIN(p, (ROUND(SQRT(POW(p.px - w.a.px, 2) + POW(p.py - w.a.py, 2)), 9), p.i)) AS b FROM w1 w JOIN pl p ON {SAME.format('p', 'w')} AND p.place = w.two WHERE NOT w.a.whole GROUP BY w.scene_id, w.template_id, w.key, w.o),
wa AS (SELECT w.scene_id, w.template_id, w.key, w.o, w.a, x.b, ROUND(w.d + COALESCE(x.d, 0), 9) AS length FROM w1 w LEFT JOIN w2 x ON {SAME.format('x', 'w')} AND x.o = w.o WHERE w.a.whole OR x.b IS NOT NULL),
wy AS MATERIALIZED (SELECT scene_id, template_id, key, MIN(length) AS length, ARG_MIN(a, (length, o)) AS a, ARG_MIN({{'b': b}}, (length, o)).b AS b FROM wa GROUP BY ALL)"""


def braced(sql):
    """`named`, with a struct's braces kept as they are."""
    return named(sql.replace("{'b': b}", "struct_pack(b := b)"))


@query(braced(f"""WITH {BLOCKERS}, {chain()}, {first_sql()}, {way_sql()} SELECT scene_id, template_id, key, CASE WHEN b IS NULL THEN 1 ELSE 2 END AS n_views, ROUND(length, 6) AS length, a.grp || ':' || a.i || CASE WHEN b IS NULL THEN '' ELSE ' ' || b.grp || ':' || b.i END AS route FROM wy"""))
def slot_ways(spark, sf_dir):
    """The way from the first view over the slots of each feasible instance."""
    route = F.array_join(F.transform("route", lambda r: F.concat_ws(":", r["grp"], r["i"].cast("string"))), " ")
    return planned(spark, sf_dir, "way")["way"].select(*E.KEY, F.col("n_views"), F.round("length", 6).alias("length"), route.alias("route"))


#: The frames of each way, a move apart.
FRAMES = f"""lg AS (SELECT scene_id, template_id, key, 0 AS leg, f.px AS fx, f.py AS fy, f.pz AS fz, a.px, a.py, a.pz, a.tx, a.ty, a.tz FROM wy JOIN fv f USING (scene_id, template_id, key) UNION ALL SELECT scene_id, template_id, key, 1, a.px, a.py, a.pz, b.px, b.py, b.pz, b.tx, b.ty, b.tz FROM wy WHERE b IS NOT NULL),
ln AS (SELECT *, CAST(GREATEST(1, CEIL(SQRT(POW(px - fx, 2) + POW(py - fy, 2)) / 0.5 - 1e-9)) AS INT) AS n FROM lg), lk AS (SELECT *, UNNEST(range(1, n + 1)) AS k FROM ln),
fm AS (SELECT scene_id, template_id, key, leg, k, (1 - k / n) * fx + k / n * px AS px, (1 - k / n) * fy + k / n * py AS py, (1 - k / n) * fz + k / n * pz AS pz, px AS ex, py AS ey, pz AS ez, tx AS lx, ty AS ly, tz AS lz, n FROM lk),
wk AS MATERIALIZED (SELECT scene_id, template_id, key, 'way' AS grp, ROW_NUMBER() OVER (PARTITION BY scene_id, template_id, key ORDER BY leg, k) - 1 AS i, px, py, pz, tx, ty, tz FROM (SELECT scene_id, template_id, key, leg, k, px, py, pz, CASE WHEN k = n THEN lx ELSE px + lx - ex END AS tx, CASE WHEN k = n THEN ly ELSE py + ly - ey END AS ty, CASE WHEN k = n THEN lz ELSE pz + lz - ez END AS tz FROM fm
  UNION ALL SELECT scene_id, template_id, key, -1, 0, f.px, f.py, f.pz, f.tx, f.ty, f.tz FROM wy JOIN fv f USING (scene_id, template_id, key)))"""
ITEMS = f"""{FRAMES},
wt AS (SELECT ti.scene_id, ti.template_id, key, 'way' AS grp, slot_id FROM ti JOIN sl ON sl.template_id = ti.template_id), wb AS (SELECT DISTINCT t.scene_id, t.template_id, t.key, 'way' AS grp, object_id FROM ob t),
{looking('wk', 'wb', 'visw')}, {met('wk', 'wt', 'visw', 'wmet')},
ls AS (SELECT scene_id, template_id, key, MAX(i) AS steps FROM wk GROUP BY ALL), bk AS (SELECT DISTINCT scene_id, template_id, key FROM (SELECT * FROM wk WHERE i > 0) w WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM wk p {free('p.pz')}) g WHERE {SAME.format('g', 'w')} AND g.i = w.i)),
ct(template_id, trajectory, most) AS (VALUES ('T01', FALSE, 8), ('T04', FALSE, 10), ('T05', TRUE, 12), ('T21', FALSE, 10)),
cv AS (SELECT m.scene_id, m.template_id, m.key, CASE WHEN ANY_VALUE(ct.trajectory) THEN AVG(ever::INT) ELSE MIN(at_end::INT) END AS asked FROM (SELECT w.scene_id, w.template_id, w.key, w.slot_id, BOOL_OR(strict AND i = steps) AS at_end, BOOL_OR(strict) AS ever FROM wmet w JOIN ls ON {SAME.format('ls', 'w')} GROUP BY ALL) m JOIN ct ON ct.template_id = m.template_id GROUP BY ALL),
im AS (SELECT ti.scene_id, ti.template_id, ti.key, ti.gt_answer, f.score AS init_score, w.length, steps, asked, CASE WHEN fs.missing IS NOT NULL THEN 'no view for ' || fs.missing WHEN f.i IS NULL THEN 'no first view' WHEN w.length IS NULL THEN 'no way over all slots' WHEN bk.key IS NOT NULL THEN 'way is blocked' WHEN steps > ct.most THEN 'too many steps' WHEN asked < 1 THEN 'coverage too low' END AS failure
  FROM ti JOIN fs ON {SAME.format('fs', 'ti')} JOIN ct ON ct.template_id = ti.template_id LEFT JOIN fv f ON {SAME.format('f', 'ti')} LEFT JOIN wy w ON {SAME.format('w', 'ti')} LEFT JOIN ls ON {SAME.format('ls', 'ti')} LEFT JOIN bk ON {SAME.format('bk', 'ti')} LEFT JOIN cv ON {SAME.format('cv', 'ti')})"""


@query(braced(f"""WITH {BLOCKERS}, {chain()}, {first_sql()}, {way_sql()}, {ITEMS} SELECT scene_id, template_id, key, gt_answer, ROUND(init_score, 6) AS init_score, CASE WHEN failure IS NULL THEN steps END AS steps, CASE WHEN failure IS NULL THEN ROUND(length, 6) END AS length, CASE WHEN failure IS NULL THEN asked::DOUBLE END AS coverage,
  CASE WHEN failure IS NULL THEN ROUND(LEAST(1.0, asked) * POW(0.95, steps), 6) END AS score, failure, CASE WHEN failure IS NULL THEN CASE WHEN steps <= 1 THEN 'easy' WHEN steps <= 3 THEN 'medium' WHEN steps <= 5 THEN 'hard' ELSE 'expert' END END AS difficulty FROM im"""))
def task_items(spark, sf_dir):
    """Task items of each template and scene: target and first view, way, coverage, score and difficulty, or why there is none."""
    out = planned(spark, sf_dir, "items")["items"]
    hard = F.when(F.col("failure").isNull(), X.difficulty(F.col("steps")))
    return out.select(*E.KEY, "gt_answer", F.round("init_score", 6).alias("init_score"), "steps", F.round("length", 6).alias("length"), "coverage", F.round("score", 6).alias("score"), "failure", hard.alias("difficulty"))


ACTED = f"""ac(a, along, side, turn, look) AS (VALUES (0, 0.5::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE), (1, -0.5, 0, 0, 0), (2, 0, -0.5, 0, 0), (3, 0, 0.5, 0, 0), (4, 0, 0, 45, 0), (5, 0, 0, -45, 0), (6, 0, 0, 0, 15), (7, 0, 0, 0, -15), (8, 0, 0, 0, 0), (9, 0, 0, 0, 0)),
w0 AS (SELECT w.*, tx - px AS dx, ty - py AS dy, tz - pz AS dz, SQRT(dx * dx + dy * dy + dz * dz) AS sz, SQRT(dx * dx + dy * dy) AS lv FROM wk w),
w3 AS (SELECT scene_id, template_id, key, 'act' AS grp, i * 10 + a AS i, a, px + along * dx / sz - side * dy / lv AS px, py + along * dy / sz + side * dx / lv AS py, pz + along * dz / sz AS pz,
  CASE WHEN look <> 0 THEN px + dx / lv * sz * COS(GREATEST(RADIANS(-75), LEAST(RADIANS(75), ATAN2(dz, lv) + RADIANS(look)))) ELSE px + along * dx / sz - side * dy / lv + dx * COS(RADIANS(turn)) - dy * SIN(RADIANS(turn)) END AS tx,
  CASE WHEN look <> 0 THEN py + dy / lv * sz * COS(GREATEST(RADIANS(-75), LEAST(RADIANS(75), ATAN2(dz, lv) + RADIANS(look)))) ELSE py + along * dy / sz + side * dx / lv + dx * SIN(RADIANS(turn)) + dy * COS(RADIANS(turn)) END AS ty,
  CASE WHEN look <> 0 THEN pz + sz * SIN(GREATEST(RADIANS(-75), LEAST(RADIANS(75), ATAN2(dz, lv) + RADIANS(look)))) WHEN a = 8 THEN pz ELSE tz + along * dz / sz END AS tz FROM w0, ac),
av AS MATERIALIZED (SELECT p.* FROM w3 p {free('p.pz')} WHERE a <> 9 UNION ALL SELECT * FROM w3 WHERE a = 9),
at_ AS (SELECT ti.scene_id, ti.template_id, key, 'act' AS grp, slot_id FROM ti JOIN sl ON sl.template_id = ti.template_id), ao AS (SELECT DISTINCT t.scene_id, t.template_id, t.key, 'act' AS grp, object_id FROM ob t),
{looking('av', 'ao', 'visa')}, {met('av', 'at_', 'visa', 'amet')},
be AS (SELECT m.scene_id, m.template_id, m.key, m.i // 10 AS step, m.i % 10 AS a, MIN(CASE WHEN sl.quality = 'balance' THEN strict::INT::DOUBLE ELSE k / n END) AS belief FROM amet m JOIN sl ON sl.template_id = m.template_id AND sl.slot_id = m.slot_id GROUP BY ALL),
rg_ AS (SELECT b.scene_id, b.template_id, b.key, b.step, MAX(b.belief) AS top, ANY_VALUE(o.belief) AS here, ANY_VALUE(x.belief) AS there FROM be b JOIN be o ON {SAME.format('o', 'b')} AND o.step = b.step AND o.a = 9 JOIN be x ON {SAME.format('x', 'b')} AND x.step = b.step + 1 AND x.a = 9 GROUP BY b.scene_id, b.template_id, b.key, b.step)"""


@query(braced(f"""WITH {BLOCKERS}, {chain()}, {first_sql()}, {way_sql()}, {FRAMES}, {ACTED} SELECT scene_id, template_id, key, COUNT(*) AS n_steps, ROUND(AVG(top - there), 5) AS mean_regret, ROUND(SUM(top - there), 5) AS cumulative_regret, ROUND(AVG(there - here), 5) AS mean_necessity,
  ROUND(AVG((there - here <= 1e-6)::INT), 5) AS redundant_ratio, COUNT(*) FILTER (ABS(top - there) <= 1e-6) AS n_best FROM rg_ GROUP BY ALL"""))
def action_regret(spark, sf_dir):
    """What the steps of each way gain in belief, against the best of ten actions at each frame; equal poses are looked at once."""
    out = planned(spark, sf_dir, "regret")["regret"]
    return out.select(*E.KEY, "n_steps", *(F.round(c, 5).alias(c) for c in ("mean_regret", "cumulative_regret", "mean_necessity", "redundant_ratio")), "n_best")
