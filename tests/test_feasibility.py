"""Catalog, ways over slots, groups, presets and image areas against small examples and brute force."""

import itertools
import json
import math

import numpy as np
import pandas as pd
import pytest

from atrium.operators import catalog, feasibility, generators, groups, image_area
from atrium.operators import objects as O
from atrium.operators import views as V

BOXES = "scene_id int, object_id long, label string, min_x double, max_x double, min_y double, max_y double, min_z double, max_z double"


def test_catalog_has_all_templates(spark):
    t = catalog.tables(spark)
    assert {n: df.count() for n, df in t.items()} == {"templates": 22, "requirements": 0, "triggers": 42, "slots": 25, "regions": 94, "predicates": 84}
    t05 = t["templates"].where("template_id = 'T05'").first()
    assert (t05.choices, t05.aggregator, t05["mode"], t05.least, t05.max_steps, t05.move_m, t05.turn_deg, t05.gamma, t05.n_slots) == ("pair_from_triple", "mean", "trajectory", 1.0, 12, 0.5, 45.0, 0.95, 2)
    assert [r.slot_id for r in t["slots"].where("repeat").orderBy("slot_id").collect()] == ["bottleneck_{i}", "hidden_instance_{i}", "portal_{i}_facing"]
    pair = t["predicates"].where("template_id = 'T05' AND predicate = 'PairVisible' AND slot_id = 'AC_view'").first()
    assert (pair["first"], pair.second, pair.min_corners, pair.max_occ) == ("subject_id", "ref_c_id", 4.0, 0.3)


def test_checks_are_merged_behind_what_is_written_out(tmp_path):
    spec = {"template_id": "X1", "trigger": {"a": 1}, "evidence_slots": [{"slot_id": "s", "predicates": [{"name": "InRoom"}]}, {"slot_id": "t"}]}
    checks = [{"when": "scene", "name": "min_objects", "args": 3}, {"when": "init", "name": "a", "args": 2}, {"when": "init", "name": "b", "args": False}, {"when": "target", "name": "Visible", "args": {"obj": "{{target_id}}"}}, {"when": "target", "slot": "t", "name": "Centered"}]
    out = catalog.merged(spec | {"checks": checks})
    assert out["scene_requirements"] == {"min_objects": 3} and out["trigger"] == {"a": 1, "b": False}
    assert [[p["name"] for p in s["predicates"]] for s in out["evidence_slots"]] == [["InRoom", "Visible"], ["Centered"]]
    for bad in ({"when": "later", "name": "x"}, {"when": "init"}, {"when": "target", "slot": "u", "name": "x"}):
        with pytest.raises(ValueError):
            catalog.merged(spec | {"checks": [bad]})
    (tmp_path / "b.json").write_text(json.dumps(spec))
    (tmp_path / "a.json").write_text(json.dumps(spec | {"template_id": "X0"}))
    assert [s["template_id"] for s in catalog.read_specs(str(tmp_path))] == ["X0", "X1"]


def test_files_and_the_short_form_give_equal_tables(spark, tmp_path):
    for spec in catalog.parse():
        (tmp_path / f"{spec['template_id']}.json").write_text(json.dumps(spec))
    a, b = catalog.tables(spark), catalog.tables(spark, catalog.read_specs(str(tmp_path)))
    assert all(sorted(map(str, a[n].collect())) == sorted(map(str, b[n].collect())) for n in a)


def brute_way(start, pools, meets):
    best = None
    for k, order in enumerate(itertools.permutations(range(len(pools)))):
        at, covered, route, total = start, set(), [], 0.0
        for slot in order:
            if slot in covered:
                continue
            if not pools[slot]:
                break
            d, i = min((round(math.dist(at, xy), 9), i) for i, xy in pools[slot].items())
            at, total = pools[slot][i], total + d
            route.append((slot, i))
            covered |= meets[slot, i]
        if len(covered) == len(pools) and (best is None or (round(total, 9), k) < best[:2]):
            best = (round(total, 9), k, route)
    return best


def test_ways_equal_all_orders(spark):
    rng = np.random.default_rng(4)
    slots = spark.createDataFrame([("T3", f"s{k}", k) for k in range(3)], "template_id string, slot_id string, place int")
    starts, cands, met, want = [], [], [], {}
    for key in range(25):
        start = tuple(rng.uniform(0, 6, 2))
        pools, meets = [], {}
        for k in range(3):
            n = int(rng.integers(0 if key % 7 == 0 else 1, 5))
            pools.append({i: tuple(rng.uniform(0, 6, 2)) for i in range(n)})
            for i, xy in pools[k].items():
                meets[k, i] = {k} | {j for j in range(3) if rng.random() < 0.25}
                cands.append((1, "T3", key, f"s{k}", i, *map(float, xy), 0.8, 0.0, 0.0, 0.0))
                met += [(1, "T3", key, f"s{k}", i, f"s{j}", j, j in meets[k, i]) for j in range(3)]
        starts.append((1, "T3", key, float(start[0]), float(start[1])))
        if (way := brute_way(start, pools, meets)) is not None:
            want[key] = way
    names = "scene_id int, template_id string, key long, "
    got = feasibility.ways(
        spark.createDataFrame(starts, names + "px double, py double"),
        spark.createDataFrame(cands, names + "grp string, i long, px double, py double, pz double, tx double, ty double, tz double"),
        spark.createDataFrame(met, names + "grp string, i long, slot_id string, place int, strict boolean"),
        slots,
    ).collect()
    assert {r.key: (round(r.length, 9), [(int(x.grp[1:]), x.i) for x in r.route]) for r in got} == {k: (w[0], w[2]) for k, w in want.items()}
    assert any(len(w[2]) < 3 for w in want.values()) and len(want) < 25


def test_frames_are_as_far_apart_as_a_move(spark):
    names = "scene_id int, template_id string, key long, "
    pose = ", px double, py double, pz double, tx double, ty double, tz double"
    starts = spark.createDataFrame([(1, "T1", 5, 0.0, 0.0, 0.8, 1.0, 0.0, 0.8)], names.rstrip(", ") + pose)
    cands = spark.createDataFrame([(1, "T1", 5, "s", 3, 1.2, 0.0, 0.8, 1.2, 1.0, 0.8)], names + "grp string, i long" + pose)
    routes = spark.createDataFrame([(1, "T1", 5, [("s", 3)])], names + "route array<struct<grp:string,i:bigint>>")
    templates = spark.createDataFrame([("T1", 0.5)], "template_id string, move_m double")
    rows = feasibility.frames(starts, routes, cands, templates).orderBy("step").collect()
    assert [(r.step, round(r.px, 6), round(r.tx, 6), round(r.ty, 6)) for r in rows] == [(0, 0.0, 1.0, 0.0), (1, 0.4, 0.4, 1.0), (2, 0.8, 0.8, 1.0), (3, 1.2, 1.2, 1.0)]


def roomed(spark, n=9, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x, y, h = rng.uniform(0.5, 3.5), rng.uniform(0.5, 3.5), rng.uniform(0.1, 0.4, 3)
        rows.append((1, i, "box", x - h[0], x + h[0], y - h[1], y + h[1], 0.0, 2 * h[2], 1))
    rows += [(1, 90, "box", None, None, None, None, None, None, 1), (1, 91, "box", *rows[0][3:9], None)]
    return spark.createDataFrame([tuple(float(v) if isinstance(v, np.floating) else v for v in r) for r in rows], BOXES + ", room_id long"), rows[:n]


@pytest.mark.parametrize("k", [2, 3, 4, 5])
def test_groups_equal_brute_force(spark, k):
    objects, rows = roomed(spark)
    gap = lambda a, b: round(math.sqrt(sum(max(0.0, a[3 + 2 * x] - b[4 + 2 * x], b[3 + 2 * x] - a[4 + 2 * x]) ** 2 for x in range(3))), 9)
    long = lambda r: max(r[4 + 2 * x] - r[3 + 2 * x] for x in range(3))
    want = set()
    for some in itertools.combinations(rows, k):
        d = [gap(a, b) for a, b in itertools.combinations(some, 2)]
        sizes = [long(r) for r in some]
        if max(d) > (3.0 if k == 2 else 2.0) or any(max(sizes[:n]) / min(sizes[:n]) > 2.5 for n in range(2, k)):
            continue
        mean = sum(sizes) / k
        bad = "size_ratio" if max(sizes) / min(sizes) > 2.5 else "too_close" if min(d) < max(0.1, 0.2 * mean) else "out_of_dyn_range" if k == 2 and max(d) > min(3.0, 1.5 * mean) else None
        want.add((tuple(r[1] for r in some), bad))
    got = {(tuple(r.members), r.reason) for r in groups.object_groups(objects, k).collect()}
    assert got == want and want
    assert groups.object_groups(objects.limit(0), k).count() == 0
    with pytest.raises(ValueError):
        groups.object_groups(objects, 6)


def hull(points):
    """Corners of the convex hull in order, by gift wrapping."""
    points = sorted(set(points))
    at, out = points[0], []
    while True:
        out.append(at)
        nxt = points[0] if points[0] != at else points[1]
        for p in points:
            turn = (nxt[0] - at[0]) * (p[1] - at[1]) - (nxt[1] - at[1]) * (p[0] - at[0])
            if turn < 0 or turn == 0 and math.dist(at, p) > math.dist(at, nxt):
                nxt = p
        at = nxt
        if at == out[0]:
            return out


def raster(points):
    """Which pixels of the image lie in the hull, each by all of its sides."""
    x, y = np.meshgrid(np.arange(image_area.PIXELS), np.arange(image_area.PIXELS))
    inside, ring = np.ones(x.shape, bool), hull(points)
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        side = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        inside &= side >= -1e-6 * math.dist((ax, ay), (bx, by))
    return inside


def test_only_boxes_that_can_cover_a_target_are_drawn(monkeypatch):
    drawn, draw = [], image_area.stretches
    monkeypatch.setattr(image_area, "stretches", lambda u, *rest: drawn.append(len(u)) or draw(u, *rest))
    cam = dict(zip(image_area.CAM, (0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 1.0)))
    boxes = [(1, True, 4.0, 0.0), (2, False, 2.0, 0.3), (3, False, 6.0, 0.0), (4, False, 2.0, 9.0), (5, False, -3.0, 0.0)]
    rows = pd.DataFrame([{"scene_id": 0, "view_id": 0, "object_id": k, "target": t, **cam, "min_x": x, "max_x": x + 0.5, "min_y": y - 0.5, "max_y": y + 0.5, "min_z": -0.5, "max_z": 0.5} for k, t, x, y in boxes])
    (area,) = image_area.view_areas(rows).to_dict("records")
    assert drawn == [2] and [o["object_id"] for o in area["occluders"]] == [2] and 0 < area["occluded_px"] < area["target_px"]


def test_image_areas_equal_a_raster(spark):
    rng = np.random.default_rng(8)
    boxes = []
    for i in range(7):
        c, h = rng.uniform((1.0, -1.2, 0.0), (4.0, 1.2, 1.6)), rng.uniform(0.1, 0.5, 3)
        boxes.append((1, i, "box", *(float(v) for a in range(3) for v in (c[a] - h[a], c[a] + h[a]))))
    boxes.append((1, 7, "behind", -2.0, -1.0, -0.5, 0.5, 0.0, 1.0))
    boxes.append((1, 8, "around", -0.5, 0.5, -0.2, 0.3, 0.2, 0.6))
    view = spark.createDataFrame([(1, 4, 0.0, 0.0, 0.8, 2.0, 0.1, 0.9)], "scene_id int, view_id long, px double, py double, pz double, tx double, ty double, tz double")
    objects = spark.createDataFrame(boxes, BOXES)
    seen = V.with_camera(view).join(objects.where("object_id < 8"), "scene_id")
    rows = image_area.occluded_area(seen, objects).collect()
    cam = np.array([seen.first()[c] for c in image_area.CAM])
    u, v, depth = image_area.projected(cam, np.array([b[3:] for b in boxes]))
    ahead = depth > 1e-6
    masks = [raster(list(zip(a[k], b[k]))) if k.sum() >= 3 else np.zeros((image_area.PIXELS,) * 2, bool) for a, b, k in zip(u, v, ahead)]
    mean = [d[k].mean() if k.any() else 0 for d, k in zip(depth, ahead)]
    assert len(rows) == 8
    for r in rows:
        nearer = [o for o in range(len(boxes)) if o != r.object_id and mean[o] + 1e-6 < mean[r.object_id] and ahead[o].sum() >= 3]
        mine = masks[r.object_id]
        covered = np.any([masks[o] for o in nearer], axis=0) & mine if nearer else np.zeros_like(mine)
        assert (r.target_px, r.occluded_px) == (mine.sum(), covered.sum())
        assert {x.object_id: x.px for x in r.occluders} == {o: n for o in nearer if (n := (masks[o] & mine).sum())}
    assert sum(r.occluded_px > 0 for r in rows) >= 2 and [r.target_px for r in rows if r.object_id == 7] == [0]
    ranked = image_area.occlusion_ranking(image_area.occluded_area(seen, objects)).orderBy("rank").collect()
    assert [r.occluded_ratio for r in ranked] == sorted((r.occluded_ratio for r in ranked), reverse=True)
    assert image_area.occluded_area(seen.limit(0), objects).count() == 0


def test_presets_take_the_least_step(spark):
    rows = [(1, i, "box", 2.0 - h, 2.0 + h, 2.0 - h / 2, 2.0 + h / 2, 0.3, 0.3 + h) for i, h in enumerate((0.1, 0.35, 0.6))]
    objects = spark.createDataFrame(rows[:1], BOXES)
    for row in rows:
        objects = spark.createDataFrame([row], BOXES)
        rooms = O.with_polygons(spark.createDataFrame([(1, 1, -50.0, 50.0, -50.0, 50.0)], "scene_id int, room_id long, x0 double, x1 double, y0 double, y1 double"))
        for r in generators.preset_views(objects, rooms, objects).collect():
            assert r.reason is None
            b = np.array(row[3:]).reshape(3, 2)
            c, d = b.mean(axis=1), np.array(generators.PRESETS[r.preset])
            d = d / np.linalg.norm(d)
            big = (b[:, 1] - b[:, 0]).max()
            begin = min(abs((b[a, 1] - c[a]) / d[a]) for a in range(3) if abs(d[a]) > 1e-9) + max(1e-3, 0.01 * big)
            for steps in itertools.count():
                p = c + d * (begin + steps * max(0.2, 0.2 * big))
                cam = spark.createDataFrame([(*map(float, p), *map(float, c))], "px double, py double, pz double, tx double, ty double, tz double") if steps == r.steps else None
                f = (c - p) / np.linalg.norm(c - p)
                right = np.cross(f, [0, 0, 1]) if np.hypot(*f[:2]) > 1e-6 else np.array([1.0, 0, 0])
                right = right / np.linalg.norm(right)
                up = np.cross(right, f)
                z = [(np.array(q) - p) @ f for q in itertools.product(*b)]
                uv = [(200 + 160 * s * ((np.array(q) - p) @ e) / max(w, 1e-9)) for q, w in zip(itertools.product(*b), z) for s, e in ((-1, right), (1, up))]
                if min(z) > 1e-6 and all(0 <= t < 400 for t in uv):
                    break
            assert r.steps == steps and np.allclose([r.px, r.py, r.pz], p)
            assert cam is not None
    inside = generators.preset_views(objects, rooms, objects.union(spark.createDataFrame([(1, 9, "big", 0.0, 4.0, 0.0, 4.0, -9.0, 9.0)], BOXES)))
    assert {r.reason for r in inside.collect()} == {"blocked"}
    small = O.with_polygons(spark.createDataFrame([(1, 1, 1.9, 2.1, 1.9, 2.1)], "scene_id int, room_id long, x0 double, x1 double, y0 double, y1 double"))
    assert {r.reason for r in generators.preset_views(objects, small, objects).where("preset <> 'above'").collect()} == {"outside"}


def test_pandas_batches_of_one_view():
    cam = dict(zip(image_area.CAM, (0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 1.0)))
    far = dict(zip(image_area.BOX, (4.0, 5.0, -1.0, 1.0, -1.0, 1.0)))
    near = dict(zip(image_area.BOX, (2.0, 2.5, -3.0, 3.0, -3.0, 3.0)))
    rows = pd.DataFrame([{"scene_id": 1, "view_id": 1, "object_id": 1, "target": True, **cam, **far}, {"scene_id": 1, "view_id": 1, "object_id": 2, "target": False, **cam, **near}])
    out = image_area.view_areas(rows)
    assert out.target_px[0] == out.occluded_px[0] == 81 * 81


def test_poses_after_actions_and_regret(spark):
    names = "scene_id int, template_id string, key long, step long, move_m double, turn_deg double, px double, py double, pz double, tx double, ty double, tz double"
    walked = spark.createDataFrame([(1, "T1", 5, k, 0.5, 90.0, 0.5 * k, 0.0, 0.8, 0.5 * k + 1.0, 0.0, 0.8) for k in (0, 1)], names)
    poses = feasibility.action_poses(walked)
    got = {feasibility.ACTIONS[r.action]: tuple(round(r[c], 6) + 0.0 for c in ("px", "py", "pz", "tx", "ty", "tz")) for r in poses.where("step = 0").collect()}
    up = (round(math.cos(math.radians(15)), 6), 0.0)
    assert got["move_forward"] == (0.5, 0.0, 0.8, 1.5, 0.0, 0.8) and got["move_backward"] == (-0.5, 0.0, 0.8, 0.5, 0.0, 0.8)
    assert got["move_right"] == (0.0, 0.5, 0.8, 1.0, 0.5, 0.8) and got["move_left"] == (0.0, -0.5, 0.8, 1.0, -0.5, 0.8)
    assert got["turn_left"] == (0.0, 0.0, 0.8, 0.0, 1.0, 0.8) and got["turn_right"] == (0.0, 0.0, 0.8, 0.0, -1.0, 0.8)
    assert got["look_up"] == (0.0, 0.0, 0.8, *up, round(0.8 + math.sin(math.radians(15)), 6)) and got["look_forward"] == got["stop"] == (0.0, 0.0, 0.8, 1.0, 0.0, 0.8)
    views, known = feasibility.distinct_poses(poses)
    # Of twenty poses, going forward from the first is the second's own, back from the second the first's, and looking ahead or stopping change nothing.
    assert (views.count(), known.count()) == (16, 20)
    slots = spark.createDataFrame([("T1", "s", None)], "template_id string, slot_id string, quality string")
    met = views.selectExpr("scene_id", "template_id", "key", "i", "'s' AS slot_id", "CAST(px >= 0.25 AS DOUBLE) AS share", "px >= 0.25 AS strict")
    row = feasibility.counterfactual(known, met, slots).first()
    assert (row.n_steps, row.mean_regret, row.mean_necessity, row.redundant_ratio, row.n_best) == (1, 0.0, 1.0, 0.0, 1)
    late = feasibility.counterfactual(known, met.withColumn("share", 1.0 - met.share), slots).first()
    assert (late.mean_regret, late.mean_necessity, late.redundant_ratio, late.n_best) == (1.0, -1.0, 1.0, 0)
