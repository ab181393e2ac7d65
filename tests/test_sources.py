import json

from pyspark.sql import Row

from atrium.functions import text as X
from atrium.operators import objects as O
from atrium.operators import tasks as T
from atrium.sources import scenes, tasks
from pyspark.sql import functions as F


def box(n=8):
    return [{"x": float(i & 1), "y": float(i >> 1 & 1), "z": float(i >> 2 & 1)} for i in range(n)]


def write(folder, **files):
    folder.mkdir(parents=True)
    for name, value in files.items():
        (folder / f"{name}.json").write_text(json.dumps(value))


def test_scene_readers(spark, tmp_path):
    labels = [{"ins_id": 7, "label": "Chair", "bounding_box": box()}, {"ins_id": "8", "label": "wall", "bounding_box": box()}, {"ins_id": "9", "label": "sofa"}, {"ins_id": "10", "label": "bed", "bounding_box": box(4)}]
    structure = {
        "rooms": [{"profile": [[0, 0], [4, 0], [4, 3]]}, {"id": "line", "profile": [[0, 0], [1, 1]]}, {"id": "k", "polygon": [[0, 0], [1, 0], [1, 1], [0, 1]]}],
        "walls": [{"location": [[0, 0], [4, 0]]}, {"location": [[1, 1], [1, 1]], "thickness": 0.4, "height": 2.0}],
        "doors": [{"id": "d", "type": "door", "location": [[0, 0], [1, 0]], "width": 1.0, "height": 2.0, "room_a": "a", "room_b": "b"}],
        "holes": [{"type": "window", "profile": [[0, 0, 0], [0.05, 0, 2], [0, 0, 2]]}, {"type": "opening", "profile": [[0, 0, 0], [2, 0, 0], [2, 0, 2]]}],
    }
    write(tmp_path / "s1", labels=labels, structure=structure, occupancy={"lower": [0, 0, -1], "max": [1, 1, 3]})
    folder = str(tmp_path)
    assert [r.scene_id for r in scenes.read_scenes(spark, folder).collect()] == ["s1"]
    objects = scenes.read_objects(spark, folder).collect()
    assert [(r.object_id, r.label, r.min_x, r.max_z) for r in objects] == [("7", "chair", 0.0, 1.0)]
    assert [(r.room_id, len(r.poly)) for r in scenes.read_rooms(spark, folder).orderBy("room_idx").collect()] == [("r0", 3), ("k", 4)]
    walls = {r.object_id: r for r in scenes.read_walls(spark, folder).collect()}
    assert (walls["wall_0"].min_y, walls["wall_0"].max_x, walls["wall_0"].max_z) == (-0.1, 4.0, 2.8)
    assert (walls["wall_1"].min_x, walls["wall_1"].max_y) == (0.8, 1.2)
    assert [(r.portal_id, r.type, r.width) for r in scenes.read_portals(spark, folder).orderBy("portal_id").collect()] == [("d", "DOOR", 1.0), ("hole_1", "OPENING", 2.0)]
    assert [tuple(r) for r in scenes.read_bounds(spark, folder).collect()] == [("s1", -1.0, 3.0)]


def test_task_files(spark, tmp_path):
    good = {"task_id": "a", "scene_name": "s", "template_id": "T1", "question": "q", "choices": ["x"], "answer": "x", "action_sequence": ["stop"], "coverage": 0.5, "score": 1.0}
    (tmp_path / "in.jsonl").write_text("\n".join(json.dumps(x) for x in (good, good | {"task_id": "b", "question": " "}, good | {"task_id": "c", "coverage": 0})))
    read = tasks.read_tasks(spark, str(tmp_path / "in.jsonl"))
    assert {r.task_id: r.invalid_reason for r in tasks.validate_tasks(read).collect()} == {"a": None, "b": "empty_question", "c": "zero_coverage"}
    assert read.first().submit_view_coverage == 0.5 and read.first().file_name == "in.jsonl"
    tasks.write_tasks(read, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).where("template_id = 'T1'").count() == 3
    tasks.write_summary_csv(tasks.run_summary(read), str(tmp_path / "csv"))
    assert [r.n_valid for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()] == ["1", "1"]


def test_golden_numbers(spark):
    one = spark.createDataFrame([Row(a="x", t=" X", c=0.5, n=2), Row(a="y", t="x", c=1.0, n=0)])
    scored = one.select(T.episode_score(F.col("a"), F.col("t"), F.col("c"), F.lit(1.0), 0.9, F.col("n")).alias("s")).collect()
    assert [round(r.s, 6) for r in scored] == [0.405, 0.0]
    steps = spark.createDataFrame([("t", 0, 0.10), ("t", 1, 0.30), ("t", 2, 0.25), ("u", 0, 0.4)], "task_id string, step int, potential double")
    rewards = T.step_rewards(steps, F.lit(0.80)).orderBy("task_id", "step").collect()
    assert [round(r.reward, 6) for r in rewards] == [0.20, 0.75, 0.80]
    walk = spark.createDataFrame([("t", i, i / 2, 0.0) for i in range(3)], "task_id string, step int, px double, py double")
    row = T.path_length(walk).withColumn("spl", T.spl(F.lit(1.0), F.col("path_length"), F.lit(True))).first()
    assert (row.path_length, row.steps_to_success, row.spl) == (1.0, 2, 1.0)
    words = spark.createDataFrame([("box",), ("lady",), ("bookshelf",), ("key",), ("flowers",), ("knife",), ("cliff",)], "w string").select(X.pluralize(F.col("w")).alias("p")).collect()
    assert [r.p for r in words] == ["boxes", "ladies", "bookshelves", "keys", "flowers", "knives", "cliffs"]


def square(x, y, size=4.0):
    return [{"x": x, "y": y}, {"x": x + size, "y": y}, {"x": x + size, "y": y + size}, {"x": x, "y": y + size}]


def test_ids_are_unique_within_a_scene_alone(spark):
    """Two scenes share object and room ids; an L-shaped room leaves its corner out."""
    corner = [{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 2.0}, {"x": 2.0, "y": 2.0}, {"x": 2.0, "y": 4.0}, {"x": 0.0, "y": 4.0}]
    poly = "array<struct<x:double,y:double>>"
    rooms = spark.createDataFrame([("s1", "r0", 0, corner), ("s1", "r1", 1, square(4.0, 0.0)), ("s2", "r0", 0, square(10.0, 0.0))], f"scene_id string, room_id string, room_idx int, poly {poly}")
    box = "scene_id string, object_id string, label string, min_x double, max_x double, min_y double, max_y double, min_z double, max_z double"
    objects = spark.createDataFrame([("s1", "7", "bed", 0.5, 1.5, 0.5, 1.5, 0.0, 1.0), ("s2", "7", "sofa", 10.5, 11.5, 0.5, 1.5, 0.0, 1.0), ("s1", "8", "wardrobe", 2.5, 3.5, 2.5, 3.5, 0.0, 1.0), ("s1", "9", "dresser", 0.2, 0.6, 3.0, 3.8, 0.0, 1.0)], box)
    roomed = O.with_room(objects, rooms)
    assert sorted((r.scene_id, r.object_id, r.room_id) for r in roomed.collect()) == [("s1", "7", "r0"), ("s1", "9", "r0"), ("s2", "7", "r0")]
    names = {(r.scene_id, r.room_id): r.name for r in O.room_names(roomed, rooms).collect()}
    assert names == {("s1", "r0"): "master bedroom", ("s1", "r1"): "room 2", ("s2", "r0"): "room 1"}
    nearest = O.nearest_object(O.object_pairs(roomed)).collect()
    assert sorted((r.scene_id, r.object_id, r.other_id) for r in nearest) == [("s1", "7", "9"), ("s1", "9", "7")]
    assert sorted((r.scene_id, r.object_id) for r in O.nearest_in_cells(roomed).collect()) == [("s1", "7"), ("s1", "9")]
    assert sorted((r.scene_id, r.object_id, r.label) for r in O.distractor_labels(roomed).collect()) == []


def test_reachability_has_no_hop_bound_and_ends_on_cycles(spark):
    doors = [(i, i + 1) for i in range(8)]
    edges = spark.createDataFrame([("line", a, b) for x, y in doors for a, b in ((x, y), (y, x))] + [("ring", a, (a + d) % 9) for a in range(9) for d in (1, 8)], "scene_id string, src long, dst long")
    starts = spark.createDataFrame([("line", 0, None), ("line", 0, 5), ("ring", 0, None), ("ring", 0, 5)], "scene_id string, start long, blocked long")
    got = {}
    for r in T.reachable(edges, starts).collect():
        got.setdefault((r.scene_id, r.blocked), {})[r.room] = r.hops
    assert got[("line", None)] == {i: i for i in range(9)} and got[("line", 5)] == {i: i for i in range(5)}
    assert got[("ring", None)] == {i: min(i, 9 - i) for i in range(9)} and set(got[("ring", 5)]) == {0, 1, 2, 3, 4, 6, 7, 8}


def test_answers_and_slots(spark):
    rows = [("{'answer': [0.8, 0.0, 1.1]}", "{'answer': [0.7, 0.2, 1.0]}", True, True), ("[1, 2]", "[1]", False, False), ("2.0", "{'answer': 2.25}", False, True), ("Sofa", "the sofa", True, True), ("the sofa", "sofa", True, True), ("sofa", "bed", False, False), ("{'answer': 'left'}", "left", True, True)]
    exact, close = X.compare_answers(F.col("t"), F.col("s"))
    got = spark.createDataFrame(rows, "t string, s string, e boolean, c boolean").select("e", "c", exact.alias("x"), close.alias("y")).collect()
    assert all((r.e, r.c) == (r.x, r.y) for r in got), got
    slots = spark.createDataFrame([("t", 0, "a"), ("t", 0, "b")], "task_id string, step int, slot_id string")
    preds = spark.createDataFrame([("t", 0, "a", True), ("t", 0, "a", None)], "task_id string, step int, slot_id string, ok boolean")
    ok = {r.slot_id: (r.fraction, r.ok, r.almost) for r in T.slot_ok(T.slot_fraction(preds, slots)).collect()}
    assert ok == {"a": (0.5, False, True), "b": (1.0, True, False)}
    none = T.coverage(preds.where("false"), "ok", spark.createDataFrame([("u",)], "task_id string")).first()
    assert (none.coverage_all, none.coverage_mean) == (1.0, 1.0)
    walk = spark.createDataFrame([("t", i, a) for i, a in enumerate(("look_up",) * 6 + ("move_forward", "stop", "move_forward", "turn_left"))], "task_id string, step int, action string")
    poses = T.replay(walk).orderBy("step").collect()
    assert [round(p.pitch, 6) for p in poses] == [15, 30, 45, 60, 75, 75, 75, 75, 75, 75] and [p.x for p in poses[-3:]] == [0.25] * 3 and poses[-1].yaw == 0
    values = spark.createDataFrame([("t", 0, "stop", 0.0, False), ("t", 0, "turn_left", 0.5, False), ("t", 0, "move_forward", 0.25, True), ("t", 1, "stop", 0.0, True)], "task_id string, step int, action string, value double, chosen boolean")
    r = T.regret(values).first()
    assert (r.n_steps, r.mean_regret, r.cumulative_regret, r.mean_necessity, r.redundant_ratio) == (2, 0.125, 0.25, 0.125, 0.5)
