"""Task templates: each gives all qualifying instances of a scene's tables, with their answer and choices.

Instances are rows with the bindings of their template (ids and labels), `gt_answer` and `choices` (the right
one first). A share of `percent` in a hundred, drawn by an integer hash of the ids, gets the other kind of
question where a template has two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.functions import labels as L
from atrium.operators import objects as O
from atrium.operators import occlusion, views
from atrium.operators.storage import written

INSTANTIATORS: dict[str, Callable[..., DataFrame]] = {}
ROOM = ("scene_id", "room_id")


def register_template(name: str):
    def add(build):
        INSTANTIATORS[name] = build
        return build

    return add


def drawn(*keys: str, percent: int = 40) -> Column:
    """True for about so many in a hundred, by the keys alone."""
    total = F.lit(17)
    for k in keys:
        total = (total * 31 + F.col(k) * 7919) % 1_000_003
    return F.pmod(total, F.lit(100)) < percent


def grouped(roomed: DataFrame) -> DataFrame:
    """Candidate objects with the groups of their labels; written, since templates join them with themselves.

    Objects that have their groups already are taken as they are.
    """
    if "g_" in roomed.columns:
        return O.candidate_objects(roomed)
    return written(L.with_groups(written(O.candidate_objects(roomed))))


def room_pairs(objects: DataFrame) -> DataFrame:
    return O.object_pairs(objects)


def volume_ratio(a: str = "a_", b: str = "b_") -> Column:
    return F.greatest(G.volume(a), G.volume(b)) / F.greatest(F.least(G.volume(a), G.volume(b)), F.lit(1e-6))


@register_template("T01")
def category(roomed: DataFrame, most: int = 3) -> DataFrame:
    """What is it: the label among up to three that are easily taken for it."""
    others = O.distractor_labels(O.candidate_objects(roomed), most)
    listed = others.groupBy("scene_id", "object_id").agg(F.sort_array(F.collect_list(F.struct("rank", "label"))).alias("l"))
    joined = roomed.select("scene_id", "object_id", "label").join(listed, ["scene_id", "object_id"])
    return joined.select("scene_id", F.col("object_id").alias("target_id"), F.col("label").alias("gt_answer"), F.concat(F.array("label"), F.transform("l", lambda x: x["label"])).alias("choices"))


@register_template("T04")
def larger(roomed: DataFrame, low: float = 1.15, high: float = 1.5) -> DataFrame:
    """Which of two close labels of a room is larger, where their volumes differ a little."""
    objects = grouped(roomed).where(O.is_meaningful())
    a, b = F.col("a_label"), F.col("b_label")
    obvious = (L.among(a, L.OBVIOUSLY_LARGE) & L.among(b, L.OBVIOUSLY_SMALL)) | (L.among(a, L.OBVIOUSLY_SMALL) & L.among(b, L.OBVIOUSLY_LARGE))
    pairs = room_pairs(objects).where((a != b) & L.close() & ~obvious & volume_ratio().between(low, high))
    answer = F.when(G.volume("a_") > G.volume("b_"), a).otherwise(b)
    return pairs.select("scene_id", F.col("a_object_id").alias("obj_a_id"), F.col("b_object_id").alias("obj_b_id"), answer.alias("gt_answer"), F.array(a, b).alias("choices"))


def with_reference(objects: DataFrame) -> DataFrame:
    """Pairs a < b of comparable objects of a room beside a third one, s_, of another label; ids, labels, masks and centres alone."""
    flags = [c for c in ("landmark", "ok") if c in objects.columns]
    narrow = objects.select(*ROOM, "object_id", "label", "g_", *flags, *(G.center(a).alias(f"c{a}") for a in G.AXES))
    refs = O.prefixed(narrow, "s_", ROOM)
    pairs = room_pairs(narrow).where(L.comparable() & (F.col("a_label") != F.col("b_label")))
    return pairs.join(refs, list(ROOM)).where((F.col("s_label") != F.col("a_label")) & (F.col("s_label") != F.col("b_label")))


def apart(a: str, b: str) -> Column:
    """Distance of two centres held as columns cx, cy, cz."""
    d = [F.col(f"{a}c{x}") - F.col(f"{b}c{x}") for x in G.AXES]
    return F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])


@register_template("T05")
def closer(roomed: DataFrame, ratio: float = 1.3) -> DataFrame:
    """Which of two comparable references is closer to a subject."""
    objects = grouped(roomed).withColumn("landmark", O.is_landmark(marked=True)).where(O.is_meaningful(0.03))
    rows = with_reference(objects)
    both = F.col("a_g_").bitwiseOR(F.col("b_g_"))
    fits = (F.col("s_g_") != 0) & (both != 0) & ((F.col("s_g_").bitwiseAND(both) != 0) | F.col("s_landmark"))
    rows = rows.withColumns({"da": apart("s_", "a_"), "db": apart("s_", "b_")}).where(fits & (F.least("da", "db") >= 1e-3) & (F.greatest("da", "db") >= ratio * F.least("da", "db")))
    answer = F.when(F.col("da") < F.col("db"), F.col("a_label")).otherwise(F.col("b_label"))
    return rows.select("scene_id", F.col("s_object_id").alias("subject_id"), F.col("a_object_id").alias("ref_b_id"), F.col("b_object_id").alias("ref_c_id"), answer.alias("gt_answer"), F.array("a_label", "b_label").alias("choices"))


@register_template("T06")
def clearance(portals: DataFrame, objects: DataFrame) -> DataFrame:
    """Does a piece of furniture fit through a door of its scene: close calls."""
    doors = portals.where((F.col("type") == "DOOR") & F.col("width").between(0.55, 2.5) & F.col("room_a").isNotNull() & F.col("room_b").isNotNull()).select("scene_id", "portal_id", "width")
    moved = O.candidate_objects(objects).where(G.xy_max_dim().between(0.30, 3.0) & L.among(F.col("label"), L.MOVEABLE)).select("scene_id", "object_id", G.xy_max_dim().alias("size_"))
    margin = F.col("width") - F.col("size_")
    rows = doors.join(moved, "scene_id").where(margin.between(-0.4, 0.6))
    return rows.select("scene_id", F.col("portal_id").alias("bottleneck_0_id"), F.col("object_id").alias("target_id"), margin.alias("clearance_margin_m"), F.when(margin > 0, "yes").otherwise("no").alias("gt_answer"), F.array(F.lit("yes"), F.lit("no")).alias("choices"))


@register_template("T08")
def straight_line(roomed: DataFrame, least: int = 3, most: int = 5, reach: float = 2.8, radius: float = 2.2) -> DataFrame:
    """Does a compact group stand in a line: for each seed the nearest object of each label of its groups."""
    objects = grouped(roomed).where(O.is_meaningful())
    seeds, others = O.prefixed(objects.where("g_ <> 0"), "a_", ROOM), O.prefixed(objects, "b_", ROOM)
    met = seeds.join(others, list(ROOM)).where(L.shares("a_g_", "b_g_")).withColumn("d", F.round(G.xy_distance("a_", "b_"), 9)).where((F.col("d") <= reach) | (F.col("a_object_id") == F.col("b_object_id")))
    seed = Window.partitionBy("scene_id", "a_object_id")
    once = met.withColumn("k", F.row_number().over(Window.partitionBy("scene_id", "a_object_id", "b_label").orderBy("d", "b_object_id"))).where("k = 1")
    group = once.withColumn("k", F.row_number().over(seed.orderBy("d", "b_object_id"))).where(F.col("k") <= most)
    x, y = G.center("x", "b_"), G.center("y", "b_")
    named = group.select("scene_id", F.col("a_object_id").alias("seed_id"), F.col("b_object_id").alias("object_id"), x.alias("x"), y.alias("y"))
    # At most `most` members each: their array is bounded.
    held = named.groupBy("scene_id", "seed_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("object_id", "x", "y"))).alias("m"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"), F.covar_pop("x", "y").alias("vxy"))
    off = F.transform("m", lambda p: F.struct(F.round(F.sqrt((p["x"] - F.col("mx")) * (p["x"] - F.col("mx")) + (p["y"] - F.col("my")) * (p["y"] - F.col("my"))), 9).alias("d"), p["object_id"].alias("id")))
    out = held.where(F.col("n") >= least).withColumn("off", off).where(F.array_max("off").getField("d") <= radius)
    mid, half = (F.col("vx") + F.col("vy")) / 2, F.sqrt((F.col("vx") - F.col("vy")) * (F.col("vx") - F.col("vy")) / 4 + F.col("vxy") * F.col("vxy"))
    ratio = F.when(mid + half > 0, F.sqrt(F.greatest(F.lit(0.0), mid - half) / (mid + half))).otherwise(F.lit(0.0))
    out = out.withColumn("ratio", ratio)
    return out.select("scene_id", "seed_id", F.transform("m", lambda p: p["object_id"]).alias("group_ids"), F.array_min("off").getField("id").alias("group_centroid_proxy"), "ratio", F.when(F.col("ratio") < 0.10, "yes").otherwise("no").alias("gt_answer"), F.array(F.lit("yes"), F.lit("no")).alias("choices"))


@register_template("T11")
def single_or_multiple(roomed: DataFrame, percent: int = 40) -> DataFrame:
    """One piece or several: near pairs of close labels and like shapes; some of their objects alone."""
    objects = grouped(roomed)
    same = F.lower("a_label") == F.lower("b_label")
    level = F.abs(G.center("z", "a_") - G.center("z", "b_")) <= 0.8
    pairs = room_pairs(objects).where(L.close() & (G.xy_distance("a_", "b_") <= 1.2) & level & (same | G.similar_shape("a_", "b_", 0.16, 2.0)))
    many = pairs.select("scene_id", F.col("a_object_id").alias("pair_a_id"), F.col("b_object_id").alias("pair_b_id"), F.col("a_label").alias("label"))
    one = many.where(drawn("pair_a_id", percent=percent)).select("scene_id", "pair_a_id", F.col("pair_a_id").alias("pair_b_id"), "label").distinct()
    tell = lambda rows, answer, other: rows.withColumns({"gt_answer": F.lit(answer), "choices": F.array(F.lit(answer), F.lit(other))})
    return tell(many, "multiple", "single").unionByName(tell(one, "single", "multiple"))


def occluded_pairs(roomed: DataFrame, rooms: DataFrame, blockers: DataFrame, beyond: float = 1.5, height: float = 0.8, least: float = 0.6) -> DataFrame:
    """(scene_id, room_id, occluder_id, object_id, labels): what a plausible occluder hides from a camera beyond it.

    The camera stands on the far side of the occluder, where positions are valid, and looks at the target.
    """
    objects = grouped(roomed)
    a, b = O.prefixed(objects, "o_", ROOM).where(L.holds("o_mk_", ("occluder",), L.MARKS)), objects.where(~L.holds("g_", ("flat_wall_visual",)))
    plausible = O.is_meaningful(0.01) & (G.volume() <= 1.2 * F.greatest(G.volume("o_"), F.lit(1e-6)))
    pairs = a.join(b, list(ROOM)).where((F.col("o_object_id") != F.col("object_id")) & plausible)
    d = [G.center(x, "o_") - G.center(x) for x in G.AXES]
    size = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    seen_from = pairs.withColumn("size_", size).where("size_ >= 1e-3").withColumns(
        {"px": G.center("x", "o_") + F.try_divide(d[0], F.col("size_")) * beyond, "py": G.center("y", "o_") + F.try_divide(d[1], F.col("size_")) * beyond, "pz": F.lit(height), "tx": G.center("x"), "ty": G.center("y"), "tz": G.center("z")}
    )
    valid = O.valid_positions(seen_from.withColumn("key_", F.struct("o_object_id", "object_id")), rooms, roomed)
    valid = valid.withColumnsRenamed({"o_object_id": "occluder_id", "o_label": "occluder_label"})
    seen = views.with_projection(views.with_camera(valid.select(*ROOM, "occluder_id", "occluder_label", "object_id", "label", *(f"{n}_{x}" for x in G.AXES for n in ("min", "max")), "px", "py", "pz", "tx", "ty", "tz")))
    hidden = occlusion.visibility(seen, blockers, ("scene_id", "occluder_id", "object_id"))
    return hidden.where(F.col("occluded") >= least).select(*ROOM, "occluder_id", "occluder_label", "object_id", "label")


@register_template("T13")
def continuous(pairs: DataFrame) -> DataFrame:
    """One piece or two behind an occluder; on boxes alone always one."""
    return pairs.select("scene_id", F.col("occluder_id").alias("front_id"), F.col("object_id").alias("back_id"), F.lit("continuous").alias("gt_answer"), F.array(F.lit("continuous"), F.lit("separate")).alias("choices"))


@register_template("T15")
def face_text(objects: DataFrame) -> DataFrame:
    """What the labelled face says: objects with a label_side."""
    text = F.coalesce("label_face_text", F.lit("unknown"))
    known = O.candidate_objects(objects).where(F.col("label_side").isin("left", "right", "top", "bottom", "back"))
    return known.select("scene_id", F.col("object_id").alias("target_id"), "label_side", text.alias("gt_answer"), F.array(text, F.lit("unknown_a"), F.lit("unknown_b")).alias("choices"))


@register_template("T17")
def hidden_exists(pairs: DataFrame, roomed: DataFrame, percent: int = 40) -> DataFrame:
    """Is there a label behind an occluder: the hidden one, or for some a plausible label of the room that isn't there."""
    objects = grouped(roomed)
    target = O.prefixed(objects, "a_", ROOM)
    others = O.prefixed(objects, "b_", ROOM)
    keyed = pairs.select("scene_id", "occluder_id", F.col("object_id").alias("a_object_id"))
    met = keyed.join(target, ["scene_id", "a_object_id"]).join(others, list(ROOM))
    fits = (F.col("b_object_id") != F.col("a_object_id")) & (F.col("b_object_id") != F.col("occluder_id")) & (F.col("a_label") != F.col("b_label")) & (G.similar_shape("a_", "b_", 0.25, 3.0) | L.confusable())
    decoys = met.where(fits).groupBy("scene_id", "occluder_id", F.col("a_object_id").alias("object_id")).agg(F.min("b_label").alias("decoy"))
    rows = pairs.join(decoys, ["scene_id", "occluder_id", "object_id"], "left").withColumn("absent", drawn("occluder_id", "object_id", percent=percent) & F.col("decoy").isNotNull())
    answer = F.when(F.col("absent"), "no").otherwise("yes")
    return rows.select("scene_id", "occluder_id", F.when(~F.col("absent"), F.col("object_id")).alias("target_id"), F.when(F.col("absent"), F.col("decoy")).otherwise(F.col("label")).alias("target_label"), answer.alias("gt_answer"), F.array(answer, F.when(F.col("absent"), "yes").otherwise("no")).alias("choices"))


@register_template("T18")
def hidden_category(pairs: DataFrame, roomed: DataFrame) -> DataFrame:
    """What is behind an occluder, among labels easily taken for it."""
    named = category(roomed).withColumnRenamed("target_id", "object_id")
    return pairs.select("scene_id", "occluder_id", "object_id").join(named, ["scene_id", "object_id"]).select("scene_id", "occluder_id", F.col("object_id").alias("target_id"), "gt_answer", "choices")


@register_template("T19")
def completeness(pairs: DataFrame) -> DataFrame:
    return pairs.select("scene_id", "occluder_id", F.col("object_id").alias("target_id"), F.lit("complete").alias("gt_answer"), F.array(*map(F.lit, ("complete", "broken", "partial"))).alias("choices"))


@register_template("T20")
def bearing_search(roomed: DataFrame) -> DataFrame:
    """Find the target, not the close label of its room with the least id."""
    objects = grouped(roomed)
    both = O.both_ways(
        room_pairs(objects).where((F.col("a_label") != F.col("b_label")) & L.close()).withColumns({"a_ok": O.is_meaningful(0.02, "a_"), "b_ok": O.is_meaningful(0.02, "b_")}),
        {n: (F.col(f"{p}{c}"), F.col(f"{q}{c}")) for n, c, p, q in (("target_id", "object_id", "a_", "b_"), ("gt_answer", "label", "a_", "b_"), ("ok", "ok", "a_", "b_"), ("other_id", "object_id", "b_", "a_"), ("other", "label", "b_", "a_"))},
    )
    best = both.where("ok").groupBy("scene_id", "target_id", "gt_answer").agg(F.min(F.struct("other_id", "other")).alias("m"))
    return best.select("scene_id", "target_id", "gt_answer", F.array("gt_answer", "m.other").alias("choices"))


@register_template("T21")
def nearest_of_two(roomed: DataFrame, difference: float = 0.4, ratio: float = 1.25) -> DataFrame:
    """Which of two comparable objects is nearer to a landmark."""
    objects = grouped(roomed).withColumns({"landmark": O.is_landmark(marked=True), "ok": O.is_meaningful(0.02)})
    rows = with_reference(objects).where("s_landmark AND a_ok AND b_ok").withColumns({"da": apart("s_", "a_"), "db": apart("s_", "b_")})
    rows = rows.where((F.abs(F.col("da") - F.col("db")) >= difference) & (F.least("da", "db") > 1e-6) & (F.greatest("da", "db") >= ratio * F.least("da", "db")))
    answer = F.when(F.col("da") < F.col("db"), F.col("a_label")).otherwise(F.col("b_label"))
    return rows.select("scene_id", F.col("s_object_id").alias("reference_id"), F.col("a_object_id").alias("obj_a_id"), F.col("b_object_id").alias("obj_b_id"), answer.alias("gt_answer"), F.array("a_label", "b_label").alias("choices"))


def doors(portals: DataFrame) -> DataFrame:
    return portals.where((F.col("type") == "DOOR") & F.col("room_a").isNotNull() & F.col("room_b").isNotNull())


@register_template("T23")
def next_room(portals: DataFrame, roomed: DataFrame) -> DataFrame:
    """Is there a label in the room behind a door: each object's there, and each label of this room that isn't there."""
    have = O.candidate_objects(roomed).select("scene_id", "room_id", "object_id", "label")
    door = doors(portals).select("scene_id", "portal_id", "room_a", "room_b")
    yes = door.join(have.withColumnRenamed("room_id", "room_b"), ["scene_id", "room_b"]).select("scene_id", "portal_id", "room_a", "room_b", F.col("object_id").alias("target_id"), F.col("label").alias("target_label"), F.lit("yes").alias("gt_answer"))
    here = door.join(have.select("scene_id", F.col("room_id").alias("room_a"), F.lower("label").alias("target_label")).distinct(), ["scene_id", "room_a"])
    there = have.select("scene_id", F.col("room_id").alias("room_b"), F.lower("label").alias("target_label")).distinct()
    occupied = have.select("scene_id", F.col("room_id").alias("room_b")).distinct()
    no = here.join(occupied, ["scene_id", "room_b"], "left_semi").join(there, ["scene_id", "room_b", "target_label"], "left_anti").select("scene_id", "portal_id", "room_a", "room_b", F.lit(None).cast("long").alias("target_id"), "target_label", F.lit("no").alias("gt_answer"))
    return yes.unionByName(no).withColumn("choices", F.when(F.col("gt_answer") == "yes", F.array(F.lit("yes"), F.lit("no"))).otherwise(F.array(F.lit("no"), F.lit("yes"))))


@register_template("T24")
def door_direction(portals: DataFrame, placed: DataFrame) -> DataFrame:
    """On which side is a door of the room that a view stands in."""
    door = doors(portals).select("scene_id", "portal_id", F.col("room_a").alias("room_id"), "x", "y")
    rows = placed.join(door, ["scene_id", "room_id"])
    side = G.bearing_label(G.signed_yaw(F.col("tx") - F.col("px"), F.col("ty") - F.col("py"), F.col("x") - F.col("px"), F.col("y") - F.col("py")))
    pool = F.array(*map(F.lit, ("left", "right", "ahead", "behind")))
    return rows.withColumn("gt_answer", side).select("scene_id", "view_id", "portal_id", "room_id", "gt_answer", F.concat(F.array("gt_answer"), F.array_remove(pool, F.col("gt_answer"))).alias("choices"))


@register_template("T26")
def hidden_count(roomed: DataFrame, neighbours: int = 6, least: int = 3, radius: float = 2.0) -> DataFrame:
    """How many of a label stand together, some behind an occluder: a scene's tightest cluster of each label and its best occluder."""
    objects = grouped(roomed)
    key = ["scene_id", F.lower("label").alias("label")]
    p = objects.select(*key, "object_id", "room_id", G.center("x").alias("x"), G.center("y").alias("y"), G.center("z").alias("z"), G.dim("x").alias("dx"), G.dim("y").alias("dy"), G.dim("z").alias("dz"), "g_")
    plain = p.select("scene_id", "label", "object_id", "x", "y", "z")
    a, b = plain.withColumnsRenamed({"object_id": "seed_id", "x": "sx", "y": "sy"}).drop("z"), plain
    d = F.round(F.sqrt((F.col("x") - F.col("sx")) * (F.col("x") - F.col("sx")) + (F.col("y") - F.col("sy")) * (F.col("y") - F.col("sy"))), 9)
    near = a.join(b, ["scene_id", "label"]).withColumn("d", d)
    near = near.withColumn("k", F.row_number().over(Window.partitionBy("scene_id", "label", "seed_id").orderBy("d", "object_id"))).where(F.col("k") <= neighbours)
    seed = ["scene_id", "label", "seed_id"]
    mean = near.groupBy(*seed).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg("z").alias("mz"), F.count("*").alias("n")).where(F.col("n") >= least)
    off = F.sqrt((F.col("x") - F.col("mx")) * (F.col("x") - F.col("mx")) + (F.col("y") - F.col("my")) * (F.col("y") - F.col("my")))
    sized = near.join(mean, seed).groupBy(*seed, "mx", "my", "mz", "n").agg(F.round(F.max(off), 6).alias("radius"), F.min("object_id").alias("first_id")).where(F.col("radius") <= radius)
    tight = sized.withColumn("k", F.row_number().over(Window.partitionBy("scene_id", "label").orderBy("radius", "seed_id"))).where("k = 1").drop("k")
    home = tight.join(p.select("scene_id", F.col("object_id").alias("first_id"), "room_id", F.col("g_").alias("target_g_")), ["scene_id", "first_id"])
    occ = p.select("scene_id", "room_id", F.col("object_id").alias("occluder_id"), F.col("label").alias("occluder_label"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("z").alias("oz"), F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy") + F.col("dz") * F.col("dz")).alias("diag"), F.col("g_").alias("og_"))
    hides = F.lit(False)
    for group, hidden in L.HIDES.items():
        hides = hides | (L.holds("og_", (group,)) & L.holds("target_g_", hidden))
    far = F.sqrt((F.col("ox") - F.col("mx")) * (F.col("ox") - F.col("mx")) + (F.col("oy") - F.col("my")) * (F.col("oy") - F.col("my")) + (F.col("oz") - F.col("mz")) * (F.col("oz") - F.col("mz")))
    met = home.join(occ, ["scene_id", "room_id"]).where((F.col("occluder_label") != F.col("label")) & hides).withColumn("far", far).where((F.col("diag") >= 0.60) & (F.col("far") < 1.8))
    best = met.groupBy("scene_id", "label", "n").agg(F.min(F.struct(F.round(F.col("far") - 0.15 * F.col("diag"), 9).alias("score"), "occluder_id")).getField("occluder_id").alias("occluder_id"))
    n = F.col("n")
    return best.select("scene_id", F.col("label").alias("target_label"), "occluder_id", n.cast("string").alias("gt_answer"), F.array_distinct(F.array(n, F.greatest(n - 1, F.lit(1)), n + 1, F.greatest(n - 2, F.lit(1)))).cast("array<string>").alias("choices"))


@register_template("T27")
def two_rooms(roomed: DataFrame, edges: DataFrame, most: int = 5) -> DataFrame:
    """How many of a label in two rooms together, each with one to five; connected says whether a door joins them."""
    counts = O.zone_counts(O.candidate_objects(roomed).withColumn("label", F.lower("label")), most)
    rows = counts.join(edges.select("scene_id", F.col("src").alias("room_a"), F.col("dst").alias("room_b"), F.lit(True).alias("joined")), ["scene_id", "room_a", "room_b"], "left")
    n = F.col("n_a") + F.col("n_b")
    return rows.select("scene_id", F.col("room_a").alias("zone_a_id"), F.col("room_b").alias("zone_b_id"), F.col("label").alias("target_label"), F.coalesce("joined", F.lit(False)).alias("connected"), n.cast("string").alias("gt_answer"), F.array(n, n - 1, n + 1).cast("array<string>").alias("choices"))


def contact_relation(a: str = "a_", b: str = "b_") -> Column:
    """How a stands to b: resting_on (b under a), under (a under b), beside, or null; by boxes and what labels allow."""
    area = F.col("overlap_")
    rests = lambda top, bottom: (F.abs(G.hi("z", bottom) - G.lo("z", top)) < 0.08) & (area > 0.01) & L.among(F.col(f"{top}label"), L.SUPPORTED) & L.among(F.col(f"{bottom}label"), L.SUPPORTS) & (G.footprint(top) <= 0.75 * G.footprint(bottom))
    pairs = F.lit(False)
    for x, y in L.BESIDE_GROUPS:
        pairs = pairs | (L.holds(f"{a}g_", (x,)) & L.holds(f"{b}g_", (y,))) | (L.holds(f"{a}g_", (y,)) & L.holds(f"{b}g_", (x,)))
    gap = G.box_distance(a, b, ("x", "y"))
    beside = (gap <= 0.20) & (F.abs(G.lo("z", a) - G.lo("z", b)) < 0.10) & L.among(F.col(f"{a}label"), L.BESIDE) & L.among(F.col(f"{b}label"), L.BESIDE) & pairs & (area <= 0.05 * F.least(G.footprint(a), G.footprint(b)))
    return F.when(rests(b, a), "under").when(rests(a, b), "resting_on").when(beside, "beside")


@register_template("T29")
def contact(objects: DataFrame) -> DataFrame:
    """How two objects of a scene touch; the one on top comes first. Only boxes in cells next to each other meet."""
    cell = 1.0
    kept = grouped(objects)
    spread = lambda p, by: O.prefixed(kept, p, ("scene_id",)).withColumn("i", F.explode(O.cells(G.lo("x", p) - by, G.hi("x", p) + by, cell))).withColumn("j", F.explode(O.cells(G.lo("y", p) - by, G.hi("y", p) + by, cell)))
    pairs = spread("a_", 0.2).join(spread("b_", 0.0), ["scene_id", "i", "j"]).where("a_object_id < b_object_id")
    rows = pairs.withColumn("overlap_", G.overlap_xy("a_", "b_")).withColumn("rel", contact_relation()).where("rel IS NOT NULL").select("scene_id", "a_object_id", "b_object_id", "a_label", "b_label", "rel").distinct()
    turned = F.col("rel") == "under"
    answer = F.when(turned, "resting_on").otherwise(F.col("rel"))
    return rows.select("scene_id", F.when(turned, F.col("b_object_id")).otherwise(F.col("a_object_id")).alias("obj_a_id"), F.when(turned, F.col("a_object_id")).otherwise(F.col("b_object_id")).alias("obj_b_id"), answer.alias("gt_answer"), F.array(*map(F.lit, ("touching", "resting_on", "beside", "stacked_above"))).alias("choices"))


@register_template("T32")
def without_passing(whole: DataFrame, blocked: DataFrame) -> DataFrame:
    """Can a room be reached without passing another: whole has (scene_id, start, room), blocked (scene_id, start, blocked, room)."""
    ends = whole.where("start <> room").select("scene_id", "start", F.col("room").alias("end"))
    others = whole.select("scene_id", F.col("room").alias("excluded")).distinct()
    rows = ends.join(others, "scene_id").where("excluded <> start AND excluded <> end")
    got = blocked.select("scene_id", "start", F.col("blocked").alias("excluded"), F.col("room").alias("end"), F.lit(True).alias("got"))
    answer = F.when(F.coalesce("got", F.lit(False)), "yes").otherwise("no")
    return rows.join(got, ["scene_id", "start", "excluded", "end"], "left").select("scene_id", "start", "end", "excluded", answer.alias("gt_answer"), F.array(F.lit("yes"), F.lit("no")).alias("choices"))


@register_template("T33")
def passable(portals: DataFrame, agents: dict[str, float] = L.AGENTS, spare: float = 0.05) -> DataFrame:
    """Does each kind of agent fit through each door."""
    width = F.explode(F.array(*(F.struct(F.lit(n).alias("agent_type"), F.lit(w).alias("agent_width")) for n, w in sorted(agents.items()))))
    rows = portals.where((F.col("type") == "DOOR") & F.col("width").between(0.40, 2.5)).select("scene_id", F.col("portal_id").alias("passage_id"), "width", width.alias("agent")).select("scene_id", "passage_id", "width", "agent.*")
    return rows.select("scene_id", "passage_id", "agent_type", F.when(F.col("width") >= F.col("agent_width") + spare, "yes").otherwise("no").alias("gt_answer"), F.array(F.lit("yes"), F.lit("no")).alias("choices"))


#: Templates that need annotations of boxes, and why a scene without them gives no instance: fixed values.
NEEDS = {"T14": "front_normal", "T16": "front_normal and front_back_diff_flag"}


@register_template("T14")
@register_template("T16")
def unmet(scenes: DataFrame, needs: dict[str, str] = NEEDS) -> DataFrame:
    """(scene_id, template_id, reason) of templates that no scene can meet."""
    rows = F.explode(F.array(*(F.struct(F.lit(t).alias("template_id"), F.lit(f"needs {what}").alias("reason")) for t, what in sorted(needs.items()))))
    return scenes.select("scene_id").distinct().select("scene_id", rows.alias("n")).select("scene_id", "n.*")


def shuffled(choices: Column, *keys: Column) -> Column:
    """The choices in an order that an integer hash of the keys and their place gives."""
    total = F.lit(11).cast("long")
    for k in keys:
        total = (total * 31 + k) % 1_000_003
    ordered = F.array_sort(F.transform(choices, lambda c, i: F.struct(((total + (i + 1) * 7919) * 104_729 % 1_000_003).alias("h"), i.alias("i"), c.alias("c"))))
    return F.transform(ordered, lambda x: x["c"])
