"""Views for the evidence slots of template instances: candidates, feasibility, the first view and the way.

Instances of all templates are rows of one shape (scene_id, template_id, key) with bindings of names to object
ids, and the catalog's tables say which generator and predicates a slot has: one plan for all templates, in
which names are joined, not looked up. Only object bindings are bound here; a predicate whose object an instance
doesn't bind fails. Nulls: a predicate that can't be told fails, and an instance without slots is feasible.
Ties go to the lower candidate number. Empty inputs give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators import generators as V
from atrium.operators import objects as O
from atrium.operators import occlusion, predicates, validators, views
from atrium.operators.storage import written

KEY = ("scene_id", "template_id", "key")
POSE = V.VIEW
#: Keys are folds of ids below this prime, the greatest below 2 ** 42.
FOLD, TIMES = 4_398_046_511_093, 1_000_003
#: For each generator its object arguments in order, the centre (mean of all, or the first), whether its base
#: direction is that from the first to the second, the range of degrees from it and whether they go either way,
#: and whether both must be about equally far. A range's end may be an argument: fixed values.
FAMILIES = [
    ("around_object", ("target",), "mean", False, "0", "360", False, False),
    ("around_pair", ("obj_a", "obj_b"), "mean", False, "0", "360", False, False),
    ("equidistant_to_pair", ("obj_a", "obj_b"), "mean", False, "0", "360", False, True),
    ("view_of_triple", ("obj_a", "obj_b", "reference"), "mean", False, "0", "360", False, False),
    ("behind_front_object", ("front_obj", "back_obj"), "mean", True, "side_angle_min_deg", "90", True, False),
    ("around_occluder_back", ("occluder", "target"), "first", True, "-60", "60", False, False),
    ("around_occluder_to_expose", ("occluder", "target"), "first", True, "-60", "60", False, False),
]
#: Objects by role in a template's validators, and whose centre its first view looks at: fixed values.
ROLES = {"T01": ("target_id",), "T04": ("obj_a_id", "obj_b_id"), "T05": ("subject_id", "ref_b_id", "ref_c_id"), "T21": ("obj_a_id", "obj_b_id", "reference_id")}
ANCHORS = {"T01": 1, "T04": 2, "T05": 1, "T21": 3}
SEES = ("n_visible", "occluded", "n_corners", "box_w", "box_h", "distance", "bearing", "angle")


def fold(template_id: str, *ids: Column) -> Column:
    """One integer for the ids of an instance; it is as good as unique within a scene."""
    total = F.lit(int(template_id[1:])).cast("long")
    for i in ids:
        total = F.pmod(total * TIMES + i, F.lit(FOLD))
    return total


def instances_of(rows: DataFrame, template_id: str, names: dict[str, str] | tuple[str, ...]) -> DataFrame:
    """Rows of an instantiator as (scene_id, template_id, key, gt_answer, choices, bound); names are its id columns, or bindings of them."""
    named = names if isinstance(names, dict) else {n: n for n in names}
    bound = F.array(*(F.struct(F.lit(n).alias("name"), F.col(c).cast("long").alias("object_id")) for n, c in named.items()))
    ids = list(dict.fromkeys(named.values()))
    return rows.select("scene_id", F.lit(template_id).alias("template_id"), fold(template_id, *map(F.col, ids)).alias("key"), "gt_answer", "choices", bound.alias("bound"))


def drawn_instances(instances: DataFrame, n: int) -> DataFrame:
    """n instances of each scene and template, by a hash of their keys: the tasks that are asked for."""
    order = F.row_number().over(Window.partitionBy("scene_id", "template_id").orderBy(F.pmod(F.col("key") * 7919, F.lit(V.LATTICE)), "key"))
    return instances.withColumn("order_", order).where(F.col("order_") <= n).drop("order_")


def bindings_of(instances: DataFrame) -> DataFrame:
    return instances.select(*KEY, F.inline("bound")).where("object_id IS NOT NULL")


def centres(objects: DataFrame) -> DataFrame:
    return objects.select("scene_id", "object_id", *(G.center(a).alias(f"c{a}") for a in G.AXES))


def slot_targets(instances: DataFrame, catalog: dict[str, DataFrame], objects: DataFrame) -> DataFrame:
    """One row per slot of an instance: where its generator's views stand and look, and within which distances and angles."""
    spark = instances.sparkSession
    families = spark.createDataFrame([(f[0], a, k, *f[2:]) for f in FAMILIES for k, a in enumerate(f[1])], "generator string, argument string, at int, centre string, along boolean, low string, high string, signed boolean, balanced boolean")
    slots = catalog["slots"].join(families, "generator").join(catalog["regions"].select("template_id", "slot_id", "argument", "name"), ["template_id", "slot_id", "argument"])
    numbers = catalog["regions"].where("number IS NOT NULL").groupBy("template_id", "slot_id").agg(F.map_from_entries(F.collect_list(F.struct("argument", "number"))).alias("given"))
    bound = instances.select(*KEY).join(F.broadcast(slots), "template_id").join(bindings_of(instances), [*KEY, "name"]).join(centres(objects), ["scene_id", "object_id"])
    first = lambda c, k: F.max(F.when(F.col("at") == k, F.col(c)))
    of = ["generator", "place", "centre", "along", "low", "high", "signed", "balanced"]
    rows = bound.groupBy(*KEY, "slot_id", *of).agg(F.avg("cx").alias("mx"), F.avg("cy").alias("my"), *(first(f"c{a}", k).alias(f"{p}{a}_") for k, p in enumerate("ab") for a in "xy"))
    rows = rows.join(F.broadcast(numbers), ["template_id", "slot_id"], "left")
    number = lambda name, default: F.coalesce(F.element_at("given", F.lit(name)), F.lit(default))
    end = lambda c: F.coalesce(F.col(c).try_cast("double"), F.element_at("given", F.col(c)))
    dx, dy = F.col("bx_") - F.col("ax_"), F.col("by_") - F.col("ay_")
    size = F.sqrt(dx * dx + dy * dy)
    alone = F.col("centre") == "first"
    made = rows.withColumns({
        "ox": F.when(alone, F.col("ax_")).otherwise(F.col("mx")), "oy": F.when(alone, F.col("ay_")).otherwise(F.col("my")),
        "lx": F.when(alone, F.col("bx_")).otherwise(F.col("mx")), "ly": F.when(alone, F.col("by_")).otherwise(F.col("my")),
        "bx": F.when(F.col("along"), F.try_divide(dx, size)).otherwise(F.lit(1.0)), "by": F.when(F.col("along"), F.try_divide(dy, size)).otherwise(F.lit(0.0)),
        "near": number("dist_min", 0.8), "far": number("dist_max", 3.0), "least_z": number("height_min", V.HEIGHT), "most_z": number("height_max", V.HEIGHT),
        "turn_low": end("low"), "turn_high": end("high"), "ratio": number("max_log_dist_ratio", 0.5),
    })
    slot_key = F.pmod(F.col("key") * 31 + F.col("place"), F.lit(FOLD)).alias("slot_key")
    return made.where(~F.col("along") | (size >= 1e-6)).select(*KEY, "slot_id", slot_key, "ox", "oy", "lx", "ly", "bx", "by", "near", "far", "least_z", "most_z", "turn_low", "turn_high", "signed", "balanced", "ratio", *(f"{p}{a}_" for p in "ab" for a in "xy"))


def slot_views(targets: DataFrame, rooms: DataFrame, objects: DataFrame, n: int) -> DataFrame:
    """(scene_id, template_id, key, grp, i, pose): the first n valid candidates of each slot; grp is the slot's id."""
    rows = targets.withColumnRenamed("key", "instance_").withColumnRenamed("slot_key", "key")
    turn = F.radians(V.spread(F.col("u1"), F.col("turn_low"), F.col("turn_high"))) * F.when(F.col("signed") & (F.col("u3") < 0.5), -1.0).otherwise(1.0)
    x, y = V.rotated(F.col("bx"), F.col("by"), turn)
    d, z = V.spread(F.col("u2"), F.col("near"), F.col("far")), V.spread(F.col("u3"), F.col("least_z"), F.col("most_z"))
    points = V.draws(rows, n).withColumns({"px": F.col("ox") + d * x, "py": F.col("oy") + d * y, "pz": z, "tx": F.col("lx"), "ty": F.col("ly"), "tz": z})
    away = {p: F.sqrt((F.col("px") - F.col(f"{p}x_")) * (F.col("px") - F.col(f"{p}x_")) + (F.col("py") - F.col(f"{p}y_")) * (F.col("py") - F.col(f"{p}y_"))) for p in "ab"}
    even = (away["a"] >= 0.2) & (away["b"] >= 0.2) & (F.abs(F.ln(away["a"] / away["b"])) <= F.col("ratio"))
    found = V.first_views(O.valid_positions(points.where(~F.col("balanced") | F.coalesce(even, F.lit(False))), rooms, objects), n)
    return found.join(targets.select("scene_id", F.col("slot_key").alias("s_"), "template_id", F.col("key").alias("k_"), F.col("slot_id").alias("grp")).withColumnsRenamed({"s_": "key"}), ["scene_id", "key"]).select("scene_id", "template_id", F.col("k_").alias("key"), "grp", F.col("i").cast("long").alias("i"), *POSE)


def bound_predicates(instances: DataFrame, catalog: dict[str, DataFrame]) -> DataFrame:
    """One row per predicate of a slot of an instance, with the ids of its objects and its numbers."""
    named = bindings_of(instances)
    rows = instances.select(*KEY).join(F.broadcast(catalog["predicates"]), "template_id")
    for role in ("first", "second"):
        rows = rows.join(named.withColumnsRenamed({"name": role, "object_id": f"{role}_id"}), [*KEY, role], "left")
    return rows


def targets_of(wanted: DataFrame, objects: DataFrame) -> tuple[DataFrame, int]:
    """((KEY, grp, object_id, n, box), most): the objects with a box that a group of views wants, numbered from 1 in the order of their ids; the greatest number."""
    boxes = objects.where("min_x IS NOT NULL").select("scene_id", "object_id", *(f"{n}_{a}" for a in G.AXES for n in ("min", "max")))
    rows = wanted.join(boxes, ["scene_id", "object_id"]).withColumn("n", F.row_number().over(Window.partitionBy(*KEY, "grp").orderBy("object_id")))
    made = written(rows)
    return made, made.agg(F.max("n")).first()[0] or 0


def seen_by(poses: DataFrame, targets: DataFrame, most: int, blockers: DataFrame) -> DataFrame:
    """(KEY, grp, i, pose, cam_f, o1_n_visible ..): each view once, beside what it sees of its targets by their numbers, null beyond them.

    The views lie by scene; targets, blockers and all that is grouped meet there, so that neither pairs nor cells are shuffled or written.
    """
    at, way = [*KEY, "grp", "i"], [f"cam_f{a}" for a in G.AXES]
    pairs = views.with_camera(poses.select(*at, *POSE)).join(targets.hint(O.BUILT), [*KEY, "grp"], "left")
    seen = occlusion.visibility(views.with_projection(pairs), blockers, (*at, "object_id"))
    mine = (F.max(F.when(F.col("n") == k, F.col(c))).alias(f"o{k}_{c}") for k in range(1, most + 1) for c in SEES)
    return seen.groupBy(*at).agg(*(F.max(c).alias(c) for c in (*POSE, *way)), *mine)


def of_number(column: str, number: Column, most: int) -> Column:
    """The column of the target with that number."""
    return F.coalesce(F.lit(None), *(F.when(number == k, F.col(f"o{k}_{column}")) for k in range(1, most + 1)))


def checks_of(tried: DataFrame, bound: DataFrame, targets: DataFrame) -> DataFrame:
    """The predicates of the slots tried (KEY, grp, slot_id), with the numbers first_n, second_n of their objects among the group's targets."""
    rows = tried.join(bound, [*KEY, "slot_id"])
    numbers = targets.select(*KEY, "grp", "object_id", "n")
    for role in ("first", "second"):
        rows = rows.join(numbers.withColumnsRenamed({"object_id": f"{role}_id", "n": f"{role}_n"}), [*KEY, "grp", f"{role}_id"], "left")
    return rows


def slots_at(seen: DataFrame, most: int, checks: DataFrame, slots: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(KEY, grp, i, slot_id, share, ok, strict): the share of a slot's predicates that hold at a view, and whether it is met.

    seen are views by `seen_by`, checks the predicates to look at for each group of views; keep are columns of the view that stay. `strict`
    is the slot's quality check where it has one that is known (both objects about equally far), else `ok`.
    """
    at = [*KEY, "grp", "i"]
    rows = seen.join(checks.hint(O.BUILT), [*KEY, "grp"])
    rows = rows.withColumns({f"{p}{c}": of_number(c, F.col(f"{role}_n"), most) for role, p in (("first", "a_"), ("second", "b_")) for c in SEES})
    c = F.col
    made = {
        "Visible": predicates.visible("a_", c("min_corners"), c("max_occ")),
        "PairVisible": predicates.pair_visible("a_", "b_", c("min_corners"), c("max_occ")),
        "DistanceBand": predicates.holds(c("a_distance").between(c("d_min"), c("d_max"))),
        "AspectExposed": predicates.aspect_exposed("a_", c("min_ratio")),
        "Centered": predicates.centered("a_", c("theta_deg")),
        "ScaleBand": predicates.scale_band("a_", c("s_min"), c("s_max")),
        "BearingWithin": predicates.holds(F.abs(c("a_bearing")) <= c("theta_deg")),
        "NotBlockedBy": predicates.holds(c("a_occluded") < 0.5),
    }
    ok = F.when(F.lit(False), F.lit(False))
    for name, column in made.items():
        ok = ok.when(c("predicate") == name, column)
    even = predicates.pair_visible("a_", "b_", 3, 0.40) & predicates.holds((F.least("a_distance", "b_distance") >= 0.2) & (F.abs(F.ln(c("a_distance") / c("b_distance"))) <= 0.5))
    met = rows.withColumns({"ok_": F.coalesce(ok, F.lit(False)), "even_": (c("predicate") == "PairVisible") & even})
    shares = met.groupBy(*at, "slot_id").agg(F.count("*").alias("n_"), F.count_if("ok_").alias("k_"), F.bool_or("even_").alias("even_"), *(F.max(k).alias(k) for k in keep))
    joined = shares.join(F.broadcast(slots.select("template_id", "slot_id", "place", "threshold", "quality")), ["template_id", "slot_id"])
    met_ = c("k_") >= c("threshold") * c("n_")
    return joined.select(*at, "slot_id", "place", (c("k_") / c("n_")).alias("share"), met_.alias("ok"), (c("k_") >= 0.5 * c("threshold") * c("n_")).alias("almost"), F.when(c("quality") == "distance_balance_check", c("even_")).otherwise(met_).alias("strict"), *keep)


def feasible(instances: DataFrame, catalog: dict[str, DataFrame], evaluated: DataFrame) -> DataFrame:
    """(KEY, n_slots, n_met, n_views, missing): instances with how many of their slots some view of the slot's own meets.

    `missing` names the first slot that none meets; null says that the instance is feasible.
    """
    slots = instances.select(*KEY).join(F.broadcast(catalog["slots"].select("template_id", "slot_id", "place")), "template_id")
    good = evaluated.where("ok AND grp = slot_id").groupBy(*KEY, "slot_id").agg(F.count("*").alias("n"))
    rows = slots.join(good, [*KEY, "slot_id"], "left")
    return rows.groupBy(*KEY).agg(F.count("*").alias("n_slots"), F.count("n").alias("n_met"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_views"), F.min(F.when(F.col("n").isNull(), F.struct("place", "slot_id"))).getField("slot_id").alias("missing"))


def anchors(instances: DataFrame, objects: DataFrame) -> DataFrame:
    """(KEY, cx, cy, cz): the point that an instance's first view looks at, the mean of its anchors to a billionth.

    The last bit of a mean of three depends on the order of its members, and rings around it touch edges of boxes and rooms.
    """
    spark = instances.sparkSession
    table = spark.createDataFrame([(t, n, k < ANCHORS[t]) for t, names in ROLES.items() for k, n in enumerate(names)], "template_id string, name string, anchor boolean").where("anchor")
    rows = bindings_of(instances).join(F.broadcast(table), ["template_id", "name"]).join(centres(objects), ["scene_id", "object_id"])
    return rows.groupBy(*KEY).agg(*(F.round(F.avg(f"c{a}"), 9).alias(f"c{a}") for a in G.AXES))


def first_candidates(instances: DataFrame, rooms: DataFrame, objects: DataFrame, per_room: int = 13) -> DataFrame:
    """(KEY, grp, i, pose): where an instance may begin: positions in all rooms of its scene, then rings around its anchor; all look at it.

    The positions of a scene's rooms are made once, for all its instances. The rows lie by scene.
    """
    at = written(anchors(instances, objects).withColumn("owner", F.pmod(F.col("key") * 31 + 30, F.lit(FOLD))))
    names = rooms.select("scene_id", F.col("room_id").alias("key"), F.col("room_id").alias("wanted_id"))
    spots = V.sample_region("room_positions", names, rooms, objects, n=per_room).select("scene_id", F.lit(None).cast("long").alias("owner"), (F.col("key") * 1000 + F.col("i")).alias("n"), "px", "py", "pz")
    ringed = at.select("scene_id", F.col("owner").alias("key"), F.col("cx").alias("ox"), F.col("cy").alias("oy")).distinct()
    rings = V.sample_region("anchor_rings", ringed, rooms, objects).select("scene_id", F.col("key").alias("owner"), F.col("i").cast("long").alias("n"), "px", "py", "pz")
    # Both are written before they meet the rest: each join by hash holds a page of a task's memory to its end, and a task has few.
    # Their numbers are made after the deal: a join right above it would deal its rows once more, by its own keys.
    number = F.when(F.col("owner").isNull(), F.col("n")).otherwise(F.col("n") + 1_000_000_000_000_000)
    places = O.by_scene(written(spots).unionByName(written(rings))).select(F.col("scene_id").alias("s_"), F.col("owner").alias("o_"), number.alias("i"), "px", "py", "pz")
    rows = places.join(at.hint(O.BUILT), (F.col("s_") == F.col("scene_id")) & F.coalesce(F.col("o_") == F.col("owner"), F.lit(True)))
    dx, dy = F.col("cx") - F.col("px"), F.col("cy") - F.col("py")
    return rows.where(F.sqrt(dx * dx + dy * dy) >= 1e-6).select(*KEY, F.lit("init").alias("grp"), "i", "px", "py", "pz", F.col("cx").alias("tx"), F.col("cy").alias("ty"), F.col("cz").alias("tz"))


def roles_of(instances: DataFrame) -> DataFrame:
    """(KEY, role, anchor, object_id): an instance's objects by their place in its template's validators, from 1."""
    table = instances.sparkSession.createDataFrame([(t, n, k + 1, k < ANCHORS[t]) for t, names in ROLES.items() for k, n in enumerate(names)], "template_id string, name string, role int, anchor boolean")
    return bindings_of(instances).join(F.broadcast(table), ["template_id", "name"]).select(*KEY, "role", "anchor", "object_id")


def first_scores(seen: DataFrame, most: int, instances: DataFrame, targets: DataFrame, specs: list[dict]) -> DataFrame:
    """seen (first views by `seen_by`) with shown, rejected and validator: whether an anchor shows, and what its template's validators say."""
    known_ = targets.where("grp = 'init'").drop("grp").join(roles_of(instances), [*KEY, "object_id"])
    box = [f"{n}_{a}" for a in G.AXES for n in ("min", "max")]
    placed = known_.groupBy(*KEY).agg(*(F.max(F.when(F.col("role") == k, F.col(c))).alias(f"r{k}_{c}") for k in (1, 2, 3) for c in ("n", "anchor", *box)))
    rows = seen.join(O.by_scene(placed).hint(O.BUILT), list(KEY), "left").withColumns({f"r{k}_{c}": of_number(c, F.col(f"r{k}_n"), most) for k in (1, 2, 3) for c in SEES})
    shows = lambda k: F.coalesce(F.col(f"r{k}_anchor") & ((F.col(f"r{k}_n_corners") > 0) | predicates.visible(f"r{k}_", 1, 0.95)), F.lit(False))
    known = {
        "init_apparent_size_ratio_min": lambda v, t: validators.apparent_ratio(v, t.get("init_apparent_size_ratio_max", 1e9), "r1_", "r2_"),
        "max_both_pairs_visible_at_init": lambda v, t: validators.not_both_pairs(v, "r1_", "r2_", "r3_"),
        "init_ordering_ambiguous": lambda v, t: validators.same_bearing(v, "r1_", "r2_"),
        "target_invisible_at_init": lambda v, t: validators.target_hidden(v, "r1_"),
    }
    bad, score = F.lit(False), F.lit(0.0)
    for spec in (s for s in specs if s["template_id"] in ROLES):
        total = validators.total_score({f: known[f](v, spec["trigger"]) for f, v in spec["trigger"].items() if f in known})
        mine = F.col("template_id") == spec["template_id"]
        bad, score = F.when(mine, total["rejected"]).otherwise(bad), F.when(mine, total["score"]).otherwise(score)
    return rows.select(*seen.columns, (shows(1) | shows(2) | shows(3)).alias("shown"), bad.alias("rejected"), score.alias("validator"))


def first_view(instances: DataFrame, evaluated: DataFrame) -> DataFrame:
    """The best first view of each instance, and how its candidates fared: one row per instance.

    evaluated are the slots at the candidates (group 'init') with pose, shown, rejected and validator, by `first_scores`.
    A view must show an anchor, leave some slot unmet, and not be rejected by a validator. Its score is 1, plus half
    the share of slots that are almost met, plus the validators'. Counts: n_examined, n_hidden (no anchor shows),
    n_winning (all slots met), n_rejected, n_accepted. Without an accepted view i, score and pose are null.
    """
    rows = evaluated.groupBy(*KEY, "i").agg(F.count("*").alias("n"), F.count_if("strict").alias("strict"), F.count_if("almost").alias("almost"), *(F.max(c).alias(c) for c in (*POSE, "shown", "rejected", "validator")))
    kind = F.when(~F.col("shown"), "hidden").when(F.col("strict") >= F.col("n"), "winning").when(F.col("rejected"), "rejected").otherwise("accepted")
    total = 1.0 + 0.5 * F.col("almost") / F.col("n") + F.col("validator")
    rows = rows.select(*KEY, "i", *POSE, kind.alias("kind"), F.round(total, 9).alias("total"))
    best = F.max(F.when(F.col("kind") == "accepted", F.struct("total", (-F.col("i")).alias("i"), *POSE)))
    kinds = ("hidden", "winning", "rejected", "accepted")
    counts = rows.groupBy(*KEY).agg(F.count("*").alias("n_examined"), *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds), best.alias("m"))
    named = [f"n_{k}" for k in ("examined", *kinds)]
    told = counts.select(*KEY, *named, F.col("m.total").alias("score"), (-F.col("m.i")).alias("i"), *(F.col(f"m.{c}").alias(c) for c in POSE))
    return instances.select(*KEY).join(told, list(KEY), "left").na.fill(0, named)


def ways(starts: DataFrame, candidates: DataFrame, evaluated: DataFrame, slots: DataFrame) -> DataFrame:
    """The way over an instance's slots: (KEY, n_views, length, route), route the views' (slot, i) in order.

    Every order of the slots is a row. From its last view an order goes to the nearest view (in the plane, ties to the
    lower i) that meets its next slot (`strict`), and passes over slots that a view on its way has met already; the shortest order
    wins, the first of equals. One join a step, whose frontier is written; as many steps as a template has slots at
    most. Instances without a view for a slot have no way. starts: (KEY, px, py).
    """
    orders = slot_orders(slots)
    met = evaluated.where("strict").groupBy(*KEY, "grp", "i").agg(F.sum(F.expr("shiftleft(1, place)")).alias("meets"))
    pool = candidates.join(met, [*KEY, "grp", "i"]).select(*KEY, "grp", "i", F.col("px").alias("x"), F.col("py").alias("y"), "meets")
    place = slots.select("template_id", F.col("slot_id").alias("grp"), F.col("place").alias("place_"))
    pool = pool.join(F.broadcast(place), ["template_id", "grp"]).where(F.col("meets").bitwiseAND(F.expr("shiftleft(1, place_)")) != 0)
    front = starts.select(*KEY, "px", "py").join(F.broadcast(orders), "template_id").withColumns({"covered": F.lit(0), "length": F.lit(0.0), "route": F.array().cast("array<struct<grp:string,i:bigint>>")})
    most = orders.agg(F.max(F.size("places"))).first()[0] or 0
    for step in range(most):
        # try_element_at is null beyond an order's end
        now = front.withColumn("place_", F.try_element_at("places", F.lit(step + 1)))
        on = F.col("place_").isNotNull() & (F.col("covered").bitwiseAND(F.expr("shiftleft(1, coalesce(place_, 0))")) == 0)
        going, done = now.where(on), now.where(~on)
        met_ = going.join(pool, [*KEY, "place_"])
        d = F.sqrt((F.col("x") - F.col("px")) * (F.col("x") - F.col("px")) + (F.col("y") - F.col("py")) * (F.col("y") - F.col("py")))
        best = F.min(F.struct(F.round(d, 9).alias("d"), "i", "grp", "x", "y", "meets")).alias("m")
        state = ["order_id", "places", "covered", "length", "route"]
        moved = met_.groupBy(*KEY, *state).agg(best)
        moved = moved.select(*KEY, F.col("m.x").alias("px"), F.col("m.y").alias("py"), "order_id", "places", F.col("covered").bitwiseOR(F.col("m.meets").cast("int")).alias("covered"), (F.col("length") + F.col("m.d")).alias("length"), F.concat("route", F.array(F.struct("m.grp", "m.i"))).alias("route"))
        front = written(moved.unionByName(done.drop("place_")))
    whole = F.col("covered").bitwiseAND(F.expr("shiftleft(1, size(places)) - 1")) == F.expr("shiftleft(1, size(places)) - 1")
    best = front.where(whole).groupBy(*KEY).agg(F.min(F.struct(F.round("length", 9).alias("length"), "order_id", "route")).alias("m"))
    return best.select(*KEY, F.size("m.route").alias("n_views"), F.col("m.length").alias("length"), F.col("m.route").alias("route"))


def slot_orders(slots: DataFrame, most: int = 120) -> DataFrame:
    """(template_id, order_id, places): the first `most` orders of each template's slots. Slots are a small table, read on the driver."""
    from itertools import islice, permutations

    counts = {r["template_id"]: r["n"] for r in slots.groupBy("template_id").agg(F.count("*").alias("n")).collect()}
    rows = [(t, k, list(p)) for t, n in sorted(counts.items()) for k, p in enumerate(islice(permutations(range(n)), most))]
    return slots.sparkSession.createDataFrame(rows, "template_id string, order_id int, places array<int>")


def frames(starts: DataFrame, routes: DataFrame, candidates: DataFrame, templates: DataFrame) -> DataFrame:
    """(KEY, step, i_way, pose): the views on the way, the first view as step 0, as far apart as the template moves at once.

    Between two views positions lie evenly on the straight way, and each looks as far past itself as the end does.
    """
    stops = routes.select(*KEY, F.posexplode("route").alias("leg", "r")).select(*KEY, "leg", F.col("r.grp").alias("grp"), F.col("r.i").alias("i")).join(candidates, [*KEY, "grp", "i"]).select(*KEY, "leg", *POSE)
    begun = starts.join(routes.select(*KEY), list(KEY)).select(*KEY, F.lit(-1).alias("leg"), *POSE)
    w = Window.partitionBy(*KEY).orderBy("leg")
    legs = begun.unionByName(stops).withColumns({f"from_{c}": F.lag(c).over(w) for c in ("px", "py", "pz")}).join(F.broadcast(templates.select("template_id", "move_m")), "template_id")
    dx, dy = F.col("px") - F.col("from_px"), F.col("py") - F.col("from_py")
    n = F.greatest(F.lit(1), F.ceil(F.sqrt(dx * dx + dy * dy) / F.greatest("move_m", F.lit(1e-6)) - 1e-9).cast("int"))
    ahead = legs.where("leg >= 0").withColumn("n_", n).withColumn("k_", F.explode(F.sequence(F.lit(1), F.col("n_"))))
    t = F.col("k_") / F.col("n_")
    end = F.col("k_") == F.col("n_")
    at = {c: (1 - t) * F.col(f"from_{c}") + t * F.col(c) for c in ("px", "py", "pz")}
    moved = ahead.select(*KEY, "leg", "k_", *(at[c].alias(c) for c in at), *(F.when(end, F.col(f"t{a}")).otherwise(at[f"p{a}"] + F.col(f"t{a}") - F.col(f"p{a}")).alias(f"t{a}") for a in G.AXES))
    every = moved.unionByName(legs.where("leg < 0").select(*KEY, "leg", F.lit(0).alias("k_"), *POSE))
    return every.withColumn("step", (F.row_number().over(Window.partitionBy(*KEY).orderBy("leg", "k_")) - 1).cast("long")).select(*KEY, "step", *POSE)


def assembled(instances: DataFrame, catalog: dict[str, DataFrame], feasibility: DataFrame, first: DataFrame, way: DataFrame, walked: DataFrame, at_frames: DataFrame, valid: DataFrame) -> DataFrame:
    """One row per instance: the task item, or `failure`, why there is none.

    walked: frames of each way; at_frames: slots evaluated at them (grp 'way', i the step); valid: frames whose position
    is valid. Coverage is that of the last frame and that of any frame, by the template's aggregate; the score is the
    share of the coverage that its mode asks for, discounted by gamma for each step.
    """
    length = walked.groupBy(*KEY).agg((F.count("*") - 1).alias("steps"))
    held = walked.where("step > 0").join(valid.select(*KEY, "step"), [*KEY, "step"], "left_anti").select(*KEY).distinct().withColumn("blocked", F.lit(True))
    last = at_frames.join(length, list(KEY)).groupBy(*KEY, "slot_id").agg(F.bool_or(F.col("strict") & (F.col("i") == F.col("steps"))).alias("at_end"), F.bool_or("strict").alias("ever"))
    cover = last.join(F.broadcast(catalog["templates"].select("template_id", "aggregator")), "template_id").groupBy(*KEY).agg(*(F.when(F.first("aggregator") == "all", F.min(F.col(c).cast("double"))).otherwise(F.avg(F.col(c).cast("double"))).alias(n) for c, n in (("at_end", "submit_view_coverage"), ("ever", "trajectory_evidence_coverage"))))
    rows = reduce(lambda a, b: a.join(b, list(KEY), "left"), (feasibility, first.select(*KEY, "score", "i"), way.select(*KEY, "n_views", "length"), length, held, cover), instances).join(F.broadcast(catalog["templates"].drop("choices")), "template_id")
    asked = F.when(F.col("mode") == "submit", F.col("submit_view_coverage")).otherwise(F.col("trajectory_evidence_coverage"))
    failure = F.when(F.col("missing").isNotNull(), F.concat(F.lit("no view for "), "missing")).when(F.col("i").isNull(), "no first view").when(F.col("length").isNull(), "no way over all slots").when(F.col("blocked"), "way is blocked").when(F.col("steps") > F.col("max_steps"), "too many steps").when(asked < F.col("least"), "coverage too low")
    done = failure.isNull()
    score = F.least(F.lit(1.0), asked / F.col("least")) * F.pow("gamma", "steps")
    return rows.select(*KEY, "gt_answer", "choices", "bound", "mode", F.when(done, F.col("steps")).alias("steps"), F.when(done, F.col("length")).alias("length"), F.when(done, asked).alias("coverage"), F.when(done, score).alias("score"), F.col("score").alias("init_score"), failure.alias("failure"))


#: The actions of an agent in the order in which the first of equally good ones is taken: fixed values. The reference's
#: moves to the sides go along (-y, x) of the forward direction for `move_right`, against it for `move_left`.
ACTIONS = ("move_forward", "move_backward", "move_left", "move_right", "turn_left", "turn_right", "look_up", "look_down", "look_forward", "stop")
LOOK, PITCH = 15.0, 75.0


def action_poses(poses: DataFrame) -> DataFrame:
    """(KEY, step, action, pose) after each of the ten actions at each frame (KEY, step, pose, move_m, turn_deg).

    Looks turn the pitch by LOOK degrees, up to PITCH either way; a view without a direction doesn't move. Other columns go.
    """
    rows = poses.select(*KEY, "step", "move_m", "turn_deg", *POSE, F.posexplode(F.array(*map(F.lit, ACTIONS))).alias("action", "name"))
    n, p, t = F.col("name"), [F.col(f"p{a}") for a in G.AXES], [F.col(f"t{a}") for a in G.AXES]
    rel = [b - a for a, b in zip(p, t)]
    size, level = F.sqrt(rel[0] * rel[0] + rel[1] * rel[1] + rel[2] * rel[2]), F.sqrt(rel[0] * rel[0] + rel[1] * rel[1])
    rows = rows.withColumns({"size_": size, "level_": level})
    along = F.when(n == "move_forward", F.col("move_m")).when(n == "move_backward", -F.col("move_m")).otherwise(F.lit(0.0))
    side = F.when(n == "move_right", F.col("move_m")).when(n == "move_left", -F.col("move_m")).otherwise(F.lit(0.0))
    yaw = F.radians(F.when(n == "turn_left", F.col("turn_deg")).when(n == "turn_right", -F.col("turn_deg")).otherwise(F.lit(0.0)))
    unit = lambda x, by: F.coalesce(F.try_divide(x, F.when(F.col(by) > 1e-6, F.col(by))), F.lit(0.0))
    step = [along * unit(rel[0], "size_") - side * unit(rel[1], "level_"), along * unit(rel[1], "size_") + side * unit(rel[0], "level_"), along * unit(rel[2], "size_")]
    pitch = F.atan2(rel[2], F.col("level_")) + F.radians(F.when(n == "look_up", LOOK).otherwise(F.lit(-LOOK)))
    pitch = F.greatest(F.radians(F.lit(-PITCH)), F.least(F.radians(F.lit(PITCH)), pitch))
    looks, turned = n.isin("look_up", "look_down"), V.rotated(rel[0], rel[1], yaw)
    ahead = [unit(rel[0], "level_"), F.when(F.col("level_") > 1e-6, unit(rel[1], "level_")).otherwise(F.lit(1.0))]
    made = {f"n{a}": x + d for a, x, d in zip(G.AXES, p, step)}
    made |= {f"m{a}": F.when(looks, p[k] + ahead[k] * F.col("size_") * F.cos(pitch)).otherwise(p[k] + step[k] + turned[k]) for k, a in enumerate("xy")}
    made["mz"] = F.when(looks, p[2] + F.col("size_") * F.sin(pitch)).when(n == "look_forward", p[2]).otherwise(t[2] + step[2])
    return rows.withColumns(made).select(*KEY, "step", "action", *(F.col(f"n{a}").alias(f"p{a}") for a in G.AXES), *(F.col(f"m{a}").alias(f"t{a}") for a in G.AXES))


def distinct_poses(poses: DataFrame, digits: int = 6) -> tuple[DataFrame, DataFrame]:
    """(views, names): each pose of an instance once, as views (KEY, grp, i, pose), and which i each (KEY, step, action) is."""
    rounded = [F.round(c, digits).alias(f"r_{c}") for c in POSE]
    rows = poses.select("*", *rounded).withColumn("id_", F.col("step") * len(ACTIONS) + F.col("action"))
    keys = [*KEY, *(f"r_{c}" for c in POSE)]
    first = written(rows.groupBy(*keys).agg(F.min(F.struct("id_", *POSE)).alias("m")))
    views_ = first.select(*KEY, F.lit("act").alias("grp"), F.col("m.id_").alias("i"), *(F.col(f"m.{c}").alias(c) for c in POSE))
    return views_, rows.join(first.select(*keys, F.col("m.id_").alias("i")), keys).select(*KEY, "step", "action", "i")


def counterfactual(names: DataFrame, evaluated: DataFrame, slots: DataFrame, eps: float = 1e-6) -> DataFrame:
    """Per instance what its steps gain in belief against what the best and a random valid action would: one row each.

    names (KEY, step, action, i) are the valid actions with their poses' numbers, `stop` always among them: its pose is
    the frame's own. Belief is the least share over slots, or whether a slot's quality check holds. Columns: n_steps,
    mean_regret, cumulative_regret, mean_necessity, redundant_ratio and n_best, the steps that gain as much as the best.
    """
    checked = F.broadcast(slots.select("template_id", "slot_id", "quality"))
    worth = F.when(F.col("quality") == "distance_balance_check", F.col("strict").cast("double")).otherwise(F.col("share"))
    belief = evaluated.join(checked, ["template_id", "slot_id"]).groupBy(*KEY, "i").agg(F.min(worth).alias("belief"))
    valued = names.join(belief, [*KEY, "i"])
    own = valued.where(F.col("action") == ACTIONS.index("stop")).select(*KEY, "step", F.col("belief").alias("here"))
    ahead = own.select(*KEY, (F.col("step") - 1).alias("step"), F.col("here").alias("there"))
    steps = valued.join(own, [*KEY, "step"]).join(ahead, [*KEY, "step"]).groupBy(*KEY, "step", "here", "there").agg(F.max("belief").alias("top"))
    regret, need = F.col("top") - F.col("there"), F.col("there") - F.col("here")
    return steps.groupBy(*KEY).agg(F.count("*").alias("n_steps"), F.avg(regret).alias("mean_regret"), F.sum(regret).alias("cumulative_regret"), F.avg(need).alias("mean_necessity"), F.avg((need <= eps).cast("int")).alias("redundant_ratio"), F.count_if(F.abs(regret) <= eps).alias("n_best"))


def every_slot(instances: DataFrame, slots: DataFrame, groups: tuple[str, ...] | None = None) -> DataFrame:
    """(KEY, grp, slot_id): all slots of an instance for the views of each slot, or for each of the groups named."""
    mine = instances.select(*KEY).join(F.broadcast(slots.select("template_id", "slot_id")), "template_id")
    if groups is None:
        return mine.join(mine.withColumnRenamed("slot_id", "grp"), list(KEY)).select(*KEY, "grp", "slot_id")
    return mine.withColumn("grp", F.explode(F.array(*map(F.lit, groups)))).select(*KEY, "grp", "slot_id")


def wanted_objects(tried: DataFrame, bound: DataFrame) -> DataFrame:
    """(KEY, grp, object_id): the objects that the predicates of the slots tried look at."""
    rows = tried.join(bound.select(*KEY, "slot_id", F.explode(F.array("first_id", "second_id")).alias("object_id")), [*KEY, "slot_id"])
    return rows.where("object_id IS NOT NULL").select(*KEY, "grp", "object_id").distinct()


def looked_at(poses: DataFrame, tried: DataFrame, wanted: DataFrame, bound: DataFrame, objects: DataFrame, blockers: DataFrame) -> tuple[DataFrame, int, DataFrame, DataFrame]:
    """(seen, most, checks, targets) of views whose groups want some objects, and try some slots."""
    targets, most = targets_of(wanted, objects)
    return seen_by(poses, targets, most, blockers), most, written(checks_of(tried, bound, targets)), targets


def planned(instances: DataFrame, catalog: dict[str, DataFrame], specs: list[dict], rooms: DataFrame, objects: DataFrame, blockers: DataFrame, n: int = 16, upto: str = "items") -> dict[str, DataFrame]:
    """All steps from instances to task items: candidates, slots met, feasible, first, way, items. What is read more than once is written.

    n are the candidates of a slot; `upto` names the last step that is wanted. First views aren't written: of those there are a hundred for
    each instance, and what they see is looked at where they were made.
    """
    out = {"instances": written(instances)}
    instances, slots = out["instances"], catalog["slots"]
    bound = written(bound_predicates(instances, catalog))
    looked = lambda poses, tried, wanted: looked_at(poses, tried, wanted, bound, objects, blockers)
    out["candidates"] = poses = written(slot_views(slot_targets(instances, catalog, objects), rooms, objects, n))
    tried = every_slot(instances, slots)
    seen, most, checks, _ = looked(O.by_scene(poses), tried, wanted_objects(tried, bound))
    met = written(slots_at(seen, most, checks, slots))
    out["feasible"] = feasible(instances, catalog, met)
    if upto == "feasible":
        return out
    tried = every_slot(instances, slots, ("init",))
    wanted = wanted_objects(tried, bound).unionByName(roles_of(instances).select(*KEY, F.lit("init").alias("grp"), "object_id")).distinct()
    seen, most, checks, targets = looked(first_candidates(instances, rooms, objects), tried, wanted)
    scored = first_scores(seen, most, instances, targets, specs)
    out["first"] = first = written(first_view(instances, slots_at(scored, most, checks, slots, (*POSE, "shown", "rejected", "validator"))))
    if upto == "first":
        return out
    begun = first.where("i IS NOT NULL")
    whole = out["feasible"].where("missing IS NULL").select(*KEY)
    out["way"] = way = written(ways(begun.join(whole, list(KEY)), poses, met, slots))
    if upto == "way":
        return out
    walked = written(frames(begun, way, poses, catalog["templates"]))
    if upto == "regret":
        sizes = F.broadcast(catalog["templates"].select("template_id", "move_m", "turn_deg"))
        moved = action_poses(O.by_scene(walked).join(sizes, "template_id"))
        rest = F.col("action") == ACTIONS.index("stop")
        acted, names = distinct_poses(written(O.valid_positions(moved.where(~rest), rooms, objects).select(*moved.columns).unionByName(moved.where(rest))))
        tried = every_slot(instances, slots, ("act",))
        seen, most, checks, _ = looked(O.by_scene(acted), tried, wanted_objects(tried, bound))
        out["regret"] = counterfactual(names, written(slots_at(seen, most, checks, slots)), slots)
        return out
    steps = walked.select(*KEY, F.lit("way").alias("grp"), F.col("step").alias("i"), *POSE)
    tried = every_slot(instances, slots, ("way",))
    seen, most, checks, _ = looked(O.by_scene(steps), tried, wanted_objects(tried, bound))
    at_frames = written(slots_at(seen, most, checks, slots))
    valid = O.valid_positions(walked, rooms, objects)
    out["items"] = assembled(instances, catalog, out["feasible"], first, way, walked, at_frames, valid)
    return out
