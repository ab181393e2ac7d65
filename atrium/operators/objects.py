"""Operators over object boxes: filters, rooms, pairs, groups and labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.functions import labels as L
from atrium.operators.storage import written


#: Joins of a scene's rows with its rooms and boxes build the latter task by task: nothing that grows is broadcast or sorted.
BUILT = "shuffle_hash"
#: Tasks for each core, at least.
SHARES = 8


def by_scene(rows: DataFrame) -> DataFrame:
    """rows dealt by scene, in many tasks however few files they come from: for rows that become many.

    Their joins by scene and cell then find them in place, where `registry.tune` or the session lets parts of the keys do.
    """
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), SHARES * spark.sparkContext.defaultParallelism), "scene_id")


def valid_objects(objects: DataFrame, blacklist: tuple[str, ...] = L.BLACKLIST) -> DataFrame:
    """Objects whose label isn't blacklisted; those without a label go."""
    return objects.where(~L.among(F.col("label"), blacklist))


def candidate_objects(objects: DataFrame, structural: tuple[str, ...] = L.STRUCTURAL, generic: tuple[str, ...] = L.GENERIC) -> DataFrame:
    return objects.where(~L.among(F.col("label"), (*structural, *generic)))


def is_meaningful(min_volume: float = 0.02, prefix: str = "", fine: tuple[str, ...] = L.FINE) -> Column:
    return ~L.among(F.col(f"{prefix}label"), fine) & (G.volume(prefix) >= min_volume)


def is_landmark(prefix: str = "", landmarks: tuple[str, ...] = L.LANDMARK, marked: bool = False) -> Column:
    """A reference that is easily told; `marked` objects have the masks of their labels, which spare the match."""
    named = L.holds(f"{prefix}mk_", ("landmark",), L.MARKS) if marked else L.matches(F.col(f"{prefix}label"), landmarks)
    return is_meaningful(0.04, prefix) & (named | (G.volume(prefix) >= 0.12))


def reject_reason(min_side: float = 0.1, max_side: float = 3.0, min_volume: float = 0.1, flatness: float = 0.05, blacklist: tuple[str, ...] = L.BLACKLIST, room: Column | None = None) -> Column:
    """Why an object is left out, the first reason that holds; null if it stays. `room` is its room, null for none."""
    reason = F.when(F.col("min_x").isNull(), "no_box").when(L.among(F.col("label"), blacklist), "blacklisted")
    reason = reason.when(G.shortest() < min_side, "too_small_side").when(G.longest() > max_side, "too_large").when(G.volume() < min_volume, "too_small_volume").when(G.shortest() < flatness * G.longest(), "too_flat")
    return reason if room is None else reason.when(room.isNull(), "no_room")


def with_polygons(rooms: DataFrame) -> DataFrame:
    """Rectangular rooms with their outline as an array of points."""
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return rooms.withColumn("poly", F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y1"), at("x0", "y1")))


def room_bounds(rooms: DataFrame) -> DataFrame:
    """Rooms with x0 .. y1, the bounds of their outline, and room_idx, their place in the file (else their id's order)."""
    side = lambda f, axis: f(F.transform("poly", lambda p: p[axis]))
    made = {"x0": side(F.array_min, "x"), "x1": side(F.array_max, "x"), "y0": side(F.array_min, "y"), "y1": side(F.array_max, "y")}
    return rooms.withColumns({k: v for k, v in made.items() if k not in rooms.columns})


def assign_room(points: DataFrame, rooms: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """(scene_id, key, room_id) of points in a room: outline test behind the bounding box, the first room wins; null in none.

    Ids are unique within a scene alone. The first room is the one of the least room_idx where rooms have one,
    else of the least id. A room is one row of a scene's few, so that the join meets each point with them and
    an aggregate by key, combined before its shuffle, takes the first.
    """
    first = "room_idx" if "room_idx" in rooms.columns else "room_id"
    near = room_bounds(rooms).select(F.col("scene_id").alias("room_scene_"), "room_id", "poly", "x0", "x1", "y0", "y1", F.col(first).alias("first_"))
    inside = (F.col("scene_id") == F.col("room_scene_")) & F.col("x_").between(F.col("x0"), F.col("x1")) & F.col("y_").between(F.col("y0"), F.col("y1"))
    joined = points.select("scene_id", key, F.col(x).alias("x_"), F.col(y).alias("y_")).join(near.hint(BUILT), inside, "left")
    # The least id is a plain number, which is aggregated without a sort; a place with its id is not.
    found = F.col("room_id") if first == "room_id" else F.struct("first_", "room_id")
    best = F.min(F.when(G.point_in_polygon(F.col("x_"), F.col("y_"), F.col("poly")), found))
    return joined.groupBy("scene_id", key).agg((best if first == "room_id" else best.getField("room_id")).alias("room_id"))


def prefixed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*(F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns))


def with_room(objects: DataFrame, rooms: DataFrame) -> DataFrame:
    """Objects with the room their centre is in; objects in no room go."""
    centers = objects.withColumns({"cx_": G.center("x"), "cy_": G.center("y")})
    return objects.join(assign_room(centers, rooms, "object_id", "cx_", "cy_").where("room_id IS NOT NULL").hint(BUILT), ["scene_id", "object_id"])


def object_pairs(roomed: DataFrame) -> DataFrame:
    """Pairs a < b of objects of one room, columns prefixed a_ and b_. An equi-join on scene and room."""
    keep = ("scene_id", "room_id")
    return prefixed(roomed, "a_", keep).join(prefixed(roomed, "b_", keep), list(keep)).where("a_object_id < b_object_id")


def near_triples(roomed: DataFrame, most: float) -> DataFrame:
    """Triples of one room with distinct labels and all distances at most `most`, each once."""
    near = object_pairs(roomed).where("a_label <> b_label").withColumn("d", G.center_distance("a_", "b_")).where(F.col("d") <= most)
    near = near.select("scene_id", "room_id", "a_object_id", "b_object_id", "a_label", "b_label", "d")
    second = near.select("scene_id", "room_id", F.col("a_object_id").alias("b_object_id"), F.col("b_object_id").alias("c_object_id"), F.col("b_label").alias("c_label"), F.col("d").alias("d_bc"))
    third = near.select("scene_id", "room_id", "a_object_id", F.col("b_object_id").alias("c_object_id"), F.col("d").alias("d_ac"))
    return near.withColumnRenamed("d", "d_ab").join(second, ["scene_id", "room_id", "b_object_id"]).join(third, ["scene_id", "room_id", "a_object_id", "c_object_id"])


def both_ways(pairs: DataFrame, columns: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Each pair as two rows, of either member: columns names a value seen from the first and from the second."""
    sides = [F.struct(*(v[i].alias(n) for n, v in columns.items())) for i in (0, 1)]
    return pairs.select("scene_id", F.inline(F.array(*sides)))


def nearest_object(pairs: DataFrame) -> DataFrame:
    """Each object's nearest other by box distance, ties to the smaller id, from pairs of either order."""
    d = G.box_distance("a_", "b_")
    ids = F.col("a_object_id"), F.col("b_object_id")
    seen = both_ways(pairs.withColumn("d_", d), {"object_id": ids, "other_id": ids[::-1], "d": (F.col("d_"), F.col("d_"))})
    best = F.min(F.struct("d", "other_id")).alias("best")
    return seen.groupBy("scene_id", "object_id").agg(best).select("scene_id", "object_id", "best.other_id", "best.d")


def nearest_in_cells(roomed: DataFrame, cell: float = 1.0) -> DataFrame:
    """Each object's nearest other centre of its room in the plane, by a grid: no all-pairs join.

    Objects meet those of the nine cells around their own. What has none there, or only one farther than a
    cell's side, is searched again on a grid of twice the side, until nothing is left without its answer or
    the cell is as wide as a room. Ties go to the smaller id. Every round is written, so that a plan holds one
    round however many there are.
    """
    points = roomed.select("scene_id", "room_id", "object_id", G.center("x").alias("x"), G.center("y").alias("y"))
    width = points.groupBy("scene_id", "room_id").agg(F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("w")).agg(F.max("w")).first()[0] or 0.0
    points = written(points)
    todo, found = points, []
    while True:
        at = lambda c, d=0: (F.floor(F.col(c) / cell) + d).cast("long")  # noqa: E731, B023
        others = points.select("scene_id", "room_id", F.col("object_id").alias("other_id"), F.col("x").alias("ox"), F.col("y").alias("oy"), at("x").alias("i"), at("y").alias("j"))
        steps = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)))
        mine = todo.withColumn("s", F.explode(steps)).withColumns({"i": at("x") + F.col("s.a"), "j": at("y") + F.col("s.b")})
        d = F.sqrt((F.col("x") - F.col("ox")) * (F.col("x") - F.col("ox")) + (F.col("y") - F.col("oy")) * (F.col("y") - F.col("oy")))
        # Objects without another in reach stay in the round with a null, so that what is left needs no join back.
        met = mine.join(others, ["scene_id", "room_id", "i", "j"], "left")
        best = F.min(F.when(F.col("object_id") != F.col("other_id"), F.struct(d.alias("d"), "other_id"))).alias("m")
        met = written(met.groupBy("scene_id", "room_id", "object_id", "x", "y").agg(best))
        last = cell > width
        found.append(met.where("m IS NOT NULL" if last else F.col("m.d") <= cell).select("scene_id", "object_id", "m.other_id", "m.d"))
        todo, cell = met.where(F.col("m").isNull() | (F.col("m.d") > cell)).drop("m"), 2 * cell
        if last or todo.isEmpty():
            return reduce(DataFrame.unionByName, found)


def farthest_pair(pairs: DataFrame) -> DataFrame:
    best = F.max(F.struct(G.center_distance("a_", "b_").alias("d"), (-F.col("a_object_id")).alias("a"), (-F.col("b_object_id")).alias("b")))
    return pairs.groupBy("scene_id", "room_id").agg(best.alias("m")).select("scene_id", "room_id", (-F.col("m.a")).alias("a_id"), (-F.col("m.b")).alias("b_id"), F.col("m.d").alias("d"))


def unique_objects(roomed: DataFrame) -> DataFrame:
    scene, room = Window.partitionBy("scene_id", "label"), Window.partitionBy("scene_id", "room_id", "label")
    return roomed.withColumns({"unique_in_scene": F.count("*").over(scene) == 1, "unique_in_room": F.count("*").over(room) == 1})


def zone_counts(roomed: DataFrame, most: int = 5) -> DataFrame:
    """Counts of a label in two rooms of a scene, each from 1 to `most`."""
    counts = roomed.groupBy("scene_id", "room_id", "label").count()
    a = counts.select("scene_id", "label", F.col("room_id").alias("room_a"), F.col("count").alias("n_a"))
    b = counts.select("scene_id", "label", F.col("room_id").alias("room_b"), F.col("count").alias("n_b"))
    return a.join(b, ["scene_id", "label"]).where((F.col("room_a") < F.col("room_b")) & (F.col("n_a") <= most) & (F.col("n_b") <= most))


def room_names(roomed: DataFrame, rooms: DataFrame, hits: int = 2, names: dict[str, tuple[str, ...]] = L.ROOM_NAMES) -> DataFrame:
    """A name for each room: the first of those with most keywords among its labels, if these are enough, else room n, by its place; equal names are numbered."""
    labels = candidate_objects(roomed).groupBy("scene_id", "room_id").agg(F.collect_set(F.lower("label")).alias("labels"))
    named = rooms.select("scene_id", "room_id").join(labels, ["scene_id", "room_id"], "left")
    place = F.row_number().over(Window.partitionBy("scene_id").orderBy("room_id"))
    score = lambda words: F.coalesce(F.size(F.array_intersect("labels", F.array(*map(F.lit, words)))), F.lit(0))
    ranked = F.array(*(F.struct((-score(words)).alias("s"), F.lit(i).alias("i"), F.lit(name).alias("name")) for i, (name, words) in enumerate(names.items())))
    best = F.array_min(ranked)
    base = F.when(best["s"] <= -hits, best["name"]).otherwise(F.concat(F.lit("room "), F.col("place").cast("string")))
    window = Window.partitionBy("scene_id", "base")
    named = named.withColumn("place", place).withColumn("base", base).withColumns({"n": F.row_number().over(window.orderBy("room_id")), "of": F.count("*").over(window)})
    return named.select("scene_id", "room_id", F.when(F.col("of") > 1, F.concat_ws(" ", "base", F.col("n").cast("string"))).otherwise(F.col("base")).alias("name"))


def group_shape(members: DataFrame, keys: list[str]) -> DataFrame:
    """Centroid, radius and member nearest the centroid of each group of (keys, object_id, x, y)."""
    mean = members.groupBy(*keys).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    d = F.sqrt((F.col("x") - F.col("mx")) * (F.col("x") - F.col("mx")) + (F.col("y") - F.col("my")) * (F.col("y") - F.col("my")))
    joined = members.join(mean, keys).withColumn("d", F.round(d, 9))
    return joined.groupBy(*keys, "mx", "my").agg(F.max("d").alias("radius"), F.min(F.struct("d", "object_id")).getField("object_id").alias("proxy_id"))


def group_axis(members: DataFrame, keys: list[str]) -> DataFrame:
    """Ratio of the lesser to the greater spread of each group: the closed form of a 2 x 2 covariance."""
    cov = members.groupBy(*keys).agg(F.var_pop("x").alias("a"), F.var_pop("y").alias("c"), F.covar_pop("x", "y").alias("b"))
    mid, half = (F.col("a") + F.col("c")) / 2, F.sqrt((F.col("a") - F.col("c")) * (F.col("a") - F.col("c")) / 4 + F.col("b") * F.col("b"))
    return cov.select(*keys, F.when(mid + half > 0, F.sqrt(F.greatest(F.lit(0.0), mid - half) / (mid + half))).otherwise(F.lit(0.0)).alias("ratio"))


def with_shape(objects: DataFrame) -> DataFrame:
    """Objects with s1_ .. s3_, their sorted sides over the length of all three: plain columns, made once per object."""
    d = [F.greatest(G.dim(a), F.lit(1e-6)) for a in G.AXES]
    norm = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    low, high = F.least(*d), F.greatest(*d)
    return objects.withColumns({"s1_": low / norm, "s2_": (d[0] + d[1] + d[2] - low - high) / norm, "s3_": high / norm})


def distractor_labels(roomed: DataFrame, most: int = 3) -> DataFrame:
    """For each object up to `most` other labels of its room: such that share a group of looks, else confusable ones by shape.

    Shapes are made once per object, and an object meets each other label of its room once, with the least
    shape distance of its objects.
    """
    have = [c for c in ("g_", "ap_", "cf_") if c in roomed.columns]
    shaped = with_shape(roomed).select("scene_id", "room_id", "object_id", "label", "s1_", "s2_", "s3_", *have)
    shaped = shaped if have else written(L.with_groups(written(shaped)))
    pairs = prefixed(shaped, "a_", ("scene_id", "room_id")).join(prefixed(shaped, "b_", ("scene_id", "room_id")), ["scene_id", "room_id"])
    gap = F.sqrt(sum(((F.col(f"a_s{i}_") - F.col(f"b_s{i}_")) * (F.col(f"a_s{i}_") - F.col(f"b_s{i}_")) for i in (1, 2, 3)), F.lit(0.0)))
    alike = L.shares("a_ap_", "b_ap_")
    some = pairs.where((F.col("a_label") != F.col("b_label")) & L.confusable())
    kinds = some.groupBy("scene_id", F.col("a_object_id").alias("object_id"), F.col("b_label").alias("label")).agg(F.round(F.min(gap), 9).alias("shape"), F.max(alike).alias("alike"))
    only = kinds.withColumn("any_alike", F.max("alike").over(Window.partitionBy("scene_id", "object_id"))).where("alike OR NOT any_alike")
    ranked = only.withColumn("rank", F.row_number().over(Window.partitionBy("scene_id", "object_id").orderBy("shape", "label")))
    return ranked.where(F.col("rank") <= most).select("scene_id", "object_id", "rank", "label")


def cells(low: Column, high: Column, cell: float) -> Column:
    """Numbers of the cells that a stretch touches."""
    return F.sequence(F.floor(low / cell).cast("long"), F.floor(high / cell).cast("long"))


def far_from_objects(points: DataFrame, objects: DataFrame, least: float) -> DataFrame:
    """Points (scene_id, px, py) with no object centre of their scene within `least` metres in the plane.

    Points meet only the centres of which the disc touches their cell: an equality of scene and cell. Objects are
    dealt by scene before they become cells: few tasks read them, and would write all cells.
    """
    cell = max(least, 0.25)
    x, y = G.center("x"), G.center("y")
    near = by_scene(objects).select(F.col("scene_id").alias("s_"), x.alias("ox_"), y.alias("oy_"), F.explode(cells(x - least, x + least, cell)).alias("i_"))
    near = near.withColumn("j_", F.explode(cells(F.col("oy_") - least, F.col("oy_") + least, cell)))
    dx, dy = F.col("px") - F.col("ox_"), F.col("py") - F.col("oy_")
    same = (F.col("scene_id") == F.col("s_")) & (F.floor(F.col("px") / cell) == F.col("i_")) & (F.floor(F.col("py") / cell) == F.col("j_"))
    return points.join(near.hint(BUILT), same & (dx * dx + dy * dy < least * least), "left_anti")


def outside_boxes(points: DataFrame, boxes: DataFrame, tolerance: float, cell: float = 1.0) -> DataFrame:
    """Points (scene_id, px, py, pz) in no box of their scene that is widened by a tolerance; by scene and cell."""
    named = boxes.select(F.col("scene_id").alias("s_"), *(F.col(f"{n}_{a}").alias(f"box_{n}_{a}") for a in G.AXES for n in ("min", "max")))
    spread = named.withColumn("i_", F.explode(cells(G.lo("x", "box_") - tolerance, G.hi("x", "box_") + tolerance, cell)))
    spread = spread.withColumn("j_", F.explode(cells(G.lo("y", "box_") - tolerance, G.hi("y", "box_") + tolerance, cell)))
    same = (F.col("scene_id") == F.col("s_")) & (F.floor(F.col("px") / cell) == F.col("i_")) & (F.floor(F.col("py") / cell) == F.col("j_"))
    return points.join(spread.hint(BUILT), same & G.in_box(F.col("px"), F.col("py"), F.col("pz"), "box_", tolerance), "left_anti")


def in_rooms(points: DataFrame, rooms: DataFrame) -> DataFrame:
    """Points (scene_id, px, py) in some room: the outline test behind the bounding box, as a semi join."""
    near = room_bounds(rooms).select(F.col("scene_id").alias("s_"), "poly", "x0", "x1", "y0", "y1")
    inside = (F.col("scene_id") == F.col("s_")) & F.col("px").between(F.col("x0"), F.col("x1")) & F.col("py").between(F.col("y0"), F.col("y1"))
    return points.join(near.hint(BUILT), inside & G.point_in_polygon(F.col("px"), F.col("py"), F.col("poly")), "left_semi")


def valid_positions(points: DataFrame, rooms: DataFrame, objects: DataFrame, least: float = 0.2) -> DataFrame:
    """Points in a room, at least `least` from all object centres in the plane, and in no object's box.

    Where points have low_z and high_z, the scene's height bounds, they count if they are 2 m apart or more.
    """
    if {"low_z", "high_z"} <= set(points.columns):
        points = points.where(F.coalesce((F.col("high_z") - F.col("low_z") < 2) | F.col("pz").between(F.col("low_z"), F.col("high_z")), F.lit(True)))
    return outside_boxes(far_from_objects(in_rooms(points, rooms), objects, least), objects, 0.0)


def legal_positions(points: DataFrame, rooms: DataFrame, objects: DataFrame, walls: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Points in a room and outside all boxes, walls too, widened by a tolerance; 0.1 m inside the height bounds if points have them."""
    if {"low_z", "high_z"} <= set(points.columns):
        points = points.where(F.coalesce(F.col("pz").between(F.col("low_z") + 0.1, F.col("high_z") - 0.1), F.lit(True)))
    return outside_boxes(in_rooms(points, rooms), blockers_of(objects, walls), tolerance)


def blockers_of(objects: DataFrame, walls: DataFrame) -> DataFrame:
    """Objects and walls together: all that can stand between a view and a target."""
    columns = ["scene_id", "object_id", "label", *(f"{n}_{a}" for a in G.AXES for n in ("min", "max"))]
    return objects.select(*columns).unionByName(walls.select(*columns))


def targets(objects: DataFrame, portals: DataFrame, thickness: float = 0.1, height: float = 2.0) -> DataFrame:
    """Objects, and portals as thin boxes across their normal: (scene_id, kind, object_id, label, box)."""
    columns = ["scene_id", "object_id", "label", *(f"{n}_{a}" for a in G.AXES for n in ("min", "max"))]
    across_x = F.abs("nx") >= F.abs("ny")
    half_x = F.when(across_x, F.lit(thickness)).otherwise(F.col("width")) / 2
    half_y = F.when(across_x, F.col("width")).otherwise(F.lit(thickness)) / 2
    thin = portals.select(
        "scene_id", F.col("portal_id").alias("object_id"), F.lower("type").alias("label"), (F.col("x") - half_x).alias("min_x"), (F.col("x") + half_x).alias("max_x"),
        (F.col("y") - half_y).alias("min_y"), (F.col("y") + half_y).alias("max_y"), (F.col("z") - height / 2).alias("min_z"), (F.col("z") + height / 2).alias("max_z"),
    )
    return objects.select(*columns).withColumn("kind", F.lit("object")).unionByName(thin.withColumn("kind", F.lit("portal")))


def reject_report(rejected: DataFrame, most: int = 10) -> DataFrame:
    """The most common labels of each reject reason, with their counts."""
    counts = rejected.groupBy("reason", "label").count()
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("reason").orderBy(F.desc("count"), "label")))
    return ranked.where(F.col("rank") <= most)
