"""View generators: rows of targets become candidate views, of which the first valid ones stay.

Each target row has scene_id, an integer `key`, and what its generator names (a centre ox, oy, a base direction
bx, by, a point to look at lx, ly). Candidates are numbered; their numbers, not a random state, give the
angles and distances, so that the same rows come out on any number of executors. A view must be a valid
position (in a room, away from object centres, outside boxes).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators import objects as O
from atrium.operators.views import CORNERS, FOCAL, WIDTH

REGIONS: dict[str, Callable[..., DataFrame]] = {}
#: Camera height over the floor, and candidates for each view that is asked for.
HEIGHT, TRIES = 0.8, 20
#: Draws are places of a lattice of so many points; the steps are its golden and plastic ratios.
LATTICE, STEPS = 1_000_003, (618_034, 754_878, 569_840)
VIEW = ("px", "py", "pz", "tx", "ty", "tz")


def register_region(*names: str):
    def add(build):
        REGIONS.update(dict.fromkeys(names, build))
        return build

    return add


def draws(rows: DataFrame, n: int) -> DataFrame:
    """rows once for each candidate i, with u1, u2, u3 from 0 to below 1 that depend on key and i alone."""
    u = {f"u{k}": F.pmod(F.col("key") * 7919 + F.col("i") * step + 104_729 * k, F.lit(LATTICE)) / float(LATTICE) for k, step in enumerate(STEPS, 1)}
    return O.by_scene(rows).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n * TRIES - 1)))).withColumns(u)


def spread(u: Column, low: float, high: float) -> Column:
    return low + u * (high - low)


def rotated(x: Column, y: Column, angle: Column) -> tuple[Column, Column]:
    return x * F.cos(angle) - y * F.sin(angle), x * F.sin(angle) + y * F.cos(angle)


def first_views(points: DataFrame, n: int) -> DataFrame:
    """The first n candidates of each key."""
    rank = F.row_number().over(Window.partitionBy("scene_id", "key").orderBy("i"))
    return points.withColumn("rank_", rank).where(F.col("rank_") <= n).select("scene_id", "key", "i", *VIEW)


def polar(rows: DataFrame, rooms: DataFrame, objects: DataFrame, n: int, dist: tuple[float, float], angles: tuple[float, float] = (0.0, 360.0), signed: bool = False, flip: bool = False, keep: Column | None = None, own_room: bool = False) -> DataFrame:
    """Views around ox, oy in a band of distances, turned by a range of degrees from bx, by, looking at lx, ly.

    `signed` turns either way, `flip` takes the base direction or its opposite, `keep` is a condition on the
    candidate, and with `own_room` it must be in the room that wanted_id names.
    """
    sign = F.when(F.col("u3") < 0.5, -1.0).otherwise(1.0)
    angle = F.radians(spread(F.col("u1"), *angles)) * (sign if signed else F.lit(1.0))
    x, y = rotated(F.col("bx") * (sign if flip else F.lit(1.0)), F.col("by") * (sign if flip else F.lit(1.0)), angle)
    d = spread(F.col("u2"), *dist)
    points = draws(rows, n).withColumns({"px": F.col("ox") + d * x, "py": F.col("oy") + d * y, "pz": F.lit(HEIGHT), "tx": F.col("lx"), "ty": F.col("ly"), "tz": F.lit(HEIGHT)})
    if keep is not None:
        points = points.where(keep)
    if own_room:
        points = in_wanted_room(points, rooms)
    return first_views(O.valid_positions(points, rooms, objects), n)


def in_wanted_room(points: DataFrame, rooms: DataFrame) -> DataFrame:
    """Points in the room that their wanted_id names; a null names none and lets them pass."""
    mine = O.room_bounds(rooms).select(F.col("scene_id").alias("s_"), F.col("room_id").alias("r_"), F.col("poly").alias("poly_"))
    found = points.join(mine, (F.col("scene_id") == F.col("s_")) & (F.col("wanted_id") == F.col("r_")), "left")
    inside = F.col("wanted_id").isNull() | F.coalesce(G.point_in_polygon(F.col("px"), F.col("py"), F.col("poly_")), F.lit(False))
    return found.where(inside).drop("s_", "r_", "poly_")


def aimed(rows: DataFrame, look: bool = True) -> DataFrame:
    """Rows with an east base direction, and the centre to look at."""
    out = rows.withColumns({"bx": F.lit(1.0), "by": F.lit(0.0)})
    return out.withColumns({"lx": F.col("ox"), "ly": F.col("oy")}) if look else out


def unit_base(rows: DataFrame, dx: Column, dy: Column) -> DataFrame:
    """Rows with a base direction of length 1; those without a direction go."""
    size = F.sqrt(dx * dx + dy * dy)
    return rows.withColumn("size_", size).where("size_ >= 1e-6").withColumns({"bx": dx / F.col("size_"), "by": dy / F.col("size_")}).drop("size_")


def of_objects(objects: DataFrame) -> DataFrame:
    return objects.select("scene_id", F.col("object_id").alias("key"), G.center("x").alias("ox"), G.center("y").alias("oy"), "label")


def of_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs (a_, b_) as targets: their middle, both centres and a key of both ids."""
    at = {f"{p}{a}_": G.center(a, f"{p}_") for p in "ab" for a in "xy"}
    key = F.pmod(F.col("a_object_id") * 1_000_003 + F.col("b_object_id"), F.lit(2_147_483_647))
    return pairs.select("scene_id", key.alias("key"), *(c.alias(n) for n, c in at.items())).withColumns({f"o{a}": (F.col(f"a{a}_") + F.col(f"b{a}_")) / 2 for a in "xy"}).withColumns({f"l{a}": F.col(f"o{a}") for a in "xy"})


def of_groups(members: DataFrame) -> DataFrame:
    """Groups (scene_id, key, x, y per member) as targets: centroid, and the direction of the greatest spread."""
    g = members.groupBy("scene_id", "key").agg(F.count("*").alias("n_"), F.avg("x").alias("ox"), F.avg("y").alias("oy"), F.var_pop("x").alias("a_"), F.var_pop("y").alias("c_"), F.covar_pop("x", "y").alias("b_"))
    turn = F.atan2(2 * F.col("b_"), F.col("a_") - F.col("c_")) / 2
    return g.withColumns({"axis_x": F.cos(turn), "axis_y": F.sin(turn), "lx": F.col("ox"), "ly": F.col("oy")}).drop("a_", "b_", "c_")


@register_region("around_object")
def around_object(objects, rooms, blockers, n=32, dist=(0.8, 3.0)):
    """A ring around each object."""
    return polar(aimed(of_objects(objects)), rooms, blockers, n, dist)


@register_region("around_pair")
def around_pair(pairs, rooms, blockers, n=32, dist=(0.8, 4.0)):
    """A ring around the middle of each pair."""
    return polar(aimed(of_pairs(pairs), look=False), rooms, blockers, n, dist)


@register_region("equidistant_to_pair")
def equidistant_to_pair(pairs, rooms, blockers, n=32, dist=(0.8, 4.0), most=0.5):
    """As around_pair, with about the same distance to both: at least 0.2 m, and the ratio's logarithm at most `most`."""
    d = {p: F.sqrt((F.col("px") - F.col(f"{p}x_")) * (F.col("px") - F.col(f"{p}x_")) + (F.col("py") - F.col(f"{p}y_")) * (F.col("py") - F.col(f"{p}y_"))) for p in "ab"}
    keep = (d["a"] >= 0.2) & (d["b"] >= 0.2) & (F.abs(F.ln(d["a"] / d["b"])) <= most)
    return polar(aimed(of_pairs(pairs), look=False), rooms, blockers, n, dist, keep=keep)


@register_region("orthogonal_to_portal")
def orthogonal_to_portal(portals, rooms, blockers, n=32, dist=(0.3, 2.0), most=15.0):
    """Facing a door along its normal, from either side."""
    rows = portals.select("scene_id", F.col("portal_id").alias("key"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("x").alias("lx"), F.col("y").alias("ly"), F.col("nx").alias("bx"), F.col("ny").alias("by"))
    return polar(rows, rooms, blockers, n, dist, (-most, most), flip=True)


@register_region("view_breaking_projection")
def view_breaking_projection(members, rooms, blockers, n=32, angles=(30.0, 75.0), dist=(1.0, 4.0)):
    """Oblique to the axis of each group of two or more."""
    rows = of_groups(members).where("n_ >= 2").withColumns({"bx": F.col("axis_x"), "by": F.col("axis_y")})
    return polar(rows, rooms, blockers, n, dist, angles, signed=True)


@register_region("view_with_separation", "view_of_triple")
def around_group(members, rooms, blockers, n=32, dist=(1.5, 4.0)):
    """A ring around the centroid of each group; triples are groups of three."""
    return polar(aimed(of_groups(members), look=False), rooms, blockers, n, dist)


@register_region("behind_front_object")
def behind_front_object(pairs, rooms, blockers, n=32, least=30.0, dist=(1.0, 3.0)):
    """Sideways of the way from the first (front) to the second (back) of each pair."""
    rows = unit_base(of_pairs(pairs), F.col("bx_") - F.col("ax_"), F.col("by_") - F.col("ay_"))
    return polar(rows, rooms, blockers, n, dist, (least, 90.0), signed=True)


@register_region("around_occluder_back", "around_occluder_to_expose")
def around_occluder_back(pairs, rooms, blockers, n=32, dist=(0.5, 3.0), most=60.0):
    """Around the side of the first of each pair (the occluder) that the second (the target) is on, looking at the target."""
    rows = unit_base(of_pairs(pairs), F.col("bx_") - F.col("ax_"), F.col("by_") - F.col("ay_"))
    rows = rows.withColumns({"ox": F.col("ax_"), "oy": F.col("ay_"), "lx": F.col("bx_"), "ly": F.col("by_")})
    return polar(rows, rooms, blockers, n, dist, (-most, most))


@register_region("orthogonal_to_segment")
def orthogonal_to_segment(pairs, rooms, blockers, n=32, least=60.0, dist=(0.5, 3.0)):
    """At `least` to 90 degrees, measured from its upright, to the segment between each pair."""
    rows = unit_base(of_pairs(pairs), F.col("bx_") - F.col("ax_"), F.col("by_") - F.col("ay_"))
    return polar(rows, rooms, blockers, n, dist, (0.0, 90.0 - least), signed=True)


@register_region("behind_object_face")
def behind_object_face(faces, rooms, blockers, n=32, most=45.0, dist=(0.5, 2.5)):
    """Around a named face: objects with the face's outward normal as bx, by."""
    rows = of_objects(faces).drop("label").join(faces.select("scene_id", F.col("object_id").alias("key"), "bx", "by"), ["scene_id", "key"])
    return polar(rows.withColumns({"lx": F.col("ox"), "ly": F.col("oy")}), rooms, blockers, n, dist, (-most, most))


@register_region("near_portal_in_room_a", "near_portal_facing")
def near_portal(portals, rooms, blockers, n=32, dist=(0.5, 3.0)):
    """A ring around each door, in the room that wanted_id names if it names one, looking at the door."""
    rows = portals.select("scene_id", F.col("portal_id").alias("key"), F.col("x").alias("ox"), F.col("y").alias("oy"), "wanted_id")
    return polar(aimed(rows), rooms, blockers, n, dist, own_room=True)


def places(rows: DataFrame, rooms: DataFrame, blockers: DataFrame, n: int) -> DataFrame:
    """Candidates of each row (scene_id, key, wanted_id), even over the bounds of its room and inside its outline."""
    bounds = O.room_bounds(rooms)
    mean = lambda a: F.aggregate("poly", F.lit(0.0), lambda s, p: s + p[a]) / F.size("poly")
    mine = bounds.select("scene_id", F.col("room_id").alias("wanted_id"), *(F.col(c).alias(c + "_") for c in ("x0", "x1", "y0", "y1")), mean("x").alias("mx"), mean("y").alias("my"))
    points = draws(rows.join(mine, ["scene_id", "wanted_id"]), n)
    points = points.withColumns({"px": F.col("x0_") + F.col("u1") * (F.col("x1_") - F.col("x0_")), "py": F.col("y0_") + F.col("u2") * (F.col("y1_") - F.col("y0_")), "pz": F.lit(HEIGHT)})
    return O.valid_positions(in_wanted_room(points, rooms), rooms, blockers)


@register_region("inside_room")
def inside_room(rows, rooms, blockers, n=32):
    """Views in a room that look at the mean of its outline's points, or anywhere within 0.1 m of it."""
    points = places(rows, rooms, blockers, n)
    dx, dy, yaw = F.col("mx") - F.col("px"), F.col("my") - F.col("py"), F.radians(F.col("u3") * 360.0)
    far = F.sqrt(dx * dx + dy * dy) > 0.1
    return first_views(points.withColumns({"tx": F.when(far, F.col("mx")).otherwise(F.col("px") + F.cos(yaw)), "ty": F.when(far, F.col("my")).otherwise(F.col("py") + F.sin(yaw)), "tz": F.lit(HEIGHT)}), n)


@register_region("room_positions")
def room_positions(rows, rooms, blockers, n=32):
    """Positions in a room with any heading."""
    yaw = F.radians(F.col("u3") * 360.0)
    return first_views(places(rows, rooms, blockers, n).withColumns({"tx": F.col("px") + F.sin(yaw), "ty": F.col("py") + F.cos(yaw), "tz": F.lit(HEIGHT)}), n)


@register_region("bearing_sector_in_room")
def bearing_sector_in_room(rows, rooms, blockers, n=32, sector=45.0):
    """Positions in a room that look past the target lx, ly by at most the sector less 5 degrees either way."""
    points = places(rows, rooms, blockers, n)
    dx, dy = F.col("lx") - F.col("px"), F.col("ly") - F.col("py")
    size = F.sqrt(dx * dx + dy * dy) + 1e-9
    x, y = rotated(dx / size, dy / size, F.radians(spread(F.col("u3"), 5.0 - sector, sector - 5.0)))
    return first_views(points.withColumns({"tx": F.col("px") + x, "ty": F.col("py") + y, "tz": F.lit(HEIGHT)}), n)


def grid(rows: DataFrame, rooms: DataFrame, blockers: DataFrame, radii: tuple[float, ...], turns: int) -> DataFrame:
    """Valid views on rings of fixed radii around ox, oy, `turns` a ring; i numbers them ring by ring."""
    at = F.array(*(F.struct(F.lit(k).alias("i"), F.lit(r).alias("r"), F.lit(360.0 * t / turns).alias("a")) for k, (r, t) in enumerate((r, t) for r in radii for t in range(turns))))
    made = O.by_scene(rows).select("scene_id", "key", "ox", "oy", F.inline(at))
    points = made.withColumns({"px": F.col("ox") + F.col("r") * F.cos(F.radians("a")), "py": F.col("oy") + F.col("r") * F.sin(F.radians("a")), "pz": F.lit(HEIGHT), "tx": F.col("ox"), "ty": F.col("oy"), "tz": F.lit(HEIGHT)})
    return O.valid_positions(points, rooms, blockers).select("scene_id", "key", "i", *VIEW)


@register_region("anchor_rings")
def anchor_rings(rows, rooms, blockers, radii=(0.8, 1.2, 1.8, 2.6, 3.5), turns=16):
    """Five rings of sixteen views around each anchor."""
    return grid(rows, rooms, blockers, radii, turns)


@register_region("ring_positions")
def ring_positions(rows, rooms, blockers, distance=1.5, tolerance=0.25, n=8):
    """n views around each object, the distance varied by the tolerance and at least 0.3 m."""
    made = draws(rows, 1).where(F.col("i") < n)
    d, a = F.greatest(F.lit(0.3), distance + spread(F.col("u1"), -tolerance, tolerance)), F.radians(360.0 * F.col("i") / n)
    points = made.withColumns({"px": F.col("ox") + d * F.cos(a), "py": F.col("oy") + d * F.sin(a), "pz": F.lit(HEIGHT), "tx": F.col("ox"), "ty": F.col("oy"), "tz": F.lit(HEIGHT)})
    return O.valid_positions(points, rooms, blockers).select("scene_id", "key", "i", *VIEW)


@register_region("eight_headings")
def eight_headings(points: DataFrame) -> DataFrame:
    """Each position (px, py, pz) with eight level headings, 45 degrees apart."""
    turned = points.withColumn("heading", F.explode(F.sequence(F.lit(0), F.lit(7))))
    a = F.radians(45.0 * F.col("heading"))
    return turned.withColumns({"tx": F.col("px") + F.cos(a), "ty": F.col("py") + F.sin(a), "tz": F.col("pz")})


def straight_path(pairs: DataFrame, frames: int = 12) -> DataFrame:
    """Frames of the straight way from one view (a_) to another (b_): positions and targets are interpolated."""
    t = F.col("frame") / float(frames - 1)
    on = pairs.withColumn("frame", F.explode(F.sequence(F.lit(0), F.lit(frames - 1))))
    return on.withColumns({c: (1 - t) * F.col(f"a_{c}") + t * F.col(f"b_{c}") for c in VIEW})


#: Directions from an object to its preset views: fixed values.
PRESETS = {
    "front": (0.0, -1.0, 0.3), "back": (0.0, 1.0, 0.3), "left": (-1.0, 0.0, 0.3), "right": (1.0, 0.0, 0.3), "above": (0.0, 0.0, 1.0), "diagonal": (1.0, -1.0, 0.6), "close": (0.0, -0.5, 0.15), "low": (0.0, -1.0, -0.3),
    "front_left": (-1.0, -1.0, 0.3), "front_right": (1.0, -1.0, 0.3), "back_left": (-1.0, 1.0, 0.3), "back_right": (1.0, 1.0, 0.3),
    "front_left_up": (-1.0, -1.0, 0.6), "front_right_up": (1.0, -1.0, 0.6), "back_left_up": (-1.0, 1.0, 0.6), "back_right_up": (1.0, 1.0, 0.6),
    "front_left_low": (-1.0, -1.0, -0.2), "front_right_low": (1.0, -1.0, -0.2), "back_left_low": (-1.0, 1.0, -0.2), "back_right_low": (1.0, 1.0, -0.2),
}


def preset_views(objects: DataFrame, rooms: DataFrame, boxes: DataFrame, presets: dict[str, tuple[float, float, float]] = PRESETS, scale: float = 1.0) -> DataFrame:
    """(scene_id, object_id, preset, steps, reason, pose): an object's first view outwards along each direction that has it whole in the image.

    The camera leaves the box and moves away by equal steps, looking back at the centre, so that its axes stay and each
    corner asks for a least distance; their greatest, in steps, is the answer, without trying. Then no place on the way
    may be in a box or out of all rooms. `reason` is null for a view, else too_far, blocked or outside; the pose is
    null then. Objects without a box have no rows.
    """
    at = F.explode(F.array(*(F.struct(F.lit(n).alias("preset"), *(F.lit(x / sum(y * y for y in d) ** 0.5).alias(f"d{a}") for a, x in zip(G.AXES, d))) for n, d in presets.items())))
    rows = O.by_scene(objects.where("min_x IS NOT NULL")).select("scene_id", "object_id", *(G.center(a).alias(f"c{a}") for a in G.AXES), *((G.dim(a) / 2).alias(f"h{a}") for a in G.AXES), at.alias("p_")).select("*", "p_.*").drop("p_")
    d, h = ([F.col(f"{n}{a}") for a in G.AXES] for n in "dh")
    big = 2 * F.greatest(*h)
    out = F.least(*(F.when(F.abs(x) >= 1e-9, y / F.abs(x)) for x, y in zip(d, h)))
    level = F.sqrt(d[0] * d[0] + d[1] * d[1])
    flat = level >= 1e-6
    # Forward is against the direction; right and up are level and upright to it.
    rx, ry = F.when(flat, -d[1] / level).otherwise(F.lit(1.0)), F.when(flat, d[0] / level).otherwise(F.lit(0.0))
    rows = rows.withColumns({"begin_": out + F.greatest(F.lit(1e-3), 0.01 * big), "step_": F.greatest(F.lit(0.2), 0.2 * big) * scale, "most_": 20.0 * scale * big, "rx_": rx, "ry_": ry})
    rows = rows.withColumns({"ux_": -F.col("ry_") * d[2], "uy_": F.col("rx_") * d[2], "uz_": F.col("ry_") * d[0] - F.col("rx_") * d[1]})
    needs = []
    for i, j, k in CORNERS:
        o = [x * (2 * s - 1) for x, s in zip(h, (i, j, k))]
        right, up = o[0] * F.col("rx_") + o[1] * F.col("ry_"), o[0] * F.col("ux_") + o[1] * F.col("uy_") + o[2] * F.col("uz_")
        needs.append(o[0] * d[0] + o[1] * d[1] + o[2] * d[2] + F.greatest(F.abs(right), F.abs(up)) * (2 * FOCAL / WIDTH))
    # Only beyond its need is a corner in the image: a whole number of steps to it is one too few.
    steps = F.greatest(F.lit(0), F.floor(F.round((F.greatest(*needs) - F.col("begin_")) / F.col("step_"), 9)).cast("int") + 1)
    rows = rows.withColumns({"steps": steps, "far_": F.col("begin_") + steps * F.col("step_")}).withColumn("late_", F.round((F.col("steps") - 1) * F.col("step_"), 9) > F.round(F.col("most_"), 9))
    keep = ["scene_id", "object_id", "preset"]
    places_ = rows.where("NOT late_").withColumn("k_", F.explode(F.sequence(F.lit(0), F.col("steps"))))
    places_ = places_.select(*keep, "k_", *((F.col(f"c{a}") + F.col(f"d{a}") * (F.col("begin_") + F.col("k_") * F.col("step_"))).alias(f"p{a}") for a in G.AXES))
    free = O.outside_boxes(places_, boxes, 0.0).select(*keep, "k_", "px", "py", "pz")
    home = O.in_rooms(free, rooms)
    counted = free.groupBy(*keep).agg(F.count("*").alias("free_")).join(home.groupBy(*keep).agg(F.count("*").alias("home_")), keep, "left")
    rows = rows.join(counted, keep, "left")
    reason = F.when(F.col("late_"), "too_far").when(F.coalesce("free_", F.lit(0)) <= F.col("steps"), "blocked").when(F.coalesce("home_", F.lit(0)) <= F.col("steps"), "outside")
    pose = [F.when(reason.isNull(), F.col(f"c{a}") + F.col(f"d{a}") * F.col("far_")).alias(f"p{a}") for a in G.AXES]
    return rows.select(*keep, "steps", reason.alias("reason"), *pose, *(F.when(reason.isNull(), F.col(f"c{a}")).alias(f"t{a}") for a in G.AXES))


def sample_region(name: str, *args, **kwargs) -> DataFrame:
    if name not in REGIONS:
        raise KeyError(f"unknown region generator: {name}")
    return REGIONS[name](*args, **kwargs)
