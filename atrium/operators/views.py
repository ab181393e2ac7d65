"""Operators over camera views: look-at projection and what a view sees.

A view is a position px, py, pz and a target tx, ty, tz. A camera looks along the way to its target; its
image has u to the left and v upwards.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators.objects import BUILT
from atrium.operators.storage import written

#: Intrinsics: pixels of the square image and its focal length.
WIDTH, FOCAL = 400.0, 160.0
#: Image coordinates are whole multiples of 1 / SNAP pixel, so that a corner on the image's edge is in it on any engine.
SNAP = 1e6
#: Corners for visibility lie so far inside their box: a share of its half sides, at most so many metres.
INSET, INSET_MOST = 0.05, 0.05
#: Low and high side of x, y and z for each corner.
CORNERS = [(i, j, k) for k, j, i in itertools.product((0, 1), repeat=3)]


def with_camera(views: DataFrame) -> DataFrame:
    """Views with the camera's axes: cam_f (to the target), cam_r (to the right, level) and cam_u (upwards)."""
    d = [F.col(f"t{a}") - F.col(f"p{a}") for a in G.AXES]
    size = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]) + 1e-8
    f = {f"cam_f{a}": x / size for a, x in zip(G.AXES, d)}
    level = F.sqrt(F.col("cam_fx") * F.col("cam_fx") + F.col("cam_fy") * F.col("cam_fy"))
    flat = level > 1e-6
    r = {"cam_rx": F.when(flat, F.col("cam_fy") / level).otherwise(F.lit(1.0)), "cam_ry": F.when(flat, -F.col("cam_fx") / level).otherwise(F.lit(0.0))}
    rx, ry, fx, fy, fz = (F.col(f"cam_{n}") for n in ("rx", "ry", "fx", "fy", "fz"))
    return views.withColumns(f).withColumns(r).withColumns({"cam_ux": ry * fz, "cam_uy": -rx * fz, "cam_uz": rx * fy - ry * fx})


def pixel(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Image u and v of a point, and its depth; u and v are null at or behind the camera."""
    dx, dy, dz = x - F.col("px"), y - F.col("py"), z - F.col("pz")
    depth = dx * F.col("cam_fx") + dy * F.col("cam_fy") + dz * F.col("cam_fz")
    right = dx * F.col("cam_rx") + dy * F.col("cam_ry")
    up = dx * F.col("cam_ux") + dy * F.col("cam_uy") + dz * F.col("cam_uz")
    ahead = depth > 1e-6
    return F.when(ahead, WIDTH / 2 - FOCAL * right / depth), F.when(ahead, WIDTH / 2 + FOCAL * up / depth), depth


def view_objects(views: DataFrame, roomed: DataFrame) -> DataFrame:
    """Views (with room_id) beside the objects of their room: an equi-join on scene and room."""
    return views.join(roomed.hint(BUILT), ["scene_id", "room_id"])


def snapped(x: Column) -> Column:
    return F.rint(x * SNAP) / SNAP


def sides(axis: str, inset: bool = False) -> tuple[Column, Column]:
    """Low and high side of a box, for visibility a little inside it."""
    low, high = G.lo(axis), G.hi(axis)
    if not inset:
        return low, high
    by = F.least((high - low) / 2 * INSET, F.lit(INSET_MOST))
    return low + by, high - by


def with_projection(pairs: DataFrame) -> DataFrame:
    """Adds what a view sees of a box: n_corners and box_w, box_h, mean_u, mean_v of the corners in the image,
    in_mask (bits of the inset corners in the image), distance, bearing in the plane, and angle from forward in space.

    The views must have their camera's axes. All of it is plain columns, which compile; no arrays.
    """
    # Per axis and side, what a corner there adds to depth, right and up: corners are sums of three of these.
    terms, raw, bits = {}, {}, {}
    for kind, inset in (("c", False), ("s", True)):
        for a in G.AXES:
            for i, side in enumerate(sides(a, inset)):
                d = side - F.col(f"p{a}")
                terms |= {f"{kind}{m}{a}{i}_": d * F.col(f"cam_{m}{a}") for m in "fru" if m != "r" or a != "z"}
    for n, at in enumerate(CORNERS):
        for kind in "cs":
            term = lambda m, axes="xyz": sum((F.col(f"{kind}{m}{a}{i}_") for a, i in zip(axes, at)), F.lit(0.0))  # noqa: E731, B023
            raw |= {f"{kind}d{n}_": term("f"), f"{kind}u{n}_": snapped(WIDTH / 2 - FOCAL * F.try_divide(term("r", "xy"), term("f"))), f"{kind}v{n}_": snapped(WIDTH / 2 + FOCAL * F.try_divide(term("u"), term("f")))}
            bits[f"{kind}i{n}_"] = (F.col(f"{kind}d{n}_") > 1e-6) & G.in_image(F.col(f"{kind}u{n}_"), F.col(f"{kind}v{n}_"), WIDTH)
    us, vs = ([F.when(F.col(f"ci{n}_"), F.col(f"c{a}{n}_")) for n in range(8)] for a in "uv")
    count = sum((F.col(f"ci{n}_").cast("int") for n in range(8)), F.lit(0))
    mean = lambda parts: sum((F.coalesce(x, F.lit(0.0)) for x in parts), F.lit(0.0)) / F.nullif(F.col("n_corners"), F.lit(0))
    dx, dy, dz = (G.center(a) - F.col(f"p{a}") for a in G.AXES)
    far = F.sqrt(dx * dx + dy * dy + dz * dz)
    ahead = dx * F.col("cam_fx") + dy * F.col("cam_fy") + dz * F.col("cam_fz")
    found = {
        "box_w": F.coalesce(F.greatest(*us) - F.least(*us), F.lit(0.0)),
        "box_h": F.coalesce(F.greatest(*vs) - F.least(*vs), F.lit(0.0)),
        "mean_u": mean(us),
        "mean_v": mean(vs),
        # The partition's number times 0 keeps filters on the mask above it: pushed down, they would repeat all corners.
        "in_mask": sum((F.col(f"si{n}_").cast("int") * (1 << n) for n in range(8)), F.spark_partition_id() * 0),
        "distance": far,
        "bearing": G.signed_yaw(F.col("cam_fx"), F.col("cam_fy"), dx, dy),
        "angle": F.when(far < 1e-6, F.lit(0.0)).otherwise(F.degrees(F.acos(G.clamp(ahead / far, -1.0, 1.0)))),
    }
    return pairs.withColumns(terms).withColumns(raw).withColumns(bits).withColumn("n_corners", count).withColumns(found).drop(*terms, *raw, *bits)


def in_frame(least_corners: int = 4) -> Column:
    return F.col("n_corners") >= least_corners


def scale() -> Column:
    return F.col("box_w") * F.col("box_h") / (WIDTH * WIDTH)


def visible_labels(seen: DataFrame) -> DataFrame:
    """Count of visible instances per view and label."""
    return seen.groupBy("view_id", "label").agg(F.count("*").alias("n"))


def anchor_object(seen: DataFrame) -> DataFrame:
    """The object with the largest image box of each view, ties to the smaller id."""
    best = F.max(F.struct(F.round(F.col("box_w") * F.col("box_h"), 6).alias("area"), (-F.col("object_id")).alias("id")))
    return seen.groupBy("view_id").agg(best.alias("m")).select("view_id", (-F.col("m.id")).alias("object_id"), F.col("m.area").alias("area"))


def view_pair_counts(seen: DataFrame, least: float = 0.05) -> DataFrame:
    """(scene_id, object_id, n_views, n_pairs): ordered pairs of a start and an end view, at least `least` metres apart, that see one object.

    All pairs count, none is made: from the square of an object's views those come off that are too near, which meet
    by cells of that side after views of one position have become one row. Null positions are near nothing.
    These rows are written, as three uses would make them three times, all within one task where rows lie by scene; then they are dealt by object.
    """
    views = seen.select("scene_id", "object_id", *(f"p{a}" for a in G.AXES)).groupBy("scene_id", "object_id", *(f"p{a}" for a in G.AXES)).agg(F.count("*").alias("m"))
    views = written(views).repartition("scene_id", "object_id")
    at = [F.floor(F.col(f"p{a}") / least).cast("long").alias(f"i{a}") for a in G.AXES]
    placed = views.select("*", *at).withColumn("id", F.struct(*(f"p{a}" for a in G.AXES)))
    around = F.explode(F.array(*(F.struct(*(F.lit(s).alias(a) for a, s in zip(G.AXES, step))) for step in itertools.product((-1, 0, 1), repeat=3))))
    a = placed.withColumn("s", around).select("scene_id", "object_id", F.col("id").alias("a"), F.col("m").alias("am"), *((F.col(f"i{x}") + F.col(f"s.{x}")).alias(f"i{x}") for x in G.AXES))
    b = placed.select("scene_id", "object_id", F.col("id").alias("b"), F.col("m").alias("bm"), *(f"i{x}" for x in G.AXES))
    d = sum(((F.col(f"a.p{x}") - F.col(f"b.p{x}")) * (F.col(f"a.p{x}") - F.col(f"b.p{x}")) for x in G.AXES), F.lit(0.0))
    near = a.join(b, ["scene_id", "object_id", *(f"i{x}" for x in G.AXES)]).where(d < least * least).groupBy("scene_id", "object_id").agg(F.sum(F.col("am") * F.col("bm")).alias("near"))
    totals = views.groupBy("scene_id", "object_id").agg(F.sum("m").alias("n_views"))
    return totals.join(near, ["scene_id", "object_id"], "left").select("scene_id", "object_id", "n_views", (F.col("n_views") * F.col("n_views") - F.coalesce("near", "n_views")).alias("n_pairs"))
