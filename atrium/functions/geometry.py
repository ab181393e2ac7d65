"""Geometry of boxes, points and views as Columns.

A box is six columns min_x .. max_z, a view a position px, py, pz and a forward direction fx, fy, fz (z up).
Prefixes tell several boxes or views of one row apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = ("x", "y", "z")


def lo(axis: str, prefix: str = "") -> Column:
    return F.col(f"{prefix}min_{axis}")


def hi(axis: str, prefix: str = "") -> Column:
    return F.col(f"{prefix}max_{axis}")


def center(axis: str, prefix: str = "") -> Column:
    return (lo(axis, prefix) + hi(axis, prefix)) / 2


def dim(axis: str, prefix: str = "") -> Column:
    return hi(axis, prefix) - lo(axis, prefix)


def volume(prefix: str = "") -> Column:
    return dim("x", prefix) * dim("y", prefix) * dim("z", prefix)


def longest(prefix: str = "") -> Column:
    return F.greatest(*(dim(a, prefix) for a in AXES))


def shortest(prefix: str = "") -> Column:
    return F.least(*(dim(a, prefix) for a in AXES))


def xy_max_dim(prefix: str = "") -> Column:
    return F.greatest(dim("x", prefix), dim("y", prefix))


def shape_distance(a: str, b: str) -> Column:
    """Distance of the sorted sides of two boxes, each box's sides divided by the length of all three."""
    def sides(p):
        d = [F.greatest(dim(x, p), F.lit(1e-6)) for x in AXES]
        norm, low, high = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]), F.least(*d), F.greatest(*d)
        return low / norm, (d[0] + d[1] + d[2] - low - high) / norm, high / norm

    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(sides(a), sides(b))), F.lit(0.0)))


def similar_shape(a: str, b: str, most: float = 0.18, ratio: float = 2.5) -> Column:
    return (shape_distance(a, b) <= most) & (F.greatest(volume(a), volume(b)) <= ratio * F.least(volume(a), volume(b)))


def xy_distance(a: str, b: str) -> Column:
    return F.sqrt(sum(((center(x, a) - center(x, b)) * (center(x, a) - center(x, b)) for x in ("x", "y")), F.lit(0.0)))


def center_distance(a: str, b: str) -> Column:
    return F.sqrt(sum(((center(x, a) - center(x, b)) * (center(x, a) - center(x, b)) for x in AXES), F.lit(0.0)))


def gap(axis: str, a: str, b: str) -> Column:
    return F.greatest(F.lit(0.0), lo(axis, a) - hi(axis, b), lo(axis, b) - hi(axis, a))


def box_distance(a: str, b: str, axes: tuple[str, ...] = AXES) -> Column:
    """Least distance of two boxes; over x and y alone with axes=("x", "y")."""
    return F.sqrt(sum((gap(x, a, b) * gap(x, a, b) for x in axes), F.lit(0.0)))


def overlap_xy(a: str, b: str) -> Column:
    side = lambda x: F.greatest(F.lit(0.0), F.least(hi(x, a), hi(x, b)) - F.greatest(lo(x, a), lo(x, b)))
    return side("x") * side("y")


def footprint(prefix: str = "") -> Column:
    return dim("x", prefix) * dim("y", prefix)


def point_box_distance(px: Column, py: Column, pz: Column, prefix: str = "") -> Column:
    out = F.lit(0.0)
    for axis, p in zip(AXES, (px, py, pz)):
        d = F.greatest(F.lit(0.0), lo(axis, prefix) - p, p - hi(axis, prefix))
        out = out + d * d
    return F.sqrt(out)


def in_box(px: Column, py: Column, pz: Column, prefix: str = "", margin: float = 0.0) -> Column:
    return px.between(lo("x", prefix) - margin, hi("x", prefix) + margin) & py.between(lo("y", prefix) - margin, hi("y", prefix) + margin) & pz.between(lo("z", prefix) - margin, hi("z", prefix) + margin)


def union_box(a: str, b: str) -> list[Column]:
    return [f(g(x, a), g(x, b)).alias(f"{n}_{x}") for x in AXES for n, f, g in (("min", F.least, lo), ("max", F.greatest, hi))]


def corners(prefix: str = "") -> Column:
    """The eight corners as an array of (x, y, z)."""
    return F.array(*(F.struct(fx("x", prefix).alias("x"), fy("y", prefix).alias("y"), fz("z", prefix).alias("z")) for fx in (lo, hi) for fy in (lo, hi) for fz in (lo, hi)))


def in_image(u: Column, v: Column, width: float = 400.0, border: float = 0.0) -> Column:
    return F.coalesce((u >= border) & (u < width - border) & (v >= border) & (v < width - border), F.lit(False))


def hfov_deg(width: float = 400.0, focal: float = 160.0) -> Column:
    return 2 * F.degrees(F.atan(F.lit(width / (2 * focal))))


def signed_yaw(fx: Column, fy: Column, dx: Column, dy: Column) -> Column:
    """Degrees from forward to a direction in the plane, positive where its cross product with forward is; 90 for no direction."""
    none = (F.abs(dx) < 1e-9) & (F.abs(dy) < 1e-9)
    return F.when(none, F.lit(90.0)).otherwise(F.degrees(F.atan2(fx * dy - fy * dx, fx * dx + fy * dy)))


def bearing_label(yaw: Column, front: float = 30.0, back: float = 150.0) -> Column:
    return F.when(F.abs(yaw) <= front, "ahead").when(F.abs(yaw) >= back, "behind").when(yaw > 0, "left").otherwise("right")


def heading_delta(a: Column, b: Column) -> Column:
    """b - a, to a billionth, wrapped to (-180, 180]: a half turn is 180 whatever its last bit says."""
    d = F.pmod(F.round(b - a, 9) + 180.0, F.lit(360.0))
    return F.when(d == 0, F.lit(180.0)).otherwise(d - 180.0)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def angle_between(ax, ay, az, bx, by, bz) -> Column:
    """Degrees between two directions; null if either has no length."""
    dot = ax * bx + ay * by + az * bz
    size = F.sqrt(ax * ax + ay * ay + az * az) * F.sqrt(bx * bx + by * by + bz * bz)
    return F.when(size > 0, F.degrees(F.acos(clamp(dot / size, -1.0, 1.0))))


COMPASS8 = ("east", "northeast", "north", "northwest", "west", "southwest", "south", "southeast")


def compass8(dx: Column, dy: Column) -> Column:
    sector = F.floor(F.pmod(F.degrees(F.atan2(dy, dx)), F.lit(360.0)) / 45.0 + 0.5).cast("int") % 8
    return F.element_at(F.array(*map(F.lit, COMPASS8)), sector + 1)


def axis_relation(dx: Column, dy: Column) -> Column:
    """The larger world axis of a displacement: east, west, north or south."""
    return F.when(F.abs(dx) >= F.abs(dy), F.when(dx >= 0, "east").otherwise("west")).otherwise(F.when(dy >= 0, "north").otherwise("south"))


def camera_direction(right: Column, up: Column, forward: Column, threshold: float = 0.30) -> Column:
    """Named direction of a displacement in camera axes: vertical, then front or back, then side, each that makes up the
    threshold's share of its length; the greatest alone if none does, "same" for no displacement."""
    size = F.sqrt(right * right + up * up + forward * forward)
    names = [(up, "above", "below"), (forward, "front", "back"), (right, "right", "left")]
    part = lambda v, plus, minus: F.when(v > 0, plus).otherwise(minus)
    joined = F.concat_ws("-", *(F.when(F.abs(v) / size >= threshold, part(v, p, m)) for v, p, m in names))
    most = F.greatest(*(F.abs(v) for v, _, _ in names))
    alone = F.when(F.abs(forward) == most, part(*names[1])).when(F.abs(right) == most, part(*names[2])).otherwise(part(*names[0]))
    return F.when(size < 1e-6, "same").when(joined == "", alone).otherwise(joined)


def yaw_between(fx: Column, fy: Column, gx: Column, gy: Column, limit: float = 100.0) -> Column:
    """Level turn from one forward direction to another in degrees, positive to the left, within the limit; 0 for an upright one."""
    upright = (F.sqrt(fx * fx + fy * fy) < 1e-6) | (F.sqrt(gx * gx + gy * gy) < 1e-6)
    return F.when(upright, F.lit(0.0)).otherwise(clamp(signed_yaw(fx, fy, gx, gy), -limit, limit))


def relative_label(right: Column, up: Column, forward: Column, threshold: float = 0.05) -> Column:
    """Where a second object is seen from a first one, from the difference of their camera coordinates: two axes at most,
    side before depth before height; the image is mirrored, so that more to the right reads "left". Null if all are small."""
    side = F.when(F.abs(right) > threshold, F.when(right > 0, "left").otherwise("right"))
    depth = F.when(F.abs(forward) > threshold, F.when(forward < 0, "front").otherwise("back"))
    height = F.when(F.abs(up) > threshold, F.when(up > 0, "above").otherwise("below"))
    both = F.array_join(F.slice(F.filter(F.array(side, depth, height), lambda x: x.isNotNull()), 1, 2), "-")
    return F.nullif(both, F.lit(""))


def side_label(yaw: Column) -> Column:
    """Left, Right, LeftBack or RightBack of a bearing in degrees, positive to the left; 0 is Right."""
    return F.when(F.abs(yaw) > 90, F.when(yaw > 0, "LeftBack").otherwise("RightBack")).otherwise(F.when(yaw > 0, "Left").otherwise("Right"))


def pose_key(px: Column, py: Column, pz: Column, yaw: Column, step: float = 0.25, turn: float = 15.0) -> Column:
    """A pose rounded to steps (heights to 0.1 m at least), to tell equal ones."""
    return F.struct(F.bround(px / step).alias("x"), F.bround(py / step).alias("y"), F.bround(pz / max(step, 0.1)).alias("z"), F.bround(yaw / turn).alias("yaw"))


def point_in_polygon(px: Column, py: Column, poly: Column) -> Column:
    """Even-odd ray cast over an array of (x, y); outlines of four points as plain columns, which compile."""
    def crosses(i, j=None):
        a, b = F.get(poly, i), F.get(poly, (i + 1) % F.size(poly) if j is None else j)
        ay, by = a.getField("y"), b.getField("y")
        at = (b.getField("x") - a.getField("x")) * (py - ay) / (by - ay + 1e-12) + a.getField("x")
        return (((ay > py) != (by > py)) & (px < at)).cast("int")

    # a function of two parameters would get a place in the array as its second
    edges = F.transform(F.sequence(F.lit(0), F.size(poly) - 1), lambda i: crosses(i))
    any_shape = F.aggregate(edges, F.lit(0), lambda s, x: s + x) % 2 == 1
    four = sum((crosses(F.lit(i), F.lit((i + 1) % 4)) for i in range(4)), F.lit(0)) % 2 == 1
    return F.when(F.size(poly) == 4, four).otherwise(any_shape)


def segment_distance(px, py, ax, ay, bx, by) -> Column:
    dx, dy = bx - ax, by - ay
    size = dx * dx + dy * dy
    t = F.when(size > 0, clamp(((px - ax) * dx + (py - ay) * dy) / size, 0.0, 1.0)).otherwise(F.lit(0.0))
    ex, ey = px - (ax + t * dx), py - (ay + t * dy)
    return F.sqrt(ex * ex + ey * ey)
