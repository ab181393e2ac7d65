"""Predicates over views, by name: each gives a boolean Column from its arguments.

Rows hold what a view sees of an object, under a prefix: the columns of `views.with_projection` and
`occlusion.visibility`. A null (an unknown object) fails a predicate, unless it says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators.views import WIDTH

PREDICATES: dict[str, Callable[..., Column]] = {}


def register_predicate(*names: str):
    """Make a builder of boolean Columns known under names."""

    def add(build):
        PREDICATES.update(dict.fromkeys(names, build))
        return build

    return add


def holds(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


@register_predicate("is_visible", "Visible")
def visible(obj: str = "", min_corners: int = 4, max_occ: float = 0.30) -> Column:
    return holds((F.col(f"{obj}n_visible") >= min_corners) & (F.col(f"{obj}occluded") <= max_occ))


@register_predicate("distance_band", "DistanceBand")
def distance_band(obj: str = "", d_min: float = 0.0, d_max: float = 1e9) -> Column:
    return holds(F.col(f"{obj}distance").between(d_min, d_max))


@register_predicate("aspect_exposed", "AspectExposed")
def aspect_exposed(obj: str = "", min_ratio: float = 0.30) -> Column:
    w, h = F.col(f"{obj}box_w"), F.col(f"{obj}box_h")
    return holds((F.col(f"{obj}n_corners") >= 4) & (F.least(w, h) >= 1e-3) & (F.try_divide(F.least(w, h), F.greatest(w, h)) >= min_ratio))


@register_predicate("is_centered", "Centered")
def centered(obj: str = "", theta_deg: float = 25.0) -> Column:
    return holds(F.col(f"{obj}angle") <= theta_deg)


@register_predicate("scale_band", "ScaleBand")
def scale_band(obj: str = "", s_min: float = 0.05, s_max: float = 0.70) -> Column:
    return holds((F.col(f"{obj}n_corners") >= 2) & (F.col(f"{obj}box_w") * F.col(f"{obj}box_h") / (WIDTH * WIDTH)).between(s_min, s_max))


@register_predicate("bearing_within", "BearingWithin")
def bearing_within(obj: str = "", bearing_min_deg: float = -180.0, bearing_max_deg: float = 180.0, theta_deg: float | None = None) -> Column:
    low, high = (bearing_min_deg, bearing_max_deg) if theta_deg is None else (-theta_deg, theta_deg)
    return holds(F.col(f"{obj}bearing").between(low, high))


@register_predicate("in_room", "InRoom")
def in_room(room: Column | str | None = None, at: str = "room_id") -> Column:
    """The view is in that room, or in any if none is given."""
    return F.col(at).isNotNull() if room is None else holds(F.col(at) == room)


@register_predicate("not_blocked_by", "NotBlockedBy")
def not_blocked_by(obj: str = "", blocker: Column | None = None) -> Column:
    """Less than half hidden, or with a blocker: what hides most of it is another one or none (column primary)."""
    return holds(F.col(f"{obj}occluded") < 0.5) if blocker is None else ~F.col(f"{obj}primary").eqNullSafe(blocker)


@register_predicate("orthogonal_to_plane", "OrthogonalToPlane")
def orthogonal_to_plane(nx: Column, ny: Column, nz: Column, max_offset_deg: float = 15.0, theta_max_deg: float | None = None) -> Column:
    """The view looks along a plane's normal, either way; an unknown plane passes."""
    angle = G.angle_between(F.col("cam_fx"), F.col("cam_fy"), F.col("cam_fz"), nx, ny, nz)
    return F.coalesce(F.least(angle, 180.0 - angle) <= (max_offset_deg if theta_max_deg is None else theta_max_deg), F.lit(True))


@register_predicate("pair_visible", "PairVisible")
def pair_visible(obj_a: str = "a_", obj_b: str = "b_", min_corners: int = 3, max_occ: float = 0.40) -> Column:
    return visible(obj_a, min_corners, max_occ) & visible(obj_b, min_corners, max_occ)


@register_predicate("separation_on_image", "SeparationOnImage")
def separation_on_image(obj_a: str = "a_", obj_b: str = "b_", min_separation_px: float = 40.0, s_min_frac: float | None = None) -> Column:
    """The mean corners in the image are that far apart; one object for both passes."""
    least = min_separation_px if s_min_frac is None else s_min_frac * WIDTH
    du, dv = (F.col(f"{obj_a}mean_{c}") - F.col(f"{obj_b}mean_{c}") for c in "uv")
    return F.when(F.col(f"{obj_a}object_id") == F.col(f"{obj_b}object_id"), F.lit(True)).otherwise(holds(F.sqrt(du * du + dv * dv) >= least))


@register_predicate("side_view", "SideView")
def side_view(nx: Column, ny: Column, nz: Column, obj: str = "", min_angle_deg: float = 30.0, max_angle_deg: float = 80.0) -> Column:
    """The camera stands at that angle from a face's normal."""
    d = [F.col(f"p{a}") - G.center(a, obj) for a in G.AXES]
    return holds(G.angle_between(*d, nx, ny, nz).between(min_angle_deg, max_angle_deg))


def face_normal(side: Column, front_x: Column | None = None, front_y: Column | None = None) -> tuple[Column, Column, Column]:
    """Outward normal of a named face: from the object's front direction, else from the axes (front is +y); null for other names."""
    fx = F.lit(0.0) if front_x is None else F.coalesce(front_x, F.lit(0.0))
    fy = F.lit(1.0) if front_y is None else F.coalesce(front_y, F.lit(1.0))
    x = F.when(side == "front", fx).when(side == "back", -fx).when(side == "right", fy).when(side == "left", -fy).when(side.isin("top", "bottom"), F.lit(0.0))
    y = F.when(side == "front", fy).when(side == "back", -fy).when(side == "right", -fx).when(side == "left", fx).when(side.isin("top", "bottom"), F.lit(0.0))
    z = F.when(side == "top", F.lit(1.0)).when(side == "bottom", F.lit(-1.0)).when(side.isin("front", "back", "left", "right"), F.lit(0.0))
    return x, y, z


def pair_plane_normal(a: str, b: str) -> tuple[Column, Column, Column]:
    """Level normal of the upright plane through two centres; null if they are above each other."""
    dx, dy = G.center("x", b) - G.center("x", a), G.center("y", b) - G.center("y", a)
    size = F.sqrt(dx * dx + dy * dy)
    there = size >= 1e-6
    return F.when(there, -dy / size), F.when(there, dx / size), F.when(there, F.lit(0.0))


def wall_normal(prefix: str = "") -> tuple[Column, Column, Column]:
    """A wall's normal is the axis of its shorter level side."""
    across = G.dim("x", prefix) <= G.dim("y", prefix)
    return F.when(across, F.lit(1.0)).otherwise(F.lit(0.0)), F.when(across, F.lit(0.0)).otherwise(F.lit(1.0)), F.lit(0.0)


def evaluate(rows: DataFrame, specs: list[tuple[str, dict]], names: list[str] | None = None) -> DataFrame:
    """rows (task_id, step, slot_id ...) in long form: one row per predicate of specs (name, arguments), with predicate and ok."""
    if unknown := [n for n, _ in specs if n not in PREDICATES]:
        raise KeyError(f"unknown predicates: {unknown}")
    made = F.array(*(F.struct(F.lit(names[i] if names else n).alias("predicate"), PREDICATES[n](**args).alias("ok")) for i, (n, args) in enumerate(specs)))
    return rows.select("*", F.inline(made))
