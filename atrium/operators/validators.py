"""Validators of a first view, by the name of the trigger field that asks for them.

Each gives a score Column from the field's value and what the row holds: null rejects the view, 0 says nothing.
Prefixes name objects as a view sees them (columns of `views.with_projection` and `occlusion.visibility`), and
angles are in degrees from forward in the plane.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators.predicates import visible
from atrium.operators.views import FOCAL, WIDTH

VALIDATORS: dict[str, Callable[..., Column]] = {}


def register_validator(*fields: str):
    def add(build):
        VALIDATORS.update(dict.fromkeys(fields, build))
        return build

    return add


def rejected() -> Column:
    return F.lit(None).cast("double")


def plane_angle(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Degrees between two directions in the plane; null if either is shorter than 1e-6."""
    sizes = F.least(F.sqrt(ax * ax + ay * ay), F.sqrt(bx * bx + by * by))
    return F.when(sizes >= 1e-6, G.angle_between(ax, ay, F.lit(0.0), bx, by, F.lit(0.0)))


def level_angle(x: Column, y: Column) -> Column:
    """Degrees in the plane from forward to a point, whichever side it is on; null if either has no direction."""
    return plane_angle(F.col("cam_fx"), F.col("cam_fy"), x - F.col("px"), y - F.col("py"))


def seen_at(obj: str) -> Column:
    return level_angle(G.center("x", obj), G.center("y", obj))


@register_validator("target_invisible_at_init")
def target_hidden(value: bool, obj: str = "") -> Column:
    """The target shows one corner at most (or, for False, is plainly seen); better the nearer it is to forward."""
    a, hint = seen_at(obj), visible(obj, 1, 0.95)
    wrong = (visible(obj, 2, 0.95) | visible(obj, 4, 0.30)) if value else ~visible(obj, 4, 0.30)
    graded = F.when(a.isNull(), F.when(hint, 0.6).otherwise(0.4)).when(~hint, F.when(a <= 50, 0.8).otherwise(0.3))
    return F.when(wrong, rejected()).otherwise(graded.when(a <= 20, 1.0).when(a <= 35, 0.7).when(a <= 50, 0.4).otherwise(0.1))


def faced(angle: Column, unknown: float) -> Column:
    """A door must be within half the field of view; better the nearer it is to forward."""
    return F.when(angle.isNull(), F.lit(unknown)).when(angle > G.hfov_deg(WIDTH, FOCAL) / 2, rejected()).when(angle <= 15, 1.0).when(angle <= 35, 0.7).otherwise(F.lit(0.5))


@register_validator("portal_invisible_at_init")
def portal_in_view(value: bool, x: Column, y: Column) -> Column:
    return faced(level_angle(x, y), 0.3)


@register_validator("target_invisible_from_room_a")
def starts_in_room(value: bool, in_room: Column, x: Column, y: Column, obj: str = "") -> Column:
    """The view is in the first room, doesn't see the target, and has the door in view."""
    if not value:
        return F.lit(0.0)
    return F.when(~F.coalesce(in_room, F.lit(False)) | visible(obj, 3, 0.40), rejected()).otherwise(faced(level_angle(x, y), 0.4))


@register_validator("max_both_pairs_visible_at_init")
def not_both_pairs(value: bool, subject: str = "s_", ref_b: str = "b_", ref_c: str = "c_") -> Column:
    """Not the subject with both references; best the subject with one."""
    if value:
        return F.lit(0.0)
    whole = lambda o: visible(o, 4, 0.30)
    with_b, with_c, clear = whole(subject) & whole(ref_b), whole(subject) & whole(ref_c), visible(subject, 3, 0.50)
    partial = sum(((F.coalesce(F.col(f"{o}n_corners"), F.lit(0)) > 0).cast("int") for o in (subject, ref_b, ref_c)), F.lit(0))
    return F.when(with_b & with_c, rejected()).when(clear & (with_b | with_c), 1.0).when(clear, 0.7).when(partial >= 2, 0.4).when(partial == 1, 0.3).otherwise(0.1)


def share_of(x: Column, most: float) -> Column:
    """1 for nothing, down to 0.5 at the bound; beyond it the view is rejected."""
    return F.when(x > most, rejected()).otherwise(1.0 - 0.5 * x / max(most, 1e-6))


@register_validator("max_init_separation_frac")
def merged(value: float, a: str = "a_", b: str = "b_") -> Column:
    """Both objects' mean corners lie that near in the image, as a share of its width; 0.3 if one has none in it."""
    du, dv = (F.col(f"{a}mean_{c}") - F.col(f"{b}mean_{c}") for c in "uv")
    hidden = (F.col(f"{a}n_corners") == 0) | (F.col(f"{b}n_corners") == 0)
    return F.when(F.col(f"{a}object_id") == F.col(f"{b}object_id"), 0.0).when(hidden, 0.3).otherwise(share_of(F.sqrt(du * du + dv * dv) / WIDTH, value))


@register_validator("min_init_occlusion_fraction", "min_target_occlusion_at_init")
def occluded_enough(value: float, obj: str = "") -> Column:
    """The object (the back one, or the target) is hidden by that share."""
    occ = F.col(f"{obj}occluded")
    return F.when(occ.isNull(), 0.0).when(occ < value, rejected()).otherwise(0.5 + 0.5 * F.least(F.lit(1.0), occ))


def facing(normal: tuple[Column, Column, Column], obj: str = "") -> Column:
    """Degrees between a face's normal and the way from the object to the camera; null if unknown."""
    return G.angle_between(*(F.col(f"p{a}") - G.center(a, obj) for a in G.AXES), *normal)


@register_validator("max_init_back_angle_deg")
def seen_from_front(value: float, normal: tuple[Column, Column, Column], obj: str = "") -> Column:
    return F.when(facing(normal, obj).isNull(), 0.0).otherwise(share_of(facing(normal, obj), value))


@register_validator("label_side_visible_at_init")
def label_side(value: bool, normal: tuple[Column, Column, Column], obj: str = "") -> Column:
    """The labelled side faces the camera, or for False doesn't."""
    c = F.cos(F.radians(facing(normal, obj)))
    return F.when(c.isNull(), 0.0).when((c > 0.5) != F.lit(value), rejected()).otherwise(0.5 + 0.5 * F.abs(c))


@register_validator("only_one_face_visible_at_init")
def one_face(value: bool, normal: tuple[Column, Column, Column], obj: str = "") -> Column:
    """Front or back alone is seen, not the side."""
    c = F.abs(F.cos(F.radians(facing(normal, obj))))
    return F.lit(0.0) if not value else F.when(c.isNull(), 0.0).when(c < 0.30, rejected()).otherwise(c)


@register_validator("min_init_occluded_count")
def occluded_count(value: int, obj: str = "") -> Column:
    """An aggregate over the objects of one label: one is seen at least, and so many aren't well seen."""
    seen, hidden = F.count_if(visible(obj, 1, 0.95)), F.count_if(~visible(obj, 3, 0.40))
    return F.when((seen == 0) | (hidden < value), rejected()).otherwise(F.least(F.lit(1.0), hidden / F.count("*")))


@register_validator("min_zones_invisible_at_init")
def hidden_zones(value: int, zone_seen: Column) -> Column:
    """An aggregate over zones with whether anything of them is seen: one is at least, and so many aren't."""
    hidden = F.count_if(~zone_seen)
    return F.when((F.count_if(zone_seen) == 0) | (hidden < value), rejected()).otherwise(F.least(F.lit(1.0), hidden / F.count("*")))


@register_validator("init_apparent_size_ratio_min")
def apparent_ratio(low: float, high: float, a: str = "a_", b: str = "b_") -> Column:
    """The ratio of image boxes is within both bounds; best in their middle by logarithm."""
    area = {o: F.col(f"{o}box_w") * F.col(f"{o}box_h") for o in (a, b)}
    ratio = area[a] / F.nullif(area[b], F.lit(0.0))
    mid, half = F.ln(F.lit(max(low, 1e-6) * max(high, 1e-6))) / 2, F.greatest(F.ln(F.lit(max(high, 1e-6) / max(low, 1e-6))) / 2, F.lit(1e-6))
    bad = (area[a] <= 1) | (area[b] <= 1) | ~ratio.between(low, high)
    return F.when(F.coalesce(bad, F.lit(True)), rejected()).otherwise(1.0 - 0.5 * F.abs(F.ln(ratio) - mid) / half)


@register_validator("init_apparent_size_ratio_max")
def apparent_ratio_max(*_) -> Column:
    """The other bound's validator looks at both."""
    return F.lit(0.0)


def off_axis(x: Column, y: Column) -> Column:
    """Degrees from forward to an axis in the plane, either way along it; null without one."""
    a = plane_angle(F.col("cam_fx"), F.col("cam_fy"), x, y)
    return F.least(a, 180.0 - a)


def along(x: Column, y: Column, most: float) -> Column:
    return F.when(off_axis(x, y).isNull(), 0.0).otherwise(share_of(off_axis(x, y), most))


@register_validator("min_projection_ambiguity_deg")
def looks_along_group(value: float, axis_x: Column, axis_y: Column) -> Column:
    return along(axis_x, axis_y, value)


@register_validator("max_init_lateral_angle_deg")
def looks_along_pair(value: float, a: str = "a_", b: str = "b_") -> Column:
    return along(G.center("x", b) - G.center("x", a), G.center("y", b) - G.center("y", a), value)


@register_validator("init_ordering_ambiguous")
def same_bearing(value: bool, a: str = "a_", b: str = "b_", most: float = 8.0) -> Column:
    """Both objects lie in about one direction, or for False don't."""
    ways = [G.center(x, o) - F.col(f"p{x}") for o in (a, b) for x in "xy"]
    between = plane_angle(*ways)
    graded = 1.0 - 0.5 * between / most if value else F.least(F.lit(1.0), 0.4 + 0.6 * between / 90.0)
    return F.when(between.isNull(), 0.0).when((between <= most) != F.lit(value), rejected()).otherwise(graded)


@register_validator("path_portals_not_all_visible_at_init")
def door_to_find(value: bool, x: Column, y: Column) -> Column:
    """Better if the first door of the way isn't in view, nor right behind; never rejects."""
    a = level_angle(x, y)
    return F.lit(0.0) if not value else F.when(a.isNull(), 0.3).when(a <= G.hfov_deg(WIDTH, FOCAL) / 2, 0.2).when(a > 150, 0.4).otherwise(1.0)


@register_validator("passage_not_orthogonally_visible_at_init")
def passage_aside(value: bool, x: Column, y: Column) -> Column:
    """Better if the passage isn't straight ahead; never rejects."""
    a = level_angle(x, y)
    return F.lit(0.0) if not value else F.when(a.isNull() | (a <= 15), 0.3).when(a <= 30, 0.4).otherwise(1.0)


def total_score(scores: dict[str, Column]) -> dict[str, Column]:
    """`rejected` if any validator rejects, else `score`, the sum; a field without a validator counts nothing."""
    known = [c for f, c in scores.items() if f in VALIDATORS]
    bad = F.lit(False)
    for c in known:
        bad = bad | c.isNull()
    return {"rejected": bad, "score": F.when(~bad, sum((F.coalesce(c, F.lit(0.0)) for c in known), F.lit(0.0)))}
