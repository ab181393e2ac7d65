"""Answer choices as array Columns: the right one first, then distractors. By name in CHOICES."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHOICES: dict[str, Callable[..., Column]] = {}
NONE = "None of the above"


def register_choice(*names: str):
    def add(build):
        CHOICES.update(dict.fromkeys(names, build))
        return build

    return add


def build_choices(name: str, *args: Column) -> Column:
    """The choices by a generator's name; an unknown name or a null answer gives an empty array."""
    empty = F.array().cast("array<string>")
    return F.coalesce(CHOICES[name](*args), empty) if name in CHOICES else empty


def one_of_two(right: Column, first: str, second: str) -> Column:
    """The answer (`first` if it is null), and the other of two."""
    answer = F.coalesce(right, F.lit(first))
    return F.array(answer, F.when(answer == first, F.lit(second)).otherwise(F.lit(first)))


@register_choice("binary_yes_no")
def yes_no(right: Column) -> Column:
    return one_of_two(F.lower(right), "yes", "no")


@register_choice("binary_same_different")
def same_different(right: Column) -> Column:
    return one_of_two(right, "same", "different")


@register_choice("binary_complete_incomplete")
def complete_incomplete(right: Column) -> Column:
    return one_of_two(right, "complete", "incomplete")


@register_choice("binary_continuous_separate")
def continuous_separate(right: Column) -> Column:
    return one_of_two(right, "continuous", "separate")


@register_choice("pair_labels", "pair_from_triple")
def pair_labels(right: Column, a: Column, b: Column) -> Column:
    """The answer and the other label of a pair; none if anything is missing."""
    whole = (right != "") & (a != "") & (b != "")
    return F.when(whole, F.array(right, F.when(right == a, b).otherwise(a)))


@register_choice("similar_aabb_labels")
def label_and_others(right: Column, given: Column, others: Column) -> Column:
    """The answer and up to three given choices, else the first three other labels."""
    kept = F.array_distinct(F.filter(F.coalesce(given, F.array().cast("array<string>")), lambda c: F.lower(c) != F.lower(right)))
    rest = F.slice(F.array_distinct(F.filter(others, lambda c: F.lower(c) != F.lower(right))), 1, 3)
    return F.when(F.size(kept) > 0, F.concat(F.array(right), F.slice(kept, 1, 3))).otherwise(F.concat(F.array(right), rest))


def pool(*names: str) -> Callable[[Column], Column]:
    """A generator of the answer and the rest of a fixed pool; the first name stands for a null answer but for the second of relations."""

    def build(right: Column, default: str = names[0]) -> Column:
        answer = F.coalesce(right, F.lit(default))
        return F.concat(F.array(answer), F.filter(F.array(*map(F.lit, names)), lambda p: p != answer))

    return build


directions = register_choice("directional_choices")(pool("left", "right", "ahead", "behind"))
arrangement = register_choice("count_and_arrangement")(pool("single", "multiple"))
contacts = register_choice("contact_relations")(pool("touching", "resting_on", "beside", "above"))
shapes = register_choice("config_shapes")(pool("row", "cluster", "ring", "L-shape"))


@register_choice("count_range", "count_range_or_zone_comparison")
def counts(right: Column) -> Column:
    """A count and its neighbours c - 1 (not below 0), c + 1 and c + 2, ascending; what is no number stands alone."""
    text = F.coalesce(right, F.lit("1"))
    c = text.try_cast("int")
    near = F.filter(F.array_sort(F.array_distinct(F.array(F.greatest(c - 1, F.lit(0)), c + 1, c + 2))), lambda x: x != c)
    return F.when(c.isNull(), F.array(text)).otherwise(F.concat(F.array(c), near).cast("array<string>"))


@register_choice("property_choices", "label_face_choices", "back_face_property_choices")
def properties(right: Column, distractors: Column) -> Column:
    return F.when(right != "", F.concat(F.array(right), F.filter(F.coalesce(distractors, F.array().cast("array<string>")), lambda d: d != right)))


def number_text(x: Column) -> Column:
    """A number as the shortest text of at most two decimals."""
    return F.regexp_replace(F.call_function("format_number", F.round(x, 2), F.lit("0.##")), "^-0$", "0")


@register_choice("meters")
def meters(value: Column, steps: tuple[float, ...] = (0.0, 0.25, -0.25, 0.5, -0.5, 0.75, -0.75, 1.0), most: int = 4) -> Column:
    """Metres: the value and others at fixed steps from it, not below 0 for a value from 0 on."""
    m = F.round(value, 2)
    at = F.transform(F.array(*map(F.lit, steps)), lambda d: F.round(m + d, 2))
    kept = F.array_distinct(F.transform(at, lambda v: F.when(value >= 0, F.greatest(v, F.lit(0.0))).otherwise(v)))
    return F.transform(F.slice(kept, 1, most), lambda v: F.concat(number_text(v), F.lit("m")))


@register_choice("degrees")
def degrees(value: Column, steps: tuple[float, ...] = (0.0, 20.0, -20.0, 40.0, -40.0, 60.0, -60.0), limit: float = 100.0, most: int = 4) -> Column:
    """Whole degrees: the value and others at fixed steps from it, none beyond the limit either way."""
    d = F.round(value)
    kept = F.filter(F.array_distinct(F.transform(F.array(*map(F.lit, steps)), lambda s: d + s)), lambda x: F.abs(x) <= limit)
    return F.transform(F.slice(kept, 1, most), lambda v: F.concat(v.cast("int").cast("string"), F.lit(" degrees")))


OPPOSITE = {"up": "down", "down": "up", "front": "back", "back": "front", "left": "right", "right": "left"}


@register_choice("direction_distractors")
def direction_distractors(right: Column, most: int = 3) -> Column:
    """A direction of parts joined by hyphens, and others: one part turned round each, its parts alone, then plain directions."""
    table = F.create_map(*(F.lit(x) for kv in OPPOSITE.items() for x in kv))
    parts = F.split(right, "-")
    flipped = F.transform(parts, lambda p, i: F.array_join(F.transform(parts, lambda q, j: F.when(i == j, F.coalesce(F.element_at(table, q), q)).otherwise(q)), "-"))
    alone = F.when(F.size(parts) > 1, parts).otherwise(F.array().cast("array<string>"))
    every = F.array_distinct(F.concat(flipped, alone, F.array(*map(F.lit, ("front", "left", "up", "back", "right", "down")))))
    return F.concat(F.array(right), F.slice(F.filter(every, lambda x: x != right), 1, most))


@register_choice("neighbouring_counts")
def neighbouring_counts(right: Column, most: int = 5) -> Column:
    """A count from 0 to 5 and the three nearest other ones, the smaller of equally near first."""
    near = F.array_sort(F.transform(F.filter(F.sequence(F.lit(0), F.lit(most)), lambda x: x != right), lambda x: F.struct(F.abs(x - right).alias("d"), x.alias("x"))))
    return F.concat(F.array(right.cast("int")), F.slice(F.transform(near, lambda s: s["x"]), 1, 3)).cast("array<string>")


@register_choice("padded_text")
def padded(right: Column, distractors: Column, size: int = 4) -> Column:
    """Four options: the answer, distractors, and as many "None of the above" as are missing."""
    some = F.slice(F.concat(F.array(right), F.filter(distractors, lambda d: d != right)), 1, size)
    return F.concat(some, F.array_repeat(F.lit(NONE), size - F.size(some)))
