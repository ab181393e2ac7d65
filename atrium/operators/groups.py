"""Groups of two to five objects of a room that are alike in size and stand near each other.

Groups are grown by ids: a group of k is extended by an object of a higher id that is near all of its members, so
that each is made once, from edges that only objects in neighbouring cells have. Objects need scene_id, room_id,
object_id and a box; those without a room or a box are in no group. Nothing near gives no rows; ties don't arise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators import objects as O

ROOM = ("scene_id", "room_id")
#: Bounds of a group: fixed values. The nearest two members are apart by NEAREST at least, and by a share LOW of the
#: members' mean longest side; pairs by FARTHEST at most, and HIGH of it.
NEAREST, FARTHEST, LOW, HIGH = 0.1, 3.0, 0.2, 1.5
SIZE_RATIO, SPREAD = 2.5, 2.0


def size_ratio() -> Column:
    return F.col("longest") / (F.col("smallest") + 1e-12)


def near_edges(roomed: DataFrame, reach: float) -> DataFrame:
    """(room, a_id, b_id, d, a_long, b_long): objects a < b of a room whose boxes are at most `reach` apart.

    Boxes, the first of each pair widened by the reach, meet by cells of that side; of shared cells in the first alone.
    """
    cell = max(reach, 0.5)
    boxes = roomed.where("room_id IS NOT NULL AND min_x IS NOT NULL").select(*ROOM, "object_id", G.longest().alias("long"), *(f"{n}_{a}" for a in G.AXES for n in ("min", "max")))
    at = lambda x: F.floor(x / cell).cast("int")

    def dealt(p: str, by: float) -> DataFrame:
        out = O.prefixed(boxes, p, ROOM)
        for x in "xy":
            low, high = at(G.lo(x, p) - by), at(G.hi(x, p) + by)
            out = out.withColumns({f"{p}first_{x}": low, x: F.explode(F.sequence(low, high))})
        return out

    pairs = dealt("a_", reach).join(dealt("b_", 0.0), [*ROOM, "x", "y"]).where("a_object_id < b_object_id AND x = greatest(a_first_x, b_first_x) AND y = greatest(a_first_y, b_first_y)")
    return pairs.select(*ROOM, F.col("a_object_id").alias("a_id"), F.col("b_object_id").alias("b_id"), F.round(G.box_distance("a_", "b_"), 9).alias("d"), "a_long", "b_long").where(F.col("d") <= reach)


def grown(groups: DataFrame, edges: DataFrame, size: int) -> DataFrame:
    """Groups of `size` from those of one less: an edge from each member to the new object, by as many equi-joins."""
    out = groups
    for k in range(size - 1):
        last = k == 0
        step = edges.select(*ROOM, F.col("a_id").alias("from_"), F.col("b_id").alias("new_id"), F.col("d").alias("d_"), *([F.col("b_long").alias("long_")] if last else []))
        out = out.withColumn("from_", F.element_at("members", size - 1 - k))
        # From the highest member on: it has the fewest objects of a higher id.
        out = out.join(step, [*ROOM, "from_"] if last else [*ROOM, "from_", "new_id"]).withColumns({"nearest": F.least("nearest", "d_"), "widest": F.greatest("widest", "d_")}).drop("d_")
    return out.select(*ROOM, F.concat("members", F.array("new_id")).alias("members"), "nearest", "widest", F.greatest("longest", "long_").alias("longest"), F.least("smallest", "long_").alias("smallest"), (F.col("total") + F.col("long_")).alias("total"))


def object_groups(roomed: DataFrame, k: int, ratio: float = SIZE_RATIO, spread: float = SPREAD) -> DataFrame:
    """(room, members, nearest, widest, reason) of all sets of k objects (2 to 5) of a room that are near each other.

    `reason` says why a set is no group: its longest sides differ too much (size_ratio, or for pairs dim_diff), it is
    too_close, or for pairs out_of_dyn_range; null for a group. Sets with a pair farther apart than `spread` (for
    pairs: FARTHEST) aren't made. A set whose sizes differ too much has no group above it, so from three on only the
    last level reports it.
    """
    if not 2 <= k <= 5:
        raise ValueError("groups have two to five members")
    edges = near_edges(roomed, FARTHEST if k == 2 else spread)
    sets = edges.select(*ROOM, F.array("a_id", "b_id").alias("members"), F.col("d").alias("nearest"), F.col("d").alias("widest"), F.greatest("a_long", "b_long").alias("longest"), F.least("a_long", "b_long").alias("smallest"), (F.col("a_long") + F.col("b_long")).alias("total"))
    for size in range(3, k + 1):
        sets = grown(sets.where(size_ratio() <= ratio), edges, size)
    mean = F.col("total") / k
    least, most = F.greatest(F.lit(NEAREST), LOW * mean), F.least(F.lit(FARTHEST), HIGH * mean)
    reason = F.when(size_ratio() > ratio, "size_ratio")
    if k == 2:
        reason = reason.when(F.col("longest") - F.col("smallest") > spread, "dim_diff")
    reason = reason.when(F.col("nearest") < least, "too_close")
    if k == 2:
        reason = reason.when(F.col("widest") > most, "out_of_dyn_range")
    return sets.select(*ROOM, "members", "nearest", "widest", reason.alias("reason"))
