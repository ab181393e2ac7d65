"""What stands between a view and an object: rays from the camera to points of the object's box against other boxes.

A ray meets a box where it is in all three of its slabs. Corners share their sides, so that a box has two
slab stretches per axis, and its eight corners are combinations of them: plain columns, no arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators.objects import BUILT
from atrium.operators.views import CORNERS, sides

SLACK = 1e-3
#: A blocker must be nearer than a corner by this share of the way.
NEARER = 0.02
FAR = 1e300
#: Side of the cells in which views' bounds and blockers meet, in metres.
CELL = 2.0


def touches(a: str, b: str, slack: float = SLACK) -> Column:
    return (G.gap("x", a, b) <= slack) & (G.gap("y", a, b) <= slack) & (G.gap("z", a, b) <= slack)


def between(pairs: DataFrame, blockers: DataFrame, cell: float = CELL) -> DataFrame:
    """pairs (view with object) beside the blockers (b_) that can meet a ray from the camera into the box.

    Both are dealt to the cells of their level bounds, the pairs' from the camera to the box, and meet by scene
    and cell; of the cells that two bounds share they meet in the first alone, so once.
    """
    b = blockers.select(F.col("scene_id").alias("b_scene_"), F.col("object_id").alias("b_object_id"), *(F.col(f"{n}_{a}").alias(f"b_{n}_{a}") for a in G.AXES for n in ("min", "max")))
    at = lambda x: F.floor(x / cell).cast("int")
    for a in "xy":
        p = F.col(f"p{a}")
        low, high = at(F.least(p, G.lo(a))), at(F.greatest(p, G.hi(a)))
        pairs = pairs.withColumns({f"first_{a}_": low, f"cell_{a}_": F.explode(F.sequence(low, high))})
        low, high = at(G.lo(a, "b_")), at(G.hi(a, "b_"))
        b = b.withColumns({f"b_first_{a}_": low, f"b_cell_{a}_": F.explode(F.sequence(low, high))})
    same = F.col("scene_id") == F.col("b_scene_")
    for a in "xy":
        same = same & (F.col(f"cell_{a}_") == F.col(f"b_cell_{a}_")) & (F.col(f"cell_{a}_") == F.greatest(f"first_{a}_", f"b_first_{a}_"))
    joined = pairs.join(b.hint(BUILT), same).where(F.col("object_id") != F.col("b_object_id"))
    for a in G.AXES:
        p = F.col(f"p{a}")
        joined = joined.where((G.lo(a, "b_") <= F.greatest(p, G.hi(a))) & (G.hi(a, "b_") >= F.least(p, G.lo(a))))
    return joined.drop("b_scene_", *(f"{n}{a}_" for n in ("first_", "cell_", "b_first_", "b_cell_") for a in "xy"))


def with_rays(rows: DataFrame, inset: bool, center: bool = False) -> tuple[DataFrame, list[tuple[Column, Column, Column]]]:
    """rows, and for each corner (and the centre) how far the ray enters and leaves the blocker, in parts of the way, and the way's length.

    All are columns of their own, made once in a row: what takes them more than once doesn't compute them again.
    """
    made = {}
    for a in G.AXES:
        p = F.col(f"p{a}")
        points = [*sides(a, inset), *([G.center(a)] if center else [])]
        for i, side in enumerate(points):
            d = side - p
            level = F.abs(d) < 1e-12
            inside = p.between(G.lo(a, "b_"), G.hi(a, "b_"))
            t1, t2 = F.try_divide(G.lo(a, "b_") - p, d), F.try_divide(G.hi(a, "b_") - p, d)
            made |= {
                f"near_{a}{i}": F.when(level, F.when(inside, -FAR).otherwise(FAR)).otherwise(F.least(t1, t2)),
                f"leave_{a}{i}": F.when(level, F.when(inside, FAR).otherwise(-FAR)).otherwise(F.greatest(t1, t2)),
                f"way_{a}{i}": d * d,
            }
    c = lambda kind, at: [F.col(f"{kind}_{a}{i}") for a, i in zip(G.AXES, at)]
    met = {}
    for n, at in enumerate([*CORNERS, *([(2, 2, 2)] if center else [])]):
        w = c("way", at)
        met |= {f"enter{n}_": F.greatest(*c("near", at)), f"out{n}_": F.least(*c("leave", at)), f"far{n}_": F.sqrt(w[0] + w[1] + w[2])}
    rays = [tuple(F.col(f"{kind}{n}_") for kind in ("enter", "out", "far")) for n in range(len(met) // 3)]
    return rows.withColumns(made).withColumns(met), rays


def hit_mask(hits: list[Column]) -> Column:
    """Bits of the rays that hit. The partition's number times 0 keeps the mask a column of its own: within an aggregate or a filter it would be computed several times."""
    return sum((F.coalesce(hit, F.lit(False)).cast("int") * (1 << n) for n, hit in enumerate(hits)), F.spark_partition_id() * 0)


def visibility(seen: DataFrame, blockers: DataFrame, keys: tuple[str, ...] = ("scene_id", "view_id", "object_id")) -> DataFrame:
    """seen (rows with in_mask) with n_visible, inset corners in the image that nothing hides, and occluded, the hidden share of those in the image.

    What touches the object hides nothing of it. Without a corner in the image, occluded is 1. Blockers are
    aggregated to one bit mask per view and object, combined before the shuffle.
    """
    rows, rays = with_rays(between(seen.where("in_mask <> 0"), blockers).where(~touches("", "b_")), inset=True)
    hides = [(way >= 1e-6) & (enter <= leave) & (enter >= 0) & (leave * way > 1e-3) & (enter * way <= way - F.greatest(F.lit(1e-3), NEARER * way)) for enter, leave, way in rays]
    hidden = rows.select(*keys, hit_mask(hides).alias("hides_")).where("hides_ <> 0").groupBy(*keys).agg(F.bit_or("hides_").alias("hidden_"))
    out = seen.join(hidden.hint(BUILT), list(keys), "left").withColumn("hidden_", F.coalesce("hidden_", F.lit(0)).bitwiseAND(F.col("in_mask")))
    inside, blocked = F.bit_count("in_mask"), F.bit_count("hidden_")
    return out.withColumns({"n_visible": inside - blocked, "occluded": F.when(inside == 0, F.lit(1.0)).otherwise(blocked / inside)}).drop("hidden_")


def primary_occluder(seen: DataFrame, blockers: DataFrame, keys: tuple[str, ...] = ("scene_id", "view_id", "object_id")) -> DataFrame:
    """(keys, blocker_id, n): the blocker that is met first on the way to most corners, ties to the smaller id; no row if there is none."""
    rows, rays = with_rays(between(seen, blockers), inset=False)
    meets = [(way >= 1e-6) & (enter <= leave) & (leave >= 0) & (enter * way > 1e-3) & (enter * way < way - 1e-3) for enter, leave, way in rays]
    # Blockers that meet no corner go before the rest is grouped, which sorts: pairs of a way and an id are compared.
    ways = [F.when(F.col("meets_").bitwiseAND(1 << n) != 0, enter * way).alias(f"t{n}_") for n, (enter, _, way) in enumerate(rays)]
    met = rows.withColumn("meets_", hit_mask(meets)).where("meets_ <> 0").select(*keys, "b_object_id", *ways)
    firsts = [F.min(F.when(F.col(f"t{n}_").isNotNull(), F.struct(F.col(f"t{n}_").alias("t"), F.col("b_object_id").alias("id")))).getField("id").alias(f"first{n}") for n in range(8)]
    first = met.groupBy(*keys).agg(*firsts).select(*keys, F.explode(F.array(*(f"first{n}" for n in range(8)))).alias("blocker_id")).where("blocker_id IS NOT NULL")
    counts = first.groupBy(*keys, "blocker_id").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", (-F.col("blocker_id")).alias("id")))
    return counts.groupBy(*keys).agg(best.alias("m")).select(*keys, (-F.col("m.id")).alias("blocker_id"), F.col("m.n").alias("n"))


def box_occluded(seen: DataFrame, blockers: DataFrame, keys: tuple[str, ...] = ("scene_id", "view_id", "object_id")) -> DataFrame:
    """(keys) of the views and objects of which any corner or the centre is hidden by anything."""
    rows, rays = with_rays(between(seen, blockers), inset=False, center=True)
    hits = [(way >= 1e-6) & (enter <= leave) & (leave >= 0) & (enter >= 0) & (enter * way <= way - 1e-3) for enter, leave, way in rays]
    return rows.select(*keys, hit_mask(hits).alias("hits_")).where("hits_ <> 0").groupBy(*keys).agg(F.lit(True).alias("blocked_")).select(*keys)


def newly_visible(before: DataFrame, after: DataFrame, keys: tuple[str, ...] = ("scene_id", "pair_id")) -> DataFrame:
    """Of each pair of views the object hidden before and visible after that is least occluded, ties to the smaller id."""
    new = after.join(before.select(*keys, "object_id"), [*keys, "object_id"], "left_anti")
    return new.groupBy(*keys).agg(F.min(F.struct("occluded", "object_id")).alias("m")).select(*keys, F.col("m.object_id").alias("object_id"), F.col("m.occluded").alias("occluded"))
