"""Operators over tasks, trajectories, slots and model results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atrium.operators.storage import written


def slot_fraction(rows: DataFrame, slots: DataFrame | None = None) -> DataFrame:
    """Share of a slot's predicates that hold at a step; an unknown one counts as failed.

    slots (task_id, step, slot_id), if given, are all there are: those without predicates have the share 1.
    """
    found = rows.groupBy("task_id", "step", "slot_id").agg(F.avg(F.coalesce("ok", F.lit(False)).cast("int")).alias("fraction"))
    if slots is None:
        return found
    return slots.select("task_id", "step", "slot_id").join(found, ["task_id", "step", "slot_id"], "left").select("task_id", "step", "slot_id", F.coalesce("fraction", F.lit(1.0)).alias("fraction"), F.col("fraction").isNull().alias("empty"))


def slot_ok(fractions: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Whether a slot is satisfied, and almost so: half the threshold, which a slot without predicates (empty) never is."""
    almost = F.col("fraction") >= threshold * 0.5
    return fractions.withColumns({"ok": F.col("fraction") >= threshold, "almost": almost & ~F.col("empty") if "empty" in fractions.columns else almost})


def slot_over_trajectory(slots: DataFrame) -> DataFrame:
    """Whether a slot holds at any step, and at the last step it was seen."""
    return slots.groupBy("task_id", "slot_id").agg(F.bool_or("ok").alias("any_frame"), F.max_by("ok", "step").alias("last_frame"))


def coverage(flags: DataFrame, flag: str, tasks: DataFrame | None = None) -> DataFrame:
    """Both coverage modes of each task: all slots, or the mean of them; of `tasks`, if given, those without slots have 1."""
    found = flags.groupBy("task_id").agg(F.min(F.col(flag).cast("double")).alias("coverage_all"), F.avg(F.col(flag).cast("double")).alias("coverage_mean"))
    if tasks is None:
        return found
    return tasks.select("task_id").join(found, "task_id", "left").na.fill(1.0, ["coverage_all", "coverage_mean"])


def potential_and_belief(fractions: DataFrame) -> DataFrame:
    return fractions.groupBy("task_id", "step").agg(F.avg("fraction").alias("potential"), F.min("fraction").alias("belief"))


def by_step() -> Window:
    return Window.partitionBy("task_id").orderBy("step")


def information_gain(steps: DataFrame) -> DataFrame:
    """Difference of belief to the next step; null on the last."""
    return steps.withColumn("gain", F.lead("belief").over(by_step()) - F.col("belief"))


def step_rewards(steps: DataFrame, terminal: Column) -> DataFrame:
    """Potential differences, the terminal score added on the last transition; a single frame has the score alone."""
    w = by_step()
    following, after = F.lead("potential").over(w), F.lead("potential", 2).over(w)
    first = F.row_number().over(w) == 1
    reward = F.when(following.isNotNull(), following - F.col("potential") + F.when(after.isNull(), terminal).otherwise(F.lit(0.0))).when(first, terminal)
    return steps.withColumn("reward", reward).where("reward IS NOT NULL")


def path_length(steps: DataFrame) -> DataFrame:
    """Length of each task's way through its positions (pz counts if there is one), its steps, and where it begins and ends."""
    w = by_step()
    axes = [a for a in ("px", "py", "pz") if a in steps.columns]
    d = [F.col(a) - F.lag(a).over(w) for a in axes]
    moved = steps.withColumn("d", F.coalesce(F.sqrt(sum((x * x for x in d), F.lit(0.0))), F.lit(0.0)))
    return moved.groupBy("task_id").agg(F.sum("d").alias("path_length"), (F.count("*") - 1).alias("steps_to_success"), F.max_by("px", "step").alias("last_x"), F.max_by("py", "step").alias("last_y"), F.min_by("px", "step").alias("first_x"), F.min_by("py", "step").alias("first_y"))


def steps_to_success(frames: Column, success: Column) -> Column:
    """Frames less the first; null without success."""
    return F.when(success, frames - 1)


def spl(shortest: Column, path: Column, success: Column) -> Column:
    """Shortest over walked length on success, 1 where both are nothing, 0 on failure."""
    most = F.greatest(path, shortest)
    return F.when(~success, F.lit(0.0)).when(most == 0, F.lit(1.0)).otherwise(shortest / most)


def episode_score(answer: Column, truth: Column, cov: Column, least: Column, gamma: float, steps: Column) -> Column:
    right = F.lower(F.trim(answer)) == F.lower(F.trim(truth))
    return F.when(right, F.least(F.lit(1.0), cov / least) * F.pow(F.lit(gamma), steps)).otherwise(F.lit(0.0))


def accuracy(compared: DataFrame) -> DataFrame:
    """Overall (null type) and per question type: n, exact and close shares; one pass with grouping sets."""
    return compared.rollup("question_type").agg(F.count("*").alias("n"), F.avg(F.col("exact").cast("int")).alias("exact"), F.avg(F.col("close").cast("int")).alias("close"))


def action_mix(steps: DataFrame, action: Column) -> DataFrame:
    """Counts of each action class per task, one column a class."""
    return steps.withColumn("class_", action).groupBy("task_id").pivot("class_", ["forward", "turn", "strafe", "other"]).count().na.fill(0)


def balanced(items: DataFrame, answer: str, quota: int, order: list[str]) -> DataFrame:
    """At most `quota` items of each answer, the first by `order`: over all items, not first come."""
    ranked = items.withColumn("rank_", F.row_number().over(Window.partitionBy(answer).orderBy(*order)))
    return ranked.where(F.col("rank_") <= quota).drop("rank_")


def capped(items: DataFrame, per: list[tuple[str, int]], order: list[str]) -> DataFrame:
    """Caps per key, one after the other."""
    for key, most in per:
        items = items.withColumn("rank_", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank_") <= most).drop("rank_")
    return items


def dedup_items(items: DataFrame, signature: Column, order: list[str]) -> DataFrame:
    """One item for each signature, the first by `order`."""
    first = F.row_number().over(Window.partitionBy("signature_").orderBy(*order))
    return items.withColumn("signature_", signature).withColumn("rank_", first).where("rank_ = 1").drop("rank_", "signature_")


def room_edges(portals: DataFrame) -> DataFrame:
    """Both directions of every door between two rooms."""
    doors = portals.where("type = 'DOOR' AND room_a <> room_b")
    forth, back = doors.select("scene_id", F.col("room_a").alias("src"), F.col("room_b").alias("dst")), doors.select("scene_id", F.col("room_b").alias("src"), F.col("room_a").alias("dst"))
    return forth.union(back).distinct()


def starts(rooms: DataFrame) -> DataFrame:
    """(scene_id, start, blocked): every room of a scene with every other one blocked."""
    a, b = rooms.select("scene_id", F.col("room_id").alias("start")), rooms.select("scene_id", F.col("room_id").alias("blocked"))
    return a.join(b, "scene_id").where("start <> blocked")


def reachable(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(scene_id, start, blocked, room, hops): rooms reached from start by doors while blocked is closed; null blocks none.

    All starts at once: each round joins the new rooms with the edges and takes away what is known, until
    nothing is new. Every round is written, so that its lineage stays short.
    """
    found = starts.select("scene_id", "start", "blocked", F.col("start").alias("room"), F.lit(0).alias("hops")).distinct()
    found = frontier = written(found)
    hops = 0
    while not frontier.isEmpty():
        hops += 1
        ahead = frontier.join(edges.withColumnRenamed("src", "room"), ["scene_id", "room"]).where(~F.col("dst").eqNullSafe(F.col("blocked"))).select("scene_id", "start", "blocked", F.col("dst").alias("room")).distinct()
        known = found.select("scene_id", F.col("start").alias("s_"), F.col("blocked").alias("b_"), F.col("room").alias("r_")).withColumnRenamed("scene_id", "c_")
        new = ahead.join(known, (F.col("scene_id") == F.col("c_")) & (F.col("start") == F.col("s_")) & F.col("blocked").eqNullSafe(F.col("b_")) & (F.col("room") == F.col("r_")), "left_anti")
        frontier = written(new.withColumn("hops", F.lit(hops)))
        found = found.unionByName(frontier)
    return found


def replay(steps: DataFrame, move: float = 0.25, turn: float = 30.0, look: float = 15.0, most: float = 75.0) -> DataFrame:
    """Pose after each action from (0, 0) facing east: running sums of turns, then of moves in the heading they give.

    Actions from a task's first `stop` on change nothing. Looks change the pitch, which stays within `most`
    degrees either way and is level again after look_forward: a running sum that is clamped at each step, kept
    in an array of the task's actions, which the task's step limit bounds.
    """
    w = by_step().rowsBetween(Window.unboundedPreceding, 0)
    live = steps.withColumn("live_", F.coalesce(F.max(F.when(F.col("action") == "stop", 1)).over(w), F.lit(0)) == 0)
    turned = F.when(~F.col("live_"), 0.0).when(F.col("action") == "turn_left", turn).when(F.col("action") == "turn_right", -turn).otherwise(F.lit(0.0))
    heading = live.withColumn("yaw", F.sum(turned).over(w))
    side = F.when(F.col("action") == "move_left", 90.0).when(F.col("action") == "move_right", -90.0).when(F.col("action") == "move_backward", 180.0).otherwise(F.lit(0.0))
    moved = F.when(F.col("action").startswith("move_") & F.col("live_"), move).otherwise(F.lit(0.0))
    angle = F.radians(F.col("yaw") + side)
    looks = F.collect_list(F.when(~F.col("live_"), "stop").otherwise(F.col("action"))).over(w)
    step = lambda p, a: F.when(a == "look_up", F.least(p + look, F.lit(most))).when(a == "look_down", F.greatest(p - look, F.lit(-most))).when(a == "look_forward", F.lit(0.0)).otherwise(p)
    return heading.withColumns({"x": F.sum(moved * F.cos(angle)).over(w), "y": F.sum(moved * F.sin(angle)).over(w), "pitch": F.aggregate(looks, F.lit(0.0), step)}).drop("live_")


def metric_summary(tasks: DataFrame, key: str) -> DataFrame:
    """Overall (null key) and per key: tasks, success rate, mean SPL, steps and path length."""
    return tasks.rollup(key).agg(F.count("*").alias("n"), F.avg(F.col("success").cast("int")).alias("success_rate"), F.avg("spl").alias("mean_spl"), F.avg("steps_to_success").alias("mean_steps"), F.avg("path_length").alias("mean_length"))


def best_trajectory(candidates: DataFrame, key: str) -> DataFrame:
    """Of each key's candidates the one with most coverage, then fewest steps, then most potential, then the first id."""
    order = [F.desc("coverage"), F.asc("steps"), F.desc("potential"), F.asc("task_id")]
    return candidates.withColumn("rank_", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("rank_ = 1").drop("rank_")


def turn_actions(angle: Column, step: float = 30.0) -> Column:
    """Turns that cover an angle: the nearest number of steps, halves up."""
    n = F.ceil(F.abs(angle) / step - 0.5).cast("int")
    return F.array_repeat(F.when(angle >= 0, "turn_left").otherwise("turn_right"), F.greatest(n, F.lit(0)))


def bind_slots(instances: DataFrame, slots: DataFrame) -> DataFrame:
    """Slots of each instance with their numbers filled in: a pattern with {i} becomes n slots.

    slots (template_id, slot, repeat) is a small dimension table; instances have template_id, task_id, n.
    """
    joined = instances.join(slots, "template_id")  # Spark broadcasts slots if its size allows
    last = F.when(F.col("repeat"), F.col("n") - 1).otherwise(F.lit(0)).cast("int")
    numbered = joined.where(last >= 0).withColumn("i", F.explode(F.sequence(F.lit(0), last)))
    return numbered.select("task_id", "template_id", F.replace("slot", F.lit("{i}"), F.col("i").cast("string")).alias("slot"))


def move_actions(distance: Column, step: float = 0.5) -> Column:
    """Moves that cover a distance: the nearest number of steps, halves up; backwards for a negative one."""
    n = F.ceil(F.abs(distance) / step - 0.5).cast("int")
    return F.array_repeat(F.when(distance >= 0, "move_forward").otherwise("move_backward"), F.greatest(n, F.lit(0)))


def chosen_trajectory(*candidates: Column) -> Column:
    """The first trajectory that has a view: of a model, the task, an agent, an expert, or init and target."""
    return F.coalesce(*(F.when(F.size(c) > 0, c) for c in candidates))


def regret(values: DataFrame, necessary: float = 1e-6) -> DataFrame:
    """Per task how far its chosen actions fall behind: values (task_id, step, action, value, chosen) has each valid action's gain of belief.

    Per step: regret (best less chosen), what a random action gains (their mean), and the best action (ties to
    the first by name). Per task: mean and cumulative regret, mean necessity, and the share of redundant steps.
    """
    best = F.min_by("action", F.struct(-F.col("value"), F.col("action")))
    steps = values.groupBy("task_id", "step").agg(F.max("value").alias("oracle"), F.avg("value").alias("random"), F.max(F.when(F.col("chosen"), F.col("value"))).alias("chosen_value"), best.alias("oracle_action")).withColumnRenamed("chosen_value", "value")
    gap = F.col("oracle") - F.col("value")
    return steps.groupBy("task_id").agg(F.count("*").alias("n_steps"), F.avg(gap).alias("mean_regret"), F.sum(gap).alias("cumulative_regret"), F.avg("value").alias("mean_necessity"), F.avg((F.col("value") <= necessary).cast("int")).alias("redundant_ratio"))


def audit(tasks: DataFrame, odd_share: float = 0.5, least_steps: int = 4) -> DataFrame:
    """Tasks with `warnings`: coverage below the minimum of their mode, an end that is no answer alone, unstable, much odd motion."""
    moves = F.filter("action_sequence", lambda a: a != "stop")
    odd = F.filter(moves, lambda a: a.isin("move_left", "move_right", "move_backward"))
    submit, whole, least = (F.col(c) for c in ("submit_view_coverage", "trajectory_evidence_coverage", "min_coverage_for_credit"))
    flags = {
        "submit_below_minimum": (F.col("coverage_mode") == "submit") & (submit + 1e-9 < least),
        "evidence_below_minimum": (F.col("coverage_mode") == "trajectory") & (whole + 1e-9 < least),
        "last_frame_not_enough": (F.col("coverage_mode") == "trajectory") & (submit + 1e-9 < least),
        "unstable": ~F.coalesce("stable_full_coverage", F.lit(True)),
        "odd_motion": (F.size(moves) >= least_steps) & (F.size(odd) >= odd_share * F.size(moves)),
    }
    return tasks.withColumn("warnings", F.filter(F.array(*(F.when(flag, F.lit(n)) for n, flag in flags.items())), lambda w: w.isNotNull()))


def failure_report(failures: DataFrame, key: str) -> DataFrame:
    """Failures of each key, and its most frequent reason, ties to the first by name."""
    counts = failures.groupBy(key, "reason").agg(F.count("*").alias("n"))
    ranked = counts.withColumns({"k": F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "reason")), "total": F.sum("n").over(Window.partitionBy(key))})
    return ranked.where("k = 1").select(key, "total", F.col("reason").alias("top_reason"), F.col("n").alias("top_n"))


def status_counts(runs: DataFrame, key: str) -> DataFrame:
    """Runs of each status (ok, empty, timeout, error) per key, and over all with a null key."""
    return runs.rollup(key).agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("ok", "empty", "timeout", "error")))


def distance_balance(steps: DataFrame, most: float = 0.5, least: float = 0.2) -> DataFrame:
    """Per task: at the last step both objects are seen from about the same distance: steps (task_id, step, da, db, both_visible)."""
    last = steps.groupBy("task_id").agg(F.max_by(F.struct("da", "db", "both_visible"), "step").alias("m")).select("task_id", "m.*")
    ok = (F.least("da", "db") >= least) & (F.abs(F.ln(F.col("da") / F.greatest("db", F.lit(1e-9)))) <= most) & F.col("both_visible")
    return last.select("task_id", F.coalesce(ok, F.lit(False)).alias("ok"))


def cross_room_existence(steps: DataFrame, bins: int = 9) -> DataFrame:
    """Per task: it ends in the room and has seen the target there (answer yes), or has looked round in it (no).

    steps: (task_id, step, in_room, sees_target, yaw in degrees, gt_answer); 30-degree bins of yaw count.
    """
    seen = F.bool_or(F.col("in_room") & F.col("sees_target"))
    looked = F.count_distinct(F.when(F.col("in_room"), F.floor(F.pmod("yaw", F.lit(360.0)) / 30)))
    rows = steps.groupBy("task_id", "gt_answer").agg(F.max_by("in_room", "step").alias("ends"), seen.alias("seen"), looked.alias("looked"))
    return rows.select("task_id", (F.col("ends") & F.when(F.col("gt_answer") == "yes", F.col("seen")).otherwise(F.col("looked") >= bins)).alias("ok"))


def zone_count(steps: DataFrame, targets: DataFrame) -> DataFrame:
    """Per task: every target was seen at some step in its room: steps (task_id, target_id, in_room, visible), targets (task_id, target_id)."""
    seen = steps.where("in_room AND visible").select("task_id", "target_id").distinct().withColumn("seen", F.lit(True))
    return targets.select("task_id", "target_id").distinct().join(seen, ["task_id", "target_id"], "left").groupBy("task_id").agg(F.bool_and(F.coalesce("seen", F.lit(False))).alias("ok"))
