"""Queries over slots, trajectories, results and the room graph."""

from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.functions import text as X
from atrium.operators import tasks as T
from atrium.plans.q_objects import r6
from atrium.plans.registry import query
from atrium.plans.scenes import scene

FRACTIONS = "f AS (SELECT task_id, step, slot_id, AVG(CASE WHEN ok THEN 1.0 ELSE 0.0 END) AS fraction FROM {pred_rows} GROUP BY 1, 2, 3)"
STEPS = f"{FRACTIONS}, s AS (SELECT task_id, step, AVG(fraction) AS potential, MIN(fraction) AS belief FROM f GROUP BY 1, 2)"


def fractions(spark, sf_dir):
    return T.slot_fraction(scene(spark, sf_dir, "pred_rows")[0])


@query(f"WITH {FRACTIONS} SELECT task_id, step, slot_id, ROUND(fraction, 6) AS fraction FROM f")
def slot_fraction(spark, sf_dir):
    return fractions(spark, sf_dir).withColumn("fraction", F.round("fraction", 6))


@query(f"WITH {FRACTIONS} SELECT slot_id, fraction >= 1.0 AS ok, fraction >= 0.5 AS almost, COUNT(*) AS n FROM f GROUP BY 1, 2, 3")
def slot_satisfied(spark, sf_dir):
    return T.slot_ok(fractions(spark, sf_dir)).groupBy("slot_id", "ok", "almost").agg(F.count("*").alias("n"))


@query(f"WITH {FRACTIONS} SELECT task_id, slot_id, BOOL_OR(fraction >= 1.0) AS any_frame, ARG_MAX(fraction >= 1.0, step) AS last_frame FROM f GROUP BY 1, 2")
def slot_over_trajectory(spark, sf_dir):
    return T.slot_over_trajectory(T.slot_ok(fractions(spark, sf_dir)))


@query(f"WITH {FRACTIONS}, o AS (SELECT task_id, slot_id, BOOL_OR(fraction >= 1.0)::INT AS x FROM f GROUP BY 1, 2) SELECT task_id, MIN(x)::DOUBLE AS coverage_all, ROUND(AVG(x), 6) AS coverage_mean FROM o GROUP BY 1")
def coverage(spark, sf_dir):
    return T.coverage(T.slot_over_trajectory(T.slot_ok(fractions(spark, sf_dir))), "any_frame").withColumn("coverage_mean", F.round("coverage_mean", 6))


@query(f"WITH {STEPS} SELECT task_id, step, ROUND(potential, 6) AS potential, ROUND(belief, 6) AS belief FROM s")
def potential_and_belief(spark, sf_dir):
    return T.potential_and_belief(fractions(spark, sf_dir)).select("task_id", "step", r6(F.col("potential"), "potential"), r6(F.col("belief"), "belief"))


@query(f"WITH {STEPS} SELECT task_id, step, ROUND(LEAD(belief) OVER (PARTITION BY task_id ORDER BY step) - belief, 6) AS gain FROM s")
def information_gain(spark, sf_dir):
    return T.information_gain(T.potential_and_belief(fractions(spark, sf_dir))).select("task_id", "step", r6(F.col("gain"), "gain"))


@query(f"""WITH {STEPS}, w AS (SELECT *, LEAD(potential) OVER w AS p1, LEAD(potential, 2) OVER w AS p2, ROW_NUMBER() OVER w AS k FROM s WINDOW w AS (PARTITION BY task_id ORDER BY step))
SELECT task_id, step, ROUND(CASE WHEN p1 IS NOT NULL THEN p1 - potential + CASE WHEN p2 IS NULL THEN 0.8 ELSE 0.0 END ELSE 0.8 END, 6) AS reward FROM w WHERE p1 IS NOT NULL OR k = 1""")
def step_rewards(spark, sf_dir):
    return T.step_rewards(T.potential_and_belief(fractions(spark, sf_dir)), F.lit(0.8)).select("task_id", "step", r6(F.col("reward"), "reward"))


PATHS = """m AS (SELECT *, LAG(px) OVER w AS qx, LAG(py) OVER w AS qy FROM {traj_steps} WINDOW w AS (PARTITION BY task_id ORDER BY step)),
paths AS (SELECT task_id, SUM(COALESCE(SQRT((px - qx) * (px - qx) + (py - qy) * (py - qy)), 0.0)) AS path_length, COUNT(*) - 1 AS steps_to_success,
  ARG_MAX(px, step) AS bx, ARG_MAX(py, step) AS by_, ARG_MIN(px, step) AS ax, ARG_MIN(py, step) AS ay FROM m GROUP BY task_id)"""


def paths(spark, sf_dir):
    return T.path_length(scene(spark, sf_dir, "traj_steps")[0])


@query(f"WITH {PATHS} SELECT task_id, ROUND(path_length, 6) AS path_length, steps_to_success FROM paths")
def path_length(spark, sf_dir):
    return paths(spark, sf_dir).select("task_id", r6(F.col("path_length"), "path_length"), "steps_to_success")


@query(f"""WITH {PATHS}, t AS (SELECT *, SQRT((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) AS shortest FROM paths)
SELECT task_id, ROUND(CASE WHEN task_id % 5 = 0 THEN 0.0 WHEN GREATEST(path_length, shortest) = 0 THEN 1.0 ELSE shortest / GREATEST(path_length, shortest) END, 6) AS spl FROM t""")
def spl(spark, sf_dir):
    dx, dy = F.col("last_x") - F.col("first_x"), F.col("last_y") - F.col("first_y")
    return paths(spark, sf_dir).select("task_id", r6(T.spl(F.sqrt(dx * dx + dy * dy), F.col("path_length"), F.col("task_id") % 5 != 0), "spl"))


ACTION = "CASE WHEN action IN ('move_forward', 'move_backward') THEN 'forward' WHEN action IN ('turn_left', 'turn_right') THEN 'turn' WHEN action IN ('move_left', 'move_right') THEN 'strafe' ELSE 'other' END"


@query(f"""SELECT task_id, COUNT(*) FILTER ({ACTION} = 'forward') AS forward, COUNT(*) FILTER ({ACTION} = 'turn') AS turn, COUNT(*) FILTER ({ACTION} = 'strafe') AS strafe, COUNT(*) FILTER ({ACTION} = 'other') AS other FROM {{traj_steps}} GROUP BY task_id""")
def action_mix(spark, sf_dir):
    return T.action_mix(scene(spark, sf_dir, "traj_steps")[0], X.action_class(F.col("action")))


@query("""SELECT task_id, COUNT(*) AS n, string_agg(replace(action, '_', ' '), ', ' ORDER BY step) AS described, CASE WHEN COUNT(*) <= 1 THEN 'easy' WHEN COUNT(*) <= 3 THEN 'medium' WHEN COUNT(*) <= 5 THEN 'hard' ELSE 'expert' END AS difficulty FROM {traj_steps} GROUP BY task_id""")
def described_actions(spark, sf_dir):
    steps = F.transform(F.sort_array(F.collect_list(F.struct("step", "action"))), lambda s: s["action"])
    grouped = scene(spark, sf_dir, "traj_steps")[0].groupBy("task_id").agg(F.count("*").alias("n"), steps.alias("actions"))
    return grouped.select("task_id", "n", X.describe_actions(F.col("actions")).alias("described"), X.difficulty(F.col("n")).alias("difficulty"))


COMPARED = "c AS (SELECT *, ABS(CAST(ground_truth AS DOUBLE) - CAST(model_prediction AS DOUBLE)) AS gap FROM {results})"


@query(f"WITH {COMPARED} SELECT question_id, gap <= 0.1 AS exact, gap <= 0.3 AS close FROM c")
def compare_answers(spark, sf_dir):
    exact, close = X.compare_answers(F.col("ground_truth"), F.col("model_prediction"))
    return scene(spark, sf_dir, "results")[0].select("question_id", exact.alias("exact"), close.alias("close"))


@query(f"WITH {COMPARED} SELECT question_type, COUNT(*) AS n, ROUND(AVG((gap <= 0.1)::INT), 6) AS exact, ROUND(AVG((gap <= 0.3)::INT), 6) AS close FROM c GROUP BY ROLLUP (question_type)")
def model_accuracy(spark, sf_dir):
    out = T.accuracy(compare_answers(spark, sf_dir).join(scene(spark, sf_dir, "results")[0].select("question_id", "question_type"), "question_id"))
    return out.select("question_type", "n", r6(F.col("exact"), "exact"), r6(F.col("close"), "close"))


@query("""WITH k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY ground_truth ORDER BY question_id) AS k FROM {results}) SELECT question_id, ground_truth FROM k WHERE k <= 20""")
def balanced_counts(spark, sf_dir):
    return T.balanced(scene(spark, sf_dir, "results")[0], "ground_truth", 20, ["question_id"]).select("question_id", "ground_truth")


@query("""WITH a AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY question_type ORDER BY question_id) AS k FROM {results}), b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY ground_truth ORDER BY question_id) AS j FROM a WHERE k <= 50)
SELECT question_id FROM b WHERE j <= 15""")
def capped_items(spark, sf_dir):
    return T.capped(scene(spark, sf_dir, "results")[0], [("question_type", 50), ("ground_truth", 15)], ["question_id"]).select("question_id")


@query("SELECT MIN(question_id) AS question_id FROM {results} GROUP BY question_type, LEAST(ground_truth, model_prediction), GREATEST(ground_truth, model_prediction)")
def dedup_items(spark, sf_dir):
    signature = F.concat_ws("|", "question_type", F.array_join(F.sort_array(F.array("ground_truth", "model_prediction")), "|"))
    return T.dedup_items(scene(spark, sf_dir, "results")[0], signature, ["question_id"]).select("question_id")


@query("SELECT scene_id, room_a AS src, room_b AS dst FROM {portals} UNION SELECT scene_id, room_b, room_a FROM {portals}")
def room_edges(spark, sf_dir):
    return T.room_edges(scene(spark, sf_dir, "portals")[0])


REACH = """e AS (SELECT scene_id, room_a AS src, room_b AS dst FROM {portals} UNION SELECT scene_id, room_b, room_a FROM {portals}),
reach(scene_id, start, blocked, room) AS (SELECT a.scene_id, a.room_id, b.room_id, a.room_id FROM {rooms} a JOIN {rooms} b ON a.scene_id = b.scene_id AND a.room_id <> b.room_id
  UNION SELECT r.scene_id, r.start, r.blocked, e.dst FROM reach r JOIN e ON r.scene_id = e.scene_id AND r.room = e.src WHERE e.dst <> r.blocked)"""


@query(f"WITH RECURSIVE {REACH} SELECT scene_id, start, blocked, room FROM reach")
def reachable_rooms(spark, sf_dir):
    portals, rooms = scene(spark, sf_dir, "portals", "rooms")
    return T.reachable(T.room_edges(portals), T.starts(rooms)).select("scene_id", "start", "blocked", "room")


@query("""WITH w AS (SELECT task_id, step, LEAD(px) OVER w - px AS dx, LEAD(py) OVER w - py AS dy FROM {traj_steps} WINDOW w AS (PARTITION BY task_id ORDER BY step)),
h AS (SELECT task_id, step, DEGREES(ATAN2(dy, dx)) AS h FROM w WHERE dx IS NOT NULL), d AS (SELECT task_id, step, ROUND(LEAD(h) OVER (PARTITION BY task_id ORDER BY step) - h, 9) AS d FROM h)
SELECT task_id, step, ROUND(CASE WHEN d > 180 THEN d - 360 WHEN d <= -180 THEN d + 360 ELSE d END, 6) AS turn FROM d WHERE d IS NOT NULL""")
def heading_changes(spark, sf_dir):
    w = T.by_step()
    steps = scene(spark, sf_dir, "traj_steps")[0]
    moves = steps.withColumns({"dx": F.lead("px").over(w) - F.col("px"), "dy": F.lead("py").over(w) - F.col("py")}).where("dx IS NOT NULL")
    heads = moves.withColumn("h", F.degrees(F.atan2("dy", "dx"))).withColumn("next", F.lead("h").over(w)).where("next IS NOT NULL")
    return heads.select("task_id", "step", r6(G.heading_delta(F.col("h"), F.col("next")), "turn"))
