"""Queries that join several operators: replay, metrics, binding, gates."""

from pyspark.sql import functions as F

from atrium.operators import tasks as T
from atrium.plans.q_objects import ROOMED, r6, roomed
from atrium.plans.q_tasks import FRACTIONS, PATHS, fractions, paths
from atrium.plans.registry import query
from atrium.plans.scenes import scene


@query("""WITH y AS (SELECT task_id, step, action, SUM(CAST(CASE action WHEN 'turn_left' THEN 30 WHEN 'turn_right' THEN -30 ELSE 0 END AS DOUBLE)) OVER (PARTITION BY task_id ORDER BY step) AS yaw FROM {traj_steps}),
m AS (SELECT *, CASE WHEN action LIKE 'move_%' THEN 0.25 ELSE 0.0 END AS d, RADIANS(yaw + CASE action WHEN 'move_left' THEN 90.0 WHEN 'move_right' THEN -90.0 WHEN 'move_backward' THEN 180.0 ELSE 0.0 END) AS a FROM y)
SELECT task_id, step, ROUND(yaw, 3) AS yaw, ROUND(SUM(d * COS(a)) OVER w, 4) + 0.0 AS x, ROUND(SUM(d * SIN(a)) OVER w, 4) + 0.0 AS y FROM m WINDOW w AS (PARTITION BY task_id ORDER BY step)""")
def replayed_actions(spark, sf_dir):
    out = T.replay(scene(spark, sf_dir, "traj_steps")[0])
    return out.select("task_id", "step", F.round("yaw", 3).alias("yaw"), (F.round("x", 4) + 0.0).alias("x"), (F.round("y", 4) + 0.0).alias("y"))


@query(f"""WITH {PATHS}, t AS (SELECT *, SQRT((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) AS shortest, task_id % 5 <> 0 AS success FROM paths),
u AS (SELECT 'T' || CAST(task_id % 7 AS VARCHAR) AS template, success, CASE WHEN NOT success THEN 0.0 WHEN GREATEST(path_length, shortest) = 0 THEN 1.0 ELSE shortest / GREATEST(path_length, shortest) END AS spl, steps_to_success, path_length FROM t)
SELECT template, COUNT(*) AS n, ROUND(AVG(success::INT), 6) AS success_rate, ROUND(AVG(spl), 6) AS mean_spl, ROUND(AVG(steps_to_success), 6) AS mean_steps, ROUND(AVG(path_length), 5) AS mean_length FROM u GROUP BY ROLLUP (template)""")
def metric_summary(spark, sf_dir):
    dx, dy, success = F.col("last_x") - F.col("first_x"), F.col("last_y") - F.col("first_y"), F.col("task_id") % 5 != 0
    rows = paths(spark, sf_dir).withColumns({"template": F.concat(F.lit("T"), (F.col("task_id") % 7).cast("string")), "success": success, "spl": T.spl(F.sqrt(dx * dx + dy * dy), F.col("path_length"), success)})
    out = T.metric_summary(rows, "template")
    return out.select("template", "n", r6(F.col("success_rate"), "success_rate"), r6(F.col("mean_spl"), "mean_spl"), r6(F.col("mean_steps"), "mean_steps"), F.round("mean_length", 5).alias("mean_length"))


@query(f"""WITH {FRACTIONS}, o AS (SELECT task_id, slot_id, BOOL_OR(fraction >= 1.0)::INT AS x FROM f GROUP BY 1, 2), c AS (SELECT task_id, ROUND(AVG(x), 6) AS coverage FROM o GROUP BY 1),
p AS (SELECT task_id, COUNT(DISTINCT step) AS steps, ROUND(AVG(fraction), 6) AS potential FROM f GROUP BY 1),
k AS (SELECT task_id % 100 AS item, task_id, coverage, steps, potential, ROW_NUMBER() OVER (PARTITION BY task_id % 100 ORDER BY coverage DESC, steps, potential DESC, task_id) AS r FROM c JOIN p USING (task_id)) SELECT item, task_id, coverage, steps, potential FROM k WHERE r = 1""")
def best_trajectory(spark, sf_dir):
    f = fractions(spark, sf_dir)
    cov = T.coverage(T.slot_over_trajectory(T.slot_ok(f)), "any_frame").select("task_id", r6(F.col("coverage_mean"), "coverage"))
    size = f.groupBy("task_id").agg(F.count_distinct("step").alias("steps"), r6(F.avg("fraction"), "potential"))
    rows = cov.join(size, "task_id").withColumn("item", F.col("task_id") % 100)
    return T.best_trajectory(rows, "item").select("item", "task_id", "coverage", "steps", "potential")


@query("""WITH s(template_id, slot, repeat) AS (VALUES (0, 'anchor', FALSE), (0, 'member_{{i}}', TRUE), (1, 'target', FALSE), (1, 'zone_{{i}}', TRUE)),
i AS (SELECT o_orderkey AS task_id, CAST(o_orderkey % 2 AS INT) AS template_id, o_orderkey % 4 AS n FROM {orders}),
e AS (SELECT task_id, i.template_id, slot, UNNEST(range(0, CASE WHEN repeat THEN n ELSE 1 END)) AS k FROM i JOIN s USING (template_id))
SELECT task_id, template_id, replace(slot, '{{i}}', CAST(k AS VARCHAR)) AS slot FROM e""")
def bound_slots(spark, sf_dir):
    slots = spark.createDataFrame([(0, "anchor", False), (0, "member_{i}", True), (1, "target", False), (1, "zone_{i}", True)], "template_id int, slot string, repeat boolean")
    orders = scene(spark, sf_dir, "orders")[0]
    return T.bind_slots(orders.select(F.col("o_orderkey").alias("task_id"), (F.col("o_orderkey") % 2).cast("int").alias("template_id"), (F.col("o_orderkey") % 4).alias("n")), slots)


@query("""SELECT o_orderkey AS task_id, CAST(GREATEST(CEIL(ABS((o_orderkey % 361) - 180) / 30.0 - 0.5), 0) AS INT) AS n, (o_orderkey % 361) - 180 >= 0 AS to_left FROM {orders}""")
def turn_plans(spark, sf_dir):
    angle = (F.col("o_orderkey") % 361 - 180).cast("double")
    return scene(spark, sf_dir, "orders")[0].select(F.col("o_orderkey").alias("task_id"), F.size(T.turn_actions(angle)).alias("n"), (angle >= 0).alias("to_left"))


@query(f"""WITH {ROOMED}, c AS (SELECT r.scene_id, COUNT(DISTINCT o.room_id) AS rooms, COUNT(DISTINCT o.label) AS labels, ANY_VALUE(d.doors) AS doors FROM {{rooms}} r LEFT JOIN roomed o USING (scene_id) LEFT JOIN (SELECT scene_id, COUNT(*) AS doors FROM {{portals}} GROUP BY 1) d USING (scene_id) GROUP BY 1)
SELECT scene_id, CASE WHEN COALESCE(doors, 0) < 4 THEN 'too few doors' WHEN rooms < 5 THEN 'too few rooms' WHEN labels < 8 THEN 'too few labels' END AS unmet FROM c""")
def scene_gate(spark, sf_dir):
    rooms, portals = scene(spark, sf_dir, "rooms", "portals")
    doors = portals.groupBy("scene_id").agg(F.count("*").alias("doors"))
    counts = roomed(spark, sf_dir).groupBy("scene_id").agg(F.count_distinct("room_id").alias("rooms"), F.count_distinct("label").alias("labels"))
    all_ = rooms.select("scene_id").distinct().join(doors, "scene_id", "left").join(counts, "scene_id", "left").na.fill(0)
    return all_.select("scene_id", F.when(F.col("doors") < 4, "too few doors").when(F.col("rooms") < 5, "too few rooms").when(F.col("labels") < 8, "too few labels").alias("unmet"))
