"""Times the headline queries and prints one JSON line; BENCH_SF_DIR and BENCH_CPUS choose tables and cores."""

import json
import os
import time

from pyspark.sql import SparkSession

from atrium.plans import registry

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = ("object_dims", "assign_room", "unique_objects", "nearest_in_cells", "object_pair_distances", "distractor_labels", "legal_positions", "slot_over_trajectory", "coverage", "step_rewards", "path_length", "model_accuracy", "view_object_visibility", "bearings", "t01_category", "t04_larger", "t05_closer", "t06_clearance", "t08_straight_line", "t20_bearing_search", "t21_nearest_of_two", "t29_contact", "t33_passable", "object_groups_of_three", "preset_views", "task_items")


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = registry.queries(), {}
    for name in HEADLINE:
        began = time.time()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/"))}))


if __name__ == "__main__":
    main()
