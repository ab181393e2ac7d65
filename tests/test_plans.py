"""What the plans of queries over whole scenes may hold, and that many tasks share their work."""

import contextlib
import io

import pytest

from atrium.operators import generators
from atrium.operators import objects as O
from atrium.plans import registry

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


GROWING = ["region_around_occluder_back", "region_around_pair", "region_breaking_projection", "region_of_triple", "region_orthogonal_to_segment", "region_with_separation", "valid_positions", "region_behind_front_object", "region_equidistant_to_pair", "preset_views", "view_pairs", "region_behind_object_face", "view_object_visibility", "not_blocked_by_next", "region_around_object", "region_near_portal_facing", "region_orthogonal_to_portal", "region_inside_room", "region_room_positions", "ring_positions", "region_bearing_sector", "far_from_objects"]


@pytest.mark.parametrize("name", GROWING)
def test_tables_that_grow_are_not_broadcast(spark, name):
    assert "BroadcastExchange" not in plan(registry.queries()[name](spark, SF_DIR))


def test_sessions_keep_their_own_threshold(spark):
    name, ours = "spark.sql.autoBroadcastJoinThreshold", "5242880b"
    before = spark.conf.get(name)
    spark.conf.set(name, ours)
    registry.tune(spark)
    assert spark.conf.get(name) == ours
    spark.conf.set(name, before)


def test_candidates_are_made_in_many_tasks_and_stay_with_their_scene(spark):
    registry.tune(spark)
    rows = spark.range(40).selectExpr("CAST(id % 7 AS INT) AS scene_id", "id AS key").coalesce(1)
    made = generators.draws(rows, 2)
    assert made.rdd.getNumPartitions() >= O.SHARES * spark.sparkContext.defaultParallelism and made.count() == 40 * 40


def test_tasks_grow_with_the_tables(spark):
    registry.tune(spark)
    rows = spark.range(200_000).selectExpr("CAST(id % 5000 AS INT) AS scene_id", "id AS key", "rand(7) AS x")
    dealt = rows.groupBy("scene_id").agg({"x": "max"}).withColumnRenamed("max(x)", "top").join(rows.hint(O.BUILT), "scene_id")
    assert dealt.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism


def test_views_and_blockers_meet_without_sorting_pairs(spark):
    text = plan(registry.queries()["view_object_visibility"](spark, SF_DIR))
    assert sum("ShuffledHashJoin" in line and "b_scene_" in line for line in text.splitlines()) == 1


def test_rays_that_hit_nothing_are_dropped_before_grouping(spark):
    assert "Filter NOT (hides_" in plan(registry.queries()["view_object_visibility"](spark, SF_DIR))


def test_objects_are_dealt_by_scene_before_they_become_cells(spark):
    text = plan(registry.queries()["far_from_objects"](spark, SF_DIR))
    assert 0 <= text.rfind("Generate explode") < text.find("REPARTITION_BY_NUM")


def test_rooms_are_assigned_without_a_sort(spark):
    text = plan(registry.queries()["assign_room"](spark, SF_DIR))
    assert "HashAggregate" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["pair_predicates", "newly_visible", "relative_position_items"])
def test_visibility_that_is_used_twice_is_dealt_once_by_view(spark, name):
    assert "REPARTITION_BY_COL" in plan(registry.queries()[name](spark, SF_DIR))
