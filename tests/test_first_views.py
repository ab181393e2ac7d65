"""Views and what they see of their targets meet where their scene lies."""

import contextlib
import io
import re

from atrium.operators import feasibility as E
from atrium.operators import objects as O
from atrium.plans import registry

KEY = "scene_id int, template_id string, key long, grp string, "
BOX = ", ".join(f"{n}_{a} double" for a in "xyz" for n in ("min", "max"))


def looked(spark):
    registry.tune(spark)
    poses = spark.createDataFrame([(1, "T04", 7, "init", i, 0.0, 0.0, 0.5, 4.0, 0.0, 0.5) for i in (3, 8)] + [(1, "T01", 9, "init", 3, 0.0, 0.0, 0.5, 4.0, 0.0, 0.5)], KEY + "i long, px double, py double, pz double, tx double, ty double, tz double")
    targets = spark.createDataFrame([(1, "T04", 7, "init", 11, 1, 3.0, 3.5, -0.2, 0.2, 0.3, 0.7), (1, "T04", 7, "init", 12, 2, -3.5, -3.0, -0.2, 0.2, 0.3, 0.7)], KEY + "object_id long, n int, " + BOX)
    wall = spark.createDataFrame([(1, 50, 1.0, 1.2, -2.0, 0.0, 0.0, 2.0)], "scene_id int, object_id long, " + BOX)
    return E.seen_by(O.by_scene(poses), targets, 2, wall)


def test_pairs_and_cells_are_not_shuffled(spark):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        looked(spark).explain()
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)#\d+, \d+\)", out.getvalue())
    assert dealt and set(dealt) <= {"scene_id", "b_scene_"} and len(dealt) == out.getvalue().count("Exchange ")


def test_views_stay_one_row_with_what_they_see_by_number(spark):
    rows = {(r.key, r.i): r for r in looked(spark).collect()}
    assert set(rows) == {(7, 3), (7, 8), (9, 3)}
    seen = rows[7, 8]
    assert (seen.o1_n_corners, seen.o1_n_visible, seen.o1_occluded, seen.o2_n_corners, seen.o2_occluded) == (8, 4, 0.5, 0, 1.0)
    assert rows[9, 3].o1_n_corners is None and rows[9, 3].tx == 4.0
