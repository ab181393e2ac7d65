"""Values that only the last bit of a floating-point number would tell apart."""

from atrium.operators import feasibility as E
from atrium.operators import predicates as P
from atrium.plans import q_views


def test_a_distance_at_a_bands_end_is_in_it(spark):
    rows = spark.createDataFrame([(1, 3.0000000000000004), (2, 0.9999999999999999), (3, 3.00001)], "object_id long, distance double")
    got = P.evaluate(q_views.to_a_billionth(rows), [("distance_band", {"d_min": 1.0, "d_max": 3.0})])
    assert {r.object_id: r.ok for r in got.collect()} == {1: True, 2: True, 3: False}


def test_the_mean_of_anchors_does_not_depend_on_their_order(spark):
    at = {1: 0.1, 2: 0.2, 3: 0.3}
    box = [(0, k, *(c for _ in "xyz" for c in (x, x))) for k, x in at.items()]
    objects = spark.createDataFrame(box, "scene_id int, object_id long, " + ", ".join(f"{n}_{a} double" for a in "xyz" for n in ("min", "max")))
    bound = lambda ids: [{"name": n, "object_id": i} for n, i in zip(E.ROLES["T21"], ids)]
    rows = [(0, "T21", k, bound(ids)) for k, ids in enumerate([(1, 2, 3), (3, 2, 1), (2, 3, 1)])]
    instances = spark.createDataFrame(rows, "scene_id int, template_id string, key long, bound array<struct<name:string,object_id:bigint>>").coalesce(1)
    assert {tuple(r)[3:] for r in E.anchors(instances, objects).collect()} == {(0.2, 0.2, 0.2)}
