"""Outlines of any number of corners."""

import pytest
from pyspark.sql import functions as F

from atrium.functions import geometry as G

TRIANGLE = [(0.0, 0.0), (4.0, 0.0), (0.0, 4.0)]
L_SHAPE = [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0), (2.0, 4.0), (0.0, 4.0)]


@pytest.mark.parametrize("outline", [TRIANGLE, L_SHAPE])
def test_points_are_told_in_or_out_of_outlines_without_four_corners(spark, outline):
    rows = spark.createDataFrame([(0.5, 0.5, outline), (1.0, 2.5, outline), (3.0, 3.0, outline), (5.0, 1.0, outline)], "x double, y double, poly array<struct<x:double,y:double>>")
    got = rows.select(G.point_in_polygon(F.col("x"), F.col("y"), F.col("poly")).alias("inside")).collect()
    assert [r.inside for r in got] == [True, True, False, False]
