"""Values on the edge of a rule, where the last bit of a float must not decide."""

import math

from pyspark.sql import functions as F

from atrium.functions import geometry as G


def test_half_turns_are_180_whatever_their_last_bit(spark):
    turns = [(0.0, 180.0, 180.0), (0.0, -180.0, 180.0), (0.0, math.nextafter(180, 200), 180.0), (0.0, math.nextafter(-180, 0), 180.0), (10.0, 190.00000000000003, 180.0), (170.0, -170.0, 20.0), (0.0, 179.5, 179.5)]
    rows = spark.createDataFrame(turns, "a double, b double, want double").select("want", G.heading_delta(F.col("a"), F.col("b")).alias("got")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
