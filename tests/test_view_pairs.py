"""Pairs of views count what one pass over visibility has found."""

import contextlib
import io

from atrium.plans import registry

SF_DIR = "/root/testdata/sf0.001"


def test_what_is_visible_is_made_once_for_its_three_uses(spark):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        registry.queries()["view_pairs"](spark, SF_DIR).explain()
    assert out.getvalue().count("REPARTITION_BY_COL") == 3 and "ShuffledHashJoin" not in out.getvalue()
