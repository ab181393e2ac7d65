"""Query op3: license notices in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atrium.llm import licenses
from atrium.llm.common import table


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.array_max("matches.containment").alias("best_containment"),
        F.get("matches", F.lit(0)).getField("start").alias("first_start"),
        F.get("matches", F.lit(0)).getField("end").alias("first_end"),
        F.transform("matches", lambda m: F.struct(m["license"].alias("license"), m["start"].alias("start"), m["end"].alias("end"))).alias("spans"),
    )
