"""Query op7: language-model scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atrium.llm import ctw
from atrium.llm.common import remainder, table


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("train", F.coalesce(remainder("doc_id", 7) != 2, F.lit(True)))
    columns = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
    return ctw.score(documents).select("doc_id", (~F.col("train")).alias("held_out"), *columns)
