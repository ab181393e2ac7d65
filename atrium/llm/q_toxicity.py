"""Query op2: toxicity scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atrium.llm import toxicity
from atrium.llm.common import remainder, table

#: A document is predicted toxic from this score on.
TOXIC = 0.7


def sample(documents: DataFrame, labels: DataFrame, usable=None, rows: int = toxicity.SAMPLE_ROWS) -> DataFrame:
    """(text, label) of at most `rows` labelled documents, the first by a hash of the id; contradictory labels count as toxic."""
    named = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    named = named.where(usable) if usable is not None else named
    chosen = named.groupBy("doc_id").agg(F.max("toxic").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(sample(documents, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1))
    scored = toxicity.score(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
