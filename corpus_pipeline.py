"""The corpus pipeline: toxicity, quality rules, near-duplicate removal and packing over documents.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept. Stages
but the last return the columns of documents, whatever other columns they have. Null texts count as empty,
repeated rows are judged each until near_dedup makes rows of equal doc_id and text one, rows without a
doc_id are judged by their texts and never near duplicates, and an empty table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atrium.llm import neardup, packing, q_toxicity, quality, toxicity
from atrium.llm.common import broadcast_if_small, fresh, materialize, table
from atrium.llm.q_quality import verdicts


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = toxicity.fit(q_toxicity.sample(docs, table(spark, sf_dir, "labels")))
    score = fresh(docs, "score")
    return toxicity.score(docs, model, name=score).where(F.col(score) < q_toxicity.TOXIC).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counted rules and the likelihood ratio; a verdict is a function of the text alone, and no text counts for itself."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    judged = quality.judge(keyed, verdicts(table(spark, sf_dir, "labels")), carry=("doc_id", "text_key"))
    id_, key_ = fresh(docs, "rejected_id"), fresh(docs, "rejected_key")
    rejected = materialize(judged.where("NOT kept").select(F.col("doc_id").alias(id_), F.col("text_key").alias(key_)).distinct(), "rejected")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(key_))
    return docs.join(broadcast_if_small(rejected), same, "left_anti")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity 0.8 or more."""
    return neardup.keep_one(docs, neardup.Settings(width=5, percent=80))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: SQL can't express the fitted machine of the first stage nor the tokenizer of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
