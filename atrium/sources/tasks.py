"""Task and result files: JSON lines in and out, and the summaries written beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEW = "struct<position:array<double>,target:array<double>,forward:array<double>>"
TASK = (
    "task_id string, task_type string, scene_name string, question string, question_type string, answer string, gt_answer string, choices array<string>, answer_choice string, "
    f"init_view {VIEW}, target_view {VIEW}, action_sequence array<string>, action_descriptions array<string>, target_object string, target_object_id string, anchor_object string, "
    "anchor_object_id string, num_steps int, difficulty string, metadata string, template_id string, "
    f"expert_trajectory array<{VIEW}>, coverage double, submit_view_coverage double, score double, min_steps int"
)
RESULT = "question_id string, question_type string, question string, ground_truth string, model_prediction string, image string"


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Tasks with the file they come from; a missing submit coverage is the coverage, other gaps stay null."""
    raw = spark.read.schema(TASK).json(path).select("*", F.col("_metadata.file_name").alias("file_name"))
    return raw.withColumn("submit_view_coverage", F.coalesce("submit_view_coverage", "coverage"))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULT).json(path)


def write_tasks(tasks: DataFrame, path: str) -> None:
    tasks.write.partitionBy("scene_name", "template_id").json(path)


def validate_tasks(tasks: DataFrame, most_steps: int = 40) -> DataFrame:
    """Tasks with the first reason why they are invalid, null if they are valid."""
    empty = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    reason = (
        F.when(empty("question"), "empty_question")
        .when(F.coalesce(F.size("choices"), F.lit(0)) <= 0, "empty_choices")
        .when(empty("answer"), "empty_answer")
        .when(F.coalesce(F.size("action_sequence"), F.lit(0)) <= 0, "empty_actions")
        .when(F.size("action_sequence") > most_steps, "too_many_actions")
        .when(F.coalesce("coverage", F.lit(0.0)) <= 0, "zero_coverage")
    )
    return tasks.withColumn("invalid_reason", reason)


def run_summary(tasks: DataFrame) -> DataFrame:
    """Per template: tasks, valid tasks and mean score; the total has a null template."""
    checked = validate_tasks(tasks)
    return checked.rollup("template_id").agg(F.count("*").alias("n"), F.count_if(F.col("invalid_reason").isNull()).alias("n_valid"), F.avg("score").alias("mean_score"))


def write_summary_csv(summary: DataFrame, path: str) -> None:
    """One file: a summary has a row per template."""
    summary.orderBy("template_id").coalesce(1).write.option("header", True).csv(path)
