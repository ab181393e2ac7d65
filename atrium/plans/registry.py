"""Queries of the scene operators and their SQL oracles."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atrium.plans.scenes import ctes

FLAGSHIP = "view_object_visibility"
MODULES = ("q_objects", "q_pairs", "q_tasks", "q_views", "q_texts", "q_jobs", "q_templates", "q_choices", "q_generators", "q_validators", "q_items")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


#: The JVM never compiles methods of more bytecodes than this.
COMPILED = "8000"
#: Settings of sessions that haven't their own. Scenes are made of few columns of small files, from which Spark takes tables for small
#: that aren't: only what a shuffle has shown to be small is broadcast. A scene's rows become many times as many in the task that
#: gets them, candidates or pairs: shuffles have many partitions, of which a task takes a megabyte, so that tasks grow with the tables.
TUNED = {
    "spark.sql.codegen.hugeMethodLimit": COMPILED,
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760b",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "800",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "65536b",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1048576b",
}


def tune(spark: SparkSession) -> None:
    """Let a stage whose generated method the JVM would only interpret run operator by operator, in methods that it compiles.

    Projections of eight corners make such methods: interpreted, they take three times as long. A session that has set the
    limit itself keeps its own. Rows that lie by scene stay so in joins by scene and cell.
    """
    for name, value in TUNED.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def query(sql: str | None = None):
    """Register a function under its name; sql names derived views in braces."""

    def add(f):
        @functools.wraps(f)
        def tuned(spark, sf_dir):
            tune(spark)
            return f(spark, sf_dir)

        _QUERIES[f.__name__] = tuned
        if sql:
            _ORACLES[f.__name__] = ctes(sql)
        return f

    return add


def oracle(name: str) -> str:
    """The SQL registered for a query, to stand in that of another."""
    return _ORACLES[name]


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"atrium.plans.{name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    load()
    return dict(_ORACLES)
