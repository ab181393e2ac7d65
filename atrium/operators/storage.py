"""Where operators keep what is read more than once, or what a round has found."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which a cluster's session names; a local session without one gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table below the shared folder: plans begin anew there, and executors may be lost."""
    path = f"{shared_folder(df.sparkSession)}/scene-{uuid.uuid4().hex[:16]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
