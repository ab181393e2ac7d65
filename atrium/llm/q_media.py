"""Query op6: all documents as images in archives, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from atrium.llm import media
from atrium.llm.common import table


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and features as read back; `error` says why a member could not be read, and is null for all others."""
    folder = media.write_archives(table(spark, sf_dir, "documents"))
    columns = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "error")
    return media.describe(media.read_archives(spark, folder)).select(*columns)
