"""Query op10: token ids of all documents, through files."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atrium.llm.common import table
from atrium.llm.tokenfile import read_ids, write_ids


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
