"""Query op11: the language of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atrium.llm import langid
from atrium.llm.common import remainder, table

FOLDS = 5


def held_out():
    """Whether a document is kept from learning; a null id counts as empty text, whose crc32 is 0."""
    return F.coalesce(remainder("doc_id", FOLDS), F.lit(0)) == 0


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    known = langid.learnable(documents.select("doc_id", "text", "lang"), ~held_out())
    idf = langid.document_frequencies(known)
    model = langid.fit(langid.sample(known), idf)
    return langid.predict(documents.select("doc_id", "text"), model, idf).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
