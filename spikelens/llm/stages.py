"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame, each on all that came before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spikelens.llm import decontaminate, jaccard, langid, packing, repeats
from spikelens.llm.common import documents, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language the classifier can't tell: no text, or no letter in it."""
    small_batches(spark)
    model = langid.fit_languages(docs, langid.training_rows())
    return langid.keep_identified(docs.select(COLUMNS), model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every group of near copies."""
    small_batches(spark)
    return jaccard.keep_one(docs.select(COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 200 bytes and more that occur elsewhere; what a cut leaves of a character goes too."""
    small_batches(spark)
    cut = repeats.remove_repeats(docs.select(COLUMNS))
    left = F.col("kept").cast("string")
    whole = F.when(F.is_valid_utf8(left), left).otherwise(F.translate(F.make_valid_utf8(left), "\ufffd", ""))
    changed = F.when(F.size("spans") > 0, whole).otherwise(F.col("text"))
    return cut.withColumn("text", changed).withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, in its own or in other numbers and names."""
    return decontaminate.drop_contaminated(docs, documents(spark, sf_dir, "benchmark")).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lay the documents out in sequences of 2048 tokens: one row per piece."""
    return packing.packing_digest(packing.pack(docs))


STAGES = [("language_id", keep_languages), ("ngram_jaccard_join", one_of_each_group), ("suffix_array_dedup", without_repeats), ("decontamination", decontaminated), ("packing", packed)]
