"""Quantile sketches that a batch leaves in its commit record, and answers merged from them."""

from __future__ import annotations

import base64
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Values kept per level of a sketch: its size stays at a few KB however many rows it has seen.
SKETCH_K = 800
# Rank error that holds in 99 of 100 answers at this k, for the sketch's merged form as well.
RANK_ERROR = 2.296 / SKETCH_K**0.9021
MARK = "delays"


def sketch(value: Column) -> Column:
    """An aggregate over the values that are not null."""
    return F.kll_sketch_agg_double(value.cast("double"), F.lit(SKETCH_K))


def to_text(data: bytes | None) -> str | None:
    return None if data is None else base64.b64encode(bytes(data)).decode()


def _table(spark: SparkSession, texts: Iterable[str]) -> DataFrame:
    rows = [(bytearray(base64.b64decode(t)),) for t in texts]
    return spark.createDataFrame(rows, "sketch binary")


def merged(spark: SparkSession, texts: Iterable[str]) -> str | None:
    """One sketch in place of several."""
    texts = list(texts)
    if len(texts) < 2:
        return texts[0] if texts else None
    return to_text(_table(spark, texts).agg(F.kll_merge_agg_double("sketch").alias("s")).first()["s"])


def percentiles(spark: SparkSession, texts: Iterable[str], probs: tuple = (0.5, 0.95, 0.99)) -> DataFrame:
    """``p, events, value``: quantiles over all rows that the sketches have seen; no row is read again.

    The rank of ``value`` is within ``RANK_ERROR`` of ``p``. Without sketches, or with empty ones, there
    are 0 events and no value.
    """
    one = merged(spark, texts)
    probs = [float(p) for p in probs]
    if one is None:
        return spark.createDataFrame([(p, 0, None) for p in probs], "p double, events long, value double")
    held = spark.range(1).select(F.unbase64(F.lit(one)).alias("s"))
    held = held.withColumn("events", F.kll_sketch_get_n_double("s").cast("long"))
    wanted = F.lit(probs)
    values = F.when(F.col("events") > 0, F.kll_sketch_get_quantile_double("s", wanted))
    pairs = F.arrays_zip(wanted.alias("p"), F.coalesce(values, F.lit([None] * len(probs)).cast("array<double>")).alias("value"))
    return held.select("events", F.inline(pairs).alias("p", "value")).select("p", "events", "value")
