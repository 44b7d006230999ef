"""Lookups and summaries over the audit table."""

from __future__ import annotations

import bisect
import itertools
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikelens.operators import hot as H


def lookup_trace(audit: DataFrame, key: str) -> DataFrame:
    return audit.filter(F.col("trace_id") == key)


def lookup_user(audit: DataFrame, user: str, event_type: str | None = None) -> DataFrame:
    found = audit.filter(F.col("user_id") == user)
    return found if event_type is None else found.filter(F.col("event_type") == event_type)


def no_baseline(audit: DataFrame) -> DataFrame:
    """Rows scored without an average: a user's first event, or no state at the time."""
    return audit.filter(F.col("rolling_avg").isNull())


def event_counts(audit: DataFrame, keys: tuple = ("user_id", "event_type")) -> DataFrame:
    return audit.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"))


def ingest_summary(audit: DataFrame, at: str = "ingested_at") -> DataFrame:
    """Row count, first and last moment, and events per second (NULL over no time at all)."""
    span = F.timestamp_diff("MICROSECOND", F.col("first_at"), F.col("last_at")) / F.lit(1e6)
    return audit.agg(
        F.count(F.lit(1)).alias("events"), F.min(at).alias("first_at"), F.max(at).alias("last_at")
    ).withColumn("per_second", F.when(span > 0, F.col("events") / span))


def recovery_time(audit: DataFrame, t0: datetime | Column, at: str = "ingested_at") -> DataFrame:
    """The first row after ``t0`` and how many seconds later it came."""
    start = t0 if isinstance(t0, Column) else F.lit(t0)
    found = audit.filter(F.col(at) > start).agg(F.min(at).alias("first_row_at"))
    gap = F.timestamp_diff("MICROSECOND", start, F.col("first_row_at")) / F.lit(1e6)
    return found.withColumn("recovery_seconds", gap)


def latency_percentiles(
    df: DataFrame, duration: str, probs: tuple = (0.5, 0.95, 0.99), exact: bool = True
) -> DataFrame:
    """One row per probability: ``p`` and the interpolated ``value``.

    The exact way never brings all durations to one task: equal values are counted first, the
    distinct ones are range-partitioned, and only the few partitions that hold a wanted rank are
    looked at again. ``exact=False`` uses the built-in sketch, in one pass.
    """
    spark = df.sparkSession
    if not exact:
        sketch = F.percentile_approx(duration, list(probs), 10_000)
        return df.agg(F.arrays_zip(F.lit(list(probs)).alias("p"), sketch.alias("value")).alias("z")).select(
            F.inline("z").alias("p", "value")
        )
    counted = (
        df.filter(F.col(duration).isNotNull())
        .groupBy(F.col(duration).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = H.ordered_chunks(counted, [F.col("v")], parts)
    sizes = sorted(tuple(r) for r in chunks.groupBy(H.CHUNK).agg(F.sum("n")).collect())
    if not sizes:
        return spark.createDataFrame([(p, None) for p in probs], "p double, value double")
    ends = list(itertools.accumulate(size for _, size in sizes))
    wanted = []
    for p in probs:
        position = (ends[-1] - 1) * p
        for rank, weight in ((int(position), 1 - position % 1), (int(position) + 1, position % 1)):
            rank = min(rank, ends[-1] - 1)
            at = bisect.bisect_right(ends, rank)
            wanted.append((p, sizes[at][0], rank - (ends[at] - sizes[at][1]), weight))
    # Bounded broadcast: two rows per probability.
    ranks = F.broadcast(
        spark.createDataFrame(wanted, f"p double, {H.CHUNK} int, rank bigint, weight double")
    )
    upto = Window.partitionBy(H.CHUNK).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    few = chunks.filter(F.col(H.CHUNK).isin(sorted({w[1] for w in wanted})))
    hits = (
        few.withColumn("_end", F.sum("n").over(upto))
        .join(ranks, H.CHUNK)
        .filter((F.col("rank") < F.col("_end")) & (F.col("rank") >= F.col("_end") - F.col("n")))
    )
    return hits.groupBy("p").agg(F.sum(F.col("v") * F.col("weight")).alias("value"))
