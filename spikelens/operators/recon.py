"""Reconciliation jobs: loss, replay, determinism, affinity, correlation, rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def affinity_violations(raw: DataFrame, key: str = "key", partition: str = "partition") -> DataFrame:
    """Keys seen on more than one partition, with the number of partitions."""
    return (
        raw.select(key, partition)
        .distinct()
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("partitions"))
        .filter(F.col("partitions") > 1)
    )


def missing_events(published: DataFrame, audit: DataFrame, key: str = "trace_id") -> DataFrame:
    """Published keys that never reached the audit table."""
    stored = audit.select(F.col(key).alias("_stored_key"))
    return published.join(stored, F.col(key) == F.col("_stored_key"), "left_anti")


def completeness(
    published: DataFrame, audit: DataFrame, phase: str = "phase", key: str = "trace_id"
) -> DataFrame:
    """Published, persisted and missing keys per phase.

    Keys are made distinct before they meet, so a key published many times is one row.
    """
    sent = published.select(phase, key).distinct()
    stored = audit.select(F.col(key).alias("_stored_key")).distinct()
    persisted = F.count("_stored_key")
    return (
        sent.join(stored, F.col(key) == F.col("_stored_key"), "left")
        .groupBy(phase)
        .agg(
            F.count(F.lit(1)).alias("published"),
            persisted.alias("persisted"),
            (F.count(F.lit(1)) - persisted).alias("missing"),
        )
    )


def replay_report(before: DataFrame, after: DataFrame, key: str = "trace_id") -> DataFrame:
    """Rows before and after a replay, and keys gained or lost by it, from one shuffle."""
    sides = before.select(key, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(key, F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    per_key = sides.groupBy(key).agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    return per_key.agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("rows_after"),
        F.count_if((F.col("b") == 0) & (F.col("a") > 0)).alias("added"),
        F.count_if((F.col("a") == 0) & (F.col("b") > 0)).alias("lost"),
    )


def diff_scores(a: DataFrame, b: DataFrame, columns: tuple | None = None) -> DataFrame:
    """Rows of two runs that do not pair up; ``surplus`` is positive if ``a`` has more of them.

    Empty when a replay gave the same scores. One grouped count replaces two bag differences.
    """
    names = list(columns or a.columns)
    both = a.select(*names, F.lit(1).alias("_s")).unionByName(b.select(*names, F.lit(-1).alias("_s")))
    return both.groupBy(*names).agg(F.sum("_s").alias("surplus")).filter(F.col("surplus") != 0)


def reject_summary(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason", "partition").agg(F.count(F.lit(1)).alias("rejects"))


def correlate(
    spans: DataFrame, audit: DataFrame, how: str = "left", span_key: str = "idempotency_key"
) -> DataFrame:
    """Spans with the audit row of their key; ``audit`` holds each key once."""
    rows = audit.select(
        F.col("trace_id").alias("_audit_key"),
        "user_id",
        "event_type",
        "event_value",
        "rolling_avg",
        "is_anomaly",
    )
    joined = spans.join(rows, F.col(span_key) == F.col("_audit_key"), how)
    return joined.withColumn("persisted", F.col("_audit_key").isNotNull()).drop("_audit_key")
