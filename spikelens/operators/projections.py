"""Shapes of the results: audit rows, responses, alerts and alert log records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikelens.functions import event_time, is_blank

# Fixed texts of a response and of an alert log record.
DONE_MESSAGE = "event processed successfully"
ALERT_TYPE = "anomaly"

MONEY = "decimal(10,2)"


def to_audit(scored: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Newly inserted events as audit rows. Values are rounded here only, after scoring."""
    return scored.filter(F.col("inserted")).select(
        "user_id",
        "event_type",
        F.col("value").cast(MONEY).alias("event_value"),
        F.col("rolling_avg").cast(MONEY).alias("rolling_avg"),
        "is_anomaly",
        "trace_id",
        event_time(F.col("timestamp"), F.col("default_ts")).alias("event_timestamp"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )


def to_responses(scored: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """One response per valid event, duplicates included."""
    return scored.select(
        "trace_id",
        F.lit(True).alias("success"),
        F.lit(DONE_MESSAGE).alias("message"),
        (F.unix_timestamp() if processed_at is None else processed_at).alias("processed_at"),
        "is_anomaly",
    )


def to_alerts(scored: DataFrame) -> DataFrame:
    """One alert per newly inserted anomaly of a named user."""
    seconds = F.when(F.col("timestamp") > 0, F.col("timestamp")).otherwise(F.col("default_ts"))
    return scored.filter(F.col("inserted") & F.col("is_anomaly") & ~is_blank(F.col("user_id"))).select(
        "user_id",
        "event_type",
        F.col("value").alias("event_value"),
        "is_anomaly",
        "trace_id",
        seconds.alias("timestamp"),
    )


def alert_records(alerts: DataFrame, span_trace: str | None = None) -> DataFrame:
    """Alerts as JSON log lines; ``span_trace`` names a column with the span's trace id, if any."""
    return alerts.select(alert_record(span_trace).alias("record"))


def alert_record(span_trace: str | None = None) -> Column:
    """The JSON log line of an alert row."""
    fields = [
        F.lit(True).alias("alert"),
        F.lit(ALERT_TYPE).alias("alert_type"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("event_value").alias("value"),
        F.col("trace_id"),
        F.col("timestamp"),
    ]
    if span_trace is not None:
        fields.append(F.nullif(F.col(span_trace), F.lit("")).alias("otel_trace_id"))
    return F.to_json(F.struct(*fields))
