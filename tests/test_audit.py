from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from spikelens.functions import is_blank
from spikelens.operators import audit as A
from spikelens.operators.projections import alert_records, to_alerts, to_audit, to_responses
from spikelens.sources import read_table, write_audit

SCORED = (
    "user_id string, event_type string, value double, rolling_avg double, is_anomaly boolean, "
    "trace_id string, timestamp long, default_ts long, inserted boolean"
)


def scored(spark):
    rows = [
        ("u1", "click", 1.005, None, False, "a", 1700000000, 5, True),
        ("u1", "view", 500.0, 33.335, True, "b", 0, 1700000009, True),
        ("u1", "view", 500.0, 33.335, True, "b", 0, 1700000009, False),
        (" ", "view", 900.0, 2.0, True, "c", -1, 1700000009, True),
    ]
    return spark.createDataFrame(rows, SCORED)


def test_audit_rounds_half_cents_up_and_keeps_inserted_rows(spark):
    at = F.lit(datetime(2024, 1, 1, tzinfo=timezone.utc))
    audit = to_audit(scored(spark), at)
    rows = {r["trace_id"]: r for r in audit.collect()}
    assert set(rows) == {"a", "b", "c"}
    assert str(rows["a"]["event_value"]) == "1.01" and rows["a"]["rolling_avg"] is None
    assert str(rows["b"]["rolling_avg"]) == "33.34" and rows["b"]["is_anomaly"]
    seconds = dict(audit.select("trace_id", F.unix_seconds("event_timestamp")).collect())
    assert seconds == {"a": 1700000000, "b": 1700000009, "c": 1700000009}


def test_responses_answer_duplicates_too(spark):
    got = to_responses(scored(spark)).collect()
    assert [r["is_anomaly"] for r in got] == [False, True, True, True]
    assert {r["message"] for r in got} == {"event processed successfully"}


def test_alerts_once_per_stored_anomaly_of_a_named_user(spark):
    alerts = to_alerts(scored(spark))
    assert [tuple(r) for r in alerts.collect()] == [("u1", "view", 500.0, True, "b", 1700000009)]
    assert alerts.filter(is_blank(F.col("user_id"))).count() == 0
    assert alert_records(alerts).first()[0] == (
        '{"alert":true,"alert_type":"anomaly","user_id":"u1","event_type":"view",'
        '"value":500.0,"trace_id":"b","timestamp":1700000009}'
    )
    spanned = alerts.withColumn("span", F.lit("f" * 32))
    assert alert_records(spanned, "span").first()[0].endswith(f'"otel_trace_id":"{"f" * 32}"}}')


def test_lookups_reach_the_scan(spark, tmp_path):
    to_audit(scored(spark)).write.parquet(str(tmp_path / "audit"))
    audit = spark.read.parquet(str(tmp_path / "audit"))
    assert A.lookup_trace(audit, "b").count() == 1
    assert A.lookup_user(audit, "u1").count() == 2
    assert A.lookup_user(audit, "u1", "click").count() == 1
    assert [r["trace_id"] for r in A.no_baseline(audit).collect()] == ["a"]
    plan = A.lookup_trace(audit, "b")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(trace_id,b)" in plan


def test_counts_and_span(spark):
    rows = [("u", "c", datetime(2024, 1, 1, 0, 0, s)) for s in (0, 10, 20)]
    audit = spark.createDataFrame(rows, "user_id string, event_type string, ingested_at timestamp_ntz")
    assert [tuple(r) for r in A.event_counts(audit).collect()] == [("u", "c", 3)]
    assert A.ingest_summary(audit).first()["per_second"] == 3 / 20
    assert A.ingest_summary(audit.limit(1)).first()["per_second"] is None
    found = A.recovery_time(audit, F.lit(datetime(2024, 1, 1, 0, 0, 4)).cast("timestamp_ntz"))
    assert found.first()["recovery_seconds"] == 6.0


@pytest.mark.parametrize("values", [[4.0], [1.0, 2.0], [5.0] * 50 + [9.0], list(range(1000))])
def test_exact_percentiles(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "d double")
    probs = (0.0, 0.5, 0.95, 0.99, 1.0)
    got = dict(A.latency_percentiles(df, "d", probs).collect())
    assert got == pytest.approx({p: float(np.percentile(values, p * 100)) for p in probs})


def test_percentiles_of_nothing_and_by_sketch(spark):
    empty = spark.createDataFrame([], "d double")
    assert {r["value"] for r in A.latency_percentiles(empty, "d").collect()} == {None}
    many = spark.range(1, 1001).select(F.col("id").cast("double").alias("d"))
    got = dict(A.latency_percentiles(many, "d", exact=False).collect())
    assert got == {0.5: 500.0, 0.95: 950.0, 0.99: 990.0}


def test_lookups_reach_the_scan_of_the_stored_table(spark, tmp_path):
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("user_id"), F.concat(F.lit("k"), F.col("id")).alias("trace_id")
    )
    write_audit(rows, str(tmp_path), batch_id=0)
    stored = read_table(spark, str(tmp_path), rows.schema)
    found = A.lookup_trace(stored, "k77")
    assert [r["user_id"] for r in found.collect()] == ["77"]
    assert "EqualTo(trace_id,k77)" in found._jdf.queryExecution().toString()
    assert A.lookup_trace(stored, "absent").count() == 0
