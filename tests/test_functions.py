import hashlib
import math

import pytest
from pyspark.sql import functions as F

from spikelens import EngineParams
from spikelens.functions import (
    avg_of_text_list,
    event_time,
    fallback_key,
    idempotency_key,
    is_anomaly,
    is_blank,
    normalise_ts,
    trim_space,
)

DEFAULT = -1

TIMES = [
    (None, DEFAULT),
    ("", DEFAULT),
    ("not-a-timestamp", DEFAULT),
    ("1700000000", 1700000000),
    (" 1700000000 ", 1700000000),
    ("+1700000000", 1700000000),
    ("1700000000000", 1700000000),
    ("1700000000123456", 1700000000),
    ("1700000000000000000", 1700000000),
    ("100000000000", 100000000000),
    ("100000000001", 100000000),
    ("100000000000000", 100000000000),
    ("100000000000001", 100000000),
    ("10000000000000000", 10000000000),
    ("10000000000000001", 10000000),
    ("-1700000000000", -1700000000000),
    ("99999999999999999999", DEFAULT),
    ("17.0", DEFAULT),
    ("1.7e9", DEFAULT),
    ("2026-09-07T12:34:56.789Z", 1788784496),
    ("2026-09-07T12:34:56Z", 1788784496),
    ("2026-09-07T14:34:56+02:00", 1788784496),
    ("2026-09-07T11:04:56.999999999-01:30", 1788784496),
    ("2026-09-07T12:34:56,5Z", 1788784496),
    ("2026-09-08T08:34:56+20:00", 1788784496),
    ("1969-12-31T23:59:58.5Z", -2),
    ("2026-09-07", DEFAULT),
    ("2026-09-07 12:34:56Z", DEFAULT),
    ("2026-09-07T12:34:56", DEFAULT),
    ("2026-09-07t12:34:56z", DEFAULT),
    ("2026-02-30T12:34:56Z", DEFAULT),
    ("2026-09-07T24:00:00Z", DEFAULT),
    ("2026-09-07T12:34:56+25:00", DEFAULT),
]


def test_normalise_ts(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TIMES)], "i int, t string")
    got = rows.select("i", normalise_ts(F.col("t"), F.lit(DEFAULT).cast("bigint")).alias("s"))
    result = {r["i"]: r["s"] for r in got.collect()}
    assert [(t, result[i]) for i, (t, _) in enumerate(TIMES)] == TIMES


def test_event_time_needs_a_positive_second(spark):
    rows = spark.createDataFrame([(5, 9), (0, 9), (-5, 9)], "ts bigint, d bigint")
    got = rows.select(F.unix_seconds(event_time(F.col("ts"), F.col("d"))).alias("s")).collect()
    assert [r["s"] for r in got] == [5, 9, 9]


ANOMALIES = [
    (110.0, 100.0, False),
    (150.0, 100.0, False),
    (150.01, 100.0, True),
    (500.0, 100.0, True),
    (150.0, None, False),
    (1000.0, None, False),
    (1000.5, None, True),
    (50.0, 0.0, False),
    (1500.0, 0.0, True),
    (50.0, -50.0, False),
    (1200.0, -50.0, True),
    (1200.0, math.nan, True),
    (900.0, math.nan, False),
    (1200.0, math.inf, True),
    (900.0, -math.inf, False),
]


def test_is_anomaly(spark):
    rows = spark.createDataFrame(
        [(i, v, a) for i, (v, a, _) in enumerate(ANOMALIES)], "i int, v double, a double"
    )
    got = rows.select("i", is_anomaly(F.col("v"), F.col("a")).alias("x")).collect()
    assert [r["x"] for r in sorted(got)] == [x for _, _, x in ANOMALIES]


def test_is_anomaly_takes_parameters(spark):
    rows = spark.createDataFrame([(250.0, 100.0), (25.0, None)], "v double, a double")
    params = EngineParams(multiplier=3, fallback=20)
    got = rows.select(is_anomaly(F.col("v"), F.col("a"), params).alias("x")).collect()
    assert [r["x"] for r in got] == [False, True]


@pytest.mark.parametrize(
    ("texts", "average"),
    [
        ([], None),
        (None, None),
        (["10.5", "20.5"], 15.5),
        (["invalid", "30.0"], 30.0),
        (["bad1", "bad2"], None),
        (["NaN", "Inf", "-Inf", "25.0"], 25.0),
        (["1.0d", " 3.5 ", "4"], 4.0),
        (["1e400", "1e1", ".5", "1."], 11.5 / 3),
    ],
)
def test_avg_of_text_list(spark, texts, average):
    rows = spark.createDataFrame([(texts,)], "t array<string>")
    assert rows.select(avg_of_text_list(F.col("t"))).first()[0] == average


def test_blank_and_trim_know_unicode_space(spark):
    texts = [None, "", "  ", "\t\n", "\u00a0\u2003\u3000", "\u200b", " a\u00a0"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", is_blank(F.col("t")), trim_space(F.col("t"))).collect()
    assert [r[1] for r in sorted(got)] == [True, True, True, True, True, False, False]
    assert sorted(got)[-1][2] == "a"


def test_idempotency_key(spark):
    rows = spark.createDataFrame(
        [("producer-key-77",), (" \u00a0k ",), ("  ",), (None,)], "trace string"
    )
    key = idempotency_key(F.col("trace"), F.lit("events"), F.lit(4), F.lit(901))
    derived = hashlib.sha256(b"events:4:901").hexdigest()[:32]
    assert derived == "4b2286dd8014c09391dcd78c05b949c2"
    got = [r[0] for r in rows.select(key).collect()]
    assert got == ["producer-key-77", "k", derived, derived]


def test_fallback_key_is_32_hex_digits(spark):
    keys = [r[0] for r in spark.range(50).select(fallback_key()).collect()]
    assert len(set(keys)) == 50
    assert all(len(k) == 32 and set(k) <= set("0123456789abcdef") for k in keys)
