import random

import pytest
from pyspark.sql import functions as F

from spikelens.operators.surge import surge_scores
from spikelens.operators.windows import preceding_avg, window_snapshot

SCHEMA = "user_id string, n int, value double"


def averages(rows, n):
    seen, out = {}, {}
    for user, at, value in rows:
        kept = seen.setdefault(user, [])
        last = kept[-n:]
        out[at] = round(sum(last) / len(last), 9) if last else None
        kept.append(value)
    return out


def got(df):
    return {r["n"]: None if r["preceding_avg"] is None else round(r["preceding_avg"], 9) for r in df.collect()}


def test_known_averages(spark):
    rows = [("u", 0, 10.0), ("u", 1, 20.0), ("u", 2, 30.0), ("u", 3, 0.0)]
    result = got(preceding_avg(spark.createDataFrame(rows, SCHEMA), order=("n",)))
    assert result == {0: None, 1: 10.0, 2: 15.0, 3: 20.0}


@pytest.mark.parametrize("chunk_rows", [3, 5, 40])
def test_chunks_equal_frames(spark, chunk_rows):
    rnd = random.Random(chunk_rows)
    rows = [(rnd.choice("aaab"), n, float(rnd.randrange(100))) for n in range(150)]
    df = spark.createDataFrame(rows, SCHEMA)
    for n in (1, 10):
        out = preceding_avg(df, order=("n",), n=n, hot_limit=20, chunk_rows=chunk_rows)
        assert out.columns == ["user_id", "n", "value", "preceding_avg"]
        assert got(out) == averages(rows, n)


def test_snapshot_is_the_next_window(spark):
    rows = [("u", n, 100.0 + n) for n in range(15)] + [("u", 15, 9000.0), ("cold", 16, 5000.0)]
    scored = surge_scores(spark.createDataFrame(rows, SCHEMA), order=("n",))
    taken = {r["user_id"]: r for r in window_snapshot(scored, order=("n",)).collect()}
    assert list(taken) == ["u"]
    assert taken["u"]["window"] == [114.0 - i for i in range(10)]
    assert taken["u"]["window_avg"] == sum(114.0 - i for i in range(10)) / 10


def test_snapshot_ignores_duplicates_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("u", 0, 1.0), ("u", 1, 2.0)], SCHEMA)
    scored = df.withColumn("is_anomaly", F.lit(False)).withColumn("inserted", F.col("n") == 0)
    taken = window_snapshot(scored, order=("n",), inserted="inserted")
    assert taken.first()["window"] == [1.0]
    plan = taken._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]
