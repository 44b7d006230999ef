import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import model
from spikelens import EngineParams
from spikelens.operators import surge
from spikelens.operators.scan import advance, limit_of, mean, window_of
from spikelens.operators.surge import static_scores, surge_scores

SCHEMA = "user_id string, n int, value double, inserted boolean, at long"


def stream(seed, users=4, rows=300, spread=1.0, big=0.4):
    """Events of a few users; the first has ``big`` of all rows."""
    rnd = random.Random(seed)
    out, at = [], 0
    for n in range(rows):
        user = 0 if rnd.random() < big else rnd.randrange(users)
        at += rnd.choice([1, 1, 2, 40])
        value = round(rnd.lognormvariate(3, spread) - 2, 2)
        out.append((f"u{user}", n, value, rnd.random() < 0.85, at))
    return out


def expected(rows, params, use_inserted=False, idle=None, start=None):
    by_user = {}
    for row in rows:
        by_user.setdefault(row[0], []).append(row)
    result = {}
    for user, own in by_user.items():
        scored = model.scores(
            [r[2] for r in own],
            params.window,
            params.multiplier,
            params.fallback,
            [r[3] for r in own] if use_inserted else None,
            [r[4] for r in own],
            idle,
            (start or {}).get(user, ()),
        )
        result.update({r[1]: s for r, s in zip(own, scored)})
    return result


def scored(df):
    return {r["n"]: (r["rolling_avg"], r["is_anomaly"]) for r in df.collect()}


@pytest.mark.parametrize(
    ("values", "flags"),
    [
        ([5000.0, 100.0, 110.0], [True, False, False]),
        ([100.0] * 5 + [200.0], [False] * 5 + [True]),
        ([0.0, 0.0, 900.0, 1001.0], [False, False, False, True]),
    ],
)
def test_known_sequences(spark, values, flags):
    rows = [("u", i, v, True, i) for i, v in enumerate(values)]
    random.Random(1).shuffle(rows)
    got = scored(surge_scores(spark.createDataFrame(rows, SCHEMA), order=("n",)))
    assert [got[i][1] for i in range(len(values))] == flags
    assert got[0][0] is None


def test_no_average_is_null_not_nan(spark):
    rows = [("u", 0, 5000.0, True, 0), ("u", 1, 10.0, True, 1)]
    df = surge_scores(spark.createDataFrame(rows, SCHEMA), order=("n",))
    assert df.filter(F.col("rolling_avg").isNull()).count() == 2


PARAMS = [
    EngineParams(),
    EngineParams(multiplier=4.0),
    EngineParams(window=3, multiplier=1.1, fallback=15.0),
    EngineParams(window=50, multiplier=2.5, fallback=-1.0),
]


@pytest.mark.parametrize("params", PARAMS)
def test_batch_equals_model(spark, params):
    rows = stream(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = scored(surge_scores(spark.createDataFrame(rows, SCHEMA), order=("n",), params=params))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == expected(rows, params)


@pytest.mark.parametrize("params", PARAMS)
@pytest.mark.parametrize("chunk_rows", [8, 60])
def test_chunks_equal_model(spark, params, chunk_rows):
    rows = stream(11, rows=500)
    df = spark.createDataFrame(rows, SCHEMA)
    got = scored(surge_scores(df, order=("n",), params=params, hot_limit=90, chunk_rows=chunk_rows))
    assert got == expected(rows, params)


@pytest.mark.parametrize("hot_limit", [10_000, 50])
def test_duplicates_are_scored_but_do_not_enter(spark, hot_limit):
    rows = stream(3, rows=400)
    df = spark.createDataFrame(rows, SCHEMA)
    got = scored(
        surge_scores(df, order=("n",), inserted="inserted", hot_limit=hot_limit, chunk_rows=30)
    )
    assert got == expected(rows, EngineParams(), use_inserted=True)


@pytest.mark.parametrize("hot_limit", [10_000, 50])
def test_idle_reset(spark, hot_limit):
    rows = stream(5, rows=400)
    df = spark.createDataFrame(rows, SCHEMA)
    got = scored(
        surge_scores(
            df, order=("n",), idle_reset=90, touched="at", hot_limit=hot_limit, chunk_rows=30
        )
    )
    reference = expected(rows, EngineParams(), idle=90)
    assert got == reference
    assert got != expected(rows, EngineParams())


@pytest.mark.parametrize("hot_limit", [10_000, 50])
def test_start_windows(spark, hot_limit):
    rows = stream(9, rows=300)
    start = {"u0": [5.0, 7.0, 9.0], "u2": [float(v) for v in range(1, 11)], "absent": [1.0]}
    seeds = spark.createDataFrame(list(start.items()), "user_id string, window array<double>")
    df = spark.createDataFrame(rows, SCHEMA)
    got = scored(
        surge_scores(df, order=("n",), start=seeds, hot_limit=hot_limit, chunk_rows=40)
    )
    assert got == expected(rows, EngineParams(), start=start)


def test_steady_decline_needs_every_chunk_before(spark):
    """Values fall so that no window forgets its past: the hardest case for cutting a user."""
    rows = [("u", n, 1000.0 * 0.99**n * (1 + (n % 7)), True, n) for n in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = scored(surge_scores(df, order=("n",), hot_limit=10, chunk_rows=20))
    assert got == expected(rows, EngineParams())


def _two_levels(rows, noise):
    rnd = np.random.default_rng(4)
    values = np.where(rnd.random(rows) < 0.95, 160.0, 100.0) + noise * rnd.random(rows)
    values[:10] = 100.0
    return [("u", n, float(v), True, n) for n, v in enumerate(values)]


@pytest.mark.parametrize("noise", [0.0, 1.0])
def test_two_levels_settle_in_few_passes(spark, monkeypatch, noise):
    passes = []
    plain = surge._summarise
    monkeypatch.setattr(surge, "_summarise", lambda *a: passes.append(1) or plain(*a))
    monkeypatch.setattr(surge, "_LOWS", 4)
    rows = _two_levels(6_400, noise)
    df = spark.createDataFrame(rows, SCHEMA)
    got = scored(surge_scores(df, order=("n",), hot_limit=10, chunk_rows=200))
    assert got == expected(rows, EngineParams())
    assert len(passes) <= 5


def test_all_rows_come_back_with_their_columns(spark):
    rows = stream(2, rows=200)
    df = spark.createDataFrame(rows, SCHEMA)
    out = surge_scores(df, order=("n",), hot_limit=20, chunk_rows=25)
    assert out.columns == [*df.columns, "rolling_avg", "is_anomaly"]
    assert sorted(out.select(*df.columns).collect()) == sorted(df.collect())


def test_one_shuffle_without_hot_users(spark):
    df = spark.createDataFrame(stream(2), SCHEMA)
    plan = surge_scores(df, order=("n",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_static_scores(spark):
    rows = [("u", 0, 150.0, True, 0), ("u", 1, 1500.0, True, 0)]
    got = scored(static_scores(spark.createDataFrame(rows, SCHEMA)))
    assert got == {0: (None, False), 1: (None, True)}


@pytest.mark.parametrize("seed", range(20))
def test_advance_equals_model(seed):
    rnd = np.random.default_rng(seed)
    count = int(rnd.integers(1, 12_000))
    values = np.round(rnd.lognormal(2, 1.5, count), 2)
    live = rnd.random(count) < 0.9
    params = EngineParams(window=int(rnd.integers(1, 15)), multiplier=float(rnd.uniform(0.8, 4)))
    averages, limits = np.full(count, np.nan), np.zeros(count)
    window = window_of([], params)
    half = count // 2
    for part in (slice(0, half), slice(half, count)):
        advance(values[part], live[part], [], window, params, averages[part], limits[part])
    wanted = model.scores(values.tolist(), params.window, params.multiplier, 1000.0, live.tolist())
    got = [(None if np.isnan(a) else a, bool(f)) for a, f in zip(averages, values > limits)]
    assert got == wanted


@pytest.mark.parametrize("seed", range(6))
def test_advance_equals_model_on_mostly_normal_values(seed):
    rnd = np.random.default_rng(seed)
    values = rnd.normal(100, 20, 9_000) * np.where(rnd.random(9_000) < 0.05, 5.0, 1.0)
    if seed == 5:
        values[4_000:4_040:13] = [np.nan, np.inf, -np.inf, 1e308]
    params = EngineParams(window=3 + 5 * seed)
    averages, limits = np.full(len(values), np.nan), np.zeros(len(values))
    advance(values, None, [], window_of([], params), params, averages, limits)
    window, at = window_of([], params), 0
    for value, average, limit in zip(values.tolist(), averages.tolist(), limits.tolist()):
        wanted = mean(window)
        assert (wanted is None and np.isnan(average)) or wanted == average, at
        assert limit == limit_of(wanted, params)
        if not value > limit:
            window.appendleft(value)
        at += 1
