import pytest
from pyspark.sql import functions as F

from spikelens.operators import hot
from spikelens.operators.dedup import first_wins, new_only

SCHEMA = "trace_id string, offset long, partition int"


def flags(df):
    return {(r["offset"], r["partition"]): r["inserted"] for r in df.collect()}


@pytest.mark.parametrize("hot_limit", [1000, 1])
def test_first_arrival_wins(spark, hot_limit):
    rows = [("a", 5, 0), ("a", 3, 1), ("a", 3, 0), ("b", 9, 0), ("b", 10, 0), ("c", 1, 0)]
    got = flags(first_wins(spark.createDataFrame(rows, SCHEMA), hot_limit=hot_limit))
    assert {k for k, v in got.items() if v} == {(3, 0), (9, 0), (1, 0)}
    assert len(got) == len(rows)


@pytest.mark.parametrize("hot_limit", [1000, 1])
def test_rows_without_a_key_are_never_dropped(spark, hot_limit):
    rows = [("", 1, 0), ("", 2, 0), (None, 3, 0), (None, 4, 0), ("a", 5, 0), ("a", 6, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = flags(first_wins(df, hot_limit=hot_limit))
    assert [k[0] for k, v in sorted(got.items()) if v] == [1, 2, 3, 4, 5]
    stored = df.filter("trace_id = 'a' or trace_id = '' or trace_id is null")
    got = flags(first_wins(df, stored=stored, hot_limit=hot_limit))
    assert [k[0] for k, v in sorted(got.items()) if v] == [1, 2, 3, 4]


@pytest.mark.parametrize("hot_limit", [1000, 1])
def test_stored_keys_came_first(spark, hot_limit):
    rows = [("a", 1, 0), ("a", 2, 0), ("b", 3, 0), ("b", 4, 0)]
    stored = spark.createDataFrame([("a", "x"), ("z", "x")], "trace_id string, other string")
    out = first_wins(spark.createDataFrame(rows, SCHEMA), stored=stored, hot_limit=hot_limit)
    got = flags(out)
    assert got == {(1, 0): False, (2, 0): False, (3, 0): True, (4, 0): False}
    assert out.columns == ["trace_id", "offset", "partition", "inserted"]


def test_hot_and_cold_ways_agree(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "copied").otherwise((F.col("id") % 91).cast("string")).alias("trace_id"),
        (F.lit(5000) - F.col("id")).alias("offset"),
        F.lit(0).alias("partition"),
    )
    assert flags(first_wins(df)) == flags(first_wins(df, hot_limit=100))


def test_frequent_keys_are_found_among_some_rows(spark, monkeypatch):
    monkeypatch.setattr(hot, "LOOKED_AT", 200)
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "copied").otherwise(F.col("id").cast("string")).alias("trace_id"),
        F.col("id").alias("offset"),
        F.lit(0).alias("partition"),
    )
    found = hot.likely_hot_keys(df, "trace_id", ("offset", "partition"), 10_000)
    assert [r[0] for r in found.keys.collect()] == ["copied"]
    assert sum(flags(first_wins(df, hot_limit=10_000)).values()) == 40_001


def test_new_only(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 2, 0), ("", 3, 0), (None, 4, 0)], SCHEMA)
    audit = spark.createDataFrame([("a",), ("",), (None,)], "trace_id string")
    assert sorted(r["offset"] for r in new_only(df, audit).collect()) == [2, 3, 4]


@pytest.mark.parametrize("hot_limit", [1000, 1])
def test_only_fresh_keys_are_inserted_and_meet_the_rows_in_one_shuffle(spark, hot_limit):
    rows = [("a", 1, 0), ("a", 1, 0), ("a", 2, 0), ("b", 3, 0), ("b", 4, 0), (None, 5, 0)]
    fresh = spark.createDataFrame([("a", "x"), ("z", "x"), (None, "x")], "trace_id string, other string")
    df = spark.createDataFrame(rows, SCHEMA)
    out = first_wins(df, fresh=fresh, hot_limit=hot_limit)
    got = sorted((r["offset"], r["inserted"]) for r in out.collect())
    if hot_limit == 1000:
        assert got == [(1, False), (1, True), (2, False), (3, False), (4, False), (5, True)]
        assert out._jdf.queryExecution().sparkPlan().toString().count("Join") == 0
    else:  # a hot key's copies at one place are all its first arrival
        assert got == [(1, True), (1, True), (2, False), (3, False), (4, False), (5, True)]
    assert out.columns == ["trace_id", "offset", "partition", "inserted"]
    with pytest.raises(ValueError, match="stored or by those that are new"):
        first_wins(df, stored=fresh, fresh=fresh)
