import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spikelens.operators.dedup import new_only
from spikelens.sources import stage, write_batch
from spikelens.sources.commits import KEPT_RECORDS, CommitLog, Part, ingest_summary
from spikelens.sources.key_store import KeyStore
from spikelens.streaming import LiveTables, score_stream
from test_streaming import append, message, run_live

ROW = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("x", T.LongType())])


def put(spark, log, run, batch, users, commit=True):
    rows = spark.createDataFrame([(u, batch) for u in users], ROW)
    write_batch(rows, f"{log.root}/t", batch, run)
    part = Part("t", f"t/run={run}/batch_id={batch}", run, batch, len(users), first=f"2024-01-0{batch + 1}", last=f"2024-01-0{batch + 1} 12:00:00")
    if commit:
        log.commit(run, batch, [part])
    return part


def test_readers_see_committed_folders_only(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    assert log.read("t", ROW) is None and log.state().version == 0
    put(spark, log, "main", 0, ["a", "b"])
    put(spark, log, "main", 1, ["c"], commit=False)
    assert log.read("t", ROW).count() == 2 and not log.is_done("main", 1)
    put(spark, log, "main", 1, ["c"])
    put(spark, log, "7", 0, ["d"])
    rows = sorted((r.user_id, r.x, r.run, r.batch_id) for r in log.read("t", ROW).collect())
    assert rows == [("a", 0, "main", 0), ("b", 0, "main", 0), ("c", 1, "main", 1), ("d", 0, "7", 0)]
    assert log.read("t").schema["run"].dataType == T.StringType() and log.is_done("main", 1) and not log.is_done("other", 0)


def test_merging_bounds_the_folders_and_keeps_old_readers(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    for batch in range(9):
        put(spark, log, "main", batch, [f"u{batch}", "v"])
        if batch == 1:
            held = log.read("t", ROW)
        log.merge("t", ROW, ["user_id"], fan_in=2)
    levels = sorted(p.level for p in log.state().parts)
    assert levels == [0, 3]  # nine rows of folders in binary
    assert held.count() == 4  # planned before the merges
    rows = log.read("t", ROW)
    assert rows.count() == 18 and {(r.x, r.batch_id) for r in rows.collect()} == {(b, b) for b in range(9)}
    assert tuple(ingest_summary(log, "t").select("events", F.col("first_at").cast("string"), F.col("last_at").cast("string")).first()) == (18, "2024-01-01 00:00:00", "2024-01-09 12:00:00")
    assert log.expire(3600) == 0 and log.expire(-1) == 8 + 4 + 2
    assert log.read("t", ROW).count() == 18 and log.expire(-1) == 0


def test_two_hundred_batches_leave_few_folders_and_records(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    most = 0
    for batch in range(200):
        log.commit("main", batch, [Part("t", f"t/{batch}", "main", batch, 1)])
        while True:
            parts = log.state().of("t")
            level = next((lv for lv in range(9) if sum(p.level == lv for p in parts) >= 8), None)
            if level is None:
                break
            old = [p for p in parts if p.level == level]
            log.swap(old, [Part("t", f"m/{batch}/{level}", "", -1, sum(p.rows for p in old), level + 1)])
        most = max(most, len(log.state().of("t")))
    assert most <= 7 * 3 and log.summary("t")[0] == 200
    assert len(list((tmp_path / "_commits").glob("0*.json"))) <= KEPT_RECORDS
    assert json.loads(max((tmp_path / "_commits").glob("0*.json")).read_text())["done"] == {"main": 199}


def test_a_second_writer_and_a_foreign_checkpoint_are_refused(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    part = put(spark, log, "main", 0, ["a"], commit=False)
    log.commit("main", 0, [part], "checkpoint-1")
    log.own("main", "checkpoint-1")
    log.own("other", "checkpoint-2")
    with pytest.raises(ValueError, match="new run name"):
        log.own("main", "checkpoint-2")
    with pytest.raises(RuntimeError, match="not part of the table"):
        log.swap([Part("t", "gone", "", 0, 1)], [])
    stale = log.state()
    log.commit("main", 1, [])
    log.state = lambda: stale
    with pytest.raises(RuntimeError, match="another writer"):
        log.commit("main", 1, [])


def test_key_store_equals_the_plain_anti_join(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    store, rnd, stored = KeyStore(log, buckets=4), random.Random(3), []
    for batch in range(5):
        keys = [f"k{rnd.randrange(10**6)}-{batch}" for _ in range(rnd.choice([0, 3, 400]))]
        stored += keys
        frame = spark.createDataFrame([(k,) for k in keys], "trace_id string")
        log.commit("main", batch, store.write(frame, len(keys), "main", batch))
        store.merge(fan_in=3)
    rows = [(k, n) for n, k in enumerate(rnd.sample(stored, 50))] + [(f"new{n}", n) for n in range(50)] + [(None, 1), ("", 2), ("new1", 3)]
    asked = stage(spark.createDataFrame(rows, "trace_id string, n long"), "asked")
    kept = spark.createDataFrame([(k,) for k in stored], "trace_id string")
    assert sorted(map(str, store.new_only(asked).collect())) == sorted(map(str, new_only(asked, kept).collect()))
    assert store.matching(asked, without_run="main") is None and store.new_only(asked, without_run="main").count() == len(rows)


def test_a_look_up_reads_only_buckets_that_may_match(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    store = KeyStore(log, buckets=16)
    for batch in range(3):
        keys = spark.range(batch * 2000, (batch + 1) * 2000).select(F.concat(F.lit("k"), "id").alias("trace_id"))
        log.commit("main", batch, store.write(keys, 2000, "main", batch))
    one = stage(spark.createDataFrame([("k2500",), ("unseen",)], "trace_id string"), "asked")
    found = store.matching(one)
    assert 1 <= len(found.inputFiles()) <= 2 and all("bucket=" in f for f in found.inputFiles())
    assert any("batch_id=1/" in f for f in found.inputFiles())
    assert "InMemoryFileIndex(1 paths)" in store.new_only(one)._jdf.queryExecution().toString() or len(found.inputFiles()) == 2
    assert [r.trace_id for r in store.new_only(one).collect()] == ["unseen"]
    assert store.matching(stage(spark.createDataFrame([("unseen-7",)], "trace_id string"), "asked")) is None


def test_a_committed_batch_is_not_done_again(spark, tmp_path):
    home = str(tmp_path)
    append(spark, f"{home}/log", [message(i, "user-a", 100 + i) for i in range(6)])
    run_live(spark, home)
    tables = LiveTables(f"{home}/tables")
    version = tables.log(spark).state().version
    # The checkpoint forgets that the batch ended, as after a crash between the record and the tick.
    for file in (tmp_path / "checkpoint" / "commits").glob("*"):
        file.unlink()
    for file in (tmp_path / "checkpoint" / "commits").glob(".*"):
        file.unlink()
    run_live(spark, home)
    assert tables.log(spark).state().version == version and tables.audit(spark).count() == 6
    alert = tables.committed(spark, "alerts")
    assert "record" in alert.columns
    with pytest.raises(ValueError, match="new run name"):
        run_live(spark, home, checkpoint="other")


EVENT = "user_id string, offset long, at timestamp, value double, trace_id string"


def test_windows_time_out_on_the_events_own_clock(spark, tmp_path):
    home = str(tmp_path)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")

    def step(rows):
        frame = spark.createDataFrame([(u, n, at, v, f"t{n}") for u, n, at, v in rows], "user_id string, offset long, at long, value double, trace_id string")
        frame.withColumn("at", F.timestamp_seconds("at")).coalesce(1).write.mode("append").parquet(f"{home}/in")
        source = spark.readStream.schema(EVENT).parquet(f"{home}/in")
        scored = score_stream(source, order=("offset",), idle_reset=100.0, touched="at", lateness=1000.0)
        out = scored.writeStream.format("parquet").option("path", f"{home}/out").option("checkpointLocation", f"{home}/checkpoint")
        out.trigger(availableNow=True).start().awaitTermination()
        return {r.offset: r.rolling_avg for r in spark.read.parquet(f"{home}/out").collect()}

    step([("u", 0, 1000, 50.0), ("u", 1, 1099, 60.0), ("v", 2, 1000, 5.0)])
    got = step([("u", 3, 1198, 56.0), ("u", 4, 1298, 7.0), ("v", 5, 1150, 6.0), ("u", 6, 1299, 8.0)])
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert got == {0: None, 1: 50.0, 2: None, 3: 55.0, 4: None, 5: None, 6: 7.0}


def test_merged_sketches_stay_within_their_bound(spark):
    import numpy as np

    from spikelens.sources import sketches

    values = np.random.default_rng(5).lognormal(1, 2, 30_000)
    frames = [spark.createDataFrame([(float(v),) for v in part], "v double") for part in np.array_split(values, 6)]
    texts = [sketches.to_text(f.agg(sketches.sketch(F.col("v")).alias("s")).first()["s"]) for f in frames]
    one = sketches.merged(spark, texts)
    assert len(one) < 40_000
    for held in (texts, [one]):
        for p, events, value in sketches.percentiles(spark, held, (0.01, 0.5, 0.99)).collect():
            assert events == 30_000 and abs((values <= value).mean() - p) <= sketches.RANK_ERROR
    assert [tuple(r) for r in sketches.percentiles(spark, [], (0.5,)).collect()] == [(0.5, 0, None)]
