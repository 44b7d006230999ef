import random
import time

import pytest
from pyspark.sql import functions as F

import model
import spikelens.streaming.live as live
from spikelens import EngineParams
from spikelens.operators.recon import diff_scores, replay_report
from spikelens.plans import process
from spikelens.sources import (
    RAW_SCHEMA,
    keyed_messages,
    read_events_range,
    read_events_stream,
    repartition_by_key,
    write_batch,
)
from spikelens.sources.raw_log import kafka_offsets, kafka_range
from spikelens.sources.tables import read_table
from spikelens.streaming import LiveTables, score_stream, start_live

ARRIVED = 1_700_000_000


def message(offset, user, value, trace=None, partition=None, payload=None):
    key = f',"trace_id":"{trace}"' if trace else ""
    text = payload
    if text is None:
        text = f'{{"user_id":"{user}","event_type":"click","value":{value},"timestamp":{ARRIVED}{key}}}'
    return ("events", len(user) % 3 if partition is None else partition, offset, user, text)


def append(spark, folder, rows):
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string")
    df = df.withColumn("arrived_at", F.timestamp_seconds(F.lit(ARRIVED)))
    df.select(*RAW_SCHEMA.names).coalesce(1).write.mode("append").parquet(folder)


def run_live(spark, home, checkpoint="checkpoint", **options):
    query = start_live(
        read_events_stream(spark, f"{home}/log"),
        f"{home}/tables",
        f"{home}/{checkpoint}",
        default_ts=F.unix_seconds("arrived_at"),
        ingested_at=F.col("arrived_at"),
        **options,
    )
    query.awaitTermination()


def random_log(seed, rows=120):
    rnd = random.Random(seed)
    out = []
    for offset in range(rows):
        if rnd.random() < 0.1:
            out.append(message(offset, "u", 0, partition=0, payload=rnd.choice(["", "junk", "{}"])))
            continue
        user = rnd.choice(["a", "bb", "ccc"])
        trace = rnd.choice([None, f"t{rnd.randrange(60)}"])
        out.append(message(offset, user, round(rnd.lognormvariate(3, 1), 2), trace))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_live_equals_batch_for_any_split(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(live, "COMPACT_EVERY", 2)
    rows, home = random_log(seed), str(tmp_path)
    cuts = sorted(random.Random(seed).sample(range(1, len(rows)), 2))
    for lo, hi in zip([0, *cuts], [*cuts, len(rows)]):
        append(spark, f"{home}/log", rows[lo:hi])
        run_live(spark, home)
    raw = spark.read.schema(RAW_SCHEMA).parquet(f"{home}/log")
    batch = process(raw, F.unix_seconds("arrived_at"), F.col("arrived_at"))
    tables = LiveTables(f"{home}/tables")
    stored = tables.audit(spark).drop("run", "batch_id")
    assert stored.count() > 40
    assert diff_scores(stored, batch.audit).count() == 0
    assert spark.read.parquet(tables.path("rejects")).count() == batch.rejects.count() > 0
    assert spark.read.parquet(tables.path("responses")).count() == batch.responses.count()
    assert spark.read.parquet(tables.path("alerts")).count() == batch.alerts.count() > 0


def test_outage_and_replay_lose_and_add_nothing(spark, tmp_path):
    home = str(tmp_path)
    tables = LiveTables(f"{home}/tables")
    append(spark, f"{home}/log", [message(i, "user-a", 105 + 5 * i) for i in range(10)])
    run_live(spark, home)
    append(spark, f"{home}/log", [message(10 + i, "user-a", 310 + 10 * i) for i in range(5)])
    run_live(spark, home)
    before = tables.audit(spark)
    assert before.count() == 15
    before = spark.createDataFrame(before.collect(), before.schema)
    run_live(spark, home, checkpoint="replay", run="replay")
    assert tuple(replay_report(before, tables.audit(spark)).first()) == (15, 15, 0, 0)
    assert spark.read.parquet(tables.path("responses")).count() == 30
    assert spark.read.parquet(tables.path("alerts")).filter("run = 'replay'").count() == 0


def test_failed_batch_is_done_again_without_copies(spark, tmp_path, monkeypatch):
    home = str(tmp_path)
    append(spark, f"{home}/log", [message(i, "user-a", 100 + i) for i in range(6)])
    run_live(spark, home)
    append(spark, f"{home}/log", [message(6 + i, "user-a", 100 + i) for i in range(6)])
    write = live.write_audit

    def written_then_lost(*args):
        write(*args)
        raise OSError("lost after the write")

    monkeypatch.setattr(live, "write_audit", written_then_lost)
    with pytest.raises(Exception, match="lost after the write"):
        run_live(spark, home)
    monkeypatch.setattr(live, "write_audit", write)
    run_live(spark, home)
    got = LiveTables(f"{home}/tables").audit(spark).collect()
    assert len(got) == 12
    wanted = model.scores([100.0 + i for i in range(6)] * 2)
    averages = sorted(-1 if a is None else round(a, 2) for a, _ in wanted)
    assert sorted(-1 if r["rolling_avg"] is None else float(r["rolling_avg"]) for r in got) == averages


EVENT = "user_id string, offset long, partition int, value double, trace_id string"


def run_stream(spark, home, **options):
    source = spark.readStream.schema(EVENT).parquet(f"{home}/in")
    query = (
        score_stream(source, **options)
        .writeStream.format("parquet")
        .option("path", f"{home}/out")
        .option("checkpointLocation", f"{home}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return {r["offset"]: (r["rolling_avg"], r["is_anomaly"]) for r in spark.read.parquet(f"{home}/out").collect()}


def write_events(spark, home, rows):
    spark.createDataFrame(rows, EVENT).write.mode("append").parquet(f"{home}/in")


def test_stream_state_survives_a_restart_and_a_replay(spark, tmp_path):
    home, rnd = str(tmp_path), random.Random(4)
    rows = [("u" + str(n % 3), n, 0, round(rnd.lognormvariate(3, 1), 2), f"t{n}") for n in range(90)]
    for lo in (0, 30, 60):
        part = rows[lo : lo + 30]
        rnd.shuffle(part)
        write_events(spark, home, part)
        run_stream(spark, home)
    write_events(spark, home, rows)
    got = run_stream(spark, home)
    assert len(got) == spark.read.parquet(f"{home}/out").count() == 90
    for user in range(3):
        own = [r for r in rows if r[0] == f"u{user}"]
        assert [got[r[1]] for r in own] == model.scores([r[3] for r in own])


def test_stream_forgets_idle_users(spark, tmp_path):
    home = str(tmp_path)
    # Without this a query with a timeout runs empty batches for ever instead of ending.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    write_events(spark, home, [("u", 0, 0, 50.0, "a"), ("v", 1, 0, 50.0, "b")])
    run_stream(spark, home, idle_reset=2.0)
    time.sleep(2.5)
    write_events(spark, home, [("u", 2, 0, 60.0, "c"), ("u", 3, 0, 60.0, "d")])
    got = run_stream(spark, home, idle_reset=2.0)
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert got[2] == (None, False) and got[3] == (60.0, False)


def test_range_reads_and_keyed_partitions(spark, tmp_path):
    home = str(tmp_path)
    append(spark, f"{home}/log", [message(i, "u", 1, partition=i % 2) for i in range(20)])
    got = read_events_range(spark, f"{home}/log", {0: 4, 1: 5}, {1: 9})
    assert sorted(r["offset"] for r in got.collect()) == [4, 5, 6, 7, 8, 10, 12, 14, 16, 18]
    assert kafka_offsets("events", {1: 5, 0: 4}) == '{"events": {"0": 4, "1": 5}}'
    assert kafka_range("events", {0: 4}, {1: 9}, None) == {}
    assert kafka_range("events", {0: 4}, {1: 9}, 2) == {
        "startingOffsets": '{"events": {"0": 4, "1": -2}}',
        "endingOffsets": '{"events": {"0": -1, "1": 9}}',
    }
    events = spark.range(300).select(F.concat(F.lit("u"), F.col("id") % 20).alias("user_id"), F.lit(1.5).alias("value"))
    placed = repartition_by_key(events, 6).withColumn("p", F.spark_partition_id())
    assert placed.rdd.getNumPartitions() == 6
    assert placed.groupBy("user_id").agg(F.countDistinct("p").alias("n")).filter("n > 1").count() == 0
    assert keyed_messages(events).orderBy("key").first()["value"] == '{"user_id":"u0","value":1.5}'


def test_batches_are_replaced_and_hidden_from_their_retry(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,)], "x int")
    assert read_table(spark, path, one.schema) is None
    write_batch(one, path, 0)
    write_batch(one, path, 1)
    write_batch(one, path, 1)
    write_batch(one, path, 1, run="other")
    assert read_table(spark, path, one.schema).count() == 3
    assert read_table(spark, path, one.schema, "main", 1).count() == 2


def test_params_reach_the_whole_job(spark, tmp_path):
    home = str(tmp_path)
    append(spark, f"{home}/log", [message(i, "u", v) for i, v in enumerate([100, 160, 40])])
    raw = spark.read.schema(RAW_SCHEMA).parquet(f"{home}/log")
    done = process(raw, F.lit(ARRIVED), params=EngineParams(multiplier=2, fallback=50))
    flags = {r["offset"]: r["is_anomaly"] for r in done.scored.collect()}
    assert flags == {0: True, 1: True, 2: False}


def test_first_copy_wins_in_keyed_state_and_repeats_are_scored(spark, tmp_path):
    home, rnd = str(tmp_path), random.Random(9)
    keys = [None, "", "hot", *(f"t{n}" for n in range(30))]
    rows = [(f"u{rnd.randrange(3)}", n, 0, round(rnd.lognormvariate(3, 1), 2), rnd.choice(keys)) for n in range(150)]
    rows += [rows[-1]]  # the very same row again
    for lo, hi in ((0, 50), (50, 51), (51, 151)):
        part = rows[lo:hi]
        rnd.shuffle(part)
        write_events(spark, home, part)
        run_stream(spark, home, duplicates="score")
    got = spark.read.parquet(f"{home}/out").collect()
    seen, windows, wanted = set(), {}, []
    for user, offset, _, value, key in rows:
        inserted = not key or key not in seen
        seen.add(key)
        window = windows.setdefault(user, [])
        average = sum(window) / len(window) if window else None
        odd = value > (average * 1.5 if average else 1000)
        if inserted and not odd:
            windows[user] = [value, *window][:10]
        wanted.append((offset, odd, inserted, None if average is None else round(average, 6)))
    found = [(r.offset, r.is_anomaly, r.inserted, None if r.rolling_avg is None else round(r.rolling_avg, 6)) for r in got]
    assert sorted(map(str, found)) == sorted(map(str, wanted))
    with pytest.raises(ValueError, match="dropped or scored"):
        score_stream(None, duplicates="both")


def test_keyed_state_is_held_by_bucket(spark, tmp_path):
    home, rnd = str(tmp_path), random.Random(3)
    rows = [(f"u{n % 40}" if n % 41 else None, n, 0, round(rnd.lognormvariate(3, 1), 2), f"t{n}") for n in range(400)]
    for part in (rows[:200], rows[200:]):
        write_events(spark, home, part)
        source = spark.readStream.schema(EVENT).parquet(f"{home}/in")
        query = (
            score_stream(source, buckets=4)
            .writeStream.format("parquet")
            .option("path", f"{home}/out")
            .option("checkpointLocation", f"{home}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        operators = {o["operatorName"]: o["numRowsTotal"] for o in query.lastProgress["stateOperators"]}
        assert operators["applyInPandasWithState"] == 5  # four buckets, and the users without a name
    got = {r["offset"]: (r["rolling_avg"], r["is_anomaly"]) for r in spark.read.parquet(f"{home}/out").collect()}
    assert len(got) == 400
    for user in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == user]
        assert [got[r[1]] for r in own] == model.scores([r[3] for r in own])


def test_idle_windows_leave_their_bucket(spark, tmp_path):
    home = str(tmp_path)
    fields = "user_id string, offset long, partition int, value double, trace_id string, at timestamp"

    def run(*rows):
        df = spark.createDataFrame([(u, o, 0, 50.0, str(o), s) for u, o, s in rows], fields.replace("at timestamp", "s long"))
        df.select("user_id", "offset", "partition", "value", "trace_id", F.timestamp_seconds(F.col("s") + 10_000).alias("at")).write.mode("append").parquet(f"{home}/in")
        source = spark.readStream.schema(fields).parquet(f"{home}/in")
        scored = score_stream(source, idle_reset=100.0, touched="at", buckets=1)
        query = scored.writeStream.format("parquet").option("path", f"{home}/out").option("checkpointLocation", f"{home}/checkpoint")
        query.trigger(availableNow=True).start().awaitTermination()
        return {r["offset"]: r["rolling_avg"] for r in spark.read.parquet(f"{home}/out").collect()}

    run(("a", 0, 0), ("b", 1, 1000))
    run(("b", 2, 1050), ("a", 3, 1060))
    got = run(("b", 4, 1400), ("a", 5, 1401), ("a", 6, 1402))
    assert got == {0: None, 1: None, 2: 50.0, 3: None, 4: None, 5: None, 6: 50.0}


def test_small_live_batches_are_not_cut_by_the_partitions_of_the_state(spark, tmp_path):
    home, before = str(tmp_path), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    append(spark, f"{home}/log", [message(i, f"user-{i}", 100 + i) for i in range(60)])
    run_live(spark, home)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    folder = tmp_path / "tables" / "audit" / "run=main" / "batch_id=0"
    assert len(list(folder.glob("*.parquet"))) <= 4
    assert LiveTables(f"{home}/tables").audit(spark).count() == 60
