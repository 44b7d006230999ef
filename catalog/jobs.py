"""The registered queries: every operator over whole test tables."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog.sample_log import raw_log
from spikelens import EngineParams, configure, shared_dir
from spikelens.functions import avg_of_text_list, fallback_key
from spikelens.operators import audit as A
from spikelens.operators import recon as R
from spikelens.operators.dedup import first_wins, new_only
from spikelens.operators.parse import parse_events, rejects, valid_events
from spikelens.operators.projections import alert_records, to_alerts, to_audit, to_responses
from spikelens.operators.surge import static_scores, surge_scores
from spikelens.operators.windows import preceding_avg, window_snapshot
from spikelens.plans import Outcome, process
from spikelens.sources import (
    keyed_messages,
    read_events_range,
    read_events_stream,
    read_table,
    repartition_by_key,
    stage,
    write_audit,
)
from spikelens.sources.commits import CommitLog, delay_percentiles
from spikelens.sources.commits import ingest_summary as recorded_summary
from spikelens.sources.key_store import KeyStore
from spikelens.sources.sketches import RANK_ERROR
from spikelens.streaming import LiveTables, configure_state, score_stream, start_live
from spikelens.streaming.live import AUDIT_SCHEMA

# Query parameters, the same in the checking SQL.
RECOVERY_START = datetime(2024, 1, 10)
IDLE_SECONDS = 12 * 3600
# Seconds of the handling clock from one offset to the next.
CLOCK_SECONDS = 300
HALF_TIME = datetime(2024, 1, 16)
STREAM_CUTS = [datetime(2024, 1, 11), datetime(2024, 1, 21)]
LOST_PARTITION = 3
LOW_UNTIL = datetime(2024, 1, 2)


def split_limits(df: DataFrame) -> dict[str, int]:
    """Limits under which a key with over a tenth of the rows is cut, whatever the scale."""
    rows = df.count()
    return dict(hot_limit=max(50, rows // 10), chunk_rows=max(50, rows // 32))


def session(spark: SparkSession) -> SparkSession:
    configure(spark)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/events.parquet")


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns the scores need: the optimizer cannot drop columns through a Python step."""
    return events(spark, sf_dir).select("event_id", "ts", "user_id", "value")


def skewed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all users' rows moved onto user 0."""
    crowd = F.when(F.col("user_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id"))
    return measures(spark, sf_dir).withColumn("user_id", crowd)


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_log(session(spark), sf_dir)


def arrival_seconds():
    return F.unix_seconds("arrived_at")


def outcome(raw: DataFrame, **scoring) -> Outcome:
    return process(raw, arrival_seconds(), F.col("arrived_at"), **scoring)


def audit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome(log(spark, sf_dir)).audit


def _scores(scored: DataFrame) -> DataFrame:
    return scored.select("event_id", "user_id", "rolling_avg", "is_anomaly")


def surge(spark, sf_dir):
    return _scores(surge_scores(measures(spark, sf_dir)))


def surge_low_fallback(spark, sf_dir):
    params = EngineParams(multiplier=3.0, fallback=100.0, window=5)
    return _scores(surge_scores(measures(spark, sf_dir), params=params))


def surge_shifted(spark, sf_dir):
    shifted = measures(spark, sf_dir).withColumn("value", F.col("value") - F.lit(50.0))
    return _scores(surge_scores(shifted, params=EngineParams(fallback=20.0)))


def surge_hot_user(spark, sf_dir):
    rows = skewed_events(spark, sf_dir)
    return _scores(surge_scores(rows, **split_limits(rows)))


def surge_resumed(spark, sf_dir):
    rows = measures(spark, sf_dir)
    first = surge_scores(rows.filter(F.col("ts") < F.lit(HALF_TIME).cast("timestamp_ntz")))
    left = window_snapshot(first).select("user_id", "window")
    second = surge_scores(
        rows.filter(F.col("ts") >= F.lit(HALF_TIME).cast("timestamp_ntz")), start=left
    )
    return _scores(first.unionByName(second))


def idle_reset(spark, sf_dir):
    return _scores(surge_scores(measures(spark, sf_dir), idle_reset=IDLE_SECONDS, touched="ts"))


def idle_reset_resumed(spark, sf_dir):
    rows, half = measures(spark, sf_dir), F.lit(HALF_TIME).cast("timestamp_ntz")
    rules = dict(idle_reset=IDLE_SECONDS, touched="ts")
    first = surge_scores(rows.filter(F.col("ts") < half), **rules)
    seen = first.groupBy("user_id").agg(F.max("ts").alias("touched"))
    last = F.max_by("_gap", F.struct("ts", "event_id")).alias("_gap")
    # The window left is what was accepted after the user's last long gap.
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.timestamp_diff("SECOND", F.lag("ts").over(order), F.col("ts")) >= IDLE_SECONDS
    spells = first.withColumn("_gap", F.count(F.when(gap, 1)).over(order))
    newest = spells.join(spells.groupBy("user_id").agg(last), ["user_id", "_gap"], "left_semi")
    left = window_snapshot(newest).select("user_id", "window").join(seen, "user_id")
    second = surge_scores(rows.filter(F.col("ts") >= half), start=left, **rules)
    return _scores(first.unionByName(second))


def surge_hot_two_levels(spark, sf_dir):
    """Two prices on hot users: a chunk entered with other windows stays at the other level."""
    low = (F.col("event_id") % 20 == 0) | (F.col("ts") < F.lit(LOW_UNTIL).cast("timestamp_ntz"))
    rows = skewed_events(spark, sf_dir).withColumn("value", F.when(low, 100.0).otherwise(160.0))
    return _scores(surge_scores(rows, **split_limits(rows)))


def plain_average(spark, sf_dir):
    averaged = preceding_avg(events(spark, sf_dir))
    return averaged.select("event_id", "user_id", F.round("preceding_avg", 6).alias("preceding_avg"))


def plain_average_hot_user(spark, sf_dir):
    rows = skewed_events(spark, sf_dir)
    averaged = preceding_avg(rows, **split_limits(rows))
    return averaged.select("event_id", "user_id", F.round("preceding_avg", 6).alias("preceding_avg"))


def static(spark, sf_dir):
    return _scores(static_scores(events(spark, sf_dir), EngineParams(fallback=100.0)))


def snapshot(spark, sf_dir):
    taken = window_snapshot(surge_scores(measures(spark, sf_dir)))
    return taken.select(
        "user_id",
        F.size("window").cast("bigint").alias("kept"),
        F.element_at("window", 1).alias("newest"),
        F.element_at("window", -1).alias("oldest"),
        F.round("window_avg", 6).alias("window_avg"),
    )


def parsed(spark, sf_dir):
    valid = valid_events(parse_events(log(spark, sf_dir), arrival_seconds()))
    return valid.select(
        "partition", "offset", "user_id", "event_type", "value", "timestamp", "trace_id"
    )


def rejected(spark, sf_dir):
    bad = rejects(parse_events(log(spark, sf_dir), arrival_seconds()))
    return bad.select("partition", "offset", "payload", "reject_reason")


def reject_report(spark, sf_dir):
    return R.reject_summary(rejects(parse_events(log(spark, sf_dir), arrival_seconds())))


def first_arrivals(spark, sf_dir):
    staged = stage(valid_events(parse_events(log(spark, sf_dir), arrival_seconds())), "valid")
    return first_wins(staged).select("partition", "offset", "trace_id", "inserted")


def first_arrivals_hot_key(spark, sf_dir):
    key = F.when(F.col("event_id") % 3 == 0, F.lit("copied")).otherwise(
        F.concat(F.lit("k"), (F.col("event_id") % 1000).cast("string"))
    )
    keyed = measures(spark, sf_dir).withColumn(
        "trace_id", F.when(F.col("event_id") % 17 == 0, F.lit("")).otherwise(key)
    )
    flagged = first_wins(keyed, order=("ts", "event_id"), hot_limit=split_limits(keyed)["hot_limit"])
    return flagged.select("event_id", "trace_id", "inserted")


def unseen(spark, sf_dir):
    valid = stage(valid_events(parse_events(log(spark, sf_dir), arrival_seconds())), "valid")
    stored = first_wins(valid.filter(F.col("partition") != LOST_PARTITION))
    kept = to_audit(static_scores(stored), F.col("arrived_at"))
    return new_only(valid, kept).select("partition", "offset", "trace_id")


def responses(spark, sf_dir):
    done = outcome(log(spark, sf_dir))
    return done.scored.select("partition", "offset", "trace_id", "inserted", "is_anomaly")


def response_rows(spark, sf_dir):
    return to_responses(outcome(log(spark, sf_dir)).scored, arrival_seconds())


def key_format(spark, sf_dir):
    """Random keys of all events: how many there are, how many differ, how many are well formed."""
    keys = events(spark, sf_dir).select(fallback_key().alias("k"))
    shaped = F.count(F.when(F.col("k").rlike("^[0-9a-f]{32}$"), 1))
    per_key = keys.groupBy("k").agg(F.count("*").alias("n"), shaped.alias("shaped"))
    return per_key.agg(F.sum("n").alias("events"), F.count("*").alias("keys"), F.sum("shaped").alias("well_formed"))


def key_places(spark, sf_dir):
    """Every sender's rows lie in one partition."""
    dealt = repartition_by_key(log(spark, sf_dir).select("key"), 7, "key")
    placed = dealt.withColumn("_place", F.spark_partition_id())
    return placed.groupBy("key").agg(F.countDistinct("_place").alias("places"), F.count("*").alias("messages"))


def audit_rows(spark, sf_dir):
    return audit_table(spark, sf_dir).select(
        "user_id",
        "event_type",
        F.col("event_value").cast("double").alias("event_value"),
        F.col("rolling_avg").cast("double").alias("rolling_avg"),
        "is_anomaly",
        "trace_id",
        F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
    )


def alerts(spark, sf_dir):
    return to_alerts(outcome(log(spark, sf_dir)).scored)


def alert_log(spark, sf_dir):
    """The JSON records, read back field by field."""
    lines = alert_records(to_alerts(outcome(log(spark, sf_dir)).scored))
    fields = "alert boolean, alert_type string, user_id string, event_type string, value double"
    schema = f"{fields}, trace_id string, timestamp bigint"
    return lines.select(F.from_json("record", schema).alias("r")).select("r.*")


def text_lists(spark, sf_dir):
    value = F.col("value").cast("string")
    odd = F.when(F.col("event_id") % 3 == 0, F.lit("NaN")).otherwise(value)
    bad = F.when(F.col("event_id") % 5 == 0, F.lit("bad1")).otherwise(F.lit("-Inf"))
    gone = F.when(F.col("event_id") % 4 == 0, F.lit("Inf")).otherwise(F.lit("2.5e1"))
    texts = F.when(F.col("event_id") % 7 == 0, F.array().cast("array<string>")).otherwise(
        F.array(odd, bad, gone)
    )
    average = avg_of_text_list(texts)
    return events(spark, sf_dir).select("event_id", F.round(average, 6).alias("text_avg"))


def ingest(spark, sf_dir):
    return _summary(A.ingest_summary(audit_table(spark, sf_dir)))


def _summary(total: DataFrame) -> DataFrame:
    return total.select(
        "events",
        F.col("first_at").cast("timestamp_ntz").alias("first_at"),
        F.col("last_at").cast("timestamp_ntz").alias("last_at"),
        F.round("per_second", 9).alias("per_second"),
    )


def latencies(spark, sf_dir):
    """Arrival in the log minus event time, in seconds."""
    rows = valid_events(parse_events(log(spark, sf_dir), arrival_seconds()))
    delay = (F.unix_micros("arrived_at") - F.col("timestamp") * F.lit(1_000_000)) / F.lit(1e6)
    found = A.latency_percentiles(rows.select(delay.alias("delay")), "delay")
    return found.select("p", F.round("value", 6).alias("value"))


def value_percentiles(spark, sf_dir):
    found = A.latency_percentiles(events(spark, sf_dir), "value", (0.0, 0.25, 0.5, 0.95, 0.99, 1.0))
    return found.select("p", F.round("value", 6).alias("value"))


def counts(spark, sf_dir):
    return A.event_counts(audit_table(spark, sf_dir))


def recovery(spark, sf_dir):
    found = A.recovery_time(audit_table(spark, sf_dir), RECOVERY_START)
    return found.select(
        F.col("first_row_at").cast("timestamp_ntz").alias("first_row_at"),
        F.round("recovery_seconds", 6).alias("recovery_seconds"),
    )


def _seen(found: DataFrame) -> DataFrame:
    return found.select("trace_id", "user_id", "event_type", "is_anomaly")


def _written_audit(spark, sf_dir):
    """The audit table as it is stored: lookups skip what its layout rules out."""
    folder = f"{shared_dir(spark)}/audit-{uuid.uuid4().hex}"
    write_audit(audit_table(spark, sf_dir), folder, batch_id=0)
    return read_table(spark, folder, AUDIT_SCHEMA)


def by_trace(spark, sf_dir):
    return _seen(A.lookup_trace(_written_audit(spark, sf_dir), "shared-view"))


def by_user(spark, sf_dir):
    return _seen(A.lookup_user(_written_audit(spark, sf_dir), "7", "click"))


def without_baseline(spark, sf_dir):
    return _seen(A.no_baseline(audit_table(spark, sf_dir)))


def affinity(spark, sf_dir):
    return R.affinity_violations(log(spark, sf_dir))


def _with_loss(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """All valid events, and the audit table of a run that never saw one partition."""
    raw = log(spark, sf_dir)
    published = stage(valid_events(parse_events(raw, arrival_seconds())), "valid")
    return published, outcome(raw.filter(F.col("partition") != LOST_PARTITION)).audit


def missing(spark, sf_dir):
    published, stored = _with_loss(spark, sf_dir)
    return R.missing_events(published, stored).select("partition", "offset", "trace_id")


def complete(spark, sf_dir):
    published, stored = _with_loss(spark, sf_dir)
    return R.completeness(published, stored, phase="event_type")


def replay(spark, sf_dir):
    raw = log(spark, sf_dir)
    first = outcome(raw)
    before = stage(first.audit, "audit")
    # The log and its arrival times are the same, so are its typed rows; all else is done again.
    again = outcome(raw, parsed=first.parsed, stored=before.select("trace_id")).audit
    return R.replay_report(before, before.unionByName(again))


def score_diff(spark, sf_dir):
    rows = measures(spark, sf_dir)
    a = surge_scores(rows).select("event_id", "is_anomaly")
    b = surge_scores(rows, params=EngineParams(multiplier=2.0)).select("event_id", "is_anomaly")
    return R.diff_scores(a, b)


def spans_with_rows(spark, sf_dir):
    published, stored = _with_loss(spark, sf_dir)
    spans = published.select("partition", "offset", F.col("trace_id").alias("idempotency_key"))
    joined = R.correlate(spans, stored)
    return joined.select("partition", "offset", "idempotency_key", "persisted", "is_anomaly")


def history_range(spark, sf_dir):
    """Write the log, then read a stretch of it back by partition and offset."""
    folder = f"{shared_dir(spark)}/log-{uuid.uuid4().hex}"
    log(spark, sf_dir).write.parquet(folder)
    lo, hi = {p: 4 * p for p in range(6)}, {0: 400, 1: 4000, 2: 400_000}
    return read_events_range(spark, folder, lo, hi).select("partition", "offset", "key", "value")


def messages(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("user_id"), "event_type", "value"
    )
    return keyed_messages(rows)


def streamed_scores(spark, sf_dir):
    """The events written in three steps; the query is stopped and started again in between."""
    return _streamed(spark, measures(spark, sf_dir), copies=False)


def streamed_copies(spark, sf_dir):
    """The same, with one event in seven twice in its step and one in eleven again in the next."""
    return _streamed(spark, measures(spark, sf_dir), copies=True)


def _streamed(spark, rows, copies, **options):
    return _scores(_stream_out(spark, rows, copies, **{"dedup": "event_id", **options}))


def _stream_out(spark, rows, copies, **options):
    configure_state(spark)
    late = None
    home = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    cuts = [None, *STREAM_CUTS, None]
    for lo, hi in zip(cuts, cuts[1:]):
        part = rows
        if lo is not None:
            part = part.filter(F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
        if hi is not None:
            part = part.filter(F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
        step = part
        if copies:
            step = step.unionByName(part.filter(F.col("event_id") % 7 == 3))
            step = step if late is None else step.unionByName(late)
            late = part.filter(F.col("event_id") % 11 == 5)
        step.write.mode("append").parquet(f"{home}/in")
        source = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
        scored = score_stream(source, order=("ts", "event_id"), **options)
        query = (
            scored.writeStream.format("parquet")
            .option("path", f"{home}/out")
            .option("checkpointLocation", f"{home}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.parquet(f"{home}/out")


def live_audit(spark, sf_dir):
    """The raw log in three steps through the live job, restarted in between."""
    raw = log(spark, sf_dir)
    home = f"{shared_dir(spark)}/live-{uuid.uuid4().hex}"
    top = raw.agg(F.max("offset")).first()[0]
    cuts = [0, top // 3, 2 * top // 3, top + 1]
    for lo, hi in zip(cuts, cuts[1:]):
        step = raw.filter((F.col("offset") >= lo) & (F.col("offset") < hi))
        step.write.mode("append").parquet(f"{home}/log")
        start_live(
            read_events_stream(spark, f"{home}/log"),
            home,
            f"{home}/checkpoint",
            default_ts=arrival_seconds(),
            ingested_at=F.col("arrived_at"),
        ).awaitTermination()
    return _stored_audit(spark, home)


def live_idle_reset(spark, sf_dir):
    """The log in two runs of two batches each; windows and last touches pass from one to the next."""
    raw = log(spark, sf_dir)
    home = f"{shared_dir(spark)}/live-{uuid.uuid4().hex}"
    top = raw.agg(F.max("offset")).first()[0]
    cuts = [0, top // 4, top // 2, 3 * top // 4, top + 1]
    for n, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        run = ("main", "replay")[n // 2]
        step = raw.filter((F.col("offset") >= lo) & (F.col("offset") < hi))
        step.write.mode("append").parquet(f"{home}/log-{run}")
        start_live(
            read_events_stream(spark, f"{home}/log-{run}"),
            home,
            f"{home}/checkpoint-{run}",
            run=run,
            default_ts=arrival_seconds(),
            ingested_at=F.col("arrived_at"),
            start=LiveTables(home).latest_windows(spark, "main"),
            idle_reset=IDLE_SECONDS,
            touched=F.timestamp_seconds(F.col("offset") * CLOCK_SECONDS),
        ).awaitTermination()
    return _stored_audit(spark, home)


def live_new_run(spark, sf_dir):
    """Half of the log, then all of it under a new checkpoint that takes the windows over."""
    raw = log(spark, sf_dir)
    home = f"{shared_dir(spark)}/live-{uuid.uuid4().hex}"
    half = raw.agg(F.max("offset")).first()[0] // 2
    for run, step in (("main", F.col("offset") < half), ("replay", F.col("offset") >= half)):
        raw.filter(step).write.mode("append").parquet(f"{home}/log")
        start_live(
            read_events_stream(spark, f"{home}/log"),
            home,
            f"{home}/checkpoint-{run}",
            run=run,
            default_ts=arrival_seconds(),
            ingested_at=F.col("arrived_at"),
            start=LiveTables(home).latest_windows(spark, "main"),
        ).awaitTermination()
    return _stored_audit(spark, home)


def live_sinks(spark, sf_dir):
    """What the live job wrote to its reject, response and alert tables, read back."""
    home = f"{shared_dir(spark)}/live-{uuid.uuid4().hex}"
    log(spark, sf_dir).write.parquet(f"{home}/log")
    start_live(read_events_stream(spark, f"{home}/log"), home, f"{home}/checkpoint", default_ts=arrival_seconds()).awaitTermination()
    return _sink_rows(spark, home)


def _sink_rows(spark, home):
    bad, told, raised = (LiveTables(home).committed(spark, t) for t in ("rejects", "responses", "alerts"))
    place = F.concat_ws(":", "partition", "offset")
    return (
        bad.select(F.lit("rejects").alias("sink"), place.alias("row_key"), F.col("reject_reason").alias("detail"))
        .unionByName(told.select(F.lit("responses").alias("sink"), F.col("trace_id").alias("row_key"), F.col("is_anomaly").cast("string").alias("detail")))
        .unionByName(raised.select(F.lit("alerts").alias("sink"), F.col("trace_id").alias("row_key"), F.concat_ws("/", "user_id", "event_type").alias("detail")))
    )


def _live_with_failure(spark, sf_dir, again):
    """Half of the log, then the rest in a batch that dies ahead of the audit sink; with ``again`` it is retried."""
    raw = log(spark, sf_dir)
    home = f"{shared_dir(spark)}/live-{uuid.uuid4().hex}"
    half = raw.agg(F.max("offset")).first()[0] // 2

    def attempt(before_write=None):
        query = start_live(
            read_events_stream(spark, f"{home}/log"),
            home,
            f"{home}/checkpoint",
            default_ts=arrival_seconds(),
            ingested_at=F.col("arrived_at"),
            before_write=before_write,
        )
        query.awaitTermination()

    def die(sink, batch_id):
        if sink == "audit":
            raise OSError(f"the writer of batch {batch_id} was lost")

    raw.filter(F.col("offset") < half).write.mode("append").parquet(f"{home}/log")
    attempt()
    raw.filter(F.col("offset") >= half).write.mode("append").parquet(f"{home}/log")
    try:
        attempt(die)
    except StreamingQueryException:
        if again:
            attempt()
        return home
    raise RuntimeError("the batch was to fail")


def live_commit_record(spark, sf_dir):
    """What readers see after a batch died between two sinks: the batches before it, in every table."""
    home = _live_with_failure(spark, sf_dir, again=False)
    audit = LiveTables(home).audit(spark)
    stored = audit.select(F.lit("audit").alias("sink"), F.col("trace_id").alias("row_key"), F.col("is_anomaly").cast("string").alias("detail"))
    return _sink_rows(spark, home).unionByName(stored)


def live_failed_batch(spark, sf_dir):
    """The audit rows after the batch that died was done again from the same offsets."""
    return _stored_audit(spark, _live_with_failure(spark, sf_dir, again=True))


# Root of the merged live run per application and scale: two queries read it.
_MERGED_RUNS: dict[tuple[str, str], str] = {}


def _many_batches(spark, sf_dir):
    """The log as nine batches, merged three at a time."""
    place = (spark.sparkContext.applicationId, sf_dir)
    if place in _MERGED_RUNS:
        return _MERGED_RUNS[place]
    raw = log(spark, sf_dir)
    home = f"{shared_dir(spark)}/live-{uuid.uuid4().hex}"
    top = raw.agg(F.max("offset")).first()[0] + 1
    for k in range(9):  # files one after the other: the stream takes them by age
        step = (F.col("offset") >= k * top // 9) & (F.col("offset") < (k + 1) * top // 9)
        raw.filter(step).coalesce(1).write.mode("append").parquet(f"{home}/log")
    start_live(
        read_events_stream(spark, f"{home}/log", files_per_trigger=1),
        home,
        f"{home}/checkpoint",
        default_ts=arrival_seconds(),
        ingested_at=F.col("arrived_at"),
        fan_in=3,
    ).awaitTermination()
    levels = [p.level for p in LiveTables(home).log(spark).state().of("audit")]
    if levels != [2]:
        raise RuntimeError(f"nine batches should have become one folder, not {levels}")
    _MERGED_RUNS[place] = home
    return home


def live_merged_audit(spark, sf_dir):
    return _stored_audit(spark, _many_batches(spark, sf_dir))


def ingest_recorded(spark, sf_dir):
    """The ingest summary from the commit records of a live run: no audit row is read."""
    return _summary(recorded_summary(LiveTables(_many_batches(spark, sf_dir)).log(spark)))


def unseen_bucketed(spark, sf_dir):
    """``new_only`` against keys that were stored in nine batches and merged; only buckets that may match are read."""
    valid = stage(valid_events(parse_events(log(spark, sf_dir), arrival_seconds())), "valid")
    commits = CommitLog(spark, f"{shared_dir(spark)}/keys-{uuid.uuid4().hex}")
    store = KeyStore(commits, buckets=16)
    seen = valid.filter(F.col("partition") != LOST_PARTITION).groupBy("trace_id").agg(F.min("offset").alias("first"))
    seen = stage(seen.withColumn("batch", F.pmod("first", F.lit(9))), "seen")
    for batch in range(9):
        keys = seen.filter(F.col("batch") == batch)
        commits.commit("main", batch, store.write(keys, keys.count(), "main", batch))
        store.merge(fan_in=4)
    return store.new_only(valid).select("partition", "offset", "trace_id")


def streamed_idle(spark, sf_dir):
    """Keyed state with windows that a long gap in the events' own time makes forgotten, over restarts."""
    rows = measures(spark, sf_dir).withColumn("at", F.col("ts").cast("timestamp"))
    return _streamed(spark, rows, copies=True, idle_reset=IDLE_SECONDS, touched="at")


def streamed_first_wins(spark, sf_dir):
    """Keyed state in which the first of a key's copies wins and repeats are scored, over restarts.

    A third of the rows share one key, some have none; a long gap makes a window forgotten.
    """
    keyed = F.when(F.col("event_id") % 17 == 0, "").when(F.col("event_id") % 3 == 0, "copied")
    rows = measures(spark, sf_dir).withColumns(
        {
            "at": F.col("ts").cast("timestamp"),
            "trace_id": keyed.otherwise(F.concat(F.lit("k"), F.col("event_id") % 1000)),
        }
    )
    scored = _stream_out(spark, rows, False, dedup="trace_id", duplicates="score", idle_reset=IDLE_SECONDS, touched="at")
    return scored.select("event_id", "user_id", "rolling_avg", "is_anomaly", "inserted")


def recorded_delays(spark, sf_dir):
    """Percentiles of the delay from the sketches in the commit records, held against the rows' own ranks."""
    home = _many_batches(spark, sf_dir)
    answers = delay_percentiles(LiveTables(home).log(spark)).collect()  # a row per probability
    delay = (F.unix_micros("ingested_at") - F.unix_micros("event_timestamp")) / 1e6
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    rows = [
        F.struct(
            F.lit(a["p"]).alias("p"),
            F.lit(a["events"]).cast("bigint").alias("events"),
            (share(delay < a["value"]) - RANK_ERROR <= a["p"]).alias("low"),
            (share(delay <= a["value"]) + RANK_ERROR >= a["p"]).alias("high"),
        )
        for a in answers
    ]
    ranked = LiveTables(home).audit(spark).agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    return ranked.select("p", "events", (F.col("low") & F.col("high")).alias("within_bound"))


def _stored_audit(spark, home):
    stored = LiveTables(home).audit(spark)
    return stored.select(
        "user_id",
        "event_type",
        F.col("event_value").cast("double").alias("event_value"),
        F.col("rolling_avg").cast("double").alias("rolling_avg"),
        "is_anomaly",
        "trace_id",
        F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
    )


QUERIES = {
    "surge_scores": surge,
    "surge_scores_low_fallback": surge_low_fallback,
    "surge_scores_shifted": surge_shifted,
    "surge_scores_hot_user": surge_hot_user,
    "surge_scores_hot_two_levels": surge_hot_two_levels,
    "surge_scores_resumed": surge_resumed,
    "idle_reset_scores": idle_reset,
    "idle_reset_resumed": idle_reset_resumed,
    "preceding_avg": plain_average,
    "preceding_avg_hot_user": plain_average_hot_user,
    "static_scores": static,
    "window_snapshot": snapshot,
    "parsed_events": parsed,
    "rejects": rejected,
    "reject_summary": reject_report,
    "first_wins": first_arrivals,
    "first_wins_hot_key": first_arrivals_hot_key,
    "new_only": unseen,
    "process_responses": responses,
    "response_rows": response_rows,
    "fallback_key": key_format,
    "repartition_by_key": key_places,
    "audit_rows": audit_rows,
    "alerts": alerts,
    "alert_records": alert_log,
    "text_list_avg": text_lists,
    "ingest_summary": ingest,
    "latency_percentiles": latencies,
    "value_percentiles": value_percentiles,
    "event_counts": counts,
    "recovery_time": recovery,
    "lookup_trace": by_trace,
    "lookup_user": by_user,
    "no_baseline": without_baseline,
    "affinity_violations": affinity,
    "missing_events": missing,
    "completeness": complete,
    "replay_report": replay,
    "diff_scores": score_diff,
    "correlate": spans_with_rows,
    "history_range": history_range,
    "keyed_messages": messages,
    "stream_scores": streamed_scores,
    "stream_scores_copies": streamed_copies,
    "live_audit_rows": live_audit,
    "live_new_run": live_new_run,
    "live_idle_reset": live_idle_reset,
    "live_sinks": live_sinks,
    "live_commit_record": live_commit_record,
    "live_failed_batch": live_failed_batch,
    "live_merged_audit": live_merged_audit,
    "ingest_summary_recorded": ingest_recorded,
    "new_only_bucketed": unseen_bucketed,
    "stream_idle_scores": streamed_idle,
    "stream_first_wins": streamed_first_wins,
    "latency_percentiles_recorded": recorded_delays,
}
