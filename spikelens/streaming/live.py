"""The whole job as a stream: strict first-wins, windows carried from batch to batch, four sinks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spikelens.operators.dedup import first_wins
from spikelens.operators.hot import hot_keys
from spikelens.operators.parse import lean, parse_events, rejects, valid_events
from spikelens.operators.projections import alert_record, to_alerts, to_audit, to_responses
from spikelens.operators.surge import surge_scores
from spikelens.operators.windows import window_snapshot
from spikelens.params import EngineParams
from spikelens.plans.process import ARRIVAL
from spikelens.session import configure
from spikelens.sources import sketches
from spikelens.sources.commits import FAN_IN, CommitLog, Part
from spikelens.sources.key_store import KeyStore
from spikelens.sources.tables import (
    KEY_FILTER,
    read_table,
    stage,
    write_alerts,
    write_audit,
    write_batch,
    write_rejects,
)
from spikelens.streaming.stateful import configure_state

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_value", T.DecimalType(10, 2)),
        T.StructField("rolling_avg", T.DecimalType(10, 2)),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)
WINDOW_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("window", T.ArrayType(T.DoubleType())),
        T.StructField("touched", T.TimestampType()),
    ]
)

# Every so many batches all windows are written, so that readers need not go back further.
COMPACT_EVERY = 50
CLOCK = "_handled_at"
ADAPTIVE = "spark.sql.adaptive.enabled"


@dataclass(frozen=True)
class LiveTables:
    """The folders of one deployment."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, self.root)

    def audit(self, spark: SparkSession) -> DataFrame | None:
        """Committed audit rows, or None before the first commit; merged folders are read in place of the batches'."""
        return self.log(spark).read("audit", AUDIT_SCHEMA)

    def committed(self, spark: SparkSession, table: str) -> DataFrame | None:
        """Committed rows of ``alerts``, ``responses`` or ``rejects``."""
        return self.log(spark).read(table)

    def window_path(self, run: str, batch_id: int) -> str:
        return f"{self.path('windows')}/{run}-from-{batch_id - batch_id % COMPACT_EVERY}"

    def windows(
        self, spark: SparkSession, run: str, before: int, users: DataFrame | None = None
    ) -> DataFrame | None:
        """Each user's window after the batches below ``before``: the newest written one.

        With ``users`` the others are left out ahead of the shuffle.
        """
        if before == 0:
            return None
        path = self.window_path(run, before - 1)
        written = read_table(spark, path, WINDOW_SCHEMA, run, before)
        if written is None:
            return None
        if users is not None:
            written = written.join(users, "user_id", "left_semi")
        return written.groupBy("user_id").agg(
            F.max_by("window", "batch_id").alias("window"), F.max_by("touched", "batch_id").alias("touched")
        )

    def latest_windows(self, spark: SparkSession, run: str) -> DataFrame | None:
        """Each user's window after the last committed batch of a run that has ended."""
        last = self.log(spark).state().done.get(run)
        return None if last is None else self.windows(spark, run, last + 1)


def _with_new_keys(parsed: DataFrame) -> DataFrame:
    """All rows, and one more row (``_new``) for each valid key the query has never seen.

    The keys live in the state store: a batch costs what its own keys cost, not what the history
    holds, and the rows themselves stay out of the state.
    """
    keys = parsed.filter(F.col("reject_reason").isNull()).select("trace_id")
    fresh = keys.dropDuplicates(["trace_id"]).withColumn("_new", F.lit(True))
    return parsed.withColumn("_new", F.lit(False)).unionByName(fresh, allowMissingColumns=True)


def _flag(valid: DataFrame, fresh: DataFrame) -> DataFrame:
    """``inserted``: the first arrival in the batch of a key that is new.

    New keys meet the rows in the one shuffle by key that ``first_wins`` needs anyway.
    """
    return first_wins(valid, order=ARRIVAL, fresh=fresh)


def _spells(scored: DataFrame, start: DataFrame | None, idle_reset: float) -> DataFrame:
    """Per user ``touched``, when it was last seen, and ``since``: where its last long gap ended, if it had one.

    Touches are first combined per user and stretch of ``idle_reset`` seconds, as two touches that far
    apart never share one; a frequent user so brings a few rows and not its events.
    """
    micros = int(idle_reset * 1_000_000)
    seen = scored.select("user_id", F.unix_micros(CLOCK).alias("_at"))
    if start is not None:
        seen = seen.unionByName(start.select("user_id", F.unix_micros("touched").alias("_at")))
    cells = seen.groupBy("user_id", F.floor(F.col("_at") / micros).alias("_cell")).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last")
    )
    before = F.lag("_last").over(Window.partitionBy("user_id").orderBy("_cell"))
    gaps = cells.withColumn("_gap", F.col("_first") - before >= micros)
    return gaps.groupBy("user_id").agg(
        F.timestamp_micros(F.max("_last")).alias("touched"),
        F.timestamp_micros(F.max(F.when(F.col("_gap"), F.col("_first")))).alias("since"),
    )


def _windows_with_touches(
    scored: DataFrame, start: DataFrame | None, params: EngineParams, idle_reset: float
) -> DataFrame:
    """Windows of all users of the batch and of ``start``, without what a long gap made them forget."""
    spells = _spells(scored, start, idle_reset)
    ended = spells.filter(F.col("since").isNotNull()).select("user_id", "since")
    recent = scored.join(ended, "user_id", "left").filter(F.col("since").isNull() | (F.col(CLOCK) >= F.col("since")))
    fresh = window_snapshot(recent, order=ARRIVAL, n=params.window, inserted="inserted")
    joined = spells.join(fresh.select("user_id", F.col("window").alias("_fresh")), "user_id", "left")
    empty = F.array().cast("array<double>")
    old = empty
    if start is not None:
        joined = joined.join(start.select("user_id", F.col("window").alias("_old")), "user_id", "left")
        old = F.when(F.col("since").isNull(), F.coalesce("_old", empty)).otherwise(empty)
    window = F.slice(F.concat(F.coalesce("_fresh", empty), old), 1, params.window)
    return joined.select("user_id", window.alias("window"), "touched")


def _windows_after(
    scored: DataFrame, start: DataFrame | None, params: EngineParams, everyone: bool
) -> DataFrame:
    fresh = window_snapshot(scored, order=ARRIVAL, n=params.window, inserted="inserted").select(
        "user_id", F.col("window").alias("_fresh")
    )
    if start is None:
        return fresh.select("user_id", F.col("_fresh").alias("window"))
    empty = F.array().cast("array<double>")
    both = F.concat(F.coalesce("_fresh", empty), F.coalesce("window", empty))
    joined = fresh.join(start, "user_id", "full" if everyone else "left")
    return joined.select("user_id", F.slice(both, 1, params.window).alias("window"))


def _sink(df: DataFrame, write: Callable, tables: LiveTables, table: str, batch_id: int, run: str, at: str | None = None) -> Part:
    """Write one sink's folder of a batch; rows, first and last moment, and delays are summed up as they pass."""
    counts = [F.count(F.lit(1)).alias("rows")]
    if at is not None:
        delay = (F.unix_micros(at) - F.unix_micros("event_timestamp")) / 1e6
        counts += [F.min(at).cast("string").alias("first"), F.max(at).cast("string").alias("last"), sketches.sketch(delay).alias("delays")]
    seen = Observation()
    write(df.observe(seen, *counts), tables.path(table), batch_id, run)
    said = seen.get
    delays = sketches.to_text(said.get("delays"))
    marks = {} if delays is None else {sketches.MARK: delays}
    return Part(table, f"{table}/run={run}/batch_id={batch_id}", run, batch_id, said["rows"], 0, said.get("first"), said.get("last"), marks)


def start_live(
    log: DataFrame,
    root: str,
    checkpoint: str,
    params: EngineParams = EngineParams(),
    run: str = "main",
    default_ts: str | Column | None = None,
    available_now: bool = True,
    ingested_at: Column | None = None,
    start: DataFrame | None = None,
    idle_reset: float | None = None,
    touched: str | Column = "arrived_at",
    before_write: Callable[[str, int], None] | None = None,
    fan_in: int = FAN_IN,
) -> StreamingQuery:
    """Run the log through parsing, first-wins, scoring and the audit, alert and reject sinks.

    Keys of this run are remembered in the query's state; those of other runs are looked up in the key
    store, which reads only buckets that may hold one of the batch's keys. All sinks of a batch become
    visible together, by one commit record written last; offsets move on after it. A batch that failed
    half-way starts again from the same offsets and state and replaces what it wrote; one that was
    committed but not yet ticked off by the checkpoint is not done again. Use a new ``run`` name with every
    new ``checkpoint``: a replay then meets the stored keys and adds nothing.
    ``before_write`` is called with a sink's name and the batch number ahead of each write, for progress
    reports; an exception ends the batch there. Audit and key folders are merged, ``fan_in`` at a time.
    ``start`` (``user_id``, ``window``) gives that run the windows to begin with, for example
    ``LiveTables(root).latest_windows(spark, "main")``; without it every user starts cold.
    With ``idle_reset`` seconds a window is forgotten when the timestamp ``touched``, which says when an
    event was handled and does not fall along a user's arrivals, shows such a gap. Duplicates keep a
    window alive as well, and the last touch is kept from batch to batch and by ``latest_windows``.
    """
    configure_state(log.sparkSession)
    tables = LiveTables(root)
    arriving = _with_new_keys(lean(parse_events(log, default_ts)))
    tables.log(log.sparkSession).own(run, checkpoint)
    begin = None
    if start is not None:
        last = F.col("touched") if "touched" in start.columns else F.lit(None).cast("timestamp").alias("touched")
        begin = stage(start.select("user_id", "window", last), "begin-windows")

    adaptive = log.sparkSession.conf.get(ADAPTIVE)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        commits = tables.log(spark)
        # The stateful step must run once per batch, so its rows are written before they fan out.
        current = tables.path(f"current/{run}")
        batch.write.mode("overwrite").parquet(current)
        if commits.is_done(run, batch_id):  # the state moves on all the same
            return
        # Keyed state turns this off for the whole query; what follows are plain jobs, and a small batch
        # must not be cut into as many tasks and files as the state has partitions.
        stateful = spark.conf.get(ADAPTIVE)
        spark.conf.set(ADAPTIVE, adaptive)
        try:
            settle(spark, commits, spark.read.schema(batch.schema).parquet(current), batch_id)
        finally:
            spark.conf.set(ADAPTIVE, stateful)

    def settle(spark: SparkSession, commits: CommitLog, both: DataFrame, batch_id: int) -> None:
        store = KeyStore(commits)
        rows, fresh = both.filter(~F.col("_new")).drop("_new"), both.filter(F.col("_new"))
        fresh = store.new_only(fresh, without_run=run)
        clock = F.col(touched) if isinstance(touched, str) else touched
        valid = valid_events(rows).drop("topic", "key").withColumn(CLOCK, clock)
        # Only users of this batch need their window; the rest is not shuffled.
        users = valid.select("user_id").distinct()
        if batch_id == 0:
            known = begin
            entry = None if begin is None else begin.join(users, "user_id", "left_semi")
        else:
            known = tables.windows(spark, run, batch_id)
            entry = tables.windows(spark, run, batch_id, users)
        scored = surge_scores(
            _flag(valid, fresh),
            order=ARRIVAL,
            params=params,
            inserted="inserted",
            start=entry,
            hot=hot_keys(valid, "user_id"),
            idle_reset=idle_reset,
            touched=CLOCK,
        )
        # Written like the batch itself: a sink then reads its columns in as many tasks as their size asks for.
        kept = tables.path(f"scored/{run}")
        scored.write.mode("overwrite").parquet(kept)
        scored = spark.read.schema(scored.schema).parquet(kept)
        everyone = batch_id % COMPACT_EVERY == 0
        now = F.lit(datetime.now(timezone.utc)) if ingested_at is None else ingested_at

        def put(table: str, df: DataFrame, write: Callable, at: str | None = None) -> Part:
            if before_write is not None:
                before_write(table, batch_id)
            return _sink(df, write, tables, table, batch_id, run, at)

        parts = [put("rejects", rejects(rows), write_rejects)]
        carried = known if everyone else entry
        if idle_reset is None:
            left = _windows_after(scored, carried, params, everyone)
        else:
            left = _windows_with_touches(scored, carried, params, idle_reset)
        write_batch(left, tables.window_path(run, batch_id), batch_id, run)
        parts.append(put("responses", to_responses(scored), write_batch))
        parts.append(put("alerts", to_alerts(scored).withColumn("record", alert_record()), write_alerts))
        parts.append(put("audit", to_audit(scored, now), write_audit, "ingested_at"))
        parts += store.write(scored.filter("inserted"), parts[-1].rows, run, batch_id)
        commits.commit(run, batch_id, parts, checkpoint)
        commits.merge("audit", AUDIT_SCHEMA, ["user_id"], KEY_FILTER, fan_in)
        store.merge(fan_in)

    writer = arriving.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
