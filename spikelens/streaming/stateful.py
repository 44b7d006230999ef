"""Scores as one streaming query: keyed state per user, de-duplication ahead of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spikelens.operators.scan import advance, window_of
from spikelens.params import EngineParams

# Marks the rows that carry the least place of a new key.
_FIRST = "_first"
# A user's name, then its number within its bucket, and the bucket's number.
_USER, _BUCKET = "_user", "_bucket"
# Keyed state is held for so many buckets of users: a call of Python per user would cost far more than its events.
BUCKETS = 4096
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure_state(spark: SparkSession) -> SparkSession:
    """Keep state on disk: the set of seen keys has no bound and must not live on the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def score_stream(
    events: DataFrame,
    key: str = "user_id",
    order: tuple = ("offset", "partition"),
    value: str = "value",
    params: EngineParams = EngineParams(),
    dedup: str | None = "trace_id",
    idle_reset: float | None = None,
    touched: str | None = None,
    lateness: float | None = None,
    duplicates: str = "drop",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Add ``rolling_avg`` and ``is_anomaly`` to a stream of valid events.

    ``dedup`` drops repeats of a key for good, across batches; among copies that arrive in one
    batch any may stay. With ``duplicates="score"`` the first of them by ``order`` wins, across users: all
    rows come out, with ``inserted`` as ``first_wins`` gives it, repeats are scored but never enter a window,
    and they keep it alive. Rows without a key are inserted always. The least place of each key is found on
    both sides of a shuffle of keys and places; rows are not shuffled by key. ``idle_reset`` seconds of
    processing time without an event forget a user's window; leave it out of replays, and with an
    available-now trigger turn ``spark.sql.streaming.noDataMicroBatches.enabled`` off, as a query
    with a time-out otherwise never ends. The state of all users of one of ``buckets`` is read and written together,
    and their rows of one batch are sorted in memory: bound the batch at the source, and raise ``buckets`` with the
    number of users. A checkpoint holds for the number it began with.
    With ``touched``, a timestamp column that says when an event was handled, gaps are measured on it instead,
    within a batch as well, and a replay gives what the first run gave. Its watermark, ``lateness`` seconds
    (by default ``idle_reset``) behind the newest event, tells which windows are overdue and leave the state;
    an event that comes in a later batch than one so much newer is dropped.
    """
    if duplicates not in ("drop", "score"):
        raise ValueError("duplicates are dropped or scored")
    strict = duplicates == "score" and dedup is not None
    columns = events.columns
    schema = T.StructType(
        events.schema.fields
        + [T.StructField("rolling_avg", T.DoubleType()), T.StructField("is_anomaly", T.BooleanType())]
        + ([T.StructField("inserted", T.BooleanType())] if strict else [])
    )
    # The users of a bucket with their windows: one entry per user in each list.
    state_schema = T.StructType(
        [
            T.StructField("users", T.ArrayType(T.StringType())),
            T.StructField("windows", T.ArrayType(T.ArrayType(T.DoubleType()))),
            T.StructField("touched", T.ArrayType(T.LongType())),
        ]
    )
    # Processing time comes in milliseconds, the column in microseconds.
    unit = 1_000 if touched is None else 1_000_000
    idle = None if idle_reset is None else int(idle_reset * unit)

    def keep(state: GroupState, held: dict, seen: set) -> None:
        """Store the windows; those that are overdue go, unless their user was in the batch."""
        if idle is not None:
            now = state.getCurrentProcessingTimeMs() if touched is None else state.getCurrentWatermarkMs()
            due = {u: last + idle if touched is None else (last + idle) // 1000 + 1 for u, (_, last) in held.items()}
            held = {u: kept for u, kept in held.items() if u in seen or due[u] > now}
        if not held:
            state.remove()
            return
        state.update((list(held), [w for w, _ in held.values()], [last for _, last in held.values()]))
        if idle is not None:
            first = max(min(due[u] for u in held), now + 1)
            if touched is None:
                state.setTimeoutDuration(first - now)
            else:
                state.setTimeoutTimestamp(first)

    def per_bucket(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {}
        if state.exists:
            users, windows, lasts = state.get
            held = {u: (list(w), last) for u, w, last in zip(users, windows, lasts)}
        if state.hasTimedOut:
            keep(state, held, set())
            return
        rows = pd.concat(list(frames), ignore_index=True)
        rows[_USER], names = pd.factorize(rows[_USER], use_na_sentinel=False)
        names = [None if pd.isna(name) else name for name in names]
        rows = rows.sort_values([_USER, *order], ignore_index=True)
        live = None
        if strict:
            marks, rows = rows[rows[_FIRST]], rows[~rows[_FIRST]].reset_index(drop=True)
            if rows.empty:
                return
            live = _inserted(rows, marks, dedup, [*order, _USER])
        if idle is None:
            moments = np.zeros(len(rows), np.int64)
        elif touched is None:
            moments = np.full(len(rows), state.getCurrentProcessingTimeMs(), np.int64)
        else:
            moments = rows[touched].to_numpy("datetime64[us]").astype(np.int64)
        values = rows[value].astype("float64").fillna(0.0).to_numpy()
        averages, limits = np.full(len(rows), np.nan), np.zeros(len(rows))
        codes = rows[_USER].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
        seen = set()
        for lo, hi in zip(edges, edges[1:]):
            user = names[codes[lo]]
            kept, last = held.get(user, (None, moments[lo]))
            # A user with new rows is never timed out, so an overdue window is dropped here.
            gaps = [] if idle is None else np.diff(moments[lo:hi], prepend=last) >= idle
            cuts = np.flatnonzero(gaps).tolist()
            own, window = slice(lo, hi), window_of(kept, params)
            advance(values[own], None if live is None else live[own], cuts, window, params, averages[own], limits[own])
            held[user] = (list(window), int(moments[hi - 1]))
            seen.add(user)
        keep(state, held, seen)
        scored = rows[columns].copy()
        scored["rolling_avg"] = averages
        scored["is_anomaly"] = values > limits
        if strict:
            scored["inserted"] = live
        yield scored

    timeout = GroupStateTimeout.NoTimeout
    if idle is not None:
        timeout = GroupStateTimeout.ProcessingTimeTimeout if touched is None else GroupStateTimeout.EventTimeTimeout
    if idle is not None and touched is not None:
        events = events.withWatermark(touched, f"{int(1000 * (idle_reset if lateness is None else lateness))} milliseconds")
    if strict:
        named = list(dict.fromkeys([dedup, key, *order, *([] if touched is None else [touched])]))
        once = _with_first_places(events, dedup, named, [*order, key])
    else:
        once = events if dedup is None else events.dropDuplicates([dedup])
    # The user without a name has a bucket of its own: numbers next to nulls would not stay whole.
    bucket = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)))
    placed = once.withColumns({_USER: F.col(key).cast("string"), _BUCKET: bucket.cast("long")})
    return placed.groupBy(_BUCKET).applyInPandasWithState(per_bucket, schema, state_schema, "append", timeout)


def _with_first_places(events: DataFrame, dedup: str, named: list[str], order: list[str]) -> DataFrame:
    """All rows, and one more (``_FIRST``) for each key never seen before, with its least place in the batch.

    A partition holds one lean row per key at most, so a frequent key is combined before the shuffle.
    """

    def least(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for frame in frames:
            best = frame if best is None else pd.concat([best, frame], ignore_index=True)
            best = best.sort_values(order, kind="stable").drop_duplicates(dedup)
        if best is not None:
            yield best

    keyed = events.filter(F.col(dedup).isNotNull() & (F.col(dedup).cast("string") != "")).select(*named)
    once = keyed.mapInPandas(least, keyed.schema).repartition(dedup).mapInPandas(least, keyed.schema)
    fresh = once.dropDuplicates([dedup]).withColumn(_FIRST, F.lit(True))
    return events.withColumn(_FIRST, F.lit(False)).unionByName(fresh, allowMissingColumns=True)


def _inserted(rows: pd.DataFrame, marks: pd.DataFrame, dedup: str, order: list[str]) -> np.ndarray:
    """Which of a user's rows enter: those without a key, and the first one at the place noted for a new key."""
    place = [dedup, *order]
    keys = rows[dedup]
    blank = (keys.isna() | (keys.astype(str) == "")).to_numpy()
    noted = set(marks[place].itertuples(index=False, name=None))
    at_mark = np.fromiter((p in noted for p in rows[place].itertuples(index=False, name=None)), bool, len(rows))
    return blank | (at_mark & ~rows.duplicated(place).to_numpy())
