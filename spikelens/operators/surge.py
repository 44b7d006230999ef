"""Scores against a window that only holds values accepted earlier.

What enters a user's window depends on the scores before it, so no SQL frame can say it. Rows
are hash-partitioned by user and sorted, and one Arrow pass per task carries the last N accepted
values. A user with more rows than one task should take is cut into ordered chunks instead, see
``_settle``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from spikelens.functions import is_anomaly
from spikelens.operators import hot as H
from spikelens.operators.scan import advance, limit_of, mean, window_of
from spikelens.params import EngineParams

SEED = "_seed"
TOUCHED = "_touched"

# The lowest values of a chunk that are kept with its record.
_LOWS = 64
# Rows of a chunk that is run again on which old and new windows are compared for a meeting point.
_COMPARE_ROWS = 65_536
_COMPARE_STEP = 512
# Windows a chunk is tried from in one pass; more of them wait for the next one.
_TRIES = 6


@dataclass(frozen=True)
class _Scan:
    """Column names and rules a task needs."""

    key: str
    value: str
    params: EngineParams
    inserted: str | None = None
    idle_micros: int | None = None
    seeded: bool = False
    out: tuple = ()


@dataclass
class _Place:
    """Where a task stands in its sorted rows."""

    at: tuple | None = None
    window: object = None
    touched: int | None = None


@dataclass
class _Segment:
    """One user's rows in one chunk, with the window it leaves for every window tried at its start."""

    chunk: int
    first: int | None
    last: int | None
    lows: list
    floor: float
    emptied: bool
    known: dict = field(default_factory=dict)


def static_scores(df: DataFrame, params: EngineParams = EngineParams(), value: str = "value"):
    """Scores with no state at hand: no average, static threshold only. No shuffle."""
    average = F.lit(None).cast("double")
    return df.withColumn("rolling_avg", average).withColumn(
        "is_anomaly", is_anomaly(F.col(value), F.col("rolling_avg"), params)
    )


def surge_scores(
    df: DataFrame,
    key: str = "user_id",
    order: tuple = ("ts", "event_id"),
    value: str = "value",
    params: EngineParams = EngineParams(),
    inserted: str | None = None,
    idle_reset: float | None = None,
    touched: str | None = None,
    start: DataFrame | None = None,
    hot: H.HotKeys | None = None,
    hot_limit: int = H.HOT_ROWS,
    chunk_rows: int = H.CHUNK_ROWS,
) -> DataFrame:
    """Add ``rolling_avg`` (NULL without a baseline) and ``is_anomaly`` to every row.

    ``order`` must order a user's rows totally. Rows whose ``inserted`` flag is false are scored
    but never enter the window. With ``idle_reset`` a window is forgotten when ``touched`` shows
    a gap of at least that many seconds. ``start`` (key, ``window`` array, newest first) gives
    users a window to begin with; its ``touched``, if it has one, tells when the user was last seen.
    A NULL value counts as 0, as a missing one does in the log. ``hot`` passes on users already found to be hot.
    """
    scan = _Scan(
        key=key,
        value=value,
        params=params,
        inserted=inserted,
        idle_micros=None if idle_reset is None else int(idle_reset * 1_000_000),
        seeded=start is not None,
        out=tuple(df.columns),
    )
    schema = T.StructType(
        df.schema.fields
        + [T.StructField("rolling_avg", T.DoubleType()), T.StructField("is_anomaly", T.BooleanType())]
    )
    hot = H.hot_keys(df, key, hot_limit) if hot is None else hot
    rows = df
    if scan.idle_micros is not None:
        rows = rows.withColumn(TOUCHED, _micros(df, touched))
    sorting: list[Column] = [F.col(key), *[F.col(c) for c in order]]
    if start is not None:
        seeds = start.select(F.col(key), F.col("window").cast("array<double>").alias(SEED))
        if scan.idle_micros is not None and "touched" in start.columns:
            last = _micros(start, "touched").alias(TOUCHED)
            seeds = start.select(F.col(key), F.col("window").cast("array<double>").alias(SEED), last)
        rows = rows.withColumn(SEED, F.lit(None).cast("array<double>")).unionByName(
            seeds, allowMissingColumns=True
        )
        sorting.insert(1, F.col(SEED).isNull())
    cold = H.cold_rows(rows, key, hot).repartition(F.col(key)).sortWithinPartitions(*sorting)
    scored = cold.mapInArrow(_score(scan, None), schema)
    if not hot:
        return scored
    chunks = H.ordered_chunks(
        H.hot_rows(rows, key, hot), sorting, H.chunk_count(hot.rows, chunk_rows)
    )
    entries = _settle(chunks, scan)
    return scored.unionByName(chunks.mapInArrow(_score(scan, entries), schema))


def _micros(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    return (F.col(column) * F.lit(1_000_000)).cast("bigint")


def _stretches(batch: pa.RecordBatch, scan: _Scan, place: _Place, chunk: int | None):
    """(start, stop, begins) of each run of equal keys; moves ``place.at`` along."""
    keys = batch.column(scan.key)
    codes = keys.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
    for start, stop in zip(edges, edges[1:]):
        at = (chunk, keys[start].as_py())
        begins = at != place.at
        if begins:
            place.at, place.touched = at, None
        yield start, stop, begins


def _columns(batch: pa.RecordBatch, scan: _Scan):
    """Values, live flags and touch times of a batch as numpy arrays."""
    values = batch.column(scan.value).cast(pa.float64()).fill_null(0.0)
    live = None
    if scan.inserted is not None:
        live = batch.column(scan.inserted).fill_null(False).to_numpy(zero_copy_only=False)
    touched = None
    if scan.idle_micros is not None:
        touched = batch.column(TOUCHED).fill_null(0).to_numpy(zero_copy_only=False)
    return values.to_numpy(zero_copy_only=False), live, touched


def _cuts(touched, start: int, stop: int, place: _Place, scan: _Scan) -> list[int]:
    """Positions, counted from ``start``, before which the user was idle for too long."""
    if touched is None or start >= stop:
        return []
    times = touched[start:stop]
    before = np.empty_like(times)
    before[0] = times[0] if place.touched is None else place.touched
    before[1:] = times[:-1]
    place.touched = int(times[-1])
    return np.flatnonzero(times - before >= scan.idle_micros).tolist()


def _seed_at(batch: pa.RecordBatch, scan: _Scan, row: int):
    if not scan.seeded:
        return None
    seed = batch.column(SEED)[row]
    return seed.as_py() if seed.is_valid else None


def _seed_touch(batch: pa.RecordBatch, scan: _Scan, row: int) -> int | None:
    return None if scan.idle_micros is None else batch.column(TOUCHED)[row].as_py()


def _score(scan: _Scan, entries: dict | None):
    """Arrow pass that emits the scored rows. ``entries``: window per (chunk, key) to begin with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _Place()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            chunk = None if entries is None else batch.column(H.CHUNK)[0].as_py()
            values, live, touched = _columns(batch, scan)
            averages = np.full(len(values), np.nan)
            limits = np.zeros(len(values))
            for start, stop, begins in _stretches(batch, scan, place, chunk):
                if begins:
                    place.window = window_of((entries or {}).get(place.at), scan.params)
                    seed = _seed_at(batch, scan, start)
                    if seed is not None:
                        place.window = window_of(seed, scan.params)
                        place.touched = _seed_touch(batch, scan, start)
                        start += 1
                advance(
                    values[start:stop],
                    None if live is None else live[start:stop],
                    _cuts(touched, start, stop, place, scan),
                    place.window,
                    scan.params,
                    averages[start:stop],
                    limits[start:stop],
                )
            result = pa.RecordBatch.from_arrays(
                [batch.column(name) for name in scan.out]
                + [pa.array(averages, mask=np.isnan(averages)), pa.array(values > limits)],
                names=[*scan.out, "rolling_avg", "is_anomaly"],
            )
            yield result.filter(batch.column(SEED).is_null()) if scan.seeded else result

    return run


def _settle(chunks: DataFrame, scan: _Scan) -> dict:
    """The window each hot user has at the start of each of its chunks.

    All chunks run at once from an empty window. Then every open chunk is tried from all windows that
    the chunk before it is known to leave, and from the one the settled chunks lead to; it remembers
    what each of them becomes. Windows made of the same accepted values are equal, so tries soon
    meet, and data that holds a few levels needs a few passes, however many chunks there are. A
    window that admits only the few lowest values of a chunk is moved past it by its record alone.
    Every pass settles at least one more chunk of each user, hence the result is exact for any data.
    The driver holds a record of at most ``_LOWS`` values and a few windows per chunk and hot user:
    rows / ``CHUNK_ROWS`` plus rows / ``HOT_ROWS`` of them.
    """
    needed = [
        c
        for c in (H.CHUNK, scan.key, scan.value, scan.inserted)
        if c is not None
    ]
    needed += [TOUCHED] if scan.idle_micros is not None else []
    needed += [SEED] if scan.seeded else []
    slim = chunks.select(*dict.fromkeys(needed))
    kind = chunks.schema[scan.key].dataType
    schema = (
        T.StructType()
        .add("chunk", T.IntegerType())
        .add("key", kind)
        .add("first", T.LongType())
        .add("last", T.LongType())
        .add("lows", T.ArrayType(T.DoubleType()))
        .add("floor", T.DoubleType())
        .add("emptied", T.BooleanType())
        .add("exits", T.ArrayType(T.ArrayType(T.DoubleType())))
    )
    records = to_arrow_schema(schema)
    chains: dict = {}
    for row in slim.mapInArrow(_summarise(scan, None, records), schema).collect():
        segment = _Segment(*[row[c] for c in ("chunk", "first", "last", "lows", "floor", "emptied")])
        segment.known[()] = tuple(row["exits"][0])
        chains.setdefault(row["key"], []).append(segment)
    for chain in chains.values():
        chain.sort(key=lambda segment: segment.chunk)
    while True:
        entries, again = {}, {}
        for key, chain in chains.items():
            windows = _walk_chain(chain, scan)
            entries |= {(segment.chunk, key): w for segment, w in zip(chain, windows) if w}
            if len(windows) < len(chain):
                again |= _open_tries(key, chain[len(windows) - 1 : -1], windows[-1], scan)
        if not again:
            return entries
        open_chunks = sorted({chunk for chunk, _ in again})
        rerun = slim.filter(F.col(H.CHUNK).isin(open_chunks)).mapInArrow(
            _summarise(scan, again, records), schema
        )
        exits = {(row["chunk"], row["key"]): row["exits"] for row in rerun.collect()}
        for key, chain in chains.items():
            for segment in chain:
                tried = again.get((segment.chunk, key), ((), ()))[1]
                segment.known.update(zip(tried, map(tuple, exits.get((segment.chunk, key), ()))))


def _walk_chain(chain: list, scan: _Scan) -> list[tuple]:
    """The true entries of a user's segments, up to the first whose exit is still open."""
    entries = [()]
    for before, segment in zip(chain, chain[1:]):
        left = _leaves(before, entries[-1], scan.params)
        if left is None:
            break
        entries.append(_handed_over(before, segment, left, scan))
    return entries


def _leaves(segment: _Segment, entry: tuple, params: EngineParams) -> tuple | None:
    if entry not in segment.known:
        passed = segment.known[()] if segment.emptied else _pass_by(segment, entry, params)
        if passed is None:
            return None
        segment.known[entry] = tuple(passed)
    return segment.known[entry]


def _open_tries(key, chain: list, front: tuple, scan: _Scan) -> dict:
    """(known runs, windows to try) of open segments; ``front`` is the true entry of the first."""
    again = {}
    for before, segment in zip([None, *chain], chain):
        wanted = [front]
        if before is not None:
            wanted += [_handed_over(before, segment, w, scan) for w in dict.fromkeys(before.known.values())]
        tries = [w for w in dict.fromkeys(wanted) if _leaves(segment, w, scan.params) is None]
        if tries:
            # The newest runs are the likeliest to be met.
            again[segment.chunk, key] = ([*segment.known.items()][-_TRIES:], tries[:_TRIES])
    return again


def _handed_over(before: _Segment, segment: _Segment, left: tuple, scan: _Scan) -> tuple:
    idle = (
        scan.idle_micros is not None
        and before.last is not None
        and segment.first is not None
        and segment.first - before.last >= scan.idle_micros
    )
    return () if idle else left


def _pass_by(segment: _Segment, entry: tuple, params: EngineParams) -> list | None:
    """The window after the segment if its lowest values decide that, else None.

    All events but those in ``lows`` are at ``floor`` or above, so while the limit stays below
    ``floor`` only ``lows`` can enter.
    """
    window = window_of(entry, params)
    limit = limit_of(mean(window), params)
    for value in segment.lows:
        if limit >= segment.floor:
            return None
        if value <= limit:
            window.appendleft(value)
            limit = limit_of(mean(window), params)
    return None if limit >= segment.floor else list(window)


class _Lows:
    """The lowest entering values of a segment, in event order, and the floor of all others."""

    def __init__(self):
        self.values = np.empty(0)
        self.floor = np.inf

    def add(self, values) -> None:
        if np.isnan(values).any():
            # Not a number always enters, so no floor holds.
            self.floor = -np.inf
        near = values[values < self.floor]
        if not len(near):
            return
        both = np.concatenate([self.values, near])
        if len(both) > _LOWS:
            order = np.argsort(both, kind="stable")
            self.floor = float(both[order[_LOWS]])
            both = both[np.sort(order[:_LOWS])]
        self.values = both


class _Tries:
    """Windows moved over one segment side by side; equal ones go on as one."""

    def __init__(self, starts: list[tuple], known: list, params: EngineParams):
        self.params = params
        self.exits: dict = dict.fromkeys(starts)
        runs = [(e, window_of(e, params), None) for e in starts]
        runs += [(e, window_of(e, params), left) for e, left in known]
        # [entries that came here, window, exit if a known run is among them]
        self.runs = [[[e] if left is None else [], w, left] for e, w, left in runs]
        self.compared = 0

    @property
    def open(self) -> bool:
        return any(entries for entries, _, _ in self.runs)

    def _meet(self) -> None:
        met: dict = {}
        for entries, window, left in self.runs:
            group = met.setdefault(tuple(window), [[], window, None])
            group[0] += entries
            group[2] = left if left is not None else group[2]
        for entries, _, left in met.values():
            if left is not None:
                self.exits.update(dict.fromkeys(entries, left))
        self.runs = [[[] if left is not None else e, w, left] for e, w, left in met.values()]

    def move(self, values, live, cuts: list[int]) -> None:
        at = 0
        # Segments that are tried again were never emptied, so there are no cuts while comparing.
        while self.open and len(self.runs) > 1 and at < len(values) and self.compared < _COMPARE_ROWS:
            end = at + _COMPARE_STEP
            for _, window, _ in self.runs:
                advance(values[at:end], None if live is None else live[at:end], [], window, self.params)
            self.compared += _COMPARE_STEP
            at = min(end, len(values))
            self._meet()
        if self.compared >= _COMPARE_ROWS:
            self.runs = [run for run in self.runs if run[0]]
        if self.open and at < len(values):
            for _, window, _ in self.runs:
                advance(values[at:], None if live is None else live[at:], cuts, window, self.params)

    def result(self) -> list[list]:
        for entries, window, _ in self.runs:
            self.exits.update(dict.fromkeys(entries, tuple(window)))
        return [list(w) for w in self.exits.values()]


def _summarise(scan: _Scan, again: dict | None, records: pa.Schema):
    """Arrow pass that emits one record per (chunk, key): its time span and its final windows.

    ``again`` holds (known runs, windows to try) of the segments to run once more; others are skipped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _Place()
        done: list[dict] = []
        skip = False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values, live, touched = _columns(batch, scan)
            for start, stop, begins in _stretches(batch, scan, place, batch.column(H.CHUNK)[0].as_py()):
                if begins:
                    task = ([], [()]) if again is None else again.get(place.at)
                    skip = task is None
                    if skip:
                        continue
                    known, starts = task
                    seed = _seed_at(batch, scan, start)
                    if seed is not None:  # the first segment of a user is entered with its seed only
                        place.touched = _seed_touch(batch, scan, start)
                        known, start = [], start + 1
                    tries = _Tries(starts, known, scan.params)
                    if seed is not None:
                        tries.runs = [[starts, window_of(seed, scan.params), None]]
                    done.append(
                        dict(chunk=place.at[0], key=place.at[1], first=None, last=None)
                        | dict(lows=_Lows(), emptied=False, exits=tries)
                    )
                    done[-1]["last"] = place.touched
                if skip or start >= stop:
                    continue
                record = done[-1]
                if touched is not None:
                    if record["first"] is None:
                        record["first"] = int(touched[start])
                    record["last"] = int(touched[stop - 1])
                part = values[start:stop]
                flags = None if live is None else live[start:stop]
                if again is None:
                    record["lows"].add(part if flags is None else part[flags])
                cuts = _cuts(touched, start, stop, place, scan)
                record["emptied"] = record["emptied"] or bool(cuts)
                record["exits"].move(part, flags, cuts)
        if done:
            yield pa.RecordBatch.from_pylist(
                [
                    record
                    | dict(
                        lows=record["lows"].values.tolist(),
                        floor=record["lows"].floor,
                        exits=record["exits"].result(),
                    )
                    for record in done
                ],
                schema=records,
            )

    return run
