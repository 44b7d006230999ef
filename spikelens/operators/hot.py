"""Finding keys that hold too many rows for one task, and cutting their rows into ordered chunks."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikelens.session import shared_dir

# A key with more rows than this is handled in chunks, by many tasks.
HOT_ROWS = 8_000_000
# Rows per chunk of a hot key.
CHUNK_ROWS = 4_000_000
CHUNK = "_chunk"
# Rows that a key at the limit is expected to have among the rows looked at by ``likely_hot_keys``.
LOOKED_AT = 1_000


@dataclass(frozen=True)
class HotKeys:
    """The hot keys of one DataFrame: at most total rows / limit of them, whatever the data."""

    keys: DataFrame | None
    rows: int = 0

    def __bool__(self) -> bool:
        return self.keys is not None


def hot_keys(df: DataFrame, key: str, limit: int = HOT_ROWS) -> HotKeys:
    """Count rows per key (combined before the shuffle) and keep the keys above ``limit``."""
    heavy = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    found = heavy.collect()
    if not found:
        return HotKeys(None)
    keys = df.sparkSession.createDataFrame(
        [(row[0],) for row in found], df.select(F.col(key).alias("_hot")).schema
    )
    return HotKeys(keys, sum(row["_n"] for row in found))


def likely_hot_keys(df: DataFrame, key: str, place: tuple, limit: int = HOT_ROWS) -> HotKeys:
    """Keys that have about ``limit`` rows or more, for near-unique keys, where counting combines nothing.

    Only every so many rows, chosen by a hash of their ``place``, are counted: a key at the limit has about
    ``LOOKED_AT`` of them, and four fifths of that are asked for. This only chooses how a key is handled:
    all its rows are handled either way, and the result is the same. Small limits count all rows.
    """
    every = max(1, limit // LOOKED_AT)
    if every == 1:
        return hot_keys(df.select(key), key, limit)
    some = df.filter(F.pmod(F.xxhash64(*place), F.lit(every)) == 0).select(key)
    return hot_keys(some, key, 4 * limit // (5 * every))


def cold_rows(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    return _match(df, key, hot, "left_anti") if hot else df


def hot_rows(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    return _match(df, key, hot, "left_semi")


def _match(df: DataFrame, key: str, hot: HotKeys, how: str) -> DataFrame:
    # Bounded broadcast: one row per hot key, of which there are at most rows / limit.
    return df.join(F.broadcast(hot.keys), F.col(key).eqNullSafe(F.col("_hot")), how)


def ordered_chunks(df: DataFrame, order: list, parts: int) -> DataFrame:
    """Range-partition on ``order``, sort, number the partitions and cut the lineage.

    Numbers follow the order, so one key's rows fill consecutive chunks. The checkpoint makes
    the cut points final: later passes see the same chunks even after an executor is lost.
    """
    shared_dir(df.sparkSession)
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return ranged.withColumn(CHUNK, F.spark_partition_id()).checkpoint()


def chunk_count(rows: int, chunk_rows: int) -> int:
    return max(2, math.ceil(rows / chunk_rows))
