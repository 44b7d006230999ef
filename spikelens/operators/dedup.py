"""First arrival per idempotency key wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikelens.operators import hot as H

_MARK = "_stored"


def _has_key(key: str) -> Column:
    return F.col(key).isNotNull() & (F.col(key) != "")


def first_wins(
    df: DataFrame,
    key: str = "trace_id",
    order: tuple = ("offset", "partition"),
    stored: DataFrame | None = None,
    hot_limit: int = H.HOT_ROWS,
    fresh: DataFrame | None = None,
) -> DataFrame:
    """Add ``inserted``: true for the first arrival of each key, across users and partitions.

    Rows without a key are always inserted. ``order`` must order the arrivals totally. Keys found
    in ``stored`` arrived earlier than every row here: they join the same shuffle as rows that
    sort first, so no separate anti-join is needed. With ``fresh``, in place of ``stored``, only keys
    found there, each at most once, are inserted at all; they join in the same way.
    """
    if stored is not None and fresh is not None:
        raise ValueError("keys are told by those stored or by those that are new")
    arrivals = df.withColumn(_MARK, F.lit(False))
    told = stored if fresh is None else fresh
    if told is not None:
        earlier = told.filter(_has_key(key)).select(key, F.lit(True).alias(_MARK))
        arrivals = arrivals.unionByName(earlier, allowMissingColumns=True)
    # A stored or new key comes once, so only the arrivals can make a key frequent.
    hot = H.likely_hot_keys(df.filter(_has_key(key)), key, order, hot_limit)
    # Rows without a key are spread by their place, so they never gather in one task.
    spread = F.when(~F.coalesce(_has_key(key), F.lit(False)), F.xxhash64(*order))
    rank = [F.col(_MARK).desc(), *[F.col(c) for c in order]]
    place = Window.partitionBy(key, spread).orderBy(*rank)
    if fresh is None:
        first = F.row_number().over(place) == 1
    else:  # the row right behind the key's mark
        first = F.lag(_MARK, 1, False).over(place) & ~F.col(_MARK)
    flagged = H.cold_rows(arrivals, key, hot).withColumn("inserted", first | spread.isNotNull())
    if hot:
        flagged = flagged.unionByName(_flag_hot(H.hot_rows(arrivals, key, hot), key, order, fresh is not None))
    return flagged.filter(~F.col(_MARK)).drop(_MARK)


def _flag_hot(rows: DataFrame, key: str, order: tuple, marked_only: bool) -> DataFrame:
    """Rows of hot keys: the first arrival is a combined minimum, and no row is shuffled."""
    place = F.struct((~F.col(_MARK)).alias("late"), *[F.col(c) for c in order])
    if marked_only:  # a key without a mark has no first arrival
        earliest = F.when(F.bool_or(_MARK), F.min(F.when(~F.col(_MARK), place)))
    else:
        earliest = F.min(place)
    first = rows.groupBy(F.col(key).alias("_key")).agg(earliest.alias("_first"))
    # Bounded broadcast: one row per hot key.
    return (
        rows.join(F.broadcast(first), F.col(key) == F.col("_key"))
        .withColumn("inserted", place.eqNullSafe(F.col("_first")))
        .drop("_key", "_first")
    )


def new_only(df: DataFrame, audit: DataFrame, key: str = "trace_id") -> DataFrame:
    """Rows whose key is not stored yet; rows without a key always pass.

    Both sides are shuffled plainly, so adaptive execution can split a key that is frequent in
    ``df``; ``audit`` holds each key once.
    """
    stored = audit.filter(_has_key(key)).select(F.col(key).alias("_stored_key"))
    return df.join(stored, F.col(key) == F.col("_stored_key"), "left_anti")
