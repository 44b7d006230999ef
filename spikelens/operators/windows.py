"""Windows a frame or a top-k per user can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spikelens.operators import hot as H

_HALO = "_halo"


def preceding_avg(
    df: DataFrame,
    key: str = "user_id",
    order: tuple = ("ts", "event_id"),
    value: str = "value",
    n: int = 10,
    hot_limit: int = H.HOT_ROWS,
    chunk_rows: int = H.CHUNK_ROWS,
) -> DataFrame:
    """Add ``preceding_avg``: the mean of the user's last ``n`` values before each row.

    Every value enters, anomalies too. Users too large for one task are averaged chunk by chunk;
    each chunk is given the ``n`` values before it.
    """
    hot = H.hot_keys(df, key, hot_limit)
    frame = Window.partitionBy(key).orderBy(*order).rowsBetween(-n, -1)
    averaged = H.cold_rows(df, key, hot).withColumn("preceding_avg", F.avg(value).over(frame))
    if not hot:
        return averaged
    chunks = H.ordered_chunks(
        H.hot_rows(df, key, hot),
        [F.col(key), *[F.col(c) for c in order]],
        H.chunk_count(hot.rows, chunk_rows),
    )
    return averaged.unionByName(_chunked_avg(chunks, key, order, value, n))


def _chunked_avg(chunks: DataFrame, key: str, order: tuple, value: str, n: int) -> DataFrame:
    columns = [c for c in chunks.columns if c != H.CHUNK]
    # The last n rows and the first row of each chunk: few rows, which suffice to tell what came
    # before a chunk even when chunks in between are shorter than n.
    segment = Window.partitionBy(key, H.CHUNK)
    ends = chunks.select(key, *order, value, H.CHUNK)
    last = ends.withColumn(
        "_r", F.row_number().over(segment.orderBy(*[F.col(c).desc() for c in order]))
    ).filter(F.col("_r") <= n)
    first = ends.withColumn("_r", F.row_number().over(segment.orderBy(*order))).filter(
        F.col("_r") == 1
    )
    edge = (
        last.withColumn("_first", F.lit(False))
        .unionByName(first.withColumn("_first", F.lit(True)))
        .groupBy(key, *order, value, H.CHUNK)
        .agg(F.max("_first").alias("_first"))
    )
    before = Window.partitionBy(key).orderBy(*order).rowsBetween(-n, -1)
    halo = (
        edge.withColumn("_values", F.collect_list(value).over(before))
        .filter(F.col("_first"))
        .select(key, H.CHUNK, F.posexplode("_values").alias(_HALO, value))
    )
    rows = chunks.withColumn(_HALO, F.lit(None).cast("int")).unionByName(
        halo, allowMissingColumns=True
    )
    frame = segment.orderBy(F.col(_HALO).asc_nulls_last(), *order).rowsBetween(-n, -1)
    return (
        rows.withColumn("preceding_avg", F.avg(value).over(frame))
        .filter(F.col(_HALO).isNull())
        .select(*columns, "preceding_avg")
    )


def window_snapshot(
    scored: DataFrame,
    key: str = "user_id",
    order: tuple = ("ts", "event_id"),
    value: str = "value",
    n: int = 10,
    inserted: str | None = None,
) -> DataFrame:
    """The window each user's next event will see: ``window`` (newest first) and its average.

    Users without an accepted value have no row. The rank limit is applied before the shuffle as
    well, so at most ``n`` rows per user and input task travel.
    """
    accepted = ~F.col("is_anomaly")
    if inserted is not None:
        accepted = accepted & F.col(inserted)
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    top = (
        scored.filter(accepted)
        .select(key, value, *order)
        .withColumn("_age", F.row_number().over(newest))
        .filter(F.col("_age") <= n)
    )
    listed = F.array_sort(F.collect_list(F.struct("_age", F.col(value).alias("v"))))
    return (
        top.groupBy(key)
        .agg(F.transform(listed, lambda s: s["v"]).alias("window"))
        .withColumn(
            "window_avg",
            F.aggregate("window", F.lit(0.0), lambda acc, v: acc + v) / F.size("window"),
        )
    )
