"""Result tables as Parquet: one folder per run and batch, replaced as a whole when written again."""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spikelens.session import shared_dir

DEFAULT_RUN = "main"
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# The folders of staged tables, by the frame that ``stage`` returned.
_STAGED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
KEY_FILTER = {
    "parquet.bloom.filter.enabled#trace_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def write_batch(
    df: DataFrame, path: str, batch_id: int, run: str = DEFAULT_RUN, options: dict | None = None
) -> str:
    """Write one batch. Repeating a batch replaces its rows, so a retry adds nothing.

    ``run`` names the checkpoint the batch numbers belong to: a replay from a new checkpoint
    counts from 0 again and must not overwrite the history of another run.
    """
    folder = f"{path}/run={run}/batch_id={batch_id}"
    df.write.mode("overwrite").options(**(options or {})).parquet(folder)
    return folder


def write_audit(df: DataFrame, path: str, batch_id: int, run: str = DEFAULT_RUN) -> str:
    """Audit rows, laid out for lookups.

    Sorted by user within each file, so that user lookups skip row groups; a Bloom filter on
    ``trace_id``, sized by the keys that a row group holds, does the same for key lookups.
    """
    return write_batch(df.sortWithinPartitions("user_id"), path, batch_id, run, KEY_FILTER)


def write_alerts(df: DataFrame, path: str, batch_id: int, run: str = DEFAULT_RUN) -> str:
    return write_batch(df, path, batch_id, run)


def write_rejects(df: DataFrame, path: str, batch_id: int, run: str = DEFAULT_RUN) -> str:
    return write_batch(df, path, batch_id, run)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    run: str | None = None,
    before: int | None = None,
) -> DataFrame | None:
    """All batches, or None if there is no table yet.

    With ``before``, batches of ``run`` from that number on are left out: a batch that is done
    again must not see its own earlier attempt.
    """
    full = T.StructType(
        [*schema.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
    )
    try:
        rows = spark.read.schema(full).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if before is not None:
        rows = rows.filter((F.col("run") != run) | (F.col("batch_id") < before))
    return rows


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate once to the shared folder and go on from the written table.

    Later passes then read only the columns they need, and a lost executor costs a re-read
    instead of the whole lineage. The shuffle files of the write go as it ends, not when the
    driver happens to collect its garbage.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    staged = spark.read.schema(df.schema).parquet(folder)
    _STAGED[staged] = folder
    return staged


def unstage(*tables: DataFrame) -> None:
    """Delete the files of staged tables: for those that only served tables written since."""
    for table in tables:
        folder = _STAGED.pop(table, None)
        if folder is not None:
            spark = table.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
