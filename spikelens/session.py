"""Session settings the operators rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options that the results depend on; safe to call repeatedly."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A repeated JSON key is legal input: the last one counts.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a scratch folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spikelens-"))
    return context.getCheckpointDir()
