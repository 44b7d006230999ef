"""Staged tables: their shuffle files go with the write, their own files when they are unstaged."""

import os
import time
from urllib.parse import urlparse

from pyspark.sql import functions as F

from spikelens.sources import stage, unstage
from spikelens.sources.tables import CLEAN_SHUFFLES


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if os.path.basename(f).startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark):
    """They would stay until the driver collects its garbage: more than the input many times over, on large tables."""
    before = shuffle_files(spark)
    sums = spark.range(0, 20_000, 1, 4).groupBy((F.col("id") % 1000).alias("k")).agg(F.sum("id").alias("s"))
    staged = stage(sums.join(sums.select("k", (F.col("s") * 2).alias("t")), "k").repartition(3, "t"), "sums")
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert staged.count() == 1000 and staged.filter("t <> 2 * s").count() == 0
    assert spark.conf.get(CLEAN_SHUFFLES) == "false"


def test_a_frame_is_staged_twice_and_used_again(spark):
    sums = spark.range(0, 5000, 1, 4).groupBy((F.col("id") % 7).alias("k")).count()
    wanted = sorted(map(tuple, sums.collect()))
    assert sorted(map(tuple, stage(sums, "a").collect())) == wanted
    assert sorted(map(tuple, stage(sums, "b").collect())) == wanted
    assert sorted(map(tuple, sums.collect())) == wanted


def test_unstage_deletes_the_given_tables_only(spark):
    one, two = stage(spark.range(5), "one"), stage(spark.range(6), "two")
    at = [os.path.dirname(urlparse(t.inputFiles()[0]).path) for t in (one, two)]
    unstage(one, one, spark.range(3))
    assert [os.path.exists(p) for p in at] == [False, True] and two.count() == 6
