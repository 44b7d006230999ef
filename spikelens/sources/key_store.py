"""The keys stored so far, by hash bucket, with a Bloom filter for every bucket of every folder.

A look-up first asks the filters, small next to the keys, and then reads only those buckets of those folders
that may hold one of the asked keys: what it costs follows from the keys asked for, not from the history.
Folders become visible with the commit record of the batch they belong to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spikelens.sources.commits import FAN_IN, MERGED, CommitLog, Part, merged_part

TABLE, FILTERS = "keys", "key_filters"
BUCKETS = 16
# Keys for each filter of 32,768 bits: with three bits a key about one look-up in a hundred reads in vain.
KEYS_PER_FILTER = 2_500
FILTER_BITS = 32_768
SEEDS = (2, 3, 4)

_KEYS = T.StructType([T.StructField("key", T.StringType())])
_BUCKETED = T.StructType([*_KEYS.fields, T.StructField("bucket", T.IntegerType())])
_FILTERS = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("slot", T.IntegerType()),
        T.StructField("bits", T.BinaryType()),
    ]
)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _slot_of(key: Column, slots: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), slots).cast("int")


def _places(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(s)), F.lit(FILTER_BITS)) for s in SEEDS]


def _has(bits: Column, place: Column) -> Column:
    octet = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return octet.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0


class KeyStore:
    """The keys of one root. ``buckets`` holds for folders written from now on; older ones keep theirs."""

    def __init__(self, log: CommitLog, buckets: int = BUCKETS):
        self.log, self.buckets = log, buckets

    def write(self, keys: DataFrame, rows: int, run: str, batch_id: int, key: str = "trace_id") -> list[Part]:
        """Write a batch's new keys and their filters; commit the parts it returns with the batch's other folders."""
        own = keys.select(F.col(key).alias("key"))
        name = f"run={run}/batch_id={batch_id}"
        return self._lay_out(own, rows, f"{TABLE}/{name}", f"{FILTERS}/{name}", run, batch_id, 0)

    def _lay_out(self, keys: DataFrame, rows: int, folder: str, filters: str, run: str, batch_id: int, level: int) -> list[Part]:
        root, spark = self.log.root, self.log.spark
        bucketed = keys.withColumn("bucket", bucket_of(F.col("key"), self.buckets))
        # One file per bucket, several where a bucket is large.
        bucketed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "key").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/{folder}")
        slots = max(1, -(-rows // (self.buckets * KEYS_PER_FILTER)))
        stored = spark.read.schema(_BUCKETED).parquet(f"{root}/{folder}")
        marked = stored.select("bucket", _slot_of(F.col("key"), F.lit(slots)).alias("slot"), F.explode(F.array(*_places(F.col("key")))).alias("place"))
        bits = marked.groupBy("bucket", "slot").agg(F.bitmap_construct_agg("place").alias("bits"))
        part = uuid.uuid4().hex
        laid = bits.select(F.lit(part).alias("part"), "bucket", "slot", "bits").sortWithinPartitions("bucket", "slot")
        laid.write.mode("overwrite").parquet(f"{root}/{filters}")
        marks = {"part": part, "buckets": self.buckets, "slots": slots, "filters": filters}
        return [Part(TABLE, folder, run, batch_id, rows, level, marks=marks)]

    def parts(self, without_run: str | None = None) -> list[Part]:
        """The committed folders; without those that hold one run's keys alone."""
        return [p for p in self.log.state().of(TABLE) if without_run is None or p.run != without_run]

    def matching(self, keys: DataFrame, key: str = "trace_id", without_run: str | None = None) -> DataFrame | None:
        """The stored keys (column ``key``) of all buckets that may hold one of ``keys``; None if no bucket may.

        ``keys`` is read twice (here and by what is done with the result), so hand over a written table.
        """
        parts = self.parts(without_run)
        if not parts:
            return None
        spark, root = self.log.spark, self.log.root
        asked = keys.filter(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
        # One entry per committed folder, of which there are few per size class.
        sides = F.array(
            *[
                F.struct(
                    F.lit(p.marks["part"]).alias("part"),
                    bucket_of(F.col("key"), p.marks["buckets"]).alias("bucket"),
                    _slot_of(F.col("key"), F.lit(p.marks["slots"])).alias("slot"),
                )
                for p in parts
            ]
        )
        sought = asked.select("key", F.explode(sides).alias("_s")).select("key", "_s.*")
        filters = spark.read.schema(_FILTERS).parquet(*[f"{root}/{p.marks['filters']}" for p in parts])
        met = sought.join(filters, ["part", "bucket", "slot"])
        for place in _places(F.col("key")):
            met = met.filter(_has(F.col("bits"), place))
        # At most one record per folder and bucket comes to the driver.
        hits = met.select("part", "bucket").distinct().collect()
        if not hits:
            return None
        folders = {p.marks["part"]: p.folder for p in parts}
        paths = sorted(f"{root}/{folders[h.part]}/bucket={h.bucket}" for h in hits)
        return spark.read.schema(_KEYS).parquet(*paths)

    def new_only(self, df: DataFrame, key: str = "trace_id", without_run: str | None = None) -> DataFrame:
        """Rows of ``df``, a written table, whose key is not stored; rows without a key always pass."""
        stored = self.matching(df.filter(F.col(key) != ""), key, without_run)
        if stored is None:
            return df
        return df.join(stored.withColumnRenamed("key", "_stored_key"), F.col(key) == F.col("_stored_key"), "left_anti")

    def merge(self, fan_in: int = FAN_IN) -> int:
        """Merge folders of one size class, within each run, while there are ``fan_in`` of them."""
        went = 0
        while True:
            classes: dict[tuple, list[Part]] = {}
            for p in self.log.state().of(TABLE):
                classes.setdefault((p.run, p.level), []).append(p)
            full = [c for c in sorted(classes) if len(classes[c]) >= fan_in]
            if not full:
                return went
            old = classes[full[0]]
            name = uuid.uuid4().hex
            keys = self.log.spark.read.schema(_KEYS).option("recursiveFileLookup", "true").parquet(*[f"{self.log.root}/{p.folder}" for p in old])
            whole = merged_part(TABLE, "", old)
            new = self._lay_out(keys, whole.rows, f"{MERGED}/{TABLE}/{name}", f"{MERGED}/{FILTERS}/{name}", full[0][0], -1, whole.level)
            self.log.swap(old, new)
            went += len(old)
