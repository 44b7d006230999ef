"""Small helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BLANKS = b" \t\n\v\f\r"


def small_batches(spark: SparkSession) -> None:
    """Rows are read and travel to Python in batches of a few MB, however long their texts: a task holds several of them."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "512")


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def spare(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def split_of(doc_id: str, parts: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def text_bytes(text: str = "text") -> Column:
    """A text column as UTF-8 bytes, null as empty: Python then takes the bytes as they are."""
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def table_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512, text: int = 1, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few MB of text, so that work over a piece needs bounded memory.

    After the last one the worker gives back what it holds: it is kept for later stages, beside the heap.
    """
    for batch in batches:
        yield from _pieces(batch, rows, text, most)
    give_back()


def _pieces(batch: pa.RecordBatch, rows: int, text: int, most: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        piece = batch.slice(start, rows)
        if piece.num_rows > 1 and piece.column(text).nbytes > most:
            yield from _pieces(piece, max(1, piece.num_rows // 2), text, most)
        else:
            yield piece


def give_back() -> None:
    """Empty the word hashes and return freed memory to the system."""
    HASHES.clear()
    trim()


def trim() -> None:
    """Return freed memory to the system, where the allocator knows how."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = np.asarray(x, np.uint64).copy()
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """64-bit hash of a word's bytes; equal in every worker. Emptied by ``words`` when it grows large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def words(self, words: list[bytes]) -> np.ndarray:
        if len(self) > 150_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


HASHES = WordHashes()
