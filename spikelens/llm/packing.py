"""Concatenate and cut: documents become one token stream, cut into windows of equal length."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikelens.llm.common import slices, table_of, text_bytes
from spikelens.llm.tokens import WORD_BPE, forget, tokenizer
from spikelens.sources import stage

_COUNTED = "part long, local_start long, doc_id long, doc_tokens long, ids binary"
_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def tokenize(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str = WORD_BPE, end_id: int = 1) -> DataFrame:
    """First pass: every document's ids, with its place in the stream of its own partition.

    ``ids`` holds little-endian integers of the vocabulary's width. A null text has only the end id.
    """
    schema = _schema(_COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, at = tokenizer(vocabulary), TaskContext.get().partitionId(), 0
        end, width = np.array([end_id], known.dtype).tobytes(), known.dtype.itemsize
        for piece in slices(batches):
            ids = [known.packed(t.decode()) + end for t in piece.column(1).to_pylist()]
            counts = [len(x) // width for x in ids]
            starts = [at, *accumulate(counts, initial=at)][1:-1] if counts else []
            at += sum(counts)
            yield table_of(schema, [[part] * len(ids), starts, piece.column(0), counts, ids])
        del known
        forget()

    return docs.select(F.col(doc_id).cast("long"), text_bytes(text)).mapInArrow(run, _COUNTED)


def pack(
    docs: DataFrame, window: int = 2048, text: str = "text", doc_id: str = "doc_id", vocabulary: str = WORD_BPE, end_id: int = 1
) -> DataFrame:
    """Pieces of documents laid out in sequences of ``window`` tokens, without gaps.

    Pass one writes every document's ids and its place within its partition; the partitions' totals,
    one number each, are summed up to the places where the partitions begin in the whole stream. Pass
    two cuts each document where the stream crosses a window's edge: one row per piece with its ids
    (little-endian unsigned 32-bit), so no row is shuffled in either pass. Only the last sequence of
    the corpus is short.

    A null or empty text is one piece with the end id alone. Rows with equal or null ids are documents
    of their own. An empty table gives no pieces. Other columns are not read.
    """
    spark = docs.sparkSession
    wide = tokenizer(vocabulary).dtype
    staged = stage(tokenize(docs, text, doc_id, vocabulary, end_id), "tokens")
    totals = sorted(map(tuple, staged.groupBy("part").agg(F.sum("doc_tokens")).collect()))
    begins = accumulate((n for _, n in totals), initial=0)
    base = spark.createDataFrame([(p, b) for (p, _), b in zip(totals, begins)], "part long, base long")
    schema = _schema(_PIECES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text=2):
            rows = []
            for doc, begin, ids, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                content = np.frombuffer(ids, wide).astype("<u4").tobytes()
                at = 0
                while at < n:
                    sequence, offset = divmod(begin + at, window)
                    length = min(n - at, window - offset)
                    rows.append((doc, at, length, n, sequence, offset, content[4 * at : 4 * (at + length)]))
                    at += length
            if rows:
                yield table_of(schema, list(zip(*rows, strict=True)))

    # One row per input partition: bounded by the number of input splits, whatever their size.
    placed = staged.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("begin"), "ids", "doc_tokens"
    )
    return placed.mapInArrow(cut, _PIECES)


def packing_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
