"""Document fingerprints by a randomised edit embedding, and groups of texts that lie close by edit distance.

A walk reads a text with a pointer. At every step it notes the character under the pointer and moves on by one
character or stays, as a bit shared by all texts for that step and character says. An edit shifts two walks
against each other, and equal bits soon bring them together again, so the noted strings of texts that differ by
few edits differ in few places: edit distance becomes Hamming distance. A fingerprint samples places of the
noted string; which places depends on its length alone, and lengths that differ little share most of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikelens.llm.common import mix, slices, table_of
from spikelens.llm.components import components
from spikelens.sources import stage

PERIOD = 512  # steps after which the shared bits repeat
CLASSES = 64  # kinds of characters with a bit string of their own; the noted characters are exact
SAMPLES = 256  # places of the noted string, one hexadecimal digit each
LONGEST = 64  # changes of a sampled place as texts grow: enough for any length
BANDS, BAND_DIGITS = 24, 6
BLOCK = 1 << 20
_SEED = 0x5EED


class _Step(list):
    """One step of the walk: per character class the step at which the next character begins; last, its own number."""

    __slots__ = ()


@lru_cache(1)
def steps() -> list[_Step]:
    """The shared bits as links: a character read at step j lasts until its first bit of 1 at or after j."""
    grid = np.arange(PERIOD * CLASSES, dtype=np.uint64).reshape(CLASSES, PERIOD) + np.uint64(_SEED << 32)
    bits = (mix(grid) & np.uint64(1)).astype(bool)
    places = np.arange(PERIOD)
    following = np.empty((CLASSES, PERIOD), np.int64)
    for k in range(CLASSES):
        ones = places[bits[k]]
        following[k] = np.append(ones, ones[0])[np.searchsorted(ones, places)] + 1
    following %= PERIOD
    made = [_Step() for _ in range(PERIOD)]
    for j, step in enumerate(made):
        step.extend(made[n] for n in following[:, j].tolist())
        step.append(j)
    return made


@lru_cache(1)
def sampled_places() -> np.ndarray:
    """Row b: the places that sample b takes one after the other as the noted string grows.

    Reservoir sampling with shared randomness: the last place below a length is uniform below it, and two
    lengths share it with the ratio of the shorter to the longer as probability.
    """
    grid = np.arange(SAMPLES * LONGEST, dtype=np.uint64).reshape(SAMPLES, LONGEST) + np.uint64(_SEED << 40)
    odds = ((mix(grid) >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
    rows = np.zeros((SAMPLES, LONGEST), np.int64)
    for k in range(1, LONGEST):
        rows[:, k] = np.minimum((rows[:, k - 1] + 1) / odds[:, k], 2.0**50).astype(np.int64)
    return rows


def _classes(text: str) -> Iterator[bytes]:
    for at in range(0, len(text), BLOCK):
        codes = np.frombuffer(text[at : at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        folded = (codes % CLASSES).astype(np.uint8)
        high = np.flatnonzero(codes > 127)
        folded[high] = (mix(codes[high]) % np.uint64(CLASSES)).astype(np.uint8)
        yield folded.tobytes()


def walk(text: str, begin: int = 0) -> np.ndarray:
    """For every character and for the end: the step at which it is first read, modulo the period."""
    made = steps()
    seen = accumulate(chain.from_iterable(_classes(text)), getitem, initial=made[begin])
    return np.fromiter(map(itemgetter(CLASSES), seen), np.uint16, len(text) + 1)


def print_of(text: str, walked: np.ndarray) -> str:
    """The fingerprint of a text from its walk: a digit for each sampled place, all ``0`` for the empty text."""
    if not text:
        return "0" * SAMPLES
    sums, total = [0], 0
    for at in range(0, len(text), BLOCK):
        total += int(_gaps(walked[at : at + BLOCK + 1]).sum())
        sums.append(total)
    rows = sampled_places()
    places = rows[np.arange(SAMPLES), (rows < total).sum(1) - 1]
    digits = np.empty(SAMPLES, np.uint64)
    blocks = np.searchsorted(sums, places, "right") - 1
    for b in np.unique(blocks).tolist():
        mine = blocks == b
        ends = np.cumsum(_gaps(walked[b * BLOCK : (b + 1) * BLOCK + 1]))
        at = np.searchsorted(ends, places[mine] - sums[b], "right") + b * BLOCK
        codes = np.fromiter((ord(text[i]) for i in at.tolist()), np.uint64, len(at))
        digits[mine] = mix(codes + (places[mine].astype(np.uint64) << np.uint64(21))) & np.uint64(15)
    return (digits.astype(np.uint8) + np.where(digits < 10, 48, 87).astype(np.uint8)).tobytes().decode()


def _gaps(walked: np.ndarray) -> np.ndarray:
    """Steps that each character lasts; a whole period shows as 0."""
    gaps = (walked[1:].astype(np.int64) - walked[:-1]) % PERIOD
    gaps[gaps == 0] = PERIOD
    return gaps


def fingerprint(text: str | None) -> str:
    text = text or ""
    return print_of(text, walk(text))


def likeness(a: str, b: str) -> float:
    """Estimated share of equal places of two noted strings, 0 to 1; equal digits by chance are taken off."""
    equal = np.count_nonzero(np.frombuffer(a.encode(), np.uint8) == np.frombuffer(b.encode(), np.uint8)) / SAMPLES
    return max(0.0, (equal - 1 / 16) / (1 - 1 / 16))


def text_likeness(a: str, print_a: str, b: str, print_b: str) -> float:
    """``likeness``, but an empty text is like the empty text alone: its digits stand for no character."""
    return likeness(print_a, print_b) if bool(a) == bool(b) else 0.0


_PRINTS = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edit(text: str, following: str) -> tuple[int, str]:
    third = len(text) // 3
    return len(text) - third, text[: len(text) - third] + following[:third]


def edit_fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every text's fingerprint, beside that of an edit of it and that of the next document.

    The next document has the next smaller id; after the last comes the first. The edit replaces the last third
    of the characters by as many from the next document's begin. One row per row of ``docs``:
    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    A null text is empty; null ids come last; rows of one id are ordered by a hash of their text, so repeated rows
    follow each other. A table of one row has itself as next. Empty texts are like each other (1) and unlike
    all others (0).

    The texts are shuffled once, by ranges of the id. A range's last row needs the first row of the range that
    follows: the begins of the ranges are found on ids and hashes alone, and their rows travel twice.
    """
    order = [F.col("_rank").desc_nulls_last(), F.col("_salt")]
    keys = docs.select(F.col(doc_id).cast("long").alias("_rank"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    keys = keys.withColumn("_salt", F.xxhash64("_text"))
    spark = docs.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = keys.select("_rank", "_salt").repartitionByRange(wanted, *order).withColumn("_part", F.spark_partition_id())
    first = F.min(F.struct(F.col("_rank").isNull().alias("none"), (-F.col("_rank").cast("decimal(20,0)")).alias("back"), F.col("_salt").alias("salt"))).alias("at")
    # One record per partition comes to the driver.
    begins = [(r.at.none, 0 if r.at.none else int(r.at.back), r.at.salt) for r in parts.groupBy("_part").agg(first).collect()]
    begins.sort()
    if not begins:
        return spark.createDataFrame([], _DDL)
    shared = spark.sparkContext.broadcast(begins)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every row to its range, and the rows that begin a range to the end of the range before as well."""
        from bisect import bisect_right

        cuts = shared.value
        opening = {c: k for k, c in enumerate(cuts)}
        for batch in slices(batches):
            ranks, salts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            places = [(r is None, 0 if r is None else -r, s) for r, s in zip(ranks, salts)]
            own = [max(0, bisect_right(cuts, p) - 1) for p in places]
            rows = range(len(places))
            also = [i for i in rows if places[i] in opening]
            take = pa.array([*rows, *also])
            part = own + [(opening[places[i]] - 1) % len(cuts) for i in also]
            late = [False] * len(own) + [True] * len(also)
            whole = pa.RecordBatch.from_arrays([batch.column(k).take(take) for k in range(3)] + [pa.array(part, pa.int32()), pa.array(late)], ["_rank", "_text", "_salt", "_part", "_late"])
            yield whole

    dealt = keys.mapInArrow(deal, "_rank long, _text string, _salt long, _part int, _late boolean")
    sorted_rows = dealt.repartitionById(len(begins), F.col("_part")).sortWithinPartitions("_late", *order, "_text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        for batch in slices(batches, rows=128, most=1 << 20):
            out = []
            for rank, body, late in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                walked = walk(body)
                mark = print_of(body, walked)
                if before is not None:
                    out.append(_row(*before, body, mark))
                # Of the rows that open the range after, the first is the next document.
                before = None if late else (rank, body, walked, mark)
                if late:
                    break
            yield table_of(_PRINTS, list(zip(*out)) if out else [[]] * len(_PRINTS))
            if before is None:
                break
        for _ in batches:
            pass

    return sorted_rows.select("_rank", "_text", "_late").mapInArrow(work, _DDL)


def _row(rank: int | None, body: str, walked: np.ndarray, mark: str, following: str, next_mark: str) -> tuple:
    kept, edited = _edit(body, following)
    rest = walk(edited[kept:], int(walked[kept]))
    edited_mark = mark if edited == body else print_of(edited, np.concatenate([walked[:kept], rest]))
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return rank, len(body), digest, mark, edited_mark, text_likeness(body, mark, edited, edited_mark), text_likeness(body, mark, following, next_mark)


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance over code points, a whole column of the table at a time as bits of one integer."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    masks: dict[str, int] = {}
    for c in set(a):
        masks[c] = int.from_bytes(np.packbits(np.fromiter(map(c.__eq__, a), bool, len(a)), bitorder="little").tobytes(), "little")
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    rise, fall, distance = full, 0, len(a)
    for c in b:
        same = masks.get(c, 0)
        level = (((same & rise) + rise) ^ rise) | same | fall
        up, down = fall | (full & ~(level | rise)), rise & level
        distance += bool(up & top) - bool(down & top)
        up, down = (up << 1) | 1, down << 1
        rise, fall = (down | (full & ~((same | fall) | up))) & full, up & (same | fall) & full
    return distance


def near_groups(docs: DataFrame, similarity: float = 0.75, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, group_id``: groups of texts at an edit distance of at most ``1 - similarity`` of the longer one.

    Equal texts are one class. Classes meet where all digits of one of ``BANDS`` samples of the fingerprint are
    equal. In every such bucket the class with the least text hash leads: the others are verified against it by
    exact edit distance, the leader and those linked to it leave, the next one leads what is left, until nothing
    is left to compare. So a bucket of near copies costs one pass and is never paired with itself; two classes
    that were linked to one leader are in one group already. ``group_id`` is the least id of the group's rows.
    Texts that share no bucket are not found (of texts at likeness 0.9 about one in twenty thousand).
    Null texts are empty, empty texts form one group; rows without an id are returned with their group.
    """
    columns = docs.select(F.col(doc_id).cast("long").alias("_row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    marked = pa.schema([("doc_id", pa.int64()), ("node", pa.string()), ("fingerprint", pa.string())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            yield table_of(marked, [batch.column(0), [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts], [fingerprint(t) for t in texts]])

    prints = stage(columns.mapInArrow(mark, "doc_id long, node string, fingerprint string"), "prints")
    classes = prints.groupBy("node").agg(F.first("fingerprint").alias("fingerprint"))
    band = [F.concat(F.lit(f"{k}:"), F.substring("fingerprint", k * BAND_DIGITS + 1, BAND_DIGITS)) for k in range(BANDS)]
    hashed = classes.select("node", F.explode(F.array(*[F.xxhash64(b) for b in band])).alias("bucket"))
    several = hashed.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b").select("bucket")
    open_rows = stage(hashed.join(several, "bucket", "left_semi").distinct(), "buckets")
    bodies = stage(columns.select(F.sha2("_text", 256).alias("node"), "_text").dropDuplicates(["node"]), "bodies")
    links: list[DataFrame] = []

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = pa.schema([("a", pa.string()), ("b", pa.string())])
        for batch in slices(batches, rows=64, text=2):
            kept = [(a, b) for a, b, x, y in zip(*(batch.column(k).to_pylist() for k in range(4))) if _close(x, y, similarity)]
            yield table_of(pairs, list(zip(*kept)) if kept else [[], []])

    while True:
        leaders = open_rows.groupBy("bucket").agg(F.min("node").alias("lead"))
        met = open_rows.join(leaders, "bucket").filter(F.col("node") != F.col("lead"))
        pairs = met.select("lead", "node").distinct()
        first = bodies.select(F.col("node").alias("lead"), F.col("_text").alias("_lead_text"))
        both = pairs.join(bodies, "node").join(first, "lead").select(F.col("lead").alias("a"), F.col("node").alias("b"), "_lead_text", "_text")
        linked = stage(both.mapInArrow(verify, "a string, b string"), "links")
        links.append(linked)
        done = linked.select(F.col("a").alias("lead"), F.col("b").alias("node"))
        left = met.join(done, ["lead", "node"], "left_anti").select("node", "bucket")
        open_rows = stage(left, "buckets")
        if open_rows.isEmpty():
            break
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    grouped = components(every)
    members = prints.select("doc_id", "node").join(grouped, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = members.groupBy("comp").agg(F.min("doc_id").alias("group_id"))
    return members.join(least, "comp").select("doc_id", "group_id")


def _close(a: str, b: str, similarity: float) -> bool:
    longer = max(len(a), len(b))
    most = int((1 - similarity) * longer + 1e-9)
    return abs(len(a) - len(b)) <= most and edit_distance(a, b) <= most
