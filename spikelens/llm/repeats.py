"""Long repeated passages by suffix sorting: exact to the byte, within and across documents.

Every window of ``length`` bytes holds one anchor, the first place of its smallest hashed gram, and equal
windows have their anchors at the same offset. So equal windows meet at anchors with equal grams, and only
the suffixes that start there, and the bytes before them read backwards, need to be sorted. Groups of one
gram are sorted deep-shallow: multikey quicksort to a shallow depth, blind tries below it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikelens.llm.common import give_back, mix, slices, spare, table_of, text_bytes
from spikelens.sources import stage, unstage

LENGTH = 200
GRAM = 32
STEP = 8
SHALLOW = 24
#: Groups of one gram with more occurrences are counted window by window instead, in a combined count.
GROUP_ROWS = 1_000_000
_POSITION_BITS = 24

_ANCHORS = pa.schema([("id1", pa.int64()), ("id2", pa.int64()), ("key", pa.int64()), ("pos", pa.int32())])
_CONTEXTS = pa.schema([("key", pa.int64()), ("before", pa.binary()), ("after", pa.binary()), ("hot", pa.bool_()), ("members", pa.binary())])
_SPANS = pa.schema([("id1", pa.int64()), ("id2", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit polynomial hash of every ``gram`` bytes (a power of two), by doubling."""
    with np.errstate(over="ignore"):
        h = data.astype(np.uint64) + np.uint64(1)
        base, width = np.uint64(0x9E3779B97F4A7C15), 1
        while width < gram:
            h = h[:-width] * base + h[width:]
            base, width = base * base, 2 * width
        return h


def anchors_of(text: bytes, length: int = LENGTH, gram: int = GRAM, chunk: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all windows of a text, and the 64-bit hashes of their grams.

    A text is taken in chunks that overlap by a window, so memory does not grow with it.
    """
    places, keys = [], []
    span = length - gram + 1
    for begin in range(0, max(len(text) - length + 1, 0), chunk):
        data = np.frombuffer(text, np.uint8, min(chunk + length - 1, len(text) - begin), begin)
        raw = gram_hashes(data, gram)
        # The hash is cut to make room for the place: equal hashes then go by the first place.
        ranked = (mix(raw) >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | np.arange(len(raw), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            ranked = np.minimum(ranked[:-width], ranked[width:])
            width *= 2
        if width < span:
            ranked = np.minimum(ranked[: len(ranked) - (span - width)], ranked[span - width :])
        at = (ranked & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        at = at[np.flatnonzero(np.diff(at, prepend=-1))]
        places.append(at + begin)
        keys.append(mix(raw[at] ^ np.uint64(0x5851F42D4C957F2D)))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, first = np.unique(np.concatenate(places), return_index=True)
    return found, np.concatenate(keys)[first].view(np.int64)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n - 1
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class BlindTrie:
    """A trie that keeps only the depths where strings part and the bytes that lead on."""

    def __init__(self, strings: Sequence[bytes]):
        self.strings = strings
        self.root: list | None = None  # [depth, {byte: node}] or [-1, [places of equal strings]]

    def add(self, place: int) -> None:
        own = self.strings[place]
        if self.root is None:
            self.root = [-1, [place]]
            return
        node = self.root
        while node[0] >= 0:  # blind: only the bytes at the parting depths are looked at
            depth = node[0]
            node = node[1].get(own[depth] if depth < len(own) else -1) or next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        same = common_prefix(own, other)
        if same == len(own) == len(other):
            node[1].append(place)
            return
        parent, turn, node = None, 0, self.root
        while 0 <= node[0] < same:
            parent, turn = node, own[node[0]] if node[0] < len(own) else -1
            node = node[1][turn]
        mine, leaf = own[same] if same < len(own) else -1, [-1, [place]]
        if node[0] == same:
            node[1][mine] = leaf
            return
        split = [same, {mine: leaf, (other[same] if same < len(other) else -1): node}]
        if parent is None:
            self.root = split
        else:
            parent[1][turn] = split

    def walk(self) -> tuple[list[int], list[int]]:
        """Places in order, and the common prefix of each with the one before it (0 for the first)."""
        order, common = [], []
        todo = [(self.root, 0)] if self.root else []
        while todo:
            node, shared = todo.pop()
            if node[0] < 0:
                for i, place in enumerate(node[1]):
                    order.append(place)
                    common.append(len(self.strings[place]) if i else shared)
            else:
                children = sorted(node[1].items())
                todo.extend((child, node[0] if i else shared) for i, (_, child) in reversed(list(enumerate(children))))
        return order, common


def deep_shallow(strings: Sequence[bytes], known: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of the strings and the common prefix of each with the one before it.

    ``known`` bytes are the same in all. Multikey quicksort takes ``STEP`` bytes as one character down to
    ``shallow`` bytes further; what is still equal there goes to a blind trie.
    """
    order: list[int] = []
    common: list[int] = []
    todo = [(list(range(len(strings))), known)]
    while todo:
        rows, depth = todo.pop()
        if len(rows) == 1:
            found, inner = rows, [0]
        elif depth >= known + shallow:
            trie = BlindTrie(strings)
            for row in rows:
                trie.add(row)
            found, inner = trie.walk()
        else:
            keys = [strings[r][depth : depth + STEP] for r in rows]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            less = [r for r, k in zip(rows, keys, strict=True) if k < pivot]
            more = [r for r, k in zip(rows, keys, strict=True) if k > pivot]
            same = [r for r, k in zip(rows, keys, strict=True) if k == pivot]
            if more:
                todo.append((more, depth))
            # A character cut short by the end of its string leaves nothing to sort.
            todo.append((same, depth + STEP if len(pivot) == STEP else known + shallow))
            if less:
                todo.append((less, depth))
            continue
        inner[0] = common_prefix(strings[order[-1]], strings[found[0]]) if order else 0
        order += found
        common += inner
    return order, common


def match_offsets(before: Sequence[bytes], after: Sequence[bytes], times: Sequence[int], length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int] | None]:
    """For every context the least and greatest offset of its anchor in a window that occurs elsewhere.

    ``before`` is read backwards from the anchor, ``after`` forwards; ``times`` counts equal contexts.
    The window at offset o occurs twice when two contexts share o bytes before and length - o after.
    """
    n = len(after)
    low, high = [length + 1] * n, [-1] * n

    def match(i: int, left: int, right: int) -> None:
        if left + right >= length:
            low[i], high[i] = min(low[i], max(length - right, 0)), max(high[i], left)

    for i in range(n):
        if times[i] > 1:
            match(i, len(before[i]), len(after[i]))
    if n == 2:
        left, right = common_prefix(before[0], before[1]), common_prefix(after[0], after[1])
        match(0, left, right)
        match(1, left, right)
    elif n > 2:
        order, right_common = deep_shallow(after, gram)
        left_order, left_common = deep_shallow(before)
        rank = [0] * n
        for r, i in enumerate(left_order):
            rank[i] = r
        if n <= 24:
            lefts = [[0] * n for _ in range(n)]
            for a in range(n):
                least = length
                for b in range(a + 1, n):
                    least = min(least, left_common[b])
                    lefts[a][b] = lefts[b][a] = least
            for a in range(n):
                least = length
                for b in range(a + 1, n):
                    least = min(least, right_common[b])
                    i, j = order[a], order[b]
                    left = lefts[rank[i]][rank[j]]
                    match(i, left, least)
                    match(j, left, least)
        else:
            place = np.empty(n, np.int64)
            place[order] = np.arange(n)
            ranks, rc, lc = np.array(rank), np.array(right_common), np.array(left_common)
            lengths_after, lengths_before = np.array([len(a) for a in after]), np.array([len(b) for b in before])
            for offset in range(length - gram + 1):
                right_class = np.cumsum(rc < length - offset)[place]
                left_class = np.cumsum(lc < offset)[ranks] if offset else np.zeros(n, np.int64)
                whole = (lengths_after >= length - offset) & (lengths_before >= offset)
                both = right_class * (n + 1) + left_class
                _, inverse, counts = np.unique(both[whole], return_inverse=True, return_counts=True)
                for i in np.flatnonzero(whole)[counts[inverse] > 1]:
                    low[i], high[i] = min(low[i], offset), max(high[i], offset)
    return [(a, b) if b >= 0 else None for a, b in zip(low, high, strict=True)]


def packed_text(text: Column) -> Column:
    """A text compressed for the shuffle; null stays null."""

    @F.arrow_udf("binary")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packer = zstandard.ZstdCompressor(level=3)
        for texts in batches:  # read in the batch's own memory, one text after the other
            yield pa.array((packer.compress(t.as_buffer()) if t.is_valid else None for t in texts), pa.binary())
        give_back()

    return pack(text.cast("string").cast("binary"))


def _unpacked(data: bytes | None) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data) if data is not None else b""


def _parts(*columns: pa.Array, rows: int = 512) -> Iterator[tuple[pa.Array, ...]]:
    """A batch in pieces, so that texts are unpacked a few MB at a time; an empty one is one piece."""
    for start in range(0, max(len(columns[0]), 1), rows):
        yield tuple(c.slice(start, rows) for c in columns)


def _cut(text: pa.BinaryScalar, spans: pa.ListScalar) -> bytes:
    """The bytes of a packed text outside the spans."""
    out, at, data = [], 0, _unpacked(text.as_buffer() if text.is_valid else None)
    for span in spans.as_py():
        out.append(data[at : span["start"]])
        at = span["end"]
    return b"".join([*out, data[at:]])


def _identified(docs: DataFrame, text: str) -> DataFrame:
    """The text packed in its column, its size, and 128 bits of hash that its copies share."""
    own = text_bytes(text)
    known = docs.withColumns({"id1": F.xxhash64(own), "id2": F.xxhash64(F.lit(7), own), "n_bytes": F.length(own).cast("long")})
    return known.withColumn(text, packed_text(F.col(text)))


def find_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``id1, id2, spans``: the byte runs of every text that repeated windows cover, merged and in order.

    Rows only for texts that lose something. A text that occurs twice or more, as a whole, loses all.
    """
    own = text_bytes(text)
    plain = docs.select(F.xxhash64(own).alias("id1"), F.xxhash64(F.lit(7), own).alias("id2"), own.alias("_text")).filter(F.length("_text") >= length)

    def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text=2):
            id1, id2, texts = (piece.column(i).to_pylist() for i in range(3))
            found = [anchors_of(t, length, gram) for t in texts]
            sizes = [len(p) for p, _ in found]
            if sum(sizes):
                yield table_of(_ANCHORS, [np.repeat(id1, sizes), np.repeat(id2, sizes), np.concatenate([k for _, k in found]), np.concatenate([p for p, _ in found]).astype(np.int32)])

    anchors = stage(plain.mapInArrow(find_anchors, "id1 long, id2 long, key long, pos int"), "anchors")
    place = F.xxhash64("id1", "id2", "pos")
    # Written, as it is few of the grams and read twice: the anchors are dealt by gram once for it. Rebalanced
    # into few files, as there are as many tasks as the anchors need and every file costs a local file system processes.
    shared = anchors.groupBy("key").agg(F.min(place).alias("_a"), F.max(place).alias("_b"), F.count("*").alias("n")).filter("_a < _b").select("key", "n")
    shared = stage(shared.hint("rebalance"), "shared-grams")
    wanted = anchors.join(shared, "key").groupBy("id1", "id2").agg(F.collect_set(F.struct("pos", "key", (F.col("n") > group_rows).alias("hot"))).alias("places"))
    reach = length - gram

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, rows=1024, text=2):
            met: dict[tuple, list[tuple[int, int, int]]] = {}
            for id1, id2, data, places in zip(*(piece.column(i).to_pylist() for i in range(4)), strict=True):
                data = _unpacked(data)
                for spot in places:
                    pos = spot["pos"]
                    around = (spot["key"], data[max(0, pos - reach) : pos][::-1], data[pos : pos + length], spot["hot"])
                    met.setdefault(around, []).append((id1, id2, pos))
            if met:  # equal contexts, as of a frequent line, travel as one row
                keys, before, after, hot = zip(*met, strict=True)
                yield table_of(_CONTEXTS, [keys, before, after, hot, [np.array(m, "<i8").tobytes() for m in met.values()]])

    packed = plain.withColumn("_text", packed_text(F.col("_text")))
    texts = packed.dropDuplicates(["id1", "id2"]).join(wanted, ["id1", "id2"])
    around = texts.mapInArrow(contexts, "key long, before binary, after binary, hot boolean, members binary")
    frequent = not shared.filter(F.col("n") > group_rows).isEmpty()
    # Written once where the frequent groups and the others are both read from it.
    around = stage(around, "contexts") if frequent else around

    def sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come ordered by key; a group may go on in the next batch."""
        held: list[tuple] = []
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
            if not rows:
                continue
            held += rows
            cut = bisect_left(held, held[-1][0], key=lambda r: r[0])
            if cut:
                yield from settle(held[:cut])
                held = held[cut:]
        yield from settle(held)

    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, same_key in groupby(rows, key=lambda r: r[0]):
            # Grams of equal hash and different bytes are different groups; hardly ever more than one.
            by_gram: dict[bytes, dict[tuple[bytes, bytes], list[bytes]]] = {}
            for _, before, after, members in same_key:
                by_gram.setdefault(after[:gram], {}).setdefault((before, after), []).append(members)
            for classes in by_gram.values():
                members = [b"".join(m) for m in classes.values()]
                found = match_offsets([c[0] for c in classes], [c[1] for c in classes], [len(m) // 24 for m in members], length, gram)
                for own, offsets in zip(members, found, strict=True):
                    if offsets:
                        at = np.frombuffer(own, "<i8").reshape(-1, 3).copy()
                        out.append(np.column_stack([at[:, :2], at[:, 2] - offsets[1], at[:, 2] - offsets[0] + length]))
        if out:
            id1, id2, start, end = np.concatenate(out).T
            yield table_of(_SPANS, [id1, id2, start.astype(np.int32), end.astype(np.int32)])

    spans_ddl = "id1 long, id2 long, start int, end int"
    spans = around.filter(~F.col("hot")).drop("hot").repartition("key").sortWithinPartitions("key").mapInArrow(sort_groups, spans_ddl)
    if frequent:
        spans = spans.unionByName(_count_windows(around.filter("hot"), length, gram))
    merged = spans.groupBy("id1", "id2").agg(_merged(F.array_sort(F.collect_set(F.struct("start", "end")))).alias("spans"))
    copies = plain.groupBy("id1", "id2").agg(F.count("*").alias("_n"), F.max(F.length("_text")).alias("_size")).filter("_n > 1")
    whole = copies.select("id1", "id2", F.array(F.struct(F.lit(0).alias("start"), F.col("_size").cast("int").alias("end"))).alias("spans"))
    found = merged.join(whole.select("id1", "id2"), ["id1", "id2"], "left_anti").unionByName(whole)
    # Written, so that the shuffled texts and contexts are gone before the texts are shuffled again to be cut.
    found = stage(found.hint("rebalance"), "spans")
    unstage(anchors, shared, around)
    return found


def _count_windows(around: DataFrame, length: int, gram: int) -> DataFrame:
    """The exact way for grams too frequent for one task: all windows at an anchor, counted with combining."""
    each = around.select("before", "after", "members").mapInArrow(_members_out, "id1 long, id2 long, pos int, before binary, after binary")
    offsets = F.sequence(F.lit(0), F.least(F.lit(length - gram), F.length("before")))
    rows = each.select("id1", "id2", "pos", "before", "after", F.explode(offsets).alias("o")).filter(F.length("after") >= length - F.col("o"))
    taken = F.concat(F.substring(F.hex("before"), F.lit(1), 2 * F.col("o")), F.lit("|"), F.substring(F.hex("after"), F.lit(1), 2 * (length - F.col("o"))))
    rows = rows.select("id1", "id2", "pos", "o", F.xxhash64(taken, "o").alias("w1"), F.xxhash64(F.lit(7), taken, F.col("o")).alias("w2"))
    twice = rows.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2")
    return rows.join(twice, ["w1", "w2"], "left_semi").groupBy("id1", "id2", "pos").agg(
        (F.col("pos") - F.max("o")).cast("int").alias("start"), (F.col("pos") - F.min("o") + length).cast("int").alias("end")
    ).select("id1", "id2", "start", "end")


def _members_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each place that a shared context stands for."""
    schema = pa.schema([("id1", pa.int64()), ("id2", pa.int64()), ("pos", pa.int32()), ("before", pa.binary()), ("after", pa.binary())])
    for batch in batches:
        for before, after, members in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            at = np.frombuffer(members, "<i8").reshape(-1, 3)
            for i in range(0, len(at), 4096):
                id1, id2, pos = at[i : i + 4096].T
                yield table_of(schema, [id1.copy(), id2.copy(), pos.astype(np.int32), [before] * len(pos), [after] * len(pos)])


def _merged(spans):
    """Sorted spans with those that touch or overlap made one."""
    kind = "array<struct<start:int,end:int>>"
    last = lambda done: F.element_at(done, -1)
    return F.aggregate(
        spans,
        F.array().cast(kind),
        lambda done, s: F.when((F.size(done) > 0) & (s["start"] <= F.get(done, F.size(done) - 1)["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], s["end"]).alias("end")))).cast(kind),
        ).otherwise(F.concat(done, F.array(s)).cast(kind)),
    )


def remove_repeats(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_bytes``, ``spans`` (removed byte runs) and ``kept`` (bytes left).

    A byte goes when a window of ``length`` bytes over it starts anywhere else too: in another document, in
    a repeated row, or in the same text, overlaps included. Null texts count as empty and lose nothing, as
    do texts shorter than a window. Columns of these names in the input are replaced.
    """
    found = find_repeats(docs, text, **settings)
    kinds = "array<struct<start:int,end:int>>"
    own = {c: spare(docs, f"own_{c}") for c in docs.columns if c.lower() in ("id1", "id2")}
    rows = _identified(docs.drop("n_bytes", "spans", "kept").withColumnsRenamed(own), text).join(found, ["id1", "id2"], "left")
    rows = rows.withColumn("spans", F.coalesce("spans", F.array().cast(kinds)))

    @F.arrow_udf("binary")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts, spans in _parts(*batch):
                yield pa.array((_cut(t, s) for t, s in zip(texts, spans, strict=True)), pa.binary())
        give_back()

    @F.arrow_udf("string")
    def whole(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for (texts,) in _parts(batch):
                yield pa.array((_unpacked(t.as_buffer()).decode() if t.is_valid else None for t in texts), pa.string())
        give_back()

    return rows.withColumn("kept", cut(text, "spans")).withColumn(text, whole(text)).drop("id1", "id2").withColumnsRenamed({v: k for k, v in own.items()})


def repeats_digest(removed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return removed.select(
        F.col(doc_id).alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
