"""A Merkle manifest of a table: a tree per group, a tree over the groups' roots, and a proof for every row.

Trees are built from the bottom in aligned blocks of leaves, a shuffle for every ``SPAN`` levels. Proofs come by
pointer jumping: a node starts with its own sibling and a pointer to its parent; a self-join appends to each
segment that of the node it points to, which doubles the distance covered, until every leaf points to the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikelens.llm.common import table_of
from spikelens.sources import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SPAN = 10  # levels built in one shuffle: blocks of 1,024 nodes
SMALL_ROWS = 20_000  # a side of a join with at most so many rows, counted first, is broadcast
TOP = -1  # the tree over the groups' roots
# What a step of a segment says of the sibling.
ALONE, RIGHT, LEFT = 0, 1, 2


def encoded(value: Column) -> Column:
    """A field as text that can't be taken for another: its UTF-8 length, a colon, the value; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(f) for f in fields]), 256))


def _digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def _sized(df: DataFrame) -> DataFrame:
    """``df``, broadcast if it is small by count."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def _numbered(df: DataFrame, group: list[str], order: list[Column], label: str) -> tuple[DataFrame, DataFrame]:
    """Staged rows with ``_part`` and ``_at``, and the ``runs`` that turn these into places within a group.

    Rows are range-partitioned and sorted; a group may cross partitions, and only its count in each of them is
    summed up. The place of a row is ``_at`` plus its run's ``_shift``.
    """
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in group] + order
    ranged = df.repartitionByRange(wanted, *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stage(ranged.select("*", F.spark_partition_id().alias("_part"), place.alias("_at")), label)
    counts = rows.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.select(*group, "_part", "_n", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows, runs


_NODES = pa.schema(
    [("tree", pa.int64()), ("level", pa.int32()), ("pos", pa.int64()), ("size", pa.int64()), ("digest", pa.binary()), ("seg", pa.binary()),
     ("open", pa.bool_()), ("top", pa.bool_()), ("row", pa.int64()), ("claim", pa.binary())]
)
_NODES_DDL = "tree long, level int, pos long, size long, digest binary, seg binary, open boolean, top boolean, row long, claim binary"


def _nodes(leaves: DataFrame, span: int) -> DataFrame:
    """All nodes of the trees over ``tree, pos, size, digest, row, claim``; a segment holds a node's own sibling.

    Every round builds ``span`` levels within aligned blocks; the blocks' tops are the next round's leaves.
    """
    made, current, level = None, leaves, 0
    while True:
        dealt = current.withColumn("block", F.shiftright("pos", span)).repartition("tree", "block").sortWithinPartitions("tree", "pos")

        def climb(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            out, held, key = [], [], None
            for batch in batches:
                for tree, pos, size, digest, row, claim in zip(*(c.to_pylist() for c in batch.columns)):
                    if key is not None and key[:2] != (tree, pos >> span):
                        out += _block(*key, level, held, span)
                        held = []
                    key = (tree, pos >> span, size)
                    held.append((digest, row, claim))
                    if len(out) >= 8192:
                        yield table_of(_NODES, list(zip(*out)))
                        out = []
            if key is not None:
                out += _block(*key, level, held, span)
            yield table_of(_NODES, list(zip(*out)) if out else [[]] * len(_NODES))

        built = stage(dealt.select("tree", "pos", "size", "digest", "row", "claim").mapInArrow(climb, _NODES_DDL), "nodes")
        done = built.filter(~F.col("open"))
        made = done if made is None else made.unionByName(done)
        current = built.filter("open")
        if current.isEmpty():
            return made
        level += span


def _block(tree: int, block: int, size: int, level: int, rows: list[tuple], span: int) -> list[tuple]:
    """Nodes above one block of up to 2**span neighbours, as far as the block reaches or the tree's top."""
    out, digests = [], [r[0] for r in rows]
    first, width, bottom = block << span, -(-size >> level), level
    for _ in range(span):
        if width == 1:
            break
        for k, digest in enumerate(digests):
            if k ^ 1 < len(digests):
                step = bytes([LEFT if k & 1 else RIGHT]) + digests[k ^ 1]
            else:
                step = bytes([ALONE])
            leaf = rows[k][1:] if level == bottom else (None, None)
            out.append((tree, level, first + k, size, digest if level == 0 else None, step, False, False, *leaf))
        digests = [_digest(*digests[k : k + 2]) for k in range(0, len(digests), 2)]
        first, width, level = first >> 1, (width + 1) >> 1, level + 1
    leaf = rows[0][1:] if level == bottom else (None, None)
    out.append((tree, level, first, size, digests[0], b"", width > 1, width == 1, *leaf))
    return out


def _height(size: int) -> int:
    return (size - 1).bit_length()


def merkle_proofs(docs: DataFrame, leaf: Column, claim: Column | None = None, group: str = "lang", row: str = "doc_id", span: int = SPAN) -> DataFrame:
    """``row, leaf, claim, proof, subroot, root`` for every row of ``docs``.

    Within a group (null is a group, the first) leaves ascend by ``row``, an integer (nulls first), rows with one
    id by their digest; equal rows are leaves of their own. While several nodes remain, every two consecutive
    ones, of the last run perhaps one, become the digest of their hexadecimal texts; what remains is the
    ``subroot``, and these, by group in binary order, give ``root`` in the same way. ``claim`` is another digest to
    hold against the proof (null: none). ``proof`` has a byte for each level, which says whether there is a
    sibling and on which side, followed by its 32 bytes. An empty table has no rows.
    """
    columns = [F.col(row).cast("long").alias("row"), F.col(group).isNotNull().cast("int").alias("_named"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("_group")]
    claimed = F.lit(None).cast("binary") if claim is None else claim
    leaves = stage(docs.select(*columns, leaf.alias("digest"), claimed.alias("claim")), "leaves")
    rows, runs = _numbered(leaves, ["_named", "_group"], [F.col("row").asc_nulls_first(), F.col("digest")], "ranked")
    groups, group_runs = _numbered(runs.groupBy("_named", "_group").agg(F.sum("_n").alias("size")), [], [F.col("_named"), F.col("_group")], "groups")
    trees = groups.join(_sized(group_runs), "_part").select("_named", "_group", "size", (F.col("_at") + F.col("_shift")).alias("tree"))
    sizes = trees.agg(F.count(F.lit(1)), F.max("size")).first()
    if not sizes[0]:
        return docs.sparkSession.createDataFrame([], "row long, leaf binary, claim binary, proof binary, subroot binary, root binary")
    places = runs.join(_sized(stage(trees, "trees")), ["_named", "_group"])
    placed = rows.join(_sized(stage(places, "runs")), ["_named", "_group", "_part"])
    within = _nodes(placed.select("tree", (F.col("_at") + F.col("_shift")).alias("pos"), "size", "digest", "row", "claim"), span)
    subroots = stage(within.filter("top").select("tree", F.col("digest").alias("subroot")), "subroots")
    none = [F.lit(None).cast("long").alias("row"), F.lit(None).cast("binary").alias("claim")]
    above = _nodes(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(sizes[0]).cast("long").alias("size"), F.col("subroot").alias("digest"), *none), span)
    root = above.filter("top").select("digest").first()[0]

    # A group's top goes on as a leaf of the upper tree, without a step of its own.
    up = [F.when(F.col("top"), x).otherwise(y) for x, y in ((F.lit(TOP), F.col("tree")), (F.lit(0), F.col("level") + 1), (F.col("tree"), F.shiftright("pos", 1)))]
    nodes = within.unionByName(above.filter(~F.col("top")))
    nodes = nodes.select("tree", "level", "pos", "row", "claim", F.when(F.col("level") == 0, F.col("digest")).alias("leaf"), "seg", up[0].cast("long").alias("up_tree"), up[1].cast("int").alias("up_level"), up[2].cast("long").alias("up_pos"))
    end = (F.col("up_tree") == TOP) & (F.col("up_level") == _height(sizes[0]))
    longest = _height(sizes[1]) + 1 + _height(sizes[0])
    distance = 1
    while distance < longest:
        # Leaves only ever point to nodes at a multiple of the distance; the others are done with.
        useful = (F.col("tree") == TOP) | (F.col("level") % distance == 0)
        targets = nodes.filter(useful & ((F.col("tree") == TOP) | (F.col("level") >= distance))).select(
            F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("pos").alias("up_pos"), F.col("seg").alias("_seg"),
            F.struct("up_tree", "up_level", "up_pos").alias("_up"),
        )
        distance *= 2
        sources = nodes.filter((F.col("tree") == TOP) | (F.col("level") % distance == 0))
        met = sources.filter(~end).join(_sized(targets), ["up_tree", "up_level", "up_pos"])
        longer = met.select("tree", "level", "pos", "row", "claim", "leaf", F.concat("seg", "_seg").alias("seg"), "_up.*")
        nodes = stage(longer.unionByName(sources.filter(end).select(longer.columns)), "segments")
    proofs = nodes.filter((F.col("level") == 0) & (F.col("tree") != TOP))
    return proofs.join(_sized(subroots), "tree").select("row", "leaf", "claim", F.col("seg").alias("proof"), "subroot", F.lit(root).alias("root"))


def siblings_of(proof: bytes) -> list[tuple[int, bytes]]:
    """The steps of a proof: on which side the sibling is, and its digest."""
    out, at = [], 0
    while at < len(proof):
        side = proof[at]
        size = 0 if side == ALONE else 32
        out.append((side, proof[at + 1 : at + 1 + size]))
        at += 1 + size
    return out


def fold(leaf: bytes, steps: list[tuple[int, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for side, sibling in steps:
        leaf = _digest(leaf) if side == ALONE else _digest(leaf, sibling) if side == RIGHT else _digest(sibling, leaf)
    return leaf


_CHECKED = pa.schema([("row", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())])


def verify_proofs(proofs: DataFrame) -> DataFrame:
    """``row, leaf, subroot, root, proof_sha256, folded_root, verified``, digests as hexadecimal text.

    ``folded_root`` is computed from the claim, or from the leaf where there is none, and the proof's siblings;
    ``verified`` tells whether it is the root. ``proof_sha256`` is the digest of the siblings' texts in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                out = []
                for row, leaf, claim, proof, subroot, root in zip(*(c.to_pylist() for c in whole.slice(start, 1024).columns)):
                    steps = siblings_of(proof)
                    folded = fold(leaf if claim is None else claim, steps)
                    out.append((row, leaf.hex(), subroot.hex(), root.hex(), _digest(*[s for _, s in steps]).hex(), folded.hex(), folded == root))
                yield table_of(_CHECKED, list(zip(*out)))

    ordered = proofs.select("row", "leaf", "claim", "proof", "subroot", "root")
    return ordered.mapInArrow(run, "row long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def tampered_leaf(every: int = 7, row: str = "doc_id", changed: str = "n_chars", fields: tuple = FIELDS) -> Column:
    """The leaf of a row whose ``changed`` is one more, for rows whose id's crc32 ``every`` divides; else null.

    A null ``changed`` stays, a null id is never chosen. The addition can't overflow.
    """
    chosen = F.crc32(F.col(row).cast("long").cast("string").cast("binary")) % every == 0
    more = F.col(changed).cast("decimal(20,0)") + 1
    return F.when(chosen, leaf_of(*[more if f == changed else F.col(f) for f in fields]))
