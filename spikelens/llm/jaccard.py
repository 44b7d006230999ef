"""Exact Jaccard join of word n-gram sets by partitioning the universe of tokens.

Tokens are hashed into segments, as many as a size band needs. If two sets are similar they differ in so
few tokens that, of H + 1 segments that one of them fills, one at least must be equal in both. Segments
are first indexed as a whole: a set with H + 1 segments that no other set has is done, which leaves few.
For these the segments to look up are chosen by cost, as whole subsets or with their one-token deletions,
and every pair found is verified on the sets themselves. Where many sets are gathered around one, as copies
of a text are, a look-up finds blocks of them, and a set is held against a block at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spikelens.llm.common import HASHES, mix, slices, spare, table_of, text_bytes
from spikelens.llm.components import components
from spikelens.sources import stage, unstage

WORDS = 5
PERCENT = 75
#: Segments per size of a band's upper end, on the first level; the next ones are for sets that leave too many empty.
DENSITY = (0.42, 4.0)
ANCHOR_ROUNDS = 1
#: Sets whose subset look-ups would meet more other sets than this weigh one-deletion look-ups against them.
EXPENSIVE = 50_000
#: Words of the sketch: every token flips one bit, so two sketches differ in no more bits than the sets in tokens.
SKETCH = 8
#: Keys before a key that two sets are held against, so that a pair is met once and not at every key it shares.
EARLIER = 10
#: So many sets around one central set are met in blocks of about so many tokens, not one by one.
CROWD = 32
BLOCK = 1 << 18

_BLOCK = "bucket int, kind int, nodes binary, a binary, b binary, c binary, d binary, e binary"
_SHARED = "kind int, doc_id long, node long, h2 long, size int, own int, low int, part int, sig long"


def _types(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of every text's word n-grams, A-Z in lower case."""
    split = [t.lower().split() for t in texts]
    sizes = [len(w) for w in split]
    flat = HASHES.words([w for ws in split for w in ws])
    n = max(len(flat) - words + 1, 0)
    grams = np.full(n, np.uint64(words))
    with np.errstate(over="ignore"):
        for i in range(words):
            grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) ^ flat[i : i + n])
        out, at = [], 0
        for size in sizes:
            if size >= words:
                out.append(np.unique(grams[at : at + size - words + 1]))
            elif size:
                h = np.array([size + 1000], np.uint64)
                for w in flat[at : at + size]:
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) ^ w)
                out.append(h)
            else:
                out.append(np.zeros(0, np.uint64))
            at += size
    return out


def band_of(size: np.ndarray) -> np.ndarray:
    """Sizes 1, 2-3, 4-7, ... are bands 0, 1, 2, ..."""
    return np.frexp(np.asarray(size, float))[1] - 1


def lowest_band(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The band of the smallest set that may be similar to one of this size: it lies at most one below."""
    return band_of(np.maximum(-(-np.asarray(size, np.int64) * percent // 100), 1))


def most_different(size, band, percent: int = PERCENT):
    """H: tokens in which a set may differ from any similar set, where the smaller of the two is in ``band``."""
    size, band = np.asarray(size, np.int64), np.asarray(band, np.int64)
    own = band_of(size) == band
    # |s - r| + |r - s| <= (100 - p) / (100 + p) * (|r| + |s|), the partner at most 100 / p as large.
    other = np.where(own, size * 100 // percent, np.minimum(size, (1 << (band + 1)) - 1))
    return (100 - percent) * (size + other) // (100 + percent)


def segments(tokens: np.ndarray, owner: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each token, and the first token of every segment that is filled.

    Segments are ranges of the hash, so sorted tokens come segment by segment.
    """
    place = ((tokens >> np.uint64(32)) * count[owner].astype(np.uint64)) >> np.uint64(32)
    new = np.ones(len(tokens), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    return place, np.flatnonzero(new)


def _part_sigs(tokens, owner, sizes, band, level):
    """(owner, segment key) of every filled segment of the sets, under the partition of ``band`` and ``level``."""
    if level < len(DENSITY):
        count = np.maximum(1, np.ceil(DENSITY[level] * (2.0 ** (band + 1)))).astype(np.int64)
        place, starts = segments(tokens, owner, count)
    else:  # every token is a segment of its own
        place, starts = tokens, np.arange(len(tokens))
    with np.errstate(over="ignore"):
        total = np.add.reduceat(mix(tokens), starts) if len(starts) else np.zeros(0, np.uint64)
        part = (band[owner[starts]] + 100 * level).astype(np.uint64)
        return owner[starts], place[starts], total, mix(total + mix(place[starts] * np.uint64(8191) + part + np.uint64(1)))


def _take(tokens, bounds, chosen):
    """Tokens and owners of some of the sets."""
    sizes = np.diff(bounds)[chosen]
    keep = np.repeat(np.isin(np.arange(len(bounds) - 1), chosen), np.diff(bounds))
    return tokens[keep], np.repeat(np.arange(len(chosen)), sizes), sizes


def signatures(sets: list[np.ndarray], percent: int = PERCENT):
    """Per set its filled segments in its own band and the one below (0 if it needs none), and all keys.

    Returns (own, low, owner, part, key). A set that fills fewer than H + 1 segments of a level is keyed
    under the next level as well; on the last level each token is a segment, and l > H.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    tokens = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    totals, keys = np.zeros((2, len(sets)), np.int64), []
    for step, first in enumerate((band_of(np.maximum(sizes, 1)), lowest_band(np.maximum(sizes, 1), percent))):
        chosen = np.flatnonzero((sizes > 0) & ((step == 0) | (first != band_of(np.maximum(sizes, 1)))))
        for level in range(len(DENSITY) + 1):
            if not len(chosen):
                break
            some, owner, own_sizes = _take(tokens, bounds, chosen)
            band = first[chosen]
            who, _, _, sig = _part_sigs(some, owner, own_sizes, band, level)
            filled = np.bincount(who, minlength=len(chosen))
            if level == 0:
                totals[step][chosen] = filled
            keys.append((chosen[who], (band[who] + 100 * level).astype(np.int64), sig))
            chosen = chosen[filled <= most_different(own_sizes, band, percent)]
    owner, part, sig = (np.concatenate(x) for x in zip(*keys, strict=True)) if keys else (np.zeros(0, np.int64),) * 3
    return totals[0], totals[1], owner, part, sig


def set_hashes(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set."""
    with np.errstate(over="ignore"):
        one = [mix(np.uint64(len(s)) + mix(s).sum(dtype=np.uint64)) for s in sets]
        two = [mix(np.uint64(len(s)) + mix(s ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)) for s in sets]
    return np.array(one, np.uint64).reshape(-1).view(np.int64), np.array(two, np.uint64).reshape(-1).view(np.int64)


def _emit_blocks(schema, doc_ids, sets, buckets, turn):
    """One row of set facts and one row of sorted keys per bucket: few rows, however many keys."""
    node, h2 = set_hashes(sets)
    own, low, owner, part, sig = signatures(sets)
    sizes = np.array([len(s) for s in sets], np.int32)
    known = np.array([d is not None for d in doc_ids])
    ids = np.array([d if d is not None else 0 for d in doc_ids], np.int64)
    raw = lambda x, kind: x.astype(kind).tobytes()
    yield [turn % buckets, 0, raw(node, "<i8"), raw(ids, "<i8"), raw(h2, "<i8"), raw(sizes, "<i4"), raw(own, "<i4") + raw(low, "<i4"), raw(known, "u1")]
    _, first = np.unique(node, return_index=True)  # copies within the piece are keyed once
    keep = np.isin(owner, first)
    owner, part, sig = owner[keep], part[keep], sig[keep]
    order = np.argsort(sig)
    owner, part, sig = owner[order], part[order], sig[order]
    where = ((sig >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.searchsorted(where, np.arange(buckets + 1, dtype=np.uint64))
    for b in range(buckets):
        i, j = edges[b], edges[b + 1]
        if i < j:
            used, local = np.unique(owner[i:j], return_inverse=True)
            yield [b, 1, raw(node[used], "<i8"), raw(sig[i:j], "<u8"), raw(local, "<u2"), raw(part[i:j], "<u2"), None, None]


def _find_shared(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """All blocks of a bucket: the facts as rows, and the keys that two sets or more have."""
    nodes, sigs, parts = [], [], []
    for batch in batches:
        for _, kind, node, a, b, c, d, e in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            node = np.frombuffer(node, "<i8")
            if kind == 0:
                n = len(node)
                known, totals = np.frombuffer(e, "u1") > 0, np.frombuffer(d, "<i4")
                ids = pa.array(np.frombuffer(a, "<i8"), pa.int64(), mask=~known)
                none = pa.nulls(n, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), ids, pa.array(node), pa.array(np.frombuffer(b, "<i8")), pa.array(np.frombuffer(c, "<i4")), pa.array(totals[:n]), pa.array(totals[n:]), none, pa.nulls(n, pa.int64())], schema=schema)
            else:
                sigs.append(np.frombuffer(a, "<u8"))
                nodes.append(node[np.frombuffer(b, "<u2")])
                parts.append(np.frombuffer(c, "<u2"))
    if not sigs:
        return
    sig, node, part = np.concatenate(sigs), np.concatenate(nodes), np.concatenate(parts)
    del sigs, nodes, parts
    order = np.argsort(sig)
    twice = np.zeros(len(sig), bool)
    equal = sig[order][1:] == sig[order][:-1]
    twice[1:] |= equal
    twice[:-1] |= equal
    order = order[twice]
    sig, node, part = sig[order], node[order], part[order]
    order = np.lexsort((node, sig))
    sig, node, part = sig[order], node[order], part[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node, part = sig[new], node[new], part[new]
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([starts, [len(sig)]]))
    keep = np.repeat(counts > 1, counts)
    sig, node, part = sig[keep], node[keep], part[keep]
    for i in range(0, len(sig), 1 << 17):
        n = len(sig[i : i + (1 << 17)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), pa.array(node[i : i + n]), pa.nulls(n, pa.int64()), *(pa.nulls(n, pa.int32()) for _ in range(3)), pa.array(part[i : i + n].astype(np.int32)), pa.array(sig[i : i + n].view(np.int64))],
            schema=schema,
        )


def _different(size: str, part: str, percent: int = PERCENT):
    """``most_different`` as a column, for parts of any level."""
    band = F.col(part) % 100
    upper = F.pow(F.lit(2.0), band + 1).cast("long") - 1
    own = F.floor(F.log2(F.col(size) + F.lit(0.5))) == band
    other = F.when(own, F.floor(F.col(size) * 100 / percent)).otherwise(F.least(F.col(size), upper))
    return F.floor((100 - percent) * (F.col(size) + other) / (100 + percent))


def _prune(keys: DataFrame, facts: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Drop the sets that have more than H segments of their own, and keys that one set is left with.

    Adds ``need``: the shared segments that must still be looked up. Returns the staged table it reads as well.
    """
    held = keys.groupBy("node", "part").agg(F.count("*").alias("held"))
    judged = held.join(facts, "node").withColumn("total", F.when(F.col("part") >= 100, F.col("held")).when(F.col("part") == F.floor(F.log2(F.col("size") + F.lit(0.5))), F.col("own")).otherwise(F.col("low")))
    left = judged.withColumn("need", _different("size", "part") + 1 - (F.col("total") - F.col("held"))).filter("need > 0").select("node", "part", "need", "size")
    kept = stage(keys.select("node", "part", "sig").join(left, ["node", "part"]), label)
    alive = kept.groupBy("sig").agg(F.min("node").alias("_a"), F.max("node").alias("_b")).filter("_a <> _b").select("sig")
    return kept.join(alive, "sig"), kept


def _sets_of(docs: DataFrame, wanted: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``node, size, tokens`` and the sketch of the sets still in question, from one document of each."""
    sketch = [f"b{i}" for i in range(SKETCH)]
    schema = pa.schema([("node", pa.int64()), ("size", pa.int32()), ("tokens", pa.binary()), *((b, pa.int64()) for b in sketch)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text=0):
            sets = shingle_sets(piece.column(0).to_pylist())
            bits = [np.packbits(np.bincount((s % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1 > 0).view(np.int64) for s in sets]
            yield table_of(schema, [set_hashes(sets)[0], [len(s) for s in sets], [s.astype("<u8").tobytes() for s in sets], *np.stack(bits, 1)])

    ids = wanted.select(F.col("doc_id").alias("_doc")).distinct()
    texts = docs.join(ids, F.col(doc_id) == F.col("_doc"), "left_semi").select(text_bytes(text))
    return stage(texts.mapInArrow(run, "node long, size int, tokens binary, " + ", ".join(f"{b} long" for b in sketch)).dropDuplicates(["node"]), "sets")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int, label: str) -> DataFrame:
    """The pairs ``a, b`` of sets whose Jaccard similarity is at least ``percent``."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                if 100 * same >= percent * (len(both) - same):
                    found.append((a, b))
            yield table_of(schema, list(zip(*found, strict=True)) if found else [[], []])

    one = sets.select(F.col("node").alias("a"), F.col("size").alias("m"), F.col("tokens").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("size").alias("n"), F.col("tokens").alias("y"))
    sized = pairs.join(one, "a").join(two, "b").filter((100 * F.col("m") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("m")))
    return stage(sized.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), label)


def _with_components(keys: DataFrame, links: DataFrame) -> DataFrame:
    known = components(links)
    return keys.join(known, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _before(node: str):
    """The keys of a set that come just before a key, in order."""
    order = Window.partitionBy(node).orderBy("sig")
    return F.array(*[F.lag("sig", k).over(order) for k in range(1, EARLIER + 1)])


def _crowds(nodes: DataFrame, best: DataFrame) -> DataFrame:
    """``node, comp, size, block`` of the sets that many others share their most central set ``best`` with.

    Those that are linked to it and those that are not make different blocks.
    """
    led = nodes.join(best.select(F.col("b").alias("node"), F.col("a").alias("lead")), "node", "left").withColumn("lead", F.coalesce("lead", "node"))
    led = led.join(nodes.select(F.col("node").alias("lead"), F.col("comp").alias("_of")), "lead", "left").withColumn("linked", F.coalesce(F.col("comp") == F.col("_of"), F.lit(False)))
    crowd = led.groupBy("lead").agg(F.count("*").alias("_n"), *(F.sum(F.when(F.col("linked") == on, F.col("size")).otherwise(0)).alias(f"_t{int(on)}") for on in (False, True)))
    room = F.ceil(F.when(F.col("linked"), F.col("_t1")).otherwise(F.col("_t0")) / BLOCK)
    block = F.xxhash64("lead", "linked", F.pmod(F.xxhash64("node"), F.greatest(room, F.lit(1))))
    return led.join(crowd.filter(F.col("_n") >= CROWD), "lead").select("node", "comp", "size", block.alias("block"))


class _Block:
    """Sets by their tokens: how many of them a set shares with each is counted over all at once."""

    def __init__(self, nodes: list[int], comps: list[int], sets: list[np.ndarray]):
        self.nodes, self.comps = np.array(nodes, np.int64), np.array(comps, np.int64)
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        self.tokens, self.starts = np.unique(flat[order], return_index=True)
        self.counts = np.diff(np.append(self.starts, len(flat)))

    def similar(self, tokens: np.ndarray, comp: int, percent: int) -> list[int]:
        """A similar set of every component but ``comp`` that has one."""
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        at = at[self.tokens[at] == tokens]
        n = self.counts[at]
        places = np.repeat(self.starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        same = np.bincount(self.owner[places], minlength=len(self.nodes))
        found = np.flatnonzero((100 * same >= percent * (len(tokens) + self.sizes - same)) & (self.comps != comp))
        return self.nodes[found[np.unique(self.comps[found], return_index=True)[1]]].tolist()


def _crowd_pairs(now: DataFrame, crowds: DataFrame, probes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links ``a, b`` of sets to members of crowds: blocks that a looked-up segment leads to are held against the set.

    A block's tokens travel once, and a set's once for each block, however many pairs these make.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members, made = None, [], None
        for batch in batches:
            found = []
            for block, kind, node, comp, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != at:
                    at, members, made = block, [], None
                tokens = np.frombuffer(tokens, "<u8")
                if kind == 0:
                    members.append((node, comp, tokens))
                else:
                    made = made or _Block(*zip(*members, strict=True))
                    found += [(min(node, r), max(node, r)) for r in made.similar(tokens, comp, percent)]
            yield table_of(schema, list(zip(*found, strict=True)) if found else [[], []])

    held = now.filter("block is not null").join(probes.select("sig").distinct(), "sig", "left_semi")
    held = held.groupBy("sig", "block").agg(F.min("comp").alias("_f"), F.max("comp").alias("_l"), F.min("size").alias("least"), F.max("size").alias("most"))
    sized = (100 * F.col("size") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("size"))
    other = (F.col("_f") != F.col("comp")) | (F.col("_l") != F.col("comp"))
    asks = probes.select("node", "size", "comp", "sig").distinct().join(held, "sig").filter(sized & other).select("node", "comp", "block").distinct()
    each = crowds.select("node", "comp", "block", F.lit(0).alias("kind")).unionByName(asks.withColumn("kind", F.lit(1)))
    dealt = each.join(sets.select("node", "tokens"), "node").select("block", "kind", "node", "comp", "tokens")
    return stage(dealt.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(run, "a long, b long").distinct(), "crowded")


def _deletion_pairs(costly: DataFrame, others: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidates of sets whose plain look-ups are dear, with one-deletion neighbourhoods by cost.

    They and the ``others``, which are sets that share a segment with them, are indexed by its segments and by its segments less one token. A
    dear set then spends H + 1 units: one unit on a segment finds equal segments, two units those that
    differ in one token as well; units go where the index lists are shortest. Returns the staged index as well.
    """
    members = others.select("node", "part").union(costly.select("node", "part")).distinct().join(sets, "node")
    schema = pa.schema([("node", pa.int64()), ("part", pa.int32()), ("seg", pa.int64()), ("kind", pa.int32()), ("key", pa.int64())])

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, part, size, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = np.frombuffer(tokens, "<u8")
                band, owner = np.array([part % 100]), np.zeros(size, np.int64)
                _, seg, total, _ = _part_sigs(tokens, owner, np.array([size]), band, part // 100)
                starts = segments(tokens, owner, np.maximum(1, np.ceil(DENSITY[part // 100] * 2.0 ** (band + 1))).astype(np.int64))[1] if part // 100 < len(DENSITY) else np.arange(size)
                of = np.repeat(np.arange(len(seg)), np.diff(np.append(starts, size)))
                with np.errstate(over="ignore"):
                    salt = mix(seg * np.uint64(8191) + np.uint64(part + 1))
                    whole, less = mix(total + salt), mix(total[of] - mix(tokens) + salt[of])
                n = len(seg) + size
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, node)), pa.array(np.full(n, part, np.int32)), pa.array(np.concatenate([seg, seg[of]]).view(np.int64)), pa.array(np.repeat(np.array([0, 1], np.int32), [len(seg), size])), pa.array(np.concatenate([whole, less]).view(np.int64))],
                    schema=schema,
                )

    index = stage(members.select("node", "part", "size", "tokens").mapInArrow(neighbours, "node long, part int, seg long, kind int, key long"), "neighbours")
    lists = index.groupBy("key").agg(F.sum(F.expr("int(kind = 0)")).alias("wholes"), F.sum("kind").alias("lesses"))
    own = index.join(costly.select("node", "part", "size"), ["node", "part"]).join(lists, "key")
    per = own.groupBy("node", "part", "size", "seg").agg(
        (F.max(F.when(F.col("kind") == 0, F.col("wholes"))) - 1).alias("c1"),
        (F.sum(F.when(F.col("kind") == 0, F.col("lesses")).otherwise(F.col("wholes")))).alias("c2"),
    )
    units = per.select("node", "part", "size", "seg", F.explode(F.array(F.struct(F.lit(1).alias("unit"), F.col("c1").alias("cost")), F.struct(F.lit(2).alias("unit"), F.greatest("c1", "c2").alias("cost")))).alias("u"))
    order = Window.partitionBy("node", "part").orderBy("u.cost", "u.unit", "seg")
    spent = units.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= _different("size", "part") + 1)
    level = spent.groupBy("node", "part", "seg").agg(F.max("u.unit").alias("units"))
    probes = own.select("node", "part", "seg", "kind", "key").join(level, ["node", "part", "seg"]).filter("kind = 0 or units = 2")
    met = probes.select(F.col("node").alias("s"), "kind", "units", "key").join(index.select(F.col("node").alias("r"), F.col("kind").alias("other"), "key"), "key")
    # Whole meets whole always; whole meets less, and less whole, for two units; less never meets less.
    pairs = met.filter((F.col("s") != F.col("r")) & (F.col("kind") + F.col("other") <= F.when(F.col("units") == 2, 1).otherwise(0))).select("s", "r").distinct()
    return pairs, index


def jaccard_components(docs: DataFrame, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; exact for every pair.

    Sets of 5-word shingles of the whole text, A-Z in lower case; fewer words are one shingle. Two documents
    link at a Jaccard similarity of ``percent`` or more, and ``component_id`` is the smallest id that links
    reach. Equal sets are one node, by 128 bits of hash. Empty sets link with nothing; rows without an id
    are returned as they are, with no component. Rows with equal ids are one document, linked to each other.
    """
    spark = docs.sparkSession
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4)
    blocks, shared = _types(_BLOCK), _types(_SHARED)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, piece in enumerate(slices(batches)):
            sets = shingle_sets(piece.column(1).to_pylist())
            yield table_of(blocks, list(zip(*_emit_blocks(blocks, piece.column(0).to_pylist(), sets, buckets, turn), strict=True)))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("_text"))
    dealt = rows.mapInArrow(emit, _BLOCK).repartition(buckets, "bucket")
    found = stage(dealt.mapInArrow(lambda batches: _find_shared(batches, shared), _SHARED), "shared")
    info = found.filter("kind = 0").select("doc_id", "node", "h2", "size", "own", "low")
    facts = info.filter("size > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), *(F.max(c).alias(c) for c in ("size", "own", "low")))
    keys = found.filter("kind = 1").select("node", "part", "sig")
    keys, held = _prune(keys, facts, "held")
    keys = stage(keys, "keys")
    unstage(held)
    sets = _sets_of(rows, facts.join(keys.select("node").distinct(), "node", "left_semi"), "_text", "doc_id")

    # Rows of one id are one document.
    twins = info.filter("size > 0").groupBy("doc_id").agg(F.min("node").alias("_a"), F.collect_set("node").alias("all")).filter("doc_id is not null and size(all) > 1")
    links = twins.select(F.col("_a").alias("a"), F.explode("all").alias("b")).filter("a <> b")
    links = stage(links, "links")
    leads = spark.createDataFrame([], "a long, b long")
    for turn in range(ANCHOR_ROUNDS):
        # Each set is held against one other, the most central of those that most of its keys lead to:
        # the text that copies were made from shares its segments with more of them than any copy does.
        now = stage(_with_components(keys, links), "now")
        often = now.groupBy("sig").agg(F.count("*").alias("n"))
        central = now.join(often, "sig").groupBy("node").agg(F.sum("n").alias("central"))
        firsts = now.join(central, "node").groupBy("sig").agg(F.max(F.struct("central", "node", "comp")).alias("_f")).select("sig", F.col("_f.comp").alias("fc"), F.col("_f.node").alias("a"))
        met = now.join(firsts, "sig").filter("comp <> fc").groupBy("node", "a").agg(F.count("*").alias("n"))
        best = met.groupBy("node").agg(F.max(F.struct("n", "a")).alias("best")).select(F.col("best.a").alias("a"), F.col("node").alias("b"))
        best = stage(best, "best")
        leads = best if turn == 0 else leads
        more = _verify(best, sets, percent, f"anchors{turn}")
        unstage(now)
        if more.isEmpty():
            break
        links = links.union(more)
    now = _with_components(keys, links)
    crowds = stage(_crowds(now.select("node", "comp", "size").distinct(), leads), "crowds")
    now = stage(now.join(crowds.select("node", "block"), "node", "left"), "now")
    # Segments that the very same sets have lead to the same pairs: the least of them stands for all.
    among = [F.bit_xor(F.xxhash64("node")).alias("_x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("_y")]
    split = now.groupBy("sig").agg(F.min("comp").alias("_f"), F.max("comp").alias("_l"), F.count("*").alias("n"), F.count_if(F.col("block").isNull()).alias("alone"), *among).filter("_f <> _l")
    apart = stage(split.select("sig", "n", "alone", "_x", "_y"), "split")
    stands = apart.groupBy("_x", "_y", "n").agg(F.min("sig").alias("same"))
    split = apart.join(stands, ["_x", "_y", "n"]).select("sig", "n", "alone", "same")
    # What a look-up costs: the sets met one by one; crowds are met in blocks.
    in_comp = now.groupBy("sig", "comp").agg(F.count_if(F.col("block").isNull()).alias("own_n"))
    open_keys = now.join(split, "sig").join(in_comp, ["sig", "comp"]).withColumn("cost", F.col("alone") - F.col("own_n"))
    settled = now.groupBy("node", "part").agg(F.count("*").alias("all_n"))
    still = open_keys.groupBy("node", "part").agg(F.count("*").alias("open_n")).join(settled, ["node", "part"]).select("node", "part", (F.col("all_n") - F.col("open_n")).alias("free"))
    order = Window.partitionBy("node", "part").orderBy("cost", "n", "sig")
    probes = open_keys.join(still, ["node", "part"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= F.col("need") - F.col("free"))
    probes = stage(probes.select("node", "part", "size", "comp", F.col("same").alias("sig"), "cost"), "probes")
    costly = stage(probes.groupBy("node", "part", "size").agg(F.sum("cost").alias("cost")).filter(F.col("cost") > EXPENSIVE), "costly")
    sketch = sets.select("node", *(f"b{i}" for i in range(SKETCH)))
    alone = now.filter("block is null")
    index = alone.join(probes.select("sig").distinct(), "sig", "left_semi").join(sketch, "node")
    index = index.select(F.col("node").alias("r"), F.col("comp").alias("rc"), F.col("size").alias("rs"), "sig", _before("node").alias("r_before"), *(F.col(f"b{i}").alias(f"c{i}") for i in range(SKETCH)))
    asked = probes.join(costly.select("node", "part"), ["node", "part"], "left_anti").select("node", "size", "comp", "sig").distinct().join(sketch, "node").withColumn("before", _before("node"))
    # At the least key that both have, none before it is common; at later ones a pair has mostly been met already.
    unmet = ~F.coalesce(F.arrays_overlap("before", "r_before"), F.lit(False))
    flips = sum((F.bit_count(F.col(f"b{i}").bitwiseXOR(F.col(f"c{i}"))) for i in range(SKETCH)), F.lit(0))
    near = (100 + percent) * flips <= (100 - percent) * (F.col("size") + F.col("rs"))
    sized = (100 * F.col("size") >= percent * F.col("rs")) & (100 * F.col("rs") >= percent * F.col("size"))
    plain = asked.join(index, [asked["sig"] == index["sig"], F.col("comp") != F.col("rc"), sized, near, unmet]).select(F.col("node").alias("s"), "r")
    spent = [keys, sets, leads, crowds, now, apart, probes, costly]
    if not costly.isEmpty():
        comp = now.select("node", "comp").distinct()
        # Of H + 1 segments of a set one is equal in any similar set.
        sigs = now.join(costly.select("node", "part"), ["node", "part"], "left_semi").select("sig").distinct()
        dear, neighbours = _deletion_pairs(costly, alone.join(sigs, "sig", "left_semi"), sets, percent)
        spent.append(neighbours)
        dear = dear.join(comp.select(F.col("node").alias("s"), F.col("comp").alias("sc")), "s").join(comp.select(F.col("node").alias("r"), F.col("comp").alias("rc")), "r").filter("sc <> rc").select("s", "r")
        plain = plain.union(dear)
    pairs = plain.select(F.least("s", "r").alias("a"), F.greatest("s", "r").alias("b")).distinct()
    links = links.union(_verify(pairs, sets, percent, "verified"))
    if not crowds.isEmpty():
        links = links.union(_crowd_pairs(now, crowds, probes, sets, percent))
    unstage(*spent)

    known = components(links)
    placed = info.join(known, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = placed.filter("size > 0").groupBy("comp").agg(F.min("doc_id").alias("_least"))
    out = placed.join(least, "comp", "left")
    own = F.when(F.col("doc_id").isNull() | (F.col("size") == 0), F.col("doc_id")).otherwise(F.col("_least"))
    return out.select("doc_id", F.col("size").cast("long").alias("n_shingles"), own.alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents that are their component's smallest id, one row for each id; rows without an id all stay.

    Of rows with one id the one with the least hash of its text stays, equal hashes by the text.
    """
    ids = jaccard_components(docs, text=text, doc_id=doc_id, **settings)
    place = spare(docs, "place")
    kept = ids.filter("component_id = doc_id").select(F.col("doc_id").alias(doc_id)).distinct()
    named = docs.filter(F.col(doc_id).isNotNull()).join(kept, doc_id, "left_semi")
    order = Window.partitionBy(doc_id).orderBy(F.xxhash64(text), text)
    named = named.withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1).drop(place)
    return named.unionByName(docs.filter(F.col(doc_id).isNull()))
