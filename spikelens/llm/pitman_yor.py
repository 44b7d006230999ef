"""Hierarchical Pitman-Yor word model, seated by Gibbs sampling, over a corpus of any size.

Every word sits in the restaurant of its context, the word before it, hashed to one of a number of
restaurants that grows with the text to learn from (``restaurants_for``). All of these share one parent, the restaurant of words without context, whose own parent is
the uniform distribution over the words seen and one more for all others. Words are dealt to buckets by
hash, so a word's customers in every restaurant and its tables in the parent lie in one bucket; they are
counted before they travel, so a bucket holds pairs of word and context, however often they occur. What
buckets need of each other is one table total per restaurant.

The chance of T tables in a restaurant has a factor that ties its dishes together, the rising product of
strength + discount * i for i < T. It is discount ** T times a gamma function, so with a gamma variable of
shape strength / discount + T drawn for each restaurant (``rates``), its dishes are independent given that
variable: a sweep of Gibbs draws the variables given the tables, then the tables of all dishes side by side
given the variables and the parent's predictive probabilities. A sweep is one Spark job. To score, a bucket's
model goes ahead of the occurrences of its words, which pass by it block by block; a bucket with many
occurrences is dealt over several tasks, each with a copy of the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikelens.llm.common import HASHES, give_back, mix, slices, split_of, table_of, text_bytes, trim
from spikelens.sources import stage

#: Bytes of text to learn from for each restaurant, and the least and most restaurants: the most bound the vectors that tasks share.
TEXT_PER_CONTEXT = 4096
LEAST_CONTEXTS, MOST_CONTEXTS = 1 << 13, 1 << 21
SWEEPS = 3
BURN_IN = 1
CHUNK_TOKENS = 500_000
CHUNK_DOCS = 1 << 16
#: The discount of every restaurant: at one half the conditional of a dish's tables has a closed form for any number of customers.
DISCOUNT = 0.5
#: Pairs of word and context worked on at once, cut between words.
PAIRS_AT_ONCE = 100_000
#: Dishes drawn at once, and the share of the likeliest table count below which others are left out.
DRAWN_AT_ONCE = 50_000
NEGLIGIBLE = 1e-14
END, START = np.uint64(1), np.uint64(2)  # below any bound of a bucket: END is in bucket 0

#: Parts that the restaurants are summed in.
SLICES = 16
#: Pairs that wait to be merged into a bucket's counts.
PENDING_PAIRS = 2_000_000

_BLOCK = "place int, kind int, chunk long, words binary, sizes binary, contexts binary, extra binary, doc_ids binary, facts binary"
_STATE = "bucket int, customers long, words binary, pair_word binary, pair_context binary, pair_count binary"
_REPLY = "chunk long, docs binary, totals binary, doc_ids binary, facts binary"
_SUMS = "slice int, contexts binary, tables binary, customers binary, words long, parent long"
_MODEL, _OCCURRENCES = 0, 1


def _types(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def packed(values: np.ndarray) -> bytes:
    """Numbers for the shuffle: bytes of one rank side by side, as the high ones are much alike, and compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpacked(data, kind: str) -> np.ndarray:
    """The numbers that ``packed`` was given; no bytes are no numbers."""
    if not len(data):
        return np.zeros(0, kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


@dataclass
class Totals:
    """What all buckets together know: a few numbers per restaurant, of which there are at most ``MOST_CONTEXTS``."""

    customers: np.ndarray  # of each context's restaurant
    tables: np.ndarray
    words: int
    tokens: int
    parent_tables: float = 0.0
    strength: float = 1.0
    #: Per sweep: the tables it started from, the parent's, and the gamma variables drawn given these, the parent's last.
    history: list[tuple[np.ndarray, float, np.ndarray, float]] = field(default_factory=list)


def restaurants_for(text_bytes: int) -> int:
    """A power of two that grows with the text."""
    wanted = max(1, -(-text_bytes // TEXT_PER_CONTEXT))
    return min(max(1 << (wanted - 1).bit_length(), LEAST_CONTEXTS), MOST_CONTEXTS)


def rates(tables: np.ndarray, strength: float, sweep: int) -> np.ndarray:
    """The gamma variable of each restaurant given its tables."""
    return np.random.default_rng([sweep, len(tables)]).standard_gamma(strength / DISCOUNT + tables)


def draw_tables(customers: np.ndarray, rate: np.ndarray, uniform: np.ndarray) -> np.ndarray:
    """Tables of each dish from their conditional given its customers and its restaurant's gamma variable.

    The weight of t tables is S(c, t) * rate ** t with generalised Stirling numbers S; the rate is the
    discount times the gamma variable times the parent's probability of the dish. At a discount of one half
    S(c, t) is (2c - t - 1)! / ((c - t)! (t - 1)! 4 ** (c - t)), so neighbouring weights have a plain ratio,
    which falls in t: the likeliest t solves a quadratic, and sums run outwards from it. ``uniform`` holds a
    number in [0, 1) for each dish; the draw depends on nothing else. One customer has one table, none has
    none.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    many = np.flatnonzero(customers > 1)
    for start in range(0, len(many), DRAWN_AT_ONCE):
        part = many[start : start + DRAWN_AT_ONCE]
        c, r = customers[part].astype(np.float64), rate[part]
        level = 2 * c - 1 + 4 * r
        root = 8 * r * c / (level + np.sqrt(np.maximum(level * level - 16 * r * c, 0)))
        mode = np.clip(1 + np.floor(root), 1, c)
        above, _ = _outwards(c, r, mode, True)
        below, _ = _outwards(c, r, mode, False)
        at = uniform[part] * (above + below)
        up = at < above
        drawn = np.empty(len(part))
        drawn[up] = _outwards(c[up], r[up], mode[up], True, at[up])[1]
        down = ~up
        drawn[down] = _outwards(c[down], r[down], mode[down], False, (at - above)[down])[1]
        tables[part] = drawn.astype(np.int64)
    return tables


def _ratio(c: np.ndarray, rate: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The weight of t + 1 tables over that of t."""
    return 4 * (c - t) * rate / ((2 * c - t - 1) * t)


def _outwards(c, r, mode, up: bool, until=None) -> tuple[np.ndarray, np.ndarray]:
    """Sums of weights from the mode up, or from below it down, and the place where they pass ``until``."""
    total, place = np.zeros(len(c)), mode.copy()
    live, t, w = np.arange(len(c)), mode.copy(), np.ones(len(c))
    first = up
    while len(live):
        if not first:
            if up:
                w, t = w * _ratio(c, r, t), t + 1
                stay = t <= c
            else:
                stay = t > 1
                t = t - 1
                w = w / np.where(stay, _ratio(c, r, np.maximum(t, 1)), 1)
            stay &= w > NEGLIGIBLE
            live, c, r, t, w = live[stay], c[stay], r[stay], t[stay], w[stay]
        first = False
        total[live] += w
        place[live] = t
        if until is not None:
            stay = total[live] <= until[live]
            live, c, r, t, w = live[stay], c[stay], r[stay], t[stay], w[stay]
    return total, place


def _uniform(keys: np.ndarray, sweep: int) -> np.ndarray:
    """A number in [0, 1) for each key and sweep: draws hang on words and contexts, not on how they are dealt."""
    with np.errstate(over="ignore"):
        salted = keys + np.uint64(sweep + 1) * np.uint64(0x9E3779B97F4A7C15)
    return (mix(salted) >> np.uint64(11)) * 2.0**-53


def _parent_chance(tables: np.ndarray, own: np.ndarray, total: float, all_own: float, known: Totals) -> np.ndarray:
    """The shared parent's predictive probability of words with these tables below and tables of its own."""
    return (np.maximum(tables - DISCOUNT * own, 0) + (known.strength + DISCOUNT * all_own) / (known.words + 1)) / (known.strength + total)


def sweeps_of(state: dict[str, np.ndarray], known: Totals) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Replay a bucket's sweeps: tables per pair, per word, and the words' tables in the parent.

    In sweep j each dish is drawn given its restaurant's gamma variable and the parent's probabilities after
    sweep j - 1, so buckets need only its totals, and a lost task repeats its draws: they hang on the word,
    the context and the sweep alone.
    """
    word, context, count = state["pair_word"], state["pair_context"], state["pair_count"]
    words = len(state["words"])
    keys = mix(state["words"])
    many = np.flatnonzero(count > 1)  # the others have one table
    dish, place, customers = word[many], context[many], count[many]
    pair_keys = keys[dish] ^ mix(place.astype(np.uint64) + np.uint64(1 << 40))
    tables = (count > 0).astype(np.int64)
    below = np.bincount(word, tables, words).astype(np.int64)
    own = np.minimum(below, 1)
    yield tables, below, own
    for n, (totals, all_own, gammas, parents) in enumerate(known.history):
        chance = _parent_chance(below, own, float(totals.sum()), all_own, known)
        tables = tables.copy()
        tables[many] = draw_tables(customers, DISCOUNT * gammas[place] * chance[dish], _uniform(pair_keys, n))
        below = np.bincount(word, tables, words).astype(np.int64)
        own = draw_tables(below, np.full(words, DISCOUNT * parents / (known.words + 1)), _uniform(keys, n))
        yield tables, below, own


def _sorted_occurrences(words, contexts, docs, bits: int):
    """Occurrences in order of word hash, context and document, by one sort of packed integers."""
    kinds, codes = np.unique(words, return_inverse=True)
    packed = np.sort((codes.astype(np.int64) << 16 + bits) | (contexts.astype(np.int64) << 16) | docs.astype(np.int64))
    return kinds, packed >> 16 + bits, (packed >> 16 & (1 << bits) - 1).astype(np.uint32), (packed & 0xFFFF).astype(np.uint16)


def tokens_of(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end after every text, their contexts, and the number of tokens per text."""
    split = [t.lower().split() for t in texts]
    sizes = np.array([len(w) + 1 for w in split], np.int64)
    ends = np.cumsum(sizes) - 1
    words = np.empty(int(sizes.sum()), np.uint64)
    is_word = np.ones(len(words), bool)
    is_word[ends] = False
    words[ends] = END
    words[is_word] = HASHES.words([w for ws in split for w in ws])
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.concatenate([[0], ends[:-1] + 1])] = START
    return words, (mix(before) >> np.uint64(64 - bits)).astype(np.uint32), sizes


def deal(docs: DataFrame, training: Column, buckets: int, contexts: int, text: str, doc_id: str, salts: list[int] | None = None) -> DataFrame:
    """A row per bucket of words and chunk of documents: its pairs with their counts, or all occurrences.

    With ``salts``, occurrences are dealt over that many places for each bucket; the first bucket's rows,
    where every document has its end token, carry the documents' ids.
    """
    schema = _types(_BLOCK)
    bits = contexts.bit_length() - 1
    first = None if salts is None else np.concatenate([[0], np.cumsum(salts)]).tolist()

    def emit(chunk: int, held: list) -> Iterator[pa.RecordBatch]:
        ids = [i for x, *_ in held for i in x]
        train = np.concatenate([t for _, t, *_ in held])
        sizes = np.concatenate([s for *_, s in held])
        words, contexts = (np.concatenate([h[k] for h in held]) for k in (2, 3))
        kinds, code, contexts, places = _sorted_occurrences(words, contexts, np.repeat(np.arange(len(ids)), sizes), bits)
        if salts is None:
            starts = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (contexts[1:] != contexts[:-1])]))
            extra = np.diff(np.append(starts, len(code))).astype("<u4")
            code, contexts = code[starts], contexts[starts]
        else:
            extra = places.astype("<u2")
        counts = np.bincount(code, minlength=len(kinds))
        where = ((kinds >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        edges, ends = np.searchsorted(where, np.arange(buckets + 1, dtype=np.uint64)), np.concatenate([[0], np.cumsum(counts)])
        facts = np.array([(0 if i is None else 1) | (2 if t else 0) for i, t in zip(ids, train, strict=True)], np.uint8).tobytes()
        raw_ids = np.array([0 if i is None else i for i in ids], "<i8").tobytes()
        for b in range(buckets):
            i, j = edges[b], edges[b + 1]
            if i < j:
                x, y = ends[i], ends[j]
                place, told = (b, False) if salts is None else (first[b] + chunk % salts[b], b == 0)
                cells = map(packed, (kinds[i:j].astype("<u8"), counts[i:j].astype("<u4"), contexts[x:y].astype("<u4"), extra[x:y]))
                row = [place, _OCCURRENCES, chunk, *cells, raw_ids if told else None, facts if told else None]
                yield table_of(schema, [[v] for v in row])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size, rows = TaskContext.get().partitionId() << 32, [], 0, 0
        for piece in slices(batches, text=2, most=2 << 20):
            words, contexts, sizes = tokens_of(piece.column(2).to_pylist(), bits)
            if held and (size + len(words) > CHUNK_TOKENS or rows + piece.num_rows > CHUNK_DOCS):
                yield from emit(chunk, held)
                trim()
                chunk, held, size, rows = chunk + 1, [], 0, 0
            held.append((piece.column(0).to_pylist(), np.array(piece.column(1).to_pylist(), bool), words, contexts, sizes))
            size, rows = size + len(words), rows + piece.num_rows
        if held:
            yield from emit(chunk, held)

    rows = docs.select(F.col(doc_id).cast("long"), training, text_bytes(text))
    return rows.mapInArrow(run, _BLOCK)


class PairCounts:
    """Customers of a bucket's pairs of word and context, merged as blocks come: holds distinct pairs only."""

    def __init__(self, bits: int):
        self.bits = bits
        self.kinds, self.codes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple] = []
        self.pairs = 0

    def add(self, words: np.ndarray, sizes: np.ndarray, contexts: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((words, sizes, contexts, counts))
        self.pairs += len(contexts)
        if self.pairs > max(PENDING_PAIRS, len(self.codes)):
            self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        kinds = np.unique(np.concatenate([self.kinds, *(w[0] for w in self.waiting)]))
        code = np.concatenate(
            [np.searchsorted(kinds, self.kinds)[self.codes >> self.bits] << self.bits | self.codes & (1 << self.bits) - 1]
            + [np.repeat(np.searchsorted(kinds, words), sizes) << self.bits | contexts for words, sizes, contexts, _ in self.waiting]
        )
        count = np.concatenate([self.counts, *(w[3] for w in self.waiting)]).astype(np.int64)
        self.waiting, self.pairs = [], 0
        order = np.argsort(code, kind="stable")
        code, count = code[order], count[order]
        starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        self.kinds, self.codes, self.counts = kinds, code[starts], np.add.reduceat(count, starts)
        trim()


def gather(blocks: DataFrame, buckets: int, contexts: int) -> DataFrame:
    """One row per bucket: its words and their pairs with the customers of each, sorted by word and context."""
    schema, bits = _types(_STATE), contexts.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, PairCounts] = {}
        for batch in batches:
            for bucket, words, sizes, contexts, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(bucket, PairCounts(bits)).add(*map(unpacked, (words, sizes, contexts, counts), ("<u8", "<u4", "<u4", "<u4")))
        for bucket in list(held):
            own = held.pop(bucket)
            own.merge()
            row = [bucket, int(own.counts.sum()), own.kinds.astype("<u8"), (own.codes >> bits).astype("<u4"), (own.codes & (1 << bits) - 1).astype("<u4"), own.counts.astype("<u8")]
            yield table_of(schema, [[v.tobytes()] if isinstance(v, np.ndarray) else [v] for v in row])
            del own, row
        give_back()

    # A bucket to a partition: several in one would be held together.
    return blocks.select("place", "words", "sizes", "contexts", "extra").repartitionById(buckets, "place").mapInArrow(run, _STATE)


_ARRAYS = {"words": "<u8", "pair_word": "<u4", "pair_context": "<u4", "pair_count": "<u8"}


def _state(row: dict) -> dict[str, np.ndarray]:
    return {n: np.frombuffer(row[n], kind) for n, kind in _ARRAYS.items()}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row after the other: a bucket's arrays are the only ones held."""
    for batch in batches:
        for i in range(batch.num_rows):
            trim()  # of what the row before took
            cells = zip(batch.schema.names, (c[i] for c in batch.columns), strict=True)
            # Arrays stay in the batch's own memory.
            yield {n: x.as_buffer() if pa.types.is_binary(x.type) and x.is_valid else x.as_py() for n, x in cells}


def _by_words(state: dict[str, np.ndarray], pairs: int = PAIRS_AT_ONCE) -> Iterator[dict[str, np.ndarray]]:
    """A bucket's state in stretches of whole words: draws of different words need nothing of each other."""
    word, lo = state["pair_word"], 0
    while lo < len(word):
        hi = min(len(word), lo + pairs)
        hi = int(np.searchsorted(word, word[hi - 1], "right"))
        first, last = int(word[lo]), int(word[hi - 1])
        yield {
            "words": state["words"][first : last + 1], "pair_word": word[lo:hi].astype(np.int64) - first,
            "pair_context": state["pair_context"][lo:hi], "pair_count": state["pair_count"][lo:hi].astype(np.int64),
        }
        trim()
        lo = hi


def _slices(customers: np.ndarray | None, tables: np.ndarray, words: int, parent: int) -> Iterator[pa.RecordBatch]:
    """A bucket's totals by restaurant, those that it has, in rows by slice of the restaurants."""
    met = np.flatnonzero(tables)
    edges = np.searchsorted(met, np.arange(SLICES + 1) * (len(tables) // SLICES))
    for n in range(SLICES):
        own = met[edges[n] : edges[n + 1]]
        if len(own) or not n:
            cells = [own.astype("<u4"), tables[own].astype("<i8"), (tables if customers is None else customers)[own].astype("<i8")]
            yield table_of(_types(_SUMS), [[v] for v in (n, *map(packed, cells), words if not n else 0, parent if not n else 0)])


def _summed(parts: DataFrame, contexts: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Customers and tables of every restaurant, words, and the parent's tables, over all buckets."""
    width, types = contexts // SLICES, _types(_SUMS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        words = parent = 0
        for row in _rows(batches):
            n = row["slice"]
            held = sums[n] if n in sums else sums.setdefault(n, np.zeros((2, width), np.int64))
            at = unpacked(row["contexts"], "<u4") - np.uint32(n * width)
            held[0, at] += unpacked(row["tables"], "<i8")
            held[1, at] += unpacked(row["customers"], "<i8")
            words, parent = words + row["words"], parent + row["parent"]
        for n, held in sums.items():
            yield table_of(types, [[v] for v in (n, b"", held[0].tobytes(), held[1].tobytes(), words, parent)])
            words = parent = 0

    customers, tables = np.zeros((2, contexts), np.int64)
    words = parent = 0
    for row in parts.repartition("slice").mapInArrow(add, _SUMS).collect():  # SLICES rows
        at = slice(row["slice"] * width, (row["slice"] + 1) * width)
        customers[at], tables[at] = np.frombuffer(row["customers"], np.int64), np.frombuffer(row["tables"], np.int64)
        words, parent = words + row["words"], parent + row["parent"]
    return customers, tables, words, parent


def count_corpus(state: DataFrame, contexts: int) -> Totals:
    """Customers and first tables of all restaurants."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            s = _state(row)
            customers = np.bincount(s["pair_context"], s["pair_count"], contexts).astype(np.int64)
            yield from _slices(customers, np.bincount(s["pair_context"], minlength=contexts), len(s["words"]), 0)

    customers, tables, words, _ = _summed(state.select(*_ARRAYS).mapInArrow(run, _SUMS), contexts)
    return Totals(customers, tables, words, int(customers.sum()), float(words))


def sweep(state: DataFrame, known: Totals) -> None:
    """One more sweep over all buckets; adds the totals it started from to the history and takes the new ones."""
    n = len(known.history)
    gammas = rates(np.append(known.tables, int(known.parent_tables)), known.strength, n)
    known.history.append((known.tables, known.parent_tables, gammas[:-1].astype(np.float32), float(gammas[-1])))
    shared = state.sparkSession.sparkContext.broadcast(known)
    contexts = len(known.tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sums, parent = np.zeros(contexts, np.int64), 0
            for part in _by_words(_state(row)):
                *_, (tables, _, own) = sweeps_of(part, shared.value)
                sums += np.bincount(part["pair_context"], tables, contexts).astype(np.int64)
                parent += int(own.sum())
            yield from _slices(None, sums, 0, parent)
        give_back()

    _, known.tables, _, parent = _summed(state.select(*_ARRAYS).mapInArrow(run, _SUMS), contexts)
    known.parent_tables = float(parent)


def seats_of(state: dict[str, np.ndarray], known: Totals, burn_in: int = BURN_IN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summed over the sampled seatings: twice each pair's discounted customers; each word's parent
    probability, a column per seating; and the words' counts.

    Seating j goes with the totals that all buckets had after it.
    """
    word, count = state["pair_word"], state["pair_count"]
    seats, chances = np.zeros(len(word), np.int64), []
    for j, (tables, below, own) in enumerate(sweeps_of(state, known)):
        if j in _sampled(known, burn_in):
            totals, all_own = _totals_after(known, j)
            seats += 2 * count - tables
            chances.append(_parent_chance(below, own, totals.sum(), all_own, known))
    return seats, np.stack(chances, 1), np.bincount(word, count, len(state["words"])).astype(np.int64)


def _sampled(known: Totals, burn_in: int) -> list[int]:
    return list(range(min(burn_in + 1, len(known.history)), len(known.history) + 1))


def _totals_after(known: Totals, j: int) -> tuple[np.ndarray, float]:
    after = [*(h[:2] for h in known.history[1:]), (known.tables, known.parent_tables)]
    return after[j - 1] if j else (known.tables, known.parent_tables)


class Scorer:
    """log10 of averaged predictive probabilities by one bucket's model."""

    def __init__(self, known: Totals, burn_in: int = BURN_IN):
        self.known, self.samples = known, _sampled(known, burn_in)
        after = [_totals_after(known, j) for j in self.samples]
        self.bits = len(known.tables).bit_length() - 1
        over = len(after) * (known.strength + known.customers)
        #: What a context hands to its parent, per seating, and the parent's probability of a word not seen.
        self.hands = np.stack([(known.strength + DISCOUNT * totals) / over for totals, _ in after], 1)
        none = np.zeros(1)
        self.unseen = np.stack([_parent_chance(none, none, totals.sum(), own, known) for totals, own in after], 1)
        self.over = 2 * over
        self.take()

    def take(self, words: bytes = b"", sizes: bytes = b"", contexts: bytes = b"", seats: bytes = b"", chances: bytes = b"", counts: bytes = b"") -> None:
        """A bucket's model, or that of a bucket without training words."""
        self.words = np.append(unpacked(words, "<u8"), np.uint64(np.iinfo(np.uint64).max))
        self.chances = np.concatenate([unpacked(chances, "<f8").reshape(-1, len(self.samples)), self.unseen])
        self.counts = np.append(unpacked(counts, "<i8"), 0)
        self.codes = np.append(np.repeat(np.arange(len(self.words) - 1), unpacked(sizes, "<u4")) << self.bits | unpacked(contexts, "<u4"), np.iinfo(np.int64).max)
        self.seats = np.append(unpacked(seats, "<i8"), 0)

    def sums(self, words: np.ndarray, sizes: np.ndarray, contexts: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Per document: score, base, tokens and known tokens of a block."""
        at = np.searchsorted(self.words, words)
        at[self.words[at] != words] = len(self.words) - 1
        word = np.repeat(at, sizes)
        code = word << self.bits | contexts
        pair = np.searchsorted(self.codes, code)
        seats = np.where(self.codes[pair] == code, self.seats[pair], 0)
        logs = np.log10(seats / self.over[contexts] + (self.hands[contexts] * self.chances[word]).sum(1))
        count = self.counts[word]
        base = np.log10((count + 0.1) / (self.known.tokens + 0.1 * (self.known.words + 1)))
        return np.stack([np.bincount(docs, w) for w in (logs, base, None, count > 0)])


def models(state: DataFrame, known: Totals, salts: list[int]) -> DataFrame:
    """Each bucket's model, once for every place that its occurrences are dealt to."""
    schema, shared = _types(_BLOCK), state.sparkSession.sparkContext.broadcast(known)
    first = np.concatenate([[0], np.cumsum(salts)]).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            s = _state(row)
            seats, chances, counts = map(np.concatenate, zip(*(seats_of(part, shared.value) for part in _by_words(s)), strict=True))
            sizes = np.bincount(s["pair_word"], minlength=len(s["words"])).astype("<u4")
            cells = [s["words"], sizes, s["pair_context"], seats.astype("<i8"), chances.astype("<f8").reshape(-1), counts.astype("<i8")]
            model = [[packed(c)] for c in cells]
            del s, seats, chances, counts, cells
            for place in range(first[row["bucket"]], first[row["bucket"] + 1]):
                yield table_of(schema, [[place], [_MODEL], [-1], *model])
        give_back()

    return state.select("bucket", *_ARRAYS).mapInArrow(run, _BLOCK)


def score_blocks(blocks: DataFrame, known: Totals) -> DataFrame:
    """Sums per chunk and document, for the documents that a block holds; blocks come after their model."""
    types, shared = _types(_REPLY), blocks.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, now = Scorer(shared.value), None
        for row in _rows(batches):
            if row["kind"] == _MODEL:
                scorer.take(row["words"], row["sizes"], row["contexts"], row["extra"], row["doc_ids"], row["facts"])
            else:
                if now != row["place"]:  # no model came ahead
                    scorer.take()
                sums = scorer.sums(*(unpacked(row[n], kind) for n, kind in (("words", "<u8"), ("sizes", "<u4"), ("contexts", "<u4"), ("extra", "<u2"))))
                met = np.flatnonzero(sums[2])
                told = [None if row[n] is None else row[n].to_pybytes() for n in ("doc_ids", "facts")]
                yield table_of(types, [[v] for v in (row["chunk"], packed(met.astype("<u2")), packed(sums[:, met].astype("<f8").reshape(-1)), *told)])
            now = row["place"]
        give_back()

    return blocks.mapInArrow(run, _REPLY)


def score_corpus(
    docs: DataFrame, training: Column, sweeps: int = SWEEPS, text: str = "text", doc_id: str = "doc_id", buckets: int | None = None
) -> DataFrame:
    """``doc_id, trained, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    Tokens are the whole text's words, A-Z in lower case, and one end; rows where ``training`` holds seat
    customers, all rows are scored. ``score`` is the log10 probability of the text under the predictive
    probabilities averaged over the sampled seatings. Null and empty texts hold the end alone; repeated rows
    and null ids are documents of their own. Without training rows every token has the base's probability.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4)
    training = F.coalesce(training, F.lit(False))
    (size,) = docs.filter(training).agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()
    contexts = restaurants_for(size or 0)
    state = stage(gather(deal(docs.filter(training), training, buckets, contexts, text, doc_id), buckets, contexts), "seating")
    known = count_corpus(state, contexts)
    for _ in range(sweeps):
        sweep(state, known)
    # One number a bucket: those that hold much more than their share are dealt over several places.
    salts = [1] * buckets
    for bucket, customers in state.select("bucket", "customers").collect():
        salts[bucket] += int(customers * buckets // max(2 * known.tokens, 1))
    blocks = deal(docs, training, buckets, contexts, text, doc_id, salts).union(models(state, known, salts))
    order = ["place", "kind", "chunk"]
    scored = score_blocks(blocks.repartition(sum(salts), "place").sortWithinPartitions(*order), known)
    final = "doc_id long, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    types, tokens = _types(final), known.tokens

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        told: dict[int, tuple[bytes, bytes]] = {}
        for batch in batches:
            for chunk, docs_met, totals, ids, facts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                met = unpacked(docs_met, "<u2")
                if ids is not None:
                    told[chunk] = ids, facts
                held = sums.get(chunk)
                if held is None or held.shape[1] <= met[-1]:
                    wider = np.zeros((4, int(met[-1]) + 1))
                    if held is not None:
                        wider[:, : held.shape[1]] = held
                    held = sums[chunk] = wider
                held[:, met] += unpacked(totals, "<f8").reshape(4, -1)
        for chunk, (ids, facts) in told.items():
            score, base, size, seen = sums.pop(chunk)
            own, facts = np.frombuffer(ids, "<i8"), np.frombuffer(facts, "u1")
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64(), mask=(facts & 1) == 0), pa.array((facts & 2) > 0), pa.array(size.astype(np.int64)), pa.array(seen.astype(np.int64)), pa.array(np.full(len(own), tokens)), pa.array(base), pa.array(score)], schema=types
            )

    return scored.repartition("chunk").mapInArrow(add, final)


def perplexity(scored: DataFrame) -> DataFrame:
    """``trained, documents, perplexity``: 10 to the mean negative log10 probability of a token."""
    return scored.groupBy("trained").agg(F.count("*").alias("documents"), F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))


def training_rows(doc_id: str = "doc_id") -> Column:
    return split_of(doc_id, 10) != 0
