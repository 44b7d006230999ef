"""Quality rules: document statistics, and boosted trees over them scored from flat node arrays."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikelens.llm.common import BLANKS, HASHES, mix, slices, table_of, text_bytes

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 20_000
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "shout_share", "distinct_share", "word_length", "line_words", "stop_share"]
# More of these never raises the score.
FALLING = ("symbol_share", "dup_line_share", "repeat_share", "shout_share")
FEATURES = ["n_words", *SHARES]
_STATS = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), *((c, pa.float64()) for c in SHARES)])
STATS_DDL = "doc_id long, " + ", ".join([f"{c} long" for c in COUNTS] + [f"{c} double" for c in SHARES])


def repeated_words(words: np.ndarray, owner: np.ndarray, docs: int, window: int = WINDOW) -> np.ndarray:
    """Per document, its words that lie in a window of words which its text has twice or more."""
    out = np.zeros(docs, np.int64)
    if len(words) < window:
        return out
    span = len(words) - window + 1
    inside = owner[:span] == owner[window - 1 :]
    key = mix(owner[:span].astype(np.uint64) + np.uint64(1))
    with np.errstate(over="ignore"):
        for i in range(window):
            key = mix(key ^ words[i : i + span]) + np.uint64(i)
    at = np.flatnonzero(inside)
    order = at[np.argsort(key[at], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(words) + 1, np.int64)
    starts = order[twice]
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(owner[covered], minlength=docs).astype(np.int64)


def _statistics(texts: list[bytes]) -> list[np.ndarray]:
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    words = HASHES.words([w for ws in split for w in ws])
    repeat = repeated_words(words, owner, len(texts))
    distinct = np.array([len(set(w)) for w in split])
    top = np.zeros(len(texts))
    chars, symbols, dups, lines, upper, digits, shouts = (np.zeros(len(texts), np.int64) for _ in range(7))
    for i, text in enumerate(texts):
        if not sizes[i]:
            symbols[i] = len(text) - len(text.translate(None, SYMBOLS))
            continue
        solid = text.translate(None, BLANKS)
        chars[i] = len(solid.decode("utf-8", "replace"))
        symbols[i] = len(solid) - len(solid.translate(None, SYMBOLS))
        upper[i] = len(solid) - len(solid.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        digits[i] = len(solid) - len(solid.translate(None, b"0123456789"))
        shouts[i] = solid.count(b"!")
        held = [x for x in text.split(b"\n") if x.translate(None, BLANKS)]
        lines[i], dups[i] = len(held), len(held) - len(set(held))
        top[i] = sum(len(w) <= 3 for w in split[i]) / sizes[i]
    n, c = np.maximum(sizes, 1), np.maximum(chars, 1)
    shares = [symbols / c, dups / np.maximum(lines, 1), repeat / n, upper / c, digits / c, shouts / c, distinct / n, chars / n, sizes / np.maximum(lines, 1), top]
    return [sizes, chars, symbols, dups, repeat, *shares]


def document_statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Counts and shares of every whole text; a null or empty text has zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            yield table_of(_STATS, [piece.column(0), *_statistics(piece.column(1).to_pylist())])

    return docs.select(F.col(doc_id).cast("long"), text_bytes(text)).mapInArrow(run, STATS_DDL)


class BoostedTrees:
    """Gradient-boosted trees for a yes/no target, as flat arrays of nodes.

    ``direction`` gives a feature's sign: 1 may only raise the score, -1 only lower it. A split that
    would break this is not taken, and the middle of its two values bounds both sides from then on.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, direction: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: int = 10):
        self.depth = depth
        share = float(y.mean()) if len(y) else 0.5
        self.base = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        self.feature, self.cut, self.left, self.value, self.roots = [], [], [], [], []
        if not len(y) or share in (0.0, 1.0):
            self._freeze()
            return
        edges = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) for col in x.T]
        coded = np.stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T, strict=True)], 1)
        z = np.full(len(y), self.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-z))
            out = np.zeros(len(y))
            self.roots.append(self._grow(coded, edges, p - y, p * (1 - p), np.arange(len(y)), depth, (-np.inf, np.inf), direction, rate, ridge, least, out))
            z += out
        self._freeze()

    def _node(self, value: float) -> int:
        for column, v in ((self.feature, 0), (self.cut, np.inf), (self.left, -1), (self.value, value)):
            column.append(v)
        return len(self.value) - 1

    def _grow(self, coded, edges, g, h, rows, depth, bound, direction, rate, ridge, least, out) -> int:
        weight = lambda a, b: np.clip(-a / (b + ridge), *bound)
        own = float(weight(g[rows].sum(), h[rows].sum()))
        here = self._node(rate * own)
        out[rows] = rate * own
        best = (1e-6, None)
        if depth and len(rows) >= 2 * least:
            gain0 = lambda a, b, w: -(a * w + 0.5 * (b + ridge) * w * w)
            whole = gain0(g[rows].sum(), h[rows].sum(), own)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                gs, hs, ns = (np.cumsum(np.bincount(coded[rows, f], w, len(e) + 1))[:-1] for w in (g[rows], h[rows], None))
                gr, hr = g[rows].sum() - gs, h[rows].sum() - hs
                wl, wr = weight(gs, hs), weight(gr, hr)
                gain = gain0(gs, hs, wl) + gain0(gr, hr, wr) - whole
                gain[(ns < least) | (len(rows) - ns < least) | (direction[f] * (wr - wl) < 0)] = -np.inf
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), (f, k, float(wl[k]), float(wr[k])))
        if best[1]:
            f, k, wl, wr = best[1]
            low = coded[rows, f] <= k
            mid, (lo, hi) = (wl + wr) / 2, bound
            sides = {1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid)), 0: (bound, bound)}[int(direction[f])]
            children = [self._grow(coded, edges, g, h, rows[m], depth - 1, b, direction, rate, ridge, least, out) for m, b in zip((low, ~low), sides, strict=True)]
            self.feature[here], self.cut[here], self.left[here] = f, edges[f][k], tuple(children)
        return here

    def _freeze(self) -> None:
        """Children as two arrays; a leaf is its own child, so a fixed number of steps ends in it."""
        pairs = [(i, i) if v == -1 else v for i, v in enumerate(self.left)]
        self.children = np.array(pairs, np.int64).reshape(-1, 2)
        self.feature, self.cut = np.array(self.feature, np.int64), np.array(self.cut, float)
        self.value, self.left = np.array(self.value, float), None

    def logit(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = self.children[at, (x[rows, self.feature[at]] > self.cut[at]).astype(np.int64)]
            total += self.value[at]
        return total

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def fit_quality(stats: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, features: list[str] = FEATURES, falling: tuple[str, ...] = FALLING) -> BoostedTrees:
    """Fit on at most ``rows`` labelled documents, the first by a hash of their id; null labels are left out.

    Only the statistics of those rows, a few numbers each, come to the driver.
    """
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").cast("double").alias("_quality"))
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
    )
    sample = stats.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("_id", "_quality", *features)
    table = np.array(sorted(map(tuple, sample.collect())), float).reshape(-1, 2 + len(features))
    return BoostedTrees(table[:, 2:], table[:, 1], np.array([-(f in falling) for f in features]))


def judge_quality(stats: DataFrame, model: BoostedTrees, rules: Mapping[str, float] | None = None, least_chance: float = 0.3) -> DataFrame:
    """The statistics with ``base_failed``, ``chance`` and ``kept``.

    ``base_failed``: fewer than ``least_words`` words, or more than ``repeat_percent`` of them repeated.
    Other rows are kept when the trees give good quality at least ``least_chance``.
    """
    rules = {"least_words": 10, "repeat_percent": 20} | dict(rules or {})
    shared = stats.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def chance(columns: pd.DataFrame) -> pd.Series:
        return pd.Series(shared.value.chance(columns.to_numpy(float)))

    failed = (F.col("n_words") < rules["least_words"]) | (100 * F.col("n_repeat_words") > rules["repeat_percent"] * F.col("n_words"))
    judged = stats.withColumn("base_failed", failed).withColumn("chance", chance(F.struct(*FEATURES)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("chance") >= least_chance))
