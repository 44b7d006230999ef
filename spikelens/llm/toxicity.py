"""A toxicity classifier whose scores may not hang on which group a text names."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikelens.llm.common import slices, split_of, table_of

WORDS = re.compile(r"[^\W\d_]+")
SAMPLE_ROWS = 4000
BUCKETS = 1 << 20
PREFIXES = (5, 6, 7)

# Terms that name groups; one may stand for any other of its row.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "hispanic", "indigenous", "african", "arab"),
    ("american", "mexican", "chinese", "indian", "russian", "turkish", "nigerian", "polish"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("disabled", "blind", "deaf", "autistic"),
    ("old", "young", "elderly"),
)
_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def words_of(text: str | None) -> set[str]:
    return set(WORDS.findall(text.lower())) if text else set()


def pieces_of(word: str) -> list[str]:
    """A word and its beginnings: inflected and compounded forms share these."""
    return [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) > n)]


def style_of(text: str | None) -> set[str]:
    """How a text is written: the share of capitals and of exclamation marks among its signs, in tenths."""
    if not text:
        return set()
    letters = sum(map(str.isalpha, text))
    raised = sum(map(str.isupper, text)) if not text.islower() else 0
    return {f"capitals {10 * raised // max(letters, 1)}", f"shouts {min(9, 40 * text.count('!') // len(text))}"}


def features(text: str | None) -> set[str]:
    return {p for w in words_of(text) for p in pieces_of(w)} | style_of(text)


def bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def swaps(words: set[str], groups: Sequence[Sequence[str]] = IDENTITY_GROUPS) -> Iterator[tuple[str, str]]:
    """(term, other) for every group term of a text and every other term of its row that the text lacks."""
    for group in groups:
        for term in group:
            if term in words:
                yield from ((term, other) for other in group if other not in words)


def changed(words: set[str], term: str, other: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(pieces gained, pieces lost) when ``other`` stands for ``term`` in a text of these words."""
    kept = {p for w in words if w[:5] in (term[:5], other[:5]) and w != term for p in pieces_of(w)}
    old, new = set(pieces_of(term)) - kept, set(pieces_of(other)) - kept
    return tuple(sorted(new - old)), tuple(sorted(old - new))


class ToxicityModel:
    """Sparse logistic weights over hashed words, found by proximal gradient steps.

    Loss: mean logistic loss, plus ``fairness`` times the mean squared change of the logit when a group
    term is swapped with all its pieces, plus an L1 term that keeps words without evidence at exactly zero. With neutral
    templates for every group term added to the swaps, a term that no labelled text holds is bound too.
    """

    def __init__(self, rows: Sequence[tuple[set[str], int]], fairness: float = 10.0, sparse: float = 1e-4, steps: int = 400):
        self.weights: dict[int, float] = {}
        y = np.array([t for _, t in rows], float)
        share = float(y.mean()) if len(y) else 0.0
        self.bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        if not len(y) or share in (0.0, 1.0):
            return
        cells = [np.fromiter({bucket(w) for w in words}, np.int64) for words, _ in rows]
        # A feature of one text alone tells nothing of other texts.
        seen = np.bincount(np.concatenate(cells), minlength=BUCKETS) > 1
        cells = [c[seen[c]] for c in cells]
        pairs = Counter(changed(words, *p) for words, _ in rows for p in swaps(words))
        pairs.update(changed({a}, a, b) for group in IDENTITY_GROUPS for a in group for b in group if a < b)
        kept, place = np.unique(np.concatenate([*cells, [bucket(w) for pair in pairs for side in pair for w in side]]).astype(np.int64), return_inverse=True)
        place, size = place.ravel(), len(kept)
        sizes = np.array([len(c) for c in cells])
        owner, flat = np.repeat(np.arange(len(y)), sizes), place[: sizes.sum()]
        # Mean squared logit change of the swaps: a square form in the few weights that they touch.
        bound, at = np.unique(place[sizes.sum() :], return_inverse=True)
        at, square, start = at.ravel(), np.zeros((len(bound), len(bound))), 0
        for (gained, lost), n in pairs.items():
            own = at[start : start + len(gained) + len(lost)]
            start += len(own)
            sign = np.repeat([1.0, -1.0], [len(gained), len(lost)])
            np.add.at(square, (own[:, None], own[None, :]), n * np.outer(sign, sign))
        square *= 2 * fairness / max(1, pairs.total())
        steepest = float(np.linalg.eigvalsh(square)[-1]) if len(bound) else 0.0
        w, b = np.zeros(size), self.bias
        ahead, ahead_b, speed = w.copy(), b, 1.0
        # The curvature of the loss along the longest direction, by a few power steps, sets the step.
        probe = np.ones(size) / np.sqrt(size)
        for _ in range(12):
            spread = np.bincount(owner, probe[flat], len(y))
            probe = np.bincount(flat, (spread / (4 * len(y)))[owner], size)
            curve = float(np.linalg.norm(probe)) + steepest
            probe /= max(np.linalg.norm(probe), 1e-12)
        step = 1 / (curve + 0.25)
        for _ in range(steps):
            z = np.bincount(owner, ahead[flat], len(y)) + ahead_b
            slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
            grad = np.bincount(flat, slope[owner], size)
            grad[bound] += square @ ahead[bound]
            moved = ahead - step * grad
            moved = np.sign(moved) * np.maximum(np.abs(moved) - step * sparse, 0)
            moved_b = ahead_b - step * float(slope.sum())
            faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
            if float(((ahead - moved) * (moved - w)).sum()) > 0:
                faster = 1.0
            ahead = moved + (speed - 1) / faster * (moved - w)
            ahead_b = moved_b + (speed - 1) / faster * (moved_b - b)
            w, b, speed = moved, moved_b, faster
        self.bias = float(b)
        self.weights = {int(k): float(v) for k, v in zip(kept, w, strict=True) if v}

    def score(self, text: str | None, known: dict[str, list[int]] | None = None) -> float:
        """The chance that the text is toxic. ``known`` keeps the weighted features of words already met."""
        if not self.weights:
            return float(1 / (1 + np.exp(-self.bias)))
        known = {} if known is None else known
        if len(known) > 300_000:
            known.clear()
        words = words_of(text)
        hit: set[int] = set()
        for word in words:
            found = known.get(word)
            if found is None:
                found = known[word] = [k for k in map(bucket, pieces_of(word)) if k in self.weights]
            hit.update(found)
        hit.update(k for k in map(bucket, style_of(text)) if k in self.weights)
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(self.weights[k] for k in sorted(hit)), -30, 30))))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, held_out_parts: int = 4, held_out: int = 2, rows: int = SAMPLE_ROWS
) -> ToxicityModel:
    """Fit on at most ``rows`` labelled documents outside the held-out fold, the first by a hash of their id.

    The ids are a bounded list, so they alone are sent to the scan; a document labelled twice counts once,
    as toxic if any label says so. Rows without an id, a text or a label are left out.
    """
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (split_of("doc_id", held_out_parts) != held_out))
    chosen = (
        usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
    )
    sample = docs.filter(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("_id", "text", "_toxic")
    return ToxicityModel([(features(r[1]), int(r[2])) for r in sorted(sample.collect())])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, score`` of every whole text; a null or empty text gets the score of no words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for piece in slices(batches):
            yield table_of(_SCORED, [piece.column(0), [shared.value.score(t, known) for t in piece.column(1).to_pylist()]])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, "doc_id long, score double")
