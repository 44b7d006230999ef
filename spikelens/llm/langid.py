"""Word-first language identification with back-off to shorter and shorter character n-grams."""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikelens.llm.common import give_back, slices, split_of, table_of, trim

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
DOCS_PER_LANGUAGE = 500
LONGEST_GRAM = 5
_CACHE_WORDS = 100_000
_PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class BackoffModel:
    """Per-language log frequencies of words and of character n-grams with word ends marked."""

    def __init__(self, rows: Iterable[tuple[str, str]], longest: int = LONGEST_GRAM):
        counts: dict[str, Counter] = {}
        for text, lang in rows:
            counts.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
        self.languages = sorted(counts)
        self.longest = longest
        self.words = self._table([counts[x] for x in self.languages], 0.1)
        self.grams = {}
        for n in range(1, longest + 1):
            by = []
            for lang in self.languages:
                seen: Counter = Counter()
                for word, times in counts[lang].items():
                    for gram in _grams(word, n):
                        seen[gram] += times
                by.append(seen)
            self.grams[n] = self._table(by, 0.5)

    @staticmethod
    def _table(counts: list[Counter], smooth: float) -> dict[str, tuple[float, ...]]:
        kinds = set().union(*counts) if counts else set()
        floor = [sum(c.values()) + smooth * len(kinds) for c in counts]
        return {k: tuple(float(np.log((c[k] + smooth) / t)) for c, t in zip(counts, floor, strict=True)) for k in kinds}

    def vector(self, word: str) -> tuple[float, ...]:
        """Log score of a word in every language: the word's own, else the longest n-grams known."""
        known = self.words.get(word)
        if known is not None:
            return known
        for n in range(self.longest, 0, -1):
            found = [v for g in _grams(word, n) if (v := self.grams[n].get(g)) is not None]
            if found:
                return tuple(sum(x) / len(found) for x in zip(*found, strict=True))
        return (0.0,) * len(self.languages)


class Scorer:
    """Sums word vectors per text; keeps the vectors of words met, up to a bound."""

    def __init__(self, model: BackoffModel):
        self.model, self.places = model, {}
        self.table = np.zeros((1024, max(1, len(model.languages))), np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        # The pattern takes number signs such as a half along with letters; alone they tell no language.
        words = LETTERS.findall(text.lower()) if text and any(map(str.isalpha, text)) else []
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        if len(self.places) > _CACHE_WORDS:
            self.places.clear()
        places = self.places
        for word in set(words):
            if word not in places:
                at = places[word] = len(places)
                if at >= len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[at] = self.model.vector(word)
        total = self.table[np.fromiter(map(places.__getitem__, words), np.int64, len(words))].sum(0, dtype=np.float64)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def _sent(docs: DataFrame, model: BackoffModel) -> Broadcast:
    """The model as bytes: what a worker unpacks of it goes with the task, a broadcast value would stay in idle workers."""
    return docs.sparkSession.sparkContext.broadcast(pickle.dumps(model, pickle.HIGHEST_PROTOCOL))


def fit_languages(
    docs: DataFrame, training: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_language: int = DOCS_PER_LANGUAGE
) -> BackoffModel:
    """Fit on at most ``per_language`` documents of each language, the first by a hash of their id.

    Only ids and languages are ranked; the texts of the chosen rows alone come to the driver.
    """
    usable = docs.filter(training & F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull())
    usable = usable.select(F.col(doc_id).alias("_id"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    # One row per language; the model holds far more for each.
    sizes = F.broadcast(usable.groupBy("_lang").agg(F.count(F.lit(1)).alias("_of")))
    # Of a hash range that holds about three times the wanted documents: few rows meet in a language's ranking.
    place = F.xxhash64("_id") / F.lit(2.0**64) + 0.5
    ids = usable.select("_id", "_lang", place.alias("_h")).join(sizes, "_lang").filter(F.col("_h") * F.col("_of") <= 3 * per_language)
    order = Window.partitionBy("_lang").orderBy("_h", "_id")
    chosen = ids.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_language).select("_id").distinct()
    # At most per_language ids for every language.
    sample = usable.join(F.broadcast(chosen), "_id", "left_semi").select("_text", "_lang")
    model = BackoffModel(sorted((r[0], r[1]) for r in sample.collect()))
    give_back()  # the sample's texts and counts, of which the driver needs nothing more
    return model


def identify(docs: DataFrame, model: BackoffModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, lang_pred, score``: one row per document, over its whole text.

    A null text, one without a letter, or a model without languages gives ``und`` and 0. Ties go to the
    language first by name.
    """
    shared = _sent(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(pickle.loads(shared.value))
        for piece in slices(batches):
            found = [scorer.predict(t) for t in piece.column(1).to_pylist()]
            yield table_of(_PREDICTED, [piece.column(0), [f[0] for f in found], [f[1] for f in found]])
        del scorer
        trim()

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )


def keep_identified(docs: DataFrame, model: BackoffModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language, with all their columns."""
    shared, at = _sent(docs, model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(pickle.loads(shared.value))
        for piece in slices(batches, text=at):
            kept = [scorer.predict(t)[0] != UNKNOWN for t in piece.column(at).to_pylist()]
            yield piece.filter(pa.array(kept, pa.bool_()))
        del scorer
        trim()

    return docs.mapInArrow(run, docs.schema)


def training_rows(doc_id: str = "doc_id") -> Column:
    return split_of(doc_id, 4) != 2
