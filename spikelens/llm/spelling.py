"""Spelling variants: words one edit apart, found by PartEnum signatures over their letter multisets.

A word's letter multiset is a binary vector: one place for every letter and every number of its occurrences.
Words one edit apart differ in two places if a letter was replaced, in one if it was inserted. The places are
partitioned by letter into classes, more than can differ, so near words agree on a whole class; a signature is
a class with the letters a word has of it. Two things that near words share as well are enumerated with it: the
length of the shorter word, and the half of it before or behind the edit. Words meet where signatures are
equal, and the join verifies them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikelens.llm.common import LOWER, slices, table_of, text_bytes
from spikelens.sources import stage

LEAST_LETTERS, LEAST_TIMES, TIMES_MORE = 7, 2, 10
TYPO_EVERY = 31
# The letters of words: lower-case a to z and U+00C0 to U+00FF.
ALPHABET = LOWER + "".join(map(chr, range(0xC0, 0x100)))
REPLACED_CLASSES, INSERTED_CLASSES = 3, 2  # one more than the places that differ
HELD_WORDS = 100_000
EQUAL, SHORT, LONG = 0, 1, 2

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def count_words(
    docs: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES, typo_every: int = TYPO_EVERY, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``word, n``: words of at least ``least_letters`` with at least ``least_times`` occurrences in all texts.

    A word is a maximal run of ``A-Z``, ``a-z`` and U+00C0 to U+00FF with A-Z lower-cased. Where ``typo_every``
    divides the crc32 of ``<doc_id>:<run>`` the run loses the letter at that crc32 modulo its length (a null id
    counts as empty text). Null texts have no words. Words are counted per piece of input before the shuffle.
    """
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_letters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in slices(batches):
            for row, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = (m.group() for m in runs.finditer(body.lower().decode())) if len(body) > 1 << 20 else runs.findall(body.lower().decode())
                start = zlib.crc32(b"%s:" % (b"" if row is None else b"%d" % row))
                if isinstance(found, list):
                    _add(held, Counter(found), start, least_letters, typo_every)
                else:
                    while part := Counter(islice(found, HELD_WORDS)):
                        _add(held, part, start, least_letters, typo_every)
            if len(held) > HELD_WORDS:
                yield table_of(_COUNTS, [list(held), list(held.values())])
                held.clear()
        yield table_of(_COUNTS, [list(held), list(held.values())])

    counts = docs.select(F.col(doc_id).cast("long"), text_bytes(text)).mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_times)


def _add(held: Counter, found: Counter, start: int, least_letters: int, typo_every: int) -> None:
    for word, n in found.items():
        h = zlib.crc32(word.encode(), start)
        if h % typo_every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < least_letters:
                continue
        held[word] += n


def letter_classes(words: DataFrame, number: int) -> list[str]:
    """The alphabet in ``number`` classes that hold about equally many letters of the words.

    The classes decide how well signatures tell words apart, not which words are found.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(F.count(F.lit(1)).alias("n"))
    # One record per letter of the alphabet.
    times = {r.letter: r.n for r in letters.collect()}
    classes, load = [""] * number, [0] * number
    for letter in sorted(ALPHABET, key=lambda c: (-times.get(c, 0), c)):
        k = load.index(min(load))
        classes[k], load[k] = classes[k] + letter, load[k] + times.get(letter, 0)
    return classes


def signatures(word: Column, role: int, classes: list[str]) -> list[Column]:
    """Hashes of a word's signatures as one of two equally long words, or as the shorter or longer one."""
    size = F.char_length(word) - (1 if role == LONG else 0)
    half = F.floor(size / 2).cast("int")
    halves = [F.substring(word, F.lit(1), half), F.substring(word, F.char_length(word) - half + 1, half)]
    kind = F.lit(0 if role == EQUAL else 1)
    out = []
    for k, letters in enumerate(classes):
        rest = "".join(c for c in ALPHABET if c not in letters)
        multiset = F.array_join(F.array_sort(F.split(F.translate(word, rest, ""), "")), "")
        out += [F.xxhash64(kind, size, F.lit(k), F.lit(side), part, multiset) for side, part in enumerate(halves)]
    return out


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: each word with each word that differs by one inserted, deleted or replaced letter.

    ``words`` holds distinct ``word`` with ``n``, of two letters or more. Both directions of a pair are returned, once.
    """
    replaced, inserted = letter_classes(words, REPLACED_CLASSES), letter_classes(words, INSERTED_CLASSES)

    def signed(roles: list[int], name: str) -> DataFrame:
        by_role = [F.struct(s.alias("sig"), F.lit(role).alias("role")) for role in roles for s in signatures(F.col("word"), role, replaced if role == EQUAL else inserted)]
        rows = words.select("word", "n", F.explode(F.array(*by_role)).alias("_s"))
        return rows.select(F.col("_s.sig").alias("sig"), F.col("_s.role").alias(f"{name}_role"), F.col("word").alias(name), F.col("n").alias(f"{name}_n"))

    left, right = signed([EQUAL, SHORT], "a"), signed([EQUAL, LONG], "b")
    fitting = ((F.col("a_role") == EQUAL) & (F.col("b_role") == EQUAL) & (F.col("a") < F.col("b"))) | ((F.col("a_role") == SHORT) & (F.col("b_role") == LONG))
    met = left.join(right, (left.sig == right.sig) & fitting & (F.levenshtein("a", "b", 1) == 1))
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    pairs = met.select(F.explode(both).alias("_p")).select("_p.*")
    # Dealt by word: the next grouping, by word alone, needs no other shuffle.
    return pairs.repartition("word").groupBy("word", "near").agg(F.first("n").alias("n"), F.first("near_n").alias("near_n")).select("word", "n", "near", "near_n")


def spelling_groups(docs: DataFrame, times_more: int = TIMES_MORE, **counting) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for all words of ``count_words``.

    ``form`` is a word's near word of largest count (ties: the first in code-point order) if that count is at least
    ``times_more`` times its own, else null; ``root`` is where forms lead from the word, itself without one.
    Counts grow along forms, so they never lead in a circle; chains are halved by self-joins until none is left.
    """
    words = stage(count_words(docs, **counting), "words")
    order = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))
    best = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(order).alias("_best"))
    rows = words.join(best, "word", "left")
    led = -F.col("_best.less") >= times_more * F.col("n")
    rows = rows.select("word", F.when(led, F.col("_best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(led, -F.col("_best.less")).alias("form_n"))
    rows = stage(rows, "forms")
    ways = rows.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("to"))
    while True:
        onward = ways.select(F.col("word").alias("to"), F.col("to").alias("_far"))
        ways = stage(ways.join(onward, "to", "left").select("word", F.coalesce("_far", "to").alias("to"), F.col("_far").isNotNull().alias("_moved")), "ways")
        if ways.filter("_moved").isEmpty():
            break
        ways = ways.drop("_moved")
    roots = ways.select("word", F.col("to").alias("_root"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
