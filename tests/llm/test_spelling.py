"""Spelling variants against all pairs of words in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spikelens.llm import spelling

DDL = "doc_id long, text string, word string, n long, near string, sig long, role int"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    words = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), c, len(near[w]), words.get(form[w])) for w, c in words.items()), key=str)


def groups(spark, rows):
    frame = spark.createDataFrame([(i, t, "w", 1, "x", 2, 3) for i, t in rows], DDL).repartition(4)
    return sorted((tuple(r) for r in spelling.spelling_groups(frame).collect()), key=str)


def variant(pick, word):
    k = pick.randrange(len(word))
    return pick.choice([word[:k] + word[k + 1 :], word[:k] + pick.choice("aeéxÿ") + word[k:], word[:k] + pick.choice("aeéxÿ") + word[k + 1 :]])


def corpus(seed):
    pick = random.Random(seed)
    stems = ["".join(pick.choice("abeinéßÿ") for _ in range(pick.randint(6, 12))) for _ in range(12)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(60):
            word = pick.choice(stems[: pick.randint(1, 12)])
            for _ in range(pick.choice([0] * 12 + [1, 1, 2])):
                word = variant(pick, word)
            words.append(pick.choice([word, word.capitalize(), word.upper() if word.isascii() else word]))
        rows.append((i, pick.choice([" ", ", ", "-", "1"]).join(words)))
    rows.append((1000, " ".join(["steadfast"] * 900 + ["steadfasd"] * 60 + ["steadfosd"] * 3)))
    return rows + [(1001 + k, "steadfast steadfast steadfasd") for k in range(3)]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_all_pairs(spark, seed):
    rows = corpus(seed)
    wanted = brute(rows)
    assert sum(r[1] is not None for r in wanted) > 20 and any(r[1] not in (None, r[2]) for r in wanted)
    assert groups(spark, rows) == wanted


def test_odd_rows(spark):
    rows = [(None, None), (None, "Straßenbahn straßenbahn"), (1, ""), (2, "short words only"), (3, "ABCDEFGH abcdefgh abcdefgx abcdefgx"), (3, "ABCDEFGH abcdefgh"), (4, "É" * 9 + " " + "é" * 9), (5, ("lengthy " * 300_000))]
    rows += [(k, "repetition repetition×÷ repetitiom") for k in range(40)]
    assert groups(spark, rows) == brute(rows)
    assert groups(spark, []) == []


def test_near_words_share_a_signature_whatever_the_classes(spark):
    pick = random.Random(5)
    words = {"".join(pick.choice("abcé") for _ in range(pick.randint(7, 9))) for _ in range(400)}
    words |= {variant(pick, w) for w in list(words)}
    frame = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    found = {(r.word, r.near) for r in spelling.near_words(frame).collect()}
    assert found == {(a, b) for a in words for b in words if one_edit(a, b)}
    assert spelling.near_words(frame).groupBy("word", "near").count().filter(F.col("count") > 1).isEmpty()
