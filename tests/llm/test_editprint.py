"""Edit fingerprints and the groups of near texts against step-by-step and all-pairs versions."""

import hashlib
import random

import numpy as np
import pytest

from spikelens.llm import editprint
from spikelens.llm.common import mix

WORDS = ["alpha", "über", "stone", "river", "naïve", "12", "—", "日本", "walks", "under", "light"]


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + pick.choice("abcdef") * pick.randint(0, 2) for _ in range(n))


def slow_print(text):
    """The walk one step at a time, then the sampled places."""
    if not text:
        return "0" * editprint.SAMPLES
    period, kinds = editprint.PERIOD, editprint.CLASSES
    noted, i, j = [], 0, 0
    while i < len(text):
        c = ord(text[i])
        kind = c % kinds if c < 128 else int(mix([c])[0] % np.uint64(kinds))
        noted.append(c)
        i += int(mix([kind * period + j % period + (0x5EED << 32)])[0] & np.uint64(1))
        j += 1
    out = []
    for b in range(editprint.SAMPLES):
        place = max(p for p in editprint.sampled_places()[b].tolist() if p < len(noted))
        out.append("%x" % int(mix([noted[place] + (place << 21)])[0] & np.uint64(15)))
    return "".join(out)


def brute(rows):
    """Rows of the operator for (doc_id, text) rows with distinct non-null ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        marks = [slow_print(x) for x in (t, edited, after)]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *marks[:2], editprint.text_likeness(t, marks[0], edited, marks[1]), editprint.text_likeness(t, marks[0], after, marks[2])))
    return sorted(out)


ROWS = [(k * 3, prose(k, 5 + 9 * k)) for k in range(40)] + [(1, None), (2, ""), (4, ""), (5, "x"), (7, "xy"), (8, prose(3, 32)), (10, prose(3, 32)), (11, prose(99, 4000))]


def test_prints_equal_the_walk_step_by_step(spark):
    frame = spark.createDataFrame([(i, t, 1, 2, "s") for i, t in ROWS], "doc_id long, text string, _part int, _rank long, _salt string").repartition(5)
    found = sorted(tuple(r) for r in editprint.edit_fingerprints(frame).collect())
    assert found == brute(ROWS)


def test_texts_longer_than_a_block(monkeypatch):
    texts = [prose(5, 700), "x" * 3000, prose(6, 10)]
    whole = [editprint.fingerprint(t) for t in texts]
    monkeypatch.setattr(editprint, "BLOCK", 97)
    assert [editprint.fingerprint(t) for t in texts] == whole == [slow_print(t) for t in texts]


def test_odd_tables(spark):
    ddl = "doc_id long, text string"
    assert editprint.edit_fingerprints(spark.createDataFrame([], ddl)).count() == 0
    one = editprint.edit_fingerprints(spark.createDataFrame([(7, "only one")], ddl)).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(7, 1.0)] and one[0].edited_sha256 == hashlib.sha256(b"only oon").hexdigest()
    rows = [(None, "no id"), (None, "no id"), (None, None), (3, "same id"), (3, "other text"), (3, "same id"), (4, "four")] * 3
    found = editprint.edit_fingerprints(spark.createDataFrame(rows, ddl).repartition(4)).collect()
    assert len(found) == len(rows)
    assert len({r.fingerprint for r in found}) == len({t or "" for _, t in rows})


def test_likeness_follows_the_edit(spark):
    texts = [prose(k, 400) for k in range(30)]
    marks = [editprint.fingerprint(t) for t in texts]
    apart = [editprint.likeness(a, b) for a, b in zip(marks, marks[1:])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near = [r.near_edited for r in editprint.edit_fingerprints(frame).collect()]
    assert min(near) > 0.5 > 0.35 > max(apart)
    few = [editprint.likeness(m, editprint.fingerprint(t[:900] + "#" + t[900:])) for m, t in zip(marks, texts)]
    assert np.mean(few) > 0.9


def test_edit_distance_equals_the_table():
    pick = random.Random(1)

    def table(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(300):
        a, b = ("".join(pick.choice("abcü") for _ in range(pick.randint(0, 30))) for _ in range(2))
        assert editprint.edit_distance(a, b) == table(a, b)


def test_near_groups_hold_planted_copies_apart_from_others(spark):
    rows = [(100 + k, prose(k, 120)) for k in range(15)] + [(1, None), (2, ""), (None, prose(0, 120))]
    for k in range(60):  # a group of copies, each with a few edits
        text = list(prose(77, 150))
        for _ in range(k % 4):
            text[random.Random(k).randrange(len(text))] = "~"
        rows.append((200 + k, "".join(text)))
    rows += [(300 + k, prose(0, 120)) for k in range(20)]
    found = editprint.near_groups(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string")).collect()
    groups = {r.doc_id: r.group_id for r in found}
    assert len(found) == len(rows)
    assert {groups[200 + k] for k in range(60)} == {200}
    assert {groups[300 + k] for k in range(20)} == {100} and groups[None] == 100
    assert all(groups[100 + k] == 100 + k for k in range(15)) and groups[1] == groups[2] == 1
    assert editprint.near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("similarity", [0.75, 0.95])
def test_every_link_of_a_group_is_within_the_distance(spark, similarity):
    base = prose(8, 80)
    rows = [(k, base[: len(base) - 12 * k] + "#" * (4 * k)) for k in range(8)]
    found = {r.doc_id: r.group_id for r in editprint.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), similarity).collect()}
    texts = dict(rows)
    for i, group in found.items():
        mates = [j for j, g in found.items() if g == group and j != i]
        assert i == group or any(editprint._close(texts[i], texts[j], similarity) for j in mates)
