"""The manifest against a plain tree, on odd rows, many groups and single leaves."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from spikelens.llm import merkle

DDL = "doc_id long, source string, lang string, n_chars long, text string, tree long, seg string, _part int, row int, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def proofs_of(leaves):
    """Root, and for every leaf its steps: (side, sibling)."""
    level, at, steps = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for k in range(len(leaves)):
            mate = at[k] ^ 1
            steps[k].append((at[k] % 2, level[mate] if mate < len(level) else ""))
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [a // 2 for a in at]
    return level[0], steps


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = []
    for name in names:
        members = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((members, *proofs_of([leaf(*r) for r in members])))
    root, tops = proofs_of([t[1] for t in trees])
    out = []
    for (members, subroot, steps), top in zip(trees, tops):
        for r, own in zip(members, steps):
            path = own + top
            value = leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                value = leaf(*r[:3], r[3] + 1, r[4])
            for side, mate in path:
                value = sha(mate + value if side else value + mate)
            out.append((r[0], leaf(*r), subroot, root, sha("".join(m for _, m in path)), value, value == root))
    return sorted(out, key=str)


def manifest(spark, rows, span=merkle.SPAN):
    docs = spark.createDataFrame([(*r, 5, "x", 1, 2, "y") for r in rows], DDL).repartition(4)
    proofs = merkle.merkle_proofs(docs, merkle.leaf_of(*[F.col(c) for c in merkle.FIELDS]), merkle.tampered_leaf(), span=span)
    return sorted((tuple(r) for r in merkle.verify_proofs(proofs).collect()), key=str)


def rows_of(n, langs, seed=0):
    return [(k, f"s{k % 3}", langs[(k * 7 + seed) % len(langs)], k % 50, f"text ü {k}") for k in range(n)]


ODD = [
    (None, None, None, None, None), (None, None, None, None, None), (1, "a", "en", 3, "abc"), (1, "a", "en", 3, "abc"), (1, "b", "en", None, ""),
    (2, "", "", 0, "é" * 5000), (3, None, "zz", 2**63 - 1, "x"), (-4, "a", None, 4, "y"), (27, "a", "é", 4, "1:2"), (28, "a", "en", None, None),
]


@pytest.mark.parametrize("rows", [[(5, "s", "en", 1, "one")], rows_of(2, ["en"]), rows_of(3, ["en", "de", "fr"]), ODD, rows_of(150, ["en", None, "de", "fr", "en"])], ids=["one", "pair", "three groups", "odd", "many"])
def test_manifest_equals_a_plain_tree(spark, rows):
    found = manifest(spark, rows)
    assert found == brute(rows)
    assert not rows[20:] or 0 < sum(not r[-1] for r in found) < len(rows)


@pytest.mark.parametrize("small", [0, 20_000])
def test_several_spans_and_both_join_plans(spark, monkeypatch, small):
    monkeypatch.setattr(merkle, "SMALL_ROWS", small)
    rows = rows_of(90, [f"l{k}" for k in range(11)] + [None, "big", "big", "big", "big"], 3)
    assert manifest(spark, rows, span=2) == brute(rows)


def test_empty_table(spark):
    assert manifest(spark, []) == []


def test_a_proof_fits_its_own_leaf_only():
    steps = [(merkle.RIGHT, b"r" * 32), (merkle.ALONE, b""), (merkle.LEFT, b"l" * 32)]
    packed = b"".join(bytes([s]) + d for s, d in steps)
    assert merkle.siblings_of(packed) == steps
    assert merkle.fold(b"a" * 32, steps) != merkle.fold(b"b" * 32, steps)
