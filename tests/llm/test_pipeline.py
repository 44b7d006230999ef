"""The whole pipeline on planted rows against a plain Python version of its stages."""

import re
import zlib

import numpy as np
import pytest
from test_operators import brute_components, prose

import corpus_pipeline
from spikelens.llm.tokens import tokenizer

LENGTH, WINDOW = 200, 2048
ITEMS = ["A train leaves with 40 people and then 15 more people come on board at 90 km from here", "Tom has 4 red apples and 9 green pears in his bag"]


def planted():
    base, passage = prose(50, 90), prose(51, 60)
    edited = base.split()
    edited[40] = "edited"
    rows = [(k, prose(60 + k, 40 + 15 * k)) for k in range(12)]
    rows += [(20, base), (21, base), (22, " ".join(edited)), (23, base + " " + prose(52, 90))]
    rows += [(30, f"{prose(53, 40)} {passage} {prose(54, 40)}"), (31, f"{prose(55, 30)} {passage}"), (32, passage[:150] + prose(56, 50))]
    rows += [(40, f"{prose(57, 20)}. {ITEMS[0]}"), (41, ITEMS[1].replace("4", "7").replace("9", "12")), (42, f"{prose(58, 20)}. {ITEMS[0][:25]}"), (43, ITEMS[1].replace(" 9 green pears in his bag", ""))]
    rows += [(50, None), (51, ""), (52, " \n\t"), (53, "12 + 30 = 42"), (54, "a"), (55, prose(59, 6000))]
    return rows


def with_letters(rows):
    return [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]


def one_of_each(rows):
    first = {i for (i, _, group) in brute_components(rows) if i == group}
    return [(i, t) for i, t in rows if i in first]


def cut(rows):
    seen, out = {}, []
    for _, t in rows:
        for k in range(len(t) - LENGTH + 1):
            seen[t[k : k + LENGTH]] = seen.get(t[k : k + LENGTH], 0) + 1
    for i, t in rows:
        gone = set()
        for k in range(len(t) - LENGTH + 1):
            if seen[t[k : k + LENGTH]] > 1:
                gone.update(range(k, k + LENGTH))
        out.append((i, "".join(c for k, c in enumerate(t) if k not in gone)))
    return out


def clean(rows):
    like = [re.compile(re.sub(r"\d+", r"\\d+", item)) for item in ITEMS]
    return [(i, t) for i, t in rows if not any(x.search(t) for x in like)]


def pieces(rows):
    """Rows of the digest when the documents lie in this order."""
    out, at, whole = [], 0, tokenizer().whole
    for i, t in rows:
        ids = np.array(whole.encode(t, add_special_tokens=False).ids + [1], "<u4")
        start = 0
        while start < len(ids):
            sequence, offset = divmod(at, WINDOW)
            n = min(len(ids) - start, WINDOW - offset)
            out.append((i, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids), sequence, offset))
            start, at = start + n, at + n
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("pipeline")
    rows = [(i, t, "en" if i % 2 else "de", "planted", len(t or "")) for i, t in planted()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_every_stage_and_the_whole_run_equal_plain_python(spark, tables, monkeypatch):
    read, written = corpus_pipeline.stage, {}

    def watched(frame, name):
        written[name] = read(frame, name)
        return written[name]

    monkeypatch.setattr(corpus_pipeline, "stage", watched)
    found = [tuple(r) for r in corpus_pipeline.run(spark, tables).collect()]
    rows, sizes = planted(), []
    for (name, _), step in zip(corpus_pipeline.STAGES, (with_letters, one_of_each, cut, clean)):
        rows = step(rows)
        sizes.append((len(rows), sum(len(t) for _, t in rows)))
        assert sorted((r.doc_id, r.text, r.n_chars) for r in written[name].collect()) == sorted((i, t, len(t)) for i, t in rows), name
    assert len(set(sizes)) == 4 and sizes[0][0] < len(planted())  # every stage had something to do
    assert list(written) == [name for name, _ in corpus_pipeline.STAGES]
    order = list(dict.fromkeys(r[0] for r in sorted(found, key=lambda r: r[5:])))
    texts = dict(rows)
    assert sorted(order) == sorted(texts) and sorted(found) == sorted(pieces([(i, texts[i]) for i in order]))
