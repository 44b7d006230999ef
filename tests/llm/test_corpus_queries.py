"""The registered corpus queries and the pipeline over the smallest tables."""

import zlib
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables here")


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "suffix_array_dedup", "decontamination", "packing"]


def test_language_is_found_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    rows = [r for r in entry.queries()["op9_language_id"](spark, str(TABLES)).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert sum(truth[r.doc_id] == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    total = docs.count()
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, str(TABLES))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 0.8 * total < docs.count() <= total


@pytest.mark.parametrize("name", sorted(entry.CORPUS_ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = pytest.importorskip("duckdb").connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    found = entry.queries()[name](spark, str(TABLES))
    cursor = connection.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(found.columns)
    wanted = sorted(map(str, cursor.fetchall()))
    assert sorted(str(tuple(r)) for r in found.select(names).collect()) == wanted
