"""The pipeline: stage by stage on small tables, and planted cases through all of it."""

import os

import pytest

import corpus_pipeline
from tripstats.llm.common import stored
from tripstats.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def kept(spark):
    """Rows after each stage, each stage read from what the one before wrote."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
        out.append((name, docs))
    return out


def ids(df):
    return {row.doc_id for row in df.select("doc_id").collect()}


def test_stages_return_documents(kept):
    columns = kept[0][1].columns
    for _, df in kept[:-1]:
        assert df.columns == columns
    assert kept[-1][1].columns[:2] == ["doc_id", "piece"]


def test_stages_only_take_rows_away(kept):
    for (_, before), (name, after) in zip(kept, kept[1:]):
        assert ids(after) <= ids(before), name
    assert ids(kept[-1][1]) == ids(kept[-2][1])


def test_run_composes_the_stages(spark, kept):
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, FOLDER).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, kept[-1][1].select(*columns).collect()))


def test_no_leak_and_no_copy_is_left(spark, kept):
    from tripstats.llm import decontamination, near_duplicates

    last = kept[-2][1]
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert decontamination.leaks(last, bench).count() == 0
    found = near_duplicates.near_duplicates(last, near_duplicates.Settings(5, 80))
    assert found.where("not kept").count() == 0


def test_empty_documents_pass_through(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_null_and_repeated_ids_are_decided_row_by_row(spark):
    texts = {name: " ".join(f"{name}{i}" for i in range(60)) for name in "ABCDE"}
    rows = [(1, texts["A"]), (1, texts["A"]), (None, texts["B"]), (None, texts["B"]), (5, texts["C"]),
            (6, texts["C"] + " tail"), (6, texts["D"]), (7, texts["E"]), (None, texts["A"]), (8, None), (9, "")]
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in rows])
    got = corpus_pipeline.drop_near_copies(spark, docs, FOLDER)
    assert got.columns == docs.columns
    kept = sorted((row.text or "").removesuffix(" tail") for row in got.collect())
    assert kept == ["", "", *sorted(texts.values())]


def test_leaks_are_decided_row_by_row(spark, tmp_path):
    item = " ".join(f"item{i}" for i in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = " ".join(f"clean{i}" for i in range(200))
    rows = [(None, f"a {item} b"), (7, f"x {item}"), (7, clean), (7, clean), (None, clean), (8, item), (9, None)]
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows])
    got = corpus_pipeline.drop_leaks(spark, docs, str(tmp_path))
    assert sorted((row.doc_id, row.text) for row in got.where("doc_id is not null").collect() if row.text) == [(7, clean)] * 2
    assert got.count() == 4
