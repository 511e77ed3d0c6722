import datetime
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripstats.sinks import write_csv, write_keyed
from tripstats.sinks import keyed
from tripstats.sources import read_table


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "table")


def frame(spark, data, schema="k int, t int, v string"):
    return spark.createDataFrame(data, schema)


def test_one_row_per_key(spark, rows, table):
    write_keyed(frame(spark, [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")]), table, ["k"], ["t"])
    assert rows(read_table(spark, table)) == [(1, 2, "b"), (2, 1, "c")]


def test_repeated_keys_need_an_order(spark, table):
    with pytest.raises(ValueError, match="order"):
        write_keyed(frame(spark, [(1, 1, "a"), (1, 2, "b")]), table, ["k"])
    assert keyed.stored_rows(spark, table) is None


def test_stored_data_is_not_written_over(spark, rows, table):
    df = frame(spark, [(1, 1, "a")])
    write_keyed(df, table, ["k"])
    with pytest.raises(FileExistsError):
        write_keyed(df, table, ["k"])
    with pytest.raises(ValueError):
        write_keyed(df, table, ["k"], mode="append")
    assert rows(read_table(spark, table)) == [(1, 1, "a")]


def test_upsert_by_order_keeps_the_later_row(spark, rows, table):
    write_keyed(frame(spark, [(1, 5, "a"), (2, 1, "b")]), table, ["k"], ["t"])
    more = frame(spark, [(1, 4, "late"), (2, 2, "new"), (3, 0, "first")])
    for _ in range(2):  # a repeated merge changes nothing
        write_keyed(more, table, ["k"], ["t"], mode="upsert")
        assert rows(read_table(spark, table)) == [(1, 5, "a"), (2, 2, "new"), (3, 0, "first")]


def test_upsert_without_order_takes_the_new_row(spark, rows, table):
    write_keyed(frame(spark, [(1, 5, "a"), (2, 1, "b")]), table, ["k"], mode="upsert")
    write_keyed(frame(spark, [(1, 4, "new")]), table, ["k"], mode="upsert")
    assert rows(read_table(spark, table)) == [(1, 4, "new"), (2, 1, "b")]


def test_spark_reads_the_partitions_only(spark, rows, table):
    for t in range(3):
        write_keyed(frame(spark, [(1, t, "x")]), table, ["k"], ["t"], mode="upsert")
    assert rows(spark.read.parquet(table), "k", "t") == [(1, 2)]
    assert {f for f in os.listdir(table) if "=" in f} == {"_table=0"}


def test_write_that_fails_changes_nothing(spark, rows, table):
    write_keyed(frame(spark, [(1, 1, "a")]), table, ["k"])
    broken = frame(spark, [(i, 9, "x") for i in range(200)]).repartition(8).withColumn(
        "v", F.when(F.col("k") == 150, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
    )
    for mode, order in (("upsert", ["t"]), ("upsert", None)):
        with pytest.raises(PySparkException, match="lost"):
            write_keyed(broken, table, ["k"], order, mode, unique=True)
        assert rows(read_table(spark, table)) == [(1, 1, "a")]
    write_keyed(frame(spark, [(2, 1, "b")]), table, ["k"], mode="upsert")
    assert rows(read_table(spark, table)) == [(1, 1, "a"), (2, 1, "b")]


def test_first_write_that_fails_can_be_made_again(spark, rows, table):
    broken = frame(spark, [(1, 1, "a")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(PySparkException, match="lost"):
        write_keyed(broken, table, ["k"], ["t"])
    assert rows(read_table(spark, table)) == []
    write_keyed(frame(spark, [(1, 1, "a")]), table, ["k"], ["t"])
    assert rows(read_table(spark, table)) == [(1, 1, "a")]


PARTED = "k int, month int, t int"


def files_of(table, month):
    return sorted(f for f in os.listdir(f"{table}/month={month}") if f.endswith(".parquet"))


def test_partitioned_upsert_rewrites_touched_partitions_only(spark, rows, table):
    write_keyed(frame(spark, [(1, 1, 1), (2, 1, 1), (3, 2, 1)], PARTED), table, ["k"], ["t"], partition_by=["month"])
    before = {month: files_of(table, month) for month in (1, 2)}
    change = frame(spark, [(1, 1, 2), (2, 1, 0), (9, 3, 1)], PARTED)
    write_keyed(change, table, ["k"], ["t"], "upsert", ["month"])
    stored = read_table(spark, table)
    assert rows(stored, "k", "month", "t") == [(1, 1, 2), (2, 1, 1), (3, 2, 1), (9, 3, 1)]
    assert files_of(table, 1) != before[1] and files_of(table, 2) == before[2] and files_of(table, 3)


def test_partitioned_upsert_past_the_listing_limit(spark, rows, table, monkeypatch):
    monkeypatch.setattr(keyed, "MAX_LISTED_PARTITIONS", 1)
    write_keyed(frame(spark, [(1, 1, 1), (3, 2, 1), (4, None, 1)], PARTED), table, ["k"], ["t"], partition_by=["month"])
    change = frame(spark, [(1, 1, 2), (3, 2, 2)], PARTED)
    write_keyed(change, table, ["k"], ["t"], "upsert", ["month"])
    assert rows(read_table(spark, table), "k", "t") == [(1, 2), (3, 2), (4, 1)]


@pytest.mark.parametrize("limit", [500, 0])
def test_partitioned_upsert_with_null_partition(spark, rows, table, limit, monkeypatch):
    monkeypatch.setattr(keyed, "MAX_LISTED_PARTITIONS", limit)
    write_keyed(frame(spark, [(1, None, 1), (2, None, 1)], PARTED), table, ["k"], ["t"], partition_by=["month"])
    write_keyed(frame(spark, [(1, None, 2)], PARTED), table, ["k"], ["t"], "upsert", ["month"])
    assert rows(read_table(spark, table), "k", "t") == [(1, 2), (2, 1)]


def test_partitioned_upsert_that_fails_changes_nothing(spark, rows, table):
    write_keyed(frame(spark, [(1, 1, 1), (3, 2, 1)], PARTED), table, ["k"], ["t"], partition_by=["month"])
    change = frame(spark, [(1, 1, 7), (3, 2, 5), (8, 2, 8)], PARTED)
    late = F.when(F.col("k") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("t")).cast("int")
    with pytest.raises(PySparkException, match="lost"):
        write_keyed(change.withColumn("t", late), table, ["k"], ["t"], "upsert", ["month"])
    assert rows(read_table(spark, table), "k", "month", "t") == [(1, 1, 1), (3, 2, 1)]
    write_keyed(change, table, ["k"], ["t"], "upsert", ["month"])
    assert rows(read_table(spark, table), "k", "month", "t") == [(1, 1, 7), (3, 2, 5), (8, 2, 8)]


@pytest.mark.parametrize("kind, values", [
    ("string", ["01", "1", "a b/c=d"]),
    ("date", [datetime.date(2024, 1, 1), datetime.date(2024, 1, 2), datetime.date(1999, 1, 1)]),
    ("long", [1, 2, 3]),
])
def test_partition_columns_keep_their_type(spark, rows, table, kind, values):
    data = [(i, value, 0) for i, value in enumerate(values)]
    write_keyed(frame(spark, data, f"k int, p {kind}, t int"), table, ["k"], ["t"], partition_by=["p"])
    change = frame(spark, [(0, values[0], 9)], f"k int, p {kind}, t int")
    write_keyed(change, table, ["k"], ["t"], "upsert", ["p"])
    stored = read_table(spark, table)
    assert dict(stored.dtypes)["p"] == ("bigint" if kind == "long" else kind)
    assert sorted(rows(stored, "k", "p", "t")) == [(0, values[0], 9), *data[1:]]


def test_null_keys_are_refused(spark, table):
    for order in (None, ["t"]):
        with pytest.raises(PySparkException, match="a row without k"):
            write_keyed(frame(spark, [(1, 1, "a"), (None, 1, "b")]), table, ["k"], order)
    assert read_table(spark, table).count() == 0


def test_write_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.range(100).repartition(4)
    write_csv(df, path)
    write_csv(df, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    assert spark.read.csv(path, header=True).count() == 100
