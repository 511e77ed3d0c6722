"""Every query against its SQL twin on the smallest test tables, and its plan."""

import os

import pytest
from conftest import executed_plan

from acceptance import compare
from acceptance.oracles import ORACLES
from acceptance.queries import QUERIES
from acceptance.stored import stations_table  # noqa: F401 - registers the stored queries

FOLDER = "/root/testdata/sf0.001"
MODELS = {"model_metrics", "model_predictions", "weather_model_metrics"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return compare.connect(FOLDER)


def test_all_queries_but_models_have_a_twin():
    assert set(QUERIES) - set(ORACLES) == MODELS
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in MODELS])
def test_query_equals_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    assert compare.spark_rows(df) == compare.sql_rows(tables, ORACLES[name])
    plan = executed_plan(df)
    for slow in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert slow not in plan


@pytest.mark.parametrize(
    "name, columns",
    [
        ("distinct_bikes", "l_partkey"),
        ("by_windspeed", "l_extendedprice,l_tax"),
        ("station_inflow", "ts,user_id"),
        ("hourly_demand", "ts,user_id"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    plan = executed_plan(QUERIES[name](spark, FOLDER))
    wide = max((line for line in plan.splitlines() if "FileScan parquet" in line), key=len)
    read = wide.split("ReadSchema: struct<")[1].split(">")[0]
    assert {field.split(":")[0] for field in read.split(",")} == set(columns.split(","))


@pytest.mark.parametrize("name", ["lag_demand", "pct_change", "events_near_busy"])
def test_trips_are_read_once(spark, name):
    plan = executed_plan(QUERIES[name](spark, FOLDER))
    for table in ("events", "lineitem", "orders"):
        assert plan.count(f"{table}.parquet") <= 1


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["user_type", "route", "number_of_trips", "average_duration"]
    assert df.count() == 20
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
