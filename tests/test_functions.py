import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tripstats.functions import calendar, geo, parsing


def one(spark, column, **values):
    schema = values.pop("schema")
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "day, weekday, weekend",
    [("2019-06-01", 0, 1), ("2019-06-02", 0, 1), ("2019-06-03", 1, 0), ("2019-06-07", 1, 0)],
)
def test_day_flags(spark, day, weekday, weekend):
    df = spark.createDataFrame([(day,)], "d string").select(F.to_date("d").alias("d"))
    flags = df.select(calendar.weekday_flag(F.col("d")), calendar.weekend_flag(F.col("d"))).first()
    assert tuple(flags) == (weekday, weekend)


def test_day_flags_of_null(spark):
    df = spark.createDataFrame([(None,)], "d date")
    flags = df.select(calendar.weekday_flag(F.col("d")), calendar.weekend_flag(F.col("d"))).first()
    assert tuple(flags) == (None, None)


def test_seasons(spark):
    df = spark.createDataFrame([(m,) for m in (*range(1, 13), None)], "m int")
    found = {r.m: r.s for r in df.select("m", calendar.season(F.col("m")).alias("s")).collect()}
    assert [m for m in range(1, 13) if found[m] == "Winter"] == [1, 2, 12]
    assert [m for m in range(1, 13) if found[m] == "Spring"] == [3, 4, 5]
    assert [m for m in range(1, 13) if found[m] == "Summer"] == [6, 7, 8]
    assert [m for m in range(1, 13) if found[m] == "Fall"] == [9, 10, 11]
    assert found[None] is None


def test_hour_labels(spark):
    df = spark.createDataFrame([(h,) for h in (0, 1, 11, 12, 13, 23, None)], "h int")
    labels = [r[0] for r in df.select(calendar.hour_label(F.col("h"))).collect()]
    assert labels == ["12AM", "1AM", "11AM", "12PM", "1PM", "11PM", None]


def km(spark, *points):
    df = spark.createDataFrame([points], "a double, b double, c double, d double")
    return df.select(geo.haversine_km(*(F.col(c) for c in "abcd"))).first()[0]


def test_distance_of_known_arcs(spark):
    assert km(spark, 0.0, 0.0, 0.0, 90.0) == pytest.approx(6371 * math.pi / 2)
    assert km(spark, 90.0, 10.0, -90.0, 50.0) == pytest.approx(6371 * math.pi)
    assert km(spark, 40.7, -73.9, 40.7, -73.9) == 0
    assert km(spark, 12.0, 179.5, 12.0, -179.5) == pytest.approx(km(spark, 12.0, 0.0, 12.0, 1.0))


def test_distance_is_a_number_that_orders_as_one(spark):
    near, far = km(spark, 0.0, 0.0, 0.0, 9.5 / 111.19), km(spark, 0.0, 0.0, 0.0, 10.25 / 111.19)
    assert near < far


def test_distance_to_nowhere(spark):
    assert km(spark, None, 0.0, 0.0, 0.0) is None


def test_cell_numbers_undo_cell_key(spark):
    df = spark.createDataFrame([(0, 2**21 - 1, 77)], "i int, j int, k int")
    key = geo.cell_key(*(F.col(c) for c in "ijk"))
    numbers = df.select(*geo.cell_numbers(key)).first()
    assert tuple(numbers) == (0, 2**21 - 1, 77)


def test_parse_time(spark):
    texts = ["2019-01-02 03:04:05", "2019-01-02 03:04", "tomorrow", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(parsing.parse_time(F.col("t"))).collect()]
    assert found == [dt.datetime(2019, 1, 2, 3, 4, 5), dt.datetime(2019, 1, 2, 3, 4), None, None]


def test_split_coordinates(spark):
    texts = ["40.5,-73.9", "40.5, -73.9", "", "40.5", "a,b", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [tuple(r) for r in df.select(*parsing.split_coordinates(F.col("t"))).collect()]
    assert found[:2] == [(40.5, -73.9)] * 2
    assert found[2:] == [(None, None), (40.5, None), (None, None), (None, None)]


def test_station_documents(spark):
    good = '{"stationBeanList":[{"id":1,"stationName":"A","availableBikes":3,"extra":0}]}'
    df = spark.createDataFrame([(good,), ("{broken",), ('{"stationBeanList":[]}',)], "v string")
    parsed = df.select(parsing.parse_station_document(F.col("v")).alias("d"))
    records = parsed.select(F.explode("d.stationBeanList").alias("s")).select("s.*").collect()
    assert [(r.id, r.stationName, r.availableBikes, r.latitude) for r in records] == [(1, "A", 3, None)]
