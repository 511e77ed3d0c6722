import datetime as dt
import json

import pytest
from pyspark.sql import Observation

from tripstats import sources

TRIP_HEADER = (
    '"tripduration","starttime","stoptime","start station id","start station name",'
    '"start station latitude","start station longitude","end station id","end station name",'
    '"end station latitude","end station longitude","bikeid","usertype","birth year","gender"'
)


def trip_line(duration=300, birth=1990, start="2019-06-01 08:15:00"):
    return (
        f'{duration},"{start}","2019-06-01 08:20:00",1,"A, north",40.5,-73.9,'
        f'2,"B",40.6,-73.8,77,"Subscriber",{birth},1'
    )


def test_read_trips(spark, tmp_path):
    lines = [TRIP_HEADER, trip_line(), trip_line(duration="x"), trip_line(birth=""), trip_line(start="?")]
    (tmp_path / "trips.csv").write_text("\n".join(lines))
    trips = sources.read_trips(spark, str(tmp_path))
    assert trips.columns[:4] == ["trip_duration", "start_time", "stop_time", "start_station_id"]
    found = trips.collect()
    assert found[0].start_time == dt.datetime(2019, 6, 1, 8, 15)
    assert (found[0].start_station_name, found[0].birth_year, found[0].gender) == ("A, north", 1990, 1)
    assert [r.trip_duration for r in found] == [300, None, 300, 300]
    assert [r.birth_year for r in found] == [1990, 1990, None, 1990]
    assert found[3].start_time is None and found[3].bike_id == 77


def test_read_events(spark, tmp_path):
    header = (
        "Event ID,Event Name,Start Date/Time,End Date/Time,Event Agency,Event Type,"
        "Event Location,event borough,Street Side,latitude,longitude"
    )
    row = '7,Fair,2019-06-01,2019-06-02,Parks,Street,"Main St, 1",Bronx,,40.5,-73.9'
    (tmp_path / "events.csv").write_text(f"{header}\n{row}\n")
    text = sources.read_events(spark, str(tmp_path))
    assert {t for _, t in text.dtypes} == {"string"}
    first = text.first()
    assert (first.event_location, first.event_borough) == ("Main St, 1", "Bronx")
    assert "Street Side" in text.columns
    guessed = sources.read_events(spark, str(tmp_path), infer=True)
    assert dict(guessed.dtypes)["event_id"] == "int"
    assert dict(guessed.dtypes)["latitude"] == "double"
    assert guessed.columns == text.columns


def test_read_station_snapshot(spark, tmp_path):
    station = {"id": 3, "stationName": "A", "availableBikes": 4, "latitude": 40.5, "testStation": False}
    document = {"executionTime": "now", "stationBeanList": [station, {**station, "id": 4}]}
    (tmp_path / "one.json").write_text(json.dumps(document, indent=2))
    (tmp_path / "none.json").write_text('{"stationBeanList": []}')
    (tmp_path / "bad.json").write_text('{"stationBeanList": [')
    stations = sources.read_station_snapshot(spark, str(tmp_path))
    assert len(stations.columns) == 18 and "test_station" in stations.columns
    assert sorted((r.id, r.station_name, r.available_bikes) for r in stations.collect()) == [
        (3, "A", 4),
        (4, "A", 4),
    ]


def test_read_weather_sites(spark, tmp_path):
    nearby = {"output": {"data": [{"id": "a"}, {"id": "b"}, {"id": "a"}]}}
    (tmp_path / "nearby.json").write_text(json.dumps(nearby))
    site = {"name": "S", "country": {"code": "US", "name": "U"}, "latitude": "40.5", "longitude": "x"}
    lines = [json.dumps({"data": {"id": i, **site}}) for i in "abc"] + ["{}"]
    (tmp_path / "sites.json").write_text("\n".join(lines))
    listed = sources.read_nearby_sites(spark, str(tmp_path / "nearby.json"))
    assert listed.count() == 3
    sites = sources.read_weather_sites(spark, str(tmp_path / "sites.json"), listed)
    assert sorted((r.id, r.latitude, r.longitude) for r in sites.collect()) == [
        ("a", 40.5, None),
        ("b", 40.5, None),
    ]
    assert sources.read_weather_sites(spark, str(tmp_path / "sites.json")).count() == 3


def test_read_weather_hours(spark, tmp_path):
    hours = [{"time": "2019-01-01 00:00", "temperature": 1.5, "humidity": 80}, {"time": "2019-01-01 01:00"}]
    lines = [{"id": "a", "name": "S", "latitude": 40.5, "data": hours}, {"id": "b", "data": []}]
    (tmp_path / "hours.json").write_text("\n".join(map(json.dumps, lines)))
    found = sources.read_weather_hours(spark, str(tmp_path))
    assert len(found.columns) == 18
    assert [(r.id, r.time, r.temperature, r.humidity) for r in found.collect()] == [
        ("a", "2019-01-01 00:00", 1.5, 80),
        ("a", "2019-01-01 01:00", None, None),
    ]


def test_read_table_takes_other_formats(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.orc(path)
    assert sources.read_table(spark, path, "orc").count() == 3
    plain = str(tmp_path / "p")
    spark.range(4).write.parquet(plain)
    assert sources.read_table(spark, plain).count() == 4


def test_a_swapped_header_stops_the_job(spark, tmp_path):
    header = TRIP_HEADER.replace('"starttime","stoptime"', '"stoptime","starttime"')
    (tmp_path / "trips.csv").write_text("\n".join([header, trip_line()]))
    assert sources.read_trips(spark, str(tmp_path)).count() == 1
    with pytest.raises(Exception, match="header does not conform"):
        sources.read_trips(spark, str(tmp_path), check_header=True).collect()
    (tmp_path / "trips.csv").write_text("\n".join([TRIP_HEADER.upper(), trip_line()]))
    assert len(sources.read_trips(spark, str(tmp_path), check_header=True).collect()) == 1


def test_unreadable_cells_are_counted(spark, tmp_path):
    short = trip_line().rsplit(",", 3)[0]
    lines = [TRIP_HEADER, trip_line(), trip_line(duration="x"), trip_line(birth=""), trip_line(start="?"), short]
    (tmp_path / "trips.csv").write_text("\n".join(lines))
    counted = Observation()
    trips = sources.read_trips(spark, str(tmp_path), check_header=True, counted=counted)
    plain = sources.read_trips(spark, str(tmp_path))
    assert trips.columns == plain.columns and trips.collect() == plain.collect()
    assert counted.get == {"read": 5, "bad": 3}


def test_malformed_documents_are_counted(spark, tmp_path):
    station = '{"id": 1, "stationName": "A", "latitude": 40.5, "longitude": -73.9}'
    good = '{"stationBeanList": [%s, %s]}' % (station, station)
    for name, text in (("a", good), ("b", good[:30]), ("c", "[]"), ("d", '{"stationBeanList": []}')):
        (tmp_path / f"{name}.json").write_text(text)
    counted = Observation()
    assert sources.read_station_snapshot(spark, str(tmp_path), counted=counted).count() == 2
    assert counted.get["bad"] == 1 and counted.get["read"] >= 3
    hours = tmp_path / "hours"
    hours.mkdir()
    (hours / "h.json").write_text('{"id": "w", "data": [{"time": "2019-06-01 08:00"}]}\n{"id": "v", "data": [{\n{"id": 7}')
    counted = Observation()
    assert sources.read_weather_hours(spark, str(hours), counted).count() == 1
    assert counted.get == {"read": 3, "bad": 1}
