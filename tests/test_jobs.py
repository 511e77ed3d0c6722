"""The jobs in order, from landed files to stored tables."""

import datetime as dt
import json

import pytest

from test_sources import TRIP_HEADER
from tripstats import jobs
from tripstats.plans import bikes as bike_counts
from tripstats.sources import read_table


def land_trips(folder):
    lines = [TRIP_HEADER]
    for day in range(1, 29):
        for hour in range(7, 12):
            for bike in range(day % 3 + 1):
                start = dt.datetime(2019, 5 + day % 2, day, hour, 5)
                lines.append(
                    f'{300 + bike},"{start}","{start + dt.timedelta(minutes=5)}",1,"North",40.5,-73.9,'
                    f'2,"South",40.6,-73.8,{bike},"{"Customer" if bike else "Subscriber"}",1990,{bike}'
                )
    lines += [lines[-1], lines[-1].replace("1990", "")]
    (folder / "trips.csv").write_text("\n".join(lines))
    return len(lines) - 3


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")
    trips = land_trips(folder)
    hours = [
        {"time": f"2019-{m:02d}-{d:02d} {h:02d}:00", "temperature": float(h), "precipitation": 0.0,
         "humidity": 50, "dewpoint": 1.0, "windspeed": float(d % 3)}
        for m in (5, 6) for d in range(1, 32 - m % 2) for h in range(7, 11) if d <= 30
    ]
    files = {
        "nearby.json": {"output": {"data": [{"id": "w"}, {"id": "v"}]}},
        "hours.json": {"id": "w", "name": "W", "latitude": 40.5, "longitude": -73.9, "data": hours},
        "stations.json": {
            "stationBeanList": [
                {"id": 1, "stationName": "North", "latitude": 40.5, "longitude": -73.9},
                {"id": 2, "stationName": "South", "latitude": 40.6, "longitude": -73.8},
            ]
        },
    }
    for name, document in files.items():
        (folder / name).write_text(json.dumps(document))
    sites = [
        {"data": {"id": i, "name": i, "latitude": lat, "longitude": "-73.9"}}
        for i, lat in (("w", "40.5"), ("v", "10.0"), ("far", "40.5"))
    ]
    (folder / "sites.json").write_text("\n".join(map(json.dumps, sites)))
    header = (
        "Event ID,Event Name,Start Date/Time,End Date/Time,Event Agency,Event Type,"
        "Event Borough,Event Location"
    )
    event = "1,Fair,2019-06-01,2019-06-02,Parks,Street,Bronx,Main St"
    (folder / "events.csv").write_text("\n".join([header, event, event, event.replace("Main St", "?")]))
    (folder / "geocodes.csv").write_text('event_location,geocode\nMain St,"40.61,-73.8"\n?,\n')
    return folder, trips


def test_jobs(spark, rows, landed, tmp_path, capsys):
    folder, trips = landed

    def job(name, *arguments):
        jobs.main([name, *map(str, arguments)], spark)

    def table(name):
        return read_table(spark, str(tmp_path / name))

    job("weather-sites", "--nearby", folder / "nearby.json", "--records", folder / "sites.json",
        "--out", tmp_path / "sites")
    assert rows(table("sites"), "id") == [("v",), ("w",)]
    job("weather-hours", "--documents", folder / "hours.json", "--out", tmp_path / "hours")
    job("stations", "--snapshot", folder / "stations.json", "--sites", tmp_path / "sites",
        "--out", tmp_path / "stations")
    assert rows(table("stations"), "id", "weather_station_id") == [(1, "w"), (2, "w")]
    job("trips", "--files", folder / "trips.csv", "--out", tmp_path / "trips")
    assert table("trips").count() == trips
    job("trips", "--files", folder / "trips.csv", "--out", tmp_path / "trips", "--mode", "upsert")
    assert table("trips").count() == trips
    job("enrich", "--trips", tmp_path / "trips", "--stations", tmp_path / "stations",
        "--weather", tmp_path / "hours", "--out", tmp_path / "enriched")
    enriched = table("enriched")
    assert enriched.count() == table("trips").filter("start_hour < 11").count() > 0
    assert {"start_year", "temperature", "windspeed", "age"} <= set(enriched.columns)

    job("reports", "--trips", tmp_path / "enriched", "--out", tmp_path / "reports")
    assert rows(table("reports/total_trips")) == [(enriched.count(),)]
    assert table("reports/start_to_end_top_20").count() == 2
    assert rows(table("reports/percentage_change"), "year", "month") == [(2019, 6)]
    with pytest.raises(FileExistsError):
        job("reports", "--trips", tmp_path / "enriched", "--out", tmp_path / "reports")

    job("forecast", "--trips", tmp_path / "enriched", "--out", tmp_path / "models", "--weather")
    assert table("models/metrics").count() == 6
    assert "random_forest" in capsys.readouterr().out
    assert table("models/random_forest").count() > 0

    job("event-places", "--files", folder / "events.csv", "--out", tmp_path / "places")
    assert spark.read.csv(str(tmp_path / "places"), header=True).count() == 2
    job("locate-events", "--files", folder / "events.csv", "--geocodes", folder / "geocodes.csv",
        "--out", tmp_path / "located")
    job("load-events", "--files", tmp_path / "located", "--out", tmp_path / "events")
    assert rows(table("events"), "event_id", "event_location", "latitude") == [(1, "Main St", 40.61)]
    near = ["--trips", tmp_path / "trips", "--events", tmp_path / "located", "--single-file"]
    job("events-near", *near, "--out", tmp_path / "near")
    assert spark.read.csv(str(tmp_path / "near"), header=True).count() == 0
    job("events-near", *near, "--out", tmp_path / "nearer", "--min-trips", 1, "--km", 500)
    found = spark.read.csv(str(tmp_path / "nearer"), header=True)
    hours = table("trips").select("end_station_id", "start_year", "day_of_year", "start_hour")
    assert found.count() == hours.distinct().count() and rows(found.select("event_id").distinct()) == [("1",)]


def test_follow_stations(spark, rows, tmp_path):
    (tmp_path / "in").mkdir()
    document = {"stationBeanList": [{"id": 1, "stationName": "A", "availableBikes": 2}]}
    (tmp_path / "in" / "a.json").write_text(json.dumps(document))
    jobs.main(
        ["follow-stations", "--table", str(tmp_path / "t"), "--checkpoint", str(tmp_path / "c"),
         "--fmt", "text", "--option", f"path={tmp_path / 'in'}", "--seconds", "15"],
        spark,
    )
    assert rows(read_table(spark, str(tmp_path / "t")), "id", "available_bikes") == [(1, 2)]


def test_bikes_after_more_trips(spark, rows, tmp_path, caplog):
    def line(bike, day, month=5):
        return (f'300,"2019-0{month}-{day:02d} 08:05:00","2019-0{month}-{day:02d} 08:10:00",1,"North",40.5,-73.9,'
                f'2,"South",40.6,-73.8,{bike},"Subscriber",1990,1')

    def land(name, lines):
        (tmp_path / name).write_text("\n".join([TRIP_HEADER, *lines]))
        return str(tmp_path / name)

    def job(*arguments):
        jobs.main(list(arguments), spark)

    trips, out = str(tmp_path / "trips"), str(tmp_path / "bikes")
    job("trips", "--files", land("a.csv", [line(b, 1 + b % 28, 5 + b % 2) for b in range(60)]), "--out", trips)
    job("bikes", "--trips", trips, "--out", out)
    counted = read_table(spark, out)
    assert rows(bike_counts.count_bikes(counted)) == [(60,)]
    more = land("b.csv", [line(40_000 + b, 3) for b in range(5)] + [line(1, 2), line("?", 3)])
    with caplog.at_level("WARNING"):
        job("trips", "--files", more, "--out", trips, "--mode", "upsert")
    assert "1 of 7 trip lines could not be read in full" in caplog.text
    untouched = set((tmp_path / "bikes" / "start_year=2019" / "start_month=6").iterdir())
    job("bikes", "--trips", trips, "--out", out, "--changed", more)
    assert set((tmp_path / "bikes" / "start_year=2019" / "start_month=6").iterdir()) == untouched
    counted = read_table(spark, out)
    assert rows(bike_counts.count_bikes(counted)) == [(65,)]
    assert rows(bike_counts.count_bikes(counted, "start_month")) == [(5, 36), (6, 30)]
    swapped = land("c.csv", [line(1, 2)]).replace("c.csv", "d.csv")
    (tmp_path / "d.csv").write_text("\n".join([TRIP_HEADER.replace('"bikeid","usertype"', '"usertype","bikeid"'), line(1, 2)]))
    with pytest.raises(Exception, match="header does not conform"):
        job("trips", "--files", swapped, "--out", str(tmp_path / "other"))
