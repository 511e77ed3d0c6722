import datetime as dt

import pytest
from conftest import executed_plan
from pyspark.sql import functions as F

from tripstats.plans import city_events, demand, enrichment, usage, weather_profiles

TRIP = (
    "trip_duration int, start_time timestamp, stop_time timestamp, start_station_id int, "
    "start_station_name string, start_station_latitude float, start_station_longitude float, "
    "end_station_id int, end_station_name string, end_station_latitude float, "
    "end_station_longitude float, bike_id int, user_type string, birth_year int, gender int"
)


def trip(start="2019-06-01 08:15:00", station=1, end=2, duration=600, birth=1990, gender=1, bike=7, user="Subscriber"):
    start = dt.datetime.fromisoformat(start)
    return (
        duration, start, start + dt.timedelta(seconds=duration or 0), station, f"S{station}",
        40.5, -73.9, end, f"S{end}", 40.6, -73.8, bike, user, birth, gender,
    )


@pytest.fixture
def make(spark):
    return lambda *trips: spark.createDataFrame(list(trips), TRIP)


def test_clean_trips(make, rows):
    cleaned = enrichment.clean_trips(
        make(trip(), trip(birth=None), trip(duration=None), trip("2019-12-31 23:55:00"))
    )
    parts = ["start_year", "start_month", "day_of_year", "start_hour", "stop_month", "stop_hour"]
    assert rows(cleaned, *parts, "weekday", "weekend", "age") == [
        (2019, 12, 365, 23, 1, 0, 1, 0, 29),
        (2019, 6, 152, 8, 6, 8, 0, 1, 29),
    ]
    assert enrichment.clean_trips(make(trip()), reference_year=2020).first().age == 30


def test_enrich_trips(spark, make, rows):
    trips = enrichment.clean_trips(
        make(
            trip("2019-06-01 08:15:00", station=1, bike=1),
            trip("2019-06-01 08:59:59", station=2, bike=2),
            trip("2019-06-01 09:00:00", station=1, bike=3),  # no weather for this hour
            trip("2018-06-01 08:15:00", station=1, bike=4),  # nor for this year
            trip("2019-06-01 08:15:00", station=9, bike=5),  # no such station
        )
    )
    stations = spark.createDataFrame(
        [(1, 0.0, 0.0), (2, 0.0, 0.3)], "id long, latitude double, longitude double"
    )
    sites = spark.createDataFrame(
        [("w", 0.0, -0.1), ("e", 0.0, 0.4)], "id string, latitude double, longitude double"
    )
    weather = spark.createDataFrame(
        [
            ("w", "2019-06-01 08:00:00", "2019-06-01 04:00", 11.0, 0.0, 50, 1.0, 2.0),
            ("e", "2019-06-01 08:00", "2019-06-01 04:00", None, 0.5, 60, 1.0, 3.0),
            ("w", "unknown", "2019-06-01 09:00", 13.0, 0.0, 70, 1.0, 2.0),
        ],
        "id string, time string, time_local string, temperature double, precipitation double, "
        "humidity int, dewpoint double, windspeed double",
    )
    located = enrichment.stations_with_site(stations, sites)
    assert rows(located, "id", "weather_station_id") == [(1, "w"), (2, "e")]
    for tuning in ({}, {"broadcast_bytes": 0, "salts": 3}):
        enriched = enrichment.enrich_trips(trips, located, weather, **tuning)
        assert rows(enriched, "bike_id", "temperature", "humidity") == [(1, 11.0, 50), (2, None, 60)]
    local = enrichment.enrich_trips(trips, located, weather, time_col="time_local")
    assert rows(local, "bike_id", "temperature") == [(3, 13.0)]


def test_usage_reports(make, rows):
    trips = enrichment.clean_trips(
        make(
            trip(station=1, end=2, duration=100, gender=1),
            trip(station=1, end=2, duration=200, gender=2, user="Customer"),
            trip(station=3, end=2, duration=300, gender=0, bike=8),
            trip(station=2, end=3, duration=400, gender=1, birth=1980, user="Dock"),
        )
    )
    assert rows(usage.total_trips(trips)) == [(4,)]
    assert rows(usage.total_trips(trips, year=2018)) == [(0,)]
    assert rows(usage.distinct_bikes(trips)) == [(2,)]
    top = usage.top_start_stations(trips, k=2).collect()
    assert [(r.start_station_name, r.number_of_trips) for r in top] == [("S1", 2), ("S2", 1)]
    assert [r.end_station_name for r in usage.top_end_stations(trips).collect()] == ["S2", "S3"]
    assert rows(usage.user_type_summary(trips)) == [("Customer", 1, 200.0), ("Subscriber", 2, 200.0)]
    routes = usage.top_routes(trips, k=2).collect()
    assert [tuple(r) for r in routes] == [
        ("Customer", "S1 to S2", 1, 200.0),
        ("Subscriber", "S1 to S2", 1, 100.0),
    ]
    assert rows(usage.trips_by_age(trips)) == [(29, 3, 1, 1, 1), (39, 1, 1, 0, 0)]
    assert rows(usage.duration_by_age(trips)) == [(29, 200.0), (39, 400.0)]
    assert rows(usage.monthly_trips(trips)) == [(2019, 6, 4)]
    assert rows(usage.season_hour_trips(trips)) == [(2019, 6, "8AM", 4, "Summer")]


def test_station_that_moved_counts_as_two(make, rows):
    moved = make(trip(), trip()).withColumn("start_station_latitude", F.lit(1.0))
    top = usage.top_start_stations(moved.union(make(trip())))
    assert rows(top, "start_station_name", "start_station_latitude", "number_of_trips") == [
        ("S1", 1.0, 2),
        ("S1", 40.5, 1),
    ]


def test_weather_profiles(spark, rows):
    trips = spark.createDataFrame(
        [(10, 5.0, None, 1, 1.0), (20, None, 0.5, None, 1.0), (60, 0.0, 0.5, None, None)],
        "trip_duration int, temperature double, precipitation double, humidity int, windspeed double",
    )
    assert rows(weather_profiles.by_temperature(trips)) == [(0.0, 2, 40.0), (5.0, 1, 10.0)]
    assert rows(weather_profiles.by_temperature(trips, "drop")) == [(0.0, 1, 60.0), (5.0, 1, 10.0)]
    assert rows(weather_profiles.by_precipitation_and_humidity(trips)) == [
        (0.0, 1, 1, 10.0),
        (0.5, 0, 2, 40.0),
    ]
    assert rows(weather_profiles.by_wind_speed(trips)) == [(0.0, 1, 60.0), (1.0, 2, 15.0)]
    with pytest.raises(ValueError):
        weather_profiles.by_wind_speed(trips, "mean")


EVENT = (
    "event_id string, event_name string, start_date_time string, end_date_time string, "
    "event_agency string, event_type string, event_borough string, event_location string"
)


def test_locate_events(spark, rows):
    fair = ("1", "Fair", "a", "b", "P", "T", "B", "Main St")
    events = spark.createDataFrame(
        [fair, fair, (*fair[:7], "Nowhere"), (*fair[:7], None), ("2", *fair[1:])], EVENT
    )
    assert rows(city_events.event_locations(events)) == [("Main St",), ("Nowhere",), (None,)]
    answers = spark.createDataFrame(
        [("Main St", "40.5,-73.9"), ("Nowhere", ""), ("Else", "1,2")],
        "event_location string, geocode string",
    )
    locations = city_events.parse_geocodes(answers)
    for tuning in ({}, {"broadcast_bytes": 0}):
        located = city_events.locate_events(events, locations, **tuning)
        table = city_events.event_table(located)
        assert rows(table, "event_id", "latitude", "longitude") == [
            (1, 40.5, -73.9),
            (2, 40.5, -73.9),
        ]
        assert len(table.columns) == 10


def test_events_near_busy_stations(spark, make, rows):
    busy = [trip("2019-06-01 08:%02d:00" % m, end=2) for m in range(3)]
    quiet = [trip("2019-06-01 09:00:00", end=2), trip(end=5)]
    events = spark.createDataFrame(
        [("1", "Near", "40.61", "-73.8"), ("1", "Near", "40.61", "-73.8"),
         ("2", "Far", "40.7", "-73.8"), ("3", "Unknown", "", None)],
        "event_id string, event_name string, latitude string, longitude string",
    )
    for tuning in ({}, {"broadcast_bytes": -1, "salts": 2}):
        near = city_events.events_near_busy_stations(make(*busy, *quiet), events, 3, **tuning)
        found = near.collect()
        assert [(r.end_station_id, r.hour, r["count"], r.event_id) for r in found] == [(2, 8, 3, "1")]
        assert 1.0 < found[0].distance_km < 1.2
    assert city_events.events_near_busy_stations(make(*busy), events).count() == 0


def test_training_rows(spark, make, rows):
    trips = enrichment.clean_trips(
        make(
            trip("2019-06-01 08:00:00"), trip("2019-06-01 08:30:00"), trip("2019-06-01 09:00:00"),
            trip("2019-06-01 11:00:00"), trip("2016-06-01 08:00:00"), trip("2016-06-01 09:00:00"),
        )
    )
    paired = demand.training_rows(trips)
    assert rows(paired, "start_station_id", "start_hour", "weekend", "past_trips", "number_of_trips") == [
        (1, 8, 1, 2, 1)
    ]
    assert demand.training_rows(trips, min_year=2010).count() == 2
    weather = trips.withColumns(
        {
            "temperature": F.when(F.minute("start_time") == 30, None).otherwise(20.0),
            "humidity": F.lit(50),
            "windspeed": F.lit(1.0),
        }
    )
    with_weather = demand.training_rows(weather, with_weather=True)
    assert rows(with_weather, "start_hour", "temperature", "past_trips", "number_of_trips") == [
        (8, 20.0, 1, 1)
    ]


def test_year_bound_skips_partitions_of_stored_trips(spark, make, tmp_path):
    trips = enrichment.clean_trips(make(trip(), trip("2016-06-01 08:00:00")))
    trips.write.partitionBy("start_year", "start_month").parquet(str(tmp_path / "t"))
    plan = executed_plan(demand.training_rows(spark.read.parquet(str(tmp_path / "t"))))
    assert "PartitionFilters: [isnotnull(start_year" in plan


def test_trips_are_not_shuffled_to_be_enriched(spark, make):
    trips = enrichment.clean_trips(make(trip()))
    stations = spark.createDataFrame([(1, "w")], "id long, weather_station_id string")
    weather = spark.createDataFrame(
        [("w", "2019-06-01 08:00", 1.0, 1.0, 1, 1.0, 1.0)],
        "id string, time string, temperature double, precipitation double, humidity int, "
        "dewpoint double, windspeed double",
    )
    enriched = enrichment.enrich_trips(trips, stations, weather)
    plan = executed_plan(enriched)
    assert plan.count("BroadcastHashJoin") == 2
    # What is dealt out is the weather, one row an hour.
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("Exchange hashpartitioning(weather_station_id" in line for line in dealt)
    assert enriched.count() == 1


def test_reports_read_the_trips_once(spark, tmp_path, monkeypatch):
    """All count and mean reports come from one scan with grouping sets."""
    from tripstats.plans import report_cells

    columns = dict.fromkeys(c for _, names in report_cells.SETS.values() for c in names)
    trips = spark.range(50).select(
        *((F.col("id") % (2 + i)).alias(c) for i, c in enumerate(columns)),
        F.when(F.col("id") % 5 > 0, F.col("id")).cast("int").alias("trip_duration"),
        (F.col("id") % 3).cast("int").alias("gender"),
    )
    trips.write.parquet(f"{tmp_path}/trips")
    cells = report_cells.trip_cells(spark.read.parquet(f"{tmp_path}/trips"))
    plan = executed_plan(cells)
    assert plan.count("FileScan") == 1 and "Expand" in plan
    assert cells.where("cell is null").isEmpty()


def test_reports_from_cells_equal_those_from_trips(spark, rows):
    from tripstats.plans import report_cells, usage, weather_profiles

    n = F.col("id")
    names = {"start": n % 4, "end": n % 3}
    trips = spark.range(400).select(
        *(F.concat(F.lit("S"), v.cast("string")).alias(f"{end}_station_name") for end, v in names.items()),
        *(((v + n % 2) / 2).alias(f"{end}_station_{c}") for end, v in names.items() for c in ("latitude", "longitude")),
        F.when(n % 11 > 0, n % 37).alias("bike_id"),
        F.when(n % 3 > 0, "Subscriber").otherwise(F.when(n % 2 > 0, "Customer")).alias("user_type"),
        (n % 6).cast("int").alias("age"),
        (2018 + n % 2).cast("int").alias("start_year"),
        (1 + n % 5).cast("int").alias("start_month"),
        (n % 24).cast("int").alias("start_hour"),
        *(F.when(n % (5 + i) > 0, n % (2 + i)).cast("double").alias(c) for i, c in enumerate(
            ("temperature", "precipitation", "humidity", "windspeed"))),
        F.when(n % 7 > 0, n).cast("int").alias("trip_duration"),
        (n % 3).cast("int").alias("gender"),
    )
    for some in (trips, trips.where("trip_duration is null"), trips.where("false")):
        made = report_cells.reports(report_cells.trip_cells(some))
        plain = {
            "total_trips": usage.total_trips(some),
            "distinct_bikes": usage.distinct_bikes(some),
            "start_trip_top_20": usage.top_start_stations(some, by_name=True),
            "end_trip_top_20": usage.top_end_stations(some, by_name=True),
            "average_trip_user_type": usage.user_type_summary(some),
            "start_to_end_top_20": usage.top_routes(some, by_name=True),
            "trips_age": usage.trips_by_age(some),
            "trip_duration_age": usage.duration_by_age(some),
            "grouped_count": usage.monthly_trips(some),
            "grouped_count_season": usage.season_hour_trips(some),
            "avg_temp": weather_profiles.by_temperature(some),
            "phmd": weather_profiles.by_precipitation_and_humidity(some),
            "windspeed": weather_profiles.by_wind_speed(some),
        }
        assert set(made) == set(plain)
        for name, report in plain.items():
            assert made[name].columns == report.columns, name
            assert rows(made[name]) == rows(report), name


def test_bikes_of_changed_months_only(spark, rows):
    from tripstats.plans import bikes, usage

    n = F.col("id")
    trips = spark.range(5000).select(
        F.when(n % 13 > 0, (n * 7919) % 200_003 - 70_000).alias("bike_id"),
        (2018 + n % 2).cast("int").alias("start_year"),
        (1 + n % 12).cast("int").alias("start_month"),
    )
    monthly = bikes.monthly_bikes(trips)
    assert monthly.select("bucket").distinct().count() > 3
    assert rows(bikes.count_bikes(monthly)) == rows(usage.distinct_bikes(trips))
    by_month = trips.groupBy("start_year", "start_month").agg(F.countDistinct("bike_id"))
    assert rows(bikes.count_bikes(monthly, *bikes.MONTH)) == rows(by_month)
    chosen = bikes.of_months(trips, [(2018, 1), (2019, 2)])
    assert rows(bikes.monthly_bikes(chosen)) == rows(bikes.of_months(monthly, [(2018, 1), (2019, 2)]))
    assert bikes.of_months(trips, []).isEmpty()
    assert rows(bikes.count_bikes(monthly.where("false"))) == [(0,)]


def test_bitmaps_are_built_after_the_shuffle(spark, rows):
    from tripstats.plans import bikes

    n = F.col("id")
    trips = spark.range(3000).repartition(8).select(
        ((n * 7919) % 100_003).alias("bike_id"),
        (2018 + n % 2).cast("int").alias("start_year"),
        (1 + n % 3).cast("int").alias("start_month"),
    )
    monthly = bikes.monthly_bikes(trips)
    counted = bikes.count_bikes(monthly, *bikes.MONTH)
    expected = trips.groupBy(*bikes.MONTH).agg(F.countDistinct("bike_id"))
    assert rows(counted) == rows(expected)
    plan = executed_plan(monthly)
    # No map task sends a bitmap of its own for a month and bucket.
    assert plan.index("partial_bitmap_construct_agg") < plan.index("Exchange")
