"""The batch and stream jobs, from landed files to stored tables.

    python -m tripstats.jobs JOB --option value ...

or this file by spark-submit, with the package on the Python path.

Order: weather-sites, weather-hours, stations, trips, enrich; then the rest.
"""

import argparse
import functools
import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripstats import sinks, sources
from tripstats.fixed_values import (
    BUSY_TRIPS_PER_HOUR,
    EVENT_KEY,
    EVENT_RADIUS_KM,
    PREDICTION_KEY,
    REPORT_KEYS,
    STATION_KEY,
    TRIP_KEY,
    WEATHER_HOUR_KEY,
    WEATHER_MEASURES,
    WEATHER_SITE_KEY,
)
from tripstats.operators.keyed import latest_per_key
from tripstats.operators.periods import month_over_month
from tripstats.plans import (
    city_events,
    demand,
    enrichment,
    forecasting,
    report_cells,
)
from tripstats.plans import bikes as bike_counts
from tripstats.plans.bikes import BIKES_KEY, MONTH
from tripstats.session import build_session
from tripstats.streaming import station_status
from tripstats.workspace import scratch_path

_log = logging.getLogger(__name__)

# Trips are stored by month, so that a filter on time skips whole folders.
TRIP_PARTITIONS = ["start_year", "start_month"]

# A bounded run of a stream waits so long for the batch under way.
GRACE_SECONDS = 60

def weather_sites(spark: SparkSession, nearby: str, records: str, out: str) -> None:
    listed, counted = Observation(), Observation()
    near = sources.read_nearby_sites(spark, nearby, listed)
    sites = sources.read_weather_sites(spark, records, near, counted)
    sinks.write_keyed(sites, out, WEATHER_SITE_KEY, order_by=["name"])
    _tell_bad("site lists", listed)
    _tell_bad("site records", counted)


def weather_hours(spark: SparkSession, documents: str, out: str) -> None:
    counted = Observation()
    hours = sources.read_weather_hours(spark, documents, counted)
    sinks.write_keyed(hours, out, WEATHER_HOUR_KEY, order_by=["time_local"])
    _tell_bad("weather documents", counted)


def stations(
    spark: SparkSession, snapshot: str, sites: str, out: str, lines: bool = False
) -> None:
    """The latest record of each station, with the nearest site; of sites equally near the
    least id."""
    counted = Observation()
    records = sources.read_station_snapshot(spark, snapshot, lines, time_col="_time", counted=counted)
    known = records.dropna(subset=list(STATION_KEY))
    latest = latest_per_key(known, list(STATION_KEY), ["_time"]).drop("_time")
    located = enrichment.stations_with_site(latest, sources.read_table(spark, sites), ties="first")
    sinks.write_keyed(located, out, STATION_KEY, unique=True)
    _tell_bad("station documents", counted)


def trips(
    spark: SparkSession, files: str, out: str, mode: str = "errorifexists", any_header: bool = False
) -> None:
    """Store cleaned trips.  A file whose header names other columns, or the columns in another
    order, stops the job, unless ``any_header``."""
    counted = Observation()
    raw = sources.read_trips(spark, files, check_header=not any_header, counted=counted)
    cleaned = enrichment.clean_trips(raw)
    sinks.write_keyed(cleaned, out, TRIP_KEY, ["stop_time"], mode, TRIP_PARTITIONS)
    _tell_bad("trip lines", counted)


def _tell_bad(what: str, counted: Observation) -> None:
    found = counted.get
    if found["bad"]:
        _log.warning("%s of %s %s could not be read in full", found["bad"], found["read"], what)


def enrich(
    spark: SparkSession, trips: str, stations: str, weather: str, out: str, time: str = "time"
) -> None:
    tables = (sources.read_table(spark, path) for path in (trips, stations, weather))
    enriched = enrichment.enrich_trips(*tables, time_col=time)
    # Trips are stored by their key, and neither stations nor hours repeat theirs.
    sinks.write_keyed(enriched, out, TRIP_KEY, partition_by=TRIP_PARTITIONS, unique=True)


def reports(spark: SparkSession, trips: str, out: str) -> None:
    """All report tables.  The trips are read once, into the cells of all reports, which are stored by
    kind for the time of the job; the monthly change is derived from the stored counts."""
    cells = report_cells.trip_cells(sources.read_table(spark, trips))
    path = scratch_path(spark, "report-cells")
    cells.write.partitionBy("cell").parquet(path)
    stored = spark.read.schema(cells.schema).parquet(path)
    for name, report in report_cells.reports(stored).items():
        _write_report(report, name, out)
    counts = sources.read_table(spark, f"{out}/grouped_count")
    _write_report(month_over_month(counts), "percentage_change", out)


def bikes(spark: SparkSession, trips: str, out: str, changed: str | None = None) -> None:
    """The bikes of each month as bitmaps; with ``changed``, files of trips that were merged into
    the stored trips since, only of the months that these have trips of."""
    rides = sources.read_table(spark, trips)
    if changed is None:
        sinks.write_keyed(bike_counts.monthly_bikes(rides), out, BIKES_KEY, None, "errorifexists", MONTH, True)
        return
    news = enrichment.clean_trips(sources.read_trips(spark, changed))
    # A few hundred at most: months, not trips.
    months = [tuple(row) for row in news.select(*MONTH).distinct().collect()]
    counted = bike_counts.monthly_bikes(bike_counts.of_months(rides, months))
    sinks.write_keyed(counted, out, BIKES_KEY, None, "replace", MONTH, True)


def _write_report(report: DataFrame, name: str, out: str) -> None:
    """A keyed table cannot hold a row without its key; such rows are counted and told."""
    keys = list(REPORT_KEYS[name])
    missing = functools.reduce(lambda a, b: a | b, (F.col(key).isNull() for key in keys))
    counted = Observation()
    known = report.observe(counted, F.count_if(missing).alias("rows")).filter(~missing)
    # A report has one row a group.
    sinks.write_keyed(known, f"{out}/{name}", keys, unique=True)
    if counted.get["rows"]:
        _log.warning("%s: %s rows without %s are not stored", name, counted.get["rows"], keys)


def forecast(spark: SparkSession, trips: str, out: str, weather: bool = False) -> None:
    """Predictions of each model, and their metrics, which are shown too."""
    # Enriched trips are complete but for the weather: no other column need be read.
    rows = demand.training_rows(
        sources.read_table(spark, trips), weather, complete=list(WEATHER_MEASURES)
    )
    result = forecasting.forecast_demand(rows, with_weather=weather)
    for name, scored in result.predictions.items():
        sinks.write_keyed(scored, f"{out}/{name}", PREDICTION_KEY, ["number_of_trips"])
    sinks.write_keyed(result.metrics, f"{out}/metrics", ["model", "metric"])
    result.metrics.show(truncate=False)


def event_places(spark: SparkSession, files: str, out: str) -> None:
    """Location texts, for a geocoder to answer with ``event_location,geocode`` rows."""
    sinks.write_csv(city_events.event_locations(sources.read_events(spark, files)), out)


def locate_events(spark: SparkSession, files: str, geocodes: str, out: str) -> None:
    answers = spark.read.schema("event_location STRING, geocode STRING").csv(geocodes, header=True)
    locations = city_events.parse_geocodes(answers)
    located = city_events.locate_events(sources.read_events(spark, files), locations)
    sinks.write_csv(city_events.event_table(located), out)


def load_events(spark: SparkSession, files: str, out: str) -> None:
    """Located events as a typed table; rows without a whole number as id, or without a
    start, are counted and told."""
    events = city_events.event_table(sources.read_events(spark, files))
    missing = functools.reduce(lambda a, b: a | b, (F.col(key).isNull() for key in EVENT_KEY))
    counted = Observation()
    known = events.observe(counted, F.count_if(missing).alias("rows")).filter(~missing)
    sinks.write_keyed(known, out, EVENT_KEY, order_by=["event_location"])
    if counted.get["rows"]:
        _log.warning("%s events without %s are not stored", counted.get["rows"], EVENT_KEY)


def events_near(
    spark: SparkSession,
    trips: str,
    events: str,
    out: str,
    single_file: bool = False,
    min_trips: int = BUSY_TRIPS_PER_HOUR,
    km: float = EVENT_RADIUS_KM,
) -> None:
    """Events near busy stations, from the stored trips and files of located events."""
    near = city_events.events_near_busy_stations(
        sources.read_table(spark, trips), sources.read_events(spark, events), min_trips, km
    )
    sinks.write_csv(near, out, single_file)


def follow_stations(
    spark: SparkSession,
    table: str,
    checkpoint: str,
    fmt: str = "kafka",
    option: list[str] | None = None,
    seconds: float | None = None,
    per_batch: int | None = None,
    least_tasks: int | None = None,
    caught_up: bool = False,
    order_by: list[str] | None = None,
) -> None:
    """Keep the station status table up to date, for a time, until stopped, or with ``caught_up``
    until all that has arrived by now is in.  The latest record goes by ``order_by``, or by arrival."""
    options = dict(pair.split("=", 1) for pair in option or [])
    messages = sources.read_snapshot_stream(spark, fmt, options, per_batch, least_tasks)
    run = station_status.start_station_status(
        station_status.station_status(messages),
        table,
        checkpoint,
        order_by=tuple(order_by or station_status.ARRIVAL_ORDER),
        trigger={"availableNow": True} if caught_up else None,
    )
    if seconds is None:
        run.awaitTermination()
    elif not run.awaitTermination(seconds):
        _let_batch_end(run)
    run.stop()
    # The last hundred batches; each has told its own counts in its progress.
    told = [p.observedMetrics.get(station_status.DOCUMENTS) for p in run.recentProgress]
    bad, read = (sum(row[name] for row in told if row is not None) for name in ("bad", "read"))
    if bad:
        _log.warning("%s of the last %s station documents could not be read", bad, read)


def _let_batch_end(run: StreamingQuery) -> None:
    """A batch under way is finished before the stream is stopped, unless that takes too long; if it is cut
    off, the next run plays it again."""
    until = time.monotonic() + GRACE_SECONDS
    while run.isActive and run.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.1)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tripstats.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def add(name: str, job: Callable, *required: str) -> argparse.ArgumentParser:
        options = jobs.add_parser(name)
        options.set_defaults(run=job)
        for option in required:
            options.add_argument(f"--{option}", required=True)
        return options

    add("weather-sites", weather_sites, "nearby", "records", "out")
    add("weather-hours", weather_hours, "documents", "out")
    options = add("stations", stations, "snapshot", "sites", "out")
    options.add_argument("--lines", action="store_true")
    options = add("trips", trips, "files", "out")
    options.add_argument("--mode", choices=["errorifexists", "upsert"], default="errorifexists")
    options.add_argument("--any-header", action="store_true")
    options = add("enrich", enrich, "trips", "stations", "weather", "out")
    options.add_argument("--time", choices=["time", "time_local"], default="time")
    add("reports", reports, "trips", "out")
    options = add("bikes", bikes, "trips", "out")
    options.add_argument("--changed", metavar="FILES")
    options = add("forecast", forecast, "trips", "out")
    options.add_argument("--weather", action="store_true")
    add("event-places", event_places, "files", "out")
    add("locate-events", locate_events, "files", "geocodes", "out")
    add("load-events", load_events, "files", "out")
    options = add("events-near", events_near, "trips", "events", "out")
    options.add_argument("--single-file", action="store_true")
    options.add_argument("--min-trips", type=int, default=BUSY_TRIPS_PER_HOUR)
    options.add_argument("--km", type=float, default=EVENT_RADIUS_KM)
    options = add("follow-stations", follow_stations, "table", "checkpoint")
    options.add_argument("--fmt", default="kafka")
    options.add_argument("--option", action="append", metavar="KEY=VALUE")
    options.add_argument("--seconds", type=float)
    options.add_argument("--per-batch", type=int, metavar="FILES_OR_MESSAGES")
    options.add_argument("--least-tasks", type=int)
    options.add_argument("--caught-up", action="store_true")
    options.add_argument("--order-by", action="append", metavar="COLUMN")
    return parser


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    options = vars(_parser().parse_args(arguments))
    options.pop("job")
    run = options.pop("run")
    if spark is None:
        spark = build_session()
    run(spark, **options)


if __name__ == "__main__":
    main()
