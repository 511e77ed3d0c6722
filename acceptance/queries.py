"""One query per operator and report, each over whole test tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance import standins
from tripstats import jobs, sinks, sources
from tripstats.fixed_values import EVENT_NAMES, TRIP_NAMES
from tripstats.functions import calendar, parsing
from tripstats.operators import columns, keyed, nearest, periods, radius, split
from tripstats.plans import (
    city_events,
    demand,
    enrichment,
    forecasting,
    usage,
    weather_profiles,
)
from tripstats.streaming import station_status
from tripstats.workspace import checkpointed, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

USER_TYPES = ("1-URGENT", "5-LOW")


def query(build):
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Trigonometric functions of two engines may differ in the last digit."""
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


# --- usage reports ---------------------------------------------------------------


@query
def total_trips(spark, folder):
    return usage.total_trips(standins.line_trips(spark, folder))


@query
def total_trips_of_year(spark, folder):
    trips = standins.line_trips(spark, folder)
    return usage.total_trips(trips.withColumn("start_year", F.year("start_time")), year=1999)


@query
def distinct_bikes(spark, folder):
    return usage.distinct_bikes(standins.line_trips(spark, folder))


@query
def start_top20(spark, folder):
    top = usage.top_start_stations(standins.line_trips(spark, folder))
    return rounded(top, start_station_latitude=6, start_station_longitude=6)


@query
def end_top20(spark, folder):
    top = usage.top_end_stations(standins.trips(spark, folder))
    return rounded(top, end_station_latitude=6, end_station_longitude=6)


@query
def usertype_summary(spark, folder):
    return usage.user_type_summary(standins.trips(spark, folder), USER_TYPES)


@query
def route_top20(spark, folder):
    return usage.top_routes(standins.trips(spark, folder))


@query
def trips_age(spark, folder):
    return usage.trips_by_age(enrichment.add_calendar(standins.trips(spark, folder)))


@query
def duration_by_age(spark, folder):
    trips = enrichment.add_calendar(standins.trips(spark, folder))
    return usage.duration_by_age(trips)


@query
def monthly_trips(spark, folder):
    return usage.monthly_trips(enrichment.add_calendar(standins.trips(spark, folder)))


@query
def pct_change(spark, folder):
    counts = usage.monthly_trips(enrichment.add_calendar(standins.trips(spark, folder)))
    return periods.month_over_month(counts)


@query
def pct_change_of_previous(spark, folder):
    counts = usage.monthly_trips(enrichment.add_calendar(standins.trips(spark, folder)))
    return periods.month_over_month(counts, denominator="previous")


@query
def season_hour(spark, folder):
    trips = enrichment.add_calendar(standins.clock_trips(spark, folder))
    return usage.season_hour_trips(trips)


@query
def season_of_month(spark, folder):
    seasons = F.year("start_time").alias("year"), calendar.season(F.month("start_time"))
    trips = standins.line_trips(spark, folder).select(seasons[0], seasons[1].alias("season"))
    return trips.groupBy("year", "season").agg(F.count(F.lit(1)).alias("trips"))


# --- weather reports -------------------------------------------------------------


@query
def fill0_by_measure(spark, folder):
    return weather_profiles.by_temperature(standins.line_trips(spark, folder))


@query
def two_measures(spark, folder):
    return weather_profiles.by_precipitation_and_humidity(standins.line_trips(spark, folder))


@query
def by_windspeed(spark, folder):
    return weather_profiles.by_wind_speed(standins.line_trips(spark, folder))


@query
def by_windspeed_known(spark, folder):
    return weather_profiles.by_wind_speed(standins.line_trips(spark, folder), missing="drop")


# --- cleaning and derived columns ------------------------------------------------


@query
def trip_features(spark, folder):
    trips = enrichment.add_calendar(standins.clock_trips(spark, folder))
    return trips.select(
        "bike_id",
        "start_year",
        "start_month",
        "day_of_year",
        "start_hour",
        "stop_month",
        "stop_hour",
        "weekday",
        "weekend",
        "age",
    )


@query
def weekday_flags(spark, folder):
    start = F.col("o_orderdate")
    flags = calendar.weekday_flag(start), calendar.weekend_flag(start)
    orders = standins.table(spark, folder, "orders")
    return orders.groupBy(flags[0].alias("weekday"), flags[1].alias("weekend")).agg(
        F.count(F.lit(1)).alias("trips")
    )


@query
def dropna(spark, folder):
    events = standins.table(spark, folder, "events").select(
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.nullif("user_id", F.lit(3)).alias("user_id"),
    )
    return columns.drop_incomplete(events).agg(F.count(F.lit(1)).alias("complete"))


@query
def fill0(spark, folder):
    events = standins.table(spark, folder, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.nullif("user_id", F.lit(3)).alias("user_id"),
    )
    return columns.zero_fill(events)


@query
def weather_times(spark, folder):
    """Times with and without seconds, and some that cannot be read."""
    number = F.col("event_id") % 3
    text = (
        F.when(number == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(number == 1, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .otherwise("soon")
    )
    at = parsing.parse_time(text)
    events = standins.table(spark, folder, "events")
    return events.select(
        "event_id", F.hour(at).alias("hour"), F.minute(at).alias("minute"), F.second(at).alias("second")
    )


@query
def geocode_parts(spark, folder):
    placed = city_events.parse_geocodes(standins.geocodes(spark, folder))
    return rounded(placed, latitude=6, longitude=6)


# --- joins -----------------------------------------------------------------------


@query
def station_join(spark, folder):
    trips = standins.line_trips(spark, folder)
    suppliers = standins.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").cast("string").alias("weather_station_id"),
    )
    located = enrichment.attach_site(trips, suppliers)
    return located.groupBy("start_station_id", "weather_station_id").agg(
        F.count(F.lit(1)).alias("trips")
    )


@query
def station_join_salted(spark, folder):
    """The same result by the path for lookup tables too large to broadcast."""
    trips = standins.line_trips(spark, folder)
    suppliers = standins.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").cast("string").alias("weather_station_id"),
    )
    located = enrichment.attach_site(trips, suppliers, broadcast_bytes=-1)
    return located.groupBy("start_station_id", "weather_station_id").agg(
        F.count(F.lit(1)).alias("trips")
    )


@query
def weather_join(spark, folder):
    site = (F.col("start_station_id") % 25).cast("string").alias("weather_station_id")
    trips = enrichment.add_calendar(standins.clock_trips(spark, folder)).select("*", site)
    joined = enrichment.attach_weather(trips, standins.weather(spark, folder))
    return joined.select(
        "bike_id",
        "weather_station_id",
        "temperature",
        "precipitation",
        "humidity",
        "dewpoint",
        "windspeed",
    )


@query
def trip_enrichment(spark, folder):
    """The whole pipeline: clean, derive, nearest site, weather of the hour.

    Stations with their site are stored before they are joined, as the jobs do.
    """
    trips = enrichment.clean_trips(standins.clock_trips(spark, folder))
    stations = enrichment.stations_with_site(
        standins.rider_stations(spark, folder), standins.sites(spark, folder)
    )
    enriched = enrichment.enrich_trips(trips, checkpointed(stations), standins.weather(spark, folder))
    return enriched.select(
        "bike_id",
        "start_station_id",
        "start_year",
        "start_month",
        "day_of_year",
        "start_hour",
        "weekday",
        "weekend",
        "age",
        "temperature",
        "precipitation",
        "humidity",
        "dewpoint",
        "windspeed",
    )


@query
def nearest_site(spark, folder):
    found = nearest.nearest_site(standins.stations(spark, folder), standins.sites(spark, folder))
    return rounded(found.select("id", "weather_station_id", "distance_km"), distance_km=6)


@query
def nearest_site_first(spark, folder):
    found = nearest.nearest_site(
        standins.rider_stations(spark, folder), standins.sites(spark, folder), ties="first"
    )
    return rounded(found.select("id", "weather_station_id", "distance_km"), distance_km=6)


@query
def nearest_of_many_sites(spark, folder):
    """As many sites as customers, by the search for tables of any size."""
    found = nearest.nearest_site(
        standins.stations(spark, folder), standins.rider_stations(spark, folder)
    )
    return rounded(found.select("id", "weather_station_id", "distance_km"), distance_km=6)


@query
def within_radius(spark, folder):
    sites = columns.prefix_columns(standins.sites(spark, folder), "site_")
    pairs = radius.within_radius(
        standins.stations(spark, folder),
        sites.distinct(),
        right_point=("site_latitude", "site_longitude"),
    )
    return rounded(pairs.select("id", "site_id", "distance_km"), distance_km=6)


@query
def within_radius_fine(spark, folder):
    """Small radius, many places on both sides, by the path without broadcast."""
    places = columns.prefix_columns(standins.customer_places(spark, folder), "place_")
    pairs = radius.within_radius(
        standins.rider_stations(spark, folder),
        places,
        km=0.75,
        right_point=("place_latitude", "place_longitude"),
        broadcast_bytes=-1,
    )
    return rounded(pairs.select("id", "place_event_id", "distance_km"), distance_km=6)


@query
def station_inflow(spark, folder):
    trips = standins.clock_trips(spark, folder)
    busy = city_events.busy_station_hours(trips, min_trips=5)
    return busy.select("end_station_id", "date", "hour", "count")


@query
def events_near_busy(spark, folder):
    events = standins.sites(spark, folder).select(
        F.col("id").alias("event_id"),
        F.concat(F.lit("Event "), "id").alias("event_name"),
        F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
    )
    near = city_events.events_near_busy_stations(
        standins.line_trips(spark, folder), events, min_trips=3
    )
    return rounded(
        near.select("end_station_id", "date", "hour", "count", "event_id", "event_name", "distance_km"),
        distance_km=6,
    )


@query
def event_lookup(spark, folder):
    locations = city_events.parse_geocodes(standins.geocodes(spark, folder))
    located = city_events.locate_events(standins.city_events(spark, folder), locations)
    return rounded(city_events.event_table(located), latitude=6, longitude=6)


@query
def event_places(spark, folder):
    return city_events.event_locations(standins.city_events(spark, folder))


# --- demand ----------------------------------------------------------------------


def _clock_trips(spark, folder):
    return enrichment.add_calendar(standins.clock_trips(spark, folder))


@query
def hourly_demand(spark, folder):
    return demand.hourly_demand(standins.clock_trips(spark, folder))


@query
def lag_demand(spark, folder):
    return demand.training_rows(_clock_trips(spark, folder))


def _weather_trips(spark, folder):
    site = (F.col("start_station_id") % 25).cast("string").alias("weather_station_id")
    trips = _clock_trips(spark, folder).select("*", site)
    return enrichment.attach_weather(trips, standins.weather(spark, folder))


@query
def lag_demand_weather(spark, folder):
    return demand.training_rows(_weather_trips(spark, folder), with_weather=True)


@query
def key_split(spark, folder):
    keys = ["start_station_id", "start_date", "start_hour"]
    rows = demand.hourly_demand(standins.clock_trips(spark, folder))
    sides = rows.groupBy(split.in_first_part(keys).alias("train"))
    return sides.agg(F.count(F.lit(1)).alias("rows"))


# --- models: no SQL twin, but for the rows that are scored -----------------------


@query
def model_metrics(spark, folder):
    rows = demand.training_rows(_clock_trips(spark, folder))
    return forecasting.forecast_demand(rows).metrics


def _predictions(spark, folder):
    rows = demand.training_rows(_clock_trips(spark, folder))
    return _predictions_of(forecasting.forecast_demand(rows))


def _predictions_of(forecast):
    scored = [df.withColumn("model", F.lit(name)) for name, df in forecast.predictions.items()]
    return scored[0].unionByName(scored[1]).unionByName(scored[2])


@query
def model_predictions(spark, folder):
    return _predictions(spark, folder)


@query
def scored_rows(spark, folder):
    """Each model scores the rows of the second part, and those only."""
    return _predictions(spark, folder).drop("prediction")


@query
def weather_model_metrics(spark, folder):
    rows = demand.training_rows(_weather_trips(spark, folder), with_weather=True)
    return forecasting.forecast_demand(rows, with_weather=True).metrics


# --- keyed tables ----------------------------------------------------------------


@query
def upsert_latest(spark, folder):
    events = standins.table(spark, folder, "events")
    return keyed.latest_per_key(events, ["user_id"], ["ts"]).select("user_id", "event_id", "event_type")


@query
def keyed_table(spark, folder):
    """Half of the events stored, the other half merged in, the table read back."""
    events = standins.table(spark, folder, "events").select("user_id", "ts", "event_id", "value")
    first = F.col("event_id") % 2 == 0
    path = scratch_path(spark, "keyed-table")
    sinks.write_keyed(events.filter(first), path, ["user_id"], ["ts"])
    sinks.write_keyed(events.filter(~first), path, ["user_id"], ["ts"], mode="upsert")
    return sources.read_table(spark, path).select("user_id", "event_id", "value")


@query
def partitioned_table(spark, folder):
    """Trips by month; a merge of the later ones rewrites only their months."""
    lines = standins.table(spark, folder, "lineitem").select(
        "l_suppkey",
        F.year("l_shipdate").alias("ship_year"),
        F.month("l_shipdate").alias("ship_month"),
        "l_orderkey",
        "l_linenumber",
    )
    keys, months = ["l_suppkey", "ship_year", "ship_month"], ["ship_year", "ship_month"]
    order = ["l_orderkey", "l_linenumber"]
    path = scratch_path(spark, "partitioned-table")
    late = F.col("ship_year") >= 2000
    even = F.col("l_orderkey") % 2 == 0
    sinks.write_keyed(lines.filter(~late | even), path, keys, order, partition_by=months)
    sinks.write_keyed(lines.filter(late & ~even), path, keys, order, "upsert", months)
    return sources.read_table(spark, path)


# --- files -----------------------------------------------------------------------


@query
def trips_csv(spark, folder):
    """Trips written with the public header, some cells unreadable, read and cleaned."""
    trips = standins.line_trips(spark, folder).join(
        standins.table(spark, folder, "part").select(F.col("p_partkey").alias("bike_id"), "p_size"),
        "bike_id",
    )
    seconds = F.col("trip_duration").cast("string")
    raw = trips.select(
        F.when(F.col("p_size") == 7, "x").otherwise(seconds).alias("trip_duration"),
        "start_time",
        F.col("start_time").alias("stop_time"),
        "start_station_id",
        "start_station_name",
        "start_station_latitude",
        "start_station_longitude",
        "end_station_id",
        "end_station_name",
        "end_station_latitude",
        "end_station_longitude",
        "bike_id",
        F.lit("Subscriber").alias("user_type"),
        F.nullif(1940 + F.col("p_size"), F.lit(1950)).alias("birth_year"),
        F.lit(1).alias("gender"),
    )
    path = scratch_path(spark, "trips-csv")
    sinks.write_csv(raw.withColumnsRenamed({ours: theirs for theirs, ours in TRIP_NAMES.items()}), path)
    trips = enrichment.clean_trips(sources.read_trips(spark, path))
    return trips.groupBy("start_station_id", "start_year", "age").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("trip_duration").alias("seconds")
    )


def _events_csv(spark, folder):
    path = scratch_path(spark, "events-csv")
    events = standins.city_events(spark, folder)
    sinks.write_csv(events.withColumnsRenamed({ours: theirs for theirs, ours in EVENT_NAMES.items()}), path)
    return path


@query
def events_csv(spark, folder):
    events = sources.read_events(spark, _events_csv(spark, folder)).dropDuplicates()
    return events.groupBy("event_id", "event_location").agg(F.count(F.lit(1)).alias("listed"))


@query
def events_csv_inferred(spark, folder):
    events = sources.read_events(spark, _events_csv(spark, folder), infer=True).dropDuplicates()
    return events.groupBy("event_id", F.year("start_date_time").alias("year")).agg(
        F.count(F.lit(1)).alias("listed")
    )


@query
def station_snapshot(spark, folder):
    """Snapshot documents landed as files, read back as station rows."""
    path = scratch_path(spark, "station-snapshot")
    documents = standins.station_documents(spark, folder)
    documents.repartition("document").select("value").write.text(path)
    rows = sources.read_station_snapshot(spark, path, lines=True)
    return rows.groupBy("id", "station_name").agg(
        F.count(F.lit(1)).alias("records"), F.sum("available_bikes").alias("bikes")
    )


@query
def weather_sites_json(spark, folder):
    """Site lists and site records landed as responses; every tenth site is not near."""
    customers = standins.rider_stations(spark, folder)
    number = F.col("id").cast("string")
    site = F.struct(
        number.alias("id"),
        F.concat(F.lit("Site "), number).alias("name"),
        F.struct(F.lit("US").alias("code"), F.lit("United States").alias("name")).alias("country"),
        F.lit("NY").alias("region"),
        F.col("latitude").cast("string").alias("latitude"),
        F.when(F.col("id") % 9 == 0, "?").otherwise(F.col("longitude").cast("string")).alias("longitude"),
    )
    records = scratch_path(spark, "site-records")
    customers.select(F.to_json(F.struct(site.alias("data")))).write.text(records)
    listed = F.struct(number.alias("id"), F.lit("1.5").alias("distance"))
    lists = customers.filter("id % 10 <> 0").groupBy(F.expr("id div 10")).agg(
        F.struct(F.collect_list(listed).alias("data")).alias("output")
    )
    responses = scratch_path(spark, "site-lists")
    lists.select(F.to_json(F.struct("output"))).write.text(responses)
    nearby = sources.read_nearby_sites(spark, responses)
    sites = sources.read_weather_sites(spark, records, nearby)
    return sites.select(
        "id",
        "name",
        "region",
        F.round(F.col("latitude").cast("double"), 3).alias("latitude"),
        F.round(F.col("longitude").cast("double"), 3).alias("longitude"),
    )


@query
def weather_hours_json(spark, folder):
    """One document per site and day with its hours, read as one row per hour."""
    hours = standins.weather(spark, folder)
    hour = F.struct("time", "temperature", "humidity")
    documents = hours.groupBy("id", F.substring("time", 1, 10).alias("name")).agg(
        F.sort_array(F.collect_list(hour)).alias("data")
    )
    path = scratch_path(spark, "weather-hours")
    documents.select(F.to_json(F.struct("id", "name", "data"))).write.text(path)
    rows = sources.read_weather_hours(spark, path)
    return rows.select(
        "id",
        "time",
        F.round(F.col("temperature").cast("double"), 2).alias("temperature"),
        "humidity",
    )


@query
def json_field(spark, folder):
    events = standins.table(spark, folder, "events")
    return events.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


@query
def json_explode(spark, folder):
    """Station rows of status documents, as the stream parses them."""
    documents = standins.station_documents(spark, folder)
    messages = documents.select(
        "value",
        F.lit(None).cast("timestamp").alias("arrived_at"),
        F.col("document").cast("string").alias("sequence"),
    )
    rows = station_status.station_status(messages)
    return rows.select(
        F.col("sequence").cast("int").alias("document"),
        F.col("position"),
        "id",
        "station_name",
        "available_bikes",
        "available_docks",
        F.round(F.col("latitude").cast("double"), 3).alias("latitude"),
        F.round(F.col("longitude").cast("double"), 3).alias("longitude"),
    )


# --- stream ----------------------------------------------------------------------


@query
def station_stream(spark, folder):
    """The status documents streamed into the keyed table, which is read at the end."""
    landed = scratch_path(spark, "status-documents")
    standins.station_documents(spark, folder).select("value").write.text(landed)
    messages = sources.read_snapshot_stream(spark, "text", {"path": landed, "wholetext": "false"})
    table = scratch_path(spark, "station-status")
    run = station_status.start_station_status(
        station_status.station_status(messages),
        table,
        checkpoint=scratch_path(spark, "stream-checkpoint"),
        order_by=("snapshot_time", "position"),
        trigger={"availableNow": True},
    )
    run.awaitTermination()
    return station_status.read_station_status(spark, table).select(
        "id", "station_name", "available_bikes", "available_docks"
    )


@query
def station_stream_batches(spark, folder):
    """The status documents as files, of which each micro-batch takes two, by the job that
    follows them until it has caught up."""
    landed = scratch_path(spark, "status-documents")
    documents = standins.station_documents(spark, folder)
    documents.repartition(6, "document").select("value").write.text(landed)
    table = scratch_path(spark, "station-status")
    _follow(spark, landed, table, scratch_path(spark, "stream-checkpoint"), caught_up=True)
    return station_status.read_station_status(spark, table).select(
        "id", "station_name", "available_bikes", "available_docks"
    )


@query
def station_stream_bounded(spark, folder):
    """As station_stream_batches, by a run that is stopped after a second and the batch under way then, and
    one that goes on from its checkpoint."""
    landed = scratch_path(spark, "status-documents")
    documents = standins.station_documents(spark, folder)
    documents.repartition(6, "document").select("value").write.text(landed)
    table, checkpoint = (scratch_path(spark, name) for name in ("station-status", "stream-checkpoint"))
    _follow(spark, landed, table, checkpoint, seconds=1)
    _follow(spark, landed, table, checkpoint, caught_up=True)
    return station_status.read_station_status(spark, table).select(
        "id", "station_name", "available_bikes", "available_docks"
    )


def _follow(spark, landed, table, checkpoint, **bound):
    jobs.follow_stations(
        spark, table, checkpoint, fmt="text",
        option=[f"path={landed}", "wholetext=false", "pathGlobFilter=part-*"],
        per_batch=2, order_by=["snapshot_time", "position"], **bound,
    )
