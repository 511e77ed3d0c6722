"""Queries through the jobs and the stored tables, and checks of the models by SQL."""

import functools

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from acceptance import standins
from acceptance.queries import _clock_trips, _predictions_of, _weather_trips, query, rounded
from tripstats import jobs, sinks, sources
from tripstats.fixed_values import (
    EVENT_NAMES,
    PREDICTION_KEY,
    TRAINING_FRACTION,
    TRIP_KEY,
    TRIP_NAMES,
)
from tripstats.operators import nearest, split
from tripstats.plans import bikes, demand, enrichment, forecasting, tree_nodes
from tripstats.workspace import scratch_path


@query
def nearest_site_repeated(spark, folder):
    """Points with repeated and missing ids, by both ways of the search."""
    stations = standins.rider_stations(spark, folder)
    number = F.when(F.col("id") % 5 != 0, F.col("id") % 7)
    points = stations.withColumn("id", number)
    sites = standins.sites(spark, folder)
    ways = [
        nearest.nearest_site(points, sites, few_sites=n).withColumn("way", F.lit(way))
        for way, n in (("few", 64), ("many", 1))
    ]
    found = ways[0].unionByName(ways[1])
    return rounded(found.select("id", "way", "weather_station_id", "distance_km"), distance_km=6)


@query
def text_partitions(spark, folder):
    """Orders partitioned by a text with leading zeros, half of them stored again."""
    orders = standins.table(spark, folder, "orders").select(
        "o_orderkey", F.lpad((F.col("o_orderkey") % 12).cast("string"), 2, "0").alias("part"), "o_totalprice"
    )
    path = scratch_path(spark, "text-partitions")
    stale = orders.withColumn("o_totalprice", F.lit(-1.0))
    sinks.write_keyed(stale, path, ["o_orderkey"], partition_by=["part"])
    even = orders.where("o_orderkey % 2 = 0")
    sinks.write_keyed(even, path, ["o_orderkey"], None, "upsert", ["part"])
    return sources.read_table(spark, path).select("o_orderkey", "part", "o_totalprice")


def _enriched(spark, folder) -> str:
    """Path of the table of the enrich job.  Each hour of weather is observed twice, and the
    earlier observation is wrong."""
    paths = {name: scratch_path(spark, name) for name in ("trips", "stations", "weather", "enriched")}
    trips = enrichment.clean_trips(standins.clock_trips(spark, folder))
    sinks.write_keyed(trips, paths["trips"], TRIP_KEY, ["stop_time"], partition_by=jobs.TRIP_PARTITIONS)
    site = (F.col("id") % 25).cast("string").alias("weather_station_id")
    stations = standins.rider_stations(spark, folder).select("id", site)
    sinks.write_keyed(stations, paths["stations"], ["id"])
    weather = standins.weather(spark, folder)
    early = weather.withColumns({"temperature": F.lit(-99.0), "humidity": F.lit(-1)})
    late = weather.withColumn("time", F.regexp_replace("time", ":00:00$", ":40:00"))
    sinks.write_keyed(early.unionByName(late), paths["weather"], ["id", "time"])
    jobs.enrich(spark, paths["trips"], paths["stations"], paths["weather"], paths["enriched"])
    return paths["enriched"]


@query
def enriched_table(spark, folder):
    stored = sources.read_table(spark, _enriched(spark, folder))
    return stored.select("bike_id", "start_station_id", "temperature", "humidity", "windspeed")


@query
def report_tables(spark, folder):
    """Tables of the report job as (table, group, trips)."""
    out = scratch_path(spark, "reports")
    jobs.reports(spark, _enriched(spark, folder), out)

    def rows(table, key, value="number_of_trips"):
        stored = sources.read_table(spark, f"{out}/{table}")
        return stored.select(
            F.lit(table).alias("table"), key.cast("string").alias("key"), F.col(value).cast("long").alias("trips")
        )

    tables = [
        rows("total_trips", F.lit("all"), "total_bikes"),
        rows("start_trip_top_20", F.col("start_station_name")),
        rows("grouped_count", F.concat_ws("-", "start_year", "start_month"), "count"),
        rows("phmd", F.col("humidity")),
    ]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out.groupBy("table", "key").agg(F.sum("trips").alias("trips"))


@query
def event_table_loaded(spark, folder):
    """Located events written as files and loaded as a typed table."""
    located = standins.city_events(spark, folder).join(
        standins.rider_stations(spark, folder).withColumn(
            "event_location", F.concat(F.lit("Place "), F.col("id").cast("string"))
        ),
        "event_location",
    )
    files, out = scratch_path(spark, "located"), scratch_path(spark, "event-table")
    columns = [F.col(name).alias(header) for header, name in EVENT_NAMES.items()]
    sinks.write_csv(located.select(*columns, "latitude", "longitude"), files)
    jobs.load_events(spark, files, out)
    stored = sources.read_table(spark, out)
    kept = stored.select("event_id", "start_date_time", "event_location", "latitude", "longitude")
    return rounded(kept, latitude=6, longitude=6)


@query
def stations_table(spark, folder):
    """Several snapshots of each station; the latest counts, with its nearest site."""
    landed, sites, out = (scratch_path(spark, name) for name in ("landed", "sites", "stations"))
    documents = standins.station_documents(spark, folder)
    documents.repartition("document").select("value").write.text(landed)
    sinks.write_keyed(standins.sites(spark, folder), sites, ["id"])
    jobs.stations(spark, landed, sites, out, lines=True)
    return sources.read_table(spark, out).select("id", "station_name", "available_bikes")


@query
def first_training_year(spark, folder):
    """Demand of order lines from the bound year on; earlier lines are left out."""
    trips = standins.line_trips(spark, folder)
    trips = trips.withColumn("start_year", F.year("start_time"))
    times = trips.withColumn("start_time", F.expr("start_time + make_interval(0, 0, 0, 0, bike_id % 24)"))
    return demand.training_rows(times, min_year=1998)


@query
def metric_values(spark, folder):
    """Metrics of the guess that an hour is like the one before."""
    rows = demand.training_rows(_clock_trips(spark, folder))
    guess = rows.withColumn("prediction", F.col("past_trips").cast("double"))
    return rounded(forecasting.evaluate({"as_before": guess}), value=6)


@query
def feature_vector(spark, folder):
    """Features of both variants as their assemblers order them."""
    plain = demand.training_rows(_clock_trips(spark, folder))
    weather = demand.training_rows(_weather_trips(spark, folder), with_weather=True)
    keys = ["start_station_id", "start_date", "start_hour"]

    def features(rows, columns, variant):
        vectors = forecasting.assembler(columns).transform(rows)
        numbers = F.transform(vector_to_array("features"), lambda x: F.round(x, 6).cast("string"))
        return vectors.select(F.lit(variant).alias("variant"), *keys, F.concat_ws("|", numbers).alias("features"))

    names = list(forecasting.FEATURES)
    return features(plain, names, "plain").unionByName(
        features(weather, [*names, *demand.WEATHER_KEYS], "weather")
    )


@query
def weekday_tree(spark, folder):
    """A tree that knows the day flag alone predicts the mean of either side."""
    rows = demand.training_rows(_clock_trips(spark, folder))
    tree = DecisionTreeRegressor(featuresCol="features", labelCol=forecasting.LABEL)
    model = Pipeline(stages=[forecasting.assembler(["weekday"]), tree]).fit(rows)
    scored = forecasting.predict(model, rows).select("weekday", "prediction").distinct()
    return rounded(scored, prediction=6)


@query
def weather_scored_rows(spark, folder):
    """As scored_rows, of the models that know the weather."""
    rows = demand.training_rows(_weather_trips(spark, folder), with_weather=True)
    return _predictions_of(forecasting.forecast_demand(rows, with_weather=True)).drop("prediction")


@query
def report_tables_in_full(spark, folder):
    """Every table of the report job as (table, key, measure, value)."""
    out = scratch_path(spark, "reports")
    jobs.reports(spark, _enriched(spark, folder), out)

    def rows(table, key):
        stored = sources.read_table(spark, f"{out}/{table}")
        measures = [c for c, kind in stored.dtypes if c not in key and kind in ("bigint", "double")]
        named = [F.struct(F.lit(c).alias("measure"), F.round(F.col(c).cast("double"), 6).alias("value")) for c in measures]
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in key]
        return stored.select(
            F.lit(table).alias("table"), F.concat_ws("|", *texts).alias("key"), F.explode(F.array(*named)).alias("m")
        ).select("table", "key", "m.*")

    keys = {
        "total_trips": [],
        "distinct_bikes": [],
        "start_trip_top_20": ["start_station_name"],
        "end_trip_top_20": ["end_station_name"],
        "average_trip_user_type": ["user_type"],
        "start_to_end_top_20": ["user_type", "route"],
        "trips_age": ["age"],
        "trip_duration_age": ["age"],
        "grouped_count": ["start_year", "start_month"],
        "percentage_change": ["year", "month"],
        "grouped_count_season": ["start_year", "start_month", "start_hour", "season"],
        "avg_temp": [],
        "phmd": [],
        "windspeed": [],
    }
    found = functools.reduce(DataFrame.unionByName, (rows(table, key) for table, key in keys.items()))
    # Places and weather values of two engines may differ in the last digit.
    return found.where(~F.col("measure").rlike("latitude|longitude"))


@query
def bikes_after_upsert(spark, folder):
    """Distinct bikes by month and in all, where trips of some months came later and only these
    months were counted anew."""
    trips = standins.line_trips(spark, folder).select(
        # Ids below zero, and in several buckets.
        (F.col("bike_id") * 997 - 50_000).alias("bike_id"),
        F.year("start_time").alias("start_year"),
        F.month("start_time").alias("start_month"),
    )
    out = scratch_path(spark, "bikes")
    late = F.col("start_year") >= 1996
    first = trips.where(~late | (F.col("bike_id") % 2 == 0))
    sinks.write_keyed(bikes.monthly_bikes(first), out, bikes.BIKES_KEY, partition_by=list(bikes.MONTH), unique=True)
    months = [tuple(row) for row in trips.where(late).select(*bikes.MONTH).distinct().collect()]
    again = bikes.monthly_bikes(bikes.of_months(trips, months))
    sinks.write_keyed(again, out, bikes.BIKES_KEY, None, "replace", list(bikes.MONTH), True)
    monthly = sources.read_table(spark, out)
    by_month = bikes.count_bikes(monthly, *bikes.MONTH)
    return by_month.unionByName(bikes.count_bikes(monthly), allowMissingColumns=True)


@query
def bad_records(spark, folder):
    """Lines and documents that cannot be read, as the readers count them on the way."""
    lines = standins.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("bike_id"), F.col("l_suppkey").alias("n")
    ).join(standins.table(spark, folder, "part").select(F.col("p_partkey").alias("bike_id"), "p_size"), "bike_id")
    columns = {theirs: F.col("n") for theirs in TRIP_NAMES}
    columns["tripduration"] = F.when(F.col("p_size") == 7, "x").otherwise("60")
    columns["starttime"] = columns["stoptime"] = F.lit("2019-06-01 08:15:00")
    trips, documents = scratch_path(spark, "trip-lines"), scratch_path(spark, "station-documents")
    sinks.write_csv(lines.select(*(c.cast("string").alias(name) for name, c in columns.items())), trips)
    cut = F.when(F.col("document") % 5 == 0, F.expr("left(value, length(value) - 10)")).otherwise(F.col("value"))
    standins.station_documents(spark, folder).select(cut.alias("value")).write.text(documents)
    counts = {what: Observation() for what in ("trip lines", "station documents")}
    read = [
        sources.read_trips(spark, trips, check_header=True, counted=counts["trip lines"]),
        sources.read_station_snapshot(spark, documents, True, counted=counts["station documents"]),
    ]
    for rows in read:
        rows.write.format("noop").mode("overwrite").save()
    found = [(what, counted.get["read"], counted.get["bad"]) for what, counted in counts.items()]
    return spark.createDataFrame(found, "what string, read long, bad long")


def _by_nodes(spark, rows, with_weather):
    """For each model the validation rows, and how many of them the node tables predict otherwise."""
    found = forecasting.forecast_demand(rows, with_weather)
    # The forecast's own split of the rows, with all features.
    _, validation = split.split_by_key(rows, list(PREDICTION_KEY), TRAINING_FRACTION)
    features = [*forecasting.FEATURES, *(demand.WEATHER_KEYS if with_weather else [])]
    key = list(PREDICTION_KEY)
    compared = []
    for name, fitted in found.models.items():
        model = fitted.stages[-1]
        nodes = tree_nodes.node_table(spark, model)
        ours = tree_nodes.predict_by_nodes(validation, nodes, features, key, *tree_nodes.size(model))
        both = found.predictions[name].select(*key, F.col("prediction").alias("theirs")).join(ours, key, "full")
        same = F.abs(F.col("theirs") - F.col("prediction")) < 1e-9
        differ = F.count_if(~F.coalesce(same, F.lit(False))).alias("different")
        compared.append(both.agg(F.count(F.lit(1)).alias("rows"), differ).withColumn("model", F.lit(name)))
    return functools.reduce(DataFrame.unionByName, compared)


@query
def trees_by_nodes(spark, folder):
    """Predictions of all three models, made once more by joins with tables of their nodes."""
    return _by_nodes(spark, demand.training_rows(_clock_trips(spark, folder)), False)


@query
def weather_trees_by_nodes(spark, folder):
    """As trees_by_nodes, of the models that know the weather."""
    return _by_nodes(spark, demand.training_rows(_weather_trips(spark, folder), with_weather=True), True)
