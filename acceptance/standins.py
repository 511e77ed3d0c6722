"""Trips, stations, weather and events, projected from the test tables.

Each function has a SQL twin of the same name in ``oracles``.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _station(number: Column) -> Column:
    return F.concat(F.lit("Station "), number.cast("string"))


def latitude(number: Column) -> Column:
    return F.lit(40.5) + (number * 37 % 100) / F.lit(250.0)


def longitude(number: Column) -> Column:
    return F.lit(-74.2) + (number * 53 % 100) / F.lit(250.0)


def fine_latitude(number: Column) -> Column:
    return F.lit(40.5) + (number * 7919 % 10007) / F.lit(25000.0)


def fine_longitude(number: Column) -> Column:
    return F.lit(-74.2) + (number * 6151 % 10009) / F.lit(25000.0)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """A trip per order line; rider and end station come from the order."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    start, end = F.col("l_suppkey"), F.col("o_custkey") % 50
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.floor("l_extendedprice").cast("int").alias("trip_duration"),
        F.col("o_orderdate").alias("start_time"),
        F.col("l_shipdate").alias("stop_time"),
        *_ends("start", start),
        *_ends("end", end),
        F.col("l_partkey").alias("bike_id"),
        F.col("o_orderpriority").alias("user_type"),
        (1930 + end).cast("int").alias("birth_year"),
        (F.col("l_linenumber") % 3).alias("gender"),
    )


def _ends(end: str, number: Column) -> list[Column]:
    return [
        number.alias(f"{end}_station_id"),
        _station(number).alias(f"{end}_station_name"),
        latitude(number).alias(f"{end}_station_latitude"),
        longitude(number).alias(f"{end}_station_longitude"),
    ]


def line_trips(spark: SparkSession, folder: str) -> DataFrame:
    """A trip per order line, of its own columns only, with weather."""
    number = F.col("l_suppkey")
    return table(spark, folder, "lineitem").select(
        F.floor("l_extendedprice").cast("int").alias("trip_duration"),
        F.col("l_shipdate").alias("start_time"),
        *_ends("start", number),
        *_ends("end", number),
        F.col("l_partkey").alias("bike_id"),
        F.nullif("l_quantity", F.lit(1.0)).alias("temperature"),
        F.nullif("l_discount", F.lit(0.03)).alias("precipitation"),
        F.nullif("l_linenumber", F.lit(2)).alias("humidity"),
        F.nullif("l_tax", F.lit(0.05)).alias("windspeed"),
    )


def clock_trips(spark: SparkSession, folder: str) -> DataFrame:
    """A trip per logged event, with true times of day."""
    rider = F.col("user_id")
    return table(spark, folder, "events").select(
        F.floor("value").cast("int").alias("trip_duration"),
        F.col("ts").alias("start_time"),
        F.col("ts").alias("stop_time"),
        *_ends("start", rider),
        *_ends("end", rider % 7),
        F.col("event_id").alias("bike_id"),
        F.col("event_type").alias("user_type"),
        (1950 + rider % 50).cast("int").alias("birth_year"),
        (F.col("event_id") % 3).cast("int").alias("gender"),
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        number.alias("id"),
        latitude(number).alias("latitude"),
        longitude(number).alias("longitude"),
    )


def rider_stations(spark: SparkSession, folder: str) -> DataFrame:
    """Stations with the numbers that ``clock_trips`` start from, and more."""
    number = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        number.alias("id"),
        fine_latitude(number).alias("latitude"),
        fine_longitude(number).alias("longitude"),
    )


def sites(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("n_nationkey")
    return table(spark, folder, "nation").select(
        number.cast("string").alias("id"),
        (F.lit(40.5) + (number * 11 % 25) / F.lit(60.0)).alias("latitude"),
        (F.lit(-74.2) + (number * 7 % 25) / F.lit(60.0)).alias("longitude"),
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly observations of the sites; hours without a logged event are missing."""
    hour = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss")
    return (
        table(spark, folder, "events")
        .groupBy((F.col("user_id") % 25).cast("string").alias("id"), hour.alias("time"))
        .agg(
            F.max("value").alias("temperature"),
            F.min("value").alias("precipitation"),
            F.count(F.lit(1)).cast("int").alias("humidity"),
            F.max("event_id").cast("double").alias("dewpoint"),
            F.min("event_id").cast("double").alias("windspeed"),
        )
    )


def city_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as the public file has them, many listed more than once."""
    day = F.date_format("ts", "yyyy-MM-dd")
    place = F.concat(F.lit("Place "), F.col("user_id").cast("string"))
    return table(spark, folder, "events").select(
        (F.col("event_id") % 500).cast("string").alias("event_id"),
        F.col("event_type").alias("event_name"),
        day.alias("start_date_time"),
        day.alias("end_date_time"),
        F.lit("Parks").alias("event_agency"),
        F.col("event_type"),
        F.lit("Bronx").alias("event_borough"),
        place.alias("event_location"),
    )


def geocodes(spark: SparkSession, folder: str) -> DataFrame:
    """Answers of a geocoder; it does not know every tenth place."""
    number = F.col("c_custkey")
    found = F.concat_ws(",", fine_latitude(number), fine_longitude(number))
    return table(spark, folder, "customer").select(
        F.concat(F.lit("Place "), number.cast("string")).alias("event_location"),
        F.when(number % 10 == 0, "").otherwise(found).alias("geocode"),
    )


def customer_places(spark: SparkSession, folder: str) -> DataFrame:
    """Located events at places as fine as there are customers."""
    number = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        number.alias("event_id"),
        F.col("c_mktsegment").alias("event_name"),
        fine_latitude(number).alias("latitude"),
        fine_longitude(number).alias("longitude"),
    )


def station_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot documents of up to a hundred station records each, as JSON text.

    The stamp of a document is the time of its last logged event.
    """
    events = table(spark, folder, "events")
    record = F.struct(
        F.col("event_id").alias("_order"),
        F.col("user_id").cast("int").alias("id"),
        _station(F.col("user_id")).alias("stationName"),
        (F.col("event_id") % 40).cast("int").alias("availableBikes"),
        (F.col("event_id") % 30).cast("int").alias("availableDocks"),
        latitude(F.col("user_id")).cast("float").alias("latitude"),
        longitude(F.col("user_id")).cast("float").alias("longitude"),
    )
    documents = events.groupBy(F.expr("event_id div 100").alias("document")).agg(
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("executionTime"),
        F.sort_array(F.collect_list(record)).alias("stationBeanList"),
    )
    text = F.to_json(F.struct("executionTime", "stationBeanList"))
    return documents.select("document", text.alias("value"))
