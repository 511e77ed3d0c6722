"""Weather service responses, landed as JSON files."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripstats.fixed_values import (
    NEARBY_SITES_SCHEMA,
    WEATHER_HOURS_SCHEMA,
    WEATHER_SITE_SCHEMA,
)
from tripstats.sources.checked import BAD, observed, schema_with_bad


def _documents(spark, path, schema: str, counted: Observation | None) -> DataFrame:
    reader = spark.read.schema(schema_with_bad(schema, counted))
    return observed(reader.json(path, columnNameOfCorruptRecord=BAD), counted)


def read_nearby_sites(
    spark: SparkSession, path: str | list[str], counted: Observation | None = None
) -> DataFrame:
    """Site list of nearby-search responses, one row per site.  Here and below ``counted`` gets
    the number of documents ``read`` and of those that are malformed (``bad``)."""
    responses = _documents(spark, path, NEARBY_SITES_SCHEMA, counted)
    return responses.select(F.explode("output.data").alias("site")).select("site.*")


def read_weather_sites(
    spark: SparkSession,
    path: str | list[str],
    nearby: DataFrame | None = None,
    counted: Observation | None = None,
) -> DataFrame:
    """Site records, one response each; ``nearby`` keeps only the sites it lists."""
    responses = _documents(spark, path, WEATHER_SITE_SCHEMA, counted)
    sites = responses.select("data.*").filter("id is not null")
    if nearby is not None:
        sites = sites.join(nearby.select("id").distinct(), "id", "left_semi")
    return sites.select(
        "id",
        "name",
        "region",
        "wmo",
        "icao",
        "iata",
        F.col("latitude").try_cast("float").alias("latitude"),
        F.col("longitude").try_cast("float").alias("longitude"),
        "elevation",
        "time_zone",
    )


def read_weather_hours(
    spark: SparkSession, path: str | list[str], counted: Observation | None = None
) -> DataFrame:
    """Hourly observations: one document per site with an array of hours, one row
    per site and hour."""
    documents = _documents(spark, path, WEATHER_HOURS_SCHEMA, counted)
    hours = documents.select("id", "name", "latitude", "longitude", F.explode("data").alias("hour"))
    return hours.select("id", "name", "latitude", "longitude", "hour.*")
