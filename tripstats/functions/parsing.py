"""Text to typed values.  What cannot be read becomes null, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripstats.fixed_values import (
    SNAPSHOT_TIME_FORMATS,
    STATION_STATUS_SCHEMA,
    WEATHER_TIME_FORMATS,
)


def parse_time(text: Column, formats=WEATHER_TIME_FORMATS) -> Column:
    """Timestamp by the first of several patterns that fits."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats))


def parse_snapshot_time(text: Column) -> Column:
    """Time of a station document, in one of its formats or as Spark writes times."""
    return F.coalesce(parse_time(text, SNAPSHOT_TIME_FORMATS), F.try_to_timestamp(text))


def split_coordinates(text: Column) -> tuple[Column, Column]:
    """Latitude and longitude from text like ``40.7,-73.9``."""
    parts = F.split(text, ",")
    return tuple(F.trim(F.get(parts, F.lit(i))).try_cast("double") for i in (0, 1))


def parse_station_document(text: Column) -> Column:
    """Struct of a station status document; null for malformed JSON."""
    return F.from_json(text, STATION_STATUS_SCHEMA)
