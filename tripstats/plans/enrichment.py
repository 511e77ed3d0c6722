"""Trips with calendar parts, weather site and the weather of their hour."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.fixed_values import REFERENCE_YEAR, TRIP_KEY, WEATHER_MEASURES
from tripstats.functions.calendar import weekday_flag, weekend_flag
from tripstats.functions.parsing import parse_time
from tripstats.operators.columns import drop_incomplete
from tripstats.operators.keyed import latest_per_key
from tripstats.operators.lookup import BROADCAST_BYTES, lookup_join
from tripstats.operators.nearest import nearest_site

# The rows of one station or weather hour are told apart by the trip key.
_SALT_BY = list(TRIP_KEY)


def add_calendar(trips: DataFrame, reference_year: int = REFERENCE_YEAR) -> DataFrame:
    """Calendar parts of both ends of a trip, day flags, and the rider's age."""
    start, stop = F.col("start_time"), F.col("stop_time")
    return trips.withColumns(
        {
            "start_year": F.year(start),
            "start_month": F.month(start),
            "day_of_year": F.dayofyear(start),
            "start_hour": F.hour(start),
            "stop_month": F.month(stop),
            "stop_hour": F.hour(stop),
            "weekday": weekday_flag(start),
            "weekend": weekend_flag(start),
            "age": F.lit(reference_year) - F.col("birth_year"),
        }
    )


def clean_trips(trips: DataFrame, reference_year: int = REFERENCE_YEAR) -> DataFrame:
    """Complete trips with their derived columns."""
    return add_calendar(drop_incomplete(trips), reference_year)


def stations_with_site(stations: DataFrame, sites: DataFrame, ties: str = "all", **tuning):
    """Stations with ``weather_station_id``, the id of their nearest weather site."""
    return nearest_site(stations, sites, ties=ties, **tuning).drop("distance_km")


def attach_site(
    trips: DataFrame,
    stations: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int | None = None,
) -> DataFrame:
    """Trips with the weather site of their start station; others are left out."""
    sites = stations.select(F.col("id").alias("start_station_id"), "weather_station_id")
    return lookup_join(trips, sites, ["start_station_id"], _SALT_BY, broadcast_bytes, salts)


def attach_weather(
    trips: DataFrame,
    weather: DataFrame,
    time_col: str = "time",
    measures: tuple[str, ...] = WEATHER_MEASURES,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int | None = None,
) -> DataFrame:
    """Trips with the weather of their site and start hour; others are left out.

    ``time_col`` names the observation time to use: "time", or "time_local" where
    the trips are in local time and the other is not.  Of several observations of a
    site in one hour the latest counts, so no trip is multiplied.
    """
    at = parse_time(F.col(time_col))
    hours = weather.select(
        F.col("id").alias("weather_station_id"),
        F.year(at).alias("start_year"),
        F.dayofyear(at).alias("day_of_year"),
        F.hour(at).alias("start_hour"),
        *measures,
        at.alias("_at"),
    ).dropna(subset=["weather_station_id", "start_year"])
    on = ["weather_station_id", "start_year", "day_of_year", "start_hour"]
    latest = latest_per_key(hours, on, ["_at"]).drop("_at")
    return lookup_join(trips, latest, on, _SALT_BY, broadcast_bytes, salts)


def enrich_trips(
    trips: DataFrame, stations: DataFrame, weather: DataFrame, time_col: str = "time", **tuning
) -> DataFrame:
    """Cleaned trips, with calendar columns, joined to site and weather."""
    located = attach_site(drop_incomplete(trips), stations, **tuning)
    return attach_weather(located, weather, time_col, **tuning).drop("weather_station_id")
