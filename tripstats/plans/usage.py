"""Reports on who rides when and from where to where.

Each takes trips with canonical column names.  Counts and means are combined
inside every task before the shuffle, so a station or month with most of the trips
sends no more rows than any other.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.fixed_values import (
    GENDER_FEMALE,
    GENDER_MALE,
    GENDER_UNKNOWN,
    TOP_K,
    USER_TYPES,
)
from tripstats.functions.calendar import hour_label, season
from tripstats.operators.keyed import latest_per_key
from tripstats.operators.topk import top_k


def _trips(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _mean_duration(name: str) -> Column:
    return F.avg("trip_duration").alias(name)


def total_trips(trips: DataFrame, year: int | None = None) -> DataFrame:
    """Number of trips, of one year if given."""
    if year is not None:
        trips = trips.filter(F.col("start_year") == year)
    return trips.agg(_trips("total_bikes"))


def distinct_bikes(trips: DataFrame) -> DataFrame:
    return trips.agg(F.countDistinct("bike_id").alias("number_of_bikes"))


def _top_stations(trips: DataFrame, end: str, k: int, by_name: bool) -> DataFrame:
    counted = trips.groupBy(*_place(end)).agg(_trips("number_of_trips"))
    return busiest_stations(counted, end, k, by_name)


def _place(end: str) -> list[str]:
    return [f"{end}_station_name", f"{end}_station_latitude", f"{end}_station_longitude"]


def busiest_stations(counted: DataFrame, end: str, k: int = TOP_K, by_name: bool = False) -> DataFrame:
    """The top of places with their ``number_of_trips``."""
    place = _place(end)
    if by_name:
        counted = latest_per_key(counted, place[:1], ["number_of_trips"])
    return top_k(counted, "number_of_trips", place, k)


def top_start_stations(trips: DataFrame, k: int = TOP_K, by_name: bool = False) -> DataFrame:
    """Stations where most trips start.  A station that moved counts at each of its places,
    with ``by_name`` only the busiest place of a name does."""
    return _top_stations(trips, "start", k, by_name)


def top_end_stations(trips: DataFrame, k: int = TOP_K, by_name: bool = False) -> DataFrame:
    """Stations where most trips end; ``by_name`` as for the start."""
    return _top_stations(trips, "end", k, by_name)


def user_type_summary(trips: DataFrame, user_types: tuple[str, ...] = USER_TYPES) -> DataFrame:
    """Trips and mean duration of the given user types."""
    chosen = trips.filter(F.col("user_type").isin(*user_types))
    return chosen.groupBy("user_type").agg(
        _trips("number_of_trips"), _mean_duration("average_duration")
    )


def top_routes(trips: DataFrame, k: int = TOP_K, by_name: bool = False) -> DataFrame:
    """Most ridden pairs of start and end station, by user type.  Two pairs can share a route
    text; with ``by_name`` only the one ridden more counts."""
    ends = ["start_station_name", "end_station_name"]
    counted = trips.groupBy("user_type", *ends).agg(
        _trips("number_of_trips"), _mean_duration("average_duration")
    )
    return busiest_routes(counted, k, by_name)


def busiest_routes(counted: DataFrame, k: int = TOP_K, by_name: bool = False) -> DataFrame:
    """The top of station pairs by user type, with ``number_of_trips`` and ``average_duration``."""
    ends = ["start_station_name", "end_station_name"]
    route = F.concat("start_station_name", F.lit(" to "), "end_station_name")
    counted = counted.withColumn("route", route)
    if by_name:
        counted = latest_per_key(counted, ["user_type", "route"], ["number_of_trips"])
    best = top_k(counted, "number_of_trips", [*ends, "user_type"], k)
    return best.select("user_type", "route", "number_of_trips", "average_duration")


def trips_by_age(trips: DataFrame) -> DataFrame:
    """Trips per age, in all and by gender."""

    def of_gender(code):
        return F.count_if(F.col("gender") == code)

    return trips.groupBy("age").agg(
        _trips("total_count"),
        of_gender(GENDER_MALE).alias("males"),
        of_gender(GENDER_FEMALE).alias("females"),
        of_gender(GENDER_UNKNOWN).alias("unknown"),
    )


def duration_by_age(trips: DataFrame) -> DataFrame:
    return trips.groupBy("age").agg(_mean_duration("avg_trip_duration"))


def monthly_trips(trips: DataFrame) -> DataFrame:
    return trips.groupBy("start_year", "start_month").count()


def season_hour_trips(trips: DataFrame) -> DataFrame:
    """Trips per year, month and hour, with the season and a 12-hour clock label in
    place of the hour."""
    return with_season(trips.groupBy("start_year", "start_month", "start_hour").count())


def with_season(counted: DataFrame) -> DataFrame:
    """Counts by year, month and hour as ``season_hour_trips`` shows them."""
    return counted.select(
        "start_year",
        "start_month",
        hour_label(F.col("start_hour")).alias("start_hour"),
        "count",
        season(F.col("start_month")).alias("season"),
    )
