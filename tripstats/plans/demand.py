"""Trips per station and hour, and their pairing with the hour after."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.fixed_values import FIRST_TRAINING_YEAR
from tripstats.functions.calendar import weekday_flag, weekend_flag
from tripstats.operators.columns import drop_incomplete
from tripstats.operators.periods import lag_demand

STATION_HOUR = ("start_station_id", "start_station_name", "start_date", "start_hour")
WEATHER_KEYS = ("temperature", "humidity", "windspeed")


def hourly_demand(trips: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Trips per start station (id and name), date and hour.

    Month and day flags follow from the date, so they are added to the counted rows
    instead of travelling through the shuffle.  ``extra_keys`` count separately, as
    the weather measures of a trip do.
    """
    start = F.col("start_time")
    counted = (
        trips.withColumns({"start_date": F.to_date(start), "start_hour": F.hour(start)})
        .groupBy(*STATION_HOUR, *extra_keys)
        .agg(F.count(F.lit(1)).alias("number_of_trips"))
    )
    date = F.col("start_date")
    return counted.select(
        *STATION_HOUR,
        F.month(date).alias("start_month"),
        weekday_flag(date).alias("weekday"),
        weekend_flag(date).alias("weekend"),
        *extra_keys,
        "number_of_trips",
    )


def training_rows(
    trips: DataFrame,
    with_weather: bool = False,
    min_year: int = FIRST_TRAINING_YEAR,
    complete: list[str] | None = None,
) -> DataFrame:
    """Features of a station-hour and, as label, the trips of the hour after it.

    ``trips`` has ``start_year``, by which it may be partitioned.  With weather,
    trips with a null are left out: in any column, or in those of ``complete``.
    """
    recent = trips.filter(F.col("start_year") >= min_year)
    if with_weather:
        demand = hourly_demand(drop_incomplete(recent, complete), WEATHER_KEYS)
    else:
        demand = hourly_demand(recent)
    return lag_demand(demand.drop("start_station_name"))
