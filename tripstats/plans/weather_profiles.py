"""Trips by weather measure."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.operators.columns import zero_fill


def by_measures(trips: DataFrame, measures: list[str], missing: str = "zero") -> DataFrame:
    """Number and mean duration of trips for each value of the measures.

    A missing number counts as 0.  With ``missing="drop"`` a trip without one of the measures
    is left out, and an unknown duration does not count in the mean.
    """
    if missing not in ("zero", "drop"):
        raise ValueError(f"missing must be 'zero' or 'drop', not {missing!r}")
    used = trips.select(*measures, "trip_duration")
    known = zero_fill(used) if missing == "zero" else used.dropna(subset=measures)
    return known.groupBy(*measures).agg(
        F.count(F.lit(1)).alias("number_of_trips"),
        F.avg("trip_duration").alias("average_duration"),
    )


def by_temperature(trips: DataFrame, missing: str = "zero") -> DataFrame:
    return by_measures(trips, ["temperature"], missing)


def by_precipitation_and_humidity(trips: DataFrame, missing: str = "zero") -> DataFrame:
    return by_measures(trips, ["precipitation", "humidity"], missing)


def by_wind_speed(trips: DataFrame, missing: str = "zero") -> DataFrame:
    return by_measures(trips, ["windspeed"], missing)
