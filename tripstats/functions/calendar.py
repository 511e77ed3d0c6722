"""Calendar parts and labels of timestamps.  Null in, null out."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripstats.fixed_values import OTHER_SEASON, SEASONS


def weekday_flag(time: Column) -> Column:
    """1 from Monday to Friday, else 0 (Spark counts days from 1 = Sunday)."""
    return F.dayofweek(time).between(2, 6).cast("int")


def weekend_flag(time: Column) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return F.dayofweek(time).isin(1, 7).cast("int")


def season(month: Column) -> Column:
    """Name of the season a month number lies in."""
    label = F.when(month.isNull(), None)
    for name, (first, last) in SEASONS.items():
        label = label.when(month.between(first, last), name)
    return label.otherwise(OTHER_SEASON)


def hour_label(hour: Column) -> Column:
    """Hour 0-23 as a 12-hour clock label, ``12AM`` to ``11PM``."""
    on_clock = (hour + 11) % 12 + 1
    half = F.when(hour < 12, "AM").otherwise("PM")
    return F.concat(on_clock.cast("string"), half)
