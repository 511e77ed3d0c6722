"""Comparison of a period with a neighbouring one.

The neighbour is found by a range frame on the period number: a frame that holds
exactly the periods ``step`` away, so a missing period gives no pair, which a plain
``lag`` would get wrong.  The input is computed once, where a self-join would
compute it for either side.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pair_periods(
    df: DataFrame, within: list[str], period: str, step: int, value: str, name: str
) -> DataFrame:
    """Each row with the ``value`` of every row ``step`` periods on, as ``name``.

    Rows pair within equal values of the ``within`` columns; rows without a partner,
    or with a null there, are left out.  ``df`` should be aggregated: the rows of
    one ``within`` group are sorted by one task.
    """
    frame = Window.partitionBy(*within).orderBy(period).rangeBetween(step, step)
    known = df.dropna(subset=[*within, period])
    partners = known.withColumn(name, F.collect_list(value).over(frame))
    return partners.withColumn(name, F.explode(name))


def month_over_month(
    counts: DataFrame,
    year: str = "start_year",
    month: str = "start_month",
    value: str = "count",
    denominator: str = "current",
) -> DataFrame:
    """Percentage change of each month against the month before, same year.

    The change is relative to the ``current`` month or to the ``previous`` one.
    """
    if denominator not in ("current", "previous"):
        raise ValueError(f"denominator must be 'current' or 'previous', not {denominator!r}")
    months = counts.select(
        F.col(month).alias("month"), F.col(year).alias("year"), F.col(value).alias("_current")
    )
    pairs = pair_periods(months, ["year"], "month", -1, "_current", "_previous")
    change = (F.col("_current") - F.col("_previous")).cast("double")
    base = F.nullif(F.col(f"_{denominator}").cast("double"), F.lit(0.0))
    return pairs.select("month", "year", (change / base * 100).alias("percentage_change"))


def lag_demand(
    demand: DataFrame,
    station: str = "start_station_id",
    date: str = "start_date",
    hour: str = "start_hour",
    value: str = "number_of_trips",
    step: int = 1,
) -> DataFrame:
    """Pair each station-hour with the count ``step`` hours later on the same day.

    The columns of the earlier hour are kept, with its count as ``past_trips``, and
    the later count is ``number_of_trips``.
    """
    earlier = demand.withColumnRenamed(value, "past_trips")
    return pair_periods(earlier, [station, date], hour, step, "past_trips", "number_of_trips")
