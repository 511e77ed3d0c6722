"""Distinct bikes by month, as bitmaps that can be put together.

A distinct count cannot be added up; a bitmap of the bikes can.  Ids fall into buckets of 32,768, and
a month holds one bitmap of 4 KB for each bucket in which it has bikes.  When trips of some months change, these
months are counted anew and the bitmaps of the others are used as they are.
"""

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONTH = ("start_year", "start_month")
BIKES_KEY = (*MONTH, "bucket")


def monthly_bikes(trips: DataFrame, bike: str = "bike_id") -> DataFrame:
    """start_year, start_month, bucket and the bitmap ``bikes``.  Trips without a bike or a month
    are left out."""
    known = trips.dropna(subset=[bike, *MONTH])
    number = F.col(bike).cast("long")
    bits = known.select(
        *MONTH,
        F.bitmap_bucket_number(number).alias("bucket"),
        F.bitmap_bit_position(number).alias("_bit"),
    )
    # The rows, not a 4 KB bitmap of each task for each month and bucket, are shuffled: a bitmap
    # is built once, in the task that gets all rows of its month and bucket.
    return (
        bits.repartition(*BIKES_KEY)
        .groupBy(*BIKES_KEY)
        .agg(F.bitmap_construct_agg("_bit").alias("bikes"))
    )


def count_bikes(monthly: DataFrame, *by: str) -> DataFrame:
    """Distinct bikes of all months, or for each of the columns ``by`` (of MONTH)."""
    united = monthly.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bikes").alias("bikes"))
    counted = F.coalesce(F.sum(F.bitmap_count("bikes")), F.lit(0)).alias("number_of_bikes")
    return united.groupBy(*by).agg(counted)


def of_months(trips: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """The trips of some months; literals let the scan skip the folders of the others."""
    chosen = [(F.col(MONTH[0]) == year) & (F.col(MONTH[1]) == month) for year, month in months]
    return trips.filter(functools.reduce(operator.or_, chosen, F.lit(False)))
