"""One row per key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """Row with the greatest ``order_by`` of each key.

    Rows that tie on ``order_by`` are told apart by their remaining columns, so the
    choice does not depend on how the data is partitioned.  Catalyst turns the
    row_number filter into a group limit that each task applies before the shuffle,
    so at most one row per key and task is sent even for a key with most rows.
    """
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order_by]
    rest = [F.desc_nulls_last(c) for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def has_duplicate_keys(df: DataFrame, keys: list[str]) -> bool:
    repeated = df.groupBy(*keys).count().filter(F.col("count") > 1)
    return not repeated.isEmpty()
