"""Top-k with a total order."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.fixed_values import TOP_K


def top_k(df: DataFrame, by: str, tie_break: list[str], k: int = TOP_K) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ties go by ``tie_break`` ascending.

    Spark plans this as TakeOrderedAndProject: each task keeps k rows.
    """
    return df.orderBy(F.desc(by), *(F.asc_nulls_last(c) for c in tie_break)).limit(k)
