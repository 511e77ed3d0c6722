"""Repeatable split of rows into two parts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.fixed_values import TRAINING_FRACTION

_HEX_DIGITS = 4


def in_first_part(keys: list[str], fraction: float = TRAINING_FRACTION) -> Column:
    """Whether a row belongs to the first part, decided by a digest of its key."""
    text = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    head = F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("int")
    return head < int(fraction * 16**_HEX_DIGITS)


def split_by_key(
    df: DataFrame, keys: list[str], fraction: float = TRAINING_FRACTION
) -> tuple[DataFrame, DataFrame]:
    """Two parts, about ``fraction`` and the rest.  Neither the partitioning nor
    the run changes the side a key falls on."""
    first = in_first_part(keys, fraction)
    return df.filter(first), df.filter(~first)
