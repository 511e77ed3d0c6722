"""Column-wise and row-wise cleaning."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Put ``prefix`` before every column name, to keep sides of a join apart."""
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Keep rows without a null (in ``subset``, or in any column)."""
    return df.dropna(how="any", subset=subset)


def zero_fill(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Nulls of numeric columns become 0; text stays null."""
    return df.fillna(0, subset=subset)
