"""Records that cannot be read, counted while the others are."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# Holds the text of a record that does not fit the schema, else null.
BAD = "_bad_record"


def schema_with_bad(schema: str, counted: Observation | None) -> str:
    """The schema, with room for bad records if they are to be counted."""
    return schema if counted is None else f"{schema.strip().rstrip(',')}, {BAD} STRING"


def observed(raw: DataFrame, counted: Observation | None) -> DataFrame:
    """``raw`` as it is, its records counted on the way as ``read`` and ``bad``.

    The counts are there when the first action on the rows has ended, and cost no pass of their own.
    """
    if counted is None:
        return raw
    bad = F.count_if(F.col(BAD).isNotNull()).alias("bad")
    return raw.observe(counted, F.count(F.lit(1)).alias("read"), bad).drop(BAD)
