"""Public event files."""

from pyspark.sql import DataFrame, SparkSession

from tripstats.fixed_values import EVENT_NAMES


def read_events(spark: SparkSession, path: str | list[str], infer: bool = False) -> DataFrame:
    """Events from comma-separated files with a header.

    Columns go by the names in the header, known ones get their canonical name, and
    all are text.  ``infer`` lets Spark guess their types instead, at the price of
    one more pass over the files.
    """
    raw = spark.read.csv(path, header=True, inferSchema=infer)
    return raw.withColumnsRenamed(EVENT_NAMES)
