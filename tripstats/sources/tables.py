"""Stored tables."""

from pyspark.sql import DataFrame, SparkSession

from tripstats.sinks.keyed import stored_rows


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A stored table; one written by ``write_keyed`` with the types it was written with.

    Any format with a reader on the class path will do, for instance that of a
    database connector, with its own options.
    """
    if fmt != "parquet":
        reader = spark.read.format(fmt).options(**options)
        return reader.load(path) if path else reader.load()
    rows = stored_rows(spark, path, **options)
    return rows if rows is not None else spark.read.options(**options).parquet(path)
