"""Spark session."""

from pyspark.sql import SparkSession


def build_session(name: str = "tripstats") -> SparkSession:
    """A session with the time zone results depend on; master, memory and the like
    come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    return builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
