"""Station snapshot documents, landed as files or arriving on a stream."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripstats.fixed_values import STATION_NAMES, STATION_SNAPSHOT_SCHEMA
from tripstats.functions.parsing import parse_snapshot_time
from tripstats.sources.checked import BAD, observed, schema_with_bad


def read_station_snapshot(
    spark: SparkSession,
    path: str | list[str],
    lines: bool = False,
    time_col: str | None = None,
    counted: Observation | None = None,
) -> DataFrame:
    """One row per station record of landed snapshot documents.

    A file holds one document, or with ``lines`` one document per line, which lets
    Spark split large files.  ``time_col`` names a further column for the time of the
    document; null where it has none.  ``counted`` gets the number of documents ``read`` and of
    those that are malformed (``bad``).
    """
    reader = spark.read.schema(schema_with_bad(STATION_SNAPSHOT_SCHEMA, counted))
    documents = observed(
        reader.json(path, multiLine=not lines, columnNameOfCorruptRecord=BAD), counted
    )
    time = parse_snapshot_time(F.col("executionTime")).alias(time_col or "_time")
    records = documents.select(F.explode("stationBeanList").alias("station"), time)
    columns = ["station.*", time_col] if time_col else ["station.*"]
    return records.select(*columns).withColumnsRenamed(STATION_NAMES)


def read_snapshot_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict | None = None,
    per_batch: int | None = None,
    least_tasks: int | None = None,
) -> DataFrame:
    """Stream of snapshot documents: ``value`` text, ``arrived_at`` and ``sequence``,
    which order the documents.

    ``fmt`` is "kafka" (needs the connector on the class path) or "text", which
    takes the files of the folder in option "path"; whole, or with option "wholetext"
    set to "false" line by line.

    ``per_batch`` is the most that a micro-batch takes in, files or messages: a stream that has fallen
    behind, or starts with a full topic, catches up in batches of that size instead of
    one that holds everything.  ``least_tasks`` spreads the messages of a batch over more tasks than
    the topic has partitions; files are spread as they are.
    """
    options = {**(options or {}), **_admission(fmt, per_batch, least_tasks)}
    if fmt == "kafka":
        messages = spark.readStream.format("kafka").options(**options).load()
        return messages.select(
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("arrived_at"),
            F.lpad(F.col("offset").cast("string"), 20, "0").alias("sequence"),
        )
    files = spark.readStream.format(fmt).options(**{"wholetext": "true", **options}).load()
    return files.select(
        "value",
        F.col("_metadata.file_modification_time").alias("arrived_at"),
        F.col("_metadata.file_path").alias("sequence"),
    )


def _admission(fmt: str, per_batch: int | None, least_tasks: int | None) -> dict[str, str]:
    """The options of the source that bound a micro-batch."""
    for name, value in (("per_batch", per_batch), ("least_tasks", least_tasks)):
        if value is not None and value < 1:
            raise ValueError(f"{name} must be 1 or more, not {value}")
    chosen = {"maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger": per_batch}
    if fmt == "kafka":
        chosen["minPartitions"] = least_tasks
    return {name: str(value) for name, value in chosen.items() if value is not None}
