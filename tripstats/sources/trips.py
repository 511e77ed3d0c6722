"""Trip files."""

from pyspark.sql import DataFrame, Observation, SparkSession

from tripstats.fixed_values import TRIP_FILE_SCHEMA, TRIP_NAMES
from tripstats.sources.checked import BAD, observed, schema_with_bad


def read_trips(
    spark: SparkSession,
    path: str | list[str],
    check_header: bool = False,
    counted: Observation | None = None,
) -> DataFrame:
    """Trips from comma-separated files with a header; a cell that does not fit its
    type is null.

    Columns go by position.  With ``check_header`` a file stops the job whose header does not name
    the columns that are read, in their order.  ``counted`` gets the number of lines ``read``, and how many
    of them had a cell too many, too few or of a wrong type (``bad``).
    """
    options = {"header": True, "mode": "PERMISSIVE", "enforceSchema": not check_header}
    if counted is not None:
        options["columnNameOfCorruptRecord"] = BAD
    raw = spark.read.schema(schema_with_bad(TRIP_FILE_SCHEMA, counted)).csv(path, **options)
    return observed(raw, counted).withColumnsRenamed(TRIP_NAMES)
