"""Parquet tables with one row per key.

A table is a folder of partitions, written by Spark's dynamic partition overwrite: a write
replaces the partitions that it has rows for, when all its files are there, and leaves
the others alone.  A write that fails before that changes nothing.  A table without
partition columns of its own is one partition, so that storing it anew goes the same way.

Folder names hold partition values as text, so the table's types are kept by an empty
table beside the partitions, which readers of the folder skip.  One writer at a time,
and no readers while a write replaces what they read.
"""

import functools
import operator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstats.operators.columns import prefix_columns
from tripstats.operators.keyed import has_duplicate_keys, latest_per_key
from tripstats.operators.lookup import BROADCAST_BYTES, measure

# Spark's listing skips names that begin with an underscore, unless they are partitions.
_SCHEMA = "_schema"
_WHOLE = "_table"
MAX_LISTED_PARTITIONS = 500


def write_keyed(
    df: DataFrame,
    path: str,
    keys: list[str],
    order_by: list[str] | None = None,
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
    unique: bool = False,
) -> None:
    """Store one row per key of ``df`` at ``path``.

    ``order_by`` decides which row of a key stays: the greatest.  Without it keys
    have to be unique, which costs a pass to find out unless the caller vouches for it
    by ``unique``.  A null in a key stops the write.  Mode "errorifexists" refuses a
    table that has data.  Mode "upsert" merges with the stored rows; by ``order_by``, or
    else the new row wins.  Mode "replace" replaces all rows of the partitions that ``df`` has rows for.

    An upsert writes the whole table anew, unless it is partitioned: then only the
    partitions with new rows are rewritten.  The key must determine the partition, and
    a table is partitioned the same way by all its writes.
    Columns keep their types, partition columns too.
    """
    spark, keys, partition_by = df.sparkSession, list(keys), list(partition_by or [])
    if mode not in ("errorifexists", "upsert", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    old = stored_rows(spark, path)
    filled = old is not None and not old.isEmpty()
    if filled and mode == "errorifexists":
        raise FileExistsError(f"{path} holds data already")
    df = df.withColumns({key: _known(key) for key in keys})
    if order_by is None:
        if not unique and has_duplicate_keys(df, keys):
            raise ValueError(f"several rows for one of {keys}: name the columns that order them")
        incoming = df
    else:
        incoming = latest_per_key(df, keys, order_by)
    if filled and mode == "upsert":
        # Which partitions are touched does not depend on which row of a key stays.
        touched = _touched_partitions(old, df, partition_by) if partition_by else old
        incoming = _merge(touched, incoming, keys, order_by)
    if not filled:
        # The columns in the order of reading: partition columns come last.
        fields = sorted(df.schema.fields, key=lambda field: field.name in partition_by)
        types = spark.createDataFrame([], T.StructType(fields))
        types.write.mode("overwrite").parquet(f"{path}/{_SCHEMA}")
    _save(incoming, path, partition_by)


def stored_rows(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """The rows of the table that ``write_keyed`` keeps at ``path``; None if there is none."""
    try:
        schema = spark.read.parquet(f"{path}/{_SCHEMA}").schema
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return spark.read.options(**options).schema(schema).parquet(path).select(*schema.names)


def _known(key: str) -> Column:
    message = F.lit(f"a row without {key} cannot be stored by it")
    return F.when(F.col(key).isNull(), F.raise_error(message)).otherwise(F.col(key))


def _merge(old: DataFrame, new: DataFrame, keys: list[str], order_by) -> DataFrame:
    if order_by is None:
        return old.join(new.select(*keys), keys, "left_anti").unionByName(new)
    return latest_per_key(old.unionByName(new), keys, order_by)


def _save(df: DataFrame, path: str, partition_by: list[str]) -> None:
    if partition_by:
        # Adaptive execution splits the large partitions and joins the small ones.
        df = df.hint("rebalance", *(F.col(c) for c in partition_by))
    else:
        df, partition_by = df.withColumn(_WHOLE, F.lit(0)), [_WHOLE]
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def _touched_partitions(old: DataFrame, new: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows of ``old`` in partitions that ``new`` has rows for."""
    touched = new.select(*partition_by).distinct()
    listed = touched.limit(MAX_LISTED_PARTITIONS + 1).collect()
    if len(listed) > MAX_LISTED_PARTITIONS:
        touched = prefix_columns(touched, "_new_")
        same = [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in partition_by]
        if measure(touched).bytes <= BROADCAST_BYTES:
            touched = F.broadcast(touched)
        return old.join(touched, same, "left_semi")
    # Literals let the scan skip the other partitions.
    hits = [_all(F.col(c).eqNullSafe(row[c]) for c in partition_by) for row in listed]
    return old.filter(functools.reduce(operator.or_, hits, F.lit(False)))


def _all(conditions) -> Column:
    return functools.reduce(operator.and_, conditions)
