"""The folder shared by driver and executors for intermediate data."""

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.  Only a local session
    may go without the setting; it gets a temporary folder, the same each time."""
    folder = spark.conf.get(_SETTING, None)
    if folder is not None:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tripstats-")
    # Its own folder, and of no use to anyone later.
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared folder, so that losing an executor does not bring
    the work behind it back."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
