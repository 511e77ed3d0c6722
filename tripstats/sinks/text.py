"""CSV output."""

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write files with a header, replacing what is at ``path``.

    ``single_file`` is for reports of a size to be read by people: one task writes
    everything, while those before it run side by side.
    """
    if single_file:
        df = df.repartition(1)
    df.write.csv(path, header=True, mode="overwrite")
