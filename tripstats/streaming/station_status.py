"""Live table of station status."""

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripstats.fixed_values import STATION_STATUS_KEY
from tripstats.functions.parsing import parse_snapshot_time, parse_station_document
from tripstats.sinks.keyed import write_keyed
from tripstats.sources.tables import read_table

_log = logging.getLogger(__name__)

# Order of status rows: by document, then by place within it.
ARRIVAL_ORDER = ("arrived_at", "sequence", "position")
STATUS_COLUMNS = (
    "id",
    "station_name",
    "available_bikes",
    "latitude",
    "longitude",
    "available_docks",
)


# Name of the counts that a stream's progress reports for each batch.
DOCUMENTS = "station_documents"


def station_status(messages: DataFrame) -> DataFrame:
    """One row per station of each document, batch or stream.

    ``messages`` has ``value``, ``arrived_at`` and ``sequence`` (see
    ``read_snapshot_stream``).  Malformed documents give no rows; the progress of a stream has the number of
    documents ``read`` and of ``bad`` ones, as metrics under the name DOCUMENTS.
    """
    document = parse_station_document(F.col("value")).alias("document")
    parsed = messages.select(document, "arrived_at", "sequence")
    if messages.isStreaming:
        bad = F.count_if(F.col("document.stationBeanList").isNull()).alias("bad")
        parsed = parsed.observe(DOCUMENTS, F.count(F.lit(1)).alias("read"), bad)
    records = parsed.select(
        F.posexplode("document.stationBeanList").alias("position", "station"),
        parse_snapshot_time(F.col("document.executionTime")).alias("snapshot_time"),
        "arrived_at",
        "sequence",
    )
    return records.select(
        "station.id",
        F.col("station.stationName").alias("station_name"),
        F.col("station.availableBikes").alias("available_bikes"),
        "station.latitude",
        "station.longitude",
        F.col("station.availableDocks").alias("available_docks"),
        "snapshot_time",
        *ARRIVAL_ORDER,
    )


def latest_status(records: DataFrame, order_by: tuple[str, ...] = ARRIVAL_ORDER) -> DataFrame:
    """The latest record of each station, batch or stream, and ``records``: how many of the station
    were seen.

    On a stream Spark's state store holds one record a station, and in update mode a batch gives
    the stations that it had records of; late and replayed records leave them as
    they are.  Of records equally late the greatest in the other columns counts.
    """
    keys = list(STATION_STATUS_KEY)
    order = [c for c in order_by if c not in keys]
    rest = [c for c in records.columns if c not in keys and c not in order]
    latest = records.groupBy(*keys).agg(
        F.max(F.struct(*order, *rest)).alias("latest"), F.count(F.lit(1)).alias("records")
    )
    return latest.select(*keys, "latest.*", "records")


def start_station_status(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    order_by: tuple[str, ...] = ARRIVAL_ORDER,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the latest row of each station of ``stream`` in the table at ``table``.

    The stream's state keeps the latest record of each station, so a micro-batch hands on
    one row for each station that it had records of.  These are merged into the table by
    ``order_by``, so a batch that is played again, or a stream begun anew,
    changes nothing.  ``trigger`` is passed on, e.g. ``{"availableNow": True}``.  Records without
    the key of the table cannot be stored; each batch that has some logs how many there were so far.
    """
    keys = list(STATION_STATUS_KEY)

    def merge(batch: DataFrame, batch_id: int) -> None:
        counted = Observation()
        unnamed = F.col(keys[0]).isNull()
        nameless = F.sum(F.when(unnamed, F.col("records"))).alias("nameless")
        named = batch.observe(counted, nameless).filter(~unnamed).drop("records")
        write_keyed(named, table, keys, list(order_by), mode="upsert")
        if counted.get["nameless"]:
            _log.warning("batch %s: %s records without %s", batch_id, counted.get["nameless"], keys[0])

    writer = latest_status(stream, order_by).writeStream.outputMode("update").foreachBatch(merge)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "0 seconds"})).start()


def read_station_status(spark: SparkSession, table: str) -> DataFrame:
    """The latest known status of each station."""
    return read_table(spark, table).select(*STATUS_COLUMNS)
