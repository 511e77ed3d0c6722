import json
import os

import pytest
from pyspark.sql import functions as F

from tripstats import sources
from tripstats.operators.keyed import latest_per_key
from tripstats.streaming.station_status import (
    STATUS_COLUMNS,
    read_station_status,
    start_station_status,
    station_status,
)


def document(stamp, bikes, stations=5):
    return json.dumps(
        {
            "executionTime": stamp,
            "stationBeanList": [
                {"id": i, "stationName": f"S{i}", "availableBikes": bikes + i, "latitude": 40.5,
                 "longitude": -73.9, "availableDocks": 1, "statusValue": "In Service"}
                for i in range(stations)
            ],
        }
    )


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()

    def land(name, text, age):
        (folder / name).write_text(text)
        os.utime(folder / name, (1_600_000_000 + age, 1_600_000_000 + age))

    land("c.json", document("2019-01-01 00:00:00", 10), 1)
    land("b.json", document("2019-01-01 00:01:00", 20), 2)
    land("a.json", document("2019-01-01 00:02:00", 30, stations=3), 3)
    land("bad.json", '{"stationBeanList": [', 4)
    land("empty.json", '{"stationBeanList": []}', 5)
    return folder, land


def run(spark, folder, tmp_path, **options):
    messages = sources.read_snapshot_stream(
        spark, "text", {"path": str(folder), "maxFilesPerTrigger": "1"}
    )
    query = start_station_status(
        station_status(messages),
        str(tmp_path / "table"),
        str(tmp_path / "checkpoint"),
        trigger={"availableNow": True},
        **options,
    )
    query.awaitTermination(120)
    return query


LATEST = [("S0", 30), ("S1", 31), ("S2", 32), ("S3", 23), ("S4", 24)]


def test_latest_status_of_each_station(spark, rows, landed, tmp_path):
    folder, _ = landed
    query = run(spark, folder, tmp_path)
    assert query.lastProgress is None or query.exception() is None
    status = read_station_status(spark, str(tmp_path / "table"))
    assert rows(status, "station_name", "available_bikes") == LATEST


def test_stream_equals_batch(spark, rows, landed, tmp_path):
    folder, _ = landed
    run(spark, folder, tmp_path)
    files = spark.read.text(str(folder), wholetext=True).select(
        "value",
        F.col("_metadata.file_modification_time").alias("arrived_at"),
        F.col("_metadata.file_path").alias("sequence"),
    )
    every = station_status(files)
    assert every.count() == 13
    batch = latest_per_key(every, ["station_name"], ["arrived_at", "sequence", "position"])
    streamed = read_station_status(spark, str(tmp_path / "table"))
    assert rows(streamed) == rows(batch, *STATUS_COLUMNS)


def test_restart_goes_on_from_the_checkpoint(spark, rows, landed, tmp_path):
    folder, land = landed
    run(spark, folder, tmp_path)
    run(spark, folder, tmp_path)
    status = read_station_status(spark, str(tmp_path / "table"))
    assert rows(status, "station_name", "available_bikes") == LATEST
    land("later.json", document("2019-01-01 00:03:00", 90, stations=1), 9)
    run(spark, folder, tmp_path)
    status = read_station_status(spark, str(tmp_path / "table"))
    assert rows(status, "station_name", "available_bikes") == [("S0", 90), *LATEST[1:]]


def test_document_time_can_order_instead_of_arrival(spark, rows, landed, tmp_path):
    folder, land = landed
    land("delayed.json", document("2018-12-31 23:59:00", 500), 8)
    run(spark, folder, tmp_path, order_by=("snapshot_time", "position"))
    status = read_station_status(spark, str(tmp_path / "table"))
    assert rows(status, "station_name", "available_bikes") == LATEST


def test_replayed_batch_changes_nothing(spark, rows, landed, tmp_path):
    """All documents again, under a new checkpoint, into the same table."""
    folder, _ = landed
    run(spark, folder, tmp_path)
    messages = sources.read_snapshot_stream(spark, "text", {"path": str(folder)})
    start_station_status(
        station_status(messages),
        str(tmp_path / "table"),
        str(tmp_path / "other"),
        trigger={"availableNow": True},
    ).awaitTermination(120)
    status = read_station_status(spark, str(tmp_path / "table"))
    assert rows(status, "station_name", "available_bikes") == LATEST


def test_runs_for_a_bounded_time(spark, landed, tmp_path):
    folder, _ = landed
    messages = sources.read_snapshot_stream(spark, "text", {"path": str(folder)})
    query = start_station_status(
        station_status(messages), str(tmp_path / "t"), str(tmp_path / "c")
    )
    assert query.awaitTermination(0.5) is False
    query.processAllAvailable()
    query.stop()
    assert read_station_status(spark, str(tmp_path / "t")).count() == 5


def batches(query):
    return [p for p in query.recentProgress if p.numInputRows]


def test_state_keeps_one_record_a_station(spark, landed, tmp_path):
    folder, land = landed
    query = run(spark, folder, tmp_path)
    assert "StateStoreSave" in query._jsq.explainInternal(False)
    # Only the stations of a batch's documents are handed on: 5, 5, 3, none, none.
    states = [p.stateOperators[0] for p in batches(query)]
    assert [s.numRowsUpdated for s in states] == [5, 5, 3, 0, 0]
    assert [s.numRowsTotal for s in states] == [5] * 5
    land("one.json", document("2019-01-01 00:04:00", 70, stations=1), 7)
    (last,) = batches(run(spark, folder, tmp_path))
    assert (last.stateOperators[0].numRowsUpdated, last.stateOperators[0].numRowsTotal) == (1, 5)


def test_late_documents_change_neither_state_nor_table(spark, rows, landed, tmp_path):
    folder, land = landed
    order = ("snapshot_time", "position")
    run(spark, folder, tmp_path, order_by=order)
    for age, name in enumerate(("late", "later")):
        land(f"{name}.json", document("2018-12-31 23:59:00", 500), 8 + age)
        run(spark, folder, tmp_path, order_by=order)
        status = read_station_status(spark, str(tmp_path / "table"))
        assert rows(status, "station_name", "available_bikes") == LATEST
    # The state still knows the latest: a record between the two is late as well.
    land("between.json", document("2019-01-01 00:00:30", 600), 20)
    run(spark, folder, tmp_path, order_by=order)
    status = read_station_status(spark, str(tmp_path / "table"))
    assert rows(status, "station_name", "available_bikes") == LATEST


def test_records_without_a_key_are_told(spark, rows, landed, tmp_path, caplog):
    folder, land = landed
    land("nameless.json", document("2019-01-01 00:05:00", 1).replace('"S1"', "null").replace('"S2"', "null"), 9)
    with caplog.at_level("WARNING"):
        run(spark, folder, tmp_path)
    assert [r.getMessage() for r in caplog.records if "without" in r.getMessage()] == [
        "batch 5: 2 records without station_name"
    ]


@pytest.mark.parametrize("per_batch, count", [(None, 1), (2, 3), (1, 5)])
def test_batches_are_bounded(spark, rows, landed, tmp_path, per_batch, count):
    folder, _ = landed
    messages = sources.read_snapshot_stream(spark, "text", {"path": str(folder)}, per_batch)
    query = start_station_status(
        station_status(messages), str(tmp_path / "t"), str(tmp_path / "c"), trigger={"availableNow": True}
    )
    query.awaitTermination(120)
    sizes = [p.numInputRows for p in batches(query)]
    assert len(sizes) == count and sum(sizes) == 5 and max(sizes) <= (per_batch or 5)
    assert rows(read_station_status(spark, str(tmp_path / "t")), "station_name", "available_bikes") == LATEST


def test_options_that_bound_a_batch():
    from tripstats.sources.stations import _admission

    assert _admission("kafka", 1000, 64) == {"maxOffsetsPerTrigger": "1000", "minPartitions": "64"}
    assert _admission("kafka", None, None) == _admission("text", None, 8) == {}
    with pytest.raises(ValueError, match="per_batch"):
        _admission("text", 0, None)


def test_progress_counts_malformed_documents(spark, landed, tmp_path):
    from tripstats.streaming.station_status import DOCUMENTS

    folder, _ = landed
    told = [p.observedMetrics[DOCUMENTS] for p in batches(run(spark, folder, tmp_path))]
    assert sum(row["read"] for row in told) == 5 and sum(row["bad"] for row in told) == 1
