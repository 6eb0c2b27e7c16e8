"""Streams over landed files: the table must equal the batch result, also after restarts."""

import datetime as dt
import json
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F, types as T

import __spark_entry__ as entry
from heliocat.session import LISTING, LISTING_TASKS, list_in_few_tasks
from heliocat.streaming.feeds import (
    drop_repeats,
    keep_running,
    latest_to_events,
    poll_latest,
    poll_trigger,
    sync_arrays,
)
from heliocat.streaming.refresh import refresh_arrays, refresh_latest
from heliocat.sources.latest_event import read_documents
from heliocat.tables import KeyedTable
from test_sources import STATUS, event


@pytest.fixture()
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "flares")).create()


def run(writer):
    query = writer.start()
    query.awaitTermination()
    return query


def key(df):
    return sorted((r["event_start"], r["instrument"], r["magnitude"]) for r in df.collect())


def test_polling(spark, table, tmp_path):
    landed, checkpoint = tmp_path / "landed", str(tmp_path / "checkpoint")
    landed.mkdir()
    running = event(max_time="Unk", end_time="Unk")
    (landed / "1.json").write_text(json.dumps([running]))
    run(poll_latest(spark, str(landed), table, checkpoint, seconds=None))
    assert table.read().isEmpty()
    (landed / "2.json").write_text(json.dumps([event()])[:-1])
    (landed / "3.json").write_text(json.dumps([event(max_class="X9.9"), event(satellite=16)]))
    run(poll_latest(spark, str(landed), table, checkpoint, seconds=None))
    start = dt.datetime(2024, 5, 8, 21, 8)
    expected = [(start, "G16", "X1.0"), (start, "G18", "X1.0")]  # the first writer wins
    assert key(table.read()) == expected
    # started again, and from an empty checkpoint: nothing is added
    run(poll_latest(spark, str(landed), table, checkpoint, seconds=None))
    run(poll_latest(spark, str(landed), table, str(tmp_path / "other"), seconds=None))
    assert key(table.read()) == expected
    docs = read_documents(spark, str(landed)).withColumn("file", F.col("_metadata.file_path"))
    assert {k[:2] for k in key(latest_to_events(docs))} == {k[:2] for k in expected}


def widest_stage(spark, query):
    """The most tasks of a stage of a streaming query."""
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(str(query.runId))]
    return max(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds if tracker.getStageInfo(s))


def test_a_task_looks_up_many_files(spark, table, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    for i in range(LISTING_TASKS + 50):
        (landed / f"{i}.json").write_text(json.dumps([event(satellite=i)]))
    was = spark.conf.get(LISTING)
    try:
        spark.conf.unset(LISTING)
        query = run(poll_latest(spark, str(landed), table, str(tmp_path / "checkpoint"), seconds=None))
        assert widest_stage(spark, query) <= LISTING_TASKS and table.read().count() == LISTING_TASKS + 50
        spark.conf.set(LISTING, "7")
        list_in_few_tasks(spark)
        assert spark.conf.get(LISTING) == "7"
    finally:
        spark.conf.set(LISTING, was)


def test_landed_documents_lie_in_one_folder(spark, tmp_path, monkeypatch):
    """As many files as there are stretches of 200 documents, and no folder below the one polled."""
    folder = tmp_path / "run"
    monkeypatch.setattr(entry, "_scratch", lambda spark: str(folder))
    entry.poll_landed_documents(spark, entry.SMOKE_DIR)
    assert not [f for f in (folder / "landed").iterdir() if f.is_dir()]
    texts = [f.read_text() for f in (folder / "landed").glob("part-*")]
    ids = [r[0] for r in spark.read.parquet(f"{entry.SMOKE_DIR}/events.parquet").select("event_id").collect()]
    assert len(texts) == len({i // 200 for i in ids}) > 1
    assert sum(len(json.loads(t)) for t in texts) == 2 * len(ids)


def land(path, rows):
    """Array rows as one file of a folder, written anew if it is there."""
    names = ["flare_id", "status", "time", "xrsb_flux", "integrated_flux", "flare_class"]
    columns = dict(zip(names, (list(c) for c in zip(*rows))))
    pq.write_table(pa.table({n: [v] for n, v in columns.items()}), path)


ARRAYS = (
    "flare_id array<bigint>, status array<string>, time array<double>, xrsb_flux array<double>, "
    "integrated_flux array<double>, flare_class array<string>"
)


def test_refresh_reads_a_file_written_anew(spark, table, tmp_path):
    """Two events of a file, then four under the same name, then the same again."""
    landed = tmp_path / "landed"
    landed.mkdir()
    land(landed / "flsum[19].parquet", STATUS[:7])
    assert [r.inserted for r in refresh_arrays(spark, str(landed), table, T._parse_datatype_string(ARRAYS))] == [2]
    assert refresh_arrays(spark, str(landed), table, T._parse_datatype_string(ARRAYS)) == []
    land(landed / "flsum[19].parquet", STATUS)
    os.utime(landed / "flsum[19].parquet", (2e9, 2e9))
    (result,) = refresh_arrays(spark, str(landed), table, T._parse_datatype_string(ARRAYS))
    assert (result.read, result.inserted, result.held) == (4, 2, 2)
    assert refresh_arrays(spark, str(landed), table, T._parse_datatype_string(ARRAYS)) == [] and table.read().count() == 4
    assert table.read_ledger().count() == 2


def test_a_failed_refresh_leaves_its_files_to_the_next(spark, table, tmp_path, monkeypatch):
    landed = tmp_path / "landed"
    landed.mkdir()
    for i in range(5):
        (landed / f"{i}.json").write_text(json.dumps([event(satellite=i)]))
        os.utime(landed / f"{i}.json", (1e9 + i, 1e9 + i))
    publish = table._log.publish
    monkeypatch.setattr(table._log, "publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh_latest(spark, str(landed), table)
    monkeypatch.setattr(table._log, "publish", publish)
    assert table.read().isEmpty()
    assert [r.inserted for r in refresh_latest(spark, str(landed), table, max_files=2)] == [2, 2, 1]
    # one more event in a document that is there already
    (landed / "0.json").write_text(json.dumps([event(satellite=0), event(satellite=77)]))
    assert [r.inserted for r in refresh_latest(spark, str(landed), table)] == [1]


def test_refused_documents_are_counted(spark, table, tmp_path):
    """Two bad files beside one good, by stream and by refresh."""
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "good.json").write_text(json.dumps([event()]))
    (landed / "bad.json").write_text("<html>")
    (landed / "none.json").write_text("[]")
    run(poll_latest(spark, str(landed), table, str(tmp_path / "checkpoint"), seconds=None))
    assert table.read().count() == 1
    reasons = {r["file"].rsplit("/")[-1]: r["reject_reason"] for r in table.read_rejects("file string").collect()}
    assert reasons == {"bad.json": "document is no array", "none.json": "document has no event"}
    (result,) = refresh_latest(spark, str(landed), KeyedTable(spark, str(tmp_path / "other")).create())
    assert (result.read, result.inserted, result.rejected) == (3, 1, 2)


def test_memory_of_keys_is_bounded(spark, tmp_path):
    """Rows in files of any order arrive, repeats go, and keys are forgotten after their time."""
    ddl = "event_start timestamp_ntz, instrument string, note double, seq long"
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = T.StructType([*T._parse_datatype_string(ddl).fields[:3]])
    table = KeyedTable(spark, out, schema, ["event_start", "instrument"]).create()
    states = []
    for n, day in enumerate((30, 2, 16, 2)):
        start = dt.datetime(2024, 1, day, 0, 0, 0, 123456)
        rows = [(start, f"i{k}", float(n), 10 * n + k) for k in range(5)] + [(start, f"i{k}", -1.0, 100 + k) for k in range(5)]
        rows += [(start, None, float("nan"), 99), (dt.datetime(2020, 1, 1), "same", 0.5, n)]
        spark.createDataFrame(rows[::-1], ddl).coalesce(2).write.mode("append").parquet(path)
        stream = spark.readStream.schema(ddl).parquet(path)
        query = run(drop_repeats(stream, table, ["seq"], checkpoint, memory_seconds=1))
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(1.2)
    found = sorted((r["event_start"].day, r["instrument"] or "", r["note"]) for r in table.read().collect())
    keyed = [f for f in found if f[1]]
    assert len(keyed) == 16 and {f[2] for f in keyed} == {0.0, 1.0, 2.0, 0.5}  # the first of each key
    assert len(found) == 20  # those without an instrument all stay
    assert max(states) <= 12  # two files' keys at most, never all


def test_daily_refresh(spark, table, tmp_path):
    names = {"flare_id": "bigint", "status": "string", "time": "double", "xrsb_flux": "double",
             "integrated_flux": "double", "flare_class": "string"}
    schema = T._parse_datatype_string(", ".join(f"{n} array<{t}>" for n, t in names.items()))
    landed, checkpoint = str(tmp_path / "landed"), str(tmp_path / "checkpoint")

    def land(rows):
        record = tuple(list(c) for c in zip(*rows))
        spark.createDataFrame([record], schema).coalesce(1).write.mode("append").parquet(landed)

    land(STATUS[:7])
    run(sync_arrays(spark, landed, table, checkpoint, schema))
    assert table.read().count() == 2
    land(STATUS)  # the next file holds the old events too
    run(sync_arrays(spark, landed, table, checkpoint, schema))
    assert table.read().count() == 4
    assert {r["instrument"] for r in table.read().collect()} == {"GOES-19"}
    land(STATUS)
    run(sync_arrays(spark, landed, table, checkpoint, schema))
    assert table.read().count() == 4


def test_late_rows_and_repeats_at_any_distance(spark, tmp_path):
    """Three files in any order, one per micro-batch: distinct rows stay, repeats go."""
    ddl = "event_start timestamp_ntz, instrument string, seq long"
    days = [(2024, 1, 30), (2024, 2, 15), (2024, 1, 1)]
    for turn, order in enumerate(([0, 1, 2], [2, 0, 1], [1, 2, 0])):
        path = str(tmp_path / f"in{turn}")
        for n, i in enumerate(order):
            start = dt.datetime(*days[i])
            rows = [(start, f"i{k}", 10 * n + k) for k in range(5)] * 2 + [(start, None, 90 + n), (dt.datetime(2020, 1, 1), "same", n)]
            spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(path)
        schema = T.StructType([*stream.schema.fields[:2]])
        table = KeyedTable(spark, str(tmp_path / f"out{turn}"), schema, ["event_start", "instrument"]).create()
        run(drop_repeats(stream, table, ["seq"], str(tmp_path / f"checkpoint{turn}")))
        assert table.read().count() == 15 + 1 + 3


def test_triggers():
    assert poll_trigger() == {"processingTime": "300 seconds"}
    assert poll_trigger(None) == {"availableNow": True}


def test_a_failed_stream_is_started_again(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3).write.parquet(path)
    calls = []

    def sometimes(batch, _):
        calls.append(batch.count())
        if len(calls) < 3:
            raise RuntimeError("lost")

    def writer(name):
        stream = spark.readStream.schema("id long").parquet(path)
        return (
            stream.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", str(tmp_path / name))
            .foreachBatch(sometimes)
        )

    keep_running(writer("one"), pause=0)
    assert calls == [3, 3, 3]
    calls.clear()
    with pytest.raises(StreamingQueryException):
        keep_running(writer("two"), pause=0, attempts=2)
