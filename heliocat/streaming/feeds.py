"""Polling the latest event and the daily refresh as streams over landed files."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from heliocat.constants import POLL_SECONDS
from heliocat.operators.collapse import StatusColumns
from heliocat.operators.merge import has_key
from heliocat.operators.normalise import normalise_latest
from heliocat.plans.loads import array_events
from heliocat.session import list_in_few_tasks
from heliocat.sources.latest_event import latest_events
from heliocat.sources.status_rows import arrays_to_rows, finish
from heliocat.tables import KeyedTable

log = logging.getLogger(__name__)

#: arrival order inside one micro-batch of documents
DOCUMENT_ORDER = ["file", "element"]


def poll_trigger(seconds: int | None = POLL_SECONDS) -> dict:
    """Every ``seconds``, or once over what has landed if None."""
    return {"processingTime": f"{seconds} seconds"} if seconds else {"availableNow": True}


def read_document_stream(spark: SparkSession, path: str, max_files: int = 10_000) -> DataFrame:
    """Landed documents, at most ``max_files`` per micro-batch; the rest comes in the next."""
    list_in_few_tasks(spark)
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .text(path, wholetext=True)
        .withColumn("file", F.col("_metadata.file_path"))
    )


def latest_to_events(documents: DataFrame, mode: str = "all") -> DataFrame:
    """Landed documents to complete events, and rows to reject for those that are unusable.

    An event still running is left out, and comes again in a later document."""
    events = latest_events(documents, mode=mode, keep=("file",), refused=True)
    return normalise_latest(events, keep=tuple(DOCUMENT_ORDER))


def poll_latest(
    spark: SparkSession,
    path: str,
    table: KeyedTable,
    checkpoint: str,
    seconds: int | None = POLL_SECONDS,
    mode: str = "all",
) -> DataStreamWriter:
    """Insert new events from landed documents. ``start()`` the result.

    A micro-batch that is run again after a failure adds nothing twice: rows are
    found by key in the table itself, over all of its history.
    """
    stream = latest_to_events(read_document_stream(spark, path), mode)
    return insert_stream(stream, table, DOCUMENT_ORDER, checkpoint, seconds)


def sync_arrays(
    spark: SparkSession,
    path: str,
    table: KeyedTable,
    checkpoint: str,
    schema: T.StructType,
    label: str = "GOES-19",
    seconds: int | None = None,
    format: str = "parquet",
    fills: dict | None = None,
    max_files: int = 100,
) -> DataStreamWriter:
    """The daily refresh over landed array files; a file is read once, by the checkpoint.

    Each file holds whole events, so they are collapsed inside the micro-batch of at most
    ``max_files`` files.
    """
    list_in_few_tasks(spark)
    files = (
        spark.readStream.format(format)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
        .withColumn("file", F.col("_metadata.file_path"))
    )
    rows = finish(arrays_to_rows(files, schema.names), fills)
    names = StatusColumns(by=("file",))

    def insert(batch: DataFrame, number: int) -> None:
        events = array_events(batch, label, names)
        result = table.insert_ignore(events, ["file", "seq"], batch_name=f"{checkpoint} {number}")
        log.info("batch %s: %s", number, result)

    return _writer(rows, checkpoint, seconds).foreachBatch(insert)


def insert_stream(
    events: DataFrame, table: KeyedTable, order: list[str], checkpoint: str, seconds: int | None
) -> DataStreamWriter:
    """Insert each micro-batch by key. A batch that is run again is known by its number, so
    it adds nothing twice, rows with a null in the key included."""

    def insert(batch: DataFrame, number: int) -> None:
        result = table.insert_ignore(batch, order, batch_name=f"{checkpoint} {number}")
        log.info("batch %s: %s", number, result)

    return _writer(events, checkpoint, seconds).foreachBatch(insert)


def keep_running(
    writer: DataStreamWriter, pause: float = POLL_SECONDS, attempts: int | None = None
) -> None:
    """Run a stream until it ends; log a failure, pause and go on from the checkpoint."""
    failures = 0
    while True:
        try:
            writer.start().awaitTermination()
            return
        except StreamingQueryException:
            failures += 1
            if attempts is not None and failures >= attempts:
                raise
            log.exception("stream failed; it will be started again in %s s", pause)
            time.sleep(pause)


def _writer(stream: DataFrame, checkpoint: str, seconds: int | None) -> DataStreamWriter:
    return (
        stream.writeStream.trigger(**poll_trigger(seconds))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def drop_repeats(
    events: DataFrame,
    table: KeyedTable,
    order: list[str],
    checkpoint: str,
    seconds: int | None = None,
    memory_seconds: int | None = None,
) -> DataStreamWriter:
    """De-duplicate a stream by the key of ``table``, which receives its first rows.

    Repeats are found in the stored table, at any distance and however late a row comes, so
    nothing depends on how the input is cut into micro-batches. Rows without a whole key
    never repeat and are all kept.

    With ``memory_seconds`` keys are remembered that long, and repeats within that time go no
    further; later ones still meet the table.
    """
    if memory_seconds is not None:
        events = forget_after(events, table.key, order, memory_seconds)
    return insert_stream(events, table, order, checkpoint, seconds)


def forget_after(events: DataFrame, key: list[str], order: list[str], seconds: int) -> DataFrame:
    """A stream without the repeats of a key that came within ``seconds`` of its last row.

    State is one flag per key, removed when the time is over, so it is bounded by the keys of
    that time. Time is that of the micro-batch: no row is late, and none is dropped but repeats.
    Rows without a whole key pass. A key's rows of one micro-batch meet in one task, some at a
    time; all but their key and order is one text there.
    """
    arrived = F.current_timestamp().alias("_arrived")
    names = events.columns
    packed = F.to_json(F.struct(*names), {"ignoreNullFields": "false", "timestampNTZFormat": _NTZ, "timestampFormat": _TZ})
    whole = events.filter(has_key(key)).select(*key, F.struct(*order).alias("_order"), packed.alias("_row"), arrived)
    rows = whole.withWatermark("_arrived", f"{seconds} seconds").groupBy(*key).applyInPandasWithState(
        _first_of_key, "_row string", "seen boolean", "append", GroupStateTimeout.EventTimeTimeout
    )
    back = F.from_json("_row", events.schema, {"timestampNTZFormat": _NTZ, "timestampFormat": _TZ})
    return rows.select(back.alias("_event")).select("_event.*").unionByName(events.filter(~has_key(key)))


#: exact texts of times, for rows that pass through a state
_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_TZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _first_of_key(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The first row of a key that is not remembered; the watermark is behind the arrival by the time to keep it."""
    if state.hasTimedOut:
        state.remove()
        return
    first, arrived = None, 0
    for part in parts:
        found = min(zip(part["_order"].map(_comparable), part["_row"]), key=lambda x: x[0])
        first = found if first is None or found[0] < first[0] else first
        arrived = max(arrived, int(part["_arrived"].max().timestamp() * 1000))
    if not state.exists and first is not None:
        yield pd.DataFrame({"_row": [first[1]]})
    state.update((True,))
    state.setTimeoutTimestamp(max(arrived, state.getCurrentWatermarkMs() + 1))


def _comparable(order) -> tuple:
    """A row's place as a tuple, nulls first."""
    values = order.values() if isinstance(order, dict) else order
    return tuple((v is not None, v if v is not None else 0) for v in values)
