"""Landed files read by a stored ledger, so that a file written anew is read again.

A file stream knows a file by its name and reads it once. Here the table keeps path, length
and time of the files that its inserts have read, entered by the same commit as the rows: a
file that has another length or time is read again, whole, and only its new events are added.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from heliocat.operators.collapse import StatusColumns
from heliocat.plans.loads import array_events
from heliocat.session import list_in_few_tasks
from heliocat.sources.status_rows import arrays_to_rows, finish
from heliocat.streaming.feeds import DOCUMENT_ORDER, latest_to_events
from heliocat.tables import InsertResult, KeyedTable

log = logging.getLogger(__name__)


def landed_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """path, length, modified of the files of a folder; contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def changed_files(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger does not know as they are now: new ones, and those written anew."""
    return listed.join(ledger, ["path", "length", "modified"], "left_anti")


def refresh(
    table: KeyedTable,
    folder: str,
    events_of: Callable[[list[str]], DataFrame],
    order: list[str],
    glob: str = "*",
    max_files: int = 1000,
) -> list[InsertResult]:
    """Insert the events of new and changed files, oldest first; one result per ``max_files`` files.

    ``events_of`` reads events from paths. A file's length and time are taken before it is read:
    if it is written again meanwhile, the next run finds it changed. A run that fails leaves
    its files to the next.
    """
    spark, results = table.spark, []
    list_in_few_tasks(spark)
    while True:
        pending = changed_files(landed_files(spark, folder, glob), table.read_ledger())
        first = pending.select("path", "length", F.unix_micros("modified").alias("micros"))
        some = first.orderBy("micros", "path").limit(max_files).collect()
        if not some:
            return results
        files = spark.createDataFrame(some, "path string, length long, micros long")
        files = files.select("path", "length", F.timestamp_micros("micros").alias("modified"))
        events = events_of([_literal(r["path"]) for r in some])
        results.append(table.insert_ignore(events, order, files=files))
        log.info("%s files: %s", len(some), results[-1])


def _literal(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def refresh_latest(
    spark: SparkSession, folder: str, table: KeyedTable, mode: str = "all", max_files: int = 1000
) -> list[InsertResult]:
    """The latest-event documents of a folder; unusable ones become rejects."""

    def events(paths: list[str]) -> DataFrame:
        documents = spark.read.text(paths, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
        return latest_to_events(documents, mode)

    return refresh(table, folder, events, DOCUMENT_ORDER, max_files=max_files)


def refresh_arrays(
    spark: SparkSession,
    folder: str,
    table: KeyedTable,
    schema: T.StructType,
    label: str = "GOES-19",
    format: str = "parquet",
    fills: dict | None = None,
    glob: str = "*",
    max_files: int = 100,
) -> list[InsertResult]:
    """The array files of a folder, each of whole events."""

    def events(paths: list[str]) -> DataFrame:
        files = spark.read.format(format).schema(schema).load(paths).withColumn("file", F.col("_metadata.file_path"))
        rows = finish(arrays_to_rows(files, schema.names), fills)
        return array_events(rows, label, StatusColumns(by=("file",)))

    return refresh(table, folder, events, ["file", "seq"], glob, max_files)
