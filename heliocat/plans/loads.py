"""Load pipelines: the historical catalog, the lookup feeds, the older table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliocat.constants import ARRAY_FILE_SUFFIX, CATALOG_END_ORDINAL, GOES_19_START
from heliocat.functions.times import utc
from heliocat.operators.collapse import StatusColumns, collapse_events
from heliocat.operators.eras import merge_eras, union_sources
from heliocat.operators.merge import Feed, observations_to_events, refuse_repeats
from heliocat.operators.normalise import (
    catalog_fate,
    is_complete,
    label_source,
    normalise_catalog,
    normalise_legacy,
    rename_catalog,
)
from heliocat.sources.catalog import read_catalog
from heliocat.sources.feeds import read_f10_7, read_kp, read_sunspots
from heliocat.sources.latest_event import latest_events
from heliocat.sources.listing import first_links, unread_files
from heliocat.sources.status_rows import read_status_rows
from heliocat.tables import InsertResult, KeyedTable, SnapshotTable

#: arrival order of the united sources
ARRIVAL = ["source_rank", "seq"]


def array_events(rows: DataFrame, label: str, names: StatusColumns = StatusColumns()) -> DataFrame:
    """Status rows of one instrument to labelled events."""
    return label_source(collapse_events(rows, names), label)


def unified_catalog(
    catalog: DataFrame, middle: DataFrame, last: DataFrame, end_ordinal: int | None
) -> DataFrame:
    """The three sources as one frame with its arrival order.

    ``catalog`` is the raw catalog with ``ordinal``; the others are status rows.
    """
    renamed = rename_catalog(catalog)
    old = normalise_catalog(renamed, end_ordinal=end_ordinal).withColumnRenamed("ordinal", "seq")
    return merge_eras(
        old, array_events(middle, "GOES-16"), array_events(last, "GOES-19")
    )


def history_accounts(
    catalog: DataFrame,
    middle: DataFrame,
    last: DataFrame,
    end_ordinal: int | None = CATALOG_END_ORDINAL,
    last_start: str = GOES_19_START,
) -> DataFrame:
    """source, fate, events: what becomes of every row of the three sources before the insert.

    ``catalog`` is as ``rename_catalog`` gives it, the others as ``array_events`` does. The insert of
    the united sources reads those of fate ``offered``; the others are cut, for the reason given.
    """
    early = F.when(F.col("event_start") < utc(last_start), "offered").otherwise("in the last era")
    parts = [
        catalog.select(F.lit("SWPC").alias("source"), catalog_fate(end_ordinal).alias("fate")),
        middle.select("source", early.alias("fate")),
        last.select("source", F.lit("offered").alias("fate")),
    ]
    return union_sources(*parts, rank=None).groupBy("source", "fate").agg(F.count("*").alias("events"))


def links_to_fetch(
    pages: DataFrame, held: DataFrame, suffix: str = ARRAY_FILE_SUFFIX, refresh: bool = False
) -> DataFrame:
    """The first matching link of each listing page, unless its file is held already."""
    links = first_links(pages, suffix).filter("link IS NOT NULL")
    return unread_files(links.withColumnRenamed("link", "file_name"), held, refresh=refresh)


def load_history(
    spark: SparkSession,
    table: KeyedTable,
    catalog_path: str,
    middle_path: str,
    last_path: str,
    dry_run: bool = False,
    end_ordinal: int | None = CATALOG_END_ORDINAL,
    **status_options,
) -> InsertResult:
    """The one-time load. A dry run counts the rows that would be added and writes nothing.

    ``end_ordinal`` is the catalog row at which the middle era takes over.
    """
    united = unified_catalog(
        read_catalog(spark, catalog_path, with_ordinal=True),
        read_status_rows(spark, middle_path, **status_options),
        read_status_rows(spark, last_path, **status_options),
        end_ordinal=end_ordinal,
    )
    if dry_run:
        return table.count_fresh(united, ARRIVAL)
    return table.insert_ignore(united, ARRIVAL)


def sync_status_rows(table: KeyedTable, rows: DataFrame, label: str = "GOES-19") -> InsertResult:
    """The daily refresh: whole files are read again, only new events are added."""
    return table.insert_ignore(array_events(rows, label), ["seq"])


def store_legacy(table: KeyedTable, documents: DataFrame) -> InsertResult:
    """The older path: one object per document, known by its start alone.

    ``documents`` carries ``value`` and ``seq``, the order of arrival. Documents that hold no
    object become rejects.
    """
    events = latest_events(documents, mode="legacy", keep=("seq",), refused=True)
    wanted = events.filter(F.col("reject_hint").isNotNull() | is_complete())
    return table.insert_ignore(normalise_legacy(wanted, keep=("seq", "reject_hint")))


def migrate(table: KeyedTable, observations: DataFrame, strict: bool = False) -> int:
    """Move older observations over; gives the table's row count afterwards.

    ``strict`` fails on new keys that come twice, before anything is written.
    """
    events = observations_to_events(observations)
    if strict:
        refuse_repeats(events, table.read(), table.key)
    table.insert_ignore(events)
    return table.read().count()


def load_sunspots(spark: SparkSession, table: SnapshotTable, path: str) -> int:
    return table.upsert_all([_sunspots(spark, path)])


def load_f10_7(spark: SparkSession, table: SnapshotTable, path: str) -> int:
    return table.upsert_all([_f10_7(spark, path)])


def load_kp(spark: SparkSession, table: SnapshotTable, path: str) -> int:
    return table.upsert_all([_kp(spark, path)])


def _sunspots(spark: SparkSession, path: str) -> Feed:
    return read_sunspots(spark, path), ["sunspot_number"], ["source"]


def _f10_7(spark: SparkSession, path: str) -> Feed:
    return read_f10_7(spark, path), ["f10_7_flux"], []


def _kp(spark: SparkSession, path: str) -> Feed:
    return read_kp(spark, path), ["kp_index", "ap_index"], []


def load_indices(
    spark: SparkSession,
    table: SnapshotTable,
    sunspot_path: str,
    f10_7_path: str | None = None,
    kp_path: str | None = None,
) -> int:
    """All feeds, one on top of the other, in one merge and one commit; gives its number.

    Without the last two only sunspot numbers. Days of other years are not touched.
    """
    feeds = [_sunspots(spark, sunspot_path)]
    feeds += [_f10_7(spark, f10_7_path)] if f10_7_path else []
    feeds += [_kp(spark, kp_path)] if kp_path else []
    return table.upsert_all(feeds)
