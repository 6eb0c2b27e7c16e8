"""The read queries. Each returns a DataFrame; the caller decides whether to collect."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heliocat.constants import DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE
from heliocat.functions.times import iso_text
from heliocat.operators.lookups import attach_indices
from heliocat.operators.paging import TOP_ROWS, newest_first, page_offset
from heliocat.operators.predicates import all_of, days_between, flare_predicates, moment
from heliocat.operators.statistics import stats, stats_long, total
from heliocat.schemas import FLARES, INDEX_COLUMNS

__all__ = [
    "list_flares",
    "count_flares",
    "flare_page",
    "latest_flare",
    "get_flare",
    "stats",
    "stats_long",
    "list_indices",
]


def list_flares(
    flares: DataFrame,
    page: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
    indices: DataFrame | None = None,
    top_rows: int = TOP_ROWS,
    **filters,
) -> DataFrame:
    """One page, newest first, of the rows that pass the filters.

    With ``indices`` the page is cut first and joined after: the lookup has one row
    per day, so the join neither adds nor removes rows.
    """
    offset = page_offset(page, page_size)
    wanted = flares.filter(all_of(flare_predicates(**filters)))
    rows = newest_first(wanted, offset, page_size, top_rows=top_rows)
    if indices is None:
        return rows
    return attach_indices(rows, indices).orderBy(
        F.desc("event_start"), F.desc("id")
    )


def count_flares(flares: DataFrame, **filters) -> DataFrame:
    return total(flares.filter(all_of(flare_predicates(**filters))))


def response_rows(rows: DataFrame) -> DataFrame:
    """The response fields, times as ISO text."""
    kept = [f for f in FLARES.fields if f.name != "metadata" and f.name in rows.columns]
    return rows.select(
        *[
            iso_text(F.col(f.name)).alias(f.name)
            if f.dataType.typeName().startswith("timestamp")
            else F.col(f.name)
            for f in kept
        ],
        *[c for c in INDEX_COLUMNS if c in rows.columns],
    )


def flare_page(
    flares: DataFrame,
    page: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
    indices: DataFrame | None = None,
    **filters,
) -> DataFrame:
    """One row: ``total, page, page_size`` and the page's rows, newest first."""
    rows = list_flares(flares, page, page_size, indices, **filters)
    numbered = response_rows(rows)
    # at most page_size rows; ISO text sorts as the times do
    entries = F.sort_array(
        F.collect_list(F.struct("event_start", "id", F.struct("*").alias("row"))), asc=False
    )
    return numbered.agg(F.transform(entries, lambda e: e["row"]).alias("results")).select(
        count_flares(flares, **filters).scalar().alias("total"),
        F.lit(page).alias("page"),
        F.lit(page_size).alias("page_size"),
        "results",
    )


def latest_flare(flares: DataFrame) -> DataFrame:
    """The newest row; none if the table is empty."""
    return newest_first(flares, 0, 1)


def get_flare(flares: DataFrame, flare_id: int, indices: DataFrame, event_start=None) -> DataFrame:
    """One event with its day's lookup values; no row if the id is unknown.

    With ``event_start`` the row must start there too: among billions of hashed ids two may be
    equal, and files of other times are then not read.
    """
    wanted = [F.col("id") == flare_id]
    if event_start is not None:
        wanted.append(F.col("event_start") == moment(event_start))
    return attach_indices(flares.filter(all_of(wanted)), indices)


def list_indices(
    indices: DataFrame, date_from=None, date_to=None, page: int = 1, page_size: int = MAX_PAGE_SIZE
) -> DataFrame:
    """One page of the lookup, newest day first; the lookup has one row per day."""
    wanted = indices.filter(all_of(days_between("date", date_from, date_to)))
    offset = page_offset(page, page_size)
    return wanted.orderBy(F.desc("date")).offset(offset).limit(page_size)
