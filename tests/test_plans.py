"""What the plans must and must not contain."""

import pytest

import __spark_entry__ as entry
from check_sql import ORACLE
from heliocat import adapters as ad
from heliocat.operators import merge
from heliocat.operators.collapse import StatusColumns, collapse_events
from heliocat.operators.lookups import attach_indices
from heliocat.operators.statistics import stats_long

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if not n.startswith("stream_")))
def test_no_products_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert bad not in text
    assert "SinglePartition" not in text or name in SINGLE


# one-row answers, pages cut before a small join, and running sums of one count per file,
# split or partition
SINGLE = {
    "catalog_cut_counts", "stored_ids", "assign_dense_ids", "catalog_from_files", "collapse_many_files",
    "collapse_counters", "era_trim_counts", "list_flares_total", "flare_page", "stats_range",
    "stats_answer", "missing_links", "list_flares_with_indices", "newest_name", "stored_pages", "refused_documents",
}


def test_lookup_join_is_left_to_adaptive_execution(spark):
    flares = ad.flares(ad.table(spark, SF, "orders"))
    indices = ad.solar_indices(ad.table(spark, SF, "lineitem"))
    assert "BroadcastHashJoin" in plan(attach_indices(flares, indices))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(attach_indices(flares, indices))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_numeric_collapse_is_one_hash_shuffle(spark):
    rows = ad.status_rows(ad.table(spark, SF, "events"))
    text = plan(collapse_events(rows, StatusColumns(magnitude=None)))
    assert text.count("Exchange") == 1 and "SortAggregate" not in text
    assert text.count("HashAggregate") == 2


def test_insert_ignore_cuts_before_the_shuffle_and_shuffles_whole_keys_once(spark):
    existing, incoming = ad.existing_and_incoming(ad.table(spark, SF, "events"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(merge.insert_ignore(existing, incoming, unique=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    final = next(i for i, x in enumerate(lines) if "WindowGroupLimit" in x and "Final" in x)
    partial = next(i for i, x in enumerate(lines) if "WindowGroupLimit" in x and "Partial" in x)
    exchange = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    # one exchange for the batch, below the final cut and above the partial one; one for the table
    assert len(exchange) == 2 and final < exchange[0] < partial
    # the table, the batch's rows with a whole key, and those without, which no exchange moves
    assert text.count("FileScan") == 3 and exchange[1] < text[: text.rfind("FileScan")].count("\n")
    assert "left_anti" in text.lower() or "LeftAnti" in text


def test_statistics_read_the_rows_once(spark):
    text = plan(stats_long(ad.flares(ad.table(spark, SF, "orders"))))
    assert text.count("FileScan") == 1
    lines = text.splitlines()
    expand = next(i for i, x in enumerate(lines) if "Expand" in x)
    exchange = [i for i, x in enumerate(lines) if "Exchange" in x]
    # rows are multiplied only after the first shuffle has made them few
    assert any(i > expand for i in exchange)


def test_filters_and_columns_reach_the_scan(spark):
    flares = spark.read.parquet(f"{SF}/orders.parquet").withColumnRenamed("o_orderdate", "event_start")
    from heliocat.operators.predicates import all_of, flare_predicates

    text = plan(flares.filter(all_of(flare_predicates(date_from="1996-01-01"))).select("o_orderkey", "event_start"))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_documents_are_parsed_once(spark):
    text = plan(entry.queries()["parse_latest_json"](spark, SF))
    assert text.count("from_json") == 1


def test_sun_position_stays_small(spark):
    text = plan(entry.queries()["sun_position"](spark, SF))
    assert len(text) < 6000
