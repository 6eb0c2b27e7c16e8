"""Merges, joins, pages and statistics on small frames with the odd cases."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import Row, functions as F

from heliocat.operators import eras, predicates
from heliocat.operators.lookups import attach_indices
from heliocat.operators.merge import (
    assign_ids,
    exists_in,
    insert_ignore,
    migrate_observations,
    upsert_columns,
)
from heliocat.operators.paging import newest_first, page_offset
from heliocat.operators.statistics import count_by_class, count_by_instrument, stats, stats_long
from heliocat.plans import queries as q
from heliocat.plans.loads import unified_catalog
from heliocat.schemas import FLARES, OBSERVATIONS, SOLAR_INDICES

KEYED = "event_start timestamp_ntz, instrument string, seq long, note string"


def at(day, hour=0, year=2024):
    return dt.datetime(year, 1, day, hour)


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), KEYED)


def plain_insert_ignore(existing, batch):
    held = {(r[0], r[1]) for r in existing if r[1] is not None}
    out = []
    for r in sorted(batch, key=lambda r: r[2]):
        if r[1] is None:
            out.append(r)
        elif (r[0], r[1]) not in held:
            held.add((r[0], r[1]))
            out.append(r)
    return out


def test_insert_ignore_against_brute_force(spark):
    rng = random.Random(5)
    instruments = ["G16", "G18", "GOES-16", None]

    def draw(n, first):
        # a third of the rows share one key
        return [
            (at(1), "G16", first + i, f"n{i}")
            if rng.random() < 1 / 3
            else (at(rng.randint(1, 9), rng.randint(0, 3)), rng.choice(instruments), first + i, f"n{i}")
            for i in range(n)
        ]

    existing, batch = draw(60, 0), draw(400, 1000)
    existing = [r for r in existing if r[0].day > 2]
    got = insert_ignore(keyed(spark, *existing), keyed(spark, *batch).repartition(5, "note"))
    expected = plain_insert_ignore(existing, batch)
    assert sorted(tuple(r) for r in got.select("seq", "note").collect()) == sorted(
        (r[2], r[3]) for r in expected
    )


def test_same_start_of_two_instruments_stays(spark):
    batch = keyed(spark, (at(1), "G19", 0, "json"), (at(1), "GOES-19", 1, "file"))
    empty = keyed(spark, (at(9), "G19", 0, "x"))
    assert insert_ignore(empty, batch).count() == 2
    assert insert_ignore(empty, batch, key=["event_start"]).collect()[0]["note"] == "json"


def test_insert_twice_equals_once(spark):
    batch = keyed(spark, (at(1), "a", 0, "x"), (at(2), "b", 1, "y"), (at(1), "a", 2, "z"))
    once = insert_ignore(batch.limit(0), batch)
    again = insert_ignore(once, batch)
    assert once.count() == 2 and again.isEmpty()


def test_arrival_order_may_have_several_columns(spark):
    rows = keyed(spark, (at(1), "a", 0, "second"), (at(1), "a", 5, "first"))
    ranked = rows.withColumn("source_rank", F.when(F.col("note") == "first", 0).otherwise(1))
    out = insert_ignore(rows.limit(0), ranked, order=["source_rank", "seq"])
    assert [r["note"] for r in out.collect()] == ["first"]


def test_existence(spark):
    table = keyed(spark, (at(1), "a", 0, "x"))
    rows = keyed(spark, (at(1), "b", 0, "y"), (at(2), "b", 0, "z"))
    assert [r["note"] for r in exists_in(rows, table, ["event_start"]).collect()] == ["y"]


def lookup(spark, *rows):
    full = [tuple(r) + (None,) * (len(SOLAR_INDICES) - len(r)) for r in rows]
    return spark.createDataFrame(full, SOLAR_INDICES)


def day(n):
    return dt.date(2024, 1, n)


FEEDS = {
    "sunspot": ("date date, sunspot_number int, source string, seq int",
                [(day(1), 10, "SILSO", 0), (day(2), 20, "SILSO", 1), (day(1), 11, "SILSO", 2)],
                ["sunspot_number"], ["source"]),
    "f10_7": ("date date, f10_7_flux double, seq int", [(day(2), 150.0, 0), (day(3), 151.0, 1)],
              ["f10_7_flux"], []),
    "kp": ("date date, kp_index double, ap_index int, seq int", [(day(3), 2.0, 7, 0), (day(1), 1.0, 4, 0)],
           ["kp_index", "ap_index"], []),
}


def apply(spark, table, name):
    ddl, rows, columns, insert_only = FEEDS[name]
    return upsert_columns(table, spark.createDataFrame(rows, ddl), columns, insert_only=insert_only)


def test_upserts_commute_in_their_own_columns(spark):
    results = set()
    for order in itertools.permutations(FEEDS):
        table = lookup(spark)
        for name in order:
            table = apply(spark, table, name)
        own = table.select("date", "sunspot_number", "f10_7_flux", "kp_index", "ap_index")
        results.add(tuple(sorted(map(str, own.collect()))))
    assert len(results) == 1
    assert len(next(iter(results))) == 3


def test_source_is_set_by_an_insert_only(spark):
    table = apply(spark, apply(spark, lookup(spark), "kp"), "sunspot")
    rows = {r["date"].day: r for r in table.collect()}
    assert rows[1]["source"] is None and rows[1]["sunspot_number"] == 11
    assert rows[2]["source"] == "SILSO" and rows[2]["created_at"] is not None
    again = {r["date"].day: r for r in apply(spark, table, "sunspot").collect()}
    assert again[1]["source"] is None


def observation(i, start, instrument="G15", sub=5.7, energy=1.0):
    return Row(
        id=i, event_start=start, max_peak_event=start, event_finish=start, classification="C",
        sub_classification=sub, observation_instrument=instrument, max_energy=energy, total_energy=0.0,
        active_region=0, altitude=1.0, azimuth=2.0, latitude=0.0, longitude=0.0, created_at=None,
    )


def test_migration(spark):
    rows = [
        observation(1, at(1)), observation(2, at(2), sub=1234.56, energy=None), observation(3, at(3), None),
        observation(4, at(2), sub=1.0), observation(5, at(3), None),
    ]
    old = spark.createDataFrame(rows, OBSERVATIONS)
    held = keyed(spark, (at(1), "G15", 0, ""))
    out = {r["seq"]: r for r in migrate_observations(old, held).collect()}
    assert sorted(out) == [2, 3, 5]
    assert out[2]["magnitude"] == "C1,234.6" and out[2]["source"] == "JSON"
    assert '"xrslong_flux":null' in out[2]["metadata"]
    assert out[3]["xrsb_flux_peak"] is None and out[3]["event_peak"] == at(3)
    with pytest.raises(ValueError, match="repeat a key"):
        migrate_observations(old, held, strict=True)
    assert migrate_observations(old.filter("id <> 4"), held, strict=True).count() == 3


def test_strict_migration_finds_the_one_fresh_key(spark):
    """Many keys come twice; only the one that the table does not hold is an error."""
    for fresh in range(1, 9):
        rows = [observation(2 * d + i, at(d)) for d in range(1, 9) for i in (0, 1)]
        old = spark.createDataFrame(rows, OBSERVATIONS)
        held = keyed(spark, *[(at(d), "G15", d, "") for d in range(1, 9) if d != fresh])
        with pytest.raises(ValueError, match="repeat a key"):
            migrate_observations(old, held, strict=True)
    held = keyed(spark, *[(at(d), "G15", d, "") for d in range(1, 9)])
    assert migrate_observations(old, held, strict=True).count() == 0


@pytest.mark.parametrize("mode", ["hash", "increment", "dense"])
def test_ids_are_unique(spark, mode):
    rows = [(at(1 + i % 9), None if i % 3 else f"i{i}", i, "") for i in range(90)]
    df = assign_ids(keyed(spark, *rows).repartition(4, "seq"), mode, after=1000)
    ids = [r["id"] for r in df.collect()]
    assert len(set(ids)) == 90
    if mode != "hash":
        assert min(ids) == 1001
    if mode == "dense":
        assert max(ids) == 1090
    with pytest.raises(ValueError):
        assign_ids(df, "other")


def flare(i, start, magnitude="C1.0", instrument="G16", source="GOES-16"):
    return (i, start, start, start, magnitude, 1e-6, 0.1, instrument, 1.0, 2.0, source, None, None)


@pytest.fixture(scope="module")
def flares(spark):
    rows = [
        flare(1, at(1), "X1.0"), flare(2, at(1), "X12.9"), flare(3, at(2), None), flare(4, at(2), ""),
        flare(5, at(3, 10), "C5.7", "G19", "JSON"), flare(6, at(3, 10), "c5.7", None),
        flare(7, at(4, year=2023), "M1.0", "GOES-19"), flare(8, at(5, year=2023), "M1.5", "GOES-19"),
    ]
    return spark.createDataFrame(rows, FLARES).cache()


def ids(df):
    return [r["id"] for r in df.collect()]


def test_pages_make_up_the_sorted_list(flares):
    expected = [6, 5, 4, 3, 2, 1, 8, 7]
    assert ids(q.list_flares(flares)) == expected
    for size in (1, 3, 5):
        pages = [ids(q.list_flares(flares, page=p, page_size=size)) for p in range(1, 10)]
        assert [i for page in pages for i in page] == expected
    assert ids(q.latest_flare(flares)) == [6]
    assert ids(q.latest_flare(flares.limit(0))) == []


def test_page_arguments():
    assert page_offset() == 0 and page_offset(3, 1000) == 2000
    for page, size in [(0, 1), (1, 0), (1, 1001)]:
        with pytest.raises(ValueError):
            page_offset(page, size)


def test_far_pages_skip_ahead_exactly(spark):
    rng = random.Random(11)
    # a third of the rows share one time; ids span the whole range of a long
    rows = [
        (rng.randint(-(2**63), 2**63 - 1), at(1) if rng.random() < 1 / 3 else at(1 + rng.randint(0, 20), rng.randint(0, 23)))
        for _ in range(900)
    ]
    df = spark.createDataFrame(rows, "id long, event_start timestamp_ntz")
    expected = [i for i, _ in sorted(rows, key=lambda r: (r[1], r[0]), reverse=True)]
    for offset in (0, 7, 250, 599, 640, 893, 899, 900, 5000):
        assert ids(newest_first(df, offset, 10, top_rows=20)) == expected[offset : offset + 10]


def test_filters(flares):
    assert ids(q.list_flares(flares, class_="X")) == [2, 1]
    assert ids(q.list_flares(flares, class_="X1.")) == [1]
    assert ids(q.list_flares(flares, class_="C")) == [5]
    assert ids(q.list_flares(flares, class_="C", ignore_case=True)) == [6, 5]
    assert ids(q.list_flares(flares, class_="_1", like=True)) == [2, 1, 8, 7]
    assert ids(q.list_flares(flares, class_="%5", like=True, ignore_case=True)) == [6, 5, 8]
    assert ids(q.list_flares(flares, class_="", source=None, date_from="")) == [6, 5, 4, 3, 2, 1, 8, 7]
    assert ids(q.list_flares(flares, source="JSON")) == [5]
    assert ids(q.list_flares(flares, instrument="GOES-19")) == [8, 7]
    # the upper bound is midnight: the events at 10:00 that day are out
    assert ids(q.list_flares(flares, date_from="2024-01-02", date_to="2024-01-03")) == [4, 3]
    assert ids(q.list_flares(flares, date_from="2024-01-03T10:00:00")) == [6, 5]
    assert q.count_flares(flares, class_="X").first()["cnt"] == 2


def test_page_answer(flares):
    row = q.flare_page(flares, page=2, page_size=3).first()
    assert (row["total"], row["page"], row["page_size"]) == (8, 2, 3)
    assert [r["id"] for r in row["results"]] == [3, 2, 1]
    assert row["results"][0]["event_start"] == "2024-01-02T00:00:00"
    assert "metadata" not in row["results"][0].asDict()
    empty = q.flare_page(flares, class_="Q").first()
    assert empty["total"] == 0 and empty["results"] == []


def test_lookup_join(spark, flares):
    table = lookup(spark, (day(1), 10, 150.0, 2.0, 7), (day(3), 30, 151.0, 3.0, 15))
    joined = {r["id"]: r["sunspot_number"] for r in attach_indices(flares, table).collect()}
    assert joined == {1: 10, 2: 10, 3: None, 4: None, 5: 30, 6: 30, 7: None, 8: None}
    assert ids(q.list_flares(flares, page_size=3, indices=table)) == [6, 5, 4]
    assert q.get_flare(flares, 5, table).first()["ap_index"] == 15
    assert q.get_flare(flares, 99, table).isEmpty()
    start = q.get_flare(flares, 5, table).first()["event_start"]
    assert q.get_flare(flares, 5, table, start).count() == 1
    assert q.get_flare(flares, 5, table, start + dt.timedelta(1)).isEmpty()
    page = q.flare_page(flares, page_size=1, indices=table).first()
    assert page["results"][0]["sunspot_number"] == 30


def test_lookup_list(spark):
    table = spark.range(1500).select(F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")).alias("date"))
    pages = [[r["date"] for r in q.list_indices(table, page=p).collect()] for p in (1, 2, 3)]
    assert [len(p) for p in pages] == [1000, 500, 0]
    assert len({d for p in pages for d in p}) == 1500 and pages[0][-1] > pages[1][0]
    dates = [r["date"] for r in q.list_indices(table, "2020-01-02", "2020-01-04").collect()]
    assert [d.day for d in dates] == [4, 3, 2]
    assert q.list_indices(table, date_to="2020-01-04T12:00:00").count() == 4


def test_statistics(flares):
    row = stats(flares).first()
    assert row["total_flares"] == 8
    assert row["by_class"] == {"": 1, "C": 1, "M": 2, "X": 2, "c": 1}
    assert row["by_year"] == {"2023": 2, "2024": 6}
    assert row["by_instrument"] == {"G16": 4, "GOES-19": 2, "G19": 1, "null": 1}
    order = stats(flares).select(F.map_keys("by_instrument")).first()[0]
    assert order == ["G16", "GOES-19", "G19", "null"]
    assert row["date_range"]["from"] == "2023-01-04T00:00:00"
    long = stats_long(flares).groupBy("kind").agg(F.sum("cnt").alias("n")).collect()
    assert {r["kind"]: r["n"] for r in long} == {"total": 8, "class": 7, "year": 8, "instrument": 8}
    assert [r["class"] for r in count_by_class(flares).collect()] == ["", "C", "M", "X", "c"]
    assert [r["cnt"] for r in count_by_instrument(flares).collect()] == [4, 2, 1, 1]


def test_statistics_of_an_empty_table(flares):
    row = stats(flares.limit(0)).first()
    assert row["total_flares"] == 0 and row["by_class"] == {}
    assert row["date_range"]["from"] is None


def test_windows_and_bounds(flares):
    inside = predicates.open_window(flares, "event_start", "2024-01-01", "2024-01-03T10:00:00")
    assert sorted(ids(inside)) == [3, 4]
    assert eras.trim_counts(flares, "2024-01-01 00:00:00").first().asDict() == {"kept": 2, "removed": 6}
    assert ids(predicates.head(flares, "id", n=2)) == [1, 2]
    assert ids(predicates.tail(flares, "id", n=2)) == [8, 7]
    assert eras.bounds(flares).first()["to"] == at(3, 10)


def test_unified_catalog_order(spark):
    """The three sources in their order; the middle one ends where the last begins."""
    catalog = spark.createDataFrame(
        [(0, "C", 1.0, " GOES-15", "0", "2016-01-01 00:00:00", "2016-01-01 00:10:00", "2016-01-01 00:20:00", 7e-6, 1.0, 2.0, "")],
        "ordinal long, Clase string, Subclase double, Instrumento string, Region string, `t-inicio` string, "
        "`t-max` string, `t-fin` string, `total X-ray flux` double, altitud double, azimuth double, unknown string",
    )
    base = dt.datetime(2000, 1, 1, 12)

    def rows(*starts):
        out = []
        for i, start in enumerate(starts):
            t = (start - base).total_seconds()
            for j, status in enumerate(["EVENT_START", "EVENT_PEAK", "EVENT_END"]):
                out.append((i, status, t + 60.0 * j, 1e-6, 0.1, "C1.0", 10 * i + j))
        return spark.createDataFrame(
            out, "flare_id long, status string, time double, xrsb_flux double, integrated_flux double, flare_class string, pos long"
        )

    middle = rows(dt.datetime(2024, 9, 19, 23, 59), dt.datetime(2024, 9, 20))
    last = rows(dt.datetime(2024, 9, 20), dt.datetime(2024, 9, 21))
    out = unified_catalog(catalog, middle, last, None).orderBy("source_rank", "seq").collect()
    assert [(r["source"], r["instrument"], r["source_rank"]) for r in out] == [
        ("SWPC", "GOES-15", 0), ("GOES-16", "GOES-16", 1), ("GOES-19", "GOES-19", 2), ("GOES-19", "GOES-19", 2),
    ]
    assert out[0]["magnitude"] == "M1.0" and out[0]["raw_flux"] == 7e-6
