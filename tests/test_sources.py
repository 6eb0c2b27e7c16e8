"""Readers on small files that hold every odd row the feeds can bring."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from heliocat.functions.times import parse_utc
from heliocat.operators.collapse import StatusColumns, collapse_counters, collapse_events
from heliocat.operators.normalise import (
    is_complete,
    normalise_catalog,
    normalise_latest,
    normalise_legacy,
    rename_catalog,
)
from heliocat.sources import feeds, listing
from heliocat.sources.catalog import read_catalog
from heliocat.sources.latest_event import count_documents, latest_events, read_documents
from heliocat.sources.listing import first_links
from heliocat.sources.status_rows import read_status_rows

HEADER = "Clase\tSubclase\tInstrumento\tRegion\tt-inicio\tt-max\tt-fin\ttotal X-ray flux\taltitud\tazimuth\tunknown"


def catalog_line(start, peak, end, flux, instrument=" GOES-15 "):
    return f"M\t1.0\t{instrument}\t123\t{start}\t{peak}\t{end}\t{flux}\t10.5\t200.5\tzz"


@pytest.fixture()
def catalog_file(tmp_path):
    at = "1980-01-01 00:00:00"
    lines = [
        catalog_line("1974-01-01 11:00:00", "1974-01-01 11:59:59", at, "7e-6"),
        catalog_line("1974-01-01 11:50:00", "1974-01-01 12:00:00", at, "7e-6"),
        catalog_line("1974-01-01 12:00:00", "", at, "7e-6"),
        catalog_line(at, at, at, "6.9999e-6"),
        catalog_line(at, at, at, ""),
        catalog_line(at, at, at, "NaN"),
        catalog_line(at, at, at, "7e-9"),
    ]
    path = tmp_path / "catalog.dat"
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_catalog_keeps_file_order_and_cuts(spark, catalog_file):
    raw = read_catalog(spark, catalog_file, with_ordinal=True)
    assert [r["ordinal"] for r in raw.collect()] == list(range(7))
    rows = normalise_catalog(rename_catalog(raw), end_ordinal=6).orderBy("ordinal").collect()
    # 0 peaks too early, 2 has no peak, 6 lies past the end; ordinals are those of the file
    assert [r["ordinal"] for r in rows] == [1, 3, 4, 5]
    assert rows[0]["xrsb_flux_peak"] == 7e-6 / 0.7
    assert [r["magnitude"] for r in rows] == ["M1.0", "C10.0", None, None]
    assert {r["instrument"] for r in rows} == {"GOES-15"}
    assert {r["source"] for r in rows} == {"SWPC"}
    assert rows[0]["altitude"] == 10.5 and rows[0]["integrated_flux"] is None
    assert rows[0]["event_peak"] == dt.datetime(1974, 1, 1, 12)


def test_catalog_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "other.dat"
    path.write_text(
        "more\tt-max\tt-inicio\tt-fin\tInstrumento\ttotal X-ray flux\taltitud\tazimuth\n"
        "x\t1980-01-01 00:10:00\t1980-01-01 00:00:00\t1980-01-01 00:20:00\tG1\tNA\t1.5\t2.5\n"
    )
    row = normalise_catalog(rename_catalog(read_catalog(spark, str(path), with_ordinal=True))).first()
    assert row["event_start"] == dt.datetime(1980, 1, 1) and row["altitude"] == 1.5
    assert row["instrument"] == "G1" and row["xrsb_flux_peak"] is None


def test_catalog_can_be_cut_by_time(spark, catalog_file):
    renamed = rename_catalog(read_catalog(spark, catalog_file))
    rows = normalise_catalog(renamed, end_ordinal=None, end_time="1975-01-01 00:00:00")
    assert rows.count() == 1


def test_ordinals_over_many_splits(spark, tmp_path):
    n = 20_000
    lines = [catalog_line("1980-01-01 00:00:00", f"{1980 + i % 7}-01-01 00:00:00", "x", f"{i}e-9") for i in range(n)]
    path = tmp_path / "big.dat"
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        raw = read_catalog(spark, str(path), with_ordinal=True)
        assert raw.rdd.getNumPartitions() > 3
        wrong = raw.filter(F.round(F.col("total X-ray flux") * 1e9) != F.col("ordinal"))
        assert raw.count() == n and wrong.isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


S, P, E, X = "EVENT_START", "EVENT_PEAK", "EVENT_END", "POST_EVENT"
#        id   status time   flux  integrated class
STATUS = [
    (1, S, 10.9, 1e-7, 0.0, "B1.0"), (1, P, 20.2, 5.7e-6, 0.1, "C5.7"), (1, E, 30.0, 1e-6, 0.2, "C1.0"), (1, X, 40.0, 1e-7, 0.3, "B1.0"),
    (2, S, 50.0, 1e-7, 0.0, "B1.0"), (2, P, 60.0, 1e-5, 0.1, "M1.0"), (2, E, 70.0, 1e-6, float("nan"), "C1.0"),
    (3, S, 80.0, 1e-7, 0.0, "B1.0"), (3, P, 90.0, 1e-5, 0.1, "M1.0"),
    (4, S, 80.0, 1e-7, 0.0, "B1.0"), (4, P, 90.0, 1e-5, 0.1, "M1.0"), (4, X, 95.0, 1e-5, 0.1, "M1.0"),
    (5, S, 100.0, 1e-7, 0.0, "B1.0"), (5, P, 110.0, 2e-5, 0.1, "M2.0"), (5, P, 105.0, 3e-5, 0.1, "M3.0"), (5, E, 120.0, 1e-6, 0.5, "C1.0"),
    (None, S, 1.0, 1e-7, 0.0, "B1.0"), (None, P, 2.0, 1e-5, 0.1, "M1.0"), (None, E, 3.0, 1e-6, 0.2, "C1.0"),
    (6, S, 200.0, None, 0.0, "B1.0"), (6, P, 210.0, None, 0.1, "M1.0"), (6, E, 220.0, 1e-6, 0.2, "C1.0"),
]
STATUS_DDL = "flare_id long, status string, time double, xrsb_flux double, integrated_flux double, flare_class string, pos long"


@pytest.fixture()
def status(spark):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(STATUS)], STATUS_DDL)


BASE = dt.datetime(2000, 1, 1, 12)


def test_collapse(spark, status):
    rows = {r["event_id"]: r for r in collapse_events(status).collect()}
    assert sorted(rows) == [1, 2, 5, 6]  # 3 is too small, 4 has no end, one has no id
    one = rows[1]
    assert one["event_start"] == BASE + dt.timedelta(seconds=10)
    assert one["event_peak"] == BASE + dt.timedelta(seconds=20)
    assert one["event_end"] == BASE + dt.timedelta(seconds=30)
    assert (one["magnitude"], one["xrsb_flux_peak"], one["integrated_flux"]) == ("C5.7", 5.7e-6, 0.2)
    assert rows[2]["integrated_flux"] != rows[2]["integrated_flux"]  # NaN is accepted here
    assert rows[5]["magnitude"] == "M2.0" and rows[5]["xrsb_flux_peak"] == 2e-5
    assert rows[6]["xrsb_flux_peak"] is None


def test_collapse_does_not_depend_on_row_order(spark, status):
    key = lambda df: sorted(str(r) for r in df.collect())
    assert key(collapse_events(status.repartition(7, "time"))) == key(collapse_events(status))


def test_counters(spark, status):
    assert collapse_counters(status).first().asDict() == {"detected": 7, "processed": 4, "discarded": 3}


def test_arrays_become_rows(spark, tmp_path):
    columns = list(zip(*STATUS))
    names = ["flare_id", "status", "time", "xrsb_flux", "integrated_flux", "flare_class"]
    record = {n: list(c) for n, c in zip(names, columns)}
    record["flare_class"] = [list(c) for c in record["flare_class"]]
    record["integrated_flux"] = [None if x != x else x for x in record["integrated_flux"]]
    (tmp_path / "one.json").write_text(json.dumps(record))
    element = {"flare_id": "bigint", "status": "string", "flare_class": "array<string>"}
    schema = T._parse_datatype_string(
        ", ".join(f"{n} array<{element.get(n, 'double')}>" for n in names)
    )
    rows = read_status_rows(
        spark, str(tmp_path), "json", fills={"integrated_flux": -9999.0}, schema=schema, multiLine=True
    )
    assert rows.count() == len(STATUS)
    events = {r["event_id"]: r for r in collapse_events(rows, StatusColumns(by=("file",))).collect()}
    assert sorted(events) == [1, 2, 5, 6]
    assert events[1]["magnitude"] == "C5.7" and events[1]["file"].endswith("/one.json")
    assert events[2]["integrated_flux"] == -9999.0


def test_sunspots(spark, tmp_path):
    lines = [
        "# comment", "", "1818;01;01;1818.001;  -1; -1.0;   0;1", "1818;01;08;1818.021;  65; 10.2;   1;1",
        "1818;01;09;1818.023;  65.5; 10.2;   1;1", "1818;02;30;1818.1;  10; 1.0; 1;1", "1818;01;10",
        "1818;xx;10;1818.1; 10; 1.0; 1;1", "1818;01;11;1818.1; many; 1.0; 1;1",
        "1818;01;08;1818.021;  70; 10.2;   1;1",
    ]
    path = tmp_path / "sunspots.csv"
    path.write_text("\n".join(lines) + "\n")
    rows = feeds.read_sunspots(spark, str(path)).orderBy("seq").collect()
    assert [(r["date"], r["sunspot_number"], r["source"]) for r in rows] == [
        (dt.date(1818, 1, 8), 65, "SILSO"),
        (dt.date(1818, 1, 9), 66, "SILSO"),
        (dt.date(1818, 1, 8), 70, "SILSO"),
    ]


def test_f10_7(spark, tmp_path):
    records = [
        {"time_tag": "2024-05-01T20:00:00", "flux": 150.5}, {"time_tag": "", "flux": 1.0}, {"flux": 2.0},
        {"time_tag": "2024-05-02T20:00:00", "flux": None}, {"time_tag": "2024-05-03", "flux": "151"},
        {"time_tag": "soon", "flux": 3.0}, {"time_tag": "2024-05-04T20:00:00", "flux": "high"},
    ]
    path = tmp_path / "f107.json"
    path.write_text(json.dumps(records))
    rows = feeds.read_f10_7(spark, str(path)).orderBy("date").collect()
    assert [(r["date"].day, r["f10_7_flux"]) for r in rows] == [(1, 150.5), (3, 151.0)]


def test_kp_is_averaged_before_the_step(spark, tmp_path):
    tags = [f"2024-05-01T{h:02d}:00:00" for h in range(0, 24, 3)]
    day_one = [2.0, 2.33, 2.67, 3.0, 1.0, 1.33, 1.67, 2.0]
    records = [{"time_tag": t, "Kp": k} for t, k in zip(tags, day_one)]
    records += [{"time_tag": "2024-05-02T00:00:00", "Kp": 0.449}, {"time_tag": "2024-05-02T03:00:00", "Kp": 0.455}]
    records += [{"time_tag": "2024-05-03T00:00:00", "Kp": None}, {"time_tag": None, "Kp": 3.0}]
    records += [{"time_tag": "2024-05-04T00:00:00", "Kp": "9.2"}]
    path = tmp_path / "kp.json"
    path.write_text(json.dumps(records))
    rows = {r["date"].day: r for r in feeds.read_kp(spark, str(path)).collect()}
    assert sorted(rows) == [1, 2, 4]
    assert (rows[1]["kp_index"], rows[1]["ap_index"]) == (2.0, 7)
    # 0.452 rounds to 0.45, which would be step 0.3; the step is taken before rounding
    assert (rows[2]["kp_index"], rows[2]["ap_index"]) == (0.45, 3)
    assert rows[4]["ap_index"] == 400


def event(**changes):
    base = {
        "satellite": 18, "begin_time": "2024-05-08T21:08:00Z", "max_time": "2024-05-08T21:40:00Z",
        "end_time": "2024-05-08T22:00:00Z", "max_class": "X1.0", "current_class": "C2.0",
        "max_xrlong": 1.5e-5, "current_int_xrlong": 2.5e-5,
    }
    return {**base, **changes}


def documents(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc int, value string")


def test_documents_of_every_shape(spark):
    good = json.dumps([event()])
    docs = documents(
        spark, good, good[:-1], json.dumps([event(), event(satellite=16)]), "[]",
        json.dumps(event()), "garbage", f"  {good}\n", "", "[", None,
    )
    every = latest_events(docs, keep=("doc",)).collect()
    assert sorted((r["doc"], r["element"], r["satellite"]) for r in every) == [
        (0, 0, "18"), (1, 0, "18"), (2, 0, "18"), (2, 1, "16"), (6, 0, "18"),
    ]
    first = latest_events(docs, mode="latest", keep=("doc",)).collect()
    assert sorted(r["doc"] for r in first) == [0, 1, 2, 6]
    legacy = latest_events(documents(spark, good, "x"), mode="legacy", keep=("doc",)).collect()
    assert [(r["doc"], r["max_class"]) for r in legacy] == [(0, "X1.0")]
    with pytest.raises(ValueError):
        latest_events(docs, mode="other")


def test_refused_documents_are_rows_with_a_reason(spark):
    good = json.dumps([event()])
    docs = documents(
        spark, good, good[:-1], "[]", json.dumps(event()), "garbage", "", "[", None, good + " x", "[null, 3]", f"[null,{good[1:]}",
    )
    for mode in ("all", "latest"):
        rows = latest_events(docs, mode=mode, keep=("doc",), refused=True)
        refused = {r["doc"]: r["reject_hint"] for r in rows.filter("element IS NULL").collect()}
        no_array, no_event, empty, no_json = ("document " + x for x in ("is no array", "has no event", "is empty", "is no JSON"))
        assert refused == {
            2: no_event, 3: no_array, 4: no_array, 5: empty, 6: no_event, 7: empty, 8: no_json, 9: no_json,
        }
        counted = count_documents(rows, "doc").first()
        assert counted["landed"] == 11 == counted["good"] + counted["refused"] and counted["refused"] == 8
        events = rows.filter("reject_hint IS NULL").drop("reject_hint")
        assert sorted(events.collect()) == sorted(latest_events(docs, mode=mode, keep=("doc",)).collect())
    assert rows.filter("reject_hint = 'element is no object'").count() == 1
    legacy = latest_events(documents(spark, good, "x", None), mode="legacy", keep=("doc",), refused=True)
    assert {r["doc"]: r["reject_hint"] for r in legacy.collect()} == {0: None, 1: no_json, 2: empty}


def test_whole_documents_are_read(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([event()], indent=1)[:-1])
    assert latest_events(read_documents(spark, str(tmp_path))).count() == 1


def test_mapping_to_the_event_table(spark):
    rows = [
        event(), event(max_time="Unk"), event(max_time=""), event(max_time=None), event(end_time="Unk"),
        event(max_class="", max_xrlong=0.0), event(max_class=None, current_class=None, satellite=None),
    ]
    docs = documents(spark, json.dumps(rows))
    out = normalise_latest(latest_events(docs), keep=("element",)).orderBy("element").collect()
    assert [r["element"] for r in out] == [0, 5, 6]
    a, b, c = out
    assert a["event_start"] == dt.datetime(2024, 5, 8, 21, 8)
    assert (a["magnitude"], a["instrument"], a["source"]) == ("X1.0", "G18", "JSON")
    assert a["xrsb_flux_peak"] is None and a["integrated_flux"] is None
    assert json.loads(a["metadata"])["xrslong_flux"] == 1.5e-5
    assert b["magnitude"] == "C2.0" and json.loads(b["metadata"])["xrslong_flux"] == 2.5e-5
    assert c["magnitude"] == "" and c["instrument"] == "GNone"
    assert -90 <= a["altitude"] <= 90 and 0 <= a["azimuth"] < 360


def test_legacy_mapping(spark):
    docs = documents(spark, json.dumps([event(max_class="M5.25")]))
    row = normalise_legacy(latest_events(docs, mode="legacy")).first()
    assert (row["classification"], row["sub_classification"]) == ("M", 5.25)
    assert row["observation_instrument"] == "G18" and row["total_energy"] == 0.0


def test_completeness(spark):
    rows = [("a", "b"), ("Unk", "b"), ("a", ""), (None, "b"), ("a", None)]
    df = spark.createDataFrame(rows, "max_time string, end_time string")
    assert [r[0] for r in df.select(is_complete()).collect()] == [True, False, False, False, False]


def test_listing(spark, tmp_path):
    names = ["sci_xrsf-l2-flsum_g19_s2024_e1.nc", "sci_xrsf-l2-flsum_g19_s2024_e2.nc", "sci_xrsf-l2-flsum_g16_e9.nc", "z.txt"]
    for n in names:
        (tmp_path / n).write_text("x")
    assert listing.newest_file(spark, str(tmp_path)).first()["file_name"] == names[1]
    assert listing.newest_file(spark, str(tmp_path), "none").first()["file_name"] is None
    listed = listing.list_files(spark, str(tmp_path), "*.nc")
    done = spark.createDataFrame([(names[0],), (names[2],)], "file_name string")
    assert [r["file_name"] for r in listing.unread_files(listed, done).collect()] == [names[1]]
    assert listing.unread_files(listed, done, refresh=True).count() == 3


def test_links_of_pages(spark):
    pages = spark.createDataFrame(
        [(1, '<a href="a.txt">a</a><a href="b.nc">b</a>'), (2, "<p>none</p>")], "page int, html string"
    )
    picked = listing.first_links(pages)
    assert [r["link"] for r in picked.orderBy("page").collect()] == ["b.nc", None]
    assert listing.missing_links(picked).first().asDict() == {"pages": 2, "missing": 1}
    assert listing.named_links(pages, "a.txt").filter("link IS NOT NULL").count() == 1


@pytest.mark.parametrize(
    "html, link",
    [
        ('<a title="a>b" href="x.nc">', "x.nc"),
        ('<a class="b"href="x.nc">', "x.nc"),
        ('<a/href="x.nc">', "x.nc"),
        ('<a title=" href=z.nc" href="x.nc">', "x.nc"),
        ('<a data-href="z.nc" href="x.nc">', "x.nc"),
        ('<a href="a&#47;b&#x2F;c.nc">', "a/b/c.nc"),
        ('<a href="a&amp;#47;b.nc">', "a&#47;b.nc"),
        ('<abbr href="z.nc">', None),
    ],
)
def test_links_as_a_parser_reads_them(spark, html, link):
    page = spark.createDataFrame([(html,)], "html string")
    assert first_links(page, ".nc").first()["link"] == link


@pytest.mark.parametrize("tail", [" x", "{]", "[{}]", ",[{}]", "]", ","])
def test_documents_with_anything_behind_the_array_are_refused(spark, tail):
    good = json.dumps([event()])
    documents = spark.createDataFrame([(good,), (good + tail,), (good.replace('"', "'"),)], "value string")
    assert latest_events(documents).count() == 1


@pytest.mark.parametrize(
    "text", ["2024/01/01 10:30", "20240101T103000Z", "01-Jan-2024 10:30", "Jan 1 2024 10:30", "2024-01-01T10:30:00Z", "2024-01-01 10:30"]
)
def test_times_in_other_formats(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_utc(F.col("t"))).first()[0] == dt.datetime(2024, 1, 1, 10, 30)


def test_ordinals_go_by_file_name(spark, tmp_path):
    at = "1980-01-01 00:00:00"
    for name, n in (("a.dat", 2), ("b.dat", 50)):
        lines = [catalog_line(at, at, at, f"{i}e-9").replace("GOES-15", name) for i in range(n)]
        (tmp_path / name).write_text("\n".join([HEADER, *lines]) + "\n")
    rows = read_catalog(spark, str(tmp_path), with_ordinal=True).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in rows] == list(range(52))
    assert [r["Instrumento"].strip() for r in rows] == ["a.dat"] * 2 + ["b.dat"] * 50


def test_rows_of_several_files_arrive_in_path_order(spark, tmp_path):
    """Equal places in two files: the first file's rows win, however they are scanned."""
    rows = [(*r, i) for i, r in enumerate(STATUS)]
    for name, shift in (("a", 0.0), ("b", 5.0)):
        df = spark.createDataFrame(rows, STATUS_DDL).withColumn("background_flux", F.lit(0.0))
        df.withColumn("time", F.col("time") + shift).coalesce(1).write.parquet(str(tmp_path / name))
    both = read_status_rows(spark, f"{tmp_path}/*")
    again = both.orderBy(F.desc("pos"))
    a, b = (sorted(map(tuple, collapse_events(x).drop("integrated_flux").collect())) for x in (both, again))
    assert a == b
    alone = read_status_rows(spark, str(tmp_path / "a"))
    peaks = lambda df: {r["event_id"]: r["event_peak"] for r in collapse_events(df).collect()}
    assert {k: v for k, v in peaks(both).items() if k in peaks(alone)} == peaks(alone)
