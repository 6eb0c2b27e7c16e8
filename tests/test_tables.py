"""Stored tables and the load pipelines."""

import datetime as dt
import json
import random
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from heliocat import commits
from heliocat.operators.normalise import rename_catalog
from heliocat.plans import loads
from heliocat.plans.queries import latest_flare
from heliocat.schemas import EVENTS, FLARES, OBSERVATIONS
from heliocat.sources.catalog import read_catalog
from heliocat.tables import InsertResult, KeyedTable, SnapshotTable, _last_of_each, observation_table, write_csv
from test_operators import observation
from test_sources import HEADER, STATUS, STATUS_DDL, catalog_line, event


def events(spark, *rows):
    """(start, instrument, magnitude) rows as a batch with arrival order."""
    full = [
        (s, s, s, m, 1e-6, float("nan"), i, 1.0, 2.0, "GOES-16", None, n) for n, (s, i, m) in enumerate(rows)
    ]
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENTS.fields)
    return spark.createDataFrame(full, f"{names}, seq long")


@pytest.fixture()
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "flares"), rejects_path=str(tmp_path / "rejects")).create()


def test_empty_table_reads(table):
    assert table.read().isEmpty() and table.read().schema.names == FLARES.names


@pytest.mark.parametrize("small", [0, 100])
def test_insert_and_insert_again(spark, table, small):
    table.small_batch_rows = small
    start = dt.datetime(2024, 1, 1)
    batch = events(spark, (start, "a", "C1.0"), (start, "a", "C2.0"), (start, None, "C3.0"), (start, None, "C4.0"))
    first = table.insert_ignore(batch)
    assert first == InsertResult(4, 3, 0, held=0, repeated=1)
    rows = table.read().collect()
    assert sorted(r["magnitude"] for r in rows) == ["C1.0", "C3.0", "C4.0"]
    assert all(r["integrated_flux"] is None for r in rows)  # NaN is stored as null
    assert len({r["id"] for r in rows}) == 3 and all(r["created_at"] for r in rows)
    # rows without an instrument never collide, so they come again
    assert table.insert_ignore(batch) == InsertResult(4, 2, 0, held=1, repeated=1)
    assert len({r["id"] for r in table.read().collect()}) == 5
    # unless the insert has a name: then it is known again
    named = table.insert_ignore(batch, batch_name="feed 7")
    assert named.inserted == 2 and table.insert_ignore(batch, batch_name="feed 7") == named
    assert table.read().count() == 7
    assert table.insert_ignore(batch, batch_name="feed 70").inserted == 2
    assert table.read().count() == 9 == len({r["id"] for r in table.read().collect()})


def test_rows_without_a_whole_key_all_stay(spark, tmp_path):
    """Two rows of one time without an instrument and with one order value, beside two others."""
    start = dt.datetime(2024, 1, 1)
    rows = events(spark, (start, None, "C1.0"), (start, None, "C2.0"), (start, "a", "C3.0"), (start, "an instrument", "C4.0"))
    rows = rows.withColumn("seq", F.lit(1))
    once = KeyedTable(spark, str(tmp_path / "once")).create()
    assert once.insert_ignore(rows) == InsertResult(4, 3, 1)
    cut = KeyedTable(spark, str(tmp_path / "cut")).create()
    results = [cut.insert_ignore(rows.filter(F.col("magnitude") == f"C{i}.0")) for i in (1, 2, 3, 4)]
    assert sum(r.inserted for r in results) == 3 and sum(r.rejected for r in results) == 1
    for table in (once, cut):
        assert sorted(r["magnitude"] for r in table.read().collect()) == ["C1.0", "C2.0", "C3.0"]
        assert len({r["id"] for r in table.read().collect()}) == 3
    assert once.fresh(rows).count() == 2  # equal rows of one batch as well
    assert once.insert_ignore(rows.unionByName(rows)).inserted == 4


def account(result):
    return result.read == result.inserted + result.held + result.repeated + result.rejected


def test_counts_add_up_also_after_a_replay(spark, table):
    start = dt.datetime(2024, 1, 1)
    held = events(spark, (start, "a", "C1.0"))
    table.insert_ignore(held)
    batch = events(
        spark, (start, "a", "C2.0"), (start, "a", "C3.0"), (start, "b", "C4.0"), (start, "b", "C5.0"),
        (start, "b", "C6.0"), (start, None, "C7.0"), (start, "an instrument", "C8.0"),
    )
    dry = table.count_fresh(batch)
    assert dry == InsertResult(read=7, inserted=2, rejected=1, held=1, repeated=3) and account(dry)
    assert table.insert_ignore(batch, batch_name="x") == dry
    assert table.insert_ignore(batch, batch_name="x") == dry  # the counts of the first
    assert table.read_rejects().count() == 1 and table.read().count() == 3


def test_a_killed_insert_is_never_seen_and_adds_once_when_run_again(spark, table, monkeypatch):
    batch = events(spark, (dt.datetime(2024, 1, 1), None, "C1.0"), (dt.datetime(2024, 1, 2), "an instrument", "C1.0"))
    publish = table._log.publish

    def killed(before, entry):
        raise RuntimeError("killed")

    monkeypatch.setattr(table._log, "publish", killed)
    with pytest.raises(RuntimeError):
        table.insert_ignore(batch, batch_name="b")
    assert table.read().isEmpty() and table.read_rejects().isEmpty()
    monkeypatch.setattr(table._log, "publish", publish)
    assert table.insert_ignore(batch, batch_name="b") == InsertResult(2, 1, 1)
    assert table.read().count() == 1 and table.read_rejects().count() == 1


@pytest.mark.parametrize("id_mode", ["hash", "dense"])
def test_two_writers_leave_each_key_once(spark, tmp_path, id_mode):
    """Four writers insert overlapping batches at once, each through a table object of its own."""
    path = str(tmp_path / "shared")
    KeyedTable(spark, path, id_mode=id_mode).create()
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    batches = [
        events(spark, *[(day(n), "a", f"C{w}.0") for n in range(w * 5, w * 5 + 20)], (day(0), None, f"C{w}.0"))
        for w in range(4)
    ]
    gate = threading.Barrier(4)

    def write(batch):
        gate.wait()
        return KeyedTable(spark, path, id_mode=id_mode).insert_ignore(batch)

    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(write, batches))
    rows = KeyedTable(spark, path).read().collect()
    keyed = [r["event_start"] for r in rows if r["instrument"]]
    assert len(keyed) == len(set(keyed)) == 35 and len(rows) == 39 == sum(r.inserted for r in results)
    assert len({r["id"] for r in rows}) == 39
    assert all(account(r) for r in results)
    if id_mode == "dense":
        assert sorted(r["id"] for r in rows) == list(range(1, 40))


def test_a_late_writer_leaves_out_what_the_other_added(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "shared")
    one, two = (KeyedTable(spark, path).create() for _ in range(2))
    start = dt.datetime(2024, 1, 1)
    publish = one._log.publish

    def late(before, entry):
        monkeypatch.setattr(one._log, "publish", publish)
        two.insert_ignore(events(spark, (start, "a", "C9.0"), (start, "z", "C9.0")))
        return publish(before, entry)

    monkeypatch.setattr(one._log, "publish", late)
    found = one.insert_ignore(events(spark, (start, "a", "C1.0"), (start, "b", "C1.0"), (start, None, "C1.0")))
    assert found == InsertResult(3, 2, 0, held=1)
    rows = sorted((r["instrument"] or "", r["magnitude"]) for r in two.read().collect())
    assert rows == [("", "C1.0"), ("a", "C9.0"), ("b", "C1.0"), ("z", "C9.0")]


def test_names_of_inserts_are_kept():
    names = {"c 1": {}, "c 12": {}, "c 9": {}, "other": {}, "d 3": {}}
    assert set(_last_of_each(names)) == {"c 12", "other", "d 3"}


def test_many_commits_and_a_merge_of_small_parts(spark, table, monkeypatch):
    monkeypatch.setattr(commits, "WHOLE_EVERY", 3)
    for n in range(7):
        table.insert_ignore(events(spark, (dt.datetime(2020 + n, 1, 1), "a", "C1.0"), (dt.datetime(2020, 1, 1), None, "C1.0")), batch_name=f"poll {n}")
    before = sorted(map(tuple, table.read().collect()), key=str)
    old = table.read()
    assert len(before) == 14 and table.compact() == 7
    fresh = KeyedTable(spark, table.path)
    assert sorted(map(tuple, fresh.read().collect()), key=str) == before
    assert len(old.inputFiles()) > len(fresh.read().inputFiles()) and old.count() == 14  # older readers go on
    assert fresh.insert_ignore(events(spark, (dt.datetime(2030, 1, 1), None, "C1.0")), batch_name="poll 6").inserted == 2  # the first's
    assert fresh.read().count() == 14
    assert table.compact() == 0


def test_pages_read_the_files_around_them(spark, tmp_path):
    """Twenty inserts of overlapping times; pages equal the sorted list and open few files."""
    table = KeyedTable(spark, str(tmp_path / "flares"), slice_rows=10).create()
    rng = random.Random(3)
    for n in range(8):
        base = dt.datetime(2001 + n, 1, 1)
        rows = [(base + dt.timedelta(hours=rng.randrange(9500)), f"i{n}{k}", "C1.0") for k in range(60)]
        table.insert_ignore(events(spark, *rows))
    every = table.read().orderBy(F.desc("event_start"), F.desc("id")).collect()
    files = len(table.read().inputFiles())
    assert files >= 40
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for page, size in ((1, 5), (2, 7), (30, 9), (48, 10), (49, 10), (200, 3)):
            spark.conf.set("spark.sql.session.timeZone", "America/New_York" if page % 2 else zone)
            found = table.read_page(page, size)
            starts = lambda rows: [(r["event_start"], r["id"]) for r in rows]
            assert starts(found.collect()) == starts(every[(page - 1) * size : page * size])
            assert len(found.inputFiles()) <= files // 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert latest_flare(table.read_newest()).collect() == every[:1]


def test_rows_that_do_not_fit_are_kept_apart(spark, table):
    start = dt.datetime(2024, 1, 1, 0, 0, 0, 600000)
    batch = events(spark, (start, "a", "C1.0"), (start, "an instrument", "C1.0"), (start, "b", "C12345678"))
    batch = batch.union(batch.filter("seq = 0").withColumn("event_peak", F.lit(None).cast("timestamp_ntz")))
    assert table.count_fresh(batch) == InsertResult(4, 1, 3)
    assert table.insert_ignore(batch) == InsertResult(4, 1, 3)
    reasons = {r["reject_reason"] for r in table.read_rejects().collect()}
    assert reasons == {
        "instrument is longer than 10", "magnitude is longer than 8", "event_peak is null",
    }
    assert table.read().first()["event_start"] == dt.datetime(2024, 1, 1, 0, 0, 1)


def test_dry_run_writes_nothing(spark, table):
    batch = events(spark, (dt.datetime(2024, 1, 1), "a", "C1.0"), (dt.datetime(2024, 1, 1), "a", "C2.0"))
    assert table.fresh(batch).count() == 1
    assert table.read().isEmpty()


def test_year_folders_are_skipped(spark, table):
    table.insert_ignore(events(spark, *[(dt.datetime(y, 6, 1), "a", "C1.0") for y in range(2000, 2010)]))
    some = table.read("2003-01-01", "2004-12-31")
    assert some.count() == 2
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_start_year" in plan
    assert "GreaterThanOrEqual(event_start,2003-01-01" in plan


def test_files_are_sorted_and_few(spark, table):
    starts = [dt.datetime(2000 + i % 3, 1, 1) + dt.timedelta(hours=(i * 7919) % 8000) for i in range(3000)]
    table.insert_ignore(events(spark, *[(s, "a", "C1.0") for s in starts]).repartition(7))
    rows = table.read().select("event_start", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("i"))
    by_file = {}
    for r in rows.orderBy("file", "i").collect():
        by_file.setdefault(r["file"], []).append(r["event_start"])
    assert len(by_file) == 3
    assert all(times == sorted(times) for times in by_file.values())


def test_newest_files_alone_give_the_latest(spark, table):
    assert table.read_newest().isEmpty()
    table.insert_ignore(events(spark, *[(dt.datetime(y, 6, 1), "a", "C1.0") for y in range(2000, 2010)]))
    newest = table.read_newest()
    assert [r["event_start"].year for r in latest_flare(newest).collect()] == [2009]
    assert newest.count() == 1


def test_links_to_fetch(spark):
    pages = spark.createDataFrame([('<a href="a.nc">',), ('<a href="b.nc">',), ("none",)], "html string")
    held = spark.createDataFrame([("a.nc",)], "file_name string")
    assert [r["file_name"] for r in loads.links_to_fetch(pages, held).collect()] == ["b.nc"]
    assert loads.links_to_fetch(pages, held, refresh=True).count() == 2


def test_ids_go_on_from_the_table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "flares"), id_mode="dense").create()
    table.insert_ignore(events(spark, *[(dt.datetime(2024, 1, d), "a", "C1.0") for d in range(1, 6)]))
    table.insert_ignore(events(spark, *[(dt.datetime(2024, 1, d), "a", "C1.0") for d in range(4, 9)]))
    assert sorted(r["id"] for r in table.read().collect()) == list(range(1, 9))


def test_older_table_is_keyed_by_start(spark, tmp_path):
    table = observation_table(spark, str(tmp_path / "observations")).create()
    rows = [observation(1, dt.datetime(2021, 1, 1)), observation(2, dt.datetime(2021, 1, 1), "G16")]
    batch = spark.createDataFrame(rows, OBSERVATIONS).withColumn("seq", F.col("id"))
    assert table.insert_ignore(batch).inserted == 1
    assert table.read().first()["observation_instrument"] == "G15"


def test_older_path(spark, tmp_path):
    table = observation_table(spark, str(tmp_path / "observations")).create()
    texts = [json.dumps([e]) for e in (event(max_class="M5.2"), event(satellite=16), event(max_time="Unk"))] + ["none"]
    documents = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, seq long")
    assert loads.store_legacy(table, documents) == InsertResult(3, 1, 1, repeated=1)
    assert table.read_rejects().first()["reject_reason"] == "document is no JSON"
    assert loads.store_legacy(table, documents).inserted == 0
    row = table.read().first()
    assert (row["classification"], row["observation_instrument"], row["total_energy"]) == ("M", "G18", 0.0)


def test_migration_into_a_table(spark, table):
    rows = [observation(i, dt.datetime(2021, 1, i)) for i in (1, 2, 3)]
    old = spark.createDataFrame(rows + [observation(4, dt.datetime(2021, 1, 1))], OBSERVATIONS)
    assert loads.migrate(table, old) == 3
    assert loads.migrate(table, old) == 3


def test_history(spark, table, tmp_path):
    catalog = tmp_path / "catalog.dat"
    t = ["2016-01-01 00:00:00", "2016-01-01 00:10:00", "2016-01-01 00:20:00"]
    lines = [catalog_line(*t, "7e-6"), catalog_line(*t, "8e-6"), catalog_line(t[0], "no time", t[2], "8e-6")]
    catalog.write_text("\n".join([HEADER, *lines]) + "\n")
    rows = spark.createDataFrame([(*r, i) for i, r in enumerate(STATUS)], STATUS_DDL)
    rows = rows.withColumn("background_flux", F.lit(0.0))
    middle, last = str(tmp_path / "middle"), str(tmp_path / "last")
    rows.withColumn("time", F.col("time") + 6e8).write.parquet(middle)
    rows.withColumn("time", F.col("time") + 8e8).write.parquet(last)
    args = (spark, table, str(catalog), middle, last)
    assert loads.load_history(*args, dry_run=True) == InsertResult(11, 9, 1, repeated=1)
    assert table.read().isEmpty()
    assert loads.load_history(*args) == InsertResult(11, 9, 1, repeated=1)  # 1 + 4 + 4
    assert table.read_rejects().first()["reject_reason"] == "event_peak is no time"
    assert loads.load_history(*args).inserted == 0
    counts = {r["source"]: r["count"] for r in table.read().groupBy("source").count().collect()}
    assert counts == {"SWPC": 1, "GOES-16": 4, "GOES-19": 4}
    new = rows.withColumn("time", F.col("time") + 8.1e8)
    assert loads.sync_status_rows(table, spark.read.parquet(last)).inserted == 0
    assert loads.sync_status_rows(table, new).inserted == 4
    write_csv(table.read(), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == table.read().count()


def test_rows_that_the_eras_cut_are_counted(spark, tmp_path):
    """Cut rows and offered ones are all rows of the sources; the offered are what an insert reads."""
    peaks = [None, "1973-12-31 00:00:00", "1974-01-01 12:00:00", "2016-01-01 00:00:00", "no time", "2016-01-02 00:00:00"]
    lines = [catalog_line("2016-01-01 00:00:00", p or "", "2016-01-01 01:00:00", "7e-6") for p in peaks]
    (tmp_path / "catalog.dat").write_text("\n".join([HEADER, *lines]) + "\n")
    raw = read_catalog(spark, str(tmp_path / "catalog.dat"), with_ordinal=True)
    rows = spark.createDataFrame([(*r, i) for i, r in enumerate(STATUS)], STATUS_DDL).withColumn("background_flux", F.lit(0.0))
    middle = rows.withColumn("time", F.col("time") + 6e8).unionByName(
        rows.withColumns({"time": F.col("time") + 9e8, "flare_id": F.col("flare_id") + 10**6})
    )
    last = rows.withColumn("time", F.col("time") + 8e8)
    events = loads.array_events(middle, "GOES-16"), loads.array_events(last, "GOES-19")
    found = loads.history_accounts(rename_catalog(raw), *events, end_ordinal=5)
    counts = {(r["source"], r["fate"]): r["events"] for r in found.collect()}
    assert counts == {
        ("SWPC", "without a peak"): 1, ("SWPC", "before the catalog"): 1, ("SWPC", "behind the catalog"): 1,
        ("SWPC", "offered"): 3, ("GOES-16", "offered"): 4, ("GOES-16", "in the last era"): 4, ("GOES-19", "offered"): 4,
    }
    table = KeyedTable(spark, str(tmp_path / "flares")).create()
    read = table.count_fresh(loads.unified_catalog(raw, middle, last, 5), loads.ARRIVAL).read
    assert read == sum(n for (_, fate), n in counts.items() if fate == "offered")


def test_lookup_feeds_in_turn(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "indices")).create()
    assert table.version() == 0 and table.read().isEmpty()
    sunspots, f107, kp = (str(tmp_path / n) for n in ("s.csv", "f.json", "k.json"))
    open(sunspots, "w").write("2024;05;01;2024.3; 100; 1; 1;1\n2024;05;02;2024.3; 110; 1; 1;1\n")
    json.dump([{"time_tag": "2024-05-02T20:00:00", "flux": 150.0}], open(f107, "w"))
    json.dump([{"time_tag": "2024-05-03T00:00:00", "Kp": 2.0}], open(kp, "w"))
    assert loads.load_indices(spark, table, sunspots, f107, kp) == 1
    rows = {r["date"].day: r for r in table.read().collect()}
    assert (rows[2]["sunspot_number"], rows[2]["f10_7_flux"], rows[2]["source"]) == (110, 150.0, "SILSO")
    assert rows[3]["kp_index"] == 2.0 and rows[3]["source"] is None
    open(sunspots, "a").write("2024;05;03;2024.3; 120; 1; 1;1\n")
    assert loads.load_indices(spark, table, sunspots) == 2
    row = {r["date"].day: r for r in table.read().collect()}[3]
    assert row["sunspot_number"] == 120 and row["source"] is None and row["kp_index"] == 2.0
    assert table.read(version=1).filter("sunspot_number IS NULL").count() == 1  # older commits stay readable
    assert table.version() == 2 and table.read().count() == 3


def test_lookup_changes_leave_other_years_alone(spark, tmp_path):
    """All feeds in one merge give what they give in turn; files of other years keep their names."""
    ddl = "date date, {}, seq int"
    d = lambda y, m, day: dt.date(y, m, day)
    spots = spark.createDataFrame([(d(2022, 1, 1), 10, "S", 1), (d(2023, 1, 1), 11, "S", 2), (d(2023, 1, 1), 12, "T", 3)], ddl.format("sunspot_number int, source string"))
    flux = spark.createDataFrame([(d(2023, 1, 1), 1.5, 1), (d(2024, 5, 1), 2.5, 2)], ddl.format("f10_7_flux double"))
    kp = spark.createDataFrame([(d(2024, 5, 1), 3.0, 9, 0), (d(2022, 1, 1), 4.0, 9, 0)], ddl.format("kp_index double, ap_index int"))
    feeds = [(spots, ["sunspot_number"], ["source"]), (flux, ["f10_7_flux"], []), (kp, ["kp_index", "ap_index"], [])]
    feeds.append((spots.withColumn("date", F.make_date(F.lit(2024), F.lit(5), F.lit(1))), ["sunspot_number"], ["source"]))
    one, turns = (SnapshotTable(spark, str(tmp_path / n)).create() for n in ("one", "turns"))
    assert one.upsert_all(feeds) == 1
    for feed in feeds:
        turns.upsert(*feed)
    rows = lambda t: sorted(tuple(r)[:-1] for r in t.read().collect())
    assert rows(one) == rows(turns) and len(rows(one)) == 3
    assert rows(one)[2] == (d(2024, 5, 1), 12, 2.5, 3.0, 9, None)  # the flux feed came first, so no source
    stamps = {r["date"]: r["created_at"] for r in one.read().collect()}
    before = set(one.read().inputFiles())
    one.upsert(spots.filter("seq = 1").withColumn("sunspot_number", F.lit(99)), ["sunspot_number"], ["source"])
    after = set(one.read().inputFiles())
    assert {f for f in before - after if "year=2022" not in f} == set() and len(after & before) == 2
    assert {r["date"]: r["created_at"] for r in one.read().collect()} == stamps
    assert one.read(version=1).filter("date = '2022-01-01'").first()["sunspot_number"] == 10


def test_two_writers_of_the_lookup(spark, tmp_path):
    path = str(tmp_path / "indices")
    SnapshotTable(spark, path).create()
    day = lambda w, column, kind: (
        spark.createDataFrame([(dt.date(2024, 5, i), w * 10 + i, 0) for i in range(1, 9)], f"date date, {column} {kind}, seq int"), [column], []
    )
    feeds = [day(1, "sunspot_number", "int"), day(2, "ap_index", "int")]
    with ThreadPoolExecutor(2) as pool:
        versions = list(pool.map(lambda f: SnapshotTable(spark, path).upsert(*f), feeds))
    assert sorted(versions) == [1, 2]
    rows = SnapshotTable(spark, path).read().collect()
    assert sorted((r["date"].day, r["sunspot_number"], r["ap_index"]) for r in rows) == [(i, 10 + i, 20 + i) for i in range(1, 9)]
