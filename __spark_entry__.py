"""Registered queries over the driver's tables, and the SQL they are checked against."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from heliocat import adapters as ad  # noqa: E402
from heliocat.commits import Files  # noqa: E402
from heliocat.constants import KP_AP_DEFAULT, KP_AP_STEPS, KP_STEP_MARGIN  # noqa: E402
from heliocat.functions.flux import class_letter, class_number, magnitude  # noqa: E402
from heliocat.functions.geomag import step_lookup  # noqa: E402
from heliocat.functions.numeric import round_half_up  # noqa: E402
from heliocat.functions.solar import add_sun_position  # noqa: E402
from heliocat.operators import collapse, eras, merge, normalise, predicates, statistics  # noqa: E402
from heliocat.operators.lookups import attach_indices  # noqa: E402
from heliocat.plans import loads, queries as q, series  # noqa: E402
from heliocat.schemas import FLARES_KEY, conform_events  # noqa: E402
from heliocat.session import shared_folder as _scratch  # noqa: E402
from heliocat.sources import feeds, listing  # noqa: E402
from heliocat.sources.catalog import read_catalog  # noqa: E402
from heliocat.sources.latest_event import count_documents, latest_events  # noqa: E402
from heliocat.sources.status_rows import arrays_to_rows, finish, read_status_rows  # noqa: E402
from heliocat.streaming.feeds import drop_repeats, insert_stream, poll_latest, sync_arrays  # noqa: E402
from heliocat.streaming.refresh import refresh_arrays  # noqa: E402
from heliocat.tables import KeyedTable, SnapshotTable, write_csv  # noqa: E402
from check_sql import ORACLE  # noqa: E402

try:
    import corpus_pipeline as _pipeline
    from heliocat.llm import queries as _llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "heliocat.llm", "heliocat.llm.queries"):
        raise
    _llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
LIST_FILTERS = {"date_from": "1996-01-01", "date_to": "1999-12-31T12:00:00", "class_": "X1"}
EVENT_ID = 77
CATALOG_CUT = "1975-06-01 00:00:00"


def _position(df: DataFrame) -> DataFrame:
    """Positions to six decimals, as two engines' sines may differ in the last bit."""
    return df.withColumns(
        {c: round_half_up(F.col(c), 6) for c in ("altitude", "azimuth")}
    )


def _flares(spark, d) -> DataFrame:
    return ad.flares(ad.table(spark, d, "orders"))


def _indices(spark, d) -> DataFrame:
    return ad.solar_indices(ad.table(spark, d, "lineitem"))


def _status_rows(spark, d) -> DataFrame:
    return ad.status_rows(ad.table(spark, d, "events"))


def collapse_events(spark, d):
    rows = finish(ad.with_class_chars(_status_rows(spark, d)))
    return _position(collapse.collapse_events(rows))


def collapse_counters(spark, d):
    return collapse.collapse_counters(_status_rows(spark, d))


def distinct_event_ids(spark, d):
    return collapse.distinct_ids(_status_rows(spark, d))


def classify_flux(spark, d):
    flux = F.col("xrsb_flux")
    return _status_rows(spark, d).select(
        "pos",
        class_letter(flux).alias("letter"),
        class_number(flux).alias("sub"),
        magnitude(flux).alias("magnitude"),
    )


def normalise_catalog(spark, d):
    raw = ad.catalog(ad.table(spark, d, "orders"))
    renamed = normalise.rename_catalog(raw)
    return normalise.normalise_catalog(renamed, end_time=CATALOG_CUT).select(
        "ordinal", "event_start", "event_peak", "event_end", "magnitude",
        "xrsb_flux_peak", "instrument", "source",
    )


def catalog_cut_counts(spark, d):
    """Rows before and behind the median ordinal, the position where another source takes over."""
    renamed = normalise.rename_catalog(ad.catalog(ad.table(spark, d, "orders")))
    middle = renamed.agg(F.expr("CAST(max(ordinal) DIV 2 AS BIGINT)")).first()[0]
    kept = normalise.normalise_catalog(renamed, end_ordinal=middle).agg(F.count("*").alias("kept"))
    every = normalise.normalise_catalog(renamed).agg(F.count("*").alias("every"))
    return kept.select("kept", (every.scalar() - F.col("kept")).alias("removed"))


def history_accounts(spark, d):
    """What becomes of the rows of three sources when they are united, by source and reason."""
    renamed = normalise.rename_catalog(ad.catalog(ad.table(spark, d, "orders")))
    middle = renamed.agg(F.expr("CAST(max(ordinal) DIV 2 AS BIGINT)")).first()[0]
    _, second, third = ad.eras(ad.table(spark, d, "orders"))
    return loads.history_accounts(renamed, second, third, end_ordinal=middle, last_start=ad.ERA_CUT)


def merge_eras(spark, d):
    parts = ad.eras(ad.table(spark, d, "orders"))
    return eras.merge_eras(*parts, last_start=ad.ERA_CUT).select(
        "id", "event_start", "magnitude", "instrument", "source", "source_rank"
    )


def era_bounds(spark, d):
    parts = ad.eras(ad.table(spark, d, "orders"))
    united = eras.merge_eras(*parts, last_start=ad.ERA_CUT)
    return eras.bounds(united, "source")


def era_trim_counts(spark, d):
    return eras.trim_counts(_flares(spark, d), ad.ERA_CUT)


def overlap_window(spark, d):
    window = predicates.open_window(_flares(spark, d), "event_start", "1999-06-01", "1999-12-30")
    return window.select("id", "event_start", "magnitude")


def list_flares_filtered(spark, d):
    return q.list_flares(_flares(spark, d), page=2, page_size=5, **LIST_FILTERS)


def list_flares_far_page(spark, d):
    return q.list_flares(_flares(spark, d), page=12, page_size=100)


def list_flares_deep_page(spark, d):
    """A page beyond what is sorted at once."""
    return q.list_flares(_flares(spark, d), page=9, page_size=1000)


def list_flares_total(spark, d):
    return q.count_flares(_flares(spark, d), instrument="1-URGENT", source="F", **LIST_FILTERS)


def list_flares_with_indices(spark, d):
    return q.list_flares(
        _flares(spark, d), page_size=1000, indices=_indices(spark, d), instrument="1-URGENT"
    )


def flares_with_indices(spark, d):
    return attach_indices(_flares(spark, d), _indices(spark, d)).select(
        "id", "event_start", "sunspot_number", "f10_7_flux", "kp_index", "ap_index"
    )


def flare_page(spark, d):
    page = q.flare_page(_flares(spark, d), page=3, page_size=10, class_="M")
    ids = F.transform("results", lambda r: r["id"].cast("string"))
    starts = F.transform("results", lambda r: r["event_start"])
    return page.select(
        "total", "page", "page_size",
        F.array_join(ids, ",").alias("ids"), F.array_join(starts, ",").alias("starts"),
    )


def response_rows(spark, d):
    return q.response_rows(_flares(spark, d))


def latest_flare(spark, d):
    return q.latest_flare(_flares(spark, d))


def flare_by_id(spark, d):
    return q.get_flare(_flares(spark, d), EVENT_ID, _indices(spark, d))


def stats_by_class(spark, d):
    return statistics.count_by_class(_flares(spark, d))


def stats_by_year(spark, d):
    return statistics.count_by_year(_flares(spark, d))


def stats_by_instrument(spark, d):
    return statistics.count_by_instrument(_flares(spark, d))


def stats_range(spark, d):
    return eras.bounds(_flares(spark, d))


def stats_all(spark, d):
    return statistics.stats_long(_flares(spark, d))


def stats_answer(spark, d):
    def text(name: str) -> Column:
        entries = F.transform(
            F.map_entries(name), lambda e: F.concat(e["key"], F.lit("="), e["value"])
        )
        return F.array_join(entries, ",").alias(name)

    return statistics.stats(_flares(spark, d)).select(
        "total_flares",
        text("by_class"),
        text("by_year"),
        text("by_instrument"),
        F.col("date_range.from").alias("range_from"),
        F.col("date_range.to").alias("range_to"),
    )


def list_indices(spark, d):
    return q.list_indices(_indices(spark, d), "1996-01-01", "2001-06-30")


def list_indices_second_page(spark, d):
    return q.list_indices(_indices(spark, d), "1996-01-01", "2001-06-30", page=2, page_size=900)


def daily_kp_ap(spark, d):
    return feeds.parse_kp(ad.kp_records(ad.table(spark, d, "events"))).drop("seq")


def ap_step_lookup(spark, d):
    steps = [(kp + KP_STEP_MARGIN, ap) for kp, ap in KP_AP_STEPS]
    kp = F.least(F.col("value") / 10.0, F.lit(10.0))
    return ad.table(spark, d, "events").select(
        "event_id", step_lookup(kp, steps, KP_AP_DEFAULT).alias("ap_index")
    )


def insert_ignore(spark, d):
    return merge.insert_ignore(*ad.existing_and_incoming(ad.table(spark, d, "events")))


def insert_ignore_start_only(spark, d):
    existing, incoming = ad.existing_and_incoming(ad.table(spark, d, "events"))
    return merge.insert_ignore(existing, incoming, key=["event_start"])


def existing_starts(spark, d):
    existing, incoming = ad.existing_and_incoming(ad.table(spark, d, "events"))
    return merge.exists_in(incoming, existing, ["event_start"])


def upsert_indices(spark, d):
    lookup, feed = ad.lookup_and_feed(ad.table(spark, d, "events"))
    return merge.upsert_columns(lookup, feed, ["sunspot_number"], insert_only=["source"])


def migrate_observations(spark, d):
    orders = ad.table(spark, d, "orders")
    moved = merge.migrate_observations(ad.observations(orders), ad.held_flares(orders))
    member = lambda name: F.get_json_object("metadata", f"$.{name}")
    return moved.select(
        "seq", "event_start", "event_peak", "event_end", "magnitude", "instrument", "source",
        member("xrslong_flux").cast("double").alias("xrslong_flux"),
        member("active_region").cast("long").alias("active_region"),
        F.size(F.json_object_keys("metadata")).cast("long").alias("members"),
    )


def parse_latest_json(spark, d):
    documents = ad.documents(ad.table(spark, d, "events"))
    events = latest_events(documents, keep=("event_id",))
    mapped = normalise.normalise_latest(events, keep=("event_id", "element"))
    return _position(mapped).select(
        "event_id", "element", "event_start", "event_peak", "event_end", "magnitude",
        "instrument", "altitude", "azimuth", "source",
        F.get_json_object("metadata", "$.xrslong_flux").cast("double").alias("xrslong_flux"),
    )


def parse_latest_first_only(spark, d):
    documents = ad.documents(ad.table(spark, d, "events"))
    return latest_events(documents, mode="latest", keep=("event_id",)).select(
        "event_id", "satellite", "begin_time", "max_time", "max_class", "max_xrlong"
    )


def legacy_observations(spark, d):
    documents = ad.documents(ad.table(spark, d, "events"))
    complete = latest_events(documents, mode="latest", keep=("event_id",)).filter(
        normalise.is_complete()
    )
    rows = normalise.normalise_legacy(complete, keep=("event_id",))
    return rows.select(
        "event_id", "event_start", "classification",
        F.col("sub_classification").cast("double").alias("sub_classification"),
        "observation_instrument", "max_energy",
    )


def extract_first_link(spark, d):
    return listing.first_links(ad.table(spark, d, "pages"), suffix="n").select("page_id", "link")


def extract_named_link(spark, d):
    return listing.named_links(ad.table(spark, d, "pages"), name="/the").select("page_id", "link")


def missing_links(spark, d):
    return listing.missing_links(listing.first_links(ad.table(spark, d, "pages"), suffix="n"))


def newest_name(spark, d):
    listed, _ = ad.listed_and_processed(ad.table(spark, d, "pages"))
    return listing.newest_name(listed, "http", "5")


def unread_files(spark, d):
    return listing.unread_files(*ad.listed_and_processed(ad.table(spark, d, "pages")))


def parse_sunspot_lines(spark, d):
    return feeds.parse_sunspots(ad.sunspot_lines(ad.table(spark, d, "events")))


def parse_f10_7_records(spark, d):
    return feeds.parse_f10_7(ad.f10_7_records(ad.table(spark, d, "events")))


def assign_dense_ids(spark, d):
    rows = ad.keyed_events(ad.table(spark, d, "events")).drop("ts")
    return merge.assign_ids(rows, "dense", after=1000)


def sun_position(spark, d):
    return _position(add_sun_position(ad.table(spark, d, "events"), "ts")).select(
        "event_id", "altitude", "azimuth"
    )


def flux_series(spark, d):
    return series.flux_series(_flares(spark, d), "source")


def calibration_compare(spark, d):
    renamed = normalise.rename_catalog(ad.catalog(ad.table(spark, d, "orders")))
    return series.calibration_series(predicates.from_catalog_start(renamed))


def class_levels(spark, d):
    return series.level_series(_flares(spark, d))


def peak_rows(spark, d):
    return predicates.with_status(_status_rows(spark, d), "EVENT_PEAK", "xrsb_flux")


def first_rows(spark, d):
    return predicates.head(_flares(spark, d).select("id", "event_start"), "id")


def last_rows(spark, d):
    return predicates.tail(_flares(spark, d).select("id", "event_start"), "id")


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    return (
        spark.readStream.schema(ad.table(spark, d, "events").schema)
        .option("maxFilesPerTrigger", 100)
        .option("pathGlobFilter", "events.parquet")
        .parquet(d)
    )


def stream_latest_events(spark, d):
    """Documents as a stream, mapped and inserted by key in micro-batches."""
    folder, order = _scratch(spark), ["event_id", "element"]
    target = KeyedTable(spark, f"{folder}/flares").create()
    events = latest_events(ad.documents(_event_stream(spark, d)), keep=("event_id",))
    mapped = normalise.normalise_latest(events, keep=tuple(order))
    insert_stream(mapped, target, order, f"{folder}/checkpoint", seconds=None).start().awaitTermination()
    return target.read().select("event_start", "instrument", "magnitude")


def stream_drop_repeats(spark, d):
    """The event file, cut into files whose times go back and forth, de-duplicated as a stream."""
    folder = _scratch(spark)
    rows = ad.keyed_events(ad.table(spark, d, "events")).select("event_start", "instrument", "seq")
    _back_and_forth(rows).write.parquet(f"{folder}/landed")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 100).parquet(f"{folder}/landed")
    schema = T.StructType([f for f in rows.schema.fields if f.name in FLARES_KEY])
    target = KeyedTable(spark, f"{folder}/events", schema, FLARES_KEY).create()
    drop_repeats(stream, target, ["seq"], f"{folder}/checkpoint").start().awaitTermination()
    return target.read()


def _back_and_forth(rows: DataFrame) -> DataFrame:
    """Rows in as many files as the table is read in, four at least, each over all of its times."""
    files = max(4, rows.rdd.getNumPartitions())
    return rows.withColumn("_file", F.pmod(F.xxhash64("seq"), F.lit(files))).repartition(files, "_file").drop("_file")


def stream_forget_repeats(spark, d):
    """The same with keys remembered for an hour; what comes later would still meet the table."""
    folder = _scratch(spark)
    rows = ad.keyed_events(ad.table(spark, d, "events")).select("event_start", "instrument", "seq")
    _back_and_forth(rows).write.parquet(f"{folder}/landed")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/landed")
    schema = T.StructType([f for f in rows.schema.fields if f.name in FLARES_KEY])
    target = KeyedTable(spark, f"{folder}/events", schema, FLARES_KEY).create()
    writer = drop_repeats(stream, target, ["seq"], f"{folder}/checkpoint", memory_seconds=3600)
    writer.start().awaitTermination()
    return target.read()


def poll_landed_documents(spark, d):
    """Documents landed as text files, polled into the table in small batches.

    A landed file holds the elements of 200 documents as one array; all lie in one folder.
    """
    folder = _scratch(spark)
    target = KeyedTable(spark, f"{folder}/flares").create()
    elements = F.btrim("value", F.lit("[]"))
    arrays = (
        ad.documents(ad.table(spark, d, "events"))
        .groupBy(F.expr("event_id DIV 200").alias("part"))
        .agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list(elements)), ","), F.lit("]")).alias("value"))
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/landed")
    poll_latest(spark, f"{folder}/landed", target, f"{folder}/checkpoint", None).start().awaitTermination()
    return target.read().select("event_start", "instrument")


def array_status_rows(spark, d):
    """Array files to rows: masked cells get the fill value, the class is one text."""
    rows = arrays_to_rows(ad.array_files(ad.table(spark, d, "events")), ad.STATUS_COLUMNS)
    return finish(rows, {"integrated_flux": ad.FILL}).select(
        "file", "pos", "flare_id", "status", "time", "xrsb_flux", "integrated_flux", "flare_class"
    )


def collapse_many_files(spark, d):
    """Status rows read from several files, whose places in the file start anew in each."""
    folder = _scratch(spark)
    rows = _status_rows(spark, d).withColumn("background_flux", F.lit(0.0))
    rows = ad.with_class_chars(rows).withColumn("flare_class", F.array_join("flare_class", ""))
    halves = rows.withColumn("half", (F.col("pos") % 2).cast("int")).withColumn("pos", F.expr("pos DIV 2"))
    for half in (0, 1):
        halves.filter(F.col("half") == half).drop("half").write.parquet(f"{folder}/file-{half}")
    found = collapse.collapse_events(read_status_rows(spark, f"{folder}/file-*"))
    return _position(found).drop("seq")


def sync_array_files(spark, d):
    """Array files landed one after another, refreshed into the table in small batches."""
    folder = _scratch(spark)
    target = KeyedTable(spark, f"{folder}/flares").create()
    files = ad.array_files(ad.table(spark, d, "events")).drop("file")
    files.repartition(max(10, files.rdd.getNumPartitions())).write.parquet(f"{folder}/landed")
    sync_arrays(
        spark, f"{folder}/landed", target, f"{folder}/checkpoint", files.schema,
        fills={"integrated_flux": ad.FILL}, max_files=4,
    ).start().awaitTermination()
    return target.read().select("event_start", "instrument", "source")


def catalog_from_files(spark, d):
    """The catalog as tab-separated text in several files, read back with its ordinals."""
    folder = _scratch(spark)
    raw = ad.catalog(ad.table(spark, d, "orders"))
    (
        raw.withColumn("Instrumento", F.trim(F.regexp_replace("Instrumento", r"\s+", " ")))
        .repartitionByRange(max(4, raw.rdd.getNumPartitions()), "ordinal")
        .sortWithinPartitions("ordinal").drop("ordinal")
        .write.option("sep", "\t").option("header", True).csv(folder)
    )
    renamed = normalise.rename_catalog(read_catalog(spark, folder, with_ordinal=True))
    return renamed.select("ordinal", "event_start", "instrument", "raw_flux")


def legacy_single_objects(spark, d):
    """The older reading: one object per document."""
    documents = ad.single_documents(ad.table(spark, d, "events"))
    return latest_events(documents, mode="legacy", keep=("event_id",)).select(
        "event_id", "satellite", "begin_time", "max_time", "max_class", "max_xrlong"
    )


def _catalog_batch(spark, d) -> DataFrame:
    renamed = normalise.rename_catalog(ad.catalog(ad.table(spark, d, "orders")))
    return normalise.normalise_catalog(renamed).withColumnRenamed("ordinal", "seq")


def load_counts(spark, d):
    """What a dry run, a load and a second load count, and the table's rows afterwards."""
    table = KeyedTable(spark, f"{_scratch(spark)}/flares").create()
    rows = _catalog_batch(spark, d)
    # every fiftieth row does not fit the table
    rows = rows.withColumn("source", F.when(F.col("seq") % 50 != 0, F.col("source")).otherwise("?"))
    rows = _stored(rows, _scratch(spark))
    steps = [
        ("dry run", table.count_fresh(rows)),
        ("load", table.insert_ignore(rows)),
        ("again", table.insert_ignore(rows)),
    ]
    counts = [(n, r.read, r.inserted, r.rejected) for n, r in steps]
    counts.append(("table", table.read().count(), 0, table.read_rejects().count()))
    return spark.createDataFrame(counts, "step string, read long, inserted long, rejected long")


def _stored(rows: DataFrame, path: str) -> DataFrame:
    """Rows written once, so that what reads them several times does not compute them anew."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _keyed_batch(spark, d) -> DataFrame:
    """Incoming events for a table whose key may have a null; each twice, with one place for all."""
    _, incoming = ad.existing_and_incoming(ad.table(spark, d, "events"))
    return incoming.unionByName(incoming).withColumn("place", F.lit(1))


def _key_table(spark, d, **options) -> KeyedTable:
    schema = T.StructType.fromJson(_keyed_batch(spark, d).select(*FLARES_KEY, "value").schema.jsonValue())
    return KeyedTable(spark, f"{_scratch(spark)}/events", schema, FLARES_KEY, **options).create()


def insert_null_keys(spark, d):
    """Rows without an instrument all stay, equal ones too, in one batch or in several."""
    table, batch = _key_table(spark, d), _keyed_batch(spark, d)
    table.insert_ignore(batch.filter("seq % 3 = 0"), ["place", "seq"])
    table.insert_ignore(batch.filter("seq % 3 <> 0"), ["place", "seq"])
    return table.read().select("event_start", "instrument")


def insert_accounts(spark, d):
    """What becomes of each row: of a first batch, of one that overlaps it, and of that run again."""
    table, batch = _key_table(spark, d), _keyed_batch(spark, d)
    rows = batch.withColumn("event_start", F.when(F.col("seq") % 50 != 0, F.col("event_start")))
    steps = [
        (name, table.insert_ignore(rows.filter(some), ["place", "seq"], batch_name=name.split()[0]))
        for name, some in (("first", "seq % 3 = 0"), ("second", "seq % 2 = 0"), ("second again", "seq % 2 = 0"))
    ]
    counts = [(n, r.read, r.inserted, r.held, r.repeated, r.rejected) for n, r in steps]
    counts.append(("stored", table.read().count(), 0, 0, 0, table.read_rejects().count()))
    return spark.createDataFrame(counts, "step string, read long, inserted long, held long, repeated long, rejected long")


def concurrent_inserts(spark, d):
    """Two writers insert overlapping halves at once; each key is there once."""
    table, rows = _key_table(spark, d), _keyed_batch(spark, d)
    halves = [rows.filter("seq % 3 <> 0"), rows.filter("seq % 3 <> 1")]

    def write(half: DataFrame) -> None:
        KeyedTable(spark, table.path, table.schema, table.key).insert_ignore(half, ["place", "seq"])

    with ThreadPoolExecutor(2) as writers:
        list(writers.map(write, halves))
    return table.read().select("event_start", "instrument")


def stored_pages(spark, d):
    """The first page and one in the middle of a stored table, from the files around them."""
    table = KeyedTable(spark, f"{_scratch(spark)}/flares", slice_rows=2000).create()
    table.insert_ignore(_catalog_batch(spark, d))
    middle = table.read().count() // 20 + 1
    pages = [
        table.read_page(page, 10).select(
            F.lit(name).alias("page"),
            F.row_number().over(Window.orderBy(F.desc("event_start"), F.desc("id"))).alias("place"),
            "event_start",
        )
        for name, page in (("first", 1), ("middle", middle))
    ]
    return pages[0].unionByName(pages[1])


def refresh_rewritten_file(spark, d):
    """Array files that hold some events, refreshed, then written anew with all, refreshed again."""
    folder = _scratch(spark)
    target = KeyedTable(spark, f"{folder}/flares").create()
    files = ad.array_files(ad.table(spark, d, "events"))
    number = max(4, files.rdd.getNumPartitions())
    parts = files.withColumn("b", F.pmod(F.xxhash64("file"), F.lit(number))).repartition(number, "b")
    schema = files.drop("file").schema
    moves = Files(spark, folder)
    for name, some in (("early", "CAST(file AS BIGINT) % 3 = 0"), ("late", "true")):
        parts.filter(some).drop("file").write.partitionBy("b").parquet(f"{folder}/{name}")
        for b in moves.names(f"{folder}/{name}"):
            for file in moves.names(f"{folder}/{name}/{b}") if b.startswith("b=") else ():
                if file.endswith(".parquet"):
                    moves.replace(f"{folder}/{name}/{b}/{file}", f"{folder}/landed/events-{b[2:]}.parquet")
        refresh_arrays(spark, f"{folder}/landed", target, schema, fills={"integrated_flux": ad.FILL}, glob="*.parquet")
    return target.read().select("event_start", "instrument", "source")


def refused_documents(spark, d):
    """Documents landed, good and refused, and the reasons that the table keeps."""
    table = KeyedTable(spark, f"{_scratch(spark)}/flares").create()
    number = F.col("event_id")
    text = (
        F.when(number % 7 == 0, "<html>").when(number % 11 == 0, "[ ]").when(number % 13 == 0, F.concat("value", F.lit("]x")))
        .when(number % 17 != 0, F.col("value"))
    )
    docs = ad.documents(ad.table(spark, d, "events")).withColumn("value", text)
    rows = _stored(latest_events(docs, keep=("event_id",), refused=True), _scratch(spark))
    table.insert_ignore(normalise.normalise_latest(rows, keep=("event_id", "element")), ["event_id", "element"])
    kept = table.read_rejects("event_id long").filter("reject_reason LIKE 'document%'")
    reasons = kept.groupBy(F.col("reject_reason").alias("what")).agg(F.count("*").alias("documents"))
    counts = count_documents(rows, "event_id").select(F.expr("stack(3, 'landed', landed, 'good', good, 'refused', refused) AS (what, documents)"))
    return counts.unionByName(reasons)


def lookup_feeds(spark, d):
    """Three feeds on top of a lookup, merged at once in one commit."""
    lookup, feed = ad.lookup_and_feed(ad.table(spark, d, "events"))
    table = SnapshotTable(spark, f"{_scratch(spark)}/indices").create()
    table.upsert(lookup.withColumn("seq", F.lit(0)), ["kp_index", "ap_index"])
    odd = feed.filter("seq % 2 = 1").select("date", (F.col("sunspot_number") / 2.0).alias("f10_7_flux"), "seq")
    kp = feed.filter("day(date) % 2 = 0").select("date", F.lit(1.5).alias("kp_index"), F.lit(6).alias("ap_index"), "seq")
    table.upsert_all([(feed, ["sunspot_number"], ["source"]), (odd, ["f10_7_flux"], []), (kp, ["kp_index", "ap_index"], [])])
    return table.read().drop("created_at")


def stored_ids(spark, d):
    """Default ids of a loaded table: all different, all rows stamped."""
    table = KeyedTable(spark, f"{_scratch(spark)}/flares").create()
    table.insert_ignore(_catalog_batch(spark, d))
    return table.read().agg(
        F.count("*").alias("stored"),
        F.countDistinct("id").alias("ids"),
        F.count_if(F.col("created_at").isNotNull()).alias("stamped"),
    )


def export_csv(spark, d):
    """The catalog written as CSV with a header, read back."""
    folder = _scratch(spark)
    write_csv(_flares(spark, d).select("id", "magnitude", "instrument"), folder)
    return spark.read.schema("id long, magnitude string, instrument string").option("header", True).csv(folder)


def not_a_number(spark, d):
    """Events whose fluxes are NaN here and there, as the table stores them."""
    gap = lambda c, n: F.when(F.col("id") % n == 0, F.lit(float("nan"))).otherwise(F.col(c))
    rows = _flares(spark, d).withColumns(
        {"xrsb_flux_peak": gap("xrsb_flux_peak", 3), "integrated_flux": gap("integrated_flux", 5)}
    )
    stored = conform_events(rows.withColumn("source", F.lit("SWPC")), ["id"])
    return stored.select("id", "xrsb_flux_peak", "integrated_flux")


def stream_insert_ignore(spark, d):
    """The event file as a stream, inserted by key in micro-batches."""
    folder = _scratch(spark)
    target = KeyedTable(spark, f"{folder}/flares").create()
    rows = ad.keyed_events(_event_stream(spark, d)).withColumns(
        {
            "event_peak": F.col("event_start"),
            "event_end": F.col("event_start"),
            "source": F.lit("JSON"),
            "xrsb_flux_peak": F.col("value"),
        }
    )
    insert_stream(rows, target, ["seq"], f"{folder}/checkpoint", seconds=None).start().awaitTermination()
    return target.read().select("event_start", "instrument", "xrsb_flux_peak")


_REGISTERED = [
    collapse_events,
    collapse_counters,
    distinct_event_ids,
    classify_flux,
    normalise_catalog,
    merge_eras,
    era_bounds,
    era_trim_counts,
    overlap_window,
    list_flares_filtered,
    catalog_cut_counts,
    history_accounts,
    list_flares_far_page,
    list_flares_deep_page,
    list_flares_total,
    list_flares_with_indices,
    flares_with_indices,
    flare_page,
    response_rows,
    latest_flare,
    flare_by_id,
    stats_by_class,
    stats_by_year,
    stats_by_instrument,
    stats_range,
    stats_all,
    stats_answer,
    list_indices,
    list_indices_second_page,
    array_status_rows,
    collapse_many_files,
    catalog_from_files,
    legacy_single_objects,
    load_counts,
    stored_ids,
    export_csv,
    not_a_number,
    daily_kp_ap,
    ap_step_lookup,
    insert_ignore,
    insert_ignore_start_only,
    existing_starts,
    upsert_indices,
    migrate_observations,
    parse_latest_json,
    parse_latest_first_only,
    legacy_observations,
    extract_first_link,
    extract_named_link,
    missing_links,
    newest_name,
    unread_files,
    parse_sunspot_lines,
    parse_f10_7_records,
    assign_dense_ids,
    sun_position,
    flux_series,
    calibration_compare,
    class_levels,
    peak_rows,
    first_rows,
    last_rows,
    stream_insert_ignore,
    stream_latest_events,
    stream_drop_repeats,
    stream_forget_repeats,
    insert_null_keys,
    insert_accounts,
    concurrent_inserts,
    stored_pages,
    refresh_rewritten_file,
    refused_documents,
    lookup_feeds,
    poll_landed_documents,
    sync_array_files,
]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: status rows collapsed to events with class and sun position."""
    return collapse_events(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or query; each takes (spark, sf_dir)."""
    found = {f.__name__: f for f in _REGISTERED}
    return found | _llm.QUERIES | {"pipeline": _pipeline.run} if _llm else found


def oracle_sql() -> dict[str, str]:
    """The same results as SQL over the same tables."""
    return ORACLE | (_llm.ORACLE if _llm else {})
