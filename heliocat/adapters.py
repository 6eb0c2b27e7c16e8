"""General star-schema tables as the frames the operators expect.

Only ``+ - * /`` and exact decimals are used, so other engines compute the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heliocat.functions.flux import add_magnitude, class_letter, class_number
from heliocat.functions.geomag import kp_to_ap
from heliocat.functions.numeric import round2, round_to_int
from heliocat.functions.times import exact_seconds_since, iso_text, truncate, utc
from heliocat.operators.daily import daily_kp, exact_mean


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _plus(ts: Column, unit: str, n) -> Column:
    return F.timestamp_add(unit, F.lit(n) if isinstance(n, int) else n, ts)


def status_rows(events: DataFrame) -> DataFrame:
    """A user's day is an event; click, view and purchase are its start, peak and end."""
    status = (
        F.when(F.col("event_type") == "click", "EVENT_START")
        .when(F.col("event_type") == "view", "EVENT_PEAK")
        .when(F.col("event_type") == "purchase", "EVENT_END")
        .otherwise("POST_EVENT")
    )
    flux = F.col("value") * F.col("value") * 1e-9
    return events.select(
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("flare_id"),
        status.alias("status"),
        exact_seconds_since(F.col("ts")).cast("double").alias("time"),
        flux.alias("xrsb_flux"),
        F.col("value").alias("integrated_flux"),
        F.col("event_id").alias("pos"),
    )


def with_class_chars(rows: DataFrame) -> DataFrame:
    """Status rows with the class as an array of characters, as array files hold it."""
    return add_magnitude(rows, "xrsb_flux", "flare_class").withColumn(
        "flare_class", F.split("flare_class", "")
    )


def _order_times(orders: DataFrame) -> DataFrame:
    start = _plus(F.col("o_orderdate"), "MINUTE", F.col("o_orderkey") % 1440)
    x = F.col("o_totalprice") / 1e5
    return orders.withColumns({"event_start": start, "flux": x * x * 5e-6})


def flares(orders: DataFrame) -> DataFrame:
    """Orders as events; some have no magnitude."""
    return add_magnitude(_order_times(orders), "flux").select(
        F.col("o_orderkey").alias("id"),
        "event_start",
        _plus(F.col("event_start"), "MINUTE", 10).alias("event_peak"),
        _plus(F.col("event_start"), "MINUTE", 25).alias("event_end"),
        F.when(F.col("o_orderkey") % 17 != 0, F.col("magnitude")).alias("magnitude"),
        F.col("flux").alias("xrsb_flux_peak"),
        F.col("o_totalprice").alias("integrated_flux"),
        F.col("o_orderpriority").alias("instrument"),
        F.col("o_orderstatus").alias("source"),
    )


def solar_indices(lineitem: DataFrame) -> DataFrame:
    """One row per ship date."""
    daily = lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.count("*").cast("int").alias("sunspot_number"),
        F.sum("l_quantity").alias("f10_7_flux"),
        exact_mean(F.col("l_discount") * 90.0).alias("kp"),
    )
    return daily.select(
        "date",
        "sunspot_number",
        "f10_7_flux",
        round2(F.col("kp")).alias("kp_index"),
        kp_to_ap(F.col("kp")).alias("ap_index"),
    )


def kp_records(events: DataFrame) -> DataFrame:
    """Events as readings of a Kp feed, value and time as text."""
    return events.select(
        iso_text(F.col("ts")).alias("time_tag"),
        F.least(F.col("value") / 10.0, F.lit(9.0)).cast("string").alias("Kp"),
    )


#: days by which orders are moved back, so that they straddle the catalog's first day
CATALOG_SHIFT = 8036


def catalog(orders: DataFrame) -> DataFrame:
    """Orders as rows of the historical catalog, all times as text."""
    moved = _order_times(orders).withColumn(
        "event_start", _plus(F.col("event_start"), "DAY", -CATALOG_SHIFT)
    )
    text = lambda minutes: _plus(
        F.col("event_start"), "MINUTE", minutes
    ).cast("string")
    return moved.select(
        F.col("o_orderkey").alias("ordinal"),
        F.col("o_orderstatus").alias("Clase"),
        F.lit(1.0).alias("Subclase"),
        F.concat(F.lit(" \t"), "o_orderpriority", F.lit("  ")).alias("Instrumento"),
        F.lit("0").alias("Region"),
        text(0).alias("t-inicio"),
        text(10).alias("t-max"),
        text(25).alias("t-fin"),
        F.col("flux").alias("total X-ray flux"),
        F.lit(0.0).alias("altitud"),
        F.lit(0.0).alias("azimuth"),
        F.lit("").alias("unknown"),
    )


def eras(orders: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three overlapping slices of the events by time, together the whole table."""
    events = flares(orders).drop("source", "integrated_flux")
    start = F.col("event_start")
    catalog_part = events.filter(start < utc("1997-01-01 00:00:00"))
    middle = events.filter(
        (start >= utc("1997-01-01 00:00:00")) & (start < utc("2000-01-01 00:00:00"))
    )
    last = events.filter(start >= utc("1999-06-01 00:00:00"))
    return (
        catalog_part.withColumn("source", F.lit("SWPC")),
        middle.withColumn("source", F.lit("GOES-16")),
        last.withColumn("source", F.lit("GOES-19")),
    )


ERA_CUT = "1999-06-01 00:00:00"


def observations(orders: DataFrame) -> DataFrame:
    """Orders as rows of the older table; one priority stands for a missing instrument."""
    rows = _order_times(orders)
    return rows.select(
        F.col("o_orderkey").alias("id"),
        "event_start",
        _plus(F.col("event_start"), "MINUTE", 10).alias("max_peak_event"),
        _plus(F.col("event_start"), "MINUTE", 25).alias("event_finish"),
        class_letter(F.col("flux")).alias("classification"),
        class_number(F.col("flux")).cast("float").alias("sub_classification"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("observation_instrument"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("max_energy"),
        F.lit(0.0).alias("total_energy"),
        F.lit(0).alias("active_region"),
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
    )


def held_flares(orders: DataFrame) -> DataFrame:
    """The events a target table holds already: those before 1998."""
    return flares(orders).filter(F.col("event_start") < utc("1998-01-01 00:00:00"))


EXISTING_BEFORE = "2024-01-20 00:00:00"
INCOMING_FROM = "2024-01-10 00:00:00"


def keyed_events(events: DataFrame) -> DataFrame:
    """Events keyed by hour and type; one type stands for a missing instrument."""
    return events.select(
        truncate(F.col("ts"), "HOUR").alias("event_start"),
        F.nullif("event_type", F.lit("error")).alias("instrument"),
        F.col("event_id").alias("seq"),
        "value",
        "ts",
    )


def existing_and_incoming(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two overlapping slices by time, together the whole table."""
    rows = keyed_events(events)
    return (
        rows.filter(F.col("ts") < utc(EXISTING_BEFORE)).drop("ts"),
        rows.filter(F.col("ts") >= utc(INCOMING_FROM)).drop("ts"),
    )


def array_files(events: DataFrame) -> DataFrame:
    """Status rows as array files, one per event: equal-length arrays, masked cells null."""
    rows = with_class_chars(status_rows(events))
    masked = F.when(F.col("pos") % 7 != 0, F.col("integrated_flux"))
    columns = STATUS_COLUMNS
    entries = F.array_sort(F.collect_list(F.struct("pos", *columns)))
    full = rows.withColumns({"integrated_flux": masked, "background_flux": F.lit(0.0)})
    packed = full.groupBy(F.col("flare_id").alias("event")).agg(entries.alias("rows"))
    return packed.select(
        F.col("event").cast("string").alias("file"),
        *[F.col(f"rows.{c}").alias(c) for c in columns],
    )


#: what masked cells are filled with
FILL = -9999.0
STATUS_COLUMNS = ["flare_id", "status", "time", "xrsb_flux", "integrated_flux", "background_flux", "flare_class"]


def single_documents(events: DataFrame) -> DataFrame:
    """One document per row as the older reading takes it: a single object in brackets."""
    first = F.regexp_extract("value", r"^\[(\{[^}]*\})", 1)
    return documents(events).select("event_id", F.concat(F.lit("["), first, F.lit("]")).alias("value"))


def documents(events: DataFrame) -> DataFrame:
    """One latest-event document per row, with two elements and sometimes no end bracket."""
    kind = F.col("event_type")

    def element(hours: int) -> Column:
        time = lambda minutes: iso_text(
            _plus(F.col("ts"), "MINUTE", 60 * hours + minutes)
        )
        return F.struct(
            F.when(kind != "signup", F.col("user_id").cast("string")).alias("satellite"),
            F.concat(time(0), F.lit("Z")).alias("begin_time"),
            F.when(kind == "error", F.lit("Unk"))
            .otherwise(F.concat(time(10), F.lit("Z")))
            .alias("max_time"),
            F.concat(time(25), F.lit("Z")).alias("end_time"),
            F.when(kind == "click", F.lit("")).otherwise(F.lit(f"C{hours + 1}.5")).alias("max_class"),
            F.lit("B9.9").alias("current_class"),
            F.when(kind == "view", F.lit(0.0)).otherwise(F.col("value")).alias("max_xrlong"),
            (F.col("value") / 2.0).alias("current_int_xrlong"),
        )

    open_text = F.rtrim(F.to_json(F.array(element(0), element(1))), F.lit("]"))
    end = F.when(kind == "purchase", "").otherwise("]")
    return events.select("event_id", F.concat(open_text, end).alias("value"))


def sunspot_lines(events: DataFrame) -> DataFrame:
    """Events as lines of the sunspot feed: comments, short lines, days that do not
    exist, missing numbers and unparsable ones stand among the good ones."""
    kind = F.col("event_type")
    date = F.col("ts").cast("string")
    day = F.when(kind == "error", F.lit("32")).otherwise(F.substring(date, 9, 2))
    number = F.when(kind == "signup", "  -1").otherwise(F.concat(F.lit("  "), F.col("value").cast("string")))
    head = F.concat_ws(";", F.substring(date, 1, 4), F.substring(date, 6, 2), day)
    line = F.when(kind == "click", F.concat(F.lit("# "), head)).otherwise(
        F.concat_ws(";", head, F.lit("2024.001"), number, F.lit(" 1.0"), F.lit("   1"), F.lit("1"))
    )
    return events.select(line.alias("value"), F.col("event_id").alias("seq"))


def f10_7_records(events: DataFrame) -> DataFrame:
    """Events as records of the F10.7 feed, some without a time or with unusable flux."""
    kind = F.col("event_type")
    return events.select(
        F.when(kind != "signup", iso_text(F.col("ts"))).otherwise("").alias("time_tag"),
        F.when(kind == "error", "n/a")
        .when(kind != "click", F.col("value").cast("string"))
        .alias("flux"),
        F.col("event_id").alias("seq"),
    )


def listed_and_processed(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Page addresses as file names; those of one language count as processed."""
    names = pages.select("page_id", F.col("url").alias("file_name"))
    return names, names.filter(F.contains("file_name", F.lit("/en/")))


def lookup_and_feed(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A lookup that holds early days' Kp, and a sunspot feed with many rows per late day."""
    day = F.to_date("ts").alias("date")
    early = events.filter(F.col("ts") < utc(EXISTING_BEFORE)).select(
        day, F.least(F.col("value") / 10.0, F.lit(9.0)).alias("kp")
    )
    lookup = daily_kp(early).select(
        "date",
        F.lit(None).cast("int").alias("sunspot_number"),
        F.lit(None).cast("double").alias("f10_7_flux"),
        "kp_index",
        "ap_index",
        F.lit(None).cast("string").alias("source"),
    )
    feed = events.filter(F.col("ts") >= utc(INCOMING_FROM)).select(
        day,
        round_to_int(F.col("value")).alias("sunspot_number"),
        F.lit("SILSO").alias("source"),
        F.col("event_id").alias("seq"),
    )
    return lookup, feed
