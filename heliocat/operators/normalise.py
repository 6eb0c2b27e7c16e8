"""Sources to the unified event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heliocat.functions.flux import add_magnitude, calibrate
from heliocat.functions.solar import add_sun_position
from heliocat.functions.texts import (
    class_head,
    class_rest,
    first_number,
    first_text,
    metadata_json,
    satellite_label,
    strip,
)
from heliocat.constants import CATALOG_START
from heliocat.functions.times import TIME_FORMATS, parse_utc, utc
from heliocat.schemas import EVENTS, align

CATALOG_NAMES = {
    "t-inicio": "event_start",
    "t-max": "event_peak",
    "t-fin": "event_end",
    "total X-ray flux": "raw_flux",
    "altitud": "altitude",
    "Instrumento": "instrument",
}


_TIMES = ("event_start", "event_peak", "event_end")


def rename_catalog(raw: DataFrame, formats: tuple = TIME_FORMATS) -> DataFrame:
    """Unified names, parsed times; the columns computed anew are dropped.

    ``reject_hint`` says which time is a text that no format fits, so that the row is
    rejected with a reason instead of leaving with the rows outside the era.
    """
    renamed = raw.drop("unknown", "Clase", "Subclase", "Region").withColumnsRenamed(CATALOG_NAMES)
    parsed = renamed.withColumns({f"_{c}": parse_utc(F.col(c).cast("string"), formats) for c in _TIMES})
    bad = [
        F.when(F.col(f"_{c}").isNull() & (F.btrim(F.col(c).cast("string")) != ""), f"{c} is no time")
        for c in _TIMES
    ]
    times = {c: F.col(f"_{c}") for c in _TIMES}
    hinted = parsed.withColumn("reject_hint", F.coalesce(*bad))
    return hinted.withColumns(times).drop(*[f"_{c}" for c in _TIMES])


def catalog_fate(end_ordinal: int | None = None, ordinal: str = "ordinal") -> Column:
    """What ``normalise_catalog`` does with a row of the renamed catalog; rows to reject are offered."""
    cuts = F.when(F.col("reject_hint").isNotNull(), "offered")
    if end_ordinal is not None:
        inside = F.coalesce(F.col(ordinal) < end_ordinal, F.lit(False))
        cuts = F.when(~inside, "behind the catalog").when(F.col("reject_hint").isNotNull(), "offered")
    cuts = cuts.when(F.col("event_peak").isNull(), "without a peak")
    return cuts.when(F.col("event_peak") < utc(CATALOG_START), "before the catalog").otherwise("offered")


def normalise_catalog(
    renamed: DataFrame,
    source: str = "SWPC",
    end_ordinal: int | None = None,
    end_time: str | None = None,
    ordinal: str = "ordinal",
) -> DataFrame:
    """Calibrate, cut the era and compute magnitudes anew.

    The end is a position in the file (``end_ordinal``, against the ordinal given by
    the loader) or, where rows have no position, a start time (``end_time``). Rows with a
    ``reject_hint`` stay for the table to reject.
    ``raw_flux`` and the ordinal stay for the comparison series and the arrival order.
    """
    kept = F.col("event_peak") >= utc(CATALOG_START)
    if end_time is not None:
        kept &= F.col("event_start") < utc(end_time)
    if "reject_hint" in renamed.columns:
        kept = F.col("reject_hint").isNotNull() | kept
    if end_ordinal is not None:
        kept = (F.col(ordinal) < end_ordinal) & kept
    era = renamed.filter(kept)
    corrected = era.withColumn("xrsb_flux_peak", calibrate(F.col("raw_flux")))
    return add_magnitude(corrected, "xrsb_flux_peak").withColumns(
        {
            "instrument": strip(F.col("instrument")),
            "source": F.lit(source),
            "integrated_flux": F.lit(None).cast("double"),
        }
    )


def label_source(events: DataFrame, label: str) -> DataFrame:
    """Collapsed events of one instrument: its label is both source and instrument."""
    return events.withColumns({"source": F.lit(label), "instrument": F.lit(label)})


def is_complete(max_time: str = "max_time", end_time: str = "end_time") -> Column:
    """Both times are known."""

    def unknown(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")).isin("Unk", "")

    return ~(unknown(max_time) | unknown(end_time))


def normalise_latest(events: DataFrame, keep: tuple = (), **site) -> DataFrame:
    """Latest-event records to unified columns; unfinished events are left out.

    Rows with a ``reject_hint`` stay for the table to reject.
    """
    hint = ["reject_hint"] if "reject_hint" in events.columns else []
    wanted = F.col("reject_hint").isNotNull() | is_complete() if hint else is_complete()
    mapped = events.filter(wanted).select(
        *keep,
        *hint,
        parse_utc(F.col("begin_time")).alias("event_start"),
        parse_utc(F.col("max_time")).alias("event_peak"),
        parse_utc(F.col("end_time")).alias("event_end"),
        first_text(F.col("max_class"), F.col("current_class")).alias("magnitude"),
        F.lit(None).cast("double").alias("xrsb_flux_peak"),
        F.lit(None).cast("double").alias("integrated_flux"),
        satellite_label(F.col("satellite")).alias("instrument"),
        F.lit("JSON").alias("source"),
        metadata_json(first_number(F.col("max_xrlong"), F.col("current_int_xrlong"))).alias(
            "metadata"
        ),
    )
    return align(add_sun_position(mapped, "event_peak", **site), EVENTS, [*keep, *hint])


def normalise_legacy(events: DataFrame, keep: tuple = (), **site) -> DataFrame:
    """Latest-event records to the older observation columns."""
    mapped = events.select(
        *keep,
        parse_utc(F.col("begin_time")).alias("event_start"),
        parse_utc(F.col("max_time")).alias("max_peak_event"),
        parse_utc(F.col("end_time")).alias("event_finish"),
        class_head(F.col("max_class")).alias("classification"),
        class_rest(F.col("max_class")).try_cast("float").alias("sub_classification"),
        satellite_label(F.col("satellite")).alias("observation_instrument"),
        F.col("max_xrlong").alias("max_energy"),
        F.lit(0.0).alias("total_energy"),
        F.lit(0).alias("active_region"),
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
    )
    return add_sun_position(mapped, "max_peak_event", **site)
