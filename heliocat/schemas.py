"""Table schemas, keys and the conversion of frames to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from heliocat.constants import SOURCES
from heliocat.functions.numeric import null_if_nan
from heliocat.functions.times import whole_second

NTZ = T.TimestampNTZType()


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType(
        [T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields]
    )


FLARES = _schema(
    ("id", T.LongType()),
    ("event_start", NTZ),
    ("event_peak", NTZ),
    ("event_end", NTZ),
    ("magnitude", T.StringType()),
    ("xrsb_flux_peak", T.DoubleType()),
    ("integrated_flux", T.DoubleType()),
    ("instrument", T.StringType()),
    ("altitude", T.DoubleType()),
    ("azimuth", T.DoubleType()),
    ("source", T.StringType()),
    ("metadata", T.StringType()),
    ("created_at", T.TimestampType()),
)
FLARES_KEY = ["event_start", "instrument"]
#: what the loaders fill; id and created_at are given at write time
EVENTS = T.StructType([f for f in FLARES.fields if f.name not in ("id", "created_at")])

SOLAR_INDICES = _schema(
    ("date", T.DateType(), False),
    ("sunspot_number", T.IntegerType()),
    ("f10_7_flux", T.DoubleType()),
    ("kp_index", T.DoubleType()),
    ("ap_index", T.IntegerType()),
    ("source", T.StringType()),
    ("created_at", T.TimestampType()),
)
INDEX_COLUMNS = ["sunspot_number", "f10_7_flux", "kp_index", "ap_index"]

OBSERVATIONS = _schema(
    ("id", T.LongType()),
    ("event_start", NTZ),
    ("max_peak_event", NTZ),
    ("event_finish", NTZ),
    ("classification", T.StringType()),
    ("sub_classification", T.FloatType()),
    ("observation_instrument", T.StringType()),
    ("max_energy", T.DoubleType()),
    ("total_energy", T.DoubleType()),
    ("active_region", T.IntegerType()),
    ("altitude", T.DoubleType()),
    ("azimuth", T.DoubleType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("created_at", T.TimestampType()),
)

CATALOG = _schema(
    ("Clase", T.StringType()),
    ("Subclase", T.DoubleType()),
    ("Instrumento", T.StringType()),
    ("Region", T.StringType()),
    ("t-inicio", T.StringType()),
    ("t-max", T.StringType()),
    ("t-fin", T.StringType()),
    ("total X-ray flux", T.DoubleType()),
    ("altitud", T.DoubleType()),
    ("azimuth", T.DoubleType()),
    ("unknown", T.StringType()),
)

STATUS_ROWS = _schema(
    ("flare_id", T.LongType()),
    ("status", T.StringType()),
    ("time", T.DoubleType()),
    ("xrsb_flux", T.DoubleType()),
    ("integrated_flux", T.DoubleType()),
    ("background_flux", T.DoubleType()),
    ("flare_class", T.StringType()),
)

LATEST_EVENT = _schema(
    ("satellite", T.StringType()),
    ("begin_time", T.StringType()),
    ("max_time", T.StringType()),
    ("end_time", T.StringType()),
    ("max_class", T.StringType()),
    ("current_class", T.StringType()),
    ("max_xrlong", T.DoubleType()),
    ("current_int_xrlong", T.DoubleType()),
)

F10_7_FEED = _schema(("time_tag", T.StringType()), ("flux", T.StringType()))
KP_FEED = _schema(("time_tag", T.StringType()), ("Kp", T.StringType()))


def align(df: DataFrame, schema: T.StructType, extra: list | None = None) -> DataFrame:
    """Ordered projection to ``schema``: casts, and adds missing columns as null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ],
        *(extra or []),
    )


def event_reject_reason() -> Column:
    """Why an event row does not fit the table, or null if it does."""
    checks = [
        (F.col("event_start").isNull(), "event_start is null"),
        (F.col("event_peak").isNull(), "event_peak is null"),
        (F.col("event_end").isNull(), "event_end is null"),
        (F.length("magnitude") > 8, "magnitude is longer than 8"),
        (F.length("instrument") > 10, "instrument is longer than 10"),
        (~F.col("source").isin(SOURCES), "source is unknown"),
    ]
    return F.coalesce(*[F.when(bad, F.lit(why)) for bad, why in checks])


def conform_events(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Event rows in table types: whole-second times, NaN as null, and a ``reject_reason``.

    ``extra`` names further columns to keep, such as the arrival order. A ``reject_hint``
    of the source is the reason if it is there.
    """
    hint = ["reject_hint"] if "reject_hint" in df.columns else []
    out = align(df, EVENTS, [*(extra or []), *hint])
    times = {c: whole_second(F.col(c)) for c in ("event_start", "event_peak", "event_end")}
    numbers = {
        f.name: null_if_nan(F.col(f.name))
        for f in EVENTS.fields
        if isinstance(f.dataType, T.DoubleType)
    }
    reasons = [*map(F.col, hint), event_reject_reason()]
    return out.withColumns({**times, **numbers}).withColumn(
        "reject_reason", F.coalesce(*reasons)
    ).drop(*hint)
