"""Column expressions against plain Python."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from heliocat.constants import FLUX_CLASSES, KP_AP_DEFAULT, KP_AP_STEPS, KP_STEP_MARGIN
from heliocat.functions import flux, geomag, numeric, solar, texts, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def values(spark, xs, type_, f):
    """``f`` over a column ``x`` holding ``xs``, in order."""
    df = spark.createDataFrame(list(enumerate(xs)), f"i int, x {type_}")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_round2_is_pythons_round(spark):
    rng = random.Random(7)
    xs = [rng.uniform(-20, 20) for _ in range(5000)]
    xs += [k / 1000 for k in range(-3000, 3000)] + [k / 8 for k in range(-200, 200)]
    xs += [1.005, 2.675, 0.125, 0.375, -0.125, 1e17, -1e17, 9999999.995]
    # neighbours of halves, where the product is rounded to one
    for k in range(2000):
        half = (rng.randint(0, 10**6) + 0.5) / 100
        xs += [half, math.nextafter(half, 0), math.nextafter(half, math.inf), -half]
    assert values(spark, xs, "double", numeric.round2) == [round(x, 2) for x in xs]


def test_round_to_int_is_half_away_from_zero(spark):
    assert values(spark, [0.5, 1.5, 2.4, -0.5, -1.5], "double", numeric.round_to_int) == [
        1, 2, 2, -1, -2,
    ]


def test_nan_becomes_null(spark):
    assert values(spark, [math.nan, 1.5, None], "double", numeric.null_if_nan) == [None, 1.5, None]


def test_masked_cells_take_the_fill(spark):
    assert values(spark, [None, 2.0], "double", lambda x: numeric.fill_masked(x, -9999.0)) == [
        -9999.0, 2.0,
    ]


def test_truncation_and_out_of_range(spark):
    assert values(spark, [1.9, -1.9, 1e30, math.nan], "double", numeric.truncate_int) == [
        1, -1, None, None,
    ]


def plain_class(x):
    for letter, limit, multiplier in FLUX_CLASSES:
        if x < limit * 10 or letter == "X":
            return letter, round(x * multiplier, 2)


def test_classes_follow_the_code_bounds(spark):
    xs = [3.800934e-07, 0.0, 1e-8, 9.99e-8, 1e-7, 1e-6, 9.999999999999999e-06, 1e-5, 1e-4, 1.29e-3]
    xs += [9.999e-6, 9.99999e-7, -9999.0]  # rounding to 10.0, and a fill value
    rng = random.Random(3)
    xs += [10 ** rng.uniform(-9, -2) for _ in range(2000)]
    got = values(spark, xs, "double", flux.classify_flux)
    assert [tuple(g) for g in got] == [plain_class(x) for x in xs]
    text = values(spark, xs, "double", flux.magnitude)
    assert text == ["%s%s" % plain_class(x) for x in xs]
    assert text[0] == "B3.8" and "C10.0" in text


def test_staged_magnitude_equals_the_expression(spark):
    df = spark.range(500).select((F.col("id") * 7.3e-8).alias("f"))
    out = flux.add_magnitude(df, "f").withColumn("m", flux.magnitude(F.col("f")))
    assert out.columns == ["f", "magnitude", "m"]
    assert out.filter("magnitude <> m").isEmpty()


def test_no_class_without_a_flux(spark):
    assert values(spark, [None, math.nan], "double", flux.magnitude) == [None, None]
    assert values(spark, [None, math.nan], "double", flux.class_letter) == [None, None]


def test_calibration(spark):
    assert values(spark, [7e-6], "double", flux.calibrate) == [7e-6 / 0.7]


def plain_ap(kp):
    return next((ap for step, ap in KP_AP_STEPS if kp <= step + KP_STEP_MARGIN), KP_AP_DEFAULT)


def test_kp_to_ap_by_both_ways(spark):
    xs = [i / 100 for i in range(-50, 1050)] + [s + KP_STEP_MARGIN for s, _ in KP_AP_STEPS]
    expected = [plain_ap(x) for x in xs]
    assert values(spark, xs, "double", geomag.kp_to_ap) == expected
    steps = [(s + KP_STEP_MARGIN, ap) for s, ap in KP_AP_STEPS]
    assert values(spark, xs, "double", lambda x: geomag.step_lookup(x, steps, KP_AP_DEFAULT)) == expected
    in_order = values(spark, sorted(xs), "double", geomag.kp_to_ap)
    assert in_order == sorted(in_order)
    assert values(spark, [math.nan, None], "double", geomag.kp_to_ap) == [400, None]


def test_offsets_from_the_time_base(spark):
    base = dt.datetime(2000, 1, 1, 12)
    xs = [0.0, 1.9, -1.9, 558_286_440.0, math.nan, None, 9.96921e36]
    assert values(spark, xs, "double", times.from_offset_seconds) == [
        base,
        base + dt.timedelta(seconds=1),
        base - dt.timedelta(seconds=1),
        base + dt.timedelta(seconds=558_286_440),
        None, None, None,
    ]


TEXTS = {
    "2024-05-08T21:08:00Z": dt.datetime(2024, 5, 8, 21, 8),
    "2024-05-08T21:08Z": dt.datetime(2024, 5, 8, 21, 8),
    "2024-05-08T21:08:00+02:00": dt.datetime(2024, 5, 8, 19, 8),
    "2024-05-08 21:08:00": dt.datetime(2024, 5, 8, 21, 8),
    "2024-05-08": dt.datetime(2024, 5, 8),
    "Unk": None,
    "": None,
    "10:30": None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_parsing_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert values(spark, list(TEXTS), "string", times.parse_utc) == list(TEXTS.values())
        assert one(spark, times.iso_text(times.utc("2024-05-08 21:08:09"), "+00:00")) == (
            "2024-05-08T21:08:09+00:00"
        )
        assert one(spark, times.seconds_since(times.utc("2000-01-01 12:00:30"))) == 30
        # a time that New York's clocks skip
        skipped = times.utc("2024-03-10 02:30:00.75")
        assert one(spark, times.seconds_since(skipped, "2024-03-10 00:00:00")) == 9000
        assert one(spark, times.iso_text(skipped)) == "2024-03-10T02:30:00"
        assert one(spark, times.truncate(skipped, "HOUR")) == dt.datetime(2024, 3, 10, 2)
        assert one(spark, times.whole_second(skipped)) == dt.datetime(2024, 3, 10, 2, 30, 1)
        assert one(spark, times.parse_utc(F.lit("2024-03-10 02:30:00"))) == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dates(spark):
    texts_ = ["2024-05-08T21:08:00", "2024-05-08T23:59:00+05:00", "2024-05-08", "x", "", None]
    day = dt.date(2024, 5, 8)
    assert values(spark, texts_, "string", times.date_of_text) == [day, day, day, None, None, None]
    parts = lambda y, m, d: one(spark, times.date_of_parts(F.lit(y), F.lit(m), F.lit(d)))
    assert parts(2024, 2, 29) == dt.date(2024, 2, 29)
    assert parts(2023, 2, 30) is None


def test_whole_seconds(spark):
    xs = [
        dt.datetime(2020, 1, 1, 0, 0, 0, 499999),
        dt.datetime(2020, 1, 1, 0, 0, 0, 500000),
        dt.datetime(1960, 1, 1, 0, 0, 59, 600000),
    ]
    assert values(spark, xs, "timestamp_ntz", times.whole_second) == [
        dt.datetime(2020, 1, 1),
        dt.datetime(2020, 1, 1, 0, 0, 1),
        dt.datetime(1960, 1, 1, 0, 1),
    ]


def test_sun_position_against_published_example(spark):
    """2003-10-17 19:30:30 UTC at 39.742476 N, 105.1786 W: altitude 39.872046 without refraction,
    39.888378 with that of 820 millibars and 11 degrees, azimuth 194.340241."""
    moment = spark.range(1).select(times.utc("2003-10-17 19:30:30").alias("t"))
    site = {"latitude": 39.742476, "longitude": -105.1786}
    plain = solar.add_sun_position(moment, "t", **site).first()
    assert plain["altitude"] == pytest.approx(39.872046, abs=0.001)
    assert plain["azimuth"] == pytest.approx(194.340241, abs=0.001)
    air = solar.with_refraction(F.col("altitude"), 820, 11)
    lifted = solar.add_sun_position(moment, "t", **site).select(air.alias("altitude")).first()
    assert lifted["altitude"] == pytest.approx(39.888378, abs=0.001)
    rough = solar.add_sun_position(moment, "t", precise=False, **site).first()
    assert rough["altitude"] == pytest.approx(39.872046, abs=0.02) and rough["azimuth"] == pytest.approx(194.340241, abs=0.02)
    assert solar.add_sun_position(moment, "t").columns == ["t", "altitude", "azimuth"]


def test_sun_longitude_against_published_example(spark):
    """1992-10-13 0h of uniform time: geometric longitude 199.907372, with nutation and aberration 199.906061."""
    c = F.lit(-2636.5 / 36525)
    row = spark.range(1).select(
        solar._longitude(c).alias("geo"), (solar._longitude(c) + solar._nutation(c) + solar._aberration(c)).alias("lon")
    ).first()
    assert row["geo"] % 360 == pytest.approx(199.907372, abs=0.0005)
    assert row["lon"] % 360 == pytest.approx(199.906061, abs=0.0005)


def test_clock_difference(spark):
    """Measured: 45.5 s in 1975, 63.8 in 2000, 66.1 in 2010; 2 minutes more or less in 1600."""
    years = spark.createDataFrame([((y - 2000) * 365.25,) for y in (1975.0, 2000.0, 2010.0, 1600.0)], "d double")
    found = [r[0] for r in years.select(solar.clock_difference(F.col("d"))).collect()]
    assert found == pytest.approx([45.45, 63.86, 66.7, 135], abs=1)


def test_sun_stays_in_range_over_a_year(spark):
    hours = spark.range(0, 8784).select(
        F.timestamp_add("HOUR", F.col("id"), times.utc("2024-01-01 00:00:00")).alias("t")
    )
    low, high, left, right = (
        solar.add_sun_position(hours, "t")
        .agg(F.min("altitude"), F.max("altitude"), F.min("azimuth"), F.max("azimuth"))
        .first()
    )
    assert -90 <= low < -80 and 85 < high <= 90 and 0 <= left and right < 360


def test_text_rules(spark):
    lit = F.lit
    assert one(spark, texts.strip(lit(" \t G15 \n"))) == "G15"
    assert one(spark, texts.join_chars(F.array(lit("X"), lit("1"), lit(".9")))) == "X1.9"
    assert one(spark, texts.first_text(lit(""), lit("B1.0"))) == "B1.0"
    assert one(spark, texts.first_text(lit(None), lit(None))) == ""
    assert one(spark, texts.first_number(lit(0.0), lit(2.5))) == 2.5
    assert one(spark, texts.first_number(lit(0.0), lit(0.0))) == 0.0
    assert one(spark, texts.first_number(lit(None).cast("double"), lit(None).cast("double"))) is None
    assert one(spark, texts.satellite_label(lit(18))) == "G18"
    assert one(spark, texts.satellite_label(lit(None).cast("string"))) == "GNone"
    assert one(spark, texts.one_decimal(lit(1234.56))) == "1,234.6"
    assert one(spark, texts.class_head(lit("X12.9"))) == "X"
    assert one(spark, texts.class_rest(lit("X12.9"))) == "12.9"


def test_metadata_keeps_null_members(spark):
    text = one(spark, texts.metadata_json(F.lit(None).cast("double")))
    assert text == (
        '{"xrslong_flux":null,"total_energy":0,"active_region":0,"latitude":0.0,"longitude":0.0}'
    )


def test_array_repair(spark):
    xs = ['[{"a":1}', ' [{"a":1}]\n', '{"a":1}', "garbage", "[{}\n"]
    assert values(spark, xs, "string", texts.close_json_array) == [
        '[{"a":1}]', '[{"a":1}]', '{"a":1}', "garbage", "[{}]",
    ]


PAGE = """<html><a name=top>none</a><!-- <a href="old.nc"> -->
<script>var x = '<a href="js.nc">';</script>
<A class="x y" HREF='first.nc'>1</A><a data-href="no.nc" href=second.nc>2</a>
<a href="c.json?x=1&amp;y=2">3</a><a href="xray-flares-latest.json">4</a></html>"""


def test_links(spark):
    links = ["first.nc", "second.nc", "c.json?x=1&y=2", "xray-flares-latest.json"]
    assert one(spark, texts.hrefs(F.lit(PAGE))) == links
    assert one(spark, texts.first_href_with_suffix(F.lit(PAGE), ".nc")) == "first.nc"
    assert one(spark, texts.first_href_with_suffix(F.lit(PAGE), ".gz")) is None
    assert one(spark, texts.first_href_equal(F.lit(PAGE), "xray-flares-latest.json")) == links[3]
    assert one(spark, texts.first_href_equal(F.lit(PAGE), "other.json")) is None
    long = "<p>" + "x" * 2_000_000 + "<a " + "k='v' " * 2000 + "href='far.nc'>"
    assert one(spark, texts.first_href_with_suffix(F.lit(long), ".nc")) == "far.nc"
