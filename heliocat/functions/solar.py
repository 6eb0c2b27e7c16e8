"""Sun position for a site: altitude above the horizon and azimuth from north.

The longitude is that of Bretagnon and Simon's periodic terms, with nutation and aberration,
turned to the horizon with apparent sidereal time and the obliquity of date; the altitude is
seen from the ground (parallax). Good to 0.001 degrees from 1900 to 2100. ``precise=False``
gives the formula of the Astronomical Almanac (J. J. Michalsky, Solar Energy 40, 1988,
227-235), good to some hundredths of a degree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heliocat.constants import SITE_LATITUDE, SITE_LONGITUDE, SUN_TERMS
from heliocat.functions.times import seconds_since

#: degrees in 1e-7 radians
_SIZE = 5.729577951308232e-06
_CENTURY = 36525.0


def days_since_base(ts: Column) -> Column:
    return seconds_since(ts).cast("double") / F.lit(86400.0)


def _polynomial(x: Column, *factors: float) -> Column:
    """``factors[0] + x * (factors[1] + ...)``"""
    out = F.lit(factors[-1])
    for f in reversed(factors[:-1]):
        out = F.lit(f) + x * out
    return out


def clock_difference(days: Column) -> Column:
    """Seconds by which uniform time is ahead of the earth's rotation.

    Polynomials of F. Espenak and J. Meeus; beyond their years the long-term parabola.
    """
    year = F.lit(2000.0) + days / F.lit(365.25)
    old, new = year - F.lit(1975.0), year - F.lit(2000.0)
    far = (year - F.lit(1820.0)) / F.lit(100.0)
    return (
        F.when(year.between(1961.0, 1986.0), _polynomial(old, 45.45, 1.067, -1 / 260, -1 / 718))
        .when(
            year.between(1986.0, 2005.0),
            _polynomial(new, 63.86, 0.3345, -0.060374, 0.0017275, 0.000651814, 0.00002373599),
        )
        .when(year.between(2005.0, 2050.0), _polynomial(new, 62.92, 0.32217, 0.005589))
        .otherwise(F.lit(-20.0) + F.lit(32.0) * far * far)
    )


def _longitude(c: Column) -> Column:
    """Geometric longitude in degrees, ``c`` centuries of uniform time after 2000. A fold over the terms."""
    terms = F.array(*[F.array(*[F.lit(float(v)) for v in term]) for term in SUN_TERMS])
    one = lambda t: t[0] * F.sin(F.radians(t[1] + t[2] * c))
    total = F.aggregate(terms, F.lit(0.0), lambda done, t: done + one(t))
    return F.lit(282.7771834) + F.lit(36000.76953744) * c + F.lit(_SIZE) * total


def _nutation(c: Column) -> Column:
    """Nutation in longitude, degrees."""
    node = F.radians(F.lit(124.90) - F.lit(1934.134) * c)
    twice = F.radians(F.lit(201.11) + F.lit(72001.5377) * c)
    return F.lit(-0.004778) * F.sin(node) - F.lit(0.0003667) * F.sin(twice)


def _aberration(c: Column) -> Column:
    return F.lit(0.0000974) * F.cos(F.radians(F.lit(177.63) + F.lit(35999.01848) * c)) - F.lit(0.005575)


def _obliquity(c: Column) -> Column:
    """Obliquity of date with its nutation, degrees."""
    node = F.radians(F.lit(125.04452) - F.lit(1934.136261) * c)
    twice = F.radians(F.lit(560.933) + F.lit(72001.5396) * c)
    return F.lit(23.4392911) - F.lit(0.0130042) * c + F.lit(0.002556) * F.cos(node) + F.lit(0.000157) * F.cos(twice)


def _sidereal(days: Column, nutation: Column, obliquity: Column, site_longitude: float) -> Column:
    """Apparent sidereal time at the site, degrees."""
    t = days / F.lit(_CENTURY)
    mean = F.lit(280.46061837) + F.lit(360.98564736629) * days + F.lit(0.000387933) * t * t
    return mean + nutation * F.cos(obliquity) + F.lit(site_longitude)


def _seen_from_the_ground(altitude: Column, days: Column) -> Column:
    """Altitude less the parallax at the sun's distance."""
    anomaly = F.radians(F.lit(357.528) + F.lit(0.9856003) * days)
    distance = F.lit(1.00014) - F.lit(0.01671) * F.cos(anomaly) - F.lit(0.00014) * F.cos(F.lit(2.0) * anomaly)
    return altitude - F.lit(8.794 / 3600.0) / distance * F.cos(F.radians(altitude))


def _almanac(days: Column) -> tuple[Column, Column]:
    """Longitude of the sun and obliquity by the short formula, radians."""
    anomaly = F.radians(F.lit(357.528) + F.lit(0.9856003) * days)
    longitude = (
        F.lit(280.460)
        + F.lit(0.9856474) * days
        + F.lit(1.915) * F.sin(anomaly)
        + F.lit(0.020) * F.sin(F.lit(2.0) * anomaly)
    )
    return F.radians(longitude), F.radians(F.lit(23.439) - F.lit(0.0000004) * days)


def _equatorial(longitude: Column, obliquity: Column, sidereal: Column) -> tuple[Column, Column]:
    """Declination and local hour angle, radians."""
    ascension = F.atan2(F.cos(obliquity) * F.sin(longitude), F.cos(longitude))
    return F.asin(F.sin(obliquity) * F.sin(longitude)), F.radians(sidereal) - ascension


def _horizontal(
    declination: Column, hour_angle: Column, site_latitude: float
) -> tuple[Column, Column]:
    """Altitude and azimuth in degrees, the azimuth still in -180..180."""
    lat = F.radians(F.lit(site_latitude))
    altitude = F.asin(
        F.sin(lat) * F.sin(declination)
        + F.cos(lat) * F.cos(declination) * F.cos(hour_angle)
    )
    azimuth = F.atan2(
        F.lit(-1.0) * F.cos(declination) * F.sin(hour_angle),
        F.sin(declination) * F.cos(lat)
        - F.cos(declination) * F.sin(lat) * F.cos(hour_angle),
    )
    return F.degrees(altitude), F.degrees(azimuth)


def with_refraction(
    altitude: Column, pressure_mbar: float = 1013.25, celsius: float = 14.85
) -> Column:
    """Apparent altitude (Reda and Andreas, Solar Energy 76, 2004), while the disc is in sight."""
    air = pressure_mbar / 1010.0 * 283.0 / (273.0 + celsius)
    lift = F.lit(air * 1.02) / (
        F.lit(60.0) * F.tan(F.radians(altitude + F.lit(10.3) / (altitude + F.lit(5.11))))
    )
    return altitude + F.when(altitude >= -(0.26667 + 0.5667), lift).otherwise(0.0)


def add_sun_position(
    df: DataFrame,
    ts: str,
    altitude: str = "altitude",
    azimuth: str = "azimuth",
    latitude: float = SITE_LATITUDE,
    longitude: float = SITE_LONGITUDE,
    refraction: bool = False,
    precise: bool = True,
) -> DataFrame:
    """Add the sun's altitude above the horizon and its azimuth from north, in degrees.

    The steps are separate projections: one nested expression would repeat its
    inner terms dozens of times and outgrow a generated method.
    """
    c = F.col
    df = df.withColumn("_days", days_since_base(c(ts)))
    if precise:
        df = (
            df.withColumn("_c", (c("_days") + clock_difference(c("_days")) / F.lit(86400.0)) / F.lit(_CENTURY))
            .withColumns({"_geo": _longitude(c("_c")), "_nut": _nutation(c("_c")), "_obl": F.radians(_obliquity(c("_c")))})
            .withColumns(
                {
                    "_lon": F.radians(c("_geo") + c("_nut") + _aberration(c("_c"))),
                    "_sid": _sidereal(c("_days"), c("_nut"), c("_obl"), longitude),
                }
            )
        )
    else:
        lon, obl = _almanac(c("_days"))
        sidereal = F.lit(280.46061837) + F.lit(360.98564736629) * c("_days") + F.lit(longitude)
        df = df.withColumns({"_lon": lon, "_obl": obl, "_sid": sidereal})
    dec, hour = _equatorial(c("_lon"), c("_obl"), c("_sid"))
    alt, az = _horizontal(c("_dec"), c("_hour"), latitude)
    seen = _seen_from_the_ground(c(altitude), c("_days")) if precise else c(altitude)
    return (
        df.withColumns({"_dec": dec, "_hour": hour})
        .withColumns({altitude: alt, "_az": az})
        .withColumns({altitude: seen, azimuth: F.when(c("_az") < 0, c("_az") + 360.0).otherwise(c("_az"))})
        .withColumn(altitude, with_refraction(c(altitude)) if refraction else c(altitude))
        .drop("_days", "_c", "_geo", "_nut", "_lon", "_obl", "_sid", "_dec", "_hour", "_az")
    )
