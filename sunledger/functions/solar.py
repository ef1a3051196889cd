"""Position of the sun and daylight as plain column expressions.

Standard low-precision solar equations (mean anomaly, equation of the centre,
ecliptic to equatorial to horizontal coordinates), good to about 0.1 degrees.
Times are days since 2000-01-01 12:00 UTC; angles are radians unless named
degrees; azimuth counts from south towards west.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Astronomical constants in degrees (and days for the transit terms).
OBLIQUITY = 23.4397
PERIHELION = 102.9372
ANOMALY_0, ANOMALY_RATE = 357.5291, 0.98560028
CENTRE_1, CENTRE_2, CENTRE_3 = 1.9148, 0.02, 0.0003
SIDEREAL_0, SIDEREAL_RATE = 280.16, 360.9856235
TRANSIT_0, TRANSIT_ANOMALY, TRANSIT_LONGITUDE = 0.0009, 0.0053, -0.0069
HORIZON = -0.833

_RAD = math.pi / 180.0
_SIN_E, _COS_E = math.sin(OBLIQUITY * _RAD), math.cos(OBLIQUITY * _RAD)


def days_since_epoch(utc: Column) -> Column:
    """Days since 2000-01-01 12:00 of a UTC timestamp without zone."""
    start = F.lit("2000-01-01 12:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", start, utc).cast("double") / F.lit(86400.0)


def _anomaly(days: Column) -> Column:
    return (F.lit(ANOMALY_0) + F.lit(ANOMALY_RATE) * days) * F.lit(_RAD)


def _longitude(anomaly: Column) -> Column:
    centre = (
        F.lit(CENTRE_1) * F.sin(anomaly)
        + F.lit(CENTRE_2) * F.sin(anomaly * 2.0)
        + F.lit(CENTRE_3) * F.sin(anomaly * 3.0)
    ) * F.lit(_RAD)
    return anomaly + centre + F.lit(PERIHELION * _RAD) + F.lit(math.pi)


def _declination(longitude: Column) -> Column:
    return F.asin(F.lit(_SIN_E) * F.sin(longitude))


def sun_position(days: Column, lat: Column, long: Column) -> tuple[Column, Column]:
    """(azimuth, altitude) for a place given in degrees."""
    lon = _longitude(_anomaly(days))
    dec = _declination(lon)
    ascension = F.atan2(F.sin(lon) * F.lit(_COS_E), F.cos(lon))
    sidereal = (F.lit(SIDEREAL_0) + F.lit(SIDEREAL_RATE) * days + long) * F.lit(_RAD)
    hour_angle = sidereal - ascension
    phi = lat * F.lit(_RAD)
    azimuth = F.atan2(F.sin(hour_angle), F.cos(hour_angle) * F.sin(phi) - F.tan(dec) * F.cos(phi))
    altitude = F.asin(F.sin(phi) * F.sin(dec) + F.cos(phi) * F.cos(dec) * F.cos(hour_angle))
    return azimuth, altitude


def daylight(days: Column, lat: Column, long: Column) -> tuple[Column, Column]:
    """(sunrise, sunset) of the solar day around an instant, NaN where the sun stays up or down."""
    west = -long / 360.0
    cycle = F.round(days - F.lit(TRANSIT_0) - west)
    noon_guess = cycle + F.lit(TRANSIT_0) + west
    anomaly = _anomaly(noon_guess)
    lon = _longitude(anomaly)
    dec = _declination(lon)
    shift = F.lit(TRANSIT_ANOMALY) * F.sin(anomaly) + F.lit(TRANSIT_LONGITUDE) * F.sin(lon * 2.0)
    phi = lat * F.lit(_RAD)
    half_arc = F.acos(
        (F.lit(math.sin(HORIZON * _RAD)) - F.sin(phi) * F.sin(dec)) / (F.cos(phi) * F.cos(dec))
    ) / F.lit(2.0 * math.pi)
    return noon_guess + shift - half_arc, noon_guess + shift + half_arc


def is_daytime(days: Column, lat: Column, long: Column) -> Column:
    """Whether the sun is up; without sunrise or sunset it counts as night."""
    rise, down = daylight(days, lat, long)
    known = ~F.isnan(rise)
    return known & (days >= rise) & (days <= down)
