"""Weather summaries and day/night temperatures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions import timecols as tc
from sunledger.functions.numeric import half_away, mean
from sunledger.functions.solar import days_since_epoch, is_daytime
from sunledger.plans.base import place_of_installation
from sunledger.tables import SITE, Tables

ZONE = "Europe/Berlin"


def monthly_weather(t: Tables, *, as_of: date) -> DataFrame:
    """Mean over the years of each calendar month's rain, sunshine and temperature."""
    twice = F.col("temperature_2m_min") + F.col("temperature_2m_max")
    months = (
        t["daily_weather_data"]
        .groupBy(SITE, F.trunc("ref_date", "month").alias("m"))
        .agg(
            F.sum("precipitation_sum").alias("rain"),
            (F.sum("sunshine_duration").cast("double") / 60.0 / 60.0).alias("sun"),
            (mean(twice) / 2.0).alias("temperature"),
        )
    )
    return months.groupBy(SITE, tc.month("m").alias("month")).agg(
        half_away(mean("rain"), 2).alias("average_precipitation_mm"),
        half_away(F.avg("sun"), 2).alias("average_sunshine_duration_h"),
        half_away(F.avg("temperature"), 2).alias("average_temperature"),
    )


def temperature_extremes(t: Tables, *, year: int, as_of: date, zone: str = ZONE) -> DataFrame:
    """Coldest and warmest night and day of a year by mean temperature; of equal ones the first."""
    m = F.col("measured_on")
    hours = (
        t.limited(date(year, 1, 1), date(year + 1, 1, 1), "weather_data")["weather_data"]
        .select(SITE, "measured_on", "temperature_2m")
        .join(_places(t, as_of), SITE)
    )
    instant = days_since_epoch(tc.local_to_utc(m, zone))
    light = is_daytime(instant, F.col("lat"), F.col("long"))
    daily = (
        hours.select(SITE, "temperature_2m", tc.day(m).alias("day"), light.alias("light"))
        .groupBy(SITE, "day")
        .agg(
            mean(F.when(F.col("light"), F.col("temperature_2m"))).alias("avg_day"),
            mean(F.when(~F.col("light"), F.col("temperature_2m"))).alias("avg_night"),
        )
    )
    picks = []
    for part in ("night", "day"):
        picks += [_lowest(f"avg_{part}").alias(f"lo_{part}"), _highest(f"avg_{part}").alias(f"hi_{part}")]
    found = daily.groupBy(SITE).agg(*picks)
    out = [F.col(SITE)]
    for part in ("night", "day"):
        for label, src in (("min", f"lo_{part}"), ("max", f"hi_{part}")):
            name = f"{label}_avg_{part}"
            out += [half_away(F.col(src)["v"], 2).alias(name), tc.as_ntz(F.col(src)["day"]).alias(f"{name}_at")]
    return found.select(*out)


def _places(t: Tables, as_of: date) -> DataFrame:
    return place_of_installation(t, as_of=as_of).select(
        SITE, F.col("lat").cast("double").alias("lat"), F.col("long").cast("double").alias("long")
    )


def _lowest(col: str) -> Column:
    return F.min(F.when(F.col(col).isNotNull(), F.struct(F.col(col).alias("v"), "day")))


def _highest(col: str) -> Column:
    later_first = (-F.unix_date("day")).alias("o")
    return F.max(F.when(F.col(col).isNotNull(), F.struct(F.col(col).alias("v"), later_first, "day")))
