"""Production statistics and the weather next to them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions import timecols as tc
from sunledger.functions.numeric import NUMERIC, energy, half_away, half_even_int, mean
from sunledger.operators.asof import Match
from sunledger.operators.intervals import day_index, interval_join, intervals
from sunledger.plans.base import config
from sunledger.plans.energy import energy_flow_per_day
from sunledger.tables import MONTH, SITE, Tables

# Cloud cover in quarters of the sky.
CLOUD_GLYPHS = ("○", "◔", "◑", "◕", "●")


def _slots_as_days(count: Column) -> Column:
    return half_even_int(count.cast("double") / 96.0)


def _daily_production(t: Tables) -> DataFrame:
    return t["measurements"].groupBy(SITE, tc.day("measured_on").alias("day")).agg(energy("production").alias("v"))


def average_production_per_hour(t: Tables, *, as_of: date) -> DataFrame:
    """Mean production and mean radiation per hour of the day.

    A weather row describes the hour before its time stamp, hence it is matched
    from one hour earlier on.
    """
    m = t["measurements"].select(SITE, "measured_on", "production")
    shifted = F.timestamp_add("HOUR", F.lit(-1), F.col("measured_on"))
    weather = intervals(Match(t["weather_data"], shifted, {"shortwave_radiation": "shortwave_radiation"}), by=[SITE], bucket=day_index)
    matched = interval_join(m, F.col("measured_on"), weather, ["shortwave_radiation"])
    return matched.groupBy(SITE, tc.hour("measured_on").alias("hour")).agg(
        half_away(mean("production") / 1000.0, 2).alias("production"),
        half_away(mean("shortwave_radiation") / 1000.0, 2).alias("shortwave_radiation"),
    )


def average_production_per_month(t: Tables, *, as_of: date) -> DataFrame:
    """Mean monthly production over the complete months, next to the mean monthly radiation."""
    full = (
        t["measurements"]
        .groupBy(SITE, tc.month_start("measured_on").alias("start"))
        .agg(energy("production").alias("kwh"), F.count("*").alias("n"))
        .where(_slots_as_days(F.col("n")) == F.day(F.last_day("start")))
    )
    solar = (
        t["weather_data"]
        .groupBy(SITE, tc.month_start("measured_on").alias("start"))
        .agg((F.sum("shortwave_radiation").cast("double") / 1000.0).alias("kwh_m2"))
    )
    return (
        full.join(solar, [SITE, "start"], "left")
        .groupBy(SITE, tc.month("start").alias("month"))
        .agg(
            half_away(F.avg("kwh"), 2).alias("production"),
            half_away(F.avg("kwh_m2"), 2).alias("shortwave_radiation"),
        )
    )


def weekly_quartiles(t: Tables, *, as_of: date) -> DataFrame:
    """Spread of daily production per ISO week.

    Each day weighs as often as it has weather rows (the days are joined to the
    hours before the quantiles are taken); a day without weather weighs once.
    """
    days = _daily_production(t).select(SITE, "day", half_away(F.col("v"), 2).alias("production"))
    weather = t["weather_data"].select(
        SITE, tc.day("measured_on").alias("day"), "shortwave_radiation", "cloud_cover_low"
    )
    # Per day: how often it counts, its radiation, and the cloud sums. This stands
    # for the fanned-out rows without building them.
    per_day = weather.groupBy(SITE, "day").agg(
        F.count("*").alias("w"),
        (F.sum("shortwave_radiation").cast("double") / 1000.0).alias("kwh_m2"),
        F.sum("cloud_cover_low").alias("clouds"),
        F.count("cloud_cover_low").alias("n_clouds"),
    )
    d = days.join(per_day, [SITE, "day"], "left").withColumn("w", F.coalesce("w", F.lit(1)))
    octant = half_even_int(F.sum("clouds").cast("double") / F.sum("n_clouds") / 25.0)
    glyph = F.element_at(F.array(*[F.lit(g) for g in CLOUD_GLYPHS]), octant + 1)
    weighted = F.when(F.col("kwh_m2").isNotNull(), F.col("w"))
    return d.groupBy(
        SITE, tc.as_ntz(tc.week_start("day")).alias("sow"), tc.iso_week("day").alias("week")
    ).agg(
        F.min("production").alias("min"),
        F.percentile("production", [0.25, 0.5, 0.75], F.col("w")).alias("quartiles"),
        F.max("production").alias("max"),
        half_away(F.sum(F.col("kwh_m2") * F.col("w")) / F.sum(weighted), 2).alias("shortwave_radiation"),
        F.when(octant.between(0, len(CLOUD_GLYPHS) - 1), glyph).alias("cloud_coverage"),
    )


def _production_stats() -> list[Column]:
    return [
        half_away(F.min("v"), 2).alias("worst"),
        half_away(F.max("v"), 2).alias("best"),
        half_away(F.avg("v"), 2).alias("daily_avg"),
        half_away(F.median("v"), 2).alias("daily_median"),
        half_away(F.sum("v"), 2).alias("total"),
    ]


def _with_yield(totals: DataFrame, t: Tables) -> DataFrame:
    """Total per installed kW peak, NULL where the peak power is unknown."""
    peak = config(t, "INSTALLED_PEAK_POWER", "__peak", NUMERIC)
    per_peak = half_away(F.col("total") / F.col("__peak").cast("double"), 2).cast(NUMERIC)
    return totals.join(peak, SITE, "left").withColumn("total_yield", per_peak).drop("__peak")


def yearly_production(t: Tables, *, as_of: date) -> DataFrame:
    """Worst, best, mean and median day and the total of each year, days without production left out."""
    days = _daily_production(t).where("v <> 0")
    return _with_yield(days.groupBy(SITE, tc.year("day").alias("year")).agg(*_production_stats()), t)


def overall_production(t: Tables, *, as_of: date) -> DataFrame:
    days = _daily_production(t).where("v <> 0")
    return _with_yield(days.groupBy(SITE).agg(*_production_stats()), t)


def peaks(t: Tables, *, as_of: date) -> DataFrame:
    """Smallest and largest nonzero power of each site and when it was last seen."""
    lit = t["measurements"].where(F.col("production") != 0)
    # Partial aggregation leaves a row per site.  These are sent around for the second pass, so that Spark neither sends the
    # measurements, however small they look, nor deals them out by site alone.
    extremes = lit.groupBy(SITE).agg(F.min("production").alias("low"), F.max("production").alias("high"))
    hit = F.col("production").eqNullSafe(F.col("low")) | F.col("production").eqNullSafe(F.col("high"))
    last = lit.join(F.broadcast(extremes), SITE).where(hit).groupBy(SITE, "production").agg(F.max("measured_on").alias("last_time_measured"))
    return last.select(SITE, F.round("production", 2).cast("decimal(8,2)").alias("production"), "last_time_measured")


def best_performing_days(t: Tables, *, as_of: date) -> DataFrame:
    """All quarter hours of the best day of each year (ties keep all), with radiation and low clouds."""
    best = Window.partitionBy(SITE, "year").orderBy(F.col("production").desc())
    top = (
        energy_flow_per_day(t, as_of=as_of)
        .select(SITE, tc.year("day").alias("year"), tc.day("day").alias("day"), "production")
        .withColumn("rnk", F.rank().over(best))
        .where("rnk = 1")
        .select(SITE, "day")
    )
    # As few rows as months, whatever ties there are.  A semi join may only send these around, never the measurements, which
    # look small to Spark where a compressed or generated table grows when read.
    found = top.groupBy(F.col(SITE).alias("__site"), F.date_format("day", "yyyy-MM").alias("__month")).agg(F.collect_set("day").alias("__days"))
    same = [F.col(SITE) == F.col("__site"), F.col(MONTH) == F.col("__month"), F.array_contains("__days", F.col("day"))]
    chosen = (
        t.by_month("measurements")
        .select(SITE, MONTH, "measured_on", "production", tc.day("measured_on").alias("day"))
        .join(found, same, "left_semi")
        .select(SITE, tc.year("day").alias("year"), "measured_on", "production")
    )
    # Both values come from one pass over the weather: a row describes the hour before its time stamp, so the radiation is
    # that of an hour later.
    both = {"shortwave_radiation": "shortwave_radiation", "cloud_coverage": "cloud_cover_low"}
    weather = intervals(Match(t["weather_data"], F.col("measured_on"), both), by=[SITE], bucket=day_index, sent=False)
    sunny = interval_join(chosen, F.timestamp_add("HOUR", F.lit(1), F.col("measured_on")), weather, ["shortwave_radiation"])
    return interval_join(sunny, F.col("measured_on"), weather, ["cloud_coverage"])


def monthly_number_of_measurements(t: Tables, *, as_of: date) -> DataFrame:
    """Completeness check: measurements per month, in days."""
    return (
        t["measurements"]
        .groupBy(SITE, tc.month_start("measured_on").alias("start"))
        .agg(_slots_as_days(F.count("*")).alias("days"))
        .select(SITE, tc.year("start").alias("y"), tc.month("start").alias("m"), "days")
    )
