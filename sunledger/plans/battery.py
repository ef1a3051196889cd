"""Battery health and state of charge."""

from __future__ import annotations

from calendar import monthrange
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions import timecols as tc
from sunledger.functions.numeric import half_away, mean
from sunledger.operators.asof import Match, month_index
from sunledger.operators.intervals import interval_join, intervals
from sunledger.plans.base import config
from sunledger.tables import SITE, Tables

CAPACITY = "BATTERY_CAPACITY"


def months_before(day: date, n: int) -> date:
    """The same day ``n`` months earlier, or the last one of a shorter month."""
    year, month = divmod(day.year * 12 + day.month - 1 - n, 12)
    return date(year, month + 1, min(day.day, monthrange(year, month + 1)[1]))


def _soh(t: Tables) -> DataFrame:
    return t["battery_health"].select(SITE, "ref_date", F.explode("packs").alias("p")).select(
        SITE, "ref_date", F.col("p.soh").alias("soh")
    )


def battery_health(t: Tables, *, as_of: date) -> DataFrame:
    """Mean state of health of all packs per year and the capacity left."""
    yearly = _soh(t).groupBy(SITE, tc.year("ref_date").alias("year")).agg(half_away(mean("soh")).alias("health"))
    return yearly.join(config(t, CAPACITY, "__cap", "double"), SITE).select(
        SITE, "year", "health", (F.col("health") / 100.0 * F.col("__cap")).alias("capacity")
    )


def battery_soc(t: Tables, *, as_of: date) -> DataFrame:
    """Charge over the last twelve months.

    Each measurement takes the health recorded next *after* it; without one it is
    left out.
    """
    until, first = tc.as_ntz(tc.date_lit(as_of)), months_before(as_of, 12)
    recent = (
        t.limited(first, as_of + timedelta(days=1), "measurements")["measurements"]
        .where(F.col("state_of_charge").isNotNull() & (F.col("measured_on") <= until))
        .select(SITE, "measured_on", "state_of_charge")
    )
    health = _soh(t).where(F.col("ref_date") >= tc.date_lit(first)).groupBy(SITE, "ref_date").agg(mean("soh").alias("soh"))
    # A battery's health is recorded a few times a year: it goes to the measurements, not they to it.
    next_one = intervals(Match(health, tc.as_ntz("ref_date"), {"soh": "soh"}), by=[SITE], bucket=month_index, forward=True)
    found = interval_join(recent, F.col("measured_on"), next_one, ["soh"], inner=True)
    capacity = half_away(F.col("soh") / 100.0 * F.col("__cap"), 1)
    return (
        found.join(config(t, CAPACITY, "__cap", "double"), SITE)
        .withColumn("capacity", capacity)
        .select(
            SITE,
            "measured_on",
            F.col("state_of_charge").cast("int").alias("state_of_charge"),
            "capacity",
            half_away(F.col("state_of_charge").cast("double") / 100.0 * F.col("capacity"), 1).alias("charge"),
        )
    )
