"""Energy flows, own consumption and self-sufficiency."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions import timecols as tc
from sunledger.functions.numeric import guarded_percent, half_away, kwh, or_zero, own_use_sum, percent, ratio
from sunledger.operators.pivot import month_columns
from sunledger.plans.base import since_first_readings
from sunledger.tables import SITE, Tables

FLOWS = ("production", "consumption", "import", "export", "buffered", "released")


def _flow(name: str) -> Column:
    return or_zero(name) if name in ("buffered", "released") else F.col(name)


def energy_flow_per_day(t: Tables, *, as_of: date) -> DataFrame:
    """Daily energies in kWh with the shares of own use and self-sufficiency."""

    def e(total: Column) -> Column:
        return half_away(kwh(total), 2)

    days = (
        t["measurements"]
        .groupBy(SITE, tc.day("measured_on").alias("day"))
        .agg(
            *[e(F.sum(_flow(n))).alias(n) for n in FLOWS],
            e(own_use_sum() - F.sum(_flow("buffered"))).alias("direct_consumption"),
            e(own_use_sum()).alias("internal_consumption"),
        )
    )
    days = since_first_readings(days, t, F.col("day")).withColumn("day", tc.as_ntz("day"))
    own = F.col("internal_consumption")
    return days.select(
        "*",
        guarded_percent(own, F.col("production")).alias("internal_consumption_share"),
        guarded_percent(
            own + F.col("released"), F.col("consumption") + F.col("buffered"), guard=F.col("consumption")
        ).alias("autarchy"),
    )


def monthly_flows(t: Tables) -> DataFrame:
    """Summed powers of each month, with its first measurement."""
    return (
        t["measurements"]
        .groupBy(SITE, tc.month_start("measured_on").alias("month"))
        .agg(*[F.sum(_flow(n)).alias(n) for n in FLOWS], F.min("measured_on").alias("first"))
    )


def energy_flow_per_month(t: Tables, *, as_of: date) -> DataFrame:
    """Monthly energies per site, and a row with month NULL for the site's total."""
    months = monthly_flows(t)
    # Sums of sums: only the months, not the measurements, pass the second level.
    both = months.groupingSets([[SITE, "month"], [SITE]], SITE, "month").agg(
        *[half_away(kwh(F.sum(n)), 2).alias(n) for n in FLOWS]
    )
    return both.withColumn("month", tc.as_ntz("month"))


def _share_inputs() -> list[Column]:
    return [
        F.sum("production").alias("production"),
        F.sum(or_zero("released")).alias("released"),
        (F.sum("consumption") + F.sum(F.when(F.col("consumption").isNotNull(), or_zero("buffered")))).alias("consumption"),
        own_use_sum().alias("own"),
    ]


def _daily_share_inputs(t: Tables) -> DataFrame:
    days = t["measurements"].groupBy(SITE, tc.day("measured_on").alias("day")).agg(*_share_inputs())
    return since_first_readings(days, t, F.col("day"))


def _shares(totals: DataFrame, *keys: str, share: Callable[[Column, Column], Column] = guarded_percent) -> DataFrame:
    p, r, c, own = (F.col(n) for n in ("production", "released", "consumption", "own"))
    return totals.select(*keys, share(own, p).alias("internal_consumption"), share(own + r, c).alias("autarchy"))


def yearly_internal_consumption_share(t: Tables, *, as_of: date) -> DataFrame:
    """Shares per year; unlike the other views this one shows 100 where no power is known at all, and 0 only where it is 0."""
    totals = (
        _daily_share_inputs(t)
        .groupBy(SITE, tc.year("day").alias("year"))
        .agg(*[kwh(F.sum(n)).alias(n) for n in ("production", "released", "consumption", "own")])
    )
    return _shares(totals, SITE, "year", share=lambda part, whole: F.when(whole == 0, F.lit(0.0)).otherwise(percent(part, whole)))


def _configured_sites(t: Tables) -> DataFrame:
    """Sites with any configuration; the others never lose rows to a start date."""
    return t["domain_values"].select(SITE).distinct()


def overall_internal_consumption_share(t: Tables, *, as_of: date) -> DataFrame:
    """Shares over all time; a site whose measurements all precede its start shows 0."""
    totals = (
        _daily_share_inputs(t)
        .groupBy(SITE)
        .agg(*[kwh(F.sum(n)).alias(n) for n in ("production", "released", "consumption", "own")])
    )
    return _shares(_configured_sites(t).join(totals, SITE, "full"), SITE)


def average_internal_consumption_share_per_hour(t: Tables, *, as_of: date) -> DataFrame:
    """Mean shares per hour of the day; hours without data show 0."""
    # Four quarter hours become one row before the start day is looked up, so the
    # measurements themselves are never joined.
    names = ("production", "released", "consumption", "own")
    # A mean leaves out rows without a value; the released and own power of a row count as 0 then.
    counts = {"production": F.count("production"), "consumption": F.count("consumption"), "released": F.count("*"), "own": F.count("*")}
    hourly = (
        t["measurements"]
        .groupBy(SITE, tc.day("measured_on").alias("day"), F.hour("measured_on").alias("h"))
        .agg(*_share_inputs(), *[c.alias(f"n_{k}") for k, c in counts.items()])
    )
    totals = (
        since_first_readings(hourly, t, F.col("day"))
        .groupBy(SITE, tc.big(F.col("h")).alias("hour"))
        .agg(*[ratio(F.sum(c), F.sum(f"n_{c}")).alias(c) for c in names])
    )
    # A day has 24 cells; as a map they are looked up on the spine without a second pass over the totals.
    cells = totals.groupBy(SITE).agg(
        F.map_from_entries(
            F.collect_list(F.struct("hour", F.struct(*names)))
        ).alias("cells")
    )
    spine = _configured_sites(t).join(cells, SITE, "full").select(
        SITE, "cells", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(23).cast("bigint"))).alias("hour")
    )
    cell = F.try_element_at("cells", F.col("hour"))
    return _shares(spine.select(SITE, "hour", cell.alias("cell")).select(SITE, "hour", "cell.*"), SITE, "hour")


def _hourly_mean(t: Tables, total: Column, count: Column) -> DataFrame:
    """Mean per clock hour in thousands, reduced to (month, hour of day) sums and counts."""
    hourly = (
        t["measurements"]
        .groupBy(SITE, tc.day("measured_on").alias("day"), F.hour("measured_on").alias("hour"))
        .agg((ratio(total, count) / 1000.0).alias("v"))
    )
    return hourly.groupBy(SITE, F.trunc("day", "month").alias("month"), tc.big(F.col("hour")).alias("hour")).agg(
        F.sum("v").alias("s"), F.count("v").alias("n")
    )


def _by_month_and_hour(monthly: DataFrame) -> DataFrame:
    return month_columns(
        monthly.withColumn("month", F.month("month")), [SITE, "hour"], "month", lambda: F.sum("s") / F.sum("n")
    )


def average_consumption_per_month_and_hour(t: Tables, *, as_of: date) -> DataFrame:
    monthly = since_first_readings(_hourly_mean(t, F.sum("consumption"), F.count("consumption")), t, F.col("month"), whole_months=True)
    return _by_month_and_hour(monthly)


def average_balance_per_month_and_hour(t: Tables, *, as_of: date) -> DataFrame:
    """Export minus import."""
    both = F.col("export").isNotNull() & F.col("import").isNotNull()
    balance = F.sum(F.when(both, F.col("export"))) - F.sum(F.when(both, F.col("import")))
    monthly = since_first_readings(_hourly_mean(t, balance, F.count_if(both)), t, F.col("month"), whole_months=True)
    return _by_month_and_hour(monthly)


def average_production_per_month_and_hour(t: Tables, *, as_of: date) -> DataFrame:
    return _by_month_and_hour(_hourly_mean(t, F.sum("production"), F.count("production")))
