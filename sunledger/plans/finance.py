"""Costs, savings, amortisation and settlements."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions import timecols as tc
from sunledger.functions.numeric import NUMERIC, energy, half_away, kwh, or_zero
from sunledger.operators.asof import Match, asof_join
from sunledger.operators.pivot import pivot_columns
from sunledger.operators.steps import step_lookup
from sunledger.plans.base import FIRST_READINGS, buying_prices, config, selling_prices, since_first_readings
from sunledger.plans.energy import monthly_flows
from sunledger.tables import SITE, Tables

# Fixed value: the settlement year without usable readings.
UNUSABLE_YEAR = 2010
UTILITIES = ["electricity", "gas", "water"]


def accumulated_yearly_co2_savings(t: Tables, *, as_of: date) -> DataFrame:
    """Kilograms of CO2 not emitted per year by power produced and used at home."""
    days = (
        t["measurements"]
        .groupBy(SITE, tc.day("measured_on").alias("day"))
        .agg(energy("production").alias("production"), energy("export").alias("export"))
    )
    days = since_first_readings(days, t, F.col("day")).withColumn("year", tc.year("day"))
    # The factor depends on the year alone, so it is looked up once per site and year.
    years = days.groupBy(SITE, "year").agg(F.sum(F.col("production") - F.col("export")).alias("own"))
    factors = t["co2_factor_per_year"].select(tc.big(F.col("year")).alias("year"), F.col("value").alias("factor"))
    found = step_lookup(years, "year", factors, "year", ["factor"])
    return found.select(SITE, "year", half_away(F.col("factor") * F.col("own") / 1000.0, 2).alias("total"))


def _price_steps(t: Tables, as_of: date) -> tuple[Match, Match, Match]:
    """Buying (gross), partial and full feed-in prices as as-of partners."""
    buy = buying_prices(t, as_of=as_of).select(SITE, "valid_from", F.col("gross").alias("buy"))
    sell = selling_prices(t, as_of=as_of)
    key = F.col("valid_from")
    return (
        Match(buy, key, {"buy": "buy"}),
        Match(sell.where("type = 'partial_sell'"), key, {"part_sell": "value"}),
        Match(sell.where("type = 'full_sell'"), key, {"full_sell": "value"}),
    )


def accumulated_yearly_energy_costs(t: Tables, *, as_of: date) -> DataFrame:
    """Running cost per year with and without own production; the year of ``as_of`` shows all its months."""
    names = ("consumption", "export", "import")
    measured = (
        t["measurements"]
        .groupBy(SITE, tc.month_start("measured_on").alias("month"))
        .agg(*[F.sum(or_zero(n)).alias(n) for n in names])
    )
    first = F.trunc(tc.date_lit(as_of), "year")
    spine = F.sequence(first, F.add_months(first, 11), F.expr("interval 1 month"))
    # Each month brings the whole spine along as months without values; one value
    # per month then is the full outer join, without a second pass to learn the sites.
    months = F.explode(F.concat(F.array(F.col("month")), spine)).alias("m")
    padded = measured.select(SITE, "month", months, *names).select(
        SITE, F.col("m").alias("month"), *[F.when(F.col("m") == F.col("month"), F.col(n)).alias(n) for n in names]
    )
    unmeasured = t["domain_values"].select(SITE).distinct().select(SITE, F.explode(spine).alias("month"))
    per_month = (
        padded.unionByName(unmeasured, allowMissingColumns=True)
        .groupBy(SITE, "month")
        .agg(*[kwh(F.coalesce(F.max(n), F.lit(0).cast("decimal(18,3)"))).alias(n) for n in names])
    )
    buy, part, _ = _price_steps(t, as_of)
    priced = asof_join(per_month, F.col("month"), [buy, part], by=[SITE])
    w = Window.partitionBy(SITE, F.year("month")).orderBy("month")
    gross, feed = F.col("buy").cast("double"), F.col("part_sell").cast("double")
    without = F.sum(gross * F.col("consumption")).over(w)
    with_pv = F.sum(gross * F.col("import") - feed * F.col("export")).over(w)
    return priced.select(
        SITE,
        tc.as_ntz("month").alias("month"),
        half_away(without / 100.0, 2).alias("cost_without_pv"),
        half_away(with_pv / 100.0, 2).alias("cost_with_pv"),
    )


def amortization(t: Tables, *, as_of: date) -> DataFrame:
    """Running balance of investment and returns per month, for full and for partial feed-in.

    Two asymmetries of the views' definition are kept: only the partial balance
    treats missing prices as no return, and it is rounded to whole units.
    """
    flows = monthly_flows(t).withColumn("first", F.min("first").over(Window.partitionBy(SITE)))
    # The first measurement bounds the months of a site without a start day, so a month that it lies within is left out.
    since = config(t, FIRST_READINGS, "since", "date")
    months = (
        flows.join(since, SITE, "left")
        .where(tc.as_ntz("month") >= F.coalesce(tc.as_ntz("since"), F.col("first")))
        .select(SITE, tc.day("month").alias("month"), *[half_away(kwh(F.col(n)), 2).alias(n) for n in ("production", "export")])
    )
    priced = asof_join(months, F.col("month"), list(_price_steps(t, as_of)), by=[SITE])
    cost = config(t, "ACQUISITION_COST", "cost", NUMERIC)
    priced = priced.join(cost, SITE, "left")
    w = Window.partitionBy(SITE).orderBy("month")

    def price(name: str) -> Column:
        return F.col(name).cast("double")

    produced, exported = F.col("production"), F.col("export")
    full = F.sum(price("full_sell") * produced).over(w) / 100.0
    part = F.sum(price("part_sell") * exported + price("buy") * (produced - exported)).over(w) / 100.0
    start = -F.coalesce(F.col("cost"), F.lit(0).cast(NUMERIC)).cast("double")
    return priced.select(
        SITE,
        tc.as_ntz("month").alias("month"),
        half_away(start + full, 2).alias("full_export"),
        half_away(start + F.coalesce(part, F.lit(0.0))).alias("partial_export"),
    )


def _usable(t: Tables, df: DataFrame, year: Column) -> DataFrame:
    """Drop the unusable year and the year of the installation; sites without a start day drop out."""
    start = config(t, FIRST_READINGS, "__since", "date")
    return df.join(start, SITE).where(~year.isin(UNUSABLE_YEAR) & (year != F.year("__since"))).drop("__since")


def yearly_settlements(t: Tables, *, as_of: date) -> DataFrame:
    """Official readings per September-to-August period, completed by own measurements."""
    september = F.make_date(
        F.year("period_start") - F.when(F.month("period_start") < 9, 1).otherwise(0), F.lit(9), F.lit(1)
    )
    official = t["official_measurements"].select(
        SITE,
        F.least(september, F.trunc("period_start", "month")).alias("period_start"),
        F.date_sub(F.trunc("period_end", "month"), 1).alias("period_end"),
        F.col("import").cast("double").alias("o_import"),
        F.col("export").cast("double").alias("o_export"),
    )
    months = (
        t["measurements"]
        .groupBy(SITE, tc.month_start("measured_on").alias("m"))
        .agg(*[F.sum(n).alias(n) for n in ("import", "export", "consumption")])
    )
    first_year = F.year("m") - F.when(F.month("m") < 9, 1).otherwise(0)
    own = months.groupBy(SITE, first_year.alias("y")).agg(
        *[half_away(kwh(F.sum(n))).alias(n) for n in ("import", "export", "consumption")]
    )
    own = own.withColumn("period_start", F.make_date("y", F.lit(9), F.lit(1))).withColumn(
        "period_end", F.make_date(F.col("y") + 1, F.lit(8), F.lit(31))
    )
    unified = official.join(own.drop("y"), [SITE, "period_start", "period_end"], "full").select(
        SITE,
        "period_start",
        "period_end",
        F.coalesce("o_import", "import").alias("import"),
        F.coalesce("o_export", "export").alias("export"),
        F.coalesce("consumption", "o_import").alias("consumption"),
    )
    unified = _usable(t, unified, F.year("period_end"))
    net = Match(buying_prices(t, as_of=as_of), F.col("valid_from"), {"net": "net"})
    return asof_join(unified, F.col("period_start"), [net], by=[SITE]).select(
        SITE, tc.year("period_end").alias("year"), "import", "export", "consumption", "net"
    )


def yearly_consumption(t: Tables, *, as_of: date) -> DataFrame:
    """Electricity, gas (kWh from m3) and water per year, in columns."""
    converted = F.when(F.col("type") == "water", half_away(F.col("consumption"))).when(
        F.col("type") == "gas",
        half_away(F.round(F.col("consumption") * F.col("ab_wert") * F.col("z_zahl"))),
    )
    others = _usable(t, t["other_utilities"].join(t["gas_parameters"], [SITE, "year"]), F.col("year")).select(
        SITE, tc.big(F.col("year")).alias("year"), "type", converted.alias("consumption")
    )
    electricity = yearly_settlements(t, as_of=as_of).select(
        SITE, "year", F.lit("electricity").alias("type"), "consumption"
    )
    # The maximum makes the choice among several rows of a cell certain and skips NULLs.
    return pivot_columns(
        others.unionByName(electricity), [SITE, "year"], "type", UTILITIES, lambda: F.max("consumption")
    )
