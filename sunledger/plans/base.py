"""Configuration, start of data, price chains: what the other plans build on."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.numeric import half_away
from sunledger.functions.timecols import as_ntz, date_lit
from sunledger.operators.chain import unbroken_chain
from sunledger.tables import SITE, Tables

FIRST_READINGS = "FIRST_PROPER_READINGS_ON"
GROSS = "decimal(9,2)"


def config(t: Tables, name: str, alias: str, dtype: str = "string") -> DataFrame:
    """One configuration value per site that has it."""
    return (
        t["domain_values"]
        .where(F.col("name") == name)
        .groupBy(SITE)
        .agg(F.max(F.col("value").cast(dtype)).alias(alias))
    )


def since_first_readings(df: DataFrame, t: Tables, day: Column, *, whole_months: bool = False) -> DataFrame:
    """Drop rows before the configured first day of proper readings.

    Without such an entry the first measurement is the bound, which excludes no row
    and no day; so the minimum over all measurements is never computed here.  ``day``
    may be coarser than a row, which lets callers aggregate first and join the few
    remaining rows.  ``whole_months`` starts with the month after.  Months that have to
    begin on or after the bound are another matter: see ``amortization``.
    """
    bound = config(t, FIRST_READINGS, "__since", "date")
    if whole_months:
        bound = bound.withColumn("__since", F.trunc(F.add_months("__since", 1), "month"))
    return (
        df.withColumn("__day", day)
        .join(bound, SITE, "left")
        .where(F.col("__since").isNull() | (F.col("__day") >= F.col("__since")))
        .drop("__since", "__day")
    )


def beginning_of_measurements(t: Tables, *, as_of: date) -> DataFrame:
    """Configured first day, else the first measurement."""
    first = t["measurements"].groupBy(SITE).agg(F.min("measured_on").alias("first"))
    bound = config(t, FIRST_READINGS, "since", "date")
    return first.join(bound, SITE, "full").select(
        SITE, F.coalesce(as_ntz("since"), F.col("first")).alias("value")
    )


def buying_prices(t: Tables, *, as_of: date) -> DataFrame:
    """Chained buying prices, split where the VAT changes, with gross price and relative change."""
    chained = unbroken_chain(t["prices"].where(F.col("type") == "buy"), [SITE], ["value"])
    buy = chained.select(
        SITE,
        F.col("valid_from").alias("b_from"),
        F.col("valid_until").alias("b_until"),
        F.col("value").alias("net"),
    )
    taxed = _with_vat(buy, t["applicable_vat_values"], as_of)
    start = F.greatest("b_from", "v_from")
    w = Window.partitionBy(SITE).orderBy(start)
    before = F.coalesce(F.lag("net").over(w), F.col("net")).cast("double")
    return taxed.select(
        SITE,
        start.alias("valid_from"),
        F.least("b_until", "v_until").alias("valid_until"),
        "net",
        half_away((F.col("net").cast("double") - before) / before, 4).alias("change"),
        "tax",
        F.round(F.col("net") * (F.col("tax") + F.lit(1).cast("decimal(2,1)")), 2).cast(GROSS).alias("gross"),
    )


def _with_vat(buy: DataFrame, vat: DataFrame, as_of: date) -> DataFrame:
    """Pair each price with the VAT periods that touch it.

    Either the VAT period starts within the price's period (an open price gets none that way), or it started before and
    ends after the price's first day.  There is one list of VAT periods for a whole country, a calendar bounds it; it meets
    every price as one row, so a pair costs a row however long either period is.
    """
    periods = F.array_sort(F.collect_list(F.struct(F.col("valid_from").alias("v_from"), F.col("valid_until").alias("v_until"), F.col("value").alias("tax"))))
    # one row on the right: an aggregate without grouping
    listed = vat.agg(periods.alias("__vat"))

    def touches(v: Column) -> Column:
        begins = (v["v_from"] >= F.col("b_from")) & (v["v_from"] <= F.col("b_until"))
        runs = (v["v_from"] < F.col("b_from")) & (F.coalesce(v["v_until"], date_lit(as_of)) > F.col("b_from"))
        return begins | runs

    return buy.crossJoin(listed).select(*buy.columns, F.inline(F.filter("__vat", touches)))


def selling_prices(t: Tables, *, as_of: date) -> DataFrame:
    """Chained feed-in prices per type."""
    sell = t["prices"].where(F.col("type").isin("partial_sell", "full_sell"))
    return unbroken_chain(sell, [SITE, "type"], ["value"]).select(SITE, "valid_from", "valid_until", "value", "type")


def current_buy(t: Tables, *, as_of: date) -> DataFrame:
    """Newest buying price (of equal starts the open one) with the newest VAT."""
    order = Window.partitionBy(SITE).orderBy(F.col("valid_from").desc(), F.col("valid_until").desc_nulls_first())
    newest = (
        t["prices"]
        .where(F.col("type") == "buy")
        .withColumn("pos", F.rank().over(order))
        .where("pos = 1")
        .select(SITE, F.col("value").alias("net"))
    )
    vat = t["applicable_vat_values"].agg(F.max_by("value", "valid_from").alias("tax"))
    gross = F.round(F.col("net") * (F.col("tax") + F.lit(1).cast("decimal(2,1)")), 2).cast(GROSS)
    # one row on the right: an aggregate without grouping
    return newest.crossJoin(vat).where(F.col("tax").isNotNull()).select(SITE, "net", "tax", gross.alias("gross"))


#: Fixed value: the place of a site that names none.
DEFAULT_PLACE = ("50.775555", "6.083611")


def place_of_installation(t: Tables, *, as_of: date) -> DataFrame:
    """Latitude and longitude per site, with the default place where unset."""
    coord = "decimal(8,6)"

    def pick(name: str, default: str) -> Column:
        value = F.max(F.when(F.col("name") == name, F.col("value"))).cast("decimal(7,5)")
        return F.coalesce(value.cast(coord), F.lit(default).cast(coord))

    return (
        t["domain_values"]
        .groupBy(SITE)
        .agg(pick("LATITUDE", DEFAULT_PLACE[0]).alias("lat"), pick("LONGITUDE", DEFAULT_PLACE[1]).alias("long"))
    )
