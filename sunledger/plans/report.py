"""The tables behind the yearly report."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions import timecols as tc
from sunledger.functions.numeric import half_away
from sunledger.functions.solar import days_since_epoch, sun_position
from sunledger.operators.pivot import drop_empty_columns
from sunledger.operators.spine import steps
from sunledger.plans.base import place_of_installation, selling_prices
from sunledger.plans.battery import battery_health
from sunledger.plans.energy import energy_flow_per_day, yearly_internal_consumption_share
from sunledger.plans.finance import accumulated_yearly_co2_savings, amortization
from sunledger.plans.production import best_performing_days, peaks, weekly_quartiles, yearly_production
from sunledger.plans.weather import ZONE
from sunledger.tables import SITE, Tables

TREND_MONTHS = 120


def report_year(t: Tables, *, as_of: date) -> DataFrame:
    """Year of the newest measurement, or of ``as_of`` for a site without any."""
    newest = t["measurements"].groupBy(SITE).agg(F.max("measured_on").alias("newest"))
    sites = t["domain_values"].select(SITE).distinct()
    return sites.join(newest, SITE, "full").select(
        SITE, F.coalesce(tc.year("newest"), F.lit(as_of.year).cast("bigint")).alias("year")
    )


def other_years(t: Tables, *, as_of: date) -> DataFrame:
    """The years with measurements, without the newest."""
    years = t["measurements"].select(SITE, tc.year("measured_on").alias("year")).distinct()
    newest = F.max("year").over(Window.partitionBy(SITE))
    return years.withColumn("__n", newest).where(F.col("year") != F.col("__n")).drop("__n")


def feed_in_price_list(t: Tables, *, as_of: date) -> DataFrame:
    """Partial feed-in prices as text, '-' for an open end."""
    sell = selling_prices(t, as_of=as_of).where("type = 'partial_sell'")
    text = [F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in ("valid_from", "valid_until", "value")]
    return sell.select(SITE, *text)


def amortization_trend(t: Tables, *, as_of: date, months: int = TREND_MONTHS) -> DataFrame:
    """Amortisation continued to ``months`` months by a straight line through the known values.

    Known months stay, however far they reach; a gap between them is filled too.

    The line runs over the month number of rows where both balances are known,
    and only fills what is missing.  A site with as many months already is
    returned as it is.
    """
    known = amortization(t, as_of=as_of).withColumn("month", tc.day("month"))
    w = Window.partitionBy(SITE)
    sized = known.select(
        "*",
        F.count("*").over(w).alias("n"),
        F.min("month").over(w).alias("first"),
        F.max("month").over(w).alias("last"),
    )
    short = F.col("n") < months
    position = F.round(F.months_between("month", "first")).cast("int")
    cell = F.map_from_entries(F.collect_list(F.struct(position.alias("x"), F.struct("full_export", "partial_export"))))
    # Fewer than `months` cells per short site fit in one row; that row then carries its own spine.
    grid = (
        sized.where(short)
        .groupBy(SITE, "first", "last")
        .agg(cell.alias("cells"))
        .select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(months - 1), F.array_max(F.map_keys("cells"))))).alias("x"))
        .select(
            SITE,
            F.add_months("first", F.col("x")).alias("month"),
            "last",
            F.col("x").cast("double").alias("x"),
            F.try_element_at("cells", F.col("x")).alias("cell"),
        )
        .select(SITE, "month", "last", "x", "cell.full_export", "cell.partial_export")
    )
    both = F.col("full_export").isNotNull() & F.col("partial_export").isNotNull()

    def filled(name: str) -> Column:
        y = F.when(both, F.col(name))
        line = F.regr_slope(y, F.col("x")).over(w) * F.col("x") + F.regr_intercept(y, F.col("x")).over(w)
        return F.coalesce(F.col(name), line).alias(name)

    continued = grid.select(
        SITE, "month", filled("full_export"), filled("partial_export"), (F.col("month") > F.col("last")).alias("extrapolated")
    )
    complete = sized.where(~short).select(
        SITE, "month", "full_export", "partial_export", F.lit(False).alias("extrapolated")
    )
    return continued.unionByName(complete).withColumn("month", tc.as_ntz("month"))


def yearly_summary(t: Tables, *, as_of: date) -> DataFrame:
    """Production, shares, battery and CO2 savings of each year side by side."""
    keys = [SITE, "year"]
    shares = yearly_internal_consumption_share(t, as_of=as_of)
    shares = shares.select(*keys, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("internal_consumption", "autarchy")])
    battery = battery_health(t, as_of=as_of)
    co2 = accumulated_yearly_co2_savings(t, as_of=as_of).withColumnRenamed("total", "co2_savings")
    joined = yearly_production(t, as_of=as_of).join(shares, keys, "left").join(battery, keys, "left").join(co2, keys, "left")
    na = F.lit("n/a")
    return joined.select(
        *keys,
        "worst",
        "best",
        "daily_avg",
        "daily_median",
        "total",
        # text, as what is not known is shown as such: a year before the start day has no shares
        *[F.coalesce(F.col(c).cast("string"), na).alias(c) for c in ("total_yield", "internal_consumption", "autarchy", "health", "capacity")],
        "co2_savings",
    )


def data_period(df: DataFrame, column: str) -> DataFrame:
    """First and last value of a time column per site."""
    return df.groupBy(SITE).agg(F.min(column).alias("min"), F.max(column).alias("max"))


def summer_quartiles(t: Tables, *, year: int, as_of: date) -> DataFrame:
    """Weekly quartiles from spring equinox on for six months, the quartiles in columns."""
    first, last = date(year, 3, 21), date(year, 9, 21)
    part = t.limited(first, last + timedelta(days=7), "measurements", "weather_data")
    sow = F.col("sow")
    weeks = weekly_quartiles(part, as_of=as_of).where(
        (sow >= tc.as_ntz(tc.date_lit(first))) & (sow <= tc.as_ntz(tc.date_lit(last)))
    )
    quartile = [F.col("quartiles")[i].alias(n) for i, n in enumerate(("q1", "med", "q3"))]
    return weeks.select(SITE, "sow", "week", "min", *quartile, "max", "shortwave_radiation", "cloud_coverage")


def maximal_peak(t: Tables, *, as_of: date) -> DataFrame:
    """Highest power ever measured, in whole W."""
    top = F.max(half_away(F.col("production")))
    return peaks(t, as_of=as_of).groupBy(SITE).agg(top.alias("max_peak"))


def best_day_of_year(t: Tables, *, year: int, as_of: date) -> DataFrame:
    """Best day of one year; only that year's measurements are read."""
    part = t.limited(date(year, 1, 1), date(year + 1, 1, 1), "measurements")
    return best_performing_days(part, as_of=as_of)


def without_empty_months(view: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """A month-by-hour matrix without the months nobody measured."""
    return drop_empty_columns(view, [SITE, "hour"], names)


def area_series(t: Tables, *, year: int, as_of: date) -> DataFrame:
    """Stacked daily series of one year: own use, import, feed-in, and the line of total consumption."""
    part = t.limited(date(year, 1, 1), date(year + 1, 1, 1), "measurements")
    d = energy_flow_per_day(part, as_of=as_of)
    feed_in = F.greatest(F.col("production") - F.col("consumption") + F.col("import"), F.lit(0.0))
    return d.select(
        SITE,
        "day",
        "internal_consumption",
        "import",
        feed_in.alias("production"),
        (F.col("internal_consumption") + F.col("import")).alias("consumption"),
    )


def _positions(times: DataFrame, zone: str) -> DataFrame:
    """Sun above the horizon in degrees for rows with ``utc``, ``lat`` and ``long``."""
    az, alt = sun_position(days_since_epoch(F.col("utc")), F.col("lat"), F.col("long"))
    found = times.select("*", az.alias("__az"), alt.alias("__alt")).where("__alt > 0")
    return found.select(
        SITE,
        tc.utc_to_local(F.col("utc"), zone).alias("at"),
        "utc",
        F.degrees("__az").alias("azimuth"),
        F.degrees("__alt").alias("altitude"),
    )


def _places(t: Tables, as_of: date) -> DataFrame:
    return place_of_installation(t, as_of=as_of).select(
        SITE, F.col("lat").cast("double").alias("lat"), F.col("long").cast("double").alias("long")
    )


def sun_year(t: Tables, *, year: int, as_of: date, zone: str = ZONE) -> DataFrame:
    """Sun position for every hour of a local year at each site."""
    start = tc.local_to_utc(tc.as_ntz(tc.date_lit(date(year, 1, 1))), zone)
    stop = tc.local_to_utc(tc.as_ntz(tc.date_lit(date(year + 1, 1, 1))), zone)
    last = F.timestamp_add("HOUR", F.lit(-1), stop)
    return _positions(steps(_places(t, as_of), start, last, "1 hour", "utc"), zone)


def sun_days(t: Tables, *, year: int, as_of: date, zone: str = ZONE) -> DataFrame:
    """Sun path by the minute on the solstices, the equinox and each site's best day of the year."""
    fixed = [date(year - 1, 12, 21), date(year, 3, 21), date(year, 6, 21)]
    best = best_day_of_year(t, year=year, as_of=as_of).groupBy(SITE).agg(tc.day(F.min("measured_on")).alias("best"))
    days = (
        _places(t, as_of)
        .join(best, SITE, "left")
        .select(
            "*", F.explode(F.array_compact(F.array_distinct(F.array(*[tc.date_lit(d) for d in fixed], "best")))).alias("d")
        )
    )
    start = tc.local_to_utc(tc.as_ntz("d"), zone)
    stop = tc.local_to_utc(tc.as_ntz(F.date_add("d", 1)), zone)
    times = steps(days, start, stop, "1 minute", "utc").drop("best")
    return _positions(times, zone)


def highest_sun_per_hour(t: Tables, *, year: int, as_of: date, zone: str = ZONE) -> DataFrame:
    """Where the sun stands highest at each hour of the local day."""
    top = F.max(F.struct("altitude", (-days_since_epoch(F.col("utc"))).alias("o"), "azimuth"))
    return (
        sun_year(t, year=year, as_of=as_of, zone=zone)
        .groupBy(SITE, tc.hour("at").alias("hour"))
        .agg(top.alias("top"))
        .select(SITE, "hour", "top.azimuth", "top.altitude")
    )
