"""From raw readings to rows ready for a merge.

All functions give one row per (site, local quarter hour).  Grouping on the local
bucket merges the hour that occurs twice when summer time ends, so that the result
is always unique per key.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions import timecols as tc
from sunledger.functions.numeric import NUMERIC, mean
from sunledger.operators.upsert import to_power
from sunledger.plans.weather import ZONE
from sunledger.sources.files import DAILY_COLUMNS, WEATHER_COLUMNS
from sunledger.tables import SITE

# Series names of the vendor's documents and the columns they fill.
POWER_SERIES = {
    "PowerProduced": "production",
    "PowerConsumed": "consumption",
    "PowerOut": "export",
    "PowerIn": "import",
}
STORAGE_SERIES = {"PowerBuffered": "buffered", "PowerReleased": "released", "StateOfCharge": "state_of_charge"}

POWER_RULES = {
    "production": "mean_unless_zero",
    "consumption": "replace",
    "export": "replace",
    "import": "replace",
}
STORAGE_RULES = {c: "keep_first" for c in STORAGE_SERIES.values()}
ZERO_DEFAULTS = {c: 0 for c in ("production", "consumption", "import", "export")}


def _quarters(df: DataFrame, ts: Column, power: Column) -> DataFrame:
    return df.groupBy(SITE, tc.quarter_start(ts).alias("measured_on")).agg(to_power(power).alias("production"))


def logger_quarters(lines: DataFrame) -> DataFrame:
    """Logger samples (``measured_on;power``) to quarter-hour means."""
    return _quarters(lines, F.col("measured_on"), mean("power"))


def fifteen_minute_rows(rows: DataFrame, fmt: str = "yyyy-MM-dd HH:mm") -> DataFrame:
    """Rows that are quarter hours already, with a textual time stamp.

    Of several rows for one quarter (the doubled hour) the largest is kept.
    """
    ts = F.to_timestamp_ntz("DateTime", F.lit(fmt))
    return rows.groupBy(SITE, ts.alias("measured_on")).agg(F.max("power").cast("decimal(8,3)").alias("production"))


def localised_quarters(rows: DataFrame) -> DataFrame:
    """Five-minute kW with decimal comma and missing values to quarter-hour means in W."""
    kw = F.replace(F.coalesce("Leistung", F.lit("0")), F.lit(","), F.lit(".")).cast(NUMERIC)
    return _quarters(rows, F.col("DateTime"), mean(kw) * F.lit(1000.0))


def series_rows(documents: DataFrame) -> DataFrame:
    """Nested series documents to (site, name, ts, v)."""
    flat = documents.select(SITE, F.inline("timeseries")).select(SITE, "name", F.explode("values").alias("ts", "v"))
    return flat


def series_quarters(rows: DataFrame, series: Mapping[str, str], zone: str = ZONE) -> DataFrame:
    """Series names to columns per instant, then the mean per local quarter hour, 0 where there is none."""
    instant = F.unix_seconds(F.to_timestamp("ts", "yyyy-MM-dd'T'HH:mmXXX"))
    wide = (
        rows.groupBy(SITE, instant.alias("at"))
        .pivot("name", list(series))
        .agg(F.max(F.col("v").cast("decimal(18,6)")))
    )
    epoch = F.lit("1970-01-01 00:00:00").cast(tc.NTZ)
    local = tc.utc_to_local(F.timestamp_add("SECOND", F.col("at"), epoch), zone)
    zero = F.lit(0.0)
    return wide.groupBy(SITE, tc.quarter_start(local).alias("measured_on")).agg(
        *[_stored(c, F.coalesce(mean(n), zero)) for n, c in series.items()]
    )


def _stored(column: str, value: Column) -> Column:
    if column == "state_of_charge":
        return F.rint(value).cast("smallint").alias(column)
    return to_power(value).alias(column)


_PARALLEL_TS = "yyyy-MM-dd'T'HH:mm"


def _parallel(documents: DataFrame, root: str, columns: tuple[str, ...]) -> DataFrame:
    """Arrays that run in parallel to one row per position."""
    arrays = F.arrays_zip(*[F.col(f"{root}.{c}").alias(c) for c in columns])
    return documents.select(SITE, F.inline(arrays)).toDF(SITE, *columns)


def hourly_weather(documents: DataFrame) -> DataFrame:
    rows = _parallel(documents, "hourly", ("time", *WEATHER_COLUMNS))
    return rows.select(
        SITE,
        F.to_timestamp_ntz("time", F.lit(_PARALLEL_TS)).alias("measured_on"),
        *[F.col(c).cast("int" if c == "weather_code" else "decimal(8,3)").alias(c) for c in WEATHER_COLUMNS],
    )


def daily_weather(documents: DataFrame) -> DataFrame:
    kinds = {"sunshine_duration": "bigint", "daylight_duration": "bigint", "precipitation_hours": "int", "weather_code": "int"}
    rows = _parallel(documents, "daily", ("time", "sunrise", "sunset", *DAILY_COLUMNS))
    return rows.select(
        SITE,
        F.to_date("time").alias("ref_date"),
        *[F.to_timestamp_ntz(c, F.lit(_PARALLEL_TS)).alias(c) for c in ("sunrise", "sunset")],
        *[F.col(c).cast(kinds.get(c, "decimal(8,3)")).alias(c) for c in DAILY_COLUMNS],
    )


def battery_packs(documents: DataFrame, as_of: date) -> DataFrame:
    """Pack documents to one list of packs per battery, dated ``as_of``.

    Equal documents count once.  A battery has a handful of packs, so the list is short.
    """
    return (
        documents.select(SITE, F.col("id.sn").alias("serial"), F.col("pk.sn"), F.col("pk.soh"), F.col("pk.op"))
        .distinct()
        .groupBy(SITE, "serial")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("sn").alias("serial"), "soh", "op"))).alias("packs"))
        .select(SITE, tc.date_lit(as_of).alias("ref_date"), "serial", "packs")
    )


def missing_ranges(measurements: DataFrame, as_of: date, *, days: int = 7, sites: DataFrame | None = None) -> DataFrame:
    """Ranges of at most ``days`` days from the day after the last measurement up to yesterday.

    A site without measurements gets the last ``days`` days.
    """
    last = measurements.groupBy(SITE).agg(F.max(tc.day("measured_on")).alias("last"))
    known = last if sites is None else sites.select(SITE).distinct().join(last, SITE, "left")
    yesterday = F.date_sub(tc.date_lit(as_of), 1)
    first = F.coalesce(F.date_add("last", 1), F.date_sub(tc.date_lit(as_of), days))
    return (
        known.select(SITE, first.alias("first"))
        .where(F.col("first") <= yesterday)
        .select(SITE, F.explode(F.sequence("first", yesterday, F.expr(f"interval {days} days"))).alias("start"))
        .select(SITE, "start", F.least(F.date_add("start", days - 1), yesterday).alias("stop"))
    )


def load_report(measurements: DataFrame) -> DataFrame:
    """Number of measurements and the last day per site."""
    return measurements.groupBy(SITE).agg(
        F.count("*").alias("measurements"), F.max(tc.day("measured_on")).alias("last_day")
    )
