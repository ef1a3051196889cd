"""Registered queries over the driver's tables, and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import derive, expected, expected_ingest, expected_report, landing, oracle
from fixtures.derive import AS_OF, tables
from sunledger import catalog
from sunledger.functions import timecols as tc
from sunledger.operators import audit, ingest, spine, surrogate, upsert
from sunledger.operators.asof import Match, asof_join, month_index
from sunledger.operators.chain import unbroken_chain
from sunledger.operators.intervals import day_index, interval_join, intervals
from sunledger.operators.pivot import MONTHS
from sunledger.plans import imports, report, weather
from sunledger.sources import dialect, files
from sunledger.sources.scratch import scratch_dir
from sunledger.sources.versioned import VersionedTable
from sunledger.streaming import logger
from sunledger.tables import DDL, MONTH, SITE, co2_factors, vat_periods

Query = Callable[[SparkSession, str], DataFrame]

KEYS = [SITE, "measured_on"]
YEAR = 2000
#: "today" of the range planner, later than the last measurement
PLANNED_ON = date(2001, 12, 31)
#: event types of the first of two deliveries
FIRST_TYPES = ("click", "error")
#: weather known before the import
KNOWN_UNTIL = "1998-01-01"


# Sums of doubles depend on their order in the last digits. Results that no view
# rounds are therefore compared at single precision: both sides are cast to it and back.
def _single(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(f"`{c}`").cast("float").cast("double") for c in cols})


def _months(df: DataFrame) -> DataFrame:
    return _single(df, *[str(m) for m in MONTHS])


def _quartiles(df: DataFrame) -> DataFrame:
    return df.withColumn("quartiles", F.col("quartiles").cast("array<float>").cast("array<double>"))


_AFTER: dict[str, Callable[[DataFrame], DataFrame]] = {
    "average_consumption_per_month_and_hour": _months,
    "average_production_per_month_and_hour": _months,
    "average_balance_per_month_and_hour": _months,
    "weekly_quartiles": _quartiles,
}


def _view(name: str) -> Query:
    view, _ = catalog.VIEWS[name]
    after = _AFTER.get(name, lambda df: df)
    return lambda spark, sf: after(view(tables(spark, sf), as_of=AS_OF))


QUERIES: dict[str, Query] = {name: _view(name) for name in catalog.VIEWS}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- the operators on their own ---------------------------------------------


def _matched_months(spark: SparkSession, sf: str, forward: bool) -> DataFrame:
    t = tables(spark, sf)
    w = Match(t["weather_data"], F.col("measured_on"), {"radiation": "shortwave_radiation"})
    m = t["measurements"].select(*KEYS)
    found = asof_join(m, F.col("measured_on"), [w], by=[SITE], forward=forward, inner=forward, bucket=month_index)
    return found.groupBy(SITE, tc.as_ntz(tc.month_start("measured_on")).alias("month")).agg(
        F.count("*").alias("n"), F.count("radiation").alias("matched"), F.sum("radiation").cast("double").alias("radiation")
    )


@query
def asof_backward(spark, sf):
    return _matched_months(spark, sf, False)


@query
def asof_forward(spark, sf):
    return _matched_months(spark, sf, True)


def _radiation(spark: SparkSession, sf: str) -> tuple[DataFrame, Match]:
    t = tables(spark, sf)
    return t["measurements"].select(*KEYS), Match(t["weather_data"], F.col("measured_on"), {"radiation": "shortwave_radiation"})


@query
def asof_rows(spark, sf):
    """Every measurement with the weather before and after it, by the union form."""
    m, w = _radiation(spark, sf)
    found = asof_join(m, F.col("measured_on"), [w], by=[SITE], bucket=month_index).withColumnRenamed("radiation", "before")
    places = m.select(SITE, month_index(F.col("measured_on")))
    later = asof_join(found, F.col("measured_on"), [w], by=[SITE], forward=True, bucket=month_index, buckets=places)
    return later.withColumnRenamed("radiation", "after")


@query
def asof_rows_by_intervals(spark, sf):
    """The same by the other form."""
    m, w = _radiation(spark, sf)
    found = interval_join(m, F.col("measured_on"), intervals(w, by=[SITE], bucket=day_index), ["radiation"]).withColumnRenamed("radiation", "before")
    later = intervals(w, by=[SITE], bucket=day_index, forward=True)
    return interval_join(found, F.col("measured_on"), later, ["radiation"]).withColumnRenamed("radiation", "after")


@query
def price_chain(spark, sf):
    return unbroken_chain(derive.prices(spark, sf), [SITE, "type"], ["value"])


# --- report -----------------------------------------------------------------


@query
def report_year(spark, sf):
    return report.report_year(tables(spark, sf), as_of=AS_OF)


@query
def other_years(spark, sf):
    return report.other_years(tables(spark, sf), as_of=AS_OF)


@query
def feed_in_price_list(spark, sf):
    return report.feed_in_price_list(tables(spark, sf), as_of=AS_OF)


@query
def amortization_trend(spark, sf):
    return _single(report.amortization_trend(tables(spark, sf), as_of=AS_OF), "full_export", "partial_export")


@query
def yearly_summary(spark, sf):
    return report.yearly_summary(tables(spark, sf), as_of=AS_OF)


@query
def measurement_period(spark, sf):
    return report.data_period(derive.stored_measurements(spark, sf), "measured_on")


@query
def weather_period(spark, sf):
    return report.data_period(derive.daily_weather_data(spark, sf), "ref_date")


@query
def summer_quartiles(spark, sf):
    return _single(report.summer_quartiles(tables(spark, sf), year=YEAR, as_of=AS_OF), "q1", "med", "q3")


@query
def maximal_peak(spark, sf):
    return report.maximal_peak(tables(spark, sf), as_of=AS_OF)


@query
def best_day_of_year(spark, sf):
    return report.best_day_of_year(tables(spark, sf), year=YEAR, as_of=AS_OF)


@query
def matrix_without_empty_months(spark, sf):
    """The matrix over all rows of a table whose second half-years have no production: six of the twelve columns are empty and go."""
    t = tables(spark, sf)
    m = t["measurements"]
    t = t.replaced(measurements=m.withColumn("production", F.when(F.month("measured_on") <= 6, F.col("production"))))
    view = catalog.VIEWS["average_production_per_month_and_hour"][0](t, as_of=AS_OF)
    names = {str(m): date(YEAR, m, 1).strftime("m%m") for m in MONTHS}
    short = report.without_empty_months(view, names)
    return _single(short, *[c for c in short.columns if c not in (SITE, "hour")])


@query
def area_series(spark, sf):
    df = report.area_series(tables(spark, sf), year=YEAR, as_of=AS_OF)
    return _single(df, "production", "consumption")


@query
def sun_year(spark, sf):
    return _single(report.sun_year(tables(spark, sf), year=YEAR, as_of=AS_OF), "azimuth", "altitude")


@query
def sun_days(spark, sf):
    return _single(report.sun_days(tables(spark, sf), year=YEAR, as_of=AS_OF), "azimuth", "altitude")


@query
def highest_sun_per_hour(spark, sf):
    return _single(report.highest_sun_per_hour(tables(spark, sf), year=YEAR, as_of=AS_OF), "azimuth", "altitude")


@query
def temperature_extremes(spark, sf):
    return weather.temperature_extremes(tables(spark, sf), year=YEAR, as_of=AS_OF)


# --- sources, ingest, merge ---------------------------------------------------


@query
def csv_logger_lines(spark, sf):
    return files.csv_source(spark, landing.logger_csv(spark, sf), files.LOGGER)


@query
def csv_many_files(spark, sf):
    """Several deliveries in one folder are one input."""
    landed = f"{scratch_dir(spark)}/lines"
    for name in landing.event_types(spark, sf):
        landing.logger_csv(spark, sf, name, path=landed, mode="append")
    return files.csv_source(spark, landed, files.LOGGER)


@query
def csv_detected(spark, sf):
    """Lines in three layouts side by side, read without a word about delimiter, header or order of columns."""
    return dialect.detected_csv(spark, landing.mixed_csv(spark, sf), files.LOGGER)


@query
def import_logger(spark, sf):
    lines = files.csv_source(spark, landing.logger_csv(spark, sf), files.LOGGER)
    rules = {"production": "mean_unless_zero"}
    return upsert.merge(landing.stored(spark, sf), ingest.logger_quarters(lines), KEYS, rules, ingest.ZERO_DEFAULTS)


@query
def import_quarter_hours(spark, sf):
    rows = files.csv_source(spark, landing.quarter_csv(spark, sf), files.QUARTER_HOURS)
    rules = {"production": "raise_only"}
    return upsert.merge(landing.stored(spark, sf), ingest.fifteen_minute_rows(rows), KEYS, rules, ingest.ZERO_DEFAULTS)


@query
def import_localised(spark, sf):
    rows = files.csv_source(spark, landing.localised_csv(spark, sf), files.LOCALISED, header=True)
    rules = {"production": "replace"}
    return upsert.merge(landing.stored(spark, sf), ingest.localised_quarters(rows), KEYS, rules, ingest.ZERO_DEFAULTS)


def _series(spark: SparkSession, sf: str, names: dict[str, str]) -> DataFrame:
    docs = files.json_source(spark, landing.series_json(spark, sf, names), files.SERIES, multiline=False)
    return ingest.series_rows(docs)


@query
def import_power_series(spark, sf):
    names = dict(zip(("purchase", "click", "view", "error"), ingest.POWER_SERIES, strict=True))
    incoming = ingest.series_quarters(_series(spark, sf, names), ingest.POWER_SERIES)
    return upsert.merge(landing.stored(spark, sf), incoming, KEYS, ingest.POWER_RULES, ingest.ZERO_DEFAULTS)


@query
def import_storage_series(spark, sf):
    names = dict(zip(("purchase", "click", "signup"), ingest.STORAGE_SERIES, strict=True))
    incoming = ingest.series_quarters(_series(spark, sf, names), ingest.STORAGE_SERIES)
    return upsert.merge(landing.stored(spark, sf), incoming, KEYS, ingest.STORAGE_RULES, ingest.ZERO_DEFAULTS)


@query
def import_hourly_weather(spark, sf):
    all_rows = derive.weather_data(spark, sf)
    known = all_rows.where(F.col("measured_on") < F.lit(KNOWN_UNTIL).cast("timestamp_ntz")).withColumn(
        "shortwave_radiation", F.lit(0).cast("decimal(8,3)")
    )
    docs = files.json_source(spark, landing.hourly_json(spark, all_rows), files.HOURLY_WEATHER, multiline=False)
    path = f"{scratch_dir(spark)}/weather"
    imports.write(known, path, "weather_data")
    imports.import_hourly_weather(spark, docs, path)
    return imports.read(spark, path, "weather_data").drop(MONTH)


@query
def import_daily_weather(spark, sf):
    all_rows = derive.daily_weather_data(spark, sf)
    known = all_rows.where(F.col("ref_date") < F.lit(KNOWN_UNTIL).cast("date")).withColumn(
        "sunshine_duration", F.lit(0).cast("bigint")
    )
    docs = files.json_source(spark, landing.daily_json(spark, all_rows), files.DAILY_WEATHER, multiline=False)
    path = f"{scratch_dir(spark)}/daily"
    imports.write(known, path, "daily_weather_data")
    imports.import_daily_weather(spark, docs, path)
    return imports.read(spark, path, "daily_weather_data").drop(MONTH)


@query
def import_battery_packs(spark, sf):
    """New pack lists replace stored ones of the same day; half of the stored ones carry that day."""
    stored = derive.battery_health(spark, sf).withColumn(
        "ref_date", F.when(F.month("ref_date") <= 6, F.lit(AS_OF).cast("date")).otherwise(F.col("ref_date"))
    )
    docs = files.json_source(spark, landing.pack_json(spark, sf), files.PACKS, multiline=False)
    incoming = ingest.battery_packs(docs, AS_OF)
    merged = upsert.merge(stored, incoming, [SITE, "ref_date", "serial"], {"packs": "replace"})
    return merged.select(SITE, "ref_date", "serial", F.explode("packs").alias("p")).select(
        SITE, "ref_date", "serial", F.col("p.serial").alias("pack"), "p.soh", "p.op"
    )


@query
def merge_into_table(spark, sf):
    """The import against a Parquet table partitioned by month, which only rewrites the months concerned."""
    path = f"{scratch_dir(spark)}/measurements"
    imports.write_measurements(landing.stored(spark, sf), path)
    lines = files.csv_source(spark, landing.logger_csv(spark, sf), files.LOGGER)
    imports.import_logger(spark, lines, path)
    return imports.read(spark, path).drop(MONTH)


@query
def missing_ranges(spark, sf):
    t = tables(spark, sf)
    return ingest.missing_ranges(t["measurements"], PLANNED_ON, sites=t["domain_values"])


@query
def load_report(spark, sf):
    return ingest.load_report(derive.stored_measurements(spark, sf))


#: what is added up of each exported table, to compare values
EXPORTED = {
    "measurements": "production",
    "weather_data": "shortwave_radiation",
    "daily_weather_data": "sunshine_duration",
    "prices": "value",
    "domain_values": "length(value)",
    "official_measurements": "export",
    "battery_health": "length(serial)",
    "other_utilities": "consumption",
    "gas_parameters": "ab_wert",
    "applicable_vat_values": "value",
    "co2_factor_per_year": "value",
}


def _exported(spark: SparkSession, sf: str, fmt: str) -> DataFrame:
    t = tables(spark, sf)
    paths = files.export_tables({n: t[n] for n in EXPORTED}, f"{scratch_dir(spark)}/export", fmt=fmt, compression="gzip" if fmt == "csv" else None)
    reader = {"csv": lambda p: spark.read.option("header", True).csv(p), "parquet": spark.read.parquet}[fmt]

    def summed(name: str, path: str) -> DataFrame:
        df = reader(path)
        site = F.max(F.col(SITE).cast("int")) if SITE in df.columns else F.lit(None).cast("int")
        total = F.sum(F.expr(EXPORTED[name]).cast("decimal(18,4)")).cast("double")
        return df.agg(F.count("*").alias("n"), site.alias("last_site"), total.alias("total")).select(F.lit(name).alias("table_name"), "*")

    out = None
    for name, path in paths.items():
        out = summed(name, path) if out is None else out.unionByName(summed(name, path))
    return out


@query
def export_parquet(spark, sf):
    return _exported(spark, sf, "parquet")


@query
def export_csv(spark, sf):
    return _exported(spark, sf, "csv")


@query
def export_csv_rows(spark, sf):
    """All hours of weather, written as CSV and read back by their declared types."""
    paths = files.export_tables({"weather_data": tables(spark, sf)["weather_data"]}, f"{scratch_dir(spark)}/export")
    return spark.read.schema(DDL["weather_data"]).option("header", True).csv(paths["weather_data"])


@query
def export_parquet_rows(spark, sf):
    """All measurements, written as Parquet and read back."""
    paths = files.export_tables({"measurements": tables(spark, sf)["measurements"]}, f"{scratch_dir(spark)}/export", fmt="parquet")
    return spark.read.parquet(paths["measurements"])


AUDITED = ("measurements", "prices", "official_measurements", "weather_data", "daily_weather_data", "battery_health",
           "other_utilities", "gas_parameters", "domain_values")


@query
def constraint_audit(spark, sf):
    raw = landing.raw_measurements(spark, sf)
    checked = {n: f(spark, sf) for n, f in derive.SOURCES.items() if n != "measurements"}
    return audit.audit({**checked, "measurements": raw}, AUDITED)


#: tables whose rows are numbered, and the keys in whose order they are
NUMBERED = {
    "domain_values": [SITE, "name"],
    "prices": [SITE, "type", "valid_from"],
    "official_measurements": [SITE, "period_start", "period_end"],
}


def _broken(df: DataFrame, name: str) -> DataFrame:
    """The rows of a table, and those of its first site once more for every rule that a row can break."""
    first = df.where(F.col(SITE) == 0) if SITE in df.columns else df
    copies = [(f.name, None) for f in df.schema if f.name not in audit.NULLABLE.get(name, ())]
    copies += [(c, "other") for t, c in audit.ALLOWED if t == name] + [(c, -1) for t, c in audit.RANGES if t == name]
    return reduce(DataFrame.unionByName, [df, *[first.withColumn(c, F.lit(v).cast(df.schema[c].dataType)) for c, v in copies]])


@query
def constraint_audit_all(spark, sf):
    """All tables with their ids, each rule broken by some rows."""
    t = {n: f(spark, sf) for n, f in derive.SOURCES.items()}
    t |= {n: surrogate.numbered(t[n], keys) for n, keys in NUMBERED.items()}
    t |= {"measurements": landing.raw_measurements(spark, sf), "applicable_vat_values": vat_periods(spark), "co2_factor_per_year": co2_factors(spark)}
    return audit.audit({n: _broken(df, n) for n, df in t.items()}, tuple(t))


@query
def surrogate_ids(spark, sf):
    """Prices are numbered in two deliveries; the second one repeats the first, whose numbers stay."""
    all_prices = derive.prices(spark, sf)
    first = surrogate.numbered(all_prices.where(F.col("valid_from") < F.lit("1997-01-01").cast("date")), NUMBERED["prices"])
    return surrogate.insert_numbered(first, all_prices, NUMBERED["prices"])


@query
def time_spine(spark, sf):
    first = derive.stored_measurements(spark, sf).groupBy(SITE).agg(F.min("measured_on").cast("date").alias("first"))
    return spine.quarter_hours(first, F.col("first"), AS_OF).select(SITE, "ts")


# --- streams ------------------------------------------------------------------


def _streamed(spark: SparkSession, sf: str, **options) -> DataFrame:
    """Quarter hours of one run: those that closed, lines that came late, and what the state still holds."""
    target, cp = (f"{scratch_dir(spark)}/{d}" for d in ("given", "cp"))
    lines = logger.logger_stream(spark, landing.landed_lines(spark, sf), **options)
    logger.run_available(logger.windows(lines), cp, logger.batches_sink(target))
    return logger.delivered_quarters(spark, target, cp).drop("delivery")


@query
def stream_quarters(spark, sf):
    return _streamed(spark, sf)


@query
def stream_late_lines(spark, sf):
    """A second delivery for the same quarter hours meets the stored and the first values by the merge rule.

    The stream is started again from its checkpoint; what it has given out is merged into the stored table after each run.
    """
    landed, target, cp, path = (f"{scratch_dir(spark)}/{d}" for d in ("lines", "given", "cp", "measurements"))
    table = imports.write(landing.stored(spark, sf), path)
    types = landing.event_types(spark, sf)
    for i, names in enumerate(([n for n in types if n in FIRST_TYPES], [n for n in types if n not in FIRST_TYPES])):
        landing.logger_csv(spark, sf, *names, path=landed, mode="append")
        logger.run_available(logger.windows(logger.logger_stream(spark, landed), delivery=i), cp, logger.batches_sink(target))
        state = logger.settle(spark, target, table)
    open_yet = logger.delivered_quarters(spark, target, cp, after=int(state.properties[logger.LEDGER]))
    return logger.fold_deliveries(table.read(state), open_yet)


@query
def stream_replayed_lines(spark, sf):
    """Every line delivered twice counts once, by the open windows of the second run or by the settled lines."""
    landed, target, cp = (f"{scratch_dir(spark)}/{d}" for d in ("lines", "given", "cp"))
    table = VersionedTable(spark, f"{scratch_dir(spark)}/lines", logger.LINES, "day")
    for _ in range(2):
        landing.logger_csv(spark, sf, path=landed, mode="append")
        logger.run_available(logger.windows(logger.logger_stream(spark, landed), once=True), cp, logger.batches_sink(target))
        logger.settle_lines(spark, target, table)
    return logger.lines_once(spark, table, cp)


@query
def stream_equals_batch(spark, sf):
    """Windows of a stream in many micro-batches and of the batch import side by side."""
    landed = landing.landed_lines(spark, sf)
    batch = ingest.logger_quarters(files.csv_source(spark, landed, files.LOGGER))
    s = _streamed(spark, sf, maxFilesPerTrigger=landing.files_a_batch(spark, landed)).withColumnRenamed("production", "streamed")
    return batch.join(s, KEYS, "full").select(*KEYS, "production", "streamed")


def oracle_sql() -> dict[str, str]:
    bodies = {**expected.EXPECTED, **expected_report.EXPECTED, **expected_ingest.EXPECTED}
    views = {**expected.VIEWS, **expected_report.VIEWS, **expected_ingest.VIEWS}
    return {n: oracle.with_tables(sql, views) for n, sql in bodies.items() if n in QUERIES}
