"""Import jobs: raw input to a stored table, ready to be scheduled.

Measurements, weather and battery records are versioned tables (``sources/versioned.py``) split by month or day.  Each job
merges one delivery by the rule of its source, touches only the partitions of the delivery, and publishes in one step.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.operators import ingest, presence, upsert
from sunledger.plans.weather import ZONE
from sunledger.sources.scratch import remove, scratch_dir
from sunledger.sources.versioned import VersionedTable
from sunledger.tables import DDL, PARTITIONS, SITE, TIMES, co2_factors, vat_periods

KEYS = (SITE, "measured_on")

def month_of(ts: str = "measured_on") -> Column:
    return F.date_format(ts, "yyyy-MM")


def table(spark: SparkSession, path: str, name: str = "measurements") -> VersionedTable:
    """The stored table of that name at ``path``."""
    return VersionedTable(spark, path, DDL[name], PARTITIONS[name])


def read(spark: SparkSession, path: str, name: str = "measurements") -> DataFrame:
    """Newest state of a stored table, with its partition column."""
    return table(spark, path, name).read()


def write(df: DataFrame, path: str, name: str = "measurements") -> VersionedTable:
    """Lay out a table that is not there yet."""
    made = table(df.sparkSession, path, name)
    state = made.manifest()
    if state.version:
        raise ValueError(f"there is a table at {path}")
    made.append(df.withColumn(made.partition, month_of(TIMES[name])), state, sort=(SITE, TIMES[name]))
    return made


def write_measurements(df: DataFrame, path: str) -> None:
    """Lay out a measurements table."""
    write(df, path)


def _merge(spark: SparkSession, path: str, incoming: DataFrame, rules: Mapping[str, str]) -> None:
    upsert.merge_into(table(spark, path), incoming, KEYS, rules, month_of(), ingest.ZERO_DEFAULTS)


def import_logger(spark: SparkSession, lines: DataFrame, path: str) -> None:
    _merge(spark, path, ingest.logger_quarters(lines), {"production": "mean_unless_zero"})


def import_quarter_hours(spark: SparkSession, rows: DataFrame, path: str) -> None:
    _merge(spark, path, ingest.fifteen_minute_rows(rows), {"production": "raise_only"})


def import_localised(spark: SparkSession, rows: DataFrame, path: str) -> None:
    _merge(spark, path, ingest.localised_quarters(rows), {"production": "replace"})


def import_power(spark: SparkSession, documents: DataFrame, path: str, zone: str = ZONE) -> None:
    rows = ingest.series_rows(documents)
    _merge(spark, path, ingest.series_quarters(rows, ingest.POWER_SERIES, zone), ingest.POWER_RULES)


def import_storage(spark: SparkSession, documents: DataFrame, path: str, zone: str = ZONE) -> None:
    rows = ingest.series_rows(documents)
    _merge(spark, path, ingest.series_quarters(rows, ingest.STORAGE_SERIES, zone), ingest.STORAGE_RULES)


def append_absent(spark: SparkSession, incoming: DataFrame, path: str, keys: tuple[str, ...]) -> None:
    """Append to a small plain Parquet table (reference rows) what it does not have by key.

    The rows are written to the scratch folder first: the table is read to find them.
    """
    stored = spark.read.parquet(path)
    landed = f"{scratch_dir(spark)}/absent"
    fresh = incoming.join(stored.select(*keys), list(keys), "left_anti")
    upsert.insert_if_absent(stored.limit(0), fresh, keys).write.parquet(landed)
    spark.read.parquet(landed).write.mode("append").parquet(path)
    remove(spark, landed)


def import_hourly_weather(spark: SparkSession, documents: DataFrame, path: str) -> None:
    presence.insert_absent(table(spark, path, "weather_data"), ingest.hourly_weather(documents), KEYS, month_of())


def import_daily_weather(spark: SparkSession, documents: DataFrame, path: str) -> None:
    stored = table(spark, path, "daily_weather_data")
    presence.insert_absent(stored, ingest.daily_weather(documents), (SITE, "ref_date"), month_of("ref_date"))


def import_battery_packs(spark: SparkSession, documents: DataFrame, path: str, as_of: date) -> None:
    """Replace the pack lists of ``as_of``; the table is partitioned by day of record."""
    upsert.merge_into(
        table(spark, path, "battery_health"),
        ingest.battery_packs(documents, as_of),
        (SITE, "ref_date", "serial"),
        {"packs": "replace"},
        F.col("ref_date").cast("string"),
    )


def seed_reference(spark: SparkSession, root: str) -> None:
    """Create the CO2 and VAT tables, or add the rows they lack."""
    for name, rows, key in (
        ("co2_factor_per_year", co2_factors(spark), "year"),
        ("applicable_vat_values", vat_periods(spark), "valid_from"),
    ):
        path = f"{root}/{name}"
        rows.limit(0).write.mode("append").parquet(path)
        append_absent(spark, rows, path, (key,))
