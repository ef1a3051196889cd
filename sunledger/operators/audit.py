"""Checks for the constraints that Parquet tables do not enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.tables import SITE, Tables

UNIQUE: dict[str, tuple[tuple[str, ...], ...]] = {
    "measurements": ((SITE, "measured_on"),),
    "domain_values": ((SITE, "name"), ("id",)),
    "applicable_vat_values": (("valid_from",),),
    "prices": ((SITE, "type", "valid_from"), ("id",)),
    "official_measurements": ((SITE, "period_start", "period_end"), ("id",)),
    "co2_factor_per_year": (("year",),),
    "weather_data": ((SITE, "measured_on"),),
    "daily_weather_data": ((SITE, "ref_date"),),
    "battery_health": ((SITE, "ref_date", "serial"),),
    "other_utilities": ((SITE, "year", "type"),),
    "gas_parameters": ((SITE, "year"),),
}
NULLABLE: dict[str, tuple[str, ...]] = {
    "measurements": ("buffered", "released", "state_of_charge"),
    "applicable_vat_values": ("valid_until",),
    "prices": ("valid_until",),
    "official_measurements": ("export",),
    "battery_health": ("packs",),
}
ALLOWED: dict[tuple[str, str], tuple[str, ...]] = {
    ("prices", "type"): ("buy", "full_sell", "partial_sell"),
    ("other_utilities", "type"): ("electricity", "water", "gas"),
}
RANGES: dict[tuple[str, str], tuple[int, int]] = {
    ("measurements", "state_of_charge"): (0, 2**8 - 1),
    ("weather_data", "weather_code"): (0, 2**16 - 1),
    ("daily_weather_data", "sunshine_duration"): (0, 2**32 - 1),
    ("daily_weather_data", "daylight_duration"): (0, 2**32 - 1),
    ("daily_weather_data", "precipitation_hours"): (0, 2**16 - 1),
    ("daily_weather_data", "weather_code"): (0, 2**16 - 1),
    ("other_utilities", "year"): (0, 2**16 - 1),
    ("gas_parameters", "year"): (0, 2**16 - 1),
}


def audit(t: Tables | Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """One row per rule: table, rule, number of rows (or surplus rows of a key) that break it."""
    return reduce(DataFrame.unionByName, [part for n in names for part in _table_rules(t[n], n)])


def _table_rules(df: DataFrame, name: str) -> list[DataFrame]:
    """Rules of the columns that ``df`` has; a table may come without its ``id``."""
    return [_row_rules(df, name)] + [_unique(df, name, keys) for keys in UNIQUE.get(name, ()) if set(keys) <= set(df.columns)]


def _row_rules(df: DataFrame, name: str) -> DataFrame:
    """NOT NULL, value lists and ranges, counted in one pass."""
    rules: dict[str, Column] = {}
    for c in df.columns:
        if c not in NULLABLE.get(name, ()):
            rules[f"not_null({c})"] = F.col(c).isNull()
    for (tab, c), values in ALLOWED.items():
        if tab == name:
            rules[f"allowed({c})"] = ~F.col(c).isin(*values)
    for (tab, c), (lo, hi) in RANGES.items():
        if tab == name:
            rules[f"range({c})"] = ~F.col(c).between(lo, hi)
    counted = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    rows = F.array(
        *[F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations")) for i, rule in enumerate(rules)]
    )
    return counted.select(F.lit(name).alias("table_name"), F.inline(rows))


def _unique(df: DataFrame, name: str, keys: tuple[str, ...]) -> DataFrame:
    n = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return n.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("table_name"), F.lit(f"unique({', '.join(keys)})").alias("rule"), "violations"
    )
