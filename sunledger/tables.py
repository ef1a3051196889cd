"""Declared schemas, reference rows and the container the plans read from."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.sources.scratch import children
from sunledger.sources.versioned import VersionedTable

SITE = "site_id"
#: Partition column of the tables that are stored by month, as ``yyyy-MM``.
MONTH = "month"

#: Column DDL per table. ``site_id`` separates installations; tables without it
#: (VAT, CO2 factors) hold for a whole country.
DDL: dict[str, str] = {
    "measurements": "site_id int, measured_on timestamp_ntz, production decimal(8,3), consumption decimal(8,3), "
    "import decimal(8,3), export decimal(8,3), buffered decimal(8,3), released decimal(8,3), state_of_charge smallint",
    "domain_values": "id int, site_id int, name string, value string, description string",
    "applicable_vat_values": "valid_from date, valid_until date, value decimal(3,2)",
    "prices": "id int, site_id int, value decimal(5,2), type string, valid_from date, valid_until date",
    "official_measurements": "id int, site_id int, period_start date, period_end date, import decimal(7,2), export decimal(7,2)",
    "co2_factor_per_year": "year int, value int",
    "weather_data": "site_id int, measured_on timestamp_ntz, shortwave_radiation decimal(8,3), temperature_2m decimal(8,3), "
    "cloud_cover decimal(8,3), cloud_cover_low decimal(8,3), cloud_cover_mid decimal(8,3), cloud_cover_high decimal(8,3), "
    "weather_code int, precipitation decimal(8,3), rain decimal(8,3), snowfall decimal(8,3)",
    "daily_weather_data": "site_id int, ref_date date, sunrise timestamp_ntz, sunset timestamp_ntz, sunshine_duration bigint, "
    "daylight_duration bigint, precipitation_hours int, precipitation_sum decimal(8,3), temperature_2m_max decimal(8,3), "
    "temperature_2m_min decimal(8,3), weather_code int",
    "battery_health": "site_id int, ref_date date, serial string, packs array<struct<serial:string,soh:decimal(4,2),op:bigint>>",
    "other_utilities": "site_id int, year int, type string, consumption decimal(8,3)",
    "gas_parameters": "site_id int, year int, ab_wert decimal(6,4), z_zahl decimal(5,4)",
}

#: Time column of the series; what they are partitioned by follows from it.
TIMES: dict[str, str] = {"measurements": "measured_on", "weather_data": "measured_on", "daily_weather_data": "ref_date"}
#: How stored tables are split.
PARTITIONS: dict[str, str] = {**dict.fromkeys(TIMES, MONTH), "battery_health": "day"}

#: Columns that a row may leave out and that then count as 0.
DEFAULT_ZERO: dict[str, tuple[str, ...]] = {
    "measurements": ("production", "consumption", "import", "export"),
}

# Grams of CO2 per kWh in the German power mix, yearly from 1990.
CO2_FIRST_YEAR = 1990
CO2_FACTORS = (
    764, 764, 730, 726, 722, 713, 684, 668, 670, 647, 644, 659, 653, 635, 615, 611, 604,
    622, 581, 567, 556, 568, 574, 573, 559, 528, 524, 486, 473, 411, 369, 410, 434,
)

# German value added tax since 1968 (first day, last day, rate).
VAT_PERIODS = (
    ("1968-01-01", "1968-06-30", "0.10"),
    ("1968-07-01", "1977-12-31", "0.11"),
    ("1978-01-01", "1979-06-30", "0.12"),
    ("1979-07-01", "1983-06-30", "0.13"),
    ("1983-07-01", "1992-12-31", "0.14"),
    ("1993-01-01", "1998-03-31", "0.15"),
    ("1998-04-01", "2006-12-31", "0.16"),
    ("2007-01-01", "2020-06-30", "0.19"),
    ("2020-07-01", "2020-12-31", "0.16"),
    ("2021-01-01", None, "0.19"),
)


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[table])


# Both tables as VALUES: Spark then knows how small they are and may broadcast them.
def co2_factors(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({CO2_FIRST_YEAR + i}, {v})" for i, v in enumerate(CO2_FACTORS))
    return spark.sql(f"select * from values {rows} as t(year, value)")


def vat_periods(spark: SparkSession) -> DataFrame:
    def day(d: str | None) -> str:
        return f"date '{d}'" if d else "cast(null as date)"

    rows = ", ".join(f"({day(lo)}, {day(hi)}, cast({rate} as decimal(3,2)))" for lo, hi, rate in VAT_PERIODS)
    return spark.sql(f"select * from values {rows} as t(valid_from, valid_until, value)")


_BUILT_IN: dict[str, Callable[[SparkSession], DataFrame]] = {
    "co2_factor_per_year": co2_factors,
    "applicable_vat_values": vat_periods,
}


def _by_month(df: DataFrame) -> bool:
    return MONTH in df.columns


def _midnight(day: date) -> Column:
    return F.lit(day).cast("date").cast("timestamp_ntz")


def conform(df: DataFrame, table: str, *more: str) -> DataFrame:
    """Bring a DataFrame to the declared schema (additive migration).

    Missing columns become NULL (0 where the table declares that default), a
    missing ``site_id`` becomes 0, and surplus columns are dropped but for ``more``.
    """
    wanted = schema_of(table)
    if not more and [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in wanted]:
        return df
    zeros = DEFAULT_ZERO.get(table, ())
    cols = []
    for f in wanted:
        if f.name in df.columns:
            c = F.col(f.name).cast(f.dataType)
        elif f.name == SITE or f.name in zeros:
            c = F.lit(0).cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols, *more)


class Tables(Mapping[str, DataFrame]):
    """The base tables by name; VAT and CO2 rows default to the built-in ones.

    A table may be given as a function that returns it: a view then only opens
    the tables it uses.
    """

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self.spark = spark
        self._given = dict(frames)
        self._open: dict[str, DataFrame] = {}

    def _raw(self, name: str) -> DataFrame:
        """A table as it was given, with its partition column."""
        if name not in self._open:
            given = self._given.get(name, _BUILT_IN.get(name))
            if given is None:
                raise KeyError(name)
            self._open[name] = given if isinstance(given, DataFrame) else given() if name in self._given else given(self.spark)
        return self._open[name]

    def __getitem__(self, name: str) -> DataFrame:
        df = self._raw(name)
        return conform(df, name) if name in DDL else df

    def by_month(self, name: str) -> DataFrame:
        """A series with its month, as a column to join on: the partition column, so that whole months can be left out, if it has one."""
        df = self._raw(name)
        month = F.col(MONTH) if _by_month(df) else F.date_format(TIMES[name], "yyyy-MM")
        return conform(df.withColumn("__month", month), name, "__month").withColumnRenamed("__month", MONTH)

    def between(self, name: str, first: date, last: date) -> DataFrame:
        """Rows of a series from ``first`` up to, without, the day ``last``; only the months in between are opened."""
        time = F.col(TIMES[name])
        rows = (time >= _midnight(first)) & (time < _midnight(last))
        df = self._raw(name)
        if _by_month(df):  # says less than the time, but keeps other folders closed
            rows &= F.col(MONTH).between(first.strftime("%Y-%m"), (last - timedelta(days=1)).strftime("%Y-%m"))
        return df.where(rows)

    def limited(self, first: date, last: date, *names: str) -> Tables:
        """The same tables with some series limited to ``[first, last)``."""
        return self.replaced(**{n: self.between(n, first, last) for n in names})

    def replaced(self, **frames: DataFrame) -> Tables:
        """The same tables with some of them exchanged."""
        return Tables(self.spark, {**self._given, **frames})

    def __iter__(self) -> Iterator[str]:
        return iter(self._given)

    def __len__(self) -> int:
        return len(self._given)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names: tuple[str, ...] = tuple(DDL)) -> Tables:
        """Read every table from ``root/<name>``; columns an old file lacks are NULL.

        A table may be one folder, folders by month, or a versioned table.
        """
        return cls(spark, {n: partial(_stored, spark, f"{root}/{n}", n) for n in names})


def _stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    inside = children(spark, path)
    if "manifest" in inside:
        return VersionedTable(spark, path, DDL[name], PARTITIONS[name]).read()
    by = f", {MONTH} string" if any(x.startswith(f"{MONTH}=") for x in inside) else ""
    return spark.read.schema(DDL[name] + by).parquet(path)
