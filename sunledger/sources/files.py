"""Readers. Schemas are always declared: inference would scan the input twice and
turn a map keyed by time stamps into one column per time stamp.

Files of several sites live in ``site_id=<n>`` folders; without them all rows
belong to site 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.tables import SITE

LOGGER = "measured_on timestamp_ntz, power decimal(18,6)"
QUARTER_HOURS = "DateTime string, power decimal(18,6)"
LOCALISED = "DateTime timestamp_ntz, Leistung string"
SERIES = "timeseries array<struct<name:string, values:map<string,double>>>"
# Names of the weather service's series.
WEATHER_COLUMNS = (
    "shortwave_radiation",
    "temperature_2m",
    "cloud_cover",
    "cloud_cover_low",
    "cloud_cover_mid",
    "cloud_cover_high",
    "weather_code",
    "precipitation",
    "rain",
    "snowfall",
)
DAILY_COLUMNS = (
    "sunshine_duration",
    "daylight_duration",
    "precipitation_hours",
    "precipitation_sum",
    "temperature_2m_max",
    "temperature_2m_min",
    "weather_code",
)
HOURLY_WEATHER = "hourly struct<time:array<string>, " + ", ".join(f"{c}:array<double>" for c in WEATHER_COLUMNS) + ">"
DAILY_WEATHER = (
    "daily struct<time:array<string>, sunrise:array<string>, sunset:array<string>, "
    + ", ".join(f"{c}:array<double>" for c in DAILY_COLUMNS)
    + ">"
)
PACKS = "id struct<sn:string>, pk struct<sn:string, soh:decimal(4,2), op:bigint>"


def csv_source(
    spark: SparkSession, paths: str | Sequence[str], schema: str, *, sep: str = ";", header: bool = False
) -> DataFrame:
    """CSV files, folders or patterns as one input; their order is irrelevant.

    With a header, columns are found by name: others and another order do no harm, but
    all files of one input have to agree.
    """
    at = paths if isinstance(paths, str) else list(paths)
    if not header:
        return with_site(spark.read.schema(schema).options(sep=sep, mode="FAILFAST").csv(at))
    raw = with_site(spark.read.options(sep=sep, header=True, mode="FAILFAST", enforceSchema=False).csv(at))
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)], SITE)


def json_source(spark: SparkSession, paths: str | Sequence[str], schema: str, *, multiline: bool = True) -> DataFrame:
    """JSON documents, one per file (or per line)."""
    df = (
        spark.read.schema(schema)
        .options(multiLine=multiline, mode="FAILFAST")
        .json(paths if isinstance(paths, str) else list(paths))
    )
    return with_site(df)


def with_site(df: DataFrame) -> DataFrame:
    """The site found in the folder names as an integer, else 0."""
    return df.withColumn(SITE, (F.col(SITE) if SITE in df.columns else F.lit(0)).cast("int"))


def export_tables(tables: dict[str, DataFrame], target: str, *, fmt: str = "csv", compression: str | None = None) -> dict[str, str]:
    """Write each table to ``target/<name>``, as CSV with header or Parquet with ZSTD.

    ``compression`` names another codec; CSV is plain text without one, six to seven times the size of gzip.
    """
    paths = {}
    for name, df in tables.items():
        path = f"{target}/{name}"
        if fmt == "csv":
            nested = [f.name for f in df.schema if f.dataType.typeName() in ("array", "struct", "map")]
            df.withColumns({c: F.to_json(c) for c in nested}).write.options(header=True, compression=compression or "none").csv(path)
        else:
            df.write.option("compression", compression or "zstd").parquet(path)
        paths[name] = path
    return paths
