"""Input files in the raw formats, written by Spark from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.derive import SITE_OF_SUPPLIER, read, readings
from sunledger.functions.numeric import mean
from sunledger.functions.timecols import quarter_start
from sunledger.operators.upsert import to_power
from sunledger.sources.files import DAILY_COLUMNS, WEATHER_COLUMNS
from sunledger.sources.scratch import children, scratch_dir
from sunledger.tables import SITE, conform


def event_types(spark: SparkSession, sf: str) -> list[str]:
    return sorted(r[0] for r in read(spark, sf, "events").select("event_type").distinct().collect())


def watts(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    """(site, measured_on, power) of some event types, or of all."""
    value = (F.col("v").cast("decimal(12,0)") * F.lit("0.001").cast("decimal(4,3)")).cast("decimal(12,3)")
    rows = readings(spark, sf)
    return (rows.where(F.col("name").isin(*names)) if names else rows).select(SITE, F.col("ts").alias("measured_on"), value.alias("power"))


def quarter_watts(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    return (
        watts(spark, sf, *names)
        .groupBy(SITE, quarter_start("measured_on").alias("measured_on"))
        .agg(to_power(mean("power")).alias("production"), F.count("*").alias("n"))
    )


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """Measurements that are there already: some with 0 (only one sample), some with storage values."""
    q = quarter_watts(spark, sf, "view")
    p = F.when(F.col("n") > 1, F.col("production")).otherwise(F.lit(0).cast("decimal(8,3)"))
    cols = q.select(
        SITE,
        "measured_on",
        p.alias("production"),
        F.col("production").alias("consumption"),
        F.when(F.col("n") > 1, F.col("production")).alias("buffered"),
        F.when(F.col("n") > 1, F.lit(7)).alias("state_of_charge"),
    )
    return conform(cols, "measurements")


def _by_site(df: DataFrame) -> DataFrame:
    """A site's rows to one task, so that its folder gets one file and not one of each task; Spark splits a large site."""
    return df.hint("rebalance", SITE)


def _csv(df: DataFrame, path: str, *, header: bool = False, mode: str = "errorifexists") -> str:
    _by_site(df).write.partitionBy(SITE).options(sep=";", header=header, timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss").mode(mode).csv(path)
    return path


def logger_csv(spark: SparkSession, sf: str, *names: str, path: str | None = None, mode: str = "errorifexists") -> str:
    return _csv(watts(spark, sf, *names), path or f"{scratch_dir(spark)}/logger", mode=mode)


def mixed_csv(spark: SparkSession, sf: str) -> str:
    """Logger lines of different event types as ``;`` without header, as ``,`` with one, and tabs with one, other order and another column."""
    path = f"{scratch_dir(spark)}/mixed"
    types = event_types(spark, sf)
    layouts = ((";", False, lambda df: df), (",", True, lambda df: df), ("\t", True, lambda df: df.select(SITE, F.lit("ok, so far").alias("Status"), "power", "measured_on")))
    for i, (sep, header, laid_out) in enumerate(layouts):
        rows = laid_out(watts(spark, sf, *types[i :: len(layouts)]))
        _by_site(rows).write.partitionBy(SITE).options(sep=sep, header=header, timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss").mode("append").csv(path)
    return path


_LANDED: dict[tuple[str, str], str] = {}


def landed_lines(spark: SparkSession, sf: str) -> str:
    """All logger lines as files by site, written once per application; not to be added to."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LANDED:
        _LANDED[key] = logger_csv(spark, sf)
    return _LANDED[key]


def files_a_batch(spark: SparkSession, path: str) -> int:
    """8 files, or as many as make about 16 micro-batches of all sites' folders: a micro-batch costs the same however little is in it."""
    return max(8, len(children(spark, path)) // 16)


def quarter_csv(spark: SparkSession, sf: str) -> str:
    q = quarter_watts(spark, sf)
    stamp = F.date_format("measured_on", "yyyy-MM-dd HH:mm").alias("DateTime")
    return _csv(q.select(SITE, stamp, F.col("production").alias("power")), f"{scratch_dir(spark)}/quarters")


def localised_csv(spark: SparkSession, sf: str) -> str:
    """kW with decimal comma, the small ones missing."""
    scaled = F.floor(F.col("power") * 10).cast("decimal(9,0)") * F.lit("0.001").cast("decimal(4,3)")
    kw = F.when(F.col("power") >= 2, F.replace(scaled.cast("string"), F.lit("."), F.lit(",")))
    # a column that no reader asks for, and not the order of the declared ones
    rows = watts(spark, sf).select(SITE, kw.alias("Leistung"), F.lit("ok").alias("Status"), F.col("measured_on").alias("DateTime"))
    return _csv(rows, f"{scratch_dir(spark)}/localised", header=True)


def series_json(spark: SparkSession, sf: str, names: dict[str, str]) -> str:
    """One document per site and day: five-minute values as a map per series (288 at most); all series, renamed where a name is given."""
    five = F.timestamp_add(
        "MINUTE", F.hour("ts") * 60 + F.floor(F.minute("ts") / 5).cast("int") * 5, F.col("ts").cast("date").cast("timestamp_ntz")
    )
    renamed = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("name")]
    rows = (
        readings(spark, sf)
        .groupBy(SITE, five.alias("at"), F.coalesce(renamed, F.concat(F.lit("Other"), F.col("name"))).alias("name"))
        .agg((F.max("v") / 1000.0).alias("v"))
        .withColumn("ts", F.concat(F.date_format(F.timestamp_add("HOUR", F.lit(1), F.col("at")), "yyyy-MM-dd'T'HH:mm"), F.lit("+01:00")))
    )
    series = rows.groupBy(SITE, F.col("at").cast("date").alias("d"), "name").agg(
        F.map_from_entries(F.collect_list(F.struct("ts", "v"))).alias("values")
    )
    docs = series.groupBy(SITE, "d").agg(F.collect_list(F.struct("name", "values")).alias("timeseries"))
    return _json(docs.drop("d"), spark, "series")


def _json(docs: DataFrame, spark: SparkSession, kind: str) -> str:
    path = f"{scratch_dir(spark)}/{kind}"
    _by_site(docs).write.partitionBy(SITE).json(path)
    return path


def _parallel(df: DataFrame, root: str, time: Column, month: Column, columns: tuple[str, ...], stamps: tuple[str, ...] = ()) -> DataFrame:
    """One document per site and month, its columns as parallel arrays."""
    cols = [time.alias("time")]
    cols += [F.date_format(s, "yyyy-MM-dd'T'HH:mm").alias(s) for s in stamps]
    cols += [F.col(c).cast("double").alias(c) for c in columns]
    docs = df.groupBy(SITE, month.alias("m")).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("r"))
    arrays = [F.col("r")[c].alias(c) for c in ("time", *stamps, *columns)]
    return docs.select(SITE, F.struct(*arrays).alias(root))


def hourly_json(spark: SparkSession, weather: DataFrame) -> str:
    time = F.date_format("measured_on", "yyyy-MM-dd'T'HH:mm")
    month = F.trunc(F.col("measured_on").cast("date"), "month")
    return _json(_parallel(weather, "hourly", time, month, WEATHER_COLUMNS), spark, "hourly")


def daily_json(spark: SparkSession, weather: DataFrame) -> str:
    docs = _parallel(
        weather, "daily", F.col("ref_date").cast("string"), F.trunc("ref_date", "month"), DAILY_COLUMNS, ("sunrise", "sunset")
    )
    return _json(docs, spark, "daily")


def pack_json(spark: SparkSession, sf: str) -> str:
    """One document per pack, the last pack twice."""
    rows = read(spark, sf, "supplier").selectExpr(
        f"{SITE_OF_SUPPLIER} site_id", "s_name", "s_suppkey k", "explode(array(1, 2, 3, 3)) x"
    )
    docs = rows.selectExpr(
        "site_id",
        "named_struct('sn', s_name) id",
        "named_struct('sn', concat(s_name, '-', x), 'soh', cast(95 - (k + x) % 10 as decimal(4,2)), 'op', k * x * 7200) pk",
    )
    return _json(docs, spark, "packs")


def raw_measurements(spark: SparkSession, sf: str) -> DataFrame:
    """Unchecked rows straight from ``lineitem``: repeated keys, missing and out-of-range values."""
    return read(spark, sf, "lineitem").selectExpr(
        "cast(l_suppkey div 34 as int) site_id",
        "timestampadd(MINUTE, cast((l_orderkey * 4 + l_linenumber) % 96 * 15 as int), l_shipdate) measured_on",
        "case when l_discount > 0 then cast(l_extendedprice * 0.1 as decimal(8,3)) end production",
        "cast(l_quantity as decimal(8,3)) consumption",
        "cast(0 as decimal(8,3)) import",
        "cast(0 as decimal(8,3)) export",
        "cast(null as decimal(8,3)) buffered",
        "cast(null as decimal(8,3)) released",
        "cast(l_quantity * 6 as int) state_of_charge",
    )
