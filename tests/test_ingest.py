"""Readers, resampling, range planning, audit and streams on small files."""

import json
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sunledger.functions.solar import days_since_epoch, is_daytime, sun_position
from sunledger.operators import audit, ingest
from sunledger.plans import imports
from sunledger.sources import files, scratch
from sunledger.tables import DDL, conform

D = date.fromisoformat


def got(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_logger_files_in_any_number_and_order(spark, tmp_path):
    (tmp_path / "b.csv").write_text("2024-01-01T10:16:00;400.000\n2024-01-01T10:14:59;1234.500\n")
    (tmp_path / "a.csv").write_text("2024-01-01T10:00:00;1000.000\n")
    lines = files.csv_source(spark, str(tmp_path / "*.csv"), files.LOGGER)
    assert got(ingest.logger_quarters(lines), "site_id", "measured_on", "production") == [
        (0, datetime(2024, 1, 1, 10, 0), Decimal("1117.250")),
        (0, datetime(2024, 1, 1, 10, 15), Decimal("400.000")),
    ]


def test_sites_come_from_folders(spark, tmp_path):
    for site in (3, 4):
        d = tmp_path / f"site_id={site}"
        d.mkdir()
        (d / "x.csv").write_text(f"2024-01-01T10:00:00;{site}\n")
    lines = files.csv_source(spark, str(tmp_path), files.LOGGER)
    assert got(lines, "site_id", "power") == [(3, Decimal(3)), (4, Decimal(4))]


def test_quarter_hours_with_explicit_format(spark, tmp_path):
    (tmp_path / "x.csv").write_text("2023-05-01 10:15;12.5\n2023-10-29 02:00;1\n2023-10-29 02:00;3\n")
    rows = ingest.fifteen_minute_rows(files.csv_source(spark, str(tmp_path), files.QUARTER_HOURS))
    assert got(rows, "measured_on", "production") == [
        (datetime(2023, 5, 1, 10, 15), Decimal("12.500")),
        (datetime(2023, 10, 29, 2, 0), Decimal("3.000")),
    ]


def test_decimal_comma_and_missing_power(spark, tmp_path):
    (tmp_path / "x.csv").write_text("DateTime;Leistung\n2023-05-01T10:00:00;1,5\n2023-05-01T10:05:00;\n2023-05-01T10:10:00;0,75\n")
    rows = ingest.localised_quarters(files.csv_source(spark, str(tmp_path), files.LOCALISED, header=True))
    assert got(rows, "measured_on", "production") == [(datetime(2023, 5, 1, 10), Decimal("750.000"))]


def test_nested_series_and_the_doubled_hour(spark, tmp_path):
    values = {
        "2024-10-27T02:00+02:00": 100,
        "2024-10-27T02:05+02:00": 200,
        "2024-10-27T02:00+01:00": 600,
        "2024-10-27T01:55+02:00": 50,
    }
    doc = {"timeseries": [{"name": "PowerProduced", "unit": "WATT", "values": values},
                          {"name": "PowerIn", "values": {"2024-10-27T02:00+02:00": 7}}], "resolution": "PT5M"}
    (tmp_path / "x.json").write_text(json.dumps(doc, indent=1))
    rows = ingest.series_rows(files.json_source(spark, str(tmp_path), files.SERIES))
    q = ingest.series_quarters(rows, ingest.POWER_SERIES)
    assert got(q, "measured_on", "production", "import", "export") == [
        (datetime(2024, 10, 27, 1, 45), Decimal(50), Decimal(0), Decimal(0)),
        (datetime(2024, 10, 27, 2, 0), Decimal(300), Decimal(7), Decimal(0)),
    ]


def test_series_repeated_in_two_documents_count_once(spark, tmp_path):
    doc = {"timeseries": [{"name": "PowerProduced", "values": {"2024-01-01T00:00+01:00": 10, "2024-01-01T00:05+01:00": 20}}]}
    for n in ("a", "b"):
        (tmp_path / f"{n}.json").write_text(json.dumps(doc))
    doc["timeseries"][0]["values"] = {"2024-01-01T00:10+01:00": 60}
    (tmp_path / "c.json").write_text(json.dumps(doc))
    rows = ingest.series_rows(files.json_source(spark, str(tmp_path), files.SERIES))
    assert got(ingest.series_quarters(rows, ingest.POWER_SERIES), "production") == [(Decimal(30),)]


def test_parallel_arrays(spark, tmp_path):
    hourly = {"time": ["2024-03-31T01:00", "2024-03-31T02:00"], "weather_code": [3, 61]}
    hourly |= {c: [0.5, 1.5] for c in files.WEATHER_COLUMNS if c != "weather_code"}
    (tmp_path / "h.json").write_text(json.dumps({"hourly": hourly, "latitude": 50.1}))
    rows = ingest.hourly_weather(files.json_source(spark, str(tmp_path / "h.json"), files.HOURLY_WEATHER))
    assert got(rows, "measured_on", "weather_code", "rain") == [
        (datetime(2024, 3, 31, 1), 3, Decimal("0.5")),
        (datetime(2024, 3, 31, 2), 61, Decimal("1.5")),
    ]
    daily = {"time": ["2024-03-31"], "sunrise": ["2024-03-31T07:14"], "sunset": ["2024-03-31T20:05"]}
    daily |= {c: [2.0] for c in files.DAILY_COLUMNS}
    (tmp_path / "d.json").write_text(json.dumps({"daily": daily}))
    rows = ingest.daily_weather(files.json_source(spark, str(tmp_path / "d.json"), files.DAILY_WEATHER))
    assert got(rows, "ref_date", "sunset", "sunshine_duration") == [(D("2024-03-31"), datetime(2024, 3, 31, 20, 5), 2)]


def test_battery_documents(spark, tmp_path):
    for i, pack in enumerate(("p2", "p1", "p1")):
        doc = {"id": {"sn": "battery"}, "pk": {"sn": pack, "soh": 98.5, "op": 3600}, "other": 1}
        (tmp_path / f"{i}.json").write_text(json.dumps(doc))
    got_rows = ingest.battery_packs(files.json_source(spark, str(tmp_path), files.PACKS), D("2025-02-01")).collect()
    assert [(r.ref_date, r.serial, [p.serial for p in r.packs]) for r in got_rows] == [(D("2025-02-01"), "battery", ["p1", "p2"])]


def recursive_ranges(last, as_of):
    """One range after the other, as the definition says."""
    out, start = [], last + timedelta(days=1)
    while start < as_of:
        stop = min(start + timedelta(days=6), as_of - timedelta(days=1))
        out.append((start, stop))
        start = stop + timedelta(days=1)
    return out


@pytest.mark.parametrize("gap", [0, 1, 2, 7, 8, 9, 15, 30])
def test_missing_ranges(spark, gap):
    as_of = D("2024-03-10")
    last = as_of - timedelta(days=gap)
    df = spark.createDataFrame([(0, datetime.combine(last, datetime.min.time()))], "site_id int, measured_on timestamp_ntz")
    assert got(ingest.missing_ranges(df, as_of), "start", "stop") == recursive_ranges(last, as_of)


def test_missing_ranges_of_a_new_site(spark):
    none = spark.createDataFrame([], "site_id int, measured_on timestamp_ntz")
    sites = spark.createDataFrame([(5,)], "site_id int")
    assert got(ingest.missing_ranges(none, D("2024-03-10"), sites=sites), "site_id", "start", "stop") == [
        (5, D("2024-03-03"), D("2024-03-09"))
    ]


def test_audit_counts_violations(spark):
    d = D("2020-01-01")
    prices = spark.createDataFrame(
        [(0, Decimal("1.00"), "buy", d, None), (0, Decimal("2.00"), "buy", d, None), (0, None, "rent", d, None)],
        "site_id int, value decimal(5,2), type string, valid_from date, valid_until date",
    )
    found = {r.rule: r.violations for r in audit.audit({"prices": prices}, ["prices"]).collect() if r.violations}
    assert found == {"not_null(value)": 1, "allowed(type)": 1, "unique(site_id, type, valid_from)": 1}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_export_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([(0, D("2020-01-01"), [{"serial": "p", "soh": 1.0}])], "site_id int, d date, packs array<struct<serial:string,soh:double>>")
    path = files.export_tables({"t": df}, str(tmp_path), fmt=fmt)["t"]
    back = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)
    assert back.count() == 1 and back.columns == df.columns
    if fmt == "parquet":
        assert any(".zstd." in f.name for f in (tmp_path / "t").iterdir())


# Noon altitudes are 90 - latitude + declination; local noon is about 11:36 UTC minus the equation of time.
@pytest.mark.parametrize(("day", "noon_altitude"), [("2024-06-20", 62.66), ("2024-12-21", 15.79), ("2024-03-20", 39.3)])
def test_sun_culminates_where_it_should(spark, day, noon_altitude):
    start = datetime.fromisoformat(day)
    df = spark.createDataFrame([(start + timedelta(minutes=i),) for i in range(0, 1440, 2)], "utc timestamp_ntz")
    az, alt = sun_position(days_since_epoch(F.col("utc")), F.lit(50.775), F.lit(6.084))
    top = df.select("utc", F.degrees(az).alias("az"), F.degrees(alt).alias("alt")).orderBy(F.desc("alt")).first()
    assert top.alt == pytest.approx(noon_altitude, abs=0.3)
    assert abs(top.az) < 1.0
    assert timedelta(hours=11, minutes=15) < top.utc - start < timedelta(hours=11, minutes=50)


def test_daytime_agrees_with_the_horizon(spark):
    start = datetime(2024, 4, 1)
    df = spark.createDataFrame([(start + timedelta(minutes=10 * i),) for i in range(144 * 3)], "utc timestamp_ntz")
    days = days_since_epoch(F.col("utc"))
    alt = F.degrees(sun_position(days, F.lit(50.775), F.lit(6.084))[1])
    rows = df.select(alt.alias("alt"), is_daytime(days, F.lit(50.775), F.lit(6.084)).alias("light")).collect()
    assert all(r.light == (r.alt > -0.833) for r in rows if abs(r.alt + 0.833) > 0.3)


def test_polar_night_is_night(spark):
    df = spark.createDataFrame([(datetime(2024, 12, 21, h),) for h in range(24)], "utc timestamp_ntz")
    light = is_daytime(days_since_epoch(F.col("utc")), F.lit(75.0), F.lit(20.0))
    assert not any(r[0] for r in df.select(light).collect())


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Status;Leistung;DateTime\nok;1,5;2024-01-01T10:00:00\n")
    rows = files.csv_source(spark, str(tmp_path / "x.csv"), files.LOCALISED, header=True)
    assert got(rows, "site_id", "DateTime", "Leistung") == [(0, datetime(2024, 1, 1, 10), "1,5")]


def test_a_session_without_a_shared_folder_says_so():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="work_dir"):
        scratch.scratch_dir(Session())
    assert scratch.scratch_dir(Session(), "/shared").startswith("/shared/sunledger/")


# --- import jobs ---


def test_jobs_fill_tables_step_by_step(spark, tmp_path):
    table = str(tmp_path / "measurements")
    empty = spark.createDataFrame([], DDL["measurements"])
    first = spark.createDataFrame([(0, datetime(2024, 1, 31, 23, 45), 4)], "site_id int, measured_on timestamp_ntz, production int")
    imports.write_measurements(empty.unionByName(conform(first, "measurements")), table)

    (tmp_path / "log.csv").write_text("2024-01-31T23:50:00;8\n2024-02-01T00:00:00;3\n")
    imports.import_logger(spark, files.csv_source(spark, str(tmp_path / "log.csv"), files.LOGGER), table)
    doc = {"timeseries": [{"name": n, "values": {"2024-02-01T00:00+01:00": v}} for n, v in (("PowerBuffered", 9), ("StateOfCharge", 41))]}
    (tmp_path / "s.json").write_text(json.dumps(doc))
    imports.import_storage(spark, files.json_source(spark, str(tmp_path / "s.json"), files.SERIES), table)

    rows = got(imports.read(spark, table), "measured_on", "production", "consumption", "buffered", "state_of_charge")
    assert rows == [
        (datetime(2024, 1, 31, 23, 45), Decimal(6), Decimal(0), None, None),
        (datetime(2024, 2, 1), Decimal(3), Decimal(0), Decimal(9), 41),
    ]


def test_reference_rows_are_added_once(spark, tmp_path):
    for _ in range(2):
        imports.seed_reference(spark, str(tmp_path))
    co2 = spark.read.parquet(f"{tmp_path}/co2_factor_per_year")
    assert co2.count() == 33 and co2.where("year = 2019").first().value == 411
    vat = spark.read.parquet(f"{tmp_path}/applicable_vat_values")
    assert vat.count() == 10


def test_pack_lists_of_a_day_are_replaced(spark, tmp_path):
    table, day = str(tmp_path / "health"), D("2025-02-01")
    for soh in (99.0, 98.0):
        (tmp_path / "p.json").write_text(json.dumps({"id": {"sn": "b"}, "pk": {"sn": "p", "soh": soh, "op": 1}}))
        imports.import_battery_packs(spark, files.json_source(spark, str(tmp_path / "p.json"), files.PACKS), table, day)
    back = imports.read(spark, table, "battery_health")
    assert [(r.ref_date, float(r.packs[0].soh)) for r in back.collect()] == [(day, 98.0)]
