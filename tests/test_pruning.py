"""Date-limited views over tables stored by month open only their months."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import derive
from sunledger import catalog
from sunledger.plans import battery, imports, production, report, weather
from sunledger.plans.base import buying_prices
from sunledger.tables import Tables

SF = "/root/testdata/sf0.001"
AS_OF = derive.AS_OF


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """All tables stored, the series as versioned tables by month."""
    root = str(tmp_path_factory.mktemp("tables"))
    given = derive.tables(spark, SF)
    for name in given:
        if name in ("measurements", "weather_data", "daily_weather_data"):
            imports.write(given[name], f"{root}/{name}", name)
        else:
            given[name].write.parquet(f"{root}/{name}")
    return Tables.from_parquet(spark, root, tuple(given))


def scans(df):
    """The partition filters of each scan of a table by month, in the executed plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line[line.index("PartitionFilters") : line.index("PushedFilters")] for line in text.splitlines() if "FileScan" in line and "month#" in line]


YEAR = 1996
CASES = {
    "summer_quartiles": (lambda t: report.summer_quartiles(t, year=YEAR, as_of=AS_OF), 2, ("1996-03", "1996-09")),
    "area_series": (lambda t: report.area_series(t, year=YEAR, as_of=AS_OF), 1, ("1996-01", "1996-12")),
    "battery_soc": (lambda t: battery.battery_soc(t, as_of=AS_OF), 1, ("2000-06", "2001-06")),
    "temperature_extremes": (lambda t: weather.temperature_extremes(t, year=YEAR, as_of=AS_OF), 1, ("1996-01", "1996-12")),
}


@pytest.mark.parametrize("name", CASES)
def test_months_reach_the_partition_filters(tables, name):
    view, series, (first, last) = CASES[name]
    limited = [s for s in scans(view(tables)) if first in s and last in s]
    assert len(limited) == series


def test_the_best_days_join_names_their_months(tables):
    """One year only: both scans of the measurements are limited; the second one also by the months of the days found."""
    found = scans(report.best_day_of_year(tables, year=YEAR, as_of=AS_OF))
    limited = [s for s in found if "1996-01" in s]
    assert len(limited) >= 2  # the scan for the days, that of their rows, and the first once more as its filter
    assert any("dynamicpruning" in s for s in limited)
    assert any("dynamicpruning" in s for s in scans(production.best_performing_days(tables, as_of=AS_OF)))


def test_limits_by_month_lose_no_row(spark, tables):
    """The same rows as from tables without partitions."""
    plain = derive.tables(spark, SF).replaced(**{n: derive.SOURCES[n](spark, SF) for n in ("measurements", "weather_data")})
    for view, _, _ in CASES.values():
        assert sorted(map(str, view(tables).collect())) == sorted(map(str, view(plain).collect()))


def test_views_open_stored_tables_whichever_way_they_are_laid_out(spark, tables, tmp_path):
    m = tables["measurements"]
    m.withColumn("month", F.date_format("measured_on", "yyyy-MM")).write.partitionBy("month").parquet(str(tmp_path / "measurements"))
    by_folder = Tables.from_parquet(spark, str(tmp_path), ("measurements",))
    first, last = date(1996, 1, 31), date(1996, 2, 2)
    wanted = m.where((F.col("measured_on") >= F.lit(datetime(1996, 1, 31))) & (F.col("measured_on") < F.lit(datetime(1996, 2, 2))))
    got = by_folder.between("measurements", first, last)
    assert "month#" in scans(got)[0] and "1996-01" in scans(got)[0]
    assert got.count() == wanted.count() == tables.between("measurements", first, last).count() > 0
    assert by_folder["measurements"].columns == m.columns
    assert by_folder.by_month("measurements").select("month").distinct().count() == m.select(F.trunc(F.col("measured_on").cast("date"), "month")).distinct().count()


def test_registered_views_run_over_versioned_tables(spark, tables):
    catalog.register_views(spark, tables, as_of=AS_OF)
    assert spark.sql("select count(*) from v_best_performing_days").head()[0] > 0
    assert spark.sql("select count(*) from v_battery_soc").head()[0] > 0


@pytest.mark.parametrize(("day", "n", "want"), [("2001-06-30", 12, "2000-06-30"), ("2024-02-29", 12, "2023-02-28"), ("2024-03-31", 1, "2024-02-29"), ("2024-01-15", 13, "2022-12-15")])
def test_months_before(spark, day, n, want):
    assert battery.months_before(date.fromisoformat(day), n) == date.fromisoformat(want)
    assert spark.sql(f"select add_months(date '{day}', -{n})").head()[0] == date.fromisoformat(want)


def test_yearly_share_without_any_power(spark):
    """100 where no power of a year is known, 0 where it is 0."""
    rows = [(0, datetime(2000, 1, 1), None, None), (0, datetime(2001, 1, 1), Decimal(0), Decimal(0)), (0, datetime(2002, 1, 1), Decimal(8), Decimal(4))]
    m = spark.createDataFrame(rows, "site_id int, measured_on timestamp_ntz, production decimal(8,3), consumption decimal(8,3)")
    none = spark.createDataFrame([], "site_id int, name string, value string, description string")
    t = Tables(spark, {"measurements": m, "domain_values": none})
    got = {r.year: (r.internal_consumption, r.autarchy) for r in catalog.VIEWS["yearly_internal_consumption_share"][0](t, as_of=AS_OF).collect()}
    assert got[2000] == (100.0, 100.0) and got[2001] == (0.0, 0.0)


def test_a_long_price_costs_a_row_for_each_tax(spark):
    """Periods of any length, as one that ends in the year 9999, meet each tax period once and open no years."""
    prices = [(0, Decimal("10.00"), "buy", date(1900, 1, 1), date(9999, 12, 31))]
    t = Tables(spark, {"prices": spark.createDataFrame(prices, "site_id int, value decimal(5,2), type string, valid_from date, valid_until date")})
    got = buying_prices(t, as_of=AS_OF)
    assert got.count() == 10
    assert "sequence" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [r.valid_from for r in got.orderBy("valid_from").collect()][0] == date(1968, 1, 1)
