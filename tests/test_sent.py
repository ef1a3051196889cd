"""What is sent around through the driver stays small, however small to Spark the measurements look."""

import re
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sunledger import Tables
from sunledger.plans import production, report
from sunledger.tables import DDL

AS_OF = date(2020, 12, 31)
SINCE = date(2019, 12, 1)


@pytest.fixture(scope="module")
def tables(spark):
    """Measurements that are made of far fewer rows: sites without any power, with equal days, and with one best day a year."""
    days = spark.createDataFrame([(s, SINCE + timedelta(days=d), d) for s in range(3) for d in range(70)], "site_id int, d date, n int")
    power = "case site_id when 1 then 1000 when 2 then 100 + n * 7 % 53 + s * 13 % 31 end"
    quarters = days.selectExpr("*", "explode(sequence(0, 95)) s").selectExpr(
        "site_id", "timestampadd(MINUTE, s * 15, cast(d as timestamp_ntz)) measured_on", f"cast({power} as decimal(8,3)) production",
        *[f"cast(0 as decimal(8,3)) {c}" for c in ("consumption", "import", "export", "buffered", "released")], "cast(0 as smallint) state_of_charge",
    )
    weather = [(1, datetime(2019, 12, 31, 0) + timedelta(hours=i), Decimal(i), Decimal(100 - i)) for i in range(48)]
    weather = spark.createDataFrame(weather, "site_id int, measured_on timestamp_ntz, shortwave_radiation decimal(8,3), cloud_cover_low decimal(8,3)")
    return Tables(spark, {"measurements": quarters, "weather_data": weather, "domain_values": spark.createDataFrame([], DDL["domain_values"])})


def executed(df):
    rows = [r.asDict() for r in df.collect()]
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_the_best_days_are_sent_around_and_not_the_measurements(tables):
    """Nor the weather, which the few rows of the best days meet in a shuffle."""
    got, text = executed(production.best_performing_days(tables, as_of=AS_OF))
    assert "BuildLeft" not in text
    assert not re.search(r"BroadcastHashJoin \[[^\]]*\], \[[^\]]*__piece", text)
    sums, all_rows = defaultdict(lambda: defaultdict(lambda: None)), tables["measurements"].collect()
    for r in all_rows:
        if r.production is not None:
            at = sums[r.site_id, r.measured_on.year]
            at[r.measured_on.date()] = (at[r.measured_on.date()] or 0) + r.production
    best = {k: {d for d, v in x.items() if round(float(v) / 4000, 2) == max(round(float(y) / 4000, 2) for y in x.values())} for k, x in sums.items()}
    want = [(r.site_id, r.measured_on, r.production) for r in all_rows if r.production is None or r.measured_on.date() in best[r.site_id, r.measured_on.year]]
    key = lambda r: (r[0], r[1])
    assert sorted(((r["site_id"], r["measured_on"], r["production"]) for r in got), key=key) == sorted(want, key=key)
    assert {r["site_id"] for r in got} == {0, 1, 2} and all(r["year"] == r["measured_on"].year for r in got)
    # the radiation of an hour later, the clouds of the hour itself, the last ones from then on
    at = {r["measured_on"]: (r["shortwave_radiation"], r["cloud_coverage"]) for r in got if r["site_id"] == 1}
    assert at[datetime(2019, 12, 30, 22, 45)] == (None, None) and at[datetime(2019, 12, 30, 23, 15)] == (0, None)
    assert at[datetime(2019, 12, 31, 5, 30)] == (6, 95) and at[datetime(2020, 1, 20)] == (47, 53)


def test_days_of_equal_production_cost_a_row_for_each_month(tables):
    """A site without any power has all its days: what is sent around for them is bounded by its months."""
    got = production.best_performing_days(tables, as_of=AS_OF)
    got.collect()
    lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    sent = next(x for x in lines[semi:] if "Aggregate" in x)
    assert "LeftSemi, BuildRight" in lines[semi] and "collect_set(day" in sent and "__days" in sent


def test_the_extremes_are_sent_around_and_not_the_measurements(tables):
    """Whichever columns the view asks for, and no join deals the measurements out by site alone."""
    last = {}
    for r in tables["measurements"].collect():
        if r.production:
            last[r.site_id, r.production] = max(r.measured_on, last.get((r.site_id, r.production), r.measured_on))
    high, low = (f(p for s, p in last if s == 2) for f in (max, min))
    for view, column, want in (
        (report.maximal_peak, "max_peak", {(1, 1000.0), (2, float(high))}),
        (production.peaks, "last_time_measured", {(s, t) for (s, p), t in last.items() if s == 1 or p in (high, low)}),
    ):
        got, text = executed(view(tables, as_of=AS_OF))
        assert "BuildRight" in text and "BuildLeft" not in text and "SortMergeJoin" not in text
        assert {(r["site_id"], r[column]) for r in got} == want
