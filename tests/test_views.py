"""Edge semantics of the views on small hand-made tables."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from sunledger import Tables, catalog
from sunledger.plans import report
from sunledger.tables import DDL, schema_of

AS_OF = date(2020, 12, 31)
DATA = {
    "measurements": [],
    "domain_values": [],
    "prices": [],
    "official_measurements": [],
    "weather_data": [],
    "daily_weather_data": [],
    "battery_health": [],
    "other_utilities": [],
    "gas_parameters": [],
}


def make(spark, **data):
    frames = {}
    for n, default in DATA.items():
        names = [f.name for f in schema_of(n)]
        rows = [tuple(r.get(c) for c in names) for r in data.get(n, default)]
        frames[n] = spark.createDataFrame(rows, schema_of(n))
    for n in ("applicable_vat_values", "co2_factor_per_year"):
        if n in data:
            names = [f.name for f in schema_of(n)]
            frames[n] = spark.createDataFrame([tuple(r.get(c) for c in names) for r in data[n]], schema_of(n))
    return Tables(spark, frames)


def dec(x, n=3):
    return Decimal(str(x)).quantize(Decimal(1).scaleb(-n))


def m(ts, production=0, consumption=0, export=0, imp=0, site=0, **more):
    return {
        "site_id": site, "measured_on": ts, "production": dec(production), "consumption": dec(consumption),
        "import": dec(imp), "export": dec(export), **{k: dec(v) if k != "state_of_charge" else v for k, v in more.items()},
    }


def cfg(name, value, site=0):
    return {"site_id": site, "name": name, "value": value, "description": name}


def price(kind, value, lo, hi=None, site=0):
    d = date.fromisoformat
    return {"site_id": site, "type": kind, "value": dec(value, 2), "valid_from": d(lo), "valid_until": d(hi) if hi else None}


def w(ts, radiation=0, temperature=0, low=0, site=0):
    zero = dec(0)
    base = {c: zero for c in ("cloud_cover", "cloud_cover_mid", "cloud_cover_high", "precipitation", "rain", "snowfall")}
    return {"site_id": site, "measured_on": ts, "shortwave_radiation": dec(radiation), "temperature_2m": dec(temperature),
            "cloud_cover_low": dec(low), "weather_code": 0, **base}


def view(t, name, as_of=AS_OF):
    return [r.asDict() for r in catalog.ordered(t, name, as_of=as_of).collect()]


@pytest.mark.parametrize("name", sorted(catalog.VIEWS))
def test_views_run_on_empty_tables(spark, name):
    assert view(make(spark), name) == []


def test_shares_of_nothing_are_zero(spark):
    t = make(spark, domain_values=[cfg("FIRST_PROPER_READINGS_ON", "2021-01-01")], measurements=[m(datetime(2020, 1, 1), 5)])
    assert view(t, "overall_internal_consumption_share") == [{"site_id": 0, "internal_consumption": 0.0, "autarchy": 0.0}]
    hours = view(t, "average_internal_consumption_share_per_hour")
    assert [h["hour"] for h in hours] == list(range(24))
    assert {h["autarchy"] for h in hours} == {0.0}


def test_days_without_production_and_caps(spark):
    rows = [m(datetime(2020, 1, 1), 0, 0), m(datetime(2020, 1, 2), 4000, 1000, export=0), m(datetime(2020, 1, 3), 4000, 4000, export=8000)]
    days = view(make(spark, measurements=rows), "energy_flow_per_day")
    assert [(d["internal_consumption_share"], d["autarchy"]) for d in days] == [(0.0, 0.0), (100.0, 100.0), (0.0, 0.0)]


def test_start_of_data(spark):
    rows = [m(datetime(2020, 1, 1, 10), 1), m(datetime(2020, 1, 2, 10), 1, site=1)]
    t = make(spark, measurements=rows, domain_values=[cfg("FIRST_PROPER_READINGS_ON", "2020-01-02", site=1), cfg("FIRST_PROPER_READINGS_ON", "2019-05-01", site=2)])
    got = {r["site_id"]: r["value"] for r in view(t, "beginning_of_measurements")}
    assert got == {0: datetime(2020, 1, 1, 10), 1: datetime(2020, 1, 2), 2: datetime(2019, 5, 1)}


def test_buying_prices_split_at_vat_change(spark):
    prices = [price("buy", 20, "2019-01-01", "2020-08-31"), price("buy", 25, "2020-09-01")]
    got = view(make(spark, prices=prices), "buying_prices")
    assert [(str(r["valid_from"]), str(r["valid_until"]), float(r["tax"]), float(r["gross"]), r["change"]) for r in got] == [
        ("2019-01-01", "2020-06-30", 0.19, 23.8, 0.0),
        ("2020-07-01", "2020-08-31", 0.16, 23.2, 0.0),
        # the open price gets no later VAT period
        ("2020-09-01", "2020-12-31", 0.16, 29.0, 0.25),
    ]


def test_vat_period_ending_on_the_first_day_does_not_count(spark):
    prices = [price("buy", 20, "2020-06-30", "2020-07-31")]
    got = view(make(spark, prices=prices), "buying_prices")
    assert [(str(r["valid_from"]), float(r["tax"])) for r in got] == [("2020-07-01", 0.16)]


def test_best_day_keeps_ties(spark):
    rows = [m(datetime(2020, 5, d, h), 1000) for d in (1, 2) for h in (10, 11)] + [m(datetime(2020, 5, 3, 10), 1000)]
    got = view(make(spark, measurements=rows, weather_data=[w(datetime(2020, 5, 2, 11), 300, low=40)]), "best_performing_days")
    assert [r["measured_on"] for r in got] == [datetime(2020, 5, d, h) for d in (1, 2) for h in (10, 11)]
    # radiation describes the hour before its stamp, clouds do not
    assert [(r["shortwave_radiation"], r["cloud_coverage"]) for r in got] == [(None, None), (None, None), (dec(300), None), (dec(300), dec(40))]


def test_quartiles_weigh_days_by_weather_rows(spark):
    """A week of 1..7 kWh, each day with as many weather rows as fan it out."""
    monday = datetime(2020, 6, 1)
    rows = [m(monday + timedelta(days=d), 4000 * (d + 1)) for d in range(7)]
    weather = [w(monday + timedelta(days=d, hours=h), 1000, low=60) for d in range(7) for h in range(24)]
    plain = view(make(spark, measurements=rows), "weekly_quartiles")
    assert plain[0]["quartiles"] == [2.5, 4.0, 5.5] and plain[0]["shortwave_radiation"] is None
    fanned = view(make(spark, measurements=rows, weather_data=weather), "weekly_quartiles")
    assert fanned[0]["quartiles"] == [2.0, 4.0, 6.0]
    assert (fanned[0]["shortwave_radiation"], fanned[0]["cloud_coverage"]) == (24.0, "◑")


def test_iso_week_over_new_year(spark):
    rows = [m(datetime(2020, 12, 31), 4000), m(datetime(2021, 1, 1), 8000), m(datetime(2021, 1, 4), 4000)]
    got = view(make(spark, measurements=rows), "weekly_quartiles")
    assert [(r["sow"], r["week"], r["max"]) for r in got] == [(datetime(2020, 12, 28), 53, 2.0), (datetime(2021, 1, 4), 1, 1.0)]


@pytest.mark.parametrize(("day", "slots"), [(date(2020, 3, 29), 92), (date(2020, 10, 25), 100)])
def test_months_with_clock_changes_are_full(spark, day, slots):
    start = datetime(day.year, day.month, 1)
    rows = []
    for d in range(31):
        n = slots if (start + timedelta(days=d)).date() == day else 96
        rows += [m(start + timedelta(days=d, minutes=14 * i), 1) for i in range(n)]
    t = make(spark, measurements=rows)
    assert [(r["y"], r["m"], r["days"]) for r in view(t, "monthly_number_of_measurements")] == [(2020, day.month, 31)]
    assert len(view(t, "average_production_per_month")) == 1


def test_peaks_take_the_latest_time_and_skip_zero(spark):
    rows = [m(datetime(2020, 1, 1, h), v) for h, v in ((8, 0), (9, 5), (10, "99999.999"), (11, 5), (12, "99999.999"), (13, 7))]
    got = view(make(spark, measurements=rows), "peaks")
    assert [(float(r["production"]), r["last_time_measured"]) for r in got] == [(5.0, datetime(2020, 1, 1, 11)), (100000.0, datetime(2020, 1, 1, 12))]


def test_one_single_peak(spark):
    got = view(make(spark, measurements=[m(datetime(2020, 1, 1, 9), 5)]), "peaks")
    assert [r["last_time_measured"] for r in got] == [datetime(2020, 1, 1, 9)]


def test_charge_takes_the_next_health_record(spark):
    packs = [{"serial": "p", "soh": dec(90, 2), "op": 1}]
    health = [{"site_id": 0, "ref_date": date(2020, 6, 2), "serial": "s", "packs": packs}]
    rows = [m(datetime(2020, 6, d), state_of_charge=50) for d in (1, 2, 3)] + [m(datetime(2019, 1, 1), state_of_charge=50)]
    t = make(spark, measurements=rows, battery_health=health, domain_values=[cfg("BATTERY_CAPACITY", "10")])
    got = view(t, "battery_soc")
    assert [(r["measured_on"].day, r["capacity"], r["charge"]) for r in got] == [(1, 9.0, 4.5), (2, 9.0, 4.5)]


def test_settlements_need_a_start_day_and_prefer_official_values(spark):
    d = date.fromisoformat
    official = [{"site_id": 0, "period_start": d("2018-09-01"), "period_end": d("2019-09-01"), "import": dec(500, 2), "export": None}]
    rows = [m(datetime(2018, 10, 1), consumption=8_000, imp=4_000, export=4_000), m(datetime(2019, 10, 1), consumption=8_000)]
    prices = [price("buy", 30, "2018-01-01")]
    data = {"official_measurements": official, "measurements": rows, "prices": prices}
    assert view(make(spark, **data), "yearly_settlements") == []
    got = view(make(spark, **data, domain_values=[cfg("FIRST_PROPER_READINGS_ON", "2017-01-01")]), "yearly_settlements")
    assert [(r["year"], r["import"], r["export"], r["consumption"], float(r["net"])) for r in got] == [(2019, 500.0, 1.0, 2.0, 30.0), (2020, 0.0, 0.0, 2.0, 30.0)]


def test_amortization_without_prices_and_cost(spark):
    got = view(make(spark, measurements=[m(datetime(2020, 1, 1), 4000)]), "amortization")
    assert [(r["full_export"], r["partial_export"]) for r in got] == [(None, 0.0)]


def test_trend_fills_gaps_on_a_line(spark):
    """Full export earns 1 per month; February is missing and the months after are continued."""
    rows = [m(datetime(2020, mo, 1), 400_00, export=400_00) for mo in (1, 3, 4)]
    prices = [price("full_sell", 10, "2019-01-01"), price("partial_sell", 10, "2019-01-01"), price("buy", 10, "2019-01-01")]
    t = make(spark, measurements=rows, prices=prices)
    got = sorted(report.amortization_trend(t, as_of=AS_OF, months=6).collect(), key=lambda r: r.month)
    assert [(r.month.month, r.extrapolated) for r in got] == [(1, False), (2, False), (3, False), (4, False), (5, True), (6, True)]
    # known points (0, 1), (2, 2), (3, 3)
    slope, base = 9 / 14, 1 - 1 / 14
    assert got[1].full_export == pytest.approx(slope + base) and got[5].full_export == pytest.approx(5 * slope + base)
    assert report.amortization_trend(t, as_of=AS_OF, months=3).count() == 3


def months_of(*starts):
    return [m(datetime(y, mo, d), production=8) for y, mo, d in starts]


def rows_of(spark, t, name):
    return catalog.ordered(t, name, as_of=AS_OF).collect()


def test_amortization_starts_with_the_first_whole_month_without_a_start_day(spark):
    t = make(spark, measurements=months_of((2020, 4, 20), (2020, 5, 1), (2020, 6, 3)))
    assert [r["month"].month for r in rows_of(spark, t, "amortization")] == [5, 6]
    t = make(spark, measurements=months_of((2020, 4, 1), (2020, 5, 1)))
    assert [r["month"].month for r in rows_of(spark, t, "amortization")] == [4, 5]


def test_trend_keeps_known_months_beyond_a_gap(spark):
    known = [(2000 + i // 12, i % 12 + 1, 1) for i in range(180) if i < 50 or i >= 130]
    t = make(spark, measurements=months_of(*known))
    rows = report.amortization_trend(t, as_of=AS_OF).collect()
    assert len(rows) == 180 and max(r["month"] for r in rows) == datetime(2014, 12, 1)
    assert not any(r["extrapolated"] for r in rows)


def test_years_without_shares_show_no_number(spark):
    rows = [m(datetime(2018, 5, 1), production=8, consumption=4), m(datetime(2019, 5, 1), production=8, consumption=4)]
    t = make(spark, measurements=rows, domain_values=[cfg("FIRST_PROPER_READINGS_ON", "2019-01-01")])
    got = {r["year"]: (r["autarchy"], r["total_yield"]) for r in report.yearly_summary(t, as_of=AS_OF).collect()}
    assert got[2018] == ("n/a", "n/a") and got[2019][0] != "n/a"


def test_means_leave_out_missing_powers(spark):
    at = datetime(2019, 5, 1, 12)
    rows = [{**m(at + timedelta(minutes=15 * i), production=4000), "production": dec(4000) if i == 0 else None} for i in range(4)]
    (row,) = rows_of(spark, make(spark, measurements=rows), "average_production_per_month_and_hour")
    assert row["5"] == 4.0


def test_peaks_before_1900_and_within_a_second(spark):
    rows = [m(datetime(1899, 6, 1), production=5), m(datetime(2019, 5, 1, 12, 0, 0, 250_000), production=9)]
    got = {(float(r["production"]), r["last_time_measured"]) for r in rows_of(spark, make(spark, measurements=rows), "peaks")}
    assert got == {(5.0, datetime(1899, 6, 1)), (9.0, datetime(2019, 5, 1, 12, 0, 0, 250_000))}


def test_totals_row_equals_sum_of_months(spark):
    rows = [m(datetime(2020, mo, 1), 4_000 * mo) for mo in (1, 2, 3)]
    got = view(make(spark, measurements=rows), "energy_flow_per_month")
    assert [r["month"] and r["month"].month for r in got] == [1, 2, 3, None]
    assert got[3]["production"] == sum(r["production"] for r in got[:3])


def test_views_are_queryable_in_sql(spark):
    t = make(spark, measurements=[m(datetime(2020, 1, 1), 4000)])
    names = catalog.register_views(spark, t, as_of=AS_OF)
    assert len(names) == len(catalog.VIEWS)
    got = spark.sql("select production from v_energy_flow_per_day where day = :d", args={"d": datetime(2020, 1, 1)})
    assert [r[0] for r in got.collect()] == [1.0]
    assert set(DDL) >= set(DATA)
