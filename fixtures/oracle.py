"""The base tables of ``derive.py`` once more, as DuckDB SQL over the driver's views."""

from __future__ import annotations

import re

from sunledger.tables import CO2_FACTORS, CO2_FIRST_YEAR, VAT_PERIODS


def _milli(e: str, dtype: str = "decimal(8,3)") -> str:
    return f"cast(cast({e} as decimal(11,0)) * 0.001 as {dtype})"


_SUPPLIERS = """select cast(s_suppkey // 34 as int) site_id, cast(s_suppkey % 34 as int) i, s_suppkey k, s_name,
    cast(round(abs(s_acctbal) * 100) as bigint) a from supplier"""

CTES: dict[str, str] = {
    "measurements": f"""
  select site_id, measured_on, case when (k * 5 + s) % 97 <> 0 and k % 50 <> 7 and (site_id % 3 <> 1 or measured_on >= timestamp '1993-01-01') then {_milli("p")} end production,
    case when (k * 7 + s) % 89 <> 0 and k % 50 <> 7 then {_milli("c")} end consumption,
    {_milli("greatest(c - p, 0)")} "import", {_milli("greatest(p - c, 0)")} export,
    case when b then {_milli("(greatest(p - c, 0) * 3) // 10")} end buffered,
    case when b then {_milli("greatest(c - p, 0) // 4")} end released,
    case when b then cast(soc as smallint) end state_of_charge
  from (select site_id, k, s, d + to_minutes(cast(s * 15 as int)) measured_on, d >= timestamp '2000-01-01' b,
      case when s between 24 and 83 then (p * (s - 23) * (84 - s) * (90 + (k + s * 7) % 11)) // 100000 else 0 end p,
      q * (20 + (k * 3 + s * 5) % 61) * 1000 + (k * 17 + s * 31) % 1000 c, (k + s) % 101 soc
    from (select cast(l_suppkey // 34 as int) site_id, l_shipdate d, cast(round(max(l_extendedprice) * 100) as bigint) p,
        cast(max(l_quantity) as bigint) q, max(l_orderkey) k from lineitem group by 1, 2), range(96) r(s) where not (k % 5 = 0 and s < 40))""",
    "weather_data": f"""
  select site_id, measured_on, {_milli("(r * 2) // 100")} shortwave_radiation, {_milli("t * 100 - 10000")} temperature_2m,
    {_milli("c * 1000")} cloud_cover, {_milli("cl * 1000")} cloud_cover_low, {_milli("cm * 1000")} cloud_cover_mid,
    {_milli("ch * 1000")} cloud_cover_high, cast(w as int) weather_code, {_milli("pr * 100")} precipitation,
    {_milli("pr * 60")} rain, {_milli("pr * 40")} snowfall
  from (select cast(o_custkey // 500 as int) site_id, o_orderdate + to_hours(cast(o_orderkey % 24 as int)) measured_on,
      cast(round(max(o_totalprice) * 100) as bigint) r, max(o_custkey % 400) t, max(o_orderkey * 11 % 101) c,
      max(o_orderkey * 7 % 101) cl, max(o_orderkey * 13 % 101) cm, max(o_orderkey * 17 % 101) ch,
      max(o_orderkey * 3 % 50) pr, max(o_orderkey % 100) w from orders
    where o_orderdate not between timestamp '1998-02-01' and timestamp '1998-05-31' group by 1, 2)""",
    "daily_weather_data": f"""
  select site_id, cast(d as date) ref_date, d + interval 6 hour sunrise, d + interval 20 hour sunset, sun sunshine_duration,
    50400 daylight_duration, cast(h as int) precipitation_hours, {_milli("pr * 100")} precipitation_sum,
    {_milli("hi * 100")} temperature_2m_max, {_milli("lo * 100 - 10000")} temperature_2m_min, cast(w as int) weather_code
  from (select cast(o_custkey // 500 as int) site_id, o_orderdate d, max(o_orderkey * 37 % 50000) sun, max(o_orderkey % 25) h,
      max(o_orderkey * 3 % 300) pr, max(o_custkey % 350) hi, min(o_custkey % 350) lo, max(o_orderkey % 100) w
    from orders group by 1, 2)""",
    "prices": f"""
  select site_id, cast((b + a % 700) * 0.01 as decimal(5,2)) "value", "type",
    cast(date '1994-01-01' + cast(i * 100 + gap as int) as date) valid_from,
    case when i < 33 - 33 % n then cast(date '1994-01-01' + cast(i * 100 + n * 100 - 1 + gap as int) as date) end valid_until
  from (select *, case when site_id % 3 = 1 and i >= 20 then 5 else 0 end gap from ({_SUPPLIERS})),
    (values ('buy', 1, 1200), ('partial_sell', 2, 600), ('full_sell', 11, 900)) x("type", n, b)
  where i % n = 0""",
    "domain_values": f"""
  select site_id, name, "value", name description from (select distinct site_id from ({_SUPPLIERS})),
    lateral (values
      ('FIRST_PROPER_READINGS_ON', case when site_id % 3 <> 1 then cast(cast(date '1996-03-15' + site_id * 59 % 365 as date) as varchar) end),
      ('INSTALLED_PEAK_POWER', case when site_id % 3 <> 1 then '10.53' end), ('BATTERY_CAPACITY', '9.6'),
      ('ACQUISITION_COST', case when site_id % 3 <> 2 then '20000' end),
      ('LATITUDE', case when site_id % 3 = 1 then '48.13715' end),
      ('LONGITUDE', case when site_id % 3 = 1 then '11.57612' end)) e(name, "value")
  where "value" is not null""",
    "official_measurements": f"""
  select site_id, make_date(1996 + i, case when i = 2 then 8 else 9 end, case when i = 1 then 12 else 1 end) period_start,
    make_date(1997 + i, 9, 1) period_end, cast((100000 + a % 50000) * 0.01 as decimal(7,2)) "import",
    case when i <> 3 then cast((200000 + k * 37 % 50000) * 0.01 as decimal(7,2)) end export
  from ({_SUPPLIERS}) where i < 5""",
    "battery_health": f"""
  select site_id, cast(date '2000-01-15' + to_months(cast(k % 24 as int)) as date) ref_date, s_name serial,
    [{{'serial': s_name || '-' || x, 'soh': cast(99 - (k * x) % 10 as decimal(4,2)), 'op': k * x * 3600}} for x in [1, 2, 3]] packs
  from ({_SUPPLIERS})""",
    "other_utilities": f"""
  select site_id, 1995 + i % 7 "year", case when i < 7 then 'water' else 'gas' end "type",
    cast((50000 + a % 900000) * 0.001 as decimal(8,3)) consumption from ({_SUPPLIERS}) where i < 14""",
    "gas_parameters": f"""
  select site_id, 1995 + i "year", cast((110000 + k % 10 * 123) * 0.0001 as decimal(6,4)) ab_wert,
    cast((9500 + k % 10 * 7) * 0.0001 as decimal(5,4)) z_zahl from ({_SUPPLIERS}) where i < 7 and i <> 4""",
    "readings": """
  select cast(user_id // 50 as int) site_id, date_trunc('second', ts) ts, event_type as name,
    cast(round(max("value") * 1000) as bigint) v from events group by 1, 2, 3""",
    "co2_factor_per_year": "select * from (values "
    + ", ".join(f"({CO2_FIRST_YEAR + i}, {v})" for i, v in enumerate(CO2_FACTORS))
    + ') c("year", "value")',
    "applicable_vat_values": 'select cast(f as date) valid_from, cast(u as date) valid_until, cast(v as decimal(3,2)) "value" from (values '
    + ", ".join(f"('{f}', {repr(u) if u else 'null'}, {v})" for f, u, v in VAT_PERIODS)
    + ") v(f, u, v)",
}


def with_tables(body: str, views: dict[str, str] | None = None) -> str:
    """Prefix a query with the CTEs it needs, found by name, in order of dependency."""
    known = {**CTES, **(views or {})}
    need: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in known:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(known[name])
                need.append(name)

    visit(body)
    ctes = ",\n".join(f"{n} as ({known[n].strip()})" for n in need)
    return f"with recursive {ctes}\n{body.strip()}"
