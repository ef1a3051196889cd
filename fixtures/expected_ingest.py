"""Expected results of ingest, merge and streaming, as DuckDB SQL over the events."""

from __future__ import annotations

from fixtures.derive import AS_OF, SOURCES
from fixtures.oracle import CTES

_MERGED = """
select site_id, measured_on, {p} production, case when s.site_id is null then {c} else {c2} end consumption,
  case when s.site_id is null then {i} else {i2} end "import", case when s.site_id is null then {e} else {e2} end export,
  {b} buffered, {r} released, {soc} state_of_charge
from stored s full join {new} n using (site_id, measured_on)"""


def _halfway(old: str, new: str) -> str:
    return f"cast(({old} + {new}) / 2 as decimal(8,3))"


def _both(rule: str) -> str:
    return f"case when s.site_id is null then n.production when n.site_id is null then s.production else {rule} end"


def _merged(new: str, production: str, **over: str) -> str:
    zero = "cast(0 as decimal(8,3))"
    parts = {
        "p": production, "c": zero, "c2": "s.consumption", "i": zero, "i2": 's."import"', "e": zero, "e2": "s.export",
        "b": "s.buffered", "r": "s.released", "soc": "s.state_of_charge",
    }
    return _MERGED.format(new=new, **{**parts, **over})


_M2 = f"case when s.production = 0 then n.production else {_halfway('s.production', 'n.production')} end"
_M3 = (
    f"case when s.production = 0 then n.production when s.production < n.production "
    f"then {_halfway('s.production', 'n.production')} else s.production end"
)
_ADOPT = {
    f"{k}2": f'case when n.site_id is null then s."{c}" else n."{c}" end'
    for k, c in (("c", "consumption"), ("i", "import"), ("e", "export"))
}
_FRESH = {k: f'n."{c}"' for k, c in (("c", "consumption"), ("i", "import"), ("e", "export"))}

#: event type -> column of the series documents
_POWER = {"purchase": "production", "click": "consumption", "view": "export", "error": "import"}
_STORAGE = {"purchase": "buffered", "click": "released", "signup": "state_of_charge"}


def _series(names: dict[str, str]) -> str:
    cols = ", ".join(f"coalesce(avg(case when name = '{n}' then x end), 0) c{i}" for i, n in enumerate(names))
    typed = ", ".join(
        f'cast(c{i} as {"smallint" if c == "state_of_charge" else "decimal(8,3)"}) "{c}"' for i, c in enumerate(names.values())
    )
    return f"""
  select site_id, measured_on, {typed} from (
    select site_id, time_bucket(interval 15 minutes, "at" + interval 1 hour) measured_on, {cols}
    from (select site_id, time_bucket(interval 5 minutes, ts) "at", name, max(v) * 0.001 x from readings group by all)
    group by all)"""


def _quarters(which: str = "true") -> str:
    return f"""
  select site_id, time_bucket(interval 15 minutes, ts) measured_on, cast(avg(v * 0.001) as decimal(8,3)) production, count(*) n
  from readings where {which} group by all"""


VIEWS: dict[str, str] = {
    "view_quarters": _quarters("name = 'view'"),
    "all_quarters": _quarters(),
    "first_quarters": _quarters("name in ('click', 'error')"),
    "later_quarters": _quarters("name not in ('click', 'error')"),
    "stored": """
  select site_id, measured_on, case when n > 1 then production else cast(0 as decimal(8,3)) end production, production consumption,
    cast(0 as decimal(8,3)) "import", cast(0 as decimal(8,3)) export, case when n > 1 then production end buffered,
    cast(null as decimal(8,3)) released, case when n > 1 then cast(7 as smallint) end state_of_charge from view_quarters""",
    "localised_rows": """
  select site_id, time_bucket(interval 15 minutes, ts) measured_on,
    cast(avg(case when v >= 2000 then cast(v // 100 * 0.001 as decimal(18,3)) else 0 end) * 1000 as decimal(8,3)) production
  from readings group by all""",
    "power_rows": _series(_POWER),
    "storage_rows": _series(_STORAGE),
    "raw_measurements": """
  select cast(l_suppkey // 34 as int) site_id, l_shipdate + to_minutes(cast((l_orderkey * 4 + l_linenumber) % 96 * 15 as int)) measured_on,
    case when l_discount > 0 then l_extendedprice end production, l_quantity * 6 state_of_charge from lineitem""",
    "full_raw": """
  select cast(l_suppkey // 34 as int) site_id, l_shipdate + to_minutes(cast((l_orderkey * 4 + l_linenumber) % 96 * 15 as int)) measured_on,
    case when l_discount > 0 then l_extendedprice end production, l_quantity consumption, 0 "import", 0 export, l_quantity * 6 state_of_charge from lineitem""",
    "late_first": f"""
  select site_id, measured_on, case when s.site_id is null then n.production when n.site_id is null then s.production else {_M2} end production
  from stored s full join first_quarters n using (site_id, measured_on)""",
}


def _absent(table: str, key: str, column: str, zero: str) -> str:
    return f"select * replace (case when {key} < '1998-01-01' then {zero} else {column} end as {column}) from {table}"


_COLUMNS = {
    "measurements": "site_id measured_on production consumption import export",
    "prices": "site_id value type valid_from",
    "official_measurements": "site_id period_start period_end import",
    "weather_data": "site_id measured_on shortwave_radiation temperature_2m cloud_cover cloud_cover_low cloud_cover_mid cloud_cover_high weather_code precipitation rain snowfall",
    "daily_weather_data": "site_id ref_date sunrise sunset sunshine_duration daylight_duration precipitation_hours precipitation_sum temperature_2m_max temperature_2m_min weather_code",
    "battery_health": "site_id ref_date serial",
    "other_utilities": "site_id year type consumption",
    "gas_parameters": "site_id year ab_wert z_zahl",
    "domain_values": "site_id name value description",
}
_UNIQUE = {
    "measurements": "site_id, measured_on",
    "prices": "site_id, type, valid_from",
    "official_measurements": "site_id, period_start, period_end",
    "weather_data": "site_id, measured_on",
    "daily_weather_data": "site_id, ref_date",
    "battery_health": "site_id, ref_date, serial",
    "other_utilities": "site_id, year, type",
    "gas_parameters": "site_id, year",
    "domain_values": "site_id, name",
}
_CHECKS = {
    "prices": ["allowed(type)"],
    "other_utilities": ["allowed(type)", "range(year)"],
    "measurements": ["range(state_of_charge)"],
    "weather_data": ["range(weather_code)"],
    "daily_weather_data": ["range(sunshine_duration)", "range(daylight_duration)", "range(precipitation_hours)", "range(weather_code)"],
    "gas_parameters": ["range(year)"],
}


def _audit() -> str:
    """Only the raw measurements break rules: missing power, impossible charge, repeated keys."""
    parts = []
    for t, cols in _COLUMNS.items():
        src = "raw_measurements" if t == "measurements" else t
        for c in cols.split():
            n = "count(*) filter (production is null)" if (t, c) == ("measurements", "production") else "0"
            parts.append(f"select '{t}' table_name, 'not_null({c})' as \"rule\", {n} violations from {src}")
            if n == "0":
                parts[-1] = f"select '{t}' table_name, 'not_null({c})' as \"rule\", 0 violations"
        for rule in _CHECKS.get(t, []):
            n = "count(*) filter (state_of_charge not between 0 and 255) violations from raw_measurements" if t == "measurements" else "0 violations"
            parts.append(f"select '{t}', '{rule}', {n}")
        key = ", ".join(f'"{k}"' for k in _UNIQUE[t].split(", "))
        parts.append(f"select '{t}', 'unique({_UNIQUE[t]})', count(*) - (select count(*) from (select distinct {key} from {src})) from {src}")
    return "\nunion all ".join(parts)


#: Every rule of all tables: columns that may not be NULL, keys, value lists and ranges.
_ALL_COLUMNS = {
    **_COLUMNS,
    "domain_values": "id " + _COLUMNS["domain_values"],
    "prices": "id " + _COLUMNS["prices"],
    "official_measurements": "id " + _COLUMNS["official_measurements"],
    "applicable_vat_values": "valid_from value",
    "co2_factor_per_year": "year value",
}
_ALL_UNIQUE = {**{t: [k] for t, k in _UNIQUE.items()}, "applicable_vat_values": ["valid_from"], "co2_factor_per_year": ["year"]}
_ALL_UNIQUE |= {t: [_UNIQUE[t], "id"] for t in ("domain_values", "prices", "official_measurements")}
_LISTS = {"prices": "'buy', 'full_sell', 'partial_sell'", "other_utilities": "'electricity', 'water', 'gas'"}
_TOPS = {"state_of_charge": 255, "weather_code": 65535, "sunshine_duration": 4294967295, "daylight_duration": 4294967295, "precipitation_hours": 65535, "year": 65535}


def _broken(t: str) -> str:
    """A table and, for each rule of its rows, the first site's rows again with a value that breaks it."""
    src = "full_raw" if t == "measurements" else t
    if "id" in _ALL_UNIQUE[t]:
        src = f"(select row_number() over (order by {', '.join(_quoted(_UNIQUE[t]))}) id, * from {t})"
    first = "" if t in ("applicable_vat_values", "co2_factor_per_year") else " where site_id = 0"
    damages = [(c, "null") for c in _ALL_COLUMNS[t].split()]
    damages += [(r.split("(")[1][:-1], "'other'" if r.startswith("allowed") else "-1") for r in _CHECKS.get(t, [])]
    return f"select * from {src}" + "".join(f' union all select * replace ({v} as "{c}") from {src}{first}' for c, v in damages)


def _quoted(names: str) -> list[str]:
    return [f'"{n}"' for n in names.split(", ")]


VIEWS |= {f"broken_{t}": _broken(t) for t in _ALL_COLUMNS}


def _audit_all() -> str:
    parts = []
    for t in _ALL_COLUMNS:
        checks = [(f"not_null({c})", f'"{c}" is null') for c in _ALL_COLUMNS[t].split()]
        for rule in _CHECKS.get(t, []):
            c = rule.split("(")[1][:-1]
            checks.append((rule, f'"{c}" not in ({_LISTS[t]})' if rule.startswith("allowed") else f'"{c}" not between 0 and {_TOPS[c]}'))
        parts += [f"select '{t}' table_name, '{rule}' as \"rule\", count(*) filter ({bad}) violations from broken_{t}" for rule, bad in checks]
        for keys in _ALL_UNIQUE[t]:
            parts.append(f"select '{t}', 'unique({keys})', count(*) - (select count(*) from (select distinct {', '.join(_quoted(keys))} from broken_{t})) from broken_{t}")
    return "\nunion all ".join(parts)


_SUMMED = {
    "measurements": "production",
    "weather_data": "shortwave_radiation",
    "daily_weather_data": "sunshine_duration",
    "prices": '"value"',
    "domain_values": 'length("value")',
    "official_measurements": "export",
    "battery_health": "length(serial)",
    "other_utilities": "consumption",
    "gas_parameters": "ab_wert",
    "applicable_vat_values": '"value"',
    "co2_factor_per_year": '"value"',
}


def _exported() -> str:
    site = {t: "cast(null as int)" if t in ("applicable_vat_values", "co2_factor_per_year") else "max(site_id)" for t in _SUMMED}
    return "\nunion all ".join(
        f"select '{t}' table_name, count(*) n, {site[t]} last_site, cast(sum(cast({c} as decimal(18,4))) as double) total from {t}" for t, c in _SUMMED.items()
    )


_LINES = "select site_id, ts measured_on, cast(v * 0.001 as decimal(18,6)) \"power\" from readings"

EXPECTED: dict[str, str] = {
    "csv_logger_lines": _LINES,
    "csv_many_files": _LINES,
    "import_logger": _merged("all_quarters", _both(_M2)),
    "import_quarter_hours": _merged("all_quarters", _both(_M3)),
    "import_localised": _merged("localised_rows", "coalesce(n.production, s.production)"),
    "import_power_series": _merged("power_rows", _both(_M2), **_ADOPT, **_FRESH),
    "import_storage_series": _merged(
        "storage_rows", "coalesce(s.production, 0)", b="coalesce(s.buffered, n.buffered)",
        r="coalesce(s.released, n.released)", soc="coalesce(s.state_of_charge, n.state_of_charge)"
    ),
    "import_hourly_weather": _absent("weather_data", "measured_on", "shortwave_radiation", "0"),
    "import_daily_weather": _absent("daily_weather_data", "ref_date", "sunshine_duration", "0"),
    "import_battery_packs": f"""
select site_id, ref_date, serial, p.serial pack, p.soh soh, p.op op from (select site_id, ref_date, serial, unnest(packs) p from battery_health where month(ref_date) > 6)
union all
select cast(s_suppkey // 34 as int), date '{AS_OF}', s_name, s_name || '-' || x, cast(95 - (s_suppkey + x) % 10 as decimal(4,2)), s_suppkey * x * 7200
from supplier, range(1, 4) r(x)""",
    "merge_into_table": _merged("all_quarters", _both(_M2)),
    "missing_ranges": """
select site_id, cast(d as date) "start", least(cast(d as date) + 6, date '2001-12-30') "stop"
from (select s.site_id, coalesce(max(cast(measured_on as date)) + 1, date '2001-12-24') lo
  from (select distinct site_id from domain_values) s left join measurements m on m.site_id = s.site_id group by all),
  lateral (select unnest(generate_series(cast(lo as timestamp), timestamp '2001-12-30', interval 7 days)) d)""",
    "load_report": "select site_id, count(*) measurements, cast(max(measured_on) as date) last_day from measurements group by all",
    "export_parquet": _exported(),
    "export_csv": _exported(),
    "export_csv_rows": "select * from weather_data",
    "export_parquet_rows": "select * from measurements",
    "constraint_audit": _audit(),
    "constraint_audit_all": _audit_all(),
    "surrogate_ids": """
select cast(row_number() over (order by valid_from >= date '1997-01-01', site_id, "type", valid_from) as int) id, site_id, "value", "type", valid_from, valid_until from prices""",
    "csv_detected": _LINES,
    "time_spine": f"""
select site_id, ts from (select site_id, min(date_trunc('day', measured_on)) lo from measurements group by all),
  lateral (select unnest(range(lo, timestamp '{AS_OF}' + interval 1 day, interval 15 minutes)) ts)""",
    "stream_quarters": "select site_id, measured_on, production from all_quarters",
    "stream_late_lines": f"""
select site_id, measured_on, case when s.site_id is null then n.production when n.site_id is null then s.production else {_M2} end production
from late_first s full join later_quarters n using (site_id, measured_on)""",
    "stream_replayed_lines": "select site_id, ts measured_on, cast(max(v) * 0.001 as decimal(18,6)) \"power\" from readings group by all",
    "stream_equals_batch": "select site_id, measured_on, production, production streamed from all_quarters",
}

assert set(SOURCES) <= set(CTES)
