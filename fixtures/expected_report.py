"""Expected results of the report queries, as DuckDB SQL."""

from __future__ import annotations

from fixtures.derive import AS_OF

ZONE = "Europe/Berlin"


def _single(c: str) -> str:
    return f'cast(cast({c} as float) as double)'



def _sun(times: str) -> str:
    """Azimuth and altitude in degrees for rows with site_id, utc, days, lat, long; the sun above the horizon."""
    return f"""
select site_id, timezone('{ZONE}', timezone('UTC', utc)) "at", utc, {_single('degrees(az)')} azimuth, {_single('degrees(alt)')} altitude
from (select *, atan2(sin(h), cos(h) * sin(phi) - tan(dec) * cos(phi)) az, asin(sin(phi) * sin(dec) + cos(phi) * cos(dec) * cos(h)) alt
  from (select *, asin(sin(l) * sin(radians(23.4397))) dec, radians(280.16 + 360.9856235 * days + lng) - atan2(sin(l) * cos(radians(23.4397)), cos(l)) h,
      radians(lat) phi
    from (select *, m + radians(1.9148 * sin(m) + 0.02 * sin(2 * m) + 0.0003 * sin(3 * m)) + radians(102.9372) + pi() l
      from (select *, radians(357.5291 + 0.98560028 * days) m from ({times})))))
where alt > 0"""


_DAYS = "epoch(utc - timestamp '2000-01-01 12:00:00') / 86400"
_PLACE = 'select site_id, cast(lat as double) lat, cast("long" as double) lng from places'
_LOCAL = f"timezone('UTC', timezone('{ZONE}', {{}}))"

VIEWS: dict[str, str] = {
    "sun_hours": _sun(f"""select site_id, lat, lng, utc, {_DAYS} as days from ({_PLACE}),
      range({_LOCAL.format("timestamp '2000-01-01'")}, {_LOCAL.format("timestamp '2001-01-01'")}, interval 1 hour) r(utc)"""),
}

_BEFORE_AND_AFTER = """
select m.site_id, m.measured_on, b.shortwave_radiation "before", a.shortwave_radiation "after" from measurements m
asof left join weather_data b on m.site_id = b.site_id and m.measured_on >= b.measured_on
asof left join weather_data a on m.site_id = a.site_id and m.measured_on <= a.measured_on"""

EXPECTED: dict[str, str] = {
    "asof_backward": """
select m.site_id, date_trunc('month', m.measured_on) "month", count(*) n, count(shortwave_radiation) matched, cast(sum(shortwave_radiation) as double) radiation
from measurements m asof left join weather_data w on m.site_id = w.site_id and m.measured_on >= w.measured_on group by all""",
    "asof_forward": """
select m.site_id, date_trunc('month', m.measured_on) "month", count(*) n, count(shortwave_radiation) matched, cast(sum(shortwave_radiation) as double) radiation
from measurements m asof join weather_data w on m.site_id = w.site_id and w.measured_on >= m.measured_on group by all""",
    "asof_rows": _BEFORE_AND_AFTER,
    "asof_rows_by_intervals": _BEFORE_AND_AFTER,
    "price_chain": """
select site_id, 'buy' as "type", valid_from, valid_until, "value" from buy_chain union all select * from sell_chain""",
    "report_year": f"""
select site_id, coalesce(y, {AS_OF.year}) "year" from (select distinct site_id from domain_values)
full join (select site_id, year(max(measured_on)) y from measurements group by all) using (site_id)""",
    "other_years": """
select distinct site_id, year(measured_on) "year" from measurements m
where year(measured_on) <> (select year(max(measured_on)) from measurements x where x.site_id = m.site_id)""",
    "feed_in_price_list": """
select site_id, cast(valid_from as varchar) valid_from, coalesce(cast(valid_until as varchar), '-') valid_until, cast("value" as varchar) "value"
from sell_chain where "type" = 'partial_sell'""",
    "amortization_trend": f"""
select g.site_id, g."month", {_single('coalesce(full_export, fs * x + fi)')} full_export, {_single('coalesce(partial_export, ps * x + pi)')} partial_export,
  g."month" > hi extrapolated
from (select site_id, lo + to_months(cast(i as int)) "month", hi, i x from (select site_id, min("month") lo, max("month") hi from amortized group by all having count(*) < 120), range(1000) r(i)) g
left join amortized a on a.site_id = g.site_id and a."month" = g."month"
left join (select site_id, regr_slope(full_export, x) fs, regr_intercept(full_export, x) fi, regr_slope(partial_export, x) ps, regr_intercept(partial_export, x) pi
  from (select *, datediff('month', min("month") over (partition by site_id), "month") x from amortized)
  where full_export is not null and partial_export is not null group by all) f on f.site_id = g.site_id
where x < 120 or g."month" <= hi
union all select site_id, "month", {_single('full_export')}, {_single('partial_export')}, false from amortized
where site_id in (select site_id from amortized group by all having count(*) >= 120)""",
    "yearly_summary": """
select p.* exclude (total_yield), coalesce(cast(p.total_yield as varchar), 'n/a') total_yield,
  case when s.site_id is null then 'n/a' else cast(coalesce(s.internal_consumption, 0.0) as varchar) end internal_consumption,
  case when s.site_id is null then 'n/a' else cast(coalesce(s.autarchy, 0.0) as varchar) end autarchy,
  coalesce(cast(h.health as varchar), 'n/a') health, coalesce(cast(h.capacity as varchar), 'n/a') capacity, c.total co2_savings
from production_year p left join shares_year s on s.site_id = p.site_id and s."year" = p."year"
left join health_year h on h.site_id = p.site_id and h."year" = p."year" left join co2_year c on c.site_id = p.site_id and c."year" = p."year" """,
    "measurement_period": 'select site_id, min(measured_on) "min", max(measured_on) "max" from measurements group by all',
    "weather_period": 'select site_id, min(ref_date) "min", max(ref_date) "max" from daily_weather_data group by all',
    "summer_quartiles": f"""
select site_id, sow, "week", "min", {_single('quartiles[1]')} q1, {_single('quartiles[2]')} med, {_single('quartiles[3]')} q3, "max", shortwave_radiation, cloud_coverage
from quartile_weeks where sow between timestamp '2000-03-21' and timestamp '2000-09-21'""",
    "maximal_peak": "select site_id, max(cast(round(production) as double)) max_peak from peak_rows group by all",
    "best_day_of_year": 'select * from best_days where "year" = 2000',
    "matrix_without_empty_months": "select site_id, \"hour\", "
    + ", ".join(f'{_single(chr(34) + str(i) + chr(34))} m{i:02d}' for i in range(1, 7))
    + """ from (pivot (select site_id, month(h) mon, hour(h) as "hour", v from (
    select site_id, date_trunc('hour', measured_on) h, avg(case when month(measured_on) <= 6 then production end) / 1000 v from measurements group by all))
  on mon in (1, 2, 3, 4, 5, 6) using avg(v) group by site_id, "hour")""",
    "area_series": f"""
select site_id, "day", internal_consumption, "import", {_single('greatest(production - consumption + "import", 0)')} production,
  {_single('internal_consumption + "import"')} consumption
from flow_day where "day" between timestamp '2000-01-01' and timestamp '2000-12-31'""",
    "sun_year": "select * from sun_hours",
    "sun_days": _sun(f"""select site_id, lat, lng, utc, {_DAYS} as days from (
      select distinct p.*, d from ({_PLACE}) p, lateral (
        select timestamp '1999-12-21' d union all select timestamp '2000-03-21' union all select timestamp '2000-06-21'
        union all select min(date_trunc('day', measured_on)) from best_days b where b.site_id = p.site_id and "year" = 2000) where d is not null),
      lateral (select unnest(generate_series({_LOCAL.format('d')}, {_LOCAL.format('d + interval 1 day')}, interval 1 minute)) utc)"""),
    "highest_sun_per_hour": """
select site_id, hour("at") as "hour", arg_max(azimuth, altitude) azimuth, max(altitude) altitude from sun_hours group by all""",
    "temperature_extremes": f"""
select site_id,
  round(min(n), 2) min_avg_night, first(d order by n, d) filter (n is not null) min_avg_night_at,
  round(max(n), 2) max_avg_night, first(d order by n desc, d) filter (n is not null) max_avg_night_at,
  round(min(t), 2) min_avg_day, first(d order by t, d) filter (t is not null) min_avg_day_at,
  round(max(t), 2) max_avg_day, first(d order by t desc, d) filter (t is not null) max_avg_day_at
from (select site_id, date_trunc('day', measured_on) d, avg(temperature_2m) filter (light) t, avg(temperature_2m) filter (not light) n
  from (select *, days between noon - arc and noon + arc light
    from (select *, guess + 0.0053 * sin(m) - 0.0069 * sin(2 * l) noon,
        acos((sin(radians(-0.833)) - sin(phi) * sin(dec)) / (cos(phi) * cos(dec))) / (2 * pi()) arc
      from (select *, asin(sin(l) * sin(radians(23.4397))) dec
        from (select *, m + radians(1.9148 * sin(m) + 0.02 * sin(2 * m) + 0.0003 * sin(3 * m)) + radians(102.9372) + pi() l
          from (select *, radians(357.5291 + 0.98560028 * guess) m, radians(lat) phi
            from (select *, round(days - 0.0009 + lng / 360) + 0.0009 - lng / 360 guess
              from (select w.*, lat, lng, epoch({_LOCAL.format('measured_on')} - timestamp '2000-01-01 12:00:00') / 86400 as days
                from weather_data w join ({_PLACE}) p using (site_id) where year(measured_on) = 2000)))))))
  group by all) group by all""",
}
