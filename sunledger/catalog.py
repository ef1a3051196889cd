"""All views by name, with the order a reader expects, and their registration for SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.plans import base, battery, energy, finance, production, weather
from sunledger.tables import SITE, Tables

View = Callable[..., DataFrame]

VIEWS: dict[str, tuple[View, tuple[str, ...]]] = {
    "beginning_of_measurements": (base.beginning_of_measurements, ()),
    "buying_prices": (base.buying_prices, ("valid_from",)),
    "selling_prices": (base.selling_prices, ("valid_from",)),
    "accumulated_yearly_co2_savings": (finance.accumulated_yearly_co2_savings, ("year",)),
    "accumulated_yearly_energy_costs": (finance.accumulated_yearly_energy_costs, ("month",)),
    "energy_flow_per_day": (energy.energy_flow_per_day, ("day",)),
    "energy_flow_per_month": (energy.energy_flow_per_month, ("month",)),
    "amortization": (finance.amortization, ("month",)),
    "average_consumption_per_month_and_hour": (energy.average_consumption_per_month_and_hour, ("hour",)),
    "average_internal_consumption_share_per_hour": (energy.average_internal_consumption_share_per_hour, ("hour",)),
    "yearly_internal_consumption_share": (energy.yearly_internal_consumption_share, ("year",)),
    "overall_internal_consumption_share": (energy.overall_internal_consumption_share, ()),
    "average_production_per_hour": (production.average_production_per_hour, ("hour",)),
    "average_production_per_month": (production.average_production_per_month, ("month",)),
    "average_production_per_month_and_hour": (energy.average_production_per_month_and_hour, ("hour",)),
    "weekly_quartiles": (production.weekly_quartiles, ("sow", "week")),
    "yearly_production": (production.yearly_production, ("year",)),
    "overall_production": (production.overall_production, ()),
    "peaks": (production.peaks, ("production",)),
    "current_buy": (base.current_buy, ()),
    "best_performing_days": (production.best_performing_days, ("measured_on",)),
    "monthly_number_of_measurements": (production.monthly_number_of_measurements, ("y", "m")),
    "place_of_installation": (base.place_of_installation, ()),
    "monthly_weather": (weather.monthly_weather, ("month",)),
    "battery_health": (battery.battery_health, ("year",)),
    "battery_soc": (battery.battery_soc, ("measured_on",)),
    "average_balance_per_month_and_hour": (energy.average_balance_per_month_and_hour, ("hour",)),
    "yearly_settlements": (finance.yearly_settlements, ("year",)),
    "yearly_consumption": (finance.yearly_consumption, ("year",)),
}


def ordered(t: Tables, name: str, *, as_of: date) -> DataFrame:
    """A view sorted by site and its own order, totals (NULL) last."""
    view, keys = VIEWS[name]
    return view(t, as_of=as_of).orderBy(SITE, *[F.col(k).asc_nulls_last() for k in keys])


def register_views(spark: SparkSession, t: Tables, *, as_of: date, prefix: str = "v_") -> list[str]:
    """Make the tables and all views available to ``spark.sql``; safe to repeat."""
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    names = []
    for name, (view, _) in VIEWS.items():
        view(t, as_of=as_of).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
