"""Deterministic rating and planning rules: distance, transit buckets, surcharges, base rates, volume weights."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles, mileage buckets, base rates (long haul, short haul), fuel index terms.
EARTH_RADIUS_MILES = 3958.8
TRANSIT_BUCKETS = ((300, 1), (600, 2), (1000, 3))
TRANSIT_LONGEST = 4
LONG_HAUL_MILES = 500
BASE_RATES = {"TL": (2.20, 2.50), "LTL": (1.80, 2.00)}
BASE_RATE_OTHER = (1.60, 1.80)
FUEL_FLOOR, FUEL_BASE, FUEL_STEP, FUEL_PEG = "0.05", "0.12", "0.05", "3.5"
MONTH_END_DAY = 27
HOLIDAY_RAMP, WEEKEND_FACTOR = 0.10, 0.8


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.least(F.lit(1.0), F.sqrt(chord))) * (2 * EARTH_RADIUS_MILES)


def transit_bucket(miles: Column, mode: Column) -> Column:
    """Planned transit days from distance, one more for intermodal moves."""
    (limit, days), *rest = TRANSIT_BUCKETS
    bucket = F.when(miles < limit, days)
    for limit, days in rest:
        bucket = bucket.when(miles < limit, days)
    return bucket.otherwise(TRANSIT_LONGEST) + F.when(mode == "Intermodal", 1).otherwise(0)


def fuel_surcharge(miles: Column, diesel: Column) -> Column:
    """Surcharge from the weekly diesel price, in exact decimals, rounded to cents."""
    per_mile = F.lit(FUEL_BASE).cast("decimal(4,2)") + F.lit(FUEL_STEP).cast("decimal(4,2)") * (
        diesel.cast("decimal(6,3)") - F.lit(FUEL_PEG).cast("decimal(3,1)")
    )
    floored = F.greatest(F.lit(FUEL_FLOOR).cast("decimal(12,5)"), per_mile.cast("decimal(12,5)"))
    return F.round(floored * miles.cast("decimal(10,2)"), 2).cast("decimal(12,2)")


def base_rate_per_mile(mode: Column, miles: Column) -> Column:
    def by_haul(rates: tuple[float, float]) -> Column:
        return F.when(miles > LONG_HAUL_MILES, rates[0]).otherwise(rates[1])

    rate = None
    for name, rates in BASE_RATES.items():
        rate = (F if rate is None else rate).when(mode == name, by_haul(rates))
    return rate.otherwise(by_haul(BASE_RATE_OTHER))


def volume_weight(day: Column, holidays: Sequence[date], eom_ramp: float) -> Column:
    """Relative shipping volume of a day: month-end and holiday ramps, quieter weekends."""
    days = [F.lit(h) for h in holidays]
    near = F.lit(False)
    if days:
        near = day.isin(*days) | F.date_sub(day, 1).isin(*days) | F.date_add(day, 1).isin(*days)
    ramped = (
        F.lit(1.0)
        + F.when(F.dayofmonth(day) >= MONTH_END_DAY, eom_ramp).otherwise(0.0)
        + F.when(near, HOLIDAY_RAMP).otherwise(0.0)
    )
    return ramped * F.when(F.weekday(day) >= 5, WEEKEND_FACTOR).otherwise(1.0)


def volume_repeats(weight: Column) -> Column:
    """Whole-number share of a weight (half rounds to even), at least one."""
    return F.greatest(F.lit(1), F.bround(weight * 10, 0).cast("int"))


def week_of_year_sunday(day: Column) -> Column:
    """Week number with Sunday-started weeks, days before the first Sunday in week 0 (strftime ``%U``)."""
    return F.floor((F.dayofyear(day) + 6 - F.weekday(F.date_add(day, 1))) / 7).cast("int")
