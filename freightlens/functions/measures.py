"""Shipment-level measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default report parameters and the separator of lane labels.
GRACE_MINUTES = 60
GM_TARGET = 0.40
LANE_ARROW = " → "
NO_NOTE = "Unknown"


def plus(ts: Column, hours: Column | int = 0, minutes: Column | int = 0) -> Column:
    def as_int(v: Column | int) -> Column:
        return v.cast("int") if isinstance(v, Column) else F.lit(v)

    return ts + F.make_dt_interval(F.lit(0), as_int(hours), as_int(minutes))


def on_time(actual: Column, plan: Column, grace: Column | int = GRACE_MINUTES) -> Column:
    """Delivered no later than plan plus grace; anything missing is late."""
    return F.coalesce(actual <= plus(plan, minutes=grace), F.lit(False))


def otif(on_time_flag: Column, in_full: Column, null_is_false: bool = False) -> Column:
    """On time and in full.  The report form keeps SQL's three-valued AND; the curated form has no nulls."""
    both = on_time_flag & in_full
    return F.coalesce(both, F.lit(False)) if null_is_false else both


def ratio(num: Column, den: Column) -> Column:
    """Double ratio, null when the denominator is zero."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def gm_per_mile(revenue: Column, cost: Column, miles: Column) -> Column:
    return ratio(revenue - cost, miles)


def transit_days(pickup: Column, delivery: Column) -> Column:
    """Calendar-day boundaries crossed, not full 24-hour spans."""
    return F.datediff(delivery, pickup)


def lane_label(origin_city: Column, dest_city: Column) -> Column:
    return F.concat(origin_city, F.lit(LANE_ARROW), dest_city)


def exception_type(notes: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(notes), F.lit("")), F.lit(NO_NOTE))
