"""Row filters of the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions import clean
from freightlens.operators.joins import lane_labels
from freightlens.schemas import STATUS_ACCEPTED, STATUS_TENDERED

Names = Sequence[str] | DataFrame
Bounds = DataFrame | tuple[date, date]

BOUNDS_DAYS = 180


def in_list(c: Column, values: Sequence[str]) -> Column:
    """Membership in a caller's list; an empty list means no restriction."""
    return c.isin(*values) if values else F.lit(True)


def keep_named(dim: DataFrame, column: str, names: Names) -> DataFrame:
    """Dimension rows whose ``column`` is in a list, or in the first column of a frame of names."""
    if isinstance(names, DataFrame):
        wanted = names.select(F.col(names.columns[0]).alias(column))
        return dim.join(wanted, column, "left_semi")
    return dim.filter(in_list(F.col(column), names))


def semi_by_key(df: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Rows whose key occurs in ``dim`` (an IN-subquery)."""
    return df.join(dim.select(F.col(dim_key).alias(key)), key, "left_semi").select(*df.columns)


def _given(names: Names | None) -> bool:
    return isinstance(names, DataFrame) or bool(names)


def apply_filters(
    ship: DataFrame,
    star: Mapping[str, DataFrame],
    customers: Names | None = None,
    carriers: Names | None = None,
    equipment: Names | None = None,
    lanes: Names | None = None,
    date_start: date | None = None,
    date_end: date | None = None,
) -> DataFrame:
    """Restrict shipments by names (resolved through dimensions) and inclusive delivery dates.

    Absent or empty lists do not restrict.  A date bound drops undelivered rows.  Dates compare the raw timestamp
    column with a literal, so they reach the file scan as pushed filters.
    """
    ts = F.col("delivery_actual_ts")
    if date_start is not None:
        ship = ship.filter(ts >= F.lit(date_start).cast("timestamp_ntz"))
    if date_end is not None:
        ship = ship.filter(ts < F.date_add(F.lit(date_end), 1).cast("timestamp_ntz"))
    for names, table, column, key in (
        (customers, "dim_customer", "name", "customer_id"),
        (carriers, "dim_carrier", "name", "carrier_id"),
        (equipment, "dim_equipment", "type", "equipment_id"),
    ):
        if _given(names):
            ship = semi_by_key(ship, key, keep_named(star[table], column, names), key)
    if _given(lanes):
        labels = lane_labels(star["dim_lane"], star["dim_location"])
        ship = semi_by_key(ship, "lane_id", keep_named(labels, "lane_label", lanes), "lane_id")
    return ship


def typed_times(ship: DataFrame) -> DataFrame:
    """Shipments with their time columns as timestamps; reports take typed columns, so text tables go through this."""
    text = [c for c, t in ship.dtypes if c.endswith("_ts") and t == "string"]
    return ship.withColumns({c: clean.safe_ts(F.col(c)) for c in text}) if text else ship


def delivered(ship: DataFrame) -> DataFrame:
    """Shipments with a delivery time."""
    return ship.filter(F.col("delivery_actual_ts").isNotNull())


def in_flight(ship: DataFrame) -> DataFrame:
    return ship.filter(F.col("delivery_actual_ts").isNull())


def bounds(ship: DataFrame, days: int = BOUNDS_DAYS) -> DataFrame:
    """One row: the window of ``days`` days that ends at the latest delivery date."""
    end = F.to_date(F.max("delivery_actual_ts"))
    return ship.agg(end.alias("end_d")).select(F.date_sub("end_d", days).alias("start_d"), "end_d")


def within_bounds(df: DataFrame, ts_col: str, window: Bounds | None) -> DataFrame:
    """Rows whose timestamp falls on a day inside the window, both ends included.

    A window frame has one row and enters as scalar subqueries: no join, and computed once per query.  The finished
    timestamps are made in that row, so that the column is compared with a plain value and the filter reaches the scan.
    """
    if window is None:
        return df
    if isinstance(window, DataFrame):
        low = F.col("start_d").cast("timestamp_ntz").alias("t")
        high = F.date_add("end_d", 1).cast("timestamp_ntz").alias("t")
        start, end = window.select(low).scalar(), window.select(high).scalar()
    else:
        start, end = (F.lit(d).cast("timestamp_ntz") for d in (window[0], window[1] + timedelta(days=1)))
    ts = F.col(ts_col)
    return df.filter((ts >= start) & (ts < end))


def min_shipments(lane_perf: DataFrame, n: int = 5) -> DataFrame:
    """Drop lanes with fewer than ``n`` shipments."""
    return lane_perf.filter(F.col("shipments") >= n)


def is_tendered(status: Column) -> Column:
    return status.isin(*STATUS_TENDERED)


def is_accepted(status: Column) -> Column:
    return status.isin(*STATUS_ACCEPTED)
