"""Exact distinct counts over any window from daily bitmaps.

Shipments are numbered, and a day holds, per stretch of 32,768 numbers, one bitmap for each flag: whose number is set has
the flag on that day.  A window joins the bitmaps of its days by OR and counts bits, so a shipment with legs on several
days counts once, and no window shuffles by shipment again.  A bitmap has 4 KB, whatever it holds; numbers should be dense.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions import measures
from freightlens.functions.measures import GRACE_MINUTES, ratio
from freightlens.operators.filters import delivered


def shipment_number(shipment_id: Column) -> Column:
    """The number in ids of one letter and digits, as the generated ones have; others need a numbering of their own."""
    return F.substring(shipment_id, 2, 40).cast("long")


def daily_bitmaps(rows: DataFrame, day: Column, number: Column, flags: Mapping[str, Column]) -> DataFrame:
    """(day, stretch, one bitmap per flag) of rows.  Rows without day or number count nowhere; a null flag is not set.

    What comes together is a row per day and number, combined in map tasks.  The rows of a stretch then meet in one task,
    and only there become bitmaps, one after the other: bitmaps are neither held by map tasks nor shuffled.
    """
    marked = rows.select(day.alias("day"), number.alias("_n"), *[f.alias(k) for k, f in flags.items()])
    marked = marked.where(F.col("day").isNotNull() & F.col("_n").isNotNull())
    once = marked.groupBy(F.bitmap_bucket_number("_n").alias("stretch"), "day", "_n").agg(*[F.max(k).alias(k) for k in flags])
    at = F.bitmap_bit_position("_n")
    # Grouped by stretch first, so that a window's bitmaps are joined in the order in which they are made.
    made = once.repartition("stretch").groupBy("stretch", "day")
    return made.agg(*[F.bitmap_construct_agg(F.when(F.col(k), at)).alias(k) for k in flags]).select("day", "stretch", *flags)


def add_days(bitmaps: DataFrame, more: DataFrame) -> DataFrame:
    """Bitmaps of two sets of rows as if made of all of them; a shipment in both counts once."""
    flags = [c for c in bitmaps.columns if c not in ("day", "stretch")]
    return bitmaps.unionByName(more).groupBy("day", "stretch").agg(*[F.bitmap_or_agg(c).alias(c) for c in flags])


def distinct_counts(bitmaps: DataFrame, windows: Mapping[str, tuple[Column | date, Column | date]]) -> DataFrame:
    """One row: for each window (first and last day, both included) and flag the shipments that have it, as
    ``<flag>_<window>``.  All windows are counted in one pass."""
    flags = [c for c in bitmaps.columns if c not in ("day", "stretch")]

    def inside(bounds: tuple) -> Column:
        first, last = (b if isinstance(b, Column) else F.lit(b) for b in bounds)
        return F.col("day").between(first, last)

    joined = bitmaps.groupBy("stretch").agg(
        *[F.bitmap_or_agg(F.when(inside(b), F.col(c))).alias(f"{c}_{w}") for w, b in windows.items() for c in flags]
    )
    names = [f"{c}_{w}" for w in windows for c in flags]
    return joined.agg(*[F.coalesce(F.sum(F.bitmap_count(n)), F.lit(0)).alias(n) for n in names])


def delivery_bitmaps(ship: DataFrame, grace: int = GRACE_MINUTES) -> DataFrame:
    """Daily bitmaps of delivered, on-time and on-time-in-full shipments, by delivery day."""
    on_time = measures.on_time(F.col("delivery_actual_ts"), F.col("delivery_plan_ts"), grace)
    flags = {
        "delivered": F.lit(True),
        "on_time": on_time,
        "otif": measures.otif(on_time, F.col("isinfull"), null_is_false=True),
    }
    return daily_bitmaps(delivered(ship), F.to_date("delivery_actual_ts"), shipment_number(F.col("shipment_id")), flags)


def tender_bitmaps(events: DataFrame) -> DataFrame:
    """Daily bitmaps of shipments with a Tendered and with an Accepted event, by event day."""
    kind = F.col("event_type")
    flags = {"accepted": kind == "Accepted", "tendered": kind == "Tendered"}
    rows = events.filter(kind.isin("Tendered", "Accepted"))
    return daily_bitmaps(rows, F.to_date("event_ts"), shipment_number(F.col("shipment_id")), flags)


def otd_otif_rates(bitmaps: DataFrame, first: Column | date, last: Column | date) -> DataFrame:
    """On-time and on-time-in-full shares of the distinct shipments delivered in a window."""
    counts = distinct_counts(bitmaps, {"w": (first, last)})
    n, on_time, otif = (F.col(f"{c}_w") for c in ("delivered", "on_time", "otif"))
    return counts.select(
        n.alias("delivered_shipments"), on_time.alias("otd_deliveries"), otif.alias("otif_deliveries"),
        ratio(on_time, n).alias("otd_rate"), ratio(otif, n).alias("otif_rate"),
    )


def otd_windows_calendar(bitmaps: DataFrame, dim_date: DataFrame) -> DataFrame:
    """On-time rate of distinct shipments over the 30 days up to the last calendar date and the 30 days before those."""
    end = dim_date.agg(F.max("date").alias("date")).scalar()
    spans = {"last": (F.date_sub(end, 29), end), "prior": (F.date_sub(end, 60), F.date_sub(end, 31))}
    counts = distinct_counts(bitmaps, spans)
    last, prior = (ratio(F.col(f"on_time_{w}"), F.col(f"delivered_{w}")) for w in spans)
    return counts.select(last.alias("otd_last_30"), prior.alias("otd_prior_30"), (last - prior).alias("otd_delta_pp"))


def tender_acceptance(bitmaps: DataFrame, first: Column | date, last: Column | date) -> DataFrame:
    """Distinct shipments accepted over those tendered in a window of event days."""
    counts = distinct_counts(bitmaps, {"w": (first, last)})
    accepted, tendered = F.col("accepted_w"), F.col("tendered_w")
    return counts.select(
        accepted.alias("accepted_shipments"), tendered.alias("tendered_shipments"),
        ratio(accepted, tendered).alias("tender_acceptance_events"),
    )
