"""Report and KPI aggregations.

Rules they share:

* A KPI that needs the latest delivery date first reduces the fact to one row per day and takes the date from that,
  so the fact is read once.
* Distinct shipment counts reduce to one row per shipment and then count flags.  The reduction combines before the
  shuffle, and several distinct counts share one shuffle.
* Fact rows are counted per dimension key before the key's name is joined, so the join sees the small result.
* Every limited report has a total order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions import measures
from freightlens.functions.measures import GM_TARGET, GRACE_MINUTES, ratio
from freightlens.operators import filters, joins
from freightlens.operators.filters import Bounds, delivered, within_bounds



def _on_time(grace: int) -> Column:
    return measures.on_time(F.col("delivery_actual_ts"), F.col("delivery_plan_ts"), grace)


def _transit() -> Column:
    return measures.transit_days(F.col("pickup_actual_ts"), F.col("delivery_actual_ts"))


def _is_delivered() -> Column:
    return F.col("delivery_actual_ts").isNotNull()


def _moved() -> Column:
    return F.col("pickup_actual_ts").isNotNull() & _is_delivered()


def _count(flag: Column) -> Column:
    return F.count_if(flag)


def _total(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


# --- delivery -----------------------------------------------------------------------------------------------------


def snapshot(ship: DataFrame) -> DataFrame:
    ts = F.col("delivery_actual_ts")
    return ship.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(ts).alias("delivered_rows"),
        F.to_date(F.min(ts)).alias("min_delivery_date"),
        F.to_date(F.max(ts)).alias("max_delivery_date"),
    )


def anchor_date(ship: DataFrame) -> DataFrame:
    return ship.agg(F.to_date(F.max("delivery_actual_ts")).alias("anchor_date"))


def _per_day(ship: DataFrame, **aggregates: Column) -> DataFrame:
    return (
        delivered(ship)
        .groupBy(F.to_date("delivery_actual_ts").alias("d"))
        .agg(*[a.alias(name) for name, a in aggregates.items()])
    )


def _anchored(daily: DataFrame) -> DataFrame:
    """Daily rows with the latest day beside them.  The window is global, over at most one row per calendar day."""
    return daily.withColumn("anchor_date", F.max("d").over(Window.partitionBy(F.lit(0))))


def otd_windows(ship: DataFrame, grace: int = GRACE_MINUTES, window: Bounds | None = None) -> DataFrame:
    """On-time rate of the last 30 days and of days -60 to -30 before the latest delivery, and their difference."""
    daily = _per_day(
        within_bounds(ship, "delivery_actual_ts", window), n=F.count(F.lit(1)), on_time=_count(_on_time(grace))
    )
    return otd_windows_of_days(daily, grace)


def otd_windows_of_days(daily: DataFrame, grace: int = GRACE_MINUTES) -> DataFrame:
    """:func:`otd_windows` from days (``d``) with their deliveries (``n``) and those on time (``on_time``)."""
    dated = _anchored(daily)
    day, anchor = F.col("d"), F.col("anchor_date")
    last = day.between(F.date_sub(anchor, 29), anchor)
    prior = day.between(F.date_sub(anchor, 60), F.date_sub(anchor, 30))
    counts = dated.agg(
        F.max("anchor_date").alias("anchor_date"),
        *[
            _total(F.when(span, F.col(c))).alias(f"{c}_{name}")
            for name, span in (("last", last), ("prior", prior))
            for c in ("n", "on_time")
        ],
    )
    last_rate = ratio(F.col("on_time_last"), F.col("n_last"))
    prior_rate = ratio(F.col("on_time_prior"), F.col("n_prior"))
    return counts.select(
        "anchor_date",
        last_rate.alias("otd_last_30"),
        prior_rate.alias("otd_prior_30"),
        (last_rate - prior_rate).alias("otd_delta_pp"),
        F.col("n_last").alias("delivered_last_30"),
        F.col("n_prior").alias("delivered_prior_30"),
        F.lit(grace).alias("grace_minutes"),
    )


def otd_rate(ship: DataFrame) -> DataFrame:
    """On-time rate by the stored flag."""
    return delivered(ship).agg(
        ratio(_count(F.coalesce("isdeliveredontime", F.lit(False))), F.count(F.lit(1))).alias("otd_rate")
    )


def otd_otif_rates(ship: DataFrame, grace: int = GRACE_MINUTES) -> DataFrame:
    """On-time and on-time-in-full shares of distinct delivered shipments."""
    on_time = _on_time(grace)
    in_full = measures.otif(on_time, F.col("isinfull"), null_is_false=True)
    per_shipment = (
        delivered(ship).groupBy("shipment_id").agg(F.max(on_time).alias("on_time"), F.max(in_full).alias("otif"))
    )
    n, otd, otif = F.count(F.lit(1)), _count(F.col("on_time")), _count(F.col("otif"))
    return per_shipment.agg(
        n.alias("delivered_shipments"),
        otd.alias("otd_deliveries"),
        otif.alias("otif_deliveries"),
        ratio(otd, n).alias("otd_rate"),
        ratio(otif, n).alias("otif_rate"),
    )


def otd_rate_rowgrain(ship: DataFrame, grace: int = GRACE_MINUTES) -> DataFrame:
    """The same rate counted by legs."""
    n, on_time = F.count(F.lit(1)), _count(_on_time(grace))
    return delivered(ship).agg(
        n.alias("delivered_legs"), on_time.alias("on_time_legs"), ratio(on_time, n).alias("otd_rate")
    )


def otd_windows_calendar(
    ship: DataFrame, dim_date: DataFrame, grace: int = GRACE_MINUTES, grain: str = "shipment"
) -> DataFrame:
    """On-time rate of the 30 days up to the last calendar date and of the 30 days before those.

    ``grain`` counts distinct shipments or legs.
    """
    top = dim_date.agg(F.max("date").alias("date")).scalar()
    dated = delivered(ship).select(
        "shipment_id", F.to_date("delivery_actual_ts").alias("d"), _on_time(grace).alias("on_time"),
        top.alias("calendar_end"),
    )
    day, end = F.col("d"), F.col("calendar_end")
    spans = {
        "last": day.between(F.date_sub(end, 29), end),
        "prior": day.between(F.date_sub(end, 60), F.date_sub(end, 31)),
    }
    flags = {}
    for name, span in spans.items():
        flags[f"n_{name}"] = span
        flags[f"on_time_{name}"] = span & F.col("on_time")
    flagged = dated.select("shipment_id", *[f.alias(k) for k, f in flags.items()])
    if grain == "shipment":
        flagged = flagged.groupBy("shipment_id").agg(*[F.max(k).alias(k) for k in flags])
    counts = flagged.agg(*[_count(F.col(k)).alias(k) for k in flags])
    last_rate = ratio(F.col("on_time_last"), F.col("n_last"))
    prior_rate = ratio(F.col("on_time_prior"), F.col("n_prior"))
    return counts.select(
        last_rate.alias("otd_last_30"), prior_rate.alias("otd_prior_30"), (last_rate - prior_rate).alias("otd_delta_pp")
    )


def daily_trend(ship: DataFrame, grace: int = GRACE_MINUTES, days: int = 60) -> DataFrame:
    """Delivered count and on-time rate per day over the last ``days`` days."""
    return daily_trend_of_days(_per_day(ship, n=F.count(F.lit(1)), on_time=_count(_on_time(grace))), days)


def daily_trend_of_days(daily: DataFrame, days: int = 60) -> DataFrame:
    """:func:`daily_trend` from days (``d``) with their deliveries (``n``) and those on time (``on_time``)."""
    return (
        _anchored(daily).filter(F.col("d") > F.date_sub("anchor_date", days))
        .select(
            F.col("d").alias("delivery_date"), F.col("n").alias("delivered"),
            ratio(F.col("on_time"), F.col("n")).alias("otd_rate"),
        )
        .orderBy("delivery_date")
    )


def _first(df: DataFrame, limit: int | None) -> DataFrame:
    """All rows, or the first ``limit`` of an ordered frame where the caller asks for a top list."""
    return df if limit is None else df.limit(limit)


def daily_deliveries(ship: DataFrame, limit: int | None = None) -> DataFrame:
    """Deliveries per day, earliest days first."""
    daily = _per_day(ship, delivered_cnt=F.count(F.lit(1))).select(F.col("d").alias("delivery_date"), "delivered_cnt")
    return _first(daily.orderBy("delivery_date"), limit)


# --- margin -------------------------------------------------------------------------------------------------------

_MONEY = ("revenue", "total_cost", "planned_miles")


def gm_per_mile(ship: DataFrame) -> DataFrame:
    """Totals, gross margin and gross margin per planned mile."""
    totals = ship.agg(*[F.sum(c).alias(c) for c in _MONEY])
    return totals.select(
        *_MONEY,
        (F.col("revenue") - F.col("total_cost")).alias("gross_margin"),
        measures.gm_per_mile(*[F.col(c) for c in _MONEY]).alias("gm_per_mile"),
    )


def gm_per_mile_ytd(ship: DataFrame, target: float = GM_TARGET) -> DataFrame:
    """Margin per mile of deliveries in the calendar year of the latest one, against a target."""
    return gm_per_mile_ytd_of_days(_per_day(ship, **{c: F.sum(c) for c in _MONEY}), target)


def gm_per_mile_ytd_of_days(daily: DataFrame, target: float = GM_TARGET) -> DataFrame:
    """:func:`gm_per_mile_ytd` from days (``d``) with the sums of their money columns."""
    in_year = F.col("d") >= F.trunc("anchor_date", "year")
    totals = _anchored(daily).filter(in_year).agg(*[F.sum(c).alias(c) for c in _MONEY])
    value = measures.gm_per_mile(*[F.col(c) for c in _MONEY])
    return totals.select(
        value.alias("gm_per_mile_ytd"),
        F.lit(target).alias("target_gm_per_mile"),
        (value - F.lit(target)).alias("variance_pp"),
    )


def gm_per_mile_ytd_calendar(ship: DataFrame, dim_date: DataFrame, target: float = GM_TARGET) -> DataFrame:
    """Margin per mile from the start of the year of the calendar's last day up to that day, against a target."""
    last = dim_date.agg(F.max("date").alias("d")).select(F.trunc("d", "year").alias("start_d"), F.col("d").alias("end_d"))
    totals = within_bounds(ship, "delivery_actual_ts", last).agg(*[F.sum(c).alias(c) for c in _MONEY])
    value = measures.gm_per_mile(*[F.col(c) for c in _MONEY])
    return totals.select(
        value.alias("gm_per_mile_ytd"),
        F.lit(target).alias("target_gm_per_mile"),
        (value - F.lit(target)).alias("variance_pp"),
    )


# --- tendering ----------------------------------------------------------------------------------------------------


def tender_acceptance_events(events: DataFrame, window: Bounds | None = None) -> DataFrame:
    """Distinct shipments with an Accepted event over those with a Tendered event."""
    kind = F.col("event_type")
    per_shipment = (
        within_bounds(events.filter(kind.isin("Tendered", "Accepted")), "event_ts", window)
        .groupBy("shipment_id")
        .agg(F.max(kind == "Accepted").alias("accepted"), F.max(kind == "Tendered").alias("tendered"))
    )
    accepted, tendered = _count(F.col("accepted")), _count(F.col("tendered"))
    return per_shipment.agg(
        accepted.alias("accepted_shipments"),
        tendered.alias("tendered_shipments"),
        ratio(accepted, tendered).alias("tender_acceptance_events"),
    )


def tender_acceptance_status(ship: DataFrame, grain: str = "leg") -> DataFrame:
    """Share of accepted statuses in the tendered universe, by legs or distinct shipments."""
    flagged = ship.select(
        "shipment_id",
        F.coalesce(filters.is_accepted(F.col("status")), F.lit(False)).alias("accepted"),
        F.coalesce(filters.is_tendered(F.col("status")), F.lit(False)).alias("tendered"),
    )
    if grain == "shipment":
        flagged = flagged.groupBy("shipment_id").agg(*[F.max(c).alias(c) for c in ("accepted", "tendered")])
    return flagged.agg(
        ratio(_count(F.col("accepted")), _count(F.col("tendered"))).alias("tender_acceptance_status")
    )


# --- transit and lanes --------------------------------------------------------------------------------------------


def avg_transit_days(ship: DataFrame, window: Bounds | None = None) -> DataFrame:
    return within_bounds(ship.filter(_moved()), "delivery_actual_ts", window).agg(
        F.avg(_transit()).alias("avg_transit_days")
    )


def avg_transit_days_of_days(daily: DataFrame) -> DataFrame:
    """:func:`avg_transit_days` from days with the moved shipments delivered on them (``moved``) and their ``transit_days``."""
    return daily.agg(ratio(F.sum("transit_days"), F.sum("moved")).alias("avg_transit_days"))


def day_totals(ship: DataFrame, grace: int = GRACE_MINUTES) -> DataFrame:
    """What the reports need of each delivery day (``d``), as sums that add up over any parts of the fact: deliveries
    (``n``), those on time, those with a pickup time (``moved``) and their transit days, revenue, cost and miles."""
    zero = F.lit(0).cast("decimal(12,2)")
    return _per_day(
        ship, n=F.count(F.lit(1)), on_time=_count(_on_time(grace)), moved=_count(_moved()),
        transit_days=F.coalesce(F.sum(F.when(_moved(), _transit())), F.lit(0)),
        **{c: F.sum(F.coalesce(F.col(c), zero)).cast("decimal(38,2)") for c in _MONEY},
    )


def avg_transit_days_by_month(ship: DataFrame) -> DataFrame:
    return (
        ship.filter(_moved())
        .groupBy(F.trunc("delivery_actual_ts", "month").alias("month"))
        .agg(F.avg(_transit()).alias("avg_transit_days"))
        .orderBy("month")
    )


def _lane_counts(ship: DataFrame, grace: int) -> DataFrame:
    return (
        ship.filter(_moved())
        .groupBy("lane_id")
        .agg(
            F.count(F.lit(1)).alias("shipments"),
            F.sum(_transit()).alias("_days"),
            _count(_on_time(grace)).alias("_on_time"),
        )
    )


def lane_performance(
    ship: DataFrame,
    lane: DataFrame,
    loc: DataFrame,
    grace: int = GRACE_MINUTES,
    by: str | None = "lane_id",
    limit: int | None = None,
    window: Bounds | None = None,
) -> DataFrame:
    """Shipments, mean transit days and on-time rate per lane, busiest lanes first.

    ``by`` groups by lane and label (``lane_id``), by label alone (``label``), or gives one overall row (None).
    """
    counts = _lane_counts(within_bounds(ship, "delivery_actual_ts", window), grace)
    labelled = counts.join(joins.lane_labels(lane, loc), "lane_id")
    groups = {"lane_id": ["lane_id", "lane_label"], "label": ["lane_label"], None: []}[by]
    perf = (
        labelled.groupBy(*groups)
        .agg(*[F.sum(c).alias(c) for c in ("shipments", "_days", "_on_time")])
        .select(
            *groups,
            "shipments",
            ratio(F.col("_days"), F.col("shipments")).alias("avg_transit_days"),
            ratio(F.col("_on_time"), F.col("shipments")).alias("otd_rate"),
        )
    )
    if by is None:
        return perf
    return _first(perf.orderBy(F.desc("shipments"), *reversed(groups)), limit)


def _exceptions_per(events: DataFrame, ship: DataFrame, by: str, window: Bounds | None = None) -> DataFrame:
    """Exception events per ``by`` value, each event once per value its shipment touches."""
    exceptions = within_bounds(events.filter(F.col("event_type") == "Exception"), "event_ts", window)
    per_shipment = exceptions.groupBy("shipment_id").agg(F.count(F.lit(1)).alias("exceptions"))
    touched = ship.select("shipment_id", by).distinct()
    return per_shipment.join(touched, "shipment_id").groupBy(by).agg(F.sum("exceptions").alias("exceptions"))


def lane_tooltips(
    ship: DataFrame,
    events: DataFrame,
    lane: DataFrame,
    loc: DataFrame,
    grace: int = GRACE_MINUTES,
    window: Bounds | None = None,
) -> DataFrame:
    """Lane figures with margin per mile and exception counts.

    Margin covers all shipments of the lane.  A window takes shipments by delivery and exceptions by event date; a
    shipment's lanes are known from all its legs.
    """
    moved, legs = _moved(), ship
    ship = within_bounds(ship, "delivery_actual_ts", window)
    per_lane = ship.groupBy("lane_id").agg(
        _count(moved).alias("shipments"),
        F.sum(F.when(moved, _transit())).alias("_days"),
        _count(moved & _on_time(grace)).alias("_on_time"),
        *[F.sum(c).alias(c) for c in _MONEY],
    )
    return (
        per_lane.filter(F.col("shipments") > 0)
        .join(joins.lane_labels(lane, loc), "lane_id")
        .join(_exceptions_per(events, legs, "lane_id", window), "lane_id", "left")
        .select(
            "lane_id",
            "lane_label",
            "shipments",
            ratio(F.col("_days"), F.col("shipments")).alias("avg_transit_days"),
            ratio(F.col("_on_time"), F.col("shipments")).alias("otd_rate"),
            measures.gm_per_mile(*[F.col(c) for c in _MONEY]).alias("gm_per_mile"),
            F.coalesce("exceptions", F.lit(0)).alias("exceptions"),
        )
    )


# --- exceptions ---------------------------------------------------------------------------------------------------


def exception_heatmap(
    events: DataFrame,
    ship: DataFrame,
    customer: DataFrame,
    window: Bounds | None = None,
    limit: int | None = None,
    dedupe_legs: bool = False,
) -> DataFrame:
    """Exceptions per customer and type, in long form.

    By default a shipment's exceptions count once per leg, as the plain join of events and legs does.
    """
    typed = within_bounds(joins.exception_events(events), "event_ts", window)
    heat = (
        joins.join_events_to_shipments(typed, ship, "customer_id", dedupe_legs)
        .groupBy("customer_id", "exception_type")
        .agg(F.sum("exceptions").alias("exceptions"))
        .join(customer.select("customer_id", F.col("name").alias("customer_name")), "customer_id")
        .groupBy("customer_name", "exception_type")
        .agg(F.sum("exceptions").alias("exceptions"))
        .orderBy("customer_name", "exception_type")
    )
    return _first(heat, limit)


def heatmap_matrix(heat: DataFrame, types: Sequence[str]) -> DataFrame:
    """The heatmap with one column per listed exception type."""
    return heat.groupBy("customer_name").pivot("exception_type", list(types)).agg(F.sum("exceptions"))


def exception_count(events: DataFrame, window: Bounds | None = None) -> DataFrame:
    exceptions = within_bounds(events.filter(F.col("event_type") == "Exception"), "event_ts", window)
    return exceptions.agg(F.count(F.lit(1)).alias("exceptions"))


def exceptions_by_carrier(
    events: DataFrame, ship: DataFrame, carrier: DataFrame, window: Bounds | None = None
) -> DataFrame:
    return (
        _exceptions_per(events, ship, "carrier_id", window)
        .join(carrier.select("carrier_id", F.col("name").alias("carrier_name")), "carrier_id")
        .groupBy("carrier_name")
        .agg(F.sum("exceptions").alias("exceptions"))
    )


def top_exception_types(events: DataFrame, n: int, window: Bounds | None = None) -> DataFrame:
    """The ``n`` most frequent exception types."""
    return (
        within_bounds(joins.exception_events(events), "event_ts", window)
        .groupBy("exception_type")
        .agg(F.count(F.lit(1)).alias("exceptions"))
        .orderBy(F.desc("exceptions"), "exception_type")
        .limit(n)
    )


# --- detail and options -------------------------------------------------------------------------------------------


def shipment_detail(
    ship: DataFrame,
    star: Mapping[str, DataFrame],
    grace: int = GRACE_MINUTES,
    window: Bounds | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The drill-through rows; with ``limit`` the first by shipment and leg.

    All rows come unordered: a full sort of the fact is the caller's choice.
    """
    rows = joins.enrich_shipments(
        within_bounds(ship, "delivery_actual_ts", window),
        star["dim_customer"], star["dim_carrier"], star["dim_lane"], star["dim_location"],
    )
    on_time = _on_time(grace)
    detail = rows.select(
        "shipment_id", "leg_id", "customer_name", "carrier_name", "lane_label", "status",
        "pickup_plan_ts", "pickup_actual_ts", "delivery_plan_ts", "delivery_actual_ts",
        on_time.alias("isdeliveredontime_calc"),
        "isinfull",
        measures.otif(on_time, F.col("isinfull")).alias("isotif_calc"),
        "planned_miles", "actual_miles", "revenue", "total_cost",
        measures.gm_per_mile(*[F.col(c) for c in _MONEY]).alias("gm_per_mile"),
    )
    return detail if limit is None else detail.orderBy("shipment_id", "leg_id").limit(limit)


def filter_options(star: Mapping[str, DataFrame], limit: int | None = None) -> DataFrame:
    """(k, v) choices of the report filters; with ``limit`` the first names of each kind, and all equipment types."""

    def options(kind: str, values: DataFrame, top: int | None) -> DataFrame:
        named = values.select(F.lit(kind).alias("k"), F.col(values.columns[0]).alias("v"))
        return named if top is None else named.orderBy("v").limit(top)

    labels = joins.lane_labels(star["dim_lane"], star["dim_location"])
    return (
        options("customer", star["dim_customer"].select("name"), limit)
        .unionByName(options("carrier", star["dim_carrier"].select("name"), limit))
        .unionByName(options("equipment", star["dim_equipment"].select("type").distinct(), None))
        .unionByName(options("lane", labels.select("lane_label").distinct(), limit))
    )


# --- events and costs ---------------------------------------------------------------------------------------------


def dwell_minutes(events: DataFrame) -> DataFrame:
    """Dwell minutes per shipment: a DwellStart pairs with the DwellEnd that follows it among the shipment's dwell events.

    Events follow their sequence number, whatever other events or gaps lie between; of equal numbers the earlier time
    comes first, and a start before an end.  A start that another start follows, and an end that no start precedes, are
    unpaired.  A pair counts without minutes if one of its times is missing.

    The order is a range partitioning, so a shipment of any size spreads over partitions.  Each partition sums up its
    piece of a shipment and says how the piece begins and ends; pieces, at most one per partition, are then put together.
    """
    is_end = F.col("event_type") == "DwellEnd"
    order = ("event_seq", "event_ts", "is_end")
    dwell = events.filter(F.col("event_type").isin("DwellStart", "DwellEnd")).select(
        "shipment_id", "event_seq", "event_ts", is_end.alias("is_end")
    )
    ranged = dwell.repartitionByRange("shipment_id", *order).withColumn("_part", F.spark_partition_id())
    along = Window.partitionBy("_part", "shipment_id").orderBy(*order)
    seen = ranged.select(
        "_part", "shipment_id", "is_end", "event_ts",
        F.lag("is_end").over(along).alias("before"),
        F.lead("is_end").over(along).alias("after"),
        F.lead("event_ts").over(along).alias("after_ts"),
    )
    opens, first, last = ~F.col("is_end"), F.col("before").isNull(), F.col("after").isNull()
    pair = opens & F.col("after")
    # The first and the last event of a piece may pair with another piece.
    alone = (opens & ~F.col("after")) | (F.col("is_end") & F.col("before"))
    pieces = seen.groupBy("_part", "shipment_id").agg(
        _count(F.coalesce(pair, F.lit(False))).alias("pairs"),
        _total(F.when(pair, _minutes("event_ts", "after_ts"))).alias("minutes"),
        _count(F.coalesce(alone, F.lit(False))).alias("alone"),
        F.max(F.when(first, F.col("is_end"))).alias("starts_with_end"),
        F.max(F.when(first, F.col("event_ts"))).alias("first_ts"),
        F.max(F.when(last, opens)).alias("ends_open"),
        F.max(F.when(last, F.col("event_ts"))).alias("last_ts"),
    )
    in_order = Window.partitionBy("shipment_id").orderBy("_part")
    met = pieces.withColumns({
        "open": F.coalesce(F.lag("ends_open").over(in_order), F.lit(False)),
        "open_ts": F.lag("last_ts").over(in_order),
        "closed": F.coalesce(F.lead("starts_with_end").over(in_order), F.lit(False)),
    })
    joined = F.col("starts_with_end") & F.col("open")
    lost = (F.col("starts_with_end") & ~F.col("open")).cast("int") + (F.col("ends_open") & ~F.col("closed")).cast("int")
    return met.groupBy("shipment_id").agg(
        (F.sum("minutes") + _total(F.when(joined, _minutes("open_ts", "first_ts")))).alias("dwell_minutes"),
        (F.sum("pairs") + _count(joined)).alias("dwell_pairs"),
        (F.sum("alone") + F.sum(lost)).alias("unpaired"),
    )


def _minutes(start: str, end: str) -> Column:
    """Whole minutes between two times, rounded down."""
    return F.floor((F.unix_seconds(F.col(end).cast("timestamp")) - F.unix_seconds(F.col(start).cast("timestamp"))) / 60)


def cost_rollup(cost: DataFrame, ship: DataFrame) -> DataFrame:
    """Cost totals per shipment by kind, against the shipment's own total.

    Costs and legs are summed per shipment in one grouping over their union, so no join is needed and both sides
    combine before the shuffle.
    """
    zero = F.lit(0).cast("decimal(12,2)")
    amount = F.coalesce("cost_amount", zero)
    kinds = {
        "base_cost": F.col("cost_type") == "Base",
        "fuel_cost": F.col("cost_type") == "Fuel",
        "accessorial_cost": F.col("cost_type").startswith("Accessorial"),
    }
    lines = cost.select(
        "shipment_id",
        *[F.when(is_kind, amount).otherwise(zero).alias(k) for k, is_kind in kinds.items()],
        amount.alias("cost_total"),
        zero.alias("shipment_total"),
    )
    legs = ship.select(
        "shipment_id",
        *[zero.alias(k) for k in kinds],
        zero.alias("cost_total"),
        F.coalesce("total_cost", zero).alias("shipment_total"),
    )
    totals = (*kinds, "cost_total", "shipment_total")
    return (
        lines.unionByName(legs)
        .groupBy("shipment_id")
        .agg(*[F.sum(c).alias(c) for c in totals])
        .withColumn("difference", F.col("cost_total") - F.col("shipment_total"))
    )


_MILESTONES = (("Tendered", F.min), ("Accepted", F.min), ("PickedUp", F.min), ("Delivered", F.max))


def event_lifecycle(events: DataFrame) -> DataFrame:
    """First tender, acceptance and pickup and last delivery per shipment, taken by event type."""
    kind = F.col("event_type")
    return (
        events.filter(kind.isin(*[m for m, _ in _MILESTONES]))
        .groupBy("shipment_id")
        .agg(*[pick(F.when(kind == m, F.col("event_ts"))).alias(f"{m.lower()}_ts") for m, pick in _MILESTONES])
    )
