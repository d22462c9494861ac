"""Registered report queries: KPIs and the filters they take."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.operators import bitmaps, filters, kpis
from freightlens.plans.registry import Bound, register
from freightlens.schemas import STATUS_ACCEPTED, STATUS_TENDERED


def _ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)"


def _per_mile(source: str = "") -> str:
    p = f"{source}." if source else ""
    return _ratio(f"sum({p}revenue) - sum({p}total_cost)", f"sum({p}planned_miles)")


# --- delivery -----------------------------------------------------------------------------------------------------


@register("""SELECT count(*) AS total_rows, count(delivery_actual_ts) AS delivered_rows,
  CAST(min(delivery_actual_ts) AS DATE) AS min_delivery_date, CAST(max(delivery_actual_ts) AS DATE) AS max_delivery_date
FROM fact_shipment""")
def snapshot(b: Bound) -> DataFrame:
    return kpis.snapshot(b.ship)


@register("SELECT max(d) AS anchor_date FROM delivered")
def anchor_date(b: Bound) -> DataFrame:
    return kpis.anchor_date(b.ship)


def windows_sql(prior_end: int, source: str) -> str:
    def share(first: int, last: int) -> str:
        span = f"d BETWEEN a - {first} AND a - {last}"
        return _ratio(f"count(*) FILTER (WHERE {span} AND on_time)", f"count(*) FILTER (WHERE {span})")

    return f"""SELECT max(a) AS anchor_date, {share(29, 0)} AS otd_last_30, {share(60, prior_end)} AS otd_prior_30,
  {share(29, 0)} - {share(60, prior_end)} AS otd_delta_pp,
  count(*) FILTER (WHERE d BETWEEN a - 29 AND a) AS delivered_last_30,
  count(*) FILTER (WHERE d BETWEEN a - 60 AND a - {prior_end}) AS delivered_prior_30, 60 AS grace_minutes
FROM {source}"""


@register(windows_sql(30, "(SELECT *, max(d) OVER () AS a FROM delivered)"))
def otd_windows(b: Bound) -> DataFrame:
    return kpis.otd_windows(b.ship)


@register(windows_sql(30, "(SELECT *, max(d) OVER () AS a FROM delivered, bounds WHERE d BETWEEN start_d AND end_d)"))
def otd_windows_bounded(b: Bound) -> DataFrame:
    return kpis.otd_windows(b.ship, window=filters.bounds(b.ship))


@register(f"SELECT {_ratio('count(*) FILTER (WHERE isdeliveredontime)', 'count(*)')} AS otd_rate FROM delivered")
def otd_rate(b: Bound) -> DataFrame:
    return kpis.otd_rate(b.ship)


_OTIF_SQL = f"""SELECT count(DISTINCT shipment_id) AS delivered_shipments,
  count(DISTINCT shipment_id) FILTER (WHERE on_time) AS otd_deliveries,
  count(DISTINCT shipment_id) FILTER (WHERE on_time AND isinfull) AS otif_deliveries,
  {_ratio('count(DISTINCT shipment_id) FILTER (WHERE on_time)', 'count(DISTINCT shipment_id)')} AS otd_rate,
  {_ratio('count(DISTINCT shipment_id) FILTER (WHERE on_time AND isinfull)', 'count(DISTINCT shipment_id)')} AS otif_rate
FROM delivered"""


@register(_OTIF_SQL)
def otd_otif_rates(b: Bound) -> DataFrame:
    return kpis.otd_otif_rates(b.ship)


def _span(b: Bound) -> tuple[Column, Column]:
    window = filters.bounds(b.ship)
    return window.select("start_d").scalar(), window.select("end_d").scalar()


@register(f"{_OTIF_SQL}, bounds WHERE d BETWEEN start_d AND end_d")
def bitmap_otd_otif_rates(b: Bound) -> DataFrame:
    """Distinct shares of a window from daily bitmaps."""
    return bitmaps.otd_otif_rates(bitmaps.delivery_bitmaps(b.ship), *_span(b))


@register(f"""SELECT count(*) AS delivered_legs, count(*) FILTER (WHERE on_time) AS on_time_legs,
  {_ratio('count(*) FILTER (WHERE on_time)', 'count(*)')} AS otd_rate FROM delivered""")
def otd_rate_rowgrain(b: Bound) -> DataFrame:
    return kpis.otd_rate_rowgrain(b.ship)


def _calendar_sql(counted: str) -> str:
    def share(first: int, last: int) -> str:
        span = f"d BETWEEN a - {first} AND a - {last}"
        return _ratio(f"count({counted}) FILTER (WHERE {span} AND on_time)", f"count({counted}) FILTER (WHERE {span})")

    return f"""SELECT {share(29, 0)} AS otd_last_30, {share(60, 31)} AS otd_prior_30,
  {share(29, 0)} - {share(60, 31)} AS otd_delta_pp
FROM (SELECT *, (SELECT max(date) FROM dim_date) AS a FROM delivered)"""


@register(_calendar_sql("DISTINCT shipment_id"))
def otd_windows_calendar(b: Bound) -> DataFrame:
    return kpis.otd_windows_calendar(b.ship, b.star["dim_date"])


@register(_calendar_sql("DISTINCT shipment_id"))
def bitmap_otd_windows_calendar(b: Bound) -> DataFrame:
    """Distinct shares of the calendar windows from daily bitmaps."""
    return bitmaps.otd_windows_calendar(bitmaps.delivery_bitmaps(b.ship), b.star["dim_date"])


@register(_calendar_sql("shipment_id"))
def otd_windows_calendar_legs(b: Bound) -> DataFrame:
    return kpis.otd_windows_calendar(b.ship, b.star["dim_date"], grain="leg")


@register(f"""SELECT d AS delivery_date, count(*) AS delivered,
  {_ratio('count(*) FILTER (WHERE on_time)', 'count(*)')} AS otd_rate
FROM delivered, bounds WHERE d > end_d - 60 GROUP BY d""")
def daily_trend(b: Bound) -> DataFrame:
    return kpis.daily_trend(b.ship)


_DAILY = "SELECT d AS delivery_date, count(*) AS delivered_cnt FROM delivered GROUP BY d"


@register(_DAILY)
def daily_deliveries(b: Bound) -> DataFrame:
    return kpis.daily_deliveries(b.ship)


@register(f"{_DAILY} ORDER BY d LIMIT 100")
def daily_deliveries_top(b: Bound) -> DataFrame:
    return kpis.daily_deliveries(b.ship, limit=100)


# --- margin -------------------------------------------------------------------------------------------------------


@register(f"""SELECT CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(total_cost) AS DOUBLE) AS total_cost,
  CAST(sum(planned_miles) AS DOUBLE) AS planned_miles,
  CAST(sum(revenue) - sum(total_cost) AS DOUBLE) AS gross_margin, {_per_mile()} AS gm_per_mile
FROM fact_shipment""")
def gm_per_mile(b: Bound) -> DataFrame:
    return kpis.gm_per_mile(b.ship)


@register(f"""SELECT {_per_mile()} AS gm_per_mile_ytd, CAST(0.40 AS DOUBLE) AS target_gm_per_mile,
  {_per_mile()} - CAST(0.40 AS DOUBLE) AS variance_pp
FROM delivered, bounds WHERE d BETWEEN CAST(date_trunc('year', end_d) AS DATE) AND end_d""")
def gm_per_mile_ytd(b: Bound) -> DataFrame:
    return kpis.gm_per_mile_ytd(b.ship)


@register(f"""SELECT {_per_mile()} AS gm_per_mile_ytd, CAST(0.40 AS DOUBLE) AS target_gm_per_mile,
  {_per_mile()} - CAST(0.40 AS DOUBLE) AS variance_pp
FROM delivered, (SELECT max(date) AS a FROM dim_date) WHERE d BETWEEN CAST(date_trunc('year', a) AS DATE) AND a""")
def gm_per_mile_ytd_calendar(b: Bound) -> DataFrame:
    return kpis.gm_per_mile_ytd_calendar(b.ship, b.star["dim_date"])


# --- tendering ----------------------------------------------------------------------------------------------------


def _tender_sql(source: str) -> str:
    accepted = "count(DISTINCT shipment_id) FILTER (WHERE event_type = 'Accepted')"
    tendered = "count(DISTINCT shipment_id) FILTER (WHERE event_type = 'Tendered')"
    return f"""SELECT {accepted} AS accepted_shipments, {tendered} AS tendered_shipments,
  {_ratio(accepted, tendered)} AS tender_acceptance_events FROM {source}"""


@register(_tender_sql("fact_event"))
def tender_acceptance_events(b: Bound) -> DataFrame:
    return kpis.tender_acceptance_events(b.events)


_TENDER_BOUNDED = _tender_sql("fact_event, bounds WHERE CAST(event_ts AS DATE) BETWEEN start_d AND end_d")


@register(_TENDER_BOUNDED)
def bitmap_tender_acceptance(b: Bound) -> DataFrame:
    """Distinct acceptance of a window of event days from daily bitmaps."""
    return bitmaps.tender_acceptance(bitmaps.tender_bitmaps(b.events), *_span(b))


@register(_TENDER_BOUNDED)
def tender_acceptance_events_bounded(b: Bound) -> DataFrame:
    return kpis.tender_acceptance_events(b.events, filters.bounds(b.ship))


def _status_sql(counted: str) -> str:
    accepted = f"count({counted}) FILTER (WHERE status IN {STATUS_ACCEPTED})"
    tendered = f"count({counted}) FILTER (WHERE status IN {STATUS_TENDERED})"
    return f"SELECT {_ratio(accepted, tendered)} AS tender_acceptance_status FROM fact_shipment"


@register(_status_sql("*"))
def tender_acceptance_status(b: Bound) -> DataFrame:
    return kpis.tender_acceptance_status(b.ship)


@register(_status_sql("DISTINCT shipment_id"))
def tender_acceptance_status_shipments(b: Bound) -> DataFrame:
    return kpis.tender_acceptance_status(b.ship, grain="shipment")


# --- transit and lanes --------------------------------------------------------------------------------------------


@register("SELECT avg(transit) AS avg_transit_days FROM delivered")
def avg_transit_days(b: Bound) -> DataFrame:
    return kpis.avg_transit_days(b.ship)


@register("SELECT avg(transit) AS avg_transit_days FROM delivered, bounds WHERE d BETWEEN start_d AND end_d")
def avg_transit_days_bounded(b: Bound) -> DataFrame:
    return kpis.avg_transit_days(b.ship, filters.bounds(b.ship))


@register("""SELECT CAST(date_trunc('month', d) AS DATE) AS month, avg(transit) AS avg_transit_days
FROM delivered GROUP BY 1""")
def avg_transit_days_by_month(b: Bound) -> DataFrame:
    return kpis.avg_transit_days_by_month(b.ship)


_LANE_AGGS = f"""count(*) AS shipments, avg(transit) AS avg_transit_days,
  {_ratio('count(*) FILTER (WHERE on_time)', 'count(*)')} AS otd_rate"""


_BY_LANE = f"""SELECT lane_id, lane_label, {_LANE_AGGS} FROM delivered JOIN lane_label USING (lane_id)
GROUP BY lane_id, lane_label"""
_BY_LABEL = f"""SELECT lane_label, {_LANE_AGGS} FROM delivered JOIN lane_label USING (lane_id), bounds
WHERE d BETWEEN start_d AND end_d GROUP BY lane_label"""


def _lanes(b: Bound, **options) -> DataFrame:
    return kpis.lane_performance(b.ship, b.star["dim_lane"], b.star["dim_location"], **options)


@register(_BY_LANE)
def lane_performance(b: Bound) -> DataFrame:
    return _lanes(b)


@register(f"{_BY_LANE} ORDER BY shipments DESC, lane_label, lane_id LIMIT 100")
def lane_performance_top(b: Bound) -> DataFrame:
    return _lanes(b, limit=100)


@register(_BY_LABEL)
def lane_performance_by_label(b: Bound) -> DataFrame:
    return _lanes(b, by="label", window=filters.bounds(b.ship))


@register(f"{_BY_LABEL} ORDER BY shipments DESC, lane_label LIMIT 50")
def lane_performance_by_label_top(b: Bound) -> DataFrame:
    return _lanes(b, by="label", window=filters.bounds(b.ship), limit=50)


@register(f"SELECT {_LANE_AGGS} FROM delivered JOIN lane_label USING (lane_id)")
def lane_performance_overall(b: Bound) -> DataFrame:
    return kpis.lane_performance(b.ship, b.star["dim_lane"], b.star["dim_location"], by=None)


@register(f"SELECT * FROM ({_BY_LANE}) WHERE shipments >= 100")
def min_shipments(b: Bound) -> DataFrame:
    return filters.min_shipments(_lanes(b), 100)


def _tooltip_sql(delivered: str = "delivered", shipped: str = "fact_shipment", event: str = "") -> str:
    return f"""SELECT lane_id, lane_label, shipments, avg_transit_days, otd_rate, gm_per_mile,
  coalesce(exceptions, 0) AS exceptions
FROM (SELECT lane_id, {_LANE_AGGS} FROM {delivered} GROUP BY lane_id)
JOIN lane_label USING (lane_id)
JOIN (SELECT lane_id, {_per_mile()} AS gm_per_mile FROM {shipped} GROUP BY lane_id) USING (lane_id)
LEFT JOIN (SELECT lane_id, count(*) AS exceptions
           FROM (SELECT DISTINCT shipment_id, lane_id FROM fact_shipment) JOIN fact_event USING (shipment_id)
           WHERE event_type = 'Exception' {event} GROUP BY lane_id) USING (lane_id)"""


_SPAN = "BETWEEN (SELECT start_d FROM bounds) AND (SELECT end_d FROM bounds)"
_IN_BOUNDS = f"AND CAST(event_ts AS DATE) {_SPAN}"


@register(_tooltip_sql())
def lane_tooltips(b: Bound) -> DataFrame:
    return kpis.lane_tooltips(b.ship, b.events, b.star["dim_lane"], b.star["dim_location"])


@register(_tooltip_sql(f"delivered WHERE d {_SPAN}", f"delivered WHERE d {_SPAN}", _IN_BOUNDS))
def lane_tooltips_bounded(b: Bound) -> DataFrame:
    star = b.star
    return kpis.lane_tooltips(
        b.ship, b.events, star["dim_lane"], star["dim_location"], window=filters.bounds(b.ship)
    )


# --- exceptions ---------------------------------------------------------------------------------------------------

_TYPED = "coalesce(nullif(trim(notes), ''), 'Unknown')"


def _heat_sql(ships: str, more: str = "") -> str:
    return f"""SELECT c.name AS customer_name, {_TYPED} AS exception_type, count(*) AS exceptions
FROM fact_event e JOIN {ships} f ON f.shipment_id = e.shipment_id JOIN dim_customer c USING (customer_id)
WHERE event_type = 'Exception' {more} GROUP BY 1, 2"""


@register(_heat_sql("fact_shipment"))
def exception_heatmap(b: Bound) -> DataFrame:
    return kpis.exception_heatmap(b.events, b.ship, b.star["dim_customer"])


@register(_heat_sql("fact_shipment", _IN_BOUNDS))
def exception_heatmap_bounded(b: Bound) -> DataFrame:
    return kpis.exception_heatmap(b.events, b.ship, b.star["dim_customer"], filters.bounds(b.ship))


@register(_heat_sql("fact_shipment", _IN_BOUNDS) + " ORDER BY 1, 2 LIMIT 500")
def exception_heatmap_bounded_top(b: Bound) -> DataFrame:
    return kpis.exception_heatmap(b.events, b.ship, b.star["dim_customer"], filters.bounds(b.ship), limit=500)


@register(_heat_sql("(SELECT DISTINCT shipment_id, customer_id FROM fact_shipment)"))
def exception_heatmap_dedupe_legs(b: Bound) -> DataFrame:
    return kpis.exception_heatmap(b.events, b.ship, b.star["dim_customer"], dedupe_legs=True)


@register(
    "SELECT customer_name, "
    + ", ".join(
        f"CAST(sum(exceptions) FILTER (WHERE exception_type = '{t}') AS BIGINT) AS {c}"
        for t, c in (("URGENT", "urgent"), ("HIGH", "high"), ("Unknown", "unknown"))
    )
    + f" FROM ({_heat_sql('fact_shipment')}) GROUP BY customer_name"
)
def heatmap_matrix(b: Bound) -> DataFrame:
    heat = kpis.exception_heatmap(b.events, b.ship, b.star["dim_customer"])
    wide = kpis.heatmap_matrix(heat, ["URGENT", "HIGH", "Unknown"])
    return wide.toDF(*[c.lower() for c in wide.columns])


_EXCEPTIONS = "SELECT count(*) AS exceptions FROM fact_event WHERE event_type = 'Exception'"


@register(_EXCEPTIONS)
def exception_count(b: Bound) -> DataFrame:
    return kpis.exception_count(b.events)


@register(f"{_EXCEPTIONS} {_IN_BOUNDS}")
def exception_count_bounded(b: Bound) -> DataFrame:
    return kpis.exception_count(b.events, filters.bounds(b.ship))


def _carrier_sql(more: str = "") -> str:
    return f"""SELECT c.name AS carrier_name, count(*) AS exceptions
FROM (SELECT DISTINCT shipment_id, carrier_id FROM fact_shipment) JOIN fact_event USING (shipment_id)
JOIN dim_carrier c USING (carrier_id) WHERE event_type = 'Exception' {more} GROUP BY 1"""


@register(_carrier_sql())
def exceptions_by_carrier(b: Bound) -> DataFrame:
    return kpis.exceptions_by_carrier(b.events, b.ship, b.star["dim_carrier"])


@register(_carrier_sql(_IN_BOUNDS))
def exceptions_by_carrier_bounded(b: Bound) -> DataFrame:
    return kpis.exceptions_by_carrier(b.events, b.ship, b.star["dim_carrier"], filters.bounds(b.ship))


def _types_sql(more: str = "") -> str:
    return f"""SELECT {_TYPED} AS exception_type, count(*) AS exceptions FROM fact_event
WHERE event_type = 'Exception' {more} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""


@register(_types_sql())
def top_exception_types(b: Bound) -> DataFrame:
    return kpis.top_exception_types(b.events, 5)


@register(_types_sql(_IN_BOUNDS))
def top_exception_types_bounded(b: Bound) -> DataFrame:
    return kpis.top_exception_types(b.events, 5, filters.bounds(b.ship))


# --- detail and options -------------------------------------------------------------------------------------------

_DETAIL = """SELECT f.shipment_id, f.leg_id, c.name AS customer_name, cr.name AS carrier_name, lane_label, f.status,
  f.pickup_plan_ts, f.pickup_actual_ts, f.delivery_plan_ts, f.delivery_actual_ts, on_time AS isdeliveredontime_calc,
  f.isinfull, on_time AND f.isinfull AS isotif_calc, CAST(f.planned_miles AS DOUBLE) AS planned_miles,
  CAST(f.actual_miles AS DOUBLE) AS actual_miles, CAST(f.revenue AS DOUBLE) AS revenue,
  CAST(f.total_cost AS DOUBLE) AS total_cost,
  CAST(f.revenue - f.total_cost AS DOUBLE) / nullif(CAST(f.planned_miles AS DOUBLE), 0) AS gm_per_mile
FROM (SELECT *, coalesce(delivery_actual_ts <= delivery_plan_ts + INTERVAL 60 MINUTE, false) AS on_time
      FROM fact_shipment) f
JOIN dim_customer c USING (customer_id) JOIN dim_carrier cr USING (carrier_id) JOIN lane_label USING (lane_id)"""


_DETAIL_BOUNDED = f"{_DETAIL} WHERE CAST(f.delivery_actual_ts AS DATE) {_SPAN}"


@register(_DETAIL)
def shipment_detail(b: Bound) -> DataFrame:
    return kpis.shipment_detail(b.ship, b.star)


@register(f"{_DETAIL} ORDER BY shipment_id, leg_id LIMIT 1000")
def shipment_detail_top(b: Bound) -> DataFrame:
    return kpis.shipment_detail(b.ship, b.star, limit=1000)


@register(_DETAIL_BOUNDED)
def shipment_detail_bounded(b: Bound) -> DataFrame:
    return kpis.shipment_detail(b.ship, b.star, window=filters.bounds(b.ship))


@register(f"{_DETAIL_BOUNDED} ORDER BY shipment_id, leg_id LIMIT 1000")
def shipment_detail_bounded_top(b: Bound) -> DataFrame:
    return kpis.shipment_detail(b.ship, b.star, window=filters.bounds(b.ship), limit=1000)


def _options_sql(limit: str = "") -> str:
    return f"""(SELECT 'customer' AS k, name AS v FROM dim_customer {limit})
UNION ALL (SELECT 'carrier', name FROM dim_carrier {limit})
UNION ALL SELECT DISTINCT 'equipment', type FROM dim_equipment
UNION ALL (SELECT DISTINCT 'lane', lane_label FROM lane_label {limit})"""


@register(_options_sql())
def filter_options(b: Bound) -> DataFrame:
    return kpis.filter_options(b.star)


@register(_options_sql("ORDER BY 2 LIMIT 50"))
def filter_options_top(b: Bound) -> DataFrame:
    return kpis.filter_options(b.star, limit=50)


# --- events and costs ---------------------------------------------------------------------------------------------


@register("""SELECT shipment_id,
  CAST(coalesce(sum(date_diff('second', event_ts, next_ts) // 60) FILTER (WHERE paired), 0) AS BIGINT) AS dwell_minutes,
  count(*) FILTER (WHERE paired) AS dwell_pairs, count(*) - 2 * count(*) FILTER (WHERE paired) AS unpaired
FROM (SELECT shipment_id, event_ts, lead(event_ts) OVER w AS next_ts,
        event_type = 'DwellStart' AND coalesce(lead(event_type) OVER w = 'DwellEnd', false) AS paired
      FROM fact_event WHERE event_type IN ('DwellStart', 'DwellEnd')
      WINDOW w AS (PARTITION BY shipment_id ORDER BY event_seq, event_ts, event_type DESC))
GROUP BY shipment_id""")
def dwell_minutes(b: Bound) -> DataFrame:
    return kpis.dwell_minutes(b.events)


@register("""SELECT shipment_id, CAST(coalesce(base_cost, 0) AS DOUBLE) AS base_cost,
  CAST(coalesce(fuel_cost, 0) AS DOUBLE) AS fuel_cost, CAST(coalesce(accessorial_cost, 0) AS DOUBLE) AS accessorial_cost,
  CAST(coalesce(cost_total, 0) AS DOUBLE) AS cost_total, CAST(coalesce(shipment_total, 0) AS DOUBLE) AS shipment_total,
  CAST(coalesce(cost_total, 0) - coalesce(shipment_total, 0) AS DOUBLE) AS difference
FROM (SELECT shipment_id, sum(cost_amount) FILTER (WHERE cost_type = 'Base') AS base_cost,
        sum(cost_amount) FILTER (WHERE cost_type = 'Fuel') AS fuel_cost,
        sum(cost_amount) FILTER (WHERE starts_with(cost_type, 'Accessorial')) AS accessorial_cost,
        sum(cost_amount) AS cost_total FROM fact_cost GROUP BY 1)
FULL JOIN (SELECT shipment_id, sum(total_cost) AS shipment_total FROM fact_shipment GROUP BY 1) USING (shipment_id)""")
def cost_rollup(b: Bound) -> DataFrame:
    return kpis.cost_rollup(b.cost, b.ship)


@register("""SELECT shipment_id, min(event_ts) FILTER (WHERE event_type = 'Tendered') AS tendered_ts,
  min(event_ts) FILTER (WHERE event_type = 'Accepted') AS accepted_ts,
  min(event_ts) FILTER (WHERE event_type = 'PickedUp') AS pickedup_ts,
  max(event_ts) FILTER (WHERE event_type = 'Delivered') AS delivered_ts
FROM fact_event WHERE event_type IN ('Tendered', 'Accepted', 'PickedUp', 'Delivered') GROUP BY 1""")
def event_lifecycle(b: Bound) -> DataFrame:
    return kpis.event_lifecycle(b.events)


# --- filters ------------------------------------------------------------------------------------------------------

_LANES = tuple(f"NATION_{o} → NATION_{(7 * o + d) % 25}" for o in range(25) for d in range(4))


@register(f"""SELECT shipment_id, leg_id, delivery_actual_ts FROM delivered
WHERE d BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
  AND customer_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'))
  AND carrier_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
  AND equipment_id IN (SELECT equipment_id FROM dim_equipment WHERE type IN ('Box', 'Deck'))
  AND lane_id IN (SELECT lane_id FROM lane_label WHERE lane_label IN {_LANES})""")
def apply_filters(b: Bound) -> DataFrame:
    segments = b.star["dim_customer"].filter(F.col("segment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"))
    solvent = b.table("supplier").filter(F.col("s_acctbal") > 0)
    return filters.apply_filters(
        b.ship,
        b.star,
        customers=segments.select("name"),
        carriers=solvent.select("s_name"),
        equipment=["Box", "Deck"],
        lanes=_LANES,
        date_start=date(1996, 1, 1),
        date_end=date(2000, 12, 31),
    ).select("shipment_id", "leg_id", "delivery_actual_ts")


@register("""SELECT event_type, count(*) AS n FROM fact_event WHERE event_type IN ('AtDest', 'DwellStart', 'O''Hare')
GROUP BY event_type""")
def in_list(b: Bound) -> DataFrame:
    wanted = filters.in_list(F.col("event_type"), ["AtDest", "DwellStart", "O'Hare"])
    return b.events.filter(wanted).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("""SELECT status, count(delivery_actual_ts) AS delivered, count(*) - count(delivery_actual_ts) AS in_flight
FROM fact_shipment GROUP BY status""")
def delivered_in_flight(b: Bound) -> DataFrame:
    done = filters.delivered(b.ship).select("status", F.lit(1).alias("x"), F.lit(0).alias("y"))
    going = filters.in_flight(b.ship).select("status", F.lit(0).alias("x"), F.lit(1).alias("y"))
    return done.unionByName(going).groupBy("status").agg(
        F.sum("x").alias("delivered"), F.sum("y").alias("in_flight")
    )


@register("SELECT start_d, end_d FROM bounds")
def bounds(b: Bound) -> DataFrame:
    return filters.bounds(b.ship)


@register("""SELECT shipment_id, leg_id, delivery_actual_ts FROM delivered, bounds WHERE d BETWEEN start_d AND end_d""")
def within_bounds(b: Bound) -> DataFrame:
    return filters.within_bounds(b.ship, "delivery_actual_ts", filters.bounds(b.ship)).select(
        "shipment_id", "leg_id", "delivery_actual_ts"
    )


@register(f"""SELECT status, count(*) AS legs, status IN {STATUS_ACCEPTED} AS accepted,
  status IN {STATUS_TENDERED} AS tendered FROM fact_shipment GROUP BY status""")
def status_sets(b: Bound) -> DataFrame:
    return (
        b.ship.groupBy("status")
        .agg(F.count(F.lit(1)).alias("legs"))
        .withColumns(
            {"accepted": filters.is_accepted(F.col("status")), "tendered": filters.is_tendered(F.col("status"))}
        )
    )
