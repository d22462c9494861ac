"""Registered queries of star joins, dimension builders and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.operators import dims, filters, joins, kpis, quality
from freightlens.plans import binding
from freightlens.plans.columns import HOLIDAYS, HUB_SQL, WEIGHT_SQL, arc_sql
from freightlens.plans.registry import Bound, register
from freightlens.schemas import KEYS, SHIPMENT_FKS, STATUS_TENDERED, TABLES

# --- joins --------------------------------------------------------------------------------------------------------


@register("""SELECT lane_id, o.city AS origin_city, d.city AS dest_city, lane_label FROM dim_lane
JOIN dim_location o ON origin_loc_id = o.loc_id JOIN dim_location d ON dest_loc_id = d.loc_id
JOIN lane_label USING (lane_id)""")
def join_lane_locations(b: Bound) -> DataFrame:
    return joins.join_lane_locations(b.star["dim_lane"], b.star["dim_location"]).select(
        "lane_id", "origin_city", "dest_city", "lane_label"
    )


@register("""SELECT shipment_id, leg_id, c.name AS customer_name, cr.name AS carrier_name, lane_label
FROM fact_shipment JOIN dim_customer c USING (customer_id) JOIN dim_carrier cr USING (carrier_id)
JOIN lane_label USING (lane_id)""")
def enrich_shipments(b: Bound) -> DataFrame:
    s = b.star
    rows = joins.enrich_shipments(b.ship, s["dim_customer"], s["dim_carrier"], s["dim_lane"], s["dim_location"])
    return rows.select("shipment_id", "leg_id", "customer_name", "carrier_name", "lane_label")


@register("""SELECT shipment_id, coalesce(nullif(trim(notes), ''), 'Unknown') AS exception_type, customer_id,
  count(*) AS exceptions FROM fact_event JOIN fact_shipment USING (shipment_id)
WHERE event_type = 'Exception' GROUP BY ALL""")
def join_events_to_shipments(b: Bound) -> DataFrame:
    return joins.join_events_to_shipments(joins.exception_events(b.events), b.ship, "customer_id")


def damaged(b: Bound) -> DataFrame:
    """Legs with missing and dangling keys and unknown statuses."""
    return b.legs.selectExpr(
        "shipment_id", "leg_id",
        "IF(_h % 97 = 0, NULL, IF(_h % 89 = 0, customer_id + 1000000000000, customer_id)) AS customer_id",
        "IF(_h % 61 = 0, -1, carrier_id) AS carrier_id",
        "equipment_id",
        "IF(_h % 41 = 0, NULL, origin_loc_id) AS origin_loc_id",
        "IF(_h % 43 = 0, 99, dest_loc_id) AS dest_loc_id",
        "IF(_h % 47 = 0, NULL, IF(_h % 53 = 0, -5, lane_id)) AS lane_id",
        "IF(_h % 83 = 0, 'Lost', IF(_h % 71 = 0, NULL, status)) AS status",
    )


DAMAGED_SQL = """damaged AS (
  SELECT shipment_id, leg_id, CASE WHEN h % 97 = 0 THEN NULL WHEN h % 89 = 0 THEN customer_id + 1000000000000
           ELSE customer_id END AS customer_id,
         CASE WHEN h % 61 = 0 THEN -1 ELSE carrier_id END AS carrier_id, equipment_id,
         CASE WHEN h % 41 > 0 THEN origin_loc_id END AS origin_loc_id,
         CASE WHEN h % 43 = 0 THEN 99 ELSE dest_loc_id END AS dest_loc_id,
         CASE WHEN h % 47 = 0 THEN NULL WHEN h % 53 = 0 THEN -5 ELSE lane_id END AS lane_id,
         CASE WHEN h % 83 = 0 THEN 'Lost' WHEN h % 71 > 0 THEN status END AS status
  FROM legs
)"""


@register("""SELECT shipment_id, leg_id, customer_id FROM damaged f
WHERE NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id)""", extra=DAMAGED_SQL)
def orphans(b: Bound) -> DataFrame:
    rows = damaged(b).select("shipment_id", "leg_id", "customer_id")
    return joins.orphans(rows, b.star["dim_customer"], "customer_id")


@register("""SELECT shipment_id, leg_id, customer_id FROM damaged f WHERE customer_id IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id)""", extra=DAMAGED_SQL)
def orphans_null_tolerant(b: Bound) -> DataFrame:
    rows = damaged(b).select("shipment_id", "leg_id", "customer_id")
    return joins.orphans(rows, b.star["dim_customer"], "customer_id", null_is_orphan=False)


@register("""SELECT shipment_id, leg_id, start_d, end_d FROM fact_shipment, bounds""")
def with_scalars(b: Bound) -> DataFrame:
    rows = b.ship.select("shipment_id", "leg_id")
    return joins.with_scalars(rows, filters.bounds(b.ship), "start_d", "end_d")


@register("""SELECT shipment_id, leg_id FROM fact_shipment
WHERE equipment_id IN (SELECT equipment_id FROM dim_equipment WHERE type IN ('Tank'))""")
def semi_by_key(b: Bound) -> DataFrame:
    reefers = filters.keep_named(b.star["dim_equipment"], "type", ["Tank"])
    return filters.semi_by_key(b.ship, "equipment_id", reefers, "equipment_id").select("shipment_id", "leg_id")


@register("""SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS matched FROM customer""", bound=False)
def null_equal(b: Bound) -> DataFrame:
    left = b.table("customer").selectExpr("c_custkey", "nullif(c_mktsegment, 'BUILDING') AS a")
    right = b.table("customer").selectExpr("nullif(c_mktsegment, 'BUILDING') AS s").distinct()
    right = right.select(F.coalesce("s", F.lit("")).alias("matched"))
    return left.join(right, joins.null_equal(F.col("a"), F.col("matched"))).select("c_custkey", "matched")


_PAIRS_SQL = f"""{HUB_SQL}, pair AS (
  SELECT o.loc_id AS o_loc_id, d.loc_id AS d_loc_id, {arc_sql('o.lat', 'o.lon', 'd.lat', 'd.lon')} AS miles
  FROM (SELECT DISTINCT 2*CAST(c_nationkey AS BIGINT) + 1 AS o_id, 2*(c_custkey % 25) + 2 AS d_id FROM customer)
  JOIN hub o ON o.loc_id = o_id JOIN hub d ON d.loc_id = d_id WHERE o.city <> d.city
), pair_days AS (
  SELECT *, CASE WHEN miles < 300 THEN 1 WHEN miles < 600 THEN 2 WHEN miles < 1000 THEN 3 ELSE 4 END AS days FROM pair
)"""


@register("SELECT o_loc_id, d_loc_id, round(miles, 4) AS miles, days AS std_transit_days FROM pair_days", extra=_PAIRS_SQL)
def lane_pairs(b: Bound) -> DataFrame:
    return joins.lane_pairs(binding.hub_routes(b.table("customer")), binding.hubs(b.table("nation"))).select(
        "o_loc_id", "d_loc_id", F.round("miles", 4).alias("miles"), "std_transit_days"
    )


_PLACES = """{name} AS (SELECT {key} AS loc_id, '{kind}' AS type, CAST({key} % 40 AS VARCHAR) AS city,
  ({key} * 37 % 1799) / 10.0 - 89.9 AS lat, ({key} * 211 % 3599) / 10.0 - 179.9 AS lon FROM {table})"""
_PLACE_CTES = ", ".join(
    _PLACES.format(name=n, key=k, kind=t, table=s)
    for n, k, t, s in (("origin", "s_suppkey", "Origin", "supplier"), ("dest", "c_custkey", "Dest", "customer"))
)


@register(
    f"""SELECT o.loc_id AS o_loc_id, d.loc_id AS d_loc_id, round({arc_sql('o.lat', 'o.lon', 'd.lat', 'd.lon')}, 4) AS miles,
  CASE WHEN {arc_sql('o.lat', 'o.lon', 'd.lat', 'd.lon')} < 300 THEN 1 ELSE 2 END AS std_transit_days
FROM origin o JOIN dest d ON o.city <> d.city AND {arc_sql('o.lat', 'o.lon', 'd.lat', 'd.lon')} <= 333.3""",
    extra=_PLACE_CTES,
)
def lanes_within(b: Bound) -> DataFrame:
    """Lanes from the places of suppliers to those of customers at most 333.3 miles away, all over the globe."""

    def places(table: str, key: str, kind: str) -> DataFrame:
        return b.table(table).selectExpr(
            f"CAST({key} AS BIGINT) AS loc_id", f"'{kind}' AS type", f"CAST({key} % 40 AS STRING) AS city",
            f"({key} * 37 % 1799) / 10.0D - 89.9D AS lat", f"({key} * 211 % 3599) / 10.0D - 179.9D AS lon",
        )

    loc = places("supplier", "s_suppkey", "Origin").unionByName(places("customer", "c_custkey", "Dest"))
    return joins.lanes_within(loc, 333.3).select("o_loc_id", "d_loc_id", F.round("miles", 4).alias("miles"), "std_transit_days")


@register("""SELECT shipment_id, leg_id, CAST(p.price AS DOUBLE) AS price FROM fact_shipment f
ASOF LEFT JOIN weekly_price p ON CAST(f.pickup_plan_ts AS DATE) >= p.week""")
def asof_weekly_price(b: Bound) -> DataFrame:
    prices = binding.weekly_prices(b.table("orders"))
    return joins.asof_weekly_price(b.ship, prices).select("shipment_id", "leg_id", "price")


def _calendar_sql(role: str, column: str) -> str:
    return f"""SELECT year AS {role}_year, quarter AS {role}_quarter, is_weekend AS {role}_is_weekend, count(*) AS legs
FROM fact_shipment LEFT JOIN dim_date ON CAST({column} AS DATE) = date GROUP BY ALL"""


def _calendar(b: Bound, role: str) -> DataFrame:
    rows = joins.join_calendar(b.ship, b.star["dim_date"], role)
    keys = [f"{role}_{c}" for c in ("year", "quarter", "is_weekend")]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("legs"))


@register(_calendar_sql("delivery", "delivery_actual_ts"))
def join_calendar_delivery(b: Bound) -> DataFrame:
    return _calendar(b, "delivery")


@register(_calendar_sql("pickup", "pickup_actual_ts"))
def join_calendar_pickup(b: Bound) -> DataFrame:
    return _calendar(b, "pickup")


@register(_calendar_sql("tender", "tender_ts"))
def join_calendar_tender(b: Bound) -> DataFrame:
    return _calendar(b, "tender")


# --- dimension builders -------------------------------------------------------------------------------------------

_DATE_COLUMNS = ("date_key", "date", "year", "quarter", "month", "week", "dow", "is_weekend")


@register(f"SELECT {', '.join(_DATE_COLUMNS)} FROM dim_date")
def date_dim(b: Bound) -> DataFrame:
    span = b.ship.agg(
        F.to_date(F.min("delivery_actual_ts")).alias("start"), F.to_date(F.max("delivery_actual_ts")).alias("end")
    )
    return dims.date_dim(span)


@register(
    "SELECT date, year FROM (SELECT date, year, unnest(range(CAST(greatest(1, round_even(weight*10, 0)) AS INTEGER))) "
    f"FROM ({WEIGHT_SQL}))"
)
def weighted_dates(b: Bound) -> DataFrame:
    return dims.weighted_dates(b.star["dim_date"], HOLIDAYS, 0.12).select("date", "year")


@register("""SELECT row_number() OVER (ORDER BY o_loc_id, d_loc_id) AS lane_id, o_loc_id AS origin_loc_id,
  d_loc_id AS dest_loc_id, round(miles, 2) AS standard_miles, days AS std_transit_days FROM pair_days""", extra=_PAIRS_SQL)
def lane_dim(b: Bound) -> DataFrame:
    return dims.lane_dim(binding.hub_routes(b.table("customer")), binding.hubs(b.table("nation")))


@register(
    """WITH seeds AS (SELECT seed, row_number() OVER (ORDER BY seed) AS pos FROM (SELECT DISTINCT p_name AS seed FROM part)),
  size AS (SELECT count(*) AS k, max(length(seed)) AS longest FROM seeds),
  wanted AS (SELECT unnest(range(1, (SELECT count(*) FROM part) + 8)) AS ordinal)
SELECT ordinal, CASE WHEN ordinal <= k THEN seed
  WHEN seed || ' ' || ordinal IN (SELECT seed FROM seeds) THEN seed || ' ' || lpad(CAST(ordinal AS VARCHAR),
    CAST(longest + 1 AS INTEGER), '0')
  ELSE seed || ' ' || ordinal END AS name
FROM wanted, size JOIN seeds ON pos = (ordinal - 1) % k + 1""",
    bound=False,
)
def surrogate_names(b: Bound) -> DataFrame:
    names = b.table("part").select("p_name")
    return dims.surrogate_names(names, names.count() + 7)


# --- quality ------------------------------------------------------------------------------------------------------


@register(" UNION ALL ".join(f"SELECT '{t.upper()}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def row_counts(b: Bound) -> DataFrame:
    return quality.row_counts(b.star)


_DOUBLED = ("dim_customer", "dim_carrier", "dim_location", "dim_lane")


def _duplicates_sql(table: str) -> str:
    keys = ", ".join(KEYS[table])
    if table in _DOUBLED:
        source = f"(SELECT {keys} FROM {table} UNION ALL SELECT {keys} FROM {table})"
    elif table == "fact_shipment":
        source = "(SELECT l_orderkey AS shipment_id, l_linenumber AS leg_id FROM lineitem)"
    else:
        source = table
    return f"""SELECT '{table.upper()}' AS table_name, count(*) AS dup_pk
FROM (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"""


@register(" UNION ALL ".join(_duplicates_sql(t) for t in TABLES))
def pk_duplicates(b: Bound) -> DataFrame:
    """Duplicates in repeated dimension rows and in the unreduced line versions."""
    tables = dict(b.star)
    for t in _DOUBLED:
        tables[t] = tables[t].unionByName(tables[t])
    versions = binding.legs(b.table("lineitem"), b.table("orders"), b.table("customer"))
    tables["fact_shipment"] = binding.shipments_of(versions)
    # A row per line version at most, with up to nine events and three costs; the count comes from the files' footers.
    lines = b.table("lineitem").count()
    rows = {"fact_shipment": lines, "fact_event": 9 * lines, "fact_cost": 3 * lines}
    return quality.pk_duplicates(tables, rows)


def _missing_sql(column: str, table: str, key: str, null_counts: bool) -> str:
    tolerant = "" if null_counts else f" AND f.{column} IS NOT NULL"
    return f"FROM damaged f LEFT JOIN {table} d ON f.{column} = d.{key} WHERE d.{key} IS NULL{tolerant}"


@register(
    " UNION ALL ".join(
        f"SELECT '{c.upper()}' AS fk, count(*) AS missing {_missing_sql(c, t, k, False)}" for c, t, k in SHIPMENT_FKS
    ),
    extra=DAMAGED_SQL,
)
def fk_coverage(b: Bound) -> DataFrame:
    return quality.fk_coverage(damaged(b), b.star)


@register(
    " UNION ALL ".join(
        f"SELECT '{c}' AS fk, count(*) AS invalid {_missing_sql(c, t, k, True)}"
        for c, t, k in SHIPMENT_FKS
        if c in ("origin_loc_id", "dest_loc_id", "lane_id")
    ),
    extra=DAMAGED_SQL,
)
def invalid_fks(b: Bound) -> DataFrame:
    return quality.invalid_fks(damaged(b), b.star)


_KEPT = "status NOT IN ('Cancelled', 'In-Transit')"
_KEPT_SQL = f"kept AS (SELECT * FROM fact_shipment WHERE {_KEPT})"


@register("""SELECT 'EVENT -> SHIPMENT' AS rel, count(*) AS missing FROM fact_event
WHERE shipment_id NOT IN (SELECT shipment_id FROM kept)
UNION ALL SELECT 'COST -> SHIPMENT', count(*) FROM fact_cost WHERE shipment_id NOT IN (SELECT shipment_id FROM kept)""",
          extra=_KEPT_SQL)
def child_coverage(b: Bound) -> DataFrame:
    return quality.child_coverage(b.events, b.cost, b.ship.filter(_KEPT))


@register("""SELECT shipment_id, count(*) AS event_rows FROM fact_event
WHERE shipment_id NOT IN (SELECT shipment_id FROM kept) GROUP BY 1""", extra=_KEPT_SQL)
def orphan_events(b: Bound) -> DataFrame:
    return quality.orphan_events(b.events, b.ship.filter(_KEPT))


@register("""SELECT count(delivery_actual_ts) AS delivered_cnt, count(*) - count(delivery_actual_ts) AS in_flight_cnt
FROM fact_shipment""")
def delivery_completeness(b: Bound) -> DataFrame:
    return quality.delivery_completeness(b.ship)


_RANGES = {"otd_rate": (0.0, 1.0), "delivered_legs": (5000.0, 10000.0)}


@register("""SELECT metric, value, low, high, value BETWEEN low AND high AS in_range
FROM (SELECT 'otd_rate' AS metric, CAST(count(*) FILTER (WHERE on_time) AS DOUBLE) / count(*) AS value,
        0.0::DOUBLE AS low, 1.0::DOUBLE AS high FROM delivered
      UNION ALL SELECT 'delivered_legs', CAST(count(*) AS DOUBLE), 5000.0, 10000.0 FROM delivered)""")
def range_checks(b: Bound) -> DataFrame:
    return quality.range_checks(kpis.otd_rate_rowgrain(b.ship), _RANGES)


@register(f"""SELECT 'FACT_SHIPMENT' AS table_name, 'status' AS column_name, count(*) FILTER (WHERE status NOT IN
  {STATUS_TENDERED}) AS out_of_domain FROM damaged
UNION ALL SELECT 'FACT_EVENT', 'event_type', 0 FROM (SELECT count(*) FROM fact_event)
UNION ALL SELECT 'FACT_COST', 'cost_type', count(*) FILTER (WHERE cost_type = 'Fuel') FROM fact_cost
UNION ALL SELECT 'FACT_COST', 'calc_method', 0 FROM (SELECT count(*) FROM fact_cost)""", extra=DAMAGED_SQL)
def domain_checks(b: Bound) -> DataFrame:
    wrong = b.cost.withColumn("cost_type", F.expr("IF(cost_type = 'Fuel', 'Petrol', cost_type)"))
    return quality.domain_checks({"fact_shipment": damaged(b), "fact_event": b.events, "fact_cost": wrong})
