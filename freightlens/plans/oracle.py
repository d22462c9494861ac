"""The binding of ``binding.py`` stated in SQL, for comparing results with another engine.

Every oracle query is ``WITH <BINDING> <query>``; ``fact_shipment`` and the other star tables are named as they are
in Spark.
"""

from __future__ import annotations

from freightlens.schemas import COST_TYPES

_LEG_RULES = """
{name}_src AS (
  SELECT l.*, o_custkey, o_orderdate, o_orderstatus, o_orderpriority,
         (l_partkey + 3*l_orderkey + l_linenumber) % 1000 AS h, CAST(l_quantity AS INTEGER) AS qty,
         CAST(c_nationkey AS BIGINT) AS origin_loc_id, o_custkey % 25 AS dest_loc_id,
         l_linestatus <> 'O' OR l_returnflag <> 'N' AS closed
  FROM (SELECT * FROM {lines}
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
          l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_returnflag DESC, l_linestatus DESC,
          l_discount DESC, l_tax DESC) = 1) l
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
), {name}_plan AS (
  SELECT *, CASE WHEN qty <= 3 THEN 'Cancelled' WHEN closed AND qty >= 47 THEN 'Exception' WHEN closed THEN 'Delivered'
                 WHEN o_orderstatus = 'O' THEN 'Tendered' WHEN o_orderstatus = 'P' THEN 'Accepted' ELSE 'In-Transit' END
           AS status,
         o_orderdate + l_linenumber * INTERVAL 1 HOUR AS tender_ts,
         o_orderdate + (24 + qty) * INTERVAL 1 HOUR AS pickup_plan_ts,
         o_orderdate + (24 + qty + 24*(2 + l_linenumber % 3)) * INTERVAL 1 HOUR AS delivery_plan_ts,
         CAST(90 + 40*abs(origin_loc_id - dest_loc_id) AS DECIMAL(10,2)) AS planned_miles,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS revenue,
         CASE WHEN l_linenumber <> 7 THEN l_returnflag <> 'R' END AS isinfull
  FROM {name}_src
), {name}_done AS (
  SELECT *, CASE WHEN status IN ('In-Transit','Delivered','Exception')
              THEN pickup_plan_ts + CAST(20*round(l_discount*100) AS INTEGER) * INTERVAL 1 MINUTE END AS pickup_actual_ts,
         CASE WHEN status IN ('Delivered','Exception')
              THEN delivery_plan_ts + CAST(30*(round(l_tax*100) - 4) AS INTEGER) * INTERVAL 1 MINUTE END
           AS delivery_actual_ts
  FROM {name}_plan
), {name} AS MATERIALIZED (
  SELECT 'S' || lpad(CAST(l_orderkey AS VARCHAR), CAST(greatest(9, length(CAST(l_orderkey AS VARCHAR))) AS INTEGER),
           '0') AS shipment_id,
         l_linenumber AS leg_id, o_custkey AS customer_id, l_suppkey AS carrier_id, 1 + l_suppkey % 3 AS equipment_id,
         origin_loc_id, dest_loc_id, origin_loc_id*25 + dest_loc_id AS lane_id, tender_ts, pickup_plan_ts,
         pickup_actual_ts, delivery_plan_ts, delivery_actual_ts, planned_miles,
         CAST(CASE WHEN qty <= 3 THEN 0 ELSE planned_miles + l_linenumber END AS DECIMAL(10,2)) AS actual_miles,
         qty AS pieces, CAST(12*qty AS DECIMAL(10,2)) AS weight_lbs, CAST(2*qty AS DECIMAL(10,2)) AS cube, revenue,
         CAST(revenue * CAST(1 - l_discount - l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS total_cost,
         CAST(revenue * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS fuel_surcharge,
         CAST(CASE WHEN status = 'Exception' THEN 3*qty ELSE 0 END AS DECIMAL(12,2)) AS accessorial_cost,
         status, coalesce(delivery_actual_ts <= delivery_plan_ts, false) AS isdeliveredontime, isinfull,
         coalesce(delivery_actual_ts <= delivery_plan_ts AND isinfull, false) AS isotif, qty <= 3 AS cancel_flag,
         o_orderdate AS load_date, l_shipdate AS update_date, h, qty,
         CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN '  ' ELSE substr(o_orderpriority, 3) END
           AS reason,
         CASE l_suppkey % 3 WHEN 0 THEN 'TL' WHEN 1 THEN 'LTL' ELSE 'Intermodal' END AS mode
  FROM {name}_done
)"""


def legs_sql(name: str, lines: str) -> str:
    """The shipment rules over a line-item relation, as the CTE ``name`` (with columns h, qty, reason, mode)."""
    return _LEG_RULES.format(name=name, lines=lines)


_STAMP = "TIMESTAMP '2024-01-01' AS load_date, TIMESTAMP '2024-01-01' AS update_date"

BINDING = (
    legs_sql("legs", "lineitem").lstrip()
    + f""",
fact_shipment AS (SELECT * EXCLUDE (h, qty, reason, mode) FROM legs),
fact_event AS (
  SELECT shipment_id, CAST(leg_id*10 + e.k AS INTEGER) AS event_seq, e.kind AS event_type, e.at AS event_ts,
         e.place AS facility_loc_id, e.note AS notes, load_date, e.at AS update_date
  FROM (
    SELECT shipment_id, leg_id, load_date, unnest([
      {{'k': 1, 'kind': 'Tendered', 'at': tender_ts, 'place': origin_loc_id, 'note': NULL}},
      {{'k': 2, 'kind': 'Accepted', 'at': CASE WHEN status NOT IN ('Cancelled', 'Tendered')
        THEN pickup_plan_ts - INTERVAL 12 HOUR END, 'place': origin_loc_id, 'note': NULL}},
      {{'k': 3, 'kind': 'AtOrigin', 'at': CASE WHEN pickup_actual_ts IS NOT NULL THEN pickup_plan_ts END,
        'place': origin_loc_id, 'note': NULL}},
      {{'k': 4, 'kind': 'PickedUp', 'at': pickup_actual_ts, 'place': origin_loc_id, 'note': NULL}},
      {{'k': 5, 'kind': 'DwellStart', 'at': CASE WHEN qty % 4 = 0 THEN delivery_actual_ts - INTERVAL 3 HOUR END,
        'place': dest_loc_id, 'note': 'Dock'}},
      {{'k': 6, 'kind': 'DwellEnd', 'at': CASE WHEN qty % 4 = 0 AND leg_id <> 2
        THEN delivery_actual_ts + (qty - 180) * INTERVAL 1 MINUTE END, 'place': dest_loc_id, 'note': NULL}},
      {{'k': 7, 'kind': 'AtDest', 'at': delivery_actual_ts - INTERVAL 1 HOUR, 'place': dest_loc_id, 'note': NULL}},
      {{'k': 8, 'kind': 'Delivered', 'at': delivery_actual_ts, 'place': dest_loc_id, 'note': NULL}},
      {{'k': 9, 'kind': 'Exception', 'at': CASE WHEN status IN ('Cancelled', 'Exception') THEN pickup_plan_ts END,
        'place': CASE WHEN cancel_flag THEN origin_loc_id ELSE dest_loc_id END, 'note': reason}}]) AS e
    FROM legs)
  WHERE e.at IS NOT NULL
),
fact_cost AS (
  SELECT shipment_id, c.kind AS cost_type, c.method AS calc_method, c.ref || ' L' || leg_id AS rate_ref,
         c.amount AS cost_amount, 'USD' AS currency, load_date, update_date
  FROM (
    SELECT shipment_id, leg_id, load_date, update_date, unnest([
      {{'kind': '{COST_TYPES[0]}', 'method': 'per-mile', 'ref': 'PM', 'amount': CASE WHEN NOT cancel_flag THEN total_cost END}},
      {{'kind': '{COST_TYPES[1]}', 'method': 'index', 'ref': 'IX', 'amount': CASE WHEN NOT cancel_flag THEN fuel_surcharge END}},
      {{'kind': '{COST_TYPES[2]}', 'method': 'flat', 'ref': 'EX', 'amount': CASE WHEN accessorial_cost > 0 THEN accessorial_cost END}},
      {{'kind': '{COST_TYPES[4]}', 'method': 'flat', 'ref': 'FEE',
        'amount': CASE WHEN cancel_flag THEN CAST(10*qty AS DECIMAL(12,2)) END}}]) AS c
    FROM legs)
  WHERE c.amount IS NOT NULL
),
dim_customer AS (
  SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment, r_name AS region, {_STAMP}
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
dim_carrier AS (
  SELECT s_suppkey AS carrier_id, s_name AS name,
         CASE s_suppkey % 3 WHEN 0 THEN 'TL' WHEN 1 THEN 'LTL' ELSE 'Intermodal' END AS mode,
         'No. ' || s_suppkey AS mc_number,
         ['A', 'B', 'C', 'D'][1 + s_suppkey % 4] AS score_tier, {_STAMP}
  FROM supplier
),
dim_equipment AS (
  SELECT DISTINCT s_suppkey % 3 + 1 AS equipment_id,
         ['Box', 'Tank', 'Deck'][1 + s_suppkey % 3] AS type,
         CAST(10000*(1 + s_suppkey % 3) AS INTEGER) AS capacity_lbs, {_STAMP}
  FROM supplier
),
dim_location AS (
  SELECT CAST(n_nationkey AS BIGINT) AS loc_id, n_name || ' DC' AS name, n_name AS city,
         CAST(NULL AS VARCHAR) AS state, r_name AS country, 'UTC' AS timezone, 'DC' AS type, {_STAMP}
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
dim_lane AS (
  SELECT o*25 + d AS lane_id, o AS origin_loc_id, d AS dest_loc_id, miles AS standard_miles,
         CASE WHEN miles < 300 THEN 1 WHEN miles < 600 THEN 2 WHEN miles < 1000 THEN 3 ELSE 4 END AS std_transit_days,
         {_STAMP}
  FROM (SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS o, c_custkey % 25 AS d,
               CAST(90 + 40*abs(c_nationkey - c_custkey % 25) AS DECIMAL(10,2)) AS miles FROM customer)
),
dim_date AS (
  SELECT CAST(year(d)*10000 + month(d)*100 + day(d) AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
         CAST(strftime(d, '%U') AS INTEGER) AS week, CAST(isodow(d) - 1 AS INTEGER) AS dow,
         isodow(d) >= 6 AS is_weekend, {_STAMP}
  FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d
        FROM (SELECT CAST(min(delivery_actual_ts) AS DATE) AS lo, CAST(max(delivery_actual_ts) AS DATE) AS hi
              FROM fact_shipment))
),
lane_label AS (
  SELECT lane_id, o.city || ' → ' || d.city AS lane_label FROM dim_lane
  JOIN dim_location o ON origin_loc_id = o.loc_id JOIN dim_location d ON dest_loc_id = d.loc_id
),
delivered AS (
  SELECT *, CAST(delivery_actual_ts AS DATE) AS d,
         coalesce(delivery_actual_ts <= delivery_plan_ts + INTERVAL 60 MINUTE, false) AS on_time,
         date_diff('day', CAST(pickup_actual_ts AS DATE), CAST(delivery_actual_ts AS DATE)) AS transit
  FROM fact_shipment WHERE delivery_actual_ts IS NOT NULL
),
bounds AS (SELECT max(d) - 180 AS start_d, max(d) AS end_d FROM delivered),
weekly_price AS (
  SELECT CAST(week AS DATE) AS week,
         CAST(CAST(n % 20 AS DECIMAL(4,0)) * CAST(0.05 AS DECIMAL(3,2)) + 3 AS DECIMAL(6,3)) AS price
  FROM (SELECT date_trunc('week', o_orderdate) AS week, count(*) AS n FROM orders GROUP BY 1)
  QUALIFY n >= avg(n) OVER ()
)"""
)


def with_binding(query: str, extra: str = "") -> str:
    """A full statement: the binding, optional further CTEs, and the query."""
    more = f",\n{extra.strip()}" if extra else ""
    return f"WITH {BINDING}{more}\n{query.strip()}"
