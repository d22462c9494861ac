"""Registered queries of the column rules: cleaning, typing, shipment measures and rating."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions import clean, measures, rating
from freightlens.operators import shaping
from freightlens.plans import binding
from freightlens.plans.registry import Bound, register
from freightlens.schemas import TABLE_DDL, TABLES, typed_schema
from freightlens.sources.landing import iso_utc

_FLAG_WORDS = ("1", "t", "TRUE", " Y ", "yes", "0", "F", "no", "x", "")


def raw_text(b: Bound) -> DataFrame:
    """Legs with untidy text forms of some columns: padded, blank, missing, unreadable, with and without offsets."""
    iso = "date_format(delivery_plan_ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
    day = "date_format(delivery_plan_ts, 'yyyy-MM-dd')"
    words = ", ".join(f"'{w}'" for w in _FLAG_WORDS)
    return b.legs.selectExpr(
        "shipment_id",
        "leg_id",
        "CASE _h % 5 WHEN 0 THEN concat('  ', status, ' ') WHEN 1 THEN '' WHEN 2 THEN '   ' WHEN 4 THEN status END "
        "AS raw_status",
        f"CASE _h % 6 WHEN 0 THEN concat({iso}, '+00:00') WHEN 1 THEN concat({iso}, '+02:00') WHEN 2 THEN '' "
        f"WHEN 3 THEN 'junk' WHEN 4 THEN concat('  ', {iso}, ' ') END AS raw_ts",
        f"CASE _h % 4 WHEN 0 THEN {day} WHEN 1 THEN 'bad' WHEN 2 THEN concat(' ', {day}, ' ') ELSE '' END AS raw_date",
        f"element_at(array({words}), CAST(_h % 10 + 1 AS INT)) AS raw_flag",
        "CASE _h % 3 WHEN 0 THEN '' WHEN 1 THEN CAST(revenue AS STRING) ELSE concat(' ', revenue, ' ') END AS raw_num",
    )


def _keyed(b: Bound, **columns: Column) -> DataFrame:
    return raw_text(b).select("shipment_id", "leg_id", *[c.alias(n) for n, c in columns.items()])


@register("SELECT shipment_id, leg_id, CASE WHEN h % 5 IN (0, 4) THEN status END AS status FROM legs")
def clean_str(b: Bound) -> DataFrame:
    return _keyed(b, status=clean.clean_str(F.col("raw_status")))


@register("""SELECT shipment_id, leg_id, CASE h % 6 WHEN 0 THEN delivery_plan_ts WHEN 4 THEN delivery_plan_ts
  WHEN 1 THEN delivery_plan_ts - INTERVAL 2 HOUR END AS ts FROM legs""")
def safe_ts(b: Bound) -> DataFrame:
    return _keyed(b, ts=clean.safe_ts(F.col("raw_ts")))


@register("SELECT shipment_id, leg_id, CASE WHEN h % 2 = 0 THEN CAST(delivery_plan_ts AS DATE) END AS day FROM legs")
def safe_date(b: Bound) -> DataFrame:
    return _keyed(b, day=clean.safe_date(F.col("raw_date")))


@register("SELECT CAST(delivery_actual_ts AS DATE) AS day, count(*) AS legs FROM fact_shipment GROUP BY 1")
def ts_date(b: Bound) -> DataFrame:
    return b.ship.groupBy(clean.ts_date(F.col("delivery_actual_ts")).alias("day")).agg(F.count(F.lit(1)).alias("legs"))


@register("""SELECT shipment_id, leg_id, CASE WHEN h % 10 < 5 THEN true WHEN h % 10 < 8 THEN false END AS dim_flag,
  h % 10 < 5 AS fact_flag FROM legs""")
def to_bool(b: Bound) -> DataFrame:
    flag = F.col("raw_flag")
    return _keyed(b, dim_flag=clean.to_bool(flag), fact_flag=clean.to_bool(flag, default=False))


@register("SELECT shipment_id, leg_id, CASE WHEN h % 3 > 0 THEN CAST(revenue AS DOUBLE) END AS amount FROM legs")
def to_num(b: Bound) -> DataFrame:
    return _keyed(b, amount=clean.to_num(F.col("raw_num"), "decimal(12,2)"))


# --- whole tables from text ---------------------------------------------------------------------------------------


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text, times in the landing form."""
    return iso_utc(df).select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _typed_sql(table: str) -> str:
    def column(name: str, kind: str) -> str:
        if kind.startswith("decimal"):
            return f"CAST({name} AS DOUBLE) AS {name}"
        if kind == "boolean" and table.startswith("fact_"):
            return f"coalesce({name}, false) AS {name}"
        return name

    fields = [column(f.name, f.dataType.simpleString()) for f in typed_schema(table, audit=False)]
    return f"SELECT {', '.join(fields)} FROM {table}"


def _register_typed(table: str) -> None:
    def typed(b: Bound) -> DataFrame:
        return shaping.type_raw_table(all_text(b.star[table]), table)

    typed.__name__ = f"type_raw_{table}"
    typed.__doc__ = f"{table} written as text and typed again."
    register(_typed_sql(table))(typed)


for _table in TABLE_DDL:
    _register_typed(_table)
assert set(TABLE_DDL) == set(TABLES)

_LINES = "l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus"


@register(
    f"""SELECT {_LINES} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_returnflag DESC,
  l_linestatus DESC) = 1""",
    bound=False,
)
def dedupe_latest(b: Bound) -> DataFrame:
    lines = b.table("lineitem").select(*_LINES.split(", "))
    return shaping.dedupe_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("""SELECT shipment_id, leg_id,
  CASE WHEN h % 2 = 0 THEN load_date ELSE TIMESTAMP '2024-06-01' END AS load_date,
  CASE WHEN h % 3 > 0 THEN update_date ELSE TIMESTAMP '2024-06-01' END AS update_date FROM legs""")
def audit_columns(b: Bound) -> DataFrame:
    gaps = b.legs.selectExpr(
        "shipment_id", "leg_id", "IF(_h % 2 = 0, load_date, NULL) AS load_date",
        "IF(_h % 3 > 0, update_date, NULL) AS update_date",
    )
    return shaping.audit_columns(gaps, datetime(2024, 6, 1))


@register("""SELECT shipment_id, leg_id, delivery_actual_ts, on_time AS isdeliveredontime, isinfull,
  coalesce(on_time AND isinfull, false) AS isotif, cancel_flag
FROM (SELECT *, coalesce(delivery_actual_ts <= delivery_plan_ts + INTERVAL 60 MINUTE, false) AS on_time
      FROM fact_shipment)""")
def curate_shipments(b: Bound) -> DataFrame:
    times = [c for c, t in b.ship.dtypes if t == "timestamp_ntz" and c.endswith("_ts")]
    landed = b.ship.withColumns({c: F.col(c).cast("string") for c in times})
    return shaping.curate_shipments(landed).select(
        "shipment_id", "leg_id", "delivery_actual_ts", "isdeliveredontime", "isinfull", "isotif", "cancel_flag"
    )


# --- measures -----------------------------------------------------------------------------------------------------


@register("""SELECT status, """ + ", ".join(
    f"count(*) FILTER (WHERE delivery_actual_ts <= delivery_plan_ts + INTERVAL {g} MINUTE) AS on_time_{g}"
    for g in (0, 60, 120)
) + " FROM fact_shipment GROUP BY status")
def on_time(b: Bound) -> DataFrame:
    actual, plan = F.col("delivery_actual_ts"), F.col("delivery_plan_ts")
    return b.ship.groupBy("status").agg(
        *[F.count_if(measures.on_time(actual, plan, g)).alias(f"on_time_{g}") for g in (0, 60, 120)]
    )


@register("""SELECT isdeliveredontime, isinfull, isdeliveredontime AND isinfull AS report_form,
  coalesce(isdeliveredontime AND isinfull, false) AS curated_form, count(*) AS legs FROM fact_shipment GROUP BY ALL""")
def otif(b: Bound) -> DataFrame:
    on_time_flag, full = F.col("isdeliveredontime"), F.col("isinfull")
    return b.ship.groupBy(
        "isdeliveredontime", "isinfull",
        measures.otif(on_time_flag, full).alias("report_form"),
        measures.otif(on_time_flag, full, null_is_false=True).alias("curated_form"),
    ).agg(F.count(F.lit(1)).alias("legs"))


@register("""SELECT shipment_id, leg_id, CAST(revenue - total_cost AS DOUBLE) /
  CASE WHEN h % 50 > 0 THEN CAST(planned_miles AS DOUBLE) END AS gm_per_mile FROM legs""")
def gm_per_mile_legs(b: Bound) -> DataFrame:
    some_zero = b.legs.withColumn("miles", F.expr("IF(_h % 50 > 0, planned_miles, 0)"))
    return some_zero.select(
        "shipment_id", "leg_id",
        measures.gm_per_mile(F.col("revenue"), F.col("total_cost"), F.col("miles")).alias("gm_per_mile"),
    )


@register("SELECT transit AS days, count(*) AS legs FROM delivered GROUP BY 1")
def transit_days(b: Bound) -> DataFrame:
    days = measures.transit_days(F.col("pickup_actual_ts"), F.col("delivery_actual_ts")).cast("bigint")
    return (
        b.ship.filter("delivery_actual_ts IS NOT NULL").groupBy(days.alias("days")).agg(F.count(F.lit(1)).alias("legs"))
    )


@register("""SELECT lane_id, CASE WHEN o.country <> 'ASIA' THEN o.city END || ' → ' || d.city AS lane_label
FROM dim_lane JOIN dim_location o ON origin_loc_id = o.loc_id JOIN dim_location d ON dest_loc_id = d.loc_id""")
def lane_label(b: Bound) -> DataFrame:
    loc = b.star["dim_location"]
    origin = loc.selectExpr("loc_id AS origin_loc_id", "IF(country <> 'ASIA', city, NULL) AS o_city")
    dest = loc.selectExpr("loc_id AS dest_loc_id", "city AS d_city")
    return (
        b.star["dim_lane"].join(origin, "origin_loc_id").join(dest, "dest_loc_id")
        .select("lane_id", measures.lane_label(F.col("o_city"), F.col("d_city")).alias("lane_label"))
    )


@register("""SELECT coalesce(nullif(trim(notes), ''), 'Unknown') AS exception_type, count(*) AS events
FROM fact_event GROUP BY 1""")
def exception_type(b: Bound) -> DataFrame:
    return b.events.groupBy(measures.exception_type(F.col("notes")).alias("exception_type")).agg(
        F.count(F.lit(1)).alias("events")
    )


# --- rating -------------------------------------------------------------------------------------------------------

HUB_SQL = """hub AS (
  SELECT CAST(n_nationkey AS BIGINT)*2 + 1 + k AS loc_id, CASE k WHEN 0 THEN 'Origin' ELSE 'Dest' END AS type,
         n_name AS city, n_nationkey*2.0 - 10.0 AS lat, n_nationkey*9.0 - 120.0 AS lon
  FROM nation, (SELECT unnest([0, 1]) AS k)
)"""


def arc_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle miles in SQL, in the arctangent form."""
    a = (
        f"(power(sin(radians({lat2} - {lat1})/2), 2) + cos(radians({lat1}))*cos(radians({lat2}))"
        f"*power(sin(radians({lon2} - {lon1})/2), 2))"
    )
    return f"2*3958.8*atan2(sqrt({a}), sqrt(1 - {a}))"


@register(f"SELECT loc_id, round({arc_sql('lat', 'lon', '33.749', '-84.388')}, 4) AS miles FROM hub", extra=HUB_SQL)
def haversine_miles(b: Bound) -> DataFrame:
    miles = rating.haversine_miles(F.col("lat"), F.col("lon"), F.lit(33.749), F.lit(-84.388))
    return binding.hubs(b.table("nation")).select("loc_id", F.round(miles, 4).alias("miles"))


_MILES = "abs(l_partkey - l_suppkey) % 1500"


@register(f"""SELECT l_suppkey % 3 AS kind, miles, CAST(CASE WHEN miles < 300 THEN 1 WHEN miles < 600 THEN 2
  WHEN miles < 1000 THEN 3 ELSE 4 END + CASE WHEN l_suppkey % 3 = 2 THEN 1 ELSE 0 END AS INTEGER) AS days,
  count(*) AS n FROM (SELECT *, {_MILES} AS miles FROM lineitem) GROUP BY ALL""", bound=False)
def transit_bucket(b: Bound) -> DataFrame:
    rows = b.table("lineitem").selectExpr(
        "l_suppkey % 3 AS kind", f"{_MILES} AS miles",
        "element_at(array('TL', 'LTL', 'Intermodal'), CAST(l_suppkey % 3 + 1 AS INT)) AS mode",
    )
    days = rating.transit_bucket(F.col("miles"), F.col("mode"))
    return rows.groupBy("kind", "miles", days.alias("days")).agg(F.count(F.lit(1)).alias("n"))


@register("""SELECT shipment_id, leg_id, CAST(round(greatest(CAST(0.05 AS DECIMAL(12,5)), CAST(CAST(0.12 AS DECIMAL(4,2))
  + CAST(0.05 AS DECIMAL(4,2)) * (CAST(h AS DECIMAL(6,0)) * CAST(0.01 AS DECIMAL(3,2)) - CAST(3.5 AS DECIMAL(3,1)))
  AS DECIMAL(12,5))) * planned_miles, 2) AS DOUBLE) AS fuel_surcharge FROM legs""")
def fuel_surcharge(b: Bound) -> DataFrame:
    diesel = F.col("_h").cast("decimal(6,0)") * F.lit("0.01").cast("decimal(3,2)")
    return b.legs.select(
        "shipment_id", "leg_id", rating.fuel_surcharge(F.col("planned_miles"), diesel).alias("fuel_surcharge")
    )


@register("""SELECT mode, CAST(planned_miles AS DOUBLE) AS planned_miles, CASE WHEN planned_miles > 500
  THEN CASE mode WHEN 'TL' THEN 2.20 WHEN 'LTL' THEN 1.80 ELSE 1.60 END
  ELSE CASE mode WHEN 'TL' THEN 2.50 WHEN 'LTL' THEN 2.00 ELSE 1.80 END END::DOUBLE AS rate, count(*) AS legs
FROM legs GROUP BY ALL""")
def base_rate_per_mile(b: Bound) -> DataFrame:
    rate = rating.base_rate_per_mile(F.col("_mode"), F.col("planned_miles"))
    return b.legs.groupBy(F.col("_mode").alias("mode"), "planned_miles", rate.alias("rate")).agg(
        F.count(F.lit(1)).alias("legs")
    )


HOLIDAYS = (date(1996, 1, 1), date(1997, 7, 4), date(1999, 12, 25))
_NEAR = " OR ".join(f"abs(date - DATE '{h}') <= 1" for h in HOLIDAYS)


WEIGHT_SQL = f"""SELECT date, year, (1.0::DOUBLE + CASE WHEN day(date) >= 27 THEN 0.12::DOUBLE ELSE 0 END
  + CASE WHEN {_NEAR} THEN 0.10::DOUBLE ELSE 0 END) * CASE WHEN isodow(date) >= 6 THEN 0.8::DOUBLE ELSE 1 END
  AS weight FROM dim_date"""


@register(
    f"SELECT date, weight, CAST(greatest(1, round_even(weight*10, 0)) AS INTEGER) AS repeats FROM ({WEIGHT_SQL})"
)
def volume_weight(b: Bound) -> DataFrame:
    weight = rating.volume_weight(F.col("date"), HOLIDAYS, 0.12)
    return b.star["dim_date"].select("date", weight.alias("weight"), rating.volume_repeats(weight).alias("repeats"))
