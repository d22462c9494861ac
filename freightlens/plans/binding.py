"""Binding of the test tables to the logistics star.

A fixed, deterministic mapping of the order tables onto shipments, events and costs, written so that any SQL engine
computes the same values (``oracle.py`` states it in SQL).  A line item is a version of a shipment leg: the table
repeats (order, line) keys, and its ship date is the version's update time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.functions import rating
from freightlens.functions.measures import plus
from freightlens.operators.dims import date_dim
from freightlens.operators.shaping import dedupe_latest
from freightlens.schemas import COST_TYPES, TABLES, typed_schema
from freightlens.session import scratch_path

_VERSION_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_discount",
    "l_tax",
)
_LINE_COLUMNS = ("l_orderkey", "l_linenumber", *_VERSION_ORDER)
_HEADER_COLUMNS = ("o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "c_nationkey")
_MODES = ("TL", "LTL", "Intermodal")
_TIERS = ("A", "B", "C", "D")
_EQUIPMENT = (("Box", 10000), ("Tank", 20000), ("Deck", 30000))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: tuple) -> Column:
    chosen = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], 1):
        chosen = chosen.when(index == i, F.lit(v))
    return chosen


def _money(c: Column | int | str) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("decimal(12,2)")


def latest_lines(lines: DataFrame) -> DataFrame:
    """One version per (order, line)."""
    return dedupe_latest(lines.select(*_LINE_COLUMNS), ["l_orderkey", "l_linenumber"], _VERSION_ORDER)


def headed_lines(lines: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Line items with what their order and its customer say.

    Orders take their customer's nation first, so the much longer line table meets one other table.
    """
    header = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority").join(
        customer.selectExpr("c_custkey AS o_custkey", "c_nationkey"), "o_custkey"
    )
    return lines.join(header, F.expr("l_orderkey = o_orderkey")).select(*_LINE_COLUMNS, *_HEADER_COLUMNS)


def legs(lines: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Shipment legs of the given line items, with the internal columns ``_h``, ``_qty``, ``_reason`` and ``_mode``."""
    return legs_of(headed_lines(lines, orders, customer))


def legs_of(columns: DataFrame) -> DataFrame:
    """Shipment legs of headed lines, row by row."""
    for step in _LEG_STEPS:
        columns = columns.selectExpr("*", *[f"{rule} AS {name}" for name, rule in step.items()])
    return columns.selectExpr(*typed_schema("fact_shipment").names, *_INTERNAL)


_INTERNAL = ("_h", "_qty", "_reason", "_mode")


def _after(ts: str, hours: str = "0", minutes: str = "0") -> str:
    return f"{ts} + make_dt_interval(0, CAST({hours} AS INT), CAST({minutes} AS INT))"


# What a line item says as a shipment leg, each step over the columns of the one before.  Goods travel from the
# customer's nation to the hub of the customer's route; quantities decide what is small (cancelled) or large (an
# exception), discount and tax how late pickup and delivery are.
_LEG_STEPS: tuple[dict[str, str], ...] = (
    {
        "_h": "(l_partkey + 3 * l_orderkey + l_linenumber) % 1000",
        "_qty": "CAST(l_quantity AS INT)",
        "_mode": "element_at(array('TL', 'LTL', 'Intermodal'), CAST(l_suppkey % 3 + 1 AS INT))",
        "_reason": "CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN '  ' "
        "ELSE substr(o_orderpriority, 3) END",
        "origin_loc_id": "CAST(c_nationkey AS BIGINT)",
        "dest_loc_id": "o_custkey % 25",
    },
    {
        "lane_id": "origin_loc_id * 25 + dest_loc_id",
        "planned_miles": "CAST(abs(origin_loc_id - dest_loc_id) * 40 + 90 AS DECIMAL(10,2))",
        "cancel_flag": "_qty <= 3",
        "_done": "_qty > 3 AND (l_linestatus <> 'O' OR l_returnflag <> 'N')",
        "tender_ts": _after("o_orderdate", "l_linenumber"),
        "pickup_plan_ts": _after("o_orderdate", "24 + _qty"),
        "revenue": "CAST(l_extendedprice AS DECIMAL(12,2))",
    },
    {
        "status": "CASE WHEN cancel_flag THEN 'Cancelled' WHEN _done AND _qty >= 47 THEN 'Exception' "
        "WHEN _done THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Tendered' WHEN o_orderstatus = 'P' THEN 'Accepted' "
        "ELSE 'In-Transit' END",
        "delivery_plan_ts": _after("pickup_plan_ts", "24 * (2 + l_linenumber % 3)"),
    },
    {
        "pickup_actual_ts": "IF(status IN ('In-Transit', 'Delivered', 'Exception'), "
        + _after("pickup_plan_ts", minutes="20 * round(l_discount * 100)") + ", NULL)",
        "delivery_actual_ts": "IF(_done, " + _after("delivery_plan_ts", minutes="30 * (round(l_tax * 100) - 4)") + ", NULL)",
        "isinfull": "IF(l_linenumber = 7, NULL, l_returnflag <> 'R')",
    },
    {
        "shipment_id": "concat('S', lpad(CAST(l_orderkey AS STRING), greatest(9, length(CAST(l_orderkey AS STRING))), '0'))",
        "leg_id": "l_linenumber",
        "customer_id": "o_custkey",
        "carrier_id": "l_suppkey",
        "equipment_id": "l_suppkey % 3 + 1",
        "actual_miles": "CAST(IF(cancel_flag, 0, planned_miles + l_linenumber) AS DECIMAL(10,2))",
        "pieces": "_qty",
        "weight_lbs": "CAST(_qty * 12 AS DECIMAL(10,2))",
        "cube": "CAST(_qty * 2 AS DECIMAL(10,2))",
        "total_cost": "CAST(revenue * CAST(1 - l_discount - l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2))",
        "fuel_surcharge": "CAST(revenue * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2))",
        "accessorial_cost": "CAST(IF(status = 'Exception', 3 * _qty, 0) AS DECIMAL(12,2))",
        "isdeliveredontime": "coalesce(delivery_actual_ts <= delivery_plan_ts, false)",
        "load_date": "o_orderdate",
        "update_date": "l_shipdate",
    },
    {"isotif": "coalesce(isdeliveredontime AND isinfull, false)"},
)


def shipments_of(leg: DataFrame) -> DataFrame:
    return leg.select(*typed_schema("fact_shipment").names)


def events_of(leg: DataFrame) -> DataFrame:
    """Up to nine events per leg, built as one array per row and exploded: no repeated scan, no shuffle."""
    qty, cancelled = F.col("_qty"), F.col("cancel_flag")
    pickup, delivery = F.col("pickup_actual_ts"), F.col("delivery_actual_ts")
    origin, dest = F.col("origin_loc_id"), F.col("dest_loc_id")
    none = F.lit(None).cast("string")
    docked = qty % 4 == 0
    apart = cancelled | (F.col("status") == "Exception")
    rows = (
        (1, "Tendered", F.col("tender_ts"), origin, none),
        (2, "Accepted", F.when(~F.col("status").isin("Cancelled", "Tendered"), plus(F.col("pickup_plan_ts"), hours=-12)),
         origin, none),
        (3, "AtOrigin", F.when(pickup.isNotNull(), F.col("pickup_plan_ts")), origin, none),
        (4, "PickedUp", pickup, origin, none),
        (5, "DwellStart", F.when(docked, plus(delivery, hours=-3)), dest, F.lit("Dock")),
        (6, "DwellEnd", F.when(docked & (F.col("leg_id") != 2), plus(delivery, minutes=qty - 180)), dest, none),
        (7, "AtDest", plus(delivery, hours=-1), dest, none),
        (8, "Delivered", delivery, dest, none),
        (9, "Exception", F.when(apart, F.col("pickup_plan_ts")), F.when(cancelled, origin).otherwise(dest),
         F.col("_reason")),
    )
    built = [
        F.struct(
            (F.col("leg_id") * 10 + k).cast("int").alias("event_seq"),
            F.lit(kind).alias("event_type"),
            at.alias("event_ts"),
            where.alias("facility_loc_id"),
            note.alias("notes"),
        )
        for k, kind, at, where, note in rows
    ]
    return (
        leg.select("shipment_id", F.explode(F.array(*built)).alias("e"), "load_date")
        .select("shipment_id", "e.*", "load_date")
        .filter(F.col("event_ts").isNotNull())
        .withColumn("update_date", F.col("event_ts"))
    )


def costs_of(leg: DataFrame) -> DataFrame:
    """Cost lines of a leg: what it cost, its fuel and its extras if it moved, and a fee by quantity if not."""
    moved, extra = ~F.col("cancel_flag"), F.col("accessorial_cost")
    rows = (
        (COST_TYPES[0], "per-mile", "PM", F.when(moved, F.col("total_cost"))),
        (COST_TYPES[1], "index", "IX", F.when(moved, F.col("fuel_surcharge"))),
        (COST_TYPES[2], "flat", "EX", F.when(extra > 0, extra)),
        (COST_TYPES[4], "flat", "FEE", F.when(~moved, _money(F.col("_qty") * 10))),
    )
    built = [
        F.struct(
            F.lit(kind).alias("cost_type"),
            F.lit(method).alias("calc_method"),
            F.concat(F.lit(f"{ref} L"), F.col("leg_id").cast("string")).alias("rate_ref"),
            amount.alias("cost_amount"),
        )
        for kind, method, ref, amount in rows
    ]
    return (
        leg.select("shipment_id", F.explode(F.array(*built)).alias("c"), "load_date", "update_date")
        .select("shipment_id", "c.*", F.lit("USD").alias("currency"), "load_date", "update_date")
        .filter(F.col("cost_amount").isNotNull())
    )


def _stamped(df: DataFrame, name: str, day: str = "2024-01-01") -> DataFrame:
    at = F.lit(day).cast("timestamp_ntz")
    stamped = df.withColumns({"load_date": at, "update_date": at})
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in typed_schema(name)])


def dim_customer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    home = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region")
    )
    return _stamped(
        customer.join(home, "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"), "region",
        ),
        "dim_customer",
    )


def dim_carrier(supplier: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    return _stamped(
        supplier.select(
            key.alias("carrier_id"),
            F.col("s_name").alias("name"),
            _pick(key % 3, _MODES).alias("mode"),
            F.concat(F.lit("No. "), key.cast("string")).alias("mc_number"),
            _pick(key % 4, _TIERS).alias("score_tier"),
        ),
        "dim_carrier",
    )


def dim_equipment(supplier: DataFrame) -> DataFrame:
    """The three equipment kinds, found on the supplier keys that use them."""
    kind = F.col("s_suppkey") % 3
    used = supplier.select(kind.alias("k")).distinct()
    return _stamped(
        used.select(
            (F.col("k") + 1).alias("equipment_id"),
            _pick(F.col("k"), tuple(t for t, _ in _EQUIPMENT)).alias("type"),
            _pick(F.col("k"), tuple(c for _, c in _EQUIPMENT)).alias("capacity_lbs"),
        ),
        "dim_equipment",
    )


def dim_location(nation: DataFrame, region: DataFrame) -> DataFrame:
    return _stamped(
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("loc_id"),
            F.concat("n_name", F.lit(" DC")).alias("name"),
            F.col("n_name").alias("city"),
            F.lit(None).alias("state"),
            F.col("r_name").alias("country"),
            F.lit("UTC").alias("timezone"),
            F.lit("DC").alias("type"),
        ),
        "dim_location",
    )


def routes(customer: DataFrame) -> DataFrame:
    """The (origin, destination) pairs that customers ship on."""
    return customer.select(
        F.col("c_nationkey").cast("bigint").alias("origin_loc_id"), (F.col("c_custkey") % 25).alias("dest_loc_id")
    ).distinct()


def dim_lane(customer: DataFrame) -> DataFrame:
    """A lane for each route in use."""
    o, d = F.col("origin_loc_id"), F.col("dest_loc_id")
    miles = (F.abs(o - d) * 40 + 90).cast("decimal(10,2)")
    return _stamped(
        routes(customer).select(
            (o * 25 + d).alias("lane_id"), o, d, miles.alias("standard_miles"),
            rating.transit_bucket(miles, F.lit("TL")).alias("std_transit_days"),
        ),
        "dim_lane",
    )


def hub_routes(customer: DataFrame) -> DataFrame:
    """The routes between the locations of :func:`hubs`: from an origin hub to a destination hub."""
    return routes(customer).select(
        (F.col("origin_loc_id") * 2 + 1).alias("origin_loc_id"), (F.col("dest_loc_id") * 2 + 2).alias("dest_loc_id")
    )


def hubs(nation: DataFrame) -> DataFrame:
    """An origin and a destination location per nation, with coordinates, for building lanes."""
    key = F.col("n_nationkey").cast("bigint")
    return nation.select(
        F.explode(
            F.array(
                *[
                    F.struct((key * 2 + i).alias("loc_id"), F.lit(kind).alias("type"))
                    for i, kind in ((1, "Origin"), (2, "Dest"))
                ]
            )
        ).alias("l"),
        F.col("n_name").alias("city"),
        (key * 2.0 - 10.0).alias("lat"),
        (key * 9.0 - 120.0).alias("lon"),
    ).select("l.*", "city", "lat", "lon")


def calendar_of(ship: DataFrame) -> DataFrame:
    span = ship.agg(
        F.to_date(F.min("delivery_actual_ts")).alias("start"), F.to_date(F.max("delivery_actual_ts")).alias("end")
    )
    return _stamped(date_dim(span), "dim_date")


def weekly_prices(orders: DataFrame) -> DataFrame:
    """A price per week, quoted only in weeks with at least the mean number of orders, so the list has gaps."""
    weekly = orders.groupBy(F.to_date(F.date_trunc("week", "o_orderdate")).alias("week")).agg(
        F.count(F.lit(1)).alias("n")
    )
    mean = weekly.agg(F.avg("n").alias("mean")).scalar()
    price = (F.col("n") % 20).cast("decimal(4,0)") * F.lit("0.05").cast("decimal(3,2)") + 3
    return weekly.filter(F.col("n") >= mean).select("week", price.cast("decimal(6,3)").alias("price"))


def source_legs(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    return legs(latest_lines(lines), table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


class BoundStar(Mapping):
    """The nine star tables over the test tables; each is planned when it is first asked for.

    With ``stored`` the latest lines and their headers are joined once and written to the scratch folder, for queries that
    read several facts in jobs of their own.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stored: bool = False):
        self._spark, self._sf_dir, self._stored = spark, sf_dir, stored
        self._made: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        return table(self._spark, self._sf_dir, name)

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def legs(self) -> DataFrame:
        return self._once("legs", self._stored_legs if self._stored else lambda: source_legs(self._spark, self._sf_dir))

    def _stored_legs(self) -> DataFrame:
        path = scratch_path(self._spark, "lines")
        lines = headed_lines(latest_lines(self.source("lineitem")), self.source("orders"), self.source("customer"))
        lines.write.option("compression", "zstd").parquet(path)
        return legs_of(self._spark.read.schema(lines.schema).parquet(path))

    def __getitem__(self, name: str) -> DataFrame:
        makers = {
            "dim_customer": lambda: dim_customer(*map(self.source, ("customer", "nation", "region"))),
            "dim_carrier": lambda: dim_carrier(self.source("supplier")),
            "dim_equipment": lambda: dim_equipment(self.source("supplier")),
            "dim_location": lambda: dim_location(*map(self.source, ("nation", "region"))),
            "dim_lane": lambda: dim_lane(self.source("customer")),
            "dim_date": lambda: calendar_of(self["fact_shipment"]),
            "fact_shipment": lambda: shipments_of(self.legs()),
            "fact_event": lambda: events_of(self.legs()),
            "fact_cost": lambda: costs_of(self.legs()),
        }
        return self._once(name, makers[name])

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


def bind_star(spark: SparkSession, sf_dir: str, stored: bool = False) -> BoundStar:
    return BoundStar(spark, sf_dir, stored)
