"""Declared schemas, keys and value domains of the logistics star.

Schemas are declared, never inferred.  Every table exists in three forms:

* typed with audit columns (landing and warehouse zones): :func:`typed_schema`
* typed without audit columns (model zone): ``typed_schema(t, audit=False)``
* every column a string (raw zone): :func:`raw_schema`
"""

from __future__ import annotations

from pyspark.sql import types as T

AUDIT_COLUMNS = ("load_date", "update_date")
_AUDIT_DDL = "load_date TIMESTAMP_NTZ, update_date TIMESTAMP_NTZ"

# Column names and types of the nine tables.
TABLE_DDL: dict[str, str] = {
    "dim_customer": "customer_id BIGINT, name STRING, segment STRING, region STRING",
    "dim_carrier": "carrier_id BIGINT, name STRING, mode STRING, mc_number STRING, score_tier STRING",
    "dim_equipment": "equipment_id BIGINT, type STRING, capacity_lbs INT",
    "dim_location": (
        "loc_id BIGINT, name STRING, city STRING, state STRING, country STRING, timezone STRING, type STRING"
    ),
    "dim_lane": (
        "lane_id BIGINT, origin_loc_id BIGINT, dest_loc_id BIGINT, standard_miles DECIMAL(10,2), "
        "std_transit_days INT"
    ),
    "dim_date": (
        "date_key INT, date DATE, year INT, quarter INT, month INT, week INT, dow INT, is_weekend BOOLEAN"
    ),
    "fact_shipment": (
        "shipment_id STRING, leg_id INT, customer_id BIGINT, carrier_id BIGINT, equipment_id BIGINT, "
        "origin_loc_id BIGINT, dest_loc_id BIGINT, lane_id BIGINT, tender_ts TIMESTAMP_NTZ, "
        "pickup_plan_ts TIMESTAMP_NTZ, pickup_actual_ts TIMESTAMP_NTZ, delivery_plan_ts TIMESTAMP_NTZ, "
        "delivery_actual_ts TIMESTAMP_NTZ, planned_miles DECIMAL(10,2), actual_miles DECIMAL(10,2), pieces INT, "
        "weight_lbs DECIMAL(10,2), cube DECIMAL(10,2), revenue DECIMAL(12,2), total_cost DECIMAL(12,2), "
        "fuel_surcharge DECIMAL(12,2), accessorial_cost DECIMAL(12,2), status STRING, "
        "isdeliveredontime BOOLEAN, isinfull BOOLEAN, isotif BOOLEAN, cancel_flag BOOLEAN"
    ),
    "fact_event": (
        "shipment_id STRING, event_seq INT, event_type STRING, event_ts TIMESTAMP_NTZ, "
        "facility_loc_id BIGINT, notes STRING"
    ),
    "fact_cost": (
        "shipment_id STRING, cost_type STRING, calc_method STRING, rate_ref STRING, "
        "cost_amount DECIMAL(12,2), currency STRING"
    ),
}

DIM_TABLES = tuple(t for t in TABLE_DDL if t.startswith("dim_"))
FACT_TABLES = tuple(t for t in TABLE_DDL if t.startswith("fact_"))
TABLES = DIM_TABLES + FACT_TABLES

# Primary keys.  rate_ref may be null, and null equals ''.
KEYS: dict[str, tuple[str, ...]] = {
    "dim_customer": ("customer_id",),
    "dim_carrier": ("carrier_id",),
    "dim_equipment": ("equipment_id",),
    "dim_location": ("loc_id",),
    "dim_lane": ("lane_id",),
    "dim_date": ("date_key",),
    "fact_shipment": ("shipment_id", "leg_id"),
    "fact_event": ("shipment_id", "event_seq"),
    "fact_cost": ("shipment_id", "cost_type", "rate_ref"),
}
NULL_EQUALS_EMPTY = ("rate_ref",)

# Shipment foreign keys as (column, dimension, dimension key).
SHIPMENT_FKS: tuple[tuple[str, str, str], ...] = (
    ("carrier_id", "dim_carrier", "carrier_id"),
    ("customer_id", "dim_customer", "customer_id"),
    ("dest_loc_id", "dim_location", "loc_id"),
    ("equipment_id", "dim_equipment", "equipment_id"),
    ("lane_id", "dim_lane", "lane_id"),
    ("origin_loc_id", "dim_location", "loc_id"),
)

# Value domains.
STATUS_TENDERED = ("Tendered", "Accepted", "In-Transit", "Delivered", "Exception", "Cancelled")
STATUS_ACCEPTED = ("Accepted", "In-Transit", "Delivered", "Exception")
EVENT_TYPES = (
    "Tendered", "Accepted", "AtOrigin", "PickedUp", "AtDest", "Delivered", "Exception", "DwellStart", "DwellEnd",
)
COST_TYPES = (
    "Base", "Fuel", "Accessorial: Detention", "Accessorial: Lumper", "Accessorial: Layover", "Accessorial: TONU",
)
CALC_METHODS = ("flat", "per-mile", "index")
DOMAINS: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("fact_shipment", "status", STATUS_TENDERED),
    ("fact_event", "event_type", EVENT_TYPES),
    ("fact_cost", "cost_type", COST_TYPES),
    ("fact_cost", "calc_method", CALC_METHODS),
)


_TYPES: dict[str, T.DataType] = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DECIMAL(10,2)": T.DecimalType(10, 2),
    "DECIMAL(12,2)": T.DecimalType(12, 2),
}


def typed_schema(table: str, audit: bool = True) -> T.StructType:
    """Declared columns of a table.  Needs no Spark session."""
    ddl = f"{TABLE_DDL[table]}, {_AUDIT_DDL}" if audit else TABLE_DDL[table]
    fields = (column.split(" ", 1) for column in ddl.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


def raw_schema(table: str, audit: bool = True) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in typed_schema(table, audit)])
