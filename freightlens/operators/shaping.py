"""Typing, deduplication, audit columns and curation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.functions import clean, measures
from freightlens.schemas import FACT_TABLES, typed_schema


def type_raw_table(df: DataFrame, table: str, audit: bool = False) -> DataFrame:
    """Raw (all text) to the typed model table.  Dimension flags keep nulls, fact flags default to false."""
    flag_default = False if table in FACT_TABLES else None
    return df.select(
        *[
            clean.typed(F.col(f.name), f.dataType, tolerant=True, bool_default=flag_default).alias(f.name)
            for f in typed_schema(table, audit)
        ]
    )


def trim_text(df: DataFrame) -> DataFrame:
    """Text columns without white space around them."""
    text = [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: clean.trim_spaces(F.col(c)) for c in text}) if text else df


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns (nulls lowest).

    Ties fall to the remaining columns, so the result never depends on row order.  Spark keeps only the first row
    per key on the map side before it shuffles (a partial group limit), so a key that holds a large share of all rows
    reaches its reducer as one row per map task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    latest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in (*order, *rest)])
    return df.withColumn("_rank", F.row_number().over(latest)).filter(F.col("_rank") == 1).drop("_rank")


def now_literal(now: datetime | Column) -> Column:
    """The run time as a literal, so that re-runs give the same rows."""
    return now if isinstance(now, Column) else F.lit(now).cast(T.TimestampNTZType())


def audit_columns(df: DataFrame, now: datetime | Column) -> DataFrame:
    """Fill missing load and update times."""
    at = now_literal(now)
    return df.withColumns({c: F.coalesce(F.col(c), at) for c in ("load_date", "update_date")})


_SHIPMENT_TIMES = ("tender_ts", "pickup_plan_ts", "pickup_actual_ts", "delivery_plan_ts", "delivery_actual_ts")


def curate_shipments(df: DataFrame, grace: int = measures.GRACE_MINUTES) -> DataFrame:
    """Type the times and recompute the on-time and on-time-in-full flags at one grace; other flags pass through."""
    types = dict(df.dtypes)

    def as_time(name: str) -> Column:
        return clean.safe_ts(F.col(name)) if types[name] == "string" else F.col(name).cast("timestamp_ntz")

    timed = df.withColumns({c: as_time(c) for c in _SHIPMENT_TIMES})
    ontime = measures.on_time(F.col("delivery_actual_ts"), F.col("delivery_plan_ts"), grace)
    return timed.withColumns(
        {
            "isdeliveredontime": ontime,
            "isotif": measures.otif(ontime, F.col("isinfull"), null_is_false=True),
        }
    )
