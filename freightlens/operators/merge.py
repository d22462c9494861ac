"""Incremental upserts.

A merge is one full outer join of the target with the source on the key: both are read once and shuffled once.  A source
that repeats a key has no single answer, so such a merge fails; run :func:`latest_source` first where it can happen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions import measures
from freightlens.operators.shaping import curate_shipments, dedupe_latest, now_literal
from freightlens.schemas import AUDIT_COLUMNS, DIM_TABLES, KEYS, NULL_EQUALS_EMPTY


#: Begins the name of a column that holds a key as it is compared, where a target stores it.
KEY_PREFIX = "key_"


def key_column(name: str) -> Column:
    """A key column as it is compared: null and empty are the same in keys that may be either."""
    return F.coalesce(F.col(name), F.lit("")) if name in NULL_EQUALS_EMPTY else F.col(name)


def _merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    guarded: bool,
    update_now: Column | None,
    insert_now: Column | None,
    buckets: int | None = None,
    unique: bool = False,
) -> DataFrame:
    stored = {k: f"{KEY_PREFIX}{k}" for k in keys if f"{KEY_PREFIX}{k}" in target.columns}
    columns = [c for c in target.columns if c not in stored.values()]
    probe = [f"_k{i}" for i in range(len(keys))]
    keyed = [key_column(k).alias(p) for p, k in zip(probe, keys)]
    if buckets:
        # Where the target lies in buckets of its key, the source comes to them.
        source = source.repartition(buckets, *[key_column(k) for k in keys])
    # The window needs the partitioning that the join needs, so it costs no shuffle.
    repeats = F.count(F.lit(1)).over(Window.partitionBy(*probe))
    complete = F.lit(True)
    for p in probe:
        complete = complete & F.col(p).isNotNull()
    once = F.when(~complete | (repeats == 1), True).otherwise(
        F.raise_error(F.lit(f"the merge source repeats a key of ({', '.join(keys)})")).cast("boolean")
    )
    if unique:
        once = F.lit(True)
    new = source.select(*keyed, *[F.col(c).alias(f"_s_{c}") for c in columns]).withColumn("_in_source", once)
    held = [F.col(stored[k]).alias(p) if k in stored else c for p, k, c in zip(probe, keys, keyed)]
    old = target.select(*held, *columns, F.lit(True).alias("_in_target"))
    joined = old.join(new, probe, "full_outer")

    kept = F.col("_in_target").isNotNull()
    take = kept & F.col("_in_source").isNotNull()
    if guarded:
        take = take & F.coalesce(F.col("_s_update_date") >= F.col("update_date"), F.lit(False))

    def stamped(value: Column, now: Column | None) -> Column:
        return value if now is None else F.coalesce(value, now)

    def merged(name: str) -> Column:
        was, comes = F.col(name), F.col(f"_s_{name}")
        changed, fresh = comes, comes
        if name in keys or name == "load_date":
            changed = was
        if name == "update_date":
            changed = stamped(comes, update_now)
        if name in AUDIT_COLUMNS:
            fresh = stamped(comes, insert_now)
        return F.when(take, changed).when(kept, was).otherwise(fresh).alias(name)

    # Reading the flag of every source row keeps the check from being optimised away.
    return joined.filter(kept | F.col("_in_source")).select(*[merged(c) for c in columns])


def merge_dim(target: DataFrame, source: DataFrame, keys: Sequence[str], now: datetime | Column) -> DataFrame:
    """Upsert a dimension: any matching source row wins, load time is kept, missing audit times become ``now``."""
    at = now_literal(now)
    return _merge(target, source, keys, guarded=False, update_now=at, insert_now=at)


def merge_fact(target: DataFrame, source: DataFrame, keys: Sequence[str], now: datetime | Column) -> DataFrame:
    """Upsert a fact: a matching row is replaced only by an equal or later update time; nulls never win."""
    at = now_literal(now)
    return _merge(target, source, keys, guarded=True, update_now=at, insert_now=at)


def merge_table(
    target: DataFrame,
    source: DataFrame,
    table: str,
    now: datetime | Column,
    copy_audit: bool = False,
    buckets: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Upsert one star table by its declared key.

    ``copy_audit`` is the curation variant: update times are copied as they are on every match, and fact inserts
    keep their audit columns too.  ``buckets`` says into how many buckets of its key the target is stored: then only
    the source is shuffled.  ``unique`` says that the source comes from :func:`latest_source`: its keys are not checked.
    """
    at = now_literal(now)
    is_dim = table in DIM_TABLES
    return _merge(
        target,
        source,
        KEYS[table],
        guarded=not is_dim,
        update_now=None if copy_audit else at,
        insert_now=at if is_dim or not copy_audit else None,
        buckets=buckets,
        unique=unique,
    )


def latest_source(df: DataFrame, table: str) -> DataFrame:
    """The latest row per declared key, ready to be a merge source (null and empty key parts are the same)."""
    keys = {k: f"_key_{k}" if k in NULL_EQUALS_EMPTY else k for k in KEYS[table]}
    extra = {alias: key_column(k) for k, alias in keys.items() if alias != k}
    return dedupe_latest(df.withColumns(extra), list(keys.values()), ["update_date"]).select(*df.columns)


def curate(
    landing: Mapping[str, DataFrame],
    warehouse: Mapping[str, DataFrame],
    now: datetime | Column,
    grace: int = measures.GRACE_MINUTES,
) -> dict[str, DataFrame]:
    """Merge every landing table into the warehouse, recomputing shipment flags on the way."""
    sources = dict(landing)
    sources["fact_shipment"] = curate_shipments(landing["fact_shipment"], grace)
    return {t: merge_table(warehouse[t], sources[t], t, now, copy_audit=True) for t in sources}
