"""Data-quality checks.  Each returns a small frame; zero means clean for all but the counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.operators.joins import orphans
from freightlens.schemas import DOMAINS, KEYS, NULL_EQUALS_EMPTY, SHIPMENT_FKS


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name.upper()).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    ).orderBy("table_name")


#: Rows whose keys one task counts, in up to as many tasks as write their shuffle files without holding rows, and beyond.
KEY_ROWS, KEY_TASKS, KEY_ROWS_MOST = 2_000_000, 200, 20_000_000


def pk_duplicates(tables: Mapping[str, DataFrame], rows: Mapping[str, int] | None = None) -> DataFrame:
    """Number of key values that occur more than once, per table.

    Of tables with a known, or highest possible, number of ``rows`` the keys are dealt to as many tasks as that takes
    and counted there only: keys hardly repeat, so tasks that counted theirs before would each hold nearly all of them.
    """

    def tasks(n: int, df: DataFrame) -> int:
        own = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return max(own, min(KEY_TASKS, -(-n // KEY_ROWS)), -(-n // KEY_ROWS_MOST))

    def duplicates(name: str, df: DataFrame) -> DataFrame:
        columns = [F.coalesce(k, F.lit("")) if k in NULL_EQUALS_EMPTY else F.col(k) for k in KEYS[name]]
        keys = [f"_k{i}" for i in range(len(columns))]
        df = df.select(*[c.alias(k) for c, k in zip(columns, keys)])
        if rows and name in rows:
            df = df.repartition(tasks(rows[name], df), *keys)
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        return per_key.agg(F.count_if(F.col("_n") > 1).alias("dup_pk")).select(
            F.lit(name.upper()).alias("table_name"), "dup_pk"
        )

    return _stack([duplicates(n, df) for n, df in tables.items()]).orderBy("table_name")


Fks = tuple[tuple[str, str, str], ...]


def _fk_values(ship: DataFrame, fks: Fks) -> DataFrame:
    """Distinct values of the given shipment keys with their row counts, from one pass over the fact."""
    pairs = [F.struct(F.lit(c).alias("fk"), F.col(c).cast("bigint").alias("key")) for c, _, _ in fks]
    return (
        ship.select(F.explode(F.array(*pairs)).alias("p"))
        .groupBy("p.fk", "p.key")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _unmatched_fks(ship: DataFrame, dims: Mapping[str, DataFrame], fks: Fks = SHIPMENT_FKS) -> DataFrame:
    known = _stack(
        [
            dims[table].select(F.lit(column).alias("fk"), F.col(key).cast("bigint").alias("key"))
            for column, table, key in fks
        ]
    )
    known = known.withColumn("_known", F.lit(True)).distinct()
    values = _fk_values(ship, fks).join(known, ["fk", "key"], "left")

    def rows(column: str, problem: Column) -> Column:
        return F.coalesce(F.sum(F.when((F.col("fk") == column) & problem, F.col("_n"))), F.lit(0))

    dangling = F.col("_known").isNull() & F.col("key").isNotNull()
    columns = [c for c, _, _ in fks]
    counts = values.agg(
        *[rows(c, dangling).alias(f"{c}_dangling") for c in columns],
        *[rows(c, F.col("key").isNull()).alias(f"{c}_null") for c in columns],
    )
    per_fk = [
        F.struct(
            F.lit(c).alias("fk"), F.col(f"{c}_dangling").alias("dangling"), F.col(f"{c}_null").alias("null_keys")
        )
        for c in columns
    ]
    return counts.select(F.explode(F.array(*per_fk)).alias("r")).select("r.*")


def fk_coverage(ship: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Shipment rows whose key is missing from its dimension; null keys do not count."""
    return (
        _unmatched_fks(ship, dims)
        .select(F.upper("fk").alias("fk"), F.col("dangling").alias("missing"))
    )


_INVALID = tuple(fk for fk in SHIPMENT_FKS if fk[0] in ("origin_loc_id", "dest_loc_id", "lane_id"))


def invalid_fks(ship: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Shipment rows with a bad origin, destination or lane; null keys count as bad."""
    return (
        _unmatched_fks(ship, dims, _INVALID)
        .select("fk", (F.col("dangling") + F.col("null_keys")).alias("invalid"))
    )


def child_coverage(events: DataFrame, costs: DataFrame, ship: DataFrame) -> DataFrame:
    """Event and cost rows without a shipment; null keys do not count.

    All three tables are counted per shipment in one grouping over their union: one shuffle of pre-combined counts.
    """

    def tagged(df: DataFrame, e: int, c: int, s: int) -> DataFrame:
        marks = {"e": e, "c": c, "s": s}
        return df.filter(F.col("shipment_id").isNotNull()).select(
            "shipment_id", *[F.lit(v).cast("bigint").alias(k) for k, v in marks.items()]
        )

    per_key = (
        _stack([tagged(events, 1, 0, 0), tagged(costs, 0, 1, 0), tagged(ship, 0, 0, 1)])
        .groupBy("shipment_id")
        .agg(*[F.sum(c).alias(c) for c in ("e", "c", "s")])
    )
    lost = F.col("s") == 0
    counts = per_key.agg(
        *[F.coalesce(F.sum(F.when(lost, F.col(c))), F.lit(0)).alias(c) for c in ("e", "c")]
    )
    return counts.select(
        F.explode(
            F.array(
                F.struct(F.lit("COST -> SHIPMENT").alias("rel"), F.col("c").alias("missing")),
                F.struct(F.lit("EVENT -> SHIPMENT").alias("rel"), F.col("e").alias("missing")),
            )
        ).alias("r")
    ).select("r.rel", "r.missing")


def orphan_events(events: DataFrame, ship: DataFrame) -> DataFrame:
    """Event rows per shipment id that no shipment has; counted before the anti join."""
    per_key = events.groupBy("shipment_id").agg(F.count(F.lit(1)).alias("event_rows"))
    return orphans(per_key, ship, "shipment_id")


def delivery_completeness(ship: DataFrame) -> DataFrame:
    ts = F.col("delivery_actual_ts")
    return ship.agg(
        F.count_if(ts.isNotNull()).alias("delivered_cnt"), F.count_if(ts.isNull()).alias("in_flight_cnt")
    )


# Plausible ranges of the default synthetic volume; a caller with other data passes its own.
PLAUSIBLE = {
    "shipments": (5000.0, 10000.0),
    "exception_rate": (0.06, 0.09),
    "otd_rate": (0.80, 0.95),
    "gm_per_mile": (0.25, 0.60),
}


def range_checks(metrics: DataFrame, expected: Mapping[str, tuple[float, float]] = PLAUSIBLE) -> DataFrame:
    """One row per expected metric of a one-row frame: value, limits, and whether it lies within them."""
    checks = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(name).cast("double").alias("value"),
            F.lit(float(low)).alias("low"),
            F.lit(float(high)).alias("high"),
        )
        for name, (low, high) in expected.items()
    ]
    return (
        metrics.select(F.explode(F.array(*checks)).alias("c"))
        .select("c.*")
        .withColumn("in_range", F.coalesce(F.col("value").between(F.col("low"), F.col("high")), F.lit(False)))
    )


def domain_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows whose value lies outside the column's declared domain; nulls do not count.  Each table is read once."""

    def outside(table: str) -> DataFrame:
        domains = [(column, values) for t, column, values in DOMAINS if t == table]
        bad = {c: F.count_if(F.coalesce(~F.col(c).isin(*values), F.lit(False))) for c, values in domains}
        found = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("out_of_domain")) for c in bad]
        counts = tables[table].agg(*[n.alias(c) for c, n in bad.items()])
        return counts.select(F.lit(table.upper()).alias("table_name"), F.explode(F.array(*found)).alias("r")).select(
            "table_name", "r.*"
        )

    return _stack([outside(t) for t in dict.fromkeys(d[0] for d in DOMAINS) if t in tables])


def load_metrics(table: str) -> dict[str, Column]:
    """What a load tells of itself while it writes: rows, values outside each declared domain, and of shipments how many
    are delivered and in flight.  Aggregates for ``DataFrame.observe``."""
    found = {"rows": F.count(F.lit(1))}
    if table == "fact_shipment":
        ts = F.col("delivery_actual_ts")
        found |= {"delivered": F.count_if(ts.isNotNull()), "in_flight": F.count_if(ts.isNull())}
    for t, column, values in DOMAINS:
        if t == table:
            found[f"{column}_out_of_domain"] = F.count_if(F.coalesce(~F.col(column).isin(*values), F.lit(False)))
    return found
