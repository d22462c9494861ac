"""The batch refresh and the raw-to-model load."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from freightlens.functions.measures import GRACE_MINUTES
from freightlens.operators import merge, quality, shaping
from freightlens.schemas import FACT_TABLES, KEYS, TABLES
from freightlens.sources.landing import landing_path, read_landing_csv, read_raw_csv
from freightlens.sources.warehouse import read_edw, update_table, write_table


def checks(star: Mapping[str, DataFrame], stored: bool = False) -> DataFrame:
    """All expect-zero checks and row counts in one (check, item, value) frame.

    ``stored`` says that the tables lie in files, whose footers count their rows.
    """

    def listed(check: str, df: DataFrame, item: str, value: str) -> DataFrame:
        return df.select(F.lit(check).alias("check"), F.col(item).alias("item"), F.col(value).alias("value"))

    ship = star["fact_shipment"]
    rows = {t: star[t].count() for t in FACT_TABLES} if stored else {}
    return (
        listed("row_count", quality.row_counts(star), "table_name", "row_count")
        .unionByName(listed("dup_pk", quality.pk_duplicates(star, rows), "table_name", "dup_pk"))
        .unionByName(listed("fk_missing", quality.fk_coverage(ship, star), "fk", "missing"))
        .unionByName(
            listed("orphans", quality.child_coverage(star["fact_event"], star["fact_cost"], ship), "rel", "missing")
        )
    )


def observed(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """A load that counts its rows, completeness and values outside their domains while it is written."""
    seen = Observation(f"load_{table}")
    return df.observe(seen, *[m.alias(name) for name, m in quality.load_metrics(table).items()]), seen


def load_report(spark: SparkSession, loads: Mapping[str, Observation]) -> DataFrame:
    """(check, item, value) of finished loads: their own counts, nothing is read again."""
    rows = [(f"loaded_{name}", table.upper(), value) for table, seen in loads.items() for name, value in seen.get.items()]
    return spark.createDataFrame(rows, "check string, item string, value bigint")


def merge_into(
    source: DataFrame,
    root: str,
    table: str,
    now: datetime | Column,
    copy_audit: bool = False,
    feed: Callable[[DataFrame, DataFrame], None] | None = None,
    stored: bool = False,
    unique: bool = False,
) -> list[int | None] | None:
    """Merge rows, unique per key, into a warehouse table; only the months that they touch are rewritten.

    ``feed`` gets the rows of a fact with the keys of the source as they are before and as they will be after.  ``stored``
    says that the rows lie in files and are cheap to read again, ``unique`` that their keys need no check.
    """

    def upsert(target: DataFrame, rows: DataFrame) -> DataFrame:
        return merge.merge_table(target, rows, table, now, copy_audit, unique=unique)

    return update_table(source, root, table, [merge.key_column(k) for k in KEYS[table]], upsert, feed, stored)


def stage_latest(loaded: DataFrame, stage: str, table: str) -> Observation:
    """Write the latest landing row per key; the rows count themselves while they are written.

    Facts are written as they are read, and their keys alone are counted.  Only where a key repeats do whole rows meet by
    key, and what is left replaces them.
    """
    spark = loaded.sparkSession
    if table in FACT_TABLES:
        counted, seen = observed(loaded, table)
        write_table(counted, stage, table, by_month=False, own=False)
        loaded = read_edw(spark, stage, table)
        if not quality.pk_duplicates({table: loaded}, {table: loaded.count()}).first()["dup_pk"]:
            return seen
    counted, seen = observed(merge.latest_source(loaded, table), table)
    write_table(counted, stage, table, by_month=False, own=table in FACT_TABLES)
    return seen


def refresh(
    spark: SparkSession,
    landing: str,
    root: str,
    now: datetime,
    grace: int = GRACE_MINUTES,
    staged: Callable[[str], None] | None = None,
) -> DataFrame:
    """Load landing CSVs, curate them into the warehouse (dimensions, then facts), and return the checks of the warehouse
    and what each load has counted of itself (``loaded_...``).

    ``landing`` holds a CSV file or folder per table, see :func:`landing_path`.  Each table's latest landing row per key
    is staged, then merged into the warehouse.  Dimensions come first, so a run that fails half-way
    leaves no fact without its dimension rows, and running it again completes it: a repeated merge changes nothing.
    A fact's staged rows are given back once they are merged.  ``staged(table)`` is called when a table's landing files have
    been read for the last time.
    """
    stage, edw = f"{root}/stg", f"{root}/edw"
    loads = {}
    for table in TABLES:
        loaded = read_landing_csv(spark, landing_path(spark, landing, table), table)
        loads[table] = stage_latest(loaded, stage, table)
        if staged is not None:
            staged(table)
    for table in TABLES:
        rows = source = read_edw(spark, stage, table)
        if table == "fact_shipment":
            source = shaping.curate_shipments(source, grace)
        merge_into(source, edw, table, now, copy_audit=True, stored=True, unique=True)
        if table in FACT_TABLES:
            write_table(spark.createDataFrame([], rows.schema), stage, table, by_month=False, own=False)
    return checks({t: read_edw(spark, edw, t) for t in TABLES}, stored=True).unionByName(load_report(spark, loads))


def load_model(spark: SparkSession, raw: str, root: str) -> DataFrame:
    """Raw CSVs (all text) to typed model tables by full replacement, then the checks.  Re-running changes nothing.

    Text is trimmed, so padded keys meet their unpadded ones.
    """
    for table in TABLES:
        text = read_raw_csv(spark, landing_path(spark, raw, table), table)
        model = shaping.type_raw_table(shaping.trim_text(text), table, audit=True)
        latest = merge.latest_source(model, table)
        write_table(latest.drop("load_date", "update_date"), root, table)
    return checks({t: read_edw(spark, root, t, audit=False) for t in TABLES}, stored=True)
