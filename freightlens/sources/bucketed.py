"""Large facts stored in sorted buckets of their key.

A merge joins a table with a batch on the key.  Stored in buckets of that key, the table is joined where it lies and
written back bucket by bucket: only the batch is shuffled.  For batches that touch most months of a fact; those that
touch few are better served by ``warehouse.update_table``, which rewrites these months only.

The layout is Spark's bucketing.  Where bucketed files lie is known from the folder, which names their number, and
declared to the session's catalog when they are read.
"""

from __future__ import annotations

import zlib
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from freightlens.operators.merge import KEY_PREFIX, key_column, merge_table
from freightlens.schemas import KEYS, NULL_EQUALS_EMPTY, typed_schema
from freightlens.session import scratch_path

#: Buckets of a table, and so tasks of a merge.  Choose them for a few hundred MB each.
BUCKETS = 64
#: Rows of a bucket that a task joins and sorts within a few hundred MB.
ROWS_PER_BUCKET = 500_000


def buckets_for(rows: int, least: int = 1) -> int:
    """Buckets for a table of about so many rows, so that a larger table has more of them and not larger ones."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


def _folder(root: str, table: str, buckets: int) -> str:
    return f"{root}/{table}_in_{buckets}_buckets"


def _bucket_columns(table: str) -> list[str]:
    """The key as it is compared: keys in which null equals empty are stored a second time, without null."""
    return [f"{KEY_PREFIX}{k}" if k in NULL_EQUALS_EMPTY else k for k in KEYS[table]]


def _catalog_name(path: str) -> str:
    return f"freight_{zlib.crc32(path.encode()):08x}_{len(path)}"


def _write(df: DataFrame, path: str, table: str, buckets: int) -> None:
    name, by = _catalog_name(path), _bucket_columns(table)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # of an external table only the entry goes
    df.write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)


def _stored(spark: SparkSession, path: str, table: str, buckets: int) -> DataFrame:
    """The rows below a path with their stored keys."""
    name, by = _catalog_name(path), ", ".join(_bucket_columns(table))
    extra = "".join(f", {c} STRING" for c in _bucket_columns(table) if c.startswith(KEY_PREFIX))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in typed_schema(table))
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}{extra}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _with_keys(df: DataFrame, table: str) -> DataFrame:
    """The declared columns and the keys that are stored a second time."""
    keys = {f"{KEY_PREFIX}{k}": key_column(k) for k in KEYS[table] if k in NULL_EQUALS_EMPTY}
    return df.select(*typed_schema(table).names, *[c.alias(n) for n, c in keys.items()])


def write_bucketed(df: DataFrame, root: str, table: str, buckets: int = BUCKETS) -> None:
    """Write a fact in buckets, one file each; this shuffles it once."""
    rows = _with_keys(df, table)
    _write(rows.repartition(buckets, *_bucket_columns(table)), _folder(root, table, buckets), table, buckets)


def read_bucketed(spark: SparkSession, root: str, table: str, buckets: int = BUCKETS) -> DataFrame:
    """A fact written in buckets."""
    return _stored(spark, _folder(root, table, buckets), table, buckets).select(*typed_schema(table).names)


def merge_bucketed(
    source: DataFrame,
    root: str,
    table: str,
    now: datetime | Column,
    buckets: int = BUCKETS,
    copy_audit: bool = False,
) -> None:
    """Merge rows, unique per key, into a fact written in buckets.

    The result is written to the shared scratch folder and copied from there, bucket by bucket, so a failed merge leaves
    the table or can be run again.
    """
    spark, path, staged = source.sparkSession, _folder(root, table, buckets), scratch_path(source.sparkSession, table)
    merged = merge_table(_stored(spark, path, table, buckets), source, table, now, copy_audit, buckets)
    _write(_with_keys(merged, table), staged, table, buckets)
    _write(_stored(spark, staged, table, buckets), path, table, buckets)
    spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(staged)}")
