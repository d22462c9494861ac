"""Warehouse tables as Parquet folders.

A dimension is one folder.  A fact is partitioned by the month of the table's own time (``PART_TIMES``): a window on that
time reads its months only, and a merge rewrites only the months it touches, by dynamic partition overwrite.

A merge finds the months that hold its keys in the table's key index: which key is in which month, partitioned by a hash
of the key, so a batch reads the index partitions of its own keys and not the keys of the table.  The index may name a
month that no longer holds a key, never the other way round: it is appended to before the table is written.

What replaces rows is written to the shared scratch folder first and copied from there.  A job that fails before the copy
leaves the table as it was; one that fails in it is completed by running it again, as a repeated merge changes nothing.
One writer per table at a time; a frame read before a merge is read again after it, as its months' files are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.operators.quality import row_counts
from freightlens.schemas import TABLES, typed_schema
from freightlens.session import scratch_path

#: Times whose month makes the partitions of a table.  An update may move a row to another month.
PART_TIMES = {"fact_shipment": "tender_ts", "fact_event": "event_ts", "fact_cost": "load_date"}
MONTH, BUCKET = "part_month", "part_bucket"
#: Marks the row that stands for a month which a merge has left empty: an overwrite replaces months, it cannot drop one.
_VOID = "part_void"
#: Partitions of a key index.  More of them make a small batch read less and a large one write more files.
KEY_BUCKETS = 64
#: A merge of stored rows with more than so many rows takes them in so many slices of keys, each a job: the shuffle files
#: of one slice lie on disk, not those of all.  The count is fixed, as each slice reads the months again.
SLICE_ROWS, SLICES = 5_000_000, 4
#: Such a merge makes no key index where there is none if its batch has a row for so many of the table's, or more rows.
INDEX_ROWS = 20
_LAYOUT = T.StructType([T.StructField(_VOID, T.BooleanType()), T.StructField(MONTH, T.IntegerType())])


def month_of(table: str) -> Column:
    """The partition that a row belongs to, as the number yyyymm; null without a time."""
    time = F.col(PART_TIMES[table])
    return (F.year(time) * 100 + F.month(time)).cast("int")


def _in(c: str, values: Sequence[int | None]) -> Column:
    known = F.col(c).isin([v for v in values if v is not None])
    return known | F.col(c).isNull() if None in values else known


def _stored(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame | None:
    """The files below a path, None where there is no such folder."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _table(spark: SparkSession, root: str, table: str, audit: bool = True) -> DataFrame | None:
    """A fact's rows with its partition column, or a dimension's rows."""
    if table not in TABLES:
        return _stored(spark, f"{root}/{table}", None)
    schema = typed_schema(table, audit)
    if table not in PART_TIMES:
        return _stored(spark, f"{root}/{table}", schema)
    stored = _stored(spark, f"{root}/{table}", T.StructType(schema.fields + _LAYOUT.fields))
    return None if stored is None else stored.where(F.col(_VOID).isNull()).drop(_VOID)


def read_edw(
    spark: SparkSession,
    root: str,
    table: str,
    audit: bool = True,
    since: date | datetime | None = None,
    until: date | datetime | None = None,
) -> DataFrame:
    """A warehouse table; a star table never written reads as empty.

    ``since`` and ``until`` (a date: that whole day) bound the table's own time, both included; other months are not
    read, and rows without that time are left out.
    """
    stored = _table(spark, root, table, audit)
    if stored is None:
        if table not in TABLES:
            raise FileNotFoundError(f"no table {table} below {root}")
        return spark.createDataFrame([], typed_schema(table, audit))
    if table not in PART_TIMES:
        if since or until:
            raise ValueError(f"{table} has no time of its own")
        return stored
    time = F.col(PART_TIMES[table])
    if since is not None:
        stored = stored.where((F.col(MONTH) >= since.year * 100 + since.month) & (time >= F.lit(since).cast("timestamp_ntz")))
    if until is not None:
        end = F.lit(until).cast("timestamp_ntz")
        below = time <= end if isinstance(until, datetime) else time < end + F.expr("INTERVAL 1 DAY")
        stored = stored.where((F.col(MONTH) <= until.year * 100 + until.month) & below)
    return stored.drop(MONTH)


def _declared(df: DataFrame, table: str) -> DataFrame:
    """The rows with the table's declared types, audit columns if they have them; other columns are an error."""
    if table not in TABLES:
        return df
    for audit in (True, False):
        schema = typed_schema(table, audit)
        if set(df.columns) == set(schema.names):
            return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    raise ValueError(f"{table}: the rows do not have the table's declared columns")


def _copy(df: DataFrame, path: str, mode: str, overwrite: str = "static") -> None:
    """Write rows as they lie in their partitions: rows that come from files of one month each need no shuffle."""
    writer = df.write.partitionBy(MONTH) if MONTH in df.columns else df.write
    writer = writer.option("compression", "zstd")
    writer.mode(mode).option("partitionOverwriteMode", overwrite).parquet(path)


def _save(df: DataFrame, path: str, table: str, mode: str, overwrite: str = "static") -> None:
    """Write rows, a fact's with its partition column.

    Rows of a month are brought together first, in pieces of the session's advisory size: a month is neither as many
    small files as there are tasks nor the work of a single one.  A dynamic overwrite takes rows that were staged so.
    """
    if MONTH in df.columns and overwrite == "static":
        df = df.hint("rebalance", F.col(MONTH))
    _copy(df, path, mode, overwrite)


def put_aside(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Rows written to the scratch folder, read from there, and their path, for :func:`give_back`."""
    path = scratch_path(df.sparkSession, label)
    _copy(df, path, "errorifexists")
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def give_back(spark: SparkSession, path: str) -> None:
    """Give back the room of a scratch folder that has been copied: its files are replaced by one without rows."""
    spark.createDataFrame([], "none int").write.mode("overwrite").parquet(path)


def _laid_out(df: DataFrame, table: str) -> DataFrame:
    """A fact's rows with their partition; the model zone's costs have no load time, and so one partition."""
    if table not in PART_TIMES:
        return df
    known = PART_TIMES[table] in df.columns
    return df.withColumn(MONTH, month_of(table) if known else F.lit(None).cast("int"))


def write_table(
    df: DataFrame,
    root: str,
    table: str,
    mode: str = "overwrite",
    by_month: bool = True,
    own: bool = True,
    lie: bool = False,
) -> None:
    """Write a table: ``overwrite`` replaces its rows, ``append`` adds to them.

    Rows that replace others may be read from the table itself; they pass through the scratch folder, so that a failed job
    leaves the table.  Without ``own`` they are written at once: they come from elsewhere, and a failed job is run again.
    Without ``by_month`` a fact is one folder, for tables that are read whole and never merged into.  A fact's rows that
    ``lie`` in files of one month each need no shuffle.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark, path, rows = df.sparkSession, f"{root}/{table}", _declared(df, table)
    if by_month:
        rows = _laid_out(rows, table)
    if own and mode == "overwrite" and _table(spark, root, table) is not None:
        staged = scratch_path(spark, table)
        _save(rows, staged, table, "errorifexists")
        _copy(spark.read.schema(rows.schema).parquet(staged), path, mode)
        give_back(spark, staged)
    elif lie:
        _copy(rows, path, mode)
    else:
        _save(rows, path, table, mode)
    if table in PART_TIMES:
        _forget_keys(spark, root, table)


# --- the key index ------------------------------------------------------------------------------------------------


def _index_path(root: str, table: str) -> str:
    return f"{root}/{table}_keys"


def _entries(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Key columns k0, k1, ..., the month (of a column that ``df`` has) and the index partition."""
    named = {f"k{i}": k for i, k in enumerate(keys)}
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int")
    return df.select(*[k.alias(n) for n, k in named.items()], F.col(MONTH), bucket.alias(BUCKET))


def _forget_keys(spark: SparkSession, root: str, table: str) -> None:
    """Empty a table's key index if there is one: the next merge makes it again."""
    path = _index_path(root, table)
    if _stored(spark, path, T.StructType([T.StructField(MONTH, T.IntegerType())])) is not None:
        none = spark.createDataFrame([], f"k0 string, {BUCKET} int")
        none.write.partitionBy(BUCKET).mode("overwrite").parquet(path)


def key_index(spark: SparkSession, root: str, table: str, keys: Sequence[Column]) -> DataFrame:
    """The key index of a fact, made from the whole table where there is none."""
    path, rows = _index_path(root, table), _table(spark, root, table)
    if rows is None:
        rows = spark.createDataFrame([], typed_schema(table)).withColumn(MONTH, F.lit(None).cast("int"))
    entries = _entries(rows, keys)
    stored = _stored(spark, path, entries.schema)
    if stored is None or not stored.inputFiles():
        entries.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).mode("overwrite").parquet(path)
        stored = spark.read.schema(entries.schema).parquet(path)
    return stored


def _has_index(spark: SparkSession, root: str, table: str) -> bool:
    index = _stored(spark, _index_path(root, table), T.StructType([T.StructField(MONTH, T.IntegerType())]))
    return index is not None and bool(index.inputFiles())


def holding_months(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The index entries of some keys (entries themselves), from the index partitions that these are in.

    The list of partitions comes to the driver: ``KEY_BUCKETS`` numbers at most.
    """
    buckets = [r[0] for r in wanted.select(BUCKET).distinct().collect()]
    keys = [c for c in wanted.columns if c.startswith("k")]
    return index.where(F.col(BUCKET).isin(buckets)).join(wanted.select(BUCKET, *keys), [BUCKET, *keys], "left_semi")


# --- merges -------------------------------------------------------------------------------------------------------


def _months(df: DataFrame) -> set[int | None]:
    """One number per month comes to the driver."""
    return {r[0] for r in df.select(MONTH).distinct().collect()}


def update_table(
    source: DataFrame,
    root: str,
    table: str,
    keys: Sequence[Column],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    feed: Callable[[DataFrame, DataFrame], None] | None = None,
    stored: bool = False,
) -> list[int | None] | None:
    """Merge ``source`` into a table and return the months that were rewritten; None if there was nothing to merge, an
    empty list for a dimension.

    ``merge(target, source)`` gives the rows that replace the target's.  Of a fact, only months that hold a key of the
    source or that one of its rows belongs to are read and rewritten.  ``feed(before, after)`` is called before the table
    is touched, with the fact's rows of the source's keys as they are and as they will be.  The source is read for its keys,
    its months and its rows; one that is not ``stored`` in files is kept in memory for that.
    """
    if stored:
        return _update(source, root, table, keys, merge, feed, stored)
    source = source.persist()
    try:
        return _update(source, root, table, keys, merge, feed)
    finally:
        source.unpersist()


def _update(
    source: DataFrame,
    root: str,
    table: str,
    keys: Sequence[Column],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    feed: Callable[[DataFrame, DataFrame], None] | None,
    stored: bool = False,
) -> list[int | None] | None:
    spark = source.sparkSession
    if source.isEmpty():
        return None
    if table not in PART_TIMES:
        write_table(merge(read_edw(spark, root, table), source), root, table)
        return []
    comes = _entries(source.withColumn(MONTH, month_of(table)), keys)
    target = _table(spark, root, table)
    if target is None:
        # Known to be empty when planned, so that nothing is shuffled to meet it.
        none = spark.createDataFrame([], typed_schema(table)).where(F.lit(False))
        if feed is not None:
            feed(none, merge(none, source))
        for i, part in enumerate(_slices(source, none, keys, merge, stored)):
            _save(_laid_out(part, table), f"{root}/{table}", table, "append" if i else "overwrite")
        return sorted(_months(comes), key=str)
    if stored and not _has_index(spark, root, table) and _is_large(source, target):
        # Most months are its own; what the others hold is read from them, and the next small batch makes the index.
        fresh, touched = None, _months(comes)
        others = sorted(_months(target) - touched, key=str)
        if others:
            lie, mine = _entries(target.where(_in(MONTH, others)), keys), [c for c in comes.columns if c != MONTH]
            touched |= _months(lie.join(comes.select(*mine), mine, "left_semi"))
    else:
        index = key_index(spark, root, table, keys)
        known = holding_months(index, comes)
        touched = _months(comes) | _months(known)
        fresh = comes.join(known, [F.equal_null(comes[c], known[c]) for c in comes.columns], "left_anti").distinct()
    old = target.where(_in(MONTH, sorted(touched, key=str))).drop(MONTH)
    staged = scratch_path(spark, table)
    for part in _slices(source, old, keys, merge, stored):
        _save(_laid_out(part, table), staged, table, "append")
    rows = spark.read.schema(T.StructType(typed_schema(table).fields + _LAYOUT.fields)).parquet(staged)
    if feed is not None:
        mine = source.select(*[k.alias(f"_key{i}") for i, k in enumerate(keys)])
        same = [F.col(f"_key{i}") == k for i, k in enumerate(keys)]
        before, after = (df.select(*typed_schema(table).names).join(mine, same, "left_semi") for df in (old, rows))
        feed(before, after)
    left = touched - _months(rows)
    if left:
        void = spark.createDataFrame([(True, m) for m in left], _LAYOUT)
        rows = rows.unionByName(void, allowMissingColumns=True)
    # Entries first: an entry without a row costs a look into its month, a row without an entry would be lost to merges.
    if fresh is not None:
        fresh.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).mode("append").parquet(_index_path(root, table))
    _save(rows, f"{root}/{table}", table, "overwrite", "dynamic")
    give_back(spark, staged)
    return sorted(touched, key=str)


def _is_large(source: DataFrame, target: DataFrame) -> bool:
    """Whether a batch goes in slices and reaches so far that a key index would cost more than it saves."""
    comes, held = source.count(), target.count()
    return comes + held > SLICE_ROWS and comes * INDEX_ROWS >= held


def _slices(
    source: DataFrame,
    old: DataFrame,
    keys: Sequence[Column],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    stored: bool,
) -> Iterator[DataFrame]:
    """The merged rows, of many stored rows one slice of keys after another.  Counts come from the files' footers."""
    if not stored or source.count() + old.count() <= SLICE_ROWS:
        yield merge(old, source)
        return
    dealt = F.pmod(F.xxhash64(*keys), F.lit(SLICES))
    for i in range(SLICES):
        yield merge(old.where(dealt == i), source.where(dealt == i))


def publish_snapshot(spark: SparkSession, src: str, dst: str, tables: Sequence[str] = TABLES) -> DataFrame:
    """Copy warehouse tables to a reporting zone and list their row counts there."""
    for table in tables:
        write_table(read_edw(spark, src, table), dst, table, lie=True)
    return row_counts({t: read_edw(spark, dst, t) for t in tables})
