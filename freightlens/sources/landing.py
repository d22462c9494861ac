"""Landing files: CSV with a header, comma separated, optional double quotes, gzip or plain."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.functions.clean import null_markers, typed
from freightlens.schemas import raw_schema, typed_schema

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    # Spark's writer trims text unless told not to.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
#: Rows of a compressed part file at most: it is read by one task.
ROWS_PER_FILE = 1_000_000
# Bad rows fail, also in queries that need only some of the fields.
READ_OPTIONS = {**CSV_OPTIONS, "mode": "FAILFAST", "columnPruning": "false"}


def strictly_typed(df: DataFrame, table: str, audit: bool = True) -> DataFrame:
    """Text columns of a landing table to their declared types; null markers become null, bad text fails."""
    return df.select(
        *[
            typed(null_markers(F.col(f.name)), f.dataType, tolerant=False).alias(f.name)
            for f in typed_schema(table, audit)
        ]
    )


def landing_path(spark: SparkSession, folder: str, table: str) -> list[str]:
    """The files or folders of a table in a landing folder, by name and whatever the case: ``<table>.csv``,
    ``<table>.csv.gz``, ``<table>`` or ``<table>_<part>.csv``."""
    folder = folder.rstrip("/")
    any_case = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in table)
    try:
        # Lists files; their content is not read.
        files = spark.read.format("binaryFile").load(f"{folder}/{any_case}*").select("path")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string")
    name = F.regexp_extract("path", f"/{re.escape(folder.rsplit('/', 1)[-1])}/({any_case}[^/]*)(/.*)?$", 1)
    named = re.compile(rf"{table}([_.-]?\d+)?(\.csv)?(\.gz)?", re.IGNORECASE)
    found = sorted(r[0] for r in files.select(name).distinct().collect() if named.fullmatch(r[0]))
    if not found:
        raise FileNotFoundError(f"no landing file of {table} in {folder}")
    return [f"{folder}/{n}" for n in found]


def read_raw_csv(spark: SparkSession, path: str | list[str], table: str, audit: bool = True) -> DataFrame:
    """A landing file as it is: every column a string.

    A row with the wrong number of fields fails the read, and so does a header that does not name the declared columns,
    in any case, in their order.
    """
    options = {**READ_OPTIONS, "enforceSchema": "false"}
    return spark.read.schema(raw_schema(table, audit)).options(**options).csv(path)


def read_landing_csv(spark: SparkSession, path: str | list[str], table: str, audit: bool = True) -> DataFrame:
    """A landing file with declared types."""
    return strictly_typed(read_raw_csv(spark, path, table, audit), table, audit)


def iso_utc(df: DataFrame) -> DataFrame:
    """Timestamps as ISO-8601 text with the UTC offset, the form landing files use."""
    stamps = [name for name, dtype in df.dtypes if dtype == "timestamp_ntz"]
    return df.withColumns(
        {c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")) for c in stamps}
    )


def write_csv(df: DataFrame, path: str, compression: str = "none", mode: str = "overwrite") -> None:
    """CSV with a header, one folder of part files; columns that start with ``_`` are internal and left out."""
    public = [c for c in df.columns if not c.startswith("_")]
    writer = iso_utc(df.select(*public)).write.mode(mode).options(**CSV_OPTIONS).option("compression", compression)
    if compression != "none":
        writer = writer.option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.csv(path)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Canonical lower-case column names, whatever case a load produced."""
    return df.toDF(*[c.lower() for c in df.columns])


def read_name_seeds(spark: SparkSession, path: str) -> DataFrame:
    """One name per line; blank lines and ``#`` comments are dropped."""
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    return (
        spark.read.text(path).select(line.alias("name")).filter((F.col("name") != "") & ~F.col("name").startswith("#"))
    )
