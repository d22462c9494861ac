"""Cleaning and typing of text columns.  All are built-in expressions, so they stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings of flags, and the null markers of landing files.
TRUE_WORDS = ("1", "T", "TRUE", "Y", "YES")
FALSE_WORDS = ("0", "F", "FALSE", "N", "NO")
NULL_MARKERS = ("", "NULL")
# What a regular expression takes as white space, and as the end of a last line, before which it takes it, too.
_SPACES, _LINE_ENDS = " \t\n\x0b\f\r", ("\x85", "\u2028", "\u2029")


def clean_str(c: Column) -> Column:
    """Trimmed text; empty becomes null."""
    return F.nullif(F.trim(c), F.lit(""))


def trim_spaces(c: Column) -> Column:
    """Text without white space around it.  Only text that ends a line pays for a regular expression."""
    ends_line = reduce(Column.__or__, [c.endswith(end) for end in _LINE_ENDS])
    return F.when(ends_line, F.regexp_replace(c, r"^\s+|\s+$", "")).otherwise(F.btrim(c, F.lit(_SPACES)))


def null_markers(c: Column) -> Column:
    """The landing file rule: blank and ``NULL`` are null, other text is kept as it is."""
    return F.when(~F.trim(c).isin(*NULL_MARKERS), c)


def safe_ts(c: Column) -> Column:
    """Tolerant ISO-8601 parse.  An offset is normalised to UTC (the session zone), bad text becomes null."""
    return F.try_to_timestamp(clean_str(c)).cast(T.TimestampNTZType())


def strict_ts(c: Column) -> Column:
    """As :func:`safe_ts`, but bad text fails the job."""
    return F.to_timestamp(clean_str(c)).cast(T.TimestampNTZType())


def safe_date(c: Column) -> Column:
    return clean_str(c).try_cast("date")


def ts_date(c: Column) -> Column:
    return F.to_date(c)


def to_bool(c: Column, default: bool | None = None) -> Column:
    """Flag text to boolean.  ``default`` is what unknown words and nulls become (None keeps three values)."""
    word = F.upper(F.trim(c))
    return (
        F.when(word.isin(*TRUE_WORDS), F.lit(True))
        .when(word.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(default).cast("boolean"))
    )


def to_num(c: Column, dtype: T.DataType | str) -> Column:
    """Number text straight to the declared type, so decimals keep their cents; blank is null, junk fails."""
    return clean_str(c).cast(dtype)


def typed(c: Column, dtype: T.DataType, tolerant: bool, bool_default: bool | None = None) -> Column:
    """One text column to its declared type.

    ``tolerant`` is the raw-to-model rule (bad times become null, flag words are read); otherwise the strict
    landing rule applies and bad text fails the job.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return safe_ts(c) if tolerant else strict_ts(c)
    if isinstance(dtype, T.DateType):
        return safe_date(c) if tolerant else clean_str(c).cast("date")
    if isinstance(dtype, T.BooleanType):
        return to_bool(c, bool_default) if tolerant else clean_str(c).cast("boolean")
    if isinstance(dtype, T.StringType):
        return c
    return to_num(c, dtype)
