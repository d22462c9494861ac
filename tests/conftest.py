from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from freightlens.schemas import typed_schema  # noqa: E402
from freightlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=8, memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Rows of a star table from partial dicts; absent columns are null."""

    def build(table: str, rows: list[dict], audit: bool = True):
        schema = typed_schema(table, audit)
        return spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in rows], schema)

    return build


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def one(df):
    (row,) = df.collect()
    return row
