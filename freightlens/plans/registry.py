"""Registered queries: each operator over the bound test tables, with the same result stated in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.plans import binding
from freightlens.plans.oracle import with_binding
from freightlens.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Bound:
    """The test tables of one folder and the star over them, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return binding.table(self.spark, self.sf_dir, name)

    @cached_property
    def star(self) -> binding.BoundStar:
        return binding.bind_star(self.spark, self.sf_dir)

    @cached_property
    def stored_star(self) -> binding.BoundStar:
        """The star over lines written once, for queries that write several of its tables."""
        return binding.bind_star(self.spark, self.sf_dir, stored=True)

    @property
    def legs(self) -> DataFrame:
        return self.star.legs()

    @property
    def ship(self) -> DataFrame:
        return self.star["fact_shipment"]

    @property
    def events(self) -> DataFrame:
        return self.star["fact_event"]

    @property
    def cost(self) -> DataFrame:
        return self.star["fact_cost"]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the one type both engines return alike."""
    decimals = {n: F.col(n).cast("double") for n, t in df.dtypes if t.startswith("decimal")}
    return df.withColumns(decimals) if decimals else df


def register(
    sql: str | None = None, extra: str = "", bound: bool = True
) -> Callable[[Callable[[Bound], DataFrame]], Callable[[Bound], DataFrame]]:
    """Register a function of the bound tables under its own name; ``sql`` is the oracle's query."""

    def add(fn: Callable[[Bound], DataFrame]) -> Callable[[Bound], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Bound(spark, sf_dir)))

        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = with_binding(sql, extra) if bound else sql.strip()
        return fn

    return add
