"""Daily totals of shipments that merges keep up to date, and the reports that read days only.

A merge tells what it replaces: of the keys of its batch the rows before and the rows after.  Their day totals, taken away
and added, are the batch's share, written under the batch's name before the table is touched.  So a batch that runs again
finds its share written and leaves it, whether or not the first run came to write the table.  The totals are the sum of
all shares.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.functions.measures import GRACE_MINUTES
from freightlens.operators import kpis
from freightlens.plans.refresh import merge_into
from freightlens.schemas import typed_schema
from freightlens.sources.warehouse import give_back, put_aside

_SUMS = ("n", "on_time", "moved", "transit_days", "revenue", "total_cost", "planned_miles")
_MONEY = _SUMS[4:]
SCHEMA = "d date, " + ", ".join(f"{c} {'decimal(38,2)' if c in _MONEY else 'bigint'}" for c in _SUMS)


class DailyTotals:
    """The daily totals below ``root``, of shipments in ``root/fact_shipment``.

    ``grace`` is part of the totals; totals for another one are kept apart.  A batch's name must always mean the same rows.
    """

    def __init__(self, spark: SparkSession, root: str, grace: int = GRACE_MINUTES):
        self.spark, self.root, self.grace = spark, root, grace
        self.folder = f"{root}/fact_shipment_daily_{grace}"

    def _shares(self, folder: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(folder)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def add(self, batch: str, before: DataFrame, after: DataFrame) -> None:
        """Write the share of a batch from the rows it replaces and those that replace them; days that do not change are
        left out.  A batch that has its share keeps it."""
        folder = f"{self.folder}/batch={batch}"
        if self._shares(folder).inputFiles():
            return
        gone, come = kpis.day_totals(before, self.grace), kpis.day_totals(after, self.grace)
        signed = come.unionByName(gone.select("d", *[(-F.col(c)).alias(c) for c in _SUMS]))
        share = _summed(signed).where(" OR ".join(f"{c} <> 0" for c in _SUMS))
        # A row per day, in one file: it is there or not.
        share.repartition(1).write.mode("overwrite").parquet(folder)

    def merge(self, batch: str, source: DataFrame, now: datetime | Column) -> None:
        """Merge shipments, unique per key, into the table and the totals.

        The batch is computed once and lies in the scratch folder meanwhile, so that a large one is merged in slices.
        """
        rows, path = put_aside(source.select(*typed_schema("fact_shipment").names), "batch")
        feed = lambda before, after: self.add(batch, before, after)
        merge_into(rows, self.root, "fact_shipment", now, feed=feed, stored=True)
        give_back(self.spark, path)

    def days(self) -> DataFrame:
        """The totals of every day with a delivery."""
        return _summed(self._shares(self.folder).select("d", *_SUMS)).where("n > 0")

    def otd_windows(self) -> DataFrame:
        return kpis.otd_windows_of_days(self.days(), self.grace)

    def daily_trend(self, days: int = 60) -> DataFrame:
        return kpis.daily_trend_of_days(self.days(), days)

    def gm_per_mile_ytd(self) -> DataFrame:
        return kpis.gm_per_mile_ytd_of_days(self.days())

    def avg_transit_days(self) -> DataFrame:
        return kpis.avg_transit_days_of_days(self.days())


def _summed(shares: DataFrame) -> DataFrame:
    return shares.groupBy("d").agg(*[F.sum(c).cast("decimal(38,2)" if c in _MONEY else "bigint").alias(c) for c in _SUMS])
