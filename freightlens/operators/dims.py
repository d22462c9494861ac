"""Dimension builders: calendar, lanes and unique names."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions import rating
from freightlens.operators.joins import lane_pairs
from freightlens.session import shared_dir


def date_dim(span: DataFrame) -> DataFrame:
    """One row per day of a one-row (start, end) frame, both ends included."""
    d = F.col("date")
    return span.select(F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("date")).select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"),
        "date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        rating.week_of_year_sunday(d).alias("week"),
        F.weekday(d).alias("dow"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def weighted_dates(calendar: DataFrame, holidays: Sequence[date], eom_ramp: float) -> DataFrame:
    """Calendar rows repeated in proportion to the shipping volume of their day."""
    repeats = rating.volume_repeats(rating.volume_weight(F.col("date"), holidays, eom_ramp))
    return calendar.select("*", F.explode(F.sequence(F.lit(1), repeats)).alias("copy"))


def lane_dim(routes: DataFrame, loc: DataFrame) -> DataFrame:
    """Lanes of the given routes between different cities, numbered by (origin, destination)."""
    lanes = lane_pairs(routes, loc).withColumnsRenamed({"o_loc_id": "origin_loc_id", "d_loc_id": "dest_loc_id"})
    lanes = lanes.select("origin_loc_id", "dest_loc_id", "miles", "std_transit_days")
    return with_ordinal(lanes, "origin_loc_id", "dest_loc_id", name="lane_id").select(
        "lane_id",
        "origin_loc_id",
        "dest_loc_id",
        F.round("miles", 2).cast("decimal(10,2)").alias("standard_miles"),
        "std_transit_days",
    )


def with_ordinal(df: DataFrame, *order: str, name: str = "ordinal") -> DataFrame:
    """Number rows 1..n in the given order without a single-task window.

    Rows are range-sorted and checkpointed, so that numbering and counting see the same partitions; a row's number
    is its place in its partition plus the rows of earlier partitions (one count per partition).
    """
    shared_dir(df.sparkSession)
    placed = (
        df.sort(*order).withColumn("_place", F.monotonically_increasing_id()).checkpoint()
        .withColumn("_part", F.shiftright("_place", 33))
        .withColumn("_at", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(earlier, F.lit(0)).alias("_offset"))
    return placed.join(offsets, "_part").select(
        *df.columns, (F.col("_offset") + F.col("_at") + 1).alias(name)
    )


def surrogate_names(names: DataFrame, n: int) -> DataFrame:
    """``n`` unique names as (ordinal, name), from the distinct seed names in alphabetical order.

    When seeds run out they repeat with their ordinal appended.  Such a name differs from all others with an ordinal, as
    its last word is its own; where it equals a seed, the ordinal is padded to more digits than any seed has
    characters.  Without seeds the names are ``Company 001`` and so on.
    """
    spark = names.sparkSession
    # One row per name first: a name that repeats a billion times must not sort in one task.
    distinct = names.select(F.col(names.columns[0]).alias("seed")).filter("seed IS NOT NULL").distinct()
    seeds = with_ordinal(distinct, "seed")
    size = seeds.agg(F.count(F.lit(1)).alias("n")).scalar()
    longest = seeds.agg(F.max(F.length("seed")).alias("n")).scalar()
    slot = F.pmod(F.col("ordinal") - 1, F.nullif(size, F.lit(0))) + 1
    wanted = (
        spark.range(1, n + 1)
        .withColumnRenamed("id", "ordinal")
        .withColumn("_slot", slot)
        .join(seeds.select(F.col("ordinal").alias("_slot"), "seed"), "_slot", "left")
        .withColumn("_variant", F.concat("seed", F.lit(" "), F.col("ordinal").cast("string")))
    )
    taken = seeds.select(F.col("seed").alias("_taken"))
    padded = F.concat("seed", F.lit(" "), F.lpad(F.col("ordinal").cast("string"), longest + 1, F.lit("0")))
    return wanted.join(taken, F.col("_variant") == F.col("_taken"), "left").select(
        "ordinal",
        F.when(F.col("seed").isNull(), F.format_string("Company %03d", F.col("ordinal")))
        .when(F.col("ordinal") == F.col("_slot"), F.col("seed"))
        .when(F.col("_taken").isNull(), F.col("_variant"))
        .otherwise(padded)
        .alias("name"),
    )
