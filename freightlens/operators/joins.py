"""Joins of the star.

No join carries a broadcast hint: Spark broadcasts a dimension whose measured size is below its threshold and
shuffles it otherwise, so a dimension that grows with the data is never forced onto every executor.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions import measures, rating


def join_lane_locations(lane: DataFrame, loc: DataFrame) -> DataFrame:
    """Lanes with the city at both ends (the location dimension plays two roles) and the lane label."""
    origin = loc.select(F.col("loc_id").alias("origin_loc_id"), F.col("city").alias("origin_city"))
    dest = loc.select(F.col("loc_id").alias("dest_loc_id"), F.col("city").alias("dest_city"))
    return (
        lane.join(origin, "origin_loc_id")
        .join(dest, "dest_loc_id")
        .select(
            *lane.columns,
            "origin_city",
            "dest_city",
            measures.lane_label(F.col("origin_city"), F.col("dest_city")).alias("lane_label"),
        )
    )


def lane_labels(lane: DataFrame, loc: DataFrame) -> DataFrame:
    return join_lane_locations(lane, loc).select("lane_id", "lane_label")


def enrich_shipments(
    ship: DataFrame, customer: DataFrame, carrier: DataFrame, lane: DataFrame, loc: DataFrame
) -> DataFrame:
    """Shipments with customer and carrier names and the lane label (inner joins: unknown keys drop).

    The lane joins the fact first and its two cities after it, each dimension on its own, so each is small enough
    by Spark's own estimate to be broadcast and the fact is not shuffled for any of them.
    """
    names = customer.select("customer_id", F.col("name").alias("customer_name"))
    carriers = carrier.select("carrier_id", F.col("name").alias("carrier_name"))
    ends = lane.select(
        "lane_id", F.col("origin_loc_id").alias("_lane_origin"), F.col("dest_loc_id").alias("_lane_dest")
    )
    origin = loc.select(F.col("loc_id").alias("_lane_origin"), F.col("city").alias("_origin_city"))
    dest = loc.select(F.col("loc_id").alias("_lane_dest"), F.col("city").alias("_dest_city"))
    return (
        ship.join(names, "customer_id")
        .join(carriers, "carrier_id")
        .join(ends, "lane_id")
        .join(origin, "_lane_origin")
        .join(dest, "_lane_dest")
        .select(
            *ship.columns,
            "customer_name",
            "carrier_name",
            measures.lane_label(F.col("_origin_city"), F.col("_dest_city")).alias("lane_label"),
        )
    )


def exception_events(events: DataFrame) -> DataFrame:
    """Exception events with their type read from the notes."""
    return events.filter(F.col("event_type") == "Exception").withColumn(
        "exception_type", measures.exception_type(F.col("notes"))
    )


def join_events_to_shipments(
    events: DataFrame, ship: DataFrame, by: str, dedupe_legs: bool = False
) -> DataFrame:
    """Exception events joined to shipments on ``shipment_id`` alone, counted per shipment, type and ``by`` column.

    A shipment with several legs repeats its events once per leg, as the plain join would.  Both sides are counted
    per key before they meet and the counts are multiplied, so a shipment with very many events or legs does not
    produce the pairs themselves.  ``dedupe_legs`` counts each event once per distinct ``by`` value instead.
    """
    per_type = events.groupBy("shipment_id", "exception_type").agg(F.count(F.lit(1)).alias("_events"))
    per_leg = ship.groupBy("shipment_id", by).agg(F.count(F.lit(1)).alias("_legs"))
    weight = F.col("_events") if dedupe_legs else F.col("_events") * F.col("_legs")
    return per_type.join(per_leg, "shipment_id").select(
        "shipment_id", "exception_type", by, weight.alias("exceptions")
    )


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
            null_is_orphan: bool = True) -> DataFrame:
    """Child rows without a parent; null keys count unless ``null_is_orphan`` is off."""
    if not null_is_orphan:
        child = child.filter(F.col(key).isNotNull())
    return child.join(parent.select(F.col(parent_key or key).alias(key)), key, "left_anti").select(*child.columns)


def with_scalars(df: DataFrame, one_row: DataFrame, *columns: str) -> DataFrame:
    """Append the values of a one-row frame to every row, as scalar subqueries."""
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in columns or one_row.columns])


def null_equal(a: Column, b: Column) -> Column:
    """Key equality where null and the empty string are the same."""
    return F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit(""))


def lane_pairs(routes: DataFrame, loc: DataFrame) -> DataFrame:
    """The routes (origin_loc_id, dest_loc_id) between different cities, with distance and planned truckload days.

    ``routes`` is any table that names pairs in use, such as shipments; repeated pairs count once.  Locations join it by
    key, so the result is as long as the list of pairs, never the square of the hubs.
    """

    def side(kind: str, prefix: str) -> DataFrame:
        return loc.filter(F.col("type") == kind).select(
            *[F.col(c).alias(f"{prefix}_{c}") for c in ("loc_id", "city", "lat", "lon")]
        )

    pairs = routes.select(F.col("origin_loc_id").alias("o_loc_id"), F.col("dest_loc_id").alias("d_loc_id")).distinct()
    miles = rating.haversine_miles(F.col("o_lat"), F.col("o_lon"), F.col("d_lat"), F.col("d_lon"))
    return (
        pairs.join(side("Origin", "o"), "o_loc_id")
        .join(side("Dest", "d"), "d_loc_id")
        .filter(F.col("o_city") != F.col("d_city"))
        .withColumn("miles", miles)
        .withColumn("std_transit_days", rating.transit_bucket(F.col("miles"), F.lit("TL")))
    )


def _grid(miles: float) -> tuple[float, Column, Column]:
    """Height of a latitude band in degrees, the last band, and (of a column ``band``) its number of cells.

    Places within ``miles`` of each other lie in the same or in neighbouring bands.  A band's cells are as wide as the
    longitudes of two such places can differ at the latitude of the band that is nearest to a pole; a band that reaches
    a pole within the distance has one cell.
    """
    reach = math.degrees(miles / rating.EARTH_RADIUS_MILES) * (1 + 1e-9) + 1e-9
    low = F.col("band") * reach - 90
    edge = F.least(F.lit(90.0), F.greatest(F.abs(low), F.abs(low + reach)))
    width = F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(math.radians(min(reach, 90.0)))) / F.cos(F.radians(edge)))))
    cells = F.when(edge + reach >= 90, 1).otherwise(F.greatest(F.lit(1), F.floor(F.lit(360.0) / (width * (1 + 1e-9)))))
    return reach, F.lit(int(180 / reach)), cells.cast("long")


#: Destinations of a grid cell that one task takes at once.
PLACES_PER_HEAP = 2000


def _with_vector(df: DataFrame, prefix: str) -> DataFrame:
    """The unit vector of a place, as ``_<prefix>_x``, ``_y`` and ``_z``."""
    lat, lon = (F.radians(F.col(f"{prefix}_{c}").cast("double")) for c in ("lat", "lon"))
    vector = {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}
    return df.withColumns({f"_{prefix}_{a}": v for a, v in vector.items()})


def places_within(origins: DataFrame, dests: DataFrame, miles: float) -> DataFrame:
    """Pairs of places (loc_id, lat, lon, further columns) at most ``miles`` apart, columns prefixed ``o_`` and ``d_``, and
    their ``miles``.  A place without coordinates is near nothing.

    Places are put in the cells of a grid, and an origin meets the destinations of its own and the neighbouring cells, over
    the date line and the poles too; all pairs are never made.  The result is bounded by how many places are that near.
    The destinations of a crowded cell are dealt into heaps, which its origins meet one by one, so no cell is the work of a
    single task.  Most pairs that are too far apart are told by the product of their unit vectors, without trigonometry.
    """
    if miles < 0:
        raise ValueError("a distance is not negative")
    reach, last, cells = _grid(miles)

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.where("lat IS NOT NULL AND lon IS NOT NULL").select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])

    def band(lat: str) -> Column:
        return F.least(F.floor((F.col(lat) + 90) / reach), last)

    around = F.pmod(F.col("lon") + 180, F.lit(360.0)) / 360
    cell = F.least(F.floor(around * F.col("cells")), F.col("cells") - 1)
    held = side(dests, "d").withColumn("band", band("d_lat")).withColumn("cells", cells).withColumn("lon", F.col("d_lon"))
    held = held.withColumn("cell", cell).drop("cells", "lon")
    near = F.array_distinct(F.array(*[F.pmod(F.col("cell") + i, F.col("cells")) for i in (-1, 0, 1)]))
    asked = side(origins, "o").withColumn("band", F.explode(F.array(*[band("o_lat") + i for i in (-1, 0, 1)])))
    asked = asked.where(F.col("band").between(0, last)).withColumn("cells", cells).withColumn("lon", F.col("o_lon"))
    asked = asked.withColumn("cell", cell).withColumn("cell", F.explode(near)).drop("cells", "lon")
    crowds = held.groupBy("band", "cell").agg(F.ceil(F.count(F.lit(1)) / PLACES_PER_HEAP).alias("_heaps"))
    dealt = F.pmod(F.xxhash64(*[c for c in held.columns if c.startswith("d_")]), F.col("_heaps"))
    held = _with_vector(held.join(crowds, ["band", "cell"]).withColumn("_heap", dealt).drop("_heaps"), "d")
    asked = asked.join(crowds, ["band", "cell"]).withColumn("_heap", F.explode(F.expr("sequence(0L, _heaps - 1L)")))
    asked = _with_vector(asked.drop("_heaps"), "o")
    # A little more than the distance: rounding never loses a pair here, the distance itself decides.
    product = sum((F.col(f"_o_{a}") * F.col(f"_d_{a}") for a in "xyz"), F.lit(0.0))
    near = product >= math.cos(min(miles / rating.EARTH_RADIUS_MILES, math.pi)) - 1e-9
    apart = rating.haversine_miles(*[F.col(c).cast("double") for c in ("o_lat", "o_lon", "d_lat", "d_lon")])
    found = asked.join(held, ["band", "cell", "_heap"]).where(near).withColumn("miles", apart).where(F.col("miles") <= miles)
    return found.drop("band", "cell", "_heap", *[f"_{p}_{a}" for p in "od" for a in "xyz"])


def lanes_within(loc: DataFrame, miles: float) -> DataFrame:
    """Lanes from places alone: every origin with every destination in another city at most ``miles`` away, with distance
    and planned truckload days."""
    columns = ("loc_id", "city", "lat", "lon")
    origins, dests = (loc.filter(F.col("type") == kind).select(*columns) for kind in ("Origin", "Dest"))
    return (
        places_within(origins, dests, miles)
        .filter(F.col("o_city") != F.col("d_city"))
        .withColumn("std_transit_days", rating.transit_bucket(F.col("miles"), F.lit("TL")))
    )


def asof_weekly_price(ship: DataFrame, prices: DataFrame, ts_col: str = "pickup_plan_ts") -> DataFrame:
    """Latest quoted price (week, price) dated on or before each shipment's day; null before the first quote.

    Of prices of one date the highest counts.  The price list is reduced to one row per date, so its length is set by
    the calendar and ordering it is a small task.  It is then filled: each quote is repeated daily up to the next one,
    the last one up to the latest shipment day.  The shipments need only an equality join on the day.
    """
    last_day = ship.agg(F.to_date(F.max(ts_col)).alias("d")).scalar()
    quotes = prices.groupBy(F.to_date("week").alias("_from")).agg(F.max("price").alias("price"))
    following = F.lead("_from").over(Window.orderBy("_from"))
    daily = (
        quotes.filter(F.col("_from").isNotNull())
        .withColumn("_until", F.coalesce(F.date_sub(following, 1), F.greatest("_from", last_day)))
        .select(F.explode(F.sequence("_from", "_until", F.expr("INTERVAL 1 DAY"))).alias("_day"), "price")
    )
    return ship.withColumn("_day", F.to_date(F.col(ts_col))).join(daily, "_day", "left").drop("_day")


_ROLES = {"tender": "tender_ts", "pickup": "pickup_actual_ts", "delivery": "delivery_actual_ts"}


def join_calendar(ship: DataFrame, dim_date: DataFrame, role: str = "delivery") -> DataFrame:
    """Calendar attributes of one role's date, prefixed with the role; rows without that date keep nulls."""
    attributes = [c for c in dim_date.columns if c not in ("load_date", "update_date")]
    calendar = dim_date.select(*[F.col(c).alias(f"{role}_{c}") for c in attributes])
    return ship.join(calendar, F.to_date(F.col(_ROLES[role])) == F.col(f"{role}_date"), "left")
