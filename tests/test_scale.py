"""Plan shapes and skewed data: one key holds a third of all rows."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import at, one, rows
from pyspark.sql import functions as F

from freightlens.operators import bitmaps, filters, joins, kpis, merge, quality, shaping
from freightlens.schemas import KEYS, typed_schema
from freightlens.plans.registry import Bound
from freightlens.sources import bucketed, warehouse

N = 6000


def _aligned(df, table):
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in typed_schema(table)
        ]
    )


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Shipments and events where shipment S0 and customer 0 hold a third of all rows, as warehouse tables."""
    root = str(tmp_path_factory.mktemp("skew"))
    hot = "id % 3 = 0"
    ship = spark.range(N).selectExpr(
        f"concat('S', IF({hot}, 0, id % 500)) AS shipment_id", "CAST(id AS INT) AS leg_id",
        f"IF({hot}, 0, id % 40) AS customer_id", "id % 7 AS carrier_id", "id % 5 AS lane_id",
        "IF(id % 11 = 0, NULL, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 90 AS INT))) "
        "AS delivery_actual_ts", "timestamp_ntz'2024-02-01 00:00:00' AS delivery_plan_ts",
        "10.00 AS revenue", "4.00 AS total_cost", "3.00 AS planned_miles", "'Delivered' AS status",
        "id % 2 = 0 AS isinfull", "timestamp_ntz'2024-01-01 00:00:00' AS update_date",
    )
    events = spark.range(N).selectExpr(
        f"concat('S', IF({hot}, 0, id % 600)) AS shipment_id", "CAST(id AS INT) AS event_seq",
        "IF(id % 4 < 2, 'Exception', 'Tendered') AS event_type", "timestamp_ntz'2024-01-05 00:00:00' AS event_ts",
        "IF(id % 8 = 0, NULL, concat('N', id % 3)) AS notes", "timestamp_ntz'2024-01-01 00:00:00' AS update_date",
    )
    customers = spark.range(50).selectExpr("id AS customer_id", "concat('C', id) AS name")
    for name, df in (("fact_shipment", ship), ("fact_event", events), ("dim_customer", customers)):
        warehouse.write_table(_aligned(df, name), root, name)
    return {t: warehouse.read_edw(spark, root, t) for t in ("fact_shipment", "fact_event", "dim_customer")}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_shipment_heatmap(skewed):
    """2,000 exceptions by 2,000 legs on one shipment would be millions of joined rows; counts give the same."""
    ship, events = skewed["fact_shipment"], skewed["fact_event"]
    got = {(c, t): n for c, t, n in rows(kpis.exception_heatmap(events, ship, skewed["dim_customer"]))}
    legs = Counter((r.shipment_id, r.customer_id) for r in ship.collect())
    per_type = Counter((r.shipment_id, r.notes or "Unknown") for r in events.collect() if r.event_type == "Exception")
    expected = Counter()
    for (s, t), n in per_type.items():
        for (s2, c), m in legs.items():
            if s == s2:
                expected[f"C{c}", t] += n * m
    assert got == dict(expected)
    pairs = joins.join_events_to_shipments(joins.exception_events(events), ship, "customer_id")
    assert pairs.count() < 10 * N


def test_hot_shipment_rates_and_coverage(skewed):
    ship, events = skewed["fact_shipment"], skewed["fact_event"]
    data = ship.collect()
    done = {r.shipment_id for r in data if r.delivery_actual_ts}
    plan_end = at("2024-02-01T01:00:00")
    punctual = {r.shipment_id for r in data if r.delivery_actual_ts and r.delivery_actual_ts <= plan_end}
    row = one(kpis.otd_otif_rates(ship))
    assert (row.delivered_shipments, row.otd_deliveries) == (len(done), len(punctual))
    known = {r.shipment_id for r in data}
    lost = sum(r.shipment_id not in known for r in events.collect())
    assert lost > 0
    assert dict(rows(quality.child_coverage(events, events, ship))) == {
        "COST -> SHIPMENT": lost, "EVENT -> SHIPMENT": lost,
    }


@pytest.mark.parametrize("partitions", ["1", "7", "200"])
def test_dwell_of_a_hot_shipment_against_brute_force(spark, partitions):
    """Gaps, repeated numbers and missing times, with one shipment that spans many partitions."""
    rng = random.Random(int(partitions))
    kinds = ("DwellStart", "DwellEnd", "PickedUp")
    data = []
    for n in range(3000):
        shipment = "S0" if n % 3 == 0 else f"S{rng.randrange(1, 60)}"
        stamp = None if rng.random() < 0.02 else datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(10**6))
        data.append((shipment, rng.randrange(5000), rng.choices(kinds, (5, 4, 2))[0], stamp))
    data += data[:20]
    expected = {}
    for s in {r[0] for r in data}:
        own = sorted((q, t is not None, t or datetime.min, k == "DwellEnd") for x, q, k, t in data if x == s and k != "PickedUp")
        pairs, minutes, used = 0, 0, 0
        for (_, has, start, end), (_, has2, stop, end2) in zip(own, own[1:]):
            if not end and end2:
                pairs, used = pairs + 1, used + 2
                minutes += (stop - start) // timedelta(minutes=1) if has and has2 else 0
        if own:
            expected[s] = (minutes, pairs, len(own) - used)
    events = spark.createDataFrame(data, "shipment_id string, event_seq int, event_type string, event_ts timestamp_ntz")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r[0]: tuple(r)[1:] for r in kpis.dwell_minutes(events.repartition(5)).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == expected


def test_hot_key_dedupe_limits_before_the_shuffle(skewed):
    latest = shaping.dedupe_latest(skewed["fact_event"], ["shipment_id"], ["event_ts", "event_seq"])
    data = skewed["fact_event"].collect()
    expected = {}
    for r in data:
        expected[r.shipment_id] = max(expected.get(r.shipment_id, -1), r.event_seq)
    assert dict(rows(latest, "shipment_id", "event_seq")) == expected
    text = plan(latest)
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[shuffle:], "rows are limited per key below the exchange"


def test_merge_is_one_join(spark, skewed):
    target = skewed["fact_shipment"]
    source = target.filter("leg_id = 7").withColumn("status", F.lit("Exception"))
    text = plan(merge.merge_fact(target, source, KEYS["fact_shipment"], at("2024-06-01")))
    assert text.count("FileScan parquet") == 2 and text.count("Join") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_window_kpi_reads_the_fact_once(skewed):
    for df in (kpis.otd_windows(skewed["fact_shipment"]), kpis.gm_per_mile_ytd(skewed["fact_shipment"]),
               kpis.daily_trend(skewed["fact_shipment"])):
        assert plan(df).count("FileScan parquet") == 1


def test_bounds_enter_as_scalars_and_columns_are_pruned(spark, skewed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    ship = skewed["fact_shipment"]
    text = plan(kpis.avg_transit_days(ship, filters.bounds(ship)))
    assert "NestedLoop" not in text and "Cartesian" not in text
    scans = [line for line in text.split("\n") if "FileScan" in line]
    assert any(">= Subquery" in line.split("Format")[0] for line in scans), "the range reaches the scan"
    scan = text[text.index("ReadSchema"):].split("\n")[0]
    assert "delivery_actual_ts" in scan and "revenue" not in scan


def test_date_filters_reach_the_scan(spark, skewed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    ship = filters.apply_filters(skewed["fact_shipment"], {}, date_start=at("2024-01-10").date(),
                                 date_end=at("2024-01-20").date())
    text = plan(ship)
    assert "GreaterThanOrEqual(delivery_actual_ts,2024-01-10T00:00)" in text
    assert "LessThan(delivery_actual_ts,2024-01-21T00:00)" in text


def test_distinct_counts_share_one_shuffle(skewed):
    text = plan(kpis.tender_acceptance_events(skewed["fact_event"]))
    assert "Expand" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_fk_checks_read_the_fact_once(spark, skewed):
    dims = {
        "dim_customer": skewed["dim_customer"],
        **{t: spark.range(5).toDF(k) for t, k in (("dim_carrier", "carrier_id"), ("dim_equipment", "equipment_id"),
                                                  ("dim_location", "loc_id"), ("dim_lane", "lane_id"))},
    }
    coverage = quality.fk_coverage(skewed["fact_shipment"], dims)
    assert plan(coverage).count("carrier_id#") and plan(coverage).count("fact_shipment") == 1
    missing = dict(rows(coverage))
    assert missing["CARRIER_ID"] == sum(i % 7 > 4 for i in range(N)) and missing["CUSTOMER_ID"] == 0


def test_stored_star_joins_its_lines_once(spark, tmp_path):
    """Facts of a star over stored lines are read from files, without the joins."""
    day = "TIMESTAMP_NTZ '2024-01-01'"
    tables = {
        "lineitem": f"id % 30 AS l_orderkey, CAST(id % 3 AS INT) AS l_linenumber, {day} + make_dt_interval(CAST(id AS INT)) AS l_shipdate, "
        "id AS l_partkey, id % 4 AS l_suppkey, CAST(id % 50 AS DOUBLE) AS l_quantity, id * 1.5D AS l_extendedprice, 'R' AS l_returnflag, "
        "'F' AS l_linestatus, 0.05D AS l_discount, 0.04D AS l_tax",
        "orders": f"id AS o_orderkey, id % 5 AS o_custkey, {day} AS o_orderdate, 'F' AS o_orderstatus, '1-URGENT' AS o_orderpriority",
        "customer": "id AS c_custkey, CAST(id AS INT) AS c_nationkey",
    }
    for name, columns in tables.items():
        spark.range(90 if name == "lineitem" else 30).createOrReplaceTempView("ids")
        spark.sql(f"SELECT {columns} FROM ids").write.parquet(str(tmp_path / f"{name}.parquet"))
    bound = Bound(spark, str(tmp_path))
    for fact in ("fact_shipment", "fact_event", "fact_cost"):
        text = plan(bound.stored_star[fact])
        assert "Exchange" not in text and "Join" not in text and text.count("FileScan parquet") == 1
    costs = rows(bound.stored_star["fact_cost"])
    assert len(costs) > 30 and costs == rows(bound.star["fact_cost"])


def test_bitmaps_are_made_after_the_shuffle(skewed):
    """Before it a row is a day and a number; a bitmap of 4 KB for each would fill a map task."""
    text = plan(bitmaps.otd_otif_rates(bitmaps.delivery_bitmaps(skewed["fact_shipment"]), *[F.lit(d).cast("date") for d in ("2024-01-01", "2024-12-31")]))
    assert "bitmap_construct_agg" not in text[text.index("hashpartitioning(stretch"):]
    assert "bitmap_construct_agg" in text


def test_larger_tables_have_more_buckets():
    assert [bucketed.buckets_for(n, 8) for n in (0, 4_000_000, 4_000_001, 216_000_000)] == [8, 8, 9, 432]


def test_a_crowded_cell_is_dealt_out(spark, monkeypatch):
    """Places that all lie in one cell of the grid meet in many tasks."""
    monkeypatch.setattr(joins, "PLACES_PER_HEAP", 3, raising=False)
    places = spark.createDataFrame([(i, 90.0 - i % 7 / 1000, float(i)) for i in range(60)], "loc_id long, lat double, lon double")
    found = joins.places_within(places, places, 50)
    assert found.count() == 3600 and found.columns == ["o_loc_id", "o_lat", "o_lon", "d_loc_id", "d_lat", "d_lon", "miles"]
    assert "_heap" in plan(found)
