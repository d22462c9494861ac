"""Quality checks: clean data gives zero, each injected defect gives exactly one.  Dimension builders."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta

import pytest
from conftest import rows

from freightlens.operators import dims, joins, quality
from freightlens.plans import binding
from freightlens.schemas import TABLES


@pytest.fixture(scope="module")
def clean(make):
    ship = {"shipment_id": "S1", "leg_id": 1, "customer_id": 1, "carrier_id": 1, "equipment_id": 1, "origin_loc_id": 1,
            "dest_loc_id": 2, "lane_id": 1, "status": "Delivered"}
    return {
        "dim_customer": [{"customer_id": 1}],
        "dim_carrier": [{"carrier_id": 1}],
        "dim_equipment": [{"equipment_id": 1}],
        "dim_location": [{"loc_id": 1}, {"loc_id": 2}],
        "dim_lane": [{"lane_id": 1, "origin_loc_id": 1, "dest_loc_id": 2}],
        "dim_date": [{"date_key": 20240101}],
        "fact_shipment": [ship, ship | {"leg_id": 2}],
        "fact_event": [{"shipment_id": "S1", "event_seq": 1, "event_type": "Tendered"}],
        "fact_cost": [{"shipment_id": "S1", "cost_type": "Base", "calc_method": "flat", "rate_ref": None}],
    }


def star(make, data, **changes):
    return {t: make(t, changes.get(t, data[t])) for t in TABLES}


def failures(tables, *checks: str) -> dict[str, int]:
    """Non-zero findings of the named checks (all by default)."""
    ship = tables["fact_shipment"]
    frames = {
        "dup": lambda: quality.pk_duplicates(tables),
        "fk": lambda: quality.fk_coverage(ship, tables),
        "invalid": lambda: quality.invalid_fks(ship, tables),
        "rel": lambda: quality.child_coverage(tables["fact_event"], tables["fact_cost"], ship),
        "domain": lambda: quality.domain_checks(tables).select("column_name", "out_of_domain"),
    }
    found = {}
    for check in checks or frames:
        for item, n in frames[check]().collect():
            found[f"{check} {item}"] = n
    return {k: v for k, v in found.items() if v}


def test_keys_of_known_tables_are_dealt_before_they_are_counted(make, clean):
    events = [{"shipment_id": f"S{n % 7}", "event_seq": n % 3} for n in range(30)] + [{}, {"event_seq": 1}, {}]
    costs = [{"shipment_id": "S1", "rate_ref": r} for r in (None, "", "x")]
    tables = star(make, clean, fact_event=events, fact_cost=costs)
    plain = quality.pk_duplicates(tables)
    dealt = quality.pk_duplicates(tables, {"fact_event": 30_000_000, "fact_cost": 10**9})
    assert rows(plain) == rows(dealt) and ("FACT_EVENT", 10) in rows(dealt) and ("FACT_COST", 1) in rows(dealt)
    text = dealt._jdf.queryExecution().executedPlan().toString()
    for n in (15, quality.KEY_TASKS):
        assert f", {n}), REPARTITION_BY_NUM" in text


def test_clean_star_has_no_findings(make, clean):
    tables = star(make, clean)
    assert failures(tables) == {}
    counts = dict(rows(quality.row_counts(tables)))
    assert counts["FACT_SHIPMENT"] == 2 and counts["DIM_LOCATION"] == 2 and len(counts) == 9


def test_each_duplicate_key_is_found_once(make, clean):
    changed = {t: clean[t] + [clean[t][0]] * 2 for t in TABLES}
    assert failures(star(make, clean, **changed), "dup") == {f"dup {t.upper()}": 1 for t in TABLES}


def test_cost_key_null_and_empty_are_duplicates(make, clean):
    twin = clean["fact_cost"][0] | {"rate_ref": ""}
    assert failures(star(make, clean, fact_cost=clean["fact_cost"] + [twin]), "dup") == {"dup FACT_COST": 1}


@pytest.mark.parametrize("column", ["customer_id", "carrier_id", "equipment_id", "origin_loc_id", "dest_loc_id", "lane_id"])
def test_dangling_and_null_foreign_keys(make, clean, column):
    legs = clean["fact_shipment"]
    strict = column in ("origin_loc_id", "dest_loc_id", "lane_id")
    dangling = failures(star(make, clean, fact_shipment=[legs[0], legs[1] | {column: 99}]), "fk", "invalid")
    expected = {f"fk {column.upper()}": 1} | ({f"invalid {column}": 1} if strict else {})
    assert dangling == expected
    missing = failures(star(make, clean, fact_shipment=[legs[0], legs[1] | {column: None}]), "fk", "invalid")
    assert missing == ({f"invalid {column}": 1} if strict else {})


def test_orphans(make, clean):
    event = clean["fact_event"][0]
    changed = star(make, clean, fact_event=[event, event | {"shipment_id": "S9"}, event | {"shipment_id": None}],
                   fact_cost=clean["fact_cost"] + [clean["fact_cost"][0] | {"shipment_id": "S8"}])
    assert failures(changed, "rel") == {"rel EVENT -> SHIPMENT": 1, "rel COST -> SHIPMENT": 1}
    lost = quality.orphan_events(changed["fact_event"], changed["fact_shipment"])
    assert rows(lost) == [("S9", 1), (None, 1)]


def test_domains(make, clean):
    odd = star(make, clean, fact_shipment=[clean["fact_shipment"][0] | {"status": "Lost"}],
               fact_event=[clean["fact_event"][0] | {"event_type": None}])
    assert failures(odd, "domain") == {"domain status": 1}


def test_empty_fact_still_reports_every_key(make, clean):
    tables = star(make, clean, fact_shipment=[])
    assert len(quality.fk_coverage(tables["fact_shipment"], tables).collect()) == 6


def test_range_checks(spark):
    metrics = spark.createDataFrame([(0.9, None)], "otd_rate double, gm_per_mile double")
    got = rows(quality.range_checks(metrics, {"otd_rate": (0.8, 0.95), "gm_per_mile": (0.25, 0.6)}), "metric", "in_range")
    assert got == [("gm_per_mile", False), ("otd_rate", True)]


def test_delivery_completeness(make):
    from conftest import at

    ship = make("fact_shipment", [{"shipment_id": "a", "delivery_actual_ts": at("2024-01-01")}, {"shipment_id": "b"}])
    assert rows(quality.delivery_completeness(ship)) == [(1, 1)]


def test_date_dim(spark):
    start, end = date(2022, 12, 30), date(2024, 3, 1)
    span = spark.createDataFrame([(start, end)], "start date, end date")
    got = [tuple(r) for r in dims.date_dim(span).orderBy("date").collect()]
    expected, d = [], start
    while d <= end:
        expected.append((int(d.strftime("%Y%m%d")), d, d.year, (d.month + 2) // 3, d.month, int(d.strftime("%U")),
                         d.weekday(), d.weekday() > 4))
        d += timedelta(days=1)
    assert got == expected


def test_lane_dim_numbering(spark):
    nation = spark.createDataFrame([(i, f"N{i}") for i in (0, 1, 2, 5)], "n_nationkey int, n_name string")
    used = [(1, 4), (3, 2), (1, 12), (11, 2), (1, 4), (1, 2), (None, 4), (99, 4)]
    routes = spark.createDataFrame(used, "origin_loc_id long, dest_loc_id long")
    lanes = rows(dims.lane_dim(routes, binding.hubs(nation)), "lane_id", "origin_loc_id", "dest_loc_id")
    assert lanes == [(1, 1, 4), (2, 1, 12), (3, 3, 2), (4, 11, 2)], "known, distinct pairs of different cities"


def test_surrogate_names(spark):
    def names(seeds, n):
        frame = spark.createDataFrame([(s,) for s in seeds], "name string")
        return [r.name for r in dims.surrogate_names(frame, n).orderBy("ordinal").collect()]

    assert names(["b", "a"], 5) == ["a", "b", "a 3", "b 4", "a 5"]
    assert names(["a", "a", "b"], 3) == ["a", "b", "a 3"]
    assert names(["c", "b", "a"], 2) == ["a", "b"]
    assert names([], 2) == ["Company 001", "Company 002"]
    assert names(["A", "A", "A 2"], 3) == ["A", "A 2", "A 3"]
    assert names(["A", "A 3"], 3) == ["A", "A 3", "A 0003"]
    tricky = ["A", "A 4", "A 4 4", "A 0000004", None]
    assert len(set(names(tricky, 40))) == 40


def test_with_ordinal_spans_partitions(spark):
    frame = spark.range(1000).repartition(7)
    got = dims.with_ordinal(frame, "id").orderBy("id").collect()
    assert [(r.id, r.ordinal) for r in got] == [(i, i + 1) for i in range(1000)]


@pytest.mark.parametrize("miles", [0, 60, 700, 3000, 30000])
def test_places_within_a_distance_against_brute_force(spark, miles):
    """Over the date line and the poles, with a crowd in one spot and places without coordinates."""
    rng = random.Random(miles)
    spots = [(90.0, 0.0), (89.9, 170.0), (89.9, -10.0), (-90.0, 5.0), (-89.5, 100.0), (0.0, 180.0), (0.0, -180.0), (0.3, 179.8), (0.2, -179.9)]
    spots += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(120)] + [(40.0, -75.0)] * 30
    spots += [(rng.uniform(84, 90), rng.uniform(-180, 180)) for _ in range(30)] + [(None, 1.0), (1.0, None)]
    places = spark.createDataFrame([(i, f"c{i % 50}", *s) for i, s in enumerate(spots)], "loc_id long, city string, lat double, lon double")

    def apart(a, b):
        (la, lo), (lb, mo) = ([math.radians(x) for x in p] for p in (a, b))
        chord = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((mo - lo) / 2) ** 2
        return 2 * 3958.8 * math.asin(min(1.0, math.sqrt(chord)))

    known = [(i, s) for i, s in enumerate(spots) if None not in s]
    expected = {(i, j) for i, a in known for j, b in known if apart(a, b) <= miles}
    found = joins.places_within(places, places, miles)
    pairs = [(r.o_loc_id, r.d_loc_id) for r in found.select("o_loc_id", "d_loc_id").collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_lanes_within(spark):
    rows_ = [(1, "Origin", "A", 40.0, -75.0), (2, "Dest", "A", 40.0, -75.0), (3, "Dest", "B", 41.0, -75.0), (4, "Dest", "C", 60.0, -75.0)]
    loc = spark.createDataFrame(rows_, "loc_id long, type string, city string, lat double, lon double")
    assert rows(joins.lanes_within(loc, 100), "o_loc_id", "d_loc_id", "std_transit_days") == [(1, 3, 1)]
    with pytest.raises(ValueError):
        joins.lanes_within(loc, -1)
