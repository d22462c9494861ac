"""Upsert rules and properties."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import at, rows

from freightlens.operators import merge, shaping
from freightlens.schemas import KEYS

NOW = datetime(2024, 6, 1)
T0, T1, T2 = at("2024-01-01T00:00:00"), at("2024-01-02T00:00:00"), at("2024-01-03T00:00:00")


def event(shipment, note, load, update, seq=1):
    return {"shipment_id": shipment, "event_seq": seq, "event_type": "Tendered", "notes": note, "load_date": load,
            "update_date": update}


@pytest.mark.parametrize(
    ("target_update", "source_update", "wins"),
    [(T1, T0, False), (T1, T1, True), (T1, T2, True), (T1, None, False), (None, T1, False), (None, None, False)],
)
def test_fact_guard(make, target_update, source_update, wins):
    target = make("fact_event", [event("S1", "old", T0, target_update)])
    source = make("fact_event", [event("S1", "new", T2, source_update)])
    got = merge.merge_fact(target, source, KEYS["fact_event"], NOW)
    expected = ("S1", "new", T0, source_update) if wins else ("S1", "old", T0, target_update)
    assert rows(got, "shipment_id", "notes", "load_date", "update_date") == [expected]


def test_fact_insert_fills_audit_times(make):
    target = make("fact_event", [])
    source = make("fact_event", [event("S1", "x", None, None), event("S2", "y", T0, T1)])
    got = merge.merge_fact(target, source, KEYS["fact_event"], NOW)
    assert rows(got, "shipment_id", "load_date", "update_date") == [("S1", NOW, NOW), ("S2", T0, T1)]


def test_null_keys_never_match(make):
    target = make("fact_event", [event(None, "t", T0, T0)])
    source = make("fact_event", [event(None, "s", T1, T1)])
    assert rows(merge.merge_fact(target, source, KEYS["fact_event"], NOW), "notes") == [("s",), ("t",)]


def test_a_repeated_source_key_fails(make):
    target = make("fact_event", [event("S1", "t", T0, T0)])
    source = make("fact_event", [event("S2", "a", T1, T1), event("S2", "b", T1, T1)])
    with pytest.raises(Exception, match="repeats a key"):
        merge.merge_table(target, source, "fact_event", NOW).collect()
    with pytest.raises(Exception, match="repeats a key"):
        merge.merge_table(target, source, "fact_event", NOW).count()
    apart = make("fact_event", [event(None, "a", T1, T1), event(None, "b", T1, T1)])
    assert merge.merge_table(target, apart, "fact_event", NOW).count() == 3, "null keys are never the same"


def test_dim_is_unguarded_and_keeps_load_date(make):
    target = make("dim_customer", [{"customer_id": 1, "name": "a", "load_date": T0, "update_date": T2}])
    source = make(
        "dim_customer",
        [{"customer_id": 1, "name": "b", "load_date": T1, "update_date": T0}, {"customer_id": 2, "name": "c"}],
    )
    got = merge.merge_dim(target, source, ["customer_id"], NOW)
    assert rows(got, "customer_id", "name", "load_date", "update_date") == [(1, "b", T0, T0), (2, "c", NOW, NOW)]


def test_dim_null_update_becomes_now_but_curation_copies_it(make):
    target = make("dim_customer", [{"customer_id": 1, "name": "a", "load_date": T0, "update_date": T2}])
    source = make("dim_customer", [{"customer_id": 1, "name": "b"}, {"customer_id": 2, "name": "c"}])
    assert rows(merge.merge_table(target, source, "dim_customer", NOW), "update_date") == [(NOW,), (NOW,)]
    curated = merge.merge_table(target, source, "dim_customer", NOW, copy_audit=True)
    assert rows(curated, "customer_id", "update_date") == [(1, None), (2, NOW)]


def test_curated_fact_inserts_copy_audit_times(make):
    got = merge.merge_table(
        make("fact_event", []), make("fact_event", [event("S1", "x", None, None)]), "fact_event", NOW, copy_audit=True
    )
    assert rows(got, "load_date", "update_date") == [(None, None)]


def test_cost_key_treats_null_as_empty(make):
    def cost(ref, amount, update):
        return {"shipment_id": "S1", "cost_type": "Base", "rate_ref": ref, "cost_amount": Decimal(amount),
                "update_date": update}

    target = make("fact_cost", [cost(None, "1.00", T0)])
    got = merge.merge_fact(target, make("fact_cost", [cost("", "2.00", T1)]), KEYS["fact_cost"], NOW)
    assert rows(got, "rate_ref", "cost_amount") == [(None, Decimal("2.00"))]
    both = make("fact_cost", [cost("", "2.00", T1), cost(None, "3.00", T2)])
    latest = merge.latest_source(both, "fact_cost")
    assert rows(latest, "cost_amount") == [(Decimal("3.00"),)]
    assert latest.columns == both.columns


def _random_events(rng, n):
    return [
        event(f"S{rng.randint(1, 12)}", f"n{i}", T0, T0 + timedelta(hours=rng.randint(0, 50)), rng.randint(1, 3))
        for i in range(n)
    ]


def test_merge_properties(make):
    rng = random.Random(7)
    a, b, c = ([dict(r) for r in _random_events(rng, 40)] for _ in range(3))
    keys = KEYS["fact_event"]

    def source(data):
        return shaping.dedupe_latest(make("fact_event", data), keys, ["update_date"])

    base = source(a)
    once = merge.merge_fact(base, source(b), keys, NOW)
    twice = merge.merge_fact(once, source(b), keys, NOW)
    assert rows(once) == rows(twice), "merging twice is merging once"
    assert once.count() == len({(r["shipment_id"], r["event_seq"]) for r in a + b}), "one row per key"

    # With distinct update times the order of batches does not matter.
    for i, r in enumerate(a + b + c):
        r["update_date"] = T0 + timedelta(minutes=rng.randint(0, 10_000), seconds=i % 60, microseconds=i)
    columns = ("shipment_id", "event_seq", "notes", "update_date")
    bc = merge.merge_fact(merge.merge_fact(source(a), source(b), keys, NOW), source(c), keys, NOW)
    cb = merge.merge_fact(merge.merge_fact(source(a), source(c), keys, NOW), source(b), keys, NOW)
    best = {}
    for r in a + b + c:
        k = (r["shipment_id"], r["event_seq"])
        if k not in best or r["update_date"] > best[k]["update_date"]:
            best[k] = r
    expected = sorted((r["shipment_id"], r["event_seq"], r["notes"], r["update_date"]) for r in best.values())
    assert sorted(rows(bc, *columns)) == sorted(rows(cb, *columns)) == expected


def test_dedupe_latest_is_total(make):
    data = [event("S1", "a", T0, T1), event("S1", "b", T0, T1), event("S1", "z", T2, T0), event("S2", None, None, None)]
    expected = [("S1", "b"), ("S2", None)]
    for order in (data, list(reversed(data))):
        got = shaping.dedupe_latest(make("fact_event", order).repartition(3), KEYS["fact_event"], ["update_date"])
        assert rows(got, "shipment_id", "notes") == expected


def test_curate_recomputes_flags(make):
    plan = at("2024-01-01T10:00:00")

    def leg(n, minutes, full):
        actual = None if minutes is None else plan + timedelta(minutes=minutes)
        return {"shipment_id": "S1", "leg_id": n, "delivery_plan_ts": plan, "delivery_actual_ts": actual,
                "isinfull": full, "isdeliveredontime": False, "isotif": True, "update_date": T1}

    landed = make("fact_shipment", [leg(1, 60, True), leg(2, 61, True), leg(3, 0, None), leg(4, None, True)])
    got = merge.curate({"fact_shipment": landed}, {"fact_shipment": make("fact_shipment", [])}, NOW)["fact_shipment"]
    assert rows(got, "leg_id", "isdeliveredontime", "isotif") == [
        (1, True, True), (2, False, False), (3, True, False), (4, False, False),
    ]


def test_type_raw_table(spark):
    from freightlens.schemas import raw_schema

    names = raw_schema("dim_date", audit=False).names
    raw = spark.createDataFrame(
        [dict(zip(names, ("20240101", "2024-01-01", "2024", "1", "1", "0", "0", "maybe")))],
        raw_schema("dim_date", audit=False),
    )
    typed = shaping.type_raw_table(raw, "dim_date")
    (row,) = typed.collect()
    assert row.date_key == 20240101 and row.is_weekend is None and str(row.date) == "2024-01-01"
