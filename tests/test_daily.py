"""Daily totals that merges keep up to date, and daily bitmaps, against full recomputation."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import at, one, rows

from freightlens.operators import bitmaps, filters, kpis, merge
from freightlens.plans.daily import DailyTotals
from freightlens.schemas import KEYS
from freightlens.sources import bucketed, warehouse

NOW = datetime(2024, 6, 1)


def legs(rng, n, update, ids=200):
    """Random legs; shipment S000000001 has a third of them."""
    keys, out = set(), []
    for i in range(n):
        key = (1 if i % 3 == 0 else rng.randrange(2, ids), i if i % 3 == 0 else rng.randrange(4))
        if key in keys:
            continue
        keys.add(key)
        start = datetime(2024, 1, 1) + timedelta(days=rng.randrange(150), hours=rng.randrange(24))
        done = None if rng.random() < 0.2 else start + timedelta(hours=rng.randrange(20, 120))
        out.append({
            "shipment_id": f"S{key[0]:09d}", "leg_id": key[1], "tender_ts": start, "pickup_actual_ts": start if rng.random() < 0.9 else None,
            "delivery_plan_ts": start + timedelta(hours=70), "delivery_actual_ts": done, "isinfull": rng.choice([True, False, None]),
            "revenue": Decimal(rng.randrange(9999)) / 100, "total_cost": Decimal(rng.randrange(5000)) / 100,
            "planned_miles": None if rng.random() < 0.1 else Decimal(rng.randrange(900)), "update_date": update,
        })
    return out


def test_totals_follow_merges(spark, make, tmp_path):
    root, rng = str(tmp_path / "edw"), random.Random(1)
    totals = DailyTotals(spark, root)
    assert totals.days().count() == 0 and one(totals.otd_windows()).anchor_date is None
    first, second = legs(rng, 300, at("2024-02-01")), legs(rng, 300, at("2024-03-01"))
    late = legs(rng, 200, at("2024-01-01"))
    for batch, data in (("1", first), ("2", second), ("2", second), ("3-late", late)):
        totals.merge(batch, make("fact_shipment", data), NOW)
    ship = warehouse.read_edw(spark, root, "fact_shipment")
    assert rows(totals.days()) == rows(kpis.day_totals(ship))
    assert rows(totals.otd_windows()) == rows(kpis.otd_windows(ship))
    assert rows(totals.daily_trend()) == rows(kpis.daily_trend(ship))
    assert rows(totals.gm_per_mile_ytd()) == rows(kpis.gm_per_mile_ytd(ship))
    assert rows(totals.avg_transit_days()) == rows(kpis.avg_transit_days(ship))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    read = totals.otd_windows()._jdf.queryExecution().executedPlan().toString()
    assert "fact_shipment_daily" in read and "fact_shipment/" not in read and "shipment_id" not in read


def test_totals_survive_a_merge_that_fails(spark, make, tmp_path, monkeypatch):
    """The share is written before the table: a run that dies between them is completed by running the batch again."""
    root, rng, save = str(tmp_path / "edw"), random.Random(2), warehouse._save
    totals = DailyTotals(spark, root)
    totals.merge("1", make("fact_shipment", legs(rng, 120, at("2024-02-01"))), NOW)

    def fail(rows, path, table, mode, overwrite="static"):
        if overwrite == "dynamic":
            raise RuntimeError("lost")
        save(rows, path, table, mode, overwrite)

    batch = make("fact_shipment", legs(rng, 120, at("2024-03-01")))
    monkeypatch.setattr(warehouse, "_save", fail)
    with pytest.raises(RuntimeError):
        totals.merge("2", batch, NOW)
    monkeypatch.setattr(warehouse, "_save", save)
    for _ in range(2):
        totals.merge("2", batch, NOW)
        assert rows(totals.days()) == rows(kpis.day_totals(warehouse.read_edw(spark, root, "fact_shipment")))


def test_bitmaps_count_any_window(spark, make):
    data = legs(random.Random(3), 500, at("2024-02-01"), ids=70_000)
    ship = make("fact_shipment", data)
    daily = bitmaps.delivery_bitmaps(ship)
    assert "shipment_id" not in daily.columns
    for first, last in ((date(2024, 1, 1), date(2024, 12, 31)), (date(2024, 2, 3), date(2024, 2, 3)), (date(2024, 2, 10), date(2024, 4, 1)), (date(2030, 1, 1), date(2030, 1, 2))):
        inside = filters.within_bounds(ship, "delivery_actual_ts", (first, last))
        assert rows(bitmaps.otd_otif_rates(daily, first, last)) == rows(kpis.otd_otif_rates(inside))
    calendar = spark.sql("SELECT DATE'2024-04-20' AS date UNION ALL SELECT DATE'2024-01-01'")
    assert rows(bitmaps.otd_windows_calendar(daily, calendar)) == rows(kpis.otd_windows_calendar(ship, calendar))
    # Days that arrive later are added; a shipment in both counts once.
    halves = [make("fact_shipment", data[i::2]) for i in (0, 1)]
    both = bitmaps.add_days(*[bitmaps.delivery_bitmaps(h) for h in halves])
    whole = (date(2024, 1, 1), date(2024, 12, 31))
    assert rows(bitmaps.otd_otif_rates(both, *whole)) == rows(kpis.otd_otif_rates(ship))
    text = bitmaps.otd_otif_rates(daily, *whole)._jdf.queryExecution().executedPlan().toString()
    assert all("shipment_id" not in line for line in text.split("\n") if "Exchange" in line)


def test_tender_bitmaps(make):
    kinds = ("Tendered", "Accepted", "PickedUp")
    rng = random.Random(4)
    events = make("fact_event", [
        {"shipment_id": f"S{rng.randrange(90):09d}", "event_seq": i, "event_type": rng.choice(kinds),
         "event_ts": None if i % 50 == 0 else datetime(2024, 1, 1) + timedelta(hours=rng.randrange(2000))} for i in range(400)
    ])
    window = (date(2024, 1, 10), date(2024, 2, 20))
    got = bitmaps.tender_acceptance(bitmaps.tender_bitmaps(events), *window)
    assert rows(got) == rows(kpis.tender_acceptance_events(events, window))
    assert rows(bitmaps.tender_acceptance(bitmaps.tender_bitmaps(events.limit(0)), *window)) == [(0, 0, None)]


def test_bucketed_merge_shuffles_the_source_only(spark, make, tmp_path):
    root, rng = str(tmp_path / "edw"), random.Random(5)
    old, new = legs(rng, 900, at("2024-02-01"), ids=400), legs(rng, 300, at("2024-03-01"), ids=500)
    bucketed.write_bucketed(make("fact_shipment", old), root, "fact_shipment", buckets=5)
    target = bucketed._stored(spark, bucketed._folder(root, "fact_shipment", 5), "fact_shipment", 5)
    source = make("fact_shipment", new)
    text = merge.merge_table(target, source, "fact_shipment", NOW, buckets=5)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text, "only the source is shuffled"
    assert text.index("FileScan parquet") < text.index("Exchange hashpartitioning")
    expected = rows(merge.merge_table(make("fact_shipment", old), source, "fact_shipment", NOW))
    for _ in range(2):
        bucketed.merge_bucketed(source, root, "fact_shipment", NOW, buckets=5)
        assert rows(bucketed.read_bucketed(spark, root, "fact_shipment", buckets=5)) == expected
    assert len(bucketed.read_bucketed(spark, root, "fact_shipment", buckets=5).inputFiles()) == 5, "a file per bucket"


def test_bucketed_costs_match_null_and_empty(spark, make, tmp_path):
    root = str(tmp_path / "it's edw")

    def cost(ref, update, currency):
        return {"shipment_id": "S1", "cost_type": "Base", "rate_ref": ref, "currency": currency, "update_date": at(update)}

    bucketed.write_bucketed(make("fact_cost", [cost(None, "2024-01-01", "USD"), cost("a", "2024-01-01", "USD")]), root, "fact_cost", buckets=3)
    bucketed.merge_bucketed(make("fact_cost", [cost("", "2024-02-01", "EUR"), cost("b", "2024-02-01", "EUR")]), root, "fact_cost", NOW, buckets=3)
    found = bucketed.read_bucketed(spark, root, "fact_cost", buckets=3)
    assert rows(found, "rate_ref", "currency") == [("a", "USD"), ("b", "EUR"), (None, "EUR")]
    assert set(KEYS["fact_cost"]) <= set(found.columns) and "key_rate_ref" not in found.columns


def test_batches_are_merged_in_slices_from_files(spark, make, tmp_path, monkeypatch):
    """A batch is computed once, and a large one is merged in slices as stored rows are."""
    from freightlens.sources import warehouse

    jobs, save = [], warehouse._save
    monkeypatch.setattr(warehouse, "SLICE_ROWS", 0)
    monkeypatch.setattr(warehouse, "_save", lambda *a, **k: jobs.append(a[1]) or save(*a, **k))
    totals = DailyTotals(spark, str(tmp_path / "daily"))
    legs = [{"shipment_id": f"S{n}", "leg_id": 1, "delivery_actual_ts": at("2024-01-02"), "tender_ts": at("2024-01-01")} for n in range(12)]
    totals.merge("1", make("fact_shipment", legs), at("2024-06-01"))
    assert len(jobs) == warehouse.SLICES
    assert [r.n for r in totals.days().collect()] == [12]
