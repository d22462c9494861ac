"""Report operators on hand-made rows."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import at, one, rows
from pyspark.sql import functions as F

from freightlens.operators import filters, joins, kpis

ANCHOR = at("2024-06-30T12:00:00")


def leg(shipment, leg_id=1, days_ago=None, late_minutes=0, **more):
    """A leg delivered ``days_ago`` days before the anchor, or undelivered."""
    out = {"shipment_id": shipment, "leg_id": leg_id, "status": "In-Transit", "lane_id": 1, "customer_id": 1,
           "carrier_id": 1, "revenue": Decimal("100.00"), "total_cost": Decimal("60.00"),
           "planned_miles": Decimal("100.00"), "isinfull": True}
    if days_ago is not None:
        actual = ANCHOR - timedelta(days=days_ago)
        out |= {"delivery_actual_ts": actual, "delivery_plan_ts": actual - timedelta(minutes=late_minutes),
                "pickup_actual_ts": actual - timedelta(days=2), "status": "Delivered"}
    return out | more


@pytest.fixture(scope="module")
def ship(make):
    return make(
        "fact_shipment",
        [leg("S1", 1, 0), leg("S1", 2, 29, 61), leg("S2", 1, 30), leg("S3", 1, 31, 60), leg("S4", 1, 60, 500),
         leg("S5", 1, 61), leg("S6", 1)],
    )


def test_windows_edges(ship):
    row = one(kpis.otd_windows(ship))
    assert (row.anchor_date, row.delivered_last_30, row.delivered_prior_30) == (ANCHOR.date(), 2, 3)
    assert row.otd_last_30 == 0.5
    assert row.otd_prior_30 == pytest.approx(2 / 3)
    assert row.otd_delta_pp == pytest.approx(0.5 - 2 / 3)


def test_windows_without_deliveries(make):
    row = one(kpis.otd_windows(make("fact_shipment", [leg("S1")])))
    assert (row.anchor_date, row.otd_last_30, row.delivered_last_30, row.grace_minutes) == (None, None, 0, 60)


def test_windows_grace(ship):
    assert one(kpis.otd_windows(ship, grace=61)).otd_last_30 == 1.0
    assert one(kpis.otd_windows(ship, grace=0)).otd_prior_30 == pytest.approx(1 / 3)


def test_calendar_windows(spark, ship):
    calendar = spark.createDataFrame([(ANCHOR.date(),), (date(2023, 1, 1),)], "date date")
    row = one(kpis.otd_windows_calendar(ship, calendar))
    # Prior is days -60 to -31: S3 on time, S4 late.  Last has both legs of S1, one on time: one shipment, on time.
    assert (row.otd_last_30, row.otd_prior_30) == (1.0, 0.5)
    assert one(kpis.otd_windows_calendar(ship, calendar, grain="leg")).otd_last_30 == 0.5


def test_distinct_and_leg_rates(ship):
    row = one(kpis.otd_otif_rates(ship))
    assert (row.delivered_shipments, row.otd_deliveries, row.otif_deliveries) == (5, 4, 4)
    assert one(kpis.otd_rate_rowgrain(ship)).otd_rate == pytest.approx(4 / 6)


def test_otif_null_in_full(make):
    row = one(kpis.otd_otif_rates(make("fact_shipment", [leg("S1", 1, 0, isinfull=None), leg("S2", 1, 0)])))
    assert (row.otd_rate, row.otif_rate) == (1.0, 0.5)


def test_snapshot_and_daily(ship):
    row = one(kpis.snapshot(ship))
    assert (row.total_rows, row.delivered_rows) == (7, 6)
    assert row.min_delivery_date == ANCHOR.date() - timedelta(days=61)
    days = [r.delivery_date for r in kpis.daily_deliveries(ship, 2).collect()]
    assert days == [ANCHOR.date() - timedelta(days=61), ANCHOR.date() - timedelta(days=60)]
    assert len(kpis.daily_trend(ship).collect()) == 4, "days -59 to 0"


def test_margin(make, ship):
    row = one(kpis.gm_per_mile(ship))
    assert (row.revenue, row.gross_margin, row.gm_per_mile) == (Decimal("700.00"), Decimal("280.00"), 0.4)
    zero = make("fact_shipment", [leg("S1", planned_miles=Decimal("0.00"))])
    assert one(kpis.gm_per_mile(zero)).gm_per_mile is None


def test_margin_ytd(make):
    data = make(
        "fact_shipment",
        [leg("S1", 1, 0), leg("S2", 1, 181, revenue=Decimal("80.00")), leg("S3", 1, 182, revenue=Decimal("9.00"))],
    )
    row = one(kpis.gm_per_mile_ytd(data))  # 2024-01-01 is 181 days before 2024-06-30
    assert row.gm_per_mile_ytd == pytest.approx((40 + 20) / 200)
    assert row.variance_pp == pytest.approx(0.3 - 0.4)


def event(shipment, seq, kind, ts="2024-06-01T00:00:00", notes=None):
    return {"shipment_id": shipment, "event_seq": seq, "event_type": kind, "event_ts": at(ts), "notes": notes}


def test_tender_acceptance(make):
    events = make(
        "fact_event",
        [event("S1", 1, "Tendered"), event("S1", 2, "Tendered"), event("S1", 3, "Accepted"), event("S2", 1, "Tendered"),
         event("S3", 1, "Tendered", "2020-01-01T00:00:00"), event("S4", 1, "Delivered")],
    )
    assert one(kpis.tender_acceptance_events(events)).tender_acceptance_events == pytest.approx(1 / 3)
    window = (date(2024, 1, 1), date(2024, 6, 1))
    assert one(kpis.tender_acceptance_events(events, window)).tender_acceptance_events == 0.5
    statuses = make("fact_shipment", [leg("S1", status="Cancelled"), leg("S1", 2, status="Accepted"),
                                      leg("S2", status="Odd"), leg("S3", status=None), leg("S4", status="Tendered")])
    assert one(kpis.tender_acceptance_status(statuses)).tender_acceptance_status == pytest.approx(1 / 3)
    by_shipment = kpis.tender_acceptance_status(statuses, grain="shipment")
    assert one(by_shipment).tender_acceptance_status == 0.5


@pytest.fixture(scope="module")
def places(make):
    """Two lanes with one label: locations 1 and 2 share a city."""
    loc = make("dim_location", [{"loc_id": i, "city": c} for i, c in ((1, "A"), (2, "A"), (3, "B"))])
    lane = make("dim_lane", [{"lane_id": i, "origin_loc_id": o, "dest_loc_id": 3} for i, o in ((1, 1), (2, 2))])
    return lane, loc


def test_lane_performance_grouping(make, places):
    legs = make("fact_shipment", [leg("S1", 1, 0), leg("S2", 1, 1, 90, lane_id=2), leg("S3", 1, 2, lane_id=2),
                                  leg("S4", 1, lane_id=2), leg("S5", 1, 3, lane_id=9)])
    by_id = kpis.lane_performance(legs, *places).collect()
    assert [tuple(r) for r in by_id] == [(2, "A → B", 2, 2.0, 0.5), (1, "A → B", 1, 2.0, 1.0)]
    by_label = kpis.lane_performance(legs, *places, by="label").collect()
    assert [tuple(r) for r in by_label] == [("A → B", 3, 2.0, 2 / 3)]
    assert tuple(one(kpis.lane_performance(legs, *places, by=None))) == (3, 2.0, 2 / 3)
    assert rows(filters.min_shipments(kpis.lane_performance(legs, *places), 2), "lane_id") == [(2,)]


def test_transit_days(ship):
    assert one(kpis.avg_transit_days(ship)).avg_transit_days == 2.0
    months = [(r.month, r.avg_transit_days) for r in kpis.avg_transit_days_by_month(ship).collect()]
    assert months == [(date(2024, 4, 1), 2.0), (date(2024, 5, 1), 2.0), (date(2024, 6, 1), 2.0)]


def test_heatmap_fans_out_per_leg(make):
    customers = make("dim_customer", [{"customer_id": 1, "name": "C1"}, {"customer_id": 2, "name": "C1"}])
    legs = make("fact_shipment", [leg("S1", 1), leg("S1", 2), leg("S1", 3, customer_id=2), leg("S2", customer_id=7)])
    events = make("fact_event", [event("S1", 1, "Exception", notes="Weather"), event("S1", 2, "Exception", notes=" "),
                                 event("S1", 3, "Exception", notes="Weather"), event("S2", 1, "Exception")])
    assert rows(kpis.exception_heatmap(events, legs, customers)) == [("C1", "Unknown", 3), ("C1", "Weather", 6)]
    once = kpis.exception_heatmap(events, legs, customers, dedupe_legs=True)
    assert rows(once) == [("C1", "Unknown", 2), ("C1", "Weather", 4)]
    matrix = kpis.heatmap_matrix(kpis.exception_heatmap(events, legs, customers), ["Weather", "Traffic"])
    assert rows(matrix) == [("C1", 6, None)]
    assert one(kpis.exception_count(events)).exceptions == 4
    assert [tuple(r) for r in kpis.top_exception_types(events, 1).collect()] == [("Unknown", 2)]


def test_exceptions_by_carrier_and_lane(make, places):
    carriers = make("dim_carrier", [{"carrier_id": 1, "name": "X"}, {"carrier_id": 2, "name": "Y"}])
    legs = make("fact_shipment", [leg("S1", 1, 0), leg("S1", 2, 0), leg("S1", 3, 0, carrier_id=2, lane_id=2)])
    events = make("fact_event", [event("S1", 1, "Exception"), event("S1", 2, "Exception")])
    assert rows(kpis.exceptions_by_carrier(events, legs, carriers)) == [("X", 2), ("Y", 2)]
    tips = rows(kpis.lane_tooltips(legs, events, *places), "lane_id", "shipments", "gm_per_mile", "exceptions")
    assert tips == [(1, 2, 0.4, 2), (2, 1, 0.4, 2)]


def test_dwell_pairs(make):
    events = make(
        "fact_event",
        [event("S1", 5, "DwellStart", "2024-06-01T00:00:00"), event("S1", 6, "DwellEnd", "2024-06-01T01:30:59"),
         event("S1", 15, "DwellStart"), event("S2", 1, "DwellEnd"), event("S3", 1, "PickedUp")],
    )
    assert rows(kpis.dwell_minutes(events)) == [("S1", 90, 1, 1), ("S2", 0, 0, 1)]


def test_dwell_pairs_span_gaps_and_other_events(make):
    events = make(
        "fact_event",
        [event("S1", 1, "DwellStart", "2024-06-01T00:00:00"), event("S1", 2, "PickedUp", "2024-06-01T00:10:00"),
         event("S1", 3, "DwellEnd", "2024-06-01T00:20:00"), event("S1", 9, "DwellEnd", "2024-06-01T00:30:00"),
         event("S2", 1, "DwellStart", "2024-06-01T00:00:00"), event("S2", 4, "DwellStart", "2024-06-01T01:00:00"),
         event("S2", 70, "DwellEnd", "2024-06-01T01:05:30"), event("S3", 1, "DwellStart") | {"event_ts": None},
         event("S3", 2, "DwellEnd", "2024-06-01T01:00:00")],
    )
    assert rows(kpis.dwell_minutes(events)) == [("S1", 20, 1, 1), ("S2", 5, 1, 1), ("S3", 0, 1, 0)]
    assert kpis.dwell_minutes(events.limit(0)).count() == 0


def test_cost_rollup(make):
    def cost(kind, amount, shipment="S1"):
        return {"shipment_id": shipment, "cost_type": kind, "cost_amount": Decimal(amount)}

    costs = make("fact_cost", [cost("Base", "40.00"), cost("Fuel", "15.00"), cost("Accessorial: Lumper", "5.00"),
                               cost("Accessorial: TONU", "75.00", "S2")])
    legs = make("fact_shipment", [leg("S1"), leg("S2", total_cost=Decimal("0.00"))])
    got = rows(kpis.cost_rollup(costs, legs))
    money = Decimal
    assert got == [
        ("S1", money("40.00"), money("15.00"), money("5.00"), money("60.00"), money("60.00"), money("0.00")),
        ("S2", money("0.00"), money("0.00"), money("75.00"), money("75.00"), money("0.00"), money("75.00")),
    ]


def test_lifecycle_uses_type_not_sequence(make):
    events = make("fact_event", [event("S1", 9, "Tendered", "2024-01-01T00:00:00"),
                                 event("S1", 1, "Delivered", "2024-01-05T00:00:00"),
                                 event("S1", 2, "Exception", "2024-01-02T00:00:00")])
    assert rows(kpis.event_lifecycle(events)) == [
        ("S1", at("2024-01-01T00:00:00"), None, None, at("2024-01-05T00:00:00"))
    ]


def test_detail_and_options(make, places):
    lane, loc = places
    star = {
        "dim_customer": make("dim_customer", [{"customer_id": 1, "name": "C1"}]),
        "dim_carrier": make("dim_carrier", [{"carrier_id": 1, "name": "X"}]),
        "dim_equipment": make("dim_equipment", [{"equipment_id": i, "type": t} for i, t in ((1, "Van"), (2, "Van"))]),
        "dim_lane": lane,
        "dim_location": loc,
    }
    legs = make("fact_shipment", [leg("S2", 1, 0), leg("S1", 2, 0, 61), leg("S1", 1, isinfull=None), leg("S3", carrier_id=5)])
    detail = kpis.shipment_detail(legs, star, limit=2).collect()
    assert [(r.shipment_id, r.leg_id, r.isdeliveredontime_calc, r.isotif_calc) for r in detail] == [
        ("S1", 1, False, False), ("S1", 2, False, False),
    ]
    assert len(detail[0]) == 18
    assert rows(kpis.filter_options(star)) == [
        ("carrier", "X"), ("customer", "C1"), ("equipment", "Van"), ("lane", "A → B"),
    ]


def test_filters(make, places):
    lane, loc = places
    star = {
        "dim_customer": make("dim_customer", [{"customer_id": 1, "name": "O'Neil"}, {"customer_id": 2, "name": "B"}]),
        "dim_carrier": make("dim_carrier", [{"carrier_id": 1, "name": "X"}]),
        "dim_equipment": make("dim_equipment", [{"equipment_id": 1, "type": "Van"}]),
        "dim_lane": lane,
        "dim_location": loc,
    }
    legs = make("fact_shipment", [leg("S1", 1, 0), leg("S2", 1, 1, customer_id=2), leg("S3", customer_id=1),
                                  leg("S4", 1, 1, lane_id=9)])

    def kept(**f):
        return [r[0] for r in rows(filters.apply_filters(legs, star, **f), "shipment_id")]

    assert kept() == kept(customers=[]) == ["S1", "S2", "S3", "S4"]
    assert kept(customers=["O'Neil"]) == ["S1", "S3", "S4"]
    assert kept(customers=star["dim_customer"].filter("customer_id = 2").select("name")) == ["S2"]
    assert kept(lanes=["A → B"]) == ["S1", "S2", "S3"]
    assert kept(date_start=ANCHOR.date()) == ["S1"]
    assert kept(date_end=ANCHOR.date() - timedelta(days=1)) == ["S2", "S4"]
    assert kept(date_start=ANCHOR.date() - timedelta(days=1), date_end=ANCHOR.date(), carriers=["X"]) == ["S1", "S2", "S4"]


def test_bounds(make, ship):
    row = one(filters.bounds(ship))
    assert (row.start_d, row.end_d) == (ANCHOR.date() - timedelta(days=180), ANCHOR.date())
    data = make("fact_shipment", [leg("S1", 1, 0), leg("S2", 1, 180), leg("S3", 1, 181), leg("S4")])
    inside = filters.within_bounds(data, "delivery_actual_ts", filters.bounds(data))
    assert rows(inside, "shipment_id") == [("S1",), ("S2",)]
    assert filters.within_bounds(data, "delivery_actual_ts", None) is data


def test_asof_weekly_price(spark, make):
    prices = spark.createDataFrame(
        [(date(2024, 1, 1), Decimal("3.500")), (date(2024, 1, 22), Decimal("4.000"))], "week date, price decimal(6,3)"
    )
    days = ["2023-12-31", "2024-01-01", "2024-01-20", "2024-01-21", "2024-01-22", "2024-03-01", None]
    legs = make("fact_shipment", [{"shipment_id": f"S{i}", "pickup_plan_ts": at(d) if d else None}
                                  for i, d in enumerate(days)])
    got = [r[1] for r in rows(joins.asof_weekly_price(legs, prices), "shipment_id", "price")]
    old, new = Decimal("3.500"), Decimal("4.000")
    assert got == [None, old, old, old, new, new, None]


def test_asof_price_never_looks_ahead(spark, make):
    quoted = [("2024-01-01", "3.000"), ("2024-01-03", "4.000"), ("2024-01-03", "4.500")]
    prices = spark.createDataFrame([(at(d).date(), Decimal(p)) for d, p in quoted], "week date, price decimal(6,3)")
    legs = make("fact_shipment", [{"shipment_id": d, "pickup_plan_ts": at(d)} for d in ("2024-01-02", "2024-01-03")])
    got = dict(rows(joins.asof_weekly_price(legs, prices), "shipment_id", "price"))
    assert got == {"2024-01-02": Decimal("3.000"), "2024-01-03": Decimal("4.500")}


def test_calendar_and_scalars(spark, make, ship):
    from freightlens.operators.dims import date_dim

    span = spark.createDataFrame([(ANCHOR.date(), ANCHOR.date())], "start date, end date")
    joined = joins.join_calendar(ship, date_dim(span), "delivery")
    assert rows(joined.filter("delivery_year IS NOT NULL"), "shipment_id", "delivery_date_key") == [("S1", 20240630)]
    assert joined.count() == 7
    row = one(joins.with_scalars(spark.range(1), filters.bounds(ship)))
    assert (row.id, row.end_d) == (0, ANCHOR.date())


def test_null_equal(spark):
    frame = spark.createDataFrame([(None, ""), ("a", "a"), ("a", None)], "a string, b string")
    assert [r[0] for r in frame.select(joins.null_equal(F.col("a"), F.col("b"))).collect()] == [True, True, False]
