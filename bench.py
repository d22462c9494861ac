"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; its time is the median.  Two sets are timed:

* registered queries, end to end from the test tables (each derives the star from order lines again);
* ``edw_*``: the reports a user runs, over the star written once as warehouse Parquet (``build_star`` is that write).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

END_TO_END = (
    "otd_windows",
    "otd_otif_rates",
    "gm_per_mile_ytd",
    "tender_acceptance_events",
    "lane_performance",
    "exception_heatmap",
    "shipment_detail",
    "cost_rollup",
    "merge_fact_shipment",
    "child_coverage",
    "fk_coverage",
    "dedupe_latest",
)


def main() -> None:
    from freightlens.operators import filters, joins, kpis, quality
    from freightlens.plans import all_queries, binding
    from freightlens.session import build_session
    from freightlens.sources import warehouse

    spark = build_session("bench", cores=CPUS, memory=os.environ.get("BENCH_MEMORY", "12g"))
    root = tempfile.mkdtemp(prefix="freightlens-bench-")
    timings: dict[str, float] = {}

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def measure(name, make) -> None:
        run(make())
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run(make())
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken), 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)

    registered = all_queries()[0]
    for name in END_TO_END:
        measure(name, lambda name=name: registered[name](spark, SF_DIR))

    start = time.perf_counter()
    for table, df in binding.bind_star(spark, SF_DIR).items():
        warehouse.write_table(df, root, table)
    timings["build_star"] = round(time.perf_counter() - start, 3)

    def star(table):
        return warehouse.read_edw(spark, root, table)

    def window():
        return filters.bounds(star("fact_shipment"))

    reports = {
        "edw_snapshot": lambda: kpis.snapshot(star("fact_shipment")),
        "edw_otd_windows": lambda: kpis.otd_windows(star("fact_shipment"), window=window()),
        "edw_otd_otif_rates": lambda: kpis.otd_otif_rates(star("fact_shipment")),
        "edw_gm_per_mile_ytd": lambda: kpis.gm_per_mile_ytd(star("fact_shipment")),
        "edw_tender_acceptance": lambda: kpis.tender_acceptance_events(star("fact_event"), window()),
        "edw_avg_transit_days": lambda: kpis.avg_transit_days(star("fact_shipment"), window()),
        "edw_lane_performance": lambda: kpis.lane_performance(
            star("fact_shipment"), star("dim_lane"), star("dim_location"), by="label", window=window()
        ),
        "edw_exception_heatmap": lambda: kpis.exception_heatmap(
            star("fact_event"), star("fact_shipment"), star("dim_customer"), window()
        ),
        "edw_shipment_detail": lambda: kpis.shipment_detail(
            star("fact_shipment"),
            {t: star(t) for t in ("dim_customer", "dim_carrier", "dim_lane", "dim_location")},
            window=window(),
        ),
        "edw_dwell_minutes": lambda: kpis.dwell_minutes(star("fact_event")),
        "edw_event_lifecycle": lambda: kpis.event_lifecycle(star("fact_event")),
        "edw_cost_rollup": lambda: kpis.cost_rollup(star("fact_cost"), star("fact_shipment")),
        "edw_child_coverage": lambda: quality.child_coverage(
            star("fact_event"), star("fact_cost"), star("fact_shipment")
        ),
        "edw_orphan_events": lambda: quality.orphan_events(star("fact_event"), star("fact_shipment")),
        "edw_calendar_join": lambda: joins.join_calendar(star("fact_shipment"), star("dim_date"))
        .groupBy("delivery_year", "delivery_month")
        .count(),
    }
    for name, make in reports.items():
        measure(name, make)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
