"""Files, warehouse tables, batch refresh and streaming ingest."""

from __future__ import annotations

import gzip
from datetime import datetime, timedelta

import pytest
from conftest import at, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from freightlens.operators import merge
from freightlens.plans import refresh as refreshing
from freightlens.schemas import KEYS, TABLES
from freightlens.sources import landing, warehouse
from freightlens.streaming.landing import stream_landing, stream_landing_once, stream_upsert

NOW = datetime(2024, 6, 1)
HEADER = "shipment_id,event_seq,event_type,event_ts,facility_loc_id,notes,load_date,update_date\n"


def put(path, *lines, compress=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = HEADER + "".join(f"{line}\n" for line in lines)
    path.write_bytes(gzip.compress(text.encode()) if compress else text.encode())
    return str(path)


def test_landing_csv(spark, tmp_path):
    path = put(
        tmp_path / "e.csv.gz",
        'S1,1,Tendered,2024-01-01T05:00:00+00:00,7,"late, very ""late""",2024-01-01T00:00:00+00:00,',
        "S2,2,Exception,,NULL, padded ,,2024-01-02T00:00:00+02:00",
        compress=True,
    )
    typed = landing.read_landing_csv(spark, path, "fact_event")
    assert rows(typed) == [
        ("S1", 1, "Tendered", at("2024-01-01T05:00:00"), 7, 'late, very "late"', at("2024-01-01T00:00:00"), None),
        ("S2", 2, "Exception", None, None, " padded ", None, at("2024-01-01T22:00:00")),
    ]
    raw = landing.read_raw_csv(spark, path, "fact_event")
    assert {t for _, t in raw.dtypes} == {"string"} and rows(raw, "facility_loc_id") == [("7",), ("NULL",)]


@pytest.mark.parametrize("line", ["S1,x,Tendered,,,,,", "S1,1,Tendered,junk,,,,", "S1,1"])
def test_bad_landing_rows_fail(spark, tmp_path, line):
    path = put(tmp_path / "e.csv", line)
    with pytest.raises((PySparkException, Py4JJavaError)):
        landing.read_landing_csv(spark, path, "fact_event").collect()
    if line == "S1,1":  # also when the query needs only some of the fields
        with pytest.raises((PySparkException, Py4JJavaError)):
            landing.read_raw_csv(spark, path, "fact_event").select("shipment_id").collect()


def test_write_csv_drops_internal_columns(spark, tmp_path):
    landing.write_csv(spark.createDataFrame([("a", 1)], "name string, _hidden int"), str(tmp_path / "o"))
    texts = [p.read_text() for p in (tmp_path / "o").glob("part-*.csv")]
    assert "name\na\n" in texts and not any("hidden" in t for t in texts)


def test_name_seeds_and_columns(spark, tmp_path):
    (tmp_path / "n.txt").write_text("# list\n  Acme \n\n\t\nBolt\t\n#x\n")
    assert rows(landing.read_name_seeds(spark, str(tmp_path / "n.txt"))) == [("Acme",), ("Bolt",)]
    assert landing.normalize_columns(spark.range(1).toDF("Loc_ID")).columns == ["loc_id"]


def test_tables(spark, make, tmp_path):
    root = str(tmp_path / "edw")
    assert warehouse.read_edw(spark, root, "dim_customer").count() == 0
    one, two = (make("dim_customer", [{"customer_id": i, "name": "n"}]) for i in (1, 2))
    warehouse.write_table(one, root, "dim_customer")
    kept = warehouse.read_edw(spark, root, "dim_customer")
    warehouse.write_table(kept.unionByName(two), root, "dim_customer")  # reads the table that it replaces
    assert rows(warehouse.read_edw(spark, root, "dim_customer"), "customer_id") == [(1,), (2,)]
    warehouse.write_table(two, root, "dim_customer")
    assert rows(warehouse.read_edw(spark, root, "dim_customer"), "customer_id", "name") == [(2, "n")]
    warehouse.write_table(one, root, "dim_customer", mode="append")
    assert rows(warehouse.read_edw(spark, root, "dim_customer"), "customer_id") == [(1,), (2,)]
    with pytest.raises(ValueError):
        warehouse.write_table(one.withColumn("more", F.lit(1)), root, "dim_customer", mode="append")
    with pytest.raises(ValueError):
        warehouse.write_table(one, root, "dim_customer", mode="ignore")
    with pytest.raises(FileNotFoundError):
        warehouse.read_edw(spark, root, "no_such_table")
    counts = warehouse.publish_snapshot(spark, root, str(tmp_path / "bi"))
    assert dict(rows(counts))["DIM_CUSTOMER"] == 2 and counts.count() == 9


def leg(n, month, update="2024-01-01", **more):
    stamp = at(f"2024-{month:02d}-05") if month else None
    return {"shipment_id": f"S{n}", "leg_id": 1, "tender_ts": stamp, "update_date": at(update), **more}


def files_by_month(spark, root):
    stored = spark.read.parquet(f"{root}/fact_shipment")
    found: dict = {}
    for name in stored.inputFiles():
        found.setdefault(name.split("part_month=")[1].split("/")[0], set()).add(name)
    return found


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_window_reads_its_months_only(spark, make, tmp_path):
    root = str(tmp_path / "edw")
    warehouse.write_table(make("fact_shipment", [leg(n, n % 7) for n in range(70)]), root, "fact_shipment")
    assert sorted(files_by_month(spark, root)) == [*(f"20240{m}" for m in range(1, 7)), "__HIVE_DEFAULT_PARTITION__"]
    some = warehouse.read_edw(spark, root, "fact_shipment", since=at("2024-02-05"), until=at("2024-03-05").date())
    assert sorted({r.tender_ts for r in some.collect()}) == [at("2024-02-05"), at("2024-03-05")] and some.count() == 20
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    filters = plan(some).split("PartitionFilters: [")[1].split("]")[0]
    assert "part_month" in filters and "202402" in filters and "202403" in filters
    assert len(some.columns) == 29 and "part_month" not in some.columns
    whole = warehouse.read_edw(spark, root, "fact_shipment")
    assert whole.count() == 70 and whole.where("tender_ts IS NULL").count() == 10
    with pytest.raises(ValueError):
        warehouse.write_table(make("dim_customer", []), root, "dim_customer")
        warehouse.read_edw(spark, root, "dim_customer", since=at("2024-01-01"))


def test_a_batch_rewrites_only_the_months_it_touches(spark, make, tmp_path):
    root = str(tmp_path / "edw")

    def merged(*legs):
        return refreshing.merge_into(make("fact_shipment", list(legs)), root, "fact_shipment", NOW)

    def changed(before):
        after = files_by_month(spark, root)
        return {m for m in after if after[m] != before.get(m)}

    warehouse.write_table(make("fact_shipment", [leg(n, 1 + n % 4) for n in range(8)]), root, "fact_shipment")
    before = files_by_month(spark, root)
    assert merged(leg(4, 1, "2024-02-01", status="Delivered"), leg(20, 1)) == [202401]
    assert changed(before) == {"202401"}
    # A row that moves to another month rewrites both.
    before = files_by_month(spark, root)
    assert merged(leg(1, 3, "2024-02-01")) == [202402, 202403]
    assert changed(before) == {"202402", "202403"}
    found = warehouse.read_edw(spark, root, "fact_shipment")
    assert found.count() == 9 and rows(found.filter("shipment_id = 'S1'"), "tender_ts") == [(at("2024-03-05"),)]
    # The last row of a month moves away, to no month at all: the month is empty.
    assert set(merged(leg(5, 0, "2024-02-01"))) == {None, 202402}
    found = warehouse.read_edw(spark, root, "fact_shipment")
    assert rows(found.filter("shipment_id = 'S5'"), "tender_ts") == [(None,)] and found.count() == 9
    assert found.filter("month(tender_ts) = 2").count() == 0
    # It is filled again, and an older row changes nothing.
    merged(leg(5, 2, "2024-03-01"), leg(0, 2, "2023-01-01"))
    found = warehouse.read_edw(spark, root, "fact_shipment")
    assert rows(found.filter("month(tender_ts) = 2"), "shipment_id") == [("S5",)] and found.count() == 9
    assert merged() is None
    warehouse.write_table(make("fact_shipment", [leg(30, 4)]), root, "fact_shipment", mode="append")
    assert merged(leg(30, 5, "2024-02-01")) == [202404, 202405]
    assert warehouse.read_edw(spark, root, "fact_shipment").count() == 10


def test_a_batch_reads_only_its_part_of_the_key_index(spark, make, tmp_path):
    root, keys = str(tmp_path / "edw"), [merge.key_column(k) for k in KEYS["fact_shipment"]]
    warehouse.write_table(make("fact_shipment", [leg(n, 1 + n % 6) for n in range(3000)]), root, "fact_shipment")
    refreshing.merge_into(make("fact_shipment", [leg(1, 2)]), root, "fact_shipment", NOW)
    batch = make("fact_shipment", [leg(n, 1) for n in (7, 8, 9)])
    wanted = warehouse._entries(batch.withColumn(warehouse.MONTH, warehouse.month_of("fact_shipment")), keys)
    index = warehouse.key_index(spark, root, "fact_shipment", keys)
    assert index.count() == 3000
    found = warehouse.holding_months(index, wanted)
    assert rows(found, "k0", "part_month") == [("S7", 202402), ("S8", 202403), ("S9", 202404)]
    buckets = {r[0] for r in wanted.select(warehouse.BUCKET).distinct().collect()}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    filters = plan(found).split("PartitionFilters: [")[1].split("]")[0]
    assert all(f"{b}" in filters for b in buckets) and len(buckets) <= 3
    (scan,) = [x for x in plan(found).split("\n") if "FileScan parquet" in x]
    assert "ReadSchema: struct<k0:string,k1:int,part_month:int>" in scan


def test_a_merge_that_fails_half_way_is_completed_by_running_it_again(spark, make, tmp_path, monkeypatch):
    root, save = str(tmp_path / "edw"), warehouse._save
    warehouse.write_table(make("fact_shipment", [leg(n, 1 + n % 3) for n in range(9)]), root, "fact_shipment")
    batch = make("fact_shipment", [leg(0, 2, "2024-02-01"), leg(50, 3)])
    before = rows(warehouse.read_edw(spark, root, "fact_shipment"))

    def fail(rows, path, table, mode, overwrite="static"):
        if overwrite == "dynamic":
            raise RuntimeError("lost")
        save(rows, path, table, mode, overwrite)

    monkeypatch.setattr(warehouse, "_save", fail)
    with pytest.raises(RuntimeError):
        refreshing.merge_into(batch, root, "fact_shipment", NOW)
    assert rows(warehouse.read_edw(spark, root, "fact_shipment")) == before
    monkeypatch.setattr(warehouse, "_save", save)
    for _ in range(2):
        refreshing.merge_into(batch, root, "fact_shipment", NOW)
        found = warehouse.read_edw(spark, root, "fact_shipment")
        assert found.count() == 10 and rows(found.filter("shipment_id = 'S0'"), "tender_ts") == [(at("2024-02-05"),)]


def test_large_stored_merges_go_in_slices_of_keys(spark, make, tmp_path, monkeypatch):
    first = make("fact_shipment", [leg(n, 1 + n % 3) for n in range(40)] + [{"leg_id": 1}])
    batch = make("fact_shipment", [leg(n, 2, "2024-02-01") for n in range(30, 50)] + [{"leg_id": 2}])
    saved, save = [], warehouse._save

    def watch(rows, path, table, mode, overwrite="static"):
        saved.append(plan(rows))
        save(rows, path, table, mode, overwrite)

    monkeypatch.setattr(warehouse, "_save", watch)
    found = []
    for most, jobs in ((1000, 1), (0, warehouse.SLICES)):
        monkeypatch.setattr(warehouse, "SLICE_ROWS", most)
        root = str(tmp_path / f"edw{most}")
        saved.clear()
        refreshing.merge_into(first, root, "fact_shipment", NOW, stored=True, unique=True)
        # A first load meets no table: there is nothing to join, and unique keys need no window.
        assert len(saved) == jobs and not any("Join" in p or "Window" in p for p in saved)
        saved.clear()
        refreshing.merge_into(batch, root, "fact_shipment", NOW, stored=True, unique=True)
        assert len(saved) == jobs + 1
        found.append(rows(warehouse.read_edw(spark, root, "fact_shipment")))
    assert found[0] == found[1] and len(found[0]) == 52


def test_landing_names(spark, make, tmp_path):
    zone = tmp_path / "zone"
    put(zone / "FACT_EVENT.csv.gz", "S1,1,Tendered,2024-01-01T05:00:00+00:00,7,x,,", compress=True)
    (zone / "FACT_EVENT_NOTES.csv").write_text("other")
    assert landing.landing_path(spark, str(zone), "fact_event") == [f"{zone}/FACT_EVENT.csv.gz"]
    put(zone / "fact_event_2.csv", "S2,1,Tendered,2024-01-01T05:00:00+00:00,7,x,,")
    both = landing.read_landing_csv(spark, landing.landing_path(spark, str(zone), "fact_event"), "fact_event")
    assert rows(both, "shipment_id") == [("S1",), ("S2",)]
    with pytest.raises(FileNotFoundError):
        landing.landing_path(spark, str(zone), "fact_cost")
    (zone / "swapped.csv").write_text(HEADER.replace("shipment_id,event_seq", "event_seq,shipment_id") + "1,S1,T,,,,,\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        landing.read_raw_csv(spark, str(zone / "swapped.csv"), "fact_event").collect()


def test_padded_keys_meet(spark, make, tmp_path):
    zone = tmp_path / "raw"
    for t in TABLES:
        landing.write_csv(make(t, [{"shipment_id": " S1 ", "event_seq": 1}] if t == "fact_event"
                               else [{"shipment_id": "S1", "leg_id": 1}] if t == "fact_shipment" else []), str(zone / f"{t}.csv"))
    found = {(r.check, r.item): r.value for r in refreshing.load_model(spark, str(zone), str(tmp_path / "m")).collect()}
    assert found["orphans", "EVENT -> SHIPMENT"] == 0


def line(shipment, seq, note, update):
    return f"{shipment},{seq},Tendered,2024-01-01T00:00:00+00:00,1,{note},2024-01-01T00:00:00+00:00,{update}"


def test_stream_equals_batch_and_replay(spark, make, tmp_path):
    """Files arrive out of order; the stream's table is the batch merge of all rows, also after a replay."""
    start = at("2024-01-01T00:00:00")
    lines = [line(f"S{i % 5}", i % 2, f"n{i}", (start + timedelta(hours=(i * 7) % 23)).isoformat() + "+00:00")
             for i in range(23)]
    folder = tmp_path / "in"
    for n in range(4):
        put(folder / f"f{n}.csv", *lines[n::4])
    root = str(tmp_path / "edw")
    for state in ("one", "two"):
        stream = stream_landing(spark, str(folder), "fact_event", max_files=1)
        stream_upsert(stream, root, "fact_event", str(tmp_path / state), NOW).awaitTermination()
    batch = merge.latest_source(landing.read_landing_csv(spark, str(folder), "fact_event"), "fact_event")
    columns = ("shipment_id", "event_seq", "notes", "update_date")
    streamed = warehouse.read_edw(spark, root, "fact_event")
    assert rows(streamed, *columns) == rows(batch, *columns)
    before = streamed.count()  # the files of a month go when it is rewritten

    put(folder / "late.csv", line("S0", 0, "too old", "2023-01-01T00:00:00+00:00"),
        line("S9", 0, "new", "2023-01-01T00:00:00+00:00"))
    stream = stream_landing(spark, str(folder), "fact_event")
    stream_upsert(stream, root, "fact_event", str(tmp_path / "two"), NOW).awaitTermination()
    after = warehouse.read_edw(spark, root, "fact_event")
    assert after.count() == before + 1
    assert after.filter(F.col("notes") == "too old").count() == 0


def test_replayed_files_count_once(spark, tmp_path):
    """Files sent twice, in one run and in a later one, against the batch of all distinct rows; state does not pile up."""
    import os
    import time

    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    now = time.time()

    def send(name, days, *lines):
        put(folder / name, *lines)
        os.utime(folder / name, (now + 86400 * days,) * 2)

    def run():
        stream = stream_landing_once(spark, str(folder), "fact_event", "2 days", max_files=1)
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    old, new = line("S1", 1, "very old", "2001-01-01T00:00:00+00:00"), line("S1", 2, "n", "2024-01-01T00:00:00+00:00")
    nulls = "S3,,,,,,,"
    send("a.csv", 0, old, new, new)
    send("b.csv", 0.1, new, old, nulls)
    run()
    send("c.csv", 1, nulls, old, line("S2", 1, "late", "1999-01-01T00:00:00+00:00"))
    run()
    batch = landing.read_landing_csv(spark, str(folder), "fact_event").distinct()
    assert rows(spark.read.parquet(out)) == rows(batch)
    send("d.csv", 30, line("S9", 1, "x", "2024-01-01T00:00:00+00:00"))
    send("e.csv", 60, line("S9", 2, "x", "2024-01-01T00:00:00+00:00"))
    assert run() <= 2, "rows of files that arrived long ago leave the state"
    assert rows(spark.read.parquet(out)) == rows(landing.read_landing_csv(spark, str(folder), "fact_event").distinct())


def test_loads_count_themselves(spark, make, tmp_path):
    zone = tmp_path / "zone"
    legs = [{"shipment_id": f"S{i}", "leg_id": 1, "status": s, "delivery_actual_ts": at("2024-01-02") if i else None} for i, s in enumerate(("Delivered", "Lost", None))]
    for t in TABLES:
        landing.write_csv(make(t, legs if t == "fact_shipment" else []), str(zone / f"{t}.csv"))
    found = {(r.check, r.item): r.value for r in refreshing.refresh(spark, str(zone), str(tmp_path / "wh"), NOW).collect()}
    counts = {c: n for (c, t), n in found.items() if t == "FACT_SHIPMENT" and c.startswith("loaded_")}
    assert counts == {"loaded_rows": 3, "loaded_delivered": 2, "loaded_in_flight": 1, "loaded_status_out_of_domain": 1}
    assert found["loaded_rows", "DIM_LANE"] == 0 and found["loaded_event_type_out_of_domain", "FACT_EVENT"] == 0


def test_refresh_twice_and_late_update(spark, make, tmp_path):
    zone, root = tmp_path / "zone", str(tmp_path / "wh")
    data = {t: [] for t in TABLES} | {
        "dim_customer": [{"customer_id": 1, "name": "C"}],
        "fact_shipment": [{"shipment_id": "S1", "leg_id": 1, "customer_id": 1, "status": "In-Transit",
                           "delivery_plan_ts": at("2024-01-02"), "update_date": at("2024-01-01")}],
    }

    def land():
        for t in TABLES:
            landing.write_csv(make(t, data[t]), str(zone / f"{t}.csv"))
        return refreshing.refresh(spark, str(zone), root, NOW)

    def shipment():
        return rows(warehouse.read_edw(spark, f"{root}/edw", "fact_shipment"), "status", "isdeliveredontime")

    found = {(r.check, r.item): r.value for r in land().collect()}
    assert found["row_count", "FACT_SHIPMENT"] == 1 and found["fk_missing", "CUSTOMER_ID"] == 0
    data["fact_shipment"][0] |= {"status": "Delivered", "delivery_actual_ts": at("2024-01-02T01:00:00"),
                                 "update_date": at("2024-01-03")}
    land()
    assert shipment() == [("Delivered", True)]
    data["fact_shipment"][0] |= {"status": "Tendered", "update_date": at("2024-01-02")}
    land()
    assert shipment() == [("Delivered", True)], "the older row does not win, and landing again changes nothing else"


def test_load_model(spark, make, tmp_path):
    zone = tmp_path / "raw"
    for t in TABLES:
        data = [{"customer_id": 1, "name": n, "update_date": at(d)} for n, d in (("old", "2024-01-01"), ("new", "2024-01-02"))]
        landing.write_csv(make(t, data if t == "dim_customer" else []), str(zone / f"{t}.csv"))
    for _ in range(2):
        found = {(r.check, r.item): r.value for r in refreshing.load_model(spark, str(zone), str(tmp_path / "m")).collect()}
        assert found["row_count", "DIM_CUSTOMER"] == 1 and found["dup_pk", "DIM_CUSTOMER"] == 0
    model = warehouse.read_edw(spark, str(tmp_path / "m"), "dim_customer", audit=False)
    assert rows(model) == [(1, "new", None, None)]


def test_compressed_landing_files_are_bounded(spark, make, tmp_path, monkeypatch):
    """A compressed file cannot be split, so one holds a bounded number of rows."""
    monkeypatch.setattr(landing, "ROWS_PER_FILE", 10, raising=False)
    customers = make("dim_customer", [{"customer_id": i, "name": f"n{i}"} for i in range(45)]).coalesce(1)
    landing.write_csv(customers, str(tmp_path / "dim_customer.csv"), compression="gzip")
    assert len(list((tmp_path / "dim_customer.csv").glob("*.csv.gz"))) == 5
    assert landing.read_landing_csv(spark, str(tmp_path / "dim_customer.csv"), "dim_customer").count() == 45


def test_replaced_rows_leave_no_copy_and_months_move_without_shuffle(spark, make, tmp_path, monkeypatch):
    """The scratch copy of a rewrite is given back, and rows that lie by month are not shuffled again."""
    staged, hints = [], []
    scratch, hint = warehouse.scratch_path, type(spark.range(1)).hint

    def path(session, label):
        staged.append(scratch(session, label))
        return staged[-1]

    def hinted(df, name, *on):
        hints.append(name)
        return hint(df, name, *on)

    monkeypatch.setattr(warehouse, "scratch_path", path)
    monkeypatch.setattr(type(spark.range(1)), "hint", hinted)
    costs = make("fact_cost", [{"shipment_id": f"S{i}", "load_date": at(f"2024-0{1 + i % 3}-01")} for i in range(30)])
    for _ in range(2):
        warehouse.write_table(costs, str(tmp_path / "edw"), "fact_cost")
    assert len(staged) == 1 and spark.read.parquet(staged[0]).count() == 0
    assert hints == ["rebalance"] * 2, "once per set of rows, not once more for the copy"
    warehouse.publish_snapshot(spark, str(tmp_path / "edw"), str(tmp_path / "bi"), ["fact_cost"])
    assert hints == ["rebalance"] * 2
    months = [f.rsplit("/", 2)[1] for f in spark.read.parquet(str(tmp_path / "bi/fact_cost")).inputFiles()]
    assert set(months) == {"part_month=202401", "part_month=202402", "part_month=202403"}
    assert rows(warehouse.read_edw(spark, str(tmp_path / "bi"), "fact_cost")) == rows(costs)


def test_session_keeps_no_shuffle_files_of_finished_jobs(spark):
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert rows(grouped) == rows(grouped), "a frame that is run again makes its shuffle again"


@pytest.mark.parametrize("repeats", [False, True])
def test_facts_are_staged_without_meeting_by_key_unless_a_key_repeats(spark, make, tmp_path, monkeypatch, repeats):
    seen, latest = [], refreshing.merge.latest_source
    monkeypatch.setattr(refreshing.merge, "latest_source", lambda df, table: seen.append(table) or latest(df, table))
    costs = [{"shipment_id": f"S{i}", "cost_type": "Base", "rate_ref": None, "currency": "old"} for i in range(9)]
    costs += [{"shipment_id": "S3", "cost_type": "Base", "rate_ref": "", "currency": "new", "update_date": at("2024-01-02")}] * repeats
    counts = refreshing.stage_latest(make("fact_cost", costs), str(tmp_path), "fact_cost").get
    assert seen == ["fact_cost"] * repeats and counts["rows"] == 9
    found = rows(warehouse.read_edw(spark, str(tmp_path), "fact_cost"), "shipment_id", "currency")
    assert found == [(f"S{i}", "new" if repeats and i == 3 else "old") for i in range(9)]


def test_staged_rows_and_landing_files_are_given_back(spark, make, tmp_path):
    zone, left = tmp_path / "zone", []
    for t in TABLES:
        landing.write_csv(make(t, [{"shipment_id": "S1"}] if t == "fact_cost" else []), str(zone / f"{t}.csv"))
    refreshing.refresh(spark, str(zone), str(tmp_path / "wh"), NOW, staged=left.append)
    assert left == list(TABLES)
    assert warehouse.read_edw(spark, str(tmp_path / "wh/stg"), "fact_cost").count() == 0
    assert warehouse.read_edw(spark, str(tmp_path / "wh/edw"), "fact_cost").count() == 1


def test_a_large_batch_needs_no_key_index(spark, make, tmp_path, monkeypatch):
    """Rows move out of months that the batch itself does not name, and a later small batch finds all keys."""
    first = make("fact_shipment", [leg(n, 1 + n % 6) for n in range(60)] + [{"leg_id": 1}])
    moved = make("fact_shipment", [leg(n, 7, "2024-02-01") for n in range(0, 60, 3)])
    late = make("fact_shipment", [leg(n, 3, "2024-03-01") for n in (0, 1, 99)])
    found = []
    for most in (1000, 0):
        monkeypatch.setattr(warehouse, "SLICE_ROWS", most)
        root = str(tmp_path / f"edw{most}")
        months = []
        for batch in (first, moved):
            months.append(refreshing.merge_into(batch, root, "fact_shipment", NOW, stored=True))
        made = (tmp_path / f"edw{most}" / "fact_shipment_keys").exists()
        assert made == (most == 1000)
        monkeypatch.setattr(warehouse, "SLICE_ROWS", 1000)
        refreshing.merge_into(late, root, "fact_shipment", NOW, stored=True)
        found.append((months, rows(warehouse.read_edw(spark, root, "fact_shipment"))))
    assert found[0] == found[1] and len(found[0][1]) == 62
