"""Registered queries of sources, sinks, upserts and incremental loads.

Those that go through files write them below the shared folder (see ``session.shared_dir``) and read them back.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.operators import merge
from freightlens.operators.merge import curate, merge_table
from freightlens.plans import binding, refresh as refreshing
from freightlens.plans.daily import DailyTotals
from freightlens.plans.oracle import legs_sql
from freightlens.plans.registry import Bound, register
from freightlens.plans.reports import windows_sql
from freightlens.schemas import AUDIT_COLUMNS, DIM_TABLES, DOMAINS, FACT_TABLES, KEYS, TABLES, typed_schema
from freightlens.session import scratch_path
from freightlens.sources import bucketed, landing, warehouse
from freightlens.streaming.landing import stream_landing as landing_stream
from freightlens.streaming.landing import stream_landing_once as landing_stream_once
from freightlens.streaming.landing import stream_upsert as start_upsert

NOW = datetime(2024, 6, 1)
_NOW_SQL = "TIMESTAMP '2024-06-01'"


def _columns_sql(table: str, audit: bool = True, prefix: str = "") -> str:
    def column(f) -> str:
        cast = f"CAST({prefix}{f.name} AS DOUBLE)" if f.dataType.simpleString().startswith("decimal") else prefix + f.name
        return f"{cast} AS {f.name}"

    return ", ".join(column(f) for f in typed_schema(table, audit))


# --- files --------------------------------------------------------------------------------------------------------


@register(f"SELECT {_columns_sql('fact_shipment')} FROM fact_shipment")
def read_landing_csv(b: Bound) -> DataFrame:
    """Shipments written as gzipped landing CSV and read back with types; the internal column stays behind."""
    path = scratch_path(b.spark, "landing")
    landing.write_csv(b.ship.withColumn("_internal", F.lit(1)), path, compression="gzip")
    return landing.read_landing_csv(b.spark, path, "fact_shipment")


@register("""SELECT CAST(customer_id AS VARCHAR) AS customer_id, name, segment, region,
  '2024-01-01T00:00:00.000000+00:00' AS load_date, '2024-01-01T00:00:00.000000+00:00' AS update_date FROM dim_customer""")
def read_raw_csv(b: Bound) -> DataFrame:
    path = scratch_path(b.spark, "raw")
    landing.write_csv(b.star["dim_customer"], path)
    return landing.read_raw_csv(b.spark, path, "dim_customer")


@register("""SELECT event_type, notes, count(*) AS events, count(DISTINCT shipment_id) AS shipments FROM fact_event
GROUP BY ALL""")
def write_csv(b: Bound) -> DataFrame:
    """Events as CSV: part files with a header, null and blank notes kept apart."""
    path = scratch_path(b.spark, "events")
    landing.write_csv(b.events, path, compression="gzip")
    raw = b.spark.read.options(**landing.CSV_OPTIONS).schema(", ".join(f"{c} STRING" for c in b.events.columns)).csv(path)
    return raw.groupBy("event_type", "notes").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("shipment_id").alias("shipments")
    )


@register(f"SELECT {_columns_sql('fact_cost')} FROM fact_cost")
def write_table(b: Bound) -> DataFrame:
    """Half of the costs written as a full replacement, the other half as an append, and read back."""
    root = scratch_path(b.spark, "edw")
    half = F.expr("length(shipment_id) % 2 = 0 OR right(shipment_id, 1) < '5'")
    warehouse.write_table(b.cost.filter(half), root, "fact_cost")
    warehouse.write_table(b.cost.filter(~half), root, "fact_cost", mode="append")
    return warehouse.read_edw(b.spark, root, "fact_cost")


@register("SELECT status, count(*) AS legs, CAST(sum(revenue) AS DOUBLE) AS revenue FROM fact_shipment GROUP BY 1")
def read_edw(b: Bound) -> DataFrame:
    root = scratch_path(b.spark, "edw")
    warehouse.write_table(b.ship, root, "fact_shipment")
    kept = warehouse.read_edw(b.spark, root, "fact_shipment")
    return kept.groupBy("status").agg(F.count(F.lit(1)).alias("legs"), F.sum("revenue").alias("revenue"))


_COUNTS_SQL = " UNION ALL ".join(f"SELECT '{t.upper()}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)


@register(_COUNTS_SQL)
def publish_snapshot(b: Bound) -> DataFrame:
    src, dst = scratch_path(b.spark, "edw"), scratch_path(b.spark, "bi")
    for name, df in b.stored_star.items():
        warehouse.write_table(df, src, name)
    return warehouse.publish_snapshot(b.spark, src, dst)


@register("SELECT customer_id, name, segment, region FROM dim_customer")
def normalize_columns(b: Bound) -> DataFrame:
    loaded = b.star["dim_customer"].drop(*AUDIT_COLUMNS)
    return landing.normalize_columns(loaded.toDF("CUSTOMER_ID", "Name", "SEGMENT", "Region"))


@register("SELECT p_name AS name, count(*) AS n FROM part WHERE p_size % 5 > 1 GROUP BY 1", bound=False)
def read_name_seeds(b: Bound) -> DataFrame:
    """Part names as a list file with padding, blank lines and comments."""
    path = scratch_path(b.spark, "seeds")
    lines = b.table("part").selectExpr(
        "CASE p_size % 5 WHEN 0 THEN concat('# ', p_name) WHEN 1 THEN '   ' WHEN 2 THEN concat('  ', p_name, '\t') "
        "ELSE p_name END AS value"
    )
    lines.write.text(path)
    return landing.read_name_seeds(b.spark, path).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


# --- upserts ------------------------------------------------------------------------------------------------------


def _merge_sql(table: str, guarded: bool, stamp: bool, fill: bool) -> str:
    """The merge of CTEs ``s`` into ``t`` as a full join."""
    names = typed_schema(table).names
    keys = KEYS[table]
    match = " AND ".join(
        f"coalesce(t.{k}, '') = coalesce(s.{k}, '')" if k == "rate_ref" else f"t.{k} = s.{k}" for k in keys
    )
    take = "s.update_date >= t.update_date" if guarded else "true"

    def column(name: str) -> str:
        if name in AUDIT_COLUMNS:
            fresh = f"coalesce(s.{name}, {_NOW_SQL})" if fill else f"s.{name}"
            changed = "t.load_date"
            if name == "update_date":
                changed = f"coalesce(s.update_date, {_NOW_SQL})" if stamp else "s.update_date"
        else:
            fresh = f"s.{name}"
            changed = f"t.{name}" if name in keys else f"s.{name}"
        value = (
            f"CASE WHEN t.{keys[0]} IS NULL THEN {fresh} WHEN s.{keys[0]} IS NOT NULL AND {take} THEN {changed} "
            f"ELSE t.{name} END"
        )
        kind = typed_schema(table)[name].dataType.simpleString()
        return f"CAST({value} AS DOUBLE) AS {name}" if kind.startswith("decimal") else f"{value} AS {name}"

    return f"SELECT {', '.join(column(n) for n in names)} FROM t FULL JOIN s ON {match}"


# The source is the whole dimension with keys moved up by one, so that most rows change, the rows of new keys are
# inserted and the first key keeps its row; text gets a suffix and some audit times are missing.
def _dim_source(table: str, ntz: str) -> list[str]:
    key = KEYS[table][0]
    kinds = {f.name: f.dataType.simpleString() for f in typed_schema(table, audit=False)}
    return [
        *[
            f"{c} + 1 AS {c}" if c == key else f"{c} || ' v2' AS {c}" if kind == "string" else c
            for c, kind in kinds.items()
        ],
        f"CASE WHEN {key} % 5 > 0 THEN {ntz} '2024-02-01' END AS load_date",
        f"CASE WHEN {key} % 7 > 0 THEN {ntz} '2023-02-01' END AS update_date",
    ]


def _dim_ctes(table: str) -> str:
    changed = ", ".join(_dim_source(table, "TIMESTAMP"))
    return f"t AS (SELECT * FROM {table}), s AS (SELECT {changed} FROM {table})"


def _dim_sides(b: Bound, table: str) -> tuple[DataFrame, DataFrame]:
    full = b.star[table]
    return full, full.selectExpr(*_dim_source(table, "TIMESTAMP_NTZ"))


def _register_dim_merge(table: str) -> None:
    def merged(b: Bound) -> DataFrame:
        target, source = _dim_sides(b, table)
        return merge.merge_dim(target, source, KEYS[table], NOW)

    merged.__name__ = f"merge_{table}"
    merged.__doc__ = f"Unguarded upsert of {table}."
    register(_merge_sql(table, guarded=False, stamp=True, fill=True), extra=_dim_ctes(table))(merged)


for _table in DIM_TABLES:
    _register_dim_merge(_table)


# Facts: the target holds the line versions already returned or accepted, the source the new ones.
_TARGET_LINES, _SOURCE_LINES = "l_returnflag <> 'N'", "l_returnflag = 'N'"


def _versions(b: Bound) -> tuple[DataFrame, DataFrame]:
    lines = b.table("lineitem")
    sides = (binding.source_legs(b.spark, b.sf_dir, lines.filter(c)) for c in (_TARGET_LINES, _SOURCE_LINES))
    target, source = sides
    return target, source.withColumn("update_date", F.expr("IF(_h % 31 > 0, update_date, NULL)"))


def _version_ctes() -> str:
    target = legs_sql("t_legs", f"(SELECT * FROM lineitem WHERE {_TARGET_LINES})").lstrip()
    source = legs_sql("s_all", f"(SELECT * FROM lineitem WHERE {_SOURCE_LINES})").lstrip()
    gaps = "s_legs AS (SELECT * REPLACE (CASE WHEN h % 31 > 0 THEN update_date END AS update_date) FROM s_all)"
    return f"{target},\n{source},\n{gaps}"


@register(
    _merge_sql("fact_shipment", guarded=True, stamp=True, fill=True),
    extra=f"{_version_ctes()}, t AS (SELECT * FROM t_legs), s AS (SELECT * FROM s_legs)",
)
def merge_fact_shipment(b: Bound) -> DataFrame:
    target, source = _versions(b)
    return merge_table(binding.shipments_of(target), binding.shipments_of(source), "fact_shipment", NOW)


_TENDER_EVENTS = """SELECT shipment_id, CAST(leg_id*10 + 1 AS INTEGER) AS event_seq, status AS event_type,
  tender_ts AS event_ts, origin_loc_id AS facility_loc_id, mode AS notes, load_date, update_date FROM {legs}"""


def _status_events(leg: DataFrame) -> DataFrame:
    return leg.selectExpr(
        "shipment_id", "CAST(leg_id * 10 + 1 AS INT) AS event_seq", "status AS event_type", "tender_ts AS event_ts",
        "origin_loc_id AS facility_loc_id", "_mode AS notes", "load_date", "update_date",
    )


@register(
    _merge_sql("fact_event", guarded=True, stamp=True, fill=True),
    extra=f"{_version_ctes()}, t AS ({_TENDER_EVENTS.format(legs='t_legs')}), "
    f"s AS ({_TENDER_EVENTS.format(legs='s_legs')})",
)
def merge_fact_event(b: Bound) -> DataFrame:
    target, source = _versions(b)
    return merge_table(_status_events(target), _status_events(source), "fact_event", NOW)


_LEG_COSTS = """SELECT shipment_id, 'Leg ' || leg_id AS cost_type, 'flat' AS calc_method, {empty} AS rate_ref,
  total_cost AS cost_amount, 'USD' AS currency, load_date, update_date FROM {legs}"""


def _leg_costs(leg: DataFrame, empty: str) -> DataFrame:
    return leg.selectExpr(
        "shipment_id", "concat('Leg ', leg_id) AS cost_type", "'flat' AS calc_method", f"{empty} AS rate_ref",
        "total_cost AS cost_amount", "'USD' AS currency", "load_date", "update_date",
    )


@register(
    _merge_sql("fact_cost", guarded=True, stamp=True, fill=True),
    extra=f"{_version_ctes()}, t AS ({_LEG_COSTS.format(legs='t_legs', empty='CAST(NULL AS VARCHAR)')}), "
    + "s AS (" + _LEG_COSTS.format(legs="s_legs", empty="''") + ")",
)
def merge_fact_cost(b: Bound) -> DataFrame:
    """Costs whose rate reference is null on one side and empty on the other are the same cost."""
    target, source = _versions(b)
    return merge_table(_leg_costs(target, "CAST(NULL AS STRING)"), _leg_costs(source, "''"), "fact_cost", NOW)


_FACT_ROWS = {
    "fact_shipment": lambda leg, _: binding.shipments_of(leg),
    "fact_event": lambda leg, _: _status_events(leg),
    "fact_cost": lambda leg, new: _leg_costs(leg, "''" if new else "CAST(NULL AS STRING)"),
}


def _register_bucketed_merge(table: str, target_sql: str, source_sql: str) -> None:
    def merged(b: Bound) -> DataFrame:
        target, source = _versions(b)
        root, rows_of = scratch_path(b.spark, "bucketed"), _FACT_ROWS[table]
        # A row per line version at most; the count comes from the files' footers.
        buckets = bucketed.buckets_for(b.table("lineitem").count(), least=8)
        bucketed.write_bucketed(rows_of(target, 0), root, table, buckets)
        bucketed.merge_bucketed(rows_of(source, 1), root, table, NOW, buckets)
        return bucketed.read_bucketed(b.spark, root, table, buckets)

    merged.__name__ = f"merge_bucketed_{table}"
    merged.__doc__ = f"The upsert of {table} into a target that lies in buckets of its key."
    register(
        _merge_sql(table, guarded=True, stamp=True, fill=True),
        extra=f"{_version_ctes()}, t AS ({target_sql}), s AS ({source_sql})",
    )(merged)


_register_bucketed_merge("fact_shipment", "SELECT * FROM t_legs", "SELECT * FROM s_legs")
_register_bucketed_merge("fact_event", _TENDER_EVENTS.format(legs="t_legs"), _TENDER_EVENTS.format(legs="s_legs"))
_register_bucketed_merge(
    "fact_cost",
    _LEG_COSTS.format(legs="t_legs", empty="CAST(NULL AS VARCHAR)"),
    _LEG_COSTS.format(legs="s_legs", empty="''"),
)

_FLAGS = """coalesce(delivery_actual_ts <= delivery_plan_ts + INTERVAL 60 MINUTE, false) AS isdeliveredontime,
  coalesce(delivery_actual_ts <= delivery_plan_ts + INTERVAL 60 MINUTE AND isinfull, false) AS isotif"""
_CURATED = f"SELECT * REPLACE ({_FLAGS}) FROM s_legs"


@register(
    _merge_sql("fact_shipment", guarded=True, stamp=False, fill=False),
    extra=f"{_version_ctes()}, t AS (SELECT * FROM t_legs), s AS ({_CURATED})",
)
def curate_fact_shipment(b: Bound) -> DataFrame:
    target, source = _versions(b)
    sides = [{"fact_shipment": binding.shipments_of(leg)} for leg in (source, target)]
    return curate(*sides, now=NOW)["fact_shipment"]


def _register_dim_curation(table: str) -> None:
    def curated(b: Bound) -> DataFrame:
        target, source = _dim_sides(b, table)
        same = {"fact_shipment": b.ship}
        return curate({table: source, **same}, {table: target, **same}, now=NOW)[table]

    curated.__name__ = f"curate_{table}"
    curated.__doc__ = f"Curation of {table}: update times are copied as they are on a match and filled on an insert."
    register(_merge_sql(table, guarded=False, stamp=False, fill=True), extra=_dim_ctes(table))(curated)


for _table in DIM_TABLES:
    _register_dim_curation(_table)


def _register_fact_curation(table: str, rows_of, target_sql: str, source_sql: str) -> None:
    def curated(b: Bound) -> DataFrame:
        target, source = _versions(b)
        same = {"fact_shipment": b.ship}
        return curate({table: rows_of(source, 1), **same}, {table: rows_of(target, 0), **same}, now=NOW)[table]

    curated.__name__ = f"curate_{table}"
    curated.__doc__ = f"Curation of {table}: audit times are copied as they are."
    register(
        _merge_sql(table, guarded=True, stamp=False, fill=False),
        extra=f"{_version_ctes()}, t AS ({target_sql}), s AS ({source_sql})",
    )(curated)


_register_fact_curation(
    "fact_event",
    lambda leg, _: _status_events(leg),
    _TENDER_EVENTS.format(legs="t_legs"),
    _TENDER_EVENTS.format(legs="s_legs"),
)
_register_fact_curation(
    "fact_cost",
    lambda leg, new: _leg_costs(leg, "''" if new else "CAST(NULL AS STRING)"),
    _LEG_COSTS.format(legs="t_legs", empty="CAST(NULL AS VARCHAR)"),
    _LEG_COSTS.format(legs="s_legs", empty="''"),
)


# --- daily totals kept up to date ---------------------------------------------------------------------------------


def _kept_up_to_date(b: Bound) -> DailyTotals:
    """Shipments and their totals after three batches: old versions, new versions, and old versions again that come too
    late; the second batch is sent twice."""
    target, source = (binding.shipments_of(leg) for leg in _versions(b))
    late = target.withColumns({"status": F.lit("Cancelled"), "update_date": F.expr("update_date - INTERVAL '3650' DAY")})
    totals = DailyTotals(b.spark, scratch_path(b.spark, "daily"))
    for batch, rows in (("1-old", target), ("2-new", source), ("2-new", source), ("3-late", late)):
        totals.merge(batch, rows, NOW)
    return totals


_FINAL_CTES = f"""{_version_ctes()}, t AS (SELECT * FROM t_legs), s AS (SELECT * FROM s_legs),
final AS ({_merge_sql("fact_shipment", guarded=True, stamp=True, fill=True)}),
final_delivered AS (SELECT *, CAST(delivery_actual_ts AS DATE) AS d,
  coalesce(delivery_actual_ts <= delivery_plan_ts + INTERVAL 60 MINUTE, false) AS on_time,
  date_diff('day', CAST(pickup_actual_ts AS DATE), CAST(delivery_actual_ts AS DATE)) AS transit
  FROM final WHERE delivery_actual_ts IS NOT NULL)"""


def _cents(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(12,2))) AS DOUBLE) AS {column}"


@register(
    f"""SELECT d, count(*) AS n, count(*) FILTER (WHERE on_time) AS on_time, count(transit) AS moved,
  CAST(coalesce(sum(transit), 0) AS BIGINT) AS transit_days, {_cents('revenue')}, {_cents('total_cost')},
  {_cents('planned_miles')} FROM final_delivered GROUP BY d""",
    extra=_FINAL_CTES,
)
def daily_totals(b: Bound) -> DataFrame:
    """The days of shipments merged in three batches, one of them sent twice and one late."""
    return _kept_up_to_date(b).days()


@register(windows_sql(30, "(SELECT *, max(d) OVER () AS a FROM final_delivered)"), extra=_FINAL_CTES)
def daily_totals_otd_windows(b: Bound) -> DataFrame:
    """The on-time windows from days that merges have kept up to date."""
    return _kept_up_to_date(b).otd_windows()


# --- incremental --------------------------------------------------------------------------------------------------


def _activity(b: Bound) -> DataFrame:
    """The event stream in the form of event landing rows; later rows of a (user, type) replace earlier ones."""
    kinds = "array('click', 'error', 'purchase', 'signup', 'view')"
    return b.table("events").selectExpr(
        "concat('U', user_id) AS shipment_id", f"CAST(array_position({kinds}, event_type) AS INT) AS event_seq",
        "event_type", "ts AS event_ts", "event_id AS facility_loc_id", "props AS notes", "ts AS load_date",
        "ts AS update_date",
    )


_ACTIVITY_SQL = """SELECT 'U' || user_id AS shipment_id,
  CAST(list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS INTEGER) AS event_seq,
  event_type, ts AS event_ts, event_id AS facility_loc_id, props AS notes, ts AS update_date FROM events"""


def _landed_files(b: Bound) -> str:
    """Activity as several landing files, split by user and not by time, so that files arrive out of order."""
    path = scratch_path(b.spark, "activity")
    landing.write_csv(_activity(b).repartition(4, "event_seq", "event_ts"), path)
    return path


@register(f"SELECT * EXCLUDE (update_date) FROM ({_ACTIVITY_SQL})", bound=False)
def stream_landing(b: Bound) -> DataFrame:
    out, state = scratch_path(b.spark, "sink"), scratch_path(b.spark, "state")
    stream = landing_stream(b.spark, _landed_files(b), "fact_event", max_files=1)
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()
    return b.spark.read.schema(typed_schema("fact_event")).parquet(out).drop(*AUDIT_COLUMNS)


@register(f"SELECT DISTINCT * EXCLUDE (update_date) FROM ({_ACTIVITY_SQL})", bound=False)
def stream_landing_once(b: Bound) -> DataFrame:
    """Every file lands twice, under another name the second time; the sink has each row once."""
    path = _landed_files(b)
    landing.write_csv(_activity(b).repartition(3, "event_ts"), path, mode="append")
    out, state = scratch_path(b.spark, "sink"), scratch_path(b.spark, "state")
    stream = landing_stream_once(b.spark, path, "fact_event", "1 day", max_files=2)
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()
    return b.spark.read.schema(typed_schema("fact_event")).parquet(out).drop(*AUDIT_COLUMNS)


@register(
    f"""SELECT * FROM ({_ACTIVITY_SQL}) QUALIFY row_number() OVER (PARTITION BY shipment_id, event_seq
ORDER BY event_ts DESC, facility_loc_id DESC) = 1""",
    bound=False,
)
def stream_upsert(b: Bound) -> DataFrame:
    """Files arrive one per batch, and all of them a second time: the replay changes nothing."""
    files, root = _landed_files(b), scratch_path(b.spark, "edw")
    for _ in range(2):
        stream = landing_stream(b.spark, files, "fact_event", max_files=1)
        start_upsert(stream, root, "fact_event", scratch_path(b.spark, "state"), NOW).awaitTermination()
    return warehouse.read_edw(b.spark, root, "fact_event").drop("load_date")


_CHECKS_SQL = f"""SELECT 'row_count' AS "check", table_name AS item, row_count AS value FROM ({_COUNTS_SQL})
UNION ALL SELECT 'dup_pk', unnest([{', '.join(f"'{t.upper()}'" for t in TABLES)}]), 0
UNION ALL SELECT 'fk_missing', unnest(['CARRIER_ID', 'CUSTOMER_ID', 'EQUIPMENT_ID', 'DEST_LOC_ID', 'LANE_ID',
  'ORIGIN_LOC_ID']), 0
UNION ALL SELECT 'orphans', unnest(['COST -> SHIPMENT', 'EVENT -> SHIPMENT']), 0"""


_LOADED_SQL = " ".join(
    f"UNION ALL SELECT 'loaded_{name}', '{table.upper()}', {value} FROM {table}"
    for table in TABLES
    for name, value in (
        ("rows", "count(*)"),
        *((("delivered", "count(delivery_actual_ts)"), ("in_flight", "count(*) - count(delivery_actual_ts)")) if table == "fact_shipment" else ()),
        *((f"{c}_out_of_domain", f"count(*) FILTER (WHERE {c} NOT IN ({', '.join(repr(v) for v in values)}))") for t, c, values in DOMAINS if t == table),
    )
)


def _landing_zone(b: Bound) -> str:
    zone = scratch_path(b.spark, "zone")
    for name, df in b.stored_star.items():
        landing.write_csv(df, f"{zone}/{name}.csv", compression="gzip")
    return zone


def _refreshed(b: Bound, zone: str, root: str) -> DataFrame:
    """A refresh from a landing zone of the query's own, whose files are given back when they are staged."""

    def give_back(table: str) -> None:
        none = b.spark.createDataFrame([], typed_schema(table))
        landing.write_csv(none, f"{zone}/{table}.csv", compression="gzip")

    # Dimensions land once and are read again with every delivery.
    return refreshing.refresh(b.spark, zone, root, NOW, staged=lambda t: give_back(t) if t in FACT_TABLES else None)


@register(f"{_CHECKS_SQL} {_LOADED_SQL}")
def refresh(b: Bound) -> DataFrame:
    """Landing files through staging and curation to the checks and the counts of the loads."""
    return _refreshed(b, _landing_zone(b), scratch_path(b.spark, "warehouse"))


@register(_CHECKS_SQL)
def load_model(b: Bound) -> DataFrame:
    """Raw text files to model tables and their checks."""
    return refreshing.load_model(b.spark, _landing_zone(b), scratch_path(b.spark, "model"))


# A second delivery after the first: some rows again, each changed, half of them too old to count.
_SECOND = {
    "fact_shipment": ("leg_id % 3 = 0", "leg_id % 2 = 0", {"status": "'In-Transit'", "pieces": "pieces + 1"}),
    "fact_event": ("event_seq % 3 = 0", "event_seq % 2 = 0", {"notes": "'again'", "event_ts": "event_ts + INTERVAL '40' DAY"}),
    "fact_cost": ("calc_method = 'flat'", "right(rate_ref, 1) IN ('2', '4', '6')", {"currency": "'EUR'"}),
}


def _register_refreshed(table: str) -> None:
    which, late, changes = _SECOND[table]
    stamp = f"update_date + (CASE WHEN {late} THEN INTERVAL '-1' DAY ELSE INTERVAL '1' DAY END)"
    changed = {**changes, "update_date": stamp}

    def refreshed(b: Bound) -> DataFrame:
        zone, root = _landing_zone(b), scratch_path(b.spark, "warehouse")
        _refreshed(b, zone, root)
        again = b.stored_star[table].filter(which)
        kept = [f"{changed.get(c, c)} AS {c}" for c in again.columns]
        for name in _SECOND:
            rows = again.selectExpr(*kept) if name == table else b.stored_star[name].limit(0)
            landing.write_csv(rows, f"{zone}/{name}.csv", compression="gzip")
        _refreshed(b, zone, root)
        return warehouse.read_edw(b.spark, f"{root}/edw", table)

    refreshed.__name__ = f"refresh_{table}"
    refreshed.__doc__ = f"{table} after a second landing with changed and late rows."
    replaced = ", ".join(f"{e} AS {c}" for c, e in changed.items())
    # What landing does on the way: flags of shipments are recomputed, blank text is missing.
    blank = "nullif(trim(notes), '') AS notes"
    flags = {
        "fact_shipment": f"SELECT * REPLACE ({_FLAGS}) FROM ",
        "fact_event": f"SELECT * REPLACE ({blank}) FROM ",
    }.get(table, "SELECT * FROM ")
    second = f"{flags}(SELECT * REPLACE ({replaced}) FROM {table} WHERE {which})"
    register(_merge_sql(table, True, False, False), extra=f"t AS ({flags}{table}), s AS ({second})")(refreshed)


for _table in _SECOND:
    _register_refreshed(_table)
