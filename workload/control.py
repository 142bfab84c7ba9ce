"""Constraints, control rows, gates and comparisons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators import aggregates as A
from tidegate.operators import checks, gates, joins, split
from tidegate.operators.control import upsert_runs
from workload import inbound, review, shapes
from workload.oracle import sql
from workload.registry import query


@query(sql(
    "SELECT strftime(business_date, '%Y-%m-%d') AS business_date, client_id_raw, COUNT(*) AS row_count"
    " FROM c_norm GROUP BY business_date, client_id_raw HAVING COUNT(*) > 1"
))
def repeated_client_keys(spark, sf_dir):
    return checks.check_unique(inbound.parsed_clients(spark, sf_dir), ["business_date", "client_id_raw"])


@query(sql(
    "SELECT strftime(t.business_date, '%Y-%m-%d') AS business_date, t.client_id, COUNT(*) AS row_count"
    " FROM t_stage t WHERE NOT EXISTS (SELECT 1 FROM c_stage c WHERE c.business_date = t.business_date"
    " AND c.client_id = t.client_id) GROUP BY t.business_date, t.client_id"
))
def broken_client_links(spark, sf_dir):
    return checks.check_fk(
        inbound.split_transfers(spark, sf_dir).stage,
        inbound.split_clients(spark, sf_dir).stage,
        ["business_date", "client_id"],
    )


_CHECKS = {
    **S.MART_CHECKS,
    "score_below_900": "risk_score < 900",
    "eur_only": "currency_code = 'EUR'",
    "small": "amount_eur <= 15000",
}


@query(sql(" UNION ALL ".join(
    f"SELECT '{n}' AS check_name, COUNT(*) FILTER (WHERE NOT ({c})) AS violations FROM mart"
    for n, c in _CHECKS.items()
)))
def mart_constraints(spark, sf_dir):
    return checks.check_expr(review.mart(spark, sf_dir), _CHECKS)


_REQUIRED = ["client_type_raw", "kyc_status_raw", "date_of_birth_raw", "email_raw", "first_name_raw"]


@query(sql(" UNION ALL ".join(
    f"SELECT '{c}' AS check_name, COUNT(*) - COUNT({c}) AS violations FROM c_norm" for c in _REQUIRED
)))
def missing_values(spark, sf_dir):
    return checks.check_not_null(inbound.parsed_clients(spark, sf_dir), _REQUIRED)


# --- Control rows ------------------------------------------------------------
# Attempts come from the event log: one process per event type, one business date
# per day, one event per logged row; waiting attempts are the errors.

_PROCESS = "concat('PROC_', upper(event_type))"
_START = dt.datetime(2026, 4, 20, 6, 0)


def run_events(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", "WAITING").otherwise("DONE")
    waiting = (F.col("value") > 20).cast("int")
    return shapes.table(spark, sf_dir, "events").select(
        F.expr(_PROCESS).alias("process_name"),
        F.to_date("ts").alias("business_date"),
        F.lit("AUTO").alias("run_mode"),
        status.alias("status"),
        F.when(waiting == 1, "WAITING_FOR_OK").alias("reason_code"),
        F.when(F.col("event_id") % 5 > 0, F.col("ts")).alias("scheduled_for_ts"),
        F.col("ts").alias("next_retry_ts"),
        F.col("ts").alias("started_ts"),
        F.col("ts").alias("finished_ts"),
        F.col("user_id").alias("expected_row_count"),
        F.when(F.col("user_id") % 4 > 0, F.col("user_id")).alias("stage_row_count"),
        F.lit(0).cast("long").alias("reject_row_count"),
        F.lit(None).cast("long").alias("core_row_count"),
        F.lit(None).cast("string").alias("data_file_name"),
        F.lit(None).cast("string").alias("ready_file_name"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("status_message"),
        F.col("event_id").alias("event_seq"),
        F.col("ts").alias("event_ts"),
        F.when(F.col("event_id") % 7 == 0, -2).otherwise(waiting).alias("retry_count_delta"),
        (F.col("event_id") % 97 == 0).cast("int").alias("reset_retry_count"),
    )


def old_control(spark, sf_dir):
    """Rows of earlier runs: a quarter of the (process, date) keys, and processes of their own."""
    events = shapes.table(spark, sf_dir, "events")
    keys = events.select(F.expr(_PROCESS).alias("process_name"), F.to_date("ts").alias("business_date")).distinct()
    known = keys.filter(F.day("business_date") % 4 == 0)
    other = keys.select(F.concat("process_name", F.lit("_OLD")).alias("process_name"), "business_date")
    rows = known.unionByName(other)
    values = {
        "run_mode": F.lit("MANUAL"),
        "status": F.lit("FAILED"),
        "retry_count": F.lit(3),
        "scheduled_for_ts": F.when(
            F.day("business_date") % 8 == 0, F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
        ),
        "stage_row_count": F.lit(0).cast("long"),
        "reject_row_count": F.lit(0).cast("long"),
        "core_row_count": F.lit(0).cast("long"),
    }
    return rows.select(
        *[
            (
                F.col(f.name)
                if f.name in ("process_name", "business_date")
                else values.get(f.name, F.lit(None)).cast(f.dataType)
            ).alias(f.name)
            for f in S.CONTROL_SCHEMA
        ]
    )


_CONTROL_COLUMNS = [
    "process_name", "business_date", "run_mode", "status", "reason_code", "retry_count", "scheduled_for_ts",
    "next_retry_ts", "expected_row_count", "stage_row_count", "core_row_count", "status_message",
]

# The retry counter is clamped at every step, so the SQL folds the events of a key one by one.
_UPSERT = f"""SELECT coalesce(n.process_name, o.process_name) AS process_name,
  strftime(coalesce(n.business_date, o.business_date), '%Y-%m-%d') AS business_date,
  CASE WHEN n.process_name IS NOT NULL THEN 'AUTO' ELSE 'MANUAL' END AS run_mode,
  CASE WHEN n.process_name IS NULL THEN 'FAILED' ELSE n.status END AS status,
  n.reason_code AS reason_code,
  CAST(CASE WHEN n.process_name IS NULL THEN 3 ELSE list_reduce(
    list_prepend(CASE WHEN o.process_name IS NULL THEN 0 ELSE 3 END, n.deltas),
    lambda a, d: CASE WHEN d = -99 THEN 0 ELSE greatest(0, a + d) END) END AS INTEGER) AS retry_count,
  CASE WHEN day(coalesce(n.business_date, o.business_date)) % 8 = 0 AND o.process_name IS NOT NULL
    THEN '2026-01-01 00:00:00' ELSE strftime(n.first_scheduled, '%Y-%m-%d %H:%M:%S') END AS scheduled_for_ts,
  strftime(n.last_ts, '%Y-%m-%d %H:%M:%S') AS next_retry_ts,
  n.user_id AS expected_row_count,
  CASE WHEN n.user_id % 4 > 0 THEN n.user_id ELSE 0 END AS stage_row_count,
  CAST(0 AS BIGINT) AS core_row_count,
  'event ' || CAST(n.event_id AS VARCHAR) AS status_message
FROM (SELECT {_PROCESS} AS process_name, CAST(ts AS DATE) AS business_date,
    list(CASE WHEN event_id % 97 = 0 THEN -99 WHEN event_id % 7 = 0 THEN -2 WHEN value > 20 THEN 1 ELSE 0 END
      ORDER BY event_id) AS deltas,
    arg_max(CASE WHEN event_type = 'error' THEN 'WAITING' ELSE 'DONE' END, event_id) AS status,
    CASE WHEN arg_max(value, event_id) > 20 THEN 'WAITING_FOR_OK' END AS reason_code,
    arg_min(ts, event_id) FILTER (WHERE event_id % 5 > 0) AS first_scheduled,
    arg_max(ts, event_id) AS last_ts, arg_max(user_id, event_id) AS user_id, max(event_id) AS event_id
  FROM events GROUP BY ALL) n
FULL OUTER JOIN (SELECT DISTINCT {_PROCESS} AS process_name, CAST(ts AS DATE) AS business_date
    FROM events WHERE day(ts) % 4 = 0
  UNION ALL SELECT DISTINCT {_PROCESS} || '_OLD', CAST(ts AS DATE) FROM events) o
ON o.process_name = n.process_name AND o.business_date = n.business_date"""


@query(_UPSERT)
def control_upsert(spark, sf_dir):
    return upsert_runs(old_control(spark, sf_dir), run_events(spark, sf_dir)).select(*_CONTROL_COLUMNS)


def _load_rows(counts, process):
    """Control rows of a load, from the row counts of its split."""
    return gates.load_status(counts).select(F.lit(process).alias("process_name"), "business_date", "status")


def load_control(spark, sf_dir):
    """Control rows of both loads and the mart, with statuses derived from the splits' counts."""
    loads = A.union_all([
        _load_rows(split.split_counts(inbound.judged_transfers(spark, sf_dir), S.TRANSFERS), S.LOAD_TRANSFERS),
        _load_rows(split.split_counts(inbound.judged_clients(spark, sf_dir), S.CLIENTS), S.LOAD_CLIENTS),
    ])
    marts = loads.filter(F.col("process_name") == S.LOAD_CLIENTS).select(
        F.lit(S.BUILD_MART).alias("process_name"),
        "business_date",
        F.when(F.day("business_date") == 19, "FAILED").otherwise("DONE").alias("status"),
    )
    return loads.unionByName(marts)


_CONTROL_SQL = """SELECT 'LOAD_CLIENT_TRANSFERS' AS process_name, business_date,
    CASE WHEN business_date IN (SELECT business_date FROM t_reject) THEN 'WARNING' ELSE 'DONE' END AS status
  FROM (SELECT DISTINCT business_date FROM inbound_transfers) a
  UNION ALL SELECT 'LOAD_CLIENTS', business_date,
    CASE WHEN business_date IN (SELECT business_date FROM c_reject) THEN 'WARNING' ELSE 'DONE' END
  FROM (SELECT DISTINCT business_date FROM inbound_clients) b
  UNION ALL SELECT 'BUILD_MART_TRANSFER_AML', business_date, CASE day(business_date) WHEN 19 THEN 'FAILED' ELSE 'DONE' END
  FROM (SELECT DISTINCT business_date FROM inbound_clients) c"""


def _gate_sql(required, statuses):
    names = ", ".join(f"'{p}'" for p in required)
    allowed = ", ".join(f"'{s}'" for s in statuses)
    return sql(
        "SELECT strftime(business_date, '%Y-%m-%d') AS business_date, COUNT(*) FILTER (WHERE process_name IN"
        f" ({names}) AND status IN ({allowed})) AS ready_processes, CASE WHEN COUNT(*) FILTER (WHERE process_name IN"
        f" ({names}) AND status IN ({allowed})) >= {len(required)} THEN 1 ELSE 0 END AS is_open"
        f" FROM ({_CONTROL_SQL}) ctl GROUP BY business_date"
    )


_MART_GATE = ((S.LOAD_CLIENTS, S.LOAD_TRANSFERS), ("DONE", "WARNING"))
_SPOOL_GATE = ((S.LOAD_CLIENTS, S.LOAD_TRANSFERS, S.BUILD_MART), ("DONE",))


@query(_gate_sql(*_MART_GATE))
def mart_gate(spark, sf_dir):
    return gates.gate(load_control(spark, sf_dir), *_MART_GATE)


@query(_gate_sql(*_SPOOL_GATE))
def spool_gate(spark, sf_dir):
    return gates.gate(load_control(spark, sf_dir), *_SPOOL_GATE)


# --- Expected against actual -------------------------------------------------


def _layer(counts, name, process):
    return counts.select(F.lit(process).alias("process_name"), "business_date", F.col(name).alias("row_count"))


def run_layers(spark, sf_dir):
    """Expected transfer runs with their control row and layer counts."""
    # A row per date, stored because three tables come from it and the rows are to be judged once.
    judged = inbound.judged_transfers(spark, sf_dir)
    counts = inbound.stored(spark, split.split_counts(judged, S.TRANSFERS), "counts")
    expected = inbound.promised_counts(spark, sf_dir).select(
        F.lit(S.LOAD_TRANSFERS).alias("process_name"),
        "business_date",
        F.lit("MANUAL").alias("run_mode"),
        F.col("expected_row_count").alias("promised_row_count"),
    )
    control = (
        _load_rows(counts, S.LOAD_TRANSFERS)
        .withColumns({"run_mode": F.lit("MANUAL"), "ctl_status": F.col("status")})
        .drop("status")
        .filter(F.day("business_date") != 19)
    )
    return joins.layer_counts(
        expected,
        control,
        {
            "actual_stage_rows": _layer(counts, "stage_row_count", S.LOAD_TRANSFERS),
            "actual_reject_rows": _layer(counts, "reject_row_count", S.LOAD_TRANSFERS),
        },
    )


_LAYERS = """SELECT 'LOAD_CLIENT_TRANSFERS' AS process_name, business_date, 'MANUAL' AS run_mode,
  expected_row_count AS promised_row_count,
  CASE WHEN day(business_date) <> 19 THEN CASE WHEN reject_row_count > 0 THEN 'WARNING' ELSE 'DONE' END END
    AS ctl_status,
  stage_row_count AS actual_stage_rows, reject_row_count AS actual_reject_rows FROM t_counts"""


@query(sql(
    "SELECT process_name, strftime(business_date, '%Y-%m-%d') AS business_date, run_mode, promised_row_count,"
    " ctl_status, actual_stage_rows, actual_reject_rows FROM run_layer_rows",
    run_layer_rows=_LAYERS,
))
def layer_counts(spark, sf_dir):
    return run_layers(spark, sf_dir)


_COMPARED = """SELECT strftime(business_date, '%Y-%m-%d') AS case_key, ctl_status AS actual_status,
  nullif(trim(concat(
    CASE WHEN ctl_status IS DISTINCT FROM 'WARNING' THEN 'status;' END,
    CASE WHEN ctl_status IS NULL OR (day(business_date) % 2 = 0) <> (actual_reject_rows > 0) THEN 'reason_code;' END,
    CASE WHEN promised_row_count <> actual_stage_rows + actual_reject_rows THEN 'expected_row_count;' END,
    CASE WHEN promised_row_count <> actual_stage_rows THEN 'actual_stage_rows;' END,
    CASE WHEN actual_reject_rows <> 0 THEN 'actual_reject_rows;' END,
    CASE WHEN promised_row_count <> actual_stage_rows THEN 'actual_core_rows;' END), ';'), '') AS mismatch_fields
FROM run_layer_rows"""


@query(sql(
    "SELECT case_key, actual_status, mismatch_fields,"
    " CASE WHEN mismatch_fields IS NULL THEN 'PASS' ELSE 'FAIL' END AS result FROM compared"
    " UNION ALL SELECT 'SUMMARY', NULL, concat('total_cases=', COUNT(*), '; passed_cases=',"
    " COUNT(*) FILTER (WHERE mismatch_fields IS NULL), '; failed_cases=', COUNT(mismatch_fields)),"
    " CASE WHEN COUNT(mismatch_fields) = 0 THEN 'PASS' ELSE 'FAIL' END FROM compared",
    run_layer_rows=_LAYERS,
    compared=_COMPARED,
))
def run_comparison(spark, sf_dir):
    """Every date expected to end in WARNING with all promised rows stored, which each field of some date breaks."""
    key = F.date_format("business_date", "yyyy-MM-dd").alias("case_key")
    warned = F.lit("INPUT_VALIDATION_WARNING")
    promised = F.col("expected_row_count")
    expected = inbound.promised_counts(spark, sf_dir).select(
        key,
        F.lit("WARNING").alias("expected_status"),
        F.when(F.day("business_date") % 2 == 0, warned).otherwise("LOAD_DONE").alias("expected_reason_code"),
        promised,
        promised.alias("expected_stage_rows"),
        F.lit(0).cast("long").alias("expected_reject_rows"),
        promised.alias("expected_core_rows"),
    )
    rejected = F.col("actual_reject_rows") > 0
    actual = run_layers(spark, sf_dir).select(
        key,
        F.col("ctl_status").alias("actual_status"),
        F.when(F.col("ctl_status").isNotNull(), F.when(rejected, warned).otherwise("LOAD_DONE")).alias(
            "actual_reason_code"
        ),
        (F.col("actual_stage_rows") + F.col("actual_reject_rows")).alias("actual_ctl_expected_rows"),
        "actual_stage_rows",
        "actual_reject_rows",
        F.col("actual_stage_rows").alias("actual_core_rows"),
    )
    return checks.compare_runs(expected, actual, ["case_key"]).select(
        "case_key", "actual_status", "mismatch_fields", "result"
    )


_NAMED = {
    "mart": {
        "MART_HAS_ROWS": "COUNT(*) > 0",
        "MART_FIVE_CURRENCIES": "COUNT(DISTINCT currency_code) = 5",
        "MART_REASON_SET": "COUNT(CASE WHEN aml_review_flag = 1 AND aml_reason_code IS NULL THEN 1 END) = 0",
        "MART_ONE_CURRENCY": "COUNT(DISTINCT currency_code) = 1",
    },
    "transfers": {"TRANSFERS_FIVE_CURRENCIES": "COUNT(DISTINCT currency_code) = 5"},
}


@query(sql(
    "SELECT check_name, result, details FROM named UNION ALL SELECT 'SUMMARY',"
    " CASE WHEN COUNT(*) FILTER (WHERE result = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END,"
    " concat('total_checks=', COUNT(*), '; failed_checks=', COUNT(*) FILTER (WHERE result = 'FAIL')) FROM named",
    named=" UNION ALL ".join(
        f"SELECT '{n}' AS check_name, CASE WHEN {c} THEN 'PASS' ELSE 'FAIL' END AS result,"
        f" 'on {table}' AS details FROM {table}"
        for table, conditions in _NAMED.items()
        for n, c in conditions.items()
    ),
))
def named_checks(spark, sf_dir):
    tables = {
        "mart": review.mart(spark, sf_dir),
        "transfers": shapes.curated_transfers(spark, sf_dir),
    }
    return checks.run_checks([
        (tables[t], [checks.Check(n, F.expr(c), f"on {t}") for n, c in conditions.items()])
        for t, conditions in _NAMED.items()
    ])
