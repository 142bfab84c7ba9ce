"""The scenario matrix, end to end from files to core tables."""

import datetime as dt

import pytest
import snapshots as X
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators.checks import compare_runs
from tidegate.operators.joins import layer_counts
from tidegate.plans import loads
from tidegate.plans.runs import StepError, Warehouse, read_control
from tidegate.sources.tables import read_table


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("matrix")
    inbound = root / "inbound"
    inbound.mkdir()
    X.write_all(inbound)
    w = Warehouse(str(inbound), str(root / "tables"), str(root / "outbound"))
    return w


@pytest.fixture(scope="module")
def outcomes(spark, warehouse):
    """All cases, loaded many dates at a time, then two dates again."""
    result = {}
    for dataset in (S.CLIENTS, S.TRANSFERS):
        dates = [row[1] for row in X.MATRIX if row[0] == dataset.name]
        for o in loads.load(spark, warehouse, dataset, dates):
            result[dataset.name, o.business_date] = o
    for dataset in (S.CLIENTS, S.TRANSFERS):
        for o in loads.load(spark, warehouse, dataset, X.MAR[1:3]):
            result[dataset.name, o.business_date] = o
    return result


def table_counts(spark, warehouse, dataset, layer):
    path = getattr(warehouse, layer)(dataset)
    schema = getattr(S, f"{layer}_schema")(dataset)
    return {
        r.business_date: r["count"]
        for r in read_table(spark, path, schema).groupBy("business_date").count().collect()
    }


@pytest.mark.parametrize("case", X.MATRIX, ids=lambda c: f"{c[0]}-{c[1]}")
def test_matrix(spark, warehouse, outcomes, case):
    name, date, code, status, reason, promised, stage, reject, core = case
    dataset = S.DATASETS[name]
    got = outcomes[name, date]
    assert (got.status, got.reason_code, got.error_code, got.expected_row_count) == (
        status, reason, code, promised,
    )
    assert [
        table_counts(spark, warehouse, dataset, layer).get(date, 0)
        for layer in ("stage", "reject", "core")
    ] == [stage, reject, core]


def test_compare_runs_passes_on_the_matrix(spark, warehouse, outcomes):
    process = {d.name: d.process for d in S.DATASETS.values()}
    expected = spark.createDataFrame(
        [
            (i, f"{n}_{d}", process[n], d, "MANUAL", st, rs, exp, s, r, c)
            for i, (n, d, _, st, rs, exp, s, r, c) in enumerate(X.MATRIX)
        ],
        "case_id int, case_key string, process_name string, business_date date, run_mode string,"
        "expected_status string, expected_reason_code string, expected_row_count long,"
        "expected_stage_rows long, expected_reject_rows long, expected_core_rows long",
    )
    counts = {}
    for layer in ("stage", "reject", "core"):
        parts = None
        for d in S.DATASETS.values():
            part = (
                read_table(spark, getattr(warehouse, layer)(d), getattr(S, f"{layer}_schema")(d))
                .groupBy("business_date").agg(F.count("*").alias("row_count"))
                .withColumn("process_name", F.lit(d.process))
            )
            parts = part if parts is None else parts.unionByName(part)
        counts[f"actual_{layer}_rows"] = parts
    control = read_control(spark, warehouse).select(
        "process_name", "business_date", "run_mode",
        F.col("status").alias("actual_status"), F.col("reason_code").alias("actual_reason_code"),
        F.col("expected_row_count").alias("actual_ctl_expected_rows"),
    )
    actual = layer_counts(
        expected.select("case_id", "process_name", "business_date", "run_mode"), control, counts
    ).drop("process_name", "business_date", "run_mode")
    rows = compare_runs(expected, actual, ["case_id"]).collect()
    assert [r.case_key for r in rows if r.result == "FAIL"] == []
    summary = [r for r in rows if r.case_key == "SUMMARY"]
    assert summary[0].mismatch_fields == "total_cases=18; passed_cases=18; failed_cases=0"


def test_reject_reasons(spark, warehouse, outcomes):
    def reasons(dataset, date):
        table = read_table(spark, warehouse.reject(dataset), S.reject_schema(dataset))
        rows = table.filter(F.col("business_date") == F.lit(date)).collect()
        return {r.source_row_num: r.reject_reason for r in rows}

    assert reasons(S.TRANSFERS, X.MAR[1]) == {
        3: "invalid amount", 5: "invalid transfer_status", 6: "invalid currency_code format",
        8: "invalid transfer_id", 9: "invalid country_code format", 11: "negative amount",
        12: "invalid channel",
    }
    assert reasons(S.CLIENTS, X.MAR[1]) == {
        3: "invalid client_status", 5: "missing company_name for BUSINESS",
        7: "invalid client_id", 9: "missing last_name for PRIVATE",
    }
    assert reasons(S.CLIENTS, X.APR[9]) == {
        3: "invalid email format", 4: "invalid risk_score", 5: "invalid phone_number format",
        6: "kyc_status too long", 8: "risk_score must be between 0 and 999",
        9: "invalid client_status", 10: "invalid risk_score", 11: "unsupported kyc_status",
    }
    assert reasons(S.TRANSFERS, X.APR[12]) == {
        2: "unsupported country_code", 3: "invalid country_code format",
    }
    assert set(reasons(S.TRANSFERS, X.MAR[4]).values()) == {"duplicate transfer_id in snapshot"}
    assert set(reasons(S.CLIENTS, X.MAR[5]).values()) == {"duplicate client_id in snapshot"}


def test_codes_are_normalised(spark, warehouse, outcomes):
    stage = read_table(spark, warehouse.stage(S.CLIENTS), S.stage_schema(S.CLIENTS))
    rows = stage.filter(F.col("business_date") == F.lit(X.APR[9])).orderBy("source_row_num").collect()
    assert [(r.source_row_num, r.client_type, r.country_code, r.kyc_status, r.risk_score, r.client_status) for r in rows] == [
        (2, "BUSINESS", "FR", "LIMITED", 999, "ACTIVE"),
        (7, "PRIVATE", "LT", "MANUAL_CHECK", 0, "ARCHIVED"),
    ]


def test_bad_run_mode(spark, warehouse):
    with pytest.raises(StepError) as error:
        loads.load_transfers(spark, warehouse, [X.MAR[2]], run_mode="  ")
    assert error.value.code == -20016
    assert "<BLANK>" in str(error.value)


def test_auto_mode_waits_then_fails(spark, tmp_path):
    inbound = tmp_path / "in"
    inbound.mkdir()
    X.write_all(inbound)
    w = Warehouse(str(inbound), str(tmp_path / "t"), str(tmp_path / "o"))
    start = dt.datetime(2026, 4, 7, 11, 0)
    cutoff = start + dt.timedelta(minutes=5)
    last = None
    for minute in range(6):
        now = start + dt.timedelta(minutes=minute)
        (last,) = loads.load_clients(
            spark, w, [X.APR[7]], "auto", cutoff=cutoff, retry_minutes=1, clock=lambda n=now: n
        )
        if minute < 5:
            assert (last.status, last.reason_code) == ("WAITING", "WAITING_FOR_OK")
            assert last.next_retry_ts == min(cutoff, now + dt.timedelta(minutes=1))
    assert (last.status, last.reason_code, last.error_code) == (
        "FAILED", "MISSING_OK_AFTER_CUTOFF", -20110,
    )
    row = read_control(spark, w).collect()[0]
    assert (row.retry_count, row.scheduled_for_ts, row.next_retry_ts) == (5, start, None)


@pytest.mark.parametrize(
    "content,code", [("", -20111), ("\n", -20112), ("ten\n", -20112), ("1.0\n", -20112)]
)
def test_bad_ready_file(spark, tmp_path, content, code):
    day = X.MAR[0]
    X.put(tmp_path, S.CLIENTS, day, [X.client(day, 1)], ok=content)
    w = Warehouse(str(tmp_path), str(tmp_path / "t"), str(tmp_path / "o"))
    (got,) = loads.load_clients(spark, w, [day])
    assert (got.status, got.reason_code, got.error_code) == ("FAILED", "INVALID_OK_CONTENT", code)


def test_failed_reload_keeps_old_rows_and_empty_reload_clears_them(spark, tmp_path):
    day = X.MAR[0]
    w = Warehouse(str(tmp_path), str(tmp_path / "t"), str(tmp_path / "o"))
    X.put(tmp_path, S.CLIENTS, day, [X.client(day, 1), X.client(day, 2)], ok=" 2 \n")
    assert loads.load_clients(spark, w, [day])[0].status == "DONE"
    X.put(tmp_path, S.CLIENTS, day, [X.client(day, 1)], ok=9)
    assert loads.load_clients(spark, w, [day])[0].reason_code == "OK_COUNT_MISMATCH"
    assert table_counts(spark, w, S.CLIENTS, "core") == {day: 2}
    X.put(tmp_path, S.CLIENTS, day, [X.client(day, "x")], ok=1)
    got = loads.load_clients(spark, w, [day])[0]
    assert (got.status, got.stage_row_count, got.reject_row_count) == ("WARNING", 0, 1)
    assert table_counts(spark, w, S.CLIENTS, "core") == {}
    X.put(tmp_path, S.CLIENTS, day, [X.client(day, 3)], ok=1)
    assert loads.load_clients(spark, w, [day])[0].status == "DONE"
    assert table_counts(spark, w, S.CLIENTS, "reject") == {}
    assert table_counts(spark, w, S.CLIENTS, "core") == {day: 1}


def test_client_reload_may_not_orphan_loaded_transfers(spark, tmp_path):
    day = X.MAR[0]
    w = Warehouse(str(tmp_path), str(tmp_path / "t"), str(tmp_path / "o"))
    X.put(tmp_path, S.CLIENTS, day, [X.client(day, 1), X.client(day, 2)], ok=2)
    X.put(tmp_path, S.TRANSFERS, day, [X.transfer(day, 10, 2)], ok=1)
    assert loads.load_clients(spark, w, [day])[0].status == "DONE"
    assert loads.load_transfers(spark, w, [day])[0].status == "DONE"
    X.put(tmp_path, S.CLIENTS, day, [X.client(day, 1)], ok=1)
    got = loads.load_clients(spark, w, [day])[0]
    assert (got.status, got.reason_code) == ("FAILED", "UNEXPECTED_ERROR")
    assert table_counts(spark, w, S.CLIENTS, "core") == {day: 2}


@pytest.mark.parametrize(
    "line",
    [
        X.transfer(X.MAR[0], 10, 1, amount="1000000000000"),
        X.transfer(X.MAR[0], 12345678901, 1),
        X.transfer(X.MAR[0], 10, 1, transfer_title="x" * 256),
        X.transfer(X.MAR[0], 10, 1, source_account="x" * 101),
    ],
)
def test_values_beyond_the_file_contract_stop_the_load(spark, tmp_path, line):
    day = X.MAR[0]
    w = Warehouse(str(tmp_path), str(tmp_path / "t"), str(tmp_path / "o"))
    X.put(tmp_path, S.CLIENTS, day, [X.client(day, 1)], ok=1)
    X.put(tmp_path, S.TRANSFERS, day, [line, X.transfer(day, 11, 1)], ok=2)
    loads.load_clients(spark, w, [day])
    got = loads.load_transfers(spark, w, [day])[0]
    assert (got.status, got.reason_code) == ("FAILED", "UNEXPECTED_ERROR")
    assert table_counts(spark, w, S.TRANSFERS, "stage") == {}


def test_keys_that_meet_only_after_rounding_stop_the_load(spark, tmp_path):
    day = X.MAR[0]
    w = Warehouse(str(tmp_path), str(tmp_path / "t"), str(tmp_path / "o"))
    X.put(tmp_path, S.CLIENTS, day, [X.client(day, "1"), X.client(day, "1.4")], ok=2)
    got = loads.load_clients(spark, w, [day])[0]
    assert (got.status, got.reason_code) == ("FAILED", "UNEXPECTED_ERROR")
