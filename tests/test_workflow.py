"""The review day end to end: golden mart rows, report file, gates and failures."""

import datetime as dt
import glob
import os
from decimal import Decimal

import pytest
import snapshots as X
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators.checks import Check, check_expr, check_not_null, check_unique, run_checks
from tidegate.plans.builds import mart_schema, run_mart, run_spool, run_workflow
from tidegate.plans.runs import Warehouse, read_control
from tidegate.sources import outbound, reference
from tidegate.sources.tables import read_table

DAY = X.APR[15]
REPORTED = sorted(t for t, row in X.REVIEW_TRANSFERS.items() if row[6])


def rates(spark, skip=()):
    return reference.fx_rates(
        spark, [(DAY, c, u, Decimal(m)) for c, u, m in X.REVIEW_RATES if c not in skip]
    )


@pytest.fixture(scope="module")
def day(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("day")
    inbound = root / "inbound"
    inbound.mkdir()
    X.write_all(inbound)
    w = Warehouse(str(inbound), str(root / "tables"), str(root / "outbound"))
    reference.load_fx_rates(rates(spark), w.fx)
    # One good date together with one that stops at its first step.
    results = run_workflow(spark, w, [DAY, X.MAR[1]])
    return w, {o.business_date: o for o in results}


def report_text(folder):
    parts = sorted(glob.glob(os.path.join(outbound.report_file(folder, DAY, "csv"), "part-*")))
    return "".join(open(p).read() for p in parts)


def control_rows(spark, w, date=DAY):
    rows = read_control(spark, w).filter(F.col("business_date") == F.lit(date)).collect()
    return {r.process_name: r for r in rows}


def test_workflow_status(spark, day):
    w, outcomes = day
    assert (outcomes[DAY].status, outcomes[DAY].reason_code) == ("DONE", "WORKFLOW_DONE")
    stopped = outcomes[X.MAR[1]]
    assert (stopped.status, stopped.reason_code, stopped.error_code) == (
        "FAILED", "WORKFLOW_STEP_FAILED", -20410,
    )
    assert "LOAD_CLIENTS" in stopped.message and "WARNING / INPUT_VALIDATION_WARNING" in stopped.message
    rows = control_rows(spark, w)
    got = {
        p: (r.status, r.reason_code, r.expected_row_count, r.stage_row_count, r.reject_row_count, r.core_row_count)
        for p, r in rows.items()
    }
    assert got == {
        "RUN_AML_WORKFLOW": ("DONE", "WORKFLOW_DONE", None, 0, 0, 0),
        "LOAD_CLIENTS": ("DONE", "LOAD_DONE", 10, 10, 0, 10),
        "LOAD_CLIENT_TRANSFERS": ("DONE", "LOAD_DONE", 20, 20, 0, 20),
        "BUILD_MART_TRANSFER_AML": ("DONE", "MART_BUILD_DONE", 20, 0, 0, 20),
        "BUILD_AML_REPORT_SPOOL": ("DONE", "SPOOL_BUILD_DONE", 11, 0, 0, 11),
    }
    spool = rows["BUILD_AML_REPORT_SPOOL"]
    assert (spool.data_file_name, spool.ready_file_name) == (
        "aml_report_spool_20260415.csv", "aml_report_spool_20260415.ok",
    )


def test_golden_mart(spark, day):
    w, _ = day
    mart = read_table(spark, w.mart, mart_schema(spark))
    got = {
        r.transfer_id: (
            r.fx_rate_to_eur, r.amount_eur, r.above_threshold_art72_flag, r.suspicion_art74_flag,
            r.aml_review_flag, r.aml_reason_code, r.report_type_candidate, r.aml_reason_details,
        )
        for r in mart.collect()
    }
    want = {}
    for tid, (_, _, _, rate, eur, code, kind, details) in X.REVIEW_TRANSFERS.items():
        above = int(kind in ("ART72_THRESHOLD", "ART72_AND_ART74"))
        suspect = int(kind in ("ART74_SUSPICION", "ART72_AND_ART74"))
        want[tid] = (
            Decimal(rate).quantize(Decimal("1e-8")), Decimal(eur), above, suspect,
            int(kind is not None), code, kind, details,
        )
    assert got == want
    assert check_unique(mart, ["business_date", "transfer_id"]).count() == 0
    assert check_expr(mart, S.MART_CHECKS).filter("violations > 0").count() == 0


def test_spool_and_report_file(spark, day):
    w, _ = day
    schema = S.REPORT_COLUMNS
    spool = read_table(spark, w.spool, spark.read.parquet(w.spool).select(*schema).schema)
    rows = {r.transfer_id: r for r in spool.collect()}
    assert sorted(rows) == REPORTED and len(rows) == 11
    assert rows[7003].report_due_date == DAY + dt.timedelta(days=7)
    assert rows[7004].report_due_date == DAY + dt.timedelta(days=2)
    assert rows[7016].report_due_date == DAY + dt.timedelta(days=2)
    assert rows[7016].report_id == "AML-20260415-7016"
    assert (rows[7016].registration_no, rows[7016].city) == ("REG-15", "Testville")
    assert check_not_null(spool, S.SPOOL_NOT_NULL).filter("violations > 0").count() == 0
    assert check_expr(spool, S.SPOOL_CHECKS).filter("violations > 0").count() == 0

    lines = report_text(w.outbound).splitlines()
    assert len(lines) == 12
    assert lines[0] == ";".join(S.REPORT_COLUMNS)
    ids = [line.split(";")[2].strip('"') for line in lines[1:]]
    assert ids == [f"AML-20260415-{t}" for t in REPORTED]
    first, private = lines[1].split(";"), lines[4].split(";")
    assert first[1] == '"2026-04-15"' and first[3] == '"ART72_THRESHOLD"'
    eur = X.REVIEW_TRANSFERS[7003][4]
    assert first[21:25] == ['"64210.00"', '"PLN"', f'"{eur}"', '"2026-04-15 10:15:00"']
    assert first[11] == '"REG-18"' and private[11] == '""'  # no registration number
    with open(outbound.report_file(w.outbound, DAY, "ok")) as f:
        assert f.read() == "11\n"


def test_named_checks(spark, day):
    w, _ = day
    mart = read_table(spark, w.mart, mart_schema(spark))
    fx = read_table(spark, w.fx, S.FX_SCHEMA)

    def one(cond):
        return F.count_if(F.expr(cond)) == 1

    result = run_checks([
        (mart, [
            Check("MART_ROW_COUNT", F.count("*") == 20, "20 rows"),
            Check("MART_USD", one(f"transfer_id = 7010 AND amount_eur = {X.REVIEW_TRANSFERS[7010][4]}"), "USD amount"),
            Check("MART_WRONG", one("transfer_id = 1"), "fails on purpose"),
        ]),
        (fx, [Check("FX_ROW_COUNT", F.count("*") == 5, "5 rates")]),
    ]).collect()
    assert {r.check_name: r.result for r in result} == {
        "MART_ROW_COUNT": "PASS", "MART_USD": "PASS", "MART_WRONG": "FAIL",
        "FX_ROW_COUNT": "PASS", "SUMMARY": "FAIL",
    }
    assert [r.details for r in result if r.check_name == "SUMMARY"] == ["total_checks=4; failed_checks=1"]


def test_missing_rate_stops_the_mart_and_the_old_one_stays(spark, day):
    w, _ = day
    reference.load_fx_rates(rates(spark, skip=("USD",)), w.fx)
    (got,) = run_mart(spark, w, [DAY])
    assert (got.status, got.reason_code, got.error_code) == ("FAILED", "MISSING_FX_RATES", -20212)
    assert "USD" in got.message
    assert read_table(spark, w.mart, mart_schema(spark)).count() == 20
    # The failed mart closes the report gate, which withdraws the ready marker but not the file.
    (spool,) = run_spool(spark, w, [DAY])
    assert (spool.reason_code, spool.error_code) == ("UPSTREAM_NOT_PUBLISHABLE", -20310)
    assert not os.path.exists(outbound.report_file(w.outbound, DAY, "ok"))
    assert os.path.exists(outbound.report_file(w.outbound, DAY, "csv"))
    reference.load_fx_rates(rates(spark), w.fx)
    assert run_mart(spark, w, [DAY])[0].status == "DONE"
    assert run_spool(spark, w, [DAY])[0].status == "DONE"
    assert os.path.exists(outbound.report_file(w.outbound, DAY, "ok"))
    row = control_rows(spark, w)["BUILD_MART_TRANSFER_AML"]
    assert (row.status, row.retry_count) == ("DONE", 0)


def test_warning_opens_the_mart_but_not_the_report(spark, tmp_path):
    date = X.MAR[1]
    X.put(tmp_path, S.CLIENTS, date, [X.client(date, 1), X.client(date, "bad")], ok=2)
    X.put(tmp_path, S.TRANSFERS, date, [X.transfer(date, 7, 1)], ok=1)
    w = Warehouse(str(tmp_path), str(tmp_path / "t"), str(tmp_path / "o"))
    reference.load_fx_rates(reference.fx_rates(spark, [(date, "EUR", 1, Decimal("4.3"))]), w.fx)
    from tidegate.plans.loads import load_clients, load_transfers

    assert run_mart(spark, w, [date])[0].reason_code == "UPSTREAM_LOAD_NOT_READY"
    assert load_clients(spark, w, [date])[0].status == "WARNING"
    assert load_transfers(spark, w, [date])[0].status == "DONE"
    assert run_mart(spark, w, [date])[0].status == "DONE"
    assert run_spool(spark, w, [date])[0].reason_code == "UPSTREAM_NOT_PUBLISHABLE"


def test_rates_are_checked_before_they_replace_a_date(spark, tmp_path):
    table = str(tmp_path / "fx")
    twice = reference.fx_rates(spark, [(DAY, "EUR", 1, Decimal("4"))] * 2)
    with pytest.raises(ValueError, match="repeat"):
        reference.load_fx_rates(twice, table)
    with pytest.raises(ValueError, match="fx_mid_rate"):
        reference.load_fx_rates(reference.fx_rates(spark, [(DAY, "EUR", 1, Decimal("0"))]), table)
