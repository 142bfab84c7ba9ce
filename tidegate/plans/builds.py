"""Mart and spool builds over the stored tables, and the whole-day workflow."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators import gates
from tidegate.operators.aggregates import count_by
from tidegate.operators.fx import fx_coverage
from tidegate.plans import publish
from tidegate.plans.loads import load_clients, load_transfers
from tidegate.plans.mart import build_mart
from tidegate.plans.runs import (
    Outcome,
    Recorder,
    Warehouse,
    failed,
    normalise_run_mode,
    on_dates,
    per_date,
    read_control,
    unexpected,
)
from tidegate.plans.spool import build_spool, report_candidates
from tidegate.sources import outbound, versions
from tidegate.sources.local import local_rows
from tidegate.sources.tables import read_table

# Public error numbers.
MART_BAD_RUN_MODE, MART_UPSTREAM, MART_NO_ROWS, MART_NO_RATES, MART_MISMATCH = (
    -20201, -20210, -20211, -20212, -20213,
)
SPOOL_BAD_RUN_MODE, SPOOL_UPSTREAM, SPOOL_MISMATCH, SPOOL_EXPORT = -20301, -20310, -20311, -20313
FLOW_BAD_RUN_MODE, FLOW_STEP = -20401, -20410

Clock = Callable[[], dt.datetime] | None


def _start(spark, warehouse, process, dates, run_mode, code, message, clock, reason=None, names=None):
    mode = normalise_run_mode(run_mode, code)
    recorder = Recorder(spark, warehouse, mode, dt.datetime.min, True, clock)
    recorder.started_ts = recorder.now()
    recorder.record(
        Outcome(
            process, d, "PROCESSING", reason, message, finished=False, **(names(d) if names else {})
        )
        for d in dates
    )
    return recorder


def _open_dates(spark, warehouse, dates, required, statuses):
    control = on_dates(read_control(spark, warehouse), dates)
    return {
        row.business_date
        for row in gates.gate(control, required, statuses).filter("is_open = 1").collect()
    }


def run_mart(
    spark: SparkSession,
    warehouse: Warehouse,
    dates: Sequence[dt.date],
    run_mode: str = "MANUAL",
    clock: Clock = None,
) -> list[Outcome]:
    """Build the mart of the given dates; a failing date keeps its earlier mart."""
    process, dates = S.BUILD_MART, sorted(set(dates))
    recorder = _start(
        spark, warehouse, process, dates, run_mode, MART_BAD_RUN_MODE, "Mart build started.", clock
    )
    done: list[Outcome] = []
    try:
        is_open = _open_dates(
            spark, warehouse, dates, (S.LOAD_CLIENTS, S.LOAD_TRANSFERS), ("DONE", "WARNING")
        )
        for date in [d for d in dates if d not in is_open]:
            done.append(
                failed(
                    process, date, "UPSTREAM_LOAD_NOT_READY", MART_UPSTREAM,
                    "The client and transfer loads of the date are not both finished.",
                )
            )
        todo = [d for d in dates if d in is_open]
        if todo:
            done += _mart_of(spark, warehouse, todo)
    except Exception as error:
        done += unexpected(process, set(dates) - {o.business_date for o in done}, error)
        raise
    finally:
        recorder.record(done)
    return sorted(done, key=lambda o: o.business_date)


def _mart_of(spark, warehouse, dates):
    """The mart is written once, as a version; counts come from what was written, and good dates are switched."""
    process = S.BUILD_MART
    transfers = read_table(spark, warehouse.core(S.TRANSFERS), S.core_schema(S.TRANSFERS), dates)
    clients = read_table(spark, warehouse.core(S.CLIENTS), S.core_schema(S.CLIENTS), dates)
    fx = read_table(spark, warehouse.fx, S.FX_SCHEMA, dates)

    sources = per_date(count_by(transfers, ["business_date"]))
    rates = per_date(fx_coverage(transfers, fx))
    outcomes, todo = [], []
    for date in dates:
        expected = sources[date].row_count if date in sources else 0
        if not expected:
            outcomes.append(
                failed(
                    process, date, "NO_TRANSFER_CORE_ROWS", MART_NO_ROWS,
                    "The date has no loaded transfers.",
                    expected_row_count=0,
                )
            )
        elif rates[date].missing_currencies:
            outcomes.append(
                failed(
                    process, date, "MISSING_FX_RATES", MART_NO_RATES,
                    f"No rates for {rates[date].missing_currencies}.",
                    expected_row_count=expected,
                )
            )
        else:
            todo.append(date)
    if not todo:
        return outcomes
    mart = build_mart(*(on_dates(df, todo) for df in (transfers, clients, fx)))
    version = versions.new_version()
    written, problems = publish.write(spark, publish.part(warehouse.mart, mart, len(todo) > 1), version)
    built = per_date(count_by(written, ["business_date"]))
    good = {}
    for date in todo:
        expected = sources[date].row_count
        actual = built[date].row_count if date in built else 0
        counts = {"expected_row_count": expected, "core_row_count": actual}
        if actual != expected:
            outcomes.append(
                failed(
                    process, date, "MART_ROW_COUNT_MISMATCH", MART_MISMATCH,
                    "The mart would not have one row per transfer.", **counts,
                )
            )
        elif date in problems:
            outcomes.append(failed(process, date, "UNEXPECTED_ERROR", None, problems[date], **counts))
        else:
            good[date] = {warehouse.mart.rsplit("/", 1)[1]: actual}
            outcomes.append(Outcome(process, date, "DONE", "MART_BUILD_DONE", "Mart built.", **counts))
    publish.switch(spark, warehouse.root, "mart", version, good)
    return outcomes


def run_spool(
    spark: SparkSession,
    warehouse: Warehouse,
    dates: Sequence[dt.date],
    run_mode: str = "MANUAL",
    clock: Clock = None,
) -> list[Outcome]:
    """Build and export the reports of the given dates.

    Whatever goes wrong for a date, an earlier ready marker of it is removed.
    """
    process, dates = S.BUILD_SPOOL, sorted(set(dates))

    def names(d):
        return {
            "data_file_name": outbound.report_file("", d, "csv").lstrip("/"),
            "ready_file_name": outbound.report_file("", d, "ok").lstrip("/"),
        }

    recorder = _start(
        spark, warehouse, process, dates, run_mode, SPOOL_BAD_RUN_MODE,
        "Report build started.", clock, names=names,
    )
    done: list[Outcome] = []
    try:
        is_open = _open_dates(
            spark, warehouse, dates, (S.LOAD_CLIENTS, S.LOAD_TRANSFERS, S.BUILD_MART), ("DONE",)
        )
        for date in [d for d in dates if d not in is_open]:
            done.append(
                failed(
                    process, date, "UPSTREAM_NOT_PUBLISHABLE", SPOOL_UPSTREAM,
                    "The loads and the mart of the date are not all DONE.",
                )
            )
        todo = [d for d in dates if d in is_open]
        if todo:
            done += _spool_of(spark, warehouse, todo, recorder.started_ts)
    except Exception as error:
        done += unexpected(process, set(dates) - {o.business_date for o in done}, error)
        raise
    finally:
        for o in done:
            o.data_file_name = names(o.business_date)["data_file_name"]
            o.ready_file_name = names(o.business_date)["ready_file_name"]
            if o.status != "DONE":
                outbound.invalidate(spark, warehouse.outbound, o.business_date, data_too=False)
        recorder.record(done)
    return sorted(done, key=lambda o: o.business_date)


def _spool_of(spark, warehouse, dates, run_ts):
    """The report is written once, as a version; counts come from what was written, and good dates are switched."""
    process = S.BUILD_SPOOL
    mart = read_table(spark, warehouse.mart, mart_schema(spark), dates)
    clients = read_table(spark, warehouse.core(S.CLIENTS), S.core_schema(S.CLIENTS), dates)
    spool = build_spool(mart, clients, run_ts)
    version = versions.new_version()
    written, problems = publish.write(spark, publish.part(warehouse.spool, spool, len(dates) > 1), version)
    candidates = per_date(count_by(report_candidates(mart), ["business_date"]))
    built = per_date(count_by(written, ["business_date"]))
    outcomes, good = [], {}
    for date in dates:
        expected = candidates[date].row_count if date in candidates else 0
        actual = built[date].row_count if date in built else 0
        counts = {"expected_row_count": expected, "core_row_count": actual}
        if actual != expected:
            outcomes.append(
                failed(
                    process, date, "SPOOL_ROW_COUNT_MISMATCH", SPOOL_MISMATCH,
                    "The report would not have one row per transfer up for review.", **counts,
                )
            )
        elif date in problems:
            outcomes.append(failed(process, date, "UNEXPECTED_ERROR", None, problems[date], **counts))
        else:
            good[date] = expected
    if not good:
        return outcomes
    name = warehouse.spool.rsplit("/", 1)[1]
    publish.switch(spark, warehouse.root, "spool", version, {d: {name: n} for d, n in good.items()})
    stored = read_table(spark, warehouse.spool, spool.schema, sorted(good))
    exported = outbound.publish(stored, warehouse.outbound, good)
    for date, count in good.items():
        counts = {"expected_row_count": count, "core_row_count": count}
        if exported[date] != count:
            outcomes.append(
                failed(
                    process, date, "UNEXPECTED_ERROR", SPOOL_EXPORT,
                    "The exported file does not hold every report row.", **counts,
                )
            )
        else:
            outcomes.append(
                Outcome(process, date, "DONE", "SPOOL_BUILD_DONE", "Report built and exported.", **counts)
            )
    return outcomes


def mart_schema(spark: SparkSession):
    """Column types of the mart."""
    return build_mart(
        local_rows(spark, [], S.core_schema(S.TRANSFERS)),
        local_rows(spark, [], S.core_schema(S.CLIENTS)),
        local_rows(spark, [], S.FX_SCHEMA),
    ).schema


def run_workflow(
    spark: SparkSession,
    warehouse: Warehouse,
    dates: Sequence[dt.date],
    run_mode: str = "MANUAL",
    clock: Clock = None,
) -> list[Outcome]:
    """Clients, transfers, mart and report of the given dates.

    Each step handles all dates still in the running at once; a date whose step
    does not end in DONE (a WARNING is not DONE) stops there, the others go on.
    """
    process, dates = S.RUN_WORKFLOW, sorted(set(dates))
    recorder = _start(
        spark, warehouse, process, dates, run_mode, FLOW_BAD_RUN_MODE,
        "Workflow started.", clock, reason="WORKFLOW_STARTED",
    )
    steps = (
        (S.LOAD_CLIENTS, load_clients),
        (S.LOAD_TRANSFERS, load_transfers),
        (S.BUILD_MART, run_mart),
        (S.BUILD_SPOOL, run_spool),
    )
    done: list[Outcome] = []
    running = list(dates)
    for name, step in steps:
        if not running:
            break
        error_text = None
        try:
            results = step(spark, warehouse, running, run_mode, clock=clock)
        except Exception as error:
            error_text = str(error)
            control = read_control(spark, warehouse).filter(F.col("process_name") == name)
            states = per_date(on_dates(control, running))
            results = [
                Outcome(
                    name, d,
                    states[d].status if d in states else "<NO_CTL_ROW>",
                    states[d].reason_code if d in states else None,
                    states[d].status_message if d in states else None,
                )
                for d in running
            ]
        for result in results:
            if result.status != "DONE":
                done.append(_step_failed(name, result, error_text))
                running.remove(result.business_date)
    done += [
        Outcome(process, d, "DONE", "WORKFLOW_DONE", "Workflow finished.")
        for d in running
    ]
    recorder.record(done)
    return sorted(done, key=lambda o: o.business_date)


def _step_failed(step: str, result: Outcome, error_text: str | None) -> Outcome:
    parts = [
        f"{step} of {result.business_date:%Y-%m-%d} ended in {result.status}"
        + (f" / {result.reason_code}" if result.reason_code else "")
    ]
    if result.message:
        parts.append(result.message[:1500].rstrip("."))
    if error_text:
        parts.append(f"Error: {error_text[:1500]}")
    return failed(
        S.RUN_WORKFLOW, result.business_date, "WORKFLOW_STEP_FAILED",
        result.error_code or FLOW_STEP, ". ".join(parts)[:4000],
    )


__all__ = [
    "run_mart",
    "run_spool",
    "run_workflow",
]
