"""Loads of dated snapshots: file -> stage / reject -> core.

One call handles any number of business dates together: the files are parsed and
judged in one pass into a work table, counts and gates are computed per date from
its few key columns, and only the dates that pass every check are published. A
failing date keeps what it had.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators import gates
from tidegate.operators.checks import check_fk, check_unique
from tidegate.operators.split import (
    core_rows,
    duplicate_keys,
    judge_clients,
    judge_transfers,
    split_judged,
    too_wide,
    unreadable,
)
from tidegate.plans.runs import (
    Outcome,
    Recorder,
    Warehouse,
    failed,
    normalise_run_mode,
    on_dates,
    per_date,
    unexpected,
)
from tidegate.schemas import Dataset
from tidegate.plans import publish
from tidegate.sources import files, inbound, reference, versions
from tidegate.sources.files import work_folder
from tidegate.sources.local import local_rows
from tidegate.sources.tables import read_table

# Last two digits of the public error numbers.
NO_READY_FILE, EMPTY_READY_FILE, BAD_READY_FILE, UNREADABLE_READY_FILE = 10, 11, 12, 13
NO_DATA_FILE, COUNT_MISMATCH, BAD_RUN_MODE, COUNT_WITH_HEADER, NO_CLIENT = 14, 15, 16, 17, 18


def load_clients(spark: SparkSession, warehouse: Warehouse, dates, run_mode="MANUAL", **options):
    return load(spark, warehouse, S.CLIENTS, dates, run_mode, **options)


def load_transfers(spark: SparkSession, warehouse: Warehouse, dates, run_mode="MANUAL", **options):
    return load(spark, warehouse, S.TRANSFERS, dates, run_mode, **options)


def load(
    spark: SparkSession,
    warehouse: Warehouse,
    dataset: Dataset,
    dates: Sequence[dt.date],
    run_mode: str = "MANUAL",
    cutoff: dt.datetime | None = None,
    retry_minutes: int = 15,
    clock: Callable[[], dt.datetime] | None = None,
    ref_currency: DataFrame | None = None,
    ref_country: DataFrame | None = None,
) -> list[Outcome]:
    """Load one dataset for the given dates; returns one outcome per date.

    A date whose ready file is missing is reported as WAITING in AUTO mode before
    the cutoff; call again at ``next_retry_ts``. Nothing sleeps in here.
    """
    mode = normalise_run_mode(run_mode, dataset.error_base - BAD_RUN_MODE)
    recorder = Recorder(spark, warehouse, mode, dt.datetime.min, False, clock)
    recorder.started_ts = recorder.now()
    dates = sorted(set(dates))
    names = {
        d: {
            "data_file_name": inbound.snapshot_name(dataset, d),
            "ready_file_name": inbound.snapshot_name(dataset, d, "ok"),
        }
        for d in dates
    }
    recorder.record(
        Outcome(
            dataset.process, d, "PROCESSING", message="Load started.",
            finished=False, **names[d],
        )
        for d in dates
    )
    done: list[Outcome] = []
    try:
        expected, outcomes = _check_files(
            spark, warehouse, dataset, dates, mode, recorder.now(), cutoff, retry_minutes
        )
        done += outcomes
        if expected:
            if ref_currency is None:
                ref_currency = reference.ref_currency(spark)
            if ref_country is None:
                ref_country = reference.ref_country(spark)
            work = work_folder(spark, f"load_{dataset.name}")
            try:
                done += _load_files(
                    spark, warehouse, dataset, expected, ref_currency, ref_country, work
                )
            finally:
                files.delete(spark, work)
    except Exception as error:
        settled = {o.business_date for o in done}
        done += unexpected(dataset.process, [d for d in dates if d not in settled], error)
        raise
    finally:
        for o in done:
            o.data_file_name = names[o.business_date]["data_file_name"]
            o.ready_file_name = names[o.business_date]["ready_file_name"]
        recorder.record(done)
    return sorted(done, key=lambda o: o.business_date)


def _check_files(spark, warehouse, dataset, dates, mode, now, cutoff, retry_minutes):
    """Dates whose files are complete, with their promised counts; outcomes of the rest."""

    def fail(date, reason, code, message, **counts):
        return failed(dataset.process, date, reason, dataset.error_base - code, message, **counts)

    listed = inbound.list_files(spark, warehouse.inbound)
    wanted = local_rows(
        spark, [(dataset.name, d) for d in dates], "dataset string, business_date date"
    )
    manifest = gates.readiness(listed, wanted).filter(
        (F.col("is_expected") == 1) & (F.col("dataset") == dataset.name)
    )
    decided = per_date(gates.readiness_decision(manifest, mode, now, cutoff, retry_minutes))
    outcomes, ready = [], []
    for date in dates:
        row = decided[date]
        if row.status == "WAITING":
            outcomes.append(
                Outcome(
                    dataset.process, date, row.status, row.reason_code,
                    "No ready file yet; the cutoff has not passed.",
                    next_retry_ts=row.next_retry_ts, retry_count_delta=1,
                )
            )
        elif row.status == "FAILED":
            name = inbound.snapshot_name(dataset, date, "ok")
            outcomes.append(
                fail(date, row.reason_code, NO_READY_FILE, f"{name} is not there.")
            )
        else:
            ready.append(date)
    promised = _read_promised(spark, warehouse, dataset, ready)
    expected = {}
    for date in ready:
        state, count = promised[date]
        name = inbound.snapshot_name(dataset, date, "ok")
        if state == "UNREADABLE":
            outcomes.append(
                fail(date, "READY_FILE_READ_ERROR", UNREADABLE_READY_FILE, f"{name} cannot be read.")
            )
        elif state == "EMPTY":
            outcomes.append(
                fail(date, "INVALID_OK_CONTENT", EMPTY_READY_FILE, f"{name} holds no line.")
            )
        elif state == "INVALID":
            outcomes.append(
                fail(
                    date, "INVALID_OK_CONTENT", BAD_READY_FILE,
                    f"The first line of {name} is not a row count.",
                )
            )
        elif not decided[date].has_data_file:
            data = inbound.snapshot_name(dataset, date)
            outcomes.append(
                fail(
                    date, "MISSING_DATA_FILE", NO_DATA_FILE,
                    f"{data} is not there, but its ready file is.",
                    expected_row_count=count,
                )
            )
        else:
            expected[date] = count
    return expected, outcomes


def _read_promised(spark, warehouse, dataset, dates):
    """date -> (ready_state, count) of the ready files."""
    if not dates:
        return {}
    names = [inbound.snapshot_name(dataset, d, "ok") for d in dates]
    try:
        rows = per_date(inbound.read_ready_counts(spark, warehouse.inbound, names))
    except Exception:  # some file vanished or may not be read: find out which
        if len(dates) == 1:
            return {dates[0]: ("UNREADABLE", None)}
        half = len(dates) // 2
        return _read_promised(spark, warehouse, dataset, dates[:half]) | _read_promised(
            spark, warehouse, dataset, dates[half:]
        )
    return {d: (rows[d].ready_state, rows[d].expected_row_count) for d in dates}


def _judge_files(spark, warehouse, dataset, dates, ref_currency, ref_country, work):
    """Judged rows with line numbers, from a work table written in one pass over the files."""
    paths = [inbound.snapshot_path(warehouse.inbound, dataset, d) for d in dates]
    lines = inbound.read_lines(spark, paths).withColumn("is_malformed", ~inbound.well_formed("value"))
    raw = inbound.parse_lines(lines, dataset)
    raw = raw.withColumn("is_unreadable", unreadable(dataset))
    judged = (
        judge_transfers(raw, ref_currency, ref_country)
        if dataset is S.TRANSFERS
        else judge_clients(raw)
    )
    stored = _store(judged, f"{work}/judged", files.CODEC)
    offsets = _store(inbound.split_offsets(stored), f"{work}/offsets")
    return inbound.with_source_row_num(stored, offsets).filter("source_row_num > 1")


def _store(df, table, codec="snappy"):
    """``df`` as a written table: computed once, safe from lost executors, of known size."""
    df.write.option("compression", codec).parquet(table)
    return df.sparkSession.read.schema(df.schema).parquet(table)


def _load_files(spark, warehouse, dataset, expected, ref_currency, ref_country, work):
    dates = sorted(expected)
    key = dataset.field(dataset.key)
    judged = _judge_files(spark, warehouse, dataset, dates, ref_currency, ref_country, work)
    # Stored, so that its size decides how it is joined.
    duplicates = _store(duplicate_keys(judged, dataset), f"{work}/duplicates")

    is_valid = F.col("reject_reason").isNull()
    rows = judged.groupBy("business_date").agg(
        F.count("*").alias("total"),
        F.count_if(is_valid).alias("valid"),
        F.count_if("is_malformed").alias("malformed"),
        F.count_if("is_unreadable").alias("unreadable"),
        F.count_if(too_wide(dataset)).alias("too_wide"),
        F.count_if(is_valid & (F.col(key.parsed) != F.round(key.parsed, 0))).alias("rounded_keys"),
    )
    repeats = duplicates.groupBy("business_date").agg(F.sum("key_rows").alias("repeated"))
    promised = local_rows(
        spark, expected.items(), "business_date date, expected_row_count long"
    )
    zero = F.lit(0)
    counts = (
        promised.join(rows, "business_date", "left")
        .join(repeats, "business_date", "left")
        .select(
            "business_date",
            "expected_row_count",
            (F.coalesce("valid", zero) - F.coalesce("repeated", zero)).alias("stage_row_count"),
            (
                F.coalesce("total", zero) - F.coalesce("valid", zero) + F.coalesce("repeated", zero)
            ).alias("reject_row_count"),
            F.coalesce("malformed", zero).alias("malformed"),
            F.coalesce("unreadable", zero).alias("unreadable"),
            F.coalesce("too_wide", zero).alias("too_wide"),
            F.coalesce("rounded_keys", zero).alias("rounded_keys"),
        )
    )
    counted = per_date(gates.load_status(gates.reconcile_counts(counts).withColumnRenamed(
        "reason_code", "count_problem"
    )))

    outcomes, good = [], []

    def counts_of(row, **more):
        return {
            "expected_row_count": row.expected_row_count,
            "stage_row_count": row.stage_row_count,
            "reject_row_count": row.reject_row_count,
            **more,
        }

    def fail(row, reason, code, message):
        outcomes.append(
            failed(
                dataset.process, row.business_date, reason,
                dataset.error_base - code if code else None, message, **counts_of(row),
            )
        )

    for date in dates:
        row = counted[date]
        if row.malformed:
            fail(row, "UNEXPECTED_ERROR", None, f"{row.malformed} line(s) hold a quoted field that does not end.")
        elif row.unreadable:
            fail(row, "UNEXPECTED_ERROR", None, f"{row.unreadable} line(s) hold a value too long to read.")
        elif row.too_wide:
            fail(row, "UNEXPECTED_ERROR", None, f"{row.too_wide} row(s) hold a number too large to store.")
        elif row.count_problem == "OK_COUNT_INCLUDES_HEADER":
            fail(
                row, row.count_problem, COUNT_WITH_HEADER,
                "The ready file counts one row more than the file has: the header?",
            )
        elif row.count_problem:
            fail(row, row.count_problem, COUNT_MISMATCH, "The ready file counts other rows than the file has.")
        else:
            good.append(date)

    split = split_judged(on_dates(judged, good), dataset, duplicates)
    for date, (reason, code, message) in _broken_links(
        spark, warehouse, dataset, split.stage, good, [d for d in good if counted[d].rounded_keys]
    ).items():
        fail(counted[date], reason, code, message)
        good.remove(date)

    problems = _publish(spark, warehouse, dataset, split, good, counted) if good else {}
    for date, message in problems.items():
        fail(counted[date], "UNEXPECTED_ERROR", None, message)
        good.remove(date)
    for date in good:
        row = counted[date]
        message = (
            "Loaded; some rows were rejected."
            if row.status == "WARNING"
            else "Loaded."
        )
        outcomes.append(
            Outcome(
                dataset.process, date, row.status, row.reason_code, message,
                **counts_of(row, core_row_count=row.stage_row_count),
            )
        )
    return outcomes


def _broken_links(spark, warehouse, dataset, stage, dates, rounded):
    """date -> (reason, error, message) where publishing would break a key."""
    if not dates:
        return {}
    problems = {}
    if rounded:
        # Keys differ before rounding, so only rounded keys can still collide.
        repeated = check_unique(
            on_dates(stage, rounded), ["business_date", dataset.key]
        ).select("business_date").distinct()
        for row in repeated.collect():
            problems[row.business_date] = (
                "UNEXPECTED_ERROR", None, f"{dataset.key} repeats after rounding.",
            )
    if dataset is S.TRANSFERS:
        clients = _core(spark, warehouse, S.CLIENTS, dates)
        for row in gates.missing_clients(stage, clients).collect():
            problems[row.business_date] = (
                "MISSING_CLIENT_SNAPSHOT", NO_CLIENT,
                f"{row.missing_rows} accepted transfer(s) have no client of their date.",
            )
    else:
        transfers = _core(spark, warehouse, S.TRANSFERS, dates)
        orphaned = check_fk(transfers, stage, ["business_date", "client_id"])
        for row in orphaned.groupBy("business_date").agg(F.sum("row_count").alias("n")).collect():
            problems[row.business_date] = (
                "UNEXPECTED_ERROR", None, f"{row.n} loaded transfer(s) would lose their client.",
            )
    return problems


def _core(spark, warehouse, dataset, dates):
    return read_table(spark, warehouse.core(dataset), S.core_schema(dataset), dates)


def _publish(spark, warehouse, dataset, split, dates, counted):
    """Write the dates' tables as one version and switch those that pass the audit; date -> problem of the rest."""
    version = versions.new_version()
    names = {k: getattr(warehouse, k)(dataset) for k in ("stage", "reject", "core")}
    publish.write(spark, publish.part(names["reject"], on_dates(split.reject, dates)), version)
    stage, _ = publish.write(spark, publish.part(names["stage"], on_dates(split.stage, dates)), version)
    _, problems = publish.write(spark, publish.part(names["core"], core_rows(stage)), version)
    base = {k: path.rsplit("/", 1)[1] for k, path in names.items()}
    publish.switch(
        spark,
        warehouse.root,
        dataset.name,
        version,
        {
            d: {
                base["stage"]: counted[d].stage_row_count,
                base["reject"]: counted[d].reject_row_count,
                base["core"]: counted[d].stage_row_count,
            }
            for d in dates
            if d not in problems
        },
    )
    return problems


__all__ = ["load", "load_clients", "load_transfers"]
