"""Readiness, reconciliation and gates, for many dates at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions import ts_literal
from tidegate.operators.aggregates import count_by
from tidegate.operators.joins import orphan_counts


def readiness(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Per expected (dataset, business_date): is the ready file there, is the data file?

    ``files`` holds (dataset, business_date, kind) with kind ``ok`` or ``csv``.
    Files nobody expects are kept, with ``is_expected`` = 0.
    """
    keys = ["dataset", "business_date"]
    present = files.groupBy(*keys).agg(
        F.max(F.when(F.col("kind") == "ok", 1).otherwise(0)).alias("has_ready_file"),
        F.max(F.when(F.col("kind") == "csv", 1).otherwise(0)).alias("has_data_file"),
    )
    wanted = expected.select(*keys).distinct().withColumn("is_expected", F.lit(1))
    return wanted.join(present, keys, "full_outer").select(
        *keys,
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("is_expected", "has_ready_file", "has_data_file")
        ],
    )


def default_cutoff(now: Column) -> Column:
    """Noon of the run day."""
    return now.cast("date").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")


def readiness_decision(
    manifest: DataFrame,
    run_mode: str,
    now: dt.datetime,
    cutoff: dt.datetime | None = None,
    retry_minutes: int = 15,
) -> DataFrame:
    """Whether each (dataset, date) may load, must wait or has failed.

    Adds ``status``, ``reason_code``, ``next_retry_ts`` and ``retry_count_delta``;
    status READY means go on.
    """
    at = ts_literal(now)
    end = ts_literal(cutoff) if cutoff else default_cutoff(at)
    pause = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(max(1, retry_minutes)))
    no_ready = F.col("has_ready_file") == 0
    may_wait = F.lit(run_mode == "AUTO") & (at < end)
    waiting = no_ready & may_wait
    return manifest.withColumns(
        {
            "status": F.when(waiting, "WAITING").when(no_ready, "FAILED").otherwise("READY"),
            "reason_code": F.when(waiting, "WAITING_FOR_OK")
            .when(no_ready & F.lit(run_mode == "MANUAL"), "MISSING_OK_MANUAL")
            .when(no_ready, "MISSING_OK_AFTER_CUTOFF"),
            "next_retry_ts": F.when(waiting, F.least(end, at + pause)),
            "retry_count_delta": F.when(waiting, 1).otherwise(0),
        }
    )


def reconcile_counts(counts: DataFrame) -> DataFrame:
    """Compare stage + reject with the ready file's count.

    Adds ``actual_row_count`` and ``reason_code``: NULL when equal, otherwise
    ``OK_COUNT_INCLUDES_HEADER`` (exactly one more) or ``OK_COUNT_MISMATCH``.
    """
    actual = F.col("stage_row_count") + F.col("reject_row_count")
    return counts.withColumns(
        {
            "actual_row_count": actual,
            "reason_code": F.when(
                F.col("expected_row_count") == actual + 1, "OK_COUNT_INCLUDES_HEADER"
            ).when(F.col("expected_row_count") != actual, "OK_COUNT_MISMATCH"),
        }
    )


def reconcile(stage: DataFrame, reject: DataFrame, ready: DataFrame) -> DataFrame:
    """``reconcile_counts`` on tables; ``ready`` holds (business_date, expected_row_count)."""
    result = ready.select("business_date", "expected_row_count")
    for name, table in (("stage_row_count", stage), ("reject_row_count", reject)):
        result = result.join(
            count_by(table, ["business_date"], name), "business_date", "left"
        ).withColumn(name, F.coalesce(name, F.lit(0)))
    return reconcile_counts(result)


def reconcile_split(counts: DataFrame, ready: DataFrame) -> DataFrame:
    """``reconcile_counts`` on (business_date, stage_row_count, reject_row_count)."""
    joined = ready.select("business_date", "expected_row_count").join(counts, "business_date", "left")
    zero = {n: F.coalesce(n, F.lit(0)) for n in ("stage_row_count", "reject_row_count")}
    return reconcile_counts(joined.withColumns(zero))


def load_status(counts: DataFrame) -> DataFrame:
    """Final status of a load that passed all gates."""
    rejected = F.col("reject_row_count") > 0
    return counts.withColumns(
        {
            "status": F.when(rejected, "WARNING").otherwise("DONE"),
            "reason_code": F.when(rejected, "INPUT_VALIDATION_WARNING").otherwise("LOAD_DONE"),
        }
    )


def missing_clients(stage_transfers: DataFrame, core_clients: DataFrame) -> DataFrame:
    """Per date: accepted transfers without a client of the same date.

    Transfers are first reduced to one row per client, so a busy client weighs
    no more than a quiet one in the join.
    """
    return (
        orphan_counts(stage_transfers, core_clients, ["business_date", "client_id"], "n")
        .groupBy("business_date")
        .agg(F.sum("n").alias("missing_rows"))
    )


def gate(control: DataFrame, required: Sequence[str], statuses: Sequence[str]) -> DataFrame:
    """Per date: how many required processes are in an allowed status."""
    ok = F.col("process_name").isin(list(required)) & F.col("status").isin(list(statuses))
    return control.groupBy("business_date").agg(
        F.countDistinct(F.when(ok, F.col("process_name"))).alias("ready_processes")
    ).withColumn("is_open", F.when(F.col("ready_processes") >= len(required), 1).otherwise(0))
