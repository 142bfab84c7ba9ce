"""Where tables live, what a step reports, and how it is recorded."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators.control import upsert_runs
from tidegate.schemas import Dataset
from tidegate.sources.local import local_rows
from tidegate.sources.tables import overwrite_date, read_table


@dataclass(frozen=True)
class Warehouse:
    """Folders of the inbound files, the tables and the outbound files."""

    inbound: str
    tables: str
    outbound: str

    @property
    def root(self) -> str:
        return self.tables.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, dataset: Dataset) -> str:
        return self.path(f"stg_{dataset.name}")

    def reject(self, dataset: Dataset) -> str:
        return self.path(f"stg_{dataset.name}_reject")

    def core(self, dataset: Dataset) -> str:
        return self.path(f"core_{dataset.name}")

    @property
    def control(self) -> str:
        return self.path("ctl_process_run")

    @property
    def fx(self) -> str:
        return self.path("ref_fx_rate_daily")

    @property
    def mart(self) -> str:
        return self.path("mart_transfer_aml")

    @property
    def spool(self) -> str:
        return self.path("aml_report_spool")


class StepError(RuntimeError):
    """A step that did not succeed; ``code`` is the public error number."""

    def __init__(self, code: int | None, message: str):
        super().__init__(message)
        self.code = code


def normalise_run_mode(run_mode: str | None, code: int) -> str:
    mode = (run_mode or "").strip(" ").upper()
    if mode not in S.RUN_MODES:
        shown = "<NULL>" if run_mode is None else run_mode[:100] if mode else "<BLANK>"
        raise StepError(code, f"Run mode {shown} is neither AUTO nor MANUAL.")
    return mode


@dataclass
class Outcome:
    """What one process did for one business date."""

    process_name: str
    business_date: dt.date
    status: str
    reason_code: str | None = None
    message: str | None = None
    error_code: int | None = None
    expected_row_count: int | None = None
    stage_row_count: int = 0
    reject_row_count: int = 0
    core_row_count: int = 0
    data_file_name: str | None = None
    ready_file_name: str | None = None
    next_retry_ts: dt.datetime | None = None
    retry_count_delta: int = 0
    finished: bool = field(default=True)

    def raise_for_status(self) -> None:
        if self.status not in ("DONE", "WARNING"):
            raise StepError(self.error_code, f"{self.reason_code}: {self.message}")


def failed(process: str, date: dt.date, reason: str, code: int | None, message: str, **counts):
    return Outcome(process, date, "FAILED", reason, message, code, **counts)


@dataclass
class Recorder:
    """Writes the outcomes of one step attempt to the control table."""

    spark: SparkSession
    warehouse: Warehouse
    run_mode: str
    started_ts: dt.datetime
    reset_retries: bool
    clock: object = None
    _seq: int = 0

    def now(self) -> dt.datetime:
        return self.clock() if self.clock else dt.datetime.now(dt.UTC).replace(tzinfo=None)

    def record(self, outcomes: Iterable[Outcome]) -> None:
        """One upsert for all given dates; only their partitions are rewritten."""
        rows, now = [], self.now()
        for o in outcomes:
            self._seq += 1
            rows.append(
                {
                    "process_name": o.process_name,
                    "business_date": o.business_date,
                    "run_mode": self.run_mode,
                    "status": o.status,
                    "reason_code": o.reason_code,
                    "scheduled_for_ts": self.started_ts,
                    "next_retry_ts": o.next_retry_ts,
                    "started_ts": self.started_ts,
                    "finished_ts": now if o.finished else None,
                    "expected_row_count": o.expected_row_count,
                    "stage_row_count": o.stage_row_count,
                    "reject_row_count": o.reject_row_count,
                    "core_row_count": o.core_row_count,
                    "data_file_name": o.data_file_name,
                    "ready_file_name": o.ready_file_name,
                    "status_message": o.message,
                    "event_seq": self._seq,
                    "event_ts": now,
                    "retry_count_delta": o.retry_count_delta,
                    "reset_retry_count": int(self.reset_retries),
                }
            )
        if not rows:
            return
        fields = S.RUN_EVENT_SCHEMA.fieldNames()
        events = local_rows(
            self.spark, [tuple(r[f] for f in fields) for r in rows], S.RUN_EVENT_SCHEMA
        )
        dates = sorted({r["business_date"] for r in rows})
        processes = sorted({r["process_name"] for r in rows})
        # Only the rows of these processes are rewritten: others may be recording the same dates.
        known = on_dates(read_control(self.spark, self.warehouse), dates).filter(
            F.col("process_name").isin(processes)
        )
        overwrite_date(upsert_runs(known, events), self.warehouse.control, within=["process_name"])


def read_control(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    return read_table(spark, warehouse.control, S.CONTROL_SCHEMA)


def on_dates(df: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    return df.filter(F.col("business_date").isin(list(dates)))


def per_date(df: DataFrame) -> dict[dt.date, object]:
    """Rows of a table with one row per business date, by date."""
    return {row.business_date: row for row in df.collect()}


def unexpected(process: str, dates: Iterable[dt.date], error: Exception) -> list[Outcome]:
    return [failed(process, d, "UNEXPECTED_ERROR", None, str(error)) for d in dates]
