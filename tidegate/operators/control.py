"""The control table: one current status row per process and business date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions import truncate

KEYS = ["process_name", "business_date"]
MESSAGE_WIDTH = 4000

_LATEST = (
    "run_mode",
    "status",
    "reason_code",
    "next_retry_ts",
    "started_ts",
    "finished_ts",
    "expected_row_count",
    "stage_row_count",
    "reject_row_count",
    "core_row_count",
    "data_file_name",
    "ready_file_name",
    "status_message",
)
_COUNTS = ("stage_row_count", "reject_row_count", "core_row_count")


#: Consecutive event numbers that are folded together; bounds the rows of a key that meet in one place.
SPAN = 4096
#: Below every counter.
_NO_FLOOR = -(2**62)


def _then(first: Column, second: Column) -> Column:
    """Both changes of the retry counter as one.

    A change maps the counter x to max(floor, x + shift), with 0 for x after a reset. Such changes are
    closed under composition, so any run of events is one change, wherever the run is cut.
    """
    both = F.struct(
        first["reset"].alias("reset"),
        F.greatest(first["floor"] + second["shift"], second["floor"]).alias("floor"),
        (first["shift"] + second["shift"]).alias("shift"),
    )
    return F.when(second["reset"], second).otherwise(both)


def _change(reset: Column, floor: Column, shift: Column) -> Column:
    return F.struct(reset.alias("reset"), floor.cast("long").alias("floor"), shift.cast("long").alias("shift"))


def _composed(changes: str) -> Column:
    """The changes of an ordered list of (place, change) as one."""
    start = _change(F.lit(False), F.lit(_NO_FLOOR), F.lit(0))
    return F.aggregate(changes, start, lambda acc, x: _then(acc, x["change"]))


def net_events(events: DataFrame, span: int = SPAN) -> DataFrame:
    """Reduce the events of each key to their combined effect.

    The last event wins, except that ``scheduled_for_ts`` is the first one given and the retry counter
    sums up: it never goes below 0 at any step and starts over at a reset. The events of a key are folded in
    ranges of ``event_seq`` and the ranges composed in order, so a key with very many events is
    spread over many tasks.
    """
    reset = F.coalesce("reset_retry_count", F.lit(0)) == 1
    delta = F.when(reset, 0).otherwise(F.coalesce("retry_count_delta", F.lit(0)))
    scheduled = F.when(F.col("scheduled_for_ts").isNotNull(), F.struct("event_seq", "scheduled_for_ts"))
    ranges = (
        events.withColumn("range", F.floor(F.col("event_seq") / span))
        .groupBy(*KEYS, "range")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("event_seq", _change(reset, F.lit(0), delta).alias("change")))
            ).alias("changes"),
            F.max(F.struct("event_seq", F.struct(*_LATEST, "event_ts").alias("event"))).alias("last"),
            F.min(scheduled).alias("scheduled"),
            F.min(F.struct("event_seq", "event_ts")).alias("first"),
        )
        .withColumn("change", _composed("changes"))
    )
    return (
        ranges.groupBy(*KEYS)
        .agg(
            F.sort_array(F.collect_list(F.struct("range", "change"))).alias("changes"),
            F.max("last").alias("last"),
            F.min("scheduled").alias("scheduled"),
            F.min("first").alias("first"),
        )
        .select(
            *KEYS,
            _composed("changes").alias("change"),
            F.col("last.event").alias("last"),
            F.col("scheduled.scheduled_for_ts").alias("scheduled_for_ts"),
            F.col("first.event_ts").alias("first_event_ts"),
        )
    )


def upsert_runs(control: DataFrame, events: DataFrame) -> DataFrame:
    """The control table after ``events`` (see ``schemas.RUN_EVENT_SCHEMA``)."""
    old = control.select(*KEYS, F.struct(*[c for c in control.columns if c not in KEYS]).alias("old"))
    merged = old.join(net_events(events), KEYS, "full_outer")
    changed = F.col("last").isNotNull()

    def pick(name):
        return F.when(changed, F.col(f"last.{name}")).otherwise(F.col(f"old.{name}"))

    base = F.when(F.col("change.reset"), 0).otherwise(F.coalesce("old.retry_count", F.lit(0)))
    values = {name: pick(name) for name in _LATEST}
    for name in _COUNTS:
        values[name] = F.coalesce(values[name], F.lit(0))
    values["status_message"] = truncate(values["status_message"], MESSAGE_WIDTH)
    values["retry_count"] = (
        F.when(changed, F.greatest(F.col("change.floor"), base + F.col("change.shift")))
        .otherwise(F.col("old.retry_count"))
        .cast("int")
    )
    values["scheduled_for_ts"] = F.coalesce("old.scheduled_for_ts", "scheduled_for_ts")
    values["created_ts"] = F.coalesce("old.created_ts", "first_event_ts")
    values["updated_ts"] = F.when(changed, F.col("last.event_ts")).otherwise(
        F.col("old.updated_ts")
    )
    order = [c for c in control.columns if c not in KEYS]
    return merged.select(*KEYS, *[values[c].alias(c) for c in order])
