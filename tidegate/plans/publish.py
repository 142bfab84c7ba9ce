"""Audited publish: tables are written as a new version, audited while they are, and switched date by date.

The write job itself counts the rows that break a condition; the key columns of the written version are
aggregated once. Only where something is broken is the version read again to tell the dates apart. A
date that breaks nothing is switched, all its tables at once; any other one stays on the version it had.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators.checks import Constraints, audit, violation_counts
from tidegate.sources import versions

CONSTRAINTS = {
    "core_client_transfers": Constraints({}, S.TRANSFER_NOT_NULL, ("business_date", "transfer_id")),
    "core_clients": Constraints(S.CLIENT_CHECKS, S.CLIENT_NOT_NULL, ("business_date", "client_id")),
    "mart_transfer_aml": Constraints(S.MART_CHECKS, S.MART_NOT_NULL, ("business_date", "transfer_id")),
    "aml_report_spool": Constraints(S.SPOOL_CHECKS, S.SPOOL_NOT_NULL, ("business_date", "report_id")),
}


@dataclass(frozen=True)
class Part:
    """A table of a publish: where it lies, its rows, and what they must meet."""

    table: str
    rows: DataFrame
    constraints: Constraints | None = None
    rebalance: bool = False

    @property
    def name(self) -> str:
        return self.table.rsplit("/", 1)[1]


def part(table: str, rows: DataFrame, rebalance: bool = False) -> Part:
    """A table with the constraints of its name, if there are any."""
    return Part(table, rows, CONSTRAINTS.get(table.rsplit("/", 1)[1]), rebalance)


def write(spark: SparkSession, item: Part, version: str) -> tuple[DataFrame, dict[dt.date, str]]:
    """Write a table as a version that nothing reads yet; the written rows, and by date what is wrong with them."""
    if item.constraints is None:
        versions.write_version(item.rows, item.table, version, item.rebalance)
        return versions.read_version(spark, item.table, version, item.rows.schema), {}
    broken = Observation()
    seen = item.rows.observe(broken, F.count("*").alias("row_count"), *violation_counts(item.constraints))
    versions.write_version(seen, item.table, version, item.rebalance)
    written = versions.read_version(spark, item.table, version, item.rows.schema)
    counts = broken.get
    if any(n for name, n in counts.items() if name != "row_count"):
        found = audit(written, item.constraints)
    else:
        # Nothing but the key is left to be told by date.
        found = audit(written, Constraints({}, (), item.constraints.key))
    problems = {}
    for row in found.collect():  # a row per date
        wrong = [f"{n}: {row[n]}" for n in row.asDict() if n not in ("business_date", "row_count") and row[n]]
        if wrong:
            problems[row["business_date"]] = f"{item.name} would break {', '.join(wrong)} row(s)."
    return written, problems


def switch(
    spark: SparkSession, root: str, group: str, version: str, counts: dict[dt.date, dict[str, int]]
) -> None:
    """Let the version hold for the dates of ``counts``; the rest of it is left for ``versions.expire``."""
    versions.switch(spark, root, group, version, counts)
