"""Outbound report files: ``aml_report_spool_YYYYMMDD.csv`` and its ``.ok`` marker."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.functions import fmt_amount, fmt_date, fmt_ts
from tidegate.sources import files
from tidegate.sources.local import local_rows

_FORMATS = {
    "report_run_ts": fmt_ts,
    "transfer_ts": fmt_ts,
    "business_date": fmt_date,
    "report_due_date": fmt_date,
    "date_of_birth": fmt_date,
    "amount": fmt_amount,
    "amount_eur": fmt_amount,
}


def report_file(folder: str, date: dt.date, kind: str) -> str:
    return f"{folder.rstrip('/')}/aml_report_spool_{date:%Y%m%d}.{kind}"


def _quoted(name: str) -> Column:
    text = _FORMATS[name](name) if name in _FORMATS else F.col(name).cast("string")
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit('"'), F.lit('""'))
    return F.concat(F.lit('"'), doubled, F.lit('"'))


def report_lines(spool: DataFrame) -> DataFrame:
    """(business_date, report_id, line): every value quoted, NULL as ``""``, ``;`` between values."""
    return spool.select(
        "business_date", "report_id", F.concat_ws(";", *[_quoted(c) for c in S.REPORT_COLUMNS]).alias("line")
    )


def write_reports(spool: DataFrame, folder: str, dates: Sequence[dt.date]) -> None:
    """Write the reports of the given dates under ``folder``, one sub-folder per file name.

    A report is an unquoted header line and one line per row, ordered by report id,
    in part files that are the report when concatenated in name order. One
    range-partitioned sort serves all dates, so neither a long report nor many short
    ones end up in one task.
    """
    header = local_rows(
        spool.sparkSession,
        [(d, 0, "", ";".join(S.REPORT_COLUMNS)) for d in dates],
        "business_date date, part int, report_id string, line string",
    )
    rows = report_lines(spool.filter(F.col("business_date").isin(list(dates)))).select(
        "business_date", F.lit(1).alias("part"), "report_id", "line"
    )
    name = F.concat(
        F.lit("aml_report_spool_"), F.date_format("business_date", "yyyyMMdd"), F.lit(".csv")
    )
    # Sorting by the file name first is what lets the writer keep the order.
    (
        header.unionByName(rows)
        .select(name.alias("file_name"), "part", "report_id", "line")
        .orderBy("file_name", "part", "report_id")
        .select("line", "file_name")
        .write.partitionBy("file_name")
        .option("lineSep", "\n")
        .text(folder)
    )


def invalidate(spark: SparkSession, folder: str, date: dt.date, data_too: bool) -> None:
    """Remove the ready marker and, if asked, the data of an earlier report."""
    files.delete(spark, report_file(folder, date, "ok"))
    if data_too:
        files.delete(spark, report_file(folder, date, "csv"))


def publish_marker(spark: SparkSession, folder: str, date: dt.date, count: int) -> str:
    path = report_file(folder, date, "ok")
    files.write_line(spark, path, str(count))
    return path


def publish(spool: DataFrame, folder: str, stored: dict[dt.date, int]) -> dict[dt.date, int]:
    """Export the given dates in one job; ``stored`` holds their row counts.

    Returns the written counts. A date gets its data, and last its ready marker, only
    if everything stored was written; otherwise it is left without both.
    """
    spark = spool.sparkSession
    for date in stored:
        invalidate(spark, folder, date, data_too=True)
    staging = f"{folder.rstrip('/')}/_export-{uuid.uuid4().hex}"
    try:
        write_reports(spool, staging, list(stored))
        lines = spark.read.schema("value string, file_name string").option("lineSep", "\n").text(staging)
        found = {r.file_name: r["count"] - 1 for r in lines.groupBy("file_name").count().collect()}
        written = {}
        for date, count in stored.items():
            path = report_file(folder, date, "csv")
            name = path.rsplit("/", 1)[-1]
            written[date] = found.get(name, 0)
            if written[date] == count:
                files.move(spark, f"{staging}/file_name={name}", path)
                publish_marker(spark, folder, date, count)
    finally:
        files.delete(spark, staging)
    return written
