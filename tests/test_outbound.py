"""Outbound files of several dates and many parts."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.sources import outbound

DAYS = [dt.date(2026, 6, 1), dt.date(2026, 6, 2), dt.date(2026, 6, 3)]


def spool_rows(spark, n):
    known = {
        "business_date": F.when(F.col("id") < n // 2, F.lit(DAYS[0])).otherwise(F.lit(DAYS[1])),
        "report_id": F.concat(F.lit("AML-"), F.lpad((F.col("id") * 7919 % n).cast("string"), 6, "0")),
        "amount": F.lit("0.5").cast("decimal(14,2)"),
        "transfer_title": F.lit('say "hi"; bye'),
        "report_run_ts": F.lit("2026-06-03 01:02:03").cast("timestamp_ntz"),
    }
    return spark.range(0, n, 1, 6).select(
        *[known.get(c, F.lit(None).cast("string")).alias(c) for c in S.REPORT_COLUMNS if c not in (
            "transfer_ts", "report_due_date", "date_of_birth", "amount_eur")],
        F.lit(None).cast("timestamp_ntz").alias("transfer_ts"),
        F.lit(None).cast("date").alias("report_due_date"),
        F.lit(None).cast("date").alias("date_of_birth"),
        F.lit(None).cast("decimal(18,2)").alias("amount_eur"),
    )


def text_of(path):
    return "".join(open(p).read() for p in sorted(glob.glob(os.path.join(path, "part-*")))).splitlines()


def test_parts_concatenate_to_an_ordered_report(spark, tmp_path):
    n, folder = 6000, str(tmp_path)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # The third date has no rows; the second one is said to have one row too many.
        written = outbound.publish(
            spool_rows(spark, n), folder, {DAYS[0]: n // 2, DAYS[1]: n // 2 + 1, DAYS[2]: 0}
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert written == {DAYS[0]: n // 2, DAYS[1]: n // 2, DAYS[2]: 0}
    first = outbound.report_file(folder, DAYS[0], "csv")
    assert len(glob.glob(os.path.join(first, "part-*"))) > 1
    lines = text_of(first)
    ids = [line.split(";")[2] for line in lines[1:]]
    assert lines[0] == ";".join(S.REPORT_COLUMNS) and len(ids) == n // 2 and ids == sorted(ids)
    assert '"say ""hi""; bye"' in lines[1] and '"0.50"' in lines[1] and '"2026-06-03 01:02:03"' in lines[1]
    assert open(outbound.report_file(folder, DAYS[0], "ok")).read() == f"{n // 2}\n"
    # A short export is not published at all; an empty report is a header and a zero.
    assert not os.path.exists(outbound.report_file(folder, DAYS[1], "csv"))
    assert not os.path.exists(outbound.report_file(folder, DAYS[1], "ok"))
    assert text_of(outbound.report_file(folder, DAYS[2], "csv")) == [";".join(S.REPORT_COLUMNS)]
    assert open(outbound.report_file(folder, DAYS[2], "ok")).read() == "0\n"
    assert [p for p in os.listdir(folder) if p.startswith("_export")] == []
