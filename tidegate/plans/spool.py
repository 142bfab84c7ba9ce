"""The report table: transfers up for review, with client identity and due date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tidegate import schemas as S
from tidegate.functions import due_date, report_id, ts_literal
from tidegate.operators.joins import enrich_report


def report_candidates(mart: DataFrame) -> DataFrame:
    return mart.filter("aml_review_flag = 1 AND report_type_candidate IS NOT NULL")


def build_spool(mart: DataFrame, clients: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return (
        enrich_report(report_candidates(mart), clients)
        .withColumns(
            {
                "report_id": report_id("business_date", "transfer_id"),
                "report_run_ts": ts_literal(run_ts),
                "report_due_date": due_date("transfer_ts", "report_type_candidate"),
            }
        )
        .select(*S.REPORT_COLUMNS)
    )
