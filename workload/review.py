"""Joins, rates, mart and report over the curated tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.functions import due_date, fmt_amount, like, report_id, trim_both, truncate
from tidegate.operators import aggregates as A
from tidegate.operators import fx, joins, split
from tidegate.operators.review import classify
from tidegate.plans.mart import build_mart
from tidegate.plans.spool import build_spool, report_candidates
from tidegate.sources import outbound, reference
from workload import inbound, shapes
from workload.oracle import RUN_TS, shown, sql
from workload.registry import query


def mart(spark, sf_dir):
    return build_mart(
        shapes.curated_transfers(spark, sf_dir), shapes.curated_clients(spark, sf_dir), shapes.rates(spark)
    )


def spool(spark, sf_dir):
    return build_spool(
        mart(spark, sf_dir), shapes.curated_clients(spark, sf_dir), dt.datetime.fromisoformat(RUN_TS)
    )


_SAME_DAY = [
    "business_date", "transfer_id", "client_id", "amount", "transfer_country_code", "client_type", "full_name",
    "country_code", "pep_flag", "high_risk_flag", "kyc_status", "risk_score",
]


@query(sql(shown(
    _SAME_DAY,
    "(SELECT t.*, t.country_code AS transfer_country_code, c.client_type, c.full_name, c.country_code AS client_country,"
    " c.pep_flag, c.high_risk_flag, c.kyc_status, c.risk_score FROM transfers t JOIN clients c"
    " ON c.business_date = t.business_date AND c.client_id = t.client_id) x",
).replace("full_name, country_code,", "full_name, client_country AS country_code,")))
def same_day_clients(spark, sf_dir):
    return joins.join_same_day_client(
        shapes.curated_transfers(spark, sf_dir), shapes.curated_clients(spark, sf_dir)
    ).select(*_SAME_DAY)


_BOTH_RATES = [
    "business_date", "transfer_id", "currency_code", "src_unit_count", "src_mid_rate_pln", "base_unit_count",
    "base_mid_rate_pln", "fx_rate_source", "fx_published_date",
]


@query(sql(shown(
    _BOTH_RATES,
    "(SELECT t.transfer_id, r.* FROM transfers t JOIN rated r ON r.business_date = t.business_date"
    " AND r.currency_code = t.currency_code) x",
)))
def transfer_rates(spark, sf_dir):
    rates = shapes.rates(spark)
    return joins.join_fx_base(
        joins.join_fx(shapes.curated_transfers(spark, sf_dir), rates), rates
    ).select(*_BOTH_RATES)


_EUR = ["business_date", "transfer_id", "amount", "currency_code", "fx_rate_to_eur", "amount_eur"]


@query(sql(shown(_EUR, "mart")))
def eur_amounts(spark, sf_dir):
    return fx.to_eur(shapes.curated_transfers(spark, sf_dir), shapes.rates(spark)).select(*_EUR)


_FLAGS = [
    "transfer_id", "above_threshold_art72_flag", "suspicion_art74_flag", "aml_review_flag", "aml_reason_code",
    "aml_reason_details", "report_type_candidate",
]


@query(sql(shown(_FLAGS, "mart")))
def review_flags(spark, sf_dir):
    rows = joins.join_same_day_client(
        shapes.curated_transfers(spark, sf_dir), shapes.curated_clients(spark, sf_dir)
    )
    return classify(fx.to_eur(rows, shapes.rates(spark))).select(*_FLAGS)


@query(sql(shown(S.MART_COLUMNS, "mart")))
def review_mart(spark, sf_dir):
    return mart(spark, sf_dir)


def mart_summary_of(table):
    return table.groupBy("business_date", "currency_code", "report_type_candidate").agg(
        F.count("*").alias("transfers"),
        F.sum("amount_eur").alias("total_eur"),
        F.max("amount_eur").alias("max_eur"),
        F.sum(F.col("aml_review_flag").cast("long")).alias("for_review"),
    )


def _summary_sql(source):
    return (
        "SELECT strftime(business_date, '%Y-%m-%d') AS business_date, currency_code, report_type_candidate,"
        " COUNT(*) AS transfers, CAST(sum(amount_eur) AS DOUBLE) AS total_eur,"
        " CAST(max(amount_eur) AS DOUBLE) AS max_eur, CAST(sum(aml_review_flag) AS BIGINT) AS for_review"
        f" FROM {source} GROUP BY business_date, currency_code, report_type_candidate"
    )


@query(sql(_summary_sql("mart")))
def mart_summary(spark, sf_dir):
    return mart_summary_of(mart(spark, sf_dir))


def april_rates(spark):
    """The last quarter's rates quoted on each inbound date."""
    last = [(c, u, m) for d, c, u, m in shapes.RATES if d == shapes.RATE_DAY]
    return reference.fx_rates(spark, [(d, c, u, m) for d in shapes.DATES for c, u, m in last])


@query(sql(shown(S.MART_COLUMNS, "full_day_mart")))
def inbound_to_mart(spark, sf_dir):
    """Raw rows of both datasets through split, core and mart."""
    transfers = split.core_rows(inbound.split_transfers(spark, sf_dir).stage)
    clients = split.core_rows(inbound.split_clients(spark, sf_dir).stage)
    return build_mart(transfers, clients, april_rates(spark))


@query(sql("SELECT strftime(business_date, '%Y-%m-%d') AS business_date, currency_code FROM needed"))
def required_currencies(spark, sf_dir):
    return A.required_currencies(shapes.curated_transfers(spark, sf_dir))


@query(sql("SELECT strftime(business_date, '%Y-%m-%d') AS business_date, currency_code FROM unquoted"))
def missing_rates(spark, sf_dir):
    return fx.missing_rates(shapes.curated_transfers(spark, sf_dir), shapes.rates(spark, gaps=True))


@query(sql(
    "SELECT strftime(d.business_date, '%Y-%m-%d') AS business_date,"
    " string_agg(u.currency_code, ', ' ORDER BY u.currency_code) AS missing_currencies"
    " FROM (SELECT DISTINCT business_date FROM transfers) d"
    " LEFT JOIN unquoted u ON u.business_date = d.business_date GROUP BY d.business_date"
))
def fx_coverage(spark, sf_dir):
    return fx.fx_coverage(shapes.curated_transfers(spark, sf_dir), shapes.rates(spark, gaps=True))


@query(sql(
    "SELECT strftime(business_date, '%Y-%m-%d') AS business_date, COUNT(DISTINCT report_type_candidate)"
    " AS distinct_values, COUNT(report_type_candidate) AS rows_with_value,"
    " COUNT(*) - COUNT(report_type_candidate) AS rows_without_value FROM mart GROUP BY business_date"
))
def report_type_coverage(spark, sf_dir):
    return A.coverage(mart(spark, sf_dir), ["business_date"], "report_type_candidate")


@query(sql(
    "SELECT channel, string_agg(country_code, ',' ORDER BY country_code) AS country_code_list"
    " FROM (SELECT DISTINCT channel, country_code FROM transfers) x GROUP BY channel"
))
def code_lists(spark, sf_dir):
    return A.ordered_list(shapes.curated_transfers(spark, sf_dir), ["channel"], "country_code", ",")


@query(sql(shown(S.REPORT_COLUMNS, "spool")))
def report_spool(spark, sf_dir):
    return spool(spark, sf_dir)


_ENRICHED = [
    "business_date", "transfer_id", "client_type", "full_name", "date_of_birth", "document_id", "registration_no",
    "address_line_1", "country_code", "phone_number", "kyc_status", "risk_score",
]


@query(sql(shown(
    _ENRICHED,
    "(SELECT m.business_date, m.transfer_id, c.client_type, c.full_name, c.date_of_birth, c.document_id,"
    " c.registration_no, c.address_line_1, c.country_code, c.phone_number, m.kyc_status, m.risk_score"
    " FROM mart m JOIN clients c ON c.business_date = m.business_date AND c.client_id = m.client_id) x",
)))
def enriched_mart(spark, sf_dir):
    return joins.enrich_report(mart(spark, sf_dir), shapes.curated_clients(spark, sf_dir)).select(*_ENRICHED)


@query(sql(
    "SELECT transfer_id, report_id, strftime(report_due_date, '%Y-%m-%d') AS report_due_date,"
    " CAST(amount_eur AS VARCHAR) AS amount_text, strftime(transfer_ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM spool"
))
def report_keys(spark, sf_dir):
    """Report key, due date and number text straight from the mart."""
    return report_candidates(mart(spark, sf_dir)).select(
        "transfer_id",
        report_id("business_date", "transfer_id").alias("report_id"),
        due_date("transfer_ts", "report_type_candidate").alias("report_due_date"),
        fmt_amount("amount_eur").alias("amount_text"),
        F.date_format("transfer_ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
    )


def _line_value(c):
    if c in ("business_date", "report_due_date", "date_of_birth"):
        text = f"strftime({c}, '%Y-%m-%d')"
    elif c in ("report_run_ts", "transfer_ts"):
        text = f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
    else:
        text = f"CAST({c} AS VARCHAR)"
    return f"""'"' || replace(coalesce({text}, ''), '"', '""') || '"'"""


LINES_SQL = (
    "SELECT business_date, report_id, " + " || ';' || ".join(_line_value(c) for c in S.REPORT_COLUMNS) + " AS line FROM spool"
)


@query(sql(f"SELECT strftime(business_date, '%Y-%m-%d') AS business_date, report_id, line FROM ({LINES_SQL}) l"))
def report_lines(spark, sf_dir):
    return outbound.report_lines(spool(spark, sf_dir))


@query(sql(
    "SELECT aml_reason_code, report_type_candidate, COUNT(*) AS row_count,"
    " CASE aml_reason_code WHEN 'ART72_AND_ART74' THEN 0 WHEN 'ART72_THRESHOLD' THEN 1 WHEN 'ART74_PEP' THEN 2"
    " ELSE 3 END AS position FROM mart WHERE aml_review_flag = 1 GROUP BY aml_reason_code, report_type_candidate"
))
def ordered_reasons(spark, sf_dir):
    reasons = A.count_by(
        mart(spark, sf_dir).filter("aml_review_flag = 1"), ["aml_reason_code", "report_type_candidate"]
    )
    position = A.custom_order("aml_reason_code", ["ART72_AND_ART74", "ART72_THRESHOLD", "ART74_PEP"])
    return A.ordered(reasons.withColumn("position", position), ["position", "aml_reason_code"])


@query(sql(
    "SELECT transfer_id, CAST(aml_reason_details LIKE 'amount_eur=%' AS INTEGER) AS by_amount,"
    " CAST(aml_reason_details LIKE '%kyc_status=REVIEW%' AS INTEGER) AS by_kyc,"
    " nullif(trim(replace(aml_reason_details, 'pep_flag=1', ';'), ';'), '') AS stripped,"
    " substr(aml_reason_details, 1, 12) AS head FROM mart"
))
def reason_patterns(spark, sf_dir):
    details = F.col("aml_reason_details")
    return mart(spark, sf_dir).select(
        "transfer_id",
        like("aml_reason_details", "amount_eur=%").cast("int").alias("by_amount"),
        like("aml_reason_details", "%kyc_status=REVIEW%").cast("int").alias("by_kyc"),
        trim_both(F.replace(details, F.lit("pep_flag=1"), F.lit(";")), ";").alias("stripped"),
        truncate("aml_reason_details", 12).alias("head"),
    )
