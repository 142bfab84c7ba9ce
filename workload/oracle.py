"""Plain SQL for the registered queries, written against the given tables."""

from __future__ import annotations

import re

from tidegate import schemas as S
from workload.shapes import INPUT_CTES

DATE_COLUMNS = {
    "business_date", "date_of_birth", "report_due_date", "fx_published_date", "published_date",
    "parsed_date",
}
TS_COLUMNS = {"transfer_ts", "report_run_ts", "next_retry_ts", "scheduled_for_ts", "updated_ts", "created_ts"}
DECIMAL_COLUMNS = {
    "amount", "amount_eur", "fx_rate_to_eur", "mid_rate_pln", "src_mid_rate_pln", "base_mid_rate_pln",
    "total_eur", "max_eur", "parsed_amount",
}


def shown(columns, source: str) -> str:
    """Select ``columns``: dates and times as ISO text, decimals as doubles."""
    parts = []
    for c in columns:
        if c in DATE_COLUMNS:
            parts.append(f"strftime({c}, '%Y-%m-%d') AS {c}")
        elif c in TS_COLUMNS:
            parts.append(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}")
        elif c in DECIMAL_COLUMNS:
            parts.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            parts.append(c)
    return f"SELECT {', '.join(parts)} FROM {source}"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
_CODES = {f.raw for d in S.DATASETS.values() for f in d.fields if f.kind == "code"}


def _normalised(dataset) -> str:
    parts = []
    for c in dataset.raw_columns:
        text = f"nullif(trim({c}), '')"
        parts.append(f"upper({text}) AS {c}" if c in _CODES else f"{text} AS {c}")
    return ", ".join(parts)


def _number(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({c}_raw, '{_NUMBER}') THEN TRY_CAST({c}_raw AS DECIMAL(38,20)) END"
        f" AS {c}_parsed"
    )


def _date(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({c}_raw, '[0-9]{{4}}[^0-9A-Za-z][0-9]{{1,2}}[^0-9A-Za-z][0-9]{{1,2}}')"
        f" THEN CAST(try_strptime(regexp_replace({c}_raw, '[^0-9]', '-', 'g'), '%Y-%m-%d') AS DATE) END"
        f" AS {c}_parsed"
    )


def _timestamp(c: str) -> str:
    part = "[^0-9A-Za-z][0-9]{1,2}"
    return (
        f"CASE WHEN regexp_full_match({c}_raw, '[0-9]{{4}}({part}){{5}}')"
        f" THEN try_strptime(regexp_replace({c}_raw, '[^0-9]', '-', 'g'), '%Y-%m-%d-%H-%M-%S') END AS {c}_parsed"
    )


def _too_long(c: str, n: int) -> str:
    return f"CASE WHEN length({c}_raw) > {n} THEN '{c} too long' END"


def _required(c: str, n: int) -> str:
    return f"CASE WHEN {c}_raw IS NULL THEN 'missing {c}' WHEN length({c}_raw) > {n} THEN '{c} too long' END"


def _code(c: str, n: int, regex: str, values) -> str:
    return (
        f"CASE WHEN length({c}_raw) > {n} THEN '{c} too long'"
        f" WHEN NOT regexp_full_match({c}_raw, '{regex}') THEN 'invalid {c} format'"
        f" WHEN {c}_raw NOT IN {_in(values)} THEN 'unsupported {c}' END"
    )


_TRANSFER_MESSAGES = f"""
  CASE WHEN transfer_id_parsed IS NULL THEN 'invalid transfer_id' END,
  CASE WHEN client_id_parsed IS NULL THEN 'invalid client_id' END,
  {_required('source_account', 34)},
  {_required('target_account', 34)},
  CASE WHEN amount_parsed IS NULL THEN 'invalid amount' WHEN amount_parsed < 0 THEN 'negative amount' END,
  CASE WHEN currency_code_raw IS NULL THEN 'missing currency_code'
    WHEN NOT regexp_full_match(currency_code_raw, '[A-Z]{{3}}') THEN 'invalid currency_code format'
    WHEN currency_code_raw NOT IN {_in(S.CURRENCIES)} THEN 'unsupported currency_code' END,
  CASE WHEN transfer_ts_parsed IS NULL THEN 'invalid transfer_ts' END,
  CASE WHEN transfer_status_raw IS NULL THEN 'missing transfer_status'
    WHEN transfer_status_raw NOT IN {_in(S.TRANSFER_STATUSES)} THEN 'invalid transfer_status' END,
  CASE WHEN channel_raw IS NULL THEN 'missing channel'
    WHEN channel_raw NOT IN {_in(S.CHANNELS)} THEN 'invalid channel' END,
  CASE WHEN country_code_raw IS NULL THEN 'missing country_code'
    WHEN NOT regexp_full_match(country_code_raw, '[A-Z]{{2}}') THEN 'invalid country_code format'
    WHEN country_code_raw NOT IN {_in(S.COUNTRIES)} THEN 'unsupported country_code' END,
  {_too_long('transfer_title', 255)}"""

_CLIENT_MESSAGES = f"""
  CASE WHEN business_date_parsed IS NULL THEN 'invalid business_date'
    WHEN business_date_parsed <> business_date THEN 'business_date does not match requested date' END,
  CASE WHEN client_id_parsed IS NULL THEN 'invalid client_id' END,
  CASE WHEN client_type_raw IS NULL THEN 'missing client_type'
    WHEN client_type_raw NOT IN {_in(S.CLIENT_TYPES)} THEN 'invalid client_type' END,
  {_required('full_name', 200)}, {_too_long('first_name', 100)}, {_too_long('last_name', 100)},
  {_too_long('company_name', 200)}, {_too_long('document_id', 100)}, {_too_long('registration_no', 50)},
  {_too_long('tax_id', 100)}, {_required('address_line_1', 200)}, {_required('city', 100)},
  {_required('postal_code', 20)},
  CASE WHEN country_code_raw IS NULL THEN 'missing country_code'
    WHEN NOT regexp_full_match(country_code_raw, '[A-Z]{{2}}') THEN 'invalid country_code format'
    WHEN country_code_raw NOT IN {_in(S.COUNTRIES)} THEN 'unsupported country_code' END,
  CASE WHEN length(phone_number_raw) > 50 THEN 'phone_number too long'
    WHEN NOT regexp_full_match(phone_number_raw, '\\+[0-9]{{7,20}}') THEN 'invalid phone_number format' END,
  CASE WHEN length(email_raw) > 255 THEN 'email too long'
    WHEN NOT regexp_full_match(email_raw, '[^\\s@]+@[^\\s@]+\\.[^\\s@]+') THEN 'invalid email format' END,
  CASE WHEN pep_flag_parsed IS NULL THEN 'invalid pep_flag'
    WHEN pep_flag_parsed NOT IN (0, 1) THEN 'pep_flag must be 0 or 1' END,
  CASE WHEN high_risk_flag_parsed IS NULL THEN 'invalid high_risk_flag'
    WHEN high_risk_flag_parsed NOT IN (0, 1) THEN 'high_risk_flag must be 0 or 1' END,
  {_code('kyc_status', 30, '[A-Z_]+', S.KYC_STATUSES)},
  CASE WHEN risk_score_raw IS NOT NULL AND risk_score_parsed IS NULL THEN 'invalid risk_score'
    WHEN risk_score_parsed NOT BETWEEN 0 AND 999 THEN 'risk_score must be between 0 and 999' END,
  CASE WHEN client_status_raw IS NULL THEN 'missing client_status'
    WHEN client_status_raw NOT IN {_in(S.CLIENT_STATUSES)} THEN 'invalid client_status' END,
  {_code('relationship_purpose_code', 50, '[A-Z0-9_]+', S.RELATIONSHIP_PURPOSES)},
  {_code('expected_activity_level', 50, '[A-Z0-9_]+', S.ACTIVITY_LEVELS)},
  {_too_long('source_of_funds_declared', 255)}, {_too_long('source_of_wealth_declared', 255)},
  CASE WHEN client_type_raw = 'PRIVATE' AND first_name_raw IS NULL THEN 'missing first_name for PRIVATE'
    WHEN client_type_raw = 'PRIVATE' AND last_name_raw IS NULL THEN 'missing last_name for PRIVATE'
    WHEN client_type_raw = 'PRIVATE' AND date_of_birth_parsed IS NULL THEN 'invalid date_of_birth for PRIVATE'
    WHEN client_type_raw = 'BUSINESS' AND company_name_raw IS NULL THEN 'missing company_name for BUSINESS'
    WHEN client_type_raw = 'BUSINESS' AND registration_no_raw IS NULL
      THEN 'missing registration_no for BUSINESS' END"""


def _counted(judged: str, key: str) -> str:
    return (
        f"SELECT *, CASE WHEN reject_reason IS NULL THEN COUNT(*) OVER (PARTITION BY business_date, {key}_parsed,"
        f" reject_reason IS NULL) END AS key_rows FROM {judged}"
    )


def _stage(dataset) -> str:
    kinds = {f.name: f for f in dataset.fields}
    parts = []
    for name in dataset.stage_order:
        f = kinds[name]
        if f.kind == "number" and f.scale:
            parts.append(f"CAST(round({name}_parsed, {f.scale}) AS DECIMAL({f.precision},{f.scale})) AS {name}")
        elif f.kind == "number":
            kind = "BIGINT" if f.precision >= 10 else "INTEGER"
            parts.append(f"CAST(round({name}_parsed, 0) AS {kind}) AS {name}")
        elif f.kind in ("date", "timestamp"):
            parts.append(f"{name}_parsed AS {name}")
        else:
            parts.append(f"{name}_raw AS {name}")
    return "business_date, source_row_num, " + ", ".join(parts)


def _rejects(counted: str, dataset) -> str:
    return (
        f"SELECT business_date, source_file_name, source_row_num, {', '.join(dataset.reject_columns)},"
        f" coalesce(reject_reason, 'duplicate {dataset.key} in snapshot') AS reject_reason"
        f" FROM {counted} WHERE reject_reason IS NOT NULL OR key_rows > 1"
    )


_CLIENT_NUMBERS = [f.name for f in S.CLIENTS.fields if f.kind == "number"]

# Rates and amounts as ratios of whole numbers, rounded half up.
_UP = "CAST(s.mid_rate_pln * 100000000 AS HUGEINT) * b.unit_count"
_DOWN = "CAST(b.mid_rate_pln * 100000000 AS HUGEINT) * s.unit_count"


def _rated(fx: str) -> str:
    return f"""SELECT s.business_date, s.currency_code, {_UP} AS up, {_DOWN} AS down,
      s.unit_count AS src_unit_count, s.mid_rate_pln AS src_mid_rate_pln,
      b.unit_count AS base_unit_count, b.mid_rate_pln AS base_mid_rate_pln,
      CASE WHEN s.currency_code = 'EUR' THEN CAST(1 AS DECIMAL(18,8))
        ELSE CAST(CAST((2 * {_UP} * 100000000 + {_DOWN}) // (2 * {_DOWN}) AS DECIMAL(18,0))
          * CAST(0.00000001 AS DECIMAL(9,8)) AS DECIMAL(18,8)) END AS fx_rate_to_eur,
      s.rate_source AS fx_rate_source, s.published_date AS fx_published_date
    FROM {fx} s JOIN {fx} b ON b.business_date = s.business_date AND b.currency_code = 'EUR'"""


_AMOUNT_EUR = """CASE WHEN t.currency_code = 'EUR' THEN CAST(t.amount AS DECIMAL(18,2))
      ELSE CAST(CAST((2 * CAST(t.amount * 100 AS HUGEINT) * r.up + r.down) // (2 * r.down) AS DECIMAL(18,0))
        * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) END"""


def _mart(transfers: str, clients: str) -> str:
    return f"""SELECT business_date, transfer_id, client_id, client_type, full_name, country_code,
      transfer_country_code, source_account, target_account, amount, currency_code, fx_rate_to_eur, amount_eur,
      a72 AS above_threshold_art72_flag, a74 AS suspicion_art74_flag,
      CASE WHEN a72 = 1 OR a74 = 1 THEN 1 ELSE 0 END AS aml_review_flag,
      CASE WHEN a72 = 1 AND a74 = 1 THEN 'ART72_AND_ART74' WHEN a72 = 1 THEN 'ART72_THRESHOLD'
        WHEN pep_flag = 1 THEN 'ART74_PEP' WHEN hrk = 1 THEN 'ART74_HIGH_RISK_KYC'
        WHEN risk_score >= 900 THEN 'ART74_RISK_SCORE' END AS aml_reason_code,
      nullif(concat_ws('; ',
        CASE WHEN a72 = 1 THEN 'amount_eur=' || CAST(amount_eur AS VARCHAR) || ' > 15000' END,
        CASE WHEN pep_flag = 1 THEN 'pep_flag=1' END,
        CASE WHEN hrk = 1 THEN 'high_risk_flag=1; kyc_status=' || kyc_status END,
        CASE WHEN risk_score >= 900 THEN 'risk_score=' || CAST(risk_score AS VARCHAR) || ' >= 900' END
      ), '') AS aml_reason_details,
      CASE WHEN a72 = 1 AND a74 = 1 THEN 'ART72_AND_ART74' WHEN a72 = 1 THEN 'ART72_THRESHOLD'
        WHEN a74 = 1 THEN 'ART74_SUSPICION' END AS report_type_candidate,
      fx_rate_source, fx_published_date, transfer_ts, transfer_status, channel, transfer_title, pep_flag,
      high_risk_flag, kyc_status, risk_score, relationship_purpose_code, expected_activity_level,
      source_of_funds_declared, source_of_wealth_declared
    FROM (SELECT *, CASE WHEN amount_eur > 15000 THEN 1 ELSE 0 END AS a72,
        CASE WHEN pep_flag = 1 OR hrk = 1 OR coalesce(risk_score, -1) >= 900 THEN 1 ELSE 0 END AS a74
      FROM (SELECT t.business_date, t.transfer_id, t.client_id, c.client_type, c.full_name, c.country_code,
          t.country_code AS transfer_country_code, t.source_account, t.target_account, t.amount, t.currency_code,
          r.fx_rate_to_eur, {_AMOUNT_EUR} AS amount_eur, r.fx_rate_source, r.fx_published_date, t.transfer_ts,
          t.transfer_status, t.channel, t.transfer_title, c.pep_flag, c.high_risk_flag, c.kyc_status,
          c.risk_score, c.relationship_purpose_code, c.expected_activity_level, c.source_of_funds_declared,
          c.source_of_wealth_declared,
          CASE WHEN c.high_risk_flag = 1 AND c.kyc_status IN ('REVIEW', 'LIMITED', 'MANUAL_CHECK')
            THEN 1 ELSE 0 END AS hrk
        FROM {transfers} t
        JOIN {clients} c ON c.business_date = t.business_date AND c.client_id = t.client_id
        JOIN rated r ON r.business_date = t.business_date AND r.currency_code = t.currency_code) a) b"""


RUN_TS = "2026-04-20 06:30:00"

CTES = {
    **INPUT_CTES,
    "t_norm": f"SELECT business_date, source_file_name, source_row_num, {_normalised(S.TRANSFERS)} FROM inbound_transfers",
    "t_parsed": f"SELECT *, {_number('transfer_id')}, {_number('client_id')}, {_number('amount')},"
    f" {_timestamp('transfer_ts')} FROM t_norm",
    "t_judged": f"SELECT *, nullif(concat_ws('; ', {_TRANSFER_MESSAGES}), '') AS reject_reason FROM t_parsed",
    "t_counted": _counted("t_judged", "transfer_id"),
    "t_stage": f"SELECT {_stage(S.TRANSFERS)} FROM t_counted WHERE key_rows = 1",
    "t_reject": _rejects("t_counted", S.TRANSFERS),
    "c_norm": f"SELECT business_date, source_file_name, source_row_num, {_normalised(S.CLIENTS)} FROM inbound_clients",
    "c_parsed": f"SELECT *, {_date('business_date')}, {_date('date_of_birth')},"
    f" {', '.join(_number(n) for n in _CLIENT_NUMBERS)} FROM c_norm",
    "c_judged": f"SELECT *, nullif(concat_ws('; ', {_CLIENT_MESSAGES}), '') AS reject_reason FROM c_parsed",
    "c_counted": _counted("c_judged", "client_id"),
    "c_stage": f"SELECT {_stage(S.CLIENTS)} FROM c_counted WHERE key_rows = 1",
    "c_reject": _rejects("c_counted", S.CLIENTS),
    "rated": _rated("fx"),
    "mart": _mart("transfers", "clients"),
    "spool": f"""SELECT TIMESTAMP '{RUN_TS}' AS report_run_ts, m.business_date,
      'AML-' || strftime(m.business_date, '%Y%m%d') || '-' || CAST(m.transfer_id AS VARCHAR) AS report_id,
      m.report_type_candidate,
      CAST(m.transfer_ts AS DATE) + CASE WHEN m.report_type_candidate = 'ART72_THRESHOLD' THEN 7 ELSE 2 END
        AS report_due_date,
      m.transfer_id, m.client_id, c.client_type, c.full_name, c.date_of_birth, c.document_id, c.registration_no,
      c.tax_id, c.address_line_1, c.city, c.postal_code, c.country_code, c.phone_number, c.email,
      m.source_account, m.target_account, m.amount, m.currency_code, m.amount_eur, m.transfer_ts,
      m.transfer_status, m.channel, m.transfer_country_code, m.transfer_title, m.pep_flag, m.high_risk_flag,
      m.kyc_status, m.risk_score, m.relationship_purpose_code, m.source_of_funds_declared,
      m.source_of_wealth_declared, m.above_threshold_art72_flag, m.suspicion_art74_flag, m.aml_review_flag,
      m.aml_reason_code, m.aml_reason_details
    FROM mart m JOIN clients c ON c.business_date = m.business_date AND c.client_id = m.client_id
    WHERE m.aml_review_flag = 1 AND m.report_type_candidate IS NOT NULL""",
    "f_rated": _rated("april_fx"),
    "april_fx": "SELECT DATE '2026-04-13' + CAST(i AS INTEGER) AS business_date, f.currency_code, f.unit_count,"
    " f.mid_rate_pln, f.rate_source, DATE '2026-04-13' + CAST(i AS INTEGER) AS published_date"
    " FROM fx f, range(7) r(i) WHERE f.business_date = DATE '2001-07-01'",
    "full_day_mart": _mart("t_stage", "c_stage").replace("JOIN rated r", "JOIN f_rated r"),
    "needed": "SELECT DISTINCT business_date, currency_code FROM transfers UNION"
    " SELECT DISTINCT business_date, 'EUR' FROM transfers WHERE currency_code <> 'EUR'",
    "unquoted": "SELECT n.business_date, n.currency_code FROM needed n LEFT JOIN fx_gaps f"
    " ON f.business_date = n.business_date AND f.currency_code = n.currency_code WHERE f.currency_code IS NULL",
    "promised": "SELECT business_date, COUNT(*) + CASE day(business_date) WHEN 14 THEN 1 WHEN 15 THEN 3 ELSE 0 END"
    " AS expected_row_count FROM inbound_transfers GROUP BY business_date",
    "t_counts": "SELECT p.business_date, p.expected_row_count,"
    " (SELECT COUNT(*) FROM t_stage s WHERE s.business_date = p.business_date) AS stage_row_count,"
    " (SELECT COUNT(*) FROM t_reject r WHERE r.business_date = p.business_date) AS reject_row_count"
    " FROM promised p",
}


def sql(select: str, **extra: str) -> str:
    """``select`` with the common table expressions it needs, in dependency order."""
    known = {**CTES, **extra}
    ordered: list[str] = []

    def visit(text: str, path: tuple[str, ...]) -> None:
        for name, body in known.items():
            used = re.search(rf"(?<![\w.'])\b{name}\b(?![\w.'])", text)
            if used and name not in path and name not in ordered:
                visit(body, (*path, name))
                ordered.append(name)

    visit(select, ())
    head = ", ".join(f"{n} AS ({known[n]})" for n in ordered)
    return f"WITH {head} {select}" if head else select
