"""Table shapes and the fixed values of the data contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: codes the inbound files may carry -------------------------

TRANSFER_STATUSES = ("COMPLETED", "PENDING", "REJECTED", "FAILED")
CHANNELS = ("API", "BRANCH", "MOBILE", "WEB")
CLIENT_TYPES = ("PRIVATE", "BUSINESS")
CLIENT_STATUSES = ("ACTIVE", "ARCHIVED")
KYC_STATUSES = ("PASS", "REVIEW", "PENDING", "LIMITED", "MANUAL_CHECK")
KYC_NEEDS_REVIEW = ("REVIEW", "LIMITED", "MANUAL_CHECK")
RELATIONSHIP_PURPOSES = ("SALARY", "SAVINGS", "REMITTANCE", "INVESTMENT", "BUSINESS_PAYMENTS")
ACTIVITY_LEVELS = ("LOW", "MEDIUM", "HIGH", "VERY_HIGH", "UNKNOWN")
FLAGS = (0, 1)

CURRENCIES = {
    "EUR": "Euro",
    "USD": "US Dollar",
    "PLN": "Polish Zloty",
    "CZK": "Czech Koruna",
    "GBP": "Pound Sterling",
}
COUNTRIES = {
    "AT": "Austria",
    "BE": "Belgium",
    "BG": "Bulgaria",
    "CH": "Switzerland",
    "CY": "Cyprus",
    "CZ": "Czechia",
    "DE": "Germany",
    "DK": "Denmark",
    "EE": "Estonia",
    "ES": "Spain",
    "FI": "Finland",
    "FR": "France",
    "GB": "United Kingdom",
    "GR": "Greece",
    "HR": "Croatia",
    "HU": "Hungary",
    "IE": "Ireland",
    "IS": "Iceland",
    "IT": "Italy",
    "LI": "Liechtenstein",
    "LT": "Lithuania",
    "LU": "Luxembourg",
    "LV": "Latvia",
    "MT": "Malta",
    "NL": "Netherlands",
    "NO": "Norway",
    "PL": "Poland",
    "PT": "Portugal",
    "RO": "Romania",
    "SE": "Sweden",
    "SI": "Slovenia",
    "SK": "Slovakia",
    "US": "United States",
}

BASE_CURRENCY = "EUR"
RATE_SOURCE = "MANUAL_NBP_TABLE_A"
THRESHOLD_EUR = 15000
RISK_SCORE_LIMIT = 900
REPORT_TYPES = ("ART72_THRESHOLD", "ART74_SUSPICION", "ART72_AND_ART74")

# --- Fixed values: process names, run modes and statuses ---------------------

LOAD_CLIENTS = "LOAD_CLIENTS"
LOAD_TRANSFERS = "LOAD_CLIENT_TRANSFERS"
BUILD_MART = "BUILD_MART_TRANSFER_AML"
BUILD_SPOOL = "BUILD_AML_REPORT_SPOOL"
RUN_WORKFLOW = "RUN_AML_WORKFLOW"
RUN_MODES = ("AUTO", "MANUAL")
RUN_STATUSES = ("WAITING", "PROCESSING", "DONE", "WARNING", "FAILED")

# --- Fixed values: field formats ---------------------------------------------

CURRENCY_FORMAT = "[A-Z]{3}"
COUNTRY_FORMAT = "[A-Z]{2}"
PHONE_FORMAT = r"\+[0-9]{7,20}"
EMAIL_FORMAT = r"[^\s@]+@[^\s@]+\.[^\s@]+"
KYC_FORMAT = "[A-Z_]+"
CODE_FORMAT = "[A-Z0-9_]+"


@dataclass(frozen=True)
class Field:
    """One field of an inbound file.

    ``kind`` is ``text``, ``code`` (upper-cased), ``number``, ``date`` or
    ``timestamp``; ``raw_width`` is the widest raw value the file contract allows.
    """

    name: str
    kind: str = "text"
    precision: int = 0
    scale: int = 0
    raw_width: int = 100

    @property
    def raw(self) -> str:
        return f"{self.name}_raw"

    @property
    def parsed(self) -> str:
        """Typed but not yet rounded; rules and duplicate keys look at this."""
        return f"{self.name}_parsed"


@dataclass(frozen=True)
class Dataset:
    """An inbound snapshot: its file order, key and stored column order."""

    name: str
    process: str
    key: str
    fields: tuple[Field, ...]
    stage_order: tuple[str, ...]
    error_base: int

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    @property
    def raw_columns(self) -> list[str]:
        return [f.raw for f in self.fields]

    @property
    def reject_columns(self) -> list[str]:
        """Raw columns in stored order, which differs from file order for clients."""
        stored = [self.field(n).raw for n in self.stage_order]
        head = [c for c in self.raw_columns if c not in stored]
        return head + stored


TRANSFERS = Dataset(
    name="client_transfers",
    process=LOAD_TRANSFERS,
    key="transfer_id",
    fields=(
        Field("transfer_id", "number", 10, 0),
        Field("client_id", "number", 10, 0),
        Field("source_account"),
        Field("target_account"),
        Field("amount", "number", 14, 2),
        Field("currency_code", "code"),
        Field("transfer_ts", "timestamp"),
        Field("transfer_status", "code"),
        Field("channel", "code"),
        Field("country_code", "code"),
        Field("transfer_title", raw_width=255),
    ),
    stage_order=(
        "transfer_id",
        "client_id",
        "source_account",
        "target_account",
        "amount",
        "currency_code",
        "transfer_ts",
        "transfer_status",
        "channel",
        "country_code",
        "transfer_title",
    ),
    error_base=-20000,
)

CLIENTS = Dataset(
    name="clients",
    process=LOAD_CLIENTS,
    key="client_id",
    fields=(
        Field("business_date", "date"),
        Field("client_id", "number", 10, 0),
        Field("client_type", "code"),
        Field("full_name", raw_width=255),
        Field("first_name", raw_width=255),
        Field("last_name", raw_width=255),
        Field("company_name", raw_width=255),
        Field("date_of_birth", "date"),
        Field("registration_no"),
        Field("address_line_1", raw_width=255),
        Field("city", raw_width=255),
        Field("postal_code"),
        Field("country_code", "code"),
        Field("pep_flag", "number", 1, 0),
        Field("high_risk_flag", "number", 1, 0),
        Field("client_status", "code"),
        Field("document_id", raw_width=255),
        Field("tax_id", raw_width=255),
        Field("phone_number"),
        Field("email", raw_width=255),
        Field("kyc_status", "code"),
        Field("risk_score", "number", 4, 0),
        Field("relationship_purpose_code", "code"),
        Field("expected_activity_level", "code"),
        Field("source_of_funds_declared", raw_width=255),
        Field("source_of_wealth_declared", raw_width=255),
    ),
    stage_order=(
        "client_id",
        "client_type",
        "full_name",
        "first_name",
        "last_name",
        "company_name",
        "date_of_birth",
        "document_id",
        "registration_no",
        "tax_id",
        "address_line_1",
        "city",
        "postal_code",
        "country_code",
        "phone_number",
        "email",
        "pep_flag",
        "high_risk_flag",
        "kyc_status",
        "risk_score",
        "client_status",
        "relationship_purpose_code",
        "expected_activity_level",
        "source_of_funds_declared",
        "source_of_wealth_declared",
    ),
    error_base=-20100,
)

DATASETS = {d.name: d for d in (TRANSFERS, CLIENTS)}


def _type_of(field: Field) -> T.DataType:
    if field.kind == "date":
        return T.DateType()
    if field.kind == "timestamp":
        return T.TimestampNTZType()
    if field.kind == "number" and field.scale:
        return T.DecimalType(field.precision, field.scale)
    if field.kind == "number":
        return T.LongType() if field.precision >= 10 else T.IntegerType()
    return T.StringType()


def core_schema(dataset: Dataset) -> T.StructType:
    return T.StructType(
        [T.StructField("business_date", T.DateType())]
        + [T.StructField(n, _type_of(dataset.field(n))) for n in dataset.stage_order]
    )


def stage_schema(dataset: Dataset) -> T.StructType:
    core = core_schema(dataset).fields
    return T.StructType([core[0], T.StructField("source_row_num", T.LongType()), *core[1:]])


def reject_schema(dataset: Dataset) -> T.StructType:
    return T.StructType(
        [
            T.StructField("business_date", T.DateType()),
            T.StructField("source_file_name", T.StringType()),
            T.StructField("source_row_num", T.LongType()),
            *[T.StructField(c, T.StringType()) for c in dataset.reject_columns],
            T.StructField("reject_reason", T.StringType()),
            T.StructField("rejected_at", T.TimestampNTZType()),
        ]
    )


FX_SCHEMA = T.StructType(
    [
        T.StructField("business_date", T.DateType()),
        T.StructField("currency_code", T.StringType()),
        T.StructField("unit_count", T.IntegerType()),
        T.StructField("mid_rate_pln", T.DecimalType(18, 8)),
        T.StructField("rate_source", T.StringType()),
        T.StructField("published_date", T.DateType()),
    ]
)

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("process_name", T.StringType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("run_mode", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("reason_code", T.StringType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("scheduled_for_ts", T.TimestampNTZType()),
        T.StructField("next_retry_ts", T.TimestampNTZType()),
        T.StructField("started_ts", T.TimestampNTZType()),
        T.StructField("finished_ts", T.TimestampNTZType()),
        T.StructField("expected_row_count", T.LongType()),
        T.StructField("stage_row_count", T.LongType()),
        T.StructField("reject_row_count", T.LongType()),
        T.StructField("core_row_count", T.LongType()),
        T.StructField("data_file_name", T.StringType()),
        T.StructField("ready_file_name", T.StringType()),
        T.StructField("status_message", T.StringType()),
        T.StructField("created_ts", T.TimestampNTZType()),
        T.StructField("updated_ts", T.TimestampNTZType()),
    ]
)

#: One reported change of a run; ``event_seq`` orders the changes of one key.
RUN_EVENT_SCHEMA = T.StructType(
    [f for f in CONTROL_SCHEMA if f.name not in ("retry_count", "created_ts", "updated_ts")]
    + [
        T.StructField("event_seq", T.LongType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("retry_count_delta", T.IntegerType()),
        T.StructField("reset_retry_count", T.IntegerType()),
    ]
)

MART_COLUMNS = (
    "business_date",
    "transfer_id",
    "client_id",
    "client_type",
    "full_name",
    "country_code",
    "transfer_country_code",
    "source_account",
    "target_account",
    "amount",
    "currency_code",
    "fx_rate_to_eur",
    "amount_eur",
    "above_threshold_art72_flag",
    "suspicion_art74_flag",
    "aml_review_flag",
    "aml_reason_code",
    "aml_reason_details",
    "report_type_candidate",
    "fx_rate_source",
    "fx_published_date",
    "transfer_ts",
    "transfer_status",
    "channel",
    "transfer_title",
    "pep_flag",
    "high_risk_flag",
    "kyc_status",
    "risk_score",
    "relationship_purpose_code",
    "expected_activity_level",
    "source_of_funds_declared",
    "source_of_wealth_declared",
)

#: Columns of the outbound report file, in file order.
REPORT_COLUMNS = (
    "report_run_ts",
    "business_date",
    "report_id",
    "report_type_candidate",
    "report_due_date",
    "transfer_id",
    "client_id",
    "client_type",
    "full_name",
    "date_of_birth",
    "document_id",
    "registration_no",
    "tax_id",
    "address_line_1",
    "city",
    "postal_code",
    "country_code",
    "phone_number",
    "email",
    "source_account",
    "target_account",
    "amount",
    "currency_code",
    "amount_eur",
    "transfer_ts",
    "transfer_status",
    "channel",
    "transfer_country_code",
    "transfer_title",
    "pep_flag",
    "high_risk_flag",
    "kyc_status",
    "risk_score",
    "relationship_purpose_code",
    "source_of_funds_declared",
    "source_of_wealth_declared",
    "above_threshold_art72_flag",
    "suspicion_art74_flag",
    "aml_review_flag",
    "aml_reason_code",
    "aml_reason_details",
)

#: Spool column -> the client column it is enriched with.
SPOOL_CLIENT_COLUMNS = (
    "client_type",
    "full_name",
    "date_of_birth",
    "document_id",
    "registration_no",
    "tax_id",
    "address_line_1",
    "city",
    "postal_code",
    "country_code",
    "phone_number",
    "email",
)

# Constraints of the stored tables, name -> SQL condition that must not be false.
FX_CHECKS = {
    "fx_unit_count": "unit_count > 0",
    "fx_mid_rate": "mid_rate_pln > 0",
    "fx_rate_source": "rate_source = upper(rate_source)",
}
CLIENT_CHECKS = {
    "client_status": "client_status IN ('ACTIVE', 'ARCHIVED')",
    "client_risk_score": "risk_score IS NULL OR risk_score BETWEEN 0 AND 999",
}
MART_CHECKS = {
    "mart_amount": "amount >= 0",
    "mart_amount_eur": "amount_eur >= 0",
    "mart_fx_rate": "fx_rate_to_eur > 0",
    "mart_art72": "above_threshold_art72_flag IN (0, 1)",
    "mart_art74": "suspicion_art74_flag IN (0, 1)",
    "mart_review": "aml_review_flag IN (0, 1)",
    "mart_report_type": (
        "report_type_candidate IS NULL OR report_type_candidate IN "
        "('ART72_THRESHOLD', 'ART74_SUSPICION', 'ART72_AND_ART74')"
    ),
}
SPOOL_CHECKS = {
    "spool_amount": "amount >= 0",
    "spool_amount_eur": "amount_eur >= 0",
    "spool_art72": "above_threshold_art72_flag IN (0, 1)",
    "spool_art74": "suspicion_art74_flag IN (0, 1)",
    "spool_review": "aml_review_flag = 1",
    "spool_report_type": (
        "report_type_candidate IN ('ART72_THRESHOLD', 'ART74_SUSPICION', 'ART72_AND_ART74')"
    ),
}
CONTROL_CHECKS = {
    "ctl_run_mode": "run_mode IN ('AUTO', 'MANUAL')",
    "ctl_status": "status IN ('WAITING', 'PROCESSING', 'DONE', 'WARNING', 'FAILED')",
    "ctl_retry": "retry_count >= 0",
    "ctl_expected": "expected_row_count IS NULL OR expected_row_count >= 0",
    "ctl_stage": "stage_row_count >= 0",
    "ctl_reject": "reject_row_count >= 0",
    "ctl_core": "core_row_count >= 0",
}
SPOOL_NOT_NULL = tuple(
    c
    for c in REPORT_COLUMNS
    if c
    not in (
        "date_of_birth",
        "document_id",
        "registration_no",
        "tax_id",
        "phone_number",
        "email",
        "transfer_title",
        "kyc_status",
        "risk_score",
        "relationship_purpose_code",
        "source_of_funds_declared",
        "source_of_wealth_declared",
    )
)
_OPTIONAL = (
    "aml_reason_code",
    "aml_reason_details",
    "report_type_candidate",
    "fx_published_date",
    "transfer_title",
    "kyc_status",
    "risk_score",
    "relationship_purpose_code",
    "expected_activity_level",
    "source_of_funds_declared",
    "source_of_wealth_declared",
)
MART_NOT_NULL = tuple(c for c in MART_COLUMNS if c not in _OPTIONAL)
CLIENT_NOT_NULL = (
    "business_date",
    "client_id",
    "client_type",
    "full_name",
    "address_line_1",
    "city",
    "postal_code",
    "country_code",
    "pep_flag",
    "high_risk_flag",
    "client_status",
)
TRANSFER_NOT_NULL = (
    "business_date",
    "transfer_id",
    "client_id",
    "source_account",
    "target_account",
    "amount",
    "currency_code",
    "transfer_ts",
    "transfer_status",
    "channel",
    "country_code",
)
