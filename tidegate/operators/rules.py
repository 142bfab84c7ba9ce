"""Row rules as data.

A rule is a chain of (condition, message) arms for one field: the first arm
that holds gives the rule's message, and the messages of all rules that fired
are joined in rule order. A dataset's rules are a plain list, so adding a rule
is adding an entry. Everything becomes one projection; no rows move.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.functions import (
    equals_date,
    in_domain,
    in_range,
    matches,
    max_len,
    norm_code,
    norm_text,
    parse_number,
    to_date_lenient,
    to_ts_lenient,
)
from tidegate.schemas import Dataset, Field

Arm = tuple[Column, str]


@dataclass(frozen=True)
class Rule:
    field: str
    arms: tuple[Arm, ...]

    def message(self) -> Column:
        """The first failing arm's message, or NULL."""
        chain = None
        for cond, text in self.arms:
            chain = F.when(cond, text) if chain is None else chain.when(cond, text)
        return chain


def reject_reason(rules: Sequence[Rule]) -> Column:
    """Messages of all failing rules joined by ``'; '``; NULL for a valid row."""
    return F.nullif(F.concat_ws("; ", *[r.message() for r in rules]), F.lit(""))


# --- Arms --------------------------------------------------------------------


def _raw(name: str) -> Column:
    return F.col(f"{name}_raw")


def _parsed(name: str) -> Column:
    return F.col(f"{name}_parsed")


def missing(name: str) -> Arm:
    return _raw(name).isNull(), f"missing {name}"


def too_long(name: str, n: int) -> Arm:
    return ~max_len(_raw(name), n), f"{name} too long"


def bad_format(name: str, regex: str, message: str | None = None) -> Arm:
    return ~matches(_raw(name), regex), message or f"invalid {name} format"


def not_one_of(name: str, values: Iterable[str], word: str = "unsupported") -> Arm:
    return ~in_domain(_raw(name), values), f"{word} {name}"


def not_parsed(name: str) -> Arm:
    return _parsed(name).isNull(), f"invalid {name}"


def not_flag(name: str) -> Arm:
    return ~_parsed(name).isin(*S.FLAGS), f"{name} must be 0 or 1"


def rule(field: str, *arms: Arm) -> Rule:
    return Rule(field, arms)


# --- Rule tables (order and wording are part of the reject-table contract) ---


def transfer_rules() -> list[Rule]:
    """Needs the flags ``is_supported_currency`` and ``is_supported_country``."""
    return [
        rule("transfer_id", not_parsed("transfer_id")),
        rule("client_id", not_parsed("client_id")),
        rule("source_account", missing("source_account"), too_long("source_account", 34)),
        rule("target_account", missing("target_account"), too_long("target_account", 34)),
        rule(
            "amount",
            not_parsed("amount"),
            (~in_range(_parsed("amount"), 0), "negative amount"),
        ),
        rule(
            "currency_code",
            missing("currency_code"),
            bad_format("currency_code", S.CURRENCY_FORMAT),
            (F.col("is_supported_currency") == 0, "unsupported currency_code"),
        ),
        rule("transfer_ts", not_parsed("transfer_ts")),
        rule(
            "transfer_status",
            missing("transfer_status"),
            not_one_of("transfer_status", S.TRANSFER_STATUSES, "invalid"),
        ),
        rule("channel", missing("channel"), not_one_of("channel", S.CHANNELS, "invalid")),
        rule(
            "country_code",
            missing("country_code"),
            bad_format("country_code", S.COUNTRY_FORMAT),
            (F.col("is_supported_country") == 0, "unsupported country_code"),
        ),
        rule("transfer_title", too_long("transfer_title", 255)),
    ]


def _optional_code(name: str, width: int, regex: str, values: Iterable[str]) -> Rule:
    return rule(name, too_long(name, width), bad_format(name, regex), not_one_of(name, values))


def client_rules() -> list[Rule]:
    """Needs ``business_date``, the date the snapshot was requested for."""
    is_private = _raw("client_type") == "PRIVATE"
    is_business = _raw("client_type") == "BUSINESS"
    return [
        rule(
            "business_date",
            not_parsed("business_date"),
            (
                ~equals_date(_parsed("business_date"), "business_date"),
                "business_date does not match requested date",
            ),
        ),
        rule("client_id", not_parsed("client_id")),
        rule(
            "client_type",
            missing("client_type"),
            not_one_of("client_type", S.CLIENT_TYPES, "invalid"),
        ),
        rule("full_name", missing("full_name"), too_long("full_name", 200)),
        rule("first_name", too_long("first_name", 100)),
        rule("last_name", too_long("last_name", 100)),
        rule("company_name", too_long("company_name", 200)),
        rule("document_id", too_long("document_id", 100)),
        rule("registration_no", too_long("registration_no", 50)),
        rule("tax_id", too_long("tax_id", 100)),
        rule("address_line_1", missing("address_line_1"), too_long("address_line_1", 200)),
        rule("city", missing("city"), too_long("city", 100)),
        rule("postal_code", missing("postal_code"), too_long("postal_code", 20)),
        rule(
            "country_code",
            missing("country_code"),
            bad_format("country_code", S.COUNTRY_FORMAT),
            not_one_of("country_code", S.COUNTRIES),
        ),
        rule(
            "phone_number",
            too_long("phone_number", 50),
            bad_format("phone_number", S.PHONE_FORMAT),
        ),
        rule("email", too_long("email", 255), bad_format("email", S.EMAIL_FORMAT)),
        rule("pep_flag", not_parsed("pep_flag"), not_flag("pep_flag")),
        rule("high_risk_flag", not_parsed("high_risk_flag"), not_flag("high_risk_flag")),
        _optional_code("kyc_status", 30, S.KYC_FORMAT, S.KYC_STATUSES),
        rule(
            "risk_score",
            (_raw("risk_score").isNotNull() & _parsed("risk_score").isNull(), "invalid risk_score"),
            (
                ~in_range(_parsed("risk_score"), 0, 999),
                "risk_score must be between 0 and 999",
            ),
        ),
        rule(
            "client_status",
            missing("client_status"),
            not_one_of("client_status", S.CLIENT_STATUSES, "invalid"),
        ),
        _optional_code(
            "relationship_purpose_code", 50, S.CODE_FORMAT, S.RELATIONSHIP_PURPOSES
        ),
        _optional_code("expected_activity_level", 50, S.CODE_FORMAT, S.ACTIVITY_LEVELS),
        rule("source_of_funds_declared", too_long("source_of_funds_declared", 255)),
        rule("source_of_wealth_declared", too_long("source_of_wealth_declared", 255)),
        rule(
            "client_type",
            (is_private & _raw("first_name").isNull(), "missing first_name for PRIVATE"),
            (is_private & _raw("last_name").isNull(), "missing last_name for PRIVATE"),
            (is_private & _parsed("date_of_birth").isNull(), "invalid date_of_birth for PRIVATE"),
            (is_business & _raw("company_name").isNull(), "missing company_name for BUSINESS"),
            (is_business & _raw("registration_no").isNull(), "missing registration_no for BUSINESS"),
        ),
    ]


# --- Normalise and parse -----------------------------------------------------


def _normalised(field: Field) -> Column:
    return (norm_code if field.kind == "code" else norm_text)(field.raw)


def _parse(field: Field) -> Column | None:
    if field.kind == "number":
        return parse_number(field.raw)
    if field.kind == "date":
        return to_date_lenient(field.raw)
    if field.kind == "timestamp":
        return to_ts_lenient(field.raw)
    return None


def normalise(raw: DataFrame, dataset: Dataset) -> DataFrame:
    """Trim every raw field and upper-case the coded ones."""
    return raw.withColumns({f.raw: _normalised(f) for f in dataset.fields})


def parse(normalised: DataFrame, dataset: Dataset) -> DataFrame:
    """Add ``<field>_parsed`` for every number, date and timestamp; bad text is NULL."""
    return normalised.withColumns(
        {f.parsed: p for f in dataset.fields if (p := _parse(f)) is not None}
    )
