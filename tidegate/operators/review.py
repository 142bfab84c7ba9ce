"""Transfer review flags, reasons and report type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.functions import fmt_amount, nvl


def _is_pep() -> Column:
    return F.col("pep_flag") == 1


def _is_high_risk_kyc() -> Column:
    return (F.col("high_risk_flag") == 1) & nvl("kyc_status", "<<NULL>>").isin(
        *S.KYC_NEEDS_REVIEW
    )


def _has_high_score() -> Column:
    return nvl("risk_score", -1) >= S.RISK_SCORE_LIMIT


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def classify(df: DataFrame) -> DataFrame:
    """Add the threshold, suspicion and review flags, the reason and report type."""
    above = F.col("above_threshold_art72_flag") == 1
    suspicious = F.col("suspicion_art74_flag") == 1
    flagged = df.withColumns(
        {
            "above_threshold_art72_flag": _flag(F.col("amount_eur") > S.THRESHOLD_EUR),
            "suspicion_art74_flag": _flag(_is_pep() | _is_high_risk_kyc() | _has_high_score()),
        }
    )
    details = F.concat_ws(
        "; ",
        F.when(
            above,
            F.concat(
                F.lit("amount_eur="), fmt_amount("amount_eur"), F.lit(f" > {S.THRESHOLD_EUR}")
            ),
        ),
        F.when(_is_pep(), "pep_flag=1"),
        F.when(
            _is_high_risk_kyc(), F.concat(F.lit("high_risk_flag=1; kyc_status="), "kyc_status")
        ),
        F.when(
            _has_high_score(),
            F.concat(
                F.lit("risk_score="),
                F.col("risk_score").cast("string"),
                F.lit(f" >= {S.RISK_SCORE_LIMIT}"),
            ),
        ),
    )
    return flagged.withColumns(
        {
            "aml_review_flag": _flag(above | suspicious),
            "aml_reason_code": F.when(above & suspicious, "ART72_AND_ART74")
            .when(above, "ART72_THRESHOLD")
            .when(_is_pep(), "ART74_PEP")
            .when(_is_high_risk_kyc(), "ART74_HIGH_RISK_KYC")
            .when(_has_high_score(), "ART74_RISK_SCORE"),
            "aml_reason_details": F.nullif(details, F.lit("")),
            "report_type_candidate": F.when(above & suspicious, "ART72_AND_ART74")
            .when(above, "ART72_THRESHOLD")
            .when(suspicious, "ART74_SUSPICION"),
        }
    )
