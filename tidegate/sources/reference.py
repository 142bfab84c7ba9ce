"""Reference data: code dictionaries and daily exchange rates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators.checks import check_expr, check_unique
from tidegate.sources.local import local_rows
from tidegate.sources.tables import overwrite_date


def _dictionary(spark: SparkSession, codes: dict[str, str], prefix: str) -> DataFrame:
    return local_rows(
        spark,
        [(code, name, 1) for code, name in codes.items()],
        f"{prefix}_code string, {prefix}_name string, is_active_flag int",
    )


def ref_currency(spark: SparkSession) -> DataFrame:
    return _dictionary(spark, S.CURRENCIES, "currency")


def ref_country(spark: SparkSession) -> DataFrame:
    return _dictionary(spark, S.COUNTRIES, "country")


def fx_rates(
    spark: SparkSession,
    rates: Sequence[tuple[dt.date, str, int, Decimal]],
    rate_source: str = S.RATE_SOURCE,
) -> DataFrame:
    """Daily rates from (date, currency, units, mid rate in PLN), published that day."""
    rows = [(d, code, units, mid, rate_source, d) for d, code, units, mid in rates]
    return local_rows(spark, rows, S.FX_SCHEMA)


def load_fx_rates(rates: DataFrame, table: str) -> None:
    """Replace the rates of every date that ``rates`` holds.

    Stops without writing when a key repeats or a constraint fails.
    """
    rates = rates.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.FX_SCHEMA])
    if check_unique(rates, ["business_date", "currency_code"]).head(1):
        raise ValueError("exchange rates repeat a (business_date, currency_code)")
    broken = check_expr(rates, S.FX_CHECKS).filter("violations > 0").head()
    if broken:
        raise ValueError(f"exchange rates violate {broken.check_name}")
    overwrite_date(rates, table)
