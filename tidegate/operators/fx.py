"""Exchange rates and conversion to EUR."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.functions import ratio_half_up
from tidegate.operators.aggregates import ordered_list, required_currencies
from tidegate.operators.joins import join_fx, join_fx_base, orphans


def _whole(c: Column, precision: int, scale: int) -> Column:
    """A decimal as a whole number of its last places."""
    factor = F.lit(10**scale).cast(f"decimal({scale + 1},0)")
    return (c.cast(f"decimal({precision},{scale})") * factor).cast(f"decimal({precision},0)")


def cross_rates(fx: DataFrame, base: str = S.BASE_CURRENCY) -> DataFrame:
    """Each date's rates next to that date's base rate, with the rounded cross rate.

    ``rate_up / rate_down`` is the unrounded rate as a ratio of whole numbers;
    with the base currency both sides are equal.
    """
    both = join_fx_base(
        fx.select(
            "business_date",
            "currency_code",
            F.col("unit_count").alias("src_unit_count"),
            F.col("mid_rate_pln").alias("src_mid_rate_pln"),
            F.col("rate_source").alias("fx_rate_source"),
            F.col("published_date").alias("fx_published_date"),
        ),
        fx,
        base,
    )
    return both.select(
        "business_date",
        "currency_code",
        rate_up().alias("rate_up"),
        rate_down().alias("rate_down"),
        fx_rate_to_eur(base).alias("fx_rate_to_eur"),
        "fx_rate_source",
        "fx_published_date",
    )


def rate_up() -> Column:
    """Numerator of src rate / base rate, from the ``src_*`` and ``base_*`` columns."""
    return _whole(F.col("src_mid_rate_pln"), 18, 8) * F.col("base_unit_count").cast(
        "decimal(6,0)"
    )


def rate_down() -> Column:
    return _whole(F.col("base_mid_rate_pln"), 18, 8) * F.col("src_unit_count").cast(
        "decimal(6,0)"
    )


def fx_rate_to_eur(base: str = S.BASE_CURRENCY) -> Column:
    scale = F.lit(10**8).cast("decimal(9,0)")
    return (
        F.when(F.col("currency_code") == base, F.lit(1))
        .otherwise(ratio_half_up(rate_up() * scale, rate_down(), 8))
        .try_cast("decimal(18,8)")
    )


def amount_eur(base: str = S.BASE_CURRENCY) -> Column:
    """The amount at the unrounded rate, rounded half-up to cents, exactly; NULL if it does not fit."""
    cents = _whole(F.col("amount"), 14, 2)
    return (
        F.when(F.col("currency_code") == base, F.col("amount").cast("decimal(18,2)"))
        .otherwise(ratio_half_up(F.try_multiply(cents, F.col("rate_up")), F.col("rate_down"), 2))
        .try_cast("decimal(18,2)")
    )


def to_eur(df: DataFrame, fx: DataFrame, base: str = S.BASE_CURRENCY) -> DataFrame:
    """Add ``fx_rate_to_eur``, ``amount_eur`` and the rate's origin.

    A row without a rate of its date for its own or the base currency drops out,
    so check ``fx_coverage`` first. The two rate lookups are folded into one join
    on the small side, a row per date and currency. It is broadcast: Spark guesses the size of
    that join as a product, and would move all rows once more.
    """
    rated = df.join(F.broadcast(cross_rates(fx, base)), ["business_date", "currency_code"])
    return rated.withColumn("amount_eur", amount_eur(base)).drop("rate_up", "rate_down")


def missing_rates(transfers: DataFrame, fx: DataFrame) -> DataFrame:
    """(business_date, currency_code) needed but not quoted."""
    return orphans(
        required_currencies(transfers), fx, ["business_date", "currency_code"]
    )


def fx_coverage(transfers: DataFrame, fx: DataFrame) -> DataFrame:
    """Per date with transfers: the sorted missing currencies, NULL when complete."""
    dates = transfers.select("business_date").distinct()
    lists = ordered_list(missing_rates(transfers, fx), ["business_date"], "currency_code")
    return dates.join(
        lists.withColumnRenamed("currency_code_list", "missing_currencies"),
        "business_date",
        "left",
    )


__all__ = [
    "amount_eur",
    "cross_rates",
    "fx_coverage",
    "fx_rate_to_eur",
    "join_fx",
    "join_fx_base",
    "missing_rates",
    "rate_down",
    "rate_up",
    "to_eur",
]
