"""Join operators.

Broadcast by hint are code dictionaries, as after filtering to the code format there
can be at most 676 country and 17,576 currency codes, whatever the input; the rates that
amounts are converted at, a row per date and currency; and the offsets of input splits. Client snapshots grow with the input and are wide, and before anything has run
Spark only guesses their size: a table that compresses well, or is unfolded by date,
looks small enough to be sent through the driver. So transfers meet them in a merge
join, whatever the guess. All other joins leave the choice to Spark. Skewed partitions
are split at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.functions import matches


def flag_exists(df: DataFrame, ref: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Add ``name`` = 1 where ``ref`` has a row with the same keys, else 0."""
    keys = ref.select(*on).distinct().withColumn(name, F.lit(1))
    return df.join(keys, list(on), "left").withColumn(name, F.coalesce(name, F.lit(0)))


def flag_supported(
    df: DataFrame, ref: DataFrame, code: str, code_format: str, name: str
) -> DataFrame:
    """Add ``name`` = 1 where ``<code>_raw`` is an active code of the dictionary."""
    raw = f"{code}_raw"
    active = (
        ref.filter("is_active_flag = 1")
        .select(F.trim(code).alias(raw))
        .filter(matches(raw, code_format))
        .distinct()
        .withColumn(name, F.lit(1))
    )
    return df.join(F.broadcast(active), raw, "left").withColumn(
        name, F.coalesce(name, F.lit(0))
    )


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows without a parent row."""
    return child.join(parent.select(*on), list(on), "left_anti")


def orphan_counts(
    child: DataFrame, parent: DataFrame, on: Sequence[str], name: str = "row_count"
) -> DataFrame:
    """Keys of child rows without a parent row, with the number of such child rows.

    Child rows are counted per key before the join, so a key with very many rows weighs
    no more than any other. Written as an outer join because Spark would move an
    anti-join below the count. Keys of stored parents shorten so well that Spark takes
    them for small; like the clients of ``join_same_day_client`` they are merged.
    """
    counts = child.groupBy(*on).agg(F.count("*").alias(name))
    found = parent.select(*on, F.lit(1).alias("has_parent")).hint("merge")
    return counts.join(found, list(on), "left").filter("has_parent IS NULL").drop("has_parent")


def join_same_day_client(transfers: DataFrame, clients: DataFrame) -> DataFrame:
    """Transfers with the client snapshot of the same business date.

    The transfer's own country becomes ``transfer_country_code``.
    """
    return transfers.withColumnRenamed("country_code", "transfer_country_code").join(
        clients.select(
            "business_date",
            "client_id",
            "client_type",
            "full_name",
            "country_code",
            "pep_flag",
            "high_risk_flag",
            "kyc_status",
            "risk_score",
            "relationship_purpose_code",
            "expected_activity_level",
            "source_of_funds_declared",
            "source_of_wealth_declared",
        ).hint("merge"),
        ["business_date", "client_id"],
    )


def join_fx(df: DataFrame, fx: DataFrame, currency_col: str = "currency_code") -> DataFrame:
    """Add the day's rate of each row's own currency as ``src_*``."""
    rates = fx.select(
        "business_date",
        F.col("currency_code").alias(currency_col),
        F.col("unit_count").alias("src_unit_count"),
        F.col("mid_rate_pln").alias("src_mid_rate_pln"),
        F.col("rate_source").alias("fx_rate_source"),
        F.col("published_date").alias("fx_published_date"),
    )
    return df.join(rates, ["business_date", currency_col])


def join_fx_base(df: DataFrame, fx: DataFrame, base: str = S.BASE_CURRENCY) -> DataFrame:
    """Add the day's rate of the base currency as ``base_*``."""
    rates = fx.filter(F.col("currency_code") == base).select(
        "business_date",
        F.col("unit_count").alias("base_unit_count"),
        F.col("mid_rate_pln").alias("base_mid_rate_pln"),
    )
    return df.join(rates, "business_date")


def enrich_report(mart: DataFrame, clients: DataFrame) -> DataFrame:
    """Mart rows with identity and address from the client snapshot.

    Type, name and country are the client's; risk fields stay the mart's.
    """
    return mart.drop("client_type", "full_name", "country_code").join(
        clients.select("business_date", "client_id", *S.SPOOL_CLIENT_COLUMNS).hint("merge"),
        ["business_date", "client_id"],
    )


def layer_counts(
    expected: DataFrame, control: DataFrame, counts: dict[str, DataFrame]
) -> DataFrame:
    """Expected runs with their control row and the row counts of each layer.

    ``counts`` maps a column name to (process_name, business_date, row_count);
    a layer without rows for a run counts 0. The count tables hold one row per
    process and date.
    """
    keys = ["process_name", "business_date"]
    result = expected.join(control, [*keys, "run_mode"], "left")
    for name, table in counts.items():
        layer = table.select(*keys, F.col("row_count").alias(name))
        result = result.join(layer, keys, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return result
