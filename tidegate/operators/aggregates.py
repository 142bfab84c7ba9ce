"""Counts, lists, sets and ordering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schemas as S


def key_multiplicity(df: DataFrame, keys: Sequence[str], name: str = "key_count") -> DataFrame:
    """Every row with the number of rows that share its keys.

    Count-then-join instead of a window: the count collapses repeats before the
    shuffle, and a skewed key is split on the way back, where a window would put
    all rows of the key into one task.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    null_safe = reduce(
        lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    )
    return (
        df.alias("r").join(counts.alias("c"), null_safe).select("r.*", F.col(f"c.{name}"))
    )


def count_by(df: DataFrame, cols: Sequence[str], name: str = "row_count") -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias(name))


def gate_counts(dfs: dict[str, DataFrame], by: str = "business_date") -> DataFrame:
    """Row counts of several tables per date, one column per table, 0 if absent.

    Each table is reduced to one row per date before the results meet.
    """
    names = list(dfs)
    parts = [
        df.groupBy(by).agg(F.count("*").alias("n")).select(by, F.lit(name).alias("t"), "n")
        for name, df in dfs.items()
    ]
    return (
        union_all(parts)
        .groupBy(by)
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.col("t") == name, F.col("n"))), F.lit(0)).alias(name)
                for name in names
            ]
        )
    )


def ordered_list(df: DataFrame, by: Sequence[str], c: str, sep: str = ", ") -> DataFrame:
    """Distinct values of a code column as one sorted text per group.

    Meant for code columns, whose domain bounds the list; repeats are removed on
    the map side, so the group never holds more than the domain.
    """
    listed = F.array_join(F.array_sort(F.collect_set(c)), sep)
    return df.groupBy(*by).agg(F.nullif(listed, F.lit("")).alias(f"{c}_list"))


def coverage(df: DataFrame, by: Sequence[str], c: str) -> DataFrame:
    """Distinct values of ``c`` per group, with rows that have and lack one."""
    return df.groupBy(*by).agg(
        F.countDistinct(c).alias("distinct_values"),
        F.coalesce(F.sum(F.when(F.col(c).isNotNull(), 1)), F.lit(0)).alias("rows_with_value"),
        F.coalesce(F.sum(F.when(F.col(c).isNull(), 1)), F.lit(0)).alias("rows_without_value"),
    )


def required_currencies(transfers: DataFrame, base: str = S.BASE_CURRENCY) -> DataFrame:
    """(business_date, currency_code) that need a rate.

    The base currency is needed as soon as any other one occurs on the date.
    """
    used = transfers.select("business_date", "currency_code").distinct()
    pivot = (
        used.filter(F.col("currency_code") != base)
        .select("business_date", F.lit(base).alias("currency_code"))
        .distinct()
    )
    return used.union(pivot).distinct()


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def ordered(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """Total order, as a range-partitioned sort."""
    return df.orderBy(*cols)


def custom_order(c: str, values: Sequence[str]) -> Column:
    """Sort key that puts ``values`` first, in the given order."""
    key = F.lit(len(values))
    for position, value in reversed(list(enumerate(values))):
        key = F.when(F.col(c) == value, position).otherwise(key)
    return key
