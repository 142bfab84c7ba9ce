"""Parquet tables partitioned by business date, replaced one or many dates at a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.sources import files, versions
from tidegate.sources.local import local_rows


def overwrite_date(
    df: DataFrame,
    table: str,
    empty_dates: Iterable[dt.date] = (),
    rebalance: bool = False,
    within: Iterable[str] = (),
) -> None:
    """Replace the business dates that ``df`` holds; other dates stay.

    With ``within`` the table is also partitioned by these columns, and only their values
    that ``df`` holds are replaced, so writers of different values do not meet.

    A date without rows in ``df`` would keep its old rows, so dates known to have
    become empty are passed in ``empty_dates`` and replaced by an empty partition.

    ``rebalance`` gathers the dates before writing. It is for many dates after a
    shuffle on other keys, where every task would otherwise write a small file per
    date; a large date is still split over many tasks.
    """
    rows = df.hint("rebalance", "business_date") if rebalance else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("business_date", *within)
        .parquet(table)
    )
    clear_dates(df.sparkSession, table, df.schema, empty_dates)


def clear_dates(
    spark: SparkSession, table: str, schema: T.StructType, dates: Iterable[dt.date]
) -> None:
    """Leave the given dates without rows."""
    fields = [f for f in schema.fields if f.name != "business_date"]
    for date in dates:
        partition = f"{table}/business_date={date:%Y-%m-%d}"
        if files.exists(spark, partition):
            nothing = local_rows(spark, [], T.StructType(fields))
            nothing.write.mode("overwrite").parquet(partition)


def read_table(
    spark: SparkSession, table: str, schema: T.StructType, dates: Sequence[dt.date] | None = None
) -> DataFrame:
    """The table's rows, of some dates or of all, or no rows if it was never written.

    Of a table that is published in versions those that hold.
    """
    if versions.is_published(spark, table):
        return versions.read_published(spark, table, schema, dates)
    if not files.exists(spark, table):
        return local_rows(spark, [], schema)
    rows = spark.read.schema(schema).parquet(table).select(*schema.fieldNames())
    return rows if dates is None else rows.filter(F.col("business_date").isin(list(dates)))
