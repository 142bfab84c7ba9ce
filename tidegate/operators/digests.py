"""Comparing two versions of a dated table by digests, and row by row only where they differ.

A digest is the number of rows of a date and key bucket with an order-free sum of their hashes. Digests are as small
as the buckets are many, can be stored next to a version when it is written, and tell where two versions
differ without reading either again. Only those dates and buckets are then compared row by row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits of a row's values, in which null differs from every value."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def digests(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, by: str = "business_date") -> DataFrame:
    """(date, bucket, row_count, low, high) of a table; one pass, a row per date, bucket and task moves.

    The two halves of the hashes are summed apart, so that the sums do not overflow below 2**31 rows a bucket.
    """
    h = row_hash(sorted(df.columns))
    return (
        df.select(by, bucket(keys, buckets).alias("bucket"), h.alias("_h"))
        .groupBy(by, "bucket")
        .agg(
            F.count("*").alias("row_count"),
            F.sum(F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
            F.sum(F.shiftright("_h", 32)).alias("high"),
        )
    )


def differing(left: DataFrame, right: DataFrame, by: str = "business_date") -> DataFrame:
    """(date, bucket) whose digests differ, or that only one side has."""
    sums = ["row_count", "low", "high"]
    one = left.select(by, "bucket", F.struct(*sums).alias("one"))
    two = right.select(by, "bucket", F.struct(*sums).alias("two"))
    return one.join(two, [by, "bucket"], "full_outer").where(~F.col("one").eqNullSafe(F.col("two"))).select(by, "bucket")


def changed_rows(
    read_left: Callable[[list[dt.date]], DataFrame],
    read_right: Callable[[list[dt.date]], DataFrame],
    where: DataFrame,
    keys: Sequence[str],
    buckets: int = BUCKETS,
    by: str = "business_date",
) -> DataFrame:
    """The keys, ``change`` (ADDED, REMOVED, CHANGED) and ``changed_columns`` of rows that differ.

    ``where`` is what ``differing`` gives; the readers get its dates, a few values, and open nothing else. Keys are
    unique within a date, and neither they nor the date are null.
    """
    dates = sorted(r[0] for r in where.select(by).distinct().collect())
    left, right = read_left(dates), read_right(dates)
    values = [c for c in left.columns if c not in keys and c != by]
    on = [by, *[k for k in keys if k != by]]

    def side(df: DataFrame, name: str) -> DataFrame:
        here = df.withColumn("bucket", bucket(keys, buckets)).join(where, [by, "bucket"], "left_semi")
        return here.select(*on, F.struct(*[F.col(c) for c in values]).alias(name))

    both = side(left, "old").join(side(right, "new"), on, "full_outer")
    change = (
        F.when(F.col("old").isNull(), "ADDED").when(F.col("new").isNull(), "REMOVED").otherwise("CHANGED")
    )
    names = [F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), F.lit(c)) for c in values]
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(
        *on, change.alias("change"), F.when(change == "CHANGED", F.concat_ws(",", *names)).alias("changed_columns")
    )
