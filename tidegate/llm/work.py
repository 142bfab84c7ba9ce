"""Intermediate tables in the shared work folder, and row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.sources.files import work_folder


def stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared work folder and read it back; cuts the lineage."""
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*columns: Column) -> Column:
    """A 64-bit key of some columns in which null differs from every value."""
    return F.xxhash64(*[x for c in columns for x in (c.isNull(), c)])


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
