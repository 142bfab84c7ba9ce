"""Registered queries: name -> (Spark query, SQL for the same rows or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = lambda spark, sf_dir: shown(fn(prepare(spark), sf_dir))
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def shown(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, decimals as doubles, so that both engines print alike."""

    def show(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        return c.alias(field.name)

    return df.select(*[show(f) for f in df.schema.fields])
