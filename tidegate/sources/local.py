"""Small driver-side rows as DataFrames.

Rows go through Arrow, which gives Spark a relation of known size; from plain Python
rows it would assume an unknown, huge one and never broadcast it up front.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.DecimalType):
        return pa.decimal128(kind.precision, kind.scale)
    return {
        "date": pa.date32(),
        "integer": pa.int32(),
        "long": pa.int64(),
        "string": pa.string(),
        "timestamp_ntz": pa.timestamp("us"),
    }[kind.typeName()]


def local_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(schema)
    arrays = [pa.array(list(c), _arrow_type(f.dataType)) for c, f in zip(columns, schema)]
    return spark.createDataFrame(pa.table(arrays, names=schema.fieldNames()), schema)
