"""Two tables met group by group in cells of bounded size, and vectors as numpy arrays.

A group's rows are cut by a hash of their ids into parts of about ``size`` rows on either side; each pair of
parts is a cell, and a cell is one group of a cogrouped map. So no task holds more than two parts,
however large a group grows, and nothing is emitted for a pair of rows that the map does not keep.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.work import stored


def parts(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def met(
    spark: SparkSession,
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    ids: tuple[str, str],
    sizes: tuple[int, int],
    run,
    schema: str,
) -> DataFrame:
    """``run(left part, right part)``, two Arrow tables, for every cell of the groups that both sides have.

    Without ``keys`` each side is one group.
    """
    if keys:
        count = lambda df, size, name: df.groupBy(*keys).agg(F.ceil(F.count("*") / size).alias(name))
        both = stored(spark, count(left, sizes[0], "_n").join(count(right, sizes[1], "_m"), keys), "cells")
        left, right = left.join(both, keys), right.join(both, keys)
    else:
        n, m = F.lit(parts(left.count(), sizes[0])), F.lit(parts(right.count(), sizes[1]))
        left, right = (df.withColumns({"_n": n, "_m": m}) for df in (left, right))

    def own(name: str, of: str) -> Column:
        return F.pmod(F.xxhash64(name, F.lit("cell")), F.col(of)).cast("int")

    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of).cast("int") - 1))
    left = left.withColumn("_i", own(ids[0], "_n")).withColumn("_j", every("_m"))
    right = right.withColumn("_j", own(ids[1], "_m")).withColumn("_i", every("_n"))
    # As many partitions as asked for: a cell is little data but much work, so few bytes must not merge them.
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cell = [*keys, "_i", "_j"]
    dealt = [df.drop("_n", "_m").repartition(many, *cell).groupBy(*cell) for df in (left, right)]
    return dealt[0].cogroup(dealt[1]).applyInArrow(run, schema)


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))
    )


def clean(rows: DataFrame, id: str, vector: str, *more: str) -> DataFrame:
    """One row per id, ``id`` as long: those with an id, finite vectors and nothing missing in ``more``.

    Of rows with one id the least by ``more`` and the vector stays.
    """
    there = finite(F.col(vector)) & F.col(id).isNotNull()
    for c in more:
        there &= F.col(c).isNotNull()
    least = F.min(F.struct(*more, vector)).alias("_least")
    return (
        rows.where(there)
        .select(F.col(id).cast("long").alias(id), *more, F.col(vector).cast("array<double>").alias(vector))
        .groupBy(id)
        .agg(least)
        .select(id, "_least.*")
    )


def matrix(column: pa.Array | pa.ChunkedArray, width: int, kind=np.float64) -> np.ndarray:
    """A list column as rows of ``width`` numbers; shorter lists are filled up with 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    if (lengths == width).all():
        return values.reshape(len(lengths), width).astype(kind, copy=False)
    out = np.zeros((len(lengths), width), kind)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def lists(rows: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as a list column."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] if rows.ndim == 2 else 0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()
