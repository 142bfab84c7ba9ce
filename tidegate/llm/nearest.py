"""Approximate nearest neighbours by multiprobe p-stable hashing, with exact reranking.

Largest inner products are made nearest points first: rows are divided by the longest one's length and
get one more component that brings them onto the unit sphere; queries are scaled onto it. That does
not change the order of a query's scores.

A table has ``functions`` p-stable hashes, floor((a x + b) / w) with normal a and uniform b; together they name a
bucket. A neighbour at distance r lies in a slot of a function with a probability that is
known from the query's place in its own slot, as a (x - q) is normal with deviation r. A query visits
the buckets of a table in descending order of the product of these probabilities, the perturbed ones after
its own, until their sum is such that all tables together find a neighbour at distance r with probability
``recall``. The rows of all visited buckets are scored exactly, in double precision, on the given vectors, and
the tables' best are merged. A query that finds fewer than ``k`` rows this way is answered from all rows.

r is fitted on ``sample`` rows, the first by a hash of the id: the 0.9 quantile, over ``probed`` of them, of
the distance to the row that stands as far up there as the last wanted one in the whole table. Slots are two such
distances wide, and the number of functions grows with the logarithm of the rows, so that a
bucket keeps about ``bucket`` rows. All rows are indexed and all queries answered.

Rows with one vector are one entry with their smallest ids, as many as can be wanted, so a vector with a third of
all rows is scored once. Buckets and their queries meet in cells of bounded size (``cells``), however full
a bucket is; a cell gives the best few of each query only.

Defined results: rows without id or vector, with a null or non-finite component or with zeros only, take no
part. Rows of one id are one row, the least by vector. Shorter vectors are filled up with zeros. Equal
scores go by the smaller id. Other columns are ignored. No queries or no rows, no result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import erf, exp, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm import cells
from tidegate.llm.work import stored

#: Slots on either side of a query's own that are considered; further ones are beyond four deviations.
_AROUND = 2
_QUERIES, _ROWS = 2048, 8192


@dataclass(frozen=True)
class Index:
    """All that a task needs to hash: few numbers, whatever the size of the table."""

    width: int
    longest: float
    distance: float
    functions: int
    tables: int
    recall: float
    slots: float = 2.0
    seed: int = 13

    def table(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        draw = np.random.default_rng([self.seed, t])
        return draw.standard_normal((self.width + 1, self.functions)), draw.uniform(0, 1, self.functions)

    def places(self, points: np.ndarray, t: int) -> np.ndarray:
        """Where points stand, in slots."""
        a, b = self.table(t)
        return points @ a / (self.slots * self.distance) + b

    def points(self, rows: np.ndarray) -> np.ndarray:
        scaled = rows / self.longest
        rest = np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(axis=1)))
        return np.column_stack([scaled, rest])

    def asked(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack([rows / np.sqrt((rows * rows).sum(axis=1))[:, None], np.zeros(len(rows))])

    def probes(self, place: np.ndarray) -> list[np.ndarray]:
        """The buckets to visit from one place, likeliest first."""
        wanted = 1 - (1 - self.recall) ** (1 / self.tables)
        own, around = np.floor(place), np.arange(-_AROUND, _AROUND + 2)
        edges = (own[:, None] + around - place[:, None]) * self.slots / sqrt(2)
        chance = np.maximum(np.diff(0.5 * (1 + _erf(edges)), axis=1), 1e-12)
        order = np.argsort(-chance, axis=1, kind="stable")
        cost = -np.log(np.take_along_axis(chance, order, axis=1))
        slot = own[:, None] + around[order]
        first = np.zeros(self.functions, int)
        heap, found, total = [(float(cost[:, 0].sum()), tuple(first), 0)], [], 0.0
        every = np.arange(self.functions)
        while heap and total < wanted:
            c, at, last = heapq.heappop(heap)
            found.append(slot[every, list(at)].astype(np.int64))
            total += exp(-c)
            # Each set of perturbations is reached from one other only: by moving on the last function or a later one.
            for f in range(last, self.functions):
                if at[f] + 1 < len(around) - 1:
                    heapq.heappush(heap, (c + cost[f, at[f] + 1] - cost[f, at[f]], (*at[:f], at[f] + 1, *at[f + 1 :]), f))
        return found


_erf = np.vectorize(erf, otypes=[float])


def _bucket(slots: np.ndarray, t: int) -> np.ndarray:
    """One number per row of slots; two buckets that share it only cost a few more scores."""
    h = np.full(len(slots), t + 1, np.uint64)
    for column in slots.T:
        h = (h ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _hash_rows(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = index.points(cells.matrix(batch.column("vector"), index.width))
            codes = [_bucket(np.floor(index.places(points, t)).astype(np.int64), t) for t in range(index.tables)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("ids"), batch.column("vector"), cells.lists(np.stack(codes, axis=1))],
                ["id", "ids", "vector", "buckets"],
            )

    return run


def _hash_queries(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = index.asked(cells.matrix(batch.column("vector"), index.width))
            visited = [[] for _ in range(len(points))]
            for t in range(index.tables):
                for q, place in enumerate(index.places(points, t)):
                    visited[q].append(_bucket(np.stack(index.probes(place)), t))
            buckets = [np.unique(np.concatenate(v)) for v in visited]
            ends = np.concatenate([[0], np.cumsum([len(b) for b in buckets])]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(buckets)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), listed], ["id", "vector", "buckets"]
            )

    return run


def _score(width: int, most: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if queries.num_rows and rows.num_rows:
            order = np.argsort(cells.numbers(rows, "id"), kind="stable")
            ids, points = cells.numbers(rows, "id")[order], cells.matrix(rows.column("vector"), width)[order]
            asked = cells.matrix(queries.column("vector"), width)
            step = max(1, (1 << 21) // max(1, len(ids)))
            for a in range(0, len(asked), step):
                near = asked[a : a + step] @ points.T
                for q, scores in enumerate(near, a):
                    bar = np.partition(scores, len(scores) - most)[len(scores) - most] if len(scores) > most else -np.inf
                    slack = 1e-12 * float(np.abs(scores).max())
                    at = np.flatnonzero(scores >= bar - slack)
                    # Summed row by row in one order, so that equal vectors have equal scores in every cell.
                    exact = (points[at] * asked[q]).sum(axis=1)
                    best = np.argsort(-exact, kind="stable")[:most]
                    out.append((np.full(len(best), cells.numbers(queries, "id")[q]), ids[at[best]], exact[best]))
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        whole = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[]] * 3
        return pa.table([pa.array(x, k) for x, k in zip(whole, kinds, strict=True)], ["query_id", "id", "score"])

    return run


def fit(rows: DataFrame, k: int, sample: int, probed: int, bucket: int, tables: int, recall: float) -> Index | None:
    """The index for a table (id, vector); None if it is empty."""
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    n, width, longest = rows.agg(F.count("*"), F.max(F.size("vector")), F.max(length)).first()
    if not n:
        return None
    first = rows.orderBy(F.xxhash64("id", F.lit("sample")), "id").limit(sample).select("vector").toArrow()
    some = cells.matrix(first.column("vector"), width)
    index = Index(width, longest, 1.0, 1, tables, recall)
    near = index.asked(some[:probed]) @ index.points(some).T
    near[np.arange(len(near)), np.arange(len(near))] = -np.inf  # not itself
    place = min(max(1, -(-k * len(some) // n)), max(1, len(some) - 1))
    last = -np.sort(-near, axis=1)[:, place - 1]
    last = last[np.isfinite(last)]
    distance = float(np.quantile(np.sqrt(np.maximum(0.0, 2 - 2 * last)), 0.9)) if len(last) else 1.0
    # With slots two distances wide a function tells about 2.45 kinds of rows apart.
    functions = max(4, round(log(max(1.0, n / bucket)) / log(2.45)))
    return Index(width, longest, max(distance, 1e-6), functions, tables, recall)


def nearest(
    spark: SparkSession,
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    recall: float = 0.95,
    tables: int = 4,
    bucket: int = 2048,
    sample: int = 4096,
    probed: int = 256,
) -> DataFrame:
    """query_id, rank, id (named as given), score: the ``k`` nearest found of each query.

    ``is_query`` is a condition on the id.
    """
    some = F.exists(vector, lambda x: x != 0)
    unique = stored(spark, cells.clean(rows.where(some), id, vector).withColumnRenamed(vector, "vector"), "vectors")
    index = fit(unique.withColumnRenamed(id, "id"), k, sample, probed, bucket, tables, recall)
    empty = spark.createDataFrame([], f"query_id long, rank int, {id} long, score double")
    if index is None:
        return empty
    # One entry per vector, with as many ids as can be wanted and the query's own.
    of_vector = Window.partitionBy("vector").orderBy(id)
    entries = (
        unique.withColumn("rank", F.row_number().over(of_vector))
        .where(F.col("rank") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list(id)).alias("ids"))
        .select(F.col("ids")[0].alias("id"), "ids", "vector")
    )
    hashed = "id long, ids array<long>, vector array<double>, buckets array<long>"
    entries = stored(spark, entries.mapInArrow(_hash_rows(index), hashed), "index")
    asked = unique.where(is_query).select(F.col(id).alias("id"), "vector")
    queries = stored(
        spark, asked.mapInArrow(_hash_queries(index), "id long, vector array<double>, buckets array<long>"), "probes"
    )
    each = [
        df.select("id", "vector", F.explode("buckets").alias("bucket")) for df in (queries, entries.select("id", "vector", "buckets"))
    ]
    shape = "query_id long, id long, score double"
    found = cells.met(
        spark, *each, ["bucket"], ("id", "id"), (_QUERIES, _ROWS), _score(index.width, k + 1), shape
    )
    best = stored(spark, _best(found, entries, k, id), "nearest")
    # A query that its buckets do not give enough rows is answered from all of them.
    full = best.where(F.col("rank") == F.lit(min(k, unique.count() - 1))).select(F.col("query_id").alias("id"))
    short = stored(spark, queries.join(full, "id", "left_anti").select("id", "vector"), "short")
    if short.isEmpty():
        return best
    entry = entries.select("id", "vector")
    found = cells.met(spark, short, entry, [], ("id", "id"), (_QUERIES, _ROWS), _score(index.width, k + 1), shape)
    kept = best.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").select(best.columns)
    return kept.unionByName(_best(found, entries, k, id))


def _best(found: DataFrame, entries: DataFrame, k: int, id: str) -> DataFrame:
    """The best rows of each query, from its best entries."""
    # Tables find the same entries; of each query the best are kept before their ids are looked up.
    merged = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    merged = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1).drop("rank")
    listed = merged.join(entries.select("id", "ids"), "id").select("query_id", "score", F.explode("ids").alias(id))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), id)
    return (
        listed.where(F.col(id) != F.col("query_id"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", id, "score")
    )
