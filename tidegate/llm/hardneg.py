"""Hard negatives: for each anchor and positive the closest rows of other labels below a share of the positive's score.

Components are scaled and floored to whole numbers; a score is the whole-number inner product. Positives of an
anchor are its best rows of the same label; negatives are the best rows of other labels whose
score lies between two shares of the positive's.

Every pair of an anchor and a row is judged by codes first. A vector is rotated (three rounds of random signs and a
Walsh-Hadamard transform) and coded with one bit per component, the sign; its alignment with the
code vector, the mean of its components' absolute values, is stored, and what the code leaves over is
coded again, ``codes`` times. The anchor is cut into ``planes`` bits per component, so that its inner product
with a code is a weighted sum of popcounts. With v the coded part of a row, r the rest, q the anchor's cut
vector and e the rest of that, the score differs from <q, v> by at most |e| |v| + |anchor| |r| (Cauchy-Schwarz): a
certain interval, no estimate. Rows whose interval cannot reach a place among the best are dropped; the
others are scored in whole numbers. So the result is exact.

Anchors meet rows in cells of bounded size (``cells``): positives label by label, negatives over all
rows. A cell gives at most the wanted number of rows per anchor and positive, and a ranked merge keeps
the best, so no pairs are emitted beyond those.

Defined results: rows without id, label or vector, or with a null or non-finite component, take no part;
nor do rows whose scaled vector has a squared length of 2**62 or more, whose scores would not fit.
Rows of one id are one row, the least by label and vector. Shorter vectors are filled up with zeros. Equal
scores go by the smaller id. A label of one row has no positives, and an anchor without any has no rows
in the result. Other columns are ignored. No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm import cells
from tidegate.llm.work import stored

_ANCHORS, _ROWS = 1024, 8192


class Rotation:
    """The same rotation in every task: signs and Walsh-Hadamard transforms on a power of two of components."""

    def __init__(self, width: int, seed: int):
        self.width = max(64, 1 << (max(1, width) - 1).bit_length())
        self.signs = np.random.default_rng(seed).integers(0, 2, (3, self.width)) * 2.0 - 1

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        y = np.zeros((len(rows), self.width))
        y[:, : rows.shape[1]] = rows
        for signs in self.signs:
            y *= signs
            h = 1
            while h < self.width:
                part = y.reshape(len(y), -1, 2, h)
                y = np.stack([part[:, :, 0] + part[:, :, 1], part[:, :, 0] - part[:, :, 1]], axis=2).reshape(len(y), -1)
                h *= 2
            y /= np.sqrt(self.width)
        return y


def _bits(flags: np.ndarray) -> np.ndarray:
    """Flags of each row as 64-bit words."""
    return np.packbits(flags, axis=-1, bitorder="little").view(np.uint64)


def encode(rows: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code words, alignments, length of the coded part, length of the rest) of rotated rows."""
    rest, words, aligned = rows.copy(), [], []
    for _ in range(codes):
        up = rest >= 0
        alignment = np.abs(rest).mean(axis=1)
        rest -= np.where(up, alignment[:, None], -alignment[:, None])
        words.append(_bits(up))
        aligned.append(alignment)
    length = lambda x: np.sqrt((x * x).sum(axis=1))
    return np.stack(words, axis=1), np.stack(aligned, axis=1), length(rows - rest), length(rest)


class Codes:
    """The coded rows of a cell; ``interval`` bounds the scores of one anchor with all of them."""

    def __init__(self, words: np.ndarray, aligned: np.ndarray, coded: np.ndarray, rest: np.ndarray):
        self.words = np.ascontiguousarray(words.transpose(1, 2, 0))  # code, word, row
        self.aligned, self.coded, self.rest = np.ascontiguousarray(aligned.T), coded, rest
        self.ones = np.bitwise_count(self.words).sum(axis=1, dtype=np.int32)

    def interval(self, anchor: np.ndarray, planes: int) -> tuple[np.ndarray, np.ndarray]:
        low = anchor.min()
        step = (anchor.max() - low) / (2**planes - 1) or 1.0
        cut = np.rint((anchor - low) / step)
        left = anchor - (low + step * cut)
        levels = cut.astype(np.uint64)
        weighed = np.zeros(self.ones.shape, np.int64)
        for k in range(planes):
            plane = _bits(((levels >> np.uint64(k)) & np.uint64(1)).astype(bool))
            hits = np.bitwise_count(self.words & plane[None, :, None])
            weighed += (hits[:, 0] if hits.shape[1] == 1 else hits.sum(axis=1, dtype=np.int32)).astype(np.int64) << k
        with_code = 2 * (low * self.ones + step * weighed) - (low * len(anchor) + step * cut.sum())
        middle = (self.aligned * with_code).sum(axis=0)
        size = np.sqrt((anchor * anchor).sum())
        reach = np.sqrt((left * left).sum()) * self.coded + size * self.rest
        reach += 1e-9 * size * (self.coded + self.rest) + 1e-6  # rounding
        return middle - reach, middle + reach


def _code(width: int, scale: float, codes: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotation = Rotation(width, seed)
        for batch in batches:
            whole = np.floor(cells.matrix(batch.column("vector"), width) * scale)
            words, aligned, coded, rest = encode(rotation(whole), codes)
            flat = words.reshape(len(whole), -1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), cells.lists(whole.astype(np.int32)), cells.lists(flat),
                 cells.lists(aligned), pa.array(coded), pa.array(rest)],
                ["id", "label", "whole", "words", "aligned", "coded", "rest"],
            )

    return run


class _Cell:
    """What a pass needs of a cell's rows and anchors."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, width: int, codes: int, seed: int):
        n = rows.num_rows
        order = np.argsort(cells.numbers(rows, "id"), kind="stable")  # equal scores then go by id
        rows = rows.take(pa.array(order))
        self.ids, self.labels = cells.numbers(rows, "id"), cells.numbers(rows, "label")
        self.whole = cells.matrix(rows.column("whole"), width, np.int64)
        words = cells.matrix(rows.column("words"), Rotation(width, seed).width // 64 * codes, np.int64)
        self.codes = Codes(
            words.view(np.uint64).reshape(n, codes, -1),
            cells.matrix(rows.column("aligned"), codes),
            cells.numbers(rows, "coded"),
            cells.numbers(rows, "rest"),
        )
        self.own, self.own_labels = cells.numbers(anchors, "id"), cells.numbers(anchors, "label")
        self.anchors = cells.matrix(anchors.column("whole"), width, np.int64)
        self.rotated = Rotation(width, seed)(self.anchors.astype(np.float64))
        top = [float(np.abs(x).max(initial=0)) for x in (self.anchors, self.whole)]
        self.small = width * top[0] * top[1] < 2**53  # then doubles are exact, and faster
        if self.small:
            self.anchors, self.whole = self.anchors.astype(np.float64), self.whole.astype(np.float64)

    def scores(self, anchor: int, rows: np.ndarray) -> np.ndarray:
        if self.small:
            return (self.whole[rows] @ self.anchors[anchor]).astype(np.int64)
        return (self.whole[rows] * self.anchors[anchor]).sum(axis=1)


def _kth(values: np.ndarray, k: int, otherwise: float) -> float:
    """The k-th largest."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else otherwise


def _positives(width: int, codes: int, planes: int, seed: int, most: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if anchors.num_rows and rows.num_rows:
            cell = _Cell(anchors, rows, width, codes, seed)
            for a, own in enumerate(cell.own):
                low, high = cell.codes.interval(cell.rotated[a], planes)
                other = cell.ids != own
                at = np.flatnonzero(other & (high >= _kth(low[other], most, -np.inf)))
                score = cell.scores(a, at)
                best = np.argsort(-score, kind="stable")[:most]
                out.append((np.full(len(best), own), cell.ids[at[best]], score[best]))
        whole = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(x, pa.int64()) for x in whole], ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(width: int, codes: int, planes: int, seed: int, most: int, least_percent: int, most_percent: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if anchors.num_rows and rows.num_rows:
            cell = _Cell(anchors, rows, width, codes, seed)
            found = anchors.column("positives").to_pylist()
            for a, own in enumerate(cell.own):
                low, high = cell.codes.interval(cell.rotated[a], planes)
                other = cell.labels != cell.own_labels[a]
                possible, spans = np.zeros(len(other), bool), []
                for p in {p["positive_score"] for p in found[a]}:
                    floor, ceiling = -(-least_percent * p // 100), most_percent * p // 100
                    if floor > ceiling:
                        continue
                    within = other & (low >= floor) & (high <= ceiling)
                    bar = max(floor, _kth(low[within], most, -np.inf))
                    possible |= other & (high >= bar) & (low <= ceiling)
                    spans.append((p, floor, ceiling))
                at = np.flatnonzero(possible)
                score = cell.scores(a, at)
                order = np.argsort(-score, kind="stable")
                at, score = at[order], score[order]
                for p, floor, ceiling in spans:
                    best = np.flatnonzero((score >= floor) & (score <= ceiling))[:most]
                    for positive in (x["positive_id"] for x in found[a] if x["positive_score"] == p):
                        n = len(best)
                        out.append((np.full(n, own), np.full(n, positive), cell.ids[at[best]], np.full(n, p), score[best]))
        whole = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 5
        names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
        return pa.table([pa.array(x, pa.int64()) for x in whole], names)

    return run


def _first(rows: DataFrame, by: list[str], score: str, id: str, most: int) -> DataFrame:
    """The best of each group with their ranks; each task keeps its own best before the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), id)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    spark: SparkSession,
    rows: DataFrame,
    is_anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    codes: int = 5,
    planes: int = 8,
    seed: int = 11,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the id; labels are whole numbers.
    """
    source = rows.select(F.col(id).alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    squared = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(F.abs(x) * scale + 1, F.lit(2)))
    fits = F.forall("vector", lambda x: F.abs(x) < 2.0**31 / scale) & (squared < 2.0**62)
    unique = stored(spark, cells.clean(source, "id", "vector", "label").where(fits), "vectors")
    width = unique.agg(F.max(F.size("vector"))).first()[0] or 1
    coded = stored(
        spark,
        unique.mapInArrow(
            _code(width, scale, codes, seed),
            "id long, label long, whole array<int>, words array<long>, aligned array<double>, coded double, rest double",
        ),
        "codes",
    )
    named = coded.withColumn(id, F.col("id")).where(is_anchor)
    anchors = stored(spark, named.select("id", "label", "whole"), "anchors")
    best = cells.met(
        spark, anchors, coded, ["label"], ("id", "id"), (_ANCHORS, _ROWS),
        _positives(width, codes, planes, seed, positives), "anchor_id long, positive_id long, positive_score long",
    )
    best = _first(best, ["anchor_id"], "positive_score", "positive_id", positives)
    listed = best.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    wanted = stored(spark, anchors.join(listed, "id"), "positives")
    found = cells.met(
        spark, wanted, coded, [], ("id", "id"), (_ANCHORS, _ROWS),
        _negatives(width, codes, planes, seed, negatives, least_percent, most_percent),
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long",
    )
    ranked = _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
