"""Language identification by rank-order profiles.

A profile is a language's most frequent character n-grams (1 to 3 letters, words marked at
both ends), by rank. A document's own most frequent n-grams are compared with every
profile: each adds how far it is out of place there, or ``top`` if it is missing. The language
with the smallest sum is predicted (the first by name on a tie); the score is 1 minus
that sum as a share of the largest possible one.

Profiles are learnt from a sample of labelled rows, about ``per_language`` documents of each
language drawn by a hash of the row (all, if there are fewer). Prediction reads nothing but the text.

Defined results: ``und`` and score 0 for a null text, a text without a letter, or when nothing
could be learnt. A row with a null label or no id is not learnt from. A row without an id is not held out.
Repeated rows are learnt from and predicted one by one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm import words as W
from tidegate.llm.work import stored

UNKNOWN = "und"
_SHIFT = np.int64(21)
_EDGE = 1  # the code of a word's edge
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """For every code point whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(text: str) -> np.ndarray:
    """All 1- to 3-grams of the text's words, one 64-bit number each."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    codes = np.where(_letter_table()[codes], codes, _EDGE)
    codes = np.concatenate([[_EDGE], codes, [_EDGE]])
    codes = codes[np.concatenate([[True], (codes[1:] != _EDGE) | (codes[:-1] != _EDGE)])]
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    pairs = (codes[:-1] << _SHIFT) | codes[1:]
    triples = (pairs[:-1] << _SHIFT) | codes[2:]
    return np.concatenate([codes[codes != _EDGE], pairs, triples[codes[1:-1] != _EDGE]])


def ranked(grams: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams in order; the smaller number first on a tie."""
    values, n = np.unique(grams, return_counts=True)
    return values[np.lexsort((values, -n))[:top]]


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    for value in batch.column("text"):
        yield value.as_py() or ""


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in W.pieces(whole, "text"):
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), _texts(batch), strict=True):
                found.setdefault(lang, []).append(ngrams(text))
            for lang, grams in found.items():
                values, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"],
                )


class Profiles:
    """Ranks of the n-grams in each language."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int):
        self.top = top
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.unique(np.array([r[1] for r in rows], np.int64))
        self.ranks = np.full((len(self.grams), len(self.langs)), -1, np.int64)
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), self.langs.index(lang)] = rank

    def predict(self, text: str) -> tuple[str, float]:
        own = ranked(ngrams(text), self.top)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        ranks = self.ranks[at[known]]
        place = np.flatnonzero(known)[:, None]
        out = np.where(ranks >= 0, np.minimum(np.abs(ranks - place), self.top), self.top).sum(axis=0)
        out = out + (~known).sum() * self.top
        best = int(out.argmin())
        return self.langs[best], float(1 - out[best] / (len(own) * self.top))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 modulo 3."""
    crc = F.crc32(doc_id.cast("long").cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(3)) == 1, F.lit(False))


def learn_profiles(
    spark: SparkSession, labelled: DataFrame, top: int = 300, per_language: int = 2000
) -> Profiles:
    """Profiles from (doc_id, text, lang); ``top`` rows a language come to the driver."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    rates = rows.groupBy("lang").agg((F.lit(float(per_language)) / F.count("*")).alias("rate"))
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("profile")), 11) * F.lit(2.0**-53)
    sample = rows.join(stored(spark, rates, "language-rates"), "lang").where(draw < F.col("rate"))
    counted = sample.select("lang", "text").mapInArrow(_learn, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = (
        counted.groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(order) - 1)
        .where(F.col("rank") < top)
    )
    return Profiles([(r["lang"], r["gram"], r["rank"]) for r in best.collect()], top)


def _predict(profiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = profiles.value
        for whole in batches:
            for batch in W.pieces(whole, "text"):
                found = [model.predict(t) for t in _texts(batch)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("held_out"),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def identify(
    spark: SparkSession, docs: DataFrame, lang: str = "lang", top: int = 300, per_language: int = 2000
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from the rows that are not held out."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text",
        F.col(lang).cast("string").alias("lang"),
    )
    learnt = learn_profiles(spark, source.where("NOT held_out"), top, per_language)
    profiles = spark.sparkContext.broadcast(learnt)
    return source.select("doc_id", "held_out", "text").mapInArrow(
        _predict(profiles), "doc_id long, held_out boolean, lang_pred string, score double"
    )
