"""Benchmark decontamination by CGK embeddings, bit sampling and exact edit distance.

Symbols are words: A-Z lower-cased, ASCII punctuation left out. A document is
contaminated by an item of m words when some run of its words is within
``floor(rate * m)`` word edits (insert, delete, replace) of the item.

A CGK walk reads a sequence with one pointer: at step t it puts out the word under the
pointer and then moves on by a random bit that depends on t and that word only. Two
sequences at a small edit distance so meet again after an edit, and most of what they put
out is equal: edit distance has become Hamming distance. A key is a hash of the words
put out at a few sampled steps; ``walks`` walks with ``samples`` keys each are taken
from every word of a document, and from every place of an item that has a whole walk
left. Equal keys make a candidate window of the item's size, widened by the edits
allowed, which is verified by exact approximate matching (bit-parallel, whole item).

A walk reads about half as many words as it has steps and an item of 8, 12 or 16 words has
one anchor only, so random walks alone miss short items. One more walk is therefore
straight: it moves on at every step and its key takes all of them. An item that may have
k edits is cut in k + 1 pieces; k edits leave one piece as it is, wherever they fall, so a
straight walk over each piece finds the item. The target recall is 1 at any length and at
the largest edit rate below 1, and the tests hold each length to it.

The benchmark is read in blocks of at most ``block_items`` items and ``block_words``
words; each block is broadcast and met with all documents. Nothing is shuffled.

Defined results: null and empty texts and items match nothing. Repeated rows are
searched one by one. A null id is given back as null. Other columns are ignored. Empty
tables give no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import words as W
from tidegate.llm.work import row_key

_WORDY = np.ones(256, dtype=bool)
_WORDY[[b for b in range(33, 127) if not chr(b).isalnum()]] = False

#: Steps of a walk and sampled steps of a key, for items of at least so many words.
_SHAPES = ((16, 7), (12, 6), (8, 6), (4, 4), (1, 1))
_GAP = _SHAPES[0][0]
#: Places that are walked at a time, so that they stay in the processor's cache.
_TILE = 1 << 15
_SCHEMA = (
    "doc_id long, row long, item_id long, item_words int, distance int, first_word int, last_word int"
)


def normal_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the normalised words, and the number of words before each text (and in all)."""
    data, offsets = W.utf8(column)
    wordy = _WORDY[data]
    total = np.concatenate([[0], np.cumsum(wordy)])
    data, offsets = data[wordy], total[offsets]
    starts, ends, first = W.spans(data, offsets)
    return W.hashes(data, starts, ends, W.LOWER), first


def _factors(steps: int, sampled: int, samples: int, random: np.random.Generator) -> np.ndarray:
    """Per step and key the odd factor with which the step's word enters the key, or 0."""
    out = np.zeros((_SHAPES[0][0], samples), np.uint64)
    for s in range(samples):
        # One step of each stretch, so that a key seldom takes one word twice.
        edges = np.linspace(0, steps, sampled + 1).astype(int)
        at = random.integers(edges[:-1], edges[1:])
        out[at, s] = random.integers(1, 2**63, sampled, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return out


def _keys(words: np.ndarray, anchors: np.ndarray, factors: np.ndarray) -> list[np.ndarray]:
    """The keys of one walk from each anchor; ``words`` must go on for its steps beyond the last one."""
    at = anchors.copy()
    keys = [np.zeros(len(anchors), np.uint64) for _ in range(factors.shape[1])]
    for step, row in enumerate(factors):
        value = words[at]
        for key, factor in zip(keys, row, strict=True):
            if factor:
                key += value * factor
        at += ((value >> np.uint64(step + 1)) & np.uint64(1)).view(np.int64)
    return [W.mix(k) for k in keys]


def best_match(item: np.ndarray, masks: dict[int, int], text: list[int]) -> tuple[int, int]:
    """(distance, end) of the run of ``text`` nearest to the item; the first end on a tie."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for i, word in enumerate(text):
        eq = masks.get(word, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (~(xh | plus) & full)
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        plus = ((mh << 1) & full) | (~(xv | ph) & full)
        minus = ph & xv
        if score < best:
            best, end = score, i + 1
    return best, end


def _masks(item: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = defaultdict(int)
    for i, word in enumerate(item.tolist()):
        out[word] |= 1 << i
    return dict(out)


def _known(keys: np.ndarray, owner: np.ndarray, place: np.ndarray) -> tuple:
    """Sorted keys, their items and places, and a filter on 20 bits."""
    order = np.argsort(keys, kind="stable")
    present = np.zeros(1 << 20, bool)
    present[keys >> np.uint64(44)] = True
    return keys[order], owner[order], place[order], present


def _meet(keys: np.ndarray, table: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the key, item, place) of all equal keys."""
    known, owner, place, present = table
    at = np.flatnonzero(present[keys >> np.uint64(44)])
    low = np.searchsorted(known, keys[at], "left")
    n = np.searchsorted(known, keys[at], "right") - low
    at, low, n = at[n > 0], low[n > 0], n[n > 0]
    entry = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.repeat(at, n), owner[entry], place[entry]


class Index:
    """Keys of one block of items; bounded by the block."""

    def __init__(self, ids: list, texts: list[str], rate: float, walks: int, samples: int, seed: int):
        words, first = normal_words(pa.array(texts, pa.large_string()))
        self.rate = rate
        self.ids = [i for i, n in zip(ids, np.diff(first), strict=True) if n]
        self.items = [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True) if b > a]
        self._masks: dict[int, tuple[dict, dict]] = {}
        random = np.random.default_rng(seed)
        size = np.array([len(x) for x in self.items])
        self.walks = []  # (seed, factors, per key its known values)
        for _ in range(walks):
            walk = np.uint64(random.integers(0, 2**63))
            factors, tables, most = [], [], None
            for steps, sampled in _SHAPES:
                here = np.flatnonzero((size >= steps) & (size < (most or np.inf)))
                most = steps
                if not len(here):
                    continue
                factors.append(_factors(steps, sampled, samples if sampled < steps else 1, random))
                anchors = [np.arange(size[i] - steps + 1) for i in here]
                owner = np.repeat(here, [len(x) for x in anchors])
                place = np.concatenate(anchors)
                ends = [W.mix(np.append(self.items[i], np.zeros(_GAP, np.uint64)) ^ walk) for i in here]
                by_item = [_keys(w, x, factors[-1]) for w, x in zip(ends, anchors, strict=True)]
                for s in range(factors[-1].shape[1]):
                    tables.append(_known(np.concatenate([k[s] for k in by_item]), owner, place))
            self.walks.append((walk, np.hstack(factors) if factors else None, tables))
        straight = defaultdict(list)  # by length, (key, item, place) of each piece
        for i, item in enumerate(self.items):
            k = min(int(rate * len(item)), len(item) - 1)
            edges = [p * len(item) // (k + 1) for p in range(k + 2)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                n = min(b - a, _GAP)
                straight[n].append((W.windows(item[a : a + n], n)[0], i, a))
        self.straight = {n: _known(*map(np.array, zip(*rows, strict=True))) for n, rows in straight.items()}

    def search(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, word after the last) of the best match of each item found."""
        n_docs = len(first) - 1
        doc = np.repeat(np.arange(n_docs), np.diff(first))
        spaced = np.arange(len(words)) + doc * _GAP  # so that no walk reaches the next text
        padded = np.zeros(len(words) + n_docs * _GAP + _GAP, np.uint64)
        padded[spaced] = words
        hits = []
        for walk, factors, tables in self.walks:
            mixed = W.mix(padded ^ walk)
            for tile in range(0, len(words) if tables else 0, _TILE):
                keys = _keys(mixed, spaced[tile : tile + _TILE], factors)
                for key, table in zip(keys, tables, strict=True):
                    at, owner, place = _meet(key, table)
                    at += tile
                    hits.append(np.column_stack([doc[at], owner, at - first[doc[at]] - place]))
        for n, table in self.straight.items():
            for tile in range(0, len(words) - n + 1, _TILE):
                at, owner, place = _meet(W.windows(words[tile : tile + _TILE + n - 1], n), table)
                at += tile
                inside = doc[at] == doc[at + n - 1]
                at, owner, place = at[inside], owner[inside], place[inside]
                hits.append(np.column_stack([doc[at], owner, at - first[doc[at]] - place]))
        found = np.unique(np.concatenate([np.zeros((0, 3), np.int64), *hits]), axis=0)
        if not len(found):
            return
        head = np.flatnonzero(np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(axis=1)]))
        for a, b in zip(head, [*head[1:], len(found)], strict=True):
            d, i = found[a, :2].tolist()
            match = self._verify(i, words[first[d] : first[d + 1]], found[a:b, 2].tolist())
            if match:
                yield d, i, *match

    def _verify(self, i: int, text: np.ndarray, begins: list[int]) -> tuple[int, int, int] | None:
        item = self.items[i]
        m, most = len(item), int(self.rate * len(item))
        if i not in self._masks:
            self._masks[i] = _masks(item), _masks(item[::-1])
        masks, back = self._masks[i]
        best, until = None, -1
        for begin in begins:  # in order; windows that are inside the last one are skipped
            if begin + m + most <= until:
                continue
            # A window also covers what begins within the edits after it.
            low, until = max(0, begin - most), begin + m + 2 * most + 2
            window = text[low:until].tolist()
            if sum(word in masks for word in window) < m - most:
                continue  # too few of the item's words for so few edits
            distance, end = best_match(item, masks, window)
            if distance <= most and (best is None or distance < best[0]):
                _, length = best_match(item, back, window[:end][::-1])
                best = (distance, low + end - length, low + end)
        return best


def _find(index):
    names = [x.split()[0] for x in _SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = index.value
        for whole in batches:
            for batch in W.pieces(whole, "text"):
                rows = list(found.search(*normal_words(batch.column("text"))))
                if rows:
                    d, i, distance, a, b = zip(*rows, strict=True)
                    part = batch.select(["doc_id", "row"]).take(pa.array(d, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *part.columns,
                            pa.array([found.ids[x] for x in i], pa.int64()),
                            pa.array([len(found.items[x]) for x in i], pa.int32()),
                            *[pa.array(x, pa.int32()) for x in (distance, a, b)],
                        ],
                        names,
                    )

    return run


def _drop(index, text: str):
    """The rows without a match, as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.pieces(whole, text):
                found = index.value.search(*normal_words(batch.column(text)))
                clean = np.ones(batch.num_rows, bool)
                clean[[f[0] for f in found]] = False
                yield batch.filter(pa.array(clean))

    return run


def _blocks(benchmark: DataFrame, items: int, words: int) -> Iterator[tuple[list, list[str]]]:
    """The distinct items, in blocks; only one block is in the driver at a time."""
    ids, texts, held = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL").distinct()
    for item, text in rows.toLocalIterator():
        n = len(text.split())
        if ids and (len(ids) >= items or held + n > words):
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(item)
        texts.append(text)
        held += n
    if ids:
        yield ids, texts


def find_leaks(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = 0.2,
    walks: int = 4,
    samples: int = 2,
    seed: int = 17,
    block_items: int = 20_000,
    block_words: int = 200_000,
) -> DataFrame:
    """One row per document and item found in it: the nearest run of words and its distance.

    ``row`` is a key of id and text; words are counted after normalising, from 0, and
    ``last_word`` is the last one of the run.
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key(F.col("doc_id"), F.col("text")).alias("row"),
        F.col("text"),
    )
    parts = []
    for ids, texts in _blocks(benchmark, block_items, block_words):
        index = spark.sparkContext.broadcast(Index(ids, texts, rate, walks, samples, seed))
        parts.append(source.mapInArrow(_find(index), _SCHEMA))
    if not parts:
        return spark.createDataFrame([], _SCHEMA)
    return reduce(DataFrame.unionAll, parts).withColumn("last_word", F.col("last_word") - 1)


def without_leaks(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    rate: float = 0.2,
    walks: int = 4,
    samples: int = 2,
    seed: int = 17,
    block_items: int = 20_000,
    block_words: int = 200_000,
) -> DataFrame:
    """The rows that ``find_leaks`` finds nothing in, with all their columns; nothing is joined."""
    for ids, texts in _blocks(benchmark, block_items, block_words):
        index = spark.sparkContext.broadcast(Index(ids, texts, rate, walks, samples, seed))
        docs = docs.mapInArrow(_drop(index, text), docs.schema)
    return docs
