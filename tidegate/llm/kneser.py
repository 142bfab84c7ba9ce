"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

Symbols are characters: lower case, a run of white space as one space, digits as 0, with
marks before and after the text. All texts that are trusted are counted; tasks combine
their counts before they are shuffled by n-gram. Lower orders count the distinct
characters before an n-gram. Every order has three discounts from its counts of counts,
and each n-gram's probability and each context's weight are joined up from order to order.

The model is cut into shards by the two characters before the predicted one, so that all that a
place of a text needs is in one shard (n-grams of one and two characters, of which there are few, are
in all). Documents are met with one shard at a time, each of about ``shard_rows`` entries,
and the parts of a document's log-probability are added up. So no text is shuffled, and
memory is bounded however large the model grows.

A document is kept if its perplexity is at most the ``quantile`` of the trusted documents' in its
language; a language without trusted documents takes that of all languages. As texts look likelier
to a model that has counted them, trusted documents are scored out of fold for this: a hash
of the id puts each in one of ``folds`` parts, and a model of the other parts scores it. N-grams are
counted once, by fold, and added up for each model.

Defined results: a null or blank text has perplexity null and is kept, as it is not judged here.
A null language is a language of its own. Without any trusted text, or with all of them in one fold,
nothing is judged. Repeated rows
count and come back as often as they are there; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import words as W
from tidegate.llm.work import row_key, stored

_BEGIN, _END = 2, 3
_SPACE = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0xA0, 0x2028, 0x2029, 0x3000, 1, _BEGIN, _END, 0])
_WINDOW = 2_000_000
_FACTORS = np.cumprod(np.full(8, 0x9E3779B97F4A7C15 | 1, np.uint64), dtype=np.uint64)


def symbols(text: str, order: int) -> np.ndarray:
    """Code points of a text as the model sees it; empty if there is nothing but white space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    codes = np.where((codes >= 0x30) & (codes <= 0x39), np.uint32(0x30), codes)
    codes = np.where(np.isin(codes, _SPACE), np.uint32(0x20), codes)
    codes = codes[(codes != 0x20) | np.concatenate([[False], codes[:-1] != 0x20])] if len(codes) else codes
    if len(codes) and codes[-1] == 0x20:
        codes = codes[:-1]
    if not len(codes):
        return codes
    return np.concatenate([np.full(order - 1, _BEGIN, np.uint32), codes, np.array([_END], np.uint32)])


def _texts(batch: pa.RecordBatch, order: int) -> list[np.ndarray]:
    return [symbols(t.as_py() or "", order) for t in batch.column("text")]


def keys(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n symbols that end before each place."""
    out = np.full(len(at), n, np.uint64)
    for k in range(1, n + 1):
        out += (codes[at - k].astype(np.uint64) + np.uint64(1)) * _FACTORS[k - 1]
    return W.mix(out)


def _count(order: int):
    def send(fold: int, window: list[np.ndarray]) -> pa.RecordBatch:
        codes = np.concatenate(window)
        ends = np.concatenate([np.arange(order, len(w) + 1) for w in window])
        ends += np.repeat(np.cumsum([0, *map(len, window[:-1])]), [len(w) - order + 1 for w in window])
        _, first, n = np.unique(keys(codes, ends, order), return_index=True, return_counts=True)
        rows = codes[ends[first][:, None] + np.arange(-order, 0)]
        grams = np.ascontiguousarray(rows, dtype="<u4").view(f"<U{order}").ravel()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(n), fold, np.int32)),
                pa.array(grams.tolist(), pa.string()),
                pa.array(n.astype(np.int64)),
            ],
            ["fold", "gram", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: dict[int, list[np.ndarray]] = {}
        held: dict[int, int] = {}
        for whole in batches:
            for batch in W.pieces(whole, "text"):
                for fold, codes in zip(batch.column("fold").to_pylist(), _texts(batch, order), strict=True):
                    if len(codes):
                        windows.setdefault(fold, []).append(codes)
                        held[fold] = held.get(fold, 0) + len(codes)
                    if held.get(fold, 0) >= _WINDOW:
                        yield send(fold, windows.pop(fold))
                        del held[fold]
        for fold, window in windows.items():
            yield send(fold, window)

    return run


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts of one order from how many n-grams were seen 1, 2, 3 and 4 times."""
    seen = [F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]
    n1, n2, n3, n4 = counts.agg(*seen).first()
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
    raw = (
        1 - 2 * y * n2 / n1 if n1 else 0.5,
        2 - 3 * y * n3 / n2 if n2 else 1.0,
        3 - 4 * y * n4 / n3 if n3 else 1.5,
    )
    return tuple(min(max(d, 0.05), k) for k, d in enumerate(raw, 1))


def _counts(spark: SparkSession, trusted: DataFrame, order: int) -> DataFrame:
    """(fold, gram, n) of the longest n-grams, stored."""
    counted = trusted.select("fold", "text").mapInArrow(_count(order), "fold int, gram string, n long")
    return stored(spark, counted.groupBy("fold", "gram").agg(F.sum("n").alias("n")), "ngram-counts")


def train(spark: SparkSession, trusted: DataFrame, order: int = 5) -> DataFrame:
    """The model of some texts, as ``_model`` gives it."""
    return _model(spark, _counts(spark, trusted.select(F.lit(0).alias("fold"), "text"), order), order)


def _model(spark: SparkSession, counted: DataFrame, order: int) -> DataFrame:
    """The model: (gram, logp, backoff) of every n-gram, logs of its probability and of its weight as a context.

    The row with an empty n-gram has the probability of a character never seen.
    """
    counts = stored(spark, counted.groupBy("gram").agg(F.sum("n").alias("n")), "ngram-counts")
    tables = {order: counts}
    for n in range(order - 1, 0, -1):
        longer = tables[n + 1]
        shorter = longer.groupBy(F.substring("gram", 2, n).alias("gram")).agg(F.count("*").alias("n"))
        tables[n] = stored(spark, shorter, "ngram-counts")
    lower = None
    out = []
    for n in range(1, order + 1):
        table = tables[n]
        d1, d2, d3 = _discounts(table)
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        table = table.withColumn("context", F.substring("gram", 1, n - 1)).withColumn("cut", discount)
        contexts = table.groupBy("context").agg(
            F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight")
        )
        if lower is None:  # below single characters, all that were seen and one unseen are alike
            kinds = table.count() + 1
            joined = table.withColumn("suffix_p", F.lit(1.0 / kinds))
            unseen = contexts.select(F.lit("").alias("gram"), F.log(F.col("weight") / kinds).alias("logp"))
        else:
            below = lower.select(F.col("gram").alias("suffix"), F.exp("logp").alias("suffix_p"))
            joined = table.withColumn("suffix", F.substring("gram", 2, n - 1)).join(below, "suffix")
        p = (F.col("n") - F.col("cut")) / F.col("total") + F.col("weight") * F.col("suffix_p")
        lower = stored(
            spark, joined.join(contexts, "context").select("gram", F.log(p).alias("logp")), "ngram-logs"
        )
        if n > 1:
            weights = contexts.select(F.col("context").alias("gram"), F.log("weight").alias("backoff"))
            out[-1] = out[-1].join(weights, "gram", "full")
        out.append(lower)
    out[-1] = out[-1].withColumn("backoff", F.lit(None).cast("double"))
    model = reduce(DataFrame.unionByName, out).unionByName(unseen.withColumn("backoff", F.lit(None).cast("double")))
    return stored(spark, model, "ngram-model")


class _Table:
    """A hash table from 64-bit keys to floats, as two arrays."""

    def __init__(self, known: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(2 * len(known) - 1).bit_length() if len(known) else 4)
        self.mask = np.uint64(size - 1)
        self.keys, self.values = np.zeros(size, np.uint64), np.zeros(size, np.float32)
        left, step = np.arange(len(known)), np.uint64(0)
        while len(left):
            slot = ((known[left] + step) & self.mask).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            first = first[self.keys[slot[first]] == 0]
            self.keys[slot[first]], self.values[slot[first]] = known[left[first]], values[left[first]]
            left = np.delete(left, first)
            step += np.uint64(1)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found or not, values)."""
        slot = (wanted & self.mask).astype(np.int64)
        held = self.keys[slot]
        found = held == wanted
        more = np.flatnonzero(~found & (held != 0))
        while len(more):
            slot[more] = (slot[more] + 1) & int(self.mask)
            held = self.keys[slot[more]]
            found[more] = held == wanted[more]
            more = more[(held != wanted[more]) & (held != 0)]
        return found, self.values[slot]


class Shard:
    """One shard of the model, ready to look up."""

    def __init__(self, order: int, shard: int, shards: int, unseen: float, grams, backoffs):
        self.order, self.shard, self.shards, self.unseen = order, shard, shards, unseen
        self.grams, self.backoffs = _Table(*grams), _Table(*backoffs)

    def score(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the places of this shard and their summed log-probability."""
        n = self.order
        sizes = np.array([len(t) for t in texts])
        codes = np.concatenate([np.zeros(0, np.uint32), *texts])
        starts = np.cumsum(sizes) - sizes
        ends = np.arange(1, len(codes) + 1)
        ends = ends[ends - np.repeat(starts, sizes) >= n]
        doc = np.repeat(np.arange(len(texts)), np.maximum(sizes - n + 1, 0))
        if self.shards > 1:
            here = keys(codes, ends - 1, 2) % np.uint64(self.shards) == self.shard
            ends, doc = ends[here], doc[here]
        logp = np.full(len(ends), self.unseen)
        weight = np.zeros(len(ends))
        left = np.arange(len(ends))
        for k in range(n, 0, -1):
            found, values = self.grams.find(keys(codes, ends[left], k))
            hit = left[found]
            logp[hit] = values[found] + weight[hit]
            left = left[~found]
            if k > 1:
                found, values = self.backoffs.find(keys(codes, ends[left] - 1, k - 1))
                weight[left[found]] += values[found]
        logp[left] += weight[left]
        summed = np.bincount(doc, weights=logp, minlength=len(texts))
        return np.bincount(doc, minlength=len(texts)), summed.astype(np.float64)  # whole numbers if all are blank


def _shards(spark: SparkSession, model: DataFrame, order: int, shard_rows: int) -> Iterator[Shard]:
    """The shards, one at a time in the driver; each is made by its key and has about ``shard_rows`` rows."""
    rows = model.count()
    if not rows:
        return
    unseen = model.where("gram = ''").first()["logp"]
    shards = -(-rows // shard_rows)

    def hashed(grams: np.ndarray, n: int) -> np.ndarray:
        codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32)
        return keys(codes, np.arange(n, len(codes) + 1, n), n)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each entry's key and, for every shard that it belongs to, the shard."""
        for batch in batches:
            grams = np.array(batch.column("gram").to_pylist(), dtype=object)
            size = np.array([len(g) for g in grams])
            for n in np.unique(size[size > 0]):
                at = np.flatnonzero(size == n)
                key = hashed(grams[at], n)
                part = batch.take(pa.array(at))
                for kind, before in (("logp", 3), ("backoff", 2)):
                    known = part.column(kind).is_valid().to_numpy(zero_copy_only=False)
                    if not known.any():
                        continue
                    if n >= before:  # the two symbols before the predicted one
                        two = [g[-3:-1] if kind == "logp" else g[-2:] for g in grams[at]]
                        belongs = [hashed(two, 2) % np.uint64(shards)]
                    else:
                        belongs = [np.full(len(at), s) for s in range(shards)]
                    for shard in belongs:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(shard.astype(np.int32)[known]),
                                pa.array([kind == "logp"] * int(known.sum())),
                                pa.array(W.signed(key[known])),
                                part.column(kind).filter(pa.array(known)).cast(pa.float32()),
                            ],
                            ["shard", "probability", "key", "value"],
                        )

    keyed = stored(
        spark,
        model.where("gram <> ''").mapInArrow(own, "shard int, probability boolean, key long, value float"),
        "model-shards",
    )
    for s in range(shards):
        table = keyed.where(F.col("shard") == s).drop("shard").toArrow()
        first = table.column("probability").to_numpy()
        key = table.column("key").to_numpy().view(np.uint64)
        value = table.column("value").to_numpy()
        yield Shard(order, s, shards, unseen, (key[first], value[first]), (key[~first], value[~first]))


def _score(shard):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shard.value
        for whole in batches:
            for batch in W.pieces(whole, "text", 1 << 20):
                n, logp = model.score(_texts(batch, model.order))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in ("doc_id", "lang", "row")],
                        pa.array(n.astype(np.int64)),
                        pa.array(logp),
                    ],
                    ["doc_id", "lang", "row", "n_symbols", "logp"],
                )

    return run


def perplexities(
    spark: SparkSession, docs: DataFrame, model: DataFrame, order: int = 5, shard_rows: int = 1_500_000
) -> DataFrame:
    """doc_id, lang, row, n_symbols, logp of every row, stored; ``row`` is a key of id, language and text."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        row_key(F.col("doc_id"), F.col("lang"), F.col("text")).alias("row"),
        "text",
    )
    schema = "doc_id long, lang string, row long, n_symbols long, logp double"
    parts = []
    for shard in _shards(spark, model, order, shard_rows):
        sent = spark.sparkContext.broadcast(shard)
        parts.append(stored(spark, source.mapInArrow(_score(sent), schema), "scores"))
        sent.destroy()
    if not parts:  # there is no model
        return source.select("doc_id", "lang", "row", F.lit(0).cast("long").alias("n_symbols"), F.lit(0.0).alias("logp"))
    if len(parts) == 1:
        return parts[0]
    # A row that is there m times has m equal parts in each shard, so its sums are m times too large.
    summed = reduce(DataFrame.unionAll, parts).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("lang").alias("lang"),
        F.sum("n_symbols").alias("n_symbols"),
        F.sum("logp").alias("logp"),
        (F.count("*") / len(parts)).cast("long").alias("m"),
    )
    once = summed.withColumn("n_symbols", (F.col("n_symbols") / F.col("m")).cast("long")).withColumn(
        "logp", F.col("logp") / F.col("m")
    )
    return stored(
        spark,
        once.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "m"))).select(
            "doc_id", "lang", "row", "n_symbols", "logp"
        ),
        "scores",
    )


def quality(
    spark: SparkSession,
    docs: DataFrame,
    trusted_ids: DataFrame,
    order: int = 5,
    quantile: float = 0.99,
    shard_rows: int = 1_500_000,
    broadcast_rows: int = 1_000_000,
    folds: int = 3,
) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold, kept of every row.

    ``trusted_ids`` has the doc_id of trusted documents. At most ``broadcast_rows`` of them are broadcast;
    more are joined by a shuffle.
    """
    ids = stored(
        spark, trusted_ids.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct(), "trusted-ids"
    )
    small = ids.count() <= broadcast_rows
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(folds)).cast("int").alias("fold")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").select("*", fold)
    trusted = texts.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
    counts = _counts(spark, trusted, order)
    # Many ids meet the scores and not the texts, which would be shuffled for each fold.
    held = trusted if small else texts
    unseen = reduce(
        DataFrame.unionAll,
        [
            perplexities(
                spark,
                held.where(F.col("fold") == f).drop("fold"),
                _model(spark, counts.where(F.col("fold") != f), order),
                order,
                shard_rows,
            )
            for f in range(folds)
        ],
    )

    def judged(scores: DataFrame) -> DataFrame:
        perplexity = F.when(F.col("n_symbols") > 0, F.exp(-F.col("logp") / F.col("n_symbols")))
        return scores.withColumn("perplexity", perplexity).withColumn("key", row_key(F.col("lang")))

    scored = judged(perplexities(spark, docs, _model(spark, counts, order), order, shard_rows))
    known = judged(unseen).where("perplexity IS NOT NULL").join(ids, "doc_id", "left_semi")
    middle = F.percentile_approx("perplexity", F.lit(quantile), F.lit(100_000))
    limits = stored(
        spark,
        known.groupBy("key").agg(middle.alias("own")).unionAll(
            known.agg(middle.alias("own")).select(F.lit(None).cast("long").alias("key"), "own")
        ),
        "perplexity-limits",
    )
    overall = limits.where("key IS NULL").first()["own"]
    threshold = F.coalesce(F.col("own"), F.lit(overall).cast("double"))
    return (
        scored.join(limits.where("key IS NOT NULL"), "key", "left")
        .withColumn("threshold", threshold)
        .withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
        .select("doc_id", "row", "lang", "n_symbols", "perplexity", "threshold", "kept")
    )
