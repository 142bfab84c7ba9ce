"""Quality rules: counts per text, and line frequency across the documents of a host.

A line is normalised to its words, A-Z lower-cased and joined by single spaces, and
hashed. A line that stands in more documents of a host than the limit is over it: it stays in the document
with the smallest id and is removed from the host's others. The limit is ``floor`` documents and one more for each
binary digit of the host's number of documents, so it hardly grows: a host with a third of a large
corpus is held to about the same number as a small one. A document is rejected when it fails the base rules or
when what stays of it is depleted: fewer than ``min_words`` words, or less than ``min_left`` of its words.

``line_quality`` gives the counts and the verdict, all counts on the whole text; ``cleaned`` gives the documents
that are kept, without the lines that are removed from them.

Defined results: a null or empty text has no words and fails the base rules. A null
host is a host of its own; a null id is a document like any other. Repeated rows
(same id, host and text) count as one document and come back as often as they
are there. Other columns of the input are ignored. No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import words as W
from tidegate.llm.work import row_key, stored

WINDOW = 5
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = (
    "doc_id long, host long, row long, "
    + ", ".join(f"{c} long" for c in COUNTS)
    + ", lines array<struct<line: long, words: long>>"
)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the flags are set in each text."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(words: np.ndarray, first: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per text, words in windows that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(len(first) - 1, np.int64)
    whole = doc[:n] == doc[WINDOW - 1 :]  # the window does not cross into the next text
    at = np.flatnonzero(whole)
    key = W.mix(W.windows(words, WINDOW)[at] + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(at), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at[again], 1)
    np.add.at(edge, at[again] + WINDOW, -1)
    return _per_text(np.cumsum(edge[:-1]) > 0, first)


def _lines(data, offsets, starts, ends, doc, line) -> tuple[np.ndarray, pa.ListArray]:
    """Repeated lines per text; the distinct normalised lines of each text with their words.

    ``line`` is the number of the line, over all texts, that each word stands in.
    """
    n_docs = len(offsets) - 1
    if not len(starts):
        empty = pa.array([[]] * n_docs, pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())])))
        return np.zeros(n_docs, np.int64), empty
    firsts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    lasts = np.append(firsts[1:], len(starts)) - 1
    owner = doc[firsts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    # Raw lines run from the byte after the last line end (or the text's start) to the next one.
    breaks = np.flatnonzero(data == 0x0A)
    before = np.concatenate([[0], breaks + 1])[np.searchsorted(breaks, starts[firsts])]
    after = np.append(breaks, len(data))[np.searchsorted(breaks, starts[lasts])]
    raw = W.hashes(data, np.maximum(before, offsets[doc[firsts]]), np.minimum(after, offsets[doc[firsts] + 1]))
    distinct = doc[firsts][np.unique(W.mix(raw + owner), return_index=True)[1]]
    repeats = np.bincount(doc[firsts], minlength=n_docs) - np.bincount(distinct, minlength=n_docs)

    normal = W.sequence_hashes(W.hashes(data, starts, ends, W.LOWER), firsts)
    counts = lasts - firsts + 1
    order = np.lexsort((normal, doc[firsts]))
    head = np.concatenate(
        [[True], (normal[order][1:] != normal[order][:-1]) | (doc[firsts][order][1:] != doc[firsts][order][:-1])]
    )
    at = np.flatnonzero(head)
    summed = np.add.reduceat(counts[order], at)
    per_doc = np.bincount(doc[firsts][order][at], minlength=n_docs)
    entries = pa.StructArray.from_arrays(
        [pa.array(W.signed(normal[order][at])), pa.array(summed.astype(np.int64))], ["line", "words"]
    )
    return repeats, pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32)), entries
    )


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in W.pieces(whole, "text"):
            data, offsets = W.utf8(batch.column("text"))
            starts, ends, first = W.spans(data, offsets)
            n_words = np.diff(first)
            doc = np.repeat(np.arange(len(n_words)), n_words)
            # A text's end ends its line too, so each text adds one to the number of a line.
            line = np.searchsorted(np.flatnonzero(data == 0x0A), starts) + doc
            in_word = np.zeros(len(data) + 1, np.int8)
            in_word[starts] += 1
            in_word[ends] -= 1
            in_word = np.cumsum(in_word[:-1], dtype=np.int8) > 0
            dup_lines, lines = _lines(data, offsets, starts, ends, doc, line)
            columns = [
                n_words,
                _per_text(in_word & ((data & 0xC0) != 0x80), offsets),
                _per_text(_SYMBOL[data], offsets),
                dup_lines,
                _repeated(W.hashes(data, starts, ends), first, doc),
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "host", "row")], *[pa.array(c, pa.int64()) for c in columns], lines],
                ["doc_id", "host", "row", *COUNTS, "lines"],
            )


def line_quality(
    spark: SparkSession,
    docs: DataFrame,
    host: str = "source",
    floor: int = 10,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    min_left: float = 0.2,
) -> DataFrame:
    """doc_id, row, the counts, removed lines and words, ``base_failed`` and ``kept``, per row.

    ``row`` is a key of id, host and text, ``cut`` lists the hashes of the lines to remove.
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key(F.col(host)).alias("host"),
        row_key(F.col("doc_id"), F.col(host), F.col("text")).alias("row"),
        F.col("text"),
    )
    counted = stored(spark, source.mapInArrow(_judge, _SCHEMA), "line-counts")

    documents = counted.groupBy("host", "row").agg(F.first("doc_id").alias("doc_id"))
    limit = documents.groupBy("host").agg((floor + F.length(F.bin(F.count("*")))).alias("most"))
    lines = counted.select("host", "row", "doc_id", F.inline("lines"))
    # Repeated rows merge first; a common line is then counted before it is shuffled.
    common = (
        lines.groupBy("host", "row", "line")
        .agg(F.first("doc_id").alias("doc_id"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "row")).alias("keeper"))
        .join(limit, "host")
        .where(F.col("n") > F.col("most"))
        .select("host", "line", F.col("keeper.row").alias("keeper"))
    )
    common = stored(spark, common, "common-lines")  # Spark then knows its size
    removed = (
        lines.join(common, ["host", "line"])
        .where(F.col("row") != F.col("keeper"))
        .groupBy("row", "line")
        .agg(F.first("words").alias("words"))  # a repeated row's line once
        .groupBy("row")
        .agg(
            F.count("*").alias("n_removed_lines"),
            F.sum("words").alias("n_removed_words"),
            F.collect_list("line").alias("cut"),  # no more than the document has lines
        )
    )
    left = F.col("n_words") - F.col("n_removed_words")
    base = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    return (
        counted.drop("lines", "host")
        .join(removed, "row", "left")
        .na.fill(0, ["n_removed_lines", "n_removed_words"])
        .withColumn("base_failed", base)
        .withColumn(
            "kept", ~F.col("base_failed") & (left >= min_words) & (left >= min_left * F.col("n_words"))
        )
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines whose hashes are listed with them; each goes with the line end behind it."""
    for whole in batches:
        for batch in W.pieces(whole, "text"):
            lists = batch.column("cut")
            data, offsets = W.utf8(batch.column("text"))
            starts, ends, first = W.spans(data, offsets)
            doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
            keep = np.ones(len(data), bool)
            if len(starts):
                breaks = np.flatnonzero(data == 0x0A)
                line = np.searchsorted(breaks, starts) + doc
                firsts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
                owner = doc[firsts]
                normal = W.sequence_hashes(W.hashes(data, starts, ends, W.LOWER), firsts)
                salt = np.uint64(0x9E3779B97F4A7C15)
                listed = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
                gone = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                hit = np.isin(W.mix(normal + owner.astype(np.uint64) * salt), W.mix(gone + listed.astype(np.uint64) * salt))
                at = starts[firsts[hit]]
                before = np.concatenate([[0], breaks + 1])[np.searchsorted(breaks, at)]
                after = np.append(breaks + 1, len(data))[np.searchsorted(breaks, at)]
                edge = np.zeros(len(data) + 1, np.int32)
                np.add.at(edge, np.maximum(before, offsets[owner[hit]]), 1)
                np.add.at(edge, np.minimum(after, offsets[owner[hit] + 1]), -1)
                keep = np.cumsum(edge[:-1]) == 0
            left = np.concatenate([[0], np.cumsum(keep)])[offsets]
            text = pa.LargeStringArray.from_buffers(
                len(offsets) - 1, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(data[keep])
            )
            text = pc.if_else(pc.is_null(batch.column("text")), None, text.cast(pa.string()))
            names = batch.schema.names
            yield batch.drop_columns(["text", "cut"]).append_column("text", text).select([n for n in names if n != "cut"])


def cleaned(spark: SparkSession, docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents that are kept, all columns, their texts without the removed lines.

    A column ``n_chars`` follows the text. Repeated rows stay repeated.
    """
    judged = line_quality(spark, docs, host, **limits).where("kept").select("row", "cut")
    judged = stored(spark, judged.dropDuplicates(["row"]), "kept-rows")
    names = [f"_c{i}" for i in range(len(docs.columns))]
    given = docs.toDF(*names)
    at = dict(zip(docs.columns, names, strict=True))
    key = row_key(F.col(at["doc_id"]), F.col(at[host]), F.col(at["text"]))
    # Merged at any size: a list that can be broadcast today outgrows it with the corpus.
    joined = given.withColumn("_key", key).join(judged.hint("merge"), F.col("_key") == F.col("row"))
    whole = joined.where("cut IS NULL").select(*names)
    part = joined.where("cut IS NOT NULL").select(*[c for c in names if c != at["text"]], F.col(at["text"]).alias("text"), "cut")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in part.drop("cut").schema)
    part = part.mapInArrow(_cut, schema).withColumnRenamed("text", at["text"])
    if "n_chars" in at:
        size = F.char_length(at["text"]).cast(docs.schema["n_chars"].dataType)
        part = part.withColumn(at["n_chars"], size)
    return whole.unionByName(part).toDF(*docs.columns)
