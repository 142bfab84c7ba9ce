"""Token ids of documents in Simple-8b files, in ascending order of id.

Documents are dealt to ranges of ids; each range is one file, and the files' names sort like the
ranges. A file has a header, its blocks, an index and a trailer:

    "TGS8" version:u32
    blocks: words, then escaped values (see ``simple8b``)
    per block: byte offset u64, values u32, words u32, escaped values u32
    per document: id i64 (the lowest value for null), ids u64
    offset of the first index u64, blocks u64, documents u64, "TGS8"

Blocks decode on their own and in any order. Documents run on from block to block.
The tokenizer drops white space and joins nothing across it, so each distinct word is encoded once. That,
the cuts below and the byte-level spelling are those of lower-casing tokenizers like the one in use; the
tests hold them against the library.
Words of ASCII and Latin letters are first cut where the tokenizer cuts them: between letters and other signs,
and around each digit; words with other characters, apostrophes or ``<`` go to it whole.

Defined results: a null or empty text has the end id only. Documents without an id come first; equal
ids stand in order of their text. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm import simple8b
from tidegate.llm import words as W
from tidegate.llm.shared_files import filesystem, whole_file
from tidegate.llm.work import stored
from tidegate.sources.files import work_folder

MAGIC, VERSION = b"TGS8", 1
_BLOCK_ENTRY = np.dtype([("at", "<u8"), ("n", "<u4"), ("words", "<u4"), ("escaped", "<u4")])
_DOC_ENTRY = np.dtype([("id", "<i8"), ("n", "<u8")])
_TRAILER = struct.Struct("<QQQ4s")
_NO_ID = -(2**63)
#: Words a task remembers the ids of, and blocks that are coded together.
_KNOWN = 600_000
_TOGETHER = 128


class Encoder:
    """The tokenizer's ids of whole texts, each distinct word encoded once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(_KNOWN * 2, np.int64)
        self.filled = 0

    def _learn(self, pieces: list[bytes]) -> None:
        plain = self.tokenizer.model.tokenize
        hard = [p for p in pieces if not _PLAIN(p)]
        whole = self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in hard], add_special_tokens=False)
        ids = {p: e.ids for p, e in zip(hard, whole, strict=True)}
        lists = [ids[p] if p in ids else [t.id for t in plain(_byte_letters(p))] for p in pieces]
        ends = self.filled + np.cumsum([len(x) for x in lists])
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.filled : ends[-1]] = [i for x in lists for i in x]
        k = len(self.known)
        while k + len(pieces) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.starts[k + 1 : k + 1 + len(pieces)] = ends
        self.known.update(zip(pieces, range(k, k + len(pieces)), strict=True))
        self.filled = int(ends[-1])

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        if len(self.known) > _KNOWN:
            self._forget()
        data, offsets = W.utf8(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        data, starts, firsts = _cut(data, offsets)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]
        ).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        known = self.known
        if unknown := [p for p in distinct if p not in known]:
            self._learn(unknown)
        places = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        at = places[pieces.indices.to_numpy()]
        n = self.starts[at + 1] - self.starts[at]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(self.starts[at] - total[:-1], n) + np.arange(total[-1])]
        return ids, total[firsts[1:]] - total[firsts[:-1]]


def _kinds() -> np.ndarray:
    """Kinds of bytes: 0 white space, 1 letters, 2 digits, 3 other signs, 4 what is left to the tokenizer."""
    out = np.full(256, 4, np.uint8)
    out[33:127] = 3
    for a, b, kind in ((48, 58, 2), (65, 91, 1), (97, 123, 1)):
        out[a:b] = kind
    out[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    out[[ord("'"), ord("<")]] = 4
    return out


_KIND = _kinds()
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
#: Pieces of ASCII and the letters U+00C0 to U+017F that the model takes without the tokenizer's other steps.
_PLAIN = re.compile(
    rb"(?:[!-&(-;=-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\xbf])+"
).fullmatch


def _letters_of_bytes() -> dict[int, int]:
    """The characters that stand for bytes in a byte-level vocabulary: visible ones for themselves, the rest from 256 on."""
    visible = {*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in visible]
    return {b: 256 + k for k, b in enumerate(rest)}


_LETTERS = _letters_of_bytes()


def _byte_letters(piece: bytes) -> str:
    """A plain piece as the model spells it."""
    if piece.isascii():
        return piece.decode()
    return piece.decode().lower().encode().decode("latin-1").translate(_LETTERS)


def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all pieces, plain ones of ASCII in lower case, where each begins, and the pieces before each text."""
    kind = _KIND[data]
    # The letters U+00C0 to U+017F, two bytes each, are letters like those of ASCII; not the signs among
    # them, nor the one that becomes two characters in lower case.
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
    code = (data[lead].astype(np.int64) << 8) | data[lead + 1]
    lead = lead[(code != 0xC397) & (code != 0xC3B7) & (code != 0xC4B0)]
    kind[lead] = kind[lead + 1] = 1
    starts, ends, _ = W.spans(data, offsets)
    # A word with anything hard in it stays as it is.
    hard = np.concatenate([[0], np.cumsum(kind == 4)])
    whole = hard[ends] > hard[starts]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[whole]] += 1
    edge[ends[whole]] -= 1
    plain = np.cumsum(edge[:-1], dtype=np.int8) == 0
    before = np.empty_like(kind)
    before[0], before[1:] = 0, kind[:-1]
    begin = (kind > 0) & plain & ((kind != before) | (kind == 2))
    begin[starts] = True
    places = np.flatnonzero(begin)
    low = np.where(plain, _SMALL[data], data)
    inside = kind > 0
    before = np.concatenate([[0], np.cumsum(inside)])
    return low[inside], np.append(before[places], before[-1]), np.searchsorted(places, offsets)


_encoders: dict[str, Encoder] = {}


def _with_ends(ids: np.ndarray, n: np.ndarray, end: int) -> np.ndarray:
    """Put the end id after each text's ids."""
    return np.insert(ids, np.cumsum(n), end)


class Writer:
    """One file, written block by block."""

    def __init__(self, stream):
        self.stream, self.at = stream, 8
        self.blocks, self.docs, self.rest = [], [], np.zeros(0, np.uint64)
        stream.write(MAGIC + struct.pack("<I", VERSION))

    def add(self, ids: list[int | None], lengths: np.ndarray, values: np.ndarray) -> None:
        entry = np.zeros(len(ids), _DOC_ENTRY)
        entry["id"] = [_NO_ID if i is None else i for i in ids]
        entry["n"] = lengths
        self.docs.append(entry)
        self.rest = np.concatenate([self.rest, values.astype(np.uint64)])
        whole = len(self.rest) // simple8b.BLOCK * simple8b.BLOCK
        self._code(self.rest[:whole])
        self.rest = self.rest[whole:]

    def _code(self, values: np.ndarray) -> None:
        step = simple8b.BLOCK * _TOGETHER
        for a in range(0, len(values), step):
            for n, words, escaped in simple8b.encode(values[a : a + step]):
                self.blocks.append((self.at, n, len(words) // 8, len(escaped) // 8))
                self.stream.write(words + escaped)
                self.at += len(words) + len(escaped)

    def close(self) -> None:
        self._code(self.rest)
        docs = np.concatenate(self.docs) if self.docs else np.zeros(0, _DOC_ENTRY)
        self.stream.write(np.array(self.blocks, _BLOCK_ENTRY).tobytes() + docs.tobytes())
        self.stream.write(_TRAILER.pack(self.at, len(self.blocks), len(docs), MAGIC))


class Reader:
    """One file; only some blocks are in memory at a time."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        at, n_blocks, n_docs, magic = _TRAILER.unpack(self._read(size - _TRAILER.size, _TRAILER.size))
        if magic != MAGIC or self._read(0, 8) != MAGIC + struct.pack("<I", VERSION):
            raise ValueError("not a token file, or not a whole one")
        if at + n_blocks * _BLOCK_ENTRY.itemsize + n_docs * _DOC_ENTRY.itemsize + _TRAILER.size != size:
            raise ValueError("the index does not fit the file")
        self.blocks = np.frombuffer(self._read(at, n_blocks * _BLOCK_ENTRY.itemsize), _BLOCK_ENTRY)
        rest = at + n_blocks * _BLOCK_ENTRY.itemsize
        self.docs = np.frombuffer(self._read(rest, n_docs * _DOC_ENTRY.itemsize), _DOC_ENTRY)

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def values(self, first: int = 0, last: int | None = None) -> Iterator[np.ndarray]:
        """The values of blocks ``first`` to ``last``, some blocks at a time."""
        last = len(self.blocks) if last is None else last
        for a in range(first, last, _TOGETHER):
            part = self.blocks[a : min(a + _TOGETHER, last)]
            begin = int(part["at"][0])
            end = int(part["at"][-1]) + 8 * int(part["words"][-1] + part["escaped"][-1])
            raw = self._read(begin, end - begin)
            yield simple8b.decode(
                [
                    (int(b["n"]), raw[x : x + 8 * int(b["words"])], raw[x + 8 * int(b["words"]) :][: 8 * int(b["escaped"])])
                    for b in part
                    for x in [int(b["at"]) - begin]
                ]
            )


def _write(folder: str, tokenizer: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(tokenizer)
        encoder = _encoders[tokenizer]
        name = f"part-{TaskContext.get().partitionId():06d}.s8b"
        n_docs = n_ids = 0
        with whole_file(folder, name) as stream:
            writer = Writer(stream)
            for whole in batches:
                for batch in W.pieces(whole, "text"):
                    ids, n = encoder(batch.column("text"))
                    writer.add(batch.column("doc_id").to_pylist(), n + 1, _with_ends(ids, n, end))
                    n_docs, n_ids = n_docs + len(n), n_ids + int(n.sum()) + len(n)
            writer.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())], ["file", "docs", "ids"]
        )

    return run


def write_tokens(
    spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, end: int = 2, partitions: int | None = None
) -> DataFrame:
    """Encode and write all documents; returns (file, docs, ids) of the files, stored."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = source.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    written = ranged.mapInArrow(_write(folder, tokenizer, end), "file string, docs long, ids long")
    return stored(spark, written, "token-files").where("docs > 0")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with fs.open_input_file(f"{base}/{name}") as source:
                    reader = Reader(source)
                    ends = np.cumsum(reader.docs["n"].astype(np.int64))
                    starts = ends - reader.docs["n"].astype(np.int64)
                    crc = np.zeros(len(ends), np.int64)
                    d, seen = 0, 0
                    for values in reader.values():
                        data = values.astype("<u4")
                        if (values >> np.uint64(32)).any():
                            raise ValueError("an id of more than 32 bits")
                        until = seen + len(data)
                        while d < len(ends):
                            part = data[max(0, starts[d] - seen) : ends[d] - seen]
                            crc[d] = zlib.crc32(part.tobytes(), int(crc[d]))
                            if ends[d] > until:
                                break
                            d += 1
                        seen = until
                    if d < len(ends) or (len(ends) and seen != ends[-1]):
                        raise ValueError(f"{name} has other ids than its index says")
                    known = pa.array(reader.docs["id"], pa.int64(), mask=reader.docs["id"] == _NO_ID)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(ends)), known, pa.array(starts), pa.array(ends - starts), pa.array(crc)],
                        ["file", "doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return run


def read_tokens(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files, a task per file."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    offsets = files.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    n = max(1, files.count())
    read = (
        files.select("file")
        .repartitionByRange(n, "file")
        .mapInArrow(_read(folder), "file string, doc_id long, start long, n_tokens long, ids_crc32 long")
    )
    return read.join(offsets, "file").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, end: int = 2) -> DataFrame:
    """Write the documents' ids to the shared work folder and read them back."""
    folder = work_folder(spark, "tokens")
    return read_tokens(spark, write_tokens(spark, docs, folder, tokenizer, end), folder)
