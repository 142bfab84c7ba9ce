"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary,
itself compressed or not; without enough data to train one there is no such frame. Every record
is one frame that declares its size. A ``response`` record holds the HTTP response with the page; a
``revisit`` record holds the HTTP headers only and names the record with the same payload.

The reader takes archives apart record by record, in memory of about one record, and raises
``ArchiveError`` for a broken frame, a frame whose size is not the declared one, more or less than one
record in a frame, a missing or repeated header, a ``Content-Length`` that is not the length of the
block, an HTTP length or a digest that is not the payload's, or a cut-off archive.

Defined results: a null page is an empty payload. Payloads below ``min_bytes`` are never revisits.
A page without an id revisits an equal page that has one, and is never revisited. Rows that
repeat the smallest id of a payload are all responses. A null or empty address becomes
``about:blank``. Other columns are ignored. An empty table gives no archives and no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import words as W
from tidegate.llm.shared_files import filesystem, whole_file
from tidegate.llm.work import stored
from tidegate.sources.files import work_folder

DICTIONARY_MAGIC = 0x184D2A5D
_ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"
#: Records, and bytes of each, that a dictionary is trained on, and its size.
_SAMPLES, _SAMPLE_BYTES, _DICTIONARY_BYTES = 200, 4096, 32 << 10
_CHUNK = 1 << 16
_ROWS = 4096


class ArchiveError(ValueError):
    """An archive that breaks the format."""


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _id(name: str) -> int | None:
    if not (name.startswith("<urn:page:") and name.endswith(">")):
        raise ArchiveError(f"record id {name!r}")
    inner = name[10:-1]
    return None if inner == "none" else int(inner)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit if it refers to another page."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % len(payload)
    )
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "about:blank"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _name(refers_to))]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.split(b"\r\n"):
        name, colon, value = line.decode().partition(":")
        if not colon or name.lower() in out:
            raise ArchiveError(f"header line {line!r}")
        out[name.lower()] = value.strip()
    return out


def parse(raw: bytes) -> dict:
    """The checked parts of one record."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ArchiveError("no WARC header")
    headers = _headers(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ArchiveError(f"{name} is missing")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4:
        raise ArchiveError("the block has another length than its header says")
    if not rest.endswith(b"\r\n\r\n"):
        raise ArchiveError("the record has no end")
    kind = headers["warc-type"]
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    if kind not in ("response", "revisit") or not gap:
        raise ArchiveError(f"a {kind} record without HTTP headers")
    length = _headers(http.partition(b"\r\n")[2]).get("content-length", "")
    digest = headers.get("warc-payload-digest", "")
    if not length.isdigit() or not digest.startswith("sha256:"):
        raise ArchiveError("no payload length or digest")
    if kind == "response" and (len(payload) != int(length) or hashlib.sha256(payload).hexdigest() != digest[7:]):
        raise ArchiveError("the payload is not the one its headers tell of")
    if kind == "revisit" and (payload or "warc-refers-to" not in headers):
        raise ArchiveError("a revisit with a payload or without a target")
    return {
        "page_id": _id(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri"),
        "payload_bytes": int(length),
        "payload_digest": digest[7:],
        "record_type": kind,
        "refers_to": _id(headers["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def write_archive(stream, records: Iterator[bytes], level: int = 3) -> int:
    """Write records to a stream; returns how many."""
    first = list(itertools.islice(records, _SAMPLES))
    dictionary = None
    try:
        dictionary = zstd.train_dictionary(_DICTIONARY_BYTES, [r[:_SAMPLE_BYTES] for r in first])
    except zstd.ZstdError:
        pass  # too little to train on
    if dictionary is not None:
        body = zstd.ZstdCompressor(level=level).compress(dictionary.as_bytes())
        stream.write(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)
    packer = zstd.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True, write_content_size=True)
    n = 0
    for r in itertools.chain(first, records):
        stream.write(packer.compress(r))
        n += 1
    return n


def read_archive(source) -> Iterator[bytes]:
    """The records of an archive, in order; ``source`` has ``read(n)``."""
    buffer = source.read(_CHUNK)

    def need(n: int) -> None:
        nonlocal buffer
        while len(buffer) < n:
            more = source.read(max(_CHUNK, n - len(buffer)))
            if not more:
                raise ArchiveError("the archive is cut off")
            buffer += more

    dictionary = None
    if buffer:
        need(8)
        magic, size = struct.unpack("<II", buffer[:8])
        if magic == DICTIONARY_MAGIC:
            need(8 + size)
            body, buffer = buffer[8 : 8 + size], buffer[8 + size :]
            if body.startswith(_ZSTD_MAGIC):
                body = zstd.ZstdDecompressor().decompress(body)
            dictionary = zstd.ZstdCompressionDict(body)
    unpacker = zstd.ZstdDecompressor(dict_data=dictionary)
    while True:
        if not buffer:
            buffer = source.read(_CHUNK)
            if not buffer:
                return
        need(4)
        if not buffer.startswith(_ZSTD_MAGIC):
            raise ArchiveError("no frame where one should begin")
        try:
            if len(buffer) < 18:
                buffer += source.read(_CHUNK)
            declared = zstd.frame_content_size(buffer)
            frame, parts = unpacker.decompressobj(), []
            while True:
                parts.append(frame.decompress(buffer))
                if frame.eof:
                    buffer = frame.unused_data
                    break
                buffer = source.read(_CHUNK)
                if not buffer:
                    raise ArchiveError("the archive is cut off")
        except zstd.ZstdError as broken:
            raise ArchiveError(str(broken)) from broken
        out = b"".join(parts)
        if declared != len(out):
            raise ArchiveError("a frame has another length than it declares")
        yield out


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        head = next(batches, None)
        if head is None:
            return

        def records() -> Iterator[bytes]:
            for whole in itertools.chain([head], batches):
                for batch in W.pieces(whole, "html"):
                    columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")]
                    for page_id, url, digest, refers_to, html in zip(
                        *columns, batch.column("html").cast(pa.large_binary()), strict=True
                    ):
                        yield record(page_id, url, html.as_py() or b"", digest, refers_to)

        name = f"part-{TaskContext.get().partitionId():06d}.warc.zst"
        with whole_file(folder, name) as stream:
            n = write_archive(stream, records())
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "records"])

    return run


def write_pages(spark: SparkSession, pages: DataFrame, folder: str, min_bytes: int = 100) -> DataFrame:
    """Write a record for every page, an archive per task; returns (file, records), stored."""
    html = F.coalesce(F.col("html"), F.lit(""))
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
        F.octet_length(html).alias("bytes"),
    )
    # Equal payloads are counted before they are shuffled; only those that repeat are kept.
    repeated = stored(
        spark,
        source.where(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("digest", "first"),
        "repeated-pages",
    )
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    typed = source.join(repeated, "digest", "left").select(
        "page_id", "url", "html", "digest", refers.alias("refers_to")
    )
    return stored(spark, typed.mapInArrow(_write(folder), "file string, records long"), "archives")


def _read(folder: str, payload: bool):
    schema = {
        "page_id": pa.int64(),
        "url": pa.string(),
        "payload_bytes": pa.int64(),
        "payload_digest": pa.string(),
        "record_type": pa.string(),
        "refers_to": pa.int64(),
    } | ({"payload": pa.binary()} if payload else {})

    def pack(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in schema.items()], list(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as source:
                    for raw in read_archive(source):
                        row = parse(raw)
                        if not payload:
                            del row["payload"]
                        rows.append(row)
                        held += len(raw) if payload else 0
                        if len(rows) >= _ROWS or held > 8 << 20:
                            yield pack(rows)
                            rows, held = [], 0
                if rows:
                    yield pack(rows)

    return run


def read_pages(spark: SparkSession, files: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of the records of archives.

    With ``payload`` also the payloads; a revisit's is null.
    """
    schema = (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )
    n = max(1, files.count())
    dealt = files.select("file").repartitionByRange(n, "file")
    return dealt.mapInArrow(_read(folder, payload), schema + (", payload binary" if payload else ""))


def page_round_trip(spark: SparkSession, pages: DataFrame, payload: bool = False) -> DataFrame:
    """Write the pages to archives in the shared work folder and read them back."""
    folder = work_folder(spark, "archives")
    return read_pages(spark, write_pages(spark, pages, folder), folder, payload)
