import hashlib
import io
import struct

import pytest
import zstandard as zstd

from tidegate.llm.warc import ArchiveError, page_round_trip, parse, read_archive, record, write_archive

PAGES = "page_id long, url string, html string, kind string, file string, row string"


def make(i, html, refers_to=None):
    payload = html.encode()
    return record(i, f"http://x.org/{i}", payload, hashlib.sha256(payload).hexdigest(), refers_to)


def archive(records):
    out = io.BytesIO()
    write_archive(out, iter(records))
    return out.getvalue()


def test_records_come_back():
    records = [make(i, f"<p>page {i} " + "same text " * (i % 50) + "</p>") for i in range(500)]
    raw = archive(records)
    assert struct.unpack("<I", raw[:4])[0] == 0x184D2A5D  # a dictionary leads
    assert list(read_archive(io.BytesIO(raw))) == records
    bare = archive(records[:2])
    assert list(read_archive(io.BytesIO(bare))) == records[:2]
    assert list(read_archive(io.BytesIO(b""))) == []


def test_an_uncompressed_dictionary():
    records = [make(i, "some text " * i) for i in range(400)]
    dictionary = zstd.train_dictionary(4096, records)
    packer = zstd.ZstdCompressor(dict_data=dictionary)
    body = dictionary.as_bytes()
    raw = struct.pack("<II", 0x184D2A5D, len(body)) + body + b"".join(map(packer.compress, records))
    assert list(read_archive(io.BytesIO(raw))) == records


def test_broken_archives_are_refused():
    raw = archive([make(i, "text " * 300 + str(i)) for i in range(300)])
    for bad in (raw[:-3], raw + b"junk", raw[:4] + b"\xff\xff\xff\x7f" + raw[8:], raw[:-20] + b"\0" * 20):
        with pytest.raises(ArchiveError):
            list(read_archive(io.BytesIO(bad)))


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/9"),
        lambda r: r.replace(b"WARC-Type: response\r\n", b""),
        lambda r: r.replace(b"WARC-Type: response\r\n", b"WARC-Type: response\r\nWARC-Type: response\r\n"),
        lambda r: r.replace(b"hello", b"hellos"),
        lambda r: r.replace(b"hello", b"jello"),
        lambda r: r[:-1],
        lambda r: r + make(2, "more"),
        lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: revisit"),
        lambda r: r.replace(b"<urn:page:1>", b"<urn:uuid:1>"),
    ],
)
def test_broken_records_are_refused(change):
    good = make(1, "hello")
    assert parse(good)["payload"] == b"hello"
    with pytest.raises(ArchiveError):
        parse(change(good))


def test_revisits(spark):
    long = "x" * 100
    rows = [
        (5, "http://a", long), (3, None, long), (9, "u\r\nv w", long), (None, "z", long), (3, "again", long),
        (1, "s", "short"), (2, "s", "short"), (4, "n", None), (6, "e", ""), (7, "ü", "é" * 50), (8, "", "é" * 50),
        (10, "long", "y" * 3_000_000),
    ]
    df = spark.createDataFrame([(*r, "k", "f", "r") for r in rows], PAGES).repartition(3)
    got = page_round_trip(spark, df, payload=True).collect()
    first = {long: 3, "é" * 50: 7}
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        other = first.get(html)
        refers = other if other is not None and i != other else None
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if refers else "response", refers, None if refers else raw))
    found = [
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
         None if r["payload"] is None else bytes(r["payload"]))
        for r in got
    ]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert page_round_trip(spark, spark.createDataFrame([], PAGES)).collect() == []
