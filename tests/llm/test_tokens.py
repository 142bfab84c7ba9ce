import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidegate.llm import simple8b
from tidegate.llm.queries import tokenizer_file
from tidegate.llm.tokens import Encoder, Reader, Writer, read_tokens, token_round_trip, write_tokens

PATH = tokenizer_file("word_bpe_49k.json")


@settings(deadline=None, max_examples=60)
@given(
    st.lists(
        st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 64), st.integers(1, 400)), max_size=60
    )
)
def test_any_numbers_come_back(runs):
    values = np.array([v >> (64 - b) if b else 0 for v, b, n in runs for _ in range(n)], np.uint64)
    assert (simple8b.decode(simple8b.encode(values)) == values).all()


def test_words_hold_as_many_values_as_fit():
    assert sum(len(b[1]) for b in simple8b.encode(np.zeros(8192, np.uint64))) == 8 * 69
    assert sum(len(b[1]) for b in simple8b.encode(np.full(6000, 2**20 - 1, np.uint64))) == 8 * 2000


def naive(rows, end=2):
    tokenizer = Tokenizer.from_file(PATH)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, out = 0, []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD = ["It's 'S don'T we'Ll", "<|startoftext|> x<|endoftext|>y", "a\x1cb\x85c\xa0d e", "12ab3 ab-c_d é́ ΑΣ ǅİ", "'", "<", "a\x00b"]


def test_ids_are_the_tokenizers(words):
    texts = [*ODD, " ".join(words), "", None, "A1b2,,,c  \n\tD."]
    ids, n = Encoder(PATH)(pa.array(texts))
    tokenizer = Tokenizer.from_file(PATH)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == sum(want, [])


def test_round_trip(spark, make, messy):
    rows = messy + [(100 + k, t, "en", "s") for k, t in enumerate(ODD)]
    got = sorted(tuple(r) for r in token_round_trip(spark, make([r for r in rows if r[0] is not None]), PATH).collect())
    assert got == sorted(naive([(i, t) for i, t, _, _ in rows if i is not None]))
    everything = token_round_trip(spark, make(rows), PATH).collect()
    assert sorted((r["start"], r["n_tokens"], r["ids_crc32"]) for r in everything) == sorted(
        x[1:] for x in naive([(i, t) for i, t, _, _ in rows])
    )


def test_empty_table(spark, make):
    assert token_round_trip(spark, make([]), PATH).collect() == []


def test_blocks_are_found_by_their_offsets(tmp_path):
    values = np.random.default_rng(1).integers(0, 50_000, 50_000).astype(np.uint64)
    with pafs.LocalFileSystem().open_output_stream(str(tmp_path / "f")) as stream:
        writer = Writer(stream)
        writer.add([1, 2], np.array([20_000, 30_000]), values)
        writer.close()
    with pafs.LocalFileSystem().open_input_file(str(tmp_path / "f")) as source:
        reader = Reader(source)
        assert (np.concatenate(list(reader.values(3, 5))) == values[3 * 8192 : 5 * 8192]).all()
        assert reader.docs["n"].tolist() == [20_000, 30_000]


def test_a_broken_file_is_refused(spark, make, tmp_path):
    folder = str(tmp_path)
    files = write_tokens(spark, make([(1, "a b c", "en", "s")]), folder, PATH, partitions=1)
    assert read_tokens(spark, files, folder).count() == 1
    name = os.path.join(folder, files.first()["file"])
    raw = open(name, "rb").read()
    open(name, "wb").write(raw[:-1])
    with pytest.raises(Exception, match="not a token file|not fit"):
        read_tokens(spark, files, folder).collect()
