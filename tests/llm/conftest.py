import random

import pytest

#: Columns that operators use themselves, to clash with.
CLASHES = ["row", "key", "size", "n", "host", "target", "shard", "kind", "copies", "_text", "node", "file", "count"]


@pytest.fixture(scope="session")
def words():
    draw = random.Random(5)
    return ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9))) for _ in range(400)]


@pytest.fixture(scope="session")
def make(spark):
    """Rows (doc_id, text, lang, source) as a table with the columns of documents and some that clash."""

    def table(rows, parts=3):
        full = [(i, t, lang, source, len(t or ""), *["x"] * len(CLASHES)) for i, t, lang, source in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, "
        return spark.createDataFrame(full, schema + ", ".join(f"{c} string" for c in CLASHES)).repartition(parts)

    return table


@pytest.fixture(scope="session")
def messy(words):
    """Null and empty fields, white space only, one very long word and text, ties and repeated rows."""
    draw = random.Random(9)
    prose = " ".join(draw.choices(words, k=120))
    long = "\n".join(" ".join(draw.choices(words, k=20)) for _ in range(3000))
    return [
        (1, prose, "en", "a"),
        (1, prose, "en", "a"),
        (2, prose, "en", None),
        (3, None, "en", "a"),
        (4, "", None, "b"),
        (5, " \t\r\n \x0b\x0c", "de", "b"),
        (None, prose, None, None),
        (None, "x", "en", "a"),
        (6, "ß" * 100_000, "de", "b"),
        (7, long, "en", "a"),
        (8, "One two three", "en", "\U0001f600"),
        (9, "é \U0001f600 ǅ İ <|endoftext|> it's 12", "fr", "￿"),
        (10, "one TWO three", "en", "a"),
        (-5, prose + " tail", "en", "a"),
    ]
