import random

import numpy as np
import pytest

from tidegate.llm.jaccard import jaccard_join, overlaps


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = low.split(" ") if low.strip(" ") else []
    ws = [w for w in ws if w]
    return frozenset(tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))) if ws else frozenset()


def naive(rows, percent=80):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(s), least[find(k)], links[k]) for k, (i, s) in enumerate(sets))


def family(draw, words, size, length, edits):
    base = draw.choices(words, k=length)
    out = []
    for _ in range(size):
        text = list(base)
        for _ in range(draw.randint(0, edits)):
            text[draw.randrange(len(text))] = draw.choice(words)
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def rows(words):
    draw = random.Random(3)
    line = " ".join(draw.choices(words, k=25))
    texts = []
    for _ in range(12):
        texts += family(draw, words, draw.randint(1, 6), draw.randint(3, 90), 2)
    texts += family(draw, words, 60, 60, 3)  # one large group
    texts += [texts[0]] * 40  # exact copies
    texts += [line + " " + " ".join(draw.choices(words, k=30)) for _ in range(40)]  # a line in common
    texts += ["", "a", "A", "a b", "a b c d e", "A b C d e"]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(
    "limits",
    [
        {},
        {"group": 4, "block": 7, "block_entries": 50, "code_entries": 200, "frequent": 5},  # all is cut up
        {"group": 2, "grams": 300, "frequent": 1},
    ],
)
def test_random_documents(spark, make, rows, limits):
    got = jaccard_join(spark, make([(i, t, "en", "s") for i, t in rows], parts=5), **limits)
    assert sorted(tuple(r) for r in got.collect()) == naive(rows)


def test_overlaps():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 300, n).astype(np.uint64)) for n in draw.integers(1, 200, 90)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = overlaps(sets)
    np.fill_diagonal(got, 0)
    np.fill_diagonal(want := np.array(want), 0)
    assert (got == want).all()


def test_odd_rows(spark, make, messy):
    got = {r["doc_id"]: r for r in jaccard_join(spark, make(messy)).collect()}
    assert got[1]["component_id"] == got[2]["component_id"] == got[-5]["component_id"] == -5
    assert got[3]["n_shingles"] == got[4]["n_shingles"] == got[5]["n_shingles"] == 0
    assert (got[3]["component_id"], got[3]["n_links"]) == (3, 0)
    assert got[8]["component_id"] == got[10]["component_id"] == 8
    assert got[6]["n_shingles"] == 1
    assert jaccard_join(spark, make(messy)).count() == len(messy)


def test_empty_table(spark, make):
    assert jaccard_join(spark, make([])).collect() == []


def test_equal_codes_of_one_set_are_counted_apart():
    """Shingles of a set that agree in their four bytes count each, however often the set arrives."""
    import pyarrow as pa

    from tidegate.llm.jaccard import _shared

    sets = {1: [7, 7, 9, 11], 2: [7, 9], 3: [5, 5]}
    arrivals = [1, 2, 1, 3]  # the first set from two tasks
    table = pa.table({
        "codes": [np.array([c for n in arrivals for c in sets[n]], np.uint32).tobytes()],
        "nodes": [np.array(arrivals, np.int64).tobytes()],
        "counts": [np.array([len(sets[n]) for n in arrivals], np.int32).tobytes()],
    })
    out = _shared(1)(table)
    nodes = np.frombuffer(out.column("nodes")[0].as_py(), np.int64)
    shared = np.frombuffer(out.column("shared")[0].as_py(), np.int32)
    assert dict(zip(nodes.tolist(), shared.tolist())) == {1: 3, 2: 2}
