import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import cells, hardneg
from tidegate.llm.hardneg import Codes, Rotation, encode, hard_negatives
from tidegate.llm.nearest import nearest

WIDTH = 16
SCHEMA = "vec_id long, embedding array<float>, label int, id long, ids string, bucket string, rank string, _i string"


def table(spark, rows, parts=3):
    full = [(i, v, label, 1, "x", "x", "x", "x") for i, v, label in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def vectors(n, seed, width=WIDTH):
    draw = np.random.default_rng(seed)
    out = draw.standard_normal((n, width)).astype(np.float32)
    return (out / np.linalg.norm(out, axis=1, keepdims=True)).tolist()


#: Rows that take no part, and some that are odd but do.
ODD = [
    (1001, None, 1),
    (1002, [0.5] * (WIDTH - 1) + [None], 1),
    (1003, [0.5] * (WIDTH - 1) + [float("nan")], 1),
    (1004, [0.5] * (WIDTH - 1) + [float("inf")], 1),
    (1005, [3e38] * WIDTH, None),
    (None, [0.1] * WIDTH, 1),
    (1006, [0.25] * 3, 2),
    (1007, [0.25] * 3 + [0.0] * (WIDTH - 3), 2),
    (1008, [-0.25] * WIDTH, 3),
]


def usable(rows, labelled):
    """One row per id: (padded vector, label)."""
    out = {}
    for i, v, label in rows:
        if i is None or v is None or labelled and label is None:
            continue
        if any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [*(float(np.float32(x)) for x in v), *[0.0] * (WIDTH - len(v))]
        out[i] = min(out[i], (label, whole)) if i in out else (label, whole)
    return out


def naive_negatives(rows, every=5):
    found = {i: (label, [int(np.floor(256 * x)) for x in v]) for i, (label, v) in usable(rows, True).items()}
    out = []
    for a, (own, q) in found.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(q, v)) for i, (_, v) in found.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if found[i][0] == own][:5]:
            fits = [i for i in order if found[i][0] != own and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fits[:3])]
    return sorted(out)


def mined(spark, rows, every=5):
    got = hard_negatives(spark, table(spark, rows), F.col("vec_id") % every == 0)
    return sorted(tuple(r) for r in got.collect())


def test_intervals_hold():
    """The score of every pair lies in its interval, and the intervals are narrow enough to drop most pairs."""
    for width in (5, 64, 100):
        rows = np.floor(256 * np.array(vectors(300, width, width)))
        rotation = Rotation(width, 3)
        rotated = rotation(rows)
        assert np.allclose(rotated @ rotated.T, rows @ rows.T)
        codes = Codes(*encode(rotated, 5))
        for a in range(40):
            low, high = codes.interval(rotated[a], 8)
            score = rows @ rows[a]
            assert (low <= score).all() and (score <= high).all()
            if width == 64:
                assert (high - low).mean() < 0.35 * 65536


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "_ANCHORS", 16)  # several cells on each side
    monkeypatch.setattr(hardneg, "_ROWS", 40)
    draw = random.Random(2)
    rows = [(i, v, draw.randint(0, 3)) for i, v in enumerate(vectors(240, 1))]
    rows += [(300 + i, rows[7][1], i % 2) for i in range(80)]  # a vector with a quarter of all rows
    rows += rows[:3] + [(4, rows[9][1], 0)] + ODD
    want = naive_negatives(rows)
    assert len(want) > 100
    assert mined(spark, rows) == want


def test_large_components(spark):
    """Scores beyond 2**53 are still exact; rows whose scores would not fit a long take no part."""
    rows = [(i, [x * 3e5 for x in v], i % 2) for i, v in enumerate(vectors(30, 4))]
    kept = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    got = mined(spark, rows + [(50, [1e30] * WIDTH, 0)])
    assert got == naive_negatives(kept) and got


def test_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(5, [1.0] * WIDTH, 1)]) == []
    assert mined(spark, ODD[:6]) == []


@pytest.mark.parametrize("copies", [0, 150])
def test_nearest(spark, copies):
    rows = [(i, v, 0) for i, v in enumerate(vectors(700, 6))]
    rows += [(1100 + i, rows[40][1], 0) for i in range(copies)] + rows[:2] + ODD + [(1009, [0.0] * WIDTH, 0)]
    found = {i: np.array(v) for i, (_, v) in usable([(i, v, 0) for i, v, _ in rows], False).items() if any(v)}
    got = defaultdict(list)
    for r in nearest(spark, table(spark, rows), F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == sorted(i for i in found if i % 20 == 0)
    hits = total = 0
    for q, listed in got.items():
        listed.sort()
        assert [r for r, _, _ in listed] == list(range(1, 21))
        for _, i, s in listed:
            assert abs(s - float(found[q] @ found[i])) <= 1e-14 * float(np.abs(found[q]) @ np.abs(found[i]))
        assert listed == sorted(listed, key=lambda x: (-x[2], x[1]))
        assert q not in {i for _, i, _ in listed}
        score = {i: float(found[q] @ v) for i, v in found.items() if i != q}
        last = sorted(score.values(), reverse=True)[19]
        hits += sum(s >= last - 1e-9 for _, _, s in listed)
        total += 20
    assert hits >= 0.9 * total
    if copies:  # equal scores go by id
        first = [i for _, i, _ in got[40]]
        assert first == [1100 + k for k in range(20)]


def test_nearest_of_few_rows(spark):
    assert nearest(spark, table(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    assert nearest(spark, table(spark, [(20, [1.0] * WIDTH, 0)]), F.col("vec_id") % 20 == 0).collect() == []
    two = table(spark, [(20, [2.0] + [0.0] * 15, 0), (21, [-1.0] * WIDTH, 0)])
    assert [tuple(r) for r in nearest(spark, two, F.col("vec_id") % 20 == 0).collect()] == [(20, 1, 21, -2.0)]


def test_cells_meet_every_pair_of_a_group_once(spark):
    left = spark.range(50).selectExpr("id", "id % 3 AS g")
    right = spark.range(100, 170).selectExpr("id", "id % 4 AS g")

    def pairs(a, b):
        import pyarrow as pa

        x, y = np.meshgrid(cells.numbers(a, "id"), cells.numbers(b, "id"))
        return pa.table([pa.array(x.ravel()), pa.array(y.ravel())], ["a", "b"])

    for keys, fits in ((["g"], lambda a, b: a % 3 == b % 4), ([], lambda a, b: True)):
        met = cells.met(spark, left, right, keys, ("id", "id"), (7, 11), pairs, "a long, b long").collect()
        assert sorted(map(tuple, met)) == sorted((a, b) for a in range(50) for b in range(100, 170) if fits(a, b))
