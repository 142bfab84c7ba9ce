import random
from collections import defaultdict

from tidegate.llm.mixture import mix, targets

WEIGHTS = (5, 2, 1)


def naive_targets(sizes, limit=3.0):
    """Share by weight; what is above a limit is shared again, until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(order)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(limit * sizes[s] for s in full)
        rest = [s for s in order if s not in full]
        out = {s: limit * sizes[s] for s in full} | {
            s: left * weight[s] / sum(weight[x] for x in rest) for s in rest
        }
        above = {s for s in rest if out[s] > limit * sizes[s] + 1e-9}
        if not above:
            return out
        full |= above


def test_targets(spark):
    draw = random.Random(3)
    for k in range(6):
        sizes = {s: draw.choice([0, 1, 10, 1000, draw.randint(1, 10**6)]) for s in draw.sample(["a", "B", "ä", "", None, "z", "￿", "\U0001f600"], k + 3)}
        sizes["a"] = 7
        rows = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), WEIGHTS, 3.0)
        got = {r["source"]: r["target"] for r in rows.collect()}
        want = naive_targets(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_the_mix(spark, make, words):
    draw = random.Random(5)
    rows = []
    for i in range(1500):
        source = draw.choice(["a"] * 8 + ["b", "c", "d", None])
        n = draw.choice([0, 1, 5, 20, 60, 300])
        rows.append((i, " ".join(draw.choices(words, k=n)), "en", source))
    got = mix(spark, make(rows)).collect()
    by = defaultdict(lambda: [0, 0, 0.0])
    copies = defaultdict(set)
    for r in got:
        text, source = rows[r["doc_id"]][1], rows[r["doc_id"]][3]
        assert r["size"] == len(text.split())
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        by[source][0] += r["size"]
        by[source][1] += r["taken"]
        by[source][2] = r["target"]
        assert r["source_size"] == sum(len(t.split()) for _, t, _, s in rows if s == source)
        copies[source].add(r["copies"])
    want = naive_targets({s: v[0] for s, v in by.items()})
    missed = []
    for source, (_, taken, target) in by.items():
        assert abs(target - want[source]) < 1e-6 * target
        # A draw that keeps expectations can miss by part of a large document where the smaller ones have no room.
        assert abs(taken - target) <= max(0.01 * target, 150)
        missed.append(abs(taken - target))
        assert max(copies[source]) - min(copies[source]) <= 1  # one whole part, and one more or not
    assert sorted(missed)[len(missed) // 2] <= 1  # as a rule by less than a word
    again = mix(spark, make(rows, parts=7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_expectations(spark, make, words):
    """Every document is taken as often as its part says: 60 sources of the same sizes are 60 draws."""
    sizes = [1 + (i * 7) % 40 for i in range(30)]
    rows = [(s * 100 + i, " ".join(words[:n]), "en", f"s{s}") for s in range(60) for i, n in enumerate(sizes)]
    by_place, by_source = defaultdict(int), defaultdict(int)
    for seed in (1, 2):
        for r in mix(spark, make(rows), weights=(1,), total=0.57, seed=seed, arity=4).collect():
            assert abs(r["target"] - 0.57 * sum(sizes)) < 1e-6
            by_place[r["doc_id"] % 100] += r["copies"]
            by_source[seed, r["doc_id"] // 100] += r["taken"]
    mean, spread = 120 * 0.57, 120 * 0.57 * 0.43
    chi = sum((by_place[i] - mean) ** 2 / spread for i in range(30))
    assert chi < 59.7  # the 0.999 quantile for 30
    large = sum(by_place[i] for i, n in enumerate(sizes) if n > 30)
    count = sum(n > 30 for n in sizes)
    assert abs(large - count * mean) < 4 * (count * spread) ** 0.5
    # What a source misses is about a small document, not a large one.
    missed = sorted(abs(t - 0.57 * sum(sizes)) for t in by_source.values())
    assert missed[len(missed) // 2] < 4 and missed[-1] < max(sizes)


def test_odd_rows(spark, make, messy):
    got = mix(spark, make(messy)).collect()
    assert len(got) == len(messy)
    assert all(r["taken"] == 0 for r in got if r["doc_id"] in (3, 4, 5))
    assert len({r["copies"] for r in got if r["doc_id"] == 1}) == 1


def test_a_single_document_and_none(spark, make):
    one = mix(spark, make([(1, "a b c", "en", "s")])).first()
    assert (one["size"], one["target"], one["copies"], one["taken"]) == (3, 3.0, 1, 3)
    assert mix(spark, make([])).collect() == []
    empty = mix(spark, make([(1, None, "en", "s"), (2, "", "en", None)])).collect()
    assert [r["taken"] for r in empty] == [0, 0]
