import math
import zlib
from collections import Counter, defaultdict

import xxhash

from tidegate.llm.shards import Node, grown, place, shard_documents, tree


def hashed(*values):
    """Spark's xxhash64 of longs, ints and strings."""
    h = 42
    for v in values:
        if isinstance(v, str):
            raw = v.encode()
        else:
            raw = (v & (2**64 - 1)).to_bytes(8, "little") if not isinstance(v, bool) else b""
        h = xxhash.xxh64_intdigest(raw, seed=h)
    return h - 2**64 if h >= 2**63 else h


def hashed_int(key, level, name):
    """As ``hashed`` with the name as a 4-byte number."""
    h = xxhash.xxh64_intdigest((key & (2**64 - 1)).to_bytes(8, "little"), seed=42)
    h = xxhash.xxh64_intdigest(level.encode(), seed=h)
    return xxhash.xxh64_intdigest(name.to_bytes(4, "little", signed=True), seed=h)


def with_int(key, name):
    h = xxhash.xxh64_intdigest((key & (2**64 - 1)).to_bytes(8, "little"), seed=42)
    h = xxhash.xxh64_intdigest(name.to_bytes(4, "little", signed=True), seed=h)
    return h - 2**64 if h >= 2**63 else h


def walk(key, nodes):
    """The shard of a key, one draw at a time."""
    for level in ("region", "rack", "shard"):
        draws = []
        for c in nodes:
            u = ((hashed_int(key, level, c.name) >> 11) + 0.5) * 2.0**-53
            draws.append((-math.log(u) / c.weight, c.name, c))
        best = min(draws, key=lambda d: d[:2])[2]
        key, nodes = with_int(key, best.name), best.children
    return best.name


def test_places_and_slots(spark, make, words):
    rows = [(i, words[i % 50], "en", "s") for i in range(2000)]
    got = shard_documents(spark, make(rows), 24, bucket=10).collect()
    root = tree(24)
    slots = defaultdict(list)
    for r in got:
        assert r["shard"] == walk(hashed(r["doc_id"]), root)
        assert r["grown_shard"] == walk(hashed(r["doc_id"]), grown(root, 24))
        assert r["grown_shard"] in (r["shard"], 24)
        raw = rows[r["doc_id"]][1].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        slots[r["shard"]].append(r["slot"])
    assert len(slots) == 24
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    moved = sum(r["grown_shard"] == 24 for r in got)
    assert 40 < moved < 130  # about 1 in 25


def test_any_number_of_shards_grows_into_the_new_one(spark):
    """A step moves keys only into the new shard, from any base, over the ends of regions too."""
    ids = spark.range(2000).selectExpr("xxhash64(id) AS k")
    for base, n in ((1, 1), (1, 11), (1, 23), (12, 12), (12, 23), (12, 24), (12, 35), (24, 39)):
        rows = place(place(ids, "k", tree(n, base), "a"), "k", tree(n + 1, base), "b").toPandas()
        assert set(rows["b"][rows["a"] != rows["b"]]) == {n}
        assert sorted(set(rows["b"])) == list(range(n + 1))
        assert rows["b"].value_counts().max() < 3 * 2000 / (n + 1)


def test_the_place_with_one_more_shard(spark, make):
    docs = make([(i, "t", "en", "s") for i in range(600)])
    for n in (11, 23):
        small = {r["doc_id"]: r["grown_shard"] for r in shard_documents(spark, docs, n, base=11).collect()}
        assert small == {r["doc_id"]: r["shard"] for r in shard_documents(spark, docs, n + 1, base=11).collect()}


def test_weights(spark):
    ids = spark.range(20_000).selectExpr("xxhash64(id) AS k")
    heavy = tree(12, weights={0: 12.0, 5: 0.0})
    counts = Counter(r["s"] for r in place(ids, "k", heavy, "s").collect())
    assert counts[5] == 0
    assert abs(counts[0] / 20_000 - 12 / 22) < 0.02
    assert Node(0, own=2.0).weight == 2.0


def test_movement_stays_in_the_subtree(spark):
    """Inside a rack, shards whose rack keeps its weight only swap among themselves."""
    ids = spark.range(5000).selectExpr("xxhash64(id) AS k")
    other = tree(24, weights={0: 1.5, 1: 0.5})
    moved = place(place(ids, "k", tree(24), "a"), "k", other, "b").where("a <> b").collect()
    assert moved and all(r["a"] < 4 and r["b"] < 4 for r in moved)


def test_odd_rows(spark, make, messy):
    got = shard_documents(spark, make(messy), 24, bucket=2).collect()
    assert len(got) == len(messy)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == 1
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got}[3] == (8, 0)


def test_a_third_of_all_rows_the_same(spark, make):
    got = shard_documents(spark, make([(7, "same", "en", "s")] * 400 + [(i, "t", "en", "s") for i in range(800)]))
    assert got.count() == 1200
    assert got.groupBy("shard").agg({"slot": "max", "*": "count"}).where("`max(slot)` + 1 <> `count(1)`").count() == 0


def test_empty_table(spark, make):
    assert shard_documents(spark, make([])).collect() == []
