import hashlib
import random

import numpy as np

from tidegate.llm import sha256
from tidegate.llm.merkle import leaf, manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def naive_tree(leaves):
    """The root, and per leaf its siblings and slots level by level."""
    ways = [[] for _ in leaves]
    nodes, owners = list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        above, above_owners = [], []
        for a in range(0, len(nodes), 3):
            run = nodes[a : a + 3]
            for k in range(len(run)):
                for i in owners[a + k]:
                    ways[i].append((run[:k], run[k + 1 :]))
            above.append(h(*run))
            above_owners.append([i for o in owners[a : a + 3] for i in o])
        nodes, owners = above, above_owners
    return nodes[0], ways


def naive(rows):
    """(doc_id, source, leaf, subroot, root, proof, folded) of each (doc_id, source, leaf, claimed)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees.append(naive_tree([r[2] for r in by[s]]))
    root, tops = naive_tree([t[0] for t in trees])
    out = []
    for s, (subroot, ways), top in zip(order, trees, tops):
        for r, way in zip(by[s], ways):
            folded = r[3]
            for left, right in [*way, *top]:
                folded = h(*left, folded, *right)
            proof = h(*[x for left, right in [*way, *top] for x in left + right])
            out.append((r[0], s, r[2], subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def check(spark, rows):
    given = spark.createDataFrame(rows, "doc_id long, source string, leaf string, claimed string").repartition(3)
    got = manifest(spark, given).drop("place")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == naive(rows)


def rows_of(sizes, seed=1):
    draw = random.Random(seed)
    out = []
    for source, n in sizes.items():
        for i in draw.sample(range(-(10**12), 10**12), n):
            own = h(str(i))
            out.append((i, source, own, own if draw.random() < 0.5 else h("other", str(i))))
    return out


def test_states_resume():
    draw = random.Random(3)
    digests = [[h(str(draw.random())) for _ in range(draw.randint(0, 5))] for _ in range(40)]
    for d in digests:
        state = sha256.started(1)
        for x in d:
            words = sha256.to_words(np.frombuffer(bytes.fromhex(x), np.uint8).reshape(1, 32))
            state = sha256.absorb(state, sha256.hex_blocks(words))
        state = sha256.absorb(state, sha256.last_blocks(np.array([len(d)])))
        assert sha256.to_bytes(state)[0].tobytes().hex() == h(*d)


def test_sizes_around_chunks(spark):
    """A hot source of several chunks and rounds, sources that end at, before and behind a chunk, single rows."""
    check(spark, rows_of({"hot": 900, "a": 1, "b": 3, "c": 243, "d": 244, "é": 729, None: 10, "": 1}))


def test_many_sources(spark):
    check(spark, rows_of({f"s{k}": 1 + k % 4 for k in range(300)}))


def test_one_source_and_one_row(spark):
    check(spark, rows_of({"a": 28}))
    check(spark, rows_of({None: 1}))
    check(spark, [(1, "a", h("x"), h("y"))])


def test_repeated_and_missing_ids(spark):
    same = (7, "a", h("same"), h("same"))
    check(spark, [same] * 40 + [(None, "a", h("n"), h("n")), (None, None, h("m"), h("k")), (7, "a", h("b"), h("b"))])


def test_empty_table(spark):
    given = spark.createDataFrame([], "doc_id long, source string, leaf string, claimed string")
    assert manifest(spark, given).collect() == []


def test_leaves_of_odd_rows(spark, make, messy):
    docs = make(messy)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    got = docs.select(*fields, leaf(*[docs[c] for c in fields]).alias("leaf")).collect()
    for r in got:
        parts = ["-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in fields]
        assert r["leaf"] == h(*parts)
    made = docs.select("doc_id", "source", leaf(*[docs[c] for c in fields]).alias("leaf"))
    rows = [(r["doc_id"], r["source"], r["leaf"], r["leaf"]) for r in made.collect()]
    assert manifest(spark, made.withColumn("claimed", made["leaf"])).where("verified").count() == len(rows)
