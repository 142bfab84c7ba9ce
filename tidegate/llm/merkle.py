"""A Merkle manifest of a dataset: a tree of SHA-256 digests per source and one over the sources.

A leaf hashes the fields of a row. Nodes are hashed in runs of three, as the hex text of their digests, until one
is left; the sources' roots, in order of the source, are hashed likewise. A digest's hex text is one
block of SHA-256, so a parent retains, next to its children, the hash state before each child slot. To fold
a changed leaf into the root, every parent resumes the state before that leaf's slot and absorbs the replacement
and the siblings to the right only.

Rows are ranked within their source by a range partitioning and counts per part, without sorting a source in
one task. The tree is built ``LEVELS`` levels at a time: 3**LEVELS consecutive nodes are a chunk, whose levels are
hashed together and stored as one row, so there are few rounds however many rows a source has, and a
chunk's size is fixed. Then the way from each chunk to the root (slots, retained states, siblings) is handed down the
rounds, and the rows meet their chunks last, in groups of bounded size, to be folded and given their proof.

Defined results: rows ascend by id, null first, equal ids by leaf; repeated rows are leaves of their own. A null
source is a source, the first one. A source of one row has its leaf as root. Other columns
are ignored. No rows in, no rows out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm import cells, sha256
from tidegate.llm.work import stored

ARITY, LEVELS = 3, 5
_WIDTH = ARITY**LEVELS
#: Nodes of a group; a group has whole chunks, so it can have a few times as many.
_GROUP = 8192
#: A step of the way up: slot, number of children, retained state, siblings from left to right.
_STEP = 2 + 32 + 2 * 32
_CHUNK = "tree long, depth int, chunk long, n int, digest binary, digests binary, states binary"


def field(value: Column) -> Column:
    """A field as it is hashed: its length in bytes, a colon and the text, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def _ranked(spark: SparkSession, rows: DataFrame, group: list[str], order: list[str], purpose: str) -> DataFrame:
    """Add ``place``, counted from 0 in each group. Equal rows may stand either way."""
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tie.repartitionByRange(many, *group, *order, "_tie").withColumn("_part", F.spark_partition_id())
    dealt = stored(spark, dealt, purpose)
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    counted = dealt.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    offsets = counted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*group, "_part").orderBy(*order, "_tie")
    place = F.row_number().over(inside).cast("long") - 1 + F.col("_before")
    return dealt.join(offsets, [*group, "_part"]).withColumn("place", place).drop("_part", "_tie", "_before")


def _depth(n: Column) -> Column:
    """Levels above ``n`` nodes until one is left."""
    powers = F.array(*[F.lit(ARITY**k).cast("long") for k in range(40)])
    return F.size(F.filter(powers, lambda p: p < n))


def _group(spark: SparkSession, rows: DataFrame, chunk: Column, groups: int):
    """Rows dealt by chunk to groups. Few bytes are much work here, so partitions must not be merged by bytes."""
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("chunk", chunk).withColumn("_group", F.pmod(F.xxhash64("tree", "chunk"), F.lit(groups)))
    return dealt.repartition(many, "_group").groupBy("_group")


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def _words(table: pa.Table, name: str) -> np.ndarray:
    """A column of 32-byte values as words."""
    raw = b"".join(table.column(name).to_pylist())
    return sha256.to_words(np.frombuffer(raw, np.uint8).reshape(-1, 32))


def _sizes(n: int, levels: int) -> list[int]:
    """Nodes of a chunk on each level, the lowest first."""
    out = [n]
    for _ in range(levels):
        out.append(-(-out[-1] // ARITY))
    return out


def _hashed(children: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of nodes with children (n, 3, 8), and the states before the slots (n, 3, 8)."""
    state = sha256.started(len(counts))
    states = []
    for slot in range(ARITY):
        states.append(state)
        state = np.where((counts > slot)[:, None], sha256.absorb(state, sha256.hex_blocks(children[:, slot])), state)
    return sha256.absorb(state, sha256.last_blocks(counts)), np.stack(states, axis=1)


def _build(done: int):
    """Hash the chunks of a group; ``done`` levels lie below."""

    def run(table: pa.Table) -> pa.Table:
        place, tree = cells.numbers(table, "place"), cells.numbers(table, "tree")
        order = np.lexsort((place, tree))
        place, tree, depth = place[order], tree[order], cells.numbers(table, "depth")[order]
        nodes = _words(table, "digest")[order]
        chunk = place // _WIDTH
        head = np.flatnonzero(np.concatenate([[True], (tree[1:] != tree[:-1]) | (chunk[1:] != chunk[:-1])]))
        tree, depth, chunk = tree[head], depth[head], chunk[head]
        size = np.diff(np.append(head, len(place)))
        levels = np.minimum(LEVELS, depth - done)
        n, digests, states = size.copy(), [[] for _ in head], [[] for _ in head]
        # Nodes of all chunks stand one after another; those of chunks that are done are left out level by level.
        live = np.arange(len(head))
        for level in range(LEVELS + 1):
            ends = np.cumsum(size)
            raw = sha256.to_bytes(nodes)
            for k, c in enumerate(live):
                digests[c].append(raw[ends[k] - size[k] : ends[k]].tobytes())
            on = levels[live] > level
            if not on.any():
                break
            nodes, live, size = nodes[np.repeat(on, size)], live[on], size[on]
            first = np.cumsum(size) - size
            parents = -(-size // ARITY)
            own = np.arange(parents.sum()) - np.repeat(np.cumsum(parents) - parents, parents)
            at = np.repeat(first, parents) + ARITY * own
            counts = np.minimum(ARITY, np.repeat(size, parents) - ARITY * own)
            children = nodes[np.minimum(at[:, None] + np.arange(ARITY), len(nodes) - 1)]
            nodes, kept = _hashed(children, counts)
            ends, kept = np.cumsum(parents), sha256.to_bytes(kept).reshape(len(kept), -1)
            for k, c in enumerate(live):
                states[c].append(kept[ends[k] - parents[k] : ends[k]].tobytes())
            size = parents
        joined = [b"".join(d) for d in digests]
        return pa.table(
            [pa.array(tree), pa.array(depth, pa.int32()), pa.array(chunk), pa.array(n, pa.int32()),
             _binary([d[-32:] for d in joined]), _binary(joined), _binary([b"".join(s) for s in states])],
            ["tree", "depth", "chunk", "n", "digest", "digests", "states"],
        )

    return run


class _Chunk:
    """A stored chunk; ``ways`` gives its children's ways to the root."""

    def __init__(self, n: int, depth: int, done: int, digests: bytes, states: bytes):
        self.sizes = _sizes(n, min(LEVELS, depth - done))
        self.digests = np.frombuffer(digests, np.uint8).reshape(-1, 32)
        self.states = np.frombuffer(states, np.uint8).reshape(-1, ARITY, 32)

    def ways(self, above: bytes) -> np.ndarray:
        """(children, steps, _STEP) bytes, the lowest step first."""
        n, steps = self.sizes[0], len(self.sizes) - 1
        rest = np.frombuffer(above, np.uint8).reshape(-1, _STEP)
        out = np.zeros((n, steps + len(rest), _STEP), np.uint8)
        out[:, steps:] = rest
        node, first, parents = np.arange(n), 0, 0
        for level in range(steps):
            size = self.sizes[level]
            parent, slot = node // ARITY, node % ARITY
            count = np.minimum(ARITY, size - ARITY * parent)
            step = out[:, level]
            step[:, 0], step[:, 1] = slot, count
            step[:, 2:34] = self.states[parents + parent, slot]
            for k in range(ARITY - 1):
                sibling = ARITY * parent + k + (slot <= k)
                there = k < count - 1
                step[there, 34 + 32 * k : 66 + 32 * k] = self.digests[first + sibling[there]]
            node, first, parents = parent, first + size, parents + self.sizes[level + 1]
        return out


def _hand_down(done: int):
    """(tree, chunk, way) of the chunks below, from chunks and their own ways."""

    def run(table: pa.Table) -> pa.Table:
        trees, places, ways = [], [], []
        for row in table.to_pylist():
            found = _Chunk(row["n"], row["depth"], done, row["digests"], row["states"]).ways(row["way"])
            trees += [row["tree"]] * len(found)
            places += range(row["chunk"] * _WIDTH, row["chunk"] * _WIDTH + len(found))
            ways += [w.tobytes() for w in found]
        return pa.table([pa.array(trees, pa.int64()), pa.array(places, pa.int64()), _binary(ways)], ["tree", "chunk", "way"])

    return run


def fold(replacements: np.ndarray, ways: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Roots (n, 8) from replaced leaves (n, 8) and their ways (n, most steps, _STEP)."""
    out = replacements.copy()
    for level in range(ways.shape[1]):
        on = np.flatnonzero(steps > level)
        step = ways[on, level]
        slot, count = step[:, 0].astype(int), step[:, 1].astype(int)
        state = sha256.absorb(sha256.to_words(step[:, 2:34]), sha256.hex_blocks(out[on]))
        siblings = sha256.to_words(step[:, 34:].reshape(len(on), ARITY - 1, 32))
        for k in range(ARITY - 1):  # the siblings from the slot on stand to its right
            right = np.flatnonzero((k >= slot) & (k < count - 1))
            if len(right):
                state[right] = sha256.absorb(state[right], sha256.hex_blocks(siblings[right, k]))
        out[on] = sha256.absorb(state, sha256.last_blocks(count))
    return out


def _proofs(ways: np.ndarray, steps: np.ndarray) -> list[str]:
    there = np.arange(ARITY - 1) < ways[:, :, 1:2].astype(int) - 1
    there &= (np.arange(ways.shape[1]) < steps[:, None])[:, :, None]
    siblings = ways[:, :, 34:].reshape(*ways.shape[:2], ARITY - 1, 32)
    return [hashlib.sha256(s[t].tobytes().hex().encode()).hexdigest() for s, t in zip(siblings, there, strict=True)]


def _verify(rows: pa.Table, chunks: pa.Table) -> pa.Table:
    """Rows with their proofs and folded roots."""
    place, tree = cells.numbers(rows, "place"), cells.numbers(rows, "tree")
    rows = rows.take(pa.array(np.lexsort((place, tree))))
    found = [
        _Chunk(c["n"], c["depth"], 0, c["digests"], c["states"]).ways(c["way"])
        for c in sorted(chunks.to_pylist(), key=lambda c: (c["tree"], c["chunk"]))
    ]
    most = max((f.shape[1] for f in found), default=0)
    ways = np.zeros((rows.num_rows, most, _STEP), np.uint8)
    steps, at = np.zeros(rows.num_rows, int), 0
    for f in found:
        ways[at : at + len(f), : f.shape[1]] = f
        steps[at : at + len(f)] = f.shape[1]
        at += len(f)
    folded = sha256.to_bytes(fold(_words(rows, "claimed"), ways, steps))
    return pa.table(
        [rows.column("id"), rows.column("tree"), rows.column("place"), _binary([d.tobytes() for d in _to_rows(rows)]),
         pa.array(_proofs(ways, steps), pa.string()), _binary([d.tobytes() for d in folded])],
        ["id", "tree", "place", "leaf", "proof_sha256", "folded"],
    )


def _to_rows(rows: pa.Table) -> np.ndarray:
    return sha256.to_bytes(_words(rows, "digest"))


def _forest(spark: SparkSession, nodes: DataFrame, deepest: int) -> tuple[list[DataFrame], DataFrame]:
    """Chunks of each round, and (tree, digest) of the roots, from (tree, depth, place, digest)."""
    rounds, roots = [], None
    for done in range(0, max(1, deepest), LEVELS):
        groups = cells.parts(nodes.count(), _GROUP)
        dealt = _group(spark, nodes, F.floor(F.col("place") / _WIDTH), groups)
        built = stored(spark, dealt.applyInArrow(_build(done), _CHUNK), "merkle-chunks")
        rounds.append(built)
        ended = built.where(F.col("depth") <= done + LEVELS).select("tree", "digest")
        roots = ended if roots is None else roots.unionAll(ended)
        nodes = built.where(F.col("depth") > done + LEVELS).select(
            "tree", "depth", F.col("chunk").alias("place"), "digest"
        )
    return rounds, roots


def _ways(spark: SparkSession, rounds: list[DataFrame], tops: DataFrame, last: int) -> DataFrame:
    """Chunks of round ``last`` with their ways, given (tree, way) of the roots."""
    handed = None
    for r in range(len(rounds) - 1, last - 1, -1):
        done = r * LEVELS
        top = rounds[r].where(F.col("depth") <= done + LEVELS).join(tops, "tree")
        if handed is not None:
            lower = rounds[r].where(F.col("depth") > done + LEVELS).join(handed, ["tree", "chunk"])
            top = top.unionByName(lower)
        if r == last:
            return top
        groups = cells.parts(rounds[r].count(), max(1, _GROUP // _WIDTH))
        dealt = _group(spark, top, F.col("chunk"), groups)
        handed = stored(
            spark, dealt.applyInArrow(_hand_down(done), "tree long, chunk long, way binary"), "merkle-ways"
        )
    raise ValueError("there is no such round")


def manifest(spark: SparkSession, leaves: DataFrame) -> DataFrame:
    """doc_id, source, leaf, place, subroot, root, proof_sha256, folded_root, verified of every row.

    ``leaves`` has doc_id, source, leaf and claimed, the leaf that is folded back; digests are hex text.
    """
    named = F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("0"))  # null is the first source
    rows = stored(
        spark,
        leaves.select(
            F.col("doc_id").cast("long").alias("id"),
            named.alias("name"),
            F.unhex("leaf").alias("digest"),
            F.unhex("claimed").alias("claimed"),
        ),
        "merkle-leaves",
    )
    counted = rows.groupBy("name").agg(F.count("*").alias("n"))
    sources = _ranked(spark, counted, [], ["name"], "merkle-sources").withColumn("depth", _depth(F.col("n")))
    sources = stored(spark, sources.withColumnRenamed("place", "tree"), "merkle-sources")
    placed = _ranked(spark, rows, ["name"], ["id", "digest"], "merkle-ranges").join(
        sources.select("name", "tree", "depth"), "name"
    )
    placed = stored(spark, placed.select("tree", "depth", "place", "id", "digest", "claimed"), "merkle-places")
    deepest, many = sources.agg(F.max("depth"), F.count("*")).first()

    rounds, subroots = _forest(spark, placed.drop("id", "claimed"), deepest or 0)
    subroots = stored(spark, subroots, "merkle-subroots")
    top_depth = 0
    while ARITY**top_depth < many:
        top_depth += 1
    top = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(top_depth).alias("depth"), F.col("tree").alias("place"), "digest"
    )
    top_rounds, root = _forest(spark, top, top_depth)
    top = root.first()
    whole = F.lit(bytes(top["digest"]) if top else None).cast("binary")
    to_sources = _ways(spark, top_rounds, root.select("tree", F.lit(b"").alias("way")), 0)
    groups = cells.parts(top_rounds[0].count(), max(1, _GROUP // _WIDTH))
    tops = _group(spark, to_sources, F.col("chunk"), groups)
    tops = stored(
        spark, tops.applyInArrow(_hand_down(0), "tree long, chunk long, way binary"), "merkle-tops"
    ).select(F.col("chunk").alias("tree"), "way")

    chunks = _ways(spark, rounds, tops, 0)
    groups = cells.parts(placed.count(), _GROUP)
    found = (
        _group(spark, placed, F.floor(F.col("place") / _WIDTH), groups)
        .cogroup(_group(spark, chunks, F.col("chunk"), groups))
        .applyInArrow(_verify, "id long, tree long, place long, leaf binary, proof_sha256 string, folded binary")
    )
    text = lambda c: F.lower(F.hex(c))
    of_source = sources.select("tree", "name").join(subroots.withColumnRenamed("digest", "subroot"), "tree")
    return (
        found.join(of_source, "tree")
        .withColumn("root", whole)
        .select(
            F.col("id").alias("doc_id"),
            F.when(F.col("name") != "0", F.substr("name", F.lit(2))).alias("source"),
            text("leaf").alias("leaf"),
            "place",
            text("subroot").alias("subroot"),
            text("root").alias("root"),
            "proof_sha256",
            text("folded").alias("folded_root"),
            (F.col("folded") == F.col("root")).alias("verified"),
        )
    )
