"""Shard placement by a weighted hash tree of regions, racks and shards.

A document descends the tree. At each node every child draws a number from the
document's key and the child's name, ``-ln(u) / weight`` with u even in (0, 1), and the
smallest draw wins, so a child wins in proportion to its weight. A draw depends on
nothing but its child: when a weight changes, documents move only into or out of that
subtree. A shard is added as a region of its own weight, so one more shard takes
documents only into itself and no others move. (Inside a rack it would raise the weights above it, and
what those draw would be dealt to its neighbours too.) So the shards that a store was first laid out with, its
``base``, belong to the placement as the key and the number of shards do, and a store keeps them as it grows.

Places in a shard are counted without sorting a shard in one task: keys are dealt
to buckets of about ``bucket`` rows, counted there, and the buckets' sizes added up.

Defined results: a null text counts as empty. A document without an id is placed by its
text. Repeated rows share a shard and have places of their own. Other columns are
ignored. No rows in, no rows out; a subtree of weight 0 gets nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.work import stored


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; its weight is that of the shards below it."""

    name: int
    children: tuple[Node, ...] = ()
    own: float = 0.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own


def tree(
    shards: int, base: int | None = None, racks: int = 3, per_rack: int = 4, weights: dict[int, float] | None = None
) -> tuple[Node, ...]:
    """Regions of full racks for the ``base`` shards first laid out; every later shard is a region of its own.

    What the base has beyond full regions are regions of one shard too. With one base the tree of
    n + 1 shards is the grown tree of n, for every n from the base on; without one all shards are the base.
    """
    base, weights = shards if base is None else base, weights or {}
    if base > shards:
        raise ValueError(f"{shards} shards cannot hold a base of {base}")
    shard = lambda i: Node(i, own=weights.get(i, 1.0))
    region = racks * per_rack
    out = []
    for r in range(base // region):
        first = r * region
        of_rack = [range(first + k * per_rack, first + (k + 1) * per_rack) for k in range(racks)]
        out.append(Node(r, tuple(Node(k, tuple(map(shard, ids))) for k, ids in enumerate(of_rack))))
    root = tuple(out)
    for i in range(base // region * region, shards):
        root = grown(root, i, weights.get(i, 1.0))
    return root


def grown(root: tuple[Node, ...], shard: int, weight: float = 1.0) -> tuple[Node, ...]:
    """The tree with one more shard, in a new region."""
    name = max((r.name for r in root), default=-1) + 1
    return (*root, Node(name, (Node(0, (Node(shard, own=weight),)),)))


def _literal(nodes: tuple[Node, ...]) -> Column:
    """Nested arrays of (name, weight, children); nodes without weight are left out."""

    def one(n: Node) -> Column:
        fields = [F.lit(n.name).alias("name"), F.lit(float(n.weight)).alias("weight")]
        if n.children:
            fields.append(_literal(n.children).alias("children"))
        return F.struct(*fields)

    return F.array(*[one(n) for n in nodes if n.weight > 0])


def _winner(children: Column, key: Column, level: str) -> Column:
    """The child with the smallest draw."""

    def draw(c: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(level), c["name"]), 11) + F.lit(0.5)) * F.lit(2.0**-53)
        return F.struct((-F.log(u) / c["weight"]).alias("draw"), c["name"].alias("name"))

    best = F.array_min(F.transform(children, draw))["name"]
    return F.filter(children, lambda c: c["name"] == best)[0]


def place(df: DataFrame, key: str, root: tuple[Node, ...], into: str) -> DataFrame:
    """Add the shard that the tree gives to the key. Racks are named within their region."""
    region = _winner(_literal(root), F.col(key), "region")
    rack_key = F.xxhash64(F.col(key), F.col("_region.name"))
    rack = _winner(F.col("_region.children"), rack_key, "rack")
    shard_key = F.xxhash64(rack_key, F.col("_rack.name"))
    shard = _winner(F.col("_rack.children"), shard_key, "shard")["name"]
    return (
        df.withColumn("_region", region).withColumn("_rack", rack).withColumn(into, shard).drop("_region", "_rack")
    )


def shard_documents(
    spark: SparkSession,
    docs: DataFrame,
    shards: int = 24,
    root: tuple[Node, ...] | None = None,
    bucket: int = 50_000,
    base: int | None = None,
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, grown_shard of every row.

    ``slot`` counts from 0 in each shard without gaps. ``grown_shard`` is the place with one more shard, the same
    that a call with this base and one more shard gives.
    """
    root = root or tree(shards, base)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("doc_id").isNull(), F.xxhash64(text, F.lit("text")))
        .otherwise(F.xxhash64(F.col("doc_id").cast("long")))
        .alias("key"),
    )
    # Repeated rows are one row with a count until the end.
    merged = rows.groupBy("doc_id", "size", "text_crc32", "key").agg(F.count("*").alias("n"))
    placed = place(place(merged, "key", root, "shard"), "key", grown(root, shards), "grown_shard")
    placed = stored(spark, placed, "shard-places")

    full = placed.groupBy("shard").agg(F.ceil(F.count("*") / bucket).alias("buckets"))
    dealt = placed.join(F.broadcast(full), "shard").withColumn(  # a row per shard
        "bucket", F.pmod(F.shiftrightunsigned("key", 20), F.col("buckets"))
    )
    sizes = dealt.groupBy("shard", "bucket").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = (
        Window.partitionBy("shard", "bucket")
        .orderBy("key", "doc_id", "text_crc32", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.coalesce(F.sum("n").over(inside), F.lit(0)) + F.col("offset")
    return (
        dealt.join(offsets, ["shard", "bucket"])
        .withColumn("first", first)
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .select(
            "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("copy")).alias("slot"), "grown_shard"
        )
    )
