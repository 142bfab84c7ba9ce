"""N-gram Jaccard join as a blocked sparse matrix product.

The matrix has a row per distinct shingle set and a column per shingle; the product
with its transpose holds the overlap of every two sets. Only the part of it that can
matter is computed, and never as rows of a table:

1. Every set becomes a fingerprint; equal sets are one class from here on.
2. All columns are dealt to blocks by shingle, four bytes an entry, and each block adds up
   how many of a set's shingles stand in another set too. A set needs ``ceil(s * size)`` of
   them to have any partner; most sets have too many shingles of their own and are done.
   (Entries that only look equal in four bytes let a few more through.)
3. Shingles are ordered: rare ones by hash, those often seen by frequency, last.
   Any order gives the same result, so the list of frequent ones may be bounded.
   Two sets with the wanted similarity overlap by at least ``t = ceil(s * size)``, so
   they share one of the first ``size - t + 1`` shingles of each.
   These first columns are dealt to blocks again. Each block adds up, for the
   pairs that share a column of at most ``group`` sets, how many they share; the
   sums are added over the blocks and pairs below the bound that their sizes set are
   discarded. Sets that share a larger column are tied to one of them, without pairs.
4. Connected sets form a family, and every two similar sets are in one. A family's
   whole product is computed by columns, dense where they are full and by postings
   where they are not. A family beyond ``block`` sets or ``grams`` shingles is cut into
   parts, and each pair of parts is a task of its own, so no group is unbounded.

Similarity is exact: ``100 * overlap >= percent * union`` on the whole sets.

Defined results: a text with fewer words than a shingle is one shingle; a null or
wordless text is the empty set, linked with nothing. Documents with equal sets are linked.
A repeated row links with its copies. A document without an id is only compared by
equality. Other columns are ignored; no rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import words as W
from tidegate.llm.components import components
from tidegate.llm.work import stored

#: A frequent shingle is one that stands in this many sets of a window of so many shingles.
_OFTEN = 3
_WINDOW = 2_000_000
#: Rows of a product that are judged at a time.
_STRIP = 256


def _print(grams: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that equal sets share."""
    if not len(grams):
        return 0, 0
    one = W.mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = W.mix(grams + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.pieces(whole, "text"):
                found = [(len(g), *_print(g)) for g in W.shingle_sets(batch.column("text"), width)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in zip(*found, strict=True)]],
                    ["doc_id", "n", "one", "two"],
                )

    return run


def _packed(key: np.ndarray, name: str, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row per key with the columns' values of that key as bytes."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    ends = [*cut[1:], len(key)]
    packed = [[x[order[a:b]].tobytes() for a, b in zip(cut, ends, strict=True)] for x in columns.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(key[cut].astype(np.int64)), *[pa.array(x, pa.binary()) for x in packed]], [name, *columns]
    )


def _unpacked(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype=kind)


def _deal_codes(width: int, blocks: int):
    """All columns: per block the shingles' codes, set after set, and how many each set has there."""

    def send(window: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        grams = np.concatenate([g for _, g in window])
        at = np.repeat(np.arange(len(window)), [len(g) for _, g in window])
        block = ((grams >> np.uint64(40)) % np.uint64(blocks)).astype(np.int64)
        codes = _packed(block, "block", {"codes": grams.astype(np.uint32)})
        each, counts = np.unique(block * len(window) + at, return_counts=True)
        nodes = np.array([node for node, _ in window], np.int64)[each % len(window)]
        runs = _packed(each // len(window), "block", {"nodes": nodes, "counts": counts.astype(np.int32)})
        return pa.RecordBatch.from_arrays(
            [*codes.columns, *runs.columns[1:]], ["block", "codes", "nodes", "counts"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, window, held = set(), [], 0
        for whole in batches:
            for batch in W.pieces(whole, "text"):
                for grams in W.shingle_sets(batch.column("text"), width):
                    node = _print(grams)[0]
                    if not len(grams) or node in seen:
                        continue
                    seen.add(node)
                    window.append((node, grams))
                    held += len(grams)
                    if held >= _WINDOW:
                        yield send(window)
                        seen, window, held = set(), [], 0
        if window:
            yield send(window)

    return run


def _shared(buckets: int):
    """Of one block: per set how many of its shingles another set has; packed by sets."""

    def run(table: pa.Table) -> pa.Table:
        codes = _unpacked(table, "codes", np.uint32)
        names, each = np.unique(_unpacked(table, "nodes", np.int64), return_inverse=True)
        owner = np.repeat(each.astype(np.int32), _unpacked(table, "counts", np.int32))
        order = np.argsort(codes, kind="stable")
        codes, owner = codes[order], owner[order]
        start = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        length = np.diff(np.append(start, len(codes)))
        several = np.minimum.reduceat(owner, start) != np.maximum.reduceat(owner, start)
        # A class that came several times, from several tasks, has all its entries as often. Two shingles of one set
        # with equal codes are two entries, so none is lost.
        arrivals = np.maximum(np.bincount(each, minlength=len(names)), 1)
        found = np.bincount(owner[np.repeat(several, length)], minlength=len(names))
        shared = (found // arrivals).astype(np.int32)
        some = shared > 0
        bucket = (names[some].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        if not len(bucket):
            return pa.table({"bucket": pa.array([], pa.int64()), "nodes": pa.array([], pa.binary()), "shared": pa.array([], pa.binary())})
        return pa.Table.from_batches([_packed(bucket, "bucket", {"nodes": names[some], "shared": shared[some]})])

    return run


def _sum_shared(table: pa.Table) -> pa.Table:
    names, each = np.unique(_unpacked(table, "nodes", np.int64), return_inverse=True)
    total = np.bincount(each, weights=_unpacked(table, "shared", np.int32)).astype(np.int64)
    return pa.table({"node": names, "shared": total})


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that are frequent within a window of sets."""

    def send(window: list[np.ndarray]) -> pa.RecordBatch:
        grams, n = np.unique(np.concatenate(window), return_counts=True)
        grams, n = grams[n >= _OFTEN], n[n >= _OFTEN]
        return pa.RecordBatch.from_arrays([pa.array(W.signed(grams)), pa.array(n.astype(np.int64))], ["gram", "n"])

    window, held = [], 0
    for batch in batches:
        for raw in batch.column("grams"):
            window.append(np.frombuffer(raw.as_py(), np.uint64))
            held += len(window[-1])
            if held >= _WINDOW:
                yield send(window)
                window, held = [], 0
    if window:
        yield send(window)


def _first_columns(grams: np.ndarray, percent: int, hot: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles of a set that come first and of which every similar set has one."""
    n = len(grams)
    take = n - -(-percent * n // 100) + 1
    if not len(hot):
        return grams[:take]
    at = np.searchsorted(hot, grams)
    at[at == len(hot)] = 0
    is_hot = hot[at] == grams
    cold = grams[~is_hot]
    if len(cold) < take:
        cold = np.concatenate([cold, grams[is_hot][np.argsort(rank[at[is_hot]])]])
    return cold[:take]


def _deal(percent: int, blocks: int, frequent):
    """The first columns of the sets, by block."""

    def send(parts) -> pa.RecordBatch:
        columns, nodes, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        block = (columns >> np.uint64(40)) % np.uint64(blocks)
        return _packed(block, "block", {"columns": columns, "nodes": nodes, "sizes": sizes})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rank = frequent.value
        parts, held = [], 0
        for batch in batches:
            for node, raw in zip(batch.column("node").to_pylist(), batch.column("grams"), strict=True):
                grams = np.frombuffer(raw.as_py(), np.uint64)
                first = _first_columns(grams, percent, hot, rank)
                parts.append((first, np.full(len(first), node), np.full(len(first), len(grams), np.int32)))
                held += len(first)
                if held >= _WINDOW // 2:
                    yield send(parts)
                    parts, held = [], 0
        if parts:
            yield send(parts)

    return run


def _count(percent: int, group: int):
    """Of one block: overlap counts of pairs (kind 0) and ties in large columns (kind 1)."""

    def run(table: pa.Table) -> pa.Table:
        columns, nodes, sizes = (
            _unpacked(table, c, t) for c, t in (("columns", np.uint64), ("nodes", np.int64), ("sizes", np.int32))
        )
        order = np.lexsort((nodes, columns))
        columns, nodes, sizes = columns[order], nodes[order], sizes[order]
        keep = np.concatenate([[True], (columns[1:] != columns[:-1]) | (nodes[1:] != nodes[:-1])])
        columns, nodes, sizes = columns[keep], nodes[keep], sizes[keep]
        start = np.flatnonzero(np.concatenate([[True], columns[1:] != columns[:-1]]))
        length = np.diff(np.append(start, len(columns)))
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in np.unique(length[(length > 1) & (length <= group)]):
            i, j = np.triu_indices(n, 1)
            at = start[length == n][:, None]
            a, b = (at + i).ravel(), (at + j).ravel()
            fits = 100 * np.minimum(sizes[a], sizes[b]).astype(np.int64) >= percent * np.maximum(sizes[a], sizes[b])
            left.append(a[fits])
            right.append(b[fits])
        a, b = np.concatenate(left), np.concatenate(right)
        na, nb, ka, kb = nodes[a], nodes[b], sizes[a].astype(np.int64), sizes[b].astype(np.int64)
        order = np.lexsort((nb, na))
        na, nb, ka, kb = na[order], nb[order], ka[order], kb[order]
        head = np.flatnonzero(
            np.concatenate([[True], (na[1:] != na[:-1]) | (nb[1:] != nb[:-1])]) if len(na) else np.zeros(0, bool)
        )
        shared = np.diff(np.append(head, len(na)))
        tied = [np.zeros((0, 2), np.int64)]
        for s, n in zip(start[length > group], length[length > group], strict=True):
            tied.append(np.column_stack([nodes[s + 1 : s + n], np.full(n - 1, nodes[s])]))
        ties = np.unique(np.concatenate(tied), axis=0)
        zero = np.zeros(len(ties), np.int64)
        out = [
            np.concatenate([x, y])
            for x, y in zip(
                (np.zeros(len(head), np.int64), na[head], nb[head], ka[head], kb[head], shared),
                (zero + 1, ties[:, 0], ties[:, 1], zero, zero, zero),
                strict=True,
            )
        ]
        return pa.table(dict(zip(["kind", "a", "b", "na", "nb", "shared"], map(pa.array, out), strict=True)))

    return run


def _sets(width: int):
    """The sets of the documents that stand for their class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.pieces(whole, "text"):
                nodes = batch.column("node").to_pylist()
                keep, grams_of = [], []
                for i, grams in enumerate(W.shingle_sets(batch.column("text"), width)):
                    if _print(grams)[0] == nodes[i]:  # an id may stand at several texts
                        keep.append(i)
                        grams_of.append(grams.tobytes())
                if keep:
                    part = batch.take(pa.array(keep, pa.int64()))
                    names = ["node", "copies", "n"]
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(c) for c in names], pa.array(grams_of, pa.binary())], [*names, "grams"]
                    )

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The whole product of one block: overlaps of all its sets."""
    k = len(sets)
    if k == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], np.float32)
    owner = np.repeat(np.arange(k), [len(s) for s in sets])
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    owner, grams = owner[order], grams[order]
    start = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    length = np.diff(np.append(start, len(grams)))
    out = np.zeros((k, k), np.float32)
    flat = out.ravel()
    thin = max(8, k // 64)
    for n in np.unique(length[(length > 1) & (length <= thin)]):
        i, j = np.triu_indices(n, 1)
        heads = start[length == n]
        step = max(1, 1_000_000 // len(i))
        for s in range(0, len(heads), step):
            at = heads[s : s + step, None]
            np.add.at(flat, (owner[at + i] * k + owner[at + j]).ravel(), np.float32(1))
    out += out.T
    full = np.flatnonzero(length > thin)
    step = max(1, min(1024, 8_000_000 // k))
    for s in range(0, len(full), step):
        part = full[s : s + step]
        n = length[part]
        rows = owner[np.repeat(start[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        dense = np.zeros((k, len(part)), np.float32)
        dense[rows, np.repeat(np.arange(len(part)), n)] = 1
        out += dense @ dense.T
    return out


def _link(percent: int):
    """Of one pair of parts: each set's smallest node reached, and its links in the pair."""

    def run(table: pa.Table) -> pa.Table:
        nodes, first = np.unique(table.column("node").to_numpy(), return_index=True)  # rows may repeat
        table = table.take(first)
        part = table.column("part").to_numpy()
        copies = table.column("copies").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        label = np.arange(len(sets))
        links = np.zeros(len(sets), np.int64)
        if len(sets) > 1:
            both = overlaps(sets)
            linked = np.empty(both.shape, bool)
            rows = [slice(a, a + _STRIP) for a in range(0, len(sets), _STRIP)]
            for r in rows:  # strip by strip, so that only the overlaps themselves are held whole
                shared = both[r].astype(np.int64)
                linked[r] = 100 * shared >= percent * (sizes[r, None] + sizes[None, :] - shared)
            del both, shared
            np.fill_diagonal(linked, False)
            if table.column("i")[0].as_py() != table.column("j")[0].as_py():
                linked &= part[:, None] != part[None, :]  # the others are counted where i = j
            links = np.concatenate([linked[r] @ copies for r in rows])
            while True:
                least = np.concatenate([np.where(linked[r], label[None, :], len(sets)).min(axis=1) for r in rows])
                after = np.minimum(label, least)
                after = after[after]
                if (after == label).all():
                    break
                label = after
        return pa.table({"node": nodes, "least": nodes[label], "links": links})

    return run


def jaccard_join(
    spark: SparkSession,
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    frequent: int = 50_000,
    group: int = 32,
    block: int = 2048,
    grams: int = 4_000_000,
    block_entries: int = 250_000,
    code_entries: int = 4_000_000,
) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every document.

    ``component_id`` is the smallest id reached by links, ``n_links`` the number of documents
    linked with directly, copies included. ``frequent`` bounds the list of frequent shingles
    that is broadcast (16 bytes each); the rest are compared without it.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(
        spark, source.mapInArrow(_sign(width), "doc_id long, n long, one long, two long"), "shingle-prints"
    )
    classes = stored(
        spark,
        rows.where("n > 0")
        .groupBy("one", "two", "n")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")),
        "shingle-classes",
    )
    node = classes.where("rep IS NOT NULL").select(F.col("one").alias("node"), "rep", "copies", "n")

    entries = classes.agg(F.sum("n")).first()[0] or 0
    blocks = int(entries // code_entries) + 1
    shared = (
        source.mapInArrow(
            _deal_codes(width, blocks), "block long, codes binary, nodes binary, counts binary"
        )
        .groupBy("block")
        .applyInArrow(_shared(blocks), "bucket long, nodes binary, shared binary")
        .groupBy("bucket")
        .applyInArrow(_sum_shared, "node long, shared long")
    )
    able = stored(
        spark, node.join(shared, "node").where(100 * F.col("shared") >= percent * F.col("n")), "able-classes"
    )
    sets = stored(
        spark,
        # Merged at any size: a list that can be broadcast today outgrows it with the corpus.
        source.join(able.withColumnRenamed("rep", "doc_id").hint("merge"), "doc_id")
        .select("text", "node", "copies", "n")
        .mapInArrow(_sets(width), "node long, copies long, n long, grams binary"),
        "shingle-sets",
    )

    often = (
        sets.select("grams")
        .mapInArrow(_often, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "gram")
        .limit(frequent)
    ).collect()  # at most ``frequent`` rows
    hot = np.array([r["gram"] for r in often], np.int64).view(np.uint64)
    order = np.argsort(hot)
    # The most frequent shingle has the highest rank, and so comes last of all.
    ranks = spark.sparkContext.broadcast((hot[order], (len(hot) - order).astype(np.int32)))

    entries = sets.agg(F.sum(F.col("n") * (100 - percent) / 100 + 1)).first()[0] or 0
    blocks = int(entries // block_entries) + 1
    counted = stored(
        spark,
        sets.select("node", "grams")
        .mapInArrow(_deal(percent, blocks, ranks), "block long, columns binary, nodes binary, sizes binary")
        .groupBy("block")
        .applyInArrow(_count(percent, group), "kind long, a long, b long, na long, nb long, shared long"),
        "overlap-counts",
    )
    # Beyond their first columns two sets share at most as many as the larger has left.
    rest = F.ceil(F.greatest("na", "nb") * F.lit(percent) / 100) - 1
    bound = F.ceil((F.col("na") + F.col("nb")) * F.lit(percent) / F.lit(100 + percent))
    pairs = (
        counted.where("kind = 0")
        .groupBy("a", "b", "na", "nb")
        .agg(F.sum("shared").alias("shared"))
        .where(F.col("shared") + rest >= bound)
        .select("a", "b")
    )
    edges = pairs.unionAll(counted.where("kind = 1").select("a", "b"))

    members = components(spark, edges).select("node", F.col("component").alias("family")).join(
        able.select("node", "n"), "node"
    )
    parts = members.groupBy("family").agg(
        F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / grams)).cast("int").alias("parts")
    )
    members = stored(spark, members.drop("n").join(parts, "family"), "family-members")
    paired = (
        sets.join(members, "node")
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("i", F.least("part", "other"))
        .withColumn("j", F.greatest("part", "other"))
        .select("family", "i", "j", "part", "node", "copies", "grams")
    )
    linked = stored(
        spark,
        paired.groupBy("family", "i", "j").applyInArrow(_link(percent), "node long, least long, links long"),
        "shingle-links",
    )
    reached = components(spark, linked.select(F.col("node").alias("a"), F.col("least").alias("b")))
    first = reached.join(node, "node").groupBy("component").agg(F.min("rep").alias("component_id"))
    found = (
        linked.groupBy("node")
        .agg(F.sum("links").alias("links"))
        .join(reached.join(first, "component"), "node", "left")
        .select(F.col("node").alias("one"), "links", "component_id")
    )
    by_class = classes.join(found, "one", "left").select("one", "two", "n", "rep", "copies", "links", "component_id")
    return rows.join(by_class, ["one", "two", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "rep", "doc_id").alias("component_id"),
        F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
    )
