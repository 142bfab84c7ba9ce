"""Mixing sources to target weights by pivotal dependent rounding.

Sources take weights in turn, in code point order with null last. They share the
corpus by weight; no target exceeds ``limit`` times its source's size, and what
that leaves over is shared again by weight (filled up like vessels to one level).
A document of a source with target/size = f gets floor(f) copies and one more with
probability f - floor(f), its fractional part.

The fractional parts are rounded together. Two documents are paired, and words are
moved from one part to the other, in a direction drawn so that expectations
stay, until one part is 0 or 1; that document is decided and the other one goes on. The
words taken stay the same in every such step. Documents of like size (within a power of
two) are dealt by hash to buckets of about ``arity``, each bucket is reduced to one undecided
document, and those are reduced again, ``arity`` buckets at a time, up to one per class: a
tree whose depth is the logarithm of the largest class. About ``POOL`` documents of each class of a source stay out of
the tree (all of a smaller class). They and what the tree has left over are settled in one go per source, the largest
class first: each class is paired up to one document, that is drawn, and the words that this moves are taken from, or
given to, all smaller ones that stayed out, in equal parts. So a source misses its target by about its smallest documents' words, or by what a
large one has beyond all that the smaller ones can move.

Every step keeps the expectations, so each document is taken with exactly the probability of its source,
whatever its size.

Defined results: a null or empty text has size 0, gets floor(f) copies and takes no
words. Repeated rows (same id, source and text) are one document, all taken or none beyond floor(f), so
a source that is mostly one repeated row can miss its target by the size of all of them. Other columns
are ignored. Results depend on the rows and the seed only. No rows in, no rows out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.work import let, row_key, stored

WORD = r"[^\x20\x09-\x0D]+"
_EMPTY = "array<struct<row: long, x: int>>"
#: Documents of each size class of a source that are kept for the last step.
POOL = 64


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def targets(sizes: DataFrame, weights: tuple[float, ...], limit: float, total: float = 1.0) -> DataFrame:
    """Add the target to (source, source_size), one row per source.

    ``total`` is the share of all sizes that the mix is to have. The windows hold one row per source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    turn = (F.row_number().over(ordered) - 1) % len(weights)
    cap = F.col("source_size") * F.lit(float(limit))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    level = (F.col("goal") - F.col("filled") + F.col("cap")) / (F.col("weights") - F.col("used") + F.col("weight"))
    return (
        sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
        .withColumn("cap", cap)
        .withColumn("goal", F.sum("source_size").over(everything) * F.lit(float(total)))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("filled", F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("used", F.sum("weight").over(filled.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("place", F.row_number().over(filled))
        .withColumn("level", level)
        .withColumn("open", F.when(F.col("cap") / F.col("weight") > F.col("level"), F.struct("place", "level")))
        .withColumn("open", F.min("open").over(everything))
        .select(
            "source",
            "source_size",
            F.when(F.col("open").isNull() | (F.col("place") < F.col("open.place")), F.col("cap"))
            .otherwise(F.col("weight") * F.col("open.level"))
            .alias("target"),
            *[c for c in sizes.columns if c not in ("source", "source_size")],
        )
    )


def _pivot(acc: Column, unit: Column, seed: int) -> Column:
    """Pair the undecided document with the next one; one of the two is decided."""

    def move(t: Column) -> Column:
        # ``to_first`` moves words from the next to the undecided one, else the other way.
        first, second = t["first"], t["second"]
        to_first = t["u"] * (t["gain"] + t["loss"]) < t["loss"]
        first_done = F.when(to_first, t["gain"] == t["first_room"]).otherwise(t["loss"] == t["first_has"])
        moved = F.when(to_first, t["gain"]).otherwise(-t["loss"])
        stays = F.when(first_done, second).otherwise(first)
        part = F.when(first_done, second["p"] - moved / second["mass"]).otherwise(first["p"] + moved / first["mass"])
        done = F.when(first_done, F.struct(first["row"].alias("row"), to_first.cast("int").alias("x"))).otherwise(
            F.struct(second["row"].alias("row"), (~to_first).cast("int").alias("x"))
        )
        kept = F.struct(
            stays["mass"].alias("mass"),
            stays["row"].alias("row"),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), part)).alias("p"),
        )
        return F.struct(kept.alias("left"), F.concat(t["out"], F.array(done)).alias("out"))

    first = acc["left"]
    first_has, first_room = first["p"] * first["mass"], (1 - first["p"]) * first["mass"]
    second_has, second_room = unit["p"] * unit["mass"], (1 - unit["p"]) * unit["mass"]
    return let(
        F.struct(
            first.alias("first"),
            unit.alias("second"),
            acc["out"].alias("out"),
            first_has.alias("first_has"),
            first_room.alias("first_room"),
            F.least(first_room, second_has).alias("gain"),
            F.least(first_has, second_room).alias("loss"),
            _uniform(first["row"], unit["row"], F.lit(seed)).alias("u"),
        ),
        move,
    )


def _reduce(units: DataFrame, names: list[str], seed: int) -> DataFrame:
    """The names, left, out: of each bucket the document left over and those decided."""
    unit = F.struct(F.col("mass"), F.col("row"), F.col("p"))
    listed = units.groupBy(*names).agg(F.sort_array(F.collect_list(unit), asc=False).alias("units"))
    folded = F.aggregate(
        F.slice("units", 2, F.size("units")),
        F.struct(F.element_at("units", 1).alias("left"), F.array().cast(_EMPTY).alias("out")),
        lambda acc, unit: _pivot(acc, unit, seed),
    )
    return listed.select(*names, folded.alias("f")).select(*names, "f.left", "f.out")


def _settle(units: DataFrame, seed: int) -> DataFrame:
    """(row, x) of the documents left of each source, class by class, the largest first.

    The documents of a class are paired up to one; that is drawn, paired with all smaller ones that move, together.
    Those have one part p still. It becomes p + c p (1 - p) with one c for all, so to move words between a document and
    all of them is to move c, with its expectation kept and as far as the part stays in [0, 1].
    """
    unit = F.struct(F.col("mass"), F.col("row"), F.col("p"), F.col("moves"))
    can = F.when(F.col("moves") == 1, F.col("p"))
    listed = units.groupBy("key").agg(
        F.sort_array(F.collect_list(unit), asc=False).alias("units"),
        F.sum(F.col("mass") * F.col("moves") * F.col("p") * (1 - F.col("p"))).alias("weight"),
        F.coalesce(-1 / (1 - F.min(can)), F.lit(0.0)).alias("least"),
        F.coalesce(1 / F.max(can), F.lit(0.0)).alias("most"),
    )

    def drawn(acc: Column) -> Column:
        """The undecided document drawn, and c moved; ``weight`` is that of the smaller ones."""
        left = acc["left"]
        # What c would have to fall by if the document is taken, and to rise by if it is not.
        fall, rise = (left["mass"] * part / acc["weight"] for part in (1 - left["p"], left["p"]))
        share = F.least(
            F.lit(1.0),
            F.when(fall > 0, (acc["c"] - F.col("least")) / fall).otherwise(F.lit(1.0)),
            F.when(rise > 0, (F.col("most") - acc["c"]) / rise).otherwise(F.lit(1.0)),
        )
        taken = _uniform(left["row"], F.lit(seed)) < left["p"]
        moved = F.when(acc["weight"] <= 1e-9, acc["c"]).otherwise(
            acc["c"] + share * F.when(taken, -fall).otherwise(rise)
        )
        done = F.struct(left["row"].alias("row"), taken.cast("int").alias("x"))
        return F.struct(
            F.greatest(F.col("least"), F.least(F.col("most"), moved)).alias("c"),
            F.concat(acc["out"], F.array(done)).alias("out"),
        )

    def own(u: Column) -> Column:
        return u["moves"] * u["p"] * (1 - u["p"])

    def now(u: Column, c: Column) -> Column:
        p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), u["p"] + c * own(u)))
        return F.struct(u["mass"].alias("mass"), u["row"].alias("row"), p.alias("p"))

    def state(left: Column, c: Column, weight: Column, out: Column) -> Column:
        return F.struct(left.alias("left"), c.alias("c"), weight.alias("weight"), out.alias("out"))

    def step(acc: Column, u: Column) -> Column:
        weight = acc["weight"] - u["mass"] * own(u)
        paired = let(
            _pivot(F.struct(acc["left"].alias("left"), acc["out"].alias("out")), now(u, acc["c"]), seed),
            lambda f: state(f["left"], acc["c"], weight, f["out"]),
        )
        next_class = let(drawn(acc), lambda d: state(now(u, d["c"]), d["c"], weight, d["out"]))
        same = F.floor(F.log2(u["mass"])) == F.floor(F.log2(acc["left"]["mass"]))
        return F.when(same, paired).otherwise(next_class)

    head = F.element_at("units", 1)
    start = state(
        now(head, F.lit(0.0)), F.lit(0.0), F.col("weight") - head["mass"] * own(head), F.array().cast(_EMPTY)
    )
    folded = F.aggregate(F.slice("units", 2, F.size("units")), start, step, lambda acc: drawn(acc)["out"])
    return listed.select(F.inline(folded))


def mix(
    spark: SparkSession,
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    limit: float = 3.0,
    total: float = 1.0,
    source: str = "source",
    seed: int = 29,
    arity: int = 16,
) -> DataFrame:
    """doc_id, row, size, source_size, target, copies, taken of every row.

    ``row`` is a key of id, source and text. ``copies`` times ``size`` are ``taken``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = stored(
        spark,
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            row_key(F.col(source)).alias("key"),
            row_key(F.col("doc_id"), F.col(source), F.col("text")).alias("row"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        ),
        "mix-sizes",
    )
    sizes = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(F.col("share") + F.lit(1e-12))
    sources = stored(
        spark,
        targets(sizes.drop("key"), weights, limit, total)
        .withColumn("key", row_key(F.col("source")))
        .withColumn("share", share)
        .withColumn("whole", whole)
        .withColumn("p", F.greatest(F.lit(0.0), F.col("share") - F.col("whole"))),
        "mix-sources",
    )
    units = stored(
        spark,
        sized.where("size > 0")
        .groupBy("key", "row")
        .agg((F.first("size") * F.count("*")).cast("double").alias("mass"))
        .join(sources.where("p > 0").select("key", "p"), "key")
        .withColumn("class", F.floor(F.log2("mass"))),
        "mix-units",
    )
    of_class = stored(  # Spark then knows its size
        spark, units.groupBy("key", "class").agg(F.count("*").alias("units")), "mix-classes"
    )
    place = F.pmod(F.xxhash64("row", F.lit(seed)), F.col("units"))
    dealt = units.join(of_class, ["key", "class"]).withColumn("place", place)
    reserved = dealt.where(F.col("place") < POOL).select("key", "mass", "row", "p", F.lit(1).alias("moves"))
    level = dealt.where(F.col("place") >= POOL)
    most = of_class.agg(F.max("units")).first()[0] or 0
    decisions, rest = [], [reserved]
    depth = 0
    while most > POOL or depth and most > 1:
        buckets = F.ceil(F.col("units") / arity)
        level = level.withColumn("buckets", buckets).withColumn("bucket", F.floor(F.col("place") / arity))
        reduced = stored(spark, _reduce(level, ["key", "class", "buckets", "bucket"], seed + depth), "mix-level")
        decisions.append(reduced.select(F.inline("out")))
        level = reduced.select(
            "key", "class", F.col("buckets").alias("units"), F.col("bucket").alias("place"), "left.mass", "left.row", "left.p"
        )
        most = -(-most // arity)
        depth += 1
    if depth:
        rest.append(level.select("key", "mass", "row", "p", F.lit(0).alias("moves")))
    # About POOL documents per class and source, whatever the size of the source.
    settled = stored(spark, _settle(reduce(DataFrame.unionAll, rest), seed), "mix-level")
    x = reduce(DataFrame.unionAll, decisions, settled)
    copies = (F.col("whole") + F.coalesce("x", F.lit(0))).cast("long")
    return (
        sized.join(x, "row", "left")
        .join(sources.select("key", "source_size", "target", "whole"), "key")
        .select("doc_id", "row", "size", "source_size", "target", copies.alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )
