"""The corpus pipeline: stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of the
documents they got; repeated rows stay repeated except where a stage says so. An empty table gives
an empty table of the same columns at every stage; columns beyond those used go through unread.
Rows are matched by 64-bit keys of their id, source and text; of 10**10 rows about three pairs would share one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import decontam, jaccard, lines, mixture, shards
from tidegate.llm.work import row_key, stored, table
from tidegate.session import prepare


#: Names that no table has.
_KEY, _COPIES, _COPY, _GROUP, _ID = (f"_tidegate_{x}_" for x in ("key", "copies", "copy", "group", "id"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are depleted of lines of their own go; the rest lose their common lines.

    ``n_chars`` follows the text. Null, empty and wordless texts fail; very long ones are judged and cut whole. A common
    line stays in the document with the smallest id, of equal ids in the one with the smallest row key.
    """
    return lines.cleaned(prepare(spark), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays, once; those without an id come last.

    Rows are told apart by a 64-bit key of all their columns, so an id may stand for several texts: each is a document
    of its own. Equal rows are one document. Texts without words are linked with nothing and stay.
    """
    keyed = docs.withColumn(_KEY, row_key(*[docs[c] for c in docs.columns]))
    joined = jaccard.jaccard_join(prepare(spark), keyed.select(F.col(_KEY).alias("doc_id"), "text"))
    groups = joined.select(F.col("doc_id").alias(_KEY), F.col("component_id").alias(_GROUP)).dropDuplicates([_KEY])
    ids = keyed.select(_KEY, F.col("doc_id").alias(_ID)).dropDuplicates([_KEY])
    first = F.min(F.struct(F.col(_ID).isNull(), _ID, _KEY)).alias("first")
    kept = groups.join(ids, _KEY).groupBy(_GROUP).agg(first).select(F.col(f"first.{_KEY}").alias(_KEY))
    kept = stored(spark, kept, "kept-documents")
    # Merged at any size: a list that can be broadcast today outgrows it with the corpus.
    left = keyed.join(kept.hint("merge"), _KEY, "left_semi")
    return left.dropDuplicates([_KEY]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none, very long ones are searched whole."""
    return decontam.without_leaks(prepare(spark), docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; one without words as often as its source's whole share says."""
    mixed = mixture.mix(prepare(spark), docs)
    copies = (
        mixed.groupBy(F.col("row").alias(_KEY)).agg(F.first("copies").alias(_COPIES)).where(F.col(_COPIES) > 0)
    )
    key = row_key(docs["doc_id"], docs["source"], docs["text"])
    return (
        docs.join(copies.hint("merge"), key == F.col(_KEY))
        .withColumn(_COPY, F.explode(F.sequence(F.lit(1).cast("long"), F.col(_COPIES))))
        .select(*docs.columns)
    )


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and place of every row."""
    return shards.shard_documents(prepare(spark), docs, 24)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", source_mix),
    ("sharding", sharding),
]

#: Approximate search and hash draws have no SQL; the tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
