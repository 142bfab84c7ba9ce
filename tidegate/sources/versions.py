"""Versions of dated tables, and the manifests that say which one holds.

A publish writes its tables to folders of a new version, ``<table>/version=<v>/business_date=<d>``. Nothing
reads them until the date's manifest names them: ``_manifest/<date>/<group>.json`` has the version and
the row counts of all tables that the group publishes together. It is put in place by one atomic rename, so
a date's tables change all at once or not at all, and a publish that fails leaves every date as it was. Readers
open the folders that the manifests name and list nothing else.

Each group of tables has one writer (a load, the mart, the report), so no two writers share a manifest.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidegate.sources import files
from tidegate.sources.local import local_rows

MANIFESTS = "_manifest"
#: Up to so many manifests are opened one by one; more are read as a table.
_FEW = 32


@dataclass(frozen=True)
class Entry:
    """What a manifest says: the version of a date's tables and how many rows each has."""

    business_date: dt.date
    group: str
    version: str
    rows: dict[str, int]


def new_version() -> str:
    return uuid.uuid4().hex


def version_path(table: str, version: str) -> str:
    return f"{table}/version={version}"


def write_version(df: DataFrame, table: str, version: str, rebalance: bool = False) -> None:
    """Write the rows of any number of dates as a version that nothing reads yet.

    ``rebalance`` gathers the dates before writing, for many dates after a shuffle on other keys;
    a large date is still split over many tasks.
    """
    rows = df.hint("rebalance", "business_date") if rebalance else df
    (
        rows.write.mode("overwrite")
        .option("compression", files.CODEC)
        .partitionBy("business_date")
        .parquet(version_path(table, version))
    )


def read_version(spark: SparkSession, table: str, version: str, schema: T.StructType) -> DataFrame:
    """A version, whether or not a manifest names it."""
    path = version_path(table, version)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def _file(root: str, date: dt.date, group: str) -> str:
    return f"{root}/{MANIFESTS}/{date:%Y-%m-%d}/{group}.json"


def switch(spark: SparkSession, root: str, group: str, version: str, rows: dict[dt.date, dict[str, int]]) -> None:
    """Let the version hold for the dates of ``rows``, one date after the other, each at once for all its tables."""
    for date, counts in rows.items():
        text = json.dumps({"version": version, "rows": counts}, sort_keys=True)
        path = _file(root, date, group)
        draft = f"{root}/{MANIFESTS}/{date:%Y-%m-%d}/_{group}.{version}"
        files.write_line(spark, draft, text)
        files.replace(spark, draft, path)


def _entry(path: str, text: str) -> Entry:
    *_, date, name = path.rsplit("/", 2)
    found = json.loads(text)
    return Entry(dt.date.fromisoformat(date), name.removesuffix(".json"), found["version"], found["rows"])


def entries(spark: SparkSession, root: str, dates: Iterable[dt.date] | None = None) -> list[Entry]:
    """The manifests of some dates, or of all; a few small lines per date."""
    days = None if dates is None else sorted(set(dates))
    pattern = f"{root}/{MANIFESTS}/{'*' if days is None else f'{{{",".join(map(str, days))}}}'}/[a-z]*.json"
    found = files.matching(spark, pattern) if days is None or days else []
    if len(found) <= _FEW:
        return [_entry(path, files.read_text(spark, path)) for path in found]
    lines = spark.read.text(found).selectExpr("_metadata.file_path AS path", "value").collect()
    return [_entry(r.path, r.value) for r in lines]


def is_published(spark: SparkSession, table: str) -> bool:
    """Whether any version of the table was ever written."""
    return bool(files.matching(spark, f"{table}/version=*"))


def read_published(
    spark: SparkSession, table: str, schema: T.StructType, dates: Sequence[dt.date] | None = None
) -> DataFrame:
    """The rows that hold, of some dates or of all; only the folders that the manifests name are opened."""
    root, name = table.rstrip("/").rsplit("/", 1)
    paths = [
        f"{version_path(table, e.version)}/business_date={e.business_date:%Y-%m-%d}"
        for e in entries(spark, root, dates)
        if e.rows.get(name)
    ]
    if not paths:
        return local_rows(spark, [], schema)
    found = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    read = spark.read.schema(found).option("basePath", table).parquet(*paths)
    return read.select(*schema.fieldNames())


def expire(spark: SparkSession, root: str, names: Iterable[str]) -> list[str]:
    """Remove the versions of the named tables that no manifest names; returns their folders.

    Not to be run while a publish of these tables is under way: its version is not named yet.
    """
    held = {(name, e.version) for e in entries(spark, root) for name in e.rows}
    gone = []
    for name in names:
        for path in files.matching(spark, f"{root}/{name}/version=*"):
            if (name, path.rsplit("=", 1)[1]) not in held:
                files.delete(spark, path)
                gone.append(path)
    return gone
