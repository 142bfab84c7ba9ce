"""Dated inbound snapshots: ``<dataset>_YYYYMMDD.csv`` with a ``.ok`` row count."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.schemas import Dataset
from tidegate.sources.files import listing
from tidegate.sources.local import local_rows

CSV_OPTIONS = {"sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
_DATED_NAME = r"\A(.+)_([0-9]{8})\.(csv|ok)\z"


def snapshot_name(dataset: Dataset, date: dt.date, kind: str = "csv") -> str:
    return f"{dataset.name}_{date:%Y%m%d}.{kind}"


def snapshot_path(inbound: str, dataset: Dataset, date: dt.date, kind: str = "csv") -> str:
    return f"{inbound.rstrip('/')}/{snapshot_name(dataset, date, kind)}"


def dataset_of(file_name: str | Column) -> Column:
    return F.nullif(F.regexp_extract(file_name, _DATED_NAME, 1), F.lit(""))


def date_of(file_name: str | Column) -> Column:
    return F.try_to_timestamp(
        F.nullif(F.regexp_extract(file_name, _DATED_NAME, 2), F.lit("")), F.lit("yyyyMMdd")
    ).cast("date")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, dataset, business_date, kind, length) of the dated files in a folder.

    Names and sizes only. An empty or missing folder gives no rows.
    """
    files = local_rows(
        spark, listing(spark, f"{folder.rstrip('/')}/*_*.*"), "file_name string, length long"
    )
    return files.filter(F.col("file_name").rlike(_DATED_NAME)).select(
        "file_name",
        dataset_of("file_name").alias("dataset"),
        date_of("file_name").alias("business_date"),
        F.regexp_extract("file_name", _DATED_NAME, 3).alias("kind"),
        "length",
    )


def read_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Text lines with the position columns that ``with_source_row_num`` needs.

    ``line_id`` grows along each input split, blank lines included.
    """
    return (
        spark.read.option("lineSep", "\n")
        .text(paths if isinstance(paths, str) else list(paths))
        .select(
            "value",
            F.col("_metadata.file_path").alias("source_path"),
            F.col("_metadata.file_name").alias("source_file_name"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("line_id"),
        )
    )


def split_offsets(lines: DataFrame) -> DataFrame:
    """Per input split: its first ``line_id`` and the lines before it in its file.

    One small row per split, so the ordered sum sees a few rows per file however
    long the file is.
    """
    earlier = (
        Window.partitionBy("source_path")
        .orderBy("split_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        lines.groupBy("source_path", "split_start")
        .agg(F.min("line_id").alias("first_id"), F.count("*").alias("split_lines"))
        .select(
            "source_path",
            "split_start",
            "first_id",
            F.coalesce(F.sum("split_lines").over(earlier), F.lit(0)).alias("lines_before"),
        )
    )


def with_source_row_num(lines: DataFrame, offsets: DataFrame | None = None) -> DataFrame:
    """Add ``source_row_num``, the physical line number: header 1, first data row 2.

    ``lines`` comes from ``read_lines``, possibly narrowed or written out and read
    back. Without ``offsets`` the lines are scanned once more to count them. The offsets
    are a row per input split and are broadcast: a shuffle would move all lines, those of
    a split to one task.
    """
    offsets = split_offsets(lines) if offsets is None else offsets
    return (
        lines.join(F.broadcast(offsets), ["source_path", "split_start"])
        .withColumn(
            "source_row_num", F.col("lines_before") + F.col("line_id") - F.col("first_id") + 1
        )
        .drop("source_path", "split_start", "line_id", "first_id", "lines_before")
    )


def well_formed(line: str | Column) -> Column:
    """Whether every field of a line is plain, or enclosed in quotes with inner quotes doubled.

    A field is enclosed when it begins with a quote; its closing quote must end the field. A quote further
    on in a plain field is a character like any other. Decided from delimiter to delimiter with one
    state, so neither long lines nor many quotes need a stack or a second look.
    """
    line = F.col(line) if isinstance(line, str) else line
    between, inside, broken = 0, 1, 2

    def step(state: Column, part: Column) -> Column:
        opens = state == between
        rest = F.replace(F.when(opens, F.substr(part, F.lit(2))).otherwise(part), F.lit('""'), F.lit(""))
        closes = F.endswith(rest, F.lit('"')) & (F.length(F.replace(rest, F.lit('"'), F.lit(""))) == F.length(rest) - 1)
        enclosed = F.when(~F.contains(rest, F.lit('"')), inside).when(closes, between).otherwise(broken)
        plain = opens & ~F.startswith(part, F.lit('"'))
        return F.when(state == broken, broken).when(plain, between).otherwise(enclosed)

    parts = F.split(F.regexp_replace(line, r"\r\z", ""), CSV_OPTIONS["sep"], -1)
    return F.when(~F.contains(line, F.lit('"')), True).otherwise(F.aggregate(parts, F.lit(between), step) == between)


def parse_lines(lines: DataFrame, dataset: Dataset) -> DataFrame:
    """Split lines into raw text fields; missing trailing fields are NULL.

    A blank line is a row of NULLs, and fields beyond the contract are ignored.
    """
    schema = ", ".join(f"{c} string" for c in dataset.raw_columns)
    parsed = F.from_csv("value", schema, CSV_OPTIONS)
    rest = [c for c in lines.columns if c != "value"]
    return lines.select(*rest, parsed.alias("row")).select(
        *rest, date_of("source_file_name").alias("business_date"), "row.*"
    )


def read_raw(
    spark: SparkSession, inbound: str, dataset: Dataset, dates: Sequence[dt.date]
) -> DataFrame:
    """Raw rows of one or many dated snapshots, with their line numbers.

    A line with an enclosed field that does not end stops the read, as nothing behind its quote can be trusted.
    """
    paths = [snapshot_path(inbound, dataset, d) for d in dates]
    numbered = with_source_row_num(read_lines(spark, paths)).filter("source_row_num > 1")
    place = F.format_string("%s, line %d: a quoted field does not end.", "source_file_name", "source_row_num")
    checked = F.when(well_formed("value"), F.col("value")).otherwise(F.raise_error(place))
    return parse_lines(numbered.withColumn("value", checked), dataset)


def read_transfers_raw(spark: SparkSession, inbound: str, *dates: dt.date) -> DataFrame:
    return read_raw(spark, inbound, S.TRANSFERS, dates)


def read_clients_raw(spark: SparkSession, inbound: str, *dates: dt.date) -> DataFrame:
    return read_raw(spark, inbound, S.CLIENTS, dates)


def ready_counts(first_lines: DataFrame, files: DataFrame) -> DataFrame:
    """Row counts promised by ready files.

    ``files`` lists the ready files, ``first_lines`` holds (file_name, value).
    ``ready_state`` is OK, EMPTY (no line at all) or INVALID (not a whole number);
    ``expected_row_count`` is NULL unless OK.
    """
    text = F.trim("value")
    # Blanks around the number are allowed; a blank line is not a number.
    is_count = F.coalesce(text.rlike(r"\A[0-9]+\z"), F.lit(False))
    return files.join(first_lines, "file_name", "left").select(
        "dataset",
        "business_date",
        F.when(is_count, text.try_cast("bigint")).alias("expected_row_count"),
        F.when(F.col("value").isNull(), "EMPTY")
        .when(is_count, "OK")
        .otherwise("INVALID")
        .alias("ready_state"),
    )


def read_ready_counts(
    spark: SparkSession, inbound: str, names: Sequence[str] | None = None
) -> DataFrame:
    """``ready_counts`` of the named ready files of a folder, or of all; only first lines count."""
    files = list_files(spark, inbound).filter("kind = 'ok'")
    if names is not None:
        files = files.filter(F.col("file_name").isin(list(names)))
    try:
        folder = inbound.rstrip("/")
        lines = read_lines(spark, [f"{folder}/{n}" for n in names or ["*_*.ok"]])
    except AnalysisException:
        return ready_counts(
            local_rows(spark, [], "file_name string, value string"), files
        )
    first = lines.filter("split_start = 0").groupBy("source_file_name").agg(
        F.min_by("value", "line_id").alias("value")
    )
    return ready_counts(first.withColumnRenamed("source_file_name", "file_name"), files)
