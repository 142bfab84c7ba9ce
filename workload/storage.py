"""Files and tables: line numbers, dated tables, report files, reference data.

These write to a new folder under the session's checkpoint folder and read it
back; what they write derives from the given tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators import aggregates as A
from tidegate.operators import split
from tidegate.plans.mart import build_mart
from tidegate.sources import inbound as inbound_files
from tidegate.sources import outbound, reference, tables
from tidegate.sources.files import work_folder
from workload import inbound, review, shapes
from workload.oracle import shown, sql
from workload.registry import query


def write_inbound_lines(raw, dataset, folder):
    """Raw rows as ``;`` lines under a header, in several files per date.

    Each part file of a date is a file of its own, as if delivered in pieces.
    """
    values = [F.coalesce(c, F.lit("")) for c in dataset.raw_columns]
    raw.select("source_file_name", F.concat_ws(";", *values).alias("line")).write.partitionBy(
        "source_file_name"
    ).option("lineSep", "\n").text(folder)


@query(sql(
    "SELECT strftime(business_date, '%Y-%m-%d') AS business_date, COUNT(*) AS row_count, 0 AS gaps,"
    " 0 AS repeats FROM inbound_transfers GROUP BY business_date"
))
def file_line_numbers(spark, sf_dir):
    """Lines written to files and numbered on reading: 1..n in every file, none missing or twice."""
    folder = work_folder(spark, "lines")
    write_inbound_lines(shapes.inbound_transfers(spark, sf_dir), S.TRANSFERS, folder)
    lines = inbound_files.read_lines(spark, f"{folder}/*/*.txt")
    numbered = inbound_files.with_source_row_num(
        lines.withColumn("part_file", F.col("source_path"))
    )
    per_file = numbered.groupBy("part_file").agg(
        F.count("*").alias("n"),
        F.countDistinct("source_row_num").alias("distinct_n"),
        F.max("source_row_num").alias("last"),
    ).withColumn(
        "business_date", F.to_date(F.regexp_extract("part_file", r"_([0-9]{8})\.csv", 1), "yyyyMMdd")
    )
    return per_file.groupBy("business_date").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.col("last") - F.col("n")).cast("int").alias("gaps"),
        F.sum(F.col("n") - F.col("distinct_n")).cast("int").alias("repeats"),
    )


@query(sql(shown(["source_file_name", *S.CLIENTS.reject_columns], "client_lines"),
           client_lines="SELECT source_file_name, " + ", ".join(
               f"nullif({c}, '') AS {c}" for c in S.CLIENTS.reject_columns) + " FROM inbound_clients"))
def client_lines(spark, sf_dir):
    """Client lines parsed back into raw fields in file order."""
    raw = shapes.inbound_clients(spark, sf_dir)
    values = [F.coalesce(c, F.lit("")) for c in S.CLIENTS.raw_columns]
    lines = raw.select("source_file_name", F.concat_ws(";", *values).alias("value"))
    return inbound_files.parse_lines(lines, S.CLIENTS).select(
        "source_file_name", *S.CLIENTS.reject_columns
    )


@query(sql(
    "SELECT strftime(business_date, '%Y-%m-%d') AS business_date, COUNT(*) AS row_count,"
    " CAST(sum(amount) AS DOUBLE) AS amount FROM ("
    " SELECT business_date, amount FROM t_stage WHERE day(business_date) NOT IN (14, 18)"
    " UNION ALL SELECT business_date, 2 * amount FROM t_stage WHERE day(business_date) = 14) x GROUP BY business_date"
))
def dated_table(spark, sf_dir):
    """A table written once, then with one date replaced and one date emptied."""
    path = work_folder(spark, "dated")
    judged = inbound.judged_transfers(spark, sf_dir)
    tables.overwrite_date(split.accepted_values(judged, S.TRANSFERS, S.TRANSFERS.stage_order), path)
    again = tables.read_table(spark, path, S.core_schema(S.TRANSFERS)).filter(F.day("business_date") == 14)
    again = again.withColumn("amount", (F.col("amount") * 2).cast("decimal(14,2)"))
    # Stored, as a table cannot be replaced by what is read from it.
    tables.overwrite_date(inbound.stored(spark, again, "again"), path, [dt.date(2026, 4, 18)])
    stored = tables.read_table(spark, path, S.core_schema(S.TRANSFERS))
    return stored.groupBy("business_date").agg(
        F.count("*").alias("row_count"), F.sum("amount").alias("amount")
    )


@query(sql(
    f"SELECT file_name, value FROM (SELECT l.*, line AS value, concat('aml_report_spool_',"
    f" strftime(business_date, '%Y%m%d'), '.csv') AS file_name FROM ({review.LINES_SQL}) l) x"
    f" UNION ALL SELECT DISTINCT concat('aml_report_spool_', strftime(business_date, '%Y%m%d'), '.csv'),"
    f" '{';'.join(S.REPORT_COLUMNS)}' FROM spool"
    " UNION ALL SELECT concat('aml_report_spool_', strftime(business_date, '%Y%m%d'), '.ok'),"
    " CAST(COUNT(*) AS VARCHAR) FROM spool GROUP BY business_date"
))
def report_files(spark, sf_dir):
    """All dates' reports and ready markers, exported and read back line by line."""
    folder = work_folder(spark, "outbound")
    report = review.spool(spark, sf_dir)
    stored = {r.business_date: r["count"] for r in report.groupBy("business_date").count().collect()}
    outbound.publish(report, folder, stored)
    data = spark.read.text(f"{folder}/*.csv").select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.csv)/", 1).alias("file_name"), "value"
    )
    marks = spark.read.text(f"{folder}/*.ok").select(
        F.col("_metadata.file_name").alias("file_name"), "value"
    )
    return data.unionByName(marks)


@query(sql(shown(
    ["business_date", "transfer_id", "fx_rate_to_eur", "amount_eur", "report_type_candidate"],
    "mart",
)))
def mart_from_stored_tables(spark, sf_dir):
    """The mart from written core and rate tables, read back by date."""
    base = work_folder(spark, "stored")
    tables.overwrite_date(shapes.curated_transfers(spark, sf_dir), f"{base}/transfers")
    tables.overwrite_date(shapes.curated_clients(spark, sf_dir), f"{base}/clients", rebalance=True)
    reference.load_fx_rates(shapes.rates(spark), f"{base}/fx")
    mart = build_mart(
        tables.read_table(spark, f"{base}/transfers", S.core_schema(S.TRANSFERS)),
        tables.read_table(spark, f"{base}/clients", S.core_schema(S.CLIENTS)),
        tables.read_table(spark, f"{base}/fx", S.FX_SCHEMA),
    )
    return mart.select(
        "business_date", "transfer_id", "fx_rate_to_eur", "amount_eur", "report_type_candidate"
    )


@query(sql(
    "SELECT country_code, COUNT(*) AS transfers, min(country_name) AS country_name FROM transfers"
    f" JOIN (VALUES {', '.join(f'({chr(39)}{c}{chr(39)}, {chr(39)}{n}{chr(39)})' for c, n in S.COUNTRIES.items())})"
    " ref(country_code, country_name) USING (country_code) GROUP BY country_code"
))
def transfers_by_country(spark, sf_dir):
    """Transfers against the country dictionary."""
    counts = A.count_by(shapes.curated_transfers(spark, sf_dir), ["country_code"], "transfers")
    return counts.join(F.broadcast(reference.ref_country(spark)), "country_code").select(
        "country_code", "transfers", "country_name"
    )


# --- Enclosed fields ---------------------------------------------------------
# The title of a line takes one of nine shapes; some are not closed, or go on after the closing quote.

_SHAPES = ['"open', '"shut"', '"a;b ""c"" ;"', '"shut" and more', '5" pipe', '"' * 4, '"' * 3, ""]
_TITLES = (
    f"CASE source_row_num % {len(_SHAPES) + 1} "
    + " ".join(f"WHEN {k} THEN '{shape}'" for k, shape in enumerate(_SHAPES))
    + " ELSE transfer_title_raw END"
)
_LINE = (
    "concat_ws(';', coalesce(transfer_id_raw, ''), coalesce(client_id_raw, ''), "
    f"coalesce({_TITLES}, ''), coalesce(currency_code_raw, ''))"
)
_FIELD = '("([^"]|"")*"|[^;"][^;]*|)'


@query(sql(
    f"SELECT strftime(business_date, '%Y-%m-%d') AS business_date, {_LINE} AS line, COUNT(*) AS row_count,"
    f" NOT regexp_full_match({_LINE}, '{_FIELD}(;{_FIELD})*', 's') AS is_malformed"
    " FROM inbound_transfers GROUP BY ALL"
))
def malformed_lines(spark, sf_dir):
    """Lines with enclosed titles written to dated files and read back: those whose quotes do not end."""
    folder = work_folder(spark, "lines")
    raw = shapes.inbound_transfers(spark, sf_dir)
    raw.select("source_file_name", F.expr(_LINE).alias("line")).write.partitionBy("source_file_name").option(
        "lineSep", "\n"
    ).text(folder)
    lines = inbound_files.read_lines(spark, f"{folder}/*/*.txt")
    date = F.to_date(F.regexp_extract("source_path", r"_([0-9]{8})\.csv", 1), "yyyyMMdd")
    return lines.groupBy(date.alias("business_date"), F.col("value").alias("line")).agg(
        F.count("*").alias("row_count"), F.first(~inbound_files.well_formed("value")).alias("is_malformed")
    )
