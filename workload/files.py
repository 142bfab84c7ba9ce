"""Delivered files through the whole workflow: every order as a transfer of its quarter, every customer as a client.

The files are written once per session and folder of tables, the workflow runs over all quarters at once, and
each query reads what it published. Quarters are spoilt in turn, nine kinds in all, four of them good.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators.checks import audit
from tidegate.plans.builds import mart_schema, run_workflow
from tidegate.plans.publish import CONSTRAINTS
from tidegate.plans.runs import Warehouse, read_control
from tidegate.sources import files, inbound, reference, versions
from tidegate.sources.files import work_folder
from tidegate.sources.tables import read_table
from workload import review, shapes
from workload.oracle import RUN_TS, shown, sql
from workload.registry import query

_KINDS = 9
#: What is wrong with a quarter of each kind; the others are good.
NO_READY_FILE, WRONG_COUNT, OPEN_QUOTE, LOST_CLIENTS, NO_RATES = range(5)
_KIND = f"((year(business_date) * 4 + quarter(business_date)) % {_KINDS})"
_LOST = "client_id % 10 = 0"


def _quoted(c):
    """A field as it is delivered: enclosed if it needs to be."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    inner = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[;"]'), inner).otherwise(text)


def _lines(rows, dataset, broken=None):
    """The lines of dated files, from rows that ``_place`` put in one task per date in order of the key: a header and a line per row.

    ``broken`` tells which lines end in an open quote.
    """
    fields = [c.removesuffix("_raw") for c in dataset.raw_columns]
    values = [
        F.date_format(c, "yyyy-MM-dd HH:mm:ss") if c == "transfer_ts" else F.col(c)
        for c in fields
    ]
    line = F.concat_ws(";", *[_quoted(v) for v in values])
    if broken is not None:
        line = F.when(broken, F.concat(line, F.lit(' "'), F.lit('x;"open'))).otherwise(line)
    # The low bits of the id count the rows of a task.
    is_first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    data = rows.select(line.alias("line"), is_first.alias("is_first"))
    header = F.lit(";".join(fields))
    return data.select(F.explode(F.when(F.col("is_first"), F.array(header, "line")).otherwise(F.array("line"))).alias("line"))


def _place(dates):
    """Rows of each date in a task of its own, in order of a key."""

    def place(rows, day, key):
        at = F.array_position(F.array(*[F.lit(d) for d in dates]), F.col(day)) - 1
        return rows.repartitionById(len(dates), at.cast("int")).sortWithinPartitions(F.col(key).cast("long"))

    return place


def _deliver(spark, rows, dataset, key, dates, lines, folder, wrong_count=None, no_ready=None):
    """One file per date, as delivered, and its ready file. ``lines`` are those of ``rows``, a task per date."""
    parts = work_folder(spark, "delivered")
    lines.write.option("lineSep", "\n").text(parts)
    counted = rows.where(F.col(key) >= 0).groupBy("business_date").agg(F.count("*").alias("n"))
    for row in counted.withColumn("kind", F.expr(_KIND)).collect():  # a row per delivered file
        (part,) = files.matching(spark, f"{parts}/part-{dates.index(row.business_date):05d}-*")
        files.replace(spark, part, inbound.snapshot_path(folder, dataset, row.business_date))
        if row.kind != no_ready:
            promised = row.n + 7 if row.kind == wrong_count else row.n
            files.write_line(spark, inbound.snapshot_path(folder, dataset, row.business_date, "ok"), str(promised))


_done: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark, sf_dir) -> Warehouse:
    """The warehouse after the workflow of all quarters; run once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _done:
        return _done[key]
    base = work_folder(spark, "workflow")
    w = Warehouse(f"{base}/inbound", f"{base}/tables", f"{base}/outbound")
    files.make(spark, w.inbound)
    transfers = shapes.curated_transfers(spark, sf_dir)
    dates = [r[0] for r in transfers.select("business_date").distinct().orderBy("business_date").collect()]
    place = _place(dates)
    opened = (F.expr(_KIND) == OPEN_QUOTE) & (F.col("transfer_id") % 50 == 0)
    lines = _lines(shapes.curated_transfers(spark, sf_dir, place), S.TRANSFERS, opened)
    _deliver(spark, transfers, S.TRANSFERS, "transfer_id", dates, lines, w.inbound, wrong_count=WRONG_COUNT)
    kept = f"NOT ({_KIND} = {LOST_CLIENTS} AND {_LOST})"
    clients = shapes.curated_clients(spark, sf_dir).where(kept)
    lines = _lines(shapes.curated_clients(spark, sf_dir, place).where(kept), S.CLIENTS)
    _deliver(spark, clients, S.CLIENTS, "client_id", dates, lines, w.inbound, no_ready=NO_READY_FILE)
    rates = shapes.rates(spark).join(transfers.select("business_date").distinct(), "business_date", "left_semi")
    reference.load_fx_rates(rates.where(f"{_KIND} <> {NO_RATES}"), w.fx)
    run_workflow(spark, w, dates, clock=lambda: dt.datetime.fromisoformat(RUN_TS))
    _done[key] = w
    return w


def _only(source: str, kinds: str) -> str:
    return f"(SELECT * FROM {source} WHERE {_KIND} {kinds}) x"


_CLIENTS_HERE = f"(SELECT * FROM clients WHERE {_KIND} > {NO_READY_FILE} AND NOT ({_KIND} = {LOST_CLIENTS} AND {_LOST})) x"
_CLIENT_COLUMNS = S.core_schema(S.CLIENTS).fieldNames()
_TRANSFER_COLUMNS = S.core_schema(S.TRANSFERS).fieldNames()


@query(sql(shown(_CLIENT_COLUMNS, _CLIENTS_HERE)))
def loaded_clients(spark, sf_dir):
    """Clients of all quarters as loaded from their files; a quarter without a ready file has none."""
    w = warehouse(spark, sf_dir)
    return read_table(spark, w.core(S.CLIENTS), S.core_schema(S.CLIENTS))


@query(sql(shown(_TRANSFER_COLUMNS, _only("transfers", f"> {LOST_CLIENTS}"))))
def loaded_transfers(spark, sf_dir):
    """Transfers as loaded: none of quarters with a wrong count, an unclosed quote or lost clients."""
    w = warehouse(spark, sf_dir)
    return read_table(spark, w.core(S.TRANSFERS), S.core_schema(S.TRANSFERS))


@query(sql(
    f"SELECT strftime(business_date, '%Y-%m-%d') AS business_date, source_row_num, transfer_id, transfer_title FROM ("
    f"SELECT *, 1 + row_number() OVER (PARTITION BY business_date ORDER BY transfer_id) AS source_row_num"
    f" FROM transfers) x WHERE {_KIND} > {LOST_CLIENTS}"
))
def raw_file_lines(spark, sf_dir):
    """The good quarters' transfer files read line by line: numbers and enclosed titles."""
    w = warehouse(spark, sf_dir)
    good = [e.business_date for e in versions.entries(spark, w.root) if e.group == S.TRANSFERS.name]
    raw = inbound.read_transfers_raw(spark, w.inbound, *good)
    return raw.select(
        "business_date",
        "source_row_num",
        F.col("transfer_id_raw").cast("long").alias("transfer_id"),
        F.nullif("transfer_title_raw", F.lit("")).alias("transfer_title"),
    )


@query(sql(shown(S.MART_COLUMNS, _only("mart", f"> {NO_RATES}"))))
def published_mart(spark, sf_dir):
    """The mart of all quarters that reached it, read through the manifests."""
    return read_table(spark, warehouse(spark, sf_dir).mart, mart_schema(spark))


@query(sql(
    "SELECT concat('aml_report_spool_', strftime(business_date, '%Y%m%d'), '.csv') AS file_name, line AS value"
    f" FROM ({review.LINES_SQL}) l WHERE {_KIND} > {NO_RATES}"
    " UNION ALL SELECT DISTINCT concat('aml_report_spool_', strftime(business_date, '%Y%m%d'), '.csv'),"
    f" '{';'.join(S.REPORT_COLUMNS)}' FROM mart WHERE {_KIND} > {NO_RATES}"
    " UNION ALL SELECT concat('aml_report_spool_', strftime(business_date, '%Y%m%d'), '.ok'),"
    " CAST(COUNT(*) FILTER (WHERE aml_review_flag = 1 AND report_type_candidate IS NOT NULL) AS VARCHAR)"
    f" FROM mart WHERE {_KIND} > {NO_RATES} GROUP BY business_date"
))
def published_reports(spark, sf_dir):
    """The exported report files and ready markers, line by line."""
    folder = warehouse(spark, sf_dir).outbound
    data = spark.read.text(f"{folder}/*.csv").select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.csv)/", 1).alias("file_name"), "value"
    )
    marks = spark.read.text(f"{folder}/*.ok").select(F.col("_metadata.file_name").alias("file_name"), "value")
    return data.unionByName(marks)


_STEPS = f"""
WITH_STEPS AS (
  SELECT d.business_date, {_KIND} AS kind, t.n AS transfers, c.n AS clients, coalesce(r.n, 0) AS reports
  FROM (SELECT DISTINCT business_date FROM transfers) d
  JOIN (SELECT business_date, COUNT(*) AS n FROM transfers GROUP BY 1) t USING (business_date)
  JOIN (SELECT business_date, COUNT(*) FILTER (WHERE NOT ({_KIND} = {LOST_CLIENTS} AND {_LOST})) AS n FROM clients GROUP BY 1) c
    USING (business_date)
  LEFT JOIN (SELECT business_date, COUNT(*) AS n FROM mart WHERE aml_review_flag = 1 AND report_type_candidate IS NOT NULL
    GROUP BY 1) r USING (business_date))
""".strip().replace("WITH_STEPS AS ", "")
_CONTROL_SQL = f"""
SELECT process_name, strftime(business_date, '%Y-%m-%d') AS business_date, status, reason_code, core_row_count
FROM (
  SELECT '{S.LOAD_CLIENTS}' AS process_name, business_date,
    CASE WHEN kind = {NO_READY_FILE} THEN 'FAILED' ELSE 'DONE' END AS status,
    CASE WHEN kind = {NO_READY_FILE} THEN 'MISSING_OK_MANUAL' ELSE 'LOAD_DONE' END AS reason_code,
    CASE WHEN kind = {NO_READY_FILE} THEN 0 ELSE clients END AS core_row_count FROM {_STEPS} s
  UNION ALL SELECT '{S.LOAD_TRANSFERS}', business_date,
    CASE WHEN kind <= {LOST_CLIENTS} THEN 'FAILED' ELSE 'DONE' END,
    CASE kind WHEN {WRONG_COUNT} THEN 'OK_COUNT_MISMATCH' WHEN {OPEN_QUOTE} THEN 'UNEXPECTED_ERROR'
      WHEN {LOST_CLIENTS} THEN 'MISSING_CLIENT_SNAPSHOT' ELSE 'LOAD_DONE' END,
    CASE WHEN kind <= {LOST_CLIENTS} THEN 0 ELSE transfers END FROM {_STEPS} s WHERE kind > {NO_READY_FILE}
  UNION ALL SELECT '{S.BUILD_MART}', business_date, CASE WHEN kind = {NO_RATES} THEN 'FAILED' ELSE 'DONE' END,
    CASE WHEN kind = {NO_RATES} THEN 'MISSING_FX_RATES' ELSE 'MART_BUILD_DONE' END,
    CASE WHEN kind = {NO_RATES} THEN 0 ELSE transfers END FROM {_STEPS} s WHERE kind >= {NO_RATES}
  UNION ALL SELECT '{S.BUILD_SPOOL}', business_date, 'DONE', 'SPOOL_BUILD_DONE', reports FROM {_STEPS} s WHERE kind > {NO_RATES}
  UNION ALL SELECT '{S.RUN_WORKFLOW}', business_date, CASE WHEN kind <= {NO_RATES} THEN 'FAILED' ELSE 'DONE' END,
    CASE WHEN kind <= {NO_RATES} THEN 'WORKFLOW_STEP_FAILED' ELSE 'WORKFLOW_DONE' END, 0 FROM {_STEPS} s) x
"""


@query(sql(_CONTROL_SQL.strip()))
def workflow_control(spark, sf_dir):
    """What the control table says of every step of every quarter."""
    control = read_control(spark, warehouse(spark, sf_dir))
    return control.select("process_name", "business_date", "status", "reason_code", "core_row_count")


_MART = CONSTRAINTS["mart_transfer_aml"]
_AUDIT_SQL = (
    "SELECT strftime(business_date, '%Y-%m-%d') AS business_date, COUNT(*) AS row_count, "
    + ", ".join(f"COUNT(*) FILTER (WHERE NOT ({c})) AS {n}" for n, c in _MART.checks.items())
    + ", "
    + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}_not_null" for c in _MART.not_null)
    + ", CAST(COUNT(*) - COUNT(DISTINCT transfer_id) AS BIGINT) AS repeated_keys FROM spoilt GROUP BY business_date"
)
_SPOILT = {
    "transfer_id": "CASE WHEN transfer_id % 97 = 0 THEN 97 ELSE transfer_id END",
    "amount_eur": "CASE WHEN transfer_id % 41 = 0 THEN -amount_eur ELSE amount_eur END",
    "full_name": "CASE WHEN transfer_id % 53 = 0 THEN NULL ELSE full_name END",
}
_SPOILT_SQL = ", ".join(f"{_SPOILT.get(c, c)} AS {c}" for c in S.MART_COLUMNS)


@query(sql(_AUDIT_SQL.replace("FROM spoilt", f"FROM (SELECT {_SPOILT_SQL} FROM mart) x")))
def mart_audit(spark, sf_dir):
    """Per quarter the mart rows that break each constraint, in a mart with planted ones."""
    mart = review.mart(spark, sf_dir)
    return audit(mart.select(*[F.expr(_SPOILT.get(c, c)).alias(c) for c in S.MART_COLUMNS]), _MART)

