"""Two versions of a table compared by digests; day sketches against exact counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators import digests, sketches
from tidegate.sources import versions
from tidegate.sources.files import work_folder
from workload import shapes
from workload.inbound import stored
from workload.oracle import sql
from workload.registry import query

_KEYS = ["transfer_id"]
#: What the second version has changed, in quarters of one year only.
_CHANGED = {
    "amount": "CASE WHEN {q} AND transfer_id % 211 = 0 THEN cast(amount + 1 AS decimal(14,2)) ELSE amount END",
    "transfer_title": "CASE WHEN {q} AND transfer_id % 307 = 0 THEN NULL ELSE transfer_title END",
    "channel": "CASE WHEN {q} AND transfer_id % 211 = 0 AND client_id % 2 = 0 THEN 'OTHER' ELSE channel END",
}
_QUARTERS = "year(business_date) = 1995"
_COLUMNS = S.core_schema(S.TRANSFERS).fieldNames()
_SECOND = ", ".join(f"{_CHANGED[c].format(q=_QUARTERS)} AS {c}" if c in _CHANGED else c for c in _COLUMNS)
_REMOVED = f"{_QUARTERS} AND transfer_id % 401 = 0"
_ADDED = f"{_QUARTERS} AND transfer_id % 503 = 0"
_VALUES = [c for c in _COLUMNS if c not in ("business_date", *_KEYS)]


def _second(first):
    """The first version with planted differences."""
    changed = first.where(f"NOT ({_REMOVED})").selectExpr(*[p.strip() for p in _split(_SECOND)])
    added = first.where(_ADDED).withColumn("transfer_id", -F.col("transfer_id"))
    return changed.unionByName(added)


def _split(text):
    """Select items at commas outside of brackets."""
    out, depth = [""], 0
    for c in text:
        depth += {"(": 1, ")": -1}.get(c, 0)
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


_DIFFERENCES = f"""
WITH_TWO AS (SELECT {_SECOND} FROM transfers WHERE NOT ({_REMOVED})
  UNION ALL SELECT business_date, -transfer_id, {', '.join(_VALUES)} FROM transfers WHERE {_ADDED})
SELECT strftime(coalesce(a.business_date, b.business_date), '%Y-%m-%d') AS business_date,
  coalesce(a.transfer_id, b.transfer_id) AS transfer_id,
  CASE WHEN a.transfer_id IS NULL THEN 'ADDED' WHEN b.transfer_id IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change,
  CASE WHEN a.transfer_id IS NOT NULL AND b.transfer_id IS NOT NULL THEN concat_ws(',',
    {', '.join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _VALUES)}) END AS changed_columns
FROM transfers a FULL OUTER JOIN two b ON a.business_date = b.business_date AND a.transfer_id = b.transfer_id
WHERE a.transfer_id IS NULL OR b.transfer_id IS NULL
  OR {' OR '.join(f'a.{c} IS DISTINCT FROM b.{c}' for c in _VALUES)}
"""
_TWO, _DIFFERENCES = _DIFFERENCES.strip().removeprefix("WITH_TWO AS ").split("\nSELECT strftime", 1)


@query(sql("SELECT strftime" + _DIFFERENCES.replace("FULL OUTER JOIN two b", f"FULL OUTER JOIN {_TWO} b")))
def differing_rows(spark, sf_dir):
    """Rows that differ between two stored versions: digests name the buckets, only their dates are read again."""
    table = f"{work_folder(spark, 'versions')}/core"
    first = shapes.curated_transfers(spark, sf_dir)
    schema = S.core_schema(S.TRANSFERS)
    sums, readers = [], []
    for name, df in (("one", first.select(*_COLUMNS)), ("two", _second(first).select(*_COLUMNS))):
        versions.write_version(df, table, name)
        written = versions.read_version(spark, table, name, schema)
        sums.append(stored(spark, digests.digests(written, _KEYS), "digests"))
        readers.append(lambda dates, df=written: df.where(F.col("business_date").isin(dates)))
    where = stored(spark, digests.differing(*sums), "differing")
    return digests.changed_rows(*readers, where, _KEYS)




@query(sql(
    "SELECT year(business_date) AS year, COUNT(*) AS row_count, COUNT(DISTINCT client_id) AS clients,"
    " COUNT(DISTINCT transfer_id) AS transfers, TRUE AS clients_within, TRUE AS transfers_within,"
    " TRUE AS median_within, TRUE AS tail_within FROM transfers GROUP BY year(business_date)"
))
def sketched_years(spark, sf_dir):
    """Years merged from stored sketches of their quarters, held against exact counts within three standard errors."""
    rows = shapes.curated_transfers(spark, sf_dir).select("business_date", "client_id", "transfer_id", "amount")
    days = stored(spark, sketches.day_sketches(rows, ["client_id", "transfer_id"], ["amount"]), "sketches")
    year = F.year("business_date").cast("long").alias("year")
    found = sketches.merged(days, [year], ["client_id", "transfer_id"], ["amount"], (0.5, 0.95))
    exact = rows.withColumn("year", year).join(F.broadcast(found.select("year", "amount_q50", "amount_q95")), "year")
    exact = exact.groupBy("year").agg(
        F.countDistinct("client_id").alias("clients"),
        F.countDistinct("transfer_id").alias("transfers"),
        F.avg((F.col("amount") <= F.col("amount_q50")).cast("int")).alias("below_median"),
        F.avg((F.col("amount") <= F.col("amount_q95")).cast("int")).alias("below_tail"),
    )

    def near(estimate, value):
        return F.abs(F.col(estimate) - F.col(value)) <= F.greatest(F.lit(1.0), 3 * sketches.standard_error() * F.col(value))

    off = 3 * sketches.rank_error()
    return found.join(exact, "year").select(
        "year",
        "row_count",
        "clients",
        "transfers",
        near("client_id_estimate", "clients").alias("clients_within"),
        near("transfer_id_estimate", "transfers").alias("transfers_within"),
        F.col("below_median").between(0.5 - off, 0.5 + off).alias("median_within"),
        F.col("below_tail").between(0.95 - off, 0.95 + off).alias("tail_within"),
    )
