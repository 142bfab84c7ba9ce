"""The given tables in the shape of the pipeline's inputs.

The texts below only shape test input, in SQL that Spark and DuckDB both run:

* inbound transfers: every ``lineitem`` row as a line of a daily file, client =
  order / 10; repeated (order, line) pairs are natural duplicate keys;
* inbound clients: every ``customer`` and, as a second line for some of them,
  every ``supplier``;
* curated transfers and clients: every ``orders`` row, and every ``customer`` once
  per quarter.

Inbound fields are spoilt in many ways on the first five of the seven dates and
clean on the last two.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.sources import reference

FIRST_DAY = 13  # of April 2026
DATES = [dt.date(2026, 4, FIRST_DAY + i) for i in range(7)]
#: Quarters that have rates; those of the clients come from the orders.
QUARTERS = [dt.date(y, m, 1) for y in range(1990, 2030) for m in (1, 4, 7, 10)]
Place = Callable[[DataFrame, str, str], DataFrame]
RATE_DAY = dt.date(2001, 7, 1)  # whose rates the days of April 2026 take

INBOUND_TRANSFERS = """
SELECT
  cast(concat('2026-04-', 13 + client_id % 7) AS date) AS business_date,
  concat('client_transfers_202604', 13 + client_id % 7, '.csv') AS source_file_name,
  l_partkey + 2 AS source_row_num,
  CASE s WHEN 0 THEN 'BAD_ID' WHEN 1 THEN concat('  ', transfer_id, ' ')
    WHEN 37 THEN concat(transfer_id, '.00000000001') WHEN 38 THEN concat(transfer_id, '.00000000000')
    ELSE concat('', transfer_id) END AS transfer_id_raw,
  CASE s WHEN 2 THEN concat('C-', client_id) ELSE concat('', client_id) END AS client_id_raw,
  CASE s WHEN 3 THEN '   ' WHEN 4 THEN repeat('9', 35)
    ELSE concat('PL', lpad(concat('', l_suppkey), 24, '0')) END AS source_account_raw,
  CASE s WHEN 5 THEN '' WHEN 6 THEN repeat('8', 35)
    ELSE concat('DE', lpad(concat('', l_partkey), 20, '0')) END AS target_account_raw,
  CASE s WHEN 7 THEN 'NOT_A_NUMBER' WHEN 8 THEN '-12.50' WHEN 9 THEN '1.25E3'
    WHEN 10 THEN '0.005' WHEN 11 THEN '.5' WHEN 12 THEN '12d' WHEN 33 THEN 'x'
    WHEN 34 THEN '0.00499999999999' WHEN 35 THEN '15000.00499999999999' WHEN 36 THEN '-0.00000000001'
    WHEN 39 THEN '15000.00500000000001' WHEN 40 THEN '-0.00000000000' WHEN 41 THEN '12500000000001E-14'
    ELSE concat('', cast(l_extendedprice AS decimal(14,2))) END AS amount_raw,
  CASE s WHEN 13 THEN ' eur ' WHEN 14 THEN 'EURO' WHEN 15 THEN 'XYZ' WHEN 16 THEN NULL
    ELSE substr('EURUSDPLNCZKGBP', cast(1 + 3 * (l_partkey % 5) AS int), 3) END AS currency_code_raw,
  CASE s WHEN 17 THEN replace(ts, '-', '/') WHEN 18 THEN 'yesterday' WHEN 19 THEN '2026-02-30 10:00:00'
    WHEN 20 THEN concat('2026-', 1 + l_partkey % 9, '-', 1 + l_suppkey % 9, ' 4:5:6')
    WHEN 21 THEN '' ELSE ts END AS transfer_ts_raw,
  CASE s WHEN 22 THEN 'UNKNOWN' WHEN 23 THEN ' completed ' WHEN 24 THEN ' '
    ELSE CASE l_partkey % 4 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'PENDING'
      WHEN 2 THEN 'REJECTED' ELSE 'FAILED' END END AS transfer_status_raw,
  CASE WHEN s IN (25, 33) THEN 'KIOSK' WHEN s = 26 THEN NULL
    ELSE CASE l_suppkey % 4 WHEN 0 THEN 'API' WHEN 1 THEN 'branch'
      WHEN 2 THEN 'MOBILE' ELSE ' WEB' END END AS channel_raw,
  CASE s WHEN 27 THEN 'POL' WHEN 28 THEN 'ZZ' WHEN 29 THEN '' WHEN 33 THEN ' '
    ELSE substr({countries}, cast(1 + 2 * (l_suppkey % 33) AS int), 2) END AS country_code_raw,
  CASE s WHEN 30 THEN repeat('t', 256) WHEN 31 THEN concat('  Rent ', l_partkey, '  ') WHEN 32 THEN NULL
    ELSE concat('Payment ', l_partkey) END AS transfer_title_raw
FROM (
  SELECT l.*,
    l_orderkey * 8 + l_linenumber AS transfer_id,
    cast(floor(l_orderkey / 10) AS bigint) AS client_id,
    concat('', cast(l_shipdate AS date), ' ', lpad(concat('', 8 + l_linenumber), 2, '0'),
      ':15:', lpad(concat('', l_partkey % 60), 2, '0')) AS ts,
    CASE WHEN cast(floor(l_orderkey / 10) AS bigint) % 7 < 5
      THEN (l_orderkey * 8 + l_linenumber + l_partkey) % 60 ELSE 99 END AS s
  FROM {lineitem} l
) x
"""

INBOUND_CLIENTS = """
SELECT
  cast(concat('2026-04-', 13 + id % 7) AS date) AS business_date,
  concat('clients_202604', 13 + id % 7, '.csv') AS source_file_name,
  id + 2 AS source_row_num,
  CASE s WHEN 0 THEN 'not a date' WHEN 1 THEN '2026-01-01' WHEN 2 THEN concat('2026/4/', 13 + id % 7)
    ELSE concat('2026-04-', 13 + id % 7) END AS business_date_raw,
  CASE s WHEN 3 THEN concat('X', id) ELSE concat('', id) END AS client_id_raw,
  CASE WHEN s = 4 THEN concat(' ', lower(kind), ' ') WHEN s = 5 THEN 'PARTNER' WHEN s IN (6, 40) THEN NULL
    ELSE kind END AS client_type_raw,
  CASE WHEN s IN (7, 40) THEN ' ' WHEN s = 8 THEN repeat('n', 201) ELSE name END AS full_name_raw,
  CASE WHEN s = 34 THEN NULL WHEN s = 41 THEN repeat('f', 101) WHEN kind = 'PRIVATE' THEN 'First'
    END AS first_name_raw,
  CASE WHEN kind = 'PRIVATE' THEN name END AS last_name_raw,
  CASE WHEN s = 36 THEN NULL WHEN kind = 'BUSINESS' THEN name END AS company_name_raw,
  CASE WHEN s = 33 THEN '31 Dec' WHEN kind = 'PRIVATE'
    THEN concat(1950 + id % 50, '-', 1 + id % 12, '-', 1 + id % 28) END AS date_of_birth_raw,
  CASE WHEN s = 35 THEN '' WHEN kind = 'BUSINESS' THEN concat('REG-', id) END AS registration_no_raw,
  CASE WHEN s = 9 THEN NULL WHEN s = 42 THEN repeat('a', 201)
    ELSE concat(id, ' Main Street') END AS address_line_1_raw,
  CASE s WHEN 9 THEN '' ELSE concat('City ', nation) END AS city_raw,
  CASE s WHEN 10 THEN repeat('1', 21) ELSE lpad(concat('', id % 100000), 5, '0') END AS postal_code_raw,
  CASE s WHEN 11 THEN 'POL' WHEN 12 THEN 'ZZ' WHEN 13 THEN ' de '
    ELSE substr({countries}, cast(1 + 2 * (nation % 33) AS int), 2) END AS country_code_raw,
  CASE s WHEN 17 THEN 'Y' WHEN 18 THEN '2' WHEN 19 THEN '1.0'
    ELSE CASE WHEN id % 29 = 0 THEN '1' ELSE '0' END END AS pep_flag_raw,
  CASE s WHEN 20 THEN '' ELSE CASE WHEN id % 3 = 0 THEN ' 1 ' ELSE '0' END END AS high_risk_flag_raw,
  CASE s WHEN 27 THEN 'SUSPENDED' WHEN 28 THEN NULL
    ELSE CASE WHEN id % 11 = 0 THEN 'archived' ELSE 'ACTIVE' END END AS client_status_raw,
  CASE s WHEN 37 THEN repeat('d', 101) ELSE concat('DOC-', id) END AS document_id_raw,
  CASE s WHEN 38 THEN repeat('t', 101) ELSE concat('TAX-', id) END AS tax_id_raw,
  CASE s WHEN 14 THEN '0048123456789' WHEN 15 THEN concat('+', repeat('4', 50)) WHEN 16 THEN ''
    ELSE concat('+48', lpad(concat('', id % 1000000000), 9, '0')) END AS phone_number_raw,
  CASE s WHEN 16 THEN 'no.at.example.invalid' WHEN 17 THEN 'a b@example.invalid'
    ELSE concat('c', id, '@example.invalid') END AS email_raw,
  CASE s WHEN 21 THEN repeat('K', 31) WHEN 22 THEN 'ES-CALATED' WHEN 23 THEN 'ESCALATED'
    ELSE CASE id % 6 WHEN 0 THEN 'pass' WHEN 1 THEN 'REVIEW' WHEN 2 THEN 'PENDING'
      WHEN 3 THEN 'LIMITED' WHEN 4 THEN 'MANUAL_CHECK' END END AS kyc_status_raw,
  CASE WHEN s = 24 THEN '1000' WHEN s IN (25, 40) THEN 'NaN' WHEN s = 26 THEN '899.5' WHEN s = 39 THEN NULL
    ELSE concat('', id * 37 % 1000) END AS risk_score_raw,
  CASE s WHEN 29 THEN 'GAMBLING' WHEN 30 THEN 'A B'
    ELSE CASE id % 6 WHEN 0 THEN 'SALARY' WHEN 1 THEN 'savings' WHEN 2 THEN 'REMITTANCE'
      WHEN 3 THEN 'INVESTMENT' WHEN 4 THEN 'BUSINESS_PAYMENTS' END END AS relationship_purpose_code_raw,
  CASE s WHEN 31 THEN 'EXTREME' WHEN 32 THEN repeat('L', 51)
    ELSE CASE id % 6 WHEN 0 THEN 'LOW' WHEN 1 THEN 'medium' WHEN 2 THEN 'HIGH'
      WHEN 3 THEN 'VERY_HIGH' WHEN 4 THEN 'UNKNOWN' END END AS expected_activity_level_raw,
  CASE s WHEN 39 THEN repeat('s', 256) ELSE concat('Funds ', id % 10) END AS source_of_funds_declared_raw,
  CASE WHEN id % 4 > 0 THEN concat('Wealth ', id % 10) END AS source_of_wealth_declared_raw
FROM (
  SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'BUSINESS' ELSE 'PRIVATE' END AS kind,
    CASE WHEN c_custkey % 7 < 5 THEN c_custkey % 43 ELSE 99 END AS s
  FROM {customer}
  UNION ALL
  SELECT s_suppkey * 7 AS id, s_name AS name, s_nationkey AS nation, 'BUSINESS' AS kind, 99 AS s
  FROM {supplier}
) x
"""

_QUARTER = "make_date(year(o_orderdate), 3 * quarter(o_orderdate) - 2, 1)"

CURATED_TRANSFERS = """
SELECT
  {quarter} AS business_date,
  o_orderkey AS transfer_id,
  o_custkey AS client_id,
  concat('PL', lpad(concat('', o_custkey), 24, '0')) AS source_account,
  concat('DE', lpad(concat('', o_orderkey), 20, '0')) AS target_account,
  cast(cast(floor(o_totalprice * 100 / 20 + 0.5) AS decimal(14,0)) * 0.01 AS decimal(14,2)) AS amount,
  substr('EURUSDPLNCZKGBP', cast(1 + 3 * (o_orderkey % 5) AS int), 3) AS currency_code,
  o_orderdate AS transfer_ts,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'FAILED' END AS transfer_status,
  CASE o_orderkey % 4 WHEN 0 THEN 'API' WHEN 1 THEN 'BRANCH' WHEN 2 THEN 'MOBILE' ELSE 'WEB' END AS channel,
  substr({countries}, cast(1 + 2 * (o_orderkey % 33) AS int), 2) AS country_code,
  CASE WHEN o_orderkey % 3 > 0 THEN concat('Order "', o_orderpriority, '"; ', o_orderkey) END AS transfer_title
FROM {orders}
""".replace("{quarter}", _QUARTER)

CURATED_CLIENTS = """
SELECT
  snapshot AS business_date,
  id AS client_id,
  kind AS client_type,
  c_name AS full_name,
  CASE WHEN kind = 'PRIVATE' THEN 'First' END AS first_name,
  CASE WHEN kind = 'PRIVATE' THEN c_name END AS last_name,
  CASE WHEN kind = 'BUSINESS' THEN c_name END AS company_name,
  CASE WHEN kind = 'PRIVATE' THEN make_date(1950 + cast(id % 50 AS int), 1 + cast(id % 12 AS int),
    1 + cast(id % 28 AS int)) END AS date_of_birth,
  concat('DOC-', id) AS document_id,
  CASE WHEN kind = 'BUSINESS' THEN concat('REG-', id) END AS registration_no,
  concat('TAX-', id) AS tax_id,
  concat(id, ' Main Street') AS address_line_1,
  concat('City ', c_nationkey) AS city,
  lpad(concat('', id % 100000), 5, '0') AS postal_code,
  substr({countries}, cast(1 + 2 * (c_nationkey % 33) AS int), 2) AS country_code,
  concat('+48', lpad(concat('', id % 1000000000), 9, '0')) AS phone_number,
  concat('c', id, '@example.invalid') AS email,
  CASE WHEN id % 29 = 0 THEN 1 ELSE 0 END AS pep_flag,
  CASE WHEN id % 7 = 0 THEN 1 ELSE 0 END AS high_risk_flag,
  CASE id % 6 WHEN 0 THEN 'PASS' WHEN 1 THEN 'REVIEW' WHEN 2 THEN 'PENDING'
    WHEN 3 THEN 'LIMITED' WHEN 4 THEN 'MANUAL_CHECK' END AS kyc_status,
  CASE WHEN id % 10 > 0 THEN cast(id * 37 % 1000 AS int) END AS risk_score,
  CASE WHEN id % 11 = 0 THEN 'ARCHIVED' ELSE 'ACTIVE' END AS client_status,
  CASE id % 6 WHEN 0 THEN 'SALARY' WHEN 1 THEN 'SAVINGS' WHEN 2 THEN 'REMITTANCE'
    WHEN 3 THEN 'INVESTMENT' WHEN 4 THEN 'BUSINESS_PAYMENTS' END AS relationship_purpose_code,
  CASE id % 6 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HIGH'
    WHEN 3 THEN 'VERY_HIGH' WHEN 4 THEN 'UNKNOWN' END AS expected_activity_level,
  concat('Funds ', id % 10) AS source_of_funds_declared,
  CASE WHEN id % 4 > 0 THEN concat('Wealth ', id % 10) END AS source_of_wealth_declared
FROM (
  SELECT c.*, c_custkey AS id,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'BUSINESS' ELSE 'PRIVATE' END AS kind,
    {quarters} AS snapshot
  FROM {customer} c
) x
"""

_COUNTRIES = "'" + "".join(S.COUNTRIES) + "'"


def _rates():
    """Five currencies per quarter, drifting a little; CZK is quoted per 10."""
    start = {"EUR": (1, "4.1873"), "USD": (1, "3.6219"), "GBP": (1, "5.3127"), "PLN": (1, "1"), "CZK": (10, "1.6941")}
    for i, day in enumerate(QUARTERS):
        for code, (units, mid) in start.items():
            drift = Decimal("0.0007") * i if code != "PLN" else Decimal(0)
            yield day, code, units, Decimal(mid) + drift


RATES = list(_rates())
#: The same rates with gaps: no USD in some quarters, no EUR in others, none at all in one.
RATES_WITH_GAPS = [
    (day, code, units, mid)
    for day, code, units, mid in RATES
    if not (
        (code in ("USD", "CZK") and day.month == 4 and day.year % 2)
        or (code == "EUR" and day.month == 10 and day.year % 3 == 0)
        or day == dt.date(2000, 1, 1)
    )
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A small table over as many tasks as a shuffle has.

    Its file is one split, but what is made of its rows (judging them, a snapshot of each per
    quarter) is far more work than reading them, and would all fall to the task that reads.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def inbound_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        INBOUND_TRANSFERS.replace("{countries}", _COUNTRIES), lineitem=table(spark, sf_dir, "lineitem")
    )


def inbound_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        INBOUND_CLIENTS.replace("{countries}", _COUNTRIES),
        customer=spread(table(spark, sf_dir, "customer")),
        supplier=spread(table(spark, sf_dir, "supplier")),
    )


def curated_transfers(spark: SparkSession, sf_dir: str, place: Place | None = None) -> DataFrame:
    """``place`` puts the rows in the tasks that need them before they get wide: (rows, day, key) -> rows."""
    orders = table(spark, sf_dir, "orders")
    if place is not None:
        orders = place(orders.withColumn("day", F.expr(_QUARTER)), "day", "o_orderkey")
    return spark.sql(CURATED_TRANSFERS.replace("{countries}", _COUNTRIES), orders=orders)


def curated_clients(spark: SparkSession, sf_dir: str, place: Place | None = None) -> DataFrame:
    """``place`` as for the transfers."""
    customer, orders = spread(table(spark, sf_dir, "customer")), table(spark, sf_dir, "orders")
    quarters = f"explode((SELECT collect_set({_QUARTER}) FROM {{orders}}))"
    if place is not None:
        unfolded = spark.sql(f"SELECT c.*, {quarters} AS day FROM {{customer}} c", customer=customer, orders=orders)
        customer, quarters = place(unfolded, "day", "c_custkey"), "day"
    return spark.sql(
        CURATED_CLIENTS.replace("{countries}", _COUNTRIES).replace("{quarters}", quarters),
        customer=customer,
        orders=orders,
    )


def rates(spark: SparkSession, gaps: bool = False) -> DataFrame:
    return reference.fx_rates(spark, RATES_WITH_GAPS if gaps else RATES)


# --- The same inputs for DuckDB ----------------------------------------------


def _rates_sql(rows) -> str:
    values = ", ".join(
        f"(DATE '{d}', '{code}', {units}, CAST({mid} AS DECIMAL(18,8)), '{S.RATE_SOURCE}', DATE '{d}')"
        for d, code, units, mid in rows
    )
    return (
        f"SELECT * FROM (VALUES {values}) v(business_date, currency_code, unit_count,"
        " mid_rate_pln, rate_source, published_date)"
    )


def duck(text: str) -> str:
    """A shaping text on DuckDB's views."""
    quarters = f"unnest((SELECT list(DISTINCT {_QUARTER}) FROM orders))"
    for name, value in {
        "countries": _COUNTRIES, "quarters": quarters, "lineitem": "lineitem", "orders": "orders",
        "customer": "customer", "supplier": "supplier",
    }.items():
        text = text.replace("{" + name + "}", value)
    return text.strip()


INPUT_CTES = {
    "inbound_transfers": duck(INBOUND_TRANSFERS),
    "inbound_clients": duck(INBOUND_CLIENTS),
    "transfers": duck(CURATED_TRANSFERS),
    "clients": duck(CURATED_CLIENTS),
    "fx": _rates_sql(RATES),
    "fx_gaps": _rates_sql(RATES_WITH_GAPS),
}
