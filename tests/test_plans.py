"""Physical plans: what is read, what is shuffled, what is broadcast."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators import gates
from tidegate.plans.mart import build_mart
from tidegate.plans.runs import on_dates
from tidegate.plans.spool import build_spool
from tidegate.sources import inbound, reference, versions
from tidegate.sources.tables import overwrite_date, read_table
from workload import files as delivered
from workload import shapes

DAYS = [dt.date(2026, 5, 1), dt.date(2026, 5, 2)]


@pytest.fixture(scope="module")
def core(spark, tmp_path_factory):
    """Core tables where one client holds a third of the transfers."""
    root = tmp_path_factory.mktemp("core")
    n = 30000

    def fill(schema, known):
        return [
            known.get(f.name, F.lit("1" if f.dataType.typeName() != "string" else "X")).cast(f.dataType).alias(f.name)
            for f in schema
        ]

    date = F.when(F.col("id") % 2 == 0, F.lit(DAYS[0])).otherwise(F.lit(DAYS[1]))
    transfers = spark.range(0, n, 1, 8).select(
        *fill(S.core_schema(S.TRANSFERS), {
            "business_date": F.lit(DAYS[0]),
            "transfer_id": F.col("id"),
            "client_id": F.when(F.col("id") < n // 3, 0).otherwise(F.col("id") % 900),
            "amount": F.lit("10.00"),
            "currency_code": F.lit("USD"),
            "transfer_ts": F.lit("2026-05-01 10:00:00"),
            "transfer_title": F.sha2(F.col("id").cast("string"), 256),
        })
    )
    clients = spark.range(0, 2000, 1, 4).select(
        *fill(S.core_schema(S.CLIENTS), {
            "business_date": date, "client_id": F.floor(F.col("id") / 2), "date_of_birth": F.lit("1980-01-01"),
        })
    )
    overwrite_date(transfers, str(root / "t"))
    overwrite_date(clients, str(root / "c"))
    fx = reference.fx_rates(spark, [(d, c, 1, Decimal(m)) for d in DAYS for c, m in (("EUR", "4"), ("USD", "3"))])
    return (
        lambda: read_table(spark, str(root / "t"), S.core_schema(S.TRANSFERS)),
        lambda: read_table(spark, str(root / "c"), S.core_schema(S.CLIENTS)),
        fx,
        n,
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_reads_one_date_and_only_the_columns_it_needs(spark, core):
    transfers, clients, fx, _ = core
    mart = build_mart(on_dates(transfers(), DAYS[:1]), on_dates(clients(), DAYS[:1]), fx)
    plan = plan_of(mart)
    assert plan.count("PartitionFilters: [isnotnull(business_date") == 2
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", mart._jdf.queryExecution().toString())
    assert "PythonUDF" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    scan = [s for s in schemas if "pep_flag" in s]
    assert scan and all("address_line_1" not in s and "email" not in s for s in scan)


def test_counting_the_mart_reads_keys_only(spark, core):
    transfers, clients, fx, n = core
    counts = build_mart(transfers(), clients(), fx).groupBy("business_date").agg(F.count("*").alias("n"))
    text = counts._jdf.queryExecution().toString()
    assert "full_name" not in text[text.index("== Physical Plan"):]
    assert [tuple(r) for r in counts.collect()] == [(DAYS[0], n)]


def test_busy_client_is_split_over_tasks(spark, core):
    transfers, clients, fx, n = core
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "10KB",  # rates only
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        mart = build_mart(transfers(), clients(), fx)
        assert len(mart.collect()) == n
        assert "skew=true" in plan_of(mart)
        # The report joins clients on the same key again; both joins are split.
        mart = mart.withColumns({"aml_review_flag": F.lit(1), "report_type_candidate": F.lit("ART74_SUSPICION")})
        spool = build_spool(mart, clients(), dt.datetime(2026, 5, 3))
        assert len(spool.collect()) == n
        final = plan_of(spool).split("== Initial Plan ==")[0]
        assert final.count("SortMergeJoin(skew=true)") == 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_missing_client_gate_joins_one_row_per_client(spark, core):
    transfers, clients, _, n = core
    gate = gates.missing_clients(transfers(), clients().filter("client_id <> 0"))
    plan = plan_of(gate)
    assert "LeftAnti" not in plan
    assert plan.index("LeftOuter") < plan.index("partial_count")
    (row,) = gate.collect()
    assert row.missing_rows >= n // 3


def test_clients_are_never_sent_through_the_driver(spark, core):
    """Both sides are far below the broadcast threshold here, as a client table that unfolds by date seems to be."""
    transfers, clients, fx, _ = core
    mart = build_mart(transfers(), clients(), fx)
    assert plan_of(mart).count("SortMergeJoin [business_date") == 1
    spool = build_spool(mart, clients(), dt.datetime(2026, 5, 3))
    assert plan_of(spool).count("SortMergeJoin [business_date") == 2


def test_small_tables_are_dealt_to_all_tasks(spark, tmp_path):
    """A file of one split: a snapshot per quarter and the row rules are not all made by the task that reads it."""
    spark.range(100).selectExpr(
        "id AS c_custkey", "concat('n', id) AS c_name", "cast(id % 25 AS int) AS c_nationkey", "'BUILDING' AS c_mktsegment"
    ).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(10).selectExpr(
        "id AS s_suppkey", "concat('s', id) AS s_name", "cast(id % 25 AS int) AS s_nationkey"
    ).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(10).selectExpr(
        "timestamp_ntz'2001-01-05 00:00:00' + make_interval(0, 3 * cast(id % 2 AS int)) AS o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    curated = shapes.curated_clients(spark, str(tmp_path))
    assert curated.count() == 200 and curated.select(F.spark_partition_id()).distinct().count() == tasks
    raw = shapes.inbound_clients(spark, str(tmp_path))
    assert raw.count() == 110 and raw.select(F.spark_partition_id()).distinct().count() == 2 * tasks


def test_rates_do_not_move_the_transfers_again(spark, core):
    """The size of the rates joined with the base rates is guessed as a product, here above the threshold."""
    transfers, clients, fx, _ = core
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1KB")
        plan = plan_of(build_mart(transfers(), clients(), fx))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(business_date" in plan and not re.search(r"hashpartitioning\(business_date#\d+, currency_code", plan)


def test_numbered_lines_stay_in_their_tasks(spark, tmp_path):
    """Lines meet the offsets of their split without a shuffle, whatever Spark guesses of the offsets."""
    (tmp_path / "clients_20260501.csv").write_text("h\na\nb\n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        lines = inbound.with_source_row_num(inbound.read_lines(spark, f"{tmp_path}/*.csv"))
        plan = plan_of(lines)
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert sorted((r.source_row_num, r.value) for r in lines.collect()) == [(1, "h"), (2, "a"), (3, "b")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_delivered_lines_are_made_after_the_rows_moved(spark, tmp_path):
    """Each date's rows come to one task in order of the key while they are narrow; its first line is the header."""
    spark.range(40).selectExpr(
        "(39 - id) AS c_custkey", "concat('n;', id) AS c_name", "cast(id % 25 AS int) AS c_nationkey", "'BUILDING' AS c_mktsegment"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(10).selectExpr(
        "timestamp_ntz'2001-01-05 00:00:00' + make_interval(0, 3 * cast(id % 2 AS int)) AS o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    dates = [dt.date(2001, 1, 1), dt.date(2001, 4, 1)]
    rows = shapes.curated_clients(spark, str(tmp_path), delivered._place(dates))
    lines = delivered._lines(rows, S.CLIENTS)
    moved = [line for line in plan_of(lines).splitlines() if "Exchange" in line]
    assert moved and all("concat" not in line and "_raw" not in line for line in moved)
    found = lines.withColumn("task", F.spark_partition_id()).collect()
    for task, date in enumerate(dates):
        header, *data = [r.line for r in found if r.task == task]
        assert header.startswith("business_date;client_id;")
        assert [line.split(";")[:2] for line in data] == [[str(date), str(i)] for i in range(40)]
        assert '"n;39"' in data[0]


def test_tables_of_neighbouring_numbers_are_compressed(spark, tmp_path):
    rows = spark.range(1000).select("id", F.lit(DAYS[0]).alias("business_date"))
    versions.write_version(rows, str(tmp_path / "t"), "one")
    assert list((tmp_path / "t").rglob("*.zstd.parquet"))


def test_parents_of_the_client_gate_are_never_sent_through_the_driver(spark, core):
    """The keys of stored clients seem small enough here, as they do at any size once they are well compressed."""
    transfers, clients, _, _ = core
    plan = plan_of(gates.missing_clients(transfers(), clients()))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
