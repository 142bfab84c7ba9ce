"""Accept / reject split: nothing lost, order irrelevant, hot keys spread."""

import datetime as dt
import random

import snapshots as X
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators import aggregates, gates, split
from tidegate.operators.control import upsert_runs
from tidegate.sources import inbound, reference
from workload import control, registry, storage  # noqa: F401
from workload import inbound as workload_inbound

DAY = X.MAR[0]


def raw_transfers(spark, lines):
    df = spark.createDataFrame(
        [(line, f"client_transfers_{DAY:%Y%m%d}.csv", i + 2) for i, line in enumerate(lines)],
        "value string, source_file_name string, source_row_num long",
    )
    return inbound.parse_lines(df, S.TRANSFERS)


def run(spark, lines):
    got = split.split_transfers(
        raw_transfers(spark, lines), reference.ref_currency(spark), reference.ref_country(spark)
    )
    return got.stage.collect(), got.reject.collect()


def random_lines(seed, n):
    rng = random.Random(seed)
    spoil = [
        {}, {}, {}, {"amount": "x"}, {"currency": "EURO"}, {"currency": "ABC"}, {"country_code": ""},
        {"channel": "KIOSK"}, {"transfer_ts": "2026/1/1 1:1:1"}, {"transfer_status": " done "},
        {"source_account": "9" * 35}, {"transfer_title": "t" * 256},
    ]
    return [X.transfer(DAY, rng.randrange(n), rng.randrange(50), **rng.choice(spoil)) for _ in range(n)] + ["", ";;;"]


def test_split_is_a_partition_and_ignores_order(spark):
    lines = random_lines(7, 300)
    stage, reject = run(spark, lines)
    assert len(stage) + len(reject) == len(lines)
    rows = [r.source_row_num for r in stage + reject]
    assert sorted(rows) == list(range(2, len(lines) + 2))
    shuffled = lines[::-1]
    stage2, reject2 = run(spark, shuffled)
    assert sorted(r.transfer_id for r in stage) == sorted(r.transfer_id for r in stage2)

    def reasons(rows):
        return sorted((r.transfer_id_raw or "", r.reject_reason) for r in rows)

    assert reasons(reject) == reasons(reject2)


def test_valid_twin_of_an_invalid_row_stays_and_valid_twins_all_go(spark):
    stage, reject = run(spark, [
        X.transfer(DAY, 1, 1), X.transfer(DAY, 1, 1, amount="x"),
        X.transfer(DAY, 2, 1), X.transfer(DAY, "2.0", 1), X.transfer(DAY, 2, 1, channel=""),
        X.transfer(DAY, 3, 1),
    ])
    assert sorted(r.transfer_id for r in stage) == [1, 3]
    assert {r.source_row_num: r.reject_reason for r in reject} == {
        3: "invalid amount", 4: "duplicate transfer_id in snapshot",
        5: "duplicate transfer_id in snapshot", 6: "missing channel",
    }


def test_messages_accumulate_in_rule_order(spark):
    _, reject = run(spark, [";;;;-1;zzz;;;;;"])
    assert reject[0].reject_reason == (
        "invalid transfer_id; invalid client_id; missing source_account; missing target_account; "
        "negative amount; unsupported currency_code; invalid transfer_ts; missing transfer_status; "
        "missing channel; missing country_code"
    )


def test_inactive_codes_are_unsupported(spark):
    currencies = reference.ref_currency(spark).withColumn(
        "is_active_flag", F.when(F.col("currency_code") == "USD", 0).otherwise(1)
    )
    got = split.split_transfers(
        raw_transfers(spark, [X.transfer(DAY, 1, 1, currency="USD")]), currencies, reference.ref_country(spark)
    )
    assert [r.reject_reason for r in got.reject.collect()] == ["unsupported currency_code"]


def test_a_client_row_can_fail_every_rule_once(spark):
    line = X.client(
        DAY, "x", kind="PARTNER", business_date="2020-01-01", full_name="", address_line_1="", city="",
        postal_code="9" * 21, country_code="POL", pep_flag=2, high_risk_flag="?", client_status="",
        phone_number="1", email="@", kyc_status="?", risk_score=-1, relationship_purpose_code="X",
        expected_activity_level="a b",
    )
    df = spark.createDataFrame([(line, f"clients_{DAY:%Y%m%d}.csv", 2)], "value string, source_file_name string, source_row_num long")
    reject = split.split_clients(inbound.parse_lines(df, S.CLIENTS)).reject.collect()
    assert reject[0].reject_reason.split("; ") == [
        "business_date does not match requested date", "invalid client_id", "invalid client_type",
        "missing full_name", "missing address_line_1", "missing city", "postal_code too long",
        "invalid country_code format", "invalid phone_number format", "invalid email format",
        "pep_flag must be 0 or 1", "invalid high_risk_flag", "invalid kyc_status format",
        "risk_score must be between 0 and 999", "missing client_status",
        "unsupported relationship_purpose_code", "invalid expected_activity_level format",
    ]


def test_no_window_or_cross_join_in_the_split_plan(spark):
    got = split.split_transfers(
        raw_transfers(spark, [X.transfer(DAY, 1, 1)]), reference.ref_currency(spark), reference.ref_country(spark)
    )
    for part in got:
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "PythonUDF" not in plan and "ArrowEval" not in plan


def test_hot_key_is_split_over_tasks(spark):
    """A key with a third of all rows: the join splits its partition, and no row is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 30000
        key = F.when(F.col("id") < n // 3, 0).otherwise(F.col("id"))
        rows = spark.range(0, n, 1, 8).select(
            F.lit(DAY).alias("business_date"), key.alias("client_id"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
        )
        counted = aggregates.key_multiplicity(rows, ["business_date", "client_id"])
        collected = counted.collect()
        assert len(collected) == n
        assert max(r.key_count for r in collected) == n // 3
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_line_numbers_over_many_splits(spark, tmp_path):
    """Files cut into many splits, blank lines included, still number 1..n per file."""
    for name, n in (("client_transfers_20260401.csv", 5000), ("client_transfers_20260402.csv", 777)):
        (tmp_path / name).write_text("".join(f"{i}\n" if i % 50 else "\n" for i in range(1, n + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        lines = inbound.read_lines(spark, str(tmp_path))
        assert lines.select("source_path", "split_start").distinct().count() > 10
        rows = inbound.with_source_row_num(lines)
        wrong = rows.filter(
            F.when(F.col("value") == "", F.col("source_row_num") % 50 != 0).otherwise(
                F.col("value").try_cast("long") != F.col("source_row_num")
            )
        )
        assert wrong.count() == 0
        counts = rows.groupBy("source_file_name").agg(
            F.count("*").alias("n"), F.countDistinct("source_row_num").alias("d"), F.max("source_row_num").alias("m")
        )
        assert sorted(tuple(r)[1:] for r in counts.collect()) == [(777, 777, 777), (5000, 5000, 5000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_are_parsed_like_the_file_contract_says(spark):
    lines = ['1;2;"a;b";"say ""hi""";5', "", "1;2;3;4;5;6;7;8;9;10;11;12;13", " 1 ;;"]
    df = spark.createDataFrame([(v, "client_transfers_20260401.csv") for v in lines], "value string, source_file_name string")
    rows = inbound.parse_lines(df, S.TRANSFERS).collect()
    assert (rows[0].source_account_raw, rows[0].target_account_raw, rows[0].currency_code_raw) == ("a;b", 'say "hi"', None)
    assert all(rows[1][c] is None for c in S.TRANSFERS.raw_columns)
    assert (rows[2].transfer_title_raw, rows[3].transfer_id_raw, rows[3].client_id_raw) == ("11", " 1 ", None)
    assert rows[0].business_date == dt.date(2026, 4, 1)


def test_retry_counter_is_clamped_at_every_step(spark):
    def event(seq, delta, reset=0, key="P"):
        base = {f.name: None for f in S.RUN_EVENT_SCHEMA}
        base.update(process_name=key, business_date=DAY, run_mode="AUTO", status="WAITING", event_seq=seq,
                    event_ts=dt.datetime(2026, 1, 1, 0, 0, seq), scheduled_for_ts=dt.datetime(2026, 1, 1, 0, 0, seq),
                    retry_count_delta=delta, reset_retry_count=reset, status_message="m" * 5000)
        return tuple(base[f.name] for f in S.RUN_EVENT_SCHEMA)

    def fold(control, deltas, key="P"):
        events = spark.createDataFrame([event(i, d, r, key) for i, (d, r) in enumerate(deltas)], S.RUN_EVENT_SCHEMA)
        return upsert_runs(control, events)

    empty = spark.createDataFrame([], S.CONTROL_SCHEMA)
    first = fold(empty, [(1, 0), (1, 0), (-5, 0), (1, 0)])
    (row,) = first.collect()
    assert (row.retry_count, row.stage_row_count, len(row.status_message)) == (1, 0, 4000)
    assert (row.scheduled_for_ts.second, row.updated_ts.second) == (0, 3)
    stored = spark.createDataFrame(first.collect(), S.CONTROL_SCHEMA)
    (row,) = fold(stored, [(1, 0), (1, 0)]).collect()
    assert (row.retry_count, row.scheduled_for_ts.second, row.created_ts.second) == (3, 0, 0)
    (row,) = fold(stored, [(1, 0), (0, 1), (1, 0)]).collect()
    assert row.retry_count == 1
    both = {r.process_name: r.retry_count for r in fold(stored, [(1, 0)], key="Q").collect()}
    assert both == {"P": 1, "Q": 1}


def test_gate_needs_every_process(spark):
    control = spark.createDataFrame(
        [("A", DAY, "DONE"), ("B", DAY, "WARNING"), ("A", X.MAR[1], "DONE")],
        "process_name string, business_date date, status string",
    )
    loose = {r.business_date: r.is_open for r in gates.gate(control, ["A", "B"], ["DONE", "WARNING"]).collect()}
    strict = {r.business_date: r.is_open for r in gates.gate(control, ["A", "B"], ["DONE"]).collect()}
    assert loose == {DAY: 1, X.MAR[1]: 0}
    assert strict == {DAY: 0, X.MAR[1]: 0}


def test_reading_dated_files_directly(spark, tmp_path):
    X.write_all(tmp_path)
    rows = inbound.read_transfers_raw(spark, str(tmp_path), X.MAR[1], X.MAR[4]).collect()
    assert sorted((r.business_date, r.source_row_num) for r in rows) == [
        (X.MAR[1], i) for i in range(2, 14)
    ] + [(X.MAR[4], 2), (X.MAR[4], 3)]
    clients = inbound.read_clients_raw(spark, str(tmp_path), X.APR[15]).collect()
    assert len(clients) == 10 and clients[0].client_type_raw == " private "
    (tmp_path / "clients_20260501.ok").write_text("")
    got = {
        (r.dataset, r.business_date): (r.ready_state, r.expected_row_count)
        for r in inbound.read_ready_counts(spark, str(tmp_path)).collect()
    }
    assert got["clients", X.APR[15]] == ("OK", 10)
    assert got["clients", dt.date(2026, 5, 1)] == ("EMPTY", None)
    assert inbound.list_files(spark, str(tmp_path / "nowhere")).count() == 0


def test_reason_counts_are_those_of_the_split(spark):
    lines = random_lines(11, 200)
    judged = split.judge_transfers(
        raw_transfers(spark, lines), reference.ref_currency(spark), reference.ref_country(spark)
    )
    counts = split.reason_counts(judged, S.TRANSFERS)
    rejected = aggregates.count_by(split.split_judged(judged, S.TRANSFERS).reject, ["business_date", "reject_reason"])
    assert counts.columns == rejected.columns
    found = sorted(map(tuple, counts.collect()))
    assert found == sorted(map(tuple, rejected.collect())) and len(found) > 5
    assert any("duplicate" in reason for _, reason, _ in found)


def test_rejects_and_accepted_values_are_those_of_the_split(spark):
    """Also from the few columns that the rejects are made of."""
    lines = random_lines(13, 200)
    judged = split.judge_transfers(
        raw_transfers(spark, lines), reference.ref_currency(spark), reference.ref_country(spark)
    )
    whole = split.split_judged(judged, S.TRANSFERS)
    few = judged.select(*split.reject_inputs(S.TRANSFERS))
    assert "amount_parsed" in judged.columns and "amount_parsed" not in few.columns
    found, want = split.rejected(few, S.TRANSFERS).drop("rejected_at"), whole.reject.drop("rejected_at")
    assert found.columns == want.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
    core = split.accepted_values(judged, S.TRANSFERS, S.TRANSFERS.stage_order)
    assert core.schema == split.core_rows(whole.stage).schema
    rows = sorted(map(repr, core.collect()))
    assert rows == sorted(map(repr, split.core_rows(whole.stage).collect())) and len(rows) > 20


def test_dated_table_stores_no_judged_rows(spark, tmp_path, monkeypatch):
    """The accepted rows come from one pass; only the rows of the date that is replaced are stored besides."""
    spark.range(400).selectExpr(
        "id % 300 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "cast(1 AS int) AS l_linenumber",
        "cast(id AS double) AS l_extendedprice", "timestamp_ntz'2001-01-05 00:00:00' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    written = []
    keep = workload_inbound.stored
    monkeypatch.setattr(
        workload_inbound, "stored", lambda spark, df, purpose: written.append((purpose, df.columns)) or keep(spark, df, purpose)
    )
    assert registry.QUERIES["dated_table"](spark, str(tmp_path)).count()
    assert [purpose for purpose, _ in written] == ["again"]
    registry.QUERIES["reject_transfers"](spark, str(tmp_path))
    assert "amount_parsed" not in written[-1][1]


def test_counting_queries_judge_each_row_once(spark, tmp_path):
    """No table of judged rows is written, and every given table is read once for the rows (once more to be counted)."""
    spark.range(40).selectExpr(
        "id % 30 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "cast(1 AS int) AS l_linenumber",
        "cast(id AS double) AS l_extendedprice", "timestamp_ntz'2001-01-05 00:00:00' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).selectExpr(
        "id AS c_custkey", "concat('n', id) AS c_name", "cast(id % 25 AS int) AS c_nationkey", "'BUILDING' AS c_mktsegment"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(5).selectExpr(
        "id AS s_suppkey", "concat('s', id) AS s_name", "cast(id % 25 AS int) AS s_nationkey"
    ).write.parquet(f"{tmp_path}/supplier.parquet")

    def scans(name):
        df = registry.QUERIES[name](spark, str(tmp_path))
        assert df.count()
        return df._jdf.queryExecution().optimizedPlan().toString().count("parquet")

    assert scans("reject_reason_histogram") == scans("day_counts") == 3
    assert scans("mart_gate") <= 5 and scans("spool_gate") <= 5
    assert scans("layer_counts") == 4
