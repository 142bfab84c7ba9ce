"""Publishing by version and manifest, audits, control rows of several writers, strict lines."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.operators.checks import Constraints, audit
from tidegate.operators.control import KEYS, net_events, upsert_runs
from tidegate.plans import publish, runs
from tidegate.plans.builds import mart_schema, run_mart
from tidegate.plans.runs import Outcome, Recorder, Warehouse, read_control
from tidegate.sources import inbound, versions
from tidegate.sources.reference import fx_rates
from tidegate.sources.tables import overwrite_date, read_table

DAYS = [dt.date(2026, 3, d) for d in (1, 2, 3)]
SCHEMA = "business_date date, id long, amount long"


def rows(spark, days, start, bad=()):
    made = [(d, start + i, -1 if d in bad and i == 2 else i) for d in days for i in range(4)]
    return spark.createDataFrame(made, SCHEMA)


def publish_all(spark, root, df, constraints):
    version = versions.new_version()
    problems, counts = {}, {}
    for name in ("stage", "core"):
        _, wrong = publish.write(spark, publish.Part(f"{root}/{name}", df, constraints), version)
        problems |= wrong
    for r in df.groupBy("business_date").count().collect():
        if r.business_date not in problems:
            counts[r.business_date] = {"stage": r["count"], "core": r["count"]}
    versions.switch(spark, root, "g", version, counts)
    return problems


RULES = Constraints({"positive": "amount >= 0"}, ("id",), ("business_date", "id"))


def held(spark, root, name, dates=None):
    table = read_table(spark, f"{root}/{name}", spark.createDataFrame([], SCHEMA).schema, dates)
    return {(r.business_date, r.id) for r in table.collect()}


def test_a_failed_write_leaves_every_row(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish_all(spark, root, rows(spark, DAYS, 0), RULES)
    before = {n: held(spark, root, n) for n in ("stage", "core")}
    assert len(before["core"]) == 12
    real, calls = versions.write_version, []

    def second_fails(*args, **more):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("disk full")
        real(*args, **more)

    monkeypatch.setattr(versions, "write_version", second_fails)
    with pytest.raises(OSError):
        publish_all(spark, root, rows(spark, DAYS, 100), RULES)
    assert {n: held(spark, root, n) for n in ("stage", "core")} == before
    monkeypatch.undo()
    publish_all(spark, root, rows(spark, DAYS[:1], 200), RULES)
    for n in ("stage", "core"):
        assert held(spark, root, n) == {(DAYS[0], 200 + i) for i in range(4)} | {x for x in before[n] if x[0] != DAYS[0]}
    gone = versions.expire(spark, root, ["stage", "core"])
    assert len(gone) == 1  # the failed one; the first still holds for two days
    assert held(spark, root, "core", DAYS[1:]) == {x for x in before["core"] if x[0] != DAYS[0]}


def test_a_violating_date_stays_alone(spark, tmp_path):
    root = str(tmp_path)
    publish_all(spark, root, rows(spark, DAYS, 0), RULES)
    problems = publish_all(spark, root, rows(spark, DAYS, 50, bad=DAYS[1:2]), RULES)
    assert list(problems) == [DAYS[1]] and "positive: 1" in problems[DAYS[1]]
    assert held(spark, root, "core") == {(d, (0 if d == DAYS[1] else 50) + i) for d in DAYS for i in range(4)}
    twice = rows(spark, DAYS[:1], 70).unionByName(rows(spark, DAYS[:1], 70)).unionByName(rows(spark, DAYS[2:], 70))
    problems = publish_all(spark, root, twice, RULES)
    assert list(problems) == [DAYS[0]] and "repeated_keys: 4" in problems[DAYS[0]]
    assert (DAYS[2], 70) in held(spark, root, "stage") and (DAYS[0], 50) in held(spark, root, "stage")


def test_a_date_is_one_folder(spark, tmp_path):
    root = str(tmp_path)
    for start in (0, 10, 20):
        publish_all(spark, root, rows(spark, DAYS, start), RULES)
    table = read_table(spark, f"{root}/core", spark.createDataFrame([], SCHEMA).schema, DAYS[:1])
    folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    assert len(folders) == 1 and folders.pop().endswith(f"business_date={DAYS[0]}")
    assert {r.id for r in table.collect()} == {20, 21, 22, 23}
    assert held(spark, root, "core", []) == set()


def test_nothing_to_publish(spark, tmp_path):
    assert publish_all(spark, str(tmp_path), rows(spark, [], 0), RULES) == {}
    assert held(spark, str(tmp_path), "core") == set()


def test_audit_counts(spark):
    made = [(DAYS[0], 1, 5), (DAYS[0], 1, -5), (DAYS[0], None, None), (DAYS[1], 1, 0)]
    got = {r.business_date: r for r in audit(spark.createDataFrame(made, SCHEMA), RULES).collect()}
    assert got[DAYS[0]][1:] == (3, 1, 1, 1)
    assert got[DAYS[1]][1:] == (1, 0, 0, 0)


# --- Control rows ------------------------------------------------------------


def event(key, date, seq, delta, reset):
    base = {f.name: None for f in S.RUN_EVENT_SCHEMA}
    at = dt.datetime(2026, 1, 1) + dt.timedelta(seconds=seq)
    base.update(process_name=key, business_date=date, run_mode="AUTO", status=f"S{seq}", event_seq=seq, event_ts=at,
                scheduled_for_ts=at if seq % 3 else None, retry_count_delta=delta, reset_retry_count=reset)
    return tuple(base[f.name] for f in S.RUN_EVENT_SCHEMA)


def test_a_hot_key_is_folded_in_ranges(spark):
    """A key with most of the events: the same counter as one event at a time, without a window over the key."""
    draw = random.Random(4)
    events = [("HOT" if draw.random() < 0.7 else f"P{draw.randint(0, 5)}", draw.choice(DAYS), s,
               draw.choice([1, 1, -1, -3, None]), int(draw.random() < 0.02)) for s in range(1500)]
    df = spark.createDataFrame([event(*e) for e in events], S.RUN_EVENT_SCHEMA).repartition(5)
    old = [("HOT", DAYS[0], 4), ("P9", DAYS[0], 2)]
    fields = S.CONTROL_SCHEMA.fieldNames()
    control = spark.createDataFrame(
        [tuple({"process_name": p, "business_date": d, "retry_count": n}.get(f) for f in fields) for p, d, n in old],
        S.CONTROL_SCHEMA,
    )
    counter, last, first = {(p, d): n for p, d, n in old}, {}, {}
    for key, date, seq, delta, reset in events:
        n = counter.get((key, date), 0)
        counter[key, date] = 0 if reset else max(0, n + (delta or 0))
        last[key, date] = f"S{seq}"
        if seq % 3:
            first.setdefault((key, date), seq)
    for span in (1, 16, 4096):
        assert "Window" not in net_events(df, span)._jdf.queryExecution().executedPlan().toString()
        net = {tuple(r[k] for k in KEYS): r for r in net_events(df, span).collect()}
        assert {k: r["last"]["status"] for k, r in net.items()} == last
        start = dt.datetime(2026, 1, 1)
        assert {k: (r.scheduled_for_ts - start).seconds for k, r in net.items() if r.scheduled_for_ts} == first
    got = {(r.process_name, r.business_date): r.retry_count for r in upsert_runs(control, df).collect()}
    assert got == counter


def test_two_recorders_keep_both_rows(spark, tmp_path, monkeypatch):
    """A process that records between another one's read and write loses nothing."""
    w = Warehouse(*[str(tmp_path / x) for x in "ito"])
    now = dt.datetime(2026, 3, 1)
    one, two = (Recorder(spark, w, "AUTO", now, False, lambda: now) for _ in range(2))
    one.record([Outcome("A", DAYS[0], "PROCESSING")])
    real, between = runs.overwrite_date, [Outcome("B", DAYS[0], "DONE")]

    def interleaved(*args, **more):
        if between:
            two.record([between.pop()])
        real(*args, **more)

    monkeypatch.setattr(runs, "overwrite_date", interleaved)
    one.record([Outcome("A", DAYS[0], "DONE")])
    assert {(r.process_name, r.status) for r in read_control(spark, w).collect()} == {("A", "DONE"), ("B", "DONE")}


# --- Lines -------------------------------------------------------------------


def test_well_formed_lines(spark):
    good = ["", ";", "a;b", '"a";b', '"a;b";c', '"a""b"', '""', '"";""', 'a"b;c"', '5" pipe;x', '""""', '"a"\r', 'x;"a;""b"";c";y',
            '"' + '""' * 20_000 + '"', "a;" * 20_000, '"' + "x;" * 20_000 + '"']
    bad = ['"', '"a', 'a;"b', '"a"b;c', '"a" ;b', '"""', 'x;"a;b', '"a"";b', '""a', '"' + '""' * 20_000, '"a;"b";"c"']
    lines = spark.createDataFrame([(x, True) for x in good] + [(x, False) for x in bad], "value string, ok boolean")
    got = lines.withColumn("found", inbound.well_formed("value")).where(F.col("found") != F.col("ok"))
    assert [r.value[:20] for r in got.collect()] == []


def test_reading_stops_at_an_open_quote(spark, tmp_path):
    name = inbound.snapshot_path(str(tmp_path), S.TRANSFERS, DAYS[0])
    with open(name, "w") as f:
        f.write('head\n1;2;a;b;3;EUR;t;s;c;PL;"closed; one"\n')
    (row,) = inbound.read_transfers_raw(spark, str(tmp_path), DAYS[0]).collect()
    assert (row.transfer_title_raw, row.source_row_num) == ("closed; one", 2)
    with open(name, "a") as f:
        f.write('2;2;a;b;3;EUR;t;s;c;PL;"open\n')
    with pytest.raises(PySparkException, match="line 3: a quoted field"):
        inbound.read_transfers_raw(spark, str(tmp_path), DAYS[0]).collect()


# --- One date cannot stop the others ------------------------------------------


def test_a_poisoned_date_fails_alone(spark, tmp_path):
    """An amount that no longer fits in EUR on one of ten dates: that date fails its audit, nine are built."""
    w = Warehouse(*[str(tmp_path / x) for x in "ito"])
    days = [dt.date(2026, 5, d) for d in range(1, 11)]
    bad = days[4]
    text = lambda schema, **given: tuple(given.get(f.name, "X" if f.dataType.typeName() == "string" else None) for f in schema)
    ts, cs = S.core_schema(S.TRANSFERS), S.core_schema(S.CLIENTS)
    transfers = [
        text(ts, business_date=d, transfer_id=i, client_id=1, amount=Decimal("999999999999.99" if d == bad else "12.34"),
             currency_code="USD", transfer_ts=dt.datetime(2026, 5, 1), country_code="PL")
        for d in days for i in (1, 2)
    ]
    clients = [text(cs, business_date=d, client_id=1, country_code="PL", pep_flag=0, high_risk_flag=0, risk_score=5) for d in days]
    for table, group, rows_, schema in (
        (w.core(S.TRANSFERS), S.TRANSFERS.name, transfers, ts),
        (w.core(S.CLIENTS), S.CLIENTS.name, clients, cs),
    ):
        version = versions.new_version()
        versions.write_version(spark.createDataFrame(rows_, schema), table, version)
        versions.switch(spark, w.root, group, version, {d: {table.rsplit("/", 1)[1]: 2} for d in days})
    rates = [(d, code, 1, Decimal("9999999999") if d == bad and code == "USD" else Decimal("4")) for d in days for code in ("EUR", "USD")]
    overwrite_date(fx_rates(spark, rates), w.fx)
    Recorder(spark, w, "MANUAL", dt.datetime(2026, 5, 1), False).record(
        Outcome(p, d, "DONE") for d in days for p in (S.LOAD_CLIENTS, S.LOAD_TRANSFERS)
    )
    done = {o.business_date: o for o in run_mart(spark, w, days)}
    assert {d: o.status for d, o in done.items()} == {d: "FAILED" if d == bad else "DONE" for d in days}
    assert "amount_eur_not_null: 2" in done[bad].message
    mart = read_table(spark, w.mart, mart_schema(spark))
    assert {(r.business_date, str(r.amount_eur)) for r in mart.collect()} == {(d, "12.34") for d in days if d != bad}
