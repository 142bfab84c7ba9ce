"""Digest comparison and day sketches on small tables."""

import datetime as dt

from pyspark.sql import functions as F

from tidegate.operators import digests, sketches

DAYS = [dt.date(2026, 3, d) for d in (1, 2, 3)]
SCHEMA = "business_date date, id long, a string, b long"


def compared(spark, one, two):
    tables = [spark.createDataFrame(rows, SCHEMA) for rows in (one, two)]
    where = digests.differing(*[digests.digests(t, ["id"], 8) for t in tables])
    asked = []

    def reader(table):
        def read(dates):
            asked.append(dates)
            return table.where(F.col("business_date").isin(dates))

        return read

    rows = digests.changed_rows(*map(reader, tables), where, ["id"], 8).collect()
    return sorted((r.business_date, r.id, r.change, r.changed_columns) for r in rows), asked


def test_only_differing_dates_are_read(spark):
    one = [(d, i, f"x{i}", None if i % 3 else i) for d in DAYS for i in range(20)]
    two = [r for r in one if r[:2] != (DAYS[1], 4)] + [(DAYS[1], 99, None, 1)]
    two = [(r[0], r[1], None, r[3]) if r[:2] == (DAYS[1], 6) else r for r in two]
    got, asked = compared(spark, one, two)
    assert got == [(DAYS[1], 4, "REMOVED", None), (DAYS[1], 6, "CHANGED", "a"), (DAYS[1], 99, "ADDED", None)]
    assert asked == [[DAYS[1]], [DAYS[1]]]


def test_equal_and_empty_tables(spark):
    one = [(DAYS[0], i, "x", i) for i in range(9)]
    assert compared(spark, one, one[::-1]) == ([], [[], []])
    assert compared(spark, [], []) == ([], [[], []])
    got, _ = compared(spark, one[:1], [])
    assert got == [(DAYS[0], 0, "REMOVED", None)]


def test_values_that_swap_are_seen(spark):
    """Digests are sums, but of whole rows: a value moved from one row to another changes them."""
    one = [(DAYS[0], 1, "x", 1), (DAYS[0], 9, "y", 2)]
    two = [(DAYS[0], 1, "y", 1), (DAYS[0], 9, "x", 2)]
    assert [r[1:3] for r in compared(spark, one, two)[0]] == [(1, "CHANGED"), (9, "CHANGED")]


def test_sketches_merge_over_any_range(spark):
    rows = spark.range(30_000).selectExpr(
        "date_add(DATE '2026-03-01', cast(id % 3 AS int)) AS business_date", "id % 7000 AS k", "cast(id AS double) AS v"
    )
    days = sketches.day_sketches(rows, ["k"], ["v"]).cache()
    (whole,) = sketches.merged(days, [F.lit("all").alias("g")], ["k"], ["v"], (0.1, 0.5)).collect()
    assert whole.row_count == 30_000
    assert abs(whole.k_estimate - 7000) < 3 * sketches.standard_error() * 7000
    assert abs(whole.v_q50 / 30_000 - 0.5) < 3 * sketches.rank_error()
    assert abs(whole.v_q10 / 30_000 - 0.1) < 3 * sketches.rank_error()
    two = days.where(F.col("business_date") > DAYS[0])
    (part,) = sketches.merged(two, [F.lit("x").alias("g")], ["k"], ["v"]).collect()
    assert part.row_count == 20_000
