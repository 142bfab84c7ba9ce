"""Table constraints, named checks and expected-versus-actual comparison."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions import trim_both
from tidegate.operators.aggregates import count_by, union_all
from tidegate.operators.joins import orphan_counts


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return count_by(df, keys).filter("row_count > 1")


def check_fk(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child keys without a parent, with the number of child rows.

    A key with a NULL part refers to nothing and passes.
    """
    complete = child.dropna(subset=list(keys))
    return orphan_counts(complete, parent, keys)


def check_expr(df: DataFrame, conditions: dict[str, str]) -> DataFrame:
    """(check_name, violations) of row conditions; NULL passes. One pass."""
    return _violations(df, {n: ~F.expr(c) for n, c in conditions.items()})


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(check_name, violations) of columns that must have a value. One pass."""
    return _violations(df, {c: F.col(c).isNull() for c in cols})


def _violations(df: DataFrame, violated: dict[str, Column]) -> DataFrame:
    names = list(violated)
    totals = df.agg(*[F.count_if(violated[n]).alias(f"v{i}") for i, n in enumerate(names)])
    return _unpivot(totals, names, "v", "check_name", "violations")


@dataclass(frozen=True)
class Constraints:
    """What every row of a stored table must meet: conditions that are not false, columns with a value, a unique key."""

    checks: dict[str, str]
    not_null: tuple[str, ...] = ()
    key: tuple[str, ...] = ()

    def violated(self) -> dict[str, Column]:
        """Row conditions by name; true where a row breaks one."""
        by_check = {n: ~F.expr(c) for n, c in self.checks.items()}
        return by_check | {f"{c}_not_null": F.col(c).isNull() for c in self.not_null}


def violation_counts(constraints: Constraints) -> list[Column]:
    """Aggregates that count the rows breaking each condition, for ``observe`` or ``agg``."""
    return [F.count_if(c).alias(n) for n, c in constraints.violated().items()]


def audit(df: DataFrame, constraints: Constraints, by: str = "business_date") -> DataFrame:
    """Per date: its rows, the rows breaking each condition and the rows whose key is there before.

    One pass for the conditions and one aggregate of the key columns; no row leaves its task.
    """
    rows = df.groupBy(by).agg(F.count("*").alias("row_count"), *violation_counts(constraints))
    if not constraints.key:
        return rows
    keys = df.groupBy(by, *[k for k in constraints.key if k != by]).agg(F.count("*").alias("n"))
    repeated = keys.groupBy(by).agg(F.sum(F.col("n") - 1).alias("repeated_keys"))
    return rows.join(repeated, by)


def _unpivot(row: DataFrame, names: Sequence[str], prefix: str, key: str, value: str) -> DataFrame:
    pairs = [
        F.struct(F.lit(n).alias(key), F.col(f"{prefix}{i}").alias(value))
        for i, n in enumerate(names)
    ]
    return row.select(F.inline(F.array(*pairs)))


@dataclass(frozen=True)
class Check:
    """A named condition on an aggregate over one table."""

    name: str
    condition: Column
    details: str


def run_checks(tables: Sequence[tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """PASS / FAIL per check plus a SUMMARY row; one pass over each table."""
    parts = []
    for df, checks in tables:
        totals = df.agg(
            *[F.coalesce(c.condition, F.lit(False)).alias(f"p{i}") for i, c in enumerate(checks)]
        )
        passed = _unpivot(totals, [c.name for c in checks], "p", "check_name", "passed")
        details = F.create_map(*[F.lit(x) for c in checks for x in (c.name, c.details)])
        parts.append(
            passed.select(
                "check_name",
                F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("result"),
                details[F.col("check_name")].alias("details"),
            )
        )
    rows = union_all(parts)
    failed = F.count_if(F.col("result") == "FAIL")
    summary = rows.agg(
        F.lit("SUMMARY").alias("check_name"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("result"),
        F.concat(
            F.lit("total_checks="),
            F.count("*").cast("string"),
            F.lit("; failed_checks="),
            failed.cast("string"),
        ).alias("details"),
    )
    return rows.unionByName(summary)


#: Compared field -> (expected column, actual column, NULL expectation matches all).
COMPARED_FIELDS = {
    "status": ("expected_status", "actual_status", False),
    "reason_code": ("expected_reason_code", "actual_reason_code", False),
    "expected_row_count": ("expected_row_count", "actual_ctl_expected_rows", True),
    "actual_stage_rows": ("expected_stage_rows", "actual_stage_rows", False),
    "actual_reject_rows": ("expected_reject_rows", "actual_reject_rows", False),
    "actual_core_rows": ("expected_core_rows", "actual_core_rows", False),
}


def compare_runs(expected: DataFrame, actual: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected runs with PASS / FAIL, the differing fields and a SUMMARY row."""
    joined = expected.join(actual, list(on), "left")
    differing = [
        F.when(
            ~F.col(want).eqNullSafe(F.col(got))
            & (F.col(want).isNotNull() if optional else F.lit(True)),
            f"{name};",
        )
        for name, (want, got, optional) in COMPARED_FIELDS.items()
    ]
    mismatch = trim_both(F.concat_ws("", *differing), ";")
    scored = joined.withColumn("mismatch_fields", mismatch).withColumn(
        "result", F.when(F.col("mismatch_fields").isNull(), "PASS").otherwise("FAIL")
    )
    failed = F.count_if(F.col("result") == "FAIL")
    total = F.count("*")
    summary = scored.agg(
        F.lit("SUMMARY").alias("case_key"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("result"),
        F.concat(
            F.lit("total_cases="),
            total.cast("string"),
            F.lit("; passed_cases="),
            (total - failed).cast("string"),
            F.lit("; failed_cases="),
            failed.cast("string"),
        ).alias("mismatch_fields"),
    )
    return scored.unionByName(summary, allowMissingColumns=True)
