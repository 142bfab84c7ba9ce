"""Text normalisation and predicates.

An empty string counts as missing everywhere, so every normaliser turns it
into NULL and every predicate is NULL (neither true nor false) on NULL input.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions._column import ColumnOrName, as_col


def norm_text(c: ColumnOrName) -> Column:
    """Strip surrounding spaces (spaces only, not tabs); blank becomes NULL."""
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def norm_code(c: ColumnOrName) -> Column:
    """``norm_text`` in upper case."""
    return F.upper(norm_text(c))


def matches(c: ColumnOrName, regex: str) -> Column:
    """Whole-value match.

    ``$`` would also match before a final newline, hence the explicit anchors.
    """
    return as_col(c).rlike(rf"\A(?:{regex})\z")


def in_domain(c: ColumnOrName, values: Iterable[str]) -> Column:
    return as_col(c).isin(list(values))


def max_len(c: ColumnOrName, n: int) -> Column:
    """Length in characters, not bytes."""
    return F.length(as_col(c)) <= n


def required_when(cond: Column, cols: Iterable[ColumnOrName]) -> Column:
    """False only where ``cond`` holds and one of ``cols`` is NULL."""
    missing = F.lit(False)
    for c in cols:
        missing = missing | as_col(c).isNull()
    return ~(F.coalesce(cond, F.lit(False)) & missing)


def like(c: ColumnOrName, pattern: str) -> Column:
    return as_col(c).like(pattern)


def trim_both(c: ColumnOrName, chars: str) -> Column:
    """Strip ``chars`` from both ends; nothing left becomes NULL."""
    return F.nullif(F.trim(as_col(c), F.lit(chars)), F.lit(""))


def truncate(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(as_col(c), 1, n)


def report_id(business_date: ColumnOrName, transfer_id: ColumnOrName) -> Column:
    """``AML-<yyyyMMdd>-<transfer_id>``."""
    return F.concat_ws(
        "-",
        F.lit("AML"),
        F.date_format(as_col(business_date), "yyyyMMdd"),
        as_col(transfer_id).cast("string"),
    )
