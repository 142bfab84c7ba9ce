"""Lenient date parsing, date arithmetic and date formats.

All values are zone-free: TIMESTAMP_NTZ keeps results independent of the
session time zone and free of daylight-saving gaps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions._column import ColumnOrName, as_col

# One separator of any kind, or none, may stand between the parts. Time parts
# may be left out from the right. There is no year 0.
_SEP = r"[^0-9A-Za-z]?"
_DATE = rf"(?!0000|0{{1,3}}[^0-9])([0-9]{{1,4}}){_SEP}([0-9]{{1,2}}){_SEP}([0-9]{{1,2}})"
_TIME = rf"(?:{_SEP}([0-9]{{1,2}})(?:{_SEP}([0-9]{{1,2}})(?:{_SEP}([0-9]{{1,2}}))?)?)?"
# The usual spelling needs no rewriting, which is by far the dearest part.
_EXACT_DATE = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_EXACT_TS = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def _canonical(c: Column, regex: str, replacement: str) -> Column:
    shaped = F.when(c.rlike(regex), F.regexp_replace(c, regex, replacement))
    return F.regexp_replace(shaped, r"\A0*([0-9]{4}-)", "$1")


def to_date_lenient(c: ColumnOrName) -> Column:
    """``YYYY-MM-DD`` with any punctuation; not a date becomes NULL."""
    c = as_col(c)
    lenient = _canonical(c, rf"\A{_DATE}\z", "000$1-$2-$3").try_cast("date")
    return F.when(c.rlike(_EXACT_DATE), c.try_cast("date")).otherwise(lenient)


def to_ts_lenient(c: ColumnOrName) -> Column:
    """``YYYY-MM-DD HH24:MI:SS`` with any punctuation; not a time becomes NULL."""
    c = as_col(c)
    text = _canonical(c, rf"\A{_DATE}{_TIME}\z", "000$1-$2-$3 $4:$5:$6")
    lenient = F.rtrim(text, F.lit(": ")).try_cast("timestamp_ntz")
    return F.when(c.rlike(_EXACT_TS), c.try_cast("timestamp_ntz")).otherwise(lenient)


def ts_literal(moment: dt.datetime) -> Column:
    """A zone-free literal; ``F.lit`` would shift it by the session's zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def equals_date(c: ColumnOrName, date: ColumnOrName) -> Column:
    return as_col(c) == as_col(date)


def due_date(ts: ColumnOrName, report_type: ColumnOrName) -> Column:
    """Two days for reports with a suspicion, seven for threshold-only ones."""
    day = as_col(ts).cast("date")
    suspicious = as_col(report_type).isin("ART74_SUSPICION", "ART72_AND_ART74")
    return F.date_add(day, F.when(suspicious, 2).otherwise(7))


def fmt_date(c: ColumnOrName) -> Column:
    return F.date_format(as_col(c), "yyyy-MM-dd")


def fmt_date_compact(c: ColumnOrName) -> Column:
    return F.date_format(as_col(c), "yyyyMMdd")


def fmt_ts(c: ColumnOrName) -> Column:
    return F.date_format(as_col(c), "yyyy-MM-dd HH:mm:ss")
