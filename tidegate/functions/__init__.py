"""Column functions; all of them are built-in Spark expressions, no UDFs."""

from tidegate.functions.dates import (
    due_date,
    equals_date,
    fmt_date,
    fmt_date_compact,
    fmt_ts,
    to_date_lenient,
    to_ts_lenient,
    ts_literal,
)
from tidegate.functions.numbers import (
    fits,
    fmt_amount,
    in_range,
    nvl,
    number_rest,
    parse_number,
    ratio_half_up,
    round_half_up,
    to_number,
)
from tidegate.functions.text import (
    in_domain,
    like,
    matches,
    max_len,
    norm_code,
    norm_text,
    report_id,
    required_when,
    trim_both,
    truncate,
)

__all__ = [
    "due_date",
    "equals_date",
    "fits",
    "fmt_amount",
    "fmt_date",
    "fmt_date_compact",
    "fmt_ts",
    "in_domain",
    "in_range",
    "like",
    "matches",
    "max_len",
    "norm_code",
    "norm_text",
    "nvl",
    "number_rest",
    "parse_number",
    "ratio_half_up",
    "report_id",
    "required_when",
    "round_half_up",
    "to_date_lenient",
    "to_number",
    "to_ts_lenient",
    "trim_both",
    "truncate",
    "ts_literal",
]
