"""Numeric conversion, exact rounding and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions._column import ColumnOrName, as_col

#: Wide enough for every numeric field before it is rounded to its column type.
WIDE_NUMBER = "decimal(38,10)"
_WHOLE, _PLACES = 28, 9

# Sign, digits with an optional point, optional exponent. Without this check the
# cast would also take tabs and non-Latin digits.
_NUMBER = r"\A([+-]?)(?:([0-9]+)\.?([0-9]*)|\.([0-9]+))(?:[eE]([+-]?[0-9]+))?\z"
# Numbers that the wide type holds as they are; nearly all are.
_PLAIN = r"\A[+-]?[0-9]{1,18}(?:\.[0-9]{0,9})?\z"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, outside generated code."""
    return F.transform(F.array(value), use)[0]


def _digits(c: Column, use) -> Column:
    """``use`` of a number's sign, its digits without outer zeros, and the place of its point.

    The value is 0.digits times ten to the power of ``point``; zero has no digits.
    """
    part = lambda k: F.regexp_extract(c, _NUMBER, k)
    power = F.regexp_replace(part(5), r"\A([+-]?)0*(?=[0-9])", "$1")
    huge = F.when(power.startswith("-"), -1_000_000).otherwise(1_000_000)
    exponent = F.when(power == "", 0).when(F.length(power) > 6, huge).otherwise(power.cast("int"))
    whole, tail = part(2), F.concat(part(3), part(4))
    bare = F.regexp_replace(F.concat(whole, tail), "^0+", "")
    return _let(
        F.struct(
            (part(1) == "-").alias("negative"),
            F.regexp_replace(bare, "0+$", "").alias("digits"),
            (F.length(whole) + exponent - (F.length(whole) + F.length(tail) - F.length(bare))).alias("point"),
        ),
        use,
    )


def _wide(p: Column) -> Column:
    point, digits = p["point"], p["digits"]
    whole = (
        F.when(point > _WHOLE, "9" * _WHOLE)
        .when(point > 0, F.rpad(F.substr(digits, F.lit(1), point), point, "0"))
        .otherwise("0")
    )
    zeros = F.repeat(F.lit("0"), F.least(-point, F.lit(_PLACES + 1)))
    places = F.when(point >= 0, F.substr(digits, point + 1)).otherwise(F.concat(zeros, digits))
    more = F.when(F.length(places) > _PLACES, "1").otherwise("0")
    text = F.concat(F.when(p["negative"], "-").otherwise(""), whole, F.lit("."), F.rpad(places, _PLACES, "0"), more)
    return F.when(digits == "", F.lit("0")).otherwise(text).cast(WIDE_NUMBER)


def parse_number(c: ColumnOrName) -> Column:
    """Text to DECIMAL(38,10); anything that is not a number is NULL.

    The tenth place only tells whether there is more beyond the ninth, so signs, comparisons with
    numbers of up to nine places and half-up rounding to up to eight are those of the exact
    number, however many places the text has. A number of more than 28 whole digits becomes the
    largest there is, which fits no column. ``number_rest`` tells such numbers apart.
    """
    c = as_col(c)
    return F.when(c.rlike(_PLAIN), c.try_cast(WIDE_NUMBER)).when(c.rlike(_NUMBER), _digits(c, _wide))


def number_rest(c: ColumnOrName) -> Column:
    """Empty where ``parse_number`` holds the exact number, else all its digits.

    Two texts are the same number if both parsed value and rest are equal.
    """
    c = as_col(c)

    def rest(p: Column) -> Column:
        exact = (p["digits"] == "") | (
            (p["point"] <= _WHOLE) & (F.length(p["digits"]) - p["point"] <= _PLACES)
        )
        return F.when(exact, "").otherwise(F.concat_ws("E", p["digits"], p["point"].cast("string")))

    return F.when(c.rlike(_PLAIN), "").when(c.rlike(_NUMBER), _digits(c, rest)).otherwise("")


def round_half_up(c: ColumnOrName, n: int) -> Column:
    """Round a decimal, halves away from zero."""
    return F.round(as_col(c), n)


def to_number(c: ColumnOrName, precision: int, scale: int) -> Column:
    """A parsed number rounded half-up into DECIMAL(precision, scale).

    Whole numbers of up to 18 digits come back as BIGINT. A value too wide for
    the type is NULL; see ``fits``.
    """
    c = as_col(c)
    fixed = F.round(c, scale).try_cast(f"decimal({precision},{scale})")
    return fixed.cast("bigint") if scale == 0 and precision <= 18 else fixed


def fits(c: ColumnOrName, precision: int, scale: int) -> Column:
    """Whether a parsed number, once rounded, fits DECIMAL(precision, scale)."""
    c = as_col(c)
    return c.isNull() | F.round(c, scale).try_cast(f"decimal({precision},{scale})").isNotNull()


def in_range(c: ColumnOrName, lo: int, hi: int | None = None) -> Column:
    c = as_col(c)
    return c >= lo if hi is None else c.between(lo, hi)


def nvl(c: ColumnOrName, default: object) -> Column:
    return F.coalesce(as_col(c), F.lit(default))


def ratio_half_up(numerator: Column, denominator: Column, scale: int) -> Column:
    """``numerator / denominator`` rounded half-up to ``scale`` places, exactly.

    Both sides must be non-negative whole DECIMAL(38,0) values whose quotient,
    in units of the last place, is the rounded result. Decimal division in Spark
    keeps only six places for operands this wide, and rounding such a quotient
    again is wrong about once in 20,000 values; whole-number division is not.

    NULL where the quotient does not fit 18 digits or a step does not fit 38, or by 0: one such row must not
    stop the dates of all others.
    """
    two = F.lit(2).cast("decimal(1,0)")
    doubled = F.try_add(F.try_multiply(numerator, two), denominator)
    fits = numerator.cast("double") < denominator.cast("double") * F.lit(9e17)
    units = F.when(
        fits & (denominator != 0) & doubled.isNotNull(),
        F.call_function("div", doubled, F.try_multiply(denominator, two)),
    )
    unit = F.lit(f"{10 ** -scale:.{scale}f}").cast(f"decimal({scale + 1},{scale})")
    return units.try_cast("decimal(18,0)") * unit


def fmt_amount(c: ColumnOrName, scale: int = 2) -> Column:
    """Fixed places, point as separator, a leading zero: ``0.50``."""
    return F.round(as_col(c), scale).cast(f"decimal(38,{scale})").cast("string")
