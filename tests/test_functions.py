"""Column functions, against plain Python where that is the clearer statement."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate import functions as fn
from tidegate import schemas as S
from tidegate.operators.fx import to_eur
from tidegate.plans.runs import StepError, normalise_run_mode
from tidegate.sources import reference


def apply(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", f("x").alias("y")).orderBy("i").collect()]


def test_blank_text_is_missing(spark):
    assert apply(spark, ["  a b ", "   ", "", None, "\ta"], fn.norm_text) == ["a b", None, None, None, "\ta"]
    assert apply(spark, [" eur ", None], fn.norm_code) == ["EUR", None]


def test_numbers(spark):
    texts = ["12", "-1.5", "1.25E3", ".5", "5.", "1e400", "12d", "", "1 2", "NaN", "٣", None, "+7"]
    got = apply(spark, texts, fn.parse_number)
    want = ["12", "-1.5", "1250", "0.5", "5", "9" * 28, None, None, None, None, None, None, "7"]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_stored_numbers_round_half_up_and_may_not_fit(spark):
    def stored(x):
        return fn.to_number(fn.parse_number(x), 14, 2)

    assert apply(spark, ["0.005", "1.004", "-0.005", "1e12"], stored) == [
        Decimal("0.01"), Decimal("1.00"), Decimal("-0.01"), None,
    ]
    assert apply(spark, ["899.5", "10"], lambda x: fn.to_number(fn.parse_number(x), 4, 0)) == [900, 10]
    texts = ["1e12", "999999999999.99", None, "1e40", "-" + "7" * 30, "1e999999999999", "1e-999999999999"]
    assert apply(spark, texts, lambda x: fn.fits(fn.parse_number(x), 14, 2)) == [
        False, True, True, False, False, False, True,
    ]


def some_number(draw):
    digits = lambda n: "".join(draw.choices("0123456789", k=draw.randint(0, n)))
    tail = draw.choice(["", ".", ".00", ".0049999999999999", ".005", ".00500000000000000001", ".999999999999"])
    power = draw.choice(["", "", "e3", "E-5", "e+0", "e-30", "E12"])
    return draw.choice(["", "-", "+"]) + digits(22) + (tail + digits(6) if tail else "") + power


def test_numbers_are_exact(spark):
    """Signs, comparisons, rounding and equality are those of the exact numbers, however many digits they have."""
    draw = random.Random(1)
    texts = sorted({some_number(draw) for _ in range(400)} | {
        "0.00499999999999", "15000.00499999999999", "-0.00000000001", "1.00000000001", "1.00000000002", "1", "1.0",
        "01.00e0", "10E-1", "-0", "0e9", "12345678901234567890.5", "0.0000000004", "1e-10", "1e-11",
    })

    def exact(t):
        try:
            return Decimal(t) if any(c.isdigit() for c in t.lower().split("e")[0]) else None
        except ArithmeticError:
            return None

    df = spark.createDataFrame([(t,) for t in texts], "x string").withColumn("p", fn.parse_number("x"))
    rows = df.select(
        "x", (F.col("p") < 0).alias("negative"), fn.in_range("p", 0, 999).alias("inside"),
        fn.to_number("p", 14, 2).alias("money"), fn.fits("p", 14, 2).alias("fits"), "p",
        fn.number_rest("x").alias("rest"),
    ).collect()
    same = {}
    for r in rows:
        value = exact(r.x)
        if value is None:
            assert r.p is None
            continue
        cents = value.quantize(Decimal("0.01"), ROUND_HALF_UP) if value.adjusted() < 25 else value
        fits = abs(cents) < 10**12
        assert (r.negative, r.inside, r.fits) == (value < 0, 0 <= value <= 999, fits), r.x
        assert r.money == (cents if fits else None), r.x
        assert same.setdefault((r.p, r.rest), value) == value, r.x
    assert len(same) == len(set(same.values()))


@pytest.mark.parametrize("text,want", [
    ("2026-03-26 10:15:00", dt.datetime(2026, 3, 26, 10, 15)),
    ("2026/03/26 10:15:00", dt.datetime(2026, 3, 26, 10, 15)),
    ("2026-3-2 9:4:3", dt.datetime(2026, 3, 2, 9, 4, 3)),
    ("20260326101500", dt.datetime(2026, 3, 26, 10, 15)),
    ("2026-03-26", dt.datetime(2026, 3, 26)),
    ("2026-03-26 10:5", dt.datetime(2026, 3, 26, 10, 5)),
    ("2026-03-08 02:30:00", dt.datetime(2026, 3, 8, 2, 30)),  # does not exist in New York
    ("26-03-26 1:1:1", dt.datetime(26, 3, 26, 1, 1, 1)),
    ("2026-02-30 10:00:00", None),
    ("2026-03-26 24:00:00", None),
    ("2026-03-26T10:15:00", None),
    ("2026-03-26 10:15:00.5", None),
    ("0000-01-01 00:00:00", None),
    ("0-1-1", None),
    ("soon", None),
    (None, None),
])
def test_lenient_times(spark, text, want):
    assert apply(spark, [text], fn.to_ts_lenient) == [want]


def test_lenient_dates(spark):
    texts = ["1980-02-29", "1981-02-29", "1980/2/9", "19800209", "1980-02-09 10:00:00", "00-1-1", None]
    assert apply(spark, texts, fn.to_date_lenient) == [
        dt.date(1980, 2, 29), None, dt.date(1980, 2, 9), dt.date(1980, 2, 9), None, None, None,
    ]


def test_matches_the_whole_value(spark):
    assert apply(spark, ["AB", "AB\n", "ABC", "ab", None], lambda x: fn.matches(x, "[A-Z]{2}")) == [
        True, False, False, False, None,
    ]
    assert apply(spark, ["+1234567", "+123456", "1234567"], lambda x: fn.matches(x, S.PHONE_FORMAT)) == [
        True, False, False,
    ]
    assert apply(spark, ["a@b.c", "a@b", "a b@c.d", "a@b@c.d"], lambda x: fn.matches(x, S.EMAIL_FORMAT)) == [
        True, False, False, False,
    ]


def test_text_helpers(spark):
    assert apply(spark, [";;a;b;", ";", None], lambda x: fn.trim_both(x, ";")) == ["a;b", None, None]
    assert apply(spark, ["abcdef"], lambda x: fn.truncate(x, 3)) == ["abc"]
    assert apply(spark, [None, "x"], lambda x: fn.nvl(x, "?")) == ["?", "x"]
    assert apply(spark, [Decimal("0.5"), Decimal("-12.345"), None], fn.fmt_amount, "decimal(10,3)") == [
        "0.50", "-12.35", None,
    ]


def test_due_dates(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ '2026-04-15 23:59:59' AS ts, stack(3, 'ART72_THRESHOLD', 'ART74_SUSPICION',"
        " 'ART72_AND_ART74') AS kind"
    )
    got = {r.kind: r.due.day for r in df.select("kind", fn.due_date("ts", "kind").alias("due")).collect()}
    assert got == {"ART72_THRESHOLD": 22, "ART74_SUSPICION": 17, "ART72_AND_ART74": 17}


def test_run_modes():
    assert normalise_run_mode(" auto ", -1) == "AUTO"
    for bad, shown in ((None, "<NULL>"), ("  ", "<BLANK>"), ("daily", "daily")):
        with pytest.raises(StepError, match=shown) as error:
            normalise_run_mode(bad, -20401)
        assert error.value.code == -20401


amounts = st.decimals(0, Decimal("9999999999.99"), places=2)
mids = st.decimals(Decimal("0.00000001"), Decimal("999.99999999"), places=8)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(amounts, mids, st.sampled_from([1, 10, 100])), min_size=30, max_size=30))
def test_eur_amounts_are_exact(spark, rows):
    day, eur = dt.date(2026, 4, 15), Decimal("4.2618")
    codes = [f"C{i:02d}" for i in range(len(rows))]
    fx = reference.fx_rates(
        spark, [(day, "EUR", 1, eur)] + [(day, c, u, m) for c, (_, m, u) in zip(codes, rows)]
    )
    transfers = spark.createDataFrame(
        [(day, c, a) for c, (a, _, _) in zip(codes, rows)],
        "business_date date, currency_code string, amount decimal(14,2)",
    )
    got = {r.currency_code: (r.amount_eur, r.fx_rate_to_eur) for r in to_eur(transfers, fx).collect()}
    from fractions import Fraction

    def half_up(value, places):
        scaled = value * 10**places
        units = int(scaled + Fraction(1, 2))
        return Decimal(units).scaleb(-places)

    for code, (amount, mid, units) in zip(codes, rows):
        rate = Fraction(mid) / units / Fraction(eur)
        assert got[code] == (half_up(Fraction(amount) * rate, 2), half_up(rate, 8))


def test_rounding_an_already_rounded_quotient_would_be_wrong(spark):
    """0.00499950.. must stay below the half cent; six-place division lifts it onto it."""
    day = dt.date(2026, 4, 15)
    fx = reference.fx_rates(spark, [(day, "EUR", 1, Decimal("3")), (day, "USD", 1, Decimal("1.00000001"))])
    df = spark.createDataFrame([(day, "USD", Decimal("37036.22"))], "business_date date, currency_code string, amount decimal(14,2)")
    exact = (Decimal("37036.22") * Decimal("1.00000001") / 3).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert [r.amount_eur for r in to_eur(df, fx).collect()] == [exact]
