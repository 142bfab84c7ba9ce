import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from tidegate.llm import pseudonyms as P


def luhn_ok(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def with_check(digits):
    return next(digits + str(c) for c in range(10) if luhn_ok(digits + str(c)))


def run(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.asDict() for r in sorted(P.pseudonymise(df, key).collect(), key=lambda r: r["doc_id"])]


@pytest.fixture(scope="module")
def values():
    draw = random.Random(1)
    digits = lambda n: "".join(draw.choices("0123456789", k=n))
    day = lambda: datetime.date(1900, 1, 1) + datetime.timedelta(draw.randrange(73049))
    return {
        "card": [with_check("4" + digits(n)) for n in (14, 14, 14, 11, 17) for _ in range(6)],
        "ip": [".".join(str(draw.randrange(256)) for _ in range(4)) for _ in range(30)],
        "date": [day().isoformat() for _ in range(30)] + ["2000-02-29", "1999-12-31", "1904-02-29", "2001-04-30"],
        "phone": [f"+1 ({digits(3)}) {digits(3)}-{digits(4)}" for _ in range(20)],
        "ssn": [f"{draw.randint(1, 665):03}-{draw.randint(1, 99):02}-{draw.randint(1, 9999):04}" for _ in range(20)],
        "email": [f"ab{digits(2)}.x+{k}@mail{k}.example.com" for k in range(20)],
        "secret": ["AKIA" + "".join(draw.choices("ABCDEF234567", k=16)) for _ in range(5)] + ["3f" + "a0b1c2d3" * 3],
        "iban": ["GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00"],
    }


def shape(s):
    return re.sub(r"[0-9]", "9", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", s)))


def test_values_keep_their_format_and_validity(spark, values):
    flat = [(kind, v) for kind, those in values.items() for v in those]
    got = run(spark, [f"x {v} y" for _, v in flat] + [f"- {v} ." for _, v in flat])
    new = [r["text"][2:-2] for r in got]
    assert new[: len(flat)] == new[len(flat) :]  # equal values stay linked
    assert len({(k, n) for (k, _), n in zip(flat, new)}) == len(set(flat))
    assert sum(v == n for (_, v), n in zip(flat, new)) <= 1
    for (kind, a), b, r in zip(flat, new, got):
        assert {k: r[f"n_{k}"] for k in P.KINDS} == {k: int(k == kind) for k in P.KINDS}
        if kind == "ip":
            assert all(0 <= int(o) <= 255 for o in b.split("."))
        else:
            assert shape(a) == shape(b)
        if kind == "card":
            assert luhn_ok(b) and a[0] == b[0]
        if kind == "date":
            datetime.date.fromisoformat(b)
        if kind == "email":
            assert a.split("@")[1] == b.split("@")[1]
        if kind == "iban":
            s = b.replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    assert run(spark, [f"x {flat[0][1]} y"], key="other")[0]["text"] != got[0]["text"]


def test_ways_of_writing_share_a_pseudonym(spark):
    card = with_check("411111111111111")
    spaced = " ".join(card[i : i + 4] for i in range(0, 16, 4))
    dates = ["2021-03-17", "2021/3/17", "17.03.2021", "17/3/2021", "3/17/2021"]
    got = [r["text"] for r in run(spark, [card, spaced, f"({spaced})", "+1 (212) 555-0187", "212-555-0187", "212.555.0187", *dates])]
    plain = [re.sub(r"[^0-9]", "", t) for t in got]
    assert plain[0] == plain[1] == plain[2]
    assert plain[3][1:] == plain[4] == plain[5]
    read = [tuple(int(x) for x in re.split(r"[-/.]", d)) for d in got[6:]]
    assert read[0] == read[1] == read[2][::-1] == read[3][::-1]
    assert sorted(read[4][:2]) == sorted(read[0][1:])


def test_small_ranges_are_permuted(spark):
    leap = [f"{y}-02-29" for y in range(1904, 2100, 4)]
    ends = [f"{y}-{m:02}-31" for y in range(1900, 2100, 10) for m in (1, 3, 5, 7, 8, 10, 12)]
    got = [r["text"] for r in run(spark, leap + ends)]
    assert sorted(got[: len(leap)]) == leap
    assert len(set(got[len(leap) :])) == len(ends)
    pairs = spark.range(35).select(
        P.feistel("k", "t", F.col("id") % 5, F.floor(F.col("id") / 5), F.lit(5), F.lit(7)).alias("p")
    )
    assert pairs.distinct().count() == 35


def test_what_is_not_valid_stays(spark):
    texts = ["4111111111111112", "256.1.1.1", "1.2.3.4.5", "2023-02-29", "1899-12-31", "2021-13-01", "000-12-3456",
             "666-12-3456", "912-12-3456", "v1.2.3", "12345", "GB00WEST12345698765432", "deadbeef", "a@b", "1/2/3"]
    got = run(spark, texts)
    assert [r["text"] for r in got] == texts
    assert all(r[f"n_{k}"] == 0 for r in got for k in P.KINDS)


def test_texts_around_values(spark, values):
    draw = random.Random(2)
    texts, kinds = [], []
    for _ in range(30):
        parts, found = [draw.choice(["", "é\n"])], []
        for _ in range(draw.randint(0, 6)):
            kind = draw.choice(list(values))
            found.append(kind)
            parts += [draw.choice(values[kind]), draw.choice([" ", ", and ", "\n日本 "])]
        texts.append("".join(parts))
        kinds.append(found)
    alone = [v for those in values.values() for v in those[:2]]
    got = run(spark, alone + texts)
    single = {v: r["text"] for v, r in zip(alone, got)}
    for text, found, r in zip(texts, kinds, got[len(alone) :]):
        assert {k: r[f"n_{k}"] for k in P.KINDS} == {k: found.count(k) for k in P.KINDS}
        for a, b in single.items():
            assert text.count(a) == r["text"].count(b) or a in b


def test_short_tokens_behind_values(spark, values):
    """A number, a year or an upper-case word behind a value leaves it to be found."""
    cases = [(kind, v) for kind, some in values.items() for v in some[:2]]
    cases += [("iban", v) for v in ("ES9121000418450200051332", "BE68 5390 0754 7034", "AT611904300234573201")]
    cases += [("phone", v) for v in ("+442071234567", "+44 20 7123 4567", "+14155550123", "+1 415 555 0123")]
    for tail in (" IN", " EUR", " 2024", " 1200 2024"):
        alone, behind = run(spark, [v for _, v in cases]), run(spark, [v + tail for _, v in cases])
        for (kind, v), a, b in zip(cases, alone, behind, strict=True):
            assert a[f"n_{kind}"] == b[f"n_{kind}"] == 1, (kind, v, tail)
            assert b["text"] == a["text"] + tail, (kind, v, tail)


def test_odd_rows(spark, make, messy):
    got = P.pseudonymise(make(messy), "k").collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["text"] is None) for r in got) == sorted(
        (i is None, i or 0, t or "", t is None) for i, t, _, _ in messy
    )
    assert P.pseudonymise(make([]), "k").collect() == []


def test_no_python_in_the_plan(spark, make):
    plan = P.pseudonymise(make([(1, "a", "en", "s")]), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def read_date(text):
    """The day that a written date means: year first, or day first where that exists, or month first."""
    a, b, c = map(int, re.split("[-/.]", text))
    return datetime.date(a, b, c) if a > 31 else datetime.date(c, b, a) if b <= 12 else datetime.date(c, a, b)


def test_dates_of_every_order_are_told_apart(spark):
    """No two days share a pseudonym, whatever order they are written in; width, order and links are kept."""
    days = [datetime.date(y, m, d) for y in range(2000, 2004) for m in range(1, 13) for d in range(1, 29)]
    days += [datetime.date(2000, 2, 29)] + [datetime.date(2001, m, 30) for m in (1, 4, 9, 11, 12)]
    days += [datetime.date(y, m, 31) for y in (2000, 2001) for m in (1, 3, 5, 7, 8, 10, 12)]
    texts = []
    for x in days:
        texts += [f"{x:%Y-%m-%d}", f"{x.day}/{x.month}/{x.year}", f"{x:%d.%m.%Y}"]
        if x.day > 12:
            texts += [f"{x.month}/{x.day}/{x.year}", f"{x:%m/%d/%Y}"]
    got = [r["text"] for r in run(spark, texts)]
    by_day = {}
    for before, after in zip(texts, got):
        assert re.sub("[0-9]", "0", before) == re.sub("[0-9]", "0", after)
        by_day.setdefault(read_date(before), set()).add(read_date(after))
    assert len(by_day) == len(days)
    assert all(len(x) == 1 for x in by_day.values())
    assert len({min(x) for x in by_day.values()}) == len(days)


def test_dates_with_times_and_spaced_phones(spark):
    texts = ["at 2024-01-05T10:00:00Z", "call 212 555 0123 now", "2024-01-05", "212-555-0123", "2024-01-05Tx"]
    timed, spaced, date, phone, other = [r["text"] for r in run(spark, texts)]
    assert timed == f"at {date}T10:00:00Z" and date != "2024-01-05"
    assert re.sub("[^0-9]", "", spaced) == re.sub("[^0-9]", "", phone) and "212 555 0123" not in spaced
    assert other == "2024-01-05Tx"
