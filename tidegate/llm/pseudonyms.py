"""Format-preserving pseudonyms for personal data, by keyed Feistel networks.

A value that is found and valid is cut in two numbers; in each round one is moved, modulo its range,
by a keyed hash of the other. That permutes the values of a format among themselves,
so equal values stay equal in all documents and different ones different:

card     13 to 19 digits with a Luhn check digit: the first stays, the check digit is made anew
phone    10 to 15 digits in a phone layout: the last ten are permuted
ssn      nine digits in valid ranges; the result is in them too
iban     valid modulo 97: the digits of the account are permuted, the check digits made anew
ip       four octets
date     1900-01-01 to 2099-12-31, year first or last, a time may follow: another date whose day and month
         are as wide and read in the same order, the 29th, 30th and 31st to ones that exist
email    letters and digits of the name, each within its kind; the host stays
secret   access keys and long hexadecimal strings, each character within its kind

Digits, separators and padding stay where they are; how a value is written does not change its
pseudonym. A date ``a/b/yyyy`` is read as day/month, or as month/day where only that exists.
An IBAN ends at its country's length; one of a country without a known length, and a phone number in
groups of a country other than +1, takes in a short group behind it that could be part of it.
What is not valid stays as it is. All of it is column functions.

Defined results: a null text stays null, an empty one empty, with counts 0. Repeated
rows are treated one by one; other columns are ignored. No rows in, no rows out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.work import let

ROUNDS = 10
KINDS = ["email", "ip", "date", "ssn", "phone", "iban", "card", "secret"]

_B, _E = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_IP = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"
_DATE = (
    rf"(?<![0-9A-Za-z./-])(?:[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}|[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}"
    rf"|[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}|[0-9]{{1,2}}\.[0-9]{{1,2}}\.[0-9]{{4}}|[0-9]{{1,2}}-[0-9]{{1,2}}-[0-9]{{4}})"
    rf"(?!(?!T[0-9]{{2}}:)[0-9A-Za-z]|[./-][0-9])"  # a time may follow
)
_SSN = rf"{_B}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_E}"
_NEXT = r"[ .-]?[0-9]"  # written out below, as a pattern that looks back takes no loop
_PHONE = (  # of 10 to 15 digits, so that a number behind it is not taken in beyond them
    r"(?<![0-9A-Za-z])(?:\+[0-9]{10,15}|\+1(?:[ .-]?[0-9]{3}){2}[ .-]?[0-9]{4}"
    r"|(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    r"|(?:\+?[0-9]{1,3}[ .-])?[0-9]{3}(?:[.-][0-9]{3}[.-]| [0-9]{3} )[0-9]{4}"
    rf"|\+[0-9]{{1,3}}(?:[ .-]?[0-9]{{2,4}}){{2,5}}(?<=\+[0-9]{_NEXT * 9}{f"(?:{_NEXT})?" * 5})){_E}"
)
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    rest = (length - 4) % 4
    tail = rf" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(length - 4) // 4}}}{tail}"


# Of its country's length first, so that a word behind it is not taken in; then of any.
_IBAN = (
    rf"{_B}(?:{'|'.join(_iban_of(n, c) for n, c in _IBAN_LENGTHS.items())}"
    rf"|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?){_E}"
)
_CARD = (  # no longer than one number, so that one beside it is not taken in
    rf"{_B}(?:[0-9]{{13,19}}|(?:[0-9]{{4}} ){{3}}[0-9]{{4}}|(?:[0-9]{{4}}-){{3}}[0-9]{{4}}"
    rf"|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{5}}){_E}"
)
_SECRET = rf"{_B}(?:AKIA[0-9A-Z]{{16}}|(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{{16,}}){_E}"
PATTERN = "|".join([_EMAIL, _IP, _DATE, _SSN, _PHONE, _IBAN, _CARD, _SECRET])


def _matches(m: Column, pattern: str) -> Column:
    return m.rlike(rf"\A(?:{pattern})\z")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _char(s: Column, i: Column) -> Column:
    return F.substr(s, i, F.lit(1))


def _hash(key: str, kind: str, r: Column, other: Column, more: Column | None = None) -> Column:
    """60 keyed bits of a half and the number of the round."""
    parts = [F.lit(key), F.lit(kind), r.cast("string"), other.cast("string")]
    text = F.concat_ws("|", *parts, *([more.cast("string")] if more is not None else []))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, a: Column, b: Column, ma: Column, mb: Column) -> Column:
    """A permutation of the pairs (a, b) with a below ``ma`` and b below ``mb``."""

    def step(s: Column, r: Column) -> Column:
        move_a = F.struct(((s["a"] + F.pmod(_hash(key, kind, r, s["b"]), ma)) % ma).alias("a"), s["b"].alias("b"))
        move_b = F.struct(s["a"].alias("a"), ((s["b"] + F.pmod(_hash(key, kind, r, s["a"]), mb)) % mb).alias("b"))
        return F.when(r % 2 == 0, move_a).otherwise(move_b)

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _ten_to(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permute_digits(key: str, kind: str, digits: Column) -> Column:
    """A string of 2 to 36 digits as another one of that length."""

    def cut(t: Column) -> Column:
        left, right = t["n"] - F.floor(t["n"] / 2).cast("int"), F.floor(t["n"] / 2).cast("int")
        halves = feistel(
            key,
            kind,
            F.substr(t["d"], F.lit(1), left),
            F.substr(t["d"], left + 1, right),
            _ten_to(left),
            _ten_to(right),
        )
        return let(
            halves,
            lambda h: F.concat(
                F.lpad(h["a"].cast("string"), left, "0"), F.lpad(h["b"].cast("string"), right, "0")
            ),
        )

    return let(F.struct(digits.alias("d"), F.length(digits).alias("n")), cut)


def _refill(m: Column, digits: Column) -> Column:
    """The digits of ``m`` replaced in turn."""

    def one(i: Column) -> Column:
        nth = F.length(_digits(F.substr(m, F.lit(1), i)))
        return F.when(_char(m, i).rlike("[0-9]"), _char(digits, nth)).otherwise(_char(m, i))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10."""
    n = F.length(digits)

    def add(s: Column, i: Column) -> Column:
        d = _char(digits, i).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return s + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10


def _card(key: str, d: Column) -> Column:
    n = F.length(d)
    inner = permute_digits(key, "card", F.substr(d, F.lit(2), n - 2))
    return let(
        F.concat(F.substr(d, F.lit(1), F.lit(1)), inner, F.lit("0")),
        lambda x: F.concat(F.substr(x, F.lit(1), n - 1), ((10 - _luhn(x)) % 10).cast("string")),
    )


def _phone(key: str, d: Column) -> Column:
    n = F.length(d)
    return F.concat(F.substr(d, F.lit(1), n - 10), permute_digits(key, "phone", F.substr(d, n - 9, F.lit(10))))


def _ssn_valid(d: Column) -> Column:
    return d.rlike(r"\A(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}\z")


def _ssn(key: str, d: Column) -> Column:
    area = F.substring(d, 1, 3).cast("int")
    place = F.when(area < 666, area - 1).otherwise(area - 2)  # 898 areas, without 000, 666 and 9xx
    a = place * 99 + F.substring(d, 4, 2).cast("int") - 1
    b = F.substring(d, 6, 4).cast("int") - 1

    def write(h: Column) -> Column:
        at = F.floor(h["a"] / 99).cast("int")
        new = F.when(at < 665, at + 1).otherwise(at + 2)
        return F.concat(
            F.lpad(new.cast("string"), 3, "0"),
            F.lpad((h["a"] % 99 + 1).cast("string"), 2, "0"),
            F.lpad((h["b"] + 1).cast("string"), 4, "0"),
        )

    return let(feistel(key, "ssn", a, b, F.lit(898 * 99), F.lit(9999)), write)


def _ip(key: str, m: Column) -> Column:
    def half(octets: Column, k: int) -> Column:
        return octets[k].cast("int") * 256 + octets[k + 1].cast("int")

    def write(h: Column) -> Column:
        parts = [F.floor(h["a"] / 256), h["a"] % 256, F.floor(h["b"] / 256), h["b"] % 256]
        return F.concat_ws(".", *[p.cast("string") for p in parts])

    full = F.lit(65536)
    return let(
        F.split(m, r"\."), lambda o: let(feistel(key, "ip", half(o, 0), half(o, 2), full, full), write)
    )


def _ip_valid(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda o: o.cast("int") <= 255)


def _mod97(s: Column) -> Column:
    """The remainder of the characters as a number, A being 10."""

    def add(acc: Column, i: Column) -> Column:
        c = _char(s, i)
        return F.when(c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise(
            (acc * 100 + F.ascii(c) - 55) % 97
        )

    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), add)


def _iban_valid(m: Column) -> Column:
    s = F.regexp_replace(m, " ", "")
    return _mod97(F.concat(F.substr(s, F.lit(5)), F.substring(s, 1, 4))) == 1


def _iban(key: str, m: Column) -> Column:
    rest = F.substr(m, F.lit(5))
    d = _digits(rest)
    new = F.when(F.length(d) >= 2, _refill(rest, permute_digits(key, "iban", d))).otherwise(rest)

    def write(x: Column) -> Column:
        country = F.substring(m, 1, 2)
        check = 98 - _mod97(F.concat(F.regexp_replace(x, " ", ""), country, F.lit("00")))
        return F.concat(country, F.lpad(check.cast("string"), 2, "0"), x)

    return let(new, write)


_PARTS = r"\A([0-9]+)([-/.])([0-9]+)[-/.]([0-9]+)\z"


def _date_parts(m: Column) -> Column:
    """Year, month and day as numbers, and the layout."""
    x, y, z = (F.regexp_extract(m, _PARTS, k) for k in (1, 3, 4))
    year_first = F.length(x) == 4
    day_first = ~year_first & (y.cast("int") <= 12)
    return F.struct(
        F.when(year_first, x).otherwise(z).cast("int").alias("year"),
        F.when(year_first | day_first, y).otherwise(x).cast("int").alias("month"),
        F.when(year_first, z).when(day_first, x).otherwise(y).cast("int").alias("day"),
        year_first.alias("year_first"),
        day_first.alias("day_first"),
        F.regexp_extract(m, _PARTS, 2).alias("mark"),
        F.length(F.when(year_first | day_first, y).otherwise(x)).alias("month_width"),
        F.length(F.when(year_first, z).when(day_first, x).otherwise(y)).alias("day_width"),
    )


def _days(year: Column, month: Column) -> Column:
    """Days of a month of 1900 to 2099."""
    leap = (year % 4 == 0) & (year != 1900)
    return F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def _date_valid(m: Column) -> Column:
    return let(
        _date_parts(m),
        lambda p: p["year"].between(1900, 2099)
        & p["month"].between(1, 12)
        & (p["day"] >= 1)
        & (p["day"] <= _days(p["year"], p["month"])),
    )


def _date(key: str, m: Column) -> Column:
    """Another date of the same kind.

    Months 1 to 9 and 10 to 12, and days 1 to 9, 10 to 12 and 13 to 28 stay among themselves, so a date keeps its
    width and is read in the same order as before; the 29th, 30th and 31st move to months that have them.
    """

    def months(*numbers: int) -> tuple[Column, int]:
        return F.array(*[F.lit(k) for k in numbers]), len(numbers)

    def permute(p: Column) -> Column:
        year, month, day = p["year"] - 1900, p["month"], p["day"]
        early = month <= 9
        first_month, n_months = F.when(early, 1).otherwise(10), F.when(early, 9).otherwise(3)
        first_day = F.when(day <= 9, 1).when(day <= 12, 10).otherwise(13)
        n_days = F.when(day <= 9, 9).when(day <= 12, 3).otherwise(16)
        place = (month - first_month) * n_days + day - first_day
        plain = let(
            feistel(key, "date", year, place, F.lit(200), n_months * n_days),
            lambda h: F.struct(
                h["a"] + 1900,
                F.floor(h["b"] / n_days) + first_month,
                h["b"] % n_days + first_day,
            ),
        )
        leap = F.floor(year / 4) - 1  # 1904 is 0, 2096 is 48
        leaps = let(
            feistel(key, "date29", F.floor(leap / 7), leap % 7, F.lit(7), F.lit(7)),
            lambda h: F.struct(1904 + 4 * (h["a"] * 7 + h["b"]), F.lit(2).cast("long"), F.lit(29).cast("long")),
        )

        def listed(of: tuple[Column, int], name: str) -> Column:
            place = F.array_position(of[0], month) - 1
            return let(
                feistel(key, name, year, place, F.lit(200), F.lit(of[1])),
                lambda h: F.struct(
                    h["a"] + 1900, F.element_at(of[0], (h["b"] + 1).cast("int")).cast("long"), day.cast("long")
                ),
            )

        chosen = (
            F.when(day <= 28, plain)
            .when((month == 2) & (day == 29), leaps)
            .when((day == 31) & early, listed(months(1, 3, 5, 7, 8), "date31"))
            .when(day == 31, listed(months(10, 12), "date31"))
            .when(early, listed(months(1, 3, 4, 5, 6, 7, 8, 9), "date30"))
            .otherwise(listed(months(10, 11, 12), "date30"))
        )

        def write(c: Column) -> Column:
            new = [c[f"col{k}"].cast("string") for k in (1, 2, 3)]
            month_text = F.when(p["month_width"] == 2, F.lpad(new[1], 2, "0")).otherwise(new[1])
            day_text = F.when(p["day_width"] == 2, F.lpad(new[2], 2, "0")).otherwise(new[2])
            return (
                F.when(p["year_first"], F.concat(new[0], p["mark"], month_text, p["mark"], day_text))
                .when(p["day_first"], F.concat(day_text, p["mark"], month_text, p["mark"], new[0]))
                .otherwise(F.concat(month_text, p["mark"], day_text, p["mark"], new[0]))
            )

        return let(chosen, write)

    return let(_date_parts(m), permute)


def permute_text(key: str, kind: str, s: Column, hexadecimal: Column | None = None) -> Column:
    """Letters and digits moved within their kind, by a Feistel network on the halves of the string."""
    small = F.lit(26) if hexadecimal is None else F.when(hexadecimal, 6).otherwise(26)

    def moved(half: Column, r: Column, other: Column) -> Column:
        def one(i: Column) -> Column:
            c = _char(half, i)
            by = _hash(key, kind, r, other, i)
            letter = lambda first, size: F.char((F.ascii(c) - first + by) % size + first)
            return (
                F.when(c.rlike("[0-9]"), letter(48, F.lit(10)))
                .when(c.rlike("[a-z]"), letter(97, small))
                .when(c.rlike("[A-Z]"), letter(65, F.lit(26)))
                .otherwise(c)
            )

        empty = F.length(half) == 0
        return F.when(empty, half).otherwise(
            F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(half), F.lit(1))), one), "")
        )

    def step(h: Column, r: Column) -> Column:
        return F.when(
            r % 2 == 0, F.struct(moved(h["a"], r, h["b"]).alias("a"), h["b"].alias("b"))
        ).otherwise(F.struct(h["a"].alias("a"), moved(h["b"], r, h["a"]).alias("b")))

    left = F.length(s) - F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), left).alias("a"), F.substr(s, left + 1).alias("b"))
    return let(
        F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step), lambda h: F.concat(h["a"], h["b"])
    )


def _email(key: str, m: Column) -> Column:
    return F.concat(
        permute_text(key, "email", F.lower(F.substring_index(m, "@", 1))), F.lit("@"), F.substring_index(m, "@", -1)
    )


def _secret(key: str, m: Column) -> Column:
    access = m.startswith("AKIA")
    return F.when(
        access, F.concat(F.lit("AKIA"), permute_text(key, "access", F.substr(m, F.lit(5))))
    ).otherwise(permute_text(key, "hex", m, F.lit(True)))


def pseudonym(key: str, m: Column) -> Column:
    """(kind, value) of a match of PATTERN; kind is null and the value as it was if it is not valid."""
    d = _digits(m)

    def found(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    return (
        F.when(F.contains(m, F.lit("@")), found("email", _email(key, m)))
        .when(_matches(m, _IP) & _ip_valid(m), found("ip", _ip(key, m)))
        .when(_matches(m, _DATE) & _date_valid(m), found("date", _date(key, m)))
        .when(_matches(m, _SSN) & _ssn_valid(d), found("ssn", _refill(m, _ssn(key, d))))
        .when(
            _matches(m, _PHONE) & F.length(d).between(10, 15), found("phone", _refill(m, _phone(key, d)))
        )
        .when(_matches(m, _IBAN) & _iban_valid(m), found("iban", _iban(key, m)))
        .when(_matches(m, _CARD) & (_luhn(d) == 0), found("card", _refill(m, _card(key, d))))
        .when(_matches(m, _SECRET), found("secret", _secret(key, m)))
        .otherwise(F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value")))
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with pseudonyms, and how many values of each kind were replaced."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    found = source.withColumn("_raw", F.regexp_extract_all("_text", F.lit(PATTERN), F.lit(0)))
    found = found.withColumn(
        "_found", F.when(F.size("_raw") > 0, F.transform("_raw", lambda m: pseudonym(key, m)))
    )
    between = F.split("_text", PATTERN, -1)
    spliced = F.concat(
        between[0],
        F.array_join(
            F.zip_with(F.col("_found"), F.slice(between, F.lit(2), F.size("_raw")), lambda f, g: F.concat(f["value"], g)), ""
        ),
    )
    kinds = F.transform("_found", lambda f: F.coalesce(f["kind"], F.lit("")))
    counts = [
        F.coalesce(F.size("_found") - F.size(F.array_remove(kinds, kind)), F.lit(0)).alias(f"n_{kind}")
        for kind in KINDS
    ]
    kept = F.when(F.col("_found").isNull(), F.col("_text")).otherwise(spliced)
    return found.select("doc_id", kept.alias("text"), *counts)
