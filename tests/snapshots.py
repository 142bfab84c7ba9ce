"""Inbound files for the tests: small dated snapshots with known outcomes."""

from __future__ import annotations

import datetime as dt
from fractions import Fraction
from pathlib import Path

from tidegate import schemas as S

MAR = [dt.date(2026, 3, d) for d in range(24, 30)]
APR = {d: dt.date(2026, 4, d) for d in (7, 8, 9, 10, 11, 12, 15)}


def client(date, client_id, kind="PRIVATE", **more):
    """One client line; ``more`` overrides single fields."""
    private = kind.strip().upper() == "PRIVATE"
    row = {
        "business_date": f"{date:%Y-%m-%d}",
        "client_id": client_id,
        "client_type": kind,
        "full_name": f"Person {client_id}" if private else f"Firm {client_id}",
        "first_name": "Pat" if private else "",
        "last_name": f"No{client_id}" if private else "",
        "company_name": "" if private else f"Firm {client_id}",
        "date_of_birth": "1980-02-29" if private else "",
        "registration_no": "" if private else f"REG-{client_id}",
        "address_line_1": f"{client_id} Test Street",
        "city": "Testville",
        "postal_code": "00-001",
        "country_code": "PL",
        "pep_flag": 0,
        "high_risk_flag": 0,
        "client_status": "ACTIVE",
        "document_id": f"DOC-{client_id}",
        "tax_id": f"TAX-{client_id}",
        "phone_number": "+48123456789",
        "email": f"c{client_id}@example.invalid",
        "kyc_status": "PASS",
        "risk_score": 100,
    }
    row.update(more)
    return ";".join(str(row.get(f.name, "")) for f in S.CLIENTS.fields)


def transfer(date, transfer_id, client_id, amount="100.00", currency="EUR", **more):
    row = {
        "transfer_id": transfer_id,
        "client_id": client_id,
        "source_account": "PL00000000000000000000000001",
        "target_account": "DE0000000000000000000002",
        "amount": amount,
        "currency_code": currency,
        "transfer_ts": f"{date:%Y-%m-%d} 10:15:00",
        "transfer_status": "COMPLETED",
        "channel": "WEB",
        "country_code": "PL",
        "transfer_title": "",
    }
    row.update(more)
    return ";".join(str(row[f.name]) for f in S.TRANSFERS.fields)


def put(folder: Path, dataset, date, lines=None, ok=None):
    """Write a data file (header added) and / or its ready file."""
    stem = folder / f"{dataset.name}_{date:%Y%m%d}"
    if lines is not None:
        header = ";".join(f.name for f in dataset.fields)
        stem.with_suffix(".csv").write_text("\n".join([header, *lines]) + "\n")
    if ok is not None:
        stem.with_suffix(".ok").write_text(str(ok))


# The review day: client -> (type, pep, high risk, kyc, score, country).
REVIEW_CLIENTS = {
    11: (" private ", 0, 0, " pass ", 35, " pl "),
    12: ("BUSINESS", 1, 0, "PASS", 520, "DE"),
    13: ("PRIVATE", 0, 1, " manual_check ", 655, "PL"),
    14: (" business ", 0, 0, "PENDING", 305, " fr "),
    15: ("BUSINESS", 0, 1, "LIMITED", 935, "LT"),
    16: ("PRIVATE", 0, 1, "PENDING", 470, "PL"),
    17: ("PRIVATE", 0, 0, "REVIEW", 900, "DE"),
    18: ("BUSINESS", 0, 0, "PASS", 15, "PL"),
    19: ("PRIVATE", 0, 1, "REVIEW", 120, "FR"),
    20: ("PRIVATE", 0, 0, "PASS", 899, "PL"),
}
REVIEW_RATES = [("EUR", 1, "4.2618"), ("USD", 1, "3.7431"), ("GBP", 1, "5.1094"), ("PLN", 1, "1"), ("CZK", 10, "1.7452")]
_OVER, _PEP, _KYC, _SCORE = "over", "pep_flag=1", "high_risk_flag=1; kyc_status=", "risk_score="
# transfer -> (client, amount, currency, reason code, what the details tell)
_REVIEWED = {
    7001: (11, "812.40", " eur ", None),
    7003: (18, "64210.00", "PLN", "ART72_THRESHOLD", _OVER),
    7004: (12, "55.10", "GBP", "ART74_PEP", _PEP),
    7008: (16, "14999.99", "EUR", None),
    7010: (14, "17100.00", "USD", "ART72_THRESHOLD", _OVER),
    7011: (13, "310.00", "CZK", "ART74_HIGH_RISK_KYC", _KYC + "MANUAL_CHECK"),
    7015: (15, "99.99", "USD", "ART74_HIGH_RISK_KYC", _KYC + "LIMITED", _SCORE + "935 >= 900"),
    7016: (15, "13000.00", "GBP", "ART72_AND_ART74", _OVER, _KYC + "LIMITED", _SCORE + "935 >= 900"),
    7020: (17, "420.00", "EUR", "ART74_RISK_SCORE", _SCORE + "900 >= 900"),
    7021: (17, "366320.00", "CZK", "ART72_AND_ART74", _OVER, _SCORE + "900 >= 900"),
    7022: (18, "15000.00", "EUR", None),
    7025: (20, "2400.75", "USD", None),
    7026: (19, "5000.00", "PLN", "ART74_HIGH_RISK_KYC", _KYC + "REVIEW"),
    7030: (14, "3.33", "GBP", None),
    7031: (11, "63927.00", "PLN", None),  # exactly 15,000 EUR
    7040: (12, "16000.00", "EUR", "ART72_AND_ART74", _OVER, _PEP),
    7041: (20, "1.00", "CZK", None),
    7050: (16, "980.25", "GBP", None),
    7051: (19, "21000.00", "GBP", "ART72_AND_ART74", _OVER, _KYC + "REVIEW"),
    7060: (18, "700.00", "USD", None),
}


def _half_up(value: Fraction, places: int) -> str:
    units = (value * 10**places * 2 + 1) // 2
    return f"{units // 10**places}.{units % 10**places:0{places}d}"


def _reviewed():
    """transfer -> (client, amount, currency, expected rate, EUR, reason code, type, details)"""
    pln = {code: Fraction(mid) / units for code, units, mid in REVIEW_RATES}
    for tid, (cid, amount, currency, code, *details) in _REVIEWED.items():
        rate = pln[currency.strip().upper()] / pln["EUR"]
        eur = _half_up(Fraction(amount) * rate, 2)
        told = "; ".join(f"amount_eur={eur} > 15000" if d == _OVER else d for d in details)
        kind = code if code is None or code.startswith("ART72") else "ART74_SUSPICION"
        yield tid, (cid, amount, currency, _half_up(rate, 8), eur, code, kind, told or None)


REVIEW_TRANSFERS = dict(_reviewed())


def write_all(folder: Path) -> None:
    c, t = S.CLIENTS, S.TRANSFERS
    d24, d25, d26, d27, d28, d29 = MAR
    put(folder, c, d24, ok=4)
    put(folder, t, d24, ok=13)

    put(folder, c, d25, ok=9, lines=[
        client(d25, 31),
        client(d25, 36, client_status="PAUSED"),
        client(d25, 32, "BUSINESS"),
        client(d25, 37, "BUSINESS", company_name=""),
        client(d25, 33),
        client(d25, "no-id"),
        client(d25, 34, "BUSINESS"),
        client(d25, 38, last_name=""),
        client(d25, 35, client_status="ARCHIVED"),
    ])
    put(folder, t, d25, ok=12, lines=[
        transfer(d25, 801, 31),
        transfer(d25, 802, 31, "12,5"),
        transfer(d25, 803, 32),
        transfer(d25, 804, 32, transfer_status="LOST"),
        transfer(d25, 805, 33, currency="eu"),
        transfer(d25, 806, 33, transfer_status="PENDING"),
        transfer(d25, "T-1", 34),
        transfer(d25, 808, 34, country_code="P1"),
        transfer(d25, 809, 34, transfer_ts="2026/3/25 9:5:0"),
        transfer(d25, 810, 35, "-0.01"),
        transfer(d25, 811, 35, channel="FAX"),
        transfer(d25, 812, 35, transfer_status="FAILED"),
    ])

    put(folder, c, d26, ok=12, lines=[
        client(d26, 600 + 7 * i, "PRIVATE" if i % 4 else "BUSINESS") for i in range(12)
    ])
    put(folder, t, d26, ok=20, lines=[
        transfer(d26, 90_000 + 3 * i, 600 + 7 * (5 * i % 12), f"{40 + 3 * i}.{7 * i % 100:02d}") for i in range(20)
    ])

    put(folder, c, d27, ok=3, lines=[client(d27, 71, "BUSINESS"), client(d27, 72)])
    put(folder, t, d27, ok=20, lines=[transfer(d27, 910, 71), transfer(d27, 911, 72)])

    put(folder, c, d28, ok=2, lines=[client(d28, 81), client(d28, 82)])
    put(folder, t, d28, ok=2, lines=[transfer(d28, 920, 82), transfer(d28, 920, 81)])
    put(folder, c, d29, ok=2, lines=[client(d29, 91, full_name="One"), client(d29, 91, full_name="Other")])

    d7, d8, d9, d10, d11, d12, d15 = (APR[d] for d in (7, 8, 9, 10, 11, 12, 15))
    for day in (d7, d8):
        put(folder, c, day, lines=[client(day, 55)])
        put(folder, t, day, lines=[transfer(day, 930, 55)])

    put(folder, c, d9, ok=10, lines=[
        client(d9, 201, " business ", country_code=" fr ", client_status=" active ", kyc_status=" limited ", risk_score=999),
        client(d9, 204, email="nobody"),
        client(d9, 205, risk_score="12x"),
        client(d9, 202, phone_number="600700800"),
        client(d9, 206, kyc_status="K" * 31),
        client(d9, 203, " private ", country_code=" lt ", client_status=" archived ", kyc_status=" manual_check ", risk_score=0),
        client(d9, 207, risk_score=1001),
        client(d9, 208, client_status="GONE"),
        client(d9, 201, risk_score="high"),
        client(d9, 209, kyc_status="UNSURE"),
    ])
    put(folder, c, d10, ok=2, lines=[client(d10, 301, "BUSINESS"), client(d10, 302)])
    put(folder, t, d10, ok=2, lines=[
        transfer(d10, 940, 302, currency=" pln ", transfer_status=" failed ", channel=" branch ", country_code=" fr "),
        transfer(d10, 941, 301, currency=" usd ", transfer_status=" rejected ", channel=" api ", country_code=" lt "),
    ])
    put(folder, t, d11, ok=1, lines=[transfer(d11, 950, 311)])
    put(folder, t, d12, ok=2, lines=[
        transfer(d12, 961, 312, currency="GBP", country_code="QQ"),
        transfer(d12, 960, 311, country_code="1F"),
    ])

    put(folder, c, d15, ok=10, lines=[
        client(d15, cid, kind, pep_flag=pep, high_risk_flag=high, kyc_status=kyc, risk_score=score,
               country_code=country, relationship_purpose_code=" savings ", expected_activity_level=" low ",
               source_of_funds_declared="Funds", source_of_wealth_declared="Wealth")
        for cid, (kind, pep, high, kyc, score, country) in REVIEW_CLIENTS.items()
    ])
    put(folder, t, d15, ok=20, lines=[
        transfer(d15, tid, row[0], row[1], row[2], transfer_title=f" Title {tid} ")
        for tid, row in REVIEW_TRANSFERS.items()
    ])


# The outcomes each kind of snapshot must have.
# (process, date, error code, status, reason, promised, stage, reject, core)
MATRIX = [
    ("clients", MAR[0], -20114, "FAILED", "MISSING_DATA_FILE", 4, 0, 0, 0),
    ("client_transfers", MAR[0], -20014, "FAILED", "MISSING_DATA_FILE", 13, 0, 0, 0),
    ("clients", MAR[1], None, "WARNING", "INPUT_VALIDATION_WARNING", 9, 5, 4, 5),
    ("client_transfers", MAR[1], None, "WARNING", "INPUT_VALIDATION_WARNING", 12, 5, 7, 5),
    ("clients", MAR[2], None, "DONE", "LOAD_DONE", 12, 12, 0, 12),
    ("client_transfers", MAR[2], None, "DONE", "LOAD_DONE", 20, 20, 0, 20),
    ("clients", MAR[3], -20117, "FAILED", "OK_COUNT_INCLUDES_HEADER", 3, 0, 0, 0),
    ("client_transfers", MAR[3], -20015, "FAILED", "OK_COUNT_MISMATCH", 20, 0, 0, 0),
    ("clients", MAR[4], None, "DONE", "LOAD_DONE", 2, 2, 0, 2),
    ("client_transfers", MAR[4], None, "WARNING", "INPUT_VALIDATION_WARNING", 2, 0, 2, 0),
    ("clients", MAR[5], None, "WARNING", "INPUT_VALIDATION_WARNING", 2, 0, 2, 0),
    ("clients", APR[8], -20110, "FAILED", "MISSING_OK_MANUAL", None, 0, 0, 0),
    ("client_transfers", APR[8], -20010, "FAILED", "MISSING_OK_MANUAL", None, 0, 0, 0),
    ("clients", APR[9], None, "WARNING", "INPUT_VALIDATION_WARNING", 10, 2, 8, 2),
    ("clients", APR[10], None, "DONE", "LOAD_DONE", 2, 2, 0, 2),
    ("client_transfers", APR[10], None, "DONE", "LOAD_DONE", 2, 2, 0, 2),
    ("client_transfers", APR[11], -20018, "FAILED", "MISSING_CLIENT_SNAPSHOT", 1, 0, 0, 0),
    ("client_transfers", APR[12], None, "WARNING", "INPUT_VALIDATION_WARNING", 2, 0, 2, 0),
]
