"""Inline raw-transaction fixtures (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt
import itertools

from ratelens import contracts as C

START = dt.datetime(2026, 1, 5)
FIELDS = [f.name for f in C.RAW_TRANSACTION.fields]


def row(i, week=1, country="BR", issuer="Itau", brand="Visa", ctype="Credit", amount=100.0, status="approved",
        reason=None, customer=None, recurring=False, hour=12, ts=None, currency="BRL", null_ts=False):
    if ts is None and week is not None and not null_ts:
        ts = START + dt.timedelta(weeks=week - 1, hours=hour if hour is not None else 0, seconds=i)
    if status == "declined" and reason is None:
        reason = "do_not_honor"
    return {
        "transaction_id": f"t{i:06d}", "timestamp": ts, "week_number": week, "country": country,
        "currency": currency, "amount": amount / 0.2 if amount is not None else None, "amount_usd": amount,
        "card_brand": brand, "card_type": ctype, "issuer_bank": issuer, "status": status,
        "decline_reason": reason if status != "approved" else None, "merchant_id": "m_1",
        "customer_id": customer if customer is not None else f"c_{i % 7}", "is_recurring": recurring,
        "hour_of_day": hour,
    }


def to_df(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], C.RAW_TRANSACTION)


def planted(n_per_week: int = 100):
    """BBVA Mexico collapses 0.82 -> 0.38 in weeks 4-6; everything else flat ~0.80."""
    rows, i = [], 0
    others = [("BR", "Itau"), ("BR", "Nubank"), ("MX", "Banorte"), ("CO", "Bancolombia")]
    brands = ["Visa", "Mastercard"]
    for week in range(1, 7):
        ok = 82 if week <= 3 else 38
        for j in range(n_per_week):
            rows.append(row(i, week, "MX", "BBVA", brands[j % 2], "Credit" if j % 3 else "Debit",
                            amount=50.0 + (j % 40) * 10, status="approved" if j < ok * n_per_week // 100 else "declined",
                            hour=(j * 5) % 24, customer=f"c_{j % 50}"))
            i += 1
        for (country, issuer), j in itertools.product(others, range(n_per_week)):
            rows.append(row(i, week, country, issuer, brands[j % 2], "Credit" if j % 3 else "Debit",
                            amount=20.0 + (j % 45) * 10, status="approved" if j % 5 else "declined",
                            hour=(j * 7) % 24, customer=f"c_{j % 60}"))
            i += 1
    return rows


def same_schema(schema, contract) -> bool:
    """Names and types in order (nullability is not part of the contracts)."""
    return [(f.name, f.dataType) for f in schema.fields] == [(f.name, f.dataType) for f in contract.fields]
