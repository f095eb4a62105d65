from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillpoint import schemas  # noqa: E402
from tillpoint.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g", partitions=4)
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def money(v) -> Decimal | None:
    return None if v is None else Decimal(str(v)).quantize(Decimal("0.01"))


@pytest.fixture(scope="session")
def tx(spark):
    def make(rows):
        """rows: (transaction, customer, date text or None, store, product, quantity, price, total)"""
        data = [(a, b, None if c is None else day(c), d, e, q, money(p), money(t)) for a, b, c, d, e, q, p, t in rows]
        return spark.createDataFrame(data, schemas.TRANSACTIONS)
    return make


@pytest.fixture(scope="session")
def loyalty(spark):
    def make(rows):
        """rows: (record, customer, transaction, date, earned, redeemed, balance, tier, rate)"""
        data = [(a, b, c, day(d), e, r, p, t, money(x)) for a, b, c, d, e, r, p, t, x in rows]
        return spark.createDataFrame(data, schemas.LOYALTY)
    return make


@pytest.fixture(scope="session")
def products(spark):
    def make(rows):
        return spark.createDataFrame([(a, b, c, money(p), money(k)) for a, b, c, p, k in rows], schemas.PRODUCTS)
    return make


@pytest.fixture(scope="session")
def customers(spark):
    def make(rows):
        """rows: (customer, enrollment date)"""
        data = [(c, "First", "Last", None, None, None, "Town", "ON", None, day(e), None) for c, e in rows]
        return spark.createDataFrame(data, schemas.CUSTOMERS)
    return make


def by(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="session")
def daily(tx):
    """100 daily lines from 2023-01-01: fifty per customer, quantity 1/2 and total 10/40 in turn, ten products."""
    rows = []
    for i in range(100):
        q, total = ((1, 10), (2, 40))[i % 2]
        when = (day("2023-01-01") + dt.timedelta(days=i)).isoformat()
        rows.append((f"T{i:03d}", "C1" if i < 50 else "C2", when, "S1", f"P{i % 10}", q, total / q, total))
    return tx(rows)
