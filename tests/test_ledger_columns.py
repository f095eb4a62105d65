"""The streaming ledger books whole buckets as columns: the same records as line by line."""

import random
from decimal import ROUND_HALF_EVEN, Decimal

import numpy as np
import pandas as pd
import pytest

from tillpoint.schemas import TIERS
from tillpoint.streaming import ledger

UNIT = ledger.MILLIONTHS


def line_by_line(lines, state):
    """(customer, date, transaction, millionths, redeemed) one after the other, in decimals."""
    tiers = [(Decimal(least), name, Decimal(rate)) for name, least, rate, _ in reversed(TIERS)]
    out = []
    for who, day, transaction, millionths, redeemed in sorted(lines, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2])):
        balance, spend, records = state.get(who, (0, 0, 0))
        spend += millionths
        name, rate = next(((n, p) for least, n, p in tiers if spend >= int(least) * UNIT), tiers[-1][1:])
        exact = (Decimal(millionths) / UNIT * rate).quantize(Decimal(1), ROUND_HALF_EVEN)
        balance, records = max(0, balance + int(exact) - redeemed), records + 1
        state[who] = (balance, spend, records)
        out.append((who, transaction, records, int(exact), redeemed, balance, name, spend))
    return out


@pytest.mark.parametrize("largest", [3_000 * UNIT, 10 ** 20])
def test_a_bucket_of_many_customers_equals_line_by_line(largest):
    pick = random.Random(largest % 97)
    booking, state, accounts = ledger.Ledger(["TransactionDate", "TransactionID"]), {}, {}
    for batch in range(3):
        lines = [(pick.choice([None, 1, 2, 3, 2 ** 60 + 1]), pick.choice([None, *range(-3, 30)]), i + 1000 * batch, pick.choice(
            [pick.randrange(-largest // 50, largest), pick.randrange(1, 900) * UNIT + UNIT // 2, 0]), pick.choice([0, 500])) for i in range(200)]
        frame = pd.DataFrame({
            "nulls": np.array([(r[0] is None) + 4 * (r[1] is None) for r in lines], dtype="int64"),
            "c0": np.array([r[0] or 0 for r in lines], dtype="int64"), "c1": np.array([r[2] for r in lines], dtype="int64"),
            "c2": np.array([r[1] or 0 for r in lines], dtype="int64"), "low": np.array([r[3] % ledger.HIGH for r in lines], dtype="int64"),
            "high": np.array([r[3] // ledger.HIGH for r in lines], dtype="int64"), "redeemed": np.array([r[4] for r in lines], dtype="int64")})
        got = booking.book(frame, accounts)
        rows = [(None if r.nulls & 1 else r.c0, r.c1, r.LoyaltyRecordID, r.PointsEarned, r.PointsRedeemed, r.PointsBalance, TIERS[r.tier][0],
                 r.high * ledger.HIGH + r.low) for r in got.itertuples()]
        assert rows == line_by_line(lines, state)
    assert accounts == state


def test_halves_go_to_the_even_number():
    got = ledger.half_even(np.array([5, 15, 25, -5, -15, 14, 16, -26]), 10)
    assert got.tolist() == [0, 2, 2, 0, -2, 1, 2, -3]
