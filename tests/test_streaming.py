from __future__ import annotations

import datetime as dt
import random
import time
from decimal import Decimal

import pytest
from conftest import day
from pyspark.sql import functions as F

from tillpoint.operators import loyalty as loy
from tillpoint.streaming import ledger, windows

ORDER = ["TransactionDate", "TransactionID", "ProductID"]


def sales(n=120, customers=5):
    pick = random.Random(3)
    return [(f"T{i:03d}", None if i % 31 == 0 else f"C{pick.randrange(customers)}", (day("2023-01-01") + dt.timedelta(days=i)).isoformat(), "S1", f"P{i % 4}",
             1, pick.randint(1, 900) * 10, pick.randint(1, 900) * 10) for i in range(n)]


def arrive(tx, rows, folder):
    """One more file."""
    tx(rows).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)  # files are taken by their age


def stream(spark, tx, folder, files=1):
    return spark.readStream.schema(tx(sales(1)).schema).option("maxFilesPerTrigger", files).parquet(folder)


def rows_of(df):
    return sorted((tuple(str(r[c]) if not isinstance(r[c], Decimal) else str(r[c].normalize()) for c in (
        "LoyaltyRecordID", "CustomerID", "TransactionID", "PointsEarned", "PointsRedeemed", "PointsBalance", "Tier", "PointsPerDollar", "CumulativeSpend")))
        for r in df.collect())


def test_ledger_of_arriving_files_equals_the_batch_one_across_a_restart(spark, tx, tmp_path):
    rows, folder, out, checkpoint = sales(), *(str(tmp_path / x) for x in ("in", "out", "state"))
    redeemed = F.when(F.substring("TransactionID", 4, 1) == "7", 300).otherwise(0)
    for at in (0, 30):
        arrive(tx, rows[at:at + 30], folder)
    query = ledger.start_points_ledger(stream(spark, tx, folder), out, checkpoint, ORDER, redeemed)
    assert query.awaitTermination(120) and len(spark.read.parquet(out).collect()) == 60
    for at in (60, 90):
        arrive(tx, rows[at:at + 30], folder)
    query = ledger.start_points_ledger(stream(spark, tx, folder), out, checkpoint, ORDER, redeemed)
    assert query.awaitTermination(120)
    want = loy.build_points_ledger(tx(rows), ORDER, redeemed, record_ids=False)
    assert rows_of(spark.read.parquet(out)) == rows_of(want)
    assert {r["Tier"] for r in want.collect()} >= {"Bronze", "Silver", "Gold"}


def test_a_late_line_is_booked_where_it_arrives(spark, tx, tmp_path):
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "state"))
    arrive(tx, [("T2", "C1", "2023-02-01", "S1", "P1", 1, 50, 50)], folder)
    arrive(tx, [("T1", "C1", "2023-01-01", "S1", "P1", 1, 10, 10), ("T3", "C1", "2023-01-02", "S1", "P1", 1, 5, None)], folder)
    assert ledger.start_points_ledger(stream(spark, tx, folder), out, checkpoint, ORDER, F.lit(0)).awaitTermination(120)
    got = {r["TransactionID"]: (r["LoyaltyRecordID"], r["PointsBalance"]) for r in spark.read.parquet(out).collect()}
    assert got == {"T2": (1, 50), "T1": (2, 60), "T3": (3, 60)}


@pytest.mark.parametrize("length, slide", [(30, 30), (60, 20)])
def test_closed_windows_equal_the_batch_ones(spark, tx, tmp_path, length, slide):
    rows, folder, out = sales(), str(tmp_path / "in"), str(tmp_path / "out")
    shuffled = sorted(rows[:60], key=lambda r: (int(r[0][1:]) // 3, r[4]))  # a little out of order
    for part in (shuffled, rows[60:90], rows[90:]):
        arrive(tx, part, folder)
    query = windows.start_sliding_sales(stream(spark, tx, folder), out, str(tmp_path / "state"), length, slide)
    assert query.awaitTermination(120) and windows.dropped(query) == 0
    closed = day(rows[-1][2]) - dt.timedelta(days=7)
    want = windows.sliding_sales(tx(rows), length, slide).filter(F.col("WindowEnd") <= F.lit(closed))
    assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(map(str, want.collect())) != []


def test_sales_beyond_the_watermark_are_dropped_and_counted(spark, tx, tmp_path):
    rows, folder, out = sales(90), str(tmp_path / "in"), str(tmp_path / "out")
    arrive(tx, rows[:45], folder)
    arrive(tx, rows[45:], folder)
    late = [("L1", "C1", "2023-01-05", "S1", "P1", 1, 5, 5), ("L2", "C2", "2023-01-06", "S1", "P1", 1, 5, 5), ("L3", "C1", rows[-1][2], "S1", "P1", 1, 7, 7)]
    arrive(tx, late, folder)
    query = windows.start_sliding_sales(stream(spark, tx, folder), out, str(tmp_path / "state"))
    assert query.awaitTermination(120) and windows.dropped(query) == 2
    closed = day(rows[-1][2]) - dt.timedelta(days=7)
    want = windows.sliding_sales(tx(rows)).filter(F.col("WindowEnd") <= F.lit(closed))
    assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(map(str, want.collect()))
