"""The points ledger over arriving sales: running spend, balance and number of records per customer in the state store.

Each batch's lines of a customer are taken in ``order``; batches are taken as they arrive, so the records equal those of
``loyalty.build_points_ledger`` when files come in the order of their dates. A line that comes later than a
newer one is booked where it arrives: records written are never changed.

Customers share ``BUCKETS`` buckets by hash. A task books one bucket's lines of one batch at once, as columns of whole numbers (an
amount in millionths, a date in days); ``maxFilesPerTrigger`` bounds a batch. State is a row for each bucket with the accounts
of its customers, in RocksDB, and survives restarts through the query's checkpoint. Sums beyond 64 bits are added as Python's numbers.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tillpoint.schemas import TIERS

AMOUNT = T.DecimalType(28, 6)
STATE = T.StructType([T.StructField("Accounts", T.BinaryType())])
#: Part of a stream's checkpoint: it stays as it is while the stream goes on.
BUCKETS = 4096
MILLIONTHS, HUNDREDTHS = 10 ** 6, 100
HIGH = 10 ** 18
#: Whole numbers up to here are added in 64 bits.
SAFE = 2 ** 62
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def record_schema(sales: DataFrame) -> T.StructType:
    kept = {f.name: f.dataType for f in sales.schema.fields}
    return T.StructType([
        T.StructField("LoyaltyRecordID", T.LongType()), T.StructField("CustomerID", kept["CustomerID"]),
        T.StructField("TransactionID", kept["TransactionID"]), T.StructField("TransactionDate", kept["TransactionDate"]),
        T.StructField("PointsEarned", T.LongType()), T.StructField("PointsRedeemed", T.LongType()), T.StructField("PointsBalance", T.LongType()),
        T.StructField("Tier", T.StringType()), T.StructField("PointsPerDollar", T.DecimalType(5, 2)), T.StructField("CumulativeSpend", AMOUNT)])


def _sent(kind: T.DataType, c: Column) -> Column:
    """A column as Python takes it fast and exactly: whole numbers and texts, in the same order. Others stay as they are."""
    if isinstance(kind, T.DateType):
        return F.coalesce(F.unix_date(c).cast("bigint"), F.lit(0).cast("bigint"))
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return F.coalesce((c.cast(T.DecimalType(18, kind.scale)) * F.lit(10 ** kind.scale).cast(T.DecimalType(19, 0))).cast("bigint"), F.lit(0).cast("bigint"))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
    if isinstance(kind, T.StringType):
        return F.coalesce(c, F.lit(""))
    return c


def _as_sent(kind: T.DataType) -> T.DataType:
    return T.LongType() if isinstance(kind, (T.DateType, T.ByteType, T.ShortType, T.IntegerType)) or isinstance(kind, T.DecimalType) and kind.precision <= 18 else kind


def _received(kind: T.DataType, c: Column) -> Column:
    """The column that ``_sent`` made whole numbers of."""
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(c.cast("int"))
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (c.cast(T.DecimalType(19, 0)) * F.lit(Decimal(1).scaleb(-kind.scale)).cast(T.DecimalType(18, kind.scale))).cast(kind)
    return c.cast(kind)


def _whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``high * HIGH + low``, as Python's numbers where 64 bits could be too few."""
    return low.astype(object) + high.astype(object) * HIGH if high.any() else low


def _small(*sums: np.ndarray) -> bool:
    """Whether all these and their sums stay within 64 bits."""
    return all(x.dtype != object for x in sums) and sum(float(np.abs(x.astype("float64")).sum()) for x in sums) < SAFE


def half_even(amounts: np.ndarray, unit: int) -> np.ndarray:
    """``amounts / unit`` to the next whole number, halves to the even one."""
    whole, rest = amounts // unit, amounts % unit
    return whole + ((2 * rest > unit) | ((2 * rest == unit) & (whole % 2 == 1)))


class Ledger(StatefulProcessor):
    """Books a bucket's lines, each customer's one after the other."""

    def __init__(self, order: list[str], tiers=TIERS, columns: list[str] | None = None):
        #: names in ``columns`` are sent as ``c0``, ``c1``, ...; bit i of ``nulls`` marks a missing value of the i-th
        self.columns = list(dict.fromkeys(["CustomerID", "TransactionID", "TransactionDate", *order])) if columns is None else columns
        self.order = order
        self.least = np.array([int(Decimal(str(least)) * MILLIONTHS) for _, least, _, _ in tiers], dtype="int64")
        self.rates = np.array([int(Decimal(str(rate)) * HUNDREDTHS) for _, _, rate, _ in tiers], dtype="int64")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("accounts", STATE)

    def _codes(self, lines: pd.DataFrame, name: str) -> np.ndarray:
        """Numbers in the order of a column's values, missing ones first."""
        i = self.columns.index(name)
        values = lines[f"c{i}"]
        missing = (lines["nulls"].to_numpy() >> i & 1).astype(bool)
        if values.dtype.kind not in "iu" or missing.any():
            codes = pd.factorize(values.where(~missing, None) if values.dtype.kind not in "iu" else values, sort=True)[0].astype("int64")
            return np.where(missing, -1, codes)
        return values.to_numpy()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        lines = pd.concat(list(rows), ignore_index=True)
        accounts = pickle.loads(bytes(self.state.get()[0])) if self.state.exists() else {}
        yield self.book(lines, accounts)
        self.state.update((pickle.dumps(accounts),))

    def book(self, lines: pd.DataFrame, accounts: dict) -> pd.DataFrame:
        """The records of the lines; ``accounts`` (customer: balance, spend in millionths, records) go on."""
        owner = self._codes(lines, "CustomerID")
        place = np.lexsort([*[self._codes(lines, c) for c in reversed(self.order)], owner])
        lines, owner = lines.iloc[place], owner[place]
        n = len(lines)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sizes = np.diff(np.r_[first, n])
        group = np.repeat(np.arange(len(first)), sizes)
        missing = (lines["nulls"].to_numpy()[first] & 1).astype(bool)
        who = [None if m else v for v, m in zip(lines["c0"].iloc[first].tolist(), missing)]
        held = [accounts.get(w, (0, 0, 0)) for w in who]
        balance, records = (np.array([h[i] for h in held], dtype="int64") for i in (0, 2))
        spent = np.array([h[1] for h in held], dtype=object)
        amount, redeemed = _whole(lines["low"].to_numpy(), lines["high"].to_numpy()), lines["redeemed"].to_numpy().astype("int64")
        if all(abs(s) < SAFE for s in spent) and _small(amount.astype(object) if amount.dtype == object else amount * 1, spent.astype("int64")) and _small(amount) and float(np.abs(amount).max()) * float(self.rates.max()) < SAFE:
            spent = spent.astype("int64")
        else:
            amount = amount.astype(object)

        def running(values: np.ndarray, start: np.ndarray) -> np.ndarray:
            upto = np.cumsum(values)
            before = upto[first] - values[first]
            return upto - before[group] + start[group]

        spend = running(amount, spent)
        tier = np.maximum(np.searchsorted(self.least, spend.astype("float64") if spend.dtype == object else spend, side="right") - 1, 0)
        if spend.dtype == object:
            tier = np.array([max(0, sum(s >= int(x) for x in self.least) - 1) for s in spend])
        earned = half_even(amount * (self.rates[tier].astype(object) if amount.dtype == object else self.rates[tier]), MILLIONTHS * HUNDREDTHS).astype("int64")
        total = running(earned - redeemed, balance)
        reach = int(total.max()) - int(total.min()) + 1
        if reach * (len(first) + 1) < SAFE:
            lowest = np.minimum.accumulate(total - group * reach) + group * reach
        else:
            lowest = np.concatenate([np.minimum.accumulate(total[a:a + k]) for a, k in zip(first, sizes)])
        after = total - np.minimum(lowest, 0)
        number = np.arange(n) - np.repeat(first, sizes) + 1 + records[group]
        last = first + sizes - 1
        accounts.update(zip(who, zip(after[last].tolist(), [int(x) for x in spend[last]], number[last].tolist())))
        high = np.array([x // HIGH for x in spend], dtype="int64") if spend.dtype == object else np.zeros(n, dtype="int64")
        low = np.array([x % HIGH for x in spend], dtype="int64") if spend.dtype == object else spend
        return pd.DataFrame({"nulls": lines["nulls"].to_numpy(), "c0": lines["c0"].to_numpy(), "c1": lines["c1"].to_numpy(), "c2": lines["c2"].to_numpy(),
                             "LoyaltyRecordID": number, "PointsEarned": earned, "PointsRedeemed": redeemed, "PointsBalance": after,
                             "tier": tier.astype("int64"), "low": low, "high": high})

    def close(self) -> None:
        pass


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def stream_points_ledger(sales: DataFrame, order: list[str], redeemed: Column, spend: Column | None = None, tiers=TIERS) -> DataFrame:
    """One record for each line of the stream, numbered per customer. Lines without an amount count as 0, lines without a customer as those of one."""
    amount = F.coalesce(F.col("LineTotal") if spend is None else spend, F.lit(0)).cast(AMOUNT)
    millionths = (amount * F.lit(MILLIONTHS).cast(T.DecimalType(7, 0))).cast(T.DecimalType(34, 0))
    high = F.lit(HIGH).cast(T.DecimalType(19, 0))
    booking = Ledger(order, tiers)
    kinds = [sales.schema[c].dataType for c in booking.columns]
    lines = sales.select(
        F.pmod(F.xxhash64("CustomerID"), F.lit(BUCKETS)).alias("bucket"),
        sum((F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(booking.columns)), F.lit(0).cast("bigint")).alias("nulls"),
        *[_sent(k, F.col(c)).alias(f"c{i}") for i, (c, k) in enumerate(zip(booking.columns, kinds))],
        (millionths % high).cast("bigint").alias("low"), F.call_function("div", millionths, high).cast("bigint").alias("high"),
        F.coalesce(redeemed, F.lit(0)).cast("bigint").alias("redeemed"))
    whole = ("LoyaltyRecordID", "PointsEarned", "PointsRedeemed", "PointsBalance", "tier", "low", "high")
    out = T.StructType([T.StructField("nulls", T.LongType()), *[T.StructField(f"c{i}", _as_sent(kinds[i])) for i in range(3)],
                        *[T.StructField(c, T.LongType()) for c in whole]])
    booked = lines.groupBy("bucket").transformWithStateInPandas(booking, out, "Append", "None")
    spent = (F.col("high").cast(T.DecimalType(19, 0)) * high + F.col("low").cast(T.DecimalType(19, 0))) * F.lit(Decimal("0.000001")).cast(T.DecimalType(6, 6))
    own = {c: F.when(F.col("nulls").bitwiseAND(F.lit(1 << i).cast("bigint")) == 0, _received(kinds[i], F.col(f"c{i}"))) for i, c in enumerate(booking.columns[:3])}
    by_tier = {"Tier": F.array(*[F.lit(n) for n, *_ in tiers]), "PointsPerDollar": F.array(*[F.lit(Decimal(str(r))).cast(T.DecimalType(5, 2)) for _, _, r, _ in tiers])}
    made = {c: F.col(c) for c in whole[:4]} | own | {c: a[F.col("tier").cast("int")] for c, a in by_tier.items()} | {"CumulativeSpend": spent.cast(AMOUNT)}
    return booked.select(*[made[f.name].cast(f.dataType).alias(f.name) for f in record_schema(sales).fields])


def start_points_ledger(sales: DataFrame, path: str, checkpoint: str, order: list[str], redeemed: Column, spend: Column | None = None,
                        tiers=TIERS) -> StreamingQuery:
    """Book what has arrived by now and append the records to Parquet at ``path``; started again, it goes on from the checkpoint."""
    with rocksdb(sales.sparkSession):
        return (stream_points_ledger(sales, order, redeemed, spend, tiers).writeStream.format("parquet").option("path", path)
                .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
