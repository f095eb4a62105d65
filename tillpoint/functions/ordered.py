"""Running totals, previous values and positions over ordered rows, at any group size.

A plain window sends each group to one task. That is right while groups are moderate and
wrong when one customer holds a third of the facts, or when the "group" is the whole table.
``Ordered`` therefore cuts such groups: their rows are range-partitioned by (keys, order) into
consecutive chunks, each window runs inside its chunk, and what the earlier chunks of the
group carry over is added. Only one row per (key, chunk) takes part in the carry.

A scan over the whole table is always cut. Of a scan by key, only the keys with more than
``GROUP_LIMIT`` rows are; all other keys keep their plain window, untouched by a hot one.

The order columns must tell the rows of a group apart; rows equal in all of them share a chunk.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillpoint.functions.lineage import stage

GROUP_LIMIT = 2_000_000
CHUNK = "_chunk"


def hot_keys(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows; there are at most rows / limit of them."""
    return df.groupBy(*keys).count().filter(F.col("count") > limit).select(*[F.col(k).alias(f"_hot_{k}") for k in keys])


def _chunked(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """``df`` in consecutive chunks of (keys, order), staged so that the chunks stay as they are."""
    chunks = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(chunks, *[F.col(k) for k in keys], *order)
    return stage(ranged.withColumn(CHUNK, F.spark_partition_id()))


class Ordered:
    """Rows in up to two parts: keys with plain windows, and groups cut into chunks."""

    def __init__(self, keys: list[str], order: list, plain: DataFrame | None, cut: DataFrame | None):
        self.keys, self.order, self.plain, self.cut = keys, order, plain, cut

    @classmethod
    def of(cls, df: DataFrame, keys: list[str], order: list, measure: DataFrame | int | None = None,
           limit: int | None = None) -> "Ordered":
        """``measure``: a cheaper frame with the same group sizes, or a number no group is larger than.

        ``order``: ascending columns or expressions.
        """
        limit = GROUP_LIMIT if limit is None else limit
        if not keys:
            return cls(keys, order, None, _chunked(df, keys, order))
        if isinstance(measure, int) and measure <= limit:
            return cls(keys, order, df, None)
        hot = stage(hot_keys(measure if isinstance(measure, DataFrame) else df, keys, limit))
        if hot.isEmpty():
            return cls(keys, order, df, None)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
        return cls(keys, order, df.join(hot, same, "left_anti"), _chunked(df.join(hot, same, "left_semi"), keys, order))

    def map(self, change: Callable[[DataFrame], DataFrame]) -> "Ordered":
        """The same scan with columns added to its rows."""
        parts = [None if part is None else change(part) for part in (self.plain, self.cut)]
        return Ordered(self.keys, self.order, *parts)

    def _windowed(self, plain: Callable[[DataFrame, Window], DataFrame], cut: Callable[[DataFrame, Window], DataFrame]) -> "Ordered":
        by = lambda *more: Window.partitionBy(*self.keys, *more).orderBy(*self.order)
        return Ordered(self.keys, self.order, None if self.plain is None else plain(self.plain, by()),
                       None if self.cut is None else cut(self.cut, by(CHUNK)))

    def _carry(self, df: DataFrame, per_chunk: dict[str, Column], before: dict[str, Column]) -> DataFrame:
        """One row per (key, chunk) with the state that the earlier chunks of the key leave behind."""
        totals = df.groupBy(*self.keys, CHUNK).agg(*[c.alias(n) for n, c in per_chunk.items()])
        return totals.select(*self.keys, CHUNK, *[c.alias(n) for n, c in before.items()])

    def _earlier_chunks(self):
        return Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)

    def _join_carry(self, local: DataFrame, carry: DataFrame) -> DataFrame:
        match = F.lit(True)
        for k in self.keys + [CHUNK]:
            match = match & F.col(f"here.{k}").eqNullSafe(F.col(f"carried.{k}"))
        carried = [c for c in carry.columns if c not in self.keys + [CHUNK]]
        return local.alias("here").join(carry.alias("carried"), match, "left").select(
            "here.*", *[F.col(f"carried.{c}").alias(c) for c in carried])

    def running_sum(self, **sums: Column) -> "Ordered":
        """Total of each expression from the group's first row up to and including the row."""
        def local(df, window):
            frame = window.rowsBetween(Window.unboundedPreceding, 0)
            return df.select("*", *[F.sum(c).over(frame).alias(n) for n, c in sums.items()])

        def across(df, window):
            here, earlier = local(df, window), self._earlier_chunks()
            joined = self._join_carry(here, self._carry(
                df, {f"_chunk_s_{n}": F.sum(c) for n, c in sums.items()},
                {f"_chunk_c_{n}": F.sum(f"_chunk_s_{n}").over(earlier) for n in sums}))
            for n in sums:
                both_null = F.col(n).isNull() & F.col(f"_chunk_c_{n}").isNull()
                total = F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"_chunk_c_{n}"), F.lit(0))
                joined = joined.withColumn(n, F.when(~both_null, total).cast(here.schema[n].dataType)).drop(f"_chunk_c_{n}")
            return joined

        return self._windowed(local, across)

    def running_min(self, **mins: Column) -> "Ordered":
        """Smallest value of each expression from the group's first row up to the row."""
        def local(df, window):
            frame = window.rowsBetween(Window.unboundedPreceding, 0)
            return df.select("*", *[F.min(c).over(frame).alias(n) for n, c in mins.items()])

        def across(df, window):
            earlier = self._earlier_chunks()
            joined = self._join_carry(local(df, window), self._carry(
                df, {f"_chunk_s_{n}": F.min(c) for n, c in mins.items()},
                {f"_chunk_c_{n}": F.min(f"_chunk_s_{n}").over(earlier) for n in mins}))
            for n in mins:
                joined = joined.withColumn(n, F.least(F.col(n), F.col(f"_chunk_c_{n}"))).drop(f"_chunk_c_{n}")
            return joined

        return self._windowed(local, across)

    def previous(self, **values: Column) -> "Ordered":
        """Value of each expression in the row before; null in a group's first row."""
        def local(df, window):
            return df.select("*", *[F.lag(c).over(window).alias(n) for n, c in values.items()])

        def across(df, window):
            by_chunk = Window.partitionBy(*self.keys).orderBy(CHUNK)
            here = local(df, window).withColumn("_chunk_first", F.row_number().over(window) == 1)
            joined = self._join_carry(here, self._carry(
                df, {"_chunk_last": F.max_by(F.struct(*[c.alias(n) for n, c in values.items()]), F.struct(*self.order))},
                {"_chunk_before": F.lag("_chunk_last").over(by_chunk)}))
            for n in values:
                joined = joined.withColumn(n, F.when(F.col("_chunk_first"), F.col(f"_chunk_before.{n}")).otherwise(F.col(n)))
            return joined.drop("_chunk_first", "_chunk_before")

        return self._windowed(local, across)

    def position(self, name: str) -> "Ordered":
        """1, 2, 3, ... in order within the group."""
        return self.running_sum(**{name: F.lit(1).cast("bigint")})

    def result(self) -> DataFrame:
        parts = [x for x in (self.plain, None if self.cut is None else self.cut.drop(CHUNK)) if x is not None]
        return reduce(DataFrame.unionByName, parts)


def ranks(df: DataFrame, key: str, metrics: dict[str, Column], size: int, limit: int | None = None) -> DataFrame:
    """``key`` and, for each metric, the row's position when all ``size`` rows are sorted by it; the key decides ties.

    The metrics (whole numbers or decimals) are ranked in one scan over narrow rows, one for each key and metric.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_metric"), c.cast("decimal(38,6)").alias("_value")) for i, c in enumerate(metrics.values())]))
    long = df.select(key, each.alias("_e")).select(key, "_e.*")
    ranked = Ordered.of(long, ["_metric"], ["_value", key], measure=size, limit=limit).position("_rank").result()
    return ranked.groupBy(key).agg(*[F.max(F.when(F.col("_metric") == i, F.col("_rank"))).alias(n) for i, n in enumerate(metrics)])


def quintile(position: Column, size) -> Column:
    """Bucket 1..5 of a 1-based rank by linear quantile cuts, as ``qcut`` does over first-ranks."""
    n = F.lit(size).cast("bigint") if isinstance(size, int) else size
    steps = F.greatest(n - 1, F.lit(1))
    cut = _whole(5 * (position - 1) + steps - 1, steps)
    return F.greatest(cut, F.lit(1)).cast("int")


def ntile(position: Column, size, tiles: int = 5) -> Column:
    """SQL ``NTILE`` from a 1-based rank: the first ``size % tiles`` tiles hold one row more."""
    n = F.lit(size).cast("bigint") if isinstance(size, int) else size
    small = _whole(n, F.lit(tiles))
    longer = n % tiles
    in_longer = longer * (small + 1)
    first = _whole(position - 1, small + 1) + 1
    rest = longer + _whole(position - in_longer - 1, F.greatest(small, F.lit(1))) + 1
    return F.when(position <= in_longer, first).otherwise(rest).cast("int")


def _whole(a: Column, b: Column) -> Column:
    """Integer division of non-negative whole numbers, without going through doubles."""
    return F.call_function("div", a.cast("bigint"), b.cast("bigint"))
