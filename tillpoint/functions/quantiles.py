"""Exact quantiles with linear interpolation, per group and column, at any group size.

A mergeable sketch brackets the wanted rank of every group and column. A second pass counts the values below each bracket, and
a third counts the few values inside it one by one, a frequent value as one row; the two neighbours of the wanted rank are
picked from these. So nothing but sketches, counts and the values within the brackets is shuffled. Where a count shows
that a bracket missed its rank, the brackets are opened to all values, which is exact whatever the sketch did.

Every group of the table comes back, also one whose values are all missing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillpoint.functions.lineage import staged_table
from tillpoint.functions.ordered import Ordered
from tillpoint.functions.stats import count_if, number

#: Accuracy of the sketch; a bracket reaches two of its errors to either side.
ACCURACY = 1000
INFINITY = float("inf")


def _finite(c: Column) -> Column:
    """NaN and infinities count as missing."""
    d = number(c)
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(INFINITY)), d)


def _same(groups: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}")) for g in groups])


def brackets(narrow: DataFrame, groups: list[str], columns: list[str], probability: float) -> DataFrame:
    """For each group an array of two values for every column, around the wanted rank."""
    reach = 2.0 / ACCURACY
    ends = F.array(F.lit(max(0.0, probability - reach)), F.lit(min(1.0, probability + reach)))
    sketches = [F.percentile_approx(F.col(c), ends, ACCURACY).alias(f"_e{i}") for i, c in enumerate(columns)]
    return narrow.groupBy(*groups).agg(*sketches) if groups else narrow.agg(*sketches)


def _with_brackets(narrow: DataFrame, found: DataFrame, groups: list[str], count: int) -> DataFrame:
    if groups:
        return narrow.alias("n").join(found.alias("b"), _same(groups, "n", "b")).select("n.*", *[F.col(f"b._e{i}") for i in range(count)])
    row = found.first()
    ends = [F.lit(None).cast("array<double>") if e is None else F.array(*[F.lit(float(x)) for x in e]) for e in row]
    return narrow.select("*", *[e.alias(f"_e{i}") for i, e in enumerate(ends)])


def _counted(placed: DataFrame, groups: list[str], columns: list[str], at) -> DataFrame:
    """(group, _i, _below, _rows, _at, _off): values below the bracket and in all, the wanted rank, and whether the bracket misses it."""
    sums = []
    for i, c in enumerate(columns):
        low, high = F.col(f"_e{i}")[0], F.col(f"_e{i}")[1]
        sums += [count_if(F.col(c) < low).alias(f"_l{i}"), count_if(F.col(c).between(low, high)).alias(f"_m{i}"), F.count(c).alias(f"_r{i}")]
    wide = placed.groupBy(*groups).agg(*sums) if groups else placed.agg(*sums)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(f"_l{i}").alias("_below"), F.col(f"_m{i}").alias("_inside"), F.col(f"_r{i}").alias("_rows"))
                               for i in range(len(columns))])).alias("e")
    long = wide.select(*groups, each).select(*groups, "e.*").withColumn("_at", at(F.col("_rows")))
    off = (F.col("_rows") > 0) & ((F.floor("_at") < F.col("_below")) | (F.ceil("_at") >= F.col("_below") + F.col("_inside")))
    return long.withColumn("_off", off)


def quantiles(df: DataFrame, groups: list[str], columns: list[str], probability: float = 0.5,
              limit: int | None = None) -> DataFrame:
    """One row per group, one quantile per column, under the column's own name."""
    narrow = df.select(*groups, *[_finite(F.col(c)).alias(c) for c in columns])
    count = len(columns)

    def at(rows: Column) -> Column:
        return (rows - 1) * F.lit(float(probability))

    found = staged_table(brackets(narrow, groups, columns, probability), "brackets")
    placed = _with_brackets(narrow, found, groups, count)
    counts = staged_table(_counted(placed, groups, columns, at), "bracket-counts")
    told = counts.agg(F.max("_off").alias("off"), F.max("_inside").alias("most")).first()
    if told["off"]:
        wide = F.array(F.lit(-INFINITY), F.lit(INFINITY))
        placed = narrow.select("*", *[wide.alias(f"_e{i}") for i in range(count)])
        counts = staged_table(_counted(placed, groups, columns, at), "bracket-counts")
        told = counts.agg(F.max("_inside").alias("most")).first()

    inside = F.array_compact(F.array(*[
        F.when(F.col(c).between(F.col(f"_e{i}")[0], F.col(f"_e{i}")[1]), F.struct(F.lit(i).alias("_i"), F.col(c).alias("_value")))
        for i, c in enumerate(columns)]))
    values = placed.select(*groups, F.explode(inside).alias("e")).select(*groups, "e.*")
    keys = [*groups, "_i"]
    tally = values.groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_n"))
    walked = Ordered.of(tally, keys, ["_value"], measure=told["most"] or 0, limit=limit).running_sum(_upto=F.col("_n")).result()
    ranked = walked.alias("w").join(counts.alias("c"), _same(keys, "w", "c")).select("w.*", "_below", "_at")

    def value_at(rank: Column) -> Column:
        upto = F.col("_below") + F.col("_upto")
        return F.max(F.when((upto - F.col("_n") <= rank) & (rank < upto), F.col("_value")))

    ends = ranked.groupBy(*keys).agg(value_at(F.floor("_at")).alias("_low"), value_at(F.ceil("_at")).alias("_high"), F.max("_at").alias("_at"))
    part = F.col("_at") - F.floor("_at")
    picked = ends.withColumn("_q", F.col("_low") + (F.col("_high") - F.col("_low")) * part)
    wide = [F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(c) for i, c in enumerate(columns)]
    if not groups:
        return picked.agg(*wide)
    have = picked.groupBy(*groups).agg(*wide)
    return found.alias("g").join(have.alias("f"), _same(groups, "g", "f"), "left").select(
        *[F.col(f"g.{g}") for g in groups], *[F.col(f"f.{c}") for c in columns])
