"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words; a document of the source is taken ``target / size of the source`` times, so in
whole copies plus a fractional copy with some probability. Two fractional documents of a source meet: words are moved
between them, in a direction drawn so that neither's expected number of copies changes, until one of the two is whole.
The other meets the next. A block of documents thus ends with one fractional document at most, and the words its
documents take sum to what they should. The leftovers of ``FAN`` blocks form a block of the next level, and so on: a
reduction tree whose root is one document for each source, rounded by a last draw. So the words taken of a source miss
its target by less than the size of one document (times the rows that repeat it).

Blocks have about ``BLOCK`` documents whatever the size of the source, so a source with a third of all rows is spread
over many tasks. Draws depend on the seed, source and block only: reruns agree.

A null text has no words. Sources are ordered by code point, the null source last. Documents without words take no words;
they are copied as often as every document of their source is. Rows that repeat (doc_id, source, size) are one unit: all
are taken equally often. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import staged, text_of

#: Documents in a block of the first level, and blocks that share one of the next.
BLOCK, FAN = 4096, 64
WORD = r"[^\x20\x09-\x0D]+"
#: Ids pass through pandas as strings, where a null does not turn the others into floats.
UNITS = "source string, doc_id string, size long, n long, source_size long, target double, copies long, p double, block long"


def source_targets(units: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """source, units, source_size and target. Works on one row for each source.

    Targets are ``min(most * size, level * weight)``; the level is where they add up to all words.
    """
    sources = units.groupBy("source").agg(F.count("*").alias("units"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    cap = F.col("source_size").cast("double") * most
    ranked = sources.withColumn("weight", weight).withColumn("cap", cap)
    all_rows = Window.partitionBy()
    below = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(below), F.lit(0.0))
    level = ((F.sum("source_size").over(all_rows) - before("cap")) / (F.sum("weight").over(all_rows) - before("weight")))
    reached = ranked.withColumn("level", level)
    # counting sources as full that are not lowers the level, so the greatest that its own source can hold is right
    first = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(all_rows)
    target = F.least(F.col("cap"), F.coalesce(first, F.lit(float("inf"))) * F.col("weight"))
    return reached.withColumn("target", target).select("source", "units", "source_size", "target")


def settle(rows: pd.DataFrame, seed: int, level: int, last: bool) -> pd.DataFrame:
    """Round the fractional copies of one block; at most one row keeps a probability between 0 and 1."""
    rows = rows.sort_values(["doc_id", "size"], na_position="last", ignore_index=True)
    source, block = rows["source"].iloc[0], int(rows["block"].iloc[0])
    draws = np.random.default_rng([seed, level, block, zlib.crc32(repr(source).encode())])
    p, words = rows["p"].to_numpy().copy(), (rows["size"] * rows["n"]).to_numpy().astype(float)
    held = -1
    for j in np.flatnonzero((p > 0) & (p < 1)):
        if held < 0:
            held = j
            continue
        i = held
        up = min((1 - p[i]) * words[i], p[j] * words[j])  # words from j to i
        down = min(p[i] * words[i], (1 - p[j]) * words[j])
        moved = up if draws.random() * (up + down) < down else -down
        a, b = (p[i] * words[i] + moved) / words[i], (p[j] * words[j] - moved) / words[j]
        p[i], p[j] = (round(x) if abs(x - round(x)) < 1e-9 else x for x in (a, b))
        if 0 < p[i] < 1 and 0 < p[j] < 1:  # rounding error: the nearer one is whole
            near = i if abs(p[i] - round(p[i])) <= abs(p[j] - round(p[j])) else j
            p[near] = round(p[near])
        held = i if 0 < p[i] < 1 else j if 0 < p[j] < 1 else -1
    if last and held >= 0:
        p[held] = float(draws.random() < p[held])
    whole = (p <= 0) | (p >= 1)
    rows["copies"] += np.where(whole, p, 0).astype("int64")
    rows["p"] = np.where(whole, 0.0, p)
    rows["block"] = block // FAN
    return rows


def settler(seed: int, level: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda rows: settle(rows, seed, level, last)


def mixture(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: int = 17) -> DataFrame:
    """Units of ``docs`` (doc_id, text, source) with the copies each of their ``n`` rows is taken:
    source, doc_id, size, n, source_size, target, copies."""
    sized = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("string").alias("doc_id"),
                        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"))
    units = staged(sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n")), "mix-units")
    targets = staged(source_targets(units, weights, most), "mix-targets")
    share = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    near = F.when(F.abs(share - F.round(share)) < 1e-12, F.round(share)).otherwise(share)
    blocks = F.ceil(F.col("units") / BLOCK)
    rows = (units.alias("u").join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source")))
            .withColumn("share", near).withColumn("copies", F.floor("share"))
            .withColumn("p", F.when(F.col("size") > 0, F.col("share") - F.col("copies")).otherwise(0.0))
            .withColumn("block", F.pmod(F.xxhash64("doc_id", "size"), blocks))
            .select("u.source", "doc_id", "size", "n", "source_size", "target", "copies", "p", "block"))
    most_blocks = int(targets.agg(F.max(blocks)).first()[0] or 0)
    levels = 1
    while most_blocks > FAN ** (levels - 1):
        levels += 1
    decided = None
    for level in range(levels):
        last = level == levels - 1
        done = staged(rows.groupBy("source", "block").applyInPandas(settler(seed, level, last), UNITS), f"mix-level-{level}")
        whole = done.filter("p = 0")
        decided = whole if decided is None else decided.unionByName(whole)
        rows = done.filter("p > 0")
    return decided.drop("p", "block")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row for each document row: doc_id, size, source_size, target, taken (words taken, repeats counted)."""
    units = mixture(docs, **options)
    return (units.select(F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                         F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_row")).drop("_row"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them."""
    taken = (mixture(docs, **options).filter("copies > 0")
             .select(F.col("source").alias("_s"), F.col("doc_id").alias("_d"), F.col("size").alias("_n"), F.col("copies").alias("_c")))
    size = F.regexp_count(text_of(), F.lit(WORD)).cast("long")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("string").alias("d"), F.col("source").cast("string").alias("s"), size.alias("n"))
    same = F.col("_d").eqNullSafe(F.col("d")) & F.col("_s").eqNullSafe(F.col("s")) & (F.col("_n") == F.col("n"))
    return rows.join(taken, same).select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_c")))).select("row.*")
