"""Removal of repeated passages by content-defined chunks of lines, in DataFrame operations only.

Every line is hashed once. A rolling hash over the hashes of ``least`` lines that are not blank (and of the blank ones between
them) decides where a chunk begins: where it is divisible by ``modulus``. A chunk goes on to the last line but one of the
rolling window that begins the next chunk, or to the last line of the text that is not blank; so it has ``least`` such lines
or more, and neighbouring chunks overlap. What begins a chunk lies within it, so an insertion shifts nothing further on.

With ``modulus`` 1, the default, every window of ``least`` lines is a chunk, and every passage of so many lines is found wherever it
stands. Anything sparser misses short passages by its nature: a passage of two lines between foreign lines can be found
only if these two lines alone make a chunk, and a rule that makes chunks of one pair in ``modulus`` finds one such passage in
``modulus``. A larger ``modulus`` shuffles fewer keys and suits corpora of long passages.

A chunk is removed wherever it stands a second time, in any document; its first occurrence, by ``doc_id`` and then by line, stays.
A line goes when any chunk it is in stands earlier, so every line that goes equals one that stays. Hashes of chunks
are counted first, without texts. The texts of those that occur again are then compared whole; where two texts share a
hash, their chunks are told apart by text, so nothing is removed because of a hash alone.

Blank lines don't make a passage; those within one must be the same and go with it. A null text counts as empty. Texts without a repeated
chunk come back as they were; a text of repeated chunks only becomes empty. Rows without an id neither lose nor lend chunks.
Rows that repeat an id lend nothing to each other at the same line. All columns of ``docs`` come back, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import salted_join, staged, text_of

#: One rolling hash in so many begins a chunk.
MODULUS = 1
#: A passage has this many lines that are not blank, or more.
LEAST = 2
#: A line that is not blank.
SOLID = r"[^\x20\x09\x0B-\x0D]"
#: A row of the documents: the id, and a hash of the text to tell apart rows that repeat an id.
ROW = ["_id", "_print"]


def with_chunks(rows: DataFrame, least: int, modulus: int, digest: Callable[[Column], Column]) -> DataFrame:
    """``rows`` with ``_chunks``: first and last line, from 0, and hash of each chunk of ``_text``.

    Columns that a lambda reads are named twice in its expression, else Spark would inline them and make them anew for each element.
    """
    lines = rows.withColumn("_lines", F.split("_text", "\n"))
    hashed = lines.withColumn("_hashes", F.transform("_lines", lambda x: F.xxhash64(x))).withColumn(
        "_solid", F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: F.get("_lines", i).rlike(SOLID)))

    def rolled(start: Column, end: Column) -> Column:
        return digest(F.slice(F.col("_hashes"), start + 1, end - start + 1))

    last = F.size("_solid") - least
    begins = F.when(last >= 0, F.sequence(F.lit(0), last))
    if modulus > 1:
        begins = F.when(F.size("_hashes") >= least, F.filter(
            begins, lambda k: F.pmod(rolled(F.get("_solid", k), F.get("_solid", k + (least - 1))), F.lit(modulus)) == 0))
    ends = F.transform("_begins", lambda k, j: F.struct(
        F.get("_solid", k).alias("s"), F.get("_solid", F.coalesce(F.get("_begins", j + 1) + (least - 2), F.size("_solid") - 1)).alias("e")))
    keyed = F.when(F.size("_hashes") >= least, F.transform(
        "_ends", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), rolled(x["s"], x["e"]).alias("key"))))
    return hashed.withColumn("_begins", begins).withColumn("_ends", ends).withColumn("_chunks", keyed)


def place(line: Column) -> Column:
    return F.col("_id").cast("decimal(38,0)") * 2147483648 + line


def repeated(rows: DataFrame, least: int, modulus: int, salts: int, digest: Callable[[Column], Column]) -> DataFrame:
    """Chunks whose hash occurs again, by row: ``_asked`` with first and last line, hash, and whether the hash stands earlier.

    The outer form of explode keeps Spark from inferring a filter, which it would push down by hashing all lines again for each.
    """
    found = with_chunks(rows.filter("_id IS NOT NULL"), least, modulus, digest).select(*ROW, F.explode_outer("_chunks").alias("_chunk"))
    chunks = staged(found.filter("_chunk IS NOT NULL").select(*ROW, "_chunk.*"), "line-chunks")
    first = staged(chunks.groupBy("key").agg(F.min(place(F.col("s"))).alias("_first"), F.count("*").alias("_n"))
                   .filter("_n > 1").drop("_n"), "repeated-chunks")
    later = (place(F.col("s")) > F.col("_first")).alias("later")
    return (salted_join(chunks, first, ["key"], "_id", salts).select(*ROW, F.struct("s", "e", "key", later).alias("_one"))
            .groupBy(*ROW).agg(F.collect_set("_one").alias("_asked")))


def told_apart(asked: DataFrame) -> DataFrame:
    """``asked``, rows with ``_text`` and ``_asked``, with ``later`` decided by whole texts where texts share a hash."""
    lines = asked.withColumn("_lines", F.split("_text", "\n"))
    text = F.when(F.size("_lines") > 0, F.transform("_asked", lambda x: F.struct(
        x.alias("_one"), F.array_join(F.slice(F.col("_lines"), x["s"] + 1, x["e"] - x["s"] + 1), "\n").alias("_piece"))))
    pieces = lines.filter("_asked IS NOT NULL").select(*ROW, F.explode_outer(text).alias("_of")).select(
        *ROW, "_of.*", F.col("_of._one.key").alias("key"))
    texts = pieces.groupBy("key", "_piece").agg(F.count("*").alias("_n"))
    clashes = staged(texts.groupBy("key").agg(F.count("*").alias("_texts")).filter("_texts > 1").select("key"), "chunk-clashes")
    if clashes.isEmpty():
        return asked
    at = place(F.col("_one.s"))
    first = pieces.join(clashes, "key").groupBy("key", "_piece").agg(F.min(at).alias("_first"))
    apart = pieces.join(first, ["key", "_piece"], "left").withColumn(
        "_one", F.col("_one").withField("later", F.when(F.col("_first").isNull(), F.col("_one.later")).otherwise(at > F.col("_first"))))
    return asked.drop("_asked").join(apart.groupBy(*ROW).agg(F.collect_set("_one").alias("_asked")), ROW, "left")


def line_dedup(docs: DataFrame, least: int = LEAST, modulus: int = MODULUS, salts: int = 8,
               digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``docs`` without the passages that stand earlier, and ``removed_lines``, how many lines went from each text.

    ``digest`` hashes the line hashes of a chunk. Texts move once, to the chunks asked of them, and stay staged with these.
    """
    others = F.struct(*(F.col(c) for c in docs.columns if c != "text"))
    own = docs.select(others.alias("_row"), F.col("doc_id").cast("long").alias("_id"), text_of().alias("_text"))
    own = own.withColumn("_print", F.xxhash64("_text"))
    asked = repeated(own.select(*ROW, "_text"), least, modulus, salts, digest)
    # both sides grow with the documents: one plan at every size
    both = told_apart(staged(own.join(asked.hint("merge"), ROW, "left"), "chunks-asked")).withColumn("_lines", F.split("_text", "\n"))
    gone = F.flatten(F.transform(F.filter("_asked", lambda x: x["later"]), lambda x: F.sequence(x["s"], x["e"])))
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    cut = both.withColumn("_left", F.when(F.col("_asked").isNotNull(), F.array_except(places, gone)))
    new = F.when(F.col("_left").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform("_left", lambda i: F.get("_lines", i)), "\n"))
    count = F.when(F.col("_left").isNull(), F.lit(0)).otherwise(F.size("_lines") - F.size("_left"))
    kept = [new.alias("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns]
    return cut.select(*kept, count.alias("removed_lines"))
