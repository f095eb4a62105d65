"""N-gram Jaccard join by vertical partitioning, and the groups its links make.

The global order of n-grams is that of their 64-bit hashes. It is cut into fragments, so every document's set falls into
vertical pieces, one for each fragment.

*Candidates.* Two sets of n and m shingles with a Jaccard similarity of t differ in at most (n + m)(1 - t)/(1 + t)
shingles, so of more fragments than that, they agree on one whole fragment. A document sends a hash of each of its
pieces, under the fragments of its size class and of those above it where a partner can be; documents that share a
piece are candidates. Common n-grams, as of a passage that many documents share, are left out of the pieces. A document
of which so little is left that the differences could touch all its pieces sends, besides, single n-grams: the first
n - ceil(t n) + 1 of its n in an order that has common ones last, of which linked sets share one. A passage that many
short documents share makes no star of them then, unless they hold hardly anything else. No pair of the stated
similarity is missed, whatever counts as common: that only decides how many candidates there are.

So many more pieces are cut than differ that linked sets share several. A set that shares fewer than it must, with all
other sets together, is no candidate.

*Counting.* Sets that share a piece make a star around the least of them. First every set meets one centre only, the
least of its centres: both are cut into fragments of the order, one row each, which meet in the shuffle; partial counts
of a fragment are summed per pair. Copies of a text are one component then, without meeting each other. A star whose
members are in several components is compared further: its members are dealt to blocks by size, and for every two
blocks that hold different components and sizes that allow a link the overlap of each pair is counted, again fragment by
fragment. Blocks of the centre's component only never meet each other. A block pair returns a spanning forest of its
links, at most one row for each document. Stars that share members are not joined to larger groups.

Documents of equal sets are one from the start, found by a 128-bit digest of the set that combines in each task. The
result is exact up to collisions of 64-bit hashes (of n-grams, and of sets where candidates meet). Texts are read again
rather than kept as sets; those of candidates are kept as texts until their links are known.

A null text is empty; texts without words link with nothing. Rows that repeat an id are one document's versions and
share its links. Rows without an id get their set's component like any other and are null only where no row of the set
has an id. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache
from itertools import groupby
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import salted_join, shuffle_partitions, slices, staged, text_of
from tillpoint.llm.components import components
from tillpoint.llm.shingles import U, mix, shingle_sets, text_bytes

#: An n-gram is common from so many documents on, counted where so many of about a megabyte of texts hold it; the
#: most frequent ones, at most so many, are sent to all tasks.
COMMON, COMMON_HERE, COMMON_MOST = 40, 3, 1_000_000
#: Documents in a block, shingles in a block, and columns of a partial count: bounds of one task's memory.
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 4_000_000, 4096
#: Fragments in which overlaps are counted, at least.
COUNTED = 8


@dataclass(frozen=True)
class Similarity:
    words: int
    part: int  # a link needs part / whole
    whole: int = 100

    @property
    def t(self) -> Fraction:
        return Fraction(self.part, self.whole)

    def differences(self, total: int) -> int:
        """Most shingles in one set only, of linked sets with ``total`` shingles together."""
        return total * (self.whole - self.part) // (self.whole + self.part)

    def size_class(self, n: int) -> int:
        return _size_class(n, self)

    def fragments(self, k: int) -> tuple[int, int]:
        """Number of fragments of size class ``k`` and how many pieces may be empty; none where linked sets are equal."""
        return _fragments(k, self)


@lru_cache(maxsize=1_000_000)
def _size_class(n: int, s: Similarity) -> int:
    return floor(log(n) / -log(float(s.t)) + 1e-9)


@lru_cache(maxsize=10_000)
def _fragments(k: int, s: Similarity) -> tuple[int, int]:
    high = ceil(float(s.t) ** -(k + 1)) + 1  # no set of the class is larger
    most = s.differences(2 * high)
    spare = ceil(most / 4) + 2
    return (most + 1 + spare, spare) if most else (0, 0)


def piece_hashes(order: np.ndarray, count: int, k: int) -> np.ndarray:
    """A hash of each of the pieces, of ``count`` fragments, that aren't empty."""
    if not len(order):
        return order
    fragment = ((order >> U(32)) * U(count)) >> U(32)
    starts = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
    pieces = np.add.reduceat(mix(order ^ U(0xA5A5A5A5)), starts)
    return mix(pieces + mix(fragment[starts] * U(64)) * U(31) + U(k))


def piece_keys(own: np.ndarray, s: Similarity, common: np.ndarray = np.empty(0, dtype=U)) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a sorted set and, for each, how many of its class the set shares with another where it links at all.

    Linked sets that differ share at least one. The last byte of a key is that of its class. common: sorted n-grams to leave out.
    """
    n, out, needs = len(own), [], []
    shared = np.zeros(n, dtype=bool)
    if len(common) and n:
        shared = common[np.minimum(np.searchsorted(common, own), len(common) - 1)] == own
    rare = own[~shared]
    # two linked sets have one of their first n-grams in common, in any order that is the same for both
    first = np.concatenate([rare, own[shared]])[:n - ceil(n * s.t) + 1]
    largest = floor(n / s.t)
    for k in range(s.size_class(n), s.size_class(largest) + 1):
        count, spare = s.fragments(k)
        if not count:
            continue
        some = [piece_hashes(rare, count, k)]
        # every shingle in one set only spoils one piece; all others that aren't empty are shared
        need = len(some[0]) - s.differences(n + largest)
        if count - len(some[0]) > spare:  # not more pieces than there can be differences
            need = 1
            some.append(mix(first + mix(np.asarray([k], dtype=U) + U(0xFEED))))
        keys = np.concatenate(some)
        out.append((keys & ~U(255)) | U(k & 255))
        needs.append(np.full(len(keys), max(1, need), dtype=np.int32))
    if not out:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32)
    return np.concatenate(out).view(np.int64), np.concatenate(needs)


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, sets), dtype=U, count=len(sets))
    low, high = (np.fromiter((mix(x ^ salt).sum() for x in sets), dtype=U, count=len(sets)) for salt in (U(0), U(0x5DEECE66D)))
    low, high = low + sizes, mix(high) + sizes
    return low.view(np.int64), high.view(np.int64)


def document_sets(docs: DataFrame, s: Similarity) -> DataFrame:
    """doc_id, n_shingles, low, high (the digest of the set) of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                sets = list(shingle_sets(*text_bytes(some.column("text")), s.words))
                low, high = signatures(sets)
                n = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(n), pa.array(low), pa.array(high)],
                                                 ["doc_id", "n_shingles", "low", "high"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n_shingles long, low long, high long")


def common_ngrams(docs: DataFrame, s: Similarity) -> np.ndarray:
    """Sorted hashes of common n-grams. Counts of all documents, combined in each task; copies there count once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for some in slices(batch, "text"):
                sets = list(shingle_sets(*text_bytes(some.column("text")), s.words))
                fresh = [x for x, sig in zip(sets, signatures(sets)[0].tolist()) if not (sig in seen or seen.add(sig))]
                values, n = np.unique(np.concatenate(fresh or [np.empty(0, dtype=U)]), return_counts=True)
                often = n >= COMMON_HERE
                yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(n[often].astype(np.int64))], ["ngram", "n"])

    here = docs.select(text_of().alias("text")).mapInArrow(scan, "ngram long, n long")
    often = here.groupBy("ngram").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON)
    found = often.orderBy(F.desc("n"), "ngram").limit(COMMON_MOST).select("ngram").toArrow().column("ngram")
    return np.sort(found.to_numpy().astype(np.int64).view(U))


def candidates(docs: DataFrame, s: Similarity) -> DataFrame:
    """Stars of sets that share a key: ``grp``, the least of those with the key, and its members ``low`` (digests of sets).

    A set that shares fewer pieces of a class than a link leaves it, with all others together, isn't a member.
    """
    common = docs.sparkSession.sparkContext.broadcast(common_ngrams(docs, s))  # at most 8 MB

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within the task are sent once
        for batch in batches:
            for some in slices(batch, "text"):
                sets = [x for x in shingle_sets(*text_bytes(some.column("text")), s.words) if len(x)]
                if not sets:
                    continue
                low, _ = signatures(sets)
                ids, keys, needs = [], [], []
                for own, sig in zip(sets, low.tolist()):
                    if sig not in seen:
                        seen.add(sig)
                        ids.append(sig)
                        of_set, need = piece_keys(own, s, common.value)
                        keys.append(of_set)
                        needs.append(need)
                if ids:
                    ends = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
                    lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (keys, needs)]
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *lists], ["low", "keys", "needs"])

    sent = docs.select(text_of().alias("text")).mapInArrow(scan, "low long, keys array<long>, needs array<int>")
    rows = sent.select("low", F.explode(F.arrays_zip("keys", "needs")).alias("of")).select("low", "of.keys", "of.needs")
    # the first and the next of its key, row by row: nothing of a frequent key is held
    by_key = Window.partitionBy("keys").orderBy("low")
    met = (rows.select("low", "keys", "needs", F.first("low").over(by_key.rowsBetween(Window.unboundedPreceding, 0)).alias("grp"),
                       F.lead("low").over(by_key).alias("next"))
           .filter("low != grp OR next != low"))
    stars = staged(met.groupBy("grp", "low", F.col("keys").bitwiseAND(255).alias("k")).agg(
        F.count("*").alias("n"), F.min("needs").alias("need")), "stars")
    able = stars.groupBy("low", "k").agg(F.sum("n").alias("n"), F.min("need").alias("need")).filter("n >= need").select("low").distinct()
    members = staged(stars.select("grp", "low").distinct().join(able, "low", "left_semi"), "members")
    several = members.groupBy("grp").agg(F.min("low").alias("centre"), F.max("low").alias("last")).filter("centre != last")
    return salted_join(members, several.select("grp", "centre"), ["grp"], "low")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shingles in common of every left with every right set: partial counts of each fragment, summed."""
    total = np.zeros((len(left), len(right)), dtype=np.float64)
    values = sum(map(len, left)) + sum(map(len, right))
    fragments = max(COUNTED, values // 200_000)
    edges = (np.arange(1, fragments, dtype=np.float64) * (2.0 ** 64 / fragments)).astype(U)
    cut = lambda sets: [np.concatenate([[0], np.searchsorted(x, edges), [len(x)]]) for x in sets]
    left_cuts, right_cuts = cut(left), cut(right)
    for f in range(fragments):
        sides = []
        for sets, cuts in ((left, left_cuts), (right, right_cuts)):
            pieces = [x[c[f]:c[f + 1]] for x, c in zip(sets, cuts)]
            sides.append((np.concatenate(pieces), np.repeat(np.arange(len(sets)), [len(p) for p in pieces])))
        common = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]), assume_unique=True)
        for at in range(0, len(common), COLUMNS):
            some = common[at:at + COLUMNS]
            dense = []
            for (values, owner), size in zip(sides, (len(left), len(right))):
                place = np.searchsorted(some, values)
                hit = np.flatnonzero(some[np.minimum(place, len(some) - 1)] == values)
                m = np.zeros((size, len(some)), dtype=np.float32)
                m[owner[hit], place[hit]] = 1
                dense.append(m)
            total += dense[0] @ dense[1].T
    return np.rint(total).astype(np.int64)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (root, node) of a spanning forest of a symmetric matrix of links."""
    free, out = np.ones(len(linked), dtype=bool), []
    for root in range(len(linked)):
        if free[root]:
            free[root] = False
            front = np.asarray([root])
            while len(front):
                front = np.flatnonzero(linked[front].any(axis=0) & free)
                free[front] = False
                out += [(root, int(x)) for x in front]
    return out


def block_links(ids: list[int], sides: list[int], sets: list[np.ndarray], s: Similarity, every: bool = False) -> list[tuple[int, int]]:
    """Links between the documents of one block (all of side 0), or between those of two: a spanning forest, or every link."""
    order = sorted(range(len(ids)), key=lambda i: sides[i])
    ids, sets = [ids[i] for i in order], [sets[i] for i in order]
    split = sum(1 for x in sides if x == 0)
    left, right = (sets[:split], sets[split:]) if split < len(sets) else (sets, sets)
    inter = overlaps(left, right)
    sizes = [np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (left, right)]
    link = s.whole * inter >= s.part * (sizes[0][:, None] + sizes[1][None, :] - inter)
    if split < len(sets):
        whole = np.zeros((len(sets), len(sets)), dtype=bool)
        whole[:split, split:], whole[split:, :split] = link, link.T
        link = whole
    if every:
        return [(ids[a], ids[b]) for a, b in np.argwhere(np.triu(link, 1)).tolist()]
    return [(ids[a], ids[b]) for a, b in forest(link) if ids[a] != ids[b]]


def texts_of(docs: DataFrame, nodes: DataFrame, s: Similarity) -> DataFrame:
    """``low`` and ``text`` of the documents that stand for the sets of ``nodes`` (rep)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                low, _ = signatures(list(shingle_sets(*text_bytes(some.column("text")), s.words)))
                yield pa.RecordBatch.from_arrays([pa.array(low), some.column("text")], ["low", "text"])

    wanted = nodes.select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # both sides grow with the documents: one plan at every size
    return texts.join(wanted.hint("merge"), "doc_id", "left_semi").select("text").mapInArrow(scan, "low long, text string")


def centre_links(texts: DataFrame, pairs: DataFrame, s: Similarity) -> DataFrame:
    """Those of ``pairs`` (low, centre) that link, as (a, b). texts: low, text; rows may repeat."""
    # a centre of many sets stands once for each part of them
    parts = pairs.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    heads = parts.select(F.col("centre").alias("low"), "centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("place"))
    dealt = salted_join(pairs, parts, ["centre"], "low").select(
        "low", "centre", F.pmod(F.xxhash64("low"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("place"))
    edges = (np.arange(1, COUNTED, dtype=np.float64) * (2.0 ** 64 / COUNTED)).astype(U)
    names = ["centre", "part", "place", "low", "fragment", "n", "piece"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                took, fragment, n, pieces = [], [], [], []
                for i, own in enumerate(shingle_sets(*text_bytes(some.column("text")), s.words)):
                    for f, piece in enumerate(np.split(own, np.searchsorted(own, edges))):
                        if len(piece):
                            took.append(i)
                            fragment.append(f)
                            n.append(len(own))
                            pieces.append(piece.tobytes())
                rows = some.select(names[:4]).take(pa.array(took, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(fragment, pa.int32()), pa.array(n, pa.int64()), pa.array(pieces, pa.binary())], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = head = last = None
        of_head = 0
        for batch in batches:
            out = []
            for centre, part, place, low, fragment, n, piece in zip(*(batch.column(c).to_pylist() for c in names)):
                if (centre, part, fragment) != key:
                    key, head, last = (centre, part, fragment), None, None
                if place == 0:
                    head, of_head = np.frombuffer(piece, dtype=U), n
                elif head is not None and low != last:  # a row that repeats counts once
                    last, own = low, np.frombuffer(piece, dtype=U)
                    at = np.minimum(np.searchsorted(head, own), len(head) - 1)
                    out.append((low, centre, n, of_head, int(np.count_nonzero(head[at] == own))))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 5,
                                             ["a", "b", "n_a", "n_b", "common"])

    asked = heads.unionByName(dealt)
    pieces = (texts.join(asked.hint("merge"), "low").select("centre", "part", "place", "low", "text")
              .mapInArrow(cut, "centre long, part int, place int, low long, fragment int, n long, piece binary"))
    met = (pieces.repartition(shuffle_partitions(texts.sparkSession), "centre", "part", "fragment")
           .sortWithinPartitions("centre", "part", "fragment", "place", "low"))
    partial = met.mapInArrow(count, "a long, b long, n_a long, n_b long, common long")
    return (partial.groupBy("a", "b").agg(F.sum("common").alias("common"), (F.max("n_a") + F.max("n_b")).alias("both"))
            .filter(F.col("common") * s.whole >= (F.col("both") - F.col("common")) * s.part).select("a", "b"))


def star_blocks(stars: DataFrame, s: Similarity, every: bool = False) -> DataFrame:
    """The members of stars in several components, or of ``every`` star, with ``block`` and ``core``: of the centre's component only.

    stars: grp (the centre), low, n_shingles, component. A large star is cut by size, and each size by a hash.
    """
    whole = stars.groupBy("grp").agg(
        F.count("*").alias("members"), F.sum("n_shingles").alias("shingles"), F.min("component").alias("least"), F.max("component").alias("most"),
        F.max(F.when(F.col("low") == F.col("grp"), F.col("component"))).alias("centre"))
    whole = (whole if every else whole.filter("least != most")).drop("least", "most")
    mixed = salted_join(stars, whole, ["grp"], "low")
    small = (F.col("members") <= BLOCK) & (F.col("shingles") <= BLOCK_SHINGLES)
    size = F.floor(F.log(F.col("n_shingles").cast("double")) / -log(float(s.t))).cast("int")
    cells = mixed.select("grp", "low", "n_shingles", "component", small.alias("small"),
                         F.when(small, F.lit(-1)).otherwise(size).alias("size"),
                         (~small & F.coalesce(F.col("component") == F.col("centre"), F.lit(False)) & F.lit(not every)).alias("core"))
    fill = cells.filter("NOT small").groupBy("grp", "size", "core").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("parts"))
    large = salted_join(cells.filter("NOT small"), fill, ["grp", "size", "core"], "low").withColumn(
        "part", F.pmod(F.xxhash64("low"), F.col("parts")).cast("int"))
    both = cells.filter("small").withColumn("part", F.lit(0)).unionByName(large.drop("parts"))
    return both.select("grp", "low", "n_shingles", "component", "core", F.xxhash64("size", "core", "part").alias("block"))


def star_links(texts: DataFrame, stars: DataFrame, s: Similarity, every: bool = False) -> DataFrame:
    """Links (a, b) between members of one star that are in different components, or more; or ``every`` link, each once for each star."""
    placed = staged(star_blocks(stars, s, every), "star-blocks")
    blocks = placed.groupBy("grp", "block", "core").agg(
        F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"), F.min("component").alias("first"), F.max("component").alias("last"))
    second = blocks.select("grp", *(F.col(c).alias(f"{c}_2") for c in ("block", "core", "least", "most", "first", "last")))
    pairs = (blocks.filter("NOT core").join(second, "grp").filter("core_2 OR block <= block_2")
             .filter(F.col("most") * s.whole >= F.col("least_2") * s.part).filter(F.col("most_2") * s.whole >= F.col("least") * s.part)
             .filter(F.lit(every) | F.expr("NOT (first = last AND first_2 = last_2 AND first = first_2)"))
             .select("grp", F.xxhash64("grp", "block", "block_2").alias("pair"), "block", "block_2"))
    sides = pairs.select("grp", "pair", "block", F.lit(0).alias("side")).unionByName(
        pairs.filter("block != block_2").select("grp", "pair", F.col("block_2").alias("block"), F.lit(1).alias("side")))
    asked = placed.join(sides, ["grp", "block"]).select("pair", "side", "low")
    work = (texts.join(asked.hint("merge"), "low").repartition(shuffle_partitions(texts.sparkSession), "pair")
            .sortWithinPartitions("pair"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for some in slices(batch, "text"):
                sets = shingle_sets(*text_bytes(some.column("text")), s.words)
                yield from zip(*(some.column(c).to_pylist() for c in ("pair", "side", "low")), sets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(rows(batches), key=lambda r: r[0]):
            _, sides, ids, sets = zip(*((*r[:3], r[3]) for r in group))
            if len(ids) > 1:
                links = block_links(list(ids), list(sides), list(sets), s, every)
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])

    return work.mapInArrow(count, "a long, b long")


def near_groups(docs: DataFrame, words: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Documents link when ``whole`` * shingles in common >= ``part`` * shingles in either.
    """
    s = Similarity(words, part, whole)
    sets = staged(document_sets(docs, s), "sets")
    same = staged(sets.filter("n_shingles > 0").groupBy("low", "high", "n_shingles").agg(F.min("doc_id").alias("rep")), "same-sets")
    pairs = staged(candidates(docs, s), "stars")
    sizes = same.filter("rep IS NOT NULL").groupBy("low").agg(F.max("n_shingles").alias("n_shingles"))
    nodes = pairs.select("low").distinct()
    texts = staged(texts_of(docs, same.join(nodes, "low").filter("rep IS NOT NULL"), s), "candidate-texts")
    first = staged(centre_links(texts, pairs.groupBy("low").agg(F.min("centre").alias("centre")).filter("low != centre"), s), "centre-links")
    known = components(first)
    members = (pairs.join(sizes, "low").join(known, F.col("low") == known["node"], "left")
               .select(F.col("centre").alias("grp"), "low", "n_shingles", F.coalesce("component", "low").alias("component")).distinct())
    # the first links as stars, so where no other follows there is nothing to do
    held = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
    links = held.unionByName(star_links(texts, members, s)).unionByName(repeated_ids(sets))
    found = staged(components(links), "components")
    least = found.join(same, found["node"] == same["low"]).groupBy("component").agg(F.min("rep").alias("component_id"))
    named = salted_join(found, least, ["component"], "node").select(F.col("node").alias("low"), "component_id")
    known = same.join(named, "low", "left").select("low", "high", "n_shingles", F.coalesce("component_id", "rep").alias("component_id"))
    linked = sets.filter("n_shingles > 0").join(known, ["low", "high", "n_shingles"])
    alone = sets.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return linked.select(*columns).unionByName(alone.select(*columns))


def class_links(docs: DataFrame, words: int = 5, part: int = 80, whole: int = 100) -> tuple[DataFrame, DataFrame]:
    """The whole join: the links of different sets, and which rows have which set.

    Links are a row (a, b), a < b, for each two sets that link. Members are doc_id, n_shingles and class_id of every row of
    ``docs``; class_id is the number of the row's set, null for a row without words. Copies of a set are not written out as pairs.

    Every two members of a star are compared, in blocks, and the links of a group of near copies are as many as its
    pairs: for components alone, ``near_groups`` is far cheaper.
    """
    s = Similarity(words, part, whole)
    sets = staged(document_sets(docs, s), "sets")
    sizes = sets.filter("n_shingles > 0").groupBy("low").agg(F.max("n_shingles").alias("n_shingles"))
    stars = staged(candidates(docs, s), "stars")
    # a text for each set, taken from the rows themselves: also those without an id, which near_groups reads as well
    texts = staged(texts_of_sets(docs, stars.select("low").distinct(), s), "candidate-texts")
    members = stars.join(sizes, "low").select(F.col("centre").alias("grp"), "low", "n_shingles", F.col("low").alias("component")).distinct()
    links = (star_links(texts, members, s, every=True).filter("a != b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return links, sets.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("low")).alias("class_id"))


def texts_of_sets(docs: DataFrame, wanted: DataFrame, s: Similarity) -> DataFrame:
    """``low`` and ``text`` of one row for each set of ``wanted`` (low); copies within a task are left out before the shuffle."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for some in slices(batch, "text"):
                low = signatures(list(shingle_sets(*text_bytes(some.column("text")), s.words)))[0].tolist()
                fresh = [i for i, x in enumerate(low) if not (x in seen or seen.add(x))]
                yield pa.RecordBatch.from_arrays([pa.array([low[i] for i in fresh], pa.int64()), some.column("text").take(pa.array(fresh, pa.int64()))],
                                                 ["low", "text"])

    rows = docs.select(text_of().alias("text")).mapInArrow(scan, "low long, text string")
    # both sides grow with the documents: one plan at every size
    return rows.join(wanted.hint("merge"), "low", "left_semi").dropDuplicates(["low"])


def link_counts(docs: DataFrame, words: int = 5, part: int = 80, whole: int = 100, salts: int = 16) -> DataFrame:
    """doc_id, n_shingles, class_id and n_links of every row of ``docs``: how many other rows its set links with, equal ones included."""
    links, members = class_links(docs, words, part, whole)
    links, members = staged(links, "class-links"), staged(members, "members")
    copies = staged(members.filter("class_id IS NOT NULL").groupBy("class_id").agg(F.count("*").alias("n")), "classes")
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = (salted_join(ends.withColumnRenamed("b", "class_id"), copies, ["class_id"], "a", salts)
              .groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("linked")))
    known = copies.join(others, "class_id", "left").select("class_id", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    alone = members.filter("class_id IS NULL").withColumn("n_links", F.lit(0).cast("long"))
    return salted_join(members.filter("class_id IS NOT NULL"), known, ["class_id"], "doc_id", salts).select(*alone.columns).unionByName(alone)


def repeated_ids(sets: DataFrame) -> DataFrame:
    """Links between the sets of a document id that several rows share: each to the least of them."""
    several = (sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id")
               .agg(F.min("low").alias("least"), F.max("low").alias("most")).filter("least != most"))
    return (sets.filter("n_shingles > 0").join(several, "doc_id")
            .select(F.col("low").alias("a"), F.col("least").alias("b")).filter("a != b").distinct())


def one_of_each(docs: DataFrame, **similarity) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their group, with all their columns, and rows without an id."""
    leave = near_groups(docs, **similarity).filter("doc_id != component_id").select("doc_id").distinct()
    return docs.join(leave, docs["doc_id"].cast("long") == leave["doc_id"], "left_anti")
