"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.functions.lineage import scratch_path

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and continue from the files.

    The copy survives the loss of any executor, and later readers prune its columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(batch: pa.RecordBatch, column: str, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``most`` bytes of text each (a longer text stands alone)."""
    sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def salted_join(rows: DataFrame, few: DataFrame, on: list[str], by: str, salts: int = 16) -> DataFrame:
    """Inner join of many ``rows`` with a smaller table, where one key may hold a great part of ``rows``.

    ``rows`` with one key are dealt to ``salts`` groups by the column ``by``; ``few`` stands once in each of them.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    right = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"]).drop("_salt")


def whole_vectors(vector: Column, scale: float) -> Column:
    """floor(scale * x) of a vector's components, as doubles, which hold these whole numbers exactly.

    Null for a null vector and one that holds a null or a component that is not a finite number (or leaves a double's range times ``scale``).
    """
    inf = F.lit(float("inf"))
    scaled = F.transform(vector, lambda x: x.cast("double") * F.lit(float(scale)))
    fit = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != inf))
    return F.when(F.coalesce(fit, F.lit(False)), F.transform(scaled, whole_double))


def whole_double(x: Column) -> Column:
    """The floor of a double, as a double: beyond 2^53 it is whole already, and may not fit 64 bits."""
    large = F.abs(x) >= F.lit(2.0 ** 53)
    return F.when(large, x).otherwise(F.floor(F.when(large, F.lit(0.0)).otherwise(x)).cast("double"))


def exact(m: np.ndarray) -> np.ndarray:
    """Whole numbers held as doubles as 64-bit integers, or Python's where these are too small."""
    if not m.size or np.abs(m).max() < 2.0 ** 53:
        return m.astype(np.int64)
    return np.asarray([int(x) for x in m.ravel().tolist()], dtype=object).reshape(m.shape)


def matrices(column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By length of an Arrow column of vectors: the length, the places and the matrix."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dim)
        yield dim, at, column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dim)


def sortable(x: int) -> str:
    """A whole number as text that sorts like the number."""
    digits = str(abs(x))
    if x >= 0:
        return f"1{len(digits):05d}{digits}"
    return f"0{99999 - len(digits):05d}" + digits.translate(str.maketrans("0123456789", "9876543210"))


def number(text: str) -> int:
    if text[0] == "1":
        return int(text[6:])
    return -int(text[6:].translate(str.maketrans("0123456789", "9876543210")))


def number_column(text: Column) -> Column:
    """The number of a sortable text; null beyond 64 bits."""
    below = -F.translate(F.substring(text, 7, 400), "0123456789", "9876543210").try_cast("decimal(38,0)")
    return F.when(F.substring(text, 1, 1) == "1", F.substring(text, 7, 400).try_cast("decimal(38,0)")).otherwise(below).try_cast("long")
