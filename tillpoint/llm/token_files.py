"""Token ids as flat binary files with 64-bit document offsets, written and read back in parallel.

Every partition of the documents, ranges of ascending ``doc_id``, becomes one shard of three files:

* ``part-N.bin``: the token ids of its documents, one after the other, as little-endian unsigned integers of 16 bits
  where every id fits and of 32 bits otherwise;
* ``part-N.idx``: n + 1 little-endian 64-bit offsets into it, counted in tokens from the shard's start;
* ``part-N.doc``: n little-endian 64-bit document ids (a null id is stored as -2^63).

The manifest has a row for each shard; a shard's first token among all tokens is the prefix sum of the shards before
it. Readers map the files into memory where the folder is a mounted file system, and read them through the file
system's interface otherwise. A shard is written under a name of its own attempt and then renamed, so a task that runs
twice leaves one whole shard.

Null texts count as empty; a document always ends with ``end_id``. Documents of equal id stand in the order of their
texts. An empty table leaves no shard and no row. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.functions.lineage import scratch_path
from tillpoint.llm.common import shuffle_partitions, slices, staged, text_of
from tillpoint.llm.encoding import encoder

NULL_ID = -(2 ** 63)
MANIFEST = "part int, path string, id_bytes int, documents long, tokens long"


class Folder:
    """A shared folder by its path or URI, seen from a task."""

    def __init__(self, uri: str):
        from pyarrow import fs

        kind = urlparse(uri).scheme
        if kind in ("", "file"):
            self.files, self.root = fs.LocalFileSystem(), urlparse(uri).path
        else:
            self.files, self.root = fs.FileSystem.from_uri(uri)
        self.mounted = kind in ("", "file")

    def write(self, name: str, pieces: list[bytes]) -> None:
        self.files.create_dir(self.root, recursive=True)
        own = f"{self.root}/.{name}.{uuid.uuid4().hex}"
        with self.files.open_output_stream(own) as out:
            for x in pieces:
                out.write(x)
        self.files.move(own, f"{self.root}/{name}")

    def array(self, name: str, dtype: str) -> np.ndarray:
        path = f"{self.root}/{name}"
        if self.mounted:
            size = self.files.get_file_info(path).size
            return np.memmap(path, dtype=dtype, mode="r") if size else np.empty(0, dtype=dtype)
        with self.files.open_input_file(path) as f:
            return np.frombuffer(f.read(), dtype=dtype)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, spaces_dropped: bool = True,
                 id_bytes: int = 2, partitions: int | None = None) -> DataFrame:
    """Write the shards of ``docs`` (doc_id, text) to ``folder`` and return the manifest, itself staged."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer, spaces_dropped).encode
        end = np.asarray([end_id], dtype="<u4").tobytes()
        ids, counts, docs_seen = [], [np.zeros(1, dtype="<i8")], []
        for batch in batches:
            for some in slices(batch, "text"):
                found = encode(some.column("text").to_pylist())
                counts.append(np.fromiter((len(x) // 4 + 1 for x in found), dtype="<i8", count=len(found)))
                flat = np.frombuffer(end.join([*found, b""]), dtype="<u4")
                if id_bytes == 2 and flat.size and flat.max() > 0xFFFF:
                    raise ValueError("token ids don't fit 16 bits; use id_bytes=4")
                ids.append(flat.astype(f"<u{id_bytes}").tobytes())
                docs_seen.append(some.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        if not docs_seen:
            return
        to, offsets = Folder(folder), np.cumsum(np.concatenate(counts), dtype="<i8")
        to.write(f"part-{part:06d}.bin", ids)
        to.write(f"part-{part:06d}.idx", [offsets.tobytes()])
        to.write(f"part-{part:06d}.doc", docs_seen)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "path": [f"{folder}/part-{part:06d}"],
            "id_bytes": pa.array([id_bytes], pa.int32()), "documents": pa.array([len(offsets) - 1], pa.int64()),
            "tokens": pa.array([int(offsets[-1])], pa.int64())})

    n = partitions or shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    dealt = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return staged(dealt.mapInArrow(write, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Documents from the files: doc_id, start (tokens before it in the whole set), n_tokens, ids (unsigned
    little-endian 32-bit integers as binary)."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                at, _, name = shard["path"].rpartition("/")
                folder = Folder(at)
                ids = folder.array(f"{name}.bin", f"<u{shard['id_bytes']}")
                offsets, docs = folder.array(f"{name}.idx", "<i8"), folder.array(f"{name}.doc", "<i8")
                first = 0
                while first < len(docs):  # runs of documents of about a million tokens
                    last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + 1_000_000, side="right")) - 1)
                    last = min(last, len(docs))
                    own, cuts = docs[first:last], offsets[first:last + 1]
                    flat = np.asarray(ids[cuts[0]:cuts[-1]]).astype("<u4").tobytes()
                    local = ((cuts - cuts[0]) * 4).tolist()
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(own.astype(np.int64), mask=np.asarray(own == NULL_ID)),
                        "start": pa.array(cuts[:-1].astype(np.int64) + shard["base"]),
                        "n_tokens": pa.array(np.diff(cuts).astype(np.int64)),
                        "ids": pa.array([flat[a:b] for a, b in zip(local, local[1:])], pa.binary())})
                    first = last

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    based = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))
    spread = based.repartition(shuffle_partitions(manifest.sparkSession), "part")
    return spread.mapInArrow(load, "doc_id long, start long, n_tokens long, ids binary")


def token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` to token files and read every document back from them."""
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer, end_id, **options))
