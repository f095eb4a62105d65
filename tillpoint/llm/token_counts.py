"""Token counts of a byte-pair piece model by merging, without ids.

A text is a row of symbols, one for each character. A heap holds every adjacent pair that is a piece of the model, by
rank and then by place; the lowest is popped again and again, its two symbols become one in a linked list, and the
pairs with the new neighbours enter the heap. Each merge takes one symbol away, so the count is the number of initial
symbols less the number of merges; a character that the model lacks stands for its UTF-8 bytes from the start.

No piece reaches over the start of a word (checked when the model is loaded), so words are merged on their own and the
counts of words are remembered for later texts. Null and empty texts have no bytes and no tokens. Rows are counted one
by one, so repeated rows and null ids pass through; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import slices, text_of

#: The mark of a space in the model's pieces.
SPACE = "▁"
#: Remembered words in one Python worker; the store is emptied when it is full. Bounds memory, not results.
REMEMBERED = 1_000_000

WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in range(model.vocab_size())
                     if not any(f(i) for f in special)}
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("pieces of this model reach over the start of a word")
        self.known: dict[str, int] = {}

    def merged(self, word: str) -> int:
        """Tokens of one word by repeated merging of the lowest-ranked adjacent pair."""
        rank, n = self.rank, len(word)
        count = sum(1 if c in rank else len(c.encode()) for c in word)
        symbols: list[str | None] = list(word)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []
        for i in range(n - 1):
            r = rank.get(word[i:i + 2])
            if r is not None:
                heap.append((r, i, i + 1, word[i:i + 2]))
        heapq.heapify(heap)
        while heap:
            _, i, j, pair = heapq.heappop(heap)
            if after[i] != j or symbols[i] is None or symbols[j] is None or symbols[i] + symbols[j] != pair:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = pair, None
            count -= 1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                r = rank.get(pair + symbols[k])
                if r is not None:
                    heapq.heappush(heap, (r, i, k, pair + symbols[k]))
            h = before[i]
            if h >= 0:
                r = rank.get(symbols[h] + pair)
                if r is not None:
                    heapq.heappush(heap, (r, h, i, symbols[h] + pair))
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", SPACE)
        if marked[0] == SPACE or SPACE * 2 in marked or marked[-1] == SPACE:
            words = WORDS.findall(SPACE + marked)
        else:
            words = [SPACE + w for w in marked.split(SPACE)]
        known, total = self.known, 0
        for w in words:
            n = known.get(w)
            if n is None:
                n = known[w] = self.merged(w)
            total += n
        if len(known) > REMEMBERED:
            known.clear()
        return total


@functools.lru_cache(maxsize=4)
def counter(path: str) -> PieceCounter:
    """One counter for each model in a Python worker, kept between tasks."""
    return PieceCounter(path)


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs`` (doc_id, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(model).count
        for batch in batches:
            for some in slices(batch, "text"):
                texts = some.column("text")
                tokens = np.fromiter(map(of, texts.to_pylist()), dtype=np.int64, count=some.num_rows)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": some.column("doc_id"), "n_bytes": pc.binary_length(texts).cast(pa.int64()),
                    "n_tokens": pa.array(tokens), "over_limit": pa.array(tokens > limit)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
