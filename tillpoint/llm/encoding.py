"""Token ids of whole texts by a ``tokenizers`` file, with the ids of repeated chunks remembered.

Byte-pair merges never cross white space, so a text can be encoded chunk by chunk, each chunk reaching from one
single space to the next. A chunk is encoded the first time a task's process meets it; later its ids are looked up.
Words of Latin letters go straight to the library's byte-pair model, apart from the signs after them and from the line
before them, which the tokenizers split before any merge; all other chunks pass the whole library. A text with a space
inside a run of other white space, where chunks would not be independent, goes to the library whole.
"""

from __future__ import annotations

import functools
import re

import numpy as np

#: Remembered chunks in one Python worker; the store is emptied when it is full. Bounds memory, not results.
REMEMBERED = 1_000_000
#: Chunks joined for one call of the library.
JOINED = 2_000

RUN = re.compile(r"\s (?:\s|\Z)")
#: Letters that every version of the character tables knows, and ASCII signs after them but ' and < (contractions, special strings).
WORD = re.compile(r"([A-Za-z\u00AA\u00B5\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+)([!-&(-/:;=-@\[-`{-~]*)")
LATIN = 0x250


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


class ChunkEncoder:
    """``encode(texts)`` gives little-endian unsigned 32-bit ids, as the library's ``encode`` without special tokens."""

    def __init__(self, path: str, spaces_dropped: bool):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        #: True where the tokenizer drops white space; otherwise a chunk keeps the space before it.
        self.spaces_dropped = spaces_dropped
        self.known: dict[str, bytes] = {}
        #: Words without a space before them, and signs after a word.
        self.bare: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {"": b""}
        letters = byte_letters()
        self.shown = {i: "".join(letters[b] for b in chr(i).encode()) for i in range(LATIN)}
        self.space = "" if spaces_dropped else letters[ord(" ")]
        #: False for a tokenizer that splits words or writes their bytes in another way: all goes through the whole library then.
        self.by_words = all("<" in x.content for x in self.library.get_added_tokens_decoder().values())
        probes = ("a", "Word", "na\u00EFve", "Stra\u00DFe.", "x,", "and&&&", "\u00C9t\u00E9:", "\u024F")
        self.by_words = self.by_words and all(self._words(x, not spaces_dropped) == self.whole(x) for x in probes)
        self.known.clear()
        self.bare.clear()

    def whole(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str, bare: bool) -> bytes | None:
        """Ids of a word of Latin letters; with a space before it where spaces are kept, unless it is ``bare``."""
        if self.spaces_dropped:  # such a tokenizer lowers all letters
            if not word.isascii() and ("\u0130" in word or max(word.lower()) >= "\u0250"):
                return None
            word = word.lower()
        store = self.bare if bare else self.known
        ids = store.get(word)
        if ids is None:
            tokens = self.library.model.tokenize(("" if bare else self.space) + word.translate(self.shown))
            ids = store[word] = np.asarray([t.id for t in tokens], dtype="<u4").tobytes()
        return ids

    def _words(self, chunk: str, bare: bool = False) -> bytes | None:
        """Ids of a chunk of words, one to a line, with signs after them; none for any other chunk."""
        if not self.by_words:
            return None
        out = []
        for line in (chunk,) if self.spaces_dropped else chunk.split("\n"):
            found = WORD.fullmatch(line)
            ids = found and self._word(found[1], bare)
            if ids is None:
                return None
            if found[2] not in self.signs:
                self.signs[found[2]] = self.whole(found[2])
            out.append(ids + self.signs[found[2]])
            bare = True
        return self.line_end.join(out)

    @functools.cached_property
    def line_end(self) -> bytes:
        return self.whole("\n")

    def _learn(self, chunks: list[str]) -> None:
        others = []
        for c in chunks:
            ids = self._words(c)
            if ids is None:
                others.append(c)
            else:
                self.known[c] = ids
        self._encode_new(others)

    def _encode_new(self, chunks: list[str]) -> None:
        lead = "" if self.spaces_dropped else " "
        plain = []
        for c in chunks:
            if not c or c[0].isspace() or c[-1].isspace():
                self.known[c] = self.whole(lead + c)
            else:
                plain.append(c)
        for at in range(0, len(plain), JOINED):
            some = plain[at:at + JOINED]
            found = self.library.encode(lead + " ".join(some), add_special_tokens=False)
            ids = np.asarray(found.ids, dtype="<u4")
            starts = np.fromiter((a for a, _ in found.offsets), dtype=np.int64, count=len(ids))
            lengths = np.fromiter(map(len, some), dtype=np.int64, count=len(some))
            ends = np.cumsum(lengths + 1) - (0 if lead else 1)
            cuts = np.searchsorted(starts, ends, side="left").tolist()
            data, before = ids.tobytes(), 0
            for c, cut in zip(some, cuts):
                self.known[c] = data[4 * before:4 * cut]
                before = cut

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) + len(self.bare) + len(self.signs) > REMEMBERED:
            self.known.clear()
            self.bare.clear()
            self.signs = {"": b""}
        known, split, new = self.known, [], {}
        for text in texts:
            if not self.spaces_dropped and RUN.search(text):
                split.append(None)
                continue
            parts = (text.replace("\n", " ") if self.spaces_dropped else text).split(" ")
            first = "" if self.spaces_dropped else parts.pop(0)
            found = list(map(known.get, parts))
            if None in found:
                new.update(dict.fromkeys([c for c, ids in zip(parts, found) if ids is None]))
                split.append((first, found, parts))
            else:
                split.append((first, found, None))
        if new:
            self._learn(list(new))
        out = []
        for text, row in zip(texts, split):
            if row is None:
                out.append(self.whole(text))
                continue
            first, found, parts = row
            if parts is not None:
                found = [known[c] if ids is None else ids for c, ids in zip(parts, found)]
            if first:
                ids = self._words(first, bare=True)
                found.insert(0, self.whole(first) if ids is None else ids)
            out.append(b"".join(found))
        return out


@functools.lru_cache(maxsize=4)
def encoder(path: str, spaces_dropped: bool) -> ChunkEncoder:
    """One encoder for each file in a Python worker, kept between tasks."""
    return ChunkEncoder(path, spaces_dropped)
