"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns, and whether to open the assistant's next turn, to a
string. It is not asked how it works: the turns are rendered one by one in growing prefixes, and the characters that a
prefix adds to the one before are the span of its last turn. The text's place within the span follows from rendering
the turn once more, with no text. A template whose output for a prefix does not begin with its output for the shorter
prefix rewrites history; then no span can be told, and the conversation is marked.

Turns of a conversation are ordered by turn, then role, then text. Null texts and roles count as empty; a null
conversation id is a conversation of its own. Other columns are ignored; an empty table gives no rows. A conversation
is one string in the end, so its turns meet in one task; conversations are spread over all tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn], bool], str]

OPEN, CLOSE, LEARNED = "### ", "</turn>\n", "assistant"
FORMATTED = "conv_id long, formatted string, rewrites boolean, spans array<struct<start: long, stop: long, text_start: long, text_stop: long, learned: boolean>>"
MARKED = re.compile(r"([\\#<])")
MARKED_ROLE = re.compile(r"([\\#<:])")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\<])*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return MARKED.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def default_template(turns: list[Turn], opened: bool = False) -> str:
    """``### role: text</turn>`` and a line feed for each turn; backslashes precede the signs of control strings in texts."""
    out = "".join(f"{OPEN}{MARKED_ROLE.sub(r'\\\1', role)}: {escape(text)}{CLOSE}" for role, text in turns)
    return f"{out}{OPEN}{LEARNED}: " if opened else out


def read_turns(formatted: str) -> list[Turn]:
    """The turns of a string by the default template."""
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def render(turns: list[Turn], template: Template, learned: str = LEARNED) -> tuple[str, bool, list[tuple]]:
    """The whole rendering, whether the template rewrites history, and for each turn the bounds of its span and of its
    text in it, and whether the text is learned."""
    done, spans = template([], False), []
    for k, (role, text) in enumerate(turns):
        longer = template(turns[:k + 1], False)
        bare = template([*turns[:k], (role, "")], False)
        if not (longer.startswith(done) and bare.startswith(done)):
            return template(turns, False), True, []
        added, frame = longer[len(done):], bare[len(done):]
        head = min(len(added), len(frame))
        while not (frame.startswith(added[:head]) and added.endswith(frame[head:])):
            head -= 1
        if role == learned:  # the opened turn says where its text begins, also where a text looks like the frame
            opened = template(turns[:k], True)
            if longer.startswith(opened) and opened.startswith(done):
                head = len(opened) - len(done)
        tail = len(frame) - head
        spans.append((len(done), len(longer), len(done) + head, len(longer) - tail, role == learned))
        done = longer
    return done, False, spans


def format_chats(conversations: DataFrame, template: Template = default_template, learned: str = LEARNED) -> DataFrame:
    """conv_id, formatted, rewrites and spans of every conversation (conv_id, turn, role, text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "stop", "text_start", "text_stop", "learned")
        held, size = [], 0
        for conv, turns in groupby(rows(batches), key=lambda r: r["conv_id"]):
            text, rewrites, spans = render([(r["role"], r["text"]) for r in turns], template, learned)
            held.append({"conv_id": conv, "formatted": text, "rewrites": rewrites, "spans": [dict(zip(names, s)) for s in spans]})
            size += len(text)
            if size > 4_000_000:
                yield pa.RecordBatch.from_pylist(held, schema=kind)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=kind)

    kind = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("rewrites", pa.bool_()), ("spans", pa.list_(pa.struct([
        ("start", pa.int64()), ("stop", pa.int64()), ("text_start", pa.int64()), ("text_stop", pa.int64()), ("learned", pa.bool_())])))])
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(write, FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted strings hold, read back from them: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                text = r["formatted"]
                turns = read_turns(text)
                loss = "".join(unescape(text[s["text_start"]:s["text_stop"]]) for s in r["spans"] if s["learned"])
                out.append({"conv_id": r["conv_id"], "n_turns": len(turns), "turns_sha256": sha("".join(f"{a}\n{b}\n" for a, b in turns)),
                            "loss_chars": len(loss), "loss_sha256": sha(loss), "formatted_chars": len(text)})
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    kind = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                      ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    return formatted.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
