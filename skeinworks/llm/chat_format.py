"""Chat formatting with offset-aligned masks.

A conversation is rendered as ``<|turn|>role<|text|>text<|end|>`` per turn. Control strings inside
roles and texts cannot occur: each ``<`` and ``[`` is followed by a backslash, which reading back
removes. The marks are special tokens of the encoder, so no token straddles a turn. The rendered text
is encoded once; the ids' lengths give each token's character offsets, and the sorted spans that the
renderer has noted for trained turns are intersected with them by binary search.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.llm._common import batch_of, batches, partitions, ready
from skeinworks.llm.token_counts import ByteEncoder

#: The template's marks.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_READ = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.S)


def escape(text: str) -> str:
    return text.replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return text.replace("<\\", "<").replace("[\\", "[")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _READ.findall(formatted)]


def token_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens lie in a span: both are sorted, so each token is looked up by binary search.

    ``offsets`` and ``spans`` are (n, 2) arrays of start and end; an empty token is in no span.
    """
    if not len(offsets) or not len(spans):
        return np.zeros(len(offsets), dtype=bool)
    at = np.searchsorted(spans[:, 0], offsets[:, 0], side="right") - 1
    inside = (at >= 0) & (offsets[:, 1] <= spans[np.maximum(at, 0), 1])
    return inside & (offsets[:, 1] > offsets[:, 0])


def masked_text(text: str, offsets: np.ndarray, mask: np.ndarray) -> str:
    """The text that the masked tokens cover, each character once (a character may be several tokens)."""
    spans = offsets[mask]
    if not len(spans):
        return ""
    # Runs of spans that touch or overlap are cut out in one piece.
    new = np.flatnonzero(spans[1:, 0] > spans[:-1, 1]) + 1
    starts, ends = spans[np.concatenate([[0], new]), 0], spans[np.concatenate([new, [len(spans)]]) - 1, 1]
    return "".join(text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True))


class Turn(NamedTuple):
    """A turn with its control strings escaped."""

    role: str
    text: str
    trained: bool


def turn(role: str | None, text: str | None, trained: str) -> Turn:
    """Null role and text are empty."""
    return Turn(escape(role or ""), escape(text or ""), role == trained)


def rendered(turns: list[Turn]) -> tuple[str, np.ndarray]:
    """The turns' text, and the (n, 2) character spans of trained texts in it."""
    parts, spans, at = [], [], 0
    for t in turns:
        head = f"{TURN}{t.role}{TEXT}"
        parts += [head, t.text, END]
        if t.trained:
            spans.append((at + len(head), at + len(head) + len(t.text)))
        at += len(head) + len(t.text) + len(END)
    return "".join(parts), np.array(spans, dtype=np.int64).reshape(-1, 2)


class MarkedEncoder(ByteEncoder):
    """The vocabulary with the marks as special tokens, numbered by the first ids that it leaves free."""

    def __init__(self, path: str):
        super().__init__(path, [TURN, TEXT, END])
        self.sizes = np.zeros(self.core.n_vocab, np.int64)
        for i in {*self.core.token_byte_values(), *(m.encode() for m in self.special)}:
            self.sizes[self.core.encode_single_token(i)] = len(i)

    def with_offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the (n, 2) character spans that they cover; a token inside a character spans it."""
        ids = self.slow(text).astype(np.int64)
        ends = np.cumsum(self.sizes[ids])
        starts = ends - self.sizes[ids]
        if not text.isascii():
            number = np.cumsum(np.frombuffer(text.encode(), np.uint8) & 0xC0 != 0x80) - 1
            starts, ends = number[starts], number[ends - 1] + 1
        return ids, np.stack([starts, ends], axis=1)


@lru_cache(maxsize=2)
def marked(path: str) -> MarkedEncoder:
    return MarkedEncoder(path)


def encode_marked(path: str, runs: list[list[Turn]]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """Formatted text, ids, character offsets and loss mask of each run of turns."""
    for turns in runs:
        text, spans = rendered(turns)
        ids, offsets = marked(path).with_offsets(text)
        yield text, ids, offsets, token_mask(offsets, spans)


FORMATTED = "conv_id long, part int, turns int, formatted string, ids array<int>, loss array<boolean>"
#: A conversation's turns are encoded in runs of about so many characters. Runs end at a mark, where no token straddles, so ids are those of one call.
RUN_CHARS = 1 << 20
#: Characters of runs that are taken together.
BATCH_CHARS = 4 << 20


def _ordered(rows: DataFrame) -> DataFrame:
    """Turns of a conversation together and in order; sorting spills, and readers stream, so no conversation is held whole."""
    spark = ready(rows)
    picked = rows.select(*(rows[c].cast(t).alias(c) for c, t in (("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string"))))
    return picked.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _runs(it: Iterator[pa.RecordBatch], trained: str) -> Iterator[list[tuple[int | None, bool, bool, list[Turn]]]]:
    """(conversation, first run?, last run?, turns) in order, as many together as make some BATCH_CHARS characters."""
    conv, turns, chars, first, any_row = None, [], 0, True, False
    done, total = [], 0
    for batch in batches(it):
        for c, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            ends = any_row and c != conv
            if ends or chars > RUN_CHARS:
                done.append((conv, first, ends, turns))
                total += chars
                turns, chars, first = [], 0, ends
                if total > BATCH_CHARS:
                    yield done
                    done, total = [], 0
            conv, any_row = c, True
            turns.append(turn(role, text, trained))
            chars += len(turns[-1].role) + len(turns[-1].text)
    if any_row:
        done.append((conv, first, True, turns))
    if done:
        yield done


def format_conversations(rows: DataFrame, path: str, trained: str = "assistant") -> DataFrame:
    """Formatted text, ids and loss mask: a row per conversation, or several numbered parts if it is very long.

    Rows with equal ``turn`` go by role and text; repeated rows are repeated turns; null ids are one
    conversation of their own; an empty table gives none; other columns are ignored.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("turns", pa.int32()), ("formatted", pa.string()), ("ids", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_()))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for runs in _runs(it, trained):
            for (conv, first, _, turns), (text, ids, _, mask) in zip(runs, encode_marked(path, [r[3] for r in runs]), strict=True):
                n = 0 if first else n + 1
                yield batch_of(schema, [conv], [n], [len(turns)], [text], [ids.tolist()], [mask.tolist()])

    return _ordered(rows).mapInArrow(run, FORMATTED)


DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def conversation_digests(rows: DataFrame, path: str, trained: str = "assistant") -> DataFrame:
    """What reading the formatted conversations back gives, one row each; cases as in ``format_conversations``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in _runs(it, trained):
            out = []
            for (conv, first, last, _), (text, _, offsets, mask) in zip(runs, encode_marked(path, [r[3] for r in runs]), strict=True):
                if first:
                    turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                chars += len(text)
                for role, said in read_turns(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                learnt = unescape(masked_text(text, offsets, mask))
                loss_chars += len(learnt)
                loss.update(learnt.encode())
                if last:
                    out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if out:
                yield batch_of(DIGESTS, *zip(*out, strict=True))

    return _ordered(rows).mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def with_probe(rows: DataFrame) -> DataFrame:
    """The conversations plus number -7, whose two turns both hold control strings."""
    spark = rows.sparkSession
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return rows.select("conv_id", "turn", "role", "text").unionByName(probe)
