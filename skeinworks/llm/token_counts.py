"""Token counts: exact lengths under a byte-level BPE, without shipping the ids.

The vocabulary file (a parameter) is read by a rank encoder, whose ids equal those of the
``tokenizers`` library on every code point; text is cut at *safe boundaries* (before a space
that a non-space follows, when no other white space precedes it), where the pre-tokenizer's
pattern always ends a token. Of a batch, equal pieces between safe boundaries are encoded once
and gathered by index, so the work follows the number of distinct pieces.

A run of one class of characters (letters, digits, blanks, the rest) is a single piece however long.
Long ones are encoded in windows that meet at *compatible* tokens: two that the encoder gives back
for their joined bytes. A sequence whose neighbours are all compatible is the one that the merges
give, so this is exact, and its time and memory follow the length of the run.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from skeinworks.llm._common import batch_of, batches, ready, spread

#: The published pre-tokenizer pattern of byte-level BPE, and the printable stand-ins it gives to bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: White space after a space: no safe boundary there.
_UNSAFE = re.compile(r" \s")
#: Bytes of texts encoded at a time.
BATCH_BYTES = 16 << 20
#: Characters of a run that is encoded in windows, bytes of a window, and what of one the next may decide anew.
LONG_RUN, WINDOW, TAIL = 512, 512, 128
LETTER, NUMBER, SPACE, REST, UNKNOWN = range(5)


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """The pre-tokenizer's class of each code point; unassigned ones, on which Unicode versions differ, are UNKNOWN and end a run."""
    table = np.full(0x110000, REST, np.uint8)
    for first, last in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(first, last)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+"), (UNKNOWN, r"\p{Cn}+")):
            for m in regex.finditer(pattern, every):
                table[first + m.start() : first + m.end()] = kind
    return table


def long_runs(text: str) -> list[tuple[int, int, int]]:
    """(start, end, class) of each run of more than LONG_RUN characters of one class."""
    if len(text) <= LONG_RUN:
        return []
    kind = character_classes()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    edges = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(kind)]])
    long = np.flatnonzero(np.diff(edges) > LONG_RUN)
    return [(int(edges[i]), int(edges[i + 1]), int(kind[edges[i]])) for i in long if kind[edges[i]] != UNKNOWN]


def byte_symbols() -> dict[str, int]:
    """The stand-in character of each byte: itself if printable, else the next free code point from 256."""
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteEncoder:
    """Ids of whole texts. ``exact(text)`` is the plain encoder; the other methods go piece by piece."""

    def __init__(self, path: str, marks: Iterable[str] = ()):
        """``marks``: further special strings, numbered by the first ids that the vocabulary leaves free."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        of = byte_symbols()
        ranks = {bytes(of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        free = max([*ranks.values(), *self.special.values()]) + 1
        self.special |= {mark: free + i for i, mark in enumerate(marks)}
        self.special_strings = re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)))
        self.core = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.spaced = np.zeros(max([*ranks.values(), *self.special.values()]) + 1, dtype=bool)
        for token, i in ranks.items():
            self.spaced[i] = token[:1] == b" "

    def exact(self, text: str) -> list[int]:
        """The plain encoder, which has no way through very long runs."""
        return self.core.encode(text, allowed_special="all")

    def plain(self, text: str) -> bool:
        """Whether every space is a safe boundary and there are no special strings and no long runs."""
        return not _UNSAFE.search(text) and not any(s in text for s in self.special) and not long_runs(text)

    def slow(self, text: str) -> np.ndarray:
        """Any text, part by part; with long runs special strings apart, and what lies between them."""
        if not long_runs(text):
            return np.concatenate([self.core.encode_to_numpy(part, allowed_special="all").astype("<u4") for part in safe_parts(text)])
        out, at = [], 0
        for m in self.special_strings.finditer(text) if self.special else ():
            out += [self.unbroken(text[at : m.start()]), np.array([self.special[m.group()]], "<u4")]
            at = m.end()
        return np.concatenate([*out, self.unbroken(text[at:])])

    def stretch(self, text: str) -> np.ndarray:
        """A text without long runs."""
        return np.concatenate([self.core.encode_to_numpy(part, disallowed_special=()).astype("<u4") for part in safe_parts(text)])

    def unbroken(self, text: str) -> np.ndarray:
        """A text without special strings.

        A run of blanks is a piece but for its last one, which goes with what follows. A run of another
        class begins as the plain encoder says, given half of LONG_RUN of it, and ends a piece.
        """
        out, at = [], 0
        for start, end, kind in long_runs(text):
            if kind == SPACE:
                cut, stop = start, end - 1 if end < len(text) else end
            else:
                cut, stop = start + LONG_RUN // 2, end
            head = self.stretch(text[at:cut]).tolist()
            found = self.extended(head, len(text[start + 2 : cut].encode()) if kind != SPACE else None, text[cut:stop].encode())
            if found is None:
                return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
            out.append(np.array(found, "<u4"))
            at = stop
        return np.concatenate([*out, self.stretch(text[at:])])

    def extended(self, ids: list[int], soft: int | None, data: bytes) -> list[int] | None:
        """``ids`` with those of ``data``, which goes on their last piece; ``soft`` bytes of it may be decided anew.

        ``soft`` is None if ``data`` is a piece of its own. None if no cut was found (then the library is asked).
        """
        fixed, at, left = len(ids), 0, b""
        own = soft is None
        while True:
            got = self.piece(left + data[at : at + WINDOW])
            joint = None if own and len(ids) == fixed else ids[-1] if ids else None
            if joint is None or self.compatible(joint, got[0]):
                at += WINDOW
                if at >= len(data):
                    return ids + got
                tail = keep = 0
                while keep < len(got) - 1 and tail < TAIL:
                    keep += 1
                    tail += len(self.bytes_of(got[-keep]))
                left = b"".join(map(self.bytes_of, got[len(got) - keep :]))
                ids += got[: len(got) - keep]
            else:
                back = self.bytes_of(ids.pop())
                if len(ids) < fixed:
                    fixed, soft = len(ids), (soft or 0) - len(back)
                    if own or soft < 0:
                        return None
                left = back + left

    @lru_cache(maxsize=1 << 16)  # noqa: B019 (encoders live as long as their process)
    def compatible(self, a: int, b: int) -> bool:
        return self.piece(self.bytes_of(a) + self.bytes_of(b)) == [a, b]

    def bytes_of(self, token: int) -> bytes:
        return self.core.decode_single_token_bytes(token)

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        return self.core._encode_single_piece(data)

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of `" " + piece` for each piece, in one run, and where each begins.

        No piece holds a space, so the ids of one begin at each token that starts with a space.
        """
        ids = self.core.encode_to_numpy(" " + " ".join(pieces)).astype("<u4")
        return ids, np.flatnonzero(self.spaced[ids])

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the offsets of each text's. Equal pieces are encoded once."""
        plain = [self.plain(t) for t in texts]
        slow = [self.slow(t) for t, p in zip(texts, plain, strict=True) if not p]
        some = [t for t, p in zip(texts, plain, strict=True) if p]
        lists = pc.split_pattern(pa.array(some, pa.large_string()), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        index, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        heads, n = sorted({t.split(" ", 1)[0] for t in some}), len(distinct)
        by_head = {h: n + i for i, h in enumerate(heads)}
        full = [i for i, p in enumerate(distinct) if p]
        ids, at = self.pieces([distinct[i] for i in full]) if full else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        start, length = np.zeros(n + len(heads), np.int64), np.zeros(n + len(heads), np.int64)
        start[full], length[full] = at, np.diff(np.append(at, len(ids)))
        tail, end = [ids], len(ids)
        for i, ids in [*((i, self.core.encode_to_numpy(" ")) for i, p in enumerate(distinct) if not p), *((by_head[h], self.core.encode_to_numpy(h)) for h in heads)]:
            start[i], length[i] = end, len(ids)
            tail.append(ids.astype("<u4"))
            end += len(ids)
        index[offsets[:-1]] = [by_head[t.split(" ", 1)[0]] for t in some]
        table, lengths = np.concatenate(tail), length[index]
        ends = np.cumsum(lengths)
        gathered = table[np.repeat(start[index] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[offsets]
        if not slow:
            return gathered, bounds
        fast, rest = iter(np.split(gathered, bounds[1:-1])), iter(slow)
        out = [next(fast) if p else next(rest) for p in plain]
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])


def safe_parts(text: str, limit: int = 1 << 16) -> Iterator[str]:
    """``text`` in parts of some ``limit`` characters, cut before a space between two non-spaces.

    A text without such a place is one part. No special string holds a space, so none is cut.
    """
    at = 0
    while len(text) - at > limit:
        cut = at + limit
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                cut = len(text)
                break
            if not text[cut - 1].isspace() and not text[cut + 1].isspace():
                break
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def balanced(rows: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of rows of about ``limit`` bytes together, whatever the batches they came in."""
    ids, texts, total = [], [], 0
    for batch in batches(rows):
        for i, text, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), pc.binary_length(batch.column(1)).to_pylist(), strict=True):
            ids.append(i)
            texts.append(text or "")
            total += size or 0
            if total >= limit:
                yield ids, texts
                ids, texts, total = [], [], 0
                pa.default_memory_pool().release_unused()
    if ids:
        yield ids, texts


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: the id, UTF-8 bytes, tokens and whether they exceed ``limit``.

    Null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows give
    repeated results; an empty table gives none. Other columns are ignored, whatever their names.
    """
    ready(docs)
    rows = spread(docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text")))

    def lengths(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for ids, texts in balanced(it):
            counts = np.diff(enc.encode_many(texts)[1])
            yield batch_of(SCHEMA, ids, [len(t.encode()) for t in texts], counts, counts > limit)

    return rows.mapInArrow(lengths, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
