"""BPE encoding and decoding with word ends: a backtracking encoder and an offset-table decoder.

A word is read by an Aho-Corasick automaton of all tokens, which gives the longest token at
each place. The encoder walks from the left, takes the longest token that may follow the last
one (the pair-compatibility test undoes merges on both sides of the seam and looks for one that
would have come first), tries the next shorter prefix otherwise, and steps back where none
fits; places given up are marked, so each is visited a bounded number of times. The result is
that of applying all merges in rank order.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from skeinworks.llm._common import batch_of, batches, ready, spread
from skeinworks.llm.token_counts import balanced, byte_symbols

#: Words kept by a worker.
CACHE_WORDS = 600_000
#: Longer texts go alone: the joined ids of a batch are one Arrow array of at most 2 GB, and a character is 4 bytes, so 4 ids of 6 digits, at most.
HUGE = 1 << 26


class WordBPE:
    def __init__(self, path: str):
        import ahocorasick
        import regex

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"]
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.names = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = token
        self.pattern = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        # A word is a string of symbols: a byte's stand-in, or its word-final form, shifted by LAST.
        self.stand_in = {b: c for c, b in byte_symbols().items()}
        self.trie = ahocorasick.Automaton()
        self.length = np.zeros(size, dtype=np.int64).tolist()
        self.split = [(i, i) for i in range(size)]
        self.pairs: dict[tuple[int, int], int] = {}
        for pair in model["merges"]:
            left, right = (vocab[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            merged = vocab[self.names[left] + self.names[right]]
            self.pairs[left, right] = merged
            self.split[merged] = (left, right)
        for token, i in vocab.items():
            if token not in self.special:
                key = self.symbols(token)
                self.length[i] = len(key)
                self.trie.add_word(key, i)
        self.trie.make_automaton()
        self.shorter: dict[int, int] = {}
        for token, i in vocab.items():
            if token in self.special:
                continue
            key = self.symbols(token)
            for n in range(len(key) - 1, 0, -1):
                if (j := self.trie.get(key[:n], None)) is not None:
                    self.shorter[i] = j
                    break
        self.fits: dict[tuple[int, int], bool] = {}
        # Decoding table: all tokens' text in one string, with each token's offset.
        self.blob = "".join(self.names)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.names])]).tolist()
        self.cut_special = re.compile("(" + "|".join(re.escape(s) for s in self.special) + ")") if self.special else None
        self.words: dict[str, list[int]] = {}

    LAST = 0x1000

    def symbols(self, token: str) -> str:
        if token.endswith(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + self.LAST)
        return token

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their text is merged in rank order."""
        key = (left, right)
        if (known := self.fits.get(key)) is not None:
            return known
        bound, ok = len(self.names) + 1, True
        while True:
            merged = self.pairs.get((left, right))
            if merged is not None and merged < bound:
                ok = False
                break
            # Undo the later of the two last merges at the seam; with none left to undo, nothing joins.
            undo_left = left > right
            for side in (undo_left, not undo_left):
                if side and self.split[left][1] != left:
                    bound, left = left, self.split[left][1]
                    break
                if not side and self.split[right][0] != right:
                    bound, right = right + 1, self.split[right][0]
                    break
                bound = left if side else right + 1
            else:
                break
        if len(self.fits) > 500_000:
            self.fits.clear()
        self.fits[key] = ok
        return ok

    def word(self, text: str) -> list[int]:
        """Ids of one pre-token (already normalised)."""
        word = text if text.isascii() and text.isprintable() else "".join(map(self.stand_in.__getitem__, text.encode()))
        word = word[:-1] + chr(ord(word[-1]) + self.LAST)
        longest, size = [-1] * len(word), self.length
        for end, token in self.trie.iter(word):
            start = end - size[token] + 1
            if longest[start] < 0 or size[token] > size[longest[start]]:
                longest[start] = token
        ids: list[int] = []
        given_up = bytearray(len(word) + 1)
        at, token = 0, longest[0]
        while at < len(word):
            end = at + size[token]
            if not given_up[end] and (not ids or self.compatible(ids[-1], token)):
                ids.append(token)
                at = end
                token = longest[at] if at < len(word) else -1
            elif token in self.shorter:
                token = self.shorter[token]
            else:
                given_up[at] = 1
                token = ids.pop()
                at -= size[token]
        return ids

    def piece(self, raw: str) -> list[int]:
        """Ids of text without white space: normalised, split by the pattern, encoded word by word."""
        if raw.isascii():
            text = raw.lower()
            if text.isalpha():
                return self.learnt(text)
        else:
            if any(unicodedata.category(c) == "Cn" for c in raw):
                return library(self.path).encode(raw, add_special_tokens=False).ids  # letters of a newer Unicode than Python's
            text = unicodedata.normalize("NFC", raw).replace("Σ", "σ").lower()
        return [i for w in self.pattern.findall(text) for i in self.learnt(w)]

    def learnt(self, word: str) -> list[int]:
        if (ids := self.words.get(word)) is None:
            ids = self.word(word)
            if len(word) < 64:
                self.words[word] = ids
            if len(self.words) > CACHE_WORDS:
                self.words.clear()
        return ids

    def encode(self, text: str) -> list[int]:
        """Any text: special strings first, then pieces between white space."""
        ids: list[int] = []
        for n, segment in enumerate(self.cut_special.split(text) if self.cut_special else [text]):
            if n % 2:
                ids.append(self.special[segment])
            else:
                for raw in re.split(r"[ \t-\r]+", segment):
                    ids += self.piece(raw)
        return ids

    def encode_many(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """For each text: the number of ids, the ids as decimals and the decoded tokens, joined by one space.

        Equal pieces of the batch are encoded once; texts with special strings go one by one.
        """
        odd = [len(t) > HUGE or bool(self.cut_special and self.cut_special.search(t)) for t in texts]
        lists = pc.ascii_split_whitespace(pa.array([t for t, o in zip(texts, odd, strict=True) if not o], pa.large_string()))
        offsets = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        got = [self.piece(p) for p in coded.dictionary.to_pylist()]
        counts = np.array([len(x) for x in got], dtype=np.int64)[index]
        full = counts > 0
        index, kept = index[full], np.concatenate([[0], np.cumsum(full)])[offsets]
        totals = np.diff(np.concatenate([[0], np.cumsum(counts)])[offsets])

        def joined(strings: list[str]) -> list[str]:
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), pa.array(strings, pa.string()).take(pa.array(index))), " ").to_pylist()

        many = zip(totals.tolist(), joined([" ".join(map(str, x)) for x in got]), joined([self.decode(x) for x in got]), strict=True)
        for text, o in zip(texts, odd, strict=True):
            if o:
                ids = self.encode(text)
                yield len(ids), " ".join(map(str, ids)), self.decode(ids)
            else:
                yield next(many)

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by one space, cut from the table by offset; an unknown id gives nothing."""
        at, blob = self.offsets, self.blob
        return " ".join(blob[at[i] : at[i + 1]] for i in ids if 0 <= i < len(self.names))


@lru_cache(maxsize=2)
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBPE:
    return WordBPE(path)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded`` text per input row; null text is empty.

    Null ids stay, repeated rows repeat, an empty table gives none; other columns are ignored.
    """
    ready(docs)
    rows = spread(docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text")))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches(it):
            ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
            yield batch_of(schema, batch.column(0), ids, [bpe.decode(x) for x in ids])

    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per input row: number of ids, digest of the decimal ids and of the decoded text.

    Cases as in ``encode_documents``. Ids are digested where they are made and never leave the worker.
    """
    ready(docs)
    rows = spread(docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text")))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for ids, texts in balanced(it):
            rows = [(n, sha(a), sha(b)) for n, a, b in bpe.encode_many(texts)]
            yield batch_of(SCHEMA, ids, *zip(*rows, strict=True))

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
