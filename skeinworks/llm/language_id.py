"""Language identification by a byte convolutional network.

Filters of several widths run over the bytes of fixed-length windows; their largest outputs go to a
softmax. It is trained in numpy on a bounded sample of labelled texts and applied to every window
of every text; a text's class comes from its windows' mean scores, weighted by letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks.llm._common import batch_of, batches, bounded_sample, give_back, ready, spread
from skeinworks.llm.token_counts import balanced

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bounds of the training sample: texts, and windows of each.
SAMPLE_TEXTS, SAMPLE_WINDOWS = 4000, 2
#: Windows scored at a time.
BLOCK = 2048
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def windows(data: bytes) -> np.ndarray:
    """Bytes as rows of a window each, the last filled up with spaces; no row for no bytes."""
    rows = -(-len(data) // WINDOW)
    return np.frombuffer(data.ljust(rows * WINDOW, b" "), dtype=np.uint8).reshape(rows, WINDOW)


def letters(block: np.ndarray) -> np.ndarray:
    """Letter bytes of each window: small ASCII letters (text is folded) and all of multi-byte characters."""
    return ((block >= 97) & (block <= 122) | (block >= 128)).sum(axis=1)


@dataclass
class ByteConvNet:
    classes: list[str]
    taps: dict[int, np.ndarray] = field(default_factory=dict)  # width -> (width, 256, FILTERS)
    bias: dict[int, np.ndarray] = field(default_factory=dict)
    out: np.ndarray | None = None  # (len(WIDTHS) * FILTERS, classes)
    out_bias: np.ndarray | None = None
    pairs: dict | None = None

    @classmethod
    def fresh(cls, classes: list[str], seed: int = 7) -> ByteConvNet:
        rng = np.random.default_rng(seed)
        net = cls(classes)
        for w in WIDTHS:
            net.taps[w] = rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32)
            net.bias[w] = np.zeros(FILTERS, np.float32)
        net.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        net.out_bias = np.zeros(len(classes), np.float32)
        return net

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, size: int = 64, rate: float = 0.01, seed: int = 7) -> None:
        """Adam on cross entropy; the gradient of a pooled filter goes to the bytes under its largest output."""
        rng = np.random.default_rng(seed)
        params = [*(self.taps[w] for w in WIDTHS), *(self.bias[w] for w in WIDTHS), self.out, self.out_bias]
        m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), size):
                rows = order[at : at + size]
                block, n = x[rows], len(rows)
                pooled, places = [], []
                for w in WIDTHS:
                    act = sum(self.taps[w][k][block[:, k : WINDOW - w + 1 + k]] for k in range(w))
                    place = act.argmax(axis=1)
                    pooled.append(np.maximum(np.take_along_axis(act, place[:, None], 1)[:, 0] + self.bias[w], 0))
                    places.append(place)
                hidden = np.concatenate(pooled, axis=1)
                p = softmax(hidden @ self.out + self.out_bias)
                p[np.arange(n), y[rows]] -= 1
                p /= n
                grads = [np.zeros_like(q) for q in params]
                grads[-2], grads[-1] = hidden.T @ p, p.sum(axis=0)
                back = (p @ self.out.T) * (hidden > 0)
                for i, w in enumerate(WIDTHS):
                    g = back[:, i * FILTERS : (i + 1) * FILTERS]
                    grads[len(WIDTHS) + i] = g.sum(axis=0)
                    for k in range(w):
                        under = np.take_along_axis(block, places[i] + k, axis=1)
                        np.add.at(grads[i][k], (under, np.arange(FILTERS)[None, :].repeat(n, 0)), g)
                t += 1
                for q, g, a, b in zip(params, grads, m, v, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    q -= rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)

    def tables(self) -> dict:
        """Sums of two neighbouring taps by byte pair, so that a width takes half the look-ups."""
        if self.pairs is None:
            self.pairs = {w: [(t[k][:, None] + t[k + 1][None, :]).reshape(65536, FILTERS) if k + 1 < w else t[k] for k in range(0, w, 2)] for w, t in self.taps.items()}
        return self.pairs

    def logits(self, block: np.ndarray) -> np.ndarray:
        wide = block.astype(np.int64)
        pair = wide[:, :-1] * 256 + wide[:, 1:]
        pooled = []
        for w in WIDTHS:
            act = None
            for i, table in enumerate(self.tables()[w]):
                index = (pair if len(table) > 256 else wide)[:, 2 * i : 2 * i + WINDOW - w + 1]
                got = table.take(index, axis=0)
                act = got if act is None else np.add(act, got, out=act)
            pooled.append(np.maximum(act.max(axis=1) + self.bias[w], 0))
        return np.concatenate(pooled, axis=1) @ self.out + self.out_bias

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Class and probability of each text; ``und`` and 0 for one without a letter."""
        rows = [windows(t.lower().encode()) if has_letter(t) else windows(b"") for t in texts]
        counts = np.array([len(r) for r in rows])
        total = np.zeros((len(texts), len(self.classes)))
        weight = np.zeros(len(texts))
        if counts.sum() and self.classes:
            owner, every = np.repeat(np.arange(len(texts)), counts), np.concatenate(rows)
            for at in range(0, len(every), BLOCK // 8):
                block, own = every[at : at + BLOCK // 8], owner[at : at + BLOCK // 8]
                w = letters(block) + 1e-3
                np.add.at(total, own, self.logits(block) * w[:, None])
                np.add.at(weight, own, w)
        out = []
        for n, t, w in zip(counts.tolist(), total, weight.tolist(), strict=True):
            if not n or not self.classes:
                out.append((UNKNOWN, 0.0))
                continue
            p = softmax(t[None] / w)[0]
            out.append((self.classes[int(p.argmax())], float(p.max())))
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(docs: DataFrame, learn: Column | None = None, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", texts: int = SAMPLE_TEXTS, windows_each: int = SAMPLE_WINDOWS) -> ByteConvNet:
    """A network fitted on at most ``texts`` labelled texts (rows where ``learn`` holds), one of each id, ``windows_each`` windows of each.

    Rows with null text or label, or without bytes, take no part; of several under an id the one of
    the least hash does; without any row left the network knows no class.
    """
    ready(docs)
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"), docs[label_column].cast("string").alias("lang"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    if learn is not None:
        rows = rows.where(learn)
    ids = bounded_sample(rows.select("doc_id"), "doc_id", texts)
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("lang", pa.string()), ("windows", pa.binary())])

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            out = []
            for i, text, lang, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = windows(text.lower().encode())
                block = block[letters(block) * 4 > WINDOW] if len(block) > 1 else block
                places = sorted({len(block) * j // windows_each for j in range(windows_each)}) if len(block) else []
                out.append((i, digest, lang, block[places].tobytes()))
            yield batch_of(schema, *zip(*out, strict=True))

    sample = rows.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", "text", "lang", F.xxhash64("lang", "text").alias("digest")).mapInArrow(cut, "doc_id long, digest long, lang string, windows binary")
    one = sample.groupBy("doc_id").agg(F.min_by(F.struct("lang", "windows"), "digest").alias("x")).select("doc_id", "x.*")
    got = [(r.lang, bytes(r.windows)[k : k + WINDOW]) for r in sorted(one.collect(), key=lambda r: r.doc_id) for k in range(0, len(r.windows), WINDOW)]
    classes = sorted({lang for lang, _ in got})
    net = ByteConvNet.fresh(classes)
    if classes:
        x = np.frombuffer(b"".join(window for _, window in got), dtype=np.uint8).reshape(-1, WINDOW)
        net.fit(x, np.array([classes.index(lang) for lang, _ in got]))
        give_back()
    return net


SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def identify(docs: DataFrame, net: ByteConvNet, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Class and score of every whole text: ``doc_id, lang_pred, score``.

    Null, empty or letterless text gives ``und`` and 0; null ids stay; repeated rows repeat; an
    empty table gives none; other columns are ignored.
    """
    ready(docs)
    rows = spread(docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text")))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in balanced(it, 4 << 20):
            got = net.predict(texts)
            yield batch_of(SCHEMA, ids, [p for p, _ in got], [s for _, s in got])

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, net: ByteConvNet, least: float = 0.3, text_column: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose text has a letter and a class of probability ``least`` or more."""
    ready(docs)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            got = net.predict([t or "" for t in batch.column(batch.schema.get_field_index(text_column)).to_pylist()])
            yield batch.filter(pa.array([p != UNKNOWN and s >= least for p, s in got]))

    return docs.mapInArrow(run, docs.schema)
