"""Toxicity scores by a counterfactual-regularised classifier.

A text's features are its distinct words and their beginnings. Those that tell the labels apart are
kept, and a logistic model is fitted with a second penalty: in labelled sentences that mention a group,
the mention is swapped for others of its kind and the change of the score is penalised, so that a
neutral mention does not move it. A score needs one look at each distinct word of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks.llm._common import batch_of, batches, bounded_sample, give_back, ready, spread
from skeinworks.llm.token_counts import balanced

#: Neutral group mentions, those of a line in one language and form; each is swapped for the next of its line.
IDENTITY_TERMS = """
women men girls boys muslims christians jews hindus buddhists atheists immigrants refugees gays lesbians blacks whites asians latinos africans europeans americans arabs
woman man girl boy muslim christian jew hindu buddhist atheist immigrant refugee gay lesbian latino african european american arab
black white asian jewish disabled elderly
femmes filles musulmanes juives chrétiennes immigrées réfugiées
hommes garçons musulmans juifs chrétiens immigrés réfugiés
femme fille musulmane juive chrétienne immigrée réfugiée
homme garçon musulman juif chrétien immigré réfugié
frauen männer muslime juden christen einwanderer flüchtlinge
frau mann muslim jude christ
muslimisch jüdisch christlich
mujeres musulmanas judías cristianas refugiadas
hombres musulmanes judíos cristianos inmigrantes refugiados
mujer musulmana judía cristiana refugiada
hombre musulmán judío cristiano inmigrante refugiado
"""
#: Bounds: labelled texts in the sample, features in the model.
SAMPLE_TEXTS, FEATURES = 4000, 4000
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def features(word: str) -> list[int]:
    """32-bit digests of the word and of its beginnings of 4 to 9 letters (marked by a trailing star)."""
    return [crc32(f.encode()) for f in (word, *(word[:n] + "*" for n in range(4, min(len(word), 9) + 1)))]


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass
class ToxicModel:
    weights: dict[int, float] = field(default_factory=dict)
    bias: float = -20.0

    def telling(self, word: str) -> tuple[int, ...]:
        """The word's features that the model has."""
        return tuple(f for f in features(word) if f in self.weights)

    def score(self, found: Iterable[int]) -> float:
        """Of a text's set of features."""
        z = self.bias + sum(sorted(self.weights[f] for f in found))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def score_many(self, texts: list[str]) -> list[float]:
        """Equal pieces of the batch are looked at once; only telling ones are gathered by text."""
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        offsets = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        hits = [tuple(sorted({f for w in _WORD.findall(p.lower()) for f in self.telling(w)})) for p in coded.dictionary.to_pylist()]
        index = coded.indices.to_numpy()
        at = np.flatnonzero(np.array([bool(h) for h in hits], dtype=bool)[index]) if hits else np.zeros(0, np.int64)
        found: list[set[int]] = [set() for _ in texts]
        for row, piece in zip((np.searchsorted(offsets, at, side="right") - 1).tolist(), index[at].tolist(), strict=True):
            found[row].update(hits[piece])
        return [self.score(f) for f in found]


def swaps(lines: str = IDENTITY_TERMS) -> dict[str, str]:
    """What each term is swapped for: the next of its line, so that a line's terms are all held alike. A term of two lines counts in the first."""
    of: dict[str, str] = {}
    for line in lines.split("\n"):
        terms = line.split()
        if len(terms) > 1:
            for term, other in zip(terms, [*terms[1:], terms[0]], strict=True):
                of.setdefault(term, other)
    return of


def digests(found: Iterable[str]) -> np.ndarray:
    """The features of some words, sorted, each once."""
    return np.unique(np.array([f for w in found for f in features(w)], dtype=np.uint32))


def pairs_of(text: str, known: dict[str, str]) -> list[tuple[bytes, bytes]]:
    """For each sentence with group mentions, the features that swapping takes away and brings in; each pair once."""
    out = {}
    for sentence in _SENTENCE.findall(text.lower()):
        found = set(_WORD.findall(sentence))
        if found & known.keys():
            before, after = digests(found), digests(known.get(w, w) for w in found)
            out[np.setdiff1d(before, after).tobytes(), np.setdiff1d(after, before).tobytes()] = None
    return list(out)


def fit(texts: list[tuple[np.ndarray, int]], pairs: list[tuple[np.ndarray, np.ndarray]], kept: Iterable[str] = (), balance: float = 10.0, ridge: float = 2.5e-6, least: int = 3, steps: int = 2000) -> ToxicModel:
    """``texts``: features and label; ``pairs``: features that a swap takes away and brings in; ``kept``: words in the model in any case.

    Minimises mean log loss + ``ridge`` |w|² + ``balance`` mean (score change of pairs)², on log-odds scores.
    """
    n1 = sum(y for _, y in texts)
    n0 = len(texts) - n1
    if not n1 or not n0:
        return ToxicModel(bias=20.0 if n1 else -20.0)
    of = [found for found, _ in texts]
    y = np.array([label for _, label in texts], dtype=float)
    ids1, k1 = np.unique(np.concatenate([f for f, label in zip(of, y, strict=True) if label]), return_counts=True)
    ids0, k0 = np.unique(np.concatenate([f for f, label in zip(of, y, strict=True) if not label]), return_counts=True)
    at = np.minimum(np.searchsorted(ids0, ids1), max(len(ids0) - 1, 0))
    other = np.where(ids0[at] == ids1, k0[at], 0) if len(ids0) else np.zeros(len(ids1))
    p1, p0 = (k1 + 0.1) / (n1 + 0.2), (other + 0.1) / (n0 + 0.2)
    z = (p1 - p0) / np.sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0 + 1e-12)
    good = np.flatnonzero((k1 + other >= least) & (z > 1.6) & (p1 > p0 * 4.5))
    chosen = np.union1d(ids1[good[np.lexsort((ids1[good], -z[good]))][:FEATURES]], digests(kept) if pairs else np.zeros(0, np.uint32))

    def matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Row and column of each feature that was chosen."""
        lengths, every = [len(x) for x in rows], np.concatenate([*rows, np.zeros(0, np.uint32)]).astype(np.uint32)
        col = np.searchsorted(chosen, every)
        hit = (col < len(chosen)) & (chosen[np.minimum(col, max(len(chosen) - 1, 0))] == every) if len(chosen) else np.zeros(len(every), bool)
        return np.repeat(np.arange(len(rows)), lengths)[hit], col[hit]

    r, c = matrix(of)
    (ra, ca), (rb, cb) = matrix([a for a, _ in pairs]), matrix([b for _, b in pairs])
    w, b = np.zeros(len(chosen)), float(np.log(n1 / n0))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        z = np.bincount(r, w[c], minlength=len(y)) + b
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.bincount(c, e[r], minlength=len(w)) + 2 * ridge * w
        if pairs:
            change = np.bincount(rb, w[cb], minlength=len(pairs)) - np.bincount(ra, w[ca], minlength=len(pairs))
            change *= 2 * balance / len(pairs)
            g = g + np.bincount(cb, change[rb], minlength=len(w)) - np.bincount(ca, change[ra], minlength=len(w))
        grad = np.append(g, e.sum())
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-10)
        w, b = w - step[:-1], b - step[-1]
    return ToxicModel({int(f): float(x) for f, x in zip(chosen, w, strict=True) if abs(x) > 1e-3}, float(b))


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", texts: int = SAMPLE_TEXTS, terms: str = IDENTITY_TERMS) -> ToxicModel:
    """A model fitted on at most ``texts`` labelled rows (those where ``learn`` holds on ``doc_id``), one of each id.

    Null labels and ids take no part; an id labelled twice counts as toxic if one label says so; of
    several texts under an id the one of the least hash is learnt; null text is empty. Without both
    classes the model gives every text the class there is (0 if none). What reaches the driver are the
    sampled texts' features, 4 bytes each.
    """
    ready(docs)
    marked = labels.select(labels[id_column].cast("long").alias("doc_id"), labels[label_column].cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    if learn is not None:
        marked = marked.where(learn)
    sample = bounded_sample(marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id", texts)
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    known = swaps(terms)
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("digest", pa.int64()), ("found", pa.binary()), ("away", pa.list_(pa.binary())), ("added", pa.list_(pa.binary()))])

    def gather(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            ids, said, toxic, digest = (c.to_pylist() for c in batch.columns)
            pairs = [pairs_of(t, known) for t in said]
            yield batch_of(schema, ids, toxic, digest, [digests(words(t)).tobytes() for t in said], [[a for a, _ in p] for p in pairs], [[b for _, b in p] for p in pairs])

    each = rows.select("doc_id", "text", "toxic", F.xxhash64("text").alias("digest")).mapInArrow(gather, "doc_id long, toxic int, digest long, found binary, away array<binary>, added array<binary>")
    one = each.groupBy("doc_id").agg(F.min_by(F.struct("toxic", "found", "away", "added"), "digest").alias("x"))
    got = sorted(one.select("doc_id", "x.*").collect(), key=lambda x: x.doc_id)
    array = lambda data: np.frombuffer(bytes(data), np.uint32)
    pairs = [(array(a), array(b)) for x in got for a, b in zip(x.away, x.added, strict=True)]
    model = fit([(array(x.found), min(x.toxic, 1)) for x in got], pairs, known)
    del got, pairs
    give_back()
    return model


SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def toxicity(docs: DataFrame, model: ToxicModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text; null text is empty, whose score is the model's base rate.

    Null ids stay; repeated rows repeat; an empty table gives none; other columns are ignored.
    """
    ready(docs)
    rows = spread(docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text")))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in balanced(it):
            yield batch_of(SCHEMA, ids, model.score_many(texts))

    return rows.mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: ToxicModel, limit: float = 0.7, text_column: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose text scores below ``limit``."""
    ready(docs)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            scores = model.score_many([t or "" for t in batch.column(batch.schema.get_field_index(text_column)).to_pylist()])
            yield batch.filter(pa.array([s < limit for s in scores]))

    return docs.mapInArrow(run, docs.schema)
