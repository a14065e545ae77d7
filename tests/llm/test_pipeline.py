"""The pipeline's stages on the smallest tables, each against a plain reading of its rule."""

import re
from collections import defaultdict

import pytest

pytest.importorskip("public_tokenizers")
cp = pytest.importorskip("corpus_pipeline")

from skeinworks.llm.queries import vocabulary  # noqa: E402
from skeinworks.llm.token_counts import ByteEncoder  # noqa: E402
from skeinworks.session import materialise  # noqa: E402

SF = "/root/testdata/sf0.001"


def shingles(text, n=5):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    return frozenset(tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))) if ws else frozenset()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    kept = []
    for name, stage in cp.STAGES:
        docs = materialise(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns
            kept.append({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
            assert kept[-1].items() <= before.items()
    language, clean, single = kept
    assert set(before) - set(language) == {i for i, t in before.items() if not re.search(r"[^\W\d_]", t or "")}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    dropped = set(language) - set(clean)
    assert sum(labels.get(i, 1) for i in dropped) >= 0.8 * len(dropped)
    # Near duplicates: the first of each group linked by 0.8 of their shingles.
    sets = {i: shingles(t or "") for i, t in clean.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert set(single) == {i for i in sets if root(i) == i}
    pieces = defaultdict(int)
    for r in docs.collect():
        pieces[r.doc_id] += r.length
    enc = ByteEncoder(vocabulary("byte_bpe_50k.json"))
    assert dict(pieces) == {i: len(enc.exact(t or "")) + 1 for i, t in single.items()}
