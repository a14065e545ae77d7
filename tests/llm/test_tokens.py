"""Byte-level counts and word BPE against the tokenizers library."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

P = pytest.importorskip("public_tokenizers")

from skeinworks.llm.token_counts import ByteEncoder, safe_parts, token_counts  # noqa: E402
from skeinworks.llm.word_bpe import WordBPE, encode_digests, encode_documents  # noqa: E402

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
CASES = ["", " ", "  ", "a", "Σ ΑΣ", "don't  I'LL\n\n x", "<|endoftext|>a <|endoftext|>", "́a é́", "a" * 500, "İstanbul \x1c\x1d b\x85c", "日本語 テキスト 123", "\x00\x01", "՘Ɤ x", "  lead", "trail ", "tab\t\tx\r\n y", "🙂🙂 🙂", "ab" * 2000]
ALPHABET = st.text(alphabet=st.sampled_from(list("ab the\n  \t'sS.é漢1<|endoftext|>  Σς\x1cͅ#!!")), max_size=60)


@pytest.fixture(scope="module")
def libraries():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD), ByteEncoder(BYTE), WordBPE(WORD)


def test_byte_ids_equal_the_library(libraries):
    lib, _, enc, _ = libraries
    rnd = random.Random(5)
    texts = CASES + ["".join(rnd.choice("ab the\n  \t'sS.é漢1<|endoftext|>  Σς") for _ in range(rnd.randint(0, 60))) for _ in range(500)]
    ids, at = enc.encode_many(texts)
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == lib.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=150, deadline=None)
@given(st.lists(ALPHABET, max_size=4))
def test_word_ids_and_decoding_equal_the_library(libraries, texts):
    _, lib, _, bpe = libraries
    for text, (n, ids, decoded) in zip(texts, bpe.encode_many(texts), strict=True):
        want = lib.encode(text, add_special_tokens=False).ids
        assert (n, ids, decoded) == (len(want), " ".join(map(str, want)), lib.decode(want, skip_special_tokens=False))
        assert bpe.encode(text) == want


def test_backtracking_on_random_words(libraries):
    _, lib, _, bpe = libraries
    rnd = random.Random(3)
    for _ in range(1500):
        word = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(1, 40)))
        assert bpe.word(word) == lib.encode(word, add_special_tokens=False).ids


def test_safe_parts_join_to_the_text(libraries):
    _, _, enc, _ = libraries
    text = "some words <|endoftext|>  and   more\n words " * 50
    parts = list(safe_parts(text, limit=64))
    assert "".join(parts) == text and len(parts) > 5
    assert [i for p in parts for i in enc.exact(p)] == enc.exact(text)


@pytest.mark.parametrize("text", [" " * 5_000_000, "\n" * 5_000_000, "a\n" * 2_500_000, "x" + " \t\n" * 1_500_000 + "y", "it'" + "s" * 3_000_000 + "'s", "-=" * 1_000_000 + "<|endoftext|>" + "\u3000" * 900_000 + "z"])
def test_very_long_runs_equal_the_library(libraries, text):
    lib, _, enc, _ = libraries
    assert enc.encode_many([text, "a b"])[0].tolist() == lib.encode(text, add_special_tokens=False).ids + lib.encode("a b", add_special_tokens=False).ids


def test_a_long_text_without_blanks_and_a_batch_of_long_texts(libraries):
    lib, _, enc, _ = libraries
    rnd = random.Random(7)
    word = "".join(rnd.choices("etaoinshrdlu", k=20_000_000))
    assert enc.encode_many([word])[0].tolist() == lib.encode(word, add_special_tokens=False).ids
    several = ["".join(rnd.choices(["the ", "cat\n", "漢字", "x" * 600, "  "], k=400_000 // 20)) * 4 for _ in range(5)]
    ids, at = enc.encode_many(several)
    for i, text in enumerate(several):
        assert ids[at[i] : at[i + 1]].tolist() == lib.encode(text, add_special_tokens=False).ids


def test_windows_of_long_runs_meet_at_compatible_tokens(libraries):
    lib, _, enc, _ = libraries
    rnd = random.Random(11)
    kinds = [lambda: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(1, 1500))), lambda: "".join(rnd.choices(" \n\t\r\u3000", k=rnd.randint(1, 900))), lambda: "".join(rnd.choices("=-_*#'", k=rnd.randint(1, 900))),
             lambda: "".join(rnd.choices("0123456789", k=rnd.randint(1, 900))), lambda: "'s", lambda: "<|endoftext|>", lambda: "".join(rnd.choices("中文字é", k=rnd.randint(1, 700))), lambda: "theandofto" * rnd.randint(1, 100)]
    for _ in range(200):
        text = "".join(rnd.choice(kinds)() for _ in range(rnd.randint(0, 7)))
        assert enc.encode_many([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids


def test_queries_cover_nulls_repeats_and_other_columns(spark, libraries):
    lib, word, _, _ = libraries
    rows = [(1, "Hello world", "x"), (1, "Hello world", "y"), (2, None, None), (None, "", "z"), (3, "b " * 3000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, BYTE).collect())
    want = sorted((i or 0, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t, _ in rows)
    assert got == want
    digests = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_digests(docs, WORD).collect())
    expect = []
    for i, t, _ in rows:
        ids = word.encode(t or "", add_special_tokens=False).ids
        expect.append((i or 0, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(word.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert digests == sorted(expect)
    assert token_counts(docs.limit(0), BYTE).count() == 0 and encode_digests(docs.limit(0), WORD).count() == 0
    assert {tuple(r.ids) for r in encode_documents(docs.where("doc_id = 1"), WORD).collect()} == {tuple(word.encode("Hello world", add_special_tokens=False).ids)}
