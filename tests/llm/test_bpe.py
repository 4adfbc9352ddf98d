from __future__ import annotations

import random

import public_tokenizers
import pytest
import tiktoken

from ebbline.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.tokens, special_tokens={})


def texts():
    rng = random.Random(1)
    any_of = lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x2000), rng.randrange(0x4E00, 0x9000), 10, 32]))
    return [
        None, "", " ", "\n\n  \t x", "I'll  don't 123456789 ½    x\x85", "<|endoftext|>", "a" * 3000, "é" * 700, "日本語テキスト" * 300,
        "😀👍🏽" * 200, "ab" * 2000, "".join(rng.choice("etaoinshrdlu") for _ in range(3000)), "\x00\x01\x7f",
        *["".join(any_of() for _ in range(300)) for _ in range(60)],
    ]


def test_the_same_ids_as_the_library_and_back(spark, vocabulary, library):
    rows = list(enumerate(texts()))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    coded = bpe.decode(bpe.encode(frame, vocabulary), vocabulary).collect()
    want = dict(rows)
    assert len(coded) == len(rows)
    for r in coded:
        text = want[r.doc.doc_id] or ""
        assert r.ids == library.encode_ordinary(text) and bytes(r.decoded) == text.encode()


def test_real_and_awkward_rows(docs, sample, vocabulary, library):
    for table in (docs, sample):
        for r in bpe.decode(bpe.encode(table, vocabulary), vocabulary).collect():
            assert r.ids == library.encode_ordinary(r.doc.text or "") and bytes(r.decoded) == (r.doc.text or "").encode()


def test_empty_table(no_docs, vocabulary):
    assert bpe.decode(bpe.encode(no_docs, vocabulary), vocabulary).collect() == []


def test_memory_of_pieces_is_dropped_and_made_anew(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    encoder = bpe.Encoder(vocabulary)
    for text in ("one two three four five six seven", "seven six five", "one"):
        assert encoder.encode([text, None, text]).to_pylist() == [library.encode_ordinary(text), [], library.encode_ordinary(text)]


def test_merges_are_all_pairs_that_make_a_token(vocabulary):
    small = bpe.Vocabulary({b"a": 0, b"b": 1, b"ab": 3, b"ba": 2, b"aba": 4, b"abab": 5}, "")
    got = {(m["l"], m["r"]): (m["id"], m["safe"]) for m in small.merges.to_pylist()}
    assert got == {(0, 1): (3, True), (1, 0): (2, True), (3, 0): (4, True), (0, 2): (4, True), (3, 3): (5, True), (4, 1): (5, True)}


def test_lower_pairs_that_arise_from_a_merge_come_first(library):
    """ab is merged late, yet abc has a lower rank: merging all of ab at once would be wrong."""
    tokens = {bytes([i]): i for i in range(256)} | {b"bc": 256, b"abc": 257, b"ab": 258, b"abca": 259, b"abab": 260}
    own = bpe.Vocabulary(tokens, r"\S+")
    text = "abcababcabab" * 40
    want = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=tokens, special_tokens={}).encode_ordinary(text)
    assert bpe.Encoder(own).encode([text]).to_pylist() == [want]
