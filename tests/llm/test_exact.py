from __future__ import annotations

import hashlib
import re

import pytest

from ebbline.llm import exact


def slow(rows):
    """rows: (doc_id, text); the same as sorted tuples."""
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    out = []
    for (i, text), n in zip(rows, norm):
        group = [(j, t) for (j, t), m in zip(rows, norm) if m == n]
        best = max(group, key=lambda g: (len(g[1] or ""), g[0] is not None, -(g[0] or 0)))
        out.append((i, best[0], len(group), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("moduli", [exact.MODULI, (3, 2)])
def test_groups_match_brute_force_even_when_fingerprints_collide(docs, moduli):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = exact.exact_groups(docs, moduli).select("doc.doc_id", "keep_id", "group_size", "text_sha256", "kept").collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == slow(rows)
    # One row of each group stays.
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_real_documents(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    got = exact.exact_groups(sample).select("doc.doc_id", "keep_id", "group_size", "text_sha256").collect()
    assert sorted((tuple(r) for r in got), key=repr) == slow(rows)


def test_empty_table(no_docs):
    assert exact.exact_groups(no_docs).collect() == []


def test_chunks_combine_to_the_value_of_the_whole():
    text = bytes(range(1, 256)) * 700
    for base, modulus in zip(exact.BASES, exact.MODULI):
        table = exact.powers(base, modulus, exact.CHUNK)
        value = 0
        for at in range(0, len(text), exact.CHUNK):
            part = text[at : at + exact.CHUNK]
            value = (value * int(table[len(part)]) + exact.chunk_value(part, table, modulus)) % modulus
        want = 0
        for b in text:
            want = (want * base + b) % modulus
        assert value == want


def test_texts_of_several_chunks(spark):
    long = "abc d" * 60_000
    rows = [(1, long), (2, long + "!"), (3, long.replace(" ", "\n")), (4, "!" + long), (5, long[:-1] + "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for moduli in (exact.MODULI, (2, 2)):
        got = exact.exact_groups(frame, moduli).select("doc.doc_id", "keep_id", "group_size", "text_sha256").collect()
        assert sorted((tuple(r) for r in got), key=repr) == slow(rows)
