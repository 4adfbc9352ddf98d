from __future__ import annotations

import zlib

import numpy as np

from ebbline.llm import langid


def test_held_out_documents_get_their_language(spark, sample):
    got = {r.doc_id: r for r in langid.identify(sample.select("doc_id", "text", "lang")).collect()}
    truth = {r.doc_id: r for r in sample.collect()}
    assert got.keys() == truth.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out and len(truth[i].text) > 40]
    assert len(held) > 20 and np.mean([got[i].lang_pred == truth[i].lang for i in held]) > 0.97


def test_awkward_rows(docs, no_docs):
    got = langid.identify(docs).collect()
    texts = sorted((r.text for r in docs.collect()), key=repr)
    assert len(got) == len(texts)
    none = [r for r in got if r.lang_pred == "und"]
    assert len(none) == sum(not any(c.isalpha() for c in t or "") for t in texts) and all(r.score == 0 for r in none)
    assert {r.lang_pred for r in got} == {"und", "en"}
    assert langid.identify(no_docs).collect() == []


def test_nothing_learned_means_undetermined(docs):
    from pyspark.sql import functions as F

    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_bundles_are_sums_of_bound_rotated_letters():
    memory = langid.Memory(64)
    keys, shares = langid.grams("Ab-ab")
    assert [tuple(chr(k >> s & 0x1FFFFF) for s in (42, 21, 0)) for k in keys.tolist()] == [("\0", "a", "b"), ("a", "b", "\0"), ("b", "\0", "a")]
    vector = lambda c: langid.letter_vector(ord(c), 64).astype(int)
    want = sum(
        w * vector(a) * np.roll(vector(b), 1) * np.roll(vector(c), 2)
        for w, (a, b, c) in zip(shares, [("\0", "a", "b"), ("a", "b", "\0"), ("b", "\0", "a")])
    )
    assert np.allclose(memory.bundle(keys, shares), want)


def test_prototypes_do_not_depend_on_partitions_or_memory(sample, monkeypatch):
    rows = sample.select("text", "lang")
    one = langid.train(rows.repartition(1), 128)
    monkeypatch.setattr(langid, "REMEMBERED", 100)
    many = langid.train(rows.repartition(5), 128)
    assert list(one) == list(many) and all(np.allclose(one[k], many[k], atol=1e-5) for k in one)
