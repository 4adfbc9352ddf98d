from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from ebbline.llm import hmm


def chain(states, rng, base):
    start, move = rng.random(states), rng.random((states, states))
    return hmm.Chain(start / start.sum(), move / move.sum(axis=1, keepdims=True), np.zeros(states), np.zeros(states), base)


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_recursions_match_sums_over_all_state_sequences(monkeypatch, chunk):
    import itertools

    monkeypatch.setattr(hmm, "CHUNK", chunk)
    rng = np.random.default_rng(4)
    lengths = np.array([1, 5, 2, 7, 1])
    b = rng.random((lengths.sum(), 3)) * 1e-3
    model = chain(3, rng, None)
    logs = hmm.likelihoods(b, lengths, model)
    gamma, moves, first = hmm.expectations(b, lengths, model)
    want_moves, want_first, at = np.zeros((3, 3)), np.zeros(3), 0
    for d, n in enumerate(lengths):
        own, total, share = b[at : at + n], 0.0, np.zeros((n, 3))
        pairs, heads = np.zeros((3, 3)), np.zeros(3)
        for path in itertools.product(range(3), repeat=int(n)):
            p = model.start[path[0]] * own[0, path[0]]
            for t in range(1, n):
                p *= model.move[path[t - 1], path[t]] * own[t, path[t]]
            total += p
            heads[path[0]] += p
            for t in range(n):
                share[t, path[t]] += p
                if t:
                    pairs[path[t - 1], path[t]] += p
        assert math.isclose(logs[d], math.log(total), rel_tol=1e-9)
        assert np.allclose(gamma[at : at + n], share / total)
        want_moves += pairs / total
        want_first += heads / total
        at += n
    assert np.allclose(moves, want_moves) and np.allclose(first, want_first)


def test_long_sequences_do_not_underflow():
    rng = np.random.default_rng(5)
    model = chain(4, rng, None)
    b = rng.random((20_001, 4)) * 1e-9
    logs = hmm.likelihoods(b, np.array([20_000, 1]), model)
    alpha, want = model.start * b[0], 0.0
    for t in range(20_000):
        alpha = (alpha @ model.move) * b[t] if t else alpha
        want += math.log(alpha.sum())
        alpha /= alpha.sum()
    assert math.isclose(logs[0], want, rel_tol=1e-9)


def test_emissions_add_up_to_one():
    base = hmm.Base(tokens=100, distinct=20, frequent_tokens=60, frequent=2)
    model = hmm.Chain(np.ones(2) / 2, np.ones((2, 2)) / 2, np.array([70.0, 30.0]), np.array([20.0, 20.0]), base)
    # Two frequent tokens (40 and 20), 18 rare ones with 40 together, and the class of unknown ones.
    counts = np.array([40, 20, *[2] * 14, *[3] * 4, 0])
    out = model.emissions(np.array([[45.0, 5.0], [5.0, 5.0]]), counts, np.array([0, 1]))
    assert np.allclose(out.sum(axis=0), 1)


def test_counts_and_base_scores(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    from zlib import crc32

    split = lambda t: [*(t or "").encode().lower().split(), None]
    trains = lambda i: i is not None and crc32(str(i).encode()) % 5 != 1
    counts = Counter(w for i, t in rows if trains(i) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    base = lambda t: sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in split(t))
    got = hmm.score(docs, min_count=2, rounds=1).collect()
    found = sorted(((r.doc.doc_id, r.trains, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=repr)
    want = sorted(((i, trains(i), len(split(t)), sum(counts[w] > 0 for w in split(t)), n, round(base(t), 4)) for i, t in rows), key=repr)
    assert found == want and all(r.score <= 1e-9 and math.isfinite(r.score) for r in got)


def test_training_raises_the_likelihood_and_beats_the_unigram_model(sample):
    total = lambda rounds, held: [sum(x) for x in zip(*[(r.score, r.base_score) for r in hmm.score(sample, min_count=5, rounds=rounds).collect() if r.trains != held])]
    few, many = total(0, False), total(2, False)
    assert many[0] > few[0]
    score, base = total(2, True)
    assert score > base


def test_scores_do_not_depend_on_blocks_or_on_how_their_counts_are_added_up(sample, monkeypatch):
    own = lambda: {r.doc.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in hmm.score(sample, rounds=2).collect()}
    whole = own()
    monkeypatch.setattr(hmm, "BLOCK_TOKENS", 2_000)
    monkeypatch.setattr(hmm, "GROUP", 2)
    parts = own()
    assert whole.keys() == parts.keys() and all(np.allclose(whole[i], parts[i], rtol=1e-8) for i in whole)


def test_empty_table_and_no_training_rows(spark, no_docs):
    assert hmm.score(no_docs).collect() == []
    lone = spark.createDataFrame([(None, "some words"), (None, None)], "doc_id long, text string")
    got = hmm.score(lone).collect()
    assert sorted(r.n_tokens for r in got) == [1, 3] and all(abs(r.score) < 1e-9 and r.base_score == 0 for r in got)


def test_a_token_stays_frequent_however_large_the_corpus(spark, monkeypatch):
    """1,200,000 training tokens: five occurrences are far less than 1e-5 of them."""
    seen = {}
    first = hmm.chain_of
    monkeypatch.setattr(hmm, "chain_of", lambda rows, base, states: seen.update(base=base) or first(rows, base, states))
    rows = [(i, "common " * 3_000) for i in range(500)] + [(i, f"seldom w{i}") for i in range(500, 510)]
    got = hmm.score(spark.createDataFrame(rows, "doc_id long, text string"), rounds=1).collect()
    assert len(got) == 510 and all(np.isfinite(r.score) for r in got)
    assert seen["base"].tokens > 1_100_000 and seen["base"].frequent == 3
