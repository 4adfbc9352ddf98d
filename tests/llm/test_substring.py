from __future__ import annotations

import random

import pytest

from ebbline.llm import substring


def slow(rows):
    """rows: (doc_id, text) -> sorted (doc_id, n_words, n_removed, kept)."""
    own = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in own:
        for k in range(len(w) - 12 if i is not None else 0):
            phrase = tuple(w[k : k + 13])
            least[phrase] = min(least.get(phrase, i), i)
    out = []
    for i, w in own:
        gone = set()
        for k in range(len(w) - 12 if i is not None else 0):
            if least[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


def found(docs):
    rows = substring.remove_repeats(docs).select("doc.doc_id", "n_words", "n_removed", "kept").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_awkward_rows_match_brute_force(docs):
    assert found(docs) == slow([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(no_docs):
    assert found(no_docs) == []


@pytest.mark.parametrize("words, phrases, run", [(substring.BLOCK_WORDS, substring.PHRASES, substring.RUN), (60, 7, 3), (400, 5, 1)])
def test_planted_passages_match_brute_force(spark, monkeypatch, words, phrases, run):
    """Passages of 11 to 30 words, shared by many documents or twice in one, at any place."""
    monkeypatch.setattr(substring, "BLOCK_WORDS", words)
    monkeypatch.setattr(substring, "PHRASES", phrases)
    monkeypatch.setattr(substring, "RUN", run)
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3)
    passages = [[word() for _ in range(n)] for n in (11, 12, 13, 14, 20, 30)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randint(0, 5)):
            text += [f"{i}-{k}-{rng.random()}" for k in range(rng.randint(0, 9))] if rng.random() < 0.5 else []
            p = rng.choice(passages)
            text += p[rng.randint(0, 2) :]
        rows.append((rng.choice([i, i, i, 5]), "\n".join(text)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == slow(rows)


def test_anchors_depend_on_the_window_alone():
    powers = substring.Powers()
    window = b" ".join(b"w%d" % i for i in range(13))
    alone = substring.Runs(window, powers).anchors()
    inside = substring.Runs(b"x y " + window + b" z", powers).anchors()
    assert len(alone) == 1 and alone[0] == inside[2]
