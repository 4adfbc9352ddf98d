from __future__ import annotations

import zlib

import numpy as np
import pytest

from ebbline.llm import nbsvm


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = nbsvm.train(docs, labels)
    scores = {r.doc.doc_id: r.score for r in nbsvm.score(docs, model, ["doc_id"]).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    held = [(r.quality, scores[r.doc_id] >= nbsvm.THRESHOLD) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    good = [p for y, p in held if y == 1]
    bad = [p for y, p in held if y == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.15


@pytest.mark.parametrize("labels, score", [([], 1.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (3, 0)], 0.0), ([(1, 0), (1, 1), (2, None)], 1.0)])
def test_labels_of_one_class_or_none(spark, docs, labels, score):
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    got = nbsvm.score(docs, nbsvm.train(docs, frame, parts=1, held=2)).collect()
    assert len(got) == docs.count() and {r.score for r in got} == {score}


def test_awkward_rows_are_scored(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in (1, 2, 4, 5, 6, 7, 8, 9, 10, 14, 14)], "doc_id long, quality int, text string")
    model = nbsvm.train(docs, labels, parts=1, held=2)
    got = nbsvm.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not (r.doc.text or "").split() and not r.doc.text}) == 1
    assert nbsvm.score(no_docs, model).collect() == []


def test_sample_is_bounded_and_the_same_every_time(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)], "doc_id long, quality int")
    one, two = (sorted(map(tuple, nbsvm.sampled(labels.repartition(n), 50, 4, 2).collect())) for n in (1, 7))
    assert one == two and len(one) == 50 and all(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in one)


def test_dual_descent_reaches_the_optimum_of_the_primal():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(12, 4, replace=False)) for _ in range(60)]
    values = [rng.normal(size=4) for _ in rows]
    labels = np.array([int(v.sum() + rng.normal() > 0) for v in values])
    weight, bias = nbsvm.descend(rows, values, labels, 1.0, 2000, 1)
    x = np.zeros((60, 13))
    for i, (r, v) in enumerate(zip(rows, values)):
        x[i, r], x[i, 12] = v, 1
    y = np.where(labels > 0, 1, -1)
    cost = np.where(labels > 0, 30 / (labels > 0).sum(), 30 / (labels <= 0).sum())
    loss = lambda w: 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (x @ w))).sum()
    found = np.append(weight[:12], bias)
    best = loss(found)
    assert all(best <= loss(found + rng.normal(size=13) * s) + 1e-6 for s in (1e-3, 1e-2, 0.1, 1) for _ in range(100))


def test_log_count_ratio_by_hand():
    ratio = nbsvm.log_count_ratio([np.array([0, 1]), np.array([1])], np.array([1, 0]))
    n = 1 << nbsvm.BITS
    assert np.isclose(ratio[0], np.log(2 / (n + 2)) - np.log(1 / (n + 1))) and np.isclose(ratio[1], np.log(2 / (n + 2)) - np.log(2 / (n + 1)))


def test_sigmoid_orders_and_separates():
    slope, offset = nbsvm.sigmoid(np.array([-2.0, -1, -1, 1, 1, 2] * 20), np.array([0, 0, 0, 1, 1, 1] * 20))
    assert slope < 0 and 1 / (1 + np.exp(slope * 2 + offset)) > 0.95
