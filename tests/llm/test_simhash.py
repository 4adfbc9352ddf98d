from __future__ import annotations

import itertools
import random
import re

import numpy as np
import xxhash

from ebbline.llm import simhash
from ebbline.llm.common import components


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(prints):
    """Least reachable id of every row, by comparing all pairs."""
    label = list(range(len(prints)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for a, b in itertools.combinations(range(len(prints)), 2):
        if (prints[a][1] ^ prints[b][1]).bit_count() <= 3:
            label[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for i in range(len(prints)):
        groups.setdefault(find(i), []).append(prints[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((p[0], f"{p[1]:016x}", least[find(i)]) for i, p in enumerate(prints)), key=repr)


def test_fingerprints_and_components_match_brute_force(docs, sample):
    for table in (docs, sample):
        rows = [(r.doc_id, slow(r.text)) for r in table.select("doc_id", "text").collect()]
        got = sorted((tuple(r) for r in simhash.near_groups(table.select("doc_id", "text")).collect()), key=repr)
        assert got == classes(rows)


def test_empty_table(no_docs):
    assert simhash.near_groups(no_docs.select("doc_id", "text")).collect() == []


def test_every_pair_within_three_bits_shares_a_bucket_at_every_depth():
    first = [int(m) for m in simhash.masks()[0]]
    for bits in itertools.combinations(range(64), 3):
        flips = sum(1 << b for b in bits)
        assert any(m & flips == 0 for m in first)
    rng = random.Random(3)
    for depth in (1, 2):
        for _ in range(300):
            flips = sum(1 << b for b in rng.sample(range(64), 3))
            path = 0
            for upper in simhash.masks()[:depth + 1]:
                path = next(path * 15 + t for t in range(15) if int(upper[path * 15 + t]) & flips == 0)


def test_deeper_masks_leave_few_bits_free():
    free = [max(64 - int(m).bit_count() for m in table) for table in simhash.masks()]
    assert 2 ** free[-1] <= simhash.LEAF


def test_crowded_buckets_are_split_without_losing_a_link(spark):
    rng = random.Random(5)
    heart = rng.getrandbits(64)
    prints = {heart}
    while len(prints) < 400:
        prints.add(rng.choice(sorted(prints)) ^ sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 3, 4, 5)))))
    rows = [(i, p) for i, p in enumerate(sorted(prints))]
    frame = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in rows], "doc_id long, fp long")
    got = sorted((r.doc_id, r.component_id) for r in simhash.grouped(frame, leaf=4).collect())
    assert got == sorted((i, c) for i, _, c in classes(rows))


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {1000 + i: 1000 for i in range(1, 300)}


def test_forest_spans_each_component():
    fps = np.sort(np.array([0, 1, 3, 31 << 40, (31 << 40) + 7, -1], dtype=np.int64))
    assert sorted(simhash.forest(fps)) == [(1, 0), (3, 0), ((31 << 40) + 7, 31 << 40)]
