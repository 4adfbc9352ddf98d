from __future__ import annotations

import itertools
import random

import corpus_pipeline
import numpy as np
import pytest

from ebbline.llm import near, sigtree
from ebbline.llm.common import numbered


def shingles(text):
    words = (text or "").encode().lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else {()}


def shingles_of(text):
    return shingles(text) - {()}


def kept(rows):
    """Least id of each component of pairs with Jaccard >= 0.8."""
    return sorted(set(roots(rows).values()))


def roots(rows):
    """The least id of each row's component, by comparing all pairs."""
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for a, b in itertools.combinations(range(len(rows)), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            label[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for i, (own, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(own)
    return {own: min(groups[find(i)]) for i, (own, _) in enumerate(rows)}


def planted():
    """Chains of edited copies with similarities around 0.8, and a line that many texts share."""
    rng = random.Random(5)
    line = " ".join(f"line{i}" for i in range(30))
    rows = []
    for _ in range(12):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([3, 8, 60, 150]))]
        for _ in range(12):
            rows.append((" ".join(words) + (f"\n{line}" if rng.random() < 0.4 else "")))
            words = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    order = list(range(len(rows)))
    rng.shuffle(order)
    return list(zip(order, rows))


def merged(rows, keep):
    """How many texts went, by the ids that stay."""
    return len(rows) - len(set(keep))


@pytest.mark.parametrize("shingles", [1 << 17, 300])
def test_join_equals_brute_force_jaccard(spark, monkeypatch, shingles):
    monkeypatch.setattr(sigtree, "BLOCK_SHINGLES", shingles)
    rows = planted() + [(1000, None), (1001, ""), (1002, " \t"), (1003, "Word"), (1004, "word"), (1005, "two words")]
    docs = numbered(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "texts")
    found = {r.doc_id: (r.n, r.component_id) for r in sigtree.classes(docs).collect()}
    filled = [(i, t) for i, t in rows if (t or "").split()]
    want = roots(filled) | {i: i for i, t in rows if not (t or "").split()}
    assert {i: c for i, (_, c) in found.items()} == want
    assert {i: n for i, (n, _) in found.items()} == {i: len(shingles_of(t)) for i, t in rows}


def test_join_takes_awkward_rows(spark, docs, no_docs):
    found = sigtree.classes(numbered(docs.select("doc_id", "text"), "texts")).select("doc_id", "n", "component_id").collect()
    assert len(found) == docs.count()
    by = {}
    for r in found:
        by.setdefault(r.component_id, []).append((r.doc_id, r.n))
    assert {len(x) for x in by.values()} > {1}
    assert sorted((r.doc_id, r.n) for r in found if not r.n and r.doc_id) == [(4, 0), (5, 0), (6, 0)]
    assert all(r.component_id == r.doc_id for r in found if not r.n)
    assert sigtree.classes(numbered(no_docs.select("doc_id", "text"), "texts")).count() == 0


def test_bound_is_never_below_the_overlap():
    """Bitmaps of any width, entries and nodes: what two signatures allow is at least what their sets share."""
    rng = np.random.default_rng(3)
    universe = np.unique(rng.integers(-(2**62), 2**62, 3000))
    sets = [np.sort(rng.choice(universe, rng.integers(1, 400), replace=False)) for _ in range(40)]
    sets += [np.sort(np.concatenate((s[: len(s) // 10 * 9], rng.choice(universe, 3)))) for s in sets]
    sets = [np.unique(s) for s in sets]
    quarter, bits = zip(*map(sigtree.signature, sets))
    n = np.array(list(map(len, sets)))
    every = sigtree.Signatures.of(list(bits), n, np.array(quarter), 8 * min(map(len, bits)))
    overlap = sigtree.overlaps(sets, sets)
    assert (overlap == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]).all()
    link = 5 * overlap >= 4 * (n[:, None] + n - overlap)
    may = every.may_link(every)
    assert (may | ~link).all() and link.sum() > len(sets) and not may.all()
    for size in (1, 3, 16, 100):
        walked = sigtree.traverse(every, every, size)
        assert (walked | ~link).all() and (may | ~walked).all()


def test_masks_cover_five_bits_of_a_half():
    every = near.masks()
    assert sorted({m.bit_count() for m in every.tolist()}) == [16, 32] and len(set(every.tolist())) == 63
    rng = random.Random(1)
    for _ in range(5000):
        five = sum(1 << i for i in rng.sample(range(32), 5))
        assert any(not int(m) & five for m in every)


def test_company_keeps_all_that_are_near(spark):
    rng = np.random.default_rng(4)
    key = np.sort(rng.integers(0, 60, 900))
    fp, n = rng.integers(0, 2**64, 900, dtype=np.uint64), rng.integers(80, 120, 900)
    fp[1::3] = fp[::3] ^ np.uint64(7)
    got = near.company(key, n, fp, 16, 20)
    for i in range(900):
        same = [j for j in np.flatnonzero(key == key[i]) if j != i]
        mates = any((int(fp[i]) ^ int(fp[j])).bit_count() <= 16 and 5 * min(n[i], n[j]) >= 4 * max(n[i], n[j]) for j in same)
        assert got[i] == (mates or len(same) >= 20)


def test_stage_links_only_by_similarity_and_misses_few(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got, want = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}, set(kept(rows))
    # A missed link leaves one row more; nothing goes that brute force keeps.
    assert want <= got and merged(rows, got) >= 0.95 * merged(rows, want) > 50


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert got == kept([(r.doc_id, r.text) for r in docs.collect()])


def test_block_bits_are_all_pairs_of_a_bucket():
    rng = np.random.default_rng(6)
    key = np.sort(rng.integers(0, 40, 300))
    place, n = rng.permutation(2000)[:300], rng.integers(80, 120, 300)
    want = {}
    for i, j in itertools.combinations(range(300), 2):
        if key[i] == key[j] and 5 * min(n[i], n[j]) >= 4 * max(n[i], n[j]):
            low, high = sorted((int(place[i]), int(place[j])))
            pair = low // sigtree.BLOCK, high // sigtree.BLOCK
            mine, its = want.setdefault(pair, (set(), set()))
            mine.add(low % sigtree.BLOCK)
            (mine if pair[0] == pair[1] else its).add(high % sigtree.BLOCK)
    a, b, bits = near.block_bits(key, place, n, 64)
    words = bits.view(np.uint64)
    of = lambda row, side: {64 * k + i for k in range(sigtree.WORDS) for i in range(64) if int(row[side * sigtree.WORDS + k]) >> i & 1}
    got = {(int(x), int(y)): (of(row, 0), set() if x == y else of(row, 1)) for x, y, row in zip(a, b, words)}
    assert got == want


@pytest.mark.parametrize("small", [3, 64])
def test_a_large_group_of_near_copies_is_one_class(spark, monkeypatch, small):
    monkeypatch.setattr(near, "SMALL", small)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    copies = []
    for _ in range(300):
        own = list(words)
        own[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        copies.append(" ".join(own))
    rows = [*enumerate(copies), *[(1000 + i, t) for i, t in planted()]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got, want = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}, set(kept(rows))
    assert want <= got and not got & set(range(1, 300))
    assert merged(rows, got) >= 0.95 * merged(rows, want)


def test_a_class_is_not_compared_with_itself_again(spark):
    """A bucket of m near copies and two strangers: as many pairs as it has blocks, not their square."""
    n = 12 * sigtree.BLOCK
    where = spark.range(n + 2).selectExpr("id AS row", "id AS place", "100L AS n", "10L AS quarter", "cast(repeat('x', 32) as binary) AS bits")
    large = where.selectExpr("7L AS key", "place", "n")
    roots = spark.range(n).selectExpr("id AS row", "0L AS root")
    pairs, now = near.apart(large, where, roots)
    blocks = now.selectExpr("place div 256 AS block").distinct().count()
    assert now.count() == n + 2 and blocks >= 12
    assert 0 < pairs.count() <= 2 * blocks + 1
    assert near.apart(large.where(f"place < {n}"), where, roots)[0].isEmpty()


def test_buckets_of_one_group_agree_on_a_hub(spark):
    """Buckets that hold different parts of a group of near copies: pairs as many as its blocks, not a hub for each bucket."""
    blocks, rng = 16, random.Random(9)
    rows = [(key, place, 100) for key in range(60) for place in rng.sample(range(blocks * sigtree.BLOCK), 800)]
    pairs = near.with_hubs(spark.createDataFrame(rows, "key long, place long, n long")).select("a", "b").distinct().collect()
    assert {x for p in pairs for x in p} == set(range(blocks)) and len(pairs) <= 2 * blocks


def test_a_text_is_joined_once_with_all_its_pairs(spark):
    """Each block meets one hub: its entries take part in as many pairs as blocks, but the join has a row for each entry."""
    blocks, full = 6, [-1] * sigtree.WORDS
    pairs = spark.createDataFrame([(0, b, *full, *full) for b in range(1, blocks)], ["a", "b", *near.BITS])
    where = spark.range(blocks * sigtree.BLOCK).selectExpr("id AS place", "id + 5 AS row", "100L AS n")
    taken = sigtree.participants(pairs, where)
    got = sorted((r.a, r.b, r.side, r.row - 5) for r in taken.collect())
    assert got == sorted((0, b, side, block * sigtree.BLOCK + i) for b in range(1, blocks) for side, block in ((0, 0), (1, b)) for i in range(sigtree.BLOCK))
    plan = taken._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(in") < plan.index("Join") < plan.index("collect_list")
