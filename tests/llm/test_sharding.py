from __future__ import annotations

import zlib

import pytest

from ebbline.llm import sharding


def check(docs, shards):
    got = sharding.kd_shards(docs, shards=shards).collect()
    rows = docs.collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted(((r.doc.doc_id, r.doc.size, r.doc.text_crc32) for r in got), key=repr) == sorted(
        ((r.doc_id, size(r.text), zlib.crc32((r.text or "").encode())) for r in rows), key=repr
    )
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert all(0 <= s < shards for s in by)
    return {s: sum(r.doc.size for r in own) for s, own in by.items()}


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_shards_hold_near_equal_bytes(sample, shards):
    bytes_of = check(sample, shards)
    total, largest = sum(bytes_of.values()), max(len(r.text.encode()) + 1 for r in sample.collect())
    assert len(bytes_of) == shards and max(abs(b - total / shards) for b in bytes_of.values()) <= 2 * largest


def test_awkward_rows(docs, no_docs):
    check(docs, 16)
    assert sharding.kd_shards(no_docs, shards=16).collect() == []


def test_one_source_and_equal_documents(spark):
    rows = [(i % 3, "same text", "en", "hot") for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert set(check(docs, 16).values()) == {100}


def test_target_bytes(sample):
    total = sum(len(r.text.encode()) + 1 for r in sample.collect())
    shards = {r.shard for r in sharding.kd_shards(sample, target_bytes=total // 4 + 1).collect()}
    assert shards == {0, 1, 2, 3}


def test_the_first_split_is_at_the_weighted_median_of_the_widest_dimension(spark):
    """Sizes and hashes are alike, so doc_id spreads most."""
    docs = spark.createDataFrame([(i, "x" * 9, "en", "s") for i in range(40)], "doc_id long, text string, lang string, source string")
    got = {r.doc.doc_id: r.shard for r in sharding.kd_shards(docs, shards=2).collect()}
    assert got == {i: int(i >= 20) for i in range(40)}


def reference(points, shards, first=0):
    """{row: shard} by the recursive definition; rows are (c0 .. c3, size, row)."""
    if shards == 1 or not points:
        return {p[-1]: first for p in points}
    widths = [max(p[d] for p in points) - min(p[d] for p in points) for d in range(4)]
    along = widths.index(max(widths))
    ordered = sorted(points, key=lambda p: (p[along], p[-1]))
    total, left, running, parts = sum(p[-2] for p in points), shards // 2, 0, ([], [])
    for p in ordered:
        running += p[-2]
        parts[not (2 * running - p[-2]) * shards < 2 * total * left].append(p)
    return {**reference(parts[0], left, first), **reference(parts[1], shards - left, first + left)}


@pytest.mark.parametrize("shards", [3, 16])
def test_shards_match_the_recursive_definition(sample, shards):
    rows = sharding.tagged(sharding.measured(sample), "sized")
    points = [tuple(p) for p in sharding.points(rows).select(*sharding.DIMENSIONS, "size", "row").collect()]
    name = {r.row: r.doc.doc_id for r in rows.collect()}
    want = {name[row]: shard for row, shard in reference(points, shards).items()}
    got = {r.doc.doc_id: r.shard for r in sharding.kd_shards(sample, shards=shards).collect()}
    assert len(name) == len(set(name.values())) and got == want
