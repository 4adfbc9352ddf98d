from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ebbline.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def fold(nodes):
    """The levels of a tree over ``nodes``, the last with one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((level[at ^ 1] if at ^ 1 < len(level) else None, at % 2 == 0))
        at //= 2
    return out


def slow(rows):
    """(group, order, digest) -> sorted (group, order, digest, subroot, root, path)."""
    groups = {}
    for group, order, digest in rows:
        groups.setdefault(group, []).append((order is not None, order or 0, digest))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [fold([d for *_, d in sorted(groups[g])]) for g in names]
    top = fold([t[-1][0] for t in trees])
    return sorted(
        (repr(g), repr(o if known else None), d, trees[k][-1][0], top[-1][0], repr(path(trees[k], i) + path(top, k)))
        for k, g in enumerate(names)
        for i, (known, o, d) in enumerate(sorted(groups[g]))
    )


def run(spark, rows, levels):
    df = spark.createDataFrame(rows, "grp string, ord long, digest string").repartition(3)
    found = merkle.manifest(df, "grp", "ord", levels).collect()
    return sorted((repr(r.row.grp), repr(r.row.ord), r.row.digest, r.subroot, r.root, repr([(p.sibling, p.first) for p in r.path])) for r in found), found


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_trees_and_paths_equal_the_plain_ones(spark, levels):
    rng = random.Random(levels)
    rows = [(g, rng.randrange(60) if rng.random() < 0.9 else None, sha(str(rng.randrange(200)))) for g, n in ((None, 3), ("a", 1), ("b", 41), ("é", 17), ("", 16), ("c", 2)) for _ in range(n)]
    rows += rows[:9]  # repeated rows
    got, found = run(spark, rows, levels)
    assert got == slow(rows)
    for r in found[::7]:
        now = r.row.digest
        for p in r.path:
            now = sha(now, p.sibling or "") if p.first else sha(p.sibling or "", now)
        assert now == r.root


def test_one_row_is_its_own_root(spark):
    assert run(spark, [(None, None, "x")], 8)[0] == [("None", "None", "x", "x", "x", "[]")]


def test_no_rows(spark):
    assert run(spark, [], 8)[0] == []


def test_fields_are_told_apart(spark, docs):
    """Lengths stand before values, nulls are not empty texts, bytes are counted, not letters."""
    row = spark.createDataFrame([("é", None, "", 7)], "a string, b string, c string, d long").select(merkle.row_digest([F.col(c) for c in "abcd"])).first()
    assert row[0] == sha("2:é", "-", "0:", "1:7")


def test_tampering_is_found_in_awkward_rows(spark, docs):
    from pyspark.sql import functions as F

    leaf = lambda n: merkle.row_digest([F.col("doc_id"), F.col("lang"), n, F.col("text")])
    tampers = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = docs.select("doc_id", "lang", "n_chars", "row", leaf(F.col("n_chars")).alias("digest"), F.when(tampers, leaf(F.col("n_chars") + 1)).alias("other"))
    found = merkle.manifest(rows, "lang", "doc_id")
    found = found.select("row.*", "root", merkle.folded(F.coalesce("row.other", "row.digest"), F.col("path")).alias("again")).collect()
    assert len(found) == docs.count()
    for r in found:
        touched = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None
        assert (r.again == r.root) == (not touched)
    assert merkle.manifest(rows.limit(0), "lang", "doc_id").count() == 0
