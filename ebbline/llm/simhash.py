"""SimHash near-dedup with covering locality-sensitive hashing.

A text's 64-bit fingerprint is the majority of its shingle hashes, bit by bit.  Every bit
position gets a non-zero vector of four bits; for each of the 15 non-zero vectors v, a mask keeps
the positions whose vector has odd inner product with v.  The vectors of three differing
positions span at most three dimensions, so some v is orthogonal to all of them: every pair of
fingerprints within distance 3 agrees under at least one mask.  No pair is missed.

Equal fingerprints are collapsed first.  Buckets of at most ``LEAF`` fingerprints are compared
in place and give a spanning forest of their links, never all pairs.  Larger buckets are covered
again by 15 masks over the bits that their mask left free (30 bits, then 14, then 7), so after
three rounds a bucket cannot hold more than ``LEAF`` different fingerprints: nothing is capped.

Nulls and edges: a null text has no words and, like an empty one, fingerprint zero; such rows are
linked like others.  component_id is the least non-null doc_id that can be reached (null where
there is none).  Rows with the same or a null doc_id each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import components, save, tagged

SHINGLE = 3
SEED = 42
RADIUS = 3
TABLES = (1 << (RADIUS + 1)) - 1
#: Most fingerprints of a bucket that are compared in place.
LEAF = 512
ROUNDS = 3


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """bytes.lower() and bytes.split() know ASCII only, as the definition asks."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    of = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    return majority(np.fromiter((of(joined[a:b], SEED) for a, b in spans), dtype=np.uint64, count=len(words) - k + 1))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 8)
        # Eight byte-wide counters to a word: sums of up to 255 rows cannot overflow into the next.
        sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(rows: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp); fp is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py() or b"") for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], ["doc_id", "fp"]
            )

    return rows.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, fp long")


def covering(free: int) -> list[int]:
    """The 15 masks over the set bits of ``free``; vectors are dealt in turn, so masks are about equally wide."""
    at = [i for i in range(64) if free >> i & 1]
    return [sum(1 << i for k, i in enumerate(at) if ((k % TABLES + 1) & v).bit_count() & 1) for v in range(1, TABLES + 1)]


def masks(rounds: int = ROUNDS) -> list[np.ndarray]:
    """For each round the masks of all paths: path * 15 + table is a path of the next round."""
    out, now = [], [0]
    for _ in range(rounds):
        now = [m | x for m in now for x in covering(~m & (1 << 64) - 1)]
        out.append(np.array(now, dtype=np.uint64))
    return out


def keyed(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """(path, fp) -> 15 rows (path, key, fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path = np.asarray(batch.column("path"))[:, None] * TABLES + np.arange(TABLES)
            fp = np.repeat(np.asarray(batch.column("fp")), TABLES)
            key = fp.view(np.uint64) & table[path.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(path.ravel()), pa.array(key.view(np.int64)), pa.array(fp)], ["path", "key", "fp"])

    return rows.mapInArrow(run, "path long, key long, fp long")


def forest(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links among at most LEAF fingerprints: (fingerprint, least of its component)."""
    bits = fps.view(np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius
    label = np.arange(len(fps))
    while True:
        least = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (least == label).all():
            break
        label = least
    return [(int(fps[i]), int(fps[x])) for i, x in enumerate(label) if i != x]


def linked(buckets: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Rows with an array ``fps`` -> the links a, b of their spanning forests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {pair for fps in batch.column("fps") for pair in forest(np.sort(np.asarray(fps.values)), radius)}
            a, b = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return buckets.mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Links a, b that connect all fingerprints (column ``fp``, each once) within the radius."""
    rows, found = distinct.select(F.lit(0).cast("long").alias("path"), "fp"), []
    tables = masks()
    for depth, table in enumerate(tables):
        last = depth == len(tables) - 1
        spread = keyed(rows, table)
        sizes = save(spread.groupBy("path", "key").count().where("count > 1"), "buckets")
        small = sizes if last else sizes.where(F.col("count") <= leaf)
        members = spread.join(small.select("path", "key"), ["path", "key"])
        # At most LEAF fingerprints to a bucket, or 2**8 in the last round.
        buckets = members.groupBy("path", "key").agg(F.collect_list("fp").alias("fps"))
        found.append(save(linked(buckets.select("fps")).distinct(), "links"))
        large = sizes.where(F.col("count") > leaf).select("path", "key")
        if last or large.isEmpty():
            break
        rows = save(spread.join(large, ["path", "key"]).select("path", "fp"), "open")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_groups(rows: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(doc_id, text) -> doc_id, fingerprint (16 hex digits), component_id."""
    prints = save(fingerprints(rows), "fingerprints")
    return grouped(prints, leaf).select("doc_id", hex_of("fp").alias("fingerprint"), "component_id")


def hex_of(name: str):
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def grouped(prints: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Columns doc_id, fp and any others -> the same with component_id."""
    distinct = save(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct, leaf))
    rooted = save(
        distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )
    least = save(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    named = save(rooted.join(least, "root").select("fp", "component_id"), "named")
    return prints.join(named, "fp")
