"""Near-duplicate documents by SimHash: five-word fingerprints, covering masks, exact Jaccard similarity of 0.8 or more.

A text's fingerprint has 64 bits, the majority of the hashes of its different five-word shingles.
Texts of similarity 0.8 differ in about 10 of them, far more than operator 1's three, so the masks
are laid out anew: each half of 32 bits gets the 63 words of the Reed-Muller code of order one as
masks, of 16 bits each (one of 32).  Any five positions of a half are missed by some mask, so a
pair with at most five differing bits in either half, hence every pair within eleven, agrees under a mask.

Texts with equal masked bits are a bucket.  Those that have nobody within ``RADIUS`` bits and of a
size that could match leave it; buckets of more than ``SMALL`` keep all.  What is left goes through
the blocks of :mod:`ebbline.llm.sigtree`: pairs of blocks, signatures, exact comparison of the sets.
A bucket of up to ``SMALL`` gives its pairs of blocks where it is read.  Of a larger one each block first
meets the one that holds most of it; then the texts outside the bucket's largest class meet all of
the bucket.  The texts of one class are never compared with each other again, so a large group of near
copies takes rows in proportion to its size, and to the strangers in its buckets.
No pair is linked by its fingerprint alone, and no bucket compares all pairs.  A pair is missed if both
halves differ in six bits or more and no mask happens to avoid them; README has the measured recall.

With n texts a bucket holds n / 2**16 of them by chance, so beyond some ten million texts the halves
should give way to longer masks on several fingerprints; that is not built.

Nulls and edges: as in :mod:`ebbline.llm.sigtree`, but texts without words (or null) are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm import sigtree, simhash
from ebbline.llm.common import components, forget_shuffles, save, tagged
from ebbline.llm.substring import Powers

HALF = 32
RADIUS = 16
#: Buckets up to this size drop texts that have nobody near.
SMALL = 64


def masks() -> np.ndarray:
    """63 masks of 32 bits: position i has the vector (1, bits of i); mask v keeps those with odd inner product with v."""
    return np.array([sum(1 << i for i in range(HALF) if ((HALF + i) & v).bit_count() & 1) for v in range(1, 2 * HALF)], dtype=np.uint64)


def fingerprints(texts: DataFrame) -> DataFrame:
    """(row, text) -> row, fp."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            found = [simhash.majority(sigtree.hashes(t.as_py(), powers).view(np.uint64)) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], ["row", "fp"])

    return texts.select("row", "text").mapInArrow(run, "row long, fp long")


def keyed(entries: DataFrame) -> DataFrame:
    """(place, n, fp) -> a row (key, place, n, fp) for each mask of each half; the key holds the mask and the masked bits."""
    every = masks()
    number = np.arange(2 * len(every), dtype=np.uint64) << np.uint64(HALF)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                fp = np.asarray(part.column("fp")).view(np.uint64)
                halves = fp & np.uint64((1 << HALF) - 1), fp >> np.uint64(HALF)
                key = np.concatenate([half[:, None] & every for half in halves], axis=1) + number
                columns = [key.ravel().view(np.int64), *[np.repeat(np.asarray(part.column(c)), key.shape[1]) for c in ("place", "n", "fp")]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "place", "n", "fp"])

    return entries.select("place", "n", "fp").mapInArrow(run, "key long, place long, n long, fp long")


def company(key: np.ndarray, n: np.ndarray, fp: np.ndarray, radius: int, small: int) -> np.ndarray:
    """Which rows, sorted by key, have another of the same key near them, or stand in a bucket of more than ``small``."""
    first = np.concatenate(([True], key[1:] != key[:-1]))
    bucket = np.cumsum(first) - 1
    size = np.bincount(bucket)[bucket]
    keep = size > small
    for step in range(1, small):
        at = np.flatnonzero((key[step:] == key[:-step]) & ~keep[step:])
        if not len(at):
            break
        to = at + step
        near = np.bitwise_count(fp[at] ^ fp[to]) <= radius
        near &= 5 * np.minimum(n[at], n[to]) >= 4 * np.maximum(n[at], n[to])
        found = np.zeros(len(key), dtype=bool)
        found[at[near]] = found[to[near]] = True
        keep |= found & (size <= small)
    return keep


BITS = [f"{side}{k}" for side in "ab" for k in range(sigtree.WORDS)]


def block_bits(key: np.ndarray, place: np.ndarray, n: np.ndarray, small: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by key, at most ``small`` of each: pairs of blocks a <= b that hold rows of one key and matching sizes, and the bits of those rows."""
    low, high = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for step in range(1, small):
        at = np.flatnonzero(key[step:] == key[:-step])
        if not len(at):
            break
        to = at + step
        fits = 5 * np.minimum(n[at], n[to]) >= 4 * np.maximum(n[at], n[to])
        x, y = place[at[fits]], place[to[fits]]
        low.append(np.minimum(x, y))
        high.append(np.maximum(x, y))
    x, y = np.concatenate(low), np.concatenate(high)
    a, b = x // sigtree.BLOCK, y // sigtree.BLOCK
    width = int(b.max(initial=0)) + 1
    code, pair = np.unique(a * width + b, return_inverse=True)
    bits = np.zeros((len(code), len(BITS)), dtype=np.uint64)
    inner = np.flatnonzero(a == b)
    for side, places, own in ((0, x, pair), (sigtree.WORDS, y, pair), (0, y[inner], pair[inner])):
        np.bitwise_or.at(bits, (own, side + places % sigtree.BLOCK // 64), np.uint64(1) << (places % 64).astype(np.uint64))
    return code // width, code % width, bits.view(np.int64)


def gathered(keys: DataFrame, radius: int = RADIUS, small: int = SMALL) -> DataFrame:
    """The texts that have company under a mask: pairs of blocks a, b with their bits for buckets of up to ``small``, rows key, place, n of larger ones."""
    names = ["key", "place", "n", "a", "b", *BITS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, dtype=np.int64) for _ in range(4)]

        def kept(own: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, place, n, fp = own
            keep = company(key, n, fp.view(np.uint64), radius, small)
            bucket = np.cumsum(np.concatenate(([True], key[1:] != key[:-1]))) - 1
            large = np.bincount(bucket)[bucket] > small
            a, b, bits = block_bits(*[x[keep & ~large] for x in (key, place, n)], small)
            nothing = [pa.nulls(len(a), pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([*nothing, pa.array(a), pa.array(b), *map(pa.array, np.ascontiguousarray(bits.T))], names)
            rows = [pa.array(x[large]) for x in (key, place, n)]
            yield pa.RecordBatch.from_arrays([*rows, *[pa.nulls(len(rows[0]), pa.int64())] * (2 + len(BITS))], names)

        for batch in batches:
            held = [np.concatenate((x, np.asarray(c))) for x, c in zip(held, batch.columns)]
            if not len(held[0]):
                continue
            # The last bucket waits for its rest; a very large one goes on in parts, which keep all.
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if len(held[0]) - cut > 1 << 16:
                cut = len(held[0]) - small - 1
            if cut:
                yield from kept([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield from kept(held)

    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(run, ", ".join(f"{x} long" for x in names))


def met(held: DataFrame, others: DataFrame, condition: str) -> DataFrame:
    """Pairs a <= b of blocks of ``others`` and ``held`` (its columns with an underscore) that share a key, meet the condition and have sizes that can match."""
    other = held.select("key", *[F.col(c).alias(f"_{c}") for c in held.columns if c != "key"])
    two = others.join(other, "key").where(condition).where("5 * most >= 4 * _least AND 5 * _most >= 4 * least")
    out = []
    for k in range(sigtree.WORDS):
        own, its = F.col(f"m{k}"), F.col(f"_m{k}")
        both = own.bitwiseOR(its)
        out.append(F.when(F.col("block") < F.col("_block"), own).when(F.col("block") > F.col("_block"), its).otherwise(both).alias(f"a{k}"))
        out.append(F.when(F.col("block") < F.col("_block"), its).when(F.col("block") > F.col("_block"), own).otherwise(both).alias(f"b{k}"))
    return two.select(F.least("block", "_block").alias("a"), F.greatest("block", "_block").alias("b"), *out).select("a", "b", *BITS)


def together(pairs: DataFrame) -> DataFrame:
    """One row for each pair of blocks; written."""
    return save(pairs.groupBy("a", "b").agg(*[F.bit_or(c).alias(c) for c in BITS]), "pairs")


def with_hubs(large: DataFrame) -> DataFrame:
    """Pairs of each block of a large bucket with one that holds much of the bucket: as many as it has blocks.

    Of the blocks with at least half as many of the bucket as any, the one with the most entries in
    all large buckets is the hub.  So the buckets of a group of near copies, which hold about the same
    texts, agree on it, and the group's blocks meet one hub, not one for each bucket.
    """
    held = sigtree.held_in_blocks(large, "key")
    peaks = held.groupBy("key").agg((F.max("own") / 2).alias("peak"))
    weights = held.groupBy("block").agg(F.sum("own").alias("weight"))
    able = held.join(peaks, "key").where("own >= peak").join(weights, "block")
    hubs = able.groupBy("key").agg(F.max_by(F.struct(*[c for c in held.columns if c != "key"]), F.struct("weight", F.negative("block"))).alias("hub"))
    return met(held, hubs.select("key", "hub.*"), "block <> _block OR own > 1")


def apart(large: DataFrame, where: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of blocks of large buckets for the rows that are not yet of one class, and the entries with their places there.

    Those of a bucket's largest class need no comparison with each other: each of the others meets
    all, so a large group of near copies is compared with the rest of its buckets, not with itself.
    Entries stand in the order of their classes, so a group has few blocks.
    """
    rooted = where.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row"))
    # A row of the join is a text with its buckets, 126 at most; written, since two plans read it.
    texts = large.groupBy("place", "n").agg(F.collect_list("key").alias("keys"))
    texts = save(texts.join(rooted.select("place", "row", "root"), "place").select("row", "n", "root", "keys"), "rooted")
    rows = texts.select(F.explode("keys").alias("key"), "row", "n", "root")
    sizes = rows.groupBy("key", "root").count()
    most = sizes.groupBy("key").agg(F.max_by("root", F.struct("count", "root")).alias("most"), F.count(F.lit(1)).alias("classes")).where("classes > 1")
    rows = save(rows.join(most, "key").select("key", "row", "n", (F.col("root") == F.col("most")).alias("main")), "apart")
    own = rooted.join(rows.select("row").distinct(), "row", "left_semi").drop("place").withColumnRenamed("root", "low")
    now = save(sigtree.placed(own), "placed")
    held = sigtree.held_in_blocks(rows.join(now.select("row", "place"), "row"), "key", "main")
    return met(held, held.where("NOT main"), "_main OR block < _block OR (block = _block AND own > 1)"), now


def linked(found: DataFrame, where: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that connect all entries of similarity 0.8 or more among those of :func:`gathered` that share a bucket."""
    pairs, large = found.where("key IS NULL").select("a", "b", *BITS), found.where("key IS NOT NULL").select("key", "place", "n")
    if large.isEmpty():
        return sigtree.compared(together(pairs), where, texts)
    first = sigtree.compared(together(pairs.union(with_hubs(large))), where, texts)
    forget_shuffles(found.sparkSession)
    rest, now = apart(large, where, save(sigtree.whole(components(first)), "roots"))
    return first.union(sigtree.compared(together(rest), now, texts))


def grouped(rows: DataFrame) -> DataFrame:
    """(row, doc_id, text) -> row, doc_id, component_id; doc_id may be any type that can be compared."""
    texts = rows.select("row", "text")
    sets = save(sigtree.described(texts, with_prefix=False).drop("prefix"), "sets")
    reps = sigtree.entries(sets)
    own = sets.where("n > 0").join(reps.select(F.col("rep").alias("row")), "row", "left_semi").drop("digest")
    where = save(sigtree.placed(own.join(fingerprints(texts), "row")), "placed")
    found = save(gathered(keyed(where), RADIUS, SMALL), "members")
    forget_shuffles(rows.sparkSession)
    roots = save(sigtree.whole(components(linked(found, where.drop("fp"), texts))), "roots")
    return sigtree.grouped(rows, sets, roots, reps)


def representatives(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the least doc_id, or the first row where ids are null or repeated."""
    rows = tagged(docs, "near")
    ids = F.struct(F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("id"), "row").alias("doc_id")
    found = grouped(rows.select("row", ids, F.col("doc.text").alias("text")))
    gone = save(found.where("doc_id <> component_id").select("row"), "gone")
    return rows.join(gone, "row", "left_anti").select("doc.*")
