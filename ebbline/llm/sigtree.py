"""N-gram Jaccard join by signature trees: all documents whose five-word shingle sets have similarity 0.8 or more.

Every document gets a signature: how many different shingles it has, and a bitmap of those in one
quarter of the hash space (at least two bits for each shingle of the document, so few bits meet).  A
node of the tree holds the OR of its documents' bitmaps and their range of sizes.  What two nodes
can share at most is what their bitmaps share, plus what collisions and the other three quarters
could hide; if that is less than similarity 0.8 asks for at the least sizes, no pair below is looked at.

1. Equal sets are one entry.  Entries stand in the order of size class and least shingle hash, so
   likely partners are neighbours; ``BLOCK`` neighbours are a block of the tree.
2. The top of the dual traversal is a join: two sets of similarity 4/5 share one of the first
   n - ceil(4n/5) + 1 shingles of either in any common order, so two blocks without such a shingle in
   common share too little.  Rare shingles stand first in that order, as counted in a part of the
   documents, which changes the work, never the result.  A block's entries with a shingle are the bits
   of four numbers; a pair of blocks gets the OR of them over all shingles, by an aggregate with
   map-side combine, so a passage in very many documents costs a row per pair of blocks.
3. The traversal goes on inside a pair of blocks, from nodes of ``NODE`` entries to entries.
4. The sets of the entries that are left are compared exactly; a pair of blocks gives a spanning
   forest of its links, not all of them.  Components of the forests are the classes.

Worst case: m entries that all share rare shingles at similarities just below 0.8 take m**2 / BLOCK**2
pairs of blocks; none of them emits more than 2 * BLOCK links.

Nulls and edges: letters are compared in ASCII lower case, words separated by ASCII blanks; fewer than
five words are one shingle.  A null text, or one without words, has an empty set and links with nothing.  Rows with the same or a null doc_id each get a row;
component_id is the least non-null doc_id that can be reached.  Shingles are told apart by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.ordering import asc, with_running
from ebbline.llm.common import components, forget_shuffles, release, save
from ebbline.llm.substring import Powers, Runs

SHINGLE = 5
#: Documents counted for the order of the shingles, and the shingles that are put last by it.
COUNTED = 20_000
COMMON = 100_000
#: Entries and shingles of a block at most (one entry may have more), and entries of a node inside it.
BLOCK = 256
BLOCK_SHINGLES = 1 << 17
NODE = 16
WORDS = BLOCK // 64
#: Columns of a block pair's matrix that are multiplied at a time.
STRIPE = 8192


def hashes(text: bytes | None, powers: Powers, shingle: int = SHINGLE) -> np.ndarray:
    """Different hashes of the shingles, ascending; none for a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.int64)
    return np.unique(Runs(b" ".join(words), powers).hashes(min(shingle, len(words))).view(np.int64))


def required(n: np.ndarray) -> np.ndarray:
    """Shingles that two sets with ``n`` in sum must share: 5 * both >= 4 * (n - both)."""
    return -(-4 * n // 9)


def signature(own: np.ndarray) -> tuple[int, bytes]:
    """Shingles in the first quarter of the hash space, and their bitmap."""
    quarter = own[own & 3 == 0]
    width = max(64, 1 << int(2 * len(own) - 1).bit_length()) if len(own) else 64
    bits = np.zeros(width, dtype=np.uint8)
    bits[(quarter >> 2) & (width - 1)] = 1
    return len(quarter), np.packbits(bits, bitorder="little").tobytes()


def common(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur most often in about COUNTED documents, sorted, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                yield pa.RecordBatch.from_arrays([pa.array(hashes(text.as_py(), powers))], ["key"])

    part = max(1, rows.count() // COUNTED)
    counted = rows.where(F.pmod(F.xxhash64("row"), F.lit(part)) == 0).select("text").mapInArrow(run, "key long")
    often = counted.groupBy("key").count().where("count > 2").orderBy(F.desc("count"), "key").limit(COMMON).toPandas().sort_values("key")
    return often["key"].to_numpy(dtype=np.int64), often["count"].to_numpy(dtype=np.int64)


def prefix(own: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first n - ceil(4n/5) + 1 hashes in the common order."""
    take = len(own) - -(-4 * len(own) // 5) + 1 if len(own) else 0
    if not len(keys):
        return own[:take]
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    return own[np.argsort(np.where(keys[at] == own, counts[at], 0), kind="stable")][:take]


ENTRY = "row long, n long, low long, quarter long, bits binary, digest binary, prefix array<bigint>"


def described(rows: DataFrame, with_prefix: bool = True) -> DataFrame:
    """(row, text) -> ENTRY: size, least hash, signature, digest of the whole set and the prefix."""
    shared = rows.sparkSession.sparkContext.broadcast(common(rows)) if with_prefix else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for text in batch.column("text").cast(pa.binary()):
                own = hashes(text.as_py(), powers)
                quarter, bits = signature(own)
                first = prefix(own, *shared.value) if shared else own[:0]
                for column, value in zip(out, (len(own), int(own[0]) if len(own) else 0, quarter, bits, xxhash.xxh3_128_digest(own.tobytes()), first)):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *[pa.array(c, k) for c, k in zip(out, kinds)]], ["row", "n", "low", "quarter", "bits", "digest", "prefix"]
            )

    return rows.select("row", "text").mapInArrow(run, ENTRY)


def entries(described: DataFrame) -> DataFrame:
    """(digest, rep): the row that stands for all rows of equal sets."""
    return save(described.groupBy("digest").agg(F.min("row").alias("rep")), "entries")


def shared(keys: DataFrame) -> DataFrame:
    """The rows (key, place, n) whose key occurs more than once; rows stream by in the order of their keys."""
    names = ["key", "place", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = [np.empty(0, dtype=np.int64) for _ in names], False
        for batch in batches:
            own = [np.concatenate((x, np.asarray(batch.column(name)))) for x, name in zip(own, names)]
            key = own[0]
            if not len(key):
                continue
            again = np.concatenate(([held], key[1:] == key[:-1]))
            keep = again.copy()
            keep[:-1] |= again[1:]
            # The last row waits for the next batch; ``held``: it has the key of the row before it.
            keep[-1] = False
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in own], names)
            own, held = [x[-1:] for x in own], bool(again[-1])
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, own)), names)

    return keys.select(*names).repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, place long, n long")


def placed(sets: DataFrame) -> DataFrame:
    """Entries (row, n, low, ...) with ``place``: their block times BLOCK, and where they stand in it."""
    classed = sets.withColumn("class", F.floor(F.log2(F.greatest("n", F.lit(1))) * 4))
    ordered = with_running(classed, [asc("class"), asc("low"), asc("row")], sums={"total": "n"}, rank="rank")
    # Either term steps on in order, so equal sums are neighbours.
    block = F.floor((F.col("rank") - 1) / BLOCK) + F.floor((F.col("total") - F.col("n")) / BLOCK_SHINGLES)
    inside = Window.partitionBy("block").orderBy("rank")
    place = F.col("block") * BLOCK + F.row_number().over(inside) - 1
    return ordered.withColumn("block", block).withColumn("place", place).drop("class", "rank", "total", "block", "low")


def held_in_blocks(members: DataFrame, *keys: str) -> DataFrame:
    """A row for each of the ``keys`` and block: how many entries (``own``), their sizes and their bits m0..; written."""
    pos = F.col("place") % BLOCK
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    bits = [F.bit_or(F.when(F.floor(pos / 64) == k, bit).otherwise(F.lit(0))).alias(f"m{k}") for k in range(WORDS)]
    at = members.withColumn("block", F.floor(F.col("place") / BLOCK))
    return save(at.groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("own"), F.min("n").alias("least"), F.max("n").alias("most"), *bits), "held")


def block_pairs(members: DataFrame) -> DataFrame:
    """Pairs of blocks a <= b that share a key and whose sizes can match; a0.. and b0.. are the bits of the entries with a shared key."""
    held = held_in_blocks(members, "key")
    other = held.select("key", *[F.col(c).alias(f"_{c}") for c in held.columns if c != "key"])
    two = held.join(other, "key").where("(block < _block) OR (block = _block AND own > 1)").where("5 * most >= 4 * _least AND 5 * _most >= 4 * least")
    grouped = two.groupBy(F.col("block").alias("a"), F.col("_block").alias("b")).agg(
        *[F.bit_or(f"m{k}").alias(f"a{k}") for k in range(WORDS)], *[F.bit_or(f"_m{k}").alias(f"b{k}") for k in range(WORDS)]
    )
    out = save(grouped, "pairs")
    release(held)
    return out


def participants(pairs: DataFrame, where: DataFrame) -> DataFrame:
    """A row (a, b, side, row, ...) for each entry of a pair of blocks that takes part."""
    sides = []
    for side, name in enumerate("ab"):
        words = ", ".join(f"{name}{k}" for k in range(WORDS))
        set_bits = F.expr(f"filter(sequence(0, {BLOCK - 1}), j -> (shiftright(array({words})[cast(j div 64 as int)], j % 64) & 1) = 1)")
        own = pairs if side == 0 else pairs.where("a < b")
        spread = own.select("a", "b", F.col(name).alias("block"), F.explode(set_bits).alias("pos"))
        sides.append(spread.select("a", "b", F.lit(side).alias("side"), (F.col("block") * BLOCK + F.col("pos")).alias("place")))
    # Joined as one row for each entry, with all its pairs: no more of them than there are blocks.
    mine = sides[0].union(sides[1]).groupBy("place").agg(F.collect_list(F.struct("a", "b", "side")).alias("in"))
    return mine.join(where, "place").drop("place").withColumn("in", F.explode("in")).select("in.*", "*").drop("in")


def by_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """Columns of the rows of each pair (a, b); the rows come sorted by a, b and side."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        now = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
        held = {name: np.concatenate((held[name], x)) if held else x for name, x in now.items()}
        a, b = held["a"], held["b"]
        cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
        start = 0
        for stop in cuts.tolist():
            yield int(a[start]), int(b[start]), {name: x[start:stop] for name, x in held.items()}
            start = stop
        held = {name: x[start:] for name, x in held.items()}
    if held and len(held["a"]):
        yield int(held["a"][0]), int(held["b"][0]), held


class Signatures:
    """Signatures of entries or nodes: OR of bitmaps, range of sizes, and what the bitmaps cannot see."""

    def __init__(self, bits: np.ndarray, least: np.ndarray, most: np.ndarray, beyond: np.ndarray, excess: np.ndarray) -> None:
        self.bits, self.least, self.most, self.beyond, self.excess = bits, least, most, beyond, excess

    @classmethod
    def of(cls, bits: list[bytes], n: np.ndarray, quarter: np.ndarray, width: int) -> Signatures:
        out = np.empty((len(bits), width // 64), dtype=np.uint64)
        for i, own in enumerate(bits):
            words = np.frombuffer(own, dtype=np.uint64)
            out[i] = np.bitwise_or.reduce(words.reshape(-1, width // 64), axis=0)
        return cls(out, n, n, n - quarter, quarter - np.bitwise_count(out).sum(axis=1, dtype=np.int64))

    def nodes(self, size: int) -> Signatures:
        at = np.arange(0, len(self.least), size)
        return Signatures(
            np.bitwise_or.reduceat(self.bits, at, axis=0), np.minimum.reduceat(self.least, at),
            *(np.maximum.reduceat(x, at) for x in (self.most, self.beyond, self.excess)),
        )

    def part(self, at: slice) -> Signatures:
        return Signatures(self.bits[at], self.least[at], self.most[at], self.beyond[at], self.excess[at])

    def may_link(self, other: Signatures) -> np.ndarray:
        """Matrix of the pairs whose maximum possible overlap is enough."""
        both = np.empty((len(self.least), len(other.least)), dtype=np.int64)
        for i, own in enumerate(self.bits):
            both[i] = np.bitwise_count(own & other.bits).sum(axis=1, dtype=np.int64)
        both += np.minimum(self.beyond[:, None], other.beyond) + np.minimum(self.excess[:, None], other.excess)
        both = np.minimum(both, np.minimum(self.most[:, None], other.most))
        return both >= required(self.least[:, None] + other.least)


def traverse(left: Signatures, right: Signatures, size: int = NODE) -> np.ndarray:
    """Matrix of the entries that may link, by dual traversal: nodes first, then what is below those that stay."""
    if len(left.least) <= size and len(right.least) <= size:
        return left.may_link(right)
    out = np.zeros((len(left.least), len(right.least)), dtype=bool)
    for i, j in np.argwhere(left.nodes(size).may_link(right.nodes(size))).tolist():
        own, other = slice(i * size, (i + 1) * size), slice(j * size, (j + 1) * size)
        out[own, other] = left.part(own).may_link(right.part(other))
    return out


def sides(own: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows of either side; a block with itself has the same on both."""
    a, b = np.flatnonzero(own["side"] == 0), np.flatnonzero(own["side"] == 1)
    return (a, b) if int(own["a"][0]) != int(own["b"][0]) else (a, a)


def survivors(rows: DataFrame) -> DataFrame:
    """Of the participants those whose signature leaves a partner: a, b, side, row, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        size = 0
        for _, _, own in by_pair(batches):
            a, b = sides(own)
            if not len(a) or not len(b):
                continue
            width = 8 * min(map(len, own["bits"]))
            every = Signatures.of(list(own["bits"]), own["n"], own["quarter"], width)
            left, right = (Signatures(every.bits[x], every.least[x], every.most[x], every.beyond[x], every.excess[x]) for x in (a, b))
            may = traverse(left, right)
            if a is b:
                np.fill_diagonal(may, False)
            keep = np.unique(np.concatenate((a[may.any(axis=1)], b[may.any(axis=0)])))
            for column, name in zip(out, ("a", "b", "side", "row", "n")):
                column.append(own[name][keep])
            size += len(keep)
            if size > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["a", "b", "side", "row", "n"])
                out, size = [[], [], [], [], []], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["a", "b", "side", "row", "n"])

    packed = rows.select("a", "b", "side", "row", "n", "quarter", "bits").repartition("a", "b").sortWithinPartitions("a", "b", "side")
    return packed.mapInArrow(run, "a long, b long, side int, row long, n long")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each left set shares with each right one."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    # Only hashes on both sides matter.
    ours, theirs = (np.unique(np.concatenate(x)) for x in (left, right))
    both = np.intersect1d(ours, theirs, assume_unique=True)

    def codes(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(both, flat)
        found = both[np.minimum(at, len(both) - 1)] == flat if len(both) else np.zeros(len(flat), dtype=bool)
        order = np.argsort(at[found], kind="stable")
        return at[found][order], owner[found][order]

    (code_l, own_l), (code_r, own_r) = codes(left), codes(right)
    for start in range(0, len(both), STRIPE):
        matrices = []
        for code, own, n in ((code_l, own_l, len(left)), (code_r, own_r, len(right))):
            low, high = np.searchsorted(code, [start, start + STRIPE])
            matrix = np.zeros((n, min(STRIPE, len(both) - start)), dtype=np.float32)
            matrix[own[low:high], code[low:high] - start] = 1
            matrices.append(matrix)
        out += matrices[0] @ matrices[1].T
    return out.astype(np.int64)


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links of a symmetric matrix: (place, least place of its component)."""
    label = np.arange(len(near))
    while True:
        least = np.where(near, label[None, :], len(near)).min(axis=1)
        least = np.minimum(least, label)
        least = least[least]
        if (least == label).all():
            return [(i, int(x)) for i, x in enumerate(label) if i != x]
        label = least


def linked(rows: DataFrame) -> DataFrame:
    """(a, b, side, row, n, hashes) -> links a, b of entries: spanning forests of the exact links of each pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, own in by_pair(batches):
            a, b = sides(own)
            if not len(a) or not len(b):
                continue
            sets = [np.frombuffer(x, dtype=np.int64) for x in own["hashes"]]
            n, row = own["n"], own["row"]
            enough = overlaps([sets[i] for i in a], [sets[i] for i in b]) >= required(n[a][:, None] + n[b])
            near = np.zeros((len(row), len(row)), dtype=bool)
            near[np.ix_(a, b)] = enough
            near |= near.T
            links = [(int(row[i]), int(row[j])) for i, j in forest(near)]
            if links:
                x, y = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    packed = rows.select("a", "b", "side", "row", "n", "hashes").repartition("a", "b").sortWithinPartitions("a", "b", "side")
    return packed.mapInArrow(run, "a long, b long")


def hashed(texts: DataFrame) -> DataFrame:
    """(row, text) -> row, hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            found = [hashes(t.as_py(), powers).tobytes() for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.binary())], ["row", "hashes"])

    return texts.select("row", "text").mapInArrow(run, "row long, hashes binary")


def links(members: DataFrame, where: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that connect all entries with similarity 0.8 or more among those that share a key.

    ``members`` are rows (key, place, n), ``where`` the entries (place, row, n, quarter, bits) and ``texts`` (row, text) of at least these.
    """
    return compared(block_pairs(members), where, texts)


def compared(pairs: DataFrame, where: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of the entries that take part in ``pairs`` of blocks, a written table that is released."""
    left = save(survivors(participants(pairs, where)), "survivors")
    forget_shuffles(where.sparkSession)
    found = hashed(texts.join(left.select("row").distinct(), "row", "left_semi"))
    out = save(linked(left.join(found, "row")).distinct(), "links")
    for old in (pairs, left):
        release(old)
    return out


def whole(roots: DataFrame) -> DataFrame:
    """Rows of :func:`components` with the roots themselves."""
    own = roots.select(F.col("node").alias("row"), "root")
    return own.union(roots.select(F.col("root").alias("row"), "root")).distinct()


def grouped(docs: DataFrame, sets: DataFrame, roots: DataFrame, reps: DataFrame) -> DataFrame:
    """(row, doc_id) -> row, doc_id, n, component_id; ``sets`` has row, n, digest, ``reps`` a row per digest and ``roots`` of those."""
    of_row = sets.select("row", "n", "digest").join(reps, "digest", "left").select("row", "n", F.coalesce("rep", "row").alias("rep"))
    of_rep = roots.select(F.col("row").alias("rep"), "root")
    rooted = of_row.join(of_rep, "rep", "left").select("row", "n", F.coalesce("root", "rep").alias("root")).join(docs.select("row", "doc_id"), "row")
    rooted = save(rooted, "rooted")
    # Written, so that Spark can split the rows of a hot class in the join.
    least = save(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return rooted.join(least, "root").select("row", "doc_id", "n", "component_id")


def classes(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text) -> row, doc_id, n (different shingles), component_id."""
    sets = save(described(docs), "sets")
    filled = sets.where("n > 0")
    reps = entries(filled)
    ordered = placed(filled.join(reps.select(F.col("rep").alias("row")), "row", "left_semi").drop("digest"))
    where = save(ordered.drop("prefix"), "placed")
    members = save(shared(ordered.select(F.explode("prefix").alias("key"), "place", "n")), "members")
    forget_shuffles(docs.sparkSession)
    roots = save(whole(components(links(members, where, docs.select("row", "text")))), "roots")
    return grouped(docs, sets, roots, reps)
