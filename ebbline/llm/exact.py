"""Exact dedup by composable polynomial fingerprints.

A normalised text is cut into chunks of 64 KiB.  A chunk's fingerprint is the value of its bytes
as a polynomial, modulo two primes; two neighbouring chunks combine as ``left * base**len(right)
+ right``, so the chunks of a huge document are hashed apart and combined afterwards in order.
Rows with equal length and fingerprint are then compared chunk by chunk with one representative;
rows that differ from it are grouped again, so a collision of fingerprints cannot merge texts.

Only rows of groups of two or more move their text.  The representative's chunk stands once on
one side of the join, so Spark can split the copies of a hot group on the other side.

Nulls: a null text counts as empty; empty texts form a group like any other.  Rows with the same
or a null doc_id are told apart by a number of their own.  Of rows that tie in length and
doc_id, the first in the written table stays; null doc_ids come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import SPACE, release, save, tagged

CHUNK = 1 << 16
#: Primes below 2**31, and the bases of the two polynomials.
MODULI = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 69_069)


def powers(base: int, modulus: int, n: int) -> np.ndarray:
    out = np.empty(n + 1, dtype=np.uint64)
    x = 1
    for i in range(n + 1):
        out[i] = x
        x = x * base % modulus
    return out


def chunk_value(chunk: bytes, table: np.ndarray, modulus: int) -> int:
    """The sum stays below 2**16 * 2**8 * 2**31."""
    b = np.frombuffer(chunk, dtype=np.uint8).astype(np.uint64)
    return int((b * table[len(b) - 1 :: -1][: len(b)]).sum() % np.uint64(modulus)) if len(b) else 0


def text_bytes(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    for x in column.cast(pa.binary()):
        yield x.as_py() or b""


def hashed(rows: DataFrame, moduli: tuple[int, int]) -> DataFrame:
    """(row, text) -> a row per chunk: its length, values and shifts, and facts of the whole text with the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [powers(b, m, CHUNK) for b, m in zip(BASES, moduli)]
        for batch in batches:
            out: list[list] = [[] for _ in schema_names]
            for row, raw in zip(batch.column("row").to_pylist(), text_bytes(batch.column("text"))):
                text = raw.translate(None, SPACE)
                code_points = len(raw.decode("utf-8", "replace"))
                sha = hashlib.sha256(text).hexdigest()
                for no, start in enumerate(range(0, max(len(text), 1), CHUNK)):
                    part = text[start : start + CHUNK]
                    values = [chunk_value(part, t, m) for t, m in zip(tables, moduli)]
                    shifts = [int(t[len(part)]) for t in tables]
                    for column, v in zip(out, (row, no, len(part), *values, *shifts, code_points, sha)):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], schema_names)

    schema_names = ["row", "no", "n", "h1", "h2", "s1", "s2", "code_points", "text_sha256"]
    kinds = [pa.int64()] * 8 + [pa.string()]
    return rows.mapInArrow(
        run, "row long, no long, n long, h1 long, h2 long, s1 long, s2 long, code_points long, text_sha256 string"
    )


def fingerprints(chunks: DataFrame, moduli: tuple[int, int]) -> DataFrame:
    """Combine the chunks of each row in order; a row's list is its own chunks only."""
    parts = F.array_sort(F.collect_list(F.struct("no", "h1", "h2", "s1", "s2")))
    zero = F.struct(F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"))
    fold = F.aggregate(
        "parts", zero,
        lambda left, right: F.struct(
            ((left.h1 * right.s1 + right.h1) % moduli[0]).alias("h1"),
            ((left.h2 * right.s2 + right.h2) % moduli[1]).alias("h2"),
        ),
    )
    return (
        chunks.groupBy("row")
        .agg(parts.alias("parts"), F.sum("n").alias("n"), F.first("code_points").alias("code_points"), F.first("text_sha256").alias("text_sha256"))
        .select("row", "n", fold.alias("h"), "code_points", "text_sha256")
        .select("row", "n", "h.h1", "h.h2", "code_points", "text_sha256")
    )


def cut(rows: DataFrame) -> DataFrame:
    """(row, rep, text) -> (row, rep, no, chunk) of the normalised text."""

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["row", "rep", "no", "chunk"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
        for batch in batches:
            keys = zip(batch.column("row").to_pylist(), batch.column("rep").to_pylist())
            for (row, rep), raw in zip(keys, text_bytes(batch.column("text"))):
                text = raw.translate(None, SPACE)
                for no, start in enumerate(range(0, max(len(text), 1), CHUNK)):
                    yield row, rep, no, text[start : start + CHUNK]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in pieces(batches):
            held.append(piece)
            size += len(piece[3]) + 64
            if size >= 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)

    return rows.mapInArrow(run, "row long, rep long, no long, chunk binary")


def equal_classes(rows: DataFrame, prints: DataFrame) -> DataFrame:
    """(row, class) of every row whose text equals another's; ``class`` is the least row of its texts."""
    open_rows = prints.select("row", "n", "h1", "h2")
    found = None
    while True:
        groups = open_rows.groupBy("n", "h1", "h2").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("size"))
        groups = save(groups.where("size > 1").drop("size"), "groups")
        grouped = save(open_rows.join(groups, ["n", "h1", "h2"]), "grouped")
        # A merge join at every size, so that small tables show what large ones will shuffle.
        texts = save(rows.join(grouped.select("row", "rep").hint("merge"), "row").select("row", "rep", "text"), "copies")
        theirs = cut(texts.where("row = rep")).select("rep", "no", F.col("chunk").alias("first_chunk"))
        compared = (
            cut(texts.where("row <> rep"))
            .join(theirs, ["rep", "no"], "left")
            .select("row", "rep", F.coalesce(F.col("chunk") == F.col("first_chunk"), F.lit(False)).alias("same"))
        )
        verdict = save(compared.groupBy("row", "rep").agg(F.min("same").alias("same")), "verdict")
        now = verdict.where("same").select("row", F.col("rep").alias("class"))
        found = now if found is None else found.union(now)
        differing = verdict.where("not same").select("row")
        release(texts)
        if differing.isEmpty():
            return found
        # A collision of fingerprints: those rows are compared among themselves.
        open_rows = save(grouped.join(differing, "row", "left_semi").select("row", "n", "h1", "h2"), "open")


def exact_groups(docs: DataFrame, moduli: tuple[int, int] = MODULI) -> DataFrame:
    """``doc`` (all columns of ``docs``) with keep_id, group_size, kept and text_sha256, a row per input row."""
    rows = tagged(docs, "exact")
    texts = rows.select("row", F.col("doc.text").alias("text"))
    prints = save(fingerprints(hashed(texts, moduli), moduli), "prints")
    copies = save(equal_classes(texts, prints), "classes")
    members = save(
        prints.join(copies, "row", "left")
        .join(rows.select("row", F.col("doc.doc_id").alias("doc_id")), "row")
        .select("row", "doc_id", F.coalesce("class", "row").alias("class"), "code_points", "text_sha256"),
        "members",
    )
    rank = F.struct("code_points", F.col("doc_id").isNotNull(), -F.col("doc_id"), -F.col("row"))
    best = F.max(F.struct(rank.alias("rank"), "doc_id", "row")).alias("best")
    # Written, so that Spark can split the rows of a hot class in the join below.
    keepers = save(members.groupBy("class").agg(best, F.count(F.lit(1)).alias("group_size")), "keepers")
    decided = members.join(keepers, "class").select(
        "row", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256"
    )
    return rows.join(save(decided, "decided"), "row").drop("row")
