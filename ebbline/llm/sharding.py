"""K-d tree sharding: weighted medians along the widest metadata dimension, DataFrame operations only.

Every document is a point: its doc_id and size, scaled to 2**20 steps of the table's range, and
hashes of its source and language.  A node with k shards to make picks the dimension in which its
points spread most, and splits them at the weight (bytes) that leaves each side its share; after
log2(k) rounds every leaf is a shard.  All nodes of a round share one range-partitioned sort that
ends in a unique key, with running sums per partition and one offset per partition, so neither the
root nor a source with a third of the rows meets in one task.

The law is ``bytes``: a split is off its mark by at most half a document.

Nulls and edges: a null text has no bytes, size 1 and the checksum of the empty text; null
metadata lies at the low end of its dimension.  Rows with the same or a null doc_id are told apart
by a number of their own.  With fewer documents than shards some shards are empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.ordering import asc, with_running
from ebbline.llm.common import release, save, tagged

STEPS = 1 << 20
DIMENSIONS = ("c0", "c1", "c2", "c3")


def scaled(name: str, low, high) -> Column:
    width = (high or 0) - (low or 0)
    x = (F.col(name) - F.lit(low or 0)).cast("double") / F.lit(float(max(width, 1)))
    return F.coalesce(F.floor(x * F.lit(float(STEPS - 1))), F.lit(0)).cast("long")


def hashed(name: str) -> Column:
    return F.coalesce(F.shiftright(F.crc32(F.col(name)), 12), F.lit(0)).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, source, lang) with size and text_crc32 in place of the text."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        "doc_id", "source", "lang", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )


def points(rows: DataFrame) -> DataFrame:
    """``row``, size and coordinates of tagged rows; one pass for the ranges."""
    flat = rows.select("row", *[F.col(f"doc.{c}").alias(c) for c in ("doc_id", "source", "lang", "size")])
    low_id, high_id, low, high = flat.agg(F.min("doc_id"), F.max("doc_id"), F.min("size"), F.max("size")).first()
    return flat.select(
        "row", "size",
        scaled("doc_id", low_id, high_id).alias("c0"), scaled("size", low, high).alias("c1"),
        hashed("source").alias("c2"), hashed("lang").alias("c3"),
    )


def split(nodes: DataFrame) -> DataFrame:
    """One round: rows with ``first`` and ``shards`` (a node's shards) -> the same, each node halved."""
    extents = nodes.groupBy("first").agg(*[(F.max(c) - F.min(c)).alias(c) for c in DIMENSIONS], F.sum("size").alias("total"))
    widest = F.greatest(*DIMENSIONS)
    # At most one row for each shard, at most ``shards`` of them: broadcast below.
    chosen = extents.select(
        "first", "total",
        reduce(lambda other, c: F.when(F.col(c) == widest, c).otherwise(other), DIMENSIONS[::-1], F.lit("c0")).alias("dimension"),
    )
    chosen = save(chosen, "nodes")
    along = F.coalesce(*[F.when(F.col("dimension") == c, F.col(c)) for c in DIMENSIONS])
    placed = nodes.join(F.broadcast(chosen.select("first", "dimension")), "first").withColumn("along", along).drop("dimension")
    summed = with_running(placed, [asc("first"), asc("along"), asc("row")], {"running": "size"}, rank=None)
    before = with_running(chosen, [asc("first")], {"upto": "total"}, rank=None)
    before = before.select("first", "total", (F.col("upto") - F.col("total")).alias("before"))
    left = F.floor(F.col("shards") / 2).cast("long")
    wide = lambda c: c.cast("decimal(38,0)")
    middle = 2 * (F.col("running") - F.col("before")) - F.col("size")
    goes_left = wide(middle) * F.col("shards") < wide(2 * F.col("total")) * left
    one = F.col("shards") == 1
    return summed.join(F.broadcast(before), "first").select(
        F.when(one | goes_left, F.col("first")).otherwise(F.col("first") + left).alias("first"),
        F.when(one, 1).when(goes_left, left).otherwise(F.col("shards") - left).cast("long").alias("shards"),
        "row", "size", *DIMENSIONS,
    )


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``doc`` (doc_id, source, lang, size, text_crc32) with shard and slot, a row per input row.

    Give the number of shards, or the bytes that a shard should hold.
    """
    rows = tagged(measured(docs), "sized")
    if shards is None:
        total = rows.agg(F.sum("doc.size")).first()[0] or 0
        shards = max(1, -(-total // (target_bytes or 1 << 30)))
    nodes = save(points(rows).withColumns({"first": F.lit(0).cast("long"), "shards": F.lit(shards).cast("long")}), "points")
    for _ in range((shards - 1).bit_length()):
        after = save(split(nodes), "points")
        release(nodes)
        nodes = after
    ranked = with_running(nodes.select("first", "row"), [asc("first"), asc("row")], rank="rank")
    # A row per shard.
    least = save(ranked.groupBy("first").agg(F.min("rank").alias("least")), "least")
    slots = ranked.join(F.broadcast(least), "first").select(
        "row", F.col("first").cast("int").alias("shard"), (F.col("rank") - F.col("least")).alias("slot")
    )
    return rows.join(slots, "row").drop("row")
