"""A prefix trie over conversations, built as a burst trie.

A conversation is the sequence of its turns' ids (128 bits of a digest of role and text) with
the byte sizes of the texts; equal conversations are one sequence with a count.  Every sequence
starts in the container of the root.  A container with more than ``MOST_ROWS`` sequences or
``MOST_TURNS`` turns bursts: what all its sequences share becomes a path of nodes, and the id of
the next turn deals them to new containers below it.  Containers that are small enough are sorted
by Spark and swept once, keeping the path of the current sequence on a stack, which gives all
nodes below the container's head.  What the heads sum up over their subtrees is added from the last
burst to the first.

Sharing of a third of all first turns is a burst like any other; many equal conversations are one
sequence.  A chain of bursts is as long as the branchings on one path whose subtrees are all too
large; stretches without a branching take one burst.

Nulls and edges: rows without a conv_id belong to no conversation.  A null role or text is empty, a
null turn stands first.  Turns of one conversation with equal numbers stand by role and text.  A
conversation without turns is a member of the root.  No conversations give no nodes.  The ids of one
conversation's turns have to fit into a row; its texts are never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import save

MOST_ROWS = 4096
MOST_TURNS = 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()
TURNS = "array<struct<id:binary,bytes:bigint>>"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, turns in their order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    # Equal numbers: by role and text, as digests; equal digests are equal turns.
    at = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", key.alias("id"), F.octet_length(text).cast("long").alias("bytes"))
    own = rows.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(at)).alias("turns"))
    return own.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes"))).alias("turns"))


def sequences(convs: DataFrame) -> DataFrame:
    """(conv_id, turns) -> a row per different sequence: turns, n, least, ends (digest of its conv_ids, ascending)."""
    whole = F.sha2(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), ""), 256)
    keyed = save(convs.select("conv_id", "turns", whole.alias("key")), "keyed")
    groups = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    several = save(groups.where("n > 1"), "several")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of key and conv_id: a digest grows while its key stays."""
        last, state = None, None
        for batch in batches:
            keys, ends = [], []
            for key, own in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if key == last:
                    state.update(f",{own}".encode())
                    continue
                if last is not None:
                    keys.append(last)
                    ends.append(state.hexdigest())
                last, state = key, hashlib.sha256(str(own).encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ends, pa.string())], ["key", "ends"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([state.hexdigest()])], ["key", "ends"])

    shared = keyed.select("key", "conv_id").join(several.select("key"), "key", "left_semi")
    ends = shared.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(run, "key string, ends string")
    counted = several.join(ends, "key")
    first = keyed.join(counted.select("key", "n", F.col("least"), "ends"), "key", "left")
    alone = F.sha2(F.col("conv_id").cast("string"), 256)
    return first.where("least is null or conv_id = least").select(
        "turns", F.coalesce("n", F.lit(1)).alias("n"), F.col("conv_id").alias("least"), F.coalesce("ends", alone).alias("ends")
    )


class Sweep:
    """The nodes of one container from its sorted sequences; the path of the last sequence is open."""

    def __init__(self, depth: int, parent: int | None, bytes_: int) -> None:
        self.depth, self.parent = depth, parent
        # n, least, children, leaves, saved, ends, bytes, finished nodes that wait for this one's least
        self.open = [[0, None, 0, 0, 0, EMPTY, bytes_, []]]
        self.last: list = []

    def add(self, turns: list, n: int, least: int, ends: str) -> None:
        """``turns`` are the (id, bytes) after the head, in sorted order of sequences."""
        same = 0
        for a, b in zip(self.last, turns):
            if a[0] != b[0]:
                break
            same += 1
        self.close(same)
        self.open += [[0, None, 0, 0, 0, EMPTY, size, []] for _, size in turns[same:]]
        self.last = turns
        top = self.open[-1]
        top[0], top[1], top[5] = n, least, ends

    def close(self, keep: int) -> None:
        """Finish the nodes below the first ``keep`` of the open path."""
        while len(self.open) > keep + 1:
            depth = self.depth + len(self.open) - 1
            node, above = self.open.pop(), self.open[-1]
            row = self.finish(node, depth)
            above[0] += node[0]
            above[1] = node[1] if above[1] is None else min(above[1], node[1])
            above[2] += 1
            above[3] += node[3]
            above[4] += node[4]
            above[7].append(row)

    def finish(self, node: list, depth: int) -> list:
        n, least, children, leaves, saved, ends, size, _ = node
        node[3], node[4] = (leaves if children else 1), saved + (n - 1) * size
        return [least, depth, None, n, children, node[3], node[4], ends, node[7]]

    def rows(self) -> Iterator[tuple]:
        """All nodes, the head first."""
        self.close(0)
        waiting = [(self.finish(self.open[0], self.depth), self.parent)]
        while waiting:
            row, parent = waiting.pop()
            below = row.pop()
            row[2] = parent
            waiting += [(child, row[0]) for child in below]
            yield tuple(row)


def swept(containers: DataFrame) -> DataFrame:
    """Rows head, depth, parent, bytes, turns (after the head), n, least, ends -> NODE, and ``head`` in the row of a head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "head"]
        kinds = [pa.int64()] * 7 + [pa.string(), pa.string()]
        head, sweep = None, None

        def rows() -> pa.RecordBatch:
            found = [(*row, head if i == 0 else None) for i, row in enumerate(sweep.rows())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("head", "depth", "parent", "bytes", "turns", "n", "least", "ends")]
            for own, depth, parent, size, turns, n, least, ends in zip(*columns):
                if own != head:
                    if sweep is not None:
                        yield rows()
                    head, sweep = own, Sweep(depth, parent, size)
                sweep.add([(t["id"], t["bytes"]) for t in turns], n, least, ends)
        if sweep is not None:
            yield rows()

    return containers.mapInArrow(run, f"{NODE}, head string")


def trie(convs: DataFrame, most_rows: int = MOST_ROWS, most_turns: int = MOST_TURNS) -> DataFrame:
    """(conv_id, turns) -> a row per node: NODE."""
    whole = sequences(convs)
    # head: digest of the path; parent: least conv_id of the node above; up: the head that burst; turns: those after the head.
    now = save(
        whole.select(
            F.lit("").alias("head"), F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("depth"),
            F.lit(None).cast("long").alias("parent"), F.lit(0).cast("long").alias("bytes"), "turns", "n", "least", "ends",
        ),
        "container",
    )
    closed, bursts = [], []
    while True:
        sizes = now.groupBy("head", "up").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.size("turns")).alias("own_turns"), F.sum("n").alias("n_convs"), F.min("least").alias("first"),
            F.min("turns").alias("low"), F.max("turns").alias("high"),
        )
        large = (F.col("rows") > most_rows) | ((F.col("own_turns") > most_turns) & (F.col("rows") > 1))
        # All sequences share what the least and the greatest share.
        differ = F.transform(F.arrays_zip("low", "high"), lambda p: ~p["low"]["id"].eqNullSafe(p["high"]["id"]))
        shared = F.array_position(differ, True) - 1
        shared = F.when(shared < 0, F.size(differ)).otherwise(shared).cast("int")
        full = save(sizes.where(large).withColumn("shared", shared).withColumn("path", F.expr("slice(low, 1, shared)")).drop("low", "high", "rows", "own_turns"), "full")
        if full.isEmpty():
            closed.append(now)
            break
        closed.append(now.join(full.select("head"), "head", "left_anti"))
        open_ = save(now.join(full.drop("up"), "head"), "bursting")
        ending = open_.where("size(turns) = shared").select("head", F.col("ends").alias("own_ends"))
        top = now.select("head", "depth", "parent", "bytes").distinct()
        bursts.append(save(full.join(top, "head").join(ending, "head", "left"), "burst"))
        turn = F.expr("turns[shared]")
        now = save(
            open_.where("size(turns) > shared").select(
                F.sha2(F.concat("head", F.array_join(F.transform(F.expr("slice(turns, 1, shared + 1)"), lambda t: F.hex(t["id"])), "")), 256).alias("head"),
                F.col("head").alias("up"), (F.col("depth") + F.col("shared") + 1).alias("depth"), F.col("first").alias("parent"), turn["bytes"].alias("bytes"),
                F.expr("slice(turns, shared + 2, greatest(size(turns) - shared - 1, 0))").alias("turns"), "n", "least", "ends",
            ),
            "container",
        )
    whole_rows = None
    below = None
    for level in reversed(range(len(closed))):
        rows = save(swept(closed[level].drop("up").repartition("head").sortWithinPartitions("head", "turns")), "nodes")
        ups = closed[level].select("head", "up").distinct()
        tops = rows.where("head is not null").join(ups, "head").select("up", "n_leaves", "saved_tokens")
        whole_rows = rows.drop("head") if whole_rows is None else whole_rows.union(rows.drop("head"))
        if level < len(bursts):
            heads = save(burst_nodes(bursts[level], below), "heads")
            whole_rows = whole_rows.union(heads.select(*rows.drop("head").columns))
            tops = tops.union(heads.where("at = 0").select("up", "n_leaves", "saved_tokens"))
        below = tops.groupBy("up").agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    return whole_rows


def burst_nodes(burst: DataFrame, below: DataFrame) -> DataFrame:
    """Nodes of the heads that burst and of their paths, with ``up`` and the place ``at`` on the path (0: the head)."""
    known = burst.join(below.withColumnRenamed("up", "head"), "head")
    sizes = F.concat(F.array("bytes"), F.transform("path", lambda t: t["bytes"]))
    spread = known.select("*", sizes.alias("sizes"), F.posexplode(sizes).alias("at", "own"))
    last = F.col("at") == F.col("shared")
    # What the nodes from here down the path save, and then all below it.
    rest = F.aggregate(F.expr("slice(sizes, at + 1, shared + 1 - at)"), F.lit(0).cast("long"), lambda a, b: a + b)
    return spread.select(
        F.col("first").alias("conv_id"), (F.col("depth") + F.col("at")).alias("depth"), F.when(F.col("at") == 0, F.col("parent")).otherwise(F.col("first")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * rest).alias("saved_tokens"), F.when(last, F.coalesce("own_ends", F.lit(EMPTY))).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
        "up", "at",
    )


def rebuilt(rows: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % group before its own turns after the first h; h = crc32(c) % heads."""
    own = save(conversations(rows), "conversations")
    base = own.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, heads).alias("before"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads)).cast("int")
    joined = own.withColumn("h", h).join(base, F.col("conv_id") - F.col("conv_id") % group == F.col("_base"), "left")
    before = F.coalesce(F.expr("slice(before, 1, h)"), F.array().cast(TURNS))
    return joined.select("conv_id", F.concat(before, F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")).alias("turns"))
