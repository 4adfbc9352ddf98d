"""A Merkle manifest of a dataset: a digest tree per language, a tree over the languages, and a proof per row.

Leaves get a rank within their group.  The binary digits of the rank are columns; grouping by
them with one digit less each time nests the nodes of a level as structs into their parent,
``LEVELS`` times, so a row of the result is a block of at most 2**LEVELS leaves with all the
digests between.  One shuffle by block serves all levels.  The tops of the blocks are ranked nodes
again and are rolled up the same way, until each group has one top; the tops of the groups, in the
order of their names, then make the last tree.

Proofs come back down: each block is put beside the path of its top by a union and a grouping, and
exploding its nested children level by level puts their siblings in front.  The ranks come from
range partitions of (group, order) and the sums of the partitions before, so a group may hold any
share of the rows.

Nulls and edges: a null field is ``-`` in a leaf.  Rows with a null group are a group of their own,
first of all.  A null order stands first; rows of equal order are ranked by digest, and equal rows
have equal digests, so the tree does not depend on the order of reading.  A null doc_id is never
tampered with.  An empty table has no rows and no root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import release, save

#: Levels of a block: 2**LEVELS leaves and their digests are one row.
LEVELS = 8
PATH = "array<struct<sibling:string,first:boolean>>"


def field(value: Column) -> Column:
    """A value as text with its byte count before it, so that neighbouring fields cannot run together."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    return F.sha2(F.concat(*values), 256)


def row_digest(columns: list[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def ranked(rows: DataFrame, group: str, order: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0, by order and digest) and ``n`` (rows) within their group."""
    by = [F.col(group).asc_nulls_first(), F.col(order).asc_nulls_first(), F.col("digest")]
    ranged = save(rows.repartitionByRange(*by).withColumn("part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy(group, "part").agg(F.count(F.lit(1)).alias("own"))
    # A group's window has a row per range partition at most.
    parts = Window.partitionBy(group)
    offsets = save(
        counts.select(
            F.col(group).alias("_group"), F.col("part").alias("_part"), F.sum("own").over(parts).alias("n"),
            F.coalesce(F.sum("own").over(parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        ),
        "offsets",
    )
    own = F.row_number().over(Window.partitionBy("part", group).orderBy(*by[1:])) - 1
    inside = ranged.withColumn("own", own)
    joined = inside.join(offsets, inside[group].eqNullSafe(offsets["_group"]) & (inside["part"] == offsets["_part"]))
    return joined.withColumn("rank", F.col("own") + F.col("before")).drop("part", "own", "before", "_group", "_part")


def rolled(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(group, n, rank, node) -> a row per block: group, n, block and ``node``, which nests the levels below it.

    ``node`` has ``digest`` and at the bottom anything else.  Level j of a group of n has more than
    one node if n > 2**j; from there on the node is handed up as it is.
    """
    digits = [F.shiftright("rank", j).bitwiseAND(1).cast("int").alias(f"d{j}") for j in range(levels)]
    now = nodes.select("group", "n", F.shiftright("rank", levels).alias("block"), *digits, "node").repartition("group", "block")
    for j in range(levels):
        keys = ["group", "n", "block", *[f"d{i}" for i in range(j + 1, levels)]]
        now = now.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(f"d{j}").alias("digit"), "node"))).alias("run"))
        joined = F.sha2(F.array_join(F.transform("run", lambda k: k["node"]["digest"]), ""), 256)
        own = F.when(F.col("n") > 1 << j, joined).otherwise(F.col("run")[0]["node"]["digest"])
        now = now.select(*keys, F.struct(own.alias("digest"), F.transform("run", lambda k: k["node"]).alias("below")).alias("node"))
    return now


def unrolled(blocks: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Blocks with the ``path`` of their top -> a row per bottom node: group, rank, node, path."""
    now = blocks.select("group", "n", F.col("block").alias("rank"), "node", "path")
    for j in reversed(range(levels)):
        # Of the run's two nodes, what stands beside the own one; a run of one has nothing beside it.
        spread = now.select("group", "n", "rank", "path", F.col("node.below").alias("run"), F.posexplode("node.below").alias("at", "child"))
        beside = F.struct(F.try_element_at("run", 2 - F.col("at"))["digest"].alias("sibling"), (F.col("at") == 0).alias("first"))
        path = F.when(F.col("n") > 1 << j, F.concat(F.array(beside), "path")).otherwise(F.col("path"))
        now = spread.select("group", "n", (F.col("rank") * 2 + F.col("at")).alias("rank"), F.col("child").alias("node"), path.alias("path"))
    return now.drop("n")


def tree(nodes: DataFrame, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """The written blocks of every phase, and the top digest of every group (group, digest)."""
    phases, tops, now = [], None, nodes
    while True:
        blocks = save(rolled(now, levels), "blocks")
        phases.append(blocks)
        done = blocks.where(F.col("n") <= 1 << levels).select("group", F.col("node.digest").alias("digest"))
        tops = done if tops is None else tops.union(done)
        more = F.expr(f"(n + {(1 << levels) - 1}) div {1 << levels}").alias("n")
        now = blocks.where(F.col("n") > 1 << levels).select("group", more, F.col("block").alias("rank"), F.struct("node.digest").alias("node"))
        if now.isEmpty():
            return phases, tops


def proofs(phases: list[DataFrame], tops: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Down from the paths of the groups' tops (group, path): group, rank, node, path of every leaf."""
    above = None
    for blocks in reversed(phases):
        of_tops = tops.join(
            blocks.where(F.col("n") <= 1 << levels).select(F.col("group").alias("_group")).distinct(),
            F.col("group").eqNullSafe(F.col("_group")), "left_semi",
        ).select("group", F.lit(0).cast("long").alias("block"), "path")
        paths = of_tops if above is None else of_tops.union(above.select("group", F.col("rank").alias("block"), "path"))
        # Block and path meet by a grouping: each block has one row of either kind.
        nothing = F.lit(None)
        mixed = blocks.select("group", "block", "n", "node", nothing.cast(PATH).alias("path")).union(
            paths.select("group", "block", nothing.cast("long").alias("n"), nothing.cast(blocks.schema["node"].dataType).alias("node"), "path")
        )
        met = mixed.groupBy("group", "block").agg(
            F.max("n").alias("n"), F.first("node", ignorenulls=True).alias("node"), F.first("path", ignorenulls=True).alias("path")
        )
        above = save(unrolled(met, levels), "paths") if blocks is not phases[0] else unrolled(met, levels)
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    def step(now: Column, run: Column) -> Column:
        beside = F.coalesce(run["sibling"], F.lit(""))
        return F.sha2(F.when(run["first"], F.concat(now, beside)).otherwise(F.concat(beside, now)), 256)

    return F.aggregate(path, leaf, step)


def path_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda run: run["sibling"]), ""), 256)


def manifest(rows: DataFrame, group: str, order: str, levels: int = LEVELS) -> DataFrame:
    """``rows`` (with a column ``digest`` per row) -> ``row`` (all of their columns), subroot, root and path."""
    payload = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    packed = rows.select(F.col(f"`{group}`").alias("group"), F.col(f"`{order}`").alias("order"), "digest", payload.alias("row"))
    leaves = ranked(packed, "group", "order").select("group", "n", "rank", F.struct("digest", "row").alias("node"))
    phases, tops = tree(leaves, levels)
    subroots = save(tops.withColumn("order", F.col("group").cast("string")), "subroots")
    # The groups themselves are the leaves of one more tree, of a single group.
    one = ranked(subroots.select(F.lit(0).alias("all"), "order", "digest", F.col("group").alias("name")), "all", "order")
    upper, top = tree(one.select(F.col("all").alias("group"), "n", "rank", F.struct("digest", "name").alias("node")), levels)
    first = top.select("group", F.array().cast(PATH).alias("path"))
    root = top.first()
    of_groups = proofs(upper, first, levels).select(F.col("node.name").alias("group"), F.col("node.digest").alias("subroot"), "path")
    of_groups = save(of_groups, "groups")
    found = proofs(phases, of_groups.select("group", "path"), levels)
    # A row per group; its size is the number of languages, and Spark decides how to join it.
    named = of_groups.select(F.col("group").alias("_group"), "subroot")
    joined = found.join(named, F.col("group").eqNullSafe(F.col("_group")))
    return joined.select(F.col("node.row").alias("row"), "subroot", F.lit(root.digest if root else None).cast("string").alias("root"), "path")
