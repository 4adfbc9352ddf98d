"""Oversampling the smaller class with exact nearest neighbours.

All rows of the smaller class take part.  Many are dealt to cells of rows near one another, and a row
is compared only with cells that may hold something nearer than what its own one has.  Class weights
(:func:`ebbline.ml.prep.with_class_weight`) balance without it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.ordering import asc, with_running
from ebbline.ml.prep import class_counts
from ebbline.session import write_table

#: Rows that :func:`fit_rows` takes unless told otherwise; the queries and models take all.
MAX_FIT_ROWS = 20_000
#: Rows that a task compares with others at a time.
BLOCK_ROWS = 20_000
QUERY_ROWS = 256
#: Queries that are searched together among the rows of another cell, and rows of a cell that are taken or left together.
GROUP_ROWS, LEAF_ROWS = 128, 128
#: Points that a group of queries meets at once, and those of them of which only the least distance bounds the search.
POINTS, GROUPED = 1024, 16
#: Main directions in which such leaves are told apart.
LEAF_AXES = 12
#: Candidates of neighbours that are measured at a time.
MEASURED = 100_000
SYNTHETIC = "synthetic"


def uniform(*parts) -> F.Column:
    """Number in [0, 1) that depends on the values only, not on partitioning."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def fit_rows(train: DataFrame, key: str, max_rows: int = MAX_FIT_ROWS, seed: int = 42) -> DataFrame:
    """At most ``max_rows`` rows, those with the least hash of the key."""
    return train.orderBy(uniform(F.col(key), F.lit(seed), F.lit("fit")), key).limit(max_rows)


def oversample(
    train: DataFrame,
    features: Sequence[str],
    key: str = "customer_id",
    label: str = "label",
    k: int = 5,
    seed: int = 42,
    max_rows: int | None = None,
) -> DataFrame:
    """All rows of ``train`` (or :func:`fit_rows` of it) plus synthetic rows of the smaller class, up to parity.

    A synthetic row lies between a base row and one of its ``min(k, n - 1)``
    nearest rows of the same class.  Nothing is added when a class is absent, the
    smaller one has fewer than two rows, or the classes are equal.
    """
    own = train.select(key, *features, label)
    chosen = write_table(own if max_rows is None else fit_rows(own, key, max_rows, seed), "labelled")
    base = chosen.withColumn(SYNTHETIC, F.lit(False))
    counts = class_counts(chosen, label)
    minority = min(counts, key=lambda c: counts[c])
    n, need = counts[minority], abs(counts[0] - counts[1])
    if n < 2 or need == 0:
        return base
    k = max(1, min(k, n - 1))
    doubles = [F.col(f).cast("double").alias(f) for f in features]
    rows = write_table(chosen.where(F.col(label) == minority).select(key, *doubles), "minority")

    # Every row is a base need // n times; the rest goes to the first rows in hash order.
    order = rows.select(key, uniform(F.col(key), F.lit(seed), F.lit("base")).alias("_h"))
    draws = with_running(order, [asc("_h"), asc(key)], rank="_r").select(
        key, (F.lit(need // n) + F.when(F.col("_r") <= need % n, 1).otherwise(0)).alias("_copies")
    )
    bases = write_table(rows.join(draws.where("_copies > 0"), key), "bases")
    near = nearest(rows, bases.select(key), features, key, k)
    lists = near.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "neighbor"))).alias("_near"))

    drawn = (
        bases.join(lists, key)
        .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .withColumn("_pick", F.floor(uniform(F.col(key), F.col("_i"), F.lit(seed), F.lit("near")) * F.size("_near")))
        .withColumn("_u", uniform(F.col(key), F.col("_i"), F.lit(seed), F.lit("step")))
        .withColumn("_to", F.col("_near")[F.col("_pick").cast("int")]["neighbor"])
    )
    targets = rows.select(F.col(key).alias("_to"), *[F.col(f).alias(f"_t_{f}") for f in features])
    types = dict(train.dtypes)
    mixed = drawn.join(targets, "_to").select(
        key,
        *[
            (F.col(f) + F.col("_u") * (F.col(f"_t_{f}") - F.col(f))).alias(f) for f in features
        ],
        F.lit(minority).cast(types[label]).alias(label),
        F.lit(True).alias(SYNTHETIC),
    )
    return base.withColumns({f: F.col(f).cast("double") for f in features}).unionByName(mixed)


def nearest(rows: DataFrame, queries: DataFrame, features: Sequence[str], key: str, k: int) -> DataFrame:
    """Exact ``k`` nearest other rows of each query: ``key, neighbor, distance, rank``; ties by the neighbour's key.

    Up to ``BLOCK_ROWS`` rows go to all tasks, with the queries spread over them; more are compared in blocks.
    """
    n = rows.count()
    if n > BLOCK_ROWS:
        return nearest_blocked(rows, queries, features, key, k, n)
    points = rows.select(key, *features).toPandas().sort_values(key)
    names = list(features)
    shared = rows.sparkSession.sparkContext.broadcast((points[key].to_numpy(), points[names].to_numpy(dtype=float)))

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, x = shared.value
        for part in parts:
            for at in range(0, len(part), QUERY_ROWS):
                own = part.iloc[at : at + QUERY_ROWS]
                yield closest(own[key].to_numpy(), own[names].to_numpy(dtype=float), ids, x, key, k)

    kind = dict(rows.dtypes)[key]
    asked = rows.join(queries.select(key), key, "left_semi").select(key, *features)
    return asked.mapInPandas(search, f"{key} {kind}, neighbor {kind}, distance double, rank int")


@dataclass(frozen=True)
class Cells:
    """Space halved again and again: by each of ``axes`` of the turned rows in turn, at a cut of its own for every cell so far."""

    centre: np.ndarray
    turn: np.ndarray
    axes: tuple[int, ...] = ()
    cuts: tuple[np.ndarray, ...] = ()

    def turned(self, x: np.ndarray) -> np.ndarray:
        """The rows in their main directions; distances stay what they are."""
        return (x - self.centre) @ self.turn

    def of(self, z: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(z), dtype=np.int64)
        for axis, cuts in zip(self.axes, self.cuts):
            cell = 2 * cell + (z[:, axis] > cuts[cell])
        return cell


def matrix(rows: pa.RecordBatch | pa.Table, names: Sequence[str]) -> np.ndarray:
    columns = [rows.column(c).to_numpy() if isinstance(rows, pa.Table) else rows.column(c).to_numpy(zero_copy_only=False) for c in names]
    return np.column_stack([c.astype(float) for c in columns]) if columns else np.empty((rows.num_rows, 0))


def main_directions(rows: DataFrame, names: Sequence[str]) -> tuple[Cells, np.ndarray]:
    """A turn of space to the main directions of all rows, and the spread of the rows along each."""
    d = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(d), np.zeros((d, d))
        for batch in batches:
            x = matrix(batch, names)
            x = x[np.isfinite(x).all(axis=1)]
            n, total, square = n + len(x), total + x.sum(axis=0), square + x.T @ x
        yield pa.RecordBatch.from_pydict({"n": [n], "total": [total.tolist()], "square": [square.ravel().tolist()]})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[np.array(batch.column(c).to_pylist(), dtype=float).sum(axis=0) for c in range(3)] for batch in batches if batch.num_rows]
        n, total, square = (sum(p[c] for p in parts) for c in range(3))
        yield pa.RecordBatch.from_pydict({"n": [int(n)], "total": [np.ravel(total).tolist()], "square": [np.ravel(square).tolist()]})

    schema = "n long, total array<double>, square array<double>"
    sums = rows.select(*names).mapInArrow(run, schema).repartition(1).mapInArrow(added, schema).first()
    n = max(sums["n"], 1)
    centre = np.array(sums["total"]) / n
    square = np.array(sums["square"]).reshape(d, d) / n - np.outer(centre, centre)
    if not np.isfinite(square).all():
        return Cells(np.zeros(d), np.eye(d)), np.ones(d)
    spread, turn = np.linalg.eigh(square)
    return Cells(centre, turn[:, ::-1]), np.sqrt(np.maximum(spread[::-1], 0))


def halved(rows: DataFrame, names: Sequence[str], halvings: int) -> Cells:
    """Cells of about as many rows each: every halving is at the medians along the direction in which cells are then widest."""
    cells, spread = main_directions(rows, names)
    for _ in range(halvings):
        if not spread.any():
            break
        axis, so_far = int(spread.argmax()), cells
        spread[axis] /= 2

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                z = so_far.turned(matrix(batch, names))
                yield pa.RecordBatch.from_pydict({"cell": so_far.of(z), "place": z[:, axis]})

        places = rows.select(*names).mapInArrow(run, "cell long, place double").where(~F.isnan("place"))
        cuts = np.zeros(1 << len(cells.axes))
        for r in places.groupBy("cell").agg(F.percentile_approx("place", 0.5, 1000).alias("cut")).collect():
            cuts[r["cell"]] = r["cut"]
        cells = replace(cells, axes=(*cells.axes, axis), cuts=(*cells.cuts, cuts))
    return cells


def lower(z: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least square of the distance from each point to anything in each box."""
    out = np.zeros((len(z), len(low)))
    for j in range(z.shape[1]):
        own = z[:, j, None]
        gap = np.maximum(low[:, j] - own, own - high[:, j])
        np.maximum(gap, 0, out=gap)
        gap *= gap
        out += gap
    return out


def within(z: np.ndarray, reach: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which boxes may hold something in reach of each point; rounding is allowed for."""
    far = max((np.square(x).sum(axis=1).max() for x in (z, low, high) if len(x)), default=0.0)
    square = reach * reach
    return lower(z, low, high) <= (square + 1e-9 * (1 + square) + 1e-12 * far)[:, None]


def leaves_of(z: np.ndarray, size: int) -> list[np.ndarray]:
    """The rows in groups of at most ``size`` near one another, by halving."""
    out, todo = [], [np.arange(len(z))]
    while todo:
        at = todo.pop()
        if len(at) <= size or not z.shape[1]:
            out.append(at)
            continue
        own = z[at]
        half, axis = len(at) // 2, (own.max(axis=0) - own.min(axis=0)).argmax()
        order = np.argpartition(own[:, axis], half)
        todo += [at[order[half:]], at[order[:half]]]
    return out


def lists(i: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """The values of each of ``n`` rows as a list; ``i`` is the row of each value, in order."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(i, np.arange(n + 1)).astype(np.int32)), values)


def in_order(asked: pa.Table, points: pa.Table, key: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers for the keys of both sides that are in the order of the keys, and the order of the points by them."""
    keys = pd.concat([asked.column(key).to_pandas(), points.column(key).to_pandas()], ignore_index=True)
    codes, _ = pd.factorize(keys, sort=True)
    codes[codes < 0] = len(codes)
    own, ids = codes[: asked.num_rows], codes[asked.num_rows :]
    order = np.argsort(ids, kind="stable")
    return own, ids[order], order


def nearest_blocked(rows: DataFrame, queries: DataFrame, features: Sequence[str], key: str, k: int, n: int) -> DataFrame:
    """:func:`nearest` over cells of about ``BLOCK_ROWS`` rows near one another.

    A query meets all rows of its own cell first.  The k-th distance found there bounds what it still looks for, so it
    is sent only to cells whose box comes as near as that, and meets there only groups of rows that do.  Rows far from
    all others go to most cells: then it is all with all again.  Tasks hold a cell and a bounded number of queries.
    """
    names, kind, most = list(features), dict(rows.dtypes)[key], 2 * BLOCK_ROWS
    fine = reduce(lambda a, b: a & b, [F.abs(F.col(c).cast("double")) < F.lit(math.inf) for c in names], F.lit(True))
    points = write_table(rows.select(key, *[F.col(c).cast("double").alias(c) for c in names]).where(fine), "points")
    cells = halved(points, names, max(1, math.ceil(math.log2(n / BLOCK_ROWS))))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = cells.turned(matrix(batch, names))
            yield pa.RecordBatch.from_arrays([pa.array(cells.of(z)), *[pa.array(own) for own in z.T]], ["cell", *[f"z{i}" for i in range(len(names))]])

    boxes = points.select(*names).mapInArrow(placed, ", ".join(["cell long", *[f"z{i} double" for i in range(len(names))]])).groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), *[f(f"z{i}").alias(f"{s}{i}") for s, f in (("low", F.min), ("high", F.max)) for i in range(len(names))]
    ).orderBy("cell").collect()
    # A cell of too many rows, since they are alike, is dealt to several blocks with its box.
    parts = [-(-r["n"] // most) for r in boxes]
    first = np.concatenate([[0], np.cumsum(parts)]).astype(int).tolist()
    low, high = (np.repeat(np.array([[r[f"{s}{i}"] for i in range(len(names))] for r in boxes]).reshape(len(boxes), len(names)), parts, axis=0) for s in ("low", "high"))
    spark, blocks = rows.sparkSession, first[-1]

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("_cell", pa.array(cells.of(cells.turned(matrix(batch, names)))))

    of_cell = spark.createDataFrame([(r["cell"], f, p) for r, f, p in zip(boxes, first, parts)], "_cell long, _first int, _parts int")
    schema = ", ".join([f"`{key}` {kind}", *[f"`{c}` double" for c in names]])
    homes = points.mapInArrow(at_home, f"{schema}, _cell long").join(F.broadcast(of_cell), "_cell")
    block = (F.col("_first") + F.pmod(F.xxhash64(key), F.col("_parts"))).cast("int").alias("_block")
    points = write_table(homes.select(key, *names, block), "cells")
    asked = points.join(queries.select(key), key, "left_semi")
    # Aliases set the two sides apart.
    points = points.select(*[F.col(c).alias(c) for c in (key, *names, "_block")])

    def at_home_first(asked: pa.Table, points: pa.Table) -> pa.Table:
        own, ids, order = in_order(asked, points, key)
        a, b, size = matrix(asked, names), matrix(points, names)[order], asked.num_rows
        found = [best(own[at : at + QUERY_ROWS], a[at : at + QUERY_ROWS], ids, b, k) for at in range(0, size, QUERY_ROWS)]
        i, j, distance = (np.concatenate([f[c] + (at * QUERY_ROWS if c == 0 else 0) for at, f in enumerate(found)] or [np.empty(0, dtype=int)]) for c in range(3))
        reach = np.full(size, np.inf)
        last = np.flatnonzero(np.arange(len(i)) - np.searchsorted(i, i) == k - 1)
        reach[i[last]] = distance[last]
        z, step, go = cells.turned(a), max(1, (1 << 22) // max(blocks, 1)), []
        home = np.array(asked.column("_block"))
        for at in range(0, size, step):
            near = within(z[at : at + step], reach[at : at + step], low, high)
            near[np.arange(len(near)), home[at : at + step]] = False
            r, c = np.nonzero(near)
            go.append((r + at, c))
        r, c = (np.concatenate([g[x] for g in go] or [np.empty(0, dtype=int)]) for x in range(2))
        neighbor = points.column(key).combine_chunks().take(pa.array(order[j]))
        out = asked.select([key, *names]).append_column("_reach", pa.array(reach))
        out = out.append_column("_blocks", lists(r, size, pa.array(c.astype(np.int32))))
        return out.append_column("_neighbors", lists(i, size, neighbor)).append_column("_distances", lists(i, size, pa.array(distance.astype(float))))

    tasks = 2 * blocks
    near = write_table(
        asked.repartition(tasks, "_block").groupBy("_block").cogroup(points.repartition(tasks, "_block").groupBy("_block"))
        .applyInArrow(at_home_first, f"{schema}, _reach double, _blocks array<int>, _neighbors array<{kind}>, _distances array<double>"),
        "near",
    )
    home = near.select(key, F.explode(F.arrays_zip("_neighbors", "_distances")).alias("_n")).select(
        key, F.col("_n._neighbors").alias("neighbor"), F.col("_n._distances").alias("distance")
    )

    # A block that very many queries come to is sent to a task for each of their parts.
    sent = near.select(F.explode("_blocks").alias("_block")).groupBy("_block").count().collect()
    shares = [(r["_block"], -(-r["count"] // (2 * most))) for r in sent]
    of_block = F.broadcast(spark.createDataFrame(shares, "_block int, _shares int"))
    asked = near.select(key, *names, "_reach", F.explode("_blocks").alias("_block")).join(of_block, "_block").select(
        key, *names, "_reach", "_block", F.pmod(F.xxhash64(key, F.lit(1)), F.col("_shares")).cast("int").alias("_share")
    )
    shared = points.join(of_block, "_block").select(key, *names, "_block", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)).alias("_share"))
    others = shared.select(*[F.col(c).alias(c) for c in (key, *names, "_block", "_share")])

    def elsewhere(asked: pa.Table, points: pa.Table) -> pa.Table:
        own, ids, order = in_order(asked, points, key)
        a, b, reach = matrix(asked, names), matrix(points, names)[order], asked.column("_reach").to_numpy()
        z, y = (cells.turned(x)[:, :LEAF_AXES] for x in (a, b))
        leaves = leaves_of(y, LEAF_ROWS)
        least, greatest = (np.array([f(y[leaf], axis=0) for leaf in leaves]) for f in (np.min, np.max))
        # Queries near the same leaf are searched together.
        middle = (least + greatest) / 2
        home = [((middle * middle).sum(axis=1) - 2 * z[at : at + most] @ middle.T).argmin(axis=1) for at in range(0, len(z), most)]
        queue, found = np.argsort(np.concatenate(home or [np.empty(0, dtype=int)]), kind="stable"), []
        for at in range(0, len(queue), GROUP_ROWS):
            group = queue[at : at + GROUP_ROWS]
            some = within(z[group], reach[group], least, greatest).any(axis=0)
            if some.any():
                here = np.sort(np.concatenate([leaves[leaf] for leaf in np.flatnonzero(some)]))
                i, j, distance = best(own[group], a[group], ids[here], b[here], k, reach[group])
                found.append((group[i], here[j], distance))
        i, j, distance = (np.concatenate([f[c] for f in found] or [np.empty(0, dtype=int)]) for c in range(3))
        return pa.table({
            key: asked.column(key).combine_chunks().take(pa.array(i)), "neighbor": points.column(key).combine_chunks().take(pa.array(order[j])),
            "distance": distance.astype(float),
        })

    tasks, by = 2 * sum(s for _, s in shares), ("_block", "_share")
    found = home
    if shares:
        found = home.unionByName(
            asked.repartition(tasks, *by).groupBy(*by).cogroup(others.repartition(tasks, *by).groupBy(*by))
            .applyInArrow(elsewhere, f"`{key}` {kind}, neighbor {kind}, distance double")
        )
    # At most k rows of each block for a query.
    rank = F.row_number().over(Window.partitionBy(key).orderBy("distance", "neighbor"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def best(own: np.ndarray, a: np.ndarray, ids: np.ndarray, b: np.ndarray, k: int, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest of the points ``b`` (in the order of their ids) for each query, itself excluded: query, point and distance, nearest first.

    Points that are not finite are no neighbours and have none.  With ``reach`` none is farther than that of its query.
    """
    a2, b2 = (a * a).sum(axis=1), (b * b).sum(axis=1)
    for mine, x in ((True, a2), (False, b2)):
        fine = np.isfinite(x)
        if not fine.all():
            at = np.flatnonzero(fine)
            if mine:
                i, j, distance = best(own[at], a[at], ids, b, k, None if reach is None else reach[at])
                return at[i], j, distance
            i, j, distance = best(own, a, ids[at], b[at], k, reach)
            return i, at[j], distance
    out = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))]
    if not len(a) or not len(b):
        return out[0]
    # The dot form cancels digits: take a little more than k, then measure by differences.
    more = 1e-9 + 1e-12 * (a2 + b2.max())
    bound = np.full(len(a), np.inf) if reach is None else reach * reach * (1 + 1e-9) + more - a2
    least, numbers = np.empty((len(a), 0)), ids.dtype.kind in "iuf" and own.dtype.kind in "iuf"
    start, stop = (np.searchsorted(ids, own, side) for side in ("left", "right")) if numbers else (None, None)
    # Squares of distances, but for the query's own square: it is the same for all points.
    left, right = np.concatenate((-2 * a, np.ones((len(a), 1))), axis=1), np.concatenate((b, b2[:, None]), axis=1)
    near: list[np.ndarray] = []
    for at in range(0, len(b), POINTS):
        square = left @ right[at : at + POINTS].T
        width = square.shape[1]
        if numbers:
            for place in range((stop - start).max()):
                same = np.flatnonzero((start + place < stop) & (start + place >= at) & (start + place < at + width))
                square[same, start[same] + place - at] = np.inf
        else:
            square[own[:, None] == ids[None, at : at + width]] = np.inf
        if reach is None:
            # The k-th of the least of groups is not below the k-th of all so far.
            group = width // GROUPED if width >= 4 * k * GROUPED else width
            least = np.concatenate((least, square[:, :group]), axis=1)
            own_least = least[:, -group:]
            for other in range(group, width - group + 1, group):
                np.minimum(own_least, square[:, other : other + group], out=own_least)
            if least.shape[1] >= k:
                least = np.partition(least, k - 1, axis=1)[:, :k]
                bound = least.max(axis=1) + more + 1e-9 * np.abs(least.max(axis=1))
        near.append(np.flatnonzero(square <= bound[:, None]))
        rows, columns = near[-1] // width, near[-1] % width + at
        near[-1] = rows * len(b) + columns
    flat = np.concatenate(near)
    flat = np.sort(flat) if len(near) > 1 else flat
    rows, columns = flat // len(b), flat % len(b)
    if not np.isfinite(bound).all():
        # A bound that is not finite lets the query's own row pass.
        other = own[rows] != ids[columns]
        rows, columns = rows[other], columns[other]
    # Rows with very many ties are measured a few at a time.
    part = np.cumsum(np.bincount(rows, minlength=len(a))) // MEASURED
    for i, j in zip(*(np.split(x, np.flatnonzero(np.diff(part[rows])) + 1) for x in (rows, columns))):
        distance = np.sqrt(((a[i] - b[j]) ** 2).sum(axis=1))
        order = np.lexsort((j, distance, i))
        i, j, distance = i[order], j[order], distance[order]
        ok = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((i[ok], j[ok], distance[ok]))
    return tuple(np.concatenate([o[c] for o in out]) for c in range(3))


def closest(own: np.ndarray, a: np.ndarray, ids: np.ndarray, b: np.ndarray, key: str, k: int) -> pd.DataFrame:
    """:func:`best` as a table."""
    i, j, distance = best(own, a, ids, b, k)
    rank = np.arange(len(i)) - np.searchsorted(i, i) + 1
    return pd.DataFrame({key: own[i], "neighbor": ids[j], "distance": distance, "rank": rank.astype(np.int32)})
