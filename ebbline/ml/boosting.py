"""Boosted trees on histograms, with a learned side for missing values and penalised leaves.

Features are cut at quantiles once, into at most ``BINS`` bins and one for missing values.  For each level of
a tree first and second derivatives of the log-loss are added up by (node, feature, bin), of the smaller
child of each split only; the larger one has the rest of its parent.  Several models over the same rows (the
folds of a cross-validation) grow side by side.

Up to ``ROWS_PER_TASK`` rows are fitted within one task.  More are dealt to tasks in blocks of bins, kept
there with the margins so far (:class:`Spread`): a level is a job that adds the blocks' sums up, the driver
chooses the splits, and a finished tree moves the margins where they are.  So the rows of a task are
bounded at any size, tasks need not run at once, and a lost one is worked out again.  The trees do not
depend on how the rows are dealt to tasks, but for the order in which doubles are added.

Rows without a label take no part.  A feature without any value never splits.  Null and NaN are both missing.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, fields, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.numbers import no_nan
from ebbline.session import work_dir, write_table

BINS = 64
#: Rows that are fitted within one task; beyond, tasks of a quarter of them work side by side, a job for each level.
ROWS_PER_TASK = 1_000_000
#: Trees after which the blocks of a fit are written, so that their lineage stays short.
CUT = 25
#: Bytes of sums that a job may bring to the driver from its tasks; more are added up on the way.
GATHERED = 1 << 25
#: Rows whose sums are taken at a time.
CHUNK = 1 << 15
#: Bins of several features together that are counted in one go where rows are many, at least so many rows for each of these.
JOINT, FILLED = 4400, 8
TREE = (
    "model int, tree int, node int, feature int, cut double, missing_left boolean, value double, gain double, cover double"
)
SCORES = "grp int, rounds int, label int, score double"


@dataclass(frozen=True)
class TreeParams:
    """The defaults of the untuned trees."""

    n_estimators: int = 300
    max_depth: int = 4
    learning_rate: float = 0.05
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0

    @staticmethod
    def of(params: Mapping[str, float] | None) -> TreeParams:
        own = {f.name: f.type for f in fields(TreeParams)}
        unknown = sorted(set(params or {}) - set(own))
        if unknown:
            raise ValueError(f"unknown tree parameters: {', '.join(unknown)}")
        whole = {"n_estimators", "max_depth"}
        return TreeParams(**{n: int(v) if n in whole else float(v) for n, v in (params or {}).items()})


@dataclass(frozen=True)
class Spec:
    """A model to fit: its parameters, its seed, and the rows it learns from: those with ``part`` below ``upto``."""

    params: TreeParams
    seed: int = 42
    upto: int | None = None


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i + 1, 2i + 2); a leaf has feature -1."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    missing_left: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)
    cover: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = (2 << self.depth) - 1
        self.feature, self.missing_left = np.full(n, -1), np.zeros(n, dtype=bool)
        self.cut, self.value, self.gain, self.cover = (np.zeros(n) for _ in range(4))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of a matrix; NaN is missing."""
        node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        for _ in range(self.depth):
            feature = self.feature[node]
            own = x[rows, feature]
            left = np.where(np.isnan(own), self.missing_left[node], own <= self.cut[node])
            node = np.where(feature < 0, node, 2 * node + 2 - left)
        return node


def margins(trees: Sequence[Tree], x: np.ndarray) -> np.ndarray:
    """Log-odds of each row."""
    out = np.zeros(len(x))
    for tree in trees:
        out += tree.value[tree.leaf_of(x)]
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    """Soft threshold of the L1 penalty."""
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_splits(g: np.ndarray, h: np.ndarray, allowed: np.ndarray, p: TreeParams) -> dict[str, np.ndarray]:
    """The best split of each node from sums by (node, feature, bin); the last bin holds the missing values.

    Ties go to the first feature, then the first bin, then missing values to the left.
    """
    total_g, total_h = g[:, 0].sum(axis=1), h[:, 0].sum(axis=1)

    def weight(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return shrunk(a, p.reg_alpha) ** 2 / np.maximum(b + p.reg_lambda, 1e-12)

    below_g, below_h = np.cumsum(g[:, :, :-1], axis=2), np.cumsum(h[:, :, :-1], axis=2)
    # Last axis: missing values left, missing values right.
    left_g = np.stack([below_g + g[:, :, -1:], below_g], axis=-1)
    left_h = np.stack([below_h + h[:, :, -1:], below_h], axis=-1)
    right_g, right_h = total_g[:, None, None, None] - left_g, total_h[:, None, None, None] - left_h
    gain = 0.5 * (weight(left_g, left_h) + weight(right_g, right_h) - weight(total_g, total_h)[:, None, None, None]) - p.gamma
    least = max(p.min_child_weight, 1e-9)
    gain[(left_h < least) | (right_h < least)] = -np.inf
    gain[:, ~allowed] = -np.inf
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    feature, cut, side = np.unravel_index(at, gain.shape[1:])
    rows = np.arange(len(flat))
    return {
        "gain": flat[rows, at], "feature": feature, "bin": cut, "missing_left": side == 0, "g": total_g, "h": total_h,
        "left_g": left_g.reshape(flat.shape)[rows, at], "left_h": left_h.reshape(flat.shape)[rows, at],
    }


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row key: the same wherever the row is."""
    z = x.view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


@dataclass(frozen=True)
class Shape:
    """What rows in other tasks must know of a model: its rounds, the counts of its classes, its unfinished tree, and the nodes to count."""

    rounds: int
    classes: np.ndarray
    tree: Tree
    cuts: np.ndarray
    counted: np.ndarray


class Grower:
    """One model while it grows, as one task sees it: its rows' margins and its trees.

    ``bins`` has a line for each feature and in it the bin of each row; all models of a task share it.
    """

    def __init__(
        self, spec: Spec, bins: np.ndarray, edges: list[np.ndarray], label: np.ndarray, key: np.ndarray, part: np.ndarray, marks: Sequence[int] | None = None
    ) -> None:
        self.p, self.seed, self.bins = spec.params, spec.seed, bins
        # With marks the rows of the part after the learned ones are scored after so many rounds, and no tree is kept.
        self.marks, self.rounds, self.scores = marks, 0, {}
        self.held = np.empty(0, dtype=np.int64) if marks is None else np.flatnonzero(part == spec.upto)
        self.held_label, self.held_margin = label[self.held], np.zeros(len(self.held))
        self.rows = np.arange(len(label)) if spec.upto is None else np.flatnonzero(part < spec.upto)
        self.label, self.key = label[self.rows], key[self.rows]
        self.edges, self.width = edges, width_of(edges)
        self.margin, self.trees = np.zeros(len(self.label)), []

    def counts(self) -> np.ndarray:
        return np.array([(self.label == 0).sum(), (self.label == 1).sum()], dtype=float)

    def start(self, counts: np.ndarray) -> None:
        """Class weights, from the counts of all tasks: positives weigh negatives / positives."""
        self.classes = counts
        self.weight = np.where(self.label == 1, counts[0] / counts[1] if counts[1] else 1.0, 1.0)

    def begin(self) -> None:
        """Derivatives at the margins so far, and the rows and features of the next tree."""
        no, p = self.rounds, self.p
        self.tree = Tree(p.max_depth)
        self.cuts = np.zeros(len(self.tree.feature), dtype=np.int64)
        prob = sigmoid(self.margin)
        self.g, self.h = self.weight * (prob - self.label), self.weight * prob * (1 - prob)
        self.node = np.zeros(len(self.label), dtype=np.int64)
        self.sampled = None if p.subsample >= 1 else np.flatnonzero(mixed(self.key, self.seed * 1_000_003 + no) < p.subsample)
        n = len(self.bins)
        take = max(1, round(n * p.colsample_bytree))
        rng = np.random.default_rng([self.seed, no])
        self.allowed = np.isin(np.arange(n), rng.permutation(n)[:take] if take < n else np.arange(n))
        self.counted, self.others, self.above = np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.int64), None
        self.joint = None

    def shape(self) -> Shape:
        """The unfinished tree, for rows that are elsewhere."""
        return Shape(self.rounds, self.classes, self.tree, self.cuts, self.counted)

    def resume(self, shape: Shape, margin: np.ndarray) -> None:
        """Go on with a tree that was begun elsewhere; ``margin`` is that of all rows before it."""
        self.start(shape.classes)
        self.rounds, self.margin = shape.rounds, margin[self.rows]
        self.begin()
        self.tree, self.cuts, self.counted = shape.tree, shape.cuts, shape.counted
        self.node = self.leaf_of(self.rows)

    def sums(self) -> np.ndarray:
        """Sums of both derivatives by (node, feature, bin) of the nodes that are counted, of the features that may split and the first."""
        n, width, nodes = len(self.bins), self.width, len(self.counted)
        place = np.full(len(self.tree.feature), -1)
        place[self.counted] = np.arange(nodes)
        rows, g, h, own = self.rows, self.g, self.h, self.node
        if self.sampled is not None:
            rows, g, h, own = (x[self.sampled] for x in (rows, g, h, own))
        own = place[own]
        at = np.flatnonzero(own >= 0)
        out = np.zeros((2, nodes, n, width))
        # Whose sums are the totals of the nodes is the first feature.
        wanted = np.flatnonzero(self.allowed | (np.arange(n) == 0)).tolist()
        if len(at) >= FILLED * JOINT * nodes:
            if self.joint is None:
                self.joint = joint(self.bins, rows, [len(self.edges[j]) + 2 for j in wanted], wanted)
            whole = len(at) == len(rows)
            own, derivatives = own[at], (g, h) if whole else (g[at], h[at])
            for codes, members, shape in self.joint:
                size = math.prod(shape)
                cells = (codes if whole else codes[at]).astype(np.int64)
                if nodes > 1:
                    cells += own * size
                for total, x in zip(out, derivatives):
                    table = np.bincount(cells, weights=x, minlength=nodes * size).reshape(nodes, *shape)
                    for axis, j in enumerate(members, 1):
                        line = table.sum(axis=tuple(i for i in range(1, len(members) + 1) if i != axis))
                        total[:, j, : line.shape[1] - 1], total[:, j, -1] = line[:, :-1], line[:, -1]
            return out.ravel()
        for start in range(0, len(at), CHUNK):
            chunk = at[start : start + CHUNK]
            here, first, g_, h_ = rows[chunk], own[chunk] * width, g[chunk], h[chunk]
            for j in wanted:
                cells = first + self.bins[j][here]
                for total, x in zip(out, (g_, h_)):
                    total[:, j] += np.bincount(cells, weights=x, minlength=nodes * width).reshape(nodes, width)
        return out.ravel()

    def split(self, sums: np.ndarray, level: int) -> None:
        """Split the nodes of a level by the sums of all tasks, or leave them as leaves."""
        n, p, tree = len(self.bins), self.p, self.tree
        own = sums.reshape(2, len(self.counted), n, self.width)
        if self.above is not None:
            # What the smaller children do not have of their parents' sums the larger ones have.
            own = np.concatenate((own, self.above - own), axis=1)
        nodes = np.concatenate((self.counted, self.others))
        found = best_splits(*own, self.allowed, p)
        self.settle(nodes, found["g"], found["h"])
        do = (found["gain"] > 1e-12) & (level < p.max_depth)
        nodes, found, own = nodes[do], {k: v[do] for k, v in found.items()}, own[:, do]
        tree.feature[nodes], tree.gain[nodes], tree.missing_left[nodes] = found["feature"], found["gain"], found["missing_left"]
        cuts = self.cuts
        cuts[nodes] = found["bin"]
        for node in nodes.tolist():
            edges = self.edges[tree.feature[node]]
            tree.cut[node] = edges[cuts[node]] if cuts[node] < len(edges) else np.inf
        parts = np.zeros(len(tree.feature), dtype=bool)
        parts[nodes] = True
        goes = np.flatnonzero(parts[self.node])
        whole = len(goes) == len(self.node)
        at = self.node if whole else self.node[goes]
        bins = self.bins.reshape(-1)[(tree.feature * self.bins.shape[1])[at] + (self.rows if whole else self.rows[goes])]
        left = bins <= cuts[at]
        missing = np.flatnonzero(bins == self.width - 1)
        left[missing] = tree.missing_left[at[missing]]
        self.node[goes] = 2 * at + 2 - left
        if level + 1 < p.max_depth:
            small = found["left_h"] <= found["h"] - found["left_h"]
            self.counted, self.others, self.above = 2 * nodes + 2 - small, 2 * nodes + 1 + small, own
        else:
            self.settle(2 * nodes + 1, found["left_g"], found["left_h"])
            self.settle(2 * nodes + 2, found["g"] - found["left_g"], found["h"] - found["left_h"])
            self.counted = np.empty(0, dtype=np.int64)

    def settle(self, nodes: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        self.tree.cover[nodes] = h
        self.tree.value[nodes] = -self.p.learning_rate * shrunk(g, self.p.reg_alpha) / np.maximum(h + self.p.reg_lambda, 1e-12)

    def end(self) -> None:
        self.margin += self.tree.value[self.node]
        self.rounds += 1
        if self.marks is None:
            self.trees.append(self.tree)
            return
        self.held_margin += self.tree.value[self.leaf_of(self.held)]
        if self.rounds in self.marks:
            self.scores[self.rounds] = sigmoid(self.held_margin)

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of the tree just grown for each of the rows, by their bins."""
        tree, node = self.tree, np.zeros(len(rows), dtype=np.int64)
        for _ in range(tree.depth):
            feature = tree.feature[node]
            if (feature < 0).all():
                break
            bins = self.bins[feature, rows]
            left = np.where(bins == self.width - 1, tree.missing_left[node], bins <= self.cuts[node])
            node = np.where(feature < 0, node, 2 * node + 2 - left)
        return node


def joint(bins: np.ndarray, rows: np.ndarray, widths: Sequence[int], features: Sequence[int]) -> list[tuple[np.ndarray, list[int], tuple[int, ...]]]:
    """Features put together while their bins multiply to no more than ``JOINT``: one number for the bins of each row, the features, and their bins.

    A missing value has a feature's last bin of ``widths``.
    """
    groups: list[list[tuple[int, int]]] = []
    for width, j in sorted(zip(widths, features), reverse=True):
        for group in groups:
            if width * math.prod(w for w, _ in group) <= JOINT:
                group.append((width, j))
                break
        else:
            groups.append([(width, j)])
    out = []
    for group in groups:
        shape = tuple(w for w, _ in group)
        codes = np.zeros(len(rows), dtype=np.uint16 if math.prod(shape) <= 1 << 16 else np.int64)
        for width, j in group:
            codes *= codes.dtype.type(width)
            codes += np.minimum(bins[j][rows], width - 1).astype(codes.dtype)
        out.append((codes, [j for _, j in group], shape))
    return out


def grow(growers: list[Grower], spread: Spread | None = None) -> None:
    """All rounds of all models, over the rows they hold or over those of ``spread``."""
    for m, own in zip(growers, spread.counts() if spread else [m.counts() for m in growers]):
        m.start(own)
    for no in range(max(m.p.n_estimators for m in growers)):
        now = [m for m in growers if no < m.p.n_estimators]
        for m in now:
            m.begin()
        level = 0
        while open_ := [m for m in now if len(m.counted)]:
            for m, own in zip(open_, spread.sums(open_) if spread else [m.sums() for m in open_]):
                m.split(own, level)
            level += 1
        if spread:
            spread.move(now)
        for m in now:
            m.end()


@dataclass(frozen=True)
class Block:
    """Rows of a fit where they are kept: bins by feature, and the margin of each model so far."""

    bins: np.ndarray
    label: np.ndarray
    key: np.ndarray
    part: np.ndarray
    margin: np.ndarray

    def grower(self, spec: Spec, edges: list[np.ndarray]) -> Grower:
        return Grower(spec, self.bins, edges, self.label, self.key, self.part)


def added(some: list[np.ndarray], more: list[np.ndarray]) -> list[np.ndarray]:
    return [a + b for a, b in zip(some, more)]


class Spread:
    """The rows of a fit dealt to tasks.  ``growers`` are without rows; with ``marks``, scores of held-out rows are written after so many rounds."""

    def __init__(self, spark: SparkSession, blocks: RDD, growers: list[Grower], specs: list[Spec], edges: list[np.ndarray], marks: list[int] | None) -> None:
        self.spark, self.specs, self.edges, self.marks = spark, specs, edges, marks
        self.place = {id(m): i for i, m in enumerate(growers)}
        self.last, self.trees = max(m.p.n_estimators for m in growers), 0
        self.blocks, self.stale, self.scores = blocks.persist(StorageLevel.MEMORY_AND_DISK), [], []

    def counts(self) -> list[np.ndarray]:
        specs, edges = self.specs, self.edges
        return self._total(lambda block: [block.grower(s, edges).counts() for s in specs], 16 * len(specs))

    def sums(self, growers: list[Grower]) -> list[np.ndarray]:
        own, edges = [(self.place[id(m)], self.specs[self.place[id(m)]], m.shape()) for m in growers], self.edges

        def run(block: Block) -> list[np.ndarray]:
            out = []
            for i, spec, shape in own:
                grower = block.grower(spec, edges)
                grower.resume(shape, block.margin[i])
                out.append(grower.sums())
            return out

        return self._total(run, sum(16 * len(m.counted) * len(m.bins) * m.width for m in growers))

    def _total(self, run, size: int) -> list[np.ndarray]:
        """What ``run`` gives of each block, added up; ``size`` is its bytes."""
        found = self.blocks.map(run)
        if size * found.getNumPartitions() <= GATHERED:
            parts = found.collect()
            total = parts[0]
            for more in parts[1:]:
                total = added(total, more)
        else:
            total = found.treeReduce(added)
        self.forget()
        return total

    def move(self, growers: list[Grower]) -> None:
        """Add the finished trees to the margins."""
        self.trees += 1
        if self.trees == self.last and self.marks is None:
            return
        own, edges = [(self.place[id(m)], self.specs[self.place[id(m)]], m.shape()) for m in growers], self.edges

        def run(block: Block) -> Block:
            margin = block.margin.copy()
            for i, spec, shape in own:
                grower = block.grower(spec, edges)
                grower.tree, grower.cuts = shape.tree, shape.cuts
                margin[i] += shape.tree.value[grower.leaf_of(np.arange(len(block.label)))]
            return replace(block, margin=margin)

        moved = self.blocks.map(run)
        if self.trees % CUT == 0:
            path = f"{work_dir(self.spark).rstrip('/')}/blocks-{uuid.uuid4().hex}"
            moved.saveAsPickleFile(path, 1)
            moved = self.spark.sparkContext.pickleFile(path)
        self.stale.append(self.blocks)
        self.blocks = moved.persist(StorageLevel.MEMORY_AND_DISK)
        found = [(i, spec, shape.rounds + 1) for i, spec, shape in own if self.marks is not None and shape.rounds + 1 in self.marks]
        if found:
            self.scores.append(self._scored(found))

    def _scored(self, own: list[tuple[int, Spec, int]]) -> DataFrame:
        def run(block: Block) -> Iterator[tuple]:
            for i, spec, rounds in own:
                held = np.flatnonzero(block.part == spec.upto)
                yield i, rounds, block.label[held].tobytes(), sigmoid(block.margin[i, held]).tobytes()

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, rounds, label, score in zip(*[c.to_pylist() for c in batch.columns]):
                    yield score_rows(i, rounds, np.frombuffer(label), np.frombuffer(score))

        packed = self.spark.createDataFrame(self.blocks.flatMap(run), "grp int, rounds int, label binary, score binary")
        return write_table(packed.mapInArrow(unpack, SCORES), "scores")

    def forget(self) -> None:
        """Give up the blocks that newer ones have been made of."""
        for blocks in self.stale:
            blocks.unpersist()
        self.stale = []

    def close(self) -> None:
        self.stale.append(self.blocks)
        self.forget()


def width_of(edges: list[np.ndarray]) -> int:
    """Bins of a feature: one more than it has edges, and one for missing values."""
    return max([len(e) for e in edges], default=0) + 2


def coded(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of each value, a line for each feature: the number of edges below it; missing values get the last."""
    width = width_of(edges)
    out = np.empty(x.shape[::-1], dtype=np.uint8 if width <= 1 << 8 else np.int32)
    for j, own in enumerate(edges):
        out[j] = np.where(np.isnan(x[:, j]), width - 1, np.searchsorted(own, x[:, j], side="left"))
    return out


def quantile_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Cut points of each feature: different approximate quantiles, without the greatest; one pass for all."""
    shares = F.array(*[F.lit(i / bins) for i in range(bins)])
    found = rows.agg(*[F.percentile_approx(no_nan(F.col(f).cast("double")), shares, 10_000).alias(f) for f in features]).first()
    return [np.unique(np.array(found[f] or [], dtype=float)) for f in features]


@dataclass(frozen=True)
class BoostedTrees:
    """Fitted trees over named features."""

    features: list[str]
    trees: list[Tree]

    def scored(self, df: DataFrame, column: str = "churn_probability") -> DataFrame:
        """``df`` with the probability of the positive class."""

        @F.pandas_udf("double")
        def probability(*columns: pd.Series) -> pd.Series:
            return pd.Series(sigmoid(margins(self.trees, np.column_stack([c.to_numpy(dtype=float) for c in columns]))))

        return df.select("*", probability(*[F.col(f).cast("double") for f in self.features]).alias(column))

    def table(self, spark: SparkSession) -> DataFrame:
        """A row per node."""
        return spark.createDataFrame(pa.Table.from_batches([as_rows(0, self.trees)]), TREE)

    def save(self, path: str) -> None:
        self.table(SparkSession.getActiveSession()).coalesce(1).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, features: Sequence[str]) -> BoostedTrees:
        return of_rows(spark.read.parquet(path).toPandas(), list(features))[0]

    def gains(self) -> dict[str, float]:
        """Mean gain of each feature's splits, as shares that add up to one."""
        total, count = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
            np.add.at(count, tree.feature[inner], 1)
        mean = total / np.maximum(count, 1)
        return dict(zip(self.features, (mean / (mean.sum() or 1.0)).tolist()))


def as_rows(model: int, trees: Sequence[Tree]) -> pa.RecordBatch:
    sizes = [len(t.feature) for t in trees]
    columns = {
        "model": np.full(sum(sizes), model, dtype=np.int32), "tree": np.repeat(np.arange(len(trees), dtype=np.int32), sizes),
        "node": np.concatenate([np.arange(n, dtype=np.int32) for n in sizes] or [np.empty(0, dtype=np.int32)]),
    }
    for name, kind in (("feature", np.int32), ("cut", float), ("missing_left", bool), ("value", float), ("gain", float), ("cover", float)):
        columns[name] = np.concatenate([getattr(t, name) for t in trees] or [np.empty(0)]).astype(kind)
    return pa.RecordBatch.from_pydict(columns)


def of_rows(nodes: pd.DataFrame, features: list[str], models: int = 1) -> list[BoostedTrees]:
    out = [BoostedTrees(features, []) for _ in range(models)]
    for (model, _), own in nodes.sort_values(["model", "tree", "node"]).groupby(["model", "tree"], sort=True):
        tree = Tree(len(own).bit_length() - 1)
        for name in ("feature", "cut", "missing_left", "value", "gain", "cover"):
            setattr(tree, name, own[name].to_numpy())
        out[model].trees.append(tree)
    return out


def fit_many(rows: DataFrame, features: Sequence[str], specs: Sequence[Spec], key: str, part: str | None = None, edges: list[np.ndarray] | None = None) -> list[BoostedTrees]:
    """Fit ``specs`` side by side on ``rows`` (features, ``label`` 0 or 1, ``key``, and the int column ``part`` where a spec asks for it).

    ``key`` decides which rows a tree samples.  ``edges`` are taken of all rows unless given.
    """
    edges = quantile_edges(rows, features) if edges is None else edges
    specs = list(specs)
    wanted, n = _fit_rows(rows, features, key, part)
    if n > ROWS_PER_TASK:
        growers, spread = _spread(wanted, n, specs, edges, None)
        try:
            grow(growers, spread)
        finally:
            spread.close()
        return [BoostedTrees(list(features), m.trees) for m in growers]
    # At most models * rounds * 2**(depth + 1) rows.
    return of_rows(_in_one_task(wanted, specs, edges, None).toPandas(), list(features), len(specs))


def fit_scores(rows: DataFrame, features: Sequence[str], specs: Sequence[Spec], key: str, part: str, edges: list[np.ndarray], marks: Sequence[int]) -> DataFrame:
    """``grp, rounds, label, score``: what the models of ``specs`` say of the rows whose ``part`` is their ``upto``, after each number of rounds in ``marks``.

    ``grp`` is the model's place in ``specs``.  No tree outlasts its round on the driver: nothing but scores leaves the tasks.
    """
    specs, marks = list(specs), sorted(set(marks))
    wanted, n = _fit_rows(rows, features, key, part)
    if n <= ROWS_PER_TASK:
        return _in_one_task(wanted, specs, edges, marks)
    growers, spread = _spread(wanted, n, specs, edges, marks)
    try:
        grow(growers, spread)
    finally:
        spread.close()
    out = spread.spark.createDataFrame([], SCORES)
    for own in spread.scores:
        out = out.unionByName(own)
    return out


def _fit_rows(rows: DataFrame, features: Sequence[str], key: str, part: str | None) -> tuple[DataFrame, int]:
    """Labelled rows as the fits read them, and their number."""
    none = F.lit(np.iinfo(np.int32).max)
    wanted = rows.where(F.col("label").isNotNull()).select(
        *[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col("label").cast("double").alias("label"),
        F.xxhash64(F.col(key)).alias("key"), (F.coalesce(F.col(part).cast("int"), none) if part else F.lit(0)).alias("part"),
    )
    return wanted, wanted.count()


def _columns(batches: Sequence[pa.RecordBatch], edges: list[np.ndarray]) -> list[np.ndarray]:
    """Bins, labels, keys and parts of rows."""
    held: list[list[np.ndarray]] = [[], [], [], []]
    for batch in batches:
        x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(edges))]) if edges else np.empty((batch.num_rows, 0))
        for column, value in zip(held, (coded(x, edges), *[batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "key", "part")])):
            column.append(value)
    empty = (coded(np.empty((0, len(edges))), edges), np.empty(0), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32))
    return [np.concatenate(c, axis=-1) if c else e for c, e in zip(held, empty)]


def score_rows(model: int, rounds: int, label: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "grp": np.full(len(score), model, dtype=np.int32), "rounds": np.full(len(score), rounds, dtype=np.int32),
        "label": label.astype(np.int32), "score": score,
    })


def _in_one_task(wanted: DataFrame, specs: list[Spec], edges: list[np.ndarray], marks: list[int] | None) -> DataFrame:
    """The trees' nodes or, with ``marks``, the scores of held-out rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _columns(batches, edges)
        growers = [Grower(s, columns[0], edges, *columns[1:], marks) for s in specs]
        grow(growers)
        for i, m in enumerate(growers):
            if marks is None:
                yield as_rows(i, m.trees)
            for no, score in m.scores.items():
                yield score_rows(i, no, m.held_label, score)

    return wanted.repartition(1, "key").mapInArrow(run, TREE if marks is None else SCORES)


def packed_rows(rows: DataFrame, features: Sequence[str], key: str, part: str, edges: list[np.ndarray]) -> tuple[DataFrame, int]:
    """Labelled rows of a fit as a written table, and their number: their bins, labels and keys, some thousand rows of one part in a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, label, key, part = _columns([batch], edges)
            for own in np.unique(part).tolist():
                at = np.flatnonzero(part == own)
                lines = [pa.array([x.tobytes()], pa.binary()) for x in (bins[:, at], label[at], key[at])]
                yield pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([len(at)], pa.int32()), *lines], ["part", "n", "bins", "label", "key"])

    wanted, n = _fit_rows(rows, features, key, part)
    return write_table(wanted.mapInArrow(run, "part int, n int, bins binary, label binary, key binary"), "packed"), n


def fit_packed(packed: DataFrame, spec: Spec, edges: list[np.ndarray], marks: Sequence[int]) -> DataFrame:
    """:func:`fit_scores` of one model in one task, over the parts that it needs of :func:`packed_rows`; ``grp`` is the model's ``upto``."""
    marks, upto = sorted(set(marks)), spec.upto

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = _columns([], edges)
        held: list[list[np.ndarray]] = [[x] for x in none]
        for batch in batches:
            for part, n, *lines in zip(*[c.to_pylist() for c in batch.columns]):
                bins, label, key = (np.frombuffer(x, dtype=own.dtype) for x, own in zip(lines, none))
                for column, value in zip(held, (bins.reshape(len(edges), n), label, key, np.full(n, part, dtype=np.int32))):
                    column.append(value)
        grower = Grower(spec, *_fit_columns(held, edges), marks)
        held.clear()
        grow([grower])
        for no, score in grower.scores.items():
            yield score_rows(upto, no, grower.held_label, score)

    return packed.where(F.col("part") <= upto).coalesce(1).mapInArrow(run, SCORES)


def _fit_columns(held: list[list[np.ndarray]], edges: list[np.ndarray]) -> tuple:
    bins, label, key, part = (np.concatenate(c, axis=-1) for c in held)
    return bins, edges, label, key, part


def _spread(wanted: DataFrame, n: int, specs: list[Spec], edges: list[np.ndarray], marks: list[int] | None) -> tuple[list[Grower], Spread]:
    """Models without rows, and the rows dealt to tasks by the key."""
    size = max(1, ROWS_PER_TASK // 4)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[pa.RecordBatch] = []
        for batch in batches:
            own.append(batch)
            if sum(b.num_rows for b in own) >= 2 * size:
                yield packed(own)
                own = []
        if own:
            yield packed(own)

    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = _columns(batches, edges)
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], ["bins", "label", "key", "part"])

    def block(row) -> Block:
        label = np.frombuffer(row.label)
        bins = np.frombuffer(row.bins, dtype=coded(np.empty((0, len(edges))), edges).dtype).reshape(len(edges), len(label))
        return Block(bins, label, np.frombuffer(row.key, dtype=np.int64), np.frombuffer(row.part, dtype=np.int32), np.zeros((len(specs), len(label))))

    dealt = wanted.repartition(-(-n // size), "key")
    blocks = dealt.mapInArrow(pack, "bins binary, label binary, key binary, part binary").rdd.map(block)
    none = _columns([], edges)
    growers = [Grower(s, none[0], edges, *none[1:], marks) for s in specs]
    return growers, Spread(wanted.sparkSession, blocks, growers, specs, edges, marks)
