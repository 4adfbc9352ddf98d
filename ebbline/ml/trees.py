"""Attribution of boosted trees: exact path-dependent Shapley values per row.

The fitted trees (bounded by rounds and depth, not by data) travel with the
function; rows are explained in Arrow batches where they are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.ml.boosting import BoostedTrees
from ebbline.operators.explain import BASE, CONTRIBUTIONS

#: Conditions whose rows are kept while leaves are gone through.
CONDITIONS = 64


@dataclass(frozen=True)
class Leaf:
    """A leaf's value and, per feature on its path, the interval leading to it, whether missing values do, and the cover share."""

    value: float
    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    missing: tuple[bool, ...]
    share: tuple[float, ...]


def leaves_of(model: BoostedTrees) -> list[Leaf]:
    """Leaves of all trees, values in log-odds."""
    leaves: list[Leaf] = []
    for tree in model.trees:
        open_nodes: list[tuple[int, dict]] = [(0, {})]
        while open_nodes:
            node, path_so_far = open_nodes.pop()
            feature = int(tree.feature[node])
            if feature < 0:
                names = tuple(path_so_far)
                parts = list(zip(*path_so_far.values())) or [(), (), (), ()]
                leaves.append(Leaf(float(tree.value[node]), names, *map(tuple, parts)))
                continue
            cut, side = float(tree.cut[node]), bool(tree.missing_left[node])
            low, high, missing, share = path_so_far.get(feature, (-math.inf, math.inf, True, 1.0))
            for child, bounds, own in ((2 * node + 1, (low, min(high, cut)), side), (2 * node + 2, (max(low, cut), high), not side)):
                step = (*bounds, missing and own, share * float(tree.cover[child] / tree.cover[node]))
                open_nodes.append((child, {**path_so_far, feature: step}))
    return leaves


def base_value(leaves: Sequence[Leaf]) -> float:
    return sum(leaf.value * math.prod(leaf.share) for leaf in leaves)


def patterns(leaf: Leaf) -> np.ndarray:
    """Contributions of the features of a leaf's path, a line for each, to rows that meet their conditions as the bits of the column's number say."""
    m = len(leaf.features)
    on = (np.arange(1 << m)[None, :] >> np.arange(m)[:, None] & 1).astype(float)
    weight = [math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)]
    out = np.empty(on.shape)
    for j in range(m):
        # coef[s]: sum over subsets of size s of the other features.
        coef = [np.ones(on.shape[1])]
        for i in range(m):
            if i == j:
                continue
            kept = [c * leaf.share[i] for c in coef] + [np.zeros(on.shape[1])]
            for s, c in enumerate(coef):
                kept[s + 1] = kept[s + 1] + c * on[i]
            coef = kept
        out[j] = leaf.value * (on[j] - leaf.share[j]) * sum(w * c for w, c in zip(weight, coef))
    return out


def shapley(leaves: Sequence[Leaf], x: np.ndarray, tables: Sequence[np.ndarray] | None = None) -> np.ndarray:
    """Contribution of each column of ``x`` to each row's log-odds; ``tables`` are the leaves' :func:`patterns`."""
    tables = [patterns(leaf) for leaf in leaves] if tables is None else tables
    columns, absent = np.ascontiguousarray(x.T), np.ascontiguousarray(np.isnan(x).T)
    phi = np.zeros(columns.shape)
    met: dict[tuple, np.ndarray] = {}
    for leaf, table in zip(leaves, tables):
        if not leaf.features:
            continue
        # Leaves of a tree share conditions and follow each other.
        if len(met) > CONDITIONS:
            met.clear()
        pattern = np.zeros(columns.shape[1], dtype=np.uint8 if len(leaf.features) <= 8 else np.int64)
        for j, own in enumerate(zip(leaf.features, leaf.low, leaf.high, leaf.missing)):
            if own not in met:
                f, low, high, missing = own
                inside = (columns[f] > low) & (columns[f] <= high)
                met[own] = ((inside | absent[f]) if missing else inside).astype(pattern.dtype)
            pattern |= met[own].astype(pattern.dtype, copy=False) << pattern.dtype.type(j)
        for f, line in zip(leaf.features, table):
            phi[f] += line[pattern]
    return phi.T


def explain_trees(model: BoostedTrees, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds ``contributions`` (one entry per feature) and ``base_value`` to ``df``.

    Base plus contributions is the log-odds of the predicted probability.
    """
    leaves = leaves_of(model)
    tables = [patterns(leaf) for leaf in leaves]
    place = [features.index(f) for f in model.features]

    @F.pandas_udf("array<double>")
    def contributions(*columns: pd.Series) -> pd.Series:
        phi = np.zeros((len(columns[0]), len(features)))
        phi[:, place] = shapley(leaves, np.column_stack([c.to_numpy(dtype=float) for c in columns]), tables)
        return pd.Series(list(phi))

    explained = df.select("*", contributions(*[F.col(f).cast("double") for f in model.features]).alias("_phi"))
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f).cast("double").alias("value"),
            F.col("_phi")[i].alias("contribution"),
        )
        for i, f in enumerate(features)
    ]
    return explained.withColumns(
        {CONTRIBUTIONS: F.array(*entries), BASE: F.lit(base_value(leaves))}
    ).drop("_phi")


def native_importance(model: BoostedTrees, features: Sequence[str]) -> dict[str, float]:
    """The model's own importance per feature: the mean gain of its splits, as a share."""
    return dict.fromkeys(features, 0.0) | model.gains()
