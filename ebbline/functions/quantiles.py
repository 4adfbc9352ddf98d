"""Exact, linearly interpolated quantiles of whole columns, by the same plan at any size.

All columns and ranks are handled together.  A pass takes an approximate histogram of every
interval that still holds a wanted rank; intervals with few different values are collected with
their counts, the others are cut at the histogram's edges, and the counts at and between the
edges tell exactly where each rank lies.  An interval shrinks about ``EDGES``-fold in a pass, so a
column of billions of values takes two or three.  No task or reducer holds the values of a
column; the driver gets at most ``FEW`` different values (and ``2 * EDGES`` counts) per interval.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.numbers import no_nan
from ebbline.session import write_table

FEW = 2_000
EDGES = 1_024


@dataclass
class Interval:
    """Values of ``column`` from ``low`` to ``high``, the first of them at rank ``start``; ``ranks`` are wanted."""

    column: str
    low: float | None
    high: float | None
    start: int
    ranks: list[int]


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, list[float | None]]:
    """``{column: [quantile, ...]}``; nulls and NaN are ignored, a column without values gives ``None``."""
    columns, probabilities = list(columns), [float(p) for p in probabilities]
    # Several passes follow: read a narrow table, not the whole plan, each time.
    numbers = write_table(df.select(*[no_nan(F.col(c).cast("double")).alias(c) for c in columns]), "quantile_input")
    counts = numbers.agg(*[F.count(c).alias(c) for c in columns]).first()
    around = {c: [(p * (counts[c] - 1)) for p in probabilities] for c in columns if counts[c]}
    found: dict[tuple[str, int], float] = {}
    wanted = {c: sorted({r for x in at for r in (math.floor(x), math.ceil(x))}) for c, at in around.items()}
    state = [Interval(c, None, None, 0, ranks) for c, ranks in wanted.items()]
    while state:
        state = _narrow(numbers, state, found)
    out: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    for c, at in around.items():
        out[c] = [found[c, math.floor(x)] + (found[c, math.ceil(x)] - found[c, math.floor(x)]) * (x - math.floor(x)) for x in at]
    return out


def _narrow(numbers: DataFrame, state: list[Interval], found: dict[tuple[str, int], float]) -> list[Interval]:
    """One pass over all intervals; fills ``found`` and returns the smaller intervals that are left."""
    names = [f"i{k}" for k in range(len(state))]
    inside = numbers.select(
        *[
            (F.col(s.column) if s.low is None else F.when(F.col(s.column).between(s.low, s.high), F.col(s.column))).alias(n)
            for n, s in zip(names, state)
        ]
    )
    probes = _doubles([i / EDGES for i in range(EDGES + 1)])
    shape = inside.agg(
        *[F.approx_count_distinct(n).alias(f"d{n}") for n in names],
        *[F.min(n).alias(f"l{n}") for n in names],
        *[F.max(n).alias(f"h{n}") for n in names],
        *[F.percentile_approx(n, probes, 10 * EDGES).alias(f"e{n}") for n in names],
    ).first()
    few = [k for k, n in enumerate(names) if shape[f"d{n}"] <= FEW]
    many = [k for k in range(len(names)) if k not in few]
    values = _counted(inside, {names[k]: (F.col(names[k]), F.lit(True)) for k in few})
    for k in few:
        _settle(state[k], [(v, v, n) for v, _, n in sorted(values[names[k]])], found)
    left: list[Interval] = []
    if many:
        edges = {}
        for k in many:
            low, high = shape[f"l{names[k]}"], shape[f"h{names[k]}"]
            edges[names[k]] = sorted({low, high, low + (high - low) / 2, *shape[f"e{names[k]}"]})
        cut = Bucketizer(
            inputCols=[names[k] for k in many], outputCols=[f"b{names[k]}" for k in many],
            splitsArray=[[*e, math.inf] for e in edges.values()], handleInvalid="keep",
        ).transform(inside)
        at_edge = {
            n: (F.col(f"b{n}"), F.col(n) == F.element_at(_doubles(e), F.col(f"b{n}").cast("int") + 1))
            for n, e in edges.items()
        }
        bins = _counted(cut, at_edge)
        for k in many:
            e = edges[names[k]]
            pieces = [
                (e[int(b)], e[int(b)], n) if exact
                else (math.nextafter(e[int(b)], math.inf), math.nextafter(e[int(b) + 1], -math.inf), n)
                for b, exact, n in bins[names[k]]
            ]
            left += _settle(state[k], sorted(pieces), found)
    return left


def _doubles(values: Sequence[float]) -> Column:
    """An array of constants, as one text: a thousand separate literals are a thousand calls to the JVM."""
    return F.expr(f"array({', '.join(f'{float(x)!r}D' for x in values)})")


def _counted(df: DataFrame, keys: dict) -> dict[str, list[tuple]]:
    """For each name the different pairs of its two keys, with their counts; rows without a value do not count."""
    out: dict[str, list[tuple]] = {n: [] for n in keys}
    if keys:
        rows = F.array(*[F.when(F.col(n).isNotNull(), F.struct(F.lit(n).alias("n"), a.alias("a"), b.alias("b"))) for n, (a, b) in keys.items()])
        for r in df.select(F.explode(F.array_compact(rows)).alias("x")).groupBy("x.n", "x.a", "x.b").count().collect():
            out[r.n].append((r.a, r.b, r["count"]))
    return out


def _settle(own: Interval, pieces: list[tuple[float, float, int]], found: dict[tuple[str, int], float]) -> list[Interval]:
    """Ranks in a piece of one value are found; the other pieces with ranks are the next intervals."""
    left, start = [], own.start
    for low, high, n in pieces:
        ranks = [r for r in own.ranks if start <= r < start + n]
        if low == high:
            found.update({(own.column, r): low for r in ranks})
        elif ranks:
            left.append(Interval(own.column, low, high, start, ranks))
        start += n
    return left
