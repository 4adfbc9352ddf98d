"""Population scoring: lines -> clean -> features at a snapshot -> score -> revenue at risk."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.dates import SnapshotLike
from ebbline.operators.cleaning import CleaningRules, clean
from ebbline.operators.evaluation import with_revenue_at_risk
from ebbline.operators.features import build_features
from ebbline.operators.splits import build_time_splits, prepare_xy
from ebbline.schema import DEFAULT_WINDOWS
from ebbline.session import write_table

Scorer = Callable[[DataFrame], DataFrame]


def score_population(
    lines: DataFrame,
    snapshot: SnapshotLike,
    scorer: Scorer,
    train_snapshot: SnapshotLike | None = None,
    rules: CleaningRules | None = CleaningRules(),
    windows: Iterable[int] = DEFAULT_WINDOWS,
) -> DataFrame:
    """Every customer seen by the snapshot with features, probability and revenue at risk.

    The cleaned lines are a written table (the feature plan reads it three
    times), and so is the result, which all portfolio tables read.
    """
    if rules is not None:
        lines = clean(lines, train_snapshot or snapshot, rules)
    matrix = build_features(lines, snapshot, windows)
    return write_table(with_revenue_at_risk(scorer(matrix)), "scored_population")


def score_held_out(
    lines: DataFrame, snapshots: dict[str, SnapshotLike], scorer: Scorer, split: str = "test"
) -> DataFrame:
    """Held-out split with ids, labels and scores, aligned by key; only its snapshot is built."""
    held_out = build_time_splits(lines, snapshots, only=[split])
    scored = scorer(prepare_xy(held_out, keep=["customer_id"]))
    return scored.select("customer_id", "label", F.col("churn_probability").alias("score"), "spend_90d")
