"""Train/validation/test matrices and forward-chaining folds."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.dates import SnapshotLike
from ebbline.functions.ordering import OrderKey, asc, with_running
from ebbline.operators.features import features_at
from ebbline.operators.labels import assert_label_window, check_label_days
from ebbline.schema import DEFAULT_WINDOWS, FEATURES

REQUIRED_SPLITS = ("train", "val", "test")


def join_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features with their labels; unlabeled customers keep nulls."""
    return features.join(labels, "customer_id", "left")


def build_time_splits(
    lines: DataFrame,
    snapshots: dict[str, SnapshotLike],
    windows: Iterable[int] = DEFAULT_WINDOWS,
    churn_days: int = 90,
    value_days: int = 90,
    check: bool = True,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Features and labels of all snapshots, or of those named in ``only``, in one frame with a ``split`` column."""
    missing = [s for s in (*REQUIRED_SPLITS, *(only or ())) if s not in snapshots]
    if missing:
        raise ValueError(f"snapshots lack {missing}")
    snapshots = {name: snapshots[name] for name in only or snapshots}
    check_label_days(churn_days, value_days)
    if check:
        assert_label_window(lines, snapshots, max(churn_days, value_days))
    return features_at(lines, snapshots, windows, (churn_days, value_days))


def split_summary(splits: DataFrame, n_features: int = len(FEATURES)) -> DataFrame:
    """Per split: customers, features, labeled, label coverage % and churn rate %."""
    n = F.count(F.lit(1))
    return splits.groupBy("split").agg(
        n.alias("customers"),
        F.lit(n_features).cast("bigint").alias("features"),
        F.count("churn").alias("labeled"),
        (F.count("churn") / n * 100).alias("label_coverage_pct"),
        (F.avg(F.col("churn").cast("double")) * 100).alias("churn_rate_pct"),
    )


def prepare_xy(
    pair: DataFrame,
    target: str = "churn",
    features: Sequence[str] = tuple(FEATURES),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Labeled rows only: ``keep`` columns, the features in order, and ``label``."""
    if target not in ("churn", "clv"):
        raise ValueError(f"unknown target {target!r}")
    label = F.col(target).cast("int" if target == "churn" else "double")
    return pair.where(F.col(target).isNotNull()).select(*keep, *features, label.alias("label"))


def align_columns(df: DataFrame, features: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """Model columns in model order; key and labels are dropped."""
    return df.select(*features)


def concat_splits(splits: DataFrame, names: Sequence[str] = ("train", "val")) -> DataFrame:
    """Bag union of the named splits, as a filter on one frame."""
    return splits.where(F.col("split").isin(*names))


def forward_folds(
    df: DataFrame, k: int = 5, order: Sequence[OrderKey] = (asc("customer_id"),)
) -> DataFrame:
    """Expanding-window folds over the row order.

    Adds ``pos`` (0-based), ``n_rows`` and ``val_fold``: fold ``i`` in 1..k
    validates on the rows with ``val_fold = i`` and trains on those with
    ``val_fold < i``; the leading rows get 0 and are never validated on.
    """
    if k < 2:
        raise ValueError("at least 2 folds")
    if df.limit(k + 1).count() <= k:
        raise ValueError(f"{k} folds need more than {k} rows")
    ranked = with_running(df, list(order), rank="pos", totals={"n_rows": "*"})
    pos, n = F.col("pos") - 1, F.col("n_rows")
    size = F.floor(n / (k + 1))
    lead_in = n - size * k
    fold = F.when(pos < lead_in, 0).otherwise(F.floor(F.try_divide(pos - lead_in, size)) + 1)
    return ranked.withColumns({"val_fold": fold.cast("int"), "pos": pos.cast("bigint")})


def train_part(folds: DataFrame, fold: int) -> DataFrame:
    return folds.where(F.col("val_fold") < fold)


def val_part(folds: DataFrame, fold: int) -> DataFrame:
    return folds.where(F.col("val_fold") == fold)


def fold_classes(folds: DataFrame, k: int, label: str = "label") -> DataFrame:
    """Per fold: training and validation sizes, classes in the training part, usable or not.

    One pass counts each ``val_fold``; the expanding sums run over k + 1 rows.
    """
    counts = folds.groupBy("val_fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
    )
    sums = []
    for i in range(1, k + 1):
        before = F.col("val_fold") < i
        sums += [
            F.sum(F.when(before, F.col("n")).otherwise(0)).alias(f"t{i}"),
            F.sum(F.when(before, F.col("pos")).otherwise(0)).alias(f"p{i}"),
            F.sum(F.when(before, F.col("neg")).otherwise(0)).alias(f"g{i}"),
            F.sum(F.when(F.col("val_fold") == i, F.col("n")).otherwise(0)).alias(f"v{i}"),
        ]
    rows = [
        F.struct(
            F.lit(i).alias("fold"),
            F.col(f"t{i}").cast("bigint").alias("n_train"),
            F.col(f"v{i}").cast("bigint").alias("n_val"),
            F.col(f"p{i}").cast("bigint").alias("train_pos"),
            F.col(f"g{i}").cast("bigint").alias("train_neg"),
            ((F.col(f"p{i}") > 0) & (F.col(f"g{i}") > 0)).alias("usable"),
        )
        for i in range(1, k + 1)
    ]
    return counts.agg(*sums).select(F.inline(F.array(*rows)))


def usable_folds(folds: DataFrame, k: int, label: str = "label") -> list[int]:
    """Folds whose training part has both classes; an error if there is none."""
    keep = [r["fold"] for r in fold_classes(folds, k, label).collect() if r["usable"]]
    if not keep:
        raise ValueError("every fold has a single class in its training part")
    return sorted(keep)
