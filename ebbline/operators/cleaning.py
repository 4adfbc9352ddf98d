"""Row filters for raw transaction lines and train-fitted outlier fences."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.dates import SnapshotLike, ts
from ebbline.functions.quantiles import exact_quantiles
from ebbline.session import write_table

log = logging.getLogger(__name__)


def drop_missing_customer(df: DataFrame, column: str = "customer_id") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one of each set of rows equal on all columns (nulls are equal).

    A hash aggregate: copies collapse before the shuffle, so a line repeated
    millions of times costs one row per map task.
    """
    return df.dropDuplicates()


def keep_non_negative_quantity(df: DataFrame, column: str = "quantity") -> DataFrame:
    """Cancellations are removed, never netted; zero stays, null goes."""
    return df.where(F.col(column) >= 0)


def keep_positive_price(df: DataFrame, column: str = "unit_price") -> DataFrame:
    return df.where(F.col(column) > 0)


@dataclass(frozen=True)
class OutlierFences:
    """Fitted bounds per column; applying them is a plain filter on literals."""

    method: str
    bounds: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    # z-score columns: (mean, std, threshold)
    scores: dict[str, tuple[float, float, float]] = field(default_factory=dict)

    def inside(self) -> Column:
        keep = F.lit(True)
        for name, (low, high) in self.bounds.items():
            c = F.col(name).cast("double")
            if low is None or high is None:
                # Nothing to fit on: no value is known to be regular.
                keep = keep & c.isNull()
            else:
                keep = keep & (c.between(F.lit(low), F.lit(high)) | c.isNull())
        for name, (mean, std, threshold) in self.scores.items():
            c = F.col(name).cast("double")
            keep = keep & ((F.abs((c - F.lit(mean)) / F.lit(std)) <= threshold) | c.isNull())
        return keep

    def apply(self, df: DataFrame) -> DataFrame:
        """Rows inside every fence; a null value passes."""
        present = set(df.columns)
        usable = OutlierFences(
            self.method,
            {k: v for k, v in self.bounds.items() if k in present},
            {k: v for k, v in self.scores.items() if k in present},
        )
        return df.where(usable.inside())


def fit_fences(
    fit_df: DataFrame,
    columns: Sequence[str] = ("quantity", "unit_price"),
    method: str = "iqr",
    iqr_factor: float = 1.5,
    zscore_threshold: float = 3.0,
) -> OutlierFences:
    """Fit fences for all columns on the same rows.

    An action (as in ``Estimator.fit``) that brings a few scalars per column
    to the driver, so that applying them needs no join.
    """
    if method not in ("iqr", "zscore", "none"):
        raise ValueError(f"unknown outlier method: {method!r}")
    if method == "none" or not columns:
        return OutlierFences("none")
    present = []
    for c in columns:
        if c in fit_df.columns:
            present.append(c)
        else:
            log.warning("outlier column %s is absent, skipped", c)
    if not present:
        return OutlierFences(method)
    if method == "iqr":
        bounds = {}
        for c, (q1, q3) in exact_quantiles(fit_df, present, [0.25, 0.75]).items():
            if q1 is None:
                bounds[c] = (None, None)
            else:
                bounds[c] = (q1 - iqr_factor * (q3 - q1), q3 + iqr_factor * (q3 - q1))
        return OutlierFences(method, bounds=bounds)
    row = fit_df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in present], *[F.stddev_samp(c).alias(f"s_{c}") for c in present]
    ).first()
    scores = {
        c: (row[f"m_{c}"], row[f"s_{c}"], zscore_threshold)
        for c in present
        if row[f"s_{c}"] is not None and row[f"s_{c}"] > 0
    }
    return OutlierFences(method, scores=scores)


def remove_outliers(
    df: DataFrame,
    columns: Sequence[str] = ("quantity", "unit_price"),
    method: str = "iqr",
    iqr_factor: float = 1.5,
    zscore_threshold: float = 3.0,
    fit_df: DataFrame | None = None,
) -> DataFrame:
    """Fit on ``fit_df`` (default: ``df`` itself) and filter ``df``."""
    fences = fit_fences(df if fit_df is None else fit_df, columns, method, iqr_factor, zscore_threshold)
    return fences.apply(df)


@dataclass(frozen=True)
class CleaningRules:
    drop_missing_customer: bool = True
    drop_duplicates: bool = True
    drop_negative_quantity: bool = True
    drop_zero_price: bool = True
    outlier_method: str = "iqr"
    outlier_columns: tuple[str, ...] = ("quantity", "unit_price")
    iqr_factor: float = 1.5
    zscore_threshold: float = 3.0


def apply_rules(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Every rule except the outlier fences, lazily."""
    # Row filters commute with de-duplication on all columns; filtering first
    # keeps the rows that would be thrown away out of its shuffle.
    if rules.drop_missing_customer:
        df = drop_missing_customer(df)
    if rules.drop_negative_quantity:
        df = keep_non_negative_quantity(df)
    if rules.drop_zero_price:
        df = keep_positive_price(df)
    if rules.drop_duplicates:
        df = drop_duplicate_rows(df)
    return df


def clean(
    df: DataFrame,
    train_snapshot: SnapshotLike | None = None,
    rules: CleaningRules = CleaningRules(),
    fences: OutlierFences | None = None,
) -> DataFrame:
    """Missing ids, duplicates, cancellations, prices, then outliers.

    Fences are fitted on rows dated up to ``train_snapshot`` only and applied
    to all rows, so later data cannot decide what counts as an outlier.
    """
    cleaned = apply_rules(df, rules)
    if rules.outlier_method == "none":
        return cleaned
    if fences is None:
        if train_snapshot is None:
            raise ValueError("outlier fences need the train snapshot they are fitted up to")
        # De-duplication is the expensive shuffle.  Its result is written once;
        # the fit then reads two columns of it and the fences push down to it.
        cleaned = write_table(cleaned, "cleaned")
        fences = _fit_past(cleaned, train_snapshot, rules)
    return fences.apply(cleaned)


def _fit_past(cleaned: DataFrame, train_snapshot: SnapshotLike, rules: CleaningRules) -> OutlierFences:
    past = cleaned.where(F.col("invoice_date") <= ts(train_snapshot))
    return fit_fences(past, rules.outlier_columns, rules.outlier_method, rules.iqr_factor, rules.zscore_threshold)


def cleaning_audit(
    df: DataFrame,
    train_snapshot: SnapshotLike | None = None,
    rules: CleaningRules = CleaningRules(),
    fences: OutlierFences | None = None,
) -> DataFrame:
    """Rows before, after and dropped per step.

    Copies are collapsed to ``(row, copies)`` once; every step is then a
    conditional sum over the collapsed rows: no count per step.
    """
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    if fences is None and rules.outlier_method != "none":
        if train_snapshot is None:
            raise ValueError("outlier fences need the train snapshot they are fitted up to")
        copies = write_table(copies, "copies")
        # The collapsed rows are distinct already.
        distinct = apply_rules(copies, replace(rules, drop_duplicates=False))
        fences = _fit_past(distinct, train_snapshot, rules)
    step_rules: list[tuple[str, Column | None]] = []
    if rules.drop_missing_customer:
        step_rules.append(("missing_customer", F.col("customer_id").isNotNull()))
    if rules.drop_duplicates:
        step_rules.append(("duplicates", None))
    if rules.drop_negative_quantity:
        step_rules.append(("negative_quantity", F.col("quantity") >= 0))
    if rules.drop_zero_price:
        step_rules.append(("zero_price", F.col("unit_price") > 0))
    if rules.outlier_method != "none":
        step_rules.append(("outliers", fences.inside()))

    alive, weight = F.lit(True), F.col("_copies")
    counters = [F.sum(weight).alias("n0")]
    for i, (_, rule) in enumerate(step_rules, start=1):
        if rule is None:
            weight = F.lit(1)
        else:
            alive = alive & rule
        counters.append(F.sum(F.when(alive, weight).otherwise(0)).alias(f"n{i}"))
    rows = [
        F.struct(
            F.lit(i).alias("step_no"),
            F.lit(name).alias("step"),
            F.coalesce(F.col(f"n{i - 1}"), F.lit(0)).cast("bigint").alias("rows_before"),
            F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("bigint").alias("rows_after"),
        )
        for i, (name, _) in enumerate(step_rules, start=1)
    ]
    return (
        copies.agg(*counters)
        .select(F.inline(F.array(*rows)))
        .withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))
    )
