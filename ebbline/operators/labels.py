"""Churn and value labels from the period after a snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.dates import SnapshotLike, after_window, plus_days, ts
from ebbline.functions.numbers import revenue, zero_if_null
from ebbline.operators.guards import CensoringError
from ebbline.schema import FEATURE_INPUT_COLUMNS, require_columns


def check_label_days(churn_days: int, value_days: int) -> None:
    if churn_days <= 0 or value_days <= 0:
        raise ValueError(f"label windows must be > 0 days, got {churn_days} and {value_days}")


def customer_universe(lines: DataFrame, snapshot: SnapshotLike) -> DataFrame:
    """Customers with any line up to the snapshot."""
    past = lines.where((F.col("invoice_date") <= ts(snapshot)) & F.col("customer_id").isNotNull())
    return past.select("customer_id").distinct()


def assert_label_window(
    lines: DataFrame, snapshots: dict[str, SnapshotLike], days: int
) -> None:
    """Raise if labels of a populated snapshot would be cut off by the end of the data.

    One aggregate serves all snapshots; one without any earlier customer is not checked.
    """
    spans = [
        F.struct(
            F.lit(n).alias("split"),
            plus_days(ts(s), days).alias("needed"),
            ((F.col("first") <= ts(s)) & (F.col("latest") < plus_days(ts(s), days))).alias("short"),
        )
        for n, s in snapshots.items()
    ]
    bounds = lines.agg(
        F.min(F.when(F.col("customer_id").isNotNull(), F.col("invoice_date"))).alias("first"),
        F.max("invoice_date").alias("latest"),
    )
    for row in bounds.select("latest", F.inline(F.array(*spans))).collect():
        if row["short"]:
            raise CensoringError(
                f"insufficient future data for {row['split']}: need {row['needed']}, "
                f"the data ends at {row['latest']}"
            )


def build_labels(
    lines: DataFrame,
    snapshot: SnapshotLike,
    churn_days: int = 90,
    value_days: int = 90,
    check: bool = True,
) -> DataFrame:
    """``customer_id, churn, clv`` for every customer seen up to the snapshot.

    One aggregate per customer over the lines up to the end of the label
    window: existence of an invoice decides churn, so nothing is counted
    distinctly and nothing is joined.
    """
    check_label_days(churn_days, value_days)
    require_columns(lines, FEATURE_INPUT_COLUMNS)
    if check:
        assert_label_window(lines, {"snapshot": snapshot}, max(churn_days, value_days))
    date, snap = F.col("invoice_date"), ts(snapshot)
    bought = after_window(date, snap, churn_days) & F.col("invoice_id").isNotNull()
    in_value = after_window(date, snap, value_days)
    return (
        lines.where(F.col("customer_id").isNotNull())
        .where(date <= plus_days(snap, max(churn_days, value_days)))
        .groupBy("customer_id")
        .agg(
            F.min("invoice_date").alias("_first"),
            F.max(F.when(bought, 1).otherwise(0)).alias("_bought"),
            zero_if_null(F.sum(F.when(in_value, revenue()))).alias("clv"),
        )
        .where(F.col("_first") <= snap)
        .select("customer_id", (1 - F.col("_bought")).cast("int").alias("churn"), "clv")
    )


def labels_at(
    lines: DataFrame,
    snapshots: dict[str, SnapshotLike],
    churn_days: int = 90,
    value_days: int = 90,
    check: bool = True,
) -> DataFrame:
    """``split, customer_id, churn, clv`` of several snapshots in one pass, without features.

    One aggregate per customer with a pair of columns per snapshot: no line is copied.
    """
    check_label_days(churn_days, value_days)
    require_columns(lines, FEATURE_INPUT_COLUMNS)
    if check:
        assert_label_window(lines, snapshots, max(churn_days, value_days))
    date, aggs, rows = F.col("invoice_date"), [], []
    for i, (name, snapshot) in enumerate(snapshots.items()):
        snap = ts(snapshot)
        bought = after_window(date, snap, churn_days) & F.col("invoice_id").isNotNull()
        value = F.when(after_window(date, snap, value_days), revenue())
        aggs += [F.max(F.when(bought, 1).otherwise(0)).alias(f"b{i}"), zero_if_null(F.sum(value)).alias(f"v{i}")]
        own = F.struct(F.lit(name).alias("split"), (1 - F.col(f"b{i}")).cast("int").alias("churn"), F.col(f"v{i}").alias("clv"))
        rows.append(F.when(F.col("_first") <= snap, own))
    by_customer = lines.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.min("invoice_date").alias("_first"), *aggs)
    return by_customer.select("customer_id", F.inline(F.array_compact(F.array(*rows)))).select("split", "customer_id", "churn", "clv")
