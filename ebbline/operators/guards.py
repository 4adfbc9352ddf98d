"""Leakage guards and data-quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.dates import SnapshotLike, plus_days, ts


class LeakageError(ValueError):
    """Rows after the snapshot reached a feature function."""


class CensoringError(ValueError):
    """The data ends before the label window does."""


def assert_no_future_rows(
    df: DataFrame, snapshot: SnapshotLike, column: str = "invoice_date"
) -> DataFrame:
    """Eager guard: raise if any date is after the snapshot (equal is fine, null is ignored)."""
    row = df.agg(F.max(column).alias("latest")).select("latest", (F.col("latest") > ts(snapshot)).alias("bad")).first()
    if row["bad"]:
        raise LeakageError(f"{column} reaches {row['latest']}, after the snapshot {snapshot}")
    return df


def refuse_future_rows(df: DataFrame, snapshot: SnapshotLike, column: str = "invoice_date") -> DataFrame:
    """Lazy guard: the same refusal, raised by the job that reads the rows."""
    message = F.concat(F.lit(f"{column} after the snapshot: "), F.col(column).cast("string"))
    checked = F.when(F.col(column) > ts(snapshot), F.raise_error(message).cast("timestamp_ntz")).otherwise(
        F.col(column)
    )
    return df.withColumn(column, checked)


def future_offenders(df: DataFrame, snapshot: SnapshotLike, column: str = "invoice_date") -> DataFrame:
    """One row: number of rows after the snapshot and the latest date."""
    return df.agg(
        F.count_if(F.col(column) > ts(snapshot)).alias("offenders"), F.max(column).alias("latest")
    )


def future_window_report(
    df: DataFrame, snapshots: dict[str, SnapshotLike], days: int, column: str = "invoice_date"
) -> DataFrame:
    """Per snapshot: does the data reach ``snapshot + days``?  One aggregate for all snapshots."""
    rows = [
        F.struct(
            F.lit(name).alias("split"),
            ts(s).alias("snapshot"),
            plus_days(ts(s), days).alias("needed"),
            F.col("latest"),
            (F.col("latest") >= plus_days(ts(s), days)).alias("sufficient"),
        )
        for name, s in snapshots.items()
    ]
    return df.agg(F.max(column).alias("latest")).select(F.inline(F.array(*rows)))


def assert_future_window(
    df: DataFrame, snapshot: SnapshotLike, days: int, column: str = "invoice_date"
) -> DataFrame:
    """Eager guard: raise if the data ends before ``snapshot + days`` or there is none."""
    row = future_window_report(df, {"s": snapshot}, days, column).first()
    if not row["sufficient"]:
        raise CensoringError(
            f"insufficient future data: need {row['needed']}, the data ends at {row['latest']}"
        )
    return df


def clean_violations(df: DataFrame) -> DataFrame:
    """Counts of rows breaking what cleaning promises; all zero on cleaned data."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("customer_id").isNull()).alias("missing_customer"),
        F.count_if(~F.coalesce(F.col("quantity") >= 0, F.lit(False))).alias("bad_quantity"),
        F.count_if(~F.coalesce(F.col("unit_price") > 0, F.lit(False))).alias("bad_price"),
    )


def null_shares(df: DataFrame, columns: Sequence[str], limit: float = 0.5) -> DataFrame:
    """Share of nulls per column, flagged above ``limit``; one pass."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("null_share")) for c in columns]
    return shares.select(F.inline(F.array(*rows))).withColumn("suspicious", F.col("null_share") > limit)


def range_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Per column: min, max and number of non-null values breaking its rule."""
    aggs = []
    for c, rule in rules.items():
        aggs += [
            F.min(F.col(c).cast("double")).alias(f"lo_{c}"),
            F.max(F.col(c).cast("double")).alias(f"hi_{c}"),
            F.count_if(~rule).alias(f"bad_{c}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"lo_{c}").alias("min_value"),
            F.col(f"hi_{c}").alias("max_value"),
            F.col(f"bad_{c}").alias("violations"),
        )
        for c in rules
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def standard_ranges() -> dict[str, Column]:
    return {
        "recency_days": F.col("recency_days") >= 0,
        "monetary": F.col("monetary") > 0,
        "churn": F.col("churn").isin(0, 1),
    }


def churn_band(df: DataFrame, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Churn rate per split; a rate outside ``[low, high]`` is suspicious."""
    rate = F.avg(F.col("churn").cast("double"))
    return (
        df.groupBy("split")
        .agg(F.count("churn").alias("labeled"), rate.alias("churn_rate"))
        .withColumn("suspicious", (F.col("churn_rate") < low) | (F.col("churn_rate") > high))
    )
