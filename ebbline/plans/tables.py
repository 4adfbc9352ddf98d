"""Tables derived once per session and test folder, written and then shared by queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.operators.features import features_at
from ebbline.operators.splits import build_time_splits, prepare_xy
from ebbline.plans.testviews import SNAPSHOTS, txn
from ebbline.session import write_table

_written: dict[tuple[str, str, str], DataFrame] = {}


def once(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _written:
        _written[key] = write_table(build(), name)
    return _written[key]


def with_fixed_score(df: DataFrame) -> DataFrame:
    """A deterministic stand-in for a model's score, so that SQL can follow."""
    score = F.col("recency_days") / (F.col("recency_days") + F.lit(90.0))
    return df.withColumns(
        {
            "label": F.col("churn"),
            "score": score,
            "churn_probability": score,
            "revenue_at_risk": score * F.coalesce(F.col("spend_90d"), F.lit(0.0)),
        }
    ).drop("churn")


def build_scored(spark: SparkSession, sf: str) -> DataFrame:
    test = {"test": SNAPSHOTS["test"]}
    return with_fixed_score(features_at(txn(spark, sf), test, label_days=(90, 90)).drop("split", "snapshot"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """The population at the test snapshot: features, label, score, revenue at risk."""
    return once(spark, sf, "scored", lambda: build_scored(spark, sf))


def splits_table(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "splits", lambda: build_time_splits(txn(spark, sf), SNAPSHOTS).drop("snapshot"))


def split_xy(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    """Labeled matrix of the named splits, with the customer id."""
    rows = splits_table(spark, sf).where(F.col("split").isin(*names))
    return prepare_xy(rows, keep=["customer_id"])
