"""Canonical transaction columns and the ordered model features."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("invoice_id", T.StringType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("country", T.StringType()),
    ]
)

# The six columns a source has to provide, and the five the features need.
MAPPED_COLUMNS = [f.name for f in TRANSACTION_SCHEMA]
FEATURE_INPUT_COLUMNS = [c for c in MAPPED_COLUMNS if c != "country"]

DEFAULT_WINDOWS = (30, 60, 90)

# Names and order the model input has to keep.
RFM_FEATURES = ["frequency", "monetary", "recency_days"]
WINDOW_STEMS = ["invoice_count", "spend", "avg_spend", "spend_std", "txn_count", "avg_basket"]
LIFETIME_FEATURES = [
    "total_invoices",
    "total_txns",
    "total_quantity",
    "total_revenue",
    "tenure_days",
    "first_purchase_days",
    "avg_order_value",
    "avg_basket_size",
    "distinct_products",
]
TREND_FEATURES = ["spend_slope", "txn_count_slope", "days_between_txns"]


def window_features(windows: Iterable[int] = DEFAULT_WINDOWS) -> list[str]:
    return [f"{stem}_{w}d" for w in windows for stem in WINDOW_STEMS]


def feature_columns(windows: Iterable[int] = DEFAULT_WINDOWS) -> list[str]:
    """Model features in model order: 15 fixed ones plus six per window."""
    return RFM_FEATURES + window_features(windows) + LIFETIME_FEATURES + TREND_FEATURES


FEATURES = feature_columns()

# A scoring record may leave these empty: too few points in the window or in
# the whole history for a mean, a deviation or a slope.
NULLABLE_FEATURES = [
    f for f in FEATURES if f.startswith(("avg_spend_", "avg_basket_", "spend_std_")) and f[-1] == "d"
] + TREND_FEATURES
REQUIRED_FEATURES = [f for f in FEATURES if f not in NULLABLE_FEATURES]
# Only slopes may be negative.
SIGNED_FEATURES = ["spend_slope", "txn_count_slope"]


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return ``df``; raise ``ValueError`` naming every absent column."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def rename_to_canonical(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename source columns to canonical ones; other columns stay.

    ``mapping`` is canonical name -> source name, e.g.
    ``{"customer_id": "Customer ID"}``.
    """
    require_columns(df, mapping.values())
    return df.withColumnsRenamed({source: canonical for canonical, source in mapping.items()})
