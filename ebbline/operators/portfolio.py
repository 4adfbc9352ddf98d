"""Business tables over the scored population.

Input: one row per customer with ``churn_probability`` and ``revenue_at_risk``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.numbers import bucket_index, equal_width_bin
from ebbline.functions.ordering import asc, desc, with_running
from ebbline.functions.quantiles import exact_quantiles
from ebbline.operators.evaluation import histogram

DEFAULT_COLUMNS = ["customer_id", "churn_probability", "spend_90d", "revenue_at_risk"]
BAND_COLUMNS = ["spend_90d", "recency_days", "frequency", "tenure_days"]
PARETO_TARGET = 0.8


def kpis(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    high = F.col("churn_probability") >= threshold
    return scored.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(high).alias("high_risk_customers"),
        F.sum("revenue_at_risk").alias("total_revenue_at_risk"),
        F.avg(F.when(high, F.col("revenue_at_risk"))).alias("avg_high_risk_revenue"),
    )


def _band_aggs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_customers"),
        F.avg("churn_probability").alias("mean_churn_probability"),
        F.sum("revenue_at_risk").alias("revenue_at_risk"),
    ]


def risk_bands(scored: DataFrame, column: str, n_bins: int = 5) -> DataFrame:
    """Up to ``n_bins`` quantile bands of a numeric column, or one row per category of a string column.

    Bands are right-closed, the first includes its lower edge; equal edges
    merge; a column with one distinct value gives the single band ``all``.
    """
    if dict(scored.dtypes)[column] == "string":
        return (
            scored.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("label"))
            .agg(*_band_aggs())
        )
    value = F.col(column).cast("double")
    present = scored.where(value.isNotNull())
    raw = exact_quantiles(scored, [column], [i / n_bins for i in range(n_bins + 1)])[column]
    edges = sorted({e for e in raw if e is not None})
    if len(edges) < 2:
        index, edges = F.lit(0), (edges * 2) or [None, None]
        labels = [F.lit("all")]
    else:
        index = bucket_index(value, edges[1:-1])
        labels = [
            F.lit(f"{'[' if i == 0 else '('}{low:.3f}, {high:.3f}]")
            for i, (low, high) in enumerate(zip(edges, edges[1:]))
        ]
    bounds = F.array(
        *[
            F.struct(
                F.lit(low).cast("double").alias("lower"),
                F.lit(high).cast("double").alias("upper"),
                label.alias("label"),
            )
            for low, high, label in zip(edges, edges[1:], labels)
        ]
    )
    band = bounds[F.col("band_index")]
    return (
        present.groupBy(index.cast("int").alias("band_index"))
        .agg(*_band_aggs())
        .select(
            "band_index",
            band["lower"].alias("lower"),
            band["upper"].alias("upper"),
            band["label"].alias("label"),
            "n_customers",
            "mean_churn_probability",
            "revenue_at_risk",
        )
    )


def cumulative_risk(scored: DataFrame) -> DataFrame:
    """Customers ranked by revenue at risk with its running sum."""
    slim = scored.select("customer_id", "revenue_at_risk")
    return with_running(
        slim,
        [desc("revenue_at_risk"), asc("customer_id")],
        sums={"cumulative": "revenue_at_risk"},
        totals={"n_total": "*", "risk_total": "revenue_at_risk"},
    )


def pareto_curve(scored: DataFrame) -> DataFrame:
    """% of customers against their share of the total; empty when the total is 0."""
    return (
        cumulative_risk(scored)
        .where(F.col("risk_total") != 0)
        .select(
            "customer_id",
            "rank",
            (F.col("rank") / F.col("n_total") * 100).alias("pct_customers"),
            (F.col("cumulative") / F.col("risk_total")).alias("share"),
        )
    )


def pareto_point(scored: DataFrame, target: float = PARETO_TARGET) -> DataFrame:
    """Smallest % of customers holding the target share; no row when nothing is at risk."""
    reached = F.min(F.when(F.col("share") >= target, F.col("rank")))
    return (
        pareto_curve(scored)
        .agg(
            F.coalesce(reached, F.max("rank")).alias("customers"),
            F.max("rank").alias("n_total"),
        )
        .where(F.col("n_total").isNotNull())
        .withColumn("pct_customers", F.col("customers") / F.col("n_total") * 100)
    )


def high_risk(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    return scored.where(F.col("churn_probability") >= threshold)


def search(scored: DataFrame, text: str, regex: bool = False) -> DataFrame:
    """Rows whose id contains the text, case-insensitively; ``regex`` matches a pattern."""
    if not text:
        return scored
    key = F.col("customer_id").cast("string")
    if regex:
        return scored.where(key.rlike(f"(?i){text}"))
    return scored.where(F.lower(key).contains(text.lower()))


def risk_bounds(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.min("revenue_at_risk").alias("min_risk"), F.max("revenue_at_risk").alias("max_risk")
    )


def in_range(scored: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """Revenue at risk within inclusive bounds; an open bound is the population's own."""
    risk = F.col("revenue_at_risk")
    keep = risk.isNotNull()
    if low is not None:
        keep = keep & (risk >= low)
    if high is not None:
        keep = keep & (risk <= high)
    return scored.where(keep)


def top_n(scored: DataFrame, n: int = 20, columns: Sequence[str] = tuple(DEFAULT_COLUMNS)) -> DataFrame:
    """First ``n`` customers by revenue at risk (ties by id), as a top-k without a full sort."""
    if n < 1:
        raise ValueError(f"n must be at least 1, got {n}")
    order = [F.col("revenue_at_risk").desc(), F.col("customer_id").asc()]
    return scored.orderBy(*order).limit(n).select(*columns)


def filtered_total(scored: DataFrame, keep: Column) -> DataFrame:
    """Revenue at risk of the filtered rows next to that of all rows."""
    risk = F.col("revenue_at_risk")
    return scored.agg(
        F.coalesce(F.sum(F.when(keep, risk)), F.lit(0.0)).alias("filtered"),
        F.coalesce(F.sum(risk), F.lit(0.0)).alias("everything"),
    )


def risk_level(score: Column) -> Column:
    return F.when(score >= 0.66, "high").when(score >= 0.33, "medium").otherwise("low")


def with_risk_level(scored: DataFrame) -> DataFrame:
    return scored.withColumn("risk_level", risk_level(F.col("churn_probability")))


def compare_customer(
    population: DataFrame, customer_id: int, features: Sequence[str], bins: int = 30
) -> DataFrame:
    """Histogram of each feature with the customer's own bin flagged and their percent rank.

    Two bounded reads (the customer's values, the features' ranges) become
    literals; then one pass counts all bins of all features.
    """
    own = population.where(F.col("customer_id") == customer_id).select(
        *[F.col(f).cast("double").alias(f) for f in features]
    ).first()
    if own is None:
        raise LookupError(f"customer {customer_id!r} not found")
    row = population.agg(
        *[F.min(F.col(f).cast("double")).alias(f"lo_{f}") for f in features],
        *[F.max(F.col(f).cast("double")).alias(f"hi_{f}") for f in features],
        *[F.count_if(F.col(f).cast("double") < F.lit(own[f])).alias(f"below_{f}") for f in features],
        *[F.count(f).alias(f"n_{f}") for f in features],
    ).first()
    entries = []
    for f in features:
        low, high, value = row[f"lo_{f}"], row[f"hi_{f}"], own[f]
        if low is None:
            continue
        width = (high - low) / bins
        rank = None
        if value is not None and row[f"n_{f}"] > 1:
            rank = row[f"below_{f}"] / (row[f"n_{f}"] - 1)
        entries.append(
            F.struct(
                F.lit(f).alias("feature"),
                equal_width_bin(F.col(f).cast("double"), low, high, bins).alias("bin"),
                equal_width_bin(F.lit(value).cast("double"), low, high, bins).alias("own_bin"),
                F.lit(value).cast("double").alias("customer_value"),
                F.lit(rank).cast("double").alias("percent_rank"),
                F.lit(low).alias("low"),
                F.lit(width).alias("width"),
            )
        )
    counted = (
        population.select(F.inline(F.array(*entries)))
        .where(F.col("bin").isNotNull())
        .groupBy("feature", "bin", "own_bin", "customer_value", "percent_rank", "low", "width")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counted.select(
        "feature",
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("lower"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
        "n_rows",
        F.coalesce(F.col("bin") == F.col("own_bin"), F.lit(False)).alias("is_customer_bin"),
        "customer_value",
        "percent_rank",
    )


def score_histogram(scored: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(scored, "churn_probability", bins, 0.0, 1.0)
