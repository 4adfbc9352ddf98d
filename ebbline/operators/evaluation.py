"""Exact classification metrics over ``(customer_id, label, score)``.

Curves first collapse rows to distinct scores, then take running sums in the
distributed global order of :mod:`ebbline.functions.ordering`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.numbers import bucket_index, equal_width_bin, ratio_or_zero
from ebbline.functions.ordering import asc, desc, with_running
from ebbline.functions.quantiles import exact_quantiles

COMPARED_METRICS = ["roc_auc", "pr_auc", "precision", "recall", "f1"]


def _flag(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def confusion_aggs(threshold: float = 0.5) -> list[Column]:
    hit, pos = F.col("score") >= threshold, F.col("label") == 1
    return [
        _flag(~hit & ~pos).alias("tn"),
        _flag(hit & ~pos).alias("fp"),
        _flag(~hit & pos).alias("fn"),
        _flag(hit & pos).alias("tp"),
    ]


def confusion(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """tn, fp, fn, tp; a score equal to the threshold is a positive prediction."""
    return scored.agg(*confusion_aggs(threshold))


def _prf_columns() -> dict[str, Column]:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return {
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }


def precision_recall_f1(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """0 where a ratio is undefined."""
    return confusion(scored, threshold).withColumns(_prf_columns()).select("precision", "recall", "f1")


def brier(scored: DataFrame) -> DataFrame:
    gap = F.col("score") - F.col("label")
    return scored.agg(F.avg(gap * gap).alias("brier"))


def by_score(scored: DataFrame) -> DataFrame:
    """Distinct scores with their positives and negatives; rows without a score take no part in any ranking."""
    return scored.where(F.col("score").isNotNull()).groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def score_curve(scored: DataFrame, next_row: bool = False) -> DataFrame:
    """Per distinct score, descending: ``pos, neg``, running ``tp, fp`` and totals ``p, n``."""
    return with_running(
        by_score(scored),
        [desc("score")],
        sums={"tp": "pos", "fp": "neg"},
        totals={"p": "pos", "n": "neg"},
        lead={"next_pos": "pos", "next_neg": "neg"} if next_row else None,
    )


def _auc(curve: DataFrame) -> list[Column]:
    """ROC-AUC (ties count half) and average precision (a step sum, not a trapezoid)."""
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    below = F.col("n") - fp
    pairs = F.sum(pos * (below + neg / F.lit(2.0)))
    area = F.try_divide(pairs, F.max(F.col("p")).cast("double") * F.max(F.col("n")).cast("double"))
    step = F.sum(pos * tp / (tp + fp).cast("double"))
    return [area.alias("roc_auc"), F.try_divide(step, F.max("p").cast("double")).alias("pr_auc")]


def auc_metrics(scored: DataFrame) -> DataFrame:
    """One row with ``roc_auc`` and ``pr_auc``; null with a single class."""
    curve = score_curve(scored)
    return curve.agg(*_auc(curve))


def auc_by(scored: DataFrame, group: str) -> DataFrame:
    """``group, roc_auc, pr_auc``: the areas of every group in one pass over all of them.

    Running sums go over all groups in order; those of the groups before are taken off again.
    """
    own = scored.where(F.col("score").isNotNull()).groupBy(group, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    running = with_running(own, [asc(group), desc("score")], sums={"tp": "pos", "fp": "neg"})
    totals = running.groupBy(group).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.min(F.col("tp") - F.col("pos")).alias("p0"), F.min(F.col("fp") - F.col("neg")).alias("n0"))
    curve = running.join(totals, group).withColumns({"tp": F.col("tp") - F.col("p0"), "fp": F.col("fp") - F.col("n0")})
    return curve.groupBy(group).agg(*_auc(curve))


def roc_auc(scored: DataFrame) -> DataFrame:
    return auc_metrics(scored).select("roc_auc")


def average_precision(scored: DataFrame) -> DataFrame:
    return auc_metrics(scored).select("pr_auc")


def roc_points(scored: DataFrame, drop_intermediate: bool = False) -> DataFrame:
    """``fpr, tpr, threshold`` in falling threshold order, starting at (0, 0, infinity).

    ``drop_intermediate`` leaves out points on a straight line between their neighbours.
    """
    curve = score_curve(scored, next_row=drop_intermediate)
    if drop_intermediate:
        bend = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
        curve = curve.where(bend | F.col("next_pos").isNull())
    points = curve.select(
        F.try_divide(F.col("fp").cast("double"), F.col("n")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("p")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    start = scored.sparkSession.createDataFrame([(0.0, 0.0, float("inf"))], points.schema)
    return start.unionByName(points)


def pr_points(scored: DataFrame) -> DataFrame:
    """``precision, recall, threshold`` with the end point (1, 0, null) and the prevalence."""
    points = score_curve(scored).select(
        (F.col("tp") / (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
        F.try_divide(F.col("tp").cast("double"), F.col("p")).alias("recall"),
        F.col("score").alias("threshold"),
        (F.col("p") / (F.col("p") + F.col("n")).cast("double")).alias("prevalence"),
    )
    end = scored.agg(
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("threshold"),
        F.avg(F.col("label").cast("double")).alias("prevalence"),
    )
    return points.unionByName(end)


def calibration(scored: DataFrame, n_bins: int = 10) -> DataFrame:
    """Mean score, observed rate and size per quantile bin; empty bins do not appear, nor rows without a score."""
    scored = scored.where(F.col("score").isNotNull())
    distinct = scored.select("score").distinct().limit(n_bins).count()
    n_bins = min(n_bins, max(2, distinct))
    edges = exact_quantiles(scored, ["score"], [i / n_bins for i in range(n_bins + 1)])["score"]
    if edges[0] is None:
        edges = []
    return (
        scored.groupBy(bucket_index(F.col("score"), edges[1:-1]).alias("bin"))
        .agg(
            F.avg("score").alias("mean_score"),
            F.avg(F.col("label").cast("double")).alias("observed_rate"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )


def ranked_by_score(scored: DataFrame) -> DataFrame:
    """``rank`` by score descending (ties by customer id) plus totals of rows and positives."""
    slim = scored.where(F.col("score").isNotNull()).select("customer_id", F.col("label").cast("bigint").alias("label"), "score")
    return with_running(
        slim, [desc("score"), asc("customer_id")], totals={"n_total": "*", "pos_total": "label"}
    )


def _lift_agg(k: float) -> Column:
    # Decimal arithmetic would hide n * k landing just above an integer; this
    # follows the double product on purpose.
    top = F.greatest(F.lit(1), F.ceil(F.col("n_total") * F.lit(float(k))))
    top_rate = F.avg(F.when(F.col("rank") <= top, F.col("label").cast("double")))
    return F.try_divide(top_rate, F.avg(F.col("label").cast("double")))


def check_share(k: float) -> None:
    if not 0 < k <= 1:
        raise ValueError(f"k must be in (0, 1], got {k}")


def lift_at_k(scored: DataFrame, k: float = 0.1) -> DataFrame:
    """Positive rate among the top share ``k`` over the base rate; null without positives."""
    check_share(k)
    return ranked_by_score(scored).agg(_lift_agg(k).alias("lift"))


def gains(scored: DataFrame, n_deciles: int = 10) -> DataFrame:
    """Per decile: % of customers, % of positives captured so far, cumulative lift.

    All cuts are conditional sums of a single aggregate over the ranked rows.
    """
    cuts = []
    for d in range(1, n_deciles + 1):
        cut = F.greatest(
            F.lit(1), F.bround(F.col("n_total") * F.lit(d / n_deciles), 0).cast("bigint")
        )
        inside = F.col("rank") <= cut
        cuts += [
            F.sum(F.when(inside, F.col("label"))).alias(f"c{d}"),
            F.count_if(inside).alias(f"k{d}"),
        ]
    sums = ranked_by_score(scored).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("p"), *cuts
    )
    rows = [
        F.struct(
            F.lit(d).alias("decile"),
            F.lit(d / n_deciles * 100).alias("pct_customers"),
            (ratio_or_zero(F.col(f"c{d}"), F.col("p")) * 100).alias("pct_captured"),
            F.try_divide(
                F.try_divide(F.col(f"c{d}").cast("double"), F.col(f"k{d}")),
                F.try_divide(F.col("p").cast("double"), F.col("n")),
            ).alias("lift"),
        )
        for d in range(1, n_deciles + 1)
    ]
    return sums.where(F.col("n") > 0).select(F.inline(F.array(*rows)))


def with_revenue_at_risk(
    df: DataFrame, score: str = "churn_probability", value: str = "spend_90d"
) -> DataFrame:
    """Adds ``revenue_at_risk = score * value``; a customer without spend has 0 at risk."""
    return df.withColumn(
        "revenue_at_risk", F.col(score) * F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    )


def evaluate(
    scored: DataFrame, model: str, value: str | None = "spend_90d", threshold: float = 0.5, k: float = 0.1
) -> DataFrame:
    """All metrics of one model as long rows ``(model, metric, value)``.

    Three aggregates (row-wise sums, the score curve, the ranking); each is a
    single row that is turned into long form, so nothing is joined.
    """
    check_share(k)
    at_risk = F.col("score") * F.coalesce(F.col(value).cast("double"), F.lit(0.0)) if value else F.lit(None)
    gap = F.col("score") - F.col("label")
    sums = scored.agg(
        *confusion_aggs(threshold),
        F.avg(gap * gap).alias("brier"),
        F.sum(at_risk.cast("double")).alias("revenue_at_risk_total"),
    ).withColumns(_prf_columns())
    sum_names = ["tn", "fp", "fn", "tp", "precision", "recall", "f1", "brier"]
    if value:
        sum_names.append("revenue_at_risk_total")
    percent = f"{k * 100:g}"
    parts = [
        _long(sums, sum_names),
        _long(auc_metrics(scored), ["roc_auc", "pr_auc"]),
        _long(ranked_by_score(scored).agg(_lift_agg(k).alias(f"lift_at_{percent}pct")), [f"lift_at_{percent}pct"]),
    ]
    long = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return long.select(F.lit(model).alias("model"), "metric", "value")


def _long(one_row: DataFrame, names: Sequence[str]) -> DataFrame:
    rows = [
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names
    ]
    return one_row.select(F.inline(F.array(*rows)))


def compare_models(metrics: DataFrame) -> DataFrame:
    """One row per model with the five headline metrics as columns."""
    return metrics.groupBy("model").pivot("metric", COMPARED_METRICS).agg(F.first("value"))


def tradeoff(metrics: DataFrame, tuned: str, default: str) -> DataFrame:
    """Change of precision and recall from the default to the tuned model, in words."""

    def pick(model: str, metric: str) -> Column:
        return F.max(F.when((F.col("model") == model) & (F.col("metric") == metric), F.col("value")))

    return metrics.agg(
        (pick(tuned, "precision") - pick(default, "precision")).alias("precision_delta"),
        (pick(tuned, "recall") - pick(default, "recall")).alias("recall_delta"),
    ).withColumns(
        {
            "recall_word": F.when(F.col("recall_delta") >= 0, "gains").otherwise("loses"),
            "precision_word": F.when(F.col("precision_delta") < 0, "gives up").otherwise("keeps"),
        }
    )


def histogram(
    df: DataFrame, column: str, bins: int = 30, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Counts per equal-width bin; bounds default to the column's min and max."""
    if low is None or high is None:
        row = df.agg(
            F.min(F.col(column).cast("double")).alias("lo"), F.max(F.col(column).cast("double")).alias("hi")
        ).first()
        low = row["lo"] if low is None else low
        high = row["hi"] if high is None else high
        if low is None:
            low = high = 0.0
    width = (high - low) / bins
    bin_ = equal_width_bin(F.col(column).cast("double"), low, high, bins)
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(bin_.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumns(
            {
                "lower": F.lit(low) + F.col("bin") * F.lit(width),
                "upper": F.lit(low) + (F.col("bin") + 1) * F.lit(width),
            }
        )
    )
