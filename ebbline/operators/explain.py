"""Per-row feature contributions and what is derived from them.

A row carries its contributions as one array column ``contributions`` of
``(feature, value, contribution)``; top-k lists and sentences work on that
array inside the row, without a shuffle.  Long form is one ``inline`` away.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.numbers import general_format
from ebbline.ml.prep import PREFIX

CONTRIBUTIONS = "contributions"
BASE = "base_value"


@dataclass(frozen=True)
class LinearExplainer:
    """Exact attribution of a linear model: ``coefficient * (x - mean)``."""

    coefficients: dict[str, float]
    means: dict[str, float]
    intercept: float = 0.0

    @staticmethod
    def fit(
        background: DataFrame, coefficients: Mapping[str, float], intercept: float = 0.0
    ) -> LinearExplainer:
        """Means of the background rows: one aggregate, one row of scalars."""
        row = background.agg(*[F.avg(f).alias(f) for f in coefficients]).first()
        means = {f: float(row[f]) if row[f] is not None else 0.0 for f in coefficients}
        return LinearExplainer(dict(coefficients), means, intercept)

    @property
    def base_value(self) -> float:
        return self.intercept + sum(c * self.means[f] for f, c in self.coefficients.items())

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``contributions`` and ``base_value``; a missing value counts as the mean."""
        entries = [
            F.struct(
                F.lit(f).alias("feature"),
                F.col(f).cast("double").alias("value"),
                F.coalesce(
                    F.lit(c) * (F.col(f).cast("double") - F.lit(self.means[f])), F.lit(0.0)
                ).alias("contribution"),
            )
            for f, c in self.coefficients.items()
        ]
        return df.withColumns({CONTRIBUTIONS: F.array(*entries), BASE: F.lit(self.base_value)})


def explain_pipeline(pipeline: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Attribution of a fitted linear pipeline (preparation, vector, logistic regression).

    The contribution of a feature is its coefficient times its imputed and scaled value, so a
    customer average in everything keeps the intercept, the base value; base plus contributions
    is the log-odds of the predicted probability.
    """
    prepare, assembler, model = pipeline.stages
    weights = dict(zip(assembler.getInputCols(), model.coefficients.toArray()))
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f).cast("double").alias("value"),
            (F.lit(float(weights[PREFIX + f])) * F.col(PREFIX + f)).alias("contribution"),
        )
        for f in features
    ]
    return prepare.transform(df).select(
        *df.columns, F.array(*entries).alias(CONTRIBUTIONS), F.lit(float(model.intercept)).alias(BASE)
    )


def to_long(explained: DataFrame, keep: Sequence[str] = ("customer_id",)) -> DataFrame:
    """``(keep..., feature, value, contribution)``, one row per feature."""
    return explained.select(*keep, F.inline(CONTRIBUTIONS))


def mean_abs_contribution(explained: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature; partial aggregates, a handful of groups."""
    return to_long(explained, []).groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_contribution")
    )


def importance_table(explained: DataFrame, native: Mapping[str, float]) -> DataFrame:
    """Model-native importance next to the mean absolute contribution."""
    lookup = F.create_map(*[x for f, v in native.items() for x in (F.lit(f), F.lit(float(v)))])
    return mean_abs_contribution(explained).select(
        "feature", lookup[F.col("feature")].alias("native_importance"), "mean_abs_contribution"
    )


def drivers(explained: DataFrame, mask: Column, n: int = 10) -> DataFrame:
    """Strongest features among the rows that satisfy ``mask``; empty when none do."""
    return (
        mean_abs_contribution(explained.where(mask))
        .orderBy(F.col("mean_abs_contribution").desc(), "feature")
        .limit(n)
    )


def ranked_contributions() -> Column:
    """The contributions by falling absolute size, ties by feature name."""
    keyed = F.transform(
        CONTRIBUTIONS,
        lambda c: F.struct(
            (-F.abs(c["contribution"])).alias("size"),
            c["feature"].alias("feature"),
            c["value"].alias("value"),
            c["contribution"].alias("contribution"),
        ),
    )
    # Unlike array_sort this compares without an expression for each comparison.
    return F.sort_array(keyed)


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, c: acc + c["contribution"])


def waterfall(explained: DataFrame, k: int = 12, key: str = "customer_id") -> DataFrame:
    """Per row: base value, the ``k`` largest contributions, the rest as one entry, the prediction."""
    ranked = F.col("_ranked")
    rest = F.slice(ranked, k + 1, F.greatest(F.size(ranked) - k, F.lit(0)))

    def step(no: Column, label: Column, amount: Column) -> Column:
        return F.struct(no.cast("int").alias("step"), label.alias("label"), amount.alias("amount"))

    top = F.transform(
        F.slice(ranked, 1, k),
        lambda c, i: step(
            i + 1, F.concat(c["feature"], F.lit(" = "), F.coalesce(general_format(c["value"]), F.lit("nan"))), c["contribution"]
        ),
    )
    other = F.when(
        F.size(ranked) > k,
        F.array(
            step(F.lit(k + 1), F.concat((F.size(ranked) - k).cast("string"), F.lit(" other features")), _sum(rest))
        ),
    ).otherwise(F.array().cast("array<struct<step:int,label:string,amount:double>>"))
    first = F.array(step(F.lit(0), F.lit("Base value"), F.col(BASE)))
    last = F.array(step(F.lit(k + 2), F.lit("Prediction"), F.col(BASE) + _sum(ranked)))
    return (
        explained.select(key, BASE, ranked_contributions().alias("_ranked"))
        # Spark puts a filter on the array's size before an inner inline, and so works all of it out twice.
        .select(key, F.inline_outer(F.concat(first, top, other, last)))
        .where("step IS NOT NULL")
    )


def feature_label(name: Column) -> Column:
    """``spend_90d`` -> ``Spend 90d``."""
    spaced = F.regexp_replace(F.regexp_replace(name, "_", " "), r"(\d+)", " $1")
    return F.initcap(F.trim(F.regexp_replace(spaced, r"\s+", " ")))


def sentences(
    explained: DataFrame, k: int = 5, labels: Mapping[str, str] | None = None, key: str = "customer_id"
) -> DataFrame:
    """Per row, up to ``k`` plain sentences about its strongest contributions."""
    custom = None
    if labels:
        custom = F.create_map(*[x for pair in labels.items() for x in map(F.lit, pair)])

    def sentence(c: Column) -> Column:
        label = feature_label(c["feature"])
        if custom is not None:
            label = F.coalesce(custom[c["feature"]], label)
        word = F.when(c["contribution"] > 0, "raising").otherwise("lowering")
        value = F.coalesce(general_format(c["value"]), F.lit("nan"))
        return F.concat(label, F.lit(" ("), value, F.lit(") is "), word, F.lit(" this customer's churn risk."))

    top = F.slice(F.col("_ranked"), 1, k)
    return explained.select(key, ranked_contributions().alias("_ranked")).select(
        key, F.transform(top, sentence).alias("sentences")
    )


def riskiest_customer(scored: DataFrame, score: str = "churn_probability") -> int:
    """Id with the highest score (ties: the smallest id)."""
    row = scored.agg(F.max_by("customer_id", F.struct(F.col(score), -F.col("customer_id"))).alias("id")).first()
    if row["id"] is None:
        raise LookupError("no scored customer")
    return row["id"]


def one_customer(explained: DataFrame, customer_id: int) -> DataFrame:
    """The explained row of a customer; unknown ids raise."""
    row = explained.where(F.col("customer_id") == customer_id)
    if not row.limit(1).count():
        raise LookupError(f"customer {customer_id!r} not found")
    return row
