"""Imputation, scaling and class weights fitted on training rows only.

Fitted statistics are a few scalars per column. They become SQL expressions in
a ``SQLTransformer``, so a saved pipeline carries its own preparation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.numbers import no_nan
from ebbline.functions.quantiles import exact_quantiles

PREFIX = "x_"
VECTOR = "features"


def fit_medians(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact median per feature, nulls and NaN ignored; a column without values gets 0."""
    return {f: (q[0] if q[0] is not None else 0.0) for f, q in exact_quantiles(train, features, [0.5]).items()}


def impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Nulls and NaN become the median."""
    return df.withColumns({f: F.coalesce(no_nan(F.col(f).cast("double")), F.lit(m)) for f, m in medians.items()})


def fit_scaling(train: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per feature; a constant feature is divided by 1."""
    row = train.agg(
        *[F.avg(F.col(f).cast("double")).alias(f"m_{f}") for f in features],
        *[F.stddev_pop(F.col(f).cast("double")).alias(f"s_{f}") for f in features],
    ).first()
    return {f: (row[f"m_{f}"] or 0.0, row[f"s_{f}"] or 1.0) for f in features}


def scale(df: DataFrame, scaling: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {f: (F.col(f).cast("double") - F.lit(mean)) / F.lit(std) for f, (mean, std) in scaling.items()}
    )


def class_counts(df: DataFrame, label: str = "label") -> dict[int, int]:
    row = df.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")).first()
    return {0: row["neg"], 1: row["pos"]}


def class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: negatives, positives and the weight of a positive (1 without positives)."""
    return df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives")
    ).withColumn(
        "positive_weight",
        F.coalesce(F.try_divide(F.col("negatives").cast("double"), F.col("positives")), F.lit(1.0)),
    )


def with_class_weight(df: DataFrame, label: str = "label", column: str = "weight") -> DataFrame:
    weight = class_weight(df, label).first()["positive_weight"]
    return df.withColumn(column, F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))


def _sql_double(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def preparation(
    medians: Mapping[str, float],
    scaling: Mapping[str, tuple[float, float]] | None = None,
    indicators: Sequence[str] = (),
) -> tuple[SQLTransformer, VectorAssembler, list[str]]:
    """Stages ``impute -> scale -> is-missing flags -> vector`` and the vector's column names."""
    exprs = []
    for f, m in medians.items():
        filled = f"coalesce(nanvl(CAST(`{f}` AS DOUBLE), CAST(NULL AS DOUBLE)), {_sql_double(m)})"
        if scaling:
            mean, std = scaling[f]
            filled = f"({filled} - {_sql_double(mean)}) / {_sql_double(std)}"
        exprs.append(f"{filled} AS `{PREFIX}{f}`")
    exprs += [f"CAST(`{f}` IS NULL OR isnan(CAST(`{f}` AS DOUBLE)) AS DOUBLE) AS `{PREFIX}no_{f}`" for f in indicators]
    columns = [f"{PREFIX}{f}" for f in medians] + [f"{PREFIX}no_{f}" for f in indicators]
    transformer = SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")
    return transformer, VectorAssembler(inputCols=columns, outputCol=VECTOR), columns
