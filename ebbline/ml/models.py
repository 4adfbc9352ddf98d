"""Churn models: a logistic pipeline of MLlib, boosted trees, and the predictor that guards their input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.ml import prep
from ebbline.ml.boosting import BoostedTrees, Spec, TreeParams, fit_many
from ebbline.ml.smote import oversample
from ebbline.operators.validation import check_fields
from ebbline.schema import FEATURES
from ebbline.session import write_table

SCHEMA_FILE = "version string, feature_columns array<string>, dtypes array<string>, kind string"

# An iterative fit runs one job per step; small inputs get fewer, fuller tasks.
ROWS_PER_TASK = 20_000


def _fit_input(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows as a written table, and their number."""
    table = write_table(rows, "fit")
    n = table.count()
    # Never more partitions than there are: large tables keep theirs.
    return table.coalesce(max(1, -(-n // ROWS_PER_TASK))), n


def train_baseline(
    train: DataFrame,
    features: Sequence[str] = tuple(FEATURES),
    use_smote: bool = True,
    seed: int = 42,
    max_iter: int = 1000,
    key: str = "customer_id",
) -> PipelineModel:
    """Median imputation, scaling, oversampling (training rows only), L2 logistic regression; all rows of both classes take part."""
    medians = prep.fit_medians(train, features)
    filled = prep.impute(train.select(key, *features, "label"), medians)
    scaling = prep.fit_scaling(filled, features)
    rows = prep.scale(filled, scaling)
    if use_smote:
        rows = oversample(rows.where(F.col("label").isin(0, 1)), features, key, seed=seed)
    rows, n = _fit_input(rows.select(*features, F.col("label").cast("double").alias("label")))
    transformer, assembler, columns = prep.preparation(medians, scaling)
    vectors = assembler.transform(
        rows.withColumnsRenamed({f: f"{prep.PREFIX}{f}" for f in features})
    ).select(prep.VECTOR, "label")
    # The penalty of a unit-strength L2 term on the summed loss, per row.
    model = LogisticRegression(
        featuresCol=prep.VECTOR, maxIter=max_iter, regParam=1.0 / max(n, 1),
        elasticNetParam=0.0, standardization=False,
    ).fit(vectors)
    return PipelineModel([transformer, assembler, model])


def train_trees(
    train: DataFrame,
    features: Sequence[str] = tuple(FEATURES),
    params: Mapping[str, float] | None = None,
    seed: int = 42,
    key: str = "customer_id",
) -> BoostedTrees:
    """Boosted trees with class weights; missing values stay missing and go to a learned side of each split."""
    return fit_many(write_table(train.select(key, *features, "label"), "fit"), features, [Spec(TreeParams.of(params), seed)], key)[0]


def score_with(model: PipelineModel | BoostedTrees, df: DataFrame, column: str = "churn_probability") -> DataFrame:
    """Adds the probability of churn; helper columns of a pipeline are dropped."""
    if isinstance(model, BoostedTrees):
        return model.scored(df, column)
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(column))


@dataclass(frozen=True)
class ChurnPredictor:
    """A fitted model plus the columns it expects, in order."""

    model: PipelineModel | BoostedTrees
    features: list[str]
    dtypes: dict[str, str]
    version: str = "v1"

    @staticmethod
    def of(model: PipelineModel | BoostedTrees, matrix: DataFrame, features: Sequence[str] = tuple(FEATURES)) -> ChurnPredictor:
        types = dict(matrix.dtypes)
        return ChurnPredictor(model, list(features), {f: types[f] for f in features})

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.model.save(f"{path}/model_{self.version}")
        kind = "trees" if isinstance(self.model, BoostedTrees) else "pipeline"
        row = (self.version, self.features, [self.dtypes[f] for f in self.features], kind)
        spark.createDataFrame([row], SCHEMA_FILE).write.json(f"{path}/feature_schema")

    @staticmethod
    def load(spark: SparkSession, path: str, version: str = "v1") -> ChurnPredictor:
        schema = spark.read.schema(SCHEMA_FILE).json(f"{path}/feature_schema").first()
        names, at = list(schema["feature_columns"]), f"{path}/model_{version}"
        model = BoostedTrees.load(spark, at, names) if schema["kind"] == "trees" else PipelineModel.load(at)
        return ChurnPredictor(model, names, dict(zip(names, schema["dtypes"])), version)

    def predict(self, df: DataFrame, keep: Sequence[str] = ("customer_id",)) -> DataFrame:
        """``keep`` columns, the features in order and ``churn_probability``.

        Columns besides ``keep`` must be exactly the model's; order is free.
        """
        check_fields(df.columns, self.features, keep)
        return score_with(self.model, df.select(*keep, *self.features))
