"""A complete training run: clean, split, search, fit, evaluate, explain, persist."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.dates import SnapshotLike
from ebbline.ml.cv import CV_METRICS, SEARCH_SPACE, best_trial, cv_report, cv_summary, run_time_cv, search
from ebbline.ml.models import ChurnPredictor, score_with, train_baseline, train_trees
from ebbline.ml.trees import explain_trees, native_importance
from ebbline.operators.cleaning import CleaningRules, clean
from ebbline.operators.evaluation import evaluate
from ebbline.operators.explain import importance_table
from ebbline.operators.splits import build_time_splits, concat_splits, prepare_xy
from ebbline.schema import FEATURES
from ebbline.session import write_table
from ebbline.sources import sinks
from ebbline.sources.readers import complete_runs, latest_run


@dataclass(frozen=True)
class TrainingRun:
    predictor: ChurnPredictor
    metrics: DataFrame
    importance: DataFrame
    trials: DataFrame


def run_training(
    lines: DataFrame,
    snapshots: Mapping[str, SnapshotLike],
    run_id: str,
    run_ts: str,
    output: str,
    rules: CleaningRules = CleaningRules(),
    n_trials: int = 50,
    timeout: float | None = None,
    folds: int = 5,
    space: Mapping[str, tuple] = SEARCH_SPACE,
    default_params: Mapping[str, float] | None = None,
    seed: int = 42,
) -> TrainingRun:
    """Search on train, refit the best trees on train and val, evaluate on test.

    Models: ``baseline`` and ``trees_default`` fitted on train,
    ``trees_tuned`` on train and val.  Written under ``output``: the predictor,
    ``metrics`` (appended, by run), ``runs`` (one row each), the importance
    table as CSV and the feature names.
    """
    snapshots = dict(snapshots)
    spark = lines.sparkSession
    cleaned = clean(lines, snapshots["train"], rules)
    table = write_table(build_time_splits(cleaned, snapshots), "splits")

    def xy(*names: str) -> DataFrame:
        return prepare_xy(concat_splits(table, names), keep=["customer_id"])

    train, test = xy("train"), xy("test")
    trials = search(train, n_trials, timeout, folds, seed=seed, space=space)
    best = best_trial(trials).first()
    models = {
        "baseline": train_baseline(train, seed=seed),
        "trees_default": train_trees(train, params=default_params, seed=seed),
        "trees_tuned": train_trees(xy("train", "val"), params=best["params"], seed=seed),
    }
    metrics = None
    for name, model in models.items():
        scored = write_table(
            score_with(model, test, "score").select("customer_id", "label", "score", "spend_90d"), "test_scores"
        )
        part = evaluate(scored, name)
        metrics = part if metrics is None else metrics.unionByName(part)
    metrics = write_table(metrics, "metrics")

    tuned = models["trees_tuned"]
    explained = write_table(explain_trees(tuned, test, FEATURES).select("customer_id", "contributions"), "explained")
    importance = importance_table(explained, native_importance(tuned, FEATURES))

    predictor = ChurnPredictor.of(tuned, test)
    predictor.save(f"{output}/{run_id}")
    sinks.write_result(
        importance.orderBy(F.col("mean_abs_contribution").desc(), "feature"), f"{output}/{run_id}/importance", "csv"
    )
    sinks.write_feature_names(train, f"{output}/{run_id}/feature_names")
    sinks.append_metrics(metrics, run_id, run_ts, f"{output}/metrics")
    sizes = {r["split"]: r["n"] for r in table.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    sinks.append_run_info(
        spark,
        {
            "run_id": run_id, "version": predictor.version, "trained_at": run_ts, "algorithm": "boosted trees",
            "n_features": len(FEATURES), "folds": folds, "trials": trials.count(), "best_score": best["score"],
            **{f"n_{k}": v for k, v in sizes.items()}, "parameters": str(dict(best["params"])),
        },
        f"{output}/runs",
    )
    sinks.complete_run(spark, run_id, run_ts, output, [f"{run_id}", "metrics", "runs"])
    return TrainingRun(predictor, metrics, importance, trials)


def run_cv_pipeline(
    xy: DataFrame,
    run_id: str,
    output: str,
    folds: int = 5,
    tree_params: Mapping[str, float] | None = None,
    max_iter: int = 1000,
    seed: int = 42,
    parallelism: int = 2,
) -> DataFrame:
    """Cross-validate, compare with the latest single-split metrics under ``output``, persist both tables.

    Returns the report (``model, metric, single_split, cv_mean, cv_std, delta``); without any
    stored metrics the single-split columns are null.  ``cv_folds`` and ``cv_report`` are written
    by run.
    """
    spark = xy.sparkSession
    by_fold = run_time_cv(xy, folds, tree_params=tree_params, max_iter=max_iter, seed=seed, parallelism=parallelism)
    single = None
    try:
        stored = latest_run(spark.read.parquet(f"{output}/metrics"), complete=complete_runs(spark, output))
        model = F.when(F.col("model").isin("trees_tuned"), "trees").otherwise(F.col("model"))
        single = stored.where(F.col("metric").isin(CV_METRICS)).select(model.alias("model"), "metric", "value")
    except (AnalysisException, LookupError):
        pass  # nothing stored yet
    report = write_table(cv_report(cv_summary(by_fold), single), "cv_report")
    sinks.append_rows(by_fold, run_id, f"{output}/cv_folds")
    sinks.append_rows(report, run_id, f"{output}/cv_report")
    return report
