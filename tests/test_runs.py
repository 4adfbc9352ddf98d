"""A whole training run and population scoring on the small tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ebbline.ml.models import ChurnPredictor
from ebbline.operators.cleaning import CleaningRules
from ebbline.plans import testviews as V
from ebbline.plans.scoring import score_population
from ebbline.plans.tables import split_xy
from ebbline.plans.training import run_cv_pipeline, run_training
from ebbline.schema import FEATURES
from ebbline.sources import sinks
from ebbline.sources.readers import complete_runs, latest_run

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


def test_training_run_and_population(spark, tmp_path):
    few = {"n_estimators": ("int", 1, 2, 1), "max_depth": ("int", 2, 2, 1)}
    lines = V.txn_dirty(spark, SF)
    rules = CleaningRules(outlier_columns=("quantity",))
    run = run_training(
        lines, V.SNAPSHOTS, "r1", "2026-01-01", str(tmp_path), rules, n_trials=1, folds=2, space=few,
        default_params={"n_estimators": 2, "max_depth": 2},
    )
    stored = latest_run(spark.read.parquet(str(tmp_path / "metrics")))
    assert {r["model"] for r in stored.select("model").distinct().collect()} == {"baseline", "trees_default", "trees_tuned"}
    assert run.importance.count() == len(FEATURES)
    names = spark.read.json(str(tmp_path / "r1" / "feature_names")).first()
    assert names["n_features"] == 33 and names["feature_columns"] == FEATURES
    info = spark.read.json(str(tmp_path / "runs")).first()
    assert info["run_id"] == "r1" and info["trials"] == 1 and info["n_test"] > 0

    loaded = ChurnPredictor.load(spark, str(tmp_path / "r1"))
    scored = score_population(lines, V.SNAPSHOTS["test"], loaded.predict, V.SNAPSHOTS["train"], rules)
    assert scored.count() == scored.select("customer_id").distinct().count() > 100
    bad = scored.where(~F.col("churn_probability").between(0, 1) | F.col("revenue_at_risk").isNull())
    assert bad.count() == 0

    few = {"tree_params": {"n_estimators": 2, "max_depth": 2}, "max_iter": 20, "folds": 2}
    report = {(r.model, r.metric): r for r in run_cv_pipeline(split_xy(spark, SF, "train"), "r1", str(tmp_path), **few).collect()}
    assert len(report) == 4 and all(r.single_split is not None for r in report.values())
    stored = {(r.model, r.metric): r.value for r in run.metrics.collect()}
    assert report["trees", "roc_auc"].single_split == stored["trees_tuned", "roc_auc"]
    run_cv_pipeline(split_xy(spark, SF, "train"), "r1", str(tmp_path), **few)
    assert spark.read.parquet(str(tmp_path / "cv_folds")).count() == 4
    alone = run_cv_pipeline(split_xy(spark, SF, "train"), "r1", str(tmp_path / "new"), **few)
    assert alone.where("single_split is not null").count() == 0


def test_a_run_that_stops_before_its_manifest_is_not_the_latest(spark, tmp_path):
    metrics = spark.createDataFrame([("trees", "roc_auc", 0.5)], "model string, metric string, value double")
    for run_id, ts in (("r1", "2026-01-01"), ("r2", "2026-01-02")):
        sinks.append_metrics(metrics, run_id, ts, str(tmp_path / "metrics"))
        if run_id == "r1":  # the second one is killed here
            sinks.complete_run(spark, run_id, ts, str(tmp_path), ["metrics"])
    stored = spark.read.parquet(str(tmp_path / "metrics"))
    assert latest_run(stored).first()["run_id"] == "r2"
    assert latest_run(stored, complete=complete_runs(spark, str(tmp_path))).first()["run_id"] == "r1"
    with pytest.raises(LookupError):
        latest_run(stored, "r2", complete_runs(spark, str(tmp_path)))
    sinks.complete_run(spark, "r2", "2026-01-02", str(tmp_path), ["metrics"])
    assert latest_run(stored, complete=complete_runs(spark, str(tmp_path))).first()["run_id"] == "r2"
