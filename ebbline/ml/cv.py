"""Forward-chaining cross-validation, its report, and a guided parameter search."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.ordering import OrderKey, asc
from ebbline.ml.boosting import (
    ROWS_PER_TASK, BoostedTrees, Spec, Tree, TreeParams, fit_many, fit_packed, fit_scores, margins, packed_rows, quantile_edges, sigmoid,
)
from ebbline.ml.models import score_with, train_baseline
from ebbline.operators.evaluation import auc_by, auc_metrics
from ebbline.operators.splits import fold_classes, forward_folds, train_part, usable_folds, val_part
from ebbline.schema import FEATURES
from ebbline.session import write_table

FOLD_SCHEMA = "model string, fold int, roc_auc double, pr_auc double, n_train bigint, n_val bigint"
CV_METRICS = ["roc_auc", "pr_auc"]


def make_folds(
    xy: DataFrame, k: int, order: Sequence[OrderKey] = (asc("customer_id"),)
) -> DataFrame:
    """Fold numbers as a written table, since every fit reads it."""
    return write_table(forward_folds(xy, k, order), "folds")


def run_time_cv(
    xy: DataFrame,
    k: int = 5,
    features: Sequence[str] = tuple(FEATURES),
    order: Sequence[OrderKey] = (asc("customer_id"),),
    tree_params: Mapping[str, float] | None = None,
    max_iter: int = 1000,
    use_smote: bool = True,
    seed: int = 42,
    models: Sequence[str] = ("baseline", "trees"),
    parallelism: int = 2,
) -> DataFrame:
    """ROC-AUC and PR-AUC per model and fold.

    Each fold trains on all rows before it; oversampling and class weights see
    its training part only.  Folds with one class in training are skipped.
    The trees of all folds are one fit over the whole table; baseline fits are
    jobs of their own, a few at a time.
    """
    folds = make_folds(xy, k, order)
    sizes = {r["fold"]: (r["n_train"], r["n_val"]) for r in fold_classes(folds, k).collect()}
    usable = usable_folds(folds, k)

    def baseline(fold: int) -> tuple:
        model = train_baseline(train_part(folds, fold), features, use_smote, seed, max_iter)
        row = auc_metrics(score_with(model, val_part(folds, fold), "score").select("label", "score")).first()
        return ("baseline", fold, row["roc_auc"], row["pr_auc"], *sizes[fold])

    rows = []
    if "baseline" in models:
        with ThreadPoolExecutor(parallelism) as pool:
            rows += pool.map(baseline, usable)
    if "trees" in models:
        fitted = fit_folds(folds, usable, TreeParams.of(tree_params), features, seed, quantile_edges(folds, features))
        areas = {r["grp"]: r for r in auc_by(held_out_scores(folds, features, {f: (f, m.trees) for f, m in fitted.items()}), "grp").collect()}
        rows += [("trees", f, areas[f]["roc_auc"], areas[f]["pr_auc"], *sizes[f]) for f in usable]
    return xy.sparkSession.createDataFrame(rows, FOLD_SCHEMA)


def fit_folds(
    folds: DataFrame, usable: Sequence[int], params: TreeParams, features: Sequence[str], seed: int, edges: list[np.ndarray]
) -> dict[int, BoostedTrees]:
    """The trees of every fold, grown side by side: fold f learns from the rows before its own."""
    return dict(zip(usable, fit_many(folds, features, [Spec(params, seed, f) for f in usable], key_of(folds), "val_fold", edges)))


def key_of(folds: DataFrame) -> str:
    return next(c for c in folds.columns if c in ("customer_id", "pos"))


def held_out_scores(folds: DataFrame, features: Sequence[str], models: Mapping[int, tuple[int, Sequence[Tree]]]) -> DataFrame:
    """``grp, label, score``: for each group (fold, trees) the scores of the fold's own rows, in one pass."""
    models = dict(models)
    columns = [F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(features))])
            label, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "val_fold"))
            for group, (own, trees) in models.items():
                at = np.flatnonzero(fold == own)
                if len(at):
                    yield pa.RecordBatch.from_pydict({
                        "grp": np.full(len(at), group, dtype=np.int32), "label": label[at].astype(np.int32), "score": sigmoid(margins(trees, x[at])),
                    })

    return folds.where("val_fold > 0 AND label IS NOT NULL").select(*columns, "label", "val_fold").mapInArrow(run, "grp int, label int, score double")


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """Mean and population deviation over folds: ``model, metric, cv_mean, cv_std``."""
    long = fold_metrics.select(
        "model",
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in CV_METRICS])
        ),
    )
    return long.groupBy("model", "metric").agg(
        F.avg("value").alias("cv_mean"), F.stddev_pop("value").alias("cv_std")
    )


def cv_report(summary: DataFrame, single_split: DataFrame | None = None) -> DataFrame:
    """``model, metric, single_split, cv_mean, cv_std, delta``; nulls without a single-split value."""
    if single_split is None:
        joined = summary.withColumn("single_split", F.lit(None).cast("double"))
    else:
        single = single_split.select("model", "metric", F.col("value").alias("single_split"))
        joined = summary.join(single, ["model", "metric"], "left")
    return joined.select(
        "model", "metric", "single_split", "cv_mean", "cv_std",
        (F.col("single_split") - F.col("cv_mean")).alias("delta"),
    )


# The search space.  Kinds: int with a step, real, log-uniform real.
SEARCH_SPACE = {
    "n_estimators": ("int", 100, 500, 50),
    "max_depth": ("int", 2, 8, 1),
    "learning_rate": ("log", 0.01, 0.3),
    "subsample": ("real", 0.5, 1.0),
    "colsample_bytree": ("real", 0.5, 1.0),
    "min_child_weight": ("int", 1, 10, 1),
    "gamma": ("real", 0.0, 5.0),
    "reg_alpha": ("log", 1e-8, 10.0),
    "reg_lambda": ("log", 1e-8, 10.0),
}


#: Trials drawn at random before the sampler learns from them, and candidates it weighs for each parameter.
STARTUP = 10
CANDIDATES = 24
#: A trial is first scored after this share of its rounds.
RUNG = 0.25
#: Rows beyond which the folds of a trial are fitted in tasks of their own.
APART = 100_000

Trial = tuple[int, float | None, float | None, bool, dict[str, float]]  # trial, score, rung score, pruned, params
TRIALS = "trial int, score double, rung_score double, pruned boolean, params map<string,double>"


def draw_params(rng: random.Random, space: Mapping[str, tuple] = SEARCH_SPACE) -> dict[str, float]:
    out: dict[str, float] = {}
    for name, (kind, low, high, *step) in space.items():
        if kind == "int":
            out[name] = low + step[0] * rng.randrange((high - low) // step[0] + 1)
        elif kind == "log":
            out[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            out[name] = rng.uniform(low, high)
    return out


def propose(rng: random.Random, done: Sequence[tuple[float, Mapping[str, float]]], space: Mapping[str, tuple] = SEARCH_SPACE) -> dict[str, float]:
    """Parameters that look more like those of good finished trials (score, params) than like those of the others.

    For each parameter the values of the best quarter and of the rest give a density each: a kernel on
    every value and a flat share over the range.  Of ``CANDIDATES`` draws from the first density the
    one with the highest ratio of the two is taken.
    """
    drawn = draw_params(rng, space)
    if len(done) < STARTUP:
        return drawn
    ranked = sorted(done, key=lambda t: -t[0])
    cut = max(2, math.ceil(len(ranked) / 4))
    out: dict[str, float] = {}
    for name, (kind, low, high, *step) in space.items():
        def place(v: float) -> float:
            return (math.log(v) - math.log(low)) / (math.log(high) - math.log(low)) if kind == "log" else (v - low) / ((high - low) or 1)

        good, rest = ([place(p[name]) for _, p in part] for part in (ranked[:cut], ranked[cut:]))

        def density(at: Sequence[float], x: float) -> float:
            width = max(0.05, 0.5 * max(len(at), 1) ** -0.4)
            return (1 + sum(math.exp(-0.5 * ((x - c) / width) ** 2) / (width * 2.5066) for c in at)) / (len(at) + 1)

        def draw() -> float:
            if rng.random() < 1 / (len(good) + 1):
                return rng.random()
            return min(1.0, max(0.0, rng.gauss(rng.choice(good), max(0.05, 0.5 * len(good) ** -0.4))))

        x = max((draw() for _ in range(CANDIDATES)), key=lambda v: density(good, v) / density(rest, v))
        if kind == "int":
            out[name] = low + step[0] * round(x * (high - low) / step[0])
        else:
            value = math.exp(math.log(low) + x * (math.log(high) - math.log(low))) if kind == "log" else low + x * (high - low)
            out[name] = min(high, max(low, value))
    return out


def search(
    xy: DataFrame,
    n_trials: int = 50,
    timeout: float | None = None,
    k: int = 5,
    features: Sequence[str] = tuple(FEATURES),
    seed: int = 42,
    space: Mapping[str, tuple] = SEARCH_SPACE,
    parallelism: int = 8,
    runs: str | None = None,
) -> DataFrame:
    """Seeded search for the best mean PR-AUC over forward folds, guided by the trials before.

    One row per trial: ``trial, score, rung_score, pruned, params, stopped_early``.  Trials come in
    generations of ``parallelism``; each learns from all generations before it, so the same seed
    gives the same trials.  Every trial is scored after a quarter of its rounds; one that is then below
    the median of the others before it is pruned and keeps that score.  All ``n_trials`` run unless a
    ``timeout`` in seconds is given: then none starts after it (the first always runs), and
    ``stopped_early`` tells of it.  With a folder ``runs`` finished generations are written
    there, and a search that starts again with the same arguments goes on after them.
    """
    started = time.monotonic()
    spark = xy.sparkSession
    folds = make_folds(xy, k)
    usable, edges = usable_folds(folds, k), quantile_edges(folds, features)
    done: list[Trial] = stored_trials(spark, runs) if runs else []
    early = False

    def areas(tables: Mapping[int, DataFrame], rounds: Mapping[int, int]) -> dict[int, float | None]:
        """Mean PR-AUC of each trial after its ``rounds``; all trials and folds are measured in one pass."""
        found: dict[int, list[float]] = {t: [] for t in tables}
        own = [s.where(F.col("rounds") == rounds[t]).select((F.col("grp") + t * k).alias("grp"), "label", "score") for t, s in tables.items()]
        for r in auc_by(reduce(DataFrame.unionByName, own), "grp").collect() if own else []:
            if r["pr_auc"] is not None:
                found[r["grp"] // k].append(r["pr_auc"])
        return {t: sum(x) / len(x) if x else None for t, x in found.items()}

    # Where rows are many but fit in a task, each fold of a trial is a task of its own.
    n = folds.count()
    packed = packed_rows(folds, features, key_of(folds), "val_fold", edges)[0] if usable and APART < n <= ROWS_PER_TASK else None

    def fitted(marks: Mapping[int, Sequence[int]], params: Mapping[int, Mapping[str, float]]) -> dict[int, DataFrame]:
        """Scores of the held-out rows of all folds after the ``marks`` of each trial, written: the trees of a generation are too many for the driver."""
        own = {t: TreeParams.of(dict(params[t]) | {"n_estimators": max(m)}) for t, m in marks.items()}

        def whole(t: int) -> DataFrame:
            specs = [Spec(own[t], seed, f) for f in usable]
            return write_table(fit_scores(folds, features, specs, key_of(folds), "val_fold", edges, marks[t]), "trial")

        def alone(task: tuple[int, int]) -> DataFrame:
            t, at = task
            scores = fit_packed(packed, Spec(own[t], seed, usable[at]), edges, marks[t])
            return write_table(scores.withColumn("grp", F.lit(at)), "trial")

        if packed is None:
            return dict(zip(marks, pool.map(whole, marks)))
        # The longest begin first, so that none is left over at the end.
        tasks = sorted(((t, at) for t in marks for at in range(len(usable))), key=lambda x: -own[x[0]].n_estimators * (1 + own[x[0]].max_depth) * usable[x[1]])
        parts = dict(zip(tasks, pool.map(alone, tasks)))
        return {t: reduce(DataFrame.unionByName, [parts[t, at] for at in range(len(usable))]) for t in marks}

    with ThreadPoolExecutor(parallelism * (len(usable) if packed is not None else 1)) as pool:
        while len(done) < n_trials and not early:
            first = len(done)
            known = [(s, p) for _, s, _, _, p in done if s is not None]
            params: dict[int, dict[str, float]] = {}
            for trial in range(first, min(first + parallelism, n_trials)):
                if trial and timeout is not None and time.monotonic() - started > timeout:
                    early = True
                    break
                params[trial] = propose(random.Random(f"{seed}-{trial}"), known, space)
            whole = {t: TreeParams.of(p).n_estimators for t, p in params.items()}
            rungs = {t: max(1, round(n * RUNG)) for t, n in whole.items()}
            # The median of what the others had after their quarter; nothing is pruned before there are enough.
            before = sorted(s for _, _, s, _, _ in done if s is not None)
            bar = before[len(before) // 2] if len(before) >= STARTUP else None
            if bar is not None:
                short = fitted({t: [rungs[t]] for t in params}, params)
                rung = areas(short, rungs)
                go_on = [t for t in params if rung[t] is None or rung[t] >= bar]
            else:
                rung, go_on = {}, list(params)
            full = fitted({t: [*([rungs[t]] if bar is None else []), whole[t]] for t in go_on}, params)
            if bar is None:
                rung = areas(full, rungs)
            scores = areas(full, whole)
            new = [(t, scores.get(t, rung[t]), rung[t], t not in full, {n: float(v) for n, v in p.items()}) for t, p in params.items()]
            if runs and new:
                spark.createDataFrame(new, TRIALS).coalesce(1).write.parquet(f"{runs}/from-{first:06d}")
            done += new
    return spark.createDataFrame(done, TRIALS).withColumn("stopped_early", F.lit(early))


def stored_trials(spark: SparkSession, runs: str) -> list[Trial]:
    """Trials of the generations that were written whole, up to the first that is missing."""
    try:
        rows = spark.read.schema(TRIALS).parquet(f"{runs}/from-*").orderBy("trial").collect()
    except AnalysisException:
        return []
    return [(r["trial"], r["score"], r["rung_score"], r["pruned"], dict(r["params"])) for i, r in enumerate(rows) if r["trial"] == i]


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the highest score (ties: the first), as one row."""
    best = F.max_by(F.struct("trial", "score", "params"), F.struct(F.col("score"), -F.col("trial")))
    return trials.agg(best.alias("b")).select("b.*")
