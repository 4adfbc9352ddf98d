"""Registered queries: preparation, models, cross-validation and evaluation.

Models are fitted as the operators do by default (300 trees of depth 4, five folds, the full
search space).  Scores are the learner's own, so these queries return what must hold for them
whatever the learner: which rows are scored, sizes, bounds and identities, which SQL can state.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.ml import cv, models, prep, smote
from ebbline.operators import evaluation as ev
from ebbline.plans import oracle as O
from ebbline.plans.registry import query, r, rounded
from ebbline.plans.tables import scored, split_xy
from ebbline.plans.testviews import SNAPSHOTS
from ebbline.schema import FEATURES

N_TRIALS = 50

_TRAIN = O.feature_ctes("txn", SNAPSHOTS["train"], p="a_")
_VAL = O.feature_ctes("txn", SNAPSHOTS["val"], p="b_")


def _fit_sql(body: str) -> str:
    return O.with_views(body, "txn", ctes=f"{_TRAIN},\n{_VAL}")


@query(
    "ml_impute",
    _fit_sql(
        "SELECT customer_id, "
        + ", ".join(r(f"coalesce(v.{f}, m_{f})", f, O.FEATURE_DIGITS.get(f, 4)) for f in FEATURES)
        + " FROM b_features v, (SELECT "
        + ", ".join(f"quantile_cont({f}, 0.5) AS m_{f}" for f in FEATURES)
        + " FROM a_features)"
    ),
)
def ml_impute(spark: SparkSession, sf: str) -> DataFrame:
    """Medians of train, applied to val."""
    medians = prep.fit_medians(split_xy(spark, sf, "train"), FEATURES)
    val = split_xy(spark, sf, "val").select("customer_id", *FEATURES)
    return rounded(prep.impute(val, medians), O.FEATURE_DIGITS)


@query(
    "ml_scale",
    _fit_sql(
        "SELECT customer_id, "
        + ", ".join(r(f"(v.{f} - m_{f}) / CASE WHEN s_{f} = 0 OR s_{f} IS NULL THEN 1 ELSE s_{f} END", f) for f in FEATURES)
        + " FROM b_features v, (SELECT "
        + ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in FEATURES)
        + " FROM a_features)"
    ),
)
def ml_scale(spark: SparkSession, sf: str) -> DataFrame:
    scaling = prep.fit_scaling(split_xy(spark, sf, "train"), FEATURES)
    return rounded(prep.scale(split_xy(spark, sf, "val").select("customer_id", *FEATURES), scaling))


@query(
    "ml_classweight",
    O.with_views(
        f"""SELECT count(*) FILTER (WHERE churn = 0) AS negatives, count(*) FILTER (WHERE churn = 1) AS positives,
  {r('count(*) FILTER (WHERE churn = 0) / count(*) FILTER (WHERE churn = 1)', 'positive_weight', 6)} FROM labels0""",
        "txn", ctes=O.label_cte("txn", SNAPSHOTS["train"]),
    ),
)
def ml_classweight(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(prep.class_weight(split_xy(spark, sf, "train")), {"positive_weight": 6})


_SCALED = f"""filled AS (SELECT customer_id, churn, {", ".join(
    f"coalesce(CAST({f} AS DOUBLE), (SELECT coalesce(quantile_cont({f}, 0.5), 0) FROM a_features)) AS {f}" for f in FEATURES
)} FROM a_features JOIN a_labels0 USING (customer_id)),
stats AS (SELECT {", ".join(f"avg({f}) AS m_{f}, coalesce(nullif(stddev_pop({f}), 0), 1) AS s_{f}" for f in FEATURES)} FROM filled),
scaled AS (SELECT customer_id, churn, {", ".join(f"({f} - m_{f}) / s_{f} AS {f}" for f in FEATURES)} FROM filled, stats),
minority AS (SELECT * FROM scaled WHERE churn =
  (SELECT CASE WHEN 2 * sum(churn) <= count(*) THEN 1 ELSE 0 END FROM scaled))"""


def _scaled_sql(body: str) -> str:
    return O.with_views(body, "txn", ctes=f"{_TRAIN},\n{O.label_cte('txn', SNAPSHOTS['train'], p='a_')},\n{_SCALED}")


def scaled_train(spark: SparkSession, sf: str) -> DataFrame:
    """Imputed and scaled train rows."""
    train = split_xy(spark, sf, "train")
    filled = prep.impute(train, prep.fit_medians(train, FEATURES))
    return prep.scale(filled, prep.fit_scaling(filled, FEATURES))


@query(
    "ml_smote",
    _scaled_sql(
        """SELECT CAST(churn AS INTEGER) AS label, count(*) AS n_real,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM scaled GROUP BY churn)) AS n_rows FROM scaled GROUP BY churn"""
    ),
)
def ml_smote(spark: SparkSession, sf: str) -> DataFrame:
    """Train rows brought to class parity: real and all rows of each class."""
    rows = smote.oversample(scaled_train(spark, sf), FEATURES)
    return rows.groupBy("label").agg(F.count_if(~F.col(smote.SYNTHETIC)).alias("n_real"), F.count(F.lit(1)).alias("n_rows"))


@query(
    "ml_smote_near",
    _scaled_sql(
        f"""SELECT customer_id, CAST(rank AS INTEGER) AS rank, {r('distance')} FROM (
  SELECT a.customer_id, sqrt({" + ".join(f"(a.{f} - b.{f}) ** 2" for f in FEATURES)}) AS distance,
    row_number() OVER (PARTITION BY a.customer_id ORDER BY {" + ".join(f"(a.{f} - b.{f}) ** 2" for f in FEATURES)}) AS rank
  FROM minority a JOIN minority b ON a.customer_id <> b.customer_id) WHERE rank <= 5"""
    ),
)
def ml_smote_near(spark: SparkSession, sf: str) -> DataFrame:
    """Distances of the five nearest rows of the smaller class, for each of its rows."""
    rows = scaled_train(spark, sf)
    counts = prep.class_counts(rows)
    minority = rows.where(F.col("label") == min(counts, key=lambda c: (counts[c], -c)))
    near = smote.nearest(minority, minority.select("customer_id"), FEATURES, "customer_id", 5)
    return rounded(near.select("customer_id", "rank", "distance"))


def baseline_model(spark: SparkSession, sf: str):
    return models.train_baseline(split_xy(spark, sf, "train"))


_TEST_ROWS = O.with_views(
    "SELECT customer_id, churn AS label, true AS in_range FROM labels0", "txn", ctes=O.label_cte("txn", SNAPSHOTS["test"])
)


def in_range(scored_rows: DataFrame) -> DataFrame:
    """Each scored row, and whether its score is a probability."""
    ok = F.col("churn_probability").isNotNull() & F.col("churn_probability").between(0, 1)
    return scored_rows.select("customer_id", "label", ok.alias("in_range"))


@query("ml_logreg", _TEST_ROWS)
def ml_logreg(spark: SparkSession, sf: str) -> DataFrame:
    return in_range(models.score_with(baseline_model(spark, sf), split_xy(spark, sf, "test")))


_FITTED_ROWS = _TEST_ROWS.replace("true AS in_range", "true AS in_range, true AS learned, true AS ranks")


def learned(model, train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows of test in range, and what no constant score and no untrained model has.

    ``learned``: the weighted log-loss on the training rows is below ln 2, that of scores of one half.
    ``ranks``: positives of the training rows score above negatives more often than not.
    """
    own = models.score_with(model, prep.with_class_weight(train), "score")
    p = F.when(F.col("label") == 1, F.col("score")).otherwise(1 - F.col("score"))
    loss = own.agg((F.sum(-F.ln(p) * F.col("weight")) / F.sum("weight")).alias("loss")).first()["loss"]
    area = ev.auc_metrics(own.select("label", "score")).first()["roc_auc"]
    return in_range(models.score_with(model, test)).withColumns({"learned": F.lit(loss < math.log(2) - 0.01), "ranks": F.lit(area > 0.55)})


@query("ml_gbt", _FITTED_ROWS)
def ml_gbt(spark: SparkSession, sf: str) -> DataFrame:
    train = split_xy(spark, sf, "train")
    return learned(models.train_trees(train), train, split_xy(spark, sf, "test"))


@query("ml_gbt_params", _FITTED_ROWS)
def ml_gbt_params(spark: SparkSession, sf: str) -> DataFrame:
    """Refit on train and val with given parameters."""
    params = {"subsample": 0.8, "colsample_bytree": 0.7, "min_child_weight": 3, "gamma": 0.5, "reg_alpha": 0.1, "reg_lambda": 2.0}
    train = split_xy(spark, sf, "train", "val")
    return learned(models.train_trees(train, params=params), train, split_xy(spark, sf, "test"))


@query("ml_predict", _TEST_ROWS.replace("churn AS label, true AS in_range", "true AS same"))
def ml_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Save, reload, and score the test split through the column contract: the scores are those of the saved model."""
    import uuid

    from ebbline.session import work_dir

    train = split_xy(spark, sf, "train")
    path = f"{work_dir(spark)}/predictor-{uuid.uuid4().hex}"
    own = models.ChurnPredictor.of(models.train_trees(train), train)
    own.save(path)
    test = split_xy(spark, sf, "test").drop("label")
    loaded = models.ChurnPredictor.load(spark, path).predict(test)
    before = own.predict(test).select("customer_id", F.col("churn_probability").alias("p"))
    return loaded.join(before, "customer_id").select("customer_id", (F.col("churn_probability") == F.col("p")).alias("same"))


@query(
    "ml_cv",
    O.with_views(
        """SELECT model, CAST(fold AS INTEGER) AS fold, n - 5 * (n // 6) + (fold - 1) * (n // 6) AS n_train, n // 6 AS n_val, true AS in_range
FROM (SELECT count(*) AS n FROM labels0), range(1, 6) AS f(fold), (VALUES ('baseline'), ('trees')) AS m(model)""",
        "txn", ctes=O.label_cte("txn", SNAPSHOTS["train"]),
    ),
)
def ml_cv(spark: SparkSession, sf: str) -> DataFrame:
    folds = cv.run_time_cv(split_xy(spark, sf, "train"), parallelism=5)
    ok = F.coalesce(F.col("roc_auc").between(0, 1) & F.col("pr_auc").between(0, 1), F.lit(False))
    return folds.select("model", "fold", "n_train", "n_val", ok.alias("in_range"))


# Stand-in fold metrics that both engines can compute: statistics of orders per
# priority ("model") and year ("fold").
_FOLD_SQL = """fm AS (SELECT o_orderpriority AS model, year(o_orderdate) - 1994 AS fold,
  avg(o_totalprice) / 1000000 AS roc_auc, min(o_totalprice) / 1000 AS pr_auc FROM orders GROUP BY 1, 2),
long AS (SELECT model, 'roc_auc' AS metric, fold, roc_auc AS value FROM fm UNION ALL SELECT model, 'pr_auc', fold, pr_auc FROM fm),
summary AS (SELECT model, metric, avg(value) AS cv_mean, stddev_pop(value) AS cv_std FROM long GROUP BY 1, 2)"""


def _fold_stand_in(spark: SparkSession, sf: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return orders.groupBy(
        F.col("o_orderpriority").alias("model"), (F.year("o_orderdate") - 1994).alias("fold")
    ).agg((F.avg("o_totalprice") / 1000000).alias("roc_auc"), (F.min("o_totalprice") / 1000).alias("pr_auc"))


@query(
    "ml_cv_summary",
    f"WITH {_FOLD_SQL} SELECT model, metric, {r('cv_mean', digits=6)}, {r('cv_std', digits=6)} FROM summary",
)
def ml_cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The mean and deviation step of cross-validation."""
    return rounded(cv.cv_summary(_fold_stand_in(spark, sf)), default=6)


@query(
    "ml_cvreport",
    f"""WITH {_FOLD_SQL} SELECT s.model, s.metric, {r('l.value', 'single_split', 6)}, {r('cv_mean', digits=6)},
  {r('cv_std', digits=6)}, {r('l.value - cv_mean', 'delta', 6)}
FROM summary s LEFT JOIN (SELECT * FROM long WHERE fold = 1 AND metric = 'roc_auc') l
  ON s.model = l.model AND s.metric = l.metric""",
)
def ml_cvreport(spark: SparkSession, sf: str) -> DataFrame:
    folds = _fold_stand_in(spark, sf)
    single = folds.where("fold = 1").select("model", F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    return rounded(cv.cv_report(cv.cv_summary(folds), single), default=6)


@query(
    "ml_search",
    f"SELECT CAST(trial AS INTEGER) AS trial, true AS in_range, true AS scored FROM range({N_TRIALS}) AS t(trial)",
)
def ml_search(spark: SparkSession, sf: str) -> DataFrame:
    """Trials of the full space over five folds: parameters inside their ranges, scores inside theirs."""
    trials = cv.search(split_xy(spark, sf, "train"), n_trials=N_TRIALS)
    inside = [F.col("params")[n].between(float(low), float(high)) for n, (_, low, high, *_) in cv.SEARCH_SPACE.items()]
    return trials.select("trial", reduce(lambda a, b: a & b, inside).alias("in_range"), F.col("score").between(0, 1).alias("scored"))


@query(
    "ml_search_best",
    f"""SELECT CAST(arg_max(o_orderkey, struct_pack(s := o_totalprice, t := -o_orderkey)) AS INTEGER) AS trial,
  {r('max(o_totalprice)', 'score')}, CAST(arg_max(o_custkey, struct_pack(s := o_totalprice, t := -o_orderkey)) AS DOUBLE) AS depth
FROM orders""",
)
def ml_search_best(spark: SparkSession, sf: str) -> DataFrame:
    """The step that picks the best trial, over orders as trials."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    trials = orders.select(
        F.col("o_orderkey").cast("int").alias("trial"),
        F.col("o_totalprice").alias("score"),
        F.create_map(F.lit("depth"), F.col("o_custkey").cast("double")).alias("params"),
    )
    best = cv.best_trial(trials)
    return best.select("trial", F.round(F.col("score") + F.lit(0.00000033), 4).alias("score"), F.col("params")["depth"].alias("depth"))


# --- evaluation --------------------------------------------------------------------

_CONF = """count(*) FILTER (WHERE score < 0.5 AND label = 0) AS tn, count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
  count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn, count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp"""


@query("ev_confusion", O.on_scored(f"SELECT {_CONF} FROM scored"))
def ev_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion(scored(spark, sf))


_PRF = [
    ("precision", "coalesce(tp / nullif(tp + fp, 0), 0)"),
    ("recall", "coalesce(tp / nullif(tp + fn, 0), 0)"),
    ("f1", "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)"),
]


@query(
    "ev_prf",
    O.on_scored(f"SELECT {', '.join(r(e, n, 6) for n, e in _PRF)} FROM (SELECT {_CONF} FROM scored)"),
)
def ev_prf(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.precision_recall_f1(scored(spark, sf)), default=6)


@query("ev_brier", O.on_scored(f"SELECT {r('avg((score - label) ** 2)', 'brier', 6)} FROM scored"))
def ev_brier(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.brier(scored(spark, sf)), default=6)


_AUC = """(SELECT sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END * p.k * n.k)
  / ((SELECT count(*) FROM scored WHERE label = 1) * (SELECT count(*) FROM scored WHERE label = 0))
  FROM (SELECT score, count(*) k FROM scored WHERE label = 1 GROUP BY 1) p,
       (SELECT score, count(*) k FROM scored WHERE label = 0 GROUP BY 1) n)"""
_CURVE = """curve AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos, neg,
    sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
        FROM scored GROUP BY 1) WINDOW w AS (ORDER BY score DESC))"""
_AP = "(SELECT sum(pos / p * tp / (tp + fp)) FROM curve)"


def _on_curve(body: str) -> str:
    return O.with_views(body, "txn", ctes=O.scored_ctes() + ",\n" + _CURVE)


@query("ev_rocauc", O.on_scored(f"SELECT {r(_AUC, 'roc_auc', 6)}"))
def ev_rocauc(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.roc_auc(scored(spark, sf)), default=6)


@query("ev_ap", _on_curve(f"SELECT {r(_AP, 'pr_auc', 6)}"))
def ev_ap(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.average_precision(scored(spark, sf)), default=6)


@query(
    "ev_roc",
    _on_curve(
        f"""SELECT {r('fp / n', 'fpr', 6)}, {r('tp / p', 'tpr', 6)}, {r('score', 'threshold', 6)} FROM curve
UNION ALL SELECT {r('0.0::DOUBLE', 'fpr', 6)}, {r('0.0::DOUBLE', 'tpr', 6)}, CAST('inf' AS DOUBLE)"""
    ),
)
def ev_roc(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.roc_points(scored(spark, sf)), default=6)


@query(
    "ev_roc_bends",
    O.with_views(
        f"""SELECT {r('fp / n', 'fpr', 6)}, {r('tp / p', 'tpr', 6)}, {r('score', 'threshold', 6)} FROM nexts
WHERE np IS NULL OR np <> pos OR nn <> neg
UNION ALL SELECT {r('0.0::DOUBLE', 'fpr', 6)}, {r('0.0::DOUBLE', 'tpr', 6)}, CAST('inf' AS DOUBLE)""",
        "txn",
        ctes=O.scored_ctes() + ",\n" + _CURVE + """,
nexts AS (SELECT *, lead(pos) OVER (ORDER BY score DESC) AS np, lead(neg) OVER (ORDER BY score DESC) AS nn FROM curve)""",
    ),
)
def ev_roc_bends(spark: SparkSession, sf: str) -> DataFrame:
    """The ROC curve without the points on straight lines."""
    return rounded(ev.roc_points(scored(spark, sf), drop_intermediate=True), default=6)


@query(
    "ev_pr",
    _on_curve(
        f"""SELECT {r('tp / (tp + fp)', 'precision', 6)}, {r('tp / p', 'recall', 6)}, {r('score', 'threshold', 6)},
  {r('p / (p + n)', 'prevalence', 6)} FROM curve
UNION ALL SELECT {r('1.0::DOUBLE', 'precision', 6)}, {r('0.0::DOUBLE', 'recall', 6)}, CAST(NULL AS DOUBLE),
  {r('avg(label)', 'prevalence', 6)} FROM scored"""
    ),
)
def ev_pr(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.pr_points(scored(spark, sf)), default=6)


@query(
    "ev_calib",
    O.on_scored(
        f"""SELECT CAST(bin AS INTEGER) AS bin, {r('avg(score)', 'mean_score', 6)}, {r('avg(label)', 'observed_rate', 6)},
  count(*) AS n_rows
FROM (SELECT score, label, len(list_filter(edges, lambda e: e < score)) AS bin FROM scored,
  (SELECT quantile_cont(score, [{', '.join(str(i / 10) for i in range(1, 10))}]) AS edges FROM scored)) GROUP BY bin"""
    ),
)
def ev_calib(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.calibration(scored(spark, sf)), default=6)


_RANKED = """ranked AS (SELECT customer_id, label, row_number() OVER (ORDER BY score DESC, customer_id) AS rk,
  count(*) OVER () AS n FROM scored)"""


def _lift(k: float) -> str:
    return f"(SELECT avg(label) FILTER (WHERE rk <= greatest(1, ceil(n * {k}::DOUBLE))) / avg(label) FROM ranked)"


def _on_ranked(body: str, more: str = "") -> str:
    return O.with_views(body, "txn", ctes=O.scored_ctes() + ",\n" + _RANKED + more)


@query("ev_lift", _on_ranked(f"SELECT {r(_lift(0.1), 'lift', 6)}"))
def ev_lift(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.lift_at_k(scored(spark, sf), 0.1), default=6)


@query(
    "ev_gains",
    _on_ranked(
        f"""SELECT CAST(d AS INTEGER) AS decile, {r('d * 10.0::DOUBLE', 'pct_customers')},
  {r('100.0 * sum(label) FILTER (WHERE rk <= cut) / sum(label)', 'pct_captured', 6)},
  {r('avg(label) FILTER (WHERE rk <= cut) / avg(label)', 'lift', 6)}
FROM (SELECT *, greatest(1, round_even(n * d / 10.0, 0)) AS cut FROM ranked, range(1, 11) t(d)) GROUP BY d"""
    ),
)
def ev_gains(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.gains(scored(spark, sf)), {"pct_customers": 4}, default=6)


@query(
    "ev_rar",
    O.on_scored(f"SELECT customer_id, {r('score')}, {r('score * coalesce(spend_90d, 0)', 'revenue_at_risk')} FROM scored"),
)
def ev_rar(spark: SparkSession, sf: str) -> DataFrame:
    rows = scored(spark, sf).select("customer_id", "score", "spend_90d")
    return rounded(ev.with_revenue_at_risk(rows, score="score").drop("spend_90d"))


def _all_sql(model: str, score_view: str) -> str:
    """Long metrics over a CTE set named like the scored one."""
    conf = f"(SELECT {_CONF} FROM {score_view})"
    rows = [(n, f"(SELECT CAST({n} AS DOUBLE) FROM {conf})") for n in ("tn", "fp", "fn", "tp")]
    rows += [(n, f"(SELECT {e} FROM {conf})") for n, e in _PRF]
    rows += [
        ("brier", f"(SELECT avg((score - label) ** 2) FROM {score_view})"),
        ("revenue_at_risk_total", f"(SELECT sum(score * coalesce(spend_90d, 0)) FROM {score_view})"),
        ("roc_auc", _AUC),
        ("pr_auc", _AP),
        ("lift_at_10pct", _lift(0.1)),
    ]
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, '{n}' AS metric, {r(e, 'value', 2 if n.startswith('rev') else 6)}" for n, e in rows
    )


def rounded_metrics(long: DataFrame) -> DataFrame:
    value = F.col("value") + F.lit(0.00000033)
    money = F.col("metric").startswith("revenue")
    return long.withColumn("value", F.when(money, F.round(value, 2)).otherwise(F.round(value, 6)))


@query("ev_all", _on_ranked(_all_sql("fixed", "scored"), ",\n" + _CURVE))
def ev_all(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_metrics(ev.evaluate(scored(spark, sf), "fixed"))


def two_models(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of the fixed score and of its square, as two models."""
    rows = scored(spark, sf)
    other = rows.withColumn("score", F.col("score") * F.col("score"))
    return ev.evaluate(rows, "default").unionByName(ev.evaluate(other, "tuned"))


_TWO = f"""conf AS (SELECT 'default' AS model, {_CONF} FROM scored
  UNION ALL SELECT 'tuned', {_CONF.replace('score', 'score * score')} FROM scored),
prf AS (SELECT model, {', '.join(f'{e} AS "{n}"' for n, e in _PRF)} FROM conf)"""


@query(
    "ev_compare",
    O.with_views(
        f"""SELECT model, {r(_AUC, 'roc_auc', 6)}, {r(_AP, 'pr_auc', 6)},
  {', '.join(r(f'"{n}"', n, 6) for n, _ in _PRF)} FROM prf""",
        "txn", ctes=O.scored_ctes() + ",\n" + _CURVE + ",\n" + _TWO,
    ),
)
def ev_compare(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.compare_models(two_models(spark, sf)), default=6)


@query(
    "ev_tradeoff",
    O.with_views(
        f"""SELECT {r('t."precision" - d."precision"', 'precision_delta', 6)}, {r('t.recall - d.recall', 'recall_delta', 6)},
  CASE WHEN t.recall - d.recall >= 0 THEN 'gains' ELSE 'loses' END AS recall_word,
  CASE WHEN t."precision" - d."precision" < 0 THEN 'gives up' ELSE 'keeps' END AS precision_word
FROM (SELECT * FROM prf WHERE model = 'tuned') t, (SELECT * FROM prf WHERE model = 'default') d""",
        "txn", ctes=O.scored_ctes() + ",\n" + _TWO,
    ),
)
def ev_tradeoff(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.tradeoff(two_models(spark, sf), "tuned", "default"), default=6)


@query(
    "ev_hist",
    O.on_scored(
        f"""SELECT bin, count(*) AS n_rows, {r('bin / 30.0', 'lower', 6)}, {r('(bin + 1) / 30.0', 'upper', 6)}
FROM (SELECT CAST(least(floor(score / (1.0::DOUBLE / 30)), 29) AS BIGINT) AS bin FROM scored) GROUP BY bin"""
    ),
)
def ev_hist(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.histogram(scored(spark, sf), "score", 30, 0.0, 1.0), default=6)
