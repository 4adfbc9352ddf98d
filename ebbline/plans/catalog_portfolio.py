"""Registered queries: portfolio tables, scoring, explanations and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.ml import models, trees
from ebbline.operators import explain, portfolio, report, validation
from ebbline.plans import oracle as O
from ebbline.plans.catalog_data import cleaned_ctes
from ebbline.plans.catalog_models import baseline_model
from ebbline.plans.registry import NUDGE, query, r, rounded
from ebbline.plans.scoring import score_held_out, score_population
from ebbline.plans.tables import scored, split_xy
from ebbline.plans.testviews import SNAPSHOTS, table, txn, txn_dirty
from ebbline.schema import FEATURES
from ebbline.session import work_dir
from ebbline.streaming.scoring import score_records, score_stream


def fixed_scorer(df: DataFrame) -> DataFrame:
    score = F.col("recency_days") / (F.col("recency_days") + F.lit(90.0))
    return df.withColumn("churn_probability", score)


# --- portfolio ---------------------------------------------------------------------


@query(
    "pf_score",
    O.with_views(
        f"SELECT customer_id, {O.feature_select(FEATURES)}, {r(O.SCORE, 'churn_probability')}, "
        f"{r(O.SCORE + ' * coalesce(spend_90d, 0)', 'revenue_at_risk')} FROM features",
        "txn_dirty", ctes=f"{cleaned_ctes()},\n{O.feature_ctes('cleaned', SNAPSHOTS['test'])}",
    ),
)
def pf_score(spark: SparkSession, sf: str) -> DataFrame:
    """Raw lines -> cleaning -> features -> score -> revenue at risk."""
    rows = score_population(txn_dirty(spark, sf), SNAPSHOTS["test"], fixed_scorer, SNAPSHOTS["train"])
    return rounded(rows.select("customer_id", *FEATURES, "churn_probability", "revenue_at_risk"), O.FEATURE_DIGITS)


@query(
    "pf_score_clean",
    O.with_views(
        "SELECT customer_id, true AS in_range FROM features", "txn_dirty",
        ctes=f"{cleaned_ctes()},\n{O.feature_ctes('cleaned', SNAPSHOTS['test'])}",
    ),
)
def pf_score_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the fitted baseline: who is scored, and whether risk is probability times spend."""
    model = baseline_model(spark, sf)
    rows = score_population(
        txn_dirty(spark, sf), SNAPSHOTS["test"], lambda m: models.score_with(model, m), SNAPSHOTS["train"]
    )
    p, spend = F.col("churn_probability"), F.coalesce("spend_90d", F.lit(0.0))
    ok = p.between(0, 1) & (F.abs(F.col("revenue_at_risk") - p * spend) <= 1e-9 * (1 + F.abs(spend)))
    return rows.select("customer_id", F.coalesce(ok, F.lit(False)).alias("in_range"))


@query(
    "pf_heldout",
    O.with_views(
        f"SELECT customer_id, churn AS label, {r(O.SCORE, 'score')}, {r('spend_90d')} FROM features JOIN labels0 USING (customer_id)",
        "txn", ctes=f"{O.feature_ctes('txn', SNAPSHOTS['test'])},\n{O.label_cte('txn', SNAPSHOTS['test'])}",
    ),
)
def pf_heldout(spark: SparkSession, sf: str) -> DataFrame:
    """The test split with labels and the fixed score."""
    return rounded(score_held_out(txn(spark, sf), SNAPSHOTS, fixed_scorer))


@query(
    "pf_kpi",
    O.on_scored(
        f"""SELECT count(*) AS total_customers, count(*) FILTER (WHERE score >= 0.5) AS high_risk_customers,
  {r('sum(revenue_at_risk)', 'total_revenue_at_risk', 2)},
  {r('avg(revenue_at_risk) FILTER (WHERE score >= 0.5)', 'avg_high_risk_revenue')} FROM scored"""
    ),
)
def pf_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(portfolio.kpis(scored(spark, sf)), {"total_revenue_at_risk": 2})


def _bands_sql(column: str) -> str:
    probabilities = "[" + ", ".join(str(i / 5) for i in range(6)) + "]"
    label = (
        "(CASE WHEN band_index = 0 THEN '[' ELSE '(' END) || format('{:.3f}', lower) || ', ' || format('{:.3f}', upper) || ']'"
    )
    return f"""SELECT band_index, {r('lower', 'lower')}, {r('upper', 'upper')}, {label} AS label, n_customers,
  {r('mean_churn_probability', digits=6)}, {r('revenue_at_risk', digits=2)}
FROM (SELECT CAST(b AS INTEGER) AS band_index, edges[b + 1] AS lower, edges[b + 2] AS upper, count(*) AS n_customers,
    avg(score) AS mean_churn_probability, sum(revenue_at_risk) AS revenue_at_risk
  FROM (SELECT score, revenue_at_risk, edges,
      len(list_filter(edges[2:len(edges) - 1], lambda e: e < CAST({column} AS DOUBLE))) AS b
    FROM scored, (SELECT list_sort(list_distinct(quantile_cont(CAST({column} AS DOUBLE), {probabilities}))) AS edges
      FROM scored) WHERE {column} IS NOT NULL) GROUP BY b, edges)"""


def _register_bands(column: str) -> None:
    name = "pf_bands" if column == "spend_90d" else f"pf_bands_{column}"

    @query(name, O.on_scored(_bands_sql(column)))
    def bands(spark: SparkSession, sf: str) -> DataFrame:
        summary = portfolio.risk_bands(scored(spark, sf), column)
        return rounded(summary, {"mean_churn_probability": 6, "revenue_at_risk": 2})


for _column in portfolio.BAND_COLUMNS:
    _register_bands(_column)


@query(
    "pf_bands_segment",
    O.on_scored(
        f"""SELECT c_mktsegment AS label, count(*) AS n_customers, {r('avg(score)', 'mean_churn_probability', 6)},
  {r('sum(revenue_at_risk)', 'revenue_at_risk', 2)} FROM scored JOIN customer ON customer_id = c_custkey GROUP BY 1"""
    ),
)
def pf_bands_segment(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), "c_mktsegment")
    summary = portfolio.risk_bands(scored(spark, sf).join(customer, "customer_id"), "c_mktsegment")
    return rounded(summary, {"mean_churn_probability": 6, "revenue_at_risk": 2})


_CUM = """cum AS (SELECT customer_id, revenue_at_risk, row_number() OVER w AS rk,
  sum(revenue_at_risk) OVER (ORDER BY revenue_at_risk DESC, customer_id ROWS UNBOUNDED PRECEDING) AS cumulative,
  count(*) OVER () AS n, sum(revenue_at_risk) OVER () AS total
  FROM scored WINDOW w AS (ORDER BY revenue_at_risk DESC, customer_id))"""


def _on_cum(body: str) -> str:
    return O.with_views(body, "txn", ctes=O.scored_ctes() + ",\n" + _CUM)


@query(
    "pf_cumrisk",
    _on_cum(
        f"""SELECT customer_id, {r('revenue_at_risk', digits=2)}, rk AS rank, {r('cumulative', digits=1)},
  n AS n_total, {r('total', 'risk_total', 1)} FROM cum"""
    ),
)
def pf_cumrisk(spark: SparkSession, sf: str) -> DataFrame:
    digits = {"revenue_at_risk": 2, "cumulative": 1, "risk_total": 1}
    return rounded(portfolio.cumulative_risk(scored(spark, sf)), digits)


@query(
    "pf_pareto",
    _on_cum(
        f"""SELECT customers, n_total, {r('customers / n_total * 100.0', 'pct_customers', 6)}
FROM (SELECT coalesce(min(rk) FILTER (WHERE cumulative / total >= 0.8), max(rk)) AS customers, max(rk) AS n_total FROM cum)"""
    ),
)
def pf_pareto(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(portfolio.pareto_point(scored(spark, sf)), {"pct_customers": 6})


@query(
    "pf_pareto_curve",
    _on_cum(
        f"""SELECT customer_id, rk AS rank, {r('100.0 * rk / n', 'pct_customers', 6)},
  {r('cumulative / total', 'share', 6)} FROM cum"""
    ),
)
def pf_pareto_curve(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(portfolio.pareto_curve(scored(spark, sf)), default=6)


_TRIAGE = f"customer_id, {r('churn_probability')}, {r('spend_90d')}, {r('revenue_at_risk')}"


def triage(df: DataFrame) -> DataFrame:
    return rounded(df.select(*portfolio.DEFAULT_COLUMNS))


@query("pf_highrisk", O.on_scored(f"SELECT {_TRIAGE} FROM scored WHERE score >= 0.66"))
def pf_highrisk(spark: SparkSession, sf: str) -> DataFrame:
    return triage(portfolio.high_risk(scored(spark, sf), 0.66))


@query("pf_search", O.on_scored(f"SELECT {_TRIAGE} FROM scored WHERE lower(CAST(customer_id AS VARCHAR)) LIKE '%14%'"))
def pf_search(spark: SparkSession, sf: str) -> DataFrame:
    return triage(portfolio.search(scored(spark, sf), "14"))


@query(
    "pf_search_regex",
    O.on_scored(f"SELECT {_TRIAGE} FROM scored WHERE regexp_matches(CAST(customer_id AS VARCHAR), '^1.*7$')"),
)
def pf_search_regex(spark: SparkSession, sf: str) -> DataFrame:
    return triage(portfolio.search(scored(spark, sf), "^1.*7$", regex=True))


@query("pf_range", O.on_scored(f"SELECT {_TRIAGE} FROM scored WHERE revenue_at_risk BETWEEN 1000 AND 100000"))
def pf_range(spark: SparkSession, sf: str) -> DataFrame:
    return triage(portfolio.in_range(scored(spark, sf), 1000.0, 100000.0))


@query(
    "pf_range_bounds",
    O.on_scored(f"SELECT {r('min(revenue_at_risk)', 'min_risk')}, {r('max(revenue_at_risk)', 'max_risk')} FROM scored"),
)
def pf_range_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(portfolio.risk_bounds(scored(spark, sf)))


@query(
    "pf_topn",
    O.on_scored(
        f"SELECT {_TRIAGE} FROM (SELECT * FROM scored ORDER BY revenue_at_risk DESC, customer_id LIMIT 250)"
    ),
)
def pf_topn(spark: SparkSession, sf: str) -> DataFrame:
    return triage(portfolio.top_n(scored(spark, sf), 250))


@query(
    "pf_filtertotal",
    O.on_scored(
        f"""SELECT {r('coalesce(sum(revenue_at_risk) FILTER (WHERE score >= 0.2), 0)', 'filtered', 2)},
  {r('coalesce(sum(revenue_at_risk), 0)', 'everything', 2)} FROM scored"""
    ),
)
def pf_filtertotal(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(portfolio.filtered_total(scored(spark, sf), F.col("churn_probability") >= 0.2), default=2)


@query(
    "pf_risklevel",
    O.on_scored(
        f"""SELECT customer_id, {r('churn_probability')},
  CASE WHEN score >= 0.66 THEN 'high' WHEN score >= 0.33 THEN 'medium' ELSE 'low' END AS risk_level FROM scored"""
    ),
)
def pf_risklevel(spark: SparkSession, sf: str) -> DataFrame:
    rows = portfolio.with_risk_level(scored(spark, sf))
    return rounded(rows.select("customer_id", "churn_probability", "risk_level"))


# --- validated scoring ---------------------------------------------------------------


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """Feature records with faults: nulls, negatives, by customer id."""
    rows = scored(spark, sf).select("customer_id", *FEATURES)
    c = F.col("customer_id")
    return rows.withColumns(
        {
            "frequency": F.when(c % 101 == 0, -F.col("frequency")).otherwise(F.col("frequency")),
            "monetary": F.when(c % 103 != 0, F.col("monetary")),
            "avg_order_value": F.when(c % 103 == 0, F.lit(-1.0)).otherwise(F.col("avg_order_value")),
        }
    )


_RAW = f"""raw AS (SELECT customer_id, {', '.join(
    {'frequency': 'CASE WHEN customer_id % 101 = 0 THEN -frequency ELSE frequency END AS frequency',
     'monetary': 'CASE WHEN customer_id % 103 <> 0 THEN monetary END AS monetary',
     'avg_order_value': 'CASE WHEN customer_id % 103 = 0 THEN -1 ELSE avg_order_value END AS avg_order_value'}.get(f, f)
    for f in FEATURES)}, churn_probability FROM scored)"""


def _errors_sql(strict: bool) -> str:
    may_be_null = set(validation.nullable_features(strict))
    checks = []
    for f in FEATURES:
        if f not in may_be_null:
            checks.append(f"CASE WHEN {f} IS NULL THEN '{f}: required' END")
        if f not in ("spend_slope", "txn_count_slope"):
            checks.append(f"CASE WHEN {f} < 0 THEN '{f}: negative' END")
    return f"concat_ws('; ', {', '.join(checks)})"


def _register_validation(strict: bool) -> None:
    @query(
        "pf_validate_strict" if strict else "pf_validate",
        O.with_views(
            f"SELECT customer_id, {_errors_sql(strict)} AS errors FROM raw", "txn", ctes=O.scored_ctes() + ",\n" + _RAW
        ),
    )
    def validate(spark: SparkSession, sf: str) -> DataFrame:
        checked = validation.validate_records(raw_records(spark, sf), strict)
        return checked.select("customer_id", F.array_join("errors", "; ").alias("errors"))


_register_validation(False)
_register_validation(True)

_BATCHES = f"""batches AS (SELECT *, customer_id // 20 AS batch_id, {_errors_sql(False)} AS errors FROM raw),
verdict AS (SELECT batch_id, bool_and(errors = '') AND count(*) <= 500 AS ok FROM batches GROUP BY 1)"""


def batched_records(spark: SparkSession, sf: str) -> DataFrame:
    return raw_records(spark, sf).withColumn("batch_id", F.floor(F.col("customer_id") / 20).cast("bigint"))


_SCORED_BATCHES = O.with_views(
    f"SELECT batch_id, customer_id, {r('churn_probability')} FROM batches JOIN verdict USING (batch_id) WHERE ok",
    "txn", ctes=O.scored_ctes() + ",\n" + _RAW + ",\n" + _BATCHES,
)


@query("pf_batchscore", _SCORED_BATCHES)
def pf_batchscore(spark: SparkSession, sf: str) -> DataFrame:
    """All-or-nothing batches with a fixed scorer."""
    good, _ = score_records(
        batched_records(spark, sf), fixed_scorer, keys=("batch_id", "customer_id"), batch="batch_id"
    )
    return rounded(good)


@query(
    "pf_batchscore_refused",
    O.with_views(
        "SELECT batch_id, customer_id, errors FROM batches JOIN verdict USING (batch_id) WHERE NOT ok",
        "txn", ctes=O.scored_ctes() + ",\n" + _RAW + ",\n" + _BATCHES,
    ),
)
def pf_batchscore_refused(spark: SparkSession, sf: str) -> DataFrame:
    _, refused = score_records(
        batched_records(spark, sf), fixed_scorer, keys=("batch_id", "customer_id"), batch="batch_id"
    )
    return refused.withColumn("errors", F.array_join("errors", "; "))


#: Files that arrive in the stream, at any size: each micro-batch costs seconds of its own, so files grow with the records, not their number.
ARRIVALS = 8


def write_arrivals(records: DataFrame, path: str) -> None:
    """The records in ``ARRIVALS`` files, so that a request batch lies across several."""
    # By number, not by AQE's choice: that would merge the small files of a small table.
    records.repartition(ARRIVALS, "customer_id").write.parquet(path)


@query("pf_batchscore_stream", _SCORED_BATCHES)
def pf_batchscore_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same through Structured Streaming, two files per micro-batch: request batches lie across files and are held until they are whole."""
    base = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"
    records = batched_records(spark, sf)
    sizes = records.groupBy("batch_id").agg(F.count(F.lit(1)).cast("int").alias("batch_size"))
    records = records.join(sizes, "batch_id")
    write_arrivals(records, f"{base}/in")
    stream = score_stream(
        spark, f"{base}/in", records.schema, fixed_scorer, f"{base}/out", f"{base}/refused", f"{base}/checkpoint",
        keys=("batch_id", "customer_id"), batch="batch_id", files_per_trigger=2, declared="batch_size",
    )
    stream.awaitTermination()
    return rounded(spark.read.parquet(f"{base}/out").drop("epoch"))


@query(
    "pf_batchscore_model",
    O.with_views(
        f"SELECT customer_id, true AS in_range FROM raw WHERE {_errors_sql(False)} = ''", "txn",
        ctes=O.scored_ctes() + ",\n" + _RAW,
    ),
)
def pf_batchscore_model(spark: SparkSession, sf: str) -> DataFrame:
    """Validated records scored by the fitted baseline: which are scored."""
    model = baseline_model(spark, sf)
    good, _ = score_records(raw_records(spark, sf), lambda m: models.score_with(model, m))
    return good.select("customer_id", F.col("churn_probability").between(0, 1).alias("in_range"))


# --- explanations -------------------------------------------------------------------

# A fixed linear model over all features, so that SQL can follow: larger steps for counts and days than for amounts.
COEFFICIENTS = {
    f: (i + 1) * (-1) ** i * (1e-7 if f.startswith(("spend", "avg", "monetary", "total")) else 1e-3)
    for i, f in enumerate(FEATURES)
}
INTERCEPT = 0.3


_ADDITIVE = O.with_views(
    "SELECT customer_id, true AS additive FROM labels0", "txn", ctes=O.label_cte("txn", SNAPSHOTS["test"])
)


def additive(rows: DataFrame) -> DataFrame:
    """Whether base value and contributions of all features add up to the log-odds of the probability."""
    total = F.aggregate("contributions", F.col("base_value"), lambda acc, c: acc + c["contribution"])
    odds = F.ln(F.col("churn_probability") / (1 - F.col("churn_probability")))
    ok = (F.abs(total - odds) < 1e-6) & (F.size("contributions") == len(FEATURES))
    return rows.select("customer_id", F.coalesce(ok, F.lit(False)).alias("additive"))


def said(rows: DataFrame) -> DataFrame:
    """Values rounded and moved off halves before they are put into words: engines sum and round in their own order."""
    return rows.withColumn(
        "contributions",
        F.transform("contributions", lambda c: c.withField("value", F.round(c["value"] + F.lit(float(NUDGE)), 4) * F.lit(1 + 1e-9))),
    )


def explained(spark: SparkSession, sf: str) -> DataFrame:
    rows = scored(spark, sf)
    return explain.LinearExplainer.fit(rows, COEFFICIENTS, INTERCEPT).transform(rows)


_MEANS = "means AS (SELECT " + ", ".join(f"avg({f}) AS m_{f}" for f in COEFFICIENTS) + " FROM scored)"
_BASE = f"{INTERCEPT}::DOUBLE + " + " + ".join(f"{c:.7f}::DOUBLE * m_{f}" for f, c in COEFFICIENTS.items())
_ATTR = _MEANS + ",\nattr AS (" + " UNION ALL ".join(
    f"SELECT customer_id, score, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, "
    f"coalesce({c:.7f}::DOUBLE * ({f} - m_{f}), 0) AS contribution FROM scored, means"
    for f, c in COEFFICIENTS.items()
) + ")"
_RANKED_ATTR = """ranked_attr AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution) DESC, feature) AS rk
  FROM attr)"""


def _on_attr(body: str, more: str = "") -> str:
    return O.with_views(body, "txn", ctes=O.scored_ctes() + ",\n" + _ATTR + ",\n" + _RANKED_ATTR + more)


@query("ex_attr", _on_attr(f"SELECT customer_id, feature, {r('value')}, {r('contribution', digits=6)} FROM attr"))
def ex_attr(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(explain.to_long(explained(spark, sf)), {"contribution": 6})


@query("ex_attr_baseline", _ADDITIVE)
def ex_attr_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted baseline explained: base and contributions add up to the log-odds of its score."""
    model = baseline_model(spark, sf)
    rows = models.score_with(model, split_xy(spark, sf, "test"))
    return additive(explain.explain_pipeline(model, rows, FEATURES))


@query("ex_attr_trees", _ADDITIVE)
def ex_attr_trees(spark: SparkSession, sf: str) -> DataFrame:
    model = models.train_trees(split_xy(spark, sf, "train"))
    rows = models.score_with(model, split_xy(spark, sf, "test"))
    return additive(trees.explain_trees(model, rows, FEATURES))


# What a linear model itself says of a feature: the size of its coefficient.
_NATIVE = {f: abs(c) for f, c in COEFFICIENTS.items()}


@query(
    "ex_importance",
    _on_attr(
        f"""SELECT feature, CASE feature {' '.join(f"WHEN '{f}' THEN {v:.7f}::DOUBLE" for f, v in _NATIVE.items())} END AS native_importance,
  {r('avg(abs(contribution))', 'mean_abs_contribution', 6)} FROM attr GROUP BY feature"""
    ),
)
def ex_importance(spark: SparkSession, sf: str) -> DataFrame:
    importance = explain.importance_table(explained(spark, sf), {f: float(f"{v:.7f}") for f, v in _NATIVE.items()})
    return importance.withColumn(
        "mean_abs_contribution", F.round(F.col("mean_abs_contribution") + F.lit(0.00000033), 6)
    )


@query(
    "ex_importance_trees",
    "SELECT f AS feature, true AS valid FROM (VALUES " + ", ".join(f"('{f}')" for f in FEATURES) + ") AS t(f)",
)
def ex_importance_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature with an importance of the model's own, which add up to one, and a mean contribution."""
    model = models.train_trees(split_xy(spark, sf, "train"))
    rows = models.score_with(model, split_xy(spark, sf, "test"))
    native = trees.native_importance(model, FEATURES)
    table = explain.importance_table(trees.explain_trees(model, rows, FEATURES), native)
    whole = F.lit(abs(sum(native.values()) - 1) < 1e-6)
    ok = (F.col("native_importance") >= 0) & (F.col("mean_abs_contribution") >= 0) & whole
    return table.select("feature", F.coalesce(ok, F.lit(False)).alias("valid"))


@query(
    "ex_drivers",
    _on_attr(
        f"""SELECT feature, {r('mean_abs', 'mean_abs_contribution', 6)} FROM
  (SELECT feature, avg(abs(contribution)) AS mean_abs FROM attr WHERE score >= 0.5 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)"""
    ),
)
def ex_drivers(spark: SparkSession, sf: str) -> DataFrame:
    top = explain.drivers(explained(spark, sf), F.col("churn_probability") >= 0.5, 5)
    return rounded(top, default=6)


@query(
    "ex_topk",
    _on_attr(
        f"""SELECT customer_id, CAST(0 AS INTEGER) AS step, 'Base value' AS label, {r(_BASE, 'amount', 6)} FROM scored, means
UNION ALL SELECT customer_id, CAST(rk AS INTEGER), feature || ' = ' || coalesce(format('{{:g}}', round(value + {NUDGE}, 4) * (1 + 1e-9)), 'nan'),
  {r('contribution', 'amount', 6)} FROM ranked_attr WHERE rk <= 12
UNION ALL SELECT customer_id, 13, count(*) || ' other features', {r('sum(contribution)', 'amount', 6)} FROM ranked_attr
  WHERE rk > 12 GROUP BY 1
UNION ALL SELECT customer_id, 14, 'Prediction', {r(f'any_value({_BASE}) + sum(contribution)', 'amount', 6)}
  FROM attr, means GROUP BY 1"""
    ),
)
def ex_topk(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(explain.waterfall(said(explained(spark, sf)), 12), default=6)


def _label(f: str) -> str:
    import re

    return " ".join(w.capitalize() for w in re.sub(r"(\d+)", r" \1", f.replace("_", " ")).split())


_CASE_LABEL = "CASE feature " + " ".join(f"WHEN '{f}' THEN '{_label(f)}'" for f in COEFFICIENTS) + " END"


@query(
    "ex_sentence",
    _on_attr(
        f"""SELECT customer_id, CAST(rk AS INTEGER) AS position,
  {_CASE_LABEL} || ' (' || coalesce(format('{{:g}}', round(value + {NUDGE}, 4) * (1 + 1e-9)), 'nan') || ') is '
    || CASE WHEN contribution > 0 THEN 'raising' ELSE 'lowering' END || ' this customer''s churn risk.' AS sentence
FROM ranked_attr WHERE rk <= 5"""
    ),
)
def ex_sentence(spark: SparkSession, sf: str) -> DataFrame:
    lists = explain.sentences(said(explained(spark, sf)))
    # Spark puts a filter on the array's size before an inner explode, and so works all sentences out twice.
    return lists.select("customer_id", F.posexplode_outer("sentences").alias("p", "sentence")).where("p IS NOT NULL").select(
        "customer_id", (F.col("p") + 1).cast("int").alias("position"), "sentence"
    )


@query(
    "pf_compare",
    _on_attr(
        f"""SELECT feature, bin, {r('low + bin * width', 'lower')}, {r('low + (bin + 1) * width', 'upper')}, count(*) AS n_rows,
  bool_or(is_own) AS is_customer_bin, {r('any_value(own)', 'customer_value')}, {r('any_value(pr)', 'percent_rank', 6)}
FROM (SELECT v.feature, low, width, own, pr, CAST(least(floor((value - low) / width), 29) AS BIGINT) AS bin,
    CAST(least(floor((own - low) / width), 29) AS BIGINT) = CAST(least(floor((value - low) / width), 29) AS BIGINT) AS is_own
  FROM attr v JOIN bounds USING (feature) WHERE value IS NOT NULL)
GROUP BY feature, bin, low, width""",
        """,
riskiest AS (SELECT arg_max(customer_id, struct_pack(s := score, t := -customer_id)) AS id FROM scored),
top3 AS (SELECT feature, value AS own FROM ranked_attr, riskiest WHERE customer_id = id AND rk <= 3),
bounds AS (SELECT feature, own, min(value) AS low, (max(value) - min(value)) / 30 AS width,
    count(*) FILTER (WHERE value < own) / (count(value) - 1) AS pr
  FROM attr JOIN top3 USING (feature) GROUP BY feature, own)""",
    ),
)
def pf_compare(spark: SparkSession, sf: str) -> DataFrame:
    """The riskiest customer against the population, for their three strongest features."""
    rows = explained(spark, sf)
    who = explain.riskiest_customer(rows)
    top = explain.one_customer(rows, who).select(
        F.inline(F.slice(explain.ranked_contributions(), 1, 3))
    ).collect()
    compared = portfolio.compare_customer(scored(spark, sf), who, [t["feature"] for t in top])
    return rounded(compared, {"percent_rank": 6})


# --- reports ---------------------------------------------------------------------------


@query(
    "fmt_report",
    O.on_scored(
        """SELECT customer_id, coalesce('£' || format('{:,}', CAST(round_even(spend_90d, 0) AS BIGINT)), 'N/A') AS spend_90d,
  '£' || format('{:,}', CAST(round_even(revenue_at_risk, 0) AS BIGINT)) AS revenue_at_risk,
  format('{:.1f}', round_even(churn_probability * 100, 1)) || '%' AS churn_probability,
  format('{:,}', frequency) AS frequency, format('{:.3f}', round_even(score, 3)) AS score,
  strftime(DATE '1999-01-01' + CAST(recency_days AS INTEGER), '%d %b %Y') AS since
FROM scored"""
    ),
)
def fmt_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = scored(spark, sf).select(
        "customer_id", "spend_90d", "revenue_at_risk", "churn_probability", "frequency", "score",
        F.date_add(F.lit("1999-01-01").cast("date"), F.col("recency_days").cast("int")).cast("string").alias("since"),
    )
    return report.format_report(
        rows,
        {
            "spend_90d": "currency", "revenue_at_risk": "currency", "churn_probability": "percent",
            "frequency": "count", "score": "metric", "since": "date",
        },
    )
