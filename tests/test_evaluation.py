from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ebbline.functions.ordering import asc, desc, with_running
from ebbline.operators import evaluation as ev
from ebbline.operators import portfolio as pf
from ebbline.operators import report


@pytest.fixture(scope="module")
def scored(spark):
    def build(labels, scores):
        rows = [(i, y, float(s)) for i, (y, s) in enumerate(zip(labels, scores), start=1)]
        return spark.createDataFrame(rows, "customer_id long, label int, score double")

    return build


def one(df):
    return df.first().asDict()


def random_case(n=300, seed=1):
    rng = random.Random(seed)
    scores = [rng.choice([0.0, 0.25, round(rng.random(), 2)]) for _ in range(n)]
    return [int(rng.random() < 0.3 + 0.5 * s) for s in scores], scores


def test_perfect_and_reversed(scored):
    perfect = scored([0, 0, 1, 1], [0, 0.1, 0.9, 1])
    assert one(ev.auc_metrics(perfect)) == {"roc_auc": 1.0, "pr_auc": 1.0}
    assert one(ev.precision_recall_f1(perfect)) == {"precision": 1.0, "recall": 1.0, "f1": 1.0}
    assert one(ev.confusion(scored([0, 0, 1, 1], [0.9, 0.1, 0.9, 0.1]))) == {"tn": 1, "fp": 1, "fn": 1, "tp": 1}
    assert one(ev.confusion(scored([1], [0.5])))["tp"] == 1
    assert one(ev.precision_recall_f1(scored([0, 0], [0.1, 0.2]))) == {"precision": 0.0, "recall": 0.0, "f1": 0.0}


def test_auc_against_all_pairs_and_symmetry(scored):
    y, s = random_case()
    pos, neg = [v for v, t in zip(s, y) if t], [v for v, t in zip(s, y) if not t]
    pairs = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    df = scored(y, s)
    auc = one(ev.roc_auc(df))["roc_auc"]
    assert auc == pytest.approx(pairs / len(pos) / len(neg), rel=1e-12)
    flipped = one(ev.roc_auc(df.withColumn("score", 1 - F.col("score"))))["roc_auc"]
    assert auc + flipped == pytest.approx(1.0)
    thresholds = sorted(set(s), reverse=True)
    ap, before = 0.0, 0.0
    for t in thresholds:
        tp = sum(1 for v, k in zip(s, y) if v >= t and k)
        n = sum(1 for v in s if v >= t)
        ap += (tp / len(pos) - before) * tp / n
        before = tp / len(pos)
    assert one(ev.average_precision(df))["pr_auc"] == pytest.approx(ap, rel=1e-12)
    roc = sorted((r["fpr"], r["tpr"]) for r in ev.roc_points(df).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(roc, roc[1:]))
    assert area == pytest.approx(auc) and roc[0] == (0.0, 0.0) and roc[-1] == (1.0, 1.0)
    bends = sorted((r["fpr"], r["tpr"]) for r in ev.roc_points(df, drop_intermediate=True).collect())
    assert len(bends) < len(roc)
    assert sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(bends, bends[1:])) == pytest.approx(auc)
    assert ev.pr_points(df).count() == len(thresholds) + 1


def test_rows_without_a_score_take_no_part_in_rankings(scored):
    df = scored([1, 0, 1, 0, 1], [0.9, 0.4, 0.7, 0.1, 0.3])
    more = df.unionByName(df.limit(2).withColumn("score", F.lit(None).cast("double")))
    assert ev.auc_metrics(more).first() == ev.auc_metrics(df).first()
    assert ev.ranked_by_score(more).count() == ev.ranked_by_score(df).count() == df.count()


def test_single_class_gives_null(scored):
    assert one(ev.auc_metrics(scored([0, 0], [0.1, 0.2])))["roc_auc"] is None


def test_lift(scored):
    assert one(ev.lift_at_k(scored([1, 1, 0, 0], [0.9, 0.8, 0.2, 0.1]), 0.5))["lift"] == 2.0
    assert one(ev.lift_at_k(scored([1, 0, 1, 0], [0.5] * 4), 1.0))["lift"] == 1.0
    assert one(ev.lift_at_k(scored([0, 0], [0.5, 0.1]), 0.5))["lift"] is None
    for k in (0, 1.5):
        with pytest.raises(ValueError):
            ev.lift_at_k(scored([1], [0.5]), k)


def test_gains_and_calibration(scored):
    zeros = scored([0] * 20, [i / 40 for i in range(20)])
    assert all(r["lift"] is None and r["pct_captured"] == 0 for r in ev.gains(zeros).collect())
    assert sum(r["n_rows"] for r in ev.calibration(zeros).collect()) == 20
    y, s = random_case(25)
    got = {r["decile"]: r for r in ev.gains(scored(y, s)).collect()}
    assert got[10]["pct_captured"] == 100.0 and got[10]["lift"] == pytest.approx(1.0)
    ranked = [t for _, _, t in sorted((-v, i, t) for i, (v, t) in enumerate(zip(s, y)))]
    # round(2.5) = 2: halves go to the even number.
    assert got[1]["pct_captured"] == pytest.approx(100 * sum(ranked[:2]) / sum(y))
    assert len(ev.calibration(scored([0, 1, 1], [0.5] * 3)).collect()) == 1


def test_evaluate_is_long_and_complete(scored):
    df = scored(*random_case(50)).withColumn("spend_90d", F.when(F.col("customer_id") % 2 == 0, F.lit(10.0)))
    got = {r["metric"]: r["value"] for r in ev.evaluate(df, "m").collect()}
    assert set(got) == {
        "tn", "fp", "fn", "tp", "precision", "recall", "f1", "brier", "roc_auc", "pr_auc", "lift_at_10pct", "revenue_at_risk_total"
    }
    assert got["tn"] + got["fp"] + got["fn"] + got["tp"] == 50


def test_revenue_at_risk(spark):
    df = spark.createDataFrame([(0.5, 100.0), (0.2, 200.0), (0.9, None)], "churn_probability double, spend_90d double")
    assert [r["revenue_at_risk"] for r in ev.with_revenue_at_risk(df).collect()] == [50.0, 40.0, 0.0]


def test_running_sums_with_a_hot_value(spark):
    """More than a third of the rows share one value: order and sums stay exact."""
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("customer_id"), F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.col("id") / 7.0).alias("v")
    ).repartition(5)
    got = with_running(df, [desc("v"), asc("customer_id")], sums={"c": "v"}, totals={"t": "v", "n": "*"}, lead={"nx": "v"})
    out = sorted(got.collect(), key=lambda r: r["rank"])
    want = sorted(((-(i / 7.0) if i % 2 else 0.0), i) for i in range(n))
    assert [r["customer_id"] for r in out] == [i for _, i in want]
    assert [r["rank"] for r in out] == list(range(1, n + 1))
    run = list(itertools.accumulate(-v for v, _ in want))
    assert [r["c"] for r in out] == pytest.approx(run) and out[0]["t"] == pytest.approx(run[-1])
    assert [r["nx"] for r in out] == [r["v"] for r in out[1:]] + [None] and out[0]["n"] == n


# --- portfolio ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def population(spark):
    rows = [(i, float(i), i / 20, i * 2.0) for i in range(1, 21)]
    return spark.createDataFrame(rows, "customer_id long, spend_90d double, churn_probability double, revenue_at_risk double")


def test_bands(population):
    bands = pf.risk_bands(population, "spend_90d").orderBy("band_index").collect()
    assert len(bands) == 5 and sum(b["n_customers"] for b in bands) == 20
    assert bands[0]["lower"] == 1.0 and bands[-1]["upper"] == 20.0 and bands[0]["label"].startswith("[")
    same = pf.risk_bands(population.withColumn("spend_90d", F.lit(10.0)), "spend_90d").collect()
    assert len(same) == 1 and same[0]["label"] == "all" and same[0]["n_customers"] == 20
    assert pf.risk_bands(population.limit(0), "spend_90d").count() == 0
    some = population.withColumn("spend_90d", F.when(F.col("customer_id") > 10, F.col("spend_90d")))
    assert sum(b["n_customers"] for b in pf.risk_bands(some, "spend_90d").collect()) == 10
    named = population.withColumn("segment", F.when(F.col("customer_id") < 5, "a").otherwise("b"))
    assert {r["label"]: r["n_customers"] for r in pf.risk_bands(named, "segment").collect()} == {"a": 4, "b": 16}


def risks(spark, xs):
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "customer_id long, revenue_at_risk double")


def test_pareto(spark):
    got = pf.pareto_point(risks(spark, [100, 10, 5, 1])).first()
    assert got["customers"] == 1 and got["pct_customers"] == 25.0
    shares = [r["share"] for r in pf.pareto_curve(risks(spark, [50, 10, 30])).orderBy("rank").collect()]
    assert shares == pytest.approx([50 / 90, 80 / 90, 1.0])
    assert pf.pareto_point(risks(spark, [0, 0])).count() == 0
    assert pf.pareto_curve(risks(spark, [0, 0])).count() == 0
    assert pf.cumulative_risk(risks(spark, [])).count() == 0 and pf.pareto_point(risks(spark, [])).count() == 0


def test_triage(population):
    k = pf.kpis(population).first()
    assert k["total_customers"] == 20 and k["high_risk_customers"] == 11 and k["avg_high_risk_revenue"] == 30.0
    assert pf.kpis(population, 2.0).first()["avg_high_risk_revenue"] is None
    assert pf.high_risk(population, 0.5).count() == 11
    assert pf.search(population, "1").count() == 11 and pf.search(population, "").count() == 20
    assert pf.search(population, "^1.$", regex=True).count() == 10
    assert pf.in_range(population, 4, 10).count() == 4 and pf.in_range(population).count() == 20
    top = pf.top_n(population, 5).collect()
    assert [r["customer_id"] for r in top] == [20, 19, 18, 17, 16] and len(top[0]) == 4
    assert pf.top_n(population, 1).count() == 1 and pf.top_n(population, 1000).count() == 20
    with pytest.raises(ValueError):
        pf.top_n(population, 0)
    total = pf.filtered_total(population, F.col("customer_id") > 18).first()
    assert total["filtered"] == 78.0 and total["everything"] == 420.0
    levels = [r["risk_level"] for r in pf.with_risk_level(population).orderBy("customer_id").collect()]
    assert levels[5] == "low" and levels[6] == "medium" and levels[13] == "high"


def test_compare_customer(population):
    got = pf.compare_customer(population, 20, ["spend_90d"], bins=4).orderBy("bin").collect()
    assert [r["n_rows"] for r in got] == [5, 5, 5, 5] and [r["is_customer_bin"] for r in got] == [False] * 3 + [True]
    assert got[0]["percent_rank"] == 1.0
    with pytest.raises(LookupError):
        pf.compare_customer(population, 99, ["spend_90d"])
    holes = population.withColumn("spend_90d", F.when(F.col("customer_id") > 10, F.col("spend_90d")))
    assert sum(r["n_rows"] for r in pf.compare_customer(holes, 20, ["spend_90d"]).collect()) == 10


def test_formats(spark):
    df = spark.createDataFrame(
        [(1234.6, 0.1234, "2026-07-09", 12345, 0.12345), (-50.0, 12.5, "soon", 7, 1.0), (None, None, None, None, None)],
        "a double, b double, c string, d long, e double",
    )
    kinds = {"a": "currency", "b": "percent", "c": "date", "d": "count", "e": "metric"}
    got = [tuple(r) for r in report.format_report(df, kinds).collect()]
    assert got[0] == ("£1,235", "12.3%", "09 Jul 2026", "12,345", "0.123")
    assert got[1] == ("£-50", "1250.0%", "soon", "7", "1.000")
    assert got[2] == ("N/A", "N/A", "unknown", "N/A", "N/A")
    with pytest.raises(ValueError):
        report.format_report(df, {"a": "roman"})


def test_general_format(spark):
    from ebbline.functions.numbers import general_format

    xs = [0.0, 12.0, 200.0, 0.1, 1681615.0, 240230.5, 87743.25, 1e-5, 0.0001234567, -3.5, 123456.7, 999999.6, 1e22, 5e-324 * 1e10]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r[0] for r in df.select(general_format(F.col("x"))).collect()] == [f"{x:g}" for x in xs]


def test_calibration_leaves_rows_without_a_score_out(spark):
    rows = [(i, i % 2, None if i % 3 == 0 else (i % 10) / 10) for i in range(60)]
    df = spark.createDataFrame(rows, "customer_id long, label int, score double")
    want = ev.calibration(df.where("score is not null")).orderBy("bin").collect()
    assert ev.calibration(df).orderBy("bin").collect() == want and sum(r["n_rows"] for r in want) == 40
    assert ev.calibration(df.where("score is null")).count() == 0


def test_general_format_works_out_each_part_once(spark):
    """Every part that has the one before it in it many times over grows the expression by its square."""
    from ebbline.functions.numbers import general_format

    plan = spark.range(1).select(general_format(F.col("id").cast("double")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("format_string") <= 30
