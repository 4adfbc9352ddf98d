from __future__ import annotations

import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.ml import cv, models, prep, smote, trees
from ebbline.operators import explain, validation
from ebbline.schema import FEATURES, REQUIRED_FEATURES
from ebbline.streaming.scoring import score_records, score_stream

COLUMNS = ["recency_days", "monetary", "frequency"]


@pytest.fixture(scope="module")
def train(spark):
    rng = random.Random(7)
    rows = []
    for i in range(200):
        r, m, f = rng.uniform(0, 100), rng.uniform(0, 1000), rng.uniform(0, 20)
        rows.append((i, r, None if i < 10 else m, f, int(r > 50)))
    return spark.createDataFrame(rows, "customer_id long, recency_days double, monetary double, frequency double, label int")


def test_imputer_and_scaler(spark):
    t = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "a double")
    assert prep.fit_medians(t, ["a"]) == {"a": 2.0}
    val = spark.createDataFrame([(None,), (100.0,)], "a double")
    assert [r["a"] for r in prep.impute(val, {"a": 2.0}).collect()] == [2.0, 100.0]
    even = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    assert prep.fit_medians(even, ["a"]) == {"a": 1.5}
    assert prep.fit_scaling(even, ["a"]) == {"a": (1.5, 0.5)}
    flat = spark.createDataFrame([(4.0,), (4.0,)], "a double")
    assert [r["a"] for r in prep.scale(flat, prep.fit_scaling(flat, ["a"])).collect()] == [0.0, 0.0]


def test_class_weight(spark, train):
    got = prep.class_weight(train).first()
    assert got["positive_weight"] == pytest.approx(got["negatives"] / got["positives"])
    none = spark.createDataFrame([(0,)], "label int")
    assert prep.class_weight(none).first()["positive_weight"] == 1.0


def test_nearest_is_exact(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(230, 4)) * [5, 1, 1, 0.5]
    x[40:60] = x[40]  # copies
    rows = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double, d double")
    got = smote.nearest(rows, rows.where("id % 3 = 0").select("id"), list("abcd"), "id", 4).toPandas()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    assert sorted(got["id"].unique()) == list(range(0, 230, 3))
    for i, part in got.groupby("id"):
        assert len(part) == 4 and i not in set(part["neighbor"])
        assert list(part.sort_values("rank")["rank"]) == [1, 2, 3, 4]
        assert np.allclose(part.sort_values("rank")["distance"], np.sort(d[i])[:4])


@pytest.mark.parametrize("minority", [1, 2, 3, 20])
def test_oversampling_reaches_parity(spark, minority):
    rows = [(i, float(i), float(i % 7), int(i < minority)) for i in range(50)]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, label int")
    out = smote.oversample(df, ["a", "b"]).collect()
    real = [r for r in out if not r["synthetic"]]
    made = [r for r in out if r["synthetic"]]
    assert len(real) == 50
    if minority < 2:
        assert not made
        return
    assert len(made) == 50 - 2 * minority and {r["label"] for r in made} == {1}
    # Between two rows of the smaller class.
    assert all(0 <= r["a"] <= minority - 1 for r in made)
    again = smote.oversample(df.repartition(7), ["a", "b"]).where("synthetic").collect()
    assert sorted(made) == sorted(again)


def test_oversampling_takes_a_bounded_sample_by_key(spark):
    df = spark.createDataFrame([(i, float(i), int(i % 4 == 0)) for i in range(400)], "customer_id long, a double, label int")
    one, two = (smote.oversample(x, ["a"], max_rows=100) for x in (df, df.repartition(9)))
    assert sorted(one.collect()) == sorted(two.collect()) and one.where("not synthetic").count() == 100
    counts = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    assert counts[0] == counts[1]


def test_oversampling_keeps_every_row_above_the_bound_of_a_fit(spark, monkeypatch):
    monkeypatch.setattr(smote, "MAX_FIT_ROWS", 50)
    n = 20_500
    df = spark.range(n).selectExpr("id as customer_id", "cast(id as double) as a", "cast(id % 100 = 0 as int) as label")
    out = smote.oversample(df, ["a"])
    assert out.where("not synthetic").count() == n
    assert {r["count"] for r in out.groupBy("label").count().collect()} == {n - n // 100}


def test_blocked_neighbours_are_exact(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(90, 2))
    rows = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double")
    want = sorted(map(tuple, smote.nearest(rows, rows.select("id"), ["a", "b"], "id", 4).collect()))
    monkeypatch.setattr(smote, "BLOCK_ROWS", 12, raising=False)
    got = sorted(map(tuple, smote.nearest(rows, rows.select("id"), ["a", "b"], "id", 4).collect()))
    assert got == want and len(got) == 360


def test_neighbours_are_sought_only_where_they_may_be(spark, monkeypatch):
    """Rows in clusters, far rows, copies, rows that are not finite, and keys that come twice: all exact, and few rows are sent to other cells."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(600, 6)) * 0.05
    x[:, :3] += rng.integers(0, 3, size=(600, 3)) * 10.0
    x[:4] += 200.0
    x[100:150] = x[100]
    x[590], x[591, 2] = np.nan, np.inf
    keys = [f"k{i:04d}" for i in range(600)]
    keys[301] = keys[300]
    rows = spark.createDataFrame([(i, *map(float, v)) for i, v in zip(keys, x)], "id string, " + ", ".join(f"f{i} double" for i in range(6)))
    written, write = {}, smote.write_table
    monkeypatch.setattr(smote, "write_table", lambda df, name: written.setdefault(name, write(df, name)))
    monkeypatch.setattr(smote, "BLOCK_ROWS", 20)
    got = smote.nearest(rows, rows.where("id != 'k0005'").select("id"), [f"f{i}" for i in range(6)], "id", 4).collect()
    fine, want = np.flatnonzero(np.isfinite(x).all(1)), {}
    for i in fine:
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        want.setdefault(keys[i], []).extend((d[j], keys[j]) for j in fine if keys[j] != keys[i])
    want = {i: sorted(v)[:4] for i, v in want.items() if i != "k0005"}
    found = {}
    for r in sorted(got, key=lambda r: (r["id"], r["rank"])):
        found.setdefault(r["id"], []).append((r["distance"], r["neighbor"]))
    assert found.keys() == want.keys()
    for i, pairs in want.items():
        assert [n for _, n in found[i]] == [n for _, n in pairs] and [d for d, _ in found[i]] == pytest.approx([d for d, _ in pairs], abs=1e-12)
    sent = written["near"].selectExpr("sum(size(_blocks)) AS n").first()["n"]
    blocks = written["cells"].select("_block").distinct().count()
    assert blocks > 20 and sent < 0.35 * len(want) * blocks


def test_the_baseline_learns_from_every_labelled_row(spark):
    n = 40_400
    df = spark.range(n + 3).selectExpr("id as customer_id", "cast(id % 11 as double) as a", f"if(id < {n}, cast(id % 2 as int), null) as label")
    for smoted in (True, False):
        model = models.train_baseline(df.where("label is not null") if not smoted else df, ["a"], smoted, max_iter=3)
        assert model.stages[-1].summary.predictions.count() == n


def test_medians_ignore_nan_and_fill_it(spark):
    df = spark.createDataFrame([(i, float(i) if i else float("nan"), i % 2) for i in range(11)], "customer_id long, a double, label int")
    medians = prep.fit_medians(df, ["a"])
    assert medians == {"a": 5.5} and prep.impute(df, medians).where("a = 5.5").count() == 1
    assert models.score_with(models.train_baseline(df, ["a"]), df).where("isnan(churn_probability)").count() == 0


def test_oversampling_keeps_balanced_or_single_class(spark):
    for labels in ([0, 1] * 3, [1] * 5):
        df = spark.createDataFrame([(i, float(i), y) for i, y in enumerate(labels)], "customer_id long, a double, label int")
        assert smote.oversample(df, ["a"]).count() == len(labels)


def test_models_fit_predict_and_reload(spark, train, tmp_path):
    baseline = models.train_baseline(train, COLUMNS)
    scored = models.score_with(baseline, train)
    assert scored.columns == [*train.columns, "churn_probability"]
    assert scored.where((F.col("churn_probability") >= 0.5) == (F.col("label") == 1)).count() > 180
    tuned = models.train_trees(train, COLUMNS, {"n_estimators": 3, "max_depth": 2})
    predictor = models.ChurnPredictor.of(tuned, train, COLUMNS)
    predictor.save(str(tmp_path / "m"))
    loaded = models.ChurnPredictor.load(spark, str(tmp_path / "m"))
    shuffled = train.select("frequency", "customer_id", "monetary", "recency_days")
    a, b = predictor.predict(shuffled).collect(), loaded.predict(shuffled).collect()
    assert sorted(a, key=lambda r: r["customer_id"]) == sorted(b, key=lambda r: r["customer_id"])
    with pytest.raises(ValueError, match="missing"):
        loaded.predict(shuffled.drop("monetary"))
    with pytest.raises(ValueError, match="unexpected"):
        loaded.predict(shuffled.withColumn("x", F.lit(1)))


def test_tree_attribution_is_additive_and_matches_enumeration(spark, train):
    model = models.train_trees(train, COLUMNS, {"n_estimators": 4, "max_depth": 3})
    rows = models.score_with(model, train)
    got = trees.explain_trees(model, rows, COLUMNS).collect()
    for r in got:
        total = r["base_value"] + sum(c["contribution"] for c in r["contributions"])
        p = r["churn_probability"]
        assert total == pytest.approx(math.log(p / (1 - p)), abs=1e-6)
    # Shapley values by definition, over all orderings of the model's columns.
    leaves = trees.leaves_of(model)
    x = np.array([[60.0, np.nan, 4.0]])
    used = sorted({f for leaf in leaves for f in leaf.features})

    def inside(v, lo, hi, missing):
        return missing if math.isnan(v) else lo < v <= hi

    def value(known):
        out = 0.0
        for leaf in leaves:
            w = leaf.value
            for f, lo, hi, missing, share in zip(leaf.features, leaf.low, leaf.high, leaf.missing, leaf.share):
                w *= float(inside(x[0, f], lo, hi, missing)) if f in known else share
            out += w
        return out

    phi = trees.shapley(leaves, x)[0]
    orders = list(itertools.permutations(used))
    for f in used:
        want = sum(value({*o[: o.index(f)], f}) - value(set(o[: o.index(f)])) for o in orders) / len(orders)
        assert phi[f] == pytest.approx(want, abs=1e-9)


def test_cross_validation_and_report(train, spark):
    folds = cv.run_time_cv(train, 3, COLUMNS, tree_params={"n_estimators": 2, "max_depth": 2}, max_iter=20)
    got = folds.collect()
    assert len(got) == 6 and {r["n_val"] for r in got} == {50} and sorted({r["n_train"] for r in got}) == [50, 100, 150]
    summary = cv.cv_summary(folds)
    single = spark.createDataFrame(
        [("baseline", "roc_auc", 0.80), ("baseline", "pr_auc", 0.85)], "model string, metric string, value double"
    )
    table = {(r["model"], r["metric"]): r for r in cv.cv_report(summary, single).collect()}
    assert len(table) == 4
    row = table["baseline", "roc_auc"]
    assert row["delta"] == pytest.approx(0.80 - row["cv_mean"]) and table["trees", "roc_auc"]["delta"] is None
    assert all(r["single_split"] is None for r in cv.cv_report(summary).collect())


def test_a_search_finds_the_same_with_a_task_for_each_fold(train, monkeypatch):
    space = {"n_estimators": ("int", 4, 8, 4), "max_depth": ("int", 2, 3, 1), "subsample": ("real", 0.5, 1.0), "colsample_bytree": ("real", 0.4, 1.0)}
    want = cv.search(train, 3, k=3, features=COLUMNS, space=space).orderBy("trial").collect()
    made, fit = [], cv.fit_packed
    monkeypatch.setattr(cv, "APART", 10)
    monkeypatch.setattr(cv, "fit_packed", lambda packed, spec, *a: made.append(spec) or fit(packed, spec, *a))
    got = cv.search(train, 3, k=3, features=COLUMNS, space=space).orderBy("trial").collect()
    assert len(made) == 9 and [r["params"] for r in got] == [r["params"] for r in want]
    for name in ("score", "rung_score"):
        assert [r[name] for r in got] == pytest.approx([r[name] for r in want], abs=1e-12)


def test_search_is_seeded_and_bounded(train):
    draws = [cv.draw_params(random.Random(5)) for _ in range(2)]
    assert draws[0] == draws[1] and set(draws[0]) == set(cv.SEARCH_SPACE)
    for seed in range(50):
        p = cv.draw_params(random.Random(seed))
        assert p["n_estimators"] % 50 == 0 and 100 <= p["n_estimators"] <= 500 and 0.01 <= p["learning_rate"] <= 0.3
    space = {"n_estimators": ("int", 1, 2, 1), "max_depth": ("int", 2, 2, 1)}
    a = cv.search(train.limit(60), 2, k=2, features=COLUMNS, space=space)
    assert a.count() == 2
    best = cv.best_trial(a).first()
    assert best["score"] == max(r["score"] for r in a.collect()) and set(a.first()["params"]) == set(space)
    assert cv.search(train, 5, timeout=0.0, k=2, features=COLUMNS, space=space).count() == 1


# --- explanations ----------------------------------------------------------------------


def contributions(spark, rows, names, base=0.3):
    data = [(i, p, base, [(n, float(v), float(c)) for n, v, c in zip(names, vs, cs)]) for i, (p, vs, cs) in enumerate(rows)]
    return spark.createDataFrame(
        data, "customer_id long, churn_probability double, base_value double, "
        "contributions array<struct<feature:string,value:double,contribution:double>>",
    )


def test_drivers_and_sentences(spark):
    names = ["tenure_days", "txn_count_30d"]
    df = contributions(spark, [(0.7, (40, 3), (0.4, -0.2)), (0.6, (10, 1), (-0.3, 0.05)), (0.2, (8, 2), (0.9, 0.9))], names)
    top = explain.drivers(df, F.col("churn_probability") >= 0.5).collect()
    assert [(r["feature"], round(r["mean_abs_contribution"], 9)) for r in top] == [("tenure_days", 0.35), ("txn_count_30d", 0.125)]
    assert explain.drivers(df, F.col("churn_probability") > 2).count() == 0
    row = contributions(spark, [(0.8, (7, 64, 90), (-0.2, 0.6, 0.1))], ["frequency", "spend_30d", "tenure_days"])
    said = explain.sentences(row, 2).first()["sentences"]
    assert said == ["Spend 30d (64) is raising this customer's churn risk.", "Frequency (7) is lowering this customer's churn risk."]
    assert explain.sentences(row, 1, {"spend_30d": "Monthly spend"}).first()["sentences"][0].startswith("Monthly spend (64)")


def test_waterfall(spark):
    names = [f"f{i}" for i in range(20)]
    row = contributions(spark, [(0.5, range(20), [(i + 1) / 20 for i in range(20)])], names)
    got = explain.waterfall(row, 5).orderBy("step").collect()
    assert len(got) == 8 and got[0]["label"] == "Base value" and got[6]["label"] == "15 other features"
    assert got[7]["amount"] == pytest.approx(0.3 + sum((i + 1) / 20 for i in range(20))) and got[1]["label"] == "f19 = 19"
    assert explain.waterfall(row, 20).count() == 22
    assert explain.riskiest_customer(row) == 0
    with pytest.raises(LookupError):
        explain.one_customer(row, 5)


def test_linear_attribution(spark):
    df = spark.createDataFrame([(1, 1.0, 4.0), (2, 3.0, None)], "customer_id long, a double, b double")
    model = explain.LinearExplainer.fit(df, {"a": 2.0, "b": -1.0}, 0.5)
    assert model.base_value == 0.5 + 4.0 - 4.0
    got = {r["customer_id"]: [c["contribution"] for c in r["contributions"]] for r in model.transform(df).collect()}
    assert got == {1: [-2.0, 0.0], 2: [2.0, 0.0]}


# --- validated scoring -------------------------------------------------------------------


@pytest.fixture(scope="module")
def records(spark):
    def build(changes):
        rows = []
        for i, change in enumerate(changes):
            row = {f: (5.0 if f in REQUIRED_FEATURES else None) for f in FEATURES}
            row.update(change)
            rows.append((f"record {i}", *[row[f] for f in FEATURES]))
        return spark.createDataFrame(rows, "customer_id string, " + ", ".join(f"{f} double" for f in FEATURES))

    return build


def test_validation(records):
    df = records([{}, {"frequency": -1.0}, {"monetary": None}, {"spend_slope": -3.0}, {"spend_90d": None}])
    got = [r["errors"] for r in validation.validate_records(df).orderBy("customer_id").collect()]
    assert got == [[], ["frequency: negative"], ["monetary: required"], [], []]
    strict = [r["errors"] for r in validation.validate_records(df, strict=True).orderBy("customer_id").collect()]
    assert strict[4] == ["spend_90d: required"]
    valid, refused = validation.split_valid(validation.validate_records(df))
    assert valid.count() == 3 and refused.count() == 2 and "errors" not in valid.columns
    with pytest.raises(ValueError, match="unexpected"):
        validation.validate_records(df.withColumn("extra", F.lit(1)))
    with pytest.raises(ValueError, match="missing"):
        validation.validate_records(df.drop("monetary"))
    words = df.withColumn("frequency", F.lit("many"))
    assert "frequency: not a number" in validation.validate_records(words).first()["errors"]


def constant(df):
    return df.withColumn("churn_probability", F.lit(0.25))


def test_batches_are_all_or_nothing(records):
    df = records([{}, {"frequency": -1.0}, {}, {}]).withColumn("batch_id", F.expr("int(substr(customer_id, 8)) div 2"))
    good, refused = score_records(df, constant, ("batch_id", "customer_id"), "batch_id")
    assert sorted(r["customer_id"] for r in good.collect()) == ["record 2", "record 3"] and refused.count() == 2
    good, refused = score_records(df, constant, ("batch_id", "customer_id"), "batch_id", max_batch_size=1)
    assert good.count() == 0 and refused.count() == 4


def test_stream_equals_batch(spark, records, tmp_path):
    df = records([{"frequency": -1.0} if i % 5 == 0 else {} for i in range(30)])
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    run = lambda: score_stream(
        spark, str(tmp_path / "in"), df.schema, constant, str(tmp_path / "out"), str(tmp_path / "bad"),
        str(tmp_path / "cp"), files_per_trigger=1,
    ).awaitTermination()
    run()
    good, refused = score_records(df, constant)
    assert sorted(r["customer_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(
        r["customer_id"] for r in good.collect()
    )
    assert spark.read.parquet(str(tmp_path / "bad")).count() == refused.count() == 6
    df.limit(2).write.mode("append").parquet(str(tmp_path / "in"))
    run()  # picks up only the new file
    assert spark.read.parquet(str(tmp_path / "out")).count() == 24 + score_records(df.limit(2), constant)[0].count()


@pytest.fixture(scope="module")
def request_rows(records):
    """Twelve request batches of five, of one record too many, and a bad record in every fourth batch."""
    df = records([{"frequency": -1.0} if i % 20 == 3 else {} for i in range(60)])
    number = F.expr("int(substr(customer_id, 8))")
    return df.withColumn("batch_id", F.expr("int(substr(customer_id, 8)) div 5")).withColumn("batch_size", F.lit(5)).withColumn("no", number)


def stream_of(spark, schema, base, **more):
    score_stream(
        spark, f"{base}/in", schema, constant, f"{base}/out", f"{base}/bad", f"{base}/cp",
        keys=("batch_id", "customer_id"), batch="batch_id", declared="batch_size", **more,
    ).awaitTermination()
    read = lambda name: sorted(tuple(r) for r in spark.read.parquet(f"{base}/{name}").drop("epoch").collect())
    return read("out"), read("bad")


def test_request_batches_are_held_across_files_and_restarts(spark, request_rows, tmp_path):
    rows = request_rows.drop("no")
    one, two = request_rows.where("no % 2 = 0").drop("no"), request_rows.where("no % 2 = 1").drop("no")
    one.coalesce(1).write.parquet(str(tmp_path / "in"))
    good, bad = stream_of(spark, rows.schema, tmp_path)
    assert good == bad == []  # no batch is whole
    two.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    good, bad = stream_of(spark, rows.schema, tmp_path)
    want, refused = score_records(rows.drop("batch_size"), constant, ("batch_id", "customer_id"), "batch_id")
    assert good == sorted(map(tuple, want.collect())) and len(good) == 45
    assert sorted(b[:2] for b in bad) == sorted(tuple(r)[:2] for r in refused.collect())
    assert stream_of(spark, rows.schema, tmp_path) == (good, bad)  # nothing twice
    rows.where("batch_id = 1").write.mode("append").parquet(str(tmp_path / "in"))
    again, late = stream_of(spark, rows.schema, tmp_path)
    assert again == good and len(late) == len(bad) + 5 and any("already judged" in e for x in late for e in x[2])


def test_request_batches_that_cannot_be_whole_are_refused(spark, request_rows, tmp_path):
    rows = request_rows.drop("no").where("batch_id in (1, 2, 5)").withColumn(
        "batch_size", F.expr("case batch_id when 1 then 6 when 2 then 501 else null end").cast("int")
    )
    rows.write.parquet(str(tmp_path / "in"))
    good, bad = stream_of(spark, rows.schema, tmp_path, wait=1)
    assert good == [] and {b[0] for b in bad} == {2, 5} and all("batch: size" in b[2][-1] for b in bad)
    time.sleep(2)
    request_rows.drop("no").where("batch_id = 6").write.mode("append").parquet(str(tmp_path / "in"))
    good, bad = stream_of(spark, rows.schema, tmp_path, wait=1)
    assert {g[0] for g in good} == {6} and {b[0] for b in bad} == {1, 2, 5}
    assert all(b[2][-1] == "batch: 5 of 6 records" for b in bad if b[0] == 1)


def test_arrivals_do_not_grow_in_number_and_split_request_batches(spark, tmp_path):
    from ebbline.plans.catalog_portfolio import ARRIVALS, write_arrivals

    for n in (400, 4000):
        write_arrivals(spark.range(n).select(F.col("id").alias("customer_id"), F.floor(F.col("id") / 20).alias("batch_id")), str(tmp_path / f"{n}"))
        files = spark.read.parquet(str(tmp_path / f"{n}")).withColumn("file", F.input_file_name())
        assert files.count() == n and files.select("file").distinct().count() == ARRIVALS
        assert files.groupBy("batch_id").agg(F.count_distinct("file").alias("files")).where("files < 2").count() == 0


def test_neighbours_are_found_for_many_queries_at_once(monkeypatch):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (300, 3)).astype(float)  # many ties
    ids, made, frame = np.arange(300) * 7, [], pd.DataFrame
    monkeypatch.setattr(smote, "MEASURED", 5_000, raising=False)
    monkeypatch.setattr(smote.pd, "DataFrame", lambda *a, **k: made.append(1) or frame(*a, **k))
    found = smote.closest(ids[:200], x[:200], ids, x, "id", 5)
    monkeypatch.undo()
    assert len(made) < 100
    got = {}
    for own, other, distance, rank in found.itertuples(index=False):
        got.setdefault(own, []).append((rank, other, distance))
    for i in range(200):
        distance = np.sqrt(((x - x[i]) ** 2).sum(1))
        want = sorted((float(distance[j]), int(ids[j])) for j in range(300) if j != i)[:5]
        assert sorted(got[ids[i]]) == [(r + 1, j, d) for r, (d, j) in enumerate(want)]
    assert len(smote.closest(ids[:3], x[:3], ids[:2], x[:2], "id", 5)) == 4


def test_sentences_and_waterfall_are_worked_out_once(spark, tmp_path):
    """A filter on the size of the exploded array would work the array out a second time."""
    entry = F.struct(F.lit("spend_90d").alias("feature"), F.col("id").cast("double").alias("value"), F.col("id").cast("double").alias("contribution"))
    spark.range(3).select(F.col("id").alias("customer_id"), F.array(entry).alias("contributions"), F.lit(0.5).alias("base_value")).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    steps = explain.waterfall(rows, 2)
    assert steps.count() == 9
    assert steps._jdf.queryExecution().optimizedPlan().toString().count("Base value") == 1
    assert "array_sort" not in rows.select(explain.ranked_contributions())._jdf.queryExecution().analyzed().toString()
