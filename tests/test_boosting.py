"""Boosted trees against a booster that tries every split by hand, and the search that tunes them."""

from __future__ import annotations

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.ml import boosting, cv, models
from ebbline.operators.evaluation import auc_by, auc_metrics

NAMES = ["a", "b", "c"]


def sample(n=200, seed=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[rng.random((n, 3)) < 0.2] = np.nan
    y = (np.where(np.isnan(x[:, 0]), 1.2, x[:, 0]) + 0.5 * rng.normal(size=n) > 0.3).astype(int)
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, *[None if math.isnan(v) else float(v) for v in r], int(t), i % 4) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "customer_id long, a double, b double, c double, label int, part int").repartition(parts)


def by_hand(x, y, p):
    """Every cut between two values, missing values on either side, depth first."""
    weight = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0)
    margin, losses = np.zeros(len(y)), []

    def soft(g):
        return math.copysign(max(abs(g) - p.reg_alpha, 0.0), g)

    for _ in range(p.n_estimators):
        prob = 1 / (1 + np.exp(-margin))
        g, h = weight * (prob - y), weight * prob * (1 - prob)

        def grow(rows, depth):
            G, H = g[rows].sum(), h[rows].sum()
            best = (1e-12, None)
            for j in range(x.shape[1]) if depth < p.max_depth else ():
                for cut in np.unique(x[~np.isnan(x[:, j]), j]):
                    for side in (True, False):
                        left = np.where(np.isnan(x[rows, j]), side, x[rows, j] <= cut)
                        GL, HL = g[rows[left]].sum(), h[rows[left]].sum()
                        GR, HR = G - GL, H - HL
                        if min(HL, HR) < p.min_child_weight:
                            continue
                        gain = 0.5 * (soft(GL) ** 2 / (HL + p.reg_lambda) + soft(GR) ** 2 / (HR + p.reg_lambda) - soft(G) ** 2 / (H + p.reg_lambda)) - p.gamma
                        if gain > best[0] + 1e-9:
                            best = (gain, left)
            if best[1] is None:
                margin[rows] += -p.learning_rate * soft(G) / (H + p.reg_lambda)
            else:
                grow(rows[best[1]], depth + 1)
                grow(rows[~best[1]], depth + 1)

        grow(np.arange(len(y)), 0)
        prob = 1 / (1 + np.exp(-margin))
        losses.append(-(weight * (y * np.log(prob) + (1 - y) * np.log(1 - prob))).sum())
    return margin, losses


@pytest.mark.parametrize("params", [
    {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3},
    {"n_estimators": 4, "max_depth": 2, "learning_rate": 0.5, "gamma": 1.5, "min_child_weight": 6, "reg_alpha": 1.0, "reg_lambda": 5.0},
])
def test_trees_equal_those_grown_by_hand(spark, params):
    x, y = sample()
    p = boosting.TreeParams.of(params)
    df = frame(spark, x, y)
    # All values are edges, so that both try the same cuts.
    edges = [np.unique(x[~np.isnan(x[:, j]), j]) for j in range(3)]
    model = boosting.fit_many(df, NAMES, [boosting.Spec(p)], "customer_id", edges=edges)[0]
    want, losses = by_hand(x, y, p)
    assert boosting.margins(model.trees, x) == pytest.approx(want, abs=1e-9)
    assert losses == sorted(losses, reverse=True)
    got = {r["customer_id"]: r["churn_probability"] for r in models.score_with(model, df).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(1 / (1 + np.exp(-want)), abs=1e-9)


def test_penalties_have_an_effect_and_unknown_parameters_none(spark):
    x, y = sample()
    df = frame(spark, x, y)
    trees = lambda **p: models.train_trees(df, NAMES, {"n_estimators": 2, "max_depth": 3} | p).trees
    plain = trees()
    for name, value in (("gamma", 1000.0), ("min_child_weight", 1e6)):
        assert all((t.feature < 0).all() for t in trees(**{name: value}))
    assert np.abs(trees(reg_lambda=100.0)[0].value).max() < np.abs(plain[0].value).max()
    assert (trees(reg_alpha=1e6)[0].value == 0).all()
    with pytest.raises(ValueError, match="unknown"):
        trees(depth=3)


def test_samples_depend_on_keys_and_seeds_alone(spark):
    x, y = sample()
    p = {"n_estimators": 3, "max_depth": 2, "subsample": 0.5, "colsample_bytree": 0.67}
    one, two = (boosting.margins(models.train_trees(frame(spark, x, y, k), NAMES, p).trees, x) for k in (2, 7))
    assert one == pytest.approx(two, abs=1e-9)
    assert np.abs(boosting.margins(models.train_trees(frame(spark, x, y), NAMES, p, seed=1).trees, x) - one).max() > 1e-6


def test_several_tasks_give_the_trees_of_one(spark, monkeypatch):
    x, y = sample()
    df, p = frame(spark, x, y), boosting.TreeParams(n_estimators=2, max_depth=2)
    edges = boosting.quantile_edges(df, NAMES)
    want = boosting.fit_many(df, NAMES, [boosting.Spec(p)], "customer_id", edges=edges)[0]
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 60)
    got = boosting.fit_many(df, NAMES, [boosting.Spec(p)], "customer_id", edges=edges)[0]
    assert boosting.margins(got.trees, x) == pytest.approx(boosting.margins(want.trees, x), abs=1e-9)
    assert [t.feature.tolist() for t in got.trees] == [t.feature.tolist() for t in want.trees]


def test_models_side_by_side_equal_those_fitted_alone(spark):
    x, y = sample()
    df = frame(spark, x, y)
    edges = boosting.quantile_edges(df, NAMES)
    specs = [boosting.Spec(boosting.TreeParams(n_estimators=n, max_depth=d), upto=u) for n, d, u in ((3, 2, 1), (5, 3, 3), (2, 1, None))]
    together = boosting.fit_many(df, NAMES, specs, "customer_id", "part", edges)
    for spec, model in zip(specs, together):
        rows = df if spec.upto is None else df.where(F.col("part") < spec.upto)
        alone = boosting.fit_many(rows, NAMES, [boosting.Spec(spec.params)], "customer_id", edges=edges)[0]
        assert boosting.margins(model.trees, x) == pytest.approx(boosting.margins(alone.trees, x), abs=1e-9)
        assert len(model.trees) == spec.params.n_estimators


def test_awkward_tables(spark):
    schema = "customer_id long, a double, b double, c double, label int"
    p = {"n_estimators": 2, "max_depth": 2}
    empty = spark.createDataFrame([], schema)
    rows = spark.createDataFrame([(1, 1.0, None, float("nan"), 1), (2, 2.0, None, 3.0, 1), (3, 1.0, None, None, None)], schema)
    for df in (empty, rows):
        model = models.train_trees(df, NAMES, p)
        assert models.score_with(model, rows).where("churn_probability between 0 and 1").count() == 3
    assert sum(models.train_trees(empty, NAMES, p).gains().values()) == 0


def test_areas_of_groups_equal_those_of_each(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i % 5, int(rng.random() < 0.4) if i % 5 else 1, rng.randrange(12) / 10 if i % 17 else None) for i in range(300)], "grp int, label int, score double")
    for r in auc_by(df, "grp").collect():
        own = auc_metrics(df.where(F.col("grp") == r["grp"])).first()
        assert (r["roc_auc"], r["pr_auc"]) == (pytest.approx(own["roc_auc"]), pytest.approx(own["pr_auc"]))


def test_sampler_beats_random_draws():
    space = {"x": ("real", -5.0, 5.0), "y": ("log", 1e-4, 10.0), "n": ("int", 0, 20, 2)}

    def value(p):
        return -((p["x"] - 2) ** 2) - math.log10(p["y"] / 0.01) ** 2 - ((p["n"] - 14) / 4) ** 2

    def best(seed, guided):
        done = []
        for t in range(40):
            rng = random.Random(f"{seed}-{t}")
            p = cv.propose(rng, done if guided else [], space)
            assert -5 <= p["x"] <= 5 and 1e-4 <= p["y"] <= 10 and p["n"] in range(0, 21, 2)
            done.append((value(p), p))
        return max(v for v, _ in done)

    guided, drawn = ([best(s, g) for s in range(12)] for g in (True, False))
    assert np.mean(guided) > np.mean(drawn) + 0.05


def test_search_prunes_repeats_and_goes_on_after_a_stop(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(cv, "STARTUP", 2)
    x, y = sample(120)
    df = frame(spark, x, y).drop("part")
    space = {"n_estimators": ("int", 2, 6, 2), "max_depth": ("int", 1, 3, 1), "learning_rate": ("log", 0.01, 0.5)}
    run = lambda n, **kw: [tuple(r)[:5] for r in cv.search(df, n, k=2, features=NAMES, space=space, parallelism=2, **kw).orderBy("trial").collect()]
    whole = run(6)
    assert [t[0] for t in whole] == list(range(6)) and all(0 <= t[1] <= 1 for t in whole)
    run(4, runs=str(tmp_path / "trials"))
    assert run(6, runs=str(tmp_path / "trials")) == whole == run(6, runs=str(tmp_path / "trials"))
    assert all(t[1] == t[2] for t in whole if t[3])


def test_search_keeps_trees_in_the_tasks_and_scores_as_they_do(spark, monkeypatch):
    x, y = sample(160)
    df = frame(spark, x, y)
    edges = boosting.quantile_edges(df, NAMES)
    p = boosting.TreeParams(n_estimators=7, max_depth=3, subsample=0.8, gamma=0.05)
    specs = [boosting.Spec(p, 1, f) for f in (2, 3)]
    fitted = boosting.fit_many(df, NAMES, specs, "customer_id", "part", edges)
    got = boosting.fit_scores(df, NAMES, specs, "customer_id", "part", edges, [2, 7]).collect()
    want = []
    for i, (spec, model) in enumerate(zip(specs, fitted)):
        own = np.arange(len(y)) % 4 == spec.upto
        for rounds in (2, 7):
            score = boosting.sigmoid(boosting.margins(model.trees[:rounds], x[own]))
            want += [(i, rounds, int(t), float(s)) for t, s in zip(y[own], score)]
    assert sorted(tuple(r) for r in got) == sorted(want)

    # Trees of a generation once came to the driver: none does now.
    monkeypatch.setattr(boosting, "of_rows", lambda *_: pytest.fail("trees on the driver"))
    space = {"n_estimators": ("int", 2, 6, 2), "max_depth": ("int", 1, 3, 1)}
    assert cv.search(df.drop("part"), 3, k=2, features=NAMES, space=space).count() == 3


@pytest.mark.parametrize("gathered", [0, 1 << 25])
def test_many_tasks_without_waiting_for_each_other_give_the_trees_and_scores_of_one(spark, monkeypatch, gathered):
    x, y = sample()
    df, edges = frame(spark, x, y), [np.array([-0.5, 0.0, 0.5])] * 3
    p = boosting.TreeParams(n_estimators=12, max_depth=3, subsample=0.8, colsample_bytree=0.67)
    specs = [boosting.Spec(p, 1, 2), boosting.Spec(boosting.TreeParams(n_estimators=5, max_depth=2), 3, 3)]

    def both():
        models = boosting.fit_many(df, NAMES, specs, "customer_id", "part", edges)
        scores = boosting.fit_scores(df, NAMES, specs, "customer_id", "part", edges, [2, 5, 12]).collect()
        return [[t.feature.tolist() for t in m.trees] for m in models], [boosting.margins(m.trees, x) for m in models], sorted(map(tuple, scores))

    shapes, margins, scores = both()
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 40)
    monkeypatch.setattr(boosting, "CUT", 4)
    monkeypatch.setattr(boosting, "GATHERED", gathered)
    start = time.time()
    got = both()
    # 72 levels; when tasks waited for each other within a stage, each of them took a second.
    assert time.time() - start < 60
    assert got[0] == shapes and np.concatenate(got[1]) == pytest.approx(np.concatenate(margins), abs=1e-9)
    assert [r[:3] for r in got[2]] == [r[:3] for r in scores]
    assert [r[3] for r in got[2]] == pytest.approx([r[3] for r in scores], abs=1e-9)


def test_features_counted_together_give_the_same_trees(monkeypatch):
    """Many rows are counted by several features at once; few are counted by one feature after another."""
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.normal(size=4000), rng.integers(0, 3, 4000), rng.normal(size=4000), rng.integers(0, 2, 4000), np.full(4000, np.nan)])
    x[rng.random(x.shape) < 0.1] = np.nan
    y = (np.nan_to_num(x[:, 0]) + np.nan_to_num(x[:, 1]) + rng.normal(size=4000) > 1).astype(float)
    edges = [np.unique(np.nanquantile(c, np.arange(64) / 64)) if not np.isnan(c).all() else np.empty(0) for c in x.T]
    params = boosting.TreeParams(n_estimators=6, max_depth=3, subsample=0.7, colsample_bytree=0.6, min_child_weight=5.0)

    def grown():
        own = boosting.Grower(boosting.Spec(params, 5, 3), boosting.coded(x, edges), edges, y, rng_key, np.arange(4000, dtype=np.int32) % 4)
        boosting.grow([own])
        return own.trees

    rng_key, counted, joint = np.arange(4000) * 7919, [], boosting.joint
    want = grown()
    monkeypatch.setattr(boosting, "FILLED", 0)
    monkeypatch.setattr(boosting, "joint", lambda *a: counted.append(joint(*a)) or counted[-1])
    got = grown()
    # Two features of 66 bins, or those of few bins, are one pass.
    assert len(counted) == 6 and all(len(groups) < sum(len(g[1]) for g in groups) for groups in counted)
    for a, b in zip(want, got):
        assert (a.feature == b.feature).all() and np.allclose(a.value, b.value, atol=1e-12) and np.allclose(a.cover, b.cover) and (a.cut == b.cut).all()
