from __future__ import annotations

import random

import pytest
from conftest import CANONICAL, SNAPSHOT, days_after
from pyspark.sql import functions as F

from ebbline.operators import features as X
from ebbline.operators import guards, labels, splits
from ebbline.schema import FEATURES, NULLABLE_FEATURES, REQUIRED_FEATURES

FUTURE = (1, "FUTURE", "2011-01-01", 1, 1.0, "X")


def test_feature_list_has_33_columns_21_required():
    assert len(FEATURES) == 33 and len(set(FEATURES)) == 33
    assert len(REQUIRED_FEATURES) == 21 and len(NULLABLE_FEATURES) == 12


def test_rfm_by_hand(canonical, rows):
    got = rows(X.rfm(canonical, SNAPSHOT))
    assert (got[1]["frequency"], got[1]["monetary"], got[1]["recency_days"]) == (2, 22.0, 22)
    assert (got[2]["monetary"], got[2]["recency_days"]) == (40.0, 4)


def test_windows_by_hand(canonical, rows):
    got = rows(X.rolling_features(canonical, SNAPSHOT, [90, 365]))
    one = got[1]
    assert (one["invoice_count_90d"], one["spend_90d"]) == (1, 12.0)
    assert (one["invoice_count_365d"], one["spend_365d"]) == (2, 22.0)
    assert one["spend_std_90d"] is None and one["avg_basket_90d"] == 1.5 and one["txn_count_365d"] == 3


def test_inactive_customer_keeps_a_row_of_nulls(lines, rows):
    old = lines([(1, "A", "2009-01-01", 1, 1.0, "X"), (1, "B", "2009-02-01", 1, 1.0, "X")])
    got = rows(X.rolling_features(old, SNAPSHOT, [30]))[1]
    assert all(v is None for k, v in got.items() if k != "customer_id")


def test_window_excludes_its_lower_bound(lines, rows):
    edge = lines([(1, "A", "2010-05-02", 1, 5.0, "X"), (1, "B", "2010-06-01", 1, 7.0, "X")])
    got = rows(X.rolling_features(edge, SNAPSHOT, [30]))[1]
    assert (got["invoice_count_30d"], got["spend_30d"]) == (1, 7.0)


def test_invoice_straddling_the_edge_counts_whole_by_its_latest_line(lines, rows):
    split = lines([(1, "A", "2010-04-01", 2, 10.0, "X"), (1, "A", "2010-05-30", 1, 1.0, "X")])
    got = rows(X.rolling_features(split, SNAPSHOT, [30]))[1]
    assert got["spend_30d"] == 21.0 and got["txn_count_30d"] == 1 and got["avg_basket_30d"] == 1.0


def test_lines_without_invoice_count_for_lifetime_only(lines, rows):
    some = lines([(1, None, "2010-05-20", 4, 2.0, "X"), (1, "A", "2010-05-21", 1, 3.0, "X")])
    got = rows(X.build_features(some, SNAPSHOT))[1]
    assert got["monetary"] == 11.0 and got["frequency"] == 1 and got["total_txns"] == 1
    assert got["spend_30d"] == 3.0 and got["txn_count_30d"] == 1 and got["avg_basket_30d"] == 2.5
    only = rows(X.build_features(lines([(1, None, "2010-05-20", 4, 2.0, "X")]), SNAPSHOT))[1]
    assert only["txn_count_30d"] == 0 and only["invoice_count_30d"] is None and only["spend_slope"] is None


@pytest.mark.parametrize("windows", [[], [0], [-1], [30, 0]])
def test_bad_windows(canonical, windows):
    with pytest.raises(ValueError):
        X.rolling_features(canonical, SNAPSHOT, windows)


def test_lifetime_by_hand(canonical, rows):
    got = rows(X.lifetime_features(canonical, SNAPSHOT))
    assert got[1]["tenure_days"] == 97 and got[2]["first_purchase_days"] == 73
    assert got[1]["distinct_products"] == 3 and got[3]["distinct_products"] == 2
    assert got[2]["total_revenue"] == 40.0 and got[2]["total_invoices"] == 3
    assert got[2]["avg_order_value"] == pytest.approx(40 / 3)


def test_no_stock_column_gives_null(canonical, rows):
    bare = canonical.drop("stock_code")
    assert rows(X.lifetime_features(bare, SNAPSHOT))[1]["distinct_products"] is None
    assert rows(X.build_features(bare, SNAPSHOT))[1]["distinct_products"] is None


def test_slopes_and_gaps(lines, rows):
    growing = lines([(1, i, d, 1, p, "X") for i, d, p in [("A", "2010-04-01", 10), ("B", "2010-04-15", 50), ("C", "2010-05-01", 100)]])
    assert rows(X.trend_features(growing, SNAPSHOT))[1]["spend_slope"] > 0
    single = rows(X.trend_features(lines([(1, "A", "2010-05-01", 1, 10, "X")]), SNAPSHOT))[1]
    assert single["spend_slope"] is None and single["days_between_txns"] is None
    even = lines([(1, i, d, 1, 1, "X") for i, d in [("A", "2010-04-01"), ("B", "2010-04-15"), ("C", "2010-04-29")]])
    got = rows(X.trend_features(even, SNAPSHOT))[1]
    assert got["days_between_txns"] == 14.0 and got["txn_count_slope"] == pytest.approx(1 / 14)
    same_day = lines([(1, i, "2010-04-01", 1, 1, "X") for i in "AB"])
    got = rows(X.trend_features(same_day, SNAPSHOT))[1]
    assert got["spend_slope"] is None and got["txn_count_slope"] is None and got["days_between_txns"] == 0.0


def test_count_slope_against_a_fit_with_ties_and_sub_day_times(lines, rows):
    import numpy as np

    rng = random.Random(3)
    data, want = [], {}
    for c in (1, 2, 3):
        moments = sorted(days_after("2009-01-01", 0)[:10] + f" {rng.randrange(24):02d}:{rng.randrange(60):02d}:00" for _ in range(8))
        moments += [days_after("2009-01-01", rng.randrange(300)) for _ in range(12)]
        moments += moments[:3]
        data += [(c, f"{c}-{i}", m, 1, 1.0, "X") for i, m in enumerate(moments)]
        t = np.sort(np.array([np.datetime64(m) for m in moments]))
        x = (t - t[0]) / np.timedelta64(1, "us") / 86400e6
        want[c] = np.polyfit(x, np.arange(1, len(x) + 1), 1)[0]
    got = rows(X.invoice_count_slope(lines(data), {"s": SNAPSHOT}))
    for c, slope in want.items():
        assert got[c]["txn_count_slope"] == pytest.approx(slope, rel=1e-9)


@pytest.mark.parametrize("fn", [X.rfm, X.rolling_features, X.lifetime_features, X.trend_features])
def test_feature_functions_refuse_future_rows(lines, fn):
    with pytest.raises(Exception, match="after the snapshot"):
        fn(lines(CANONICAL + [FUTURE]), SNAPSHOT).collect()


def test_missing_columns_are_listed(canonical):
    with pytest.raises(ValueError, match="invoice_date.*unit_price"):
        X.rfm(canonical.drop("invoice_date", "unit_price"), SNAPSHOT)


def test_future_rows_leave_the_matrix_unchanged(lines, canonical):
    more = lines(CANONICAL + [FUTURE, (9, "N", "2010-06-02", 1, 1.0, "Q")])
    a, b = X.build_features(canonical, SNAPSHOT), X.build_features(more, SNAPSHOT)
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.columns == ["customer_id", *FEATURES]


def test_matrix_equals_its_four_parts(canonical, rows):
    whole = rows(X.build_features(canonical, SNAPSHOT))
    parts = [f(canonical, SNAPSHOT) for f in (X.rfm, X.rolling_features, X.lifetime_features, X.trend_features)]
    merged = rows(X.merge_on_customer(parts).select("customer_id", *FEATURES))
    assert whole.keys() == merged.keys()
    for c, row in whole.items():
        assert row == {k: (pytest.approx(v) if isinstance(v, float) else v) for k, v in merged[c].items()}


def test_late_and_absent_customers(lines, rows):
    late = lines([(1, "A", "2010-04-01", 1, 1, "X"), (2, "B", "2010-04-01", 1, 1, "X"), (4, "C", "2011-01-01", 1, 1, "X"),
                  (None, "D", "2010-04-01", 1, 1, "X"), (1, "E", None, 5, 5, "X")])
    got = rows(X.build_features(late, SNAPSHOT))
    assert set(got) == {1, 2} and got[1]["recency_days"] == 61 and got[1]["monetary"] == 1.0
    assert X.build_features(late.limit(0), SNAPSHOT).count() == 0


def test_merge(spark, rows):
    a = spark.createDataFrame([(1, 10), (2, 20)], "customer_id long, x int")
    b = spark.createDataFrame([(2, 200), (3, 300)], "customer_id long, y int")
    got = rows(X.merge_on_customer([a, b]))
    assert got[1]["y"] is None and got[3]["x"] is None and got[2]["y"] == 200
    with pytest.raises(ValueError):
        X.merge_on_customer([])
    with pytest.raises(ValueError):
        X.merge_on_customer([a, b.drop("customer_id")])


@pytest.mark.parametrize("partitions", ["1", "7", "17"])
def test_result_does_not_depend_on_partitioning(spark, lines, canonical, partitions):
    want = sorted(X.build_features(canonical, SNAPSHOT).collect())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        shuffled = lines(random.Random(5).sample(CANONICAL, len(CANONICAL))).repartition(5)
        got = sorted(X.build_features(shuffled, SNAPSHOT).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [tuple(pytest.approx(v) if isinstance(v, float) else v for v in r) for r in want] == [tuple(r) for r in got]


def test_frequency_grows_with_the_snapshot(canonical):
    got = X.features_at(canonical, {"a": "2010-04-01", "b": "2010-05-01", "c": SNAPSHOT})
    by = got.groupBy("customer_id").pivot("split", ["a", "b", "c"]).agg(F.first("frequency")).collect()
    assert all((r["a"] or 0) <= (r["b"] or 0) <= r["c"] for r in by)


# --- guards and labels ---------------------------------------------------------------


def test_guards(lines, canonical):
    guards.assert_no_future_rows(canonical, "2010-05-28")
    with pytest.raises(guards.LeakageError, match="2011-01-01"):
        guards.assert_no_future_rows(lines(CANONICAL + [FUTURE]), SNAPSHOT)
    guards.assert_no_future_rows(lines([(1, "A", None, 1, 1, "X")]), SNAPSHOT)
    guards.assert_future_window(lines(CANONICAL + [FUTURE]), SNAPSHOT, 90)
    with pytest.raises(guards.CensoringError):
        guards.assert_future_window(canonical, SNAPSHOT, 90)
    with pytest.raises(guards.CensoringError):
        guards.assert_future_window(canonical.limit(0), SNAPSHOT, 90)


AFTER = [
    (1, "N1", days_after(SNAPSHOT, 12), 2, 3.5, "P"),
    (3, "N2", days_after(SNAPSHOT, 61), 1, 18.0, "S"),
    (3, "N3", days_after(SNAPSHOT, 150), 4, 2.0, "S"),
]


def test_labels_by_hand(lines, rows):
    got = rows(labels.build_labels(lines(CANONICAL + AFTER), SNAPSHOT))
    assert {c: r["churn"] for c, r in got.items()} == {1: 0, 2: 1, 3: 0}
    assert {c: r["clv"] for c, r in got.items()} == {1: 7.0, 2: 0.0, 3: 18.0}


def test_label_edges(lines, canonical, rows):
    with pytest.raises(guards.CensoringError, match="insufficient future data"):
        labels.build_labels(canonical, SNAPSHOT)
    with_new = lines(CANONICAL + [(4, "Z1", days_after(SNAPSHOT, 90), 1, 1.0, "X")])
    got = rows(labels.build_labels(with_new, SNAPSHOT))
    assert set(got) == {1, 2, 3} and all(r["churn"] == 1 and r["clv"] == 0 for r in got.values())
    only_new = lines([(99, "Z", days_after(SNAPSHOT, 5), 1, 1.0, "X")])
    assert labels.build_labels(only_new, SNAPSHOT).count() == 0
    for w in (0, -1):
        with pytest.raises(ValueError):
            labels.build_labels(canonical, SNAPSHOT, churn_days=w)
        with pytest.raises(ValueError):
            labels.build_labels(canonical, SNAPSHOT, value_days=w)


def test_revenue_without_invoice_is_churn_with_value(lines, rows):
    got = rows(labels.build_labels(lines(CANONICAL + [(2, None, days_after(SNAPSHOT, 90), 2, 3.0, "X")]), SNAPSHOT))
    assert got[2]["churn"] == 1 and got[2]["clv"] == 6.0


def test_splits_equal_single_features_and_labels(lines):
    history = lines(CANONICAL + AFTER)
    snaps = {"train": "2010-03-05", "val": "2010-04-01", "test": SNAPSHOT}
    got = splits.build_time_splits(history, snaps, churn_days=20, value_days=90)
    for name, snap in snaps.items():
        want = splits.join_labels(X.build_features(history, snap), labels.build_labels(history, snap, 20, 90))
        part = got.where(F.col("split") == name).drop("split", "snapshot")
        assert part.columns == want.columns
        for a, b in zip(sorted(part.collect()), sorted(want.collect()), strict=True):
            assert a.asDict() == {k: (pytest.approx(v) if isinstance(v, float) else v) for k, v in b.asDict().items()}
    with pytest.raises(ValueError):
        splits.build_time_splits(history, {"train": "2010-03-05"})


def test_xy_and_concat(spark):
    pair = spark.createDataFrame(
        [(1, 1.0, 2.0, 0, 50.0), (2, 1.0, 2.0, 1, 0.0), (3, 1.0, 2.0, 0, 75.0), (4, 1.0, 2.0, None, None)],
        "customer_id long, recency_days double, monetary double, churn int, clv double",
    )
    xy = splits.prepare_xy(pair, "churn", ["recency_days", "monetary"])
    assert xy.count() == 3 and xy.columns == ["recency_days", "monetary", "label"] and dict(xy.dtypes)["label"] == "int"
    assert [r["label"] for r in splits.prepare_xy(pair, "clv", ["monetary"]).collect()] == [50.0, 0.0, 75.0]
    with pytest.raises(ValueError):
        splits.prepare_xy(pair, "segment")


def test_folds(spark):
    df = spark.range(40).select(F.col("id").alias("customer_id"), (F.col("id") % 2).cast("int").alias("label"))
    folds = splits.forward_folds(df.repartition(6), 4)
    for i, n in zip(range(1, 5), (8, 16, 24, 32)):
        assert splits.train_part(folds, i).count() == n and splits.val_part(folds, i).count() == 8
        edge = splits.train_part(folds, i).agg(F.max("customer_id")).first()[0]
        assert edge < splits.val_part(folds, i).agg(F.min("customer_id")).first()[0]
    one_class = folds.withColumn("label", F.when(F.col("customer_id") < 12, 0).otherwise(F.col("label")))
    assert splits.usable_folds(one_class, 4) == [2, 3, 4]
    with pytest.raises(ValueError):
        splits.usable_folds(folds.withColumn("label", F.lit(1)), 4)


def test_matrix_is_the_same_for_busy_customers_and_shuffles_narrow_rows_once(lines, monkeypatch):
    data = [
        (c, None if i % 7 == 0 else f"I{c}-{i // 2}", None if i == 5 else f"2010-0{1 + i % 6}-{1 + i % 28:02d} 0{i % 10}:00:00", None if i % 11 == 0 else i, 1.5 * (c or 1), f"S{i % 4}")
        for c, n in ((1, 40), (2, 6), (3, 1), (None, 3)) for i in range(n)
    ]
    some, snapshots = lines(data), {"a": "2010-03-15", "b": "2010-05-01"}

    def matrix():
        return {k: sorted(str(round(v, 9) if isinstance(v, float) else v) for v in r.values()) for k, r in keyed(X.features_at(some, snapshots, label_days=(30, 30))).items()}

    def keyed(df):
        return {(r["split"], r["customer_id"]): r.asDict() for r in df.collect()}

    whole = matrix()
    assert whole and {c for _, c in whole} <= {1, 2, 3}
    monkeypatch.setattr(X, "PART_LINES", 10)
    plan = X.features_at(some, snapshots, label_days=(30, 30))._jdf.queryExecution().executedPlan().toString()
    # Invoices, slopes and products: nothing is shuffled after the copies for snapshots and windows are made.
    assert plan.count("Exchange hashpartitioning(customer_id") == plan.count("Exchange hashpartitioning") == 3, plan
    assert matrix() == whole
    monkeypatch.setattr(X, "BUSY", 10)
    assert matrix() == whole


def test_lines_are_joined_once_and_not_shuffled_by_customer(spark, tmp_path):
    from ebbline.plans.testviews import txn

    tables = {
        "lineitem": ("l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double", [(1, 5, 2.0, 6.0), (1, 5, 2.0, 6.0), (2, 6, 1.0, 4.0), (3, 7, 1.0, 1.0), (None, 7, 1.0, 1.0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz", [(1, 10, None), (2, 11, None), (3, 99, None), (4, None, None)]),
        "customer": ("c_custkey long, c_nationkey long", [(10, 1), (10, 2), (11, None), (None, 1)]),
        "nation": ("n_nationkey long, n_name string", [(1, "A"), (2, "B")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = txn(spark, str(tmp_path), country=True)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["customer_id"], r["invoice_id"], r["unit_price"], r["country"]) for r in df.collect()) == [
            (10, "1", 3.0, "A"), (10, "1", 3.0, "A"), (10, "1", 3.0, "B"), (10, "1", 3.0, "B"),
        ]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # The last join is that of the lines, so nothing shuffles them for another.
    assert "l_orderkey" in next(line for line in plan.splitlines() if "SortMergeJoin" in line)
