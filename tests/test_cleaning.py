from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbline.functions import quantiles
from ebbline.operators import cleaning, guards
from ebbline.schema import rename_to_canonical
from ebbline.sources import readers, sinks

MAPPING = {
    "customer_id": "Customer ID", "invoice_id": "Invoice", "invoice_date": "InvoiceDate",
    "quantity": "Quantity", "unit_price": "Price", "country": "Country",
}


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (1.0, "A", "2010-01-01", 10, 2.5, "UK"),
        (1.0, "B", "2010-02-01", 5, 3.0, "UK"),
        (2.0, "C", "2010-01-15", 3, 1.5, "France"),
        (None, "D", "2010-03-01", -2, 4.0, "France"),
        (3.0, "E", "2010-05-01", 0, 0.0, "Germany"),
        (4.0, "F", "2010-06-01", 8, 2.0, "USA"),
        (4.0, "F", "2010-06-01", 8, 2.0, "USA"),
        (5.0, "G", "2010-07-01", 1000, 5.0, "UK"),
    ]
    typed = [(c, i, dt.datetime.fromisoformat(d), q, p, k) for c, i, d, q, p, k in rows]
    df = spark.createDataFrame(
        typed, "`Customer ID` double, Invoice string, InvoiceDate timestamp_ntz, Quantity int, Price double, Country string"
    )
    return readers.coerce_types(rename_to_canonical(df, MAPPING))


def test_single_rules(raw):
    assert dict(raw.dtypes)["customer_id"] == "bigint"
    assert cleaning.drop_missing_customer(raw).count() == 7
    assert cleaning.drop_duplicate_rows(raw).count() == 7
    assert cleaning.keep_positive_price(raw).count() == 7
    kept = cleaning.keep_non_negative_quantity(raw)
    assert kept.count() == 7 and kept.where("quantity = 0").count() == 1


def test_pipeline_and_audit(raw):
    cleaned = cleaning.clean(raw, "2010-06-01")
    assert sorted(r["invoice_id"] for r in cleaned.collect()) == ["A", "B", "C", "F"]
    audit = {r["step"]: (r["rows_before"], r["rows_after"]) for r in cleaning.cleaning_audit(raw, "2010-06-01").collect()}
    assert audit == {
        "missing_customer": (8, 7), "duplicates": (7, 6), "negative_quantity": (6, 6), "zero_price": (6, 5), "outliers": (5, 4)
    }
    assert guards.clean_violations(cleaned).first()["bad_price"] == 0


def test_switches(raw):
    off = cleaning.CleaningRules(False, False, False, False, "none")
    assert cleaning.clean(raw, rules=off).count() == raw.count()
    with pytest.raises(ValueError):
        cleaning.clean(raw)


def values(spark, xs):
    return spark.createDataFrame([(None if x is None else float(x),) for x in xs], "x double")


def left(df):
    return sorted(r["x"] for r in df.collect() if r["x"] is not None)


def test_outlier_vectors(spark):
    assert left(cleaning.remove_outliers(values(spark, [1, 2, 3, 4, 5, 100]), ["x"])) == [1, 2, 3, 4, 5]
    z = cleaning.remove_outliers(values(spark, [*range(1, 11), 1000]), ["x"], "zscore", zscore_threshold=1.0)
    assert 1000 not in left(z)
    assert left(cleaning.remove_outliers(values(spark, [1, 2, 3, 1000]), ["x"], "none")) == [1, 2, 3, 1000]
    mixed = values(spark, [1, 2, 3, 4, 5, 500, 550, 600])
    assert left(cleaning.remove_outliers(mixed, ["x"], fit_df=mixed.where("x <= 5"))) == [1, 2, 3, 4, 5]
    assert 500 in left(cleaning.remove_outliers(mixed, ["x"]))
    assert cleaning.remove_outliers(values(spark, [1, 2, None]), ["x"]).count() == 3
    assert left(cleaning.remove_outliers(values(spark, [7, 7, 7]), ["x"], "zscore")) == [7, 7, 7]
    with pytest.raises(ValueError):
        cleaning.remove_outliers(mixed, ["x"], "other")
    assert cleaning.remove_outliers(mixed, ["absent"]).count() == 8
    assert left(cleaning.remove_outliers(mixed, ["x"], fit_df=mixed.limit(0))) == []


def test_fences_ignore_rows_after_the_train_snapshot(lines):
    early = [(i, f"E{i}", "2010-01-01", i, 1.0, "X") for i in (1, 2, 3, 4)]
    late = [(9, "L1", "2011-01-01", 5000, 1.0, "X"), (9, "L2", "2011-01-02", 6000, 1.0, "X")]
    cleaned = cleaning.clean(lines(early + late), "2010-06-01")
    assert cleaned.agg(F.max("quantity")).first()[0] == 4


@pytest.mark.parametrize("few, edges", [(quantiles.FEW, quantiles.EDGES), (5, 8), (200, 16)])
def test_quantiles_are_exact_at_any_size(spark, monkeypatch, few, edges):
    import numpy as np

    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "EDGES", edges)
    n = 20_000
    x = F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / F.lit(997.0))
    df = spark.range(n).select(x.alias("a"), F.when(F.col("id") > 5, F.lit(1.5)).alias("b"), F.lit(None).cast("double").alias("c"))
    df = df.withColumn("b", F.coalesce("b", F.lit(float("nan"))))
    probabilities = [0.0, 0.1, 0.25, 0.4, 0.5, 0.75, 0.999, 1.0]
    got = quantiles.exact_quantiles(df, ["a", "b", "c"], probabilities)
    want = np.quantile(df.select("a").toPandas()["a"], probabilities)
    assert got["a"] == pytest.approx(list(want), rel=1e-12)
    assert got["b"] == [1.5] * 8 and got["c"] == [None] * 8


def test_csv_with_quotes_separators_and_line_breaks(spark, tmp_path):
    odd = ['He said ""hi"", UK', "two\nlines", "plain"]
    rows = "".join(f'L{i},S,2,12/31/2010 10:00,1.5,123{i},"{t}"\n' for i, t in enumerate(odd))
    (tmp_path / "a.csv").write_text("Invoice,StockCode,Quantity,InvoiceDate,Price,Customer ID,Country\n" + rows)
    names = {"customer_id": "Customer ID", "invoice_id": "Invoice", "invoice_date": "InvoiceDate", "quantity": "Quantity", "unit_price": "Price", "country": "Country"}
    got = {r.customer_id: r for r in readers.load_transactions(spark, str(tmp_path / "a.csv"), "csv", names).collect()}
    assert [got[1230 + i].country for i in range(3)] == ['He said "hi", UK', "two\nlines", "plain"]
    assert all(r.quantity == 2 and r.unit_price == 1.5 and str(r.invoice_date) == "2010-12-31 10:00:00" for r in got.values())
    sinks.write_result(spark.createDataFrame([(t,) for t in odd], "t string"), str(tmp_path / "out"), "csv")
    assert {r.t for r in readers.read_part(spark, str(tmp_path / "out"), "csv").collect()} == set(odd)


def test_what_is_no_number_date_or_id_becomes_null(spark):
    rows = [
        ("12347.7", "12/31/2010 10:00", "NaN", "Infinity"), ("12347.0", "2010-12-31T10:00:00", "1e3", "-Infinity"),
        ("9007199254740993", "31/12/2010", " 4 ", "nan"), ("", "", "", ""), ("Infinity", "1/2/2011", "2", "0.5"),
    ]
    typed = readers.coerce_types(spark.createDataFrame(rows, "customer_id string, invoice_date string, quantity string, unit_price string"))
    got = [(r.customer_id, r.invoice_date and str(r.invoice_date), r.quantity, r.unit_price) for r in typed.collect()]
    assert got == [
        (None, "2010-12-31 10:00:00", None, None), (12347, "2010-12-31 10:00:00", 1000.0, None),
        (9007199254740993, None, 4.0, None), (None, None, None, None), (None, "2011-01-02 00:00:00", 2.0, 0.5),
    ]


def test_a_rerun_replaces_its_metrics(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for run, values in (("a1", [1.0]), ("b2", [5.0]), ("a1", [2.0])):
        frame = spark.createDataFrame([("m", "auc", v) for v in values], "model string, metric string, value double")
        sinks.append_metrics(frame, run, "2011-01-01", path)
        sinks.append_run_info(spark, {"run_id": run, "version": "1", "trained_at": "x", "algorithm": "y", "n_features": int(values[0])}, path + "-runs")
    assert {(r.run_id, r.value) for r in spark.read.parquet(path).collect()} == {("a1", 2.0), ("b2", 5.0)}
    assert {(r.run_id, r.n_features) for r in spark.read.json(path + "-runs").collect()} == {("a1", 2), ("b2", 5)}


def test_part_union(spark):
    a = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    assert readers.union_parts([a, a.select("b", "a").limit(1)]).count() == 3
    with pytest.raises(ValueError, match="other columns"):
        readers.union_parts([a, a.withColumnRenamed("b", "c")])


def test_csv_load(spark, tmp_path):
    text = "Invoice,StockCode,Quantity,InvoiceDate,Price,Customer ID,Country\n" \
           "A,X,2,2010-01-01 08:30:00,2.5,12345.0,UK\nB,Y,oops,not-a-date,3,,UK\n"
    (tmp_path / "a.csv").write_text(text)
    got = readers.load_transactions(spark, str(tmp_path / "a.csv"), "csv", MAPPING, {"stock_code": "StockCode", "x": "Nope"})
    first, second = sorted(got.collect(), key=lambda r: r["invoice_id"])
    assert first["customer_id"] == 12345 and first["quantity"] == 2.0 and first["invoice_date"] == dt.datetime(2010, 1, 1, 8, 30)
    assert second["customer_id"] is None and second["invoice_date"] is None and second["quantity"] is None
    assert first["stock_code"] == "X"
    with pytest.raises(ValueError, match="unknown file type"):
        readers.read_part(spark, "x", "xls")
    with pytest.raises(ValueError, match="missing required columns"):
        readers.load_transactions(spark, str(tmp_path / "a.csv"), "csv", {**MAPPING, "country": "Land"})


def test_runs(spark, tmp_path):
    path = str(tmp_path / "metrics")
    m = spark.createDataFrame([("baseline", "roc_auc", 0.7)], "model string, metric string, value double")
    sinks.append_metrics(m, "r1", "2026-01-01", path)
    sinks.append_metrics(m, "r2", "2026-02-01", path)
    stored = spark.read.parquet(path)
    assert readers.latest_run(stored).first()["run_id"] == "r2"
    assert readers.latest_run(stored, "r1").first()["run_id"] == "r1"
    with pytest.raises(LookupError):
        readers.latest_run(stored.limit(0))
    with pytest.raises(LookupError):
        readers.latest_run(stored, "r9")
