"""Registered queries: sources, cleaning, guards, features, labels and splits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.dates import day_diff, frac_days, in_window, ts
from ebbline.functions.numbers import revenue
from ebbline.operators import cleaning, features, guards, labels, splits
from ebbline.plans import oracle as O
from ebbline.plans.registry import query, r, rounded
from ebbline.plans.testviews import (
    EVENT_SNAPSHOT,
    EVENT_WINDOWS,
    SNAPSHOTS,
    table,
    txn,
    txn_dirty,
    txn_events,
)
from ebbline.schema import (
    FEATURES,
    LIFETIME_FEATURES,
    RFM_FEATURES,
    TREND_FEATURES,
    feature_columns,
    rename_to_canonical,
    window_features,
)
from ebbline.session import work_dir
from ebbline.sources import readers, sinks

TEST = SNAPSHOTS["test"]
S = O.moment(TEST)
SOURCE_NAMES = {
    "customer_id": "Customer ID",
    "invoice_id": "Invoice",
    "invoice_date": "InvoiceDate",
    "quantity": "Quantity",
    "unit_price": "Price",
    "country": "Country",
}


def source_named(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(s) for c, s in SOURCE_NAMES.items()])


def past(df: DataFrame, snapshot: str = TEST) -> DataFrame:
    return df.where(F.col("invoice_date") <= ts(snapshot))


# --- sources and sinks -------------------------------------------------------


@query(
    "src_csv",
    O.with_views(
        f"""SELECT customer_id, count(*) AS n_rows, min(invoice_date) AS first_date,
  {r('sum(quantity)', 'quantity')}, {r('sum(quantity * unit_price)', 'revenue', 2)},
  min('The "' || country || '", trade' || chr(10) || 'only') AS country
FROM txn_ship GROUP BY 1""",
        "txn_ship",
    ),
)
def src_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Written and read as CSV; the country has quotes, a comma and a line break around it."""
    path = f"{work_dir(spark)}/csv-{uuid.uuid4().hex}"
    odd = F.concat(F.lit('The "'), "country", F.lit('", trade\nonly'))
    sinks.write_result(source_named(txn(spark, sf, "l_shipdate", country=True).withColumn("country", odd)), path, "csv")
    lines = readers.load_transactions(spark, path, "csv", SOURCE_NAMES)
    return rounded(
        lines.groupBy("customer_id").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("invoice_date").alias("first_date"),
            F.sum("quantity").alias("quantity"),
            F.sum(revenue()).alias("revenue"),
            F.min("country").alias("country"),
        ),
        {"revenue": 2},
    )


@query(
    "src_parquet",
    f"""SELECT l_orderkey, count(*) AS n_rows, {r('sum(l_extendedprice)', 'price')},
  max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1""",
)
def src_parquet(spark: SparkSession, sf: str) -> DataFrame:
    lines = readers.read_part(spark, f"{sf}/lineitem.parquet", "parquet")
    return rounded(
        lines.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("l_extendedprice").alias("price"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )


@query(
    "src_parts",
    O.with_views(
        f"""SELECT customer_id, count(*) AS n_rows, {r('sum(quantity)', 'quantity')}
FROM (SELECT * FROM txn UNION ALL SELECT * FROM txn_ship) GROUP BY 1""",
        "txn", "txn_ship",
    ),
)
def src_parts(spark: SparkSession, sf: str) -> DataFrame:
    first = txn(spark, sf, country=True)
    second = txn(spark, sf, "l_shipdate", country=True).select(*reversed(first.columns))
    both = readers.union_parts([first, second])
    return rounded(
        both.groupBy("customer_id").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("quantity")
        )
    )


@query(
    "src_coerce",
    O.with_views(
        f"""SELECT CASE WHEN CAST(invoice_id AS BIGINT) % 97 <> 0 AND CAST(invoice_id AS BIGINT) % 91 <> 0 THEN customer_id END AS customer_id,
  invoice_id, CASE WHEN CAST(invoice_id AS BIGINT) % 53 <> 0 THEN invoice_date END AS invoice_date,
  CASE WHEN CAST(stock_code AS BIGINT) % 41 <> 0 AND CAST(stock_code AS BIGINT) % 37 <> 0 THEN quantity END AS quantity,
  {r('CASE WHEN CAST(stock_code AS BIGINT) % 89 <> 0 AND CAST(stock_code AS BIGINT) % 83 <> 0 THEN unit_price END', 'unit_price')}
FROM txn""",
        "txn",
    ),
)
def src_coerce(spark: SparkSession, sf: str) -> DataFrame:
    lines = txn(spark, sf)
    order, part = F.col("invoice_id").cast("bigint"), F.col("stock_code").cast("bigint")
    raw = lines.select(
        F.when(order % 97 == 0, "unknown").when(order % 91 == 0, F.concat("customer_id", F.lit(".7")))
        .otherwise(F.col("customer_id").cast("double").cast("string")).alias("customer_id"),
        "invoice_id",
        F.when(order % 53 == 0, "not-a-date").when(order % 2 == 0, F.date_format("invoice_date", "M/d/yyyy H:mm:ss"))
        .otherwise(F.col("invoice_date").cast("string")).alias("invoice_date"),
        F.when(part % 41 == 0, "many").when(part % 37 == 0, "NaN").otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.when(part % 89 == 0, "").when(part % 83 == 0, "-Infinity").otherwise(F.col("unit_price").cast("string")).alias("unit_price"),
    )
    typed = readers.coerce_types(raw)
    return typed.withColumn("unit_price", F.round(F.col("unit_price") + F.lit(0.00000033), 4))


@query(
    "src_rename",
    O.with_views(
        f"""SELECT customer_id, invoice_id, invoice_date, quantity, {r('unit_price')}, country, stock_code
FROM txn""",
        "txn",
    ),
)
def src_rename(spark: SparkSession, sf: str) -> DataFrame:
    lines = txn(spark, sf, country=True)
    named = lines.select(*[F.col(c).alias(s) for c, s in SOURCE_NAMES.items()], "stock_code")
    return rounded(rename_to_canonical(named, SOURCE_NAMES))


@query(
    "src_nonnull",
    O.with_views(
        " UNION ALL ".join(
            f'SELECT \'{c}\' AS "column", count({c}) AS non_null FROM txn_dirty'
            for c in ["customer_id", "invoice_id", "invoice_date", "quantity", "unit_price", "country"]
        ),
        "txn_dirty",
    ),
)
def src_nonnull(spark: SparkSession, sf: str) -> DataFrame:
    return readers.non_null_counts(txn_dirty(spark, sf), list(SOURCE_NAMES))


@query(
    "src_partprofile",
    O.with_views(
        """SELECT 'orders' AS part, count(*) AS n_rows, min(invoice_date) AS min_date, max(invoice_date) AS max_date FROM txn
UNION ALL SELECT 'ship', count(*), min(invoice_date), max(invoice_date) FROM txn_ship""",
        "txn", "txn_ship",
    ),
)
def src_partprofile(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        txn(spark, sf, d).withColumn("part", F.lit(n)) for d, n in [("o_orderdate", "orders"), ("l_shipdate", "ship")]
    ]
    return readers.part_profile(readers.union_parts(parts))


@query(
    "snk_table",
    f"""SELECT l_orderkey, l_linenumber, l_quantity, {r('l_extendedprice')} FROM lineitem""",
)
def snk_table(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{work_dir(spark)}/result-{uuid.uuid4().hex}"
    wanted = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    sinks.write_result(wanted, path, "csv")
    return rounded(spark.read.schema(wanted.schema).option("header", True).csv(path))


def _yearly_metrics(spark: SparkSession, sf: str) -> str:
    """Runs of simple metrics, one per year of orders, the first one twice; returns the table's path."""
    path = f"{work_dir(spark)}/metrics-{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders")
    years = sorted(r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect())
    for year in [years[0], *years]:
        metrics = (
            orders.where(F.year("o_orderdate") == year)
            .groupBy(F.col("o_orderpriority").alias("model"))
            .agg(F.avg("o_totalprice").alias("value"))
            .select("model", F.lit("avg_price").alias("metric"), "value")
        )
        sinks.append_metrics(metrics, f"run{year}", f"{year}-12-31", path)
    return path


_RUNS_SQL = f"""SELECT o_orderpriority AS model, 'avg_price' AS metric, {r('avg(o_totalprice)', 'value', 3)},
  make_timestamp(CAST(year(o_orderdate) AS BIGINT), 12, 31, 0, 0, 0.0) AS run_ts, 'run' || year(o_orderdate) AS run_id
FROM orders {{}} GROUP BY o_orderpriority, year(o_orderdate)"""


@query("snk_metrics", _RUNS_SQL.format(""))
def snk_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(spark.read.parquet(_yearly_metrics(spark, sf)), {"value": 3})


@query("src_latestrun", _RUNS_SQL.format("WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)"))
def src_latestrun(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(readers.latest_run(spark.read.parquet(_yearly_metrics(spark, sf))), {"value": 3})


# --- cleaning ----------------------------------------------------------------

_LINE = f"customer_id, invoice_id, invoice_date, quantity, {r('unit_price')}, stock_code, country"


@query("cln_missing", O.with_views(f"SELECT {_LINE} FROM txn_dirty WHERE customer_id IS NOT NULL", "txn_dirty"))
def cln_missing(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.drop_missing_customer(txn_dirty(spark, sf)))


@query("cln_dedup", O.with_views(f"SELECT {_LINE} FROM (SELECT DISTINCT * FROM txn_dirty)", "txn_dirty"))
def cln_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.drop_duplicate_rows(txn_dirty(spark, sf)))


@query("cln_negqty", O.with_views(f"SELECT {_LINE} FROM txn_dirty WHERE quantity >= 0", "txn_dirty"))
def cln_negqty(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.keep_non_negative_quantity(txn_dirty(spark, sf)))


@query("cln_price", O.with_views(f"SELECT {_LINE} FROM txn_dirty WHERE unit_price > 0", "txn_dirty"))
def cln_price(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.keep_positive_price(txn_dirty(spark, sf)))


def _fence(fit: str, column: str) -> str:
    q1, q3 = f"quantile_cont({column}, 0.25)", f"quantile_cont({column}, 0.75)"
    return (
        f"(SELECT {q1} - 1.5 * ({q3} - {q1}) AS {column}_lo, {q3} + 1.5 * ({q3} - {q1}) AS {column}_hi FROM {fit})"
    )


def _iqr_sql(source: str, fit: str) -> str:
    return f"""SELECT {_LINE} FROM {source}, {_fence(fit, 'quantity')}, {_fence(fit, 'unit_price')}
WHERE (quantity IS NULL OR quantity BETWEEN quantity_lo AND quantity_hi)
  AND (unit_price IS NULL OR unit_price BETWEEN unit_price_lo AND unit_price_hi)"""


@query("cln_iqr", O.with_views(_iqr_sql("txn_dirty", "txn_dirty"), "txn_dirty"))
def cln_iqr(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.remove_outliers(txn_dirty(spark, sf)))


_MEASURES = ("quantity", "unit_price")


@query(
    "cln_zscore",
    O.with_views(
        f"SELECT {_LINE} FROM dirty, stats WHERE " + " AND ".join(f"({c} IS NULL OR abs(({c} - m_{c}) / s_{c}) <= 3)" for c in _MEASURES),
        "txn_dirty",
        ctes="dirty AS MATERIALIZED (SELECT * FROM txn_dirty), stats AS (SELECT "
        + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _MEASURES) + " FROM dirty)",
    ),
)
def cln_zscore(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.remove_outliers(txn_dirty(spark, sf), method="zscore"))


@query(
    "cln_fitapply",
    O.with_views(
        _iqr_sql("txn_dirty", "fit"), "txn_dirty",
        ctes=f"fit AS (SELECT * FROM txn_dirty WHERE invoice_date <= {O.moment(SNAPSHOTS['train'])})",
    ),
)
def cln_fitapply(spark: SparkSession, sf: str) -> DataFrame:
    dirty = txn_dirty(spark, sf)
    fences = cleaning.fit_fences(past(dirty, SNAPSHOTS["train"]))
    return rounded(fences.apply(dirty))


_RULED = """ruled AS (SELECT DISTINCT * FROM txn_dirty
  WHERE customer_id IS NOT NULL AND quantity >= 0 AND unit_price > 0)"""
_FIT = f"fit AS (SELECT * FROM ruled WHERE invoice_date <= {O.moment(SNAPSHOTS['train'])})"


@query("cln_pipe", O.with_views(_iqr_sql("ruled", "fit"), "txn_dirty", ctes=f"{_RULED}, {_FIT}"))
def cln_pipe(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cleaning.clean(txn_dirty(spark, sf), SNAPSHOTS["train"]))


def _audit_sql() -> str:
    steps = ["missing_customer", "duplicates", "negative_quantity", "zero_price", "outliers"]
    tables = ["txn_dirty", "a1", "a2", "a3", "a4", "a5"]
    ctes = f"""a1 AS (SELECT * FROM txn_dirty WHERE customer_id IS NOT NULL),
a2 AS (SELECT DISTINCT * FROM a1), a3 AS (SELECT * FROM a2 WHERE quantity >= 0),
a4 AS (SELECT * FROM a3 WHERE unit_price > 0),
fit AS (SELECT * FROM a4 WHERE invoice_date <= {O.moment(SNAPSHOTS['train'])}),
a5 AS ({_iqr_sql('a4', 'fit')})"""
    rows = []
    for i, step in enumerate(steps):
        before, after = (f"(SELECT count(*) FROM {t})" for t in tables[i : i + 2])
        rows.append(
            f"SELECT {i + 1} AS step_no, '{step}' AS step, {before} AS rows_before, {after} AS rows_after, "
            f"{before} - {after} AS rows_dropped"
        )
    return O.with_views(" UNION ALL ".join(rows), "txn_dirty", ctes=ctes)


@query("cln_audit", _audit_sql())
def cln_audit(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.cleaning_audit(txn_dirty(spark, sf), SNAPSHOTS["train"])


# --- guards and data quality ---------------------------------------------------


@query(
    "grd_nofuture",
    O.with_views(
        f"SELECT count(*) FILTER (WHERE invoice_date > {S}) AS offenders, max(invoice_date) AS latest FROM txn_ship",
        "txn_ship",
    ),
)
def grd_nofuture(spark: SparkSession, sf: str) -> DataFrame:
    return guards.future_offenders(txn(spark, sf, "l_shipdate"), TEST)


_GUARDED = {**SNAPSHOTS, "late": "2001-07-01"}


@query(
    "grd_futurewin",
    O.with_views(
        " UNION ALL ".join(
            f"SELECT '{n}' AS split, {O.moment(s)} AS snapshot, {O.moment(s)} + INTERVAL 90 DAY AS needed, "
            f"max(invoice_date) AS latest, max(invoice_date) >= {O.moment(s)} + INTERVAL 90 DAY AS sufficient FROM txn"
            for n, s in _GUARDED.items()
        ),
        "txn",
    ),
)
def grd_futurewin(spark: SparkSession, sf: str) -> DataFrame:
    return guards.future_window_report(txn(spark, sf), _GUARDED, 90)


@query(
    "dq_clean",
    O.with_views(
        """SELECT 'dirty' AS stage, count(*) AS n_rows, count(*) FILTER (WHERE customer_id IS NULL) AS missing_customer,
  count(*) FILTER (WHERE NOT quantity >= 0) AS bad_quantity, count(*) FILTER (WHERE NOT unit_price > 0) AS bad_price
FROM txn_dirty UNION ALL SELECT 'clean', count(*), 0, 0, 0 FROM ruled""",
        "txn_dirty", ctes=_RULED,
    ),
)
def dq_clean(spark: SparkSession, sf: str) -> DataFrame:
    dirty = txn_dirty(spark, sf)
    reports = [("dirty", dirty), ("clean", cleaning.apply_rules(dirty))]
    parts = [guards.clean_violations(df).select(F.lit(n).alias("stage"), "*") for n, df in reports]
    return parts[0].unionByName(parts[1])


@query(
    "dq_nullshare",
    O.with_views(
        " UNION ALL ".join(
            f"SELECT '{f}' AS feature, {r(f'avg(CASE WHEN {f} IS NULL THEN 1.0 ELSE 0.0 END)', 'null_share', 6)}, "
            f"avg(CASE WHEN {f} IS NULL THEN 1.0 ELSE 0.0 END) > 0.5 AS suspicious FROM features"
            for f in FEATURES
        ),
        "txn", ctes=O.feature_ctes("txn", TEST),
    ),
)
def dq_nullshare(spark: SparkSession, sf: str) -> DataFrame:
    matrix = features.build_features(txn(spark, sf), TEST)
    return rounded(guards.null_shares(matrix, FEATURES), {"null_share": 6})


@query(
    "dq_ranges",
    O.with_views(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {r(f'min({c})', 'min_value')}, {r(f'max({c})', 'max_value')}, "
            f"count(*) FILTER (WHERE NOT ({rule})) AS violations FROM joined"
            for c, rule in [("recency_days", "recency_days >= 0"), ("monetary", "monetary > 0"), ("churn", "churn IN (0, 1)")]
        ),
        "txn",
        ctes=O.feature_ctes("txn", TEST) + ",\n" + O.label_cte("txn", TEST)
        + ",\njoined AS (SELECT * FROM features LEFT JOIN labels0 USING (customer_id))",
    ),
)
def dq_ranges(spark: SparkSession, sf: str) -> DataFrame:
    lines = txn(spark, sf)
    joined = splits.join_labels(features.rfm(past(lines), TEST), labels.build_labels(lines, TEST))
    return rounded(guards.range_report(joined, guards.standard_ranges()))


@query(
    "dq_churnband",
    O.on_splits(
        f"""SELECT split, count(churn) AS labeled, {r('avg(churn)', 'churn_rate', 6)},
  avg(churn) < 0.05 OR avg(churn) > 0.95 AS suspicious FROM splits GROUP BY 1"""
    ),
)
def dq_churnband(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(guards.churn_band(labels.labels_at(txn(spark, sf), SNAPSHOTS)), {"churn_rate": 6})


# --- derived columns -----------------------------------------------------------


@query(
    "prj_revenue",
    O.with_views(f"SELECT invoice_id, stock_code, {r('quantity * unit_price', 'revenue')} FROM txn", "txn"),
)
def prj_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(txn(spark, sf).select("invoice_id", "stock_code", revenue().alias("revenue")))


_EV = O.moment(EVENT_SNAPSHOT)


@query(
    "prj_daydiff",
    O.with_views(
        f"SELECT invoice_id, {O.floor_days('invoice_date', _EV)} AS days FROM txn_events",
        "txn_events",
    ),
)
def prj_daydiff(spark: SparkSession, sf: str) -> DataFrame:
    events = txn_events(spark, sf)
    return events.select("invoice_id", day_diff(F.col("invoice_date"), ts(EVENT_SNAPSHOT)).alias("days"))


@query(
    "prj_fracdays",
    O.with_views(
        f"SELECT invoice_id, {r(O.days('invoice_date', _EV), 'days', 6)} FROM txn_events", "txn_events"
    ),
)
def prj_fracdays(spark: SparkSession, sf: str) -> DataFrame:
    days = frac_days(F.col("invoice_date"), ts(EVENT_SNAPSHOT)).alias("days")
    return rounded(txn_events(spark, sf).select("invoice_id", days), {"days": 6})


@query(
    "prj_cutoff",
    O.with_views(f"SELECT invoice_id, invoice_date, quantity FROM txn_ship WHERE invoice_date <= {S}", "txn_ship"),
)
def prj_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    return past(txn(spark, sf, "l_shipdate")).select("invoice_id", "invoice_date", "quantity")


@query(
    "prj_halfopen",
    O.with_views(
        f"""SELECT invoice_id, invoice_date, quantity FROM txn_ship
WHERE invoice_date > {S} - INTERVAL 90 DAY AND invoice_date <= {S}""",
        "txn_ship",
    ),
)
def prj_halfopen(spark: SparkSession, sf: str) -> DataFrame:
    lines = txn(spark, sf, "l_shipdate").where(in_window(F.col("invoice_date"), ts(TEST), 90))
    return lines.select("invoice_id", "invoice_date", "quantity")


@query(
    "prj_dropalign",
    O.with_views(f"SELECT {O.feature_select(FEATURES)} FROM features", "txn", ctes=O.feature_ctes("txn", TEST)),
)
def prj_dropalign(spark: SparkSession, sf: str) -> DataFrame:
    lines = txn(spark, sf)
    joined = splits.join_labels(features.build_features(lines, TEST), labels.build_labels(lines, TEST))
    return rounded(splits.align_columns(joined), O.FEATURE_DIGITS)


# --- features --------------------------------------------------------------------


def _feature_sql(view: str, names: list[str], snap: str = TEST, windows=(30, 60, 90)) -> str:
    return O.with_views(
        f"SELECT customer_id, {O.feature_select(names)} FROM features", view,
        ctes=O.feature_ctes(view, snap, windows),
    )


@query("agg_rfm", _feature_sql("txn", RFM_FEATURES))
def agg_rfm(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.rfm(past(txn(spark, sf)), TEST))


@query(
    "agg_invoice",
    O.with_views(
        f"""SELECT customer_id, invoice_id, min(invoice_date) AS first_date, max(invoice_date) AS last_date,
  {r('sum(quantity * unit_price)', 'revenue')}, {r('sum(quantity)', 'quantity')}, count(*) AS n_lines
FROM txn_ship WHERE invoice_date <= {S} GROUP BY 1, 2""",
        "txn_ship",
    ),
)
def agg_invoice(spark: SparkSession, sf: str) -> DataFrame:
    lines = past(txn(spark, sf, "l_shipdate")).withColumn("snapshot", ts(TEST))
    return rounded(features.invoice_rollup(lines, []).drop("snapshot"))


_INVOICE_WINDOW = [f"{stem}_{w}d" for w in (30, 60, 90) for stem in ("invoice_count", "spend", "avg_spend", "spend_std")]
_LINE_WINDOW = [f"{stem}_{w}d" for w in (30, 60, 90) for stem in ("txn_count", "avg_basket")]


@query("agg_roll_inv", _feature_sql("txn_ship", _INVOICE_WINDOW))
def agg_roll_inv(spark: SparkSession, sf: str) -> DataFrame:
    rolled = features.rolling_features(past(txn(spark, sf, "l_shipdate")), TEST)
    return rounded(rolled.select("customer_id", *_INVOICE_WINDOW))


@query("agg_roll_txn", _feature_sql("txn_ship", _LINE_WINDOW))
def agg_roll_txn(spark: SparkSession, sf: str) -> DataFrame:
    rolled = features.rolling_features(past(txn(spark, sf, "l_shipdate")), TEST)
    return rounded(rolled.select("customer_id", *_LINE_WINDOW))


@query(
    "agg_roll_anchor",
    O.with_views(
        f"""SELECT customer_id, {O.feature_select(window_features(EVENT_WINDOWS))} FROM features
WHERE invoice_count_7d IS NULL""",
        "txn_events", ctes=O.feature_ctes("txn_events", EVENT_SNAPSHOT, EVENT_WINDOWS),
    ),
)
def agg_roll_anchor(spark: SparkSession, sf: str) -> DataFrame:
    events = past(txn_events(spark, sf), EVENT_SNAPSHOT)
    rolled = features.rolling_features(events, EVENT_SNAPSHOT, EVENT_WINDOWS)
    return rounded(rolled.where(F.col("invoice_count_7d").isNull()))


@query("agg_lifetime", _feature_sql("txn_ship", LIFETIME_FEATURES))
def agg_lifetime(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.lifetime_features(past(txn(spark, sf, "l_shipdate")), TEST))


@query("agg_products", _feature_sql("txn", ["distinct_products"]))
def agg_products(spark: SparkSession, sf: str) -> DataFrame:
    counted = features.distinct_products(txn(spark, sf), {"test": TEST})
    return counted.select("customer_id", "distinct_products")


@query("agg_spend_slope", _feature_sql("txn_ship", ["spend_slope"]))
def agg_spend_slope(spark: SparkSession, sf: str) -> DataFrame:
    trend = features.trend_features(past(txn(spark, sf, "l_shipdate")), TEST)
    return rounded(trend.select("customer_id", "spend_slope"), O.FEATURE_DIGITS)


@query("agg_count_slope", _feature_sql("txn_events", ["txn_count_slope"], EVENT_SNAPSHOT, EVENT_WINDOWS))
def agg_count_slope(spark: SparkSession, sf: str) -> DataFrame:
    slopes = features.invoice_count_slope(txn_events(spark, sf), {"e": EVENT_SNAPSHOT})
    return rounded(slopes.select("customer_id", "txn_count_slope"), O.FEATURE_DIGITS)


@query("agg_gap", _feature_sql("txn_ship", ["days_between_txns"]))
def agg_gap(spark: SparkSession, sf: str) -> DataFrame:
    trend = features.trend_features(past(txn(spark, sf, "l_shipdate")), TEST)
    return rounded(trend.select("customer_id", "days_between_txns"))


@query("agg_gap_lag", _feature_sql("txn_ship", ["days_between_txns"]))
def agg_gap_lag(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.mean_gap_by_lag(past(txn(spark, sf, "l_shipdate")), TEST))


@query(
    "agg_merge",
    O.with_views(
        f"""SELECT customer_id, CAST(a.frequency AS BIGINT) AS frequency, {r('a.monetary', 'monetary')},
  CAST(a.recency_days AS BIGINT) AS recency_days, CAST(b.later AS BIGINT) AS later FROM e_features a
FULL JOIN (SELECT customer_id, count(*) AS later FROM txn WHERE invoice_date > {O.moment(SNAPSHOTS['train'])} GROUP BY 1) b
USING (customer_id)""",
        "txn", ctes=O.feature_ctes("txn", SNAPSHOTS["train"], p="e_"),
    ),
)
def agg_merge(spark: SparkSession, sf: str) -> DataFrame:
    lines, snap = txn(spark, sf), SNAPSHOTS["train"]
    later = lines.where(F.col("invoice_date") > ts(snap)).groupBy("customer_id").agg(F.count(F.lit(1)).alias("later"))
    return rounded(features.merge_on_customer([features.rfm(past(lines, snap), snap), later]))


@query("agg_features", _feature_sql("txn", FEATURES))
def agg_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.build_features(txn(spark, sf), TEST), O.FEATURE_DIGITS)


@query("agg_features_ship", _feature_sql("txn_ship", FEATURES))
def agg_features_ship(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.build_features(txn(spark, sf, "l_shipdate"), TEST), O.FEATURE_DIGITS)


@query("agg_features_events", _feature_sql("txn_events", feature_columns(EVENT_WINDOWS), EVENT_SNAPSHOT, EVENT_WINDOWS))
def agg_features_events(spark: SparkSession, sf: str) -> DataFrame:
    matrix = features.build_features(txn_events(spark, sf), EVENT_SNAPSHOT, EVENT_WINDOWS)
    return rounded(matrix, O.FEATURE_DIGITS)


def cleaned_ctes() -> str:
    """CTE ``cleaned``: the dirty lines after all cleaning steps, fences fitted at the train snapshot."""
    return f"{_RULED}, {_FIT}, cleaned AS ({_iqr_sql('ruled', 'fit').replace(r('unit_price'), 'unit_price')})"


def flagship_sql() -> str:
    return O.with_views(
        f"SELECT customer_id, {O.feature_select(FEATURES)} FROM features", "txn_dirty",
        ctes=f"{cleaned_ctes()},\n{O.feature_ctes('cleaned', TEST)}",
    )


@query("clean_features", flagship_sql())
def clean_features(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: raw lines -> cleaning with train-fitted fences -> 33 features at the test snapshot."""
    cleaned = cleaning.clean(txn_dirty(spark, sf), SNAPSHOTS["train"])
    return rounded(features.build_features(cleaned, TEST), O.FEATURE_DIGITS)


# --- labels and splits -----------------------------------------------------------


def time_splits(spark: SparkSession, sf: str) -> DataFrame:
    return splits.build_time_splits(txn(spark, sf), SNAPSHOTS)


@query(
    "lbl_universe",
    O.with_views(
        f"SELECT DISTINCT customer_id FROM txn_dirty WHERE invoice_date <= {S} AND customer_id IS NOT NULL", "txn_dirty"
    ),
)
def lbl_universe(spark: SparkSession, sf: str) -> DataFrame:
    return labels.customer_universe(txn_dirty(spark, sf), TEST)


@query(
    "lbl_churn",
    O.with_views("SELECT customer_id, churn FROM labels0", "txn_ship", ctes=O.label_cte("txn_ship", TEST)),
)
def lbl_churn(spark: SparkSession, sf: str) -> DataFrame:
    return labels.build_labels(txn(spark, sf, "l_shipdate"), TEST).select("customer_id", "churn")


@query(
    "lbl_clv",
    O.with_views(
        f"SELECT customer_id, churn, {r('clv')} FROM labels0", "txn",
        ctes=O.label_cte("txn", TEST, churn_days=60, value_days=120),
    ),
)
def lbl_clv(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(labels.build_labels(txn(spark, sf), TEST, 60, 120))


@query(
    "spl_joined",
    O.with_views(
        f"SELECT customer_id, {O.feature_select(FEATURES)}, churn, {r('clv')} FROM features LEFT JOIN labels0 USING (customer_id)",
        "txn", ctes=O.feature_ctes("txn", TEST) + ",\n" + O.label_cte("txn", TEST),
    ),
)
def spl_joined(spark: SparkSession, sf: str) -> DataFrame:
    lines = txn(spark, sf)
    joined = splits.join_labels(features.build_features(lines, TEST), labels.build_labels(lines, TEST))
    return rounded(joined, O.FEATURE_DIGITS)


@query(
    "spl_time",
    O.on_splits(f"SELECT split, customer_id, {O.feature_select(FEATURES)}, churn, {r('clv')} FROM splits"),
)
def spl_time(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(time_splits(spark, sf).drop("snapshot"), O.FEATURE_DIGITS)


@query(
    "spl_summary",
    O.on_splits(
        f"""SELECT split, count(*) AS customers, CAST(33 AS BIGINT) AS features, count(churn) AS labeled,
  {r('100.0 * count(churn) / count(*)', 'label_coverage_pct')}, {r('100.0 * avg(churn)', 'churn_rate_pct')}
FROM splits GROUP BY 1"""
    ),
)
def spl_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(splits.split_summary(labels.labels_at(txn(spark, sf), SNAPSHOTS)))


@query(
    "spl_xy",
    O.on_splits(f"SELECT customer_id, {O.feature_select(FEATURES)}, churn AS label FROM splits WHERE split = 'train'"),
)
def spl_xy(spark: SparkSession, sf: str) -> DataFrame:
    train = splits.build_time_splits(txn(spark, sf), SNAPSHOTS, only=["train"])
    return rounded(splits.prepare_xy(train, keep=["customer_id"]), O.FEATURE_DIGITS)


@query(
    "spl_concat",
    O.on_splits(f"SELECT split, customer_id, {r('monetary')}, churn FROM splits WHERE split IN ('train', 'val')"),
)
def spl_concat(spark: SparkSession, sf: str) -> DataFrame:
    both = splits.concat_splits(splits.build_time_splits(txn(spark, sf), SNAPSHOTS, only=["train", "val"]))
    return rounded(both.select("split", "customer_id", "monetary", "churn"))


_FOLDS = """pos0 AS (SELECT customer_id, churn AS label, row_number() OVER (ORDER BY customer_id) - 1 AS pos,
    count(*) OVER () AS n_rows FROM train_labels0),
folds AS (SELECT *, CAST(CASE WHEN pos < n_rows - (n_rows // 6) * 5 THEN 0
    ELSE (pos - (n_rows - (n_rows // 6) * 5)) // (n_rows // 6) + 1 END AS INTEGER) AS val_fold FROM pos0)"""


@query(
    "spl_folds",
    O.with_views(
        "SELECT customer_id, label, CAST(pos AS BIGINT) AS pos, n_rows, val_fold FROM folds", "txn",
        ctes=O.label_cte("txn", SNAPSHOTS["train"], p="train_") + ",\n" + _FOLDS,
    ),
)
def spl_folds(spark: SparkSession, sf: str) -> DataFrame:
    labeled = labels.build_labels(txn(spark, sf), SNAPSHOTS["train"])
    return splits.forward_folds(labeled.select("customer_id", F.col("churn").alias("label")), 5)


@query(
    "spl_singleclass",
    O.with_views(
        """SELECT CAST(i AS INTEGER) AS fold, count(*) FILTER (WHERE val_fold < i) AS n_train,
  count(*) FILTER (WHERE val_fold = i) AS n_val, count(*) FILTER (WHERE val_fold < i AND label = 1) AS train_pos,
  count(*) FILTER (WHERE val_fold < i AND label = 0) AS train_neg,
  count(*) FILTER (WHERE val_fold < i AND label = 1) > 0 AND count(*) FILTER (WHERE val_fold < i AND label = 0) > 0 AS usable
FROM folds, range(1, 6) t(i) GROUP BY i""",
        "txn", ctes=O.label_cte("txn", SNAPSHOTS["train"], p="train_") + ",\n" + _FOLDS,
    ),
)
def spl_singleclass(spark: SparkSession, sf: str) -> DataFrame:
    return splits.fold_classes(spl_folds(spark, sf), 5)
