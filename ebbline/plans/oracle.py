"""SQL fragments: the views and the features, written independently of the Spark plans."""

from __future__ import annotations

from collections.abc import Sequence

from ebbline.plans.registry import r
from ebbline.plans.testviews import SNAPSHOTS
from ebbline.schema import DEFAULT_WINDOWS, feature_columns

TXN = """SELECT o_custkey AS customer_id, CAST(o_orderkey AS VARCHAR) AS invoice_id,
  {date} AS invoice_date, l_quantity AS quantity, l_extendedprice / l_quantity AS unit_price,
  CAST(l_partkey AS VARCHAR) AS stock_code, n_name AS country
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

DIRTY = """SELECT CASE WHEN CAST(invoice_id AS BIGINT) % 97 <> 0 THEN customer_id END AS customer_id,
  invoice_id, invoice_date,
  (CASE WHEN CAST(invoice_id AS BIGINT) % 53 = 0 THEN -1 ELSE 1 END)
    * (CASE WHEN CAST(stock_code AS BIGINT) % 89 = 0 THEN 1000 ELSE 1 END) * quantity AS quantity,
  CASE WHEN CAST(stock_code AS BIGINT) % 41 = 0 THEN 0.0 ELSE unit_price END AS unit_price,
  stock_code, country
FROM txn, unnest(CASE WHEN CAST(invoice_id AS BIGINT) % 31 = 0 THEN [1, 2] ELSE [1] END) AS u(c)"""

EVENTS = """SELECT user_id AS customer_id, CAST(event_id AS VARCHAR) AS invoice_id, ts AS invoice_date,
  CAST(1 AS DOUBLE) AS quantity, value AS unit_price, CAST(NULL AS VARCHAR) AS stock_code
FROM events WHERE event_type = 'purchase'"""


def with_views(body: str, *views: str, ctes: str = "") -> str:
    """Prefix ``body`` with the views it needs (``txn``, ``txn_ship``, ``txn_dirty``, ``txn_events``)."""
    parts = []
    if "txn" in views or "txn_dirty" in views:
        parts.append(f"txn AS ({TXN.format(date='o_orderdate')})")
    if "txn_ship" in views:
        parts.append(f"txn_ship AS ({TXN.format(date='l_shipdate')})")
    if "txn_dirty" in views:
        parts.append(f"txn_dirty AS ({DIRTY})")
    if "txn_events" in views:
        parts.append(f"txn_events AS ({EVENTS})")
    if ctes:
        parts.append(ctes)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def moment(value: str) -> str:
    return f"TIMESTAMP '{value if ' ' in value else value + ' 00:00:00'}'"


def days(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 86400000000.0)"


def floor_days(start: str, end: str) -> str:
    return f"CAST(floor({days(start, end)}) AS BIGINT)"


def feature_ctes(view: str, snap: str, windows: Sequence[int] = DEFAULT_WINDOWS, p: str = "") -> str:
    """CTE ``{p}features``: customer_id and all features, frame by frame and joined."""
    s = moment(snap)
    out = [
        f"{p}w AS (SELECT * FROM {view} WHERE invoice_date <= {s} AND customer_id IS NOT NULL)",
        f"""{p}inv AS (SELECT customer_id, invoice_id, min(invoice_date) AS f, max(invoice_date) AS l,
  coalesce(sum(quantity * unit_price), 0) AS rev FROM {p}w WHERE invoice_id IS NOT NULL GROUP BY 1, 2)""",
        f"""{p}life AS (SELECT customer_id, count(DISTINCT invoice_id) AS frequency,
  coalesce(sum(quantity * unit_price), 0) AS monetary, {floor_days('max(invoice_date)', s)} AS recency_days,
  count(DISTINCT invoice_id) AS total_invoices, count(invoice_id) AS total_txns,
  coalesce(sum(quantity), 0) AS total_quantity, coalesce(sum(quantity * unit_price), 0) AS total_revenue,
  {floor_days('min(invoice_date)', 'max(invoice_date)')} AS tenure_days,
  {floor_days('min(invoice_date)', s)} AS first_purchase_days,
  sum(quantity * unit_price) / nullif(count(DISTINCT invoice_id), 0) AS avg_order_value,
  sum(quantity) / nullif(count(invoice_id), 0) AS avg_basket_size,
  count(DISTINCT stock_code) AS distinct_products FROM {p}w GROUP BY 1)""",
    ]
    for w in windows:
        lower = f"{s} - INTERVAL {w} DAY"
        out += [
            f"""{p}i{w} AS (SELECT customer_id, count(*) AS invoice_count_{w}d, sum(rev) AS spend_{w}d,
  avg(rev) AS avg_spend_{w}d, CASE WHEN count(*) > 1 THEN stddev_samp(rev) END AS spend_std_{w}d
  FROM {p}inv WHERE l > {lower} AND l <= {s} GROUP BY 1)""",
            f"""{p}t{w} AS (SELECT customer_id, count(invoice_id) AS txn_count_{w}d, avg(quantity) AS avg_basket_{w}d
  FROM {p}w WHERE invoice_date > {lower} GROUP BY 1)""",
        ]
    out.append(
        f"""{p}x AS (SELECT customer_id, rev, {days(f"min(f) OVER (PARTITION BY customer_id)", 'f')} AS x,
  CAST(row_number() OVER (PARTITION BY customer_id ORDER BY f, invoice_id) AS DOUBLE) AS rn FROM {p}inv)"""
    )
    out.append(
        f"""{p}trend AS (SELECT customer_id,
  CASE WHEN min(x) < max(x) THEN regr_slope(rev, x) END AS spend_slope,
  CASE WHEN min(x) < max(x) THEN regr_slope(rn, x) END AS txn_count_slope,
  CASE WHEN count(*) > 1 THEN max(x) / (count(*) - 1) END AS days_between_txns FROM {p}x GROUP BY 1)"""
    )
    joins = " ".join(f"LEFT JOIN {p}i{w} USING (customer_id) LEFT JOIN {p}t{w} USING (customer_id)" for w in windows)
    out.append(
        f"""{p}features AS (SELECT customer_id, {', '.join(feature_columns(windows))} FROM {p}life {joins}
  LEFT JOIN {p}trend USING (customer_id))"""
    )
    return ",\n".join(out)


INTEGER_FEATURES = {
    "frequency", "recency_days", "total_invoices", "total_txns", "tenure_days", "first_purchase_days",
    "distinct_products",
}


def is_integer(feature: str) -> bool:
    return feature in INTEGER_FEATURES or feature.startswith(("invoice_count_", "txn_count_")) and feature[-1] == "d"


# Slopes differ more between engines than sums do.
FEATURE_DIGITS = {"spend_slope": 3, "txn_count_slope": 6}


def feature_select(features: Sequence[str]) -> str:
    return ", ".join(
        f"CAST({f} AS BIGINT) AS {f}" if is_integer(f) else r(f, f, FEATURE_DIGITS.get(f, 4)) for f in features
    )


def label_cte(view: str, snap: str, p: str = "", churn_days: int = 90, value_days: int = 90) -> str:
    s = moment(snap)
    return f"""{p}labels0 AS (SELECT u.customer_id,
  CAST(CASE WHEN count(DISTINCT CASE WHEN t.invoice_date <= {s} + INTERVAL {churn_days} DAY THEN t.invoice_id END) = 0
    THEN 1 ELSE 0 END AS INTEGER) AS churn,
  coalesce(sum(CASE WHEN t.invoice_date <= {s} + INTERVAL {value_days} DAY
    THEN t.quantity * t.unit_price END), 0) AS clv
  FROM (SELECT DISTINCT customer_id FROM {view} WHERE invoice_date <= {s} AND customer_id IS NOT NULL) u
  LEFT JOIN {view} t ON t.customer_id = u.customer_id AND t.invoice_date > {s} GROUP BY 1)"""


def splits_ctes(view: str = "txn") -> str:
    """CTE ``splits``: split, customer_id, features, churn, clv of all snapshots."""
    parts, selects = [], []
    for name, snap in SNAPSHOTS.items():
        parts += [feature_ctes(view, snap, p=f"{name}_"), label_cte(view, snap, p=f"{name}_")]
        selects.append(
            f"SELECT '{name}' AS split, f.*, churn, clv FROM {name}_features f LEFT JOIN {name}_labels0 USING (customer_id)"
        )
    return ",\n".join(parts) + ",\nsplits AS (" + " UNION ALL ".join(selects) + ")"


SCORE = "recency_days / (recency_days + 90.0)"


def scored_ctes(view: str = "txn") -> str:
    """CTE ``scored``: features at the test snapshot, label, deterministic score, revenue at risk."""
    snap = SNAPSHOTS["test"]
    return f"""{feature_ctes(view, snap)},
{label_cte(view, snap)},
scored AS (SELECT f.*, churn AS label, clv, {SCORE} AS score, {SCORE} AS churn_probability,
  {SCORE} * coalesce(spend_90d, 0) AS revenue_at_risk
  FROM features f LEFT JOIN labels0 USING (customer_id))"""


def on_scored(body: str) -> str:
    return with_views(body, "txn", ctes=scored_ctes())


def on_splits(body: str, extra: str = "") -> str:
    return with_views(body, "txn", ctes=splits_ctes() + (",\n" + extra if extra else ""))
