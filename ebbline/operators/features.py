"""Per-customer features as of one or many snapshots.

Plan of the full matrix: lines -> (customer, invoice, moment), a few narrow
columns, with map-side combine and written once.  These rows are dealt by
customer, before there is a copy for each snapshot or a column for each
window; invoices, customers, the slope of the running invoice number (see
:func:`invoice_count_slope`) and distinct products then follow inside the
partition, without another shuffle.  Customers with more than ``BUSY`` lines
stay spread over all tasks: for them the same aggregates shuffle partial rows,
so a customer holding a third of all rows is no task of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.dates import (
    SnapshotLike,
    after_window,
    day_diff,
    frac_days,
    in_window,
    latest,
    micros_between,
    plus_days,
    ts,
)
from ebbline.functions.numbers import null_if_zero, revenue, zero_if_null
from ebbline.functions.ordering import asc, with_running
from ebbline.operators.guards import refuse_future_rows
from ebbline.schema import (
    DEFAULT_WINDOWS,
    FEATURE_INPUT_COLUMNS,
    LIFETIME_FEATURES,
    RFM_FEATURES,
    TREND_FEATURES,
    feature_columns,
    require_columns,
    window_features,
)
from ebbline.session import write_table

SNAPSHOT = "snapshot"
#: Lines of a customer above which it is spread over the tasks.
BUSY = 1_000_000
#: Lines of a partition that is dealt by customer: narrow when shuffled, a matrix needs many times their bytes.
PART_LINES = 100_000


def check_windows(windows: Iterable[int]) -> list[int]:
    windows = list(windows)
    if not windows or not all(isinstance(w, int) and w > 0 for w in windows):
        raise ValueError(f"windows must be a non-empty list of positive ints, got {windows!r}")
    return windows


def at_snapshots(
    lines: DataFrame, snapshots: dict[str, SnapshotLike], horizon_days: int = 0
) -> DataFrame:
    """One copy of each line per snapshot it matters to, with ``split`` and ``snapshot``.

    A line matters to a snapshot if it is dated at most ``horizon_days`` after
    it.  The copies are made inside the scan stage, before any shuffle.
    """
    moments = F.array(
        *[F.struct(F.lit(name).alias("split"), ts(s).alias(SNAPSHOT)) for name, s in snapshots.items()]
    )
    # The widest cutoff is a literal and reaches the file scan.
    last = latest(snapshots.values())
    cut = lines.where(F.col("invoice_date") <= plus_days(ts(last), horizon_days))
    exploded = cut.select("*", F.inline(moments))
    return exploded.where(F.col("invoice_date") <= plus_days(F.col(SNAPSHOT), horizon_days))


def invoice_rollup(
    lines: DataFrame,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    keys: Sequence[str] = (),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per (customer, invoice): first and last date, sums, per-window partials.

    ``lines`` carries its snapshot in the column ``snapshot``; ``keys`` are
    extra grouping columns and ``extra`` further aggregates.  Lines without an invoice id form one group per
    customer that counts for lifetime sums only.
    """
    date, snap = F.col("invoice_date"), F.col(SNAPSHOT)
    per_window = []
    for w in windows:
        hit = in_window(date, snap, w)
        per_window += [
            F.count_if(hit).alias(f"lines_{w}d"),
            F.sum(F.when(hit, F.col("quantity"))).alias(f"qty_{w}d"),
            F.count(F.when(hit, F.col("quantity"))).alias(f"qty_n_{w}d"),
        ]
    return (
        lines.where(F.col("customer_id").isNotNull())
        .groupBy(*keys, SNAPSHOT, "customer_id", "invoice_id")
        .agg(
            F.min("invoice_date").alias("first_date"),
            F.max("invoice_date").alias("last_date"),
            zero_if_null(F.sum(revenue())).alias("revenue"),
            zero_if_null(F.sum("quantity")).alias("quantity"),
            F.count("invoice_id").alias("n_lines"),
            *per_window,
            *extra,
        )
    )


def invoice_moments(lines: DataFrame) -> DataFrame:
    """One row per (customer, invoice, moment): number of lines, sums of revenue and quantity, lines with a quantity."""
    return (
        lines.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "invoice_id", "invoice_date")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(revenue()).alias("revenue"),
            F.sum("quantity").alias("quantity"),
            F.count("quantity").alias("qty_n"),
        )
    )


def moment_rollup(
    moments: DataFrame,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    keys: Sequence[str] = (),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """:func:`invoice_rollup` of lines that :func:`invoice_moments` has added up."""
    date, snap = F.col("invoice_date"), F.col(SNAPSHOT)
    per_window = []
    for w in windows:
        hit = in_window(date, snap, w)
        per_window += [
            F.sum(F.when(hit, F.col("lines")).otherwise(0)).alias(f"lines_{w}d"),
            F.sum(F.when(hit, F.col("quantity"))).alias(f"qty_{w}d"),
            F.sum(F.when(hit, F.col("qty_n")).otherwise(0)).alias(f"qty_n_{w}d"),
        ]
    return moments.groupBy(*keys, SNAPSHOT, "customer_id", "invoice_id").agg(
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"),
        zero_if_null(F.sum("revenue")).alias("revenue"),
        zero_if_null(F.sum("quantity")).alias("quantity"),
        F.sum(F.when(F.col("invoice_id").isNotNull(), F.col("lines")).otherwise(0)).alias("n_lines"),
        *per_window,
        *extra,
    )


def _rfm_aggs() -> list[Column]:
    return [
        F.count("invoice_id").alias("frequency"),
        F.sum("revenue").alias("monetary"),
        day_diff(F.max("last_date"), F.col(SNAPSHOT)).alias("recency_days"),
    ]


def aggregate_inputs(rollup: DataFrame, windows: Sequence[int], trend: bool = True) -> DataFrame:
    """Columns the customer aggregate needs, computed per invoice.

    Kept out of the aggregate itself: its generated code stays small enough
    for the JVM to compile.
    """
    known = F.col("invoice_id").isNotNull()
    columns: dict[str, Column] = {}
    for w in windows:
        hit = known & in_window(F.col("last_date"), F.col(SNAPSHOT), w)
        columns[f"_spend_{w}d"] = F.when(hit, F.col("revenue"))
        columns[f"_known_{w}d"] = F.when(known, F.col(f"lines_{w}d")).otherwise(0)
    if trend:
        columns["_start"] = F.when(known, F.col("first_date"))
        columns["_x"] = F.when(known, frac_days(F.col(SNAPSHOT), F.col("first_date")))
        columns["_y"] = F.when(known, F.col("revenue"))
    return rollup.withColumns(columns)


def _window_aggs(windows: Sequence[int]) -> list[Column]:
    out = []
    for w in windows:
        spend = F.col(f"_spend_{w}d")
        out += [
            null_if_zero(F.count(spend)).alias(f"invoice_count_{w}d"),
            F.sum(spend).alias(f"spend_{w}d"),
            F.avg(spend).alias(f"avg_spend_{w}d"),
            F.stddev_samp(spend).alias(f"spend_std_{w}d"),
            F.when(F.sum(f"lines_{w}d") > 0, F.sum(f"_known_{w}d")).alias(f"txn_count_{w}d"),
            F.try_divide(F.sum(f"qty_{w}d"), F.sum(f"qty_n_{w}d")).alias(f"avg_basket_{w}d"),
        ]
    return out


def _lifetime_aggs() -> list[Column]:
    first, last = F.min("first_date"), F.max("last_date")
    return [
        F.count("invoice_id").alias("total_invoices"),
        F.sum("n_lines").alias("total_txns"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("revenue").alias("total_revenue"),
        day_diff(first, last).alias("tenure_days"),
        day_diff(first, F.col(SNAPSHOT)).alias("first_purchase_days"),
        F.try_divide(F.sum("revenue"), F.count("invoice_id")).alias("avg_order_value"),
        F.try_divide(F.sum("quantity"), F.sum("n_lines")).alias("avg_basket_size"),
    ]


def _trend_aggs() -> list[Column]:
    """Spend slope and mean gap; both are unchanged by where time starts."""
    start = F.col("_start")
    gap = frac_days(F.min(start), F.max(start)) / null_if_zero(F.count(start) - 1)
    return [
        # Zero variance of x is decided on the dates, not on a rounded variance.
        F.when(F.min(start) < F.max(start), F.regr_slope(F.col("_y"), F.col("_x"))).alias("spend_slope"),
        F.when(F.count(start) > 1, gap).alias("days_between_txns"),
    ]


def per_customer(rollup: DataFrame, aggs: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    return rollup.groupBy(*keys, SNAPSHOT, "customer_id").agg(*aggs)


def invoice_count_slope(lines: DataFrame, snapshots: dict[str, SnapshotLike]) -> DataFrame:
    """OLS slope of the running invoice number on time: ``split, customer_id, txn_count_slope``."""
    known = lines.where(F.col("invoice_id").isNotNull())
    return _count_slope(invoice_rollup(at_snapshots(known, snapshots), [], ["split"]))


def _count_slope(invoices: DataFrame) -> DataFrame:
    """The slope from the invoice table.

    Invoices at the same moment share their mean rank, which leaves the slope
    unchanged.  Invoices collapse to distinct moments, which are ranked inside
    each day; the invoices of earlier days are added as an offset.  No group
    holds more rows than a day has moments or a history has days, so a
    customer with a third of all invoices is fine.
    """
    owner = ["split", "customer_id"]
    day_micros = F.lit(86_400_000_000)
    moments = (
        invoices.where(F.col("invoice_id").isNotNull() & F.col("first_date").isNotNull())
        .groupBy(*owner, F.col("first_date").alias("at"))
        .agg(F.count(F.lit(1)).alias("m"))
        .withColumn("us", micros_between(ts("2000-01-01"), F.col("at")))
        .withColumn("x", F.pmod(F.col("us"), day_micros) / day_micros)
        .withColumn("day", F.floor(F.col("us") / day_micros))
    )
    in_day = Window.partitionBy(*owner, "day").orderBy("at")
    earlier = in_day.rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum("m").over(earlier), F.lit(0)) + (F.col("m") + 1) / F.lit(2.0)

    # Per day: number of invoices and sums of time and rank, time counted from the day's start.
    m, x, r = F.col("m"), F.col("x"), F.col("r")
    days = (
        moments.withColumn("r", rank)
        .groupBy(*owner, "day")
        .agg(
            F.sum("m").alias("n"),
            F.sum(m * x).alias("sx"),
            F.sum(m * x * x).alias("sxx"),
            F.sum(m * r).alias("sr"),
            F.sum(m * r * x).alias("srx"),
            F.min("at").alias("lo"),
            F.max("at").alias("hi"),
        )
    )
    by_day = Window.partitionBy(*owner).orderBy("day")
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    placed = days.withColumns(
        {
            "off": F.coalesce(F.sum("n").over(before), F.lit(0)),
            "d": (F.col("day") - F.min("day").over(so_far)).cast("double"),
        }
    )
    n, d, off = F.col("n"), F.col("d"), F.col("off")
    total = placed.groupBy(*owner).agg(
        F.sum("n").alias("n"),
        F.sum(n * d + F.col("sx")).alias("sx"),
        F.sum(n * d * d + 2 * d * F.col("sx") + F.col("sxx")).alias("sxx"),
        F.sum(off * (n * d + F.col("sx")) + d * F.col("sr") + F.col("srx")).alias("srx"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )
    n, sx = F.col("n").cast("double"), F.col("sx")
    slope = (F.col("srx") - sx * (n + 1) / 2) / (F.col("sxx") - sx * sx / n)
    return total.select(*owner, F.when(F.col("lo") < F.col("hi"), slope).alias("txn_count_slope"))


def distinct_products(lines: DataFrame, snapshots: dict[str, SnapshotLike]) -> DataFrame:
    """Exact distinct stock codes per snapshot and customer.

    (customer, product) pairs are made distinct once, keeping their first
    date; every snapshot then counts the pairs seen by then.
    """
    last = latest(snapshots.values())
    pairs = (
        lines.where(F.col("customer_id").isNotNull() & F.col("stock_code").isNotNull())
        .where(F.col("invoice_date") <= ts(last))
        .groupBy("customer_id", "stock_code")
        .agg(F.min("invoice_date").alias("since"))
    )
    splits = F.array(
        *[F.struct(F.lit(n).alias("split"), ts(s).alias(SNAPSHOT)) for n, s in snapshots.items()]
    )
    return (
        pairs.select("customer_id", "since", F.inline(splits))
        .where(F.col("since") <= F.col(SNAPSHOT))
        .groupBy("split", SNAPSHOT, "customer_id")
        .agg(F.count(F.lit(1)).alias("distinct_products"))
    )


def _one(snapshot: SnapshotLike) -> dict[str, SnapshotLike]:
    return {"all": snapshot}


def _guarded(lines: DataFrame, snapshot: SnapshotLike) -> DataFrame:
    require_columns(lines, FEATURE_INPUT_COLUMNS)
    return refuse_future_rows(lines, snapshot).withColumn(SNAPSHOT, ts(snapshot))


def rfm(lines: DataFrame, snapshot: SnapshotLike) -> DataFrame:
    """Frequency, monetary value and recency. Refuses rows after the snapshot."""
    rollup = invoice_rollup(_guarded(lines, snapshot), [])
    return per_customer(rollup, _rfm_aggs()).select("customer_id", *RFM_FEATURES)


def rolling_features(
    lines: DataFrame, snapshot: SnapshotLike, windows: Iterable[int] = DEFAULT_WINDOWS
) -> DataFrame:
    """Six features per window; all null for a customer inactive in it."""
    windows = check_windows(windows)
    rollup = aggregate_inputs(invoice_rollup(_guarded(lines, snapshot), windows), windows, trend=False)
    return per_customer(rollup, _window_aggs(windows)).select("customer_id", *window_features(windows))


def lifetime_features(lines: DataFrame, snapshot: SnapshotLike) -> DataFrame:
    """Totals, tenure, averages and distinct products up to the snapshot."""
    guarded = _guarded(lines, snapshot)
    base = per_customer(invoice_rollup(guarded, []), _lifetime_aggs())
    if "stock_code" in lines.columns:
        products = distinct_products(guarded, _one(snapshot)).select("customer_id", "distinct_products")
        base = base.join(products, "customer_id", "left").withColumn(
            "distinct_products", F.coalesce("distinct_products", F.lit(0).cast("bigint"))
        )
    else:
        base = base.withColumn("distinct_products", F.lit(None).cast("bigint"))
    return base.select("customer_id", *LIFETIME_FEATURES)


def trend_features(lines: DataFrame, snapshot: SnapshotLike) -> DataFrame:
    """Slopes and mean gap per customer with at least one known invoice."""
    guarded = _guarded(lines, snapshot)
    known = guarded.where(F.col("invoice_id").isNotNull())
    invoices = write_table(invoice_rollup(known.withColumn("split", F.lit("all")), [], ["split"]), "invoices")
    base = per_customer(aggregate_inputs(invoices, []), _trend_aggs())
    counts = _count_slope(invoices).select("customer_id", "txn_count_slope")
    return base.join(counts, "customer_id", "left").select("customer_id", *TREND_FEATURES)


def mean_gap_by_lag(lines: DataFrame, snapshot: SnapshotLike) -> DataFrame:
    """``days_between_txns`` from consecutive invoices, as a cross-check of the closed form.

    The next invoice comes from range partitions of (customer, time): no task holds a customer's whole history.
    """
    rollup = invoice_rollup(_guarded(lines, snapshot), []).where(F.col("invoice_id").isNotNull())
    ordered = with_running(
        rollup.select("customer_id", "first_date", "invoice_id"), [asc("customer_id"), asc("first_date"), asc("invoice_id")],
        rank=None, lead={"next_customer": "customer_id", "next_date": "first_date"},
    )
    own = F.col("next_customer") == F.col("customer_id")
    gap = F.when(own, frac_days(F.col("first_date"), F.col("next_date")))
    return (
        ordered.select("customer_id", gap.alias("gap"))
        .groupBy("customer_id")
        .agg(F.avg("gap").alias("days_between_txns"))
    )


def merge_on_customer(frames: Sequence[DataFrame], on: str = "customer_id") -> DataFrame:
    """Full outer join of any number of per-customer frames."""
    if not frames:
        raise ValueError("no frames to merge")
    for i, frame in enumerate(frames):
        if on not in frame.columns:
            raise ValueError(f"frame {i} lacks the key {on!r}")
    return reduce(lambda left, right: left.join(right, on, "full"), frames)


def features_at(
    lines: DataFrame,
    snapshots: dict[str, SnapshotLike],
    windows: Iterable[int] = DEFAULT_WINDOWS,
    label_days: tuple[int, int] | None = None,
) -> DataFrame:
    """Feature matrix (and labels) of several snapshots in one pass over the lines.

    Result: ``split, snapshot, customer_id``, the features in model order and,
    with ``label_days=(churn window, value window)``, ``churn`` and ``clv``.
    Customers without a line up to a snapshot are absent from it.  The lines and
    their moments are written when this is called; the rest is lazy.
    """
    windows = check_windows(windows)
    require_columns(lines, FEATURE_INPUT_COLUMNS)
    horizon = max(label_days) if label_days else 0
    columns = [c for c in (*FEATURE_INPUT_COLUMNS, "stock_code") if c in lines.columns]
    reach = plus_days(ts(latest(snapshots.values())), horizon)
    # Two aggregates read the lines; their plan may hold joins.
    lines = write_table(lines.where(F.col("customer_id").isNotNull() & (F.col("invoice_date") <= reach)).select(*columns), "lines")
    moments = write_table(invoice_moments(lines), "moments")
    counts = moments.groupBy("customer_id").agg(F.sum("lines").alias("n"))
    # As many busy customers as there are times BUSY lines, at most.
    found = counts.agg(
        F.sum("n").alias("lines"), F.collect_list(F.when(F.col("n") > BUSY, F.struct("customer_id", "n"))).alias("busy")
    ).first()
    busy = [r["customer_id"] for r in found["busy"]]
    parts = max(1, -(-((found["lines"] or 0) - sum(r["n"] for r in found["busy"])) // PART_LINES))

    known = F.col("customer_id").isin(busy)
    own, own_moments = (lines.where(~known), moments.where(~known)) if busy else (lines, moments)
    # Sorted, so that a customer's doubles are added in the same order whatever other rows there are.
    in_order = own_moments.repartition(parts, "customer_id").sortWithinPartitions("customer_id", "invoice_date", "invoice_id")
    rest = _matrix(own.repartition(parts, "customer_id"), in_order, snapshots, windows, label_days)
    if not busy:
        return rest
    return rest.unionByName(_matrix(lines.where(known), moments.where(known), snapshots, windows, label_days))


def _matrix(
    lines: DataFrame, moments: DataFrame, snapshots: dict[str, SnapshotLike], windows: Sequence[int], label_days: tuple[int, int] | None
) -> DataFrame:
    """:func:`features_at` of written lines and their moments; nothing is shuffled where both are dealt by customer."""
    horizon = max(label_days) if label_days else 0
    keyed = at_snapshots(moments, snapshots, horizon)
    is_past = F.col("invoice_date") <= F.col(SNAPSHOT)
    keys = ["split"]
    past = F.lit(True)
    label_aggs: list[Column] = []
    if label_days:
        # Lines after the snapshot roll up apart from those before it, in the
        # same aggregate, so features cannot see them and labels need no join.
        keyed = keyed.withColumn("past", is_past)
        keys.append("past")
        past = F.col("past")
        label_aggs = _label_aggs()
    rollup = _rollup_with_labels(keyed, windows, keys, label_days)
    masked = rollup if not label_days else _mask_future(rollup, windows)
    customers = aggregate_inputs(masked, windows).groupBy("split", SNAPSHOT, "customer_id").agg(
        *_rfm_aggs(), *_window_aggs(windows), *_lifetime_aggs(), *_trend_aggs(), *label_aggs,
        F.count_if(past).alias("_past"),
    ).where(F.col("_past") > 0)

    invoices = moment_rollup(at_snapshots(moments.where(F.col("invoice_id").isNotNull()), snapshots), [], ["split"])
    # Joins on the customer alone, since that is how the rows are dealt.
    joined = customers.join(_by_split(_count_slope(invoices), "txn_count_slope"), "customer_id", "left")
    joined = joined.withColumn("txn_count_slope", F.try_element_at("txn_count_slope", F.col("split")))
    if "stock_code" in lines.columns:
        products = _by_split(distinct_products(lines, snapshots), "distinct_products")
        joined = joined.join(products, "customer_id", "left").withColumn(
            "distinct_products", F.coalesce(F.try_element_at("distinct_products", F.col("split")), F.lit(0).cast("bigint"))
        )
    else:
        joined = joined.withColumn("distinct_products", F.lit(None).cast("bigint"))
    labels = ["churn", "clv"] if label_days else []
    return joined.select("split", SNAPSHOT, "customer_id", *feature_columns(windows), *labels)


def _by_split(rows: DataFrame, column: str) -> DataFrame:
    """One row per customer: a map from split to ``column``."""
    return rows.groupBy("customer_id").agg(F.map_from_entries(F.collect_list(F.struct("split", column))).alias(column))


def _rollup_with_labels(
    keyed: DataFrame, windows: Sequence[int], keys: list[str], label_days: tuple[int, int] | None
) -> DataFrame:
    if not label_days:
        return moment_rollup(keyed, windows, keys)
    churn_days, value_days = label_days
    date, snap = F.col("invoice_date"), F.col(SNAPSHOT)
    # Two more partials per invoice ride along as columns of the moments.
    tagged = keyed.withColumns(
        {
            "_bought": F.when(
                after_window(date, snap, churn_days) & F.col("invoice_id").isNotNull(), 1
            ).otherwise(0),
            "_value": F.when(after_window(date, snap, value_days), F.col("revenue")),
        }
    )
    return moment_rollup(
        tagged, windows, keys, [F.max("_bought").alias("_bought"), F.sum("_value").alias("_value")]
    )


def _label_aggs() -> list[Column]:
    return [
        F.when(F.max("_bought") > 0, 0).otherwise(1).cast("int").alias("churn"),
        zero_if_null(F.sum("_value")).alias("clv"),
    ]


def _mask_future(rollup: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Null every feature input of the invoices after the snapshot."""
    inputs = ["invoice_id", "first_date", "last_date", "revenue", "quantity", "n_lines"]
    inputs += [f"{stem}_{w}d" for w in windows for stem in ("lines", "qty", "qty_n")]
    return rollup.withColumns({c: F.when(F.col("past"), F.col(c)) for c in inputs})


def build_features(
    lines: DataFrame, snapshot: SnapshotLike, windows: Iterable[int] = DEFAULT_WINDOWS
) -> DataFrame:
    """The 33-column matrix at one snapshot; later lines are cut off first."""
    matrix = features_at(lines, _one(snapshot), windows)
    return matrix.select("customer_id", *feature_columns(check_windows(windows)))
