"""Transaction views over the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOTS = {"train": "1997-01-01", "val": "1998-01-01", "test": "1999-01-01"}
EVENT_SNAPSHOT = "2024-01-20 12:00:00"
EVENT_WINDOWS = (7, 14)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txn(spark: SparkSession, sf_dir: str, date: str = "o_orderdate", country: bool = False) -> DataFrame:
    """Order lines as transactions, dated by the order or (``l_shipdate``) by the line."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    if country:
        # Orders get their country before they meet their lines, so lines are not shuffled by customer.
        customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
        orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
            nation, F.col("c_nationkey") == F.col("n_nationkey")
        )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    columns = [
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").cast("string").alias("invoice_id"),
        F.col(date).alias("invoice_date"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_partkey").cast("string").alias("stock_code"),
    ]
    if country:
        columns.append(F.col("n_name").alias("country"))
    return joined.select(*columns)


def txn_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``txn`` with null ids, negated quantities, zero prices, inflated quantities and copies."""
    base = txn(spark, sf_dir, country=True)
    order, part = F.col("invoice_id").cast("bigint"), F.col("stock_code").cast("bigint")
    inflated = F.when(part % 89 == 0, F.col("quantity") * 1000).otherwise(F.col("quantity"))
    copies = F.when(order % 31 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return base.select(
        F.when(order % 97 != 0, F.col("customer_id")).alias("customer_id"),
        "invoice_id",
        "invoice_date",
        F.when(order % 53 == 0, -inflated).otherwise(inflated).alias("quantity"),
        F.when(part % 41 == 0, F.lit(0.0)).otherwise(F.col("unit_price")).alias("unit_price"),
        "stock_code",
        "country",
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def txn_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of the event stream: sub-day times, quantity 1."""
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return events.select(
        F.col("user_id").alias("customer_id"),
        F.col("event_id").cast("string").alias("invoice_id"),
        F.col("ts").alias("invoice_date"),
        F.lit(1.0).alias("quantity"),
        F.col("value").alias("unit_price"),
        F.lit(None).cast("string").alias("stock_code"),
    )
