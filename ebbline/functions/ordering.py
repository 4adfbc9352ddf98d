"""Global order, rank and running sums without sending all rows to one task.

``Window.orderBy`` without ``partitionBy`` moves the whole table into a single
task.  Here the rows are range-partitioned on the full order (which ends in a
unique key, so a value shared by a third of the rows is still split), the
partition number is written into a table, and a running sum becomes *running
sum inside the partition + total of the partitions before it*.  The offsets
table has one row per range partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.session import write_table

PART = "_part"
RANK = "rank"


@dataclass(frozen=True)
class OrderKey:
    name: str
    descending: bool = False

    def column(self) -> Column:
        c = F.col(self.name)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_last()


def asc(name: str) -> OrderKey:
    return OrderKey(name)


def desc(name: str) -> OrderKey:
    return OrderKey(name, descending=True)


def with_running(
    df: DataFrame,
    keys: list[OrderKey],
    sums: dict[str, str] | None = None,
    rank: str | None = RANK,
    lead: dict[str, str] | None = None,
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """Add a 1-based global ``rank`` and running sums in the order of ``keys``.

    ``sums`` maps new column -> summed column (inclusive running sum);
    ``totals`` maps new column -> summed column (sum over all rows; ``"*"``
    counts them); ``lead`` maps new column -> column taken from the next row.
    ``keys`` must identify a row.
    """
    sums, lead, totals = sums or {}, lead or {}, totals or {}
    order = [k.column() for k in keys]
    # No partition count: AQE merges neighbouring ranges that are small, which
    # keeps the ranges in order.  The number of the range is written with the
    # rows, so later reads cannot disagree about it.
    ranged = write_table(
        df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()), "ordered"
    )

    in_part = Window.partitionBy(PART).orderBy(*order)
    running = in_part.rowsBetween(Window.unboundedPreceding, 0)
    # One row per range from here to the join: at most as many as shuffle partitions.
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    part_totals = ranged.groupBy(PART).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(src).alias(f"_s_{new}") for new, src in sums.items()],
        *[
            (F.count(F.lit(1)) if src == "*" else F.sum(src)).alias(f"_t_{new}")
            for new, src in totals.items()
        ],
        *(
            [
                F.min_by(F.struct(*[F.col(s) for s in lead.values()]), _order_struct(keys)).alias("_first")
            ]
            if lead
            else []
        ),
    )
    offsets = part_totals.select(
        PART,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
        *[F.coalesce(F.sum(f"_s_{new}").over(before), F.lit(0)).alias(f"_s_{new}") for new in sums],
        *[F.sum(f"_t_{new}").over(everything).alias(f"_t_{new}") for new in totals],
        *([F.lead("_first").over(Window.orderBy(PART)).alias("_next")] if lead else []),
    )
    # `offsets` has one row per range, whatever the size of `df`.
    joined = ranged.join(F.broadcast(offsets), PART)

    out: dict[str, Column] = {}
    if rank:
        out[rank] = (F.row_number().over(in_part) + F.col("_n")).cast("bigint")
    for new, src in sums.items():
        out[new] = F.sum(src).over(running) + F.col(f"_s_{new}")
    for new in totals:
        out[new] = F.col(f"_t_{new}")
    for new, src in lead.items():
        out[new] = F.coalesce(F.lead(src).over(in_part), F.col(f"_next.{src}"))
    result = joined.withColumns(out)
    return result.select(*df.columns, *out)


def _order_struct(keys: list[OrderKey]) -> Column:
    """Sort key for ``min_by``: numeric columns are negated for descending order."""
    return F.struct(*[(-F.col(k.name) if k.descending else F.col(k.name)).alias(k.name) for k in keys])
