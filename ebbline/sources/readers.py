"""Reading, coercing and profiling transaction sources, and finding the latest run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.functions.numbers import finite
from ebbline.schema import MAPPED_COLUMNS, rename_to_canonical, require_columns

PART_COLUMN = "part"


#: Date and time as spreadsheets write them, tried after ISO forms.
DATE_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy")


def read_part(
    spark: SparkSession,
    path: str,
    file_type: str,
    columns: Sequence[str] | None = None,
    quote: str = '"',
    escape: str = '"',
    multi_line: bool = True,
) -> DataFrame:
    """One part of a dataset as csv or parquet.

    CSV columns arrive as strings, without an inference pass over the data;
    :func:`coerce_types` gives them types.  With ``columns`` the header is not
    even peeked at.  Quoted fields may hold separators, doubled quotes and line
    breaks; a file is then read by one task, so cut huge files up or, if no
    field has a line break, pass ``multi_line=False``.
    """
    if file_type == "parquet":
        return spark.read.parquet(path)
    if file_type == "csv":
        reader = spark.read.options(header=True, quote=quote, escape=escape, multiLine=multi_line)
        if columns:
            reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        return reader.csv(path)
    raise ValueError(f"unknown file type {file_type!r}")


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union by name; refused if a part has other columns than the first (order is free)."""
    if not parts:
        raise ValueError("no parts")
    expected = set(parts[0].columns)
    for i, part in enumerate(parts[1:], start=1):
        if set(part.columns) != expected:
            raise ValueError(
                f"part {i} has other columns than part 0: {sorted(set(part.columns) ^ expected)}"
            )
    return reduce(lambda a, b: a.unionByName(b), parts)


def coerce_types(
    df: DataFrame,
    customer_id: str = "customer_id",
    invoice_date: str = "invoice_date",
    quantity: str = "quantity",
    unit_price: str = "unit_price",
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Date, id, quantity and price get their types; what cannot be parsed becomes null.

    So do NaN and infinite numbers and ids with a fraction.  Text dates may be ISO or in one of
    ``date_formats``; the first that fits counts.
    """
    types = dict(df.dtypes)

    def number(name: str):
        return finite(F.col(name).try_cast("double"))

    def customer(name: str):
        if types[name] == "bigint":
            return F.col(name)
        # Ids often come as '12345.0', an artefact of missing values.
        parsed = number(name)
        whole = F.when(parsed == F.floor(parsed), parsed.try_cast("bigint"))
        return F.coalesce(F.col(name).try_cast("bigint"), whole) if types[name] == "string" else whole

    def moment(name: str):
        if types[name] == "timestamp_ntz":
            return F.col(name)
        iso = F.col(name).try_cast("timestamp_ntz")
        if types[name] != "string":
            return iso
        return F.coalesce(iso, *[F.try_to_timestamp(name, F.lit(f)).cast("timestamp_ntz") for f in date_formats])

    return df.withColumns(
        {
            customer_id: customer(customer_id),
            invoice_date: moment(invoice_date),
            quantity: number(quantity),
            unit_price: number(unit_price),
        }
    )


def load_transactions(
    spark: SparkSession,
    paths: str | Sequence[str],
    file_type: str,
    mapping: Mapping[str, str],
    optional: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parts -> union -> canonical names -> types.

    ``mapping`` (canonical -> source name) must cover the six mapped columns;
    ``optional`` ones, such as the stock code, are renamed where present.
    """
    unmapped = sorted(set(MAPPED_COLUMNS) - set(mapping))
    if unmapped:
        raise ValueError(f"mapping lacks columns: {unmapped}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = union_parts([read_part(spark, p, file_type) for p in paths])
    require_columns(raw, mapping.values())
    extra = {k: v for k, v in (optional or {}).items() if v in raw.columns}
    return coerce_types(rename_to_canonical(raw, {**mapping, **extra}))


def non_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null count per column, one pass, one row per column."""
    counts = df.agg(*[F.count(c).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("non_null")) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def with_part(df: DataFrame) -> DataFrame:
    """Tag rows with the file they come from."""
    return df.withColumn(PART_COLUMN, F.input_file_name())


def part_profile(df: DataFrame, date: str = "invoice_date", part: str = PART_COLUMN) -> DataFrame:
    """Rows, first and last date per part."""
    return df.groupBy(part).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(date).alias("min_date"), F.max(date).alias("max_date")
    )


def complete_runs(spark: SparkSession, output: str) -> DataFrame:
    """``run_id, run_ts, tables`` of the runs whose manifest has been written."""
    return spark.read.schema("run_id string, run_ts string, tables array<string>").json(f"{output}/manifests/*")


def latest_run(metrics: DataFrame, override: str | None = None, complete: DataFrame | None = None) -> DataFrame:
    """Metrics of the most recent run (``run_id, run_ts, ...``); ``override`` names another one.

    ``complete`` (:func:`complete_runs`) leaves out runs that stopped before their manifest.

    The run is found by a one-row aggregate and used as a literal, so the read
    prunes to its partition.  No run at all is an error.
    """
    if complete is not None:
        metrics = metrics.join(F.broadcast(complete.select("run_id").distinct()), "run_id", "left_semi")  # a row per run
    if override is None:
        row = metrics.agg(F.max_by("run_id", F.struct("run_ts", "run_id")).alias("run_id")).first()
        run_id = row["run_id"]
        if run_id is None:
            raise LookupError("no run with metrics found")
    else:
        run_id = override
    chosen = metrics.where(F.col("run_id") == F.lit(run_id))
    if override is not None and not chosen.limit(1).count():
        raise LookupError(f"run {override!r} not found")
    return chosen
