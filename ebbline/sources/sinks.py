"""Result tables and the run registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.schema import FEATURES


def write_result(df: DataFrame, path: str, file_type: str = "parquet", mode: str = "error") -> None:
    """A result table as parquet or as CSV with a header, written by all tasks."""
    if file_type == "csv":
        df.write.mode(mode).options(header=True, quote='"', escape='"').csv(path)
    elif file_type == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unknown file type {file_type!r}")


def append_metrics(metrics: DataFrame, run_id: str, run_ts: str, path: str) -> None:
    """Long metrics ``(model, metric, value)`` of one run, partitioned by ``run_id``; a rerun replaces its own."""
    append_rows(metrics.withColumn("run_ts", F.lit(run_ts).cast("timestamp_ntz")), run_id, path)


def append_rows(df: DataFrame, run_id: str, path: str) -> None:
    """Rows of one run, partitioned by ``run_id``; a rerun replaces its own."""
    rows = df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    rows.partitionBy("run_id").parquet(path)


def append_run_info(spark: SparkSession, info: dict, path: str) -> None:
    """One row per run: version, date, algorithm, sizes, folds, trials, best score, parameters; a rerun replaces its own."""
    required = ["run_id", "version", "trained_at", "algorithm", "n_features"]
    missing = [k for k in required if k not in info]
    if missing:
        raise ValueError(f"run info lacks {missing}")
    row = {k: (v if isinstance(v, (int, float, str)) or v is None else str(v)) for k, v in info.items()}
    frame = spark.createDataFrame([row]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    frame.partitionBy("run_id").json(path)


def complete_run(spark: SparkSession, run_id: str, run_ts: str, output: str, tables: Sequence[str]) -> None:
    """The manifest of a run, written after everything else: only runs that have one count as complete."""
    row = spark.createDataFrame([(run_id, run_ts, list(tables))], "run_id string, run_ts string, tables array<string>")
    row.coalesce(1).write.mode("overwrite").json(f"{output}/manifests/{run_id}")


def write_feature_names(matrix: DataFrame, path: str, features: Sequence[str] = tuple(FEATURES)) -> None:
    """``{feature_columns, n_features, n_rows}`` as JSON next to the model."""
    matrix.agg(
        F.array(*[F.lit(f) for f in features]).alias("feature_columns"),
        F.lit(len(features)).alias("n_features"),
        F.count(F.lit(1)).alias("n_rows"),
    ).write.mode("error").json(path)
