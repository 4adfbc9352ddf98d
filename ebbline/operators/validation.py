"""Rules for scoring records: a bad record gets its errors listed, a bad batch is refused whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.schema import FEATURES, NULLABLE_FEATURES, SIGNED_FEATURES

MAX_BATCH_SIZE = 500
ERRORS = "errors"


def nullable_features(strict: bool) -> list[str]:
    """Features that may be null.

    The window counts and spends are null for customers without activity in the
    window, so they may be null unless ``strict`` asks for them.
    """
    if strict:
        return list(NULLABLE_FEATURES)
    idle = [f for f in FEATURES if f.startswith(("invoice_count_", "txn_count_", "spend_")) and f[-1] == "d"]
    return sorted({*NULLABLE_FEATURES, *idle})


def check_fields(
    columns: Sequence[str], features: Sequence[str] = tuple(FEATURES), also: Sequence[str] = ()
) -> None:
    """Unknown and absent fields are refused for the whole input."""
    unknown = sorted(set(columns) - set(features) - set(also))
    absent = sorted(set(features) - set(columns))
    if unknown:
        raise ValueError(f"unexpected feature columns: {unknown}")
    if absent:
        raise ValueError(f"missing feature columns: {absent}")


def validate_records(
    df: DataFrame,
    strict: bool = False,
    keys: Sequence[str] = ("customer_id",),
    features: Sequence[str] = tuple(FEATURES),
) -> DataFrame:
    """Adds ``errors``, an array that is empty for a valid record."""
    check_fields(df.columns, features, keys)
    may_be_null = set(nullable_features(strict))
    types = dict(df.dtypes)
    checks = []
    for f in features:
        raw = F.col(f)
        number = raw.try_cast("double") if types[f] == "string" else raw.cast("double")
        if types[f] == "string":
            checks.append(F.when(raw.isNotNull() & number.isNull(), F.lit(f"{f}: not a number")))
        if f not in may_be_null:
            checks.append(F.when(raw.isNull(), F.lit(f"{f}: required")))
        if f not in SIGNED_FEATURES:
            checks.append(F.when(number < 0, F.lit(f"{f}: negative")))
    return df.withColumn(ERRORS, F.array_compact(F.array(*checks)))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid records, and the quarantine with its errors."""
    ok = F.size(ERRORS) == 0
    return validated.where(ok).drop(ERRORS), validated.where(~ok)


def refuse_bad_batches(
    validated: DataFrame, batch: str = "batch_id", max_size: int = MAX_BATCH_SIZE
) -> DataFrame:
    """Adds ``batch_ok``: every record is valid and the batch has 1..``max_size`` records.

    Batches are judged by an aggregate with map-side combine and joined back,
    so a batch of any size never has to fit into one task.
    """
    verdict = validated.groupBy(batch).agg(
        (F.bool_and(F.size(ERRORS) == 0) & (F.count(F.lit(1)) <= max_size)).alias("batch_ok")
    )
    return validated.join(verdict, batch)
