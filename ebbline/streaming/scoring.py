"""Validated bulk scoring, as a batch job and as a stream over arriving files."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ebbline.operators.validation import (
    ERRORS,
    MAX_BATCH_SIZE,
    refuse_bad_batches,
    validate_records,
)
from ebbline.schema import FEATURES
from ebbline.session import write_table

Scorer = Callable[[DataFrame], DataFrame]


def score_records(
    records: DataFrame,
    scorer: Scorer,
    keys: Sequence[str] = ("customer_id",),
    batch: str | None = None,
    strict: bool = False,
    max_batch_size: int = MAX_BATCH_SIZE,
    features: Sequence[str] = tuple(FEATURES),
) -> tuple[DataFrame, DataFrame]:
    """``(scored, refused)``: keys with ``churn_probability``, and the records that were turned away.

    ``scorer`` gets the keys and the features in model order and adds
    ``churn_probability``.  With ``batch`` a bad record, or too many records,
    refuse the whole batch.
    """
    checked = validate_records(records, strict, keys, features)
    if batch:
        checked = refuse_bad_batches(checked, batch, max_batch_size)
        good = F.col("batch_ok")
    else:
        good = F.size(ERRORS) == 0
    return judged(checked, scorer, keys, good, features)


def judged(checked: DataFrame, scorer: Scorer, keys: Sequence[str], good: Column, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(scored, refused)`` of records with their errors."""
    accepted = checked.where(good).select(*keys, *[F.col(f).cast("double").alias(f) for f in features])
    refused = checked.where(~good).select(*keys, ERRORS)
    return scorer(accepted).select(*keys, "churn_probability"), refused


def held_batches(
    checked: DataFrame, batch: str, declared: str, keys: Sequence[str], features: Sequence[str], max_batch_size: int = MAX_BATCH_SIZE, wait: float = 600
) -> DataFrame:
    """A stream of records with errors -> the same records with ``batch_ok``, each request batch at once, when it is whole.

    The state of a batch holds its records until there are as many as its first record declares.  One
    bad record then refuses all.  Refused at once: batches that declare more than ``max_batch_size``,
    or no positive size.  Refused after ``wait`` seconds since the last record: batches that are still not whole.  Records
    that come after the judgement are refused on their own, for as long as ``wait`` again.  A null batch id is a batch.
    A stream that stops when it has read what is there looks at time-outs only while there is something to read.
    """
    held = [*dict.fromkeys([batch, *keys, *features])]
    schema = T.StructType([*[checked.schema[c] for c in held], checked.schema[declared], checked.schema[ERRORS]])
    out = T.StructType([*[checked.schema[c] for c in held], checked.schema[ERRORS], T.StructField("batch_ok", T.BooleanType())])

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows, size, closed = state.get if state.exists else (None, 0, False)
        known = [pickle.loads(rows)] if rows else []

        def verdict(frame: pd.DataFrame, why: str | None) -> pd.DataFrame:
            errors = [list(e) for e in frame[ERRORS]]
            ok = why is None and not any(errors)
            return frame[held].assign(**{ERRORS: [[*e, why] if why else e for e in errors], "batch_ok": ok})

        if state.hasTimedOut:
            state.remove()
            if known:
                whole = pd.concat(known, ignore_index=True)
                yield verdict(whole, f"batch: {len(whole)} of {size} records")
            return
        new = pd.concat(list(frames), ignore_index=True)
        if closed:
            yield verdict(new, "batch: already judged")
        else:
            if not known:
                first = new[declared].iloc[0]
                size = 0 if pd.isna(first) else int(first)
            whole = pd.concat([*known, new], ignore_index=True)
            why = None if 1 <= size <= max_batch_size else f"batch: size not between 1 and {max_batch_size}"
            if why or len(whole) >= size:
                if not why and len(whole) > size:
                    why = f"batch: more than {size} records"
                yield verdict(whole, why)
                closed, known = True, []
            else:
                known = [whole]
        state.update((pickle.dumps(known[0]) if known else None, size, closed))
        state.setTimeoutDuration(max(1, round(wait * 1000)))

    grouped = checked.select(*schema.names).groupBy(batch)
    return grouped.applyInPandasWithState(run, out, "rows binary, size int, closed boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)


def score_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    scorer: Scorer,
    sink: str,
    quarantine: str,
    checkpoint: str,
    keys: Sequence[str] = ("customer_id",),
    batch: str | None = None,
    strict: bool = False,
    files_per_trigger: int = 1000,
    once: bool = True,
    features: Sequence[str] = tuple(FEATURES),
    max_batch_size: int = MAX_BATCH_SIZE,
    declared: str | None = None,
    wait: float = 600,
) -> StreamingQuery:
    """Score parquet files as they arrive in ``source``.

    Each micro-batch is judged, scored and replaces its own ``epoch`` folder in both sinks, so a
    micro-batch repeated after a failure leaves no copies.  With ``once`` the stream takes what is
    there and stops.  Records of one request batch may come in several files if they carry its size
    in the column ``declared``: they are then held in the stream's state until all are there, and judged
    once (see :func:`held_batches`).  Without it the all-or-nothing rule looks at one micro-batch, and
    files must not split a request batch.
    """
    records = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    )

    if batch and declared:
        checked = validate_records(records, strict, [*keys, declared], features)
        records = held_batches(checked, batch, declared, keys, features, max_batch_size, wait)

    def run(rows: DataFrame, epoch: int) -> None:
        # Read once: both sinks, and the check of request batches, look at the written rows.
        rows = write_table(rows, "micro_batch")
        if batch and declared:
            scored, refused = judged(rows, scorer, keys, F.col("batch_ok"), features)
        else:
            scored, refused = score_records(rows, scorer, keys, batch, strict, max_batch_size, features)
        scored.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")
        refused.write.mode("overwrite").parquet(f"{quarantine}/epoch={epoch}")

    writer = records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if not once:
        return writer.trigger(processingTime="30 seconds").start()
    # A state with time-outs asks for one more empty micro-batch for ever; the query keeps the settings it starts with.
    empty = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(empty)
    spark.conf.set(empty, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(empty, before)
