"""Printable columns for KPI, triage and metrics tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_AVAILABLE = "N/A"


def _fixed(value: Column, decimals: int) -> Column:
    """Fixed decimals, halves to even (the formatter alone rounds them up); null stays null."""
    return F.when(value.isNotNull(), F.format_string(f"%.{decimals}f", F.bround(value, decimals)))


def currency(value: Column, symbol: str = "£") -> Column:
    """``1234.6`` -> ``£1,235``; ``-50`` -> ``£-50``; half to even."""
    text = F.format_number(F.bround(value.cast("double"), 0), 0)
    # A small negative amount prints with its sign: -0.4 -> -0.
    signed = F.when((value < 0) & (text == "0"), F.lit("-0")).otherwise(text)
    return F.coalesce(F.concat(F.lit(symbol), signed), F.lit(NOT_AVAILABLE))


def percent(value: Column, decimals: int = 1) -> Column:
    return F.coalesce(
        F.concat(_fixed(value.cast("double") * 100, decimals), F.lit("%")), F.lit(NOT_AVAILABLE)
    )


def date(value: Column) -> Column:
    """ISO text -> ``09 Jul 2026``; other text passes through; null -> ``unknown``."""
    text = value.cast("string")
    parsed = F.date_format(text.try_cast("timestamp_ntz"), "dd MMM yyyy")
    return F.coalesce(parsed, text, F.lit("unknown"))


def count(value: Column) -> Column:
    return F.coalesce(F.format_number(value.cast("bigint"), 0), F.lit(NOT_AVAILABLE))


def metric(value: Column) -> Column:
    return F.coalesce(_fixed(value.cast("double"), 3), F.lit(NOT_AVAILABLE))


FORMATS = {"currency": currency, "percent": percent, "date": date, "count": count, "metric": metric}


def format_report(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """Replace columns by their printable form: ``{"revenue_at_risk": "currency", ...}``."""
    unknown = sorted(set(formats.values()) - set(FORMATS))
    if unknown:
        raise ValueError(f"unknown formats: {unknown}")
    return df.select(
        *[FORMATS[formats[c]](F.col(c)).alias(c) if c in formats else F.col(c) for c in df.columns]
    )
