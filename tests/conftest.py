from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

LINE_SCHEMA = (
    "customer_id bigint, invoice_id string, invoice_date timestamp_ntz, quantity double, unit_price double, stock_code string"
)

# Three customers with eight lines; the results expected of them are computed by hand.
CANONICAL = [
    (1, "K10", "2010-02-02", 4, 2.5, "P"),
    (1, "K11", "2010-05-10", 1, 6.0, "Q"),
    (1, "K11", "2010-05-10", 2, 3.0, "R"),
    (2, "K20", "2010-03-20", 10, 1.2, "P"),
    (2, "K21", "2010-04-25", 6, 1.5, "P"),
    (2, "K22", "2010-05-28", 2, 9.5, "S"),
    (3, "K30", "2010-04-05", 3, 3.0, "Q"),
    (3, "K30", "2010-04-05", 5, 2.0, "S"),
]
SNAPSHOT = "2010-06-01"


@pytest.fixture(scope="session")
def spark():
    from ebbline.session import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lines(spark):
    """Build transaction lines from tuples; dates are ISO text or None."""

    def build(rows, schema=LINE_SCHEMA):
        def moment(v):
            return dt.datetime.fromisoformat(v) if isinstance(v, str) else v

        typed = [
            (c, i, moment(d), None if q is None else float(q), None if p is None else float(p), *rest)
            for c, i, d, q, p, *rest in rows
        ]
        return spark.createDataFrame(typed, schema)

    return build


@pytest.fixture(scope="session")
def canonical(lines):
    return lines(CANONICAL)


@pytest.fixture(scope="session")
def rows():
    """Collect a frame into ``{key: row dict}``."""

    def collect(df, key="customer_id"):
        return {r[key]: r.asDict() for r in df.collect()}

    return collect


def days_after(snapshot: str, days: int) -> str:
    return (dt.datetime.fromisoformat(snapshot) + dt.timedelta(days=days)).isoformat(sep=" ")
