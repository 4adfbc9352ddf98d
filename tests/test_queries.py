"""Every registered query with SQL gives the rows of its SQL; the others run.

Fits of hundreds of trees take minutes each: with ``RUN_SLOW=1`` only (tests/test_models.py covers
the operators on small input).
"""

from __future__ import annotations

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from ebbline.plans import registry

SF = "/root/testdata/sf0.001"
SLOW = {"ml_gbt", "ml_gbt_params", "ml_predict", "ml_cv", "ml_search", "ex_attr_trees", "ex_importance_trees"}
#: Without rows at this size, on both sides.
EMPTY = {"agg_roll_anchor"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
#: Without those on training text, which tests/llm covers.
QUERIES = {n: q for n, q in entry.queries().items() if n in registry.QUERIES}
ORACLES = {n: q for n, q in entry.oracle_sql().items() if n in registry.ORACLES}


def ran(names):
    slow = pytest.mark.skipif(not os.environ.get("RUN_SLOW"), reason="RUN_SLOW not set")
    return [pytest.param(n, marks=slow) if n in SLOW else n for n in sorted(names)]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", ran(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    allowed = ["no rows"] if name in EMPTY else []
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF) == allowed


@pytest.mark.parametrize("name", ran(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
