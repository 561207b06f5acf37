"""Every registered query of the reference operators against its SQL, at the smallest scale."""

from __future__ import annotations

import datetime
import numbers
import os
from decimal import Decimal
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

from plinth import plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if getattr(v, "ndim", 0) or isinstance(v, list | tuple):
            return tuple(plain(x) for x in v)
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
            return ""
        if isinstance(v, bool | np.bool_):
            return str(bool(v))
        if isinstance(v, numbers.Number | Decimal):
            return str(round(float(v), 6))
        return str(pd.Timestamp(v)) if isinstance(v, datetime.date) else str(v)

    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    got = plans.QUERIES[name](spark, SF).toPandas()
    if name in plans.ORACLE_SQL:
        want = duck.execute(plans.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_filters_reach_the_scan(spark):
    plan = plans.QUERIES["price_floor"](spark, SF)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice)" in plan and "GreaterThanOrEqual(o_totalprice,400000.0)" in plan
    assert "o_custkey" not in plan.split("ReadSchema")[1]


def test_entry_works_without_the_optional_parts(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(plans.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
