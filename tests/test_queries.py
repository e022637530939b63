"""Every registered engine query with SQL against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from strandline.plans.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def canon(rows, columns):
    return sorted(tuple(repr(round(v, 6)) if isinstance(v, float) else repr(v) for _, v in sorted(zip(columns, r, strict=True))) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0


def test_both_kernels_agree(spark):
    a, b = (sorted(map(tuple, QUERIES[n](spark, DIR).collect())) for n in ("dp5_align", "dp7_align_checkpointed"))
    assert a == b
