"""Each query that has SQL against that SQL, on the smallest tables."""

import math
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
if not Path(SF).exists():
    pytest.skip("no test tables", allow_module_level=True)

from isoforge.plans import report_queries  # noqa: E402, F401
from isoforge.plans.queries import QUERIES, SQL  # noqa: E402


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    text = lambda v: "" if v is None or isinstance(v, float) and math.isnan(v) else str(float(v)) if isinstance(v, int | float) or type(v).__module__ == "numpy" else str(v)
    return sorted(tuple(map(text, r)) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def db():
    out = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        out.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return out


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(db.execute(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
