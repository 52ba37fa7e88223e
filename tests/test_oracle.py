"""Every registered query against its DuckDB oracle (rows, schema, values)."""

import pytest

import __spark_entry__ as E
from scripts.check_oracle import canon, duck, spark_type_family
from tests.conftest import SF_ORACLE

# The training-data operators have their own tests in tests/llm.
QUERIES = {k: f for k, f in E.queries().items() if k not in E.LLM_QUERIES}
SQL = {k: q for k, q in E.oracle_sql().items() if k not in E.LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) >= 69


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    stypes = dict(zip(df.columns, [spark_type_family(f.dataType.simpleString()) for f in df.schema.fields]))
    dtypes = dict(zip(rel.columns, [spark_type_family(str(t)) for t in rel.types]))
    assert stypes == dtypes
    assert len(srows) == len(drows)
    assert canon(srows, df.columns) == canon(drows, rel.columns)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "month_name", "revenue", "margin", "orders", "mom_revenue_growth_pct"]
    assert df.count() > 0
