"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

from lodgeflow.plans import oracle as O
from lodgeflow.plans import registry as R
from tests.oracle_compare import canon, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _keys():
    return sorted(O.oracle_sql())


def test_every_query_has_an_oracle_or_is_metadata_only():
    assert set(R.queries()) - set(O.oracle_sql()) <= {"profile_wide", "sample_bernoulli"}
    import __spark_entry__ as E
    assert set(R.queries()) <= set(E.queries()) and set(O.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("key", _keys())
def test_matches_duckdb(spark, con, key):
    df = R.queries()[key](spark, SF)
    sn, sr = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(O.oracle_sql()[key])
    dn, dr = canon([d[0] for d in cur.description], cur.fetchall())
    assert sn == dn
    assert len(sr) == len(dr)
    assert sr == dr


SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("key", _keys())
def test_column_types_match_duckdb(spark, con, key):
    df = R.queries()[key](spark, SF)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    rel = con.sql(O.oracle_sql()[key])
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_wide_profile_covers_the_whole_table(spark, con):
    row = R.queries()["profile_wide"](spark, SF).first()
    fact = R.queries()["fct_reviews"](spark, SF)
    assert "profile_wide" in O.oracle_sql() and row["data_type"] == "full"
    assert row["total_rows"] == fact.count()
    assert {f"{c}_{m}" for c in fact.columns for m in ("null_count", "distinct_count")} <= set(row.asDict())
