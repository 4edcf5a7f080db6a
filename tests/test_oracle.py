"""Every value-checkable registered query against its DuckDB SQL (sf0.001),
and every rows-only query runs."""
import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import duck, rows_of  # noqa: E402

SLOW_ROWS_ONLY = {"lr_tuned", "rf_tuned", "gbt", "term_similarity_dimsum"}
DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
              "string": "VARCHAR", "boolean": "BOOLEAN", "binary": "BLOB"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_duckdb(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)
    rel = con.sql(E.oracle_sql()[key])
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in sdf.schema.fields:
        st = f.dataType.simpleString()
        assert DUCK_TYPES.get(st, st) == dtypes[f.name], (f.name, st, dtypes[f.name])


@pytest.mark.parametrize("key", sorted(set(E.queries()) - set(E.oracle_sql()) - SLOW_ROWS_ONLY))
def test_rows_only_query_runs(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "title_term_similarity" in df.columns
