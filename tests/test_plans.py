"""Plan shape of every registered query: no cross products, pruned scans."""
import re

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E

# Model queries fit eagerly while building; their plans are covered by the
# feature queries they read.
EAGER = {"lr_tuned", "rf_tuned", "gbt", "kmeans_clusters", "bisecting_clusters", "kmeans_curves",
         "assembled_features", "lr_grid", "lr_ridge"}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(E.queries()) - EAGER))
def test_no_cross_product(spark, key):
    text = plan_text(E.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_scans_read_only_needed_columns(spark):
    df = E.queries()["len_query"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas, text
    # documents are read for the join key and filter columns only, never n_chars/source
    for s in schemas:
        assert "n_chars" not in s and "source" not in s
