"""Every SQL-checked query equals its DuckDB oracle on the small test tables."""

import pytest

from ledgerlens.plans.compare import compare, duck_connect
from ledgerlens.plans.queries import oracle_sql, queries

from conftest import SF_SMALL

SQLS = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    res = compare(df, con, SQLS[name])
    assert res["ok"], res


def test_every_query_has_a_sql_oracle_or_is_a_model():
    rows_only = set(queries()) - set(SQLS)
    assert rows_only <= {"rf_predictions", "lr_predictions", "cv_scores", "rf_feature_importance",
                         "importance_groups", "model_comparison", "model_confusion_matrix",
                         "kmeans_sweep", "kmeans_profile", "wallet_pca"}
