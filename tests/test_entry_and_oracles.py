import duckdb
import pytest

import __spark_entry__ as E
from segscore.sources.tables import TABLES
from tests.conftest import SF

FAST_SQL = ["customer_features", "standard_scale", "feature_moments", "corr_pairs", "corr_bands", "reduced_features",
            "power_params", "pr_curve", "average_precision", "roc_auc", "top_share_flags", "gain_curve",
            "stratified_folds", "classification_report", "knn_minority", "smote_synthetic", "request_validation"]


def _canon(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(None if v != v else v for v in r) for r in df[cols].itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST_SQL)
def test_query_matches_duckdb(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    assert _canon(got) == _canon(exp)


def test_entry_smoke(spark):
    out = E.entry(spark)
    rows = out.collect()
    assert len(rows) == 5 and sum(r["n"] for r in rows) == 150
