"""The driver contract: entry smoke test and oracle agreement on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from fusekit.plans.oracle import ORACLE
from fusekit.plans.queries import all_queries
from tests.conftest import SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ROWS_ONLY = {"descent_neighbours", "pca_features", "mlp_predictions", "route_l_predictions", "linear_predictions"}


def canon(v):
    if isinstance(v, float):
        return round(v, 6) if math.isfinite(v) else v
    return v


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["filename", "predicted_label"] and len(rows) > 0


def test_every_query_has_oracle_or_is_rows_only():
    assert set(all_queries()) - set(ORACLE) == ROWS_ONLY
    assert set(all_queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(ORACLE)))
def test_query_matches_oracle_sf0001(spark, duck, name):
    df = E.queries()[name](spark, SMOKE)
    cols = sorted(df.columns)
    got = sorted((tuple(canon(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(canon(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SMOKE)
    assert df.count() > 0


def test_other_queries_stay_when_the_subpackage_cannot_be_imported(monkeypatch):
    """A library that only the training-data operators need is missing."""
    import sys
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("fusekit.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    assert set(E.queries()) == set(all_queries()) and set(E.oracle_sql()) == set(ORACLE)
