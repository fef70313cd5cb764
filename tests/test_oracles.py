"""Every registered query with SQL gives the rows DuckDB gives."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tasteloom import spread
from tools.check_oracles import compare

# Queries in which joins or numbering split hot keys.
SPREADING = [
    "encode_frequency", "flatten_recommendations", "prediction_yield", "rownum_latest",
    "topk_rank_per_user", "interaction_frequency", "feature_table", "join_hits", "join_id_map",
    "drop_missing_predictions", "enrich_image", "serve_filter_sort_page", "evaluation_report",
]


@pytest.fixture(scope="module")
def con(small):
    connection = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, small, con, name):
    df = entry.queries()[name](spark, small)
    assert compare(df, con, entry.oracle_sql()[name]).startswith("ok")


@pytest.mark.parametrize("name", SPREADING)
def test_matches_sql_with_hot_keys(spark, small, con, name, monkeypatch):
    monkeypatch.setattr(spread, "HOT_ROWS", 7)
    df = entry.queries()[name](spark, small)
    assert compare(df, con, entry.oracle_sql()[name]).startswith("ok")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["user_id", "product_id", "rank", "prediction"]
