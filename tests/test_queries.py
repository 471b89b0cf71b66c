"""Registered queries against their SQL, on the given tables and on a copy in
which one user, one part and one asking user hold a third of all rows."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from basketry.operators import recommend, sequence
from basketry.sources import star
from check_queries import TABLES, database, rows_of, type_differences

SMALL = "/root/testdata/sf0.001"
NO_SQL = {"gbt_evaluation", "gbt_importance", "gbt_recommend"}
SKEWED = [
    "base_orders",
    "base_order_products",
    "user_features",
    "user_product_history",
    "user_product_features",
    "training_matrix",
    "request_features",
    "recommend_topn",
    "response_summary",
]
# table: rows at this size; the last three are pairs, candidates and positives.
EXPECTED = {"orders": 1500, "order_products": 5848, "pairs": 4342, "candidates": 3409, "positives": 148}


def same(spark, con, name, sf_dir):
    df = queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, got) == rows_of(columns, want)
    assert not type_differences(df.columns, got, columns, want)


LLM = {name for name in queries() if name == "pipeline" or name.startswith("op")}


def test_every_query_has_sql_or_is_named_here():
    assert set(queries()) - LLM - set(oracle_sql()) == NO_SQL
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def small():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - LLM))
def test_query(spark, small, name):
    same(spark, small, name, SMALL)


def test_known_counts(spark):
    counts = {r.table_name: r.row_count for r in queries()["table_row_counts"](spark, SMALL).collect()}
    assert counts["orders"] == EXPECTED["orders"] and counts["order_products"] == EXPECTED["order_products"]
    pairs = queries()["user_product_features"](spark, SMALL)
    assert pairs.count() == EXPECTED["pairs"]
    labels = {r.is_reordered_target: r.row_count for r in queries()["label_distribution"](spark, SMALL).collect()}
    assert sum(labels.values()) == EXPECTED["candidates"] and labels[1] == EXPECTED["positives"]
    assert pairs.filter("user_product_total_buys > 1").count() == 796
    assert pairs.filter("user_product_order_streak = 0").count() == 613


def test_orphans_are_reported(spark, tmp_path):
    """A tenth of the orders and of the parts is missing."""
    con = duckdb.connect()
    cut = {"orders": "WHERE o_orderkey % 10 != 3", "part": "WHERE p_partkey % 10 != 3"}
    for t in TABLES:
        con.execute(f"COPY (FROM read_parquet('{SMALL}/{t}.parquet') {cut.get(t, '')}) TO '{tmp_path}/{t}.parquet'")
    con = database(str(tmp_path))
    for name in ("fk_violations", "base_order_products", "user_product_features", "not_null_violations", "pk_violations"):
        same(spark, con, name, str(tmp_path))
    found = {r.check_name: r.violations for r in queries()["fk_violations"](spark, str(tmp_path)).collect()}
    lines, parts = con.execute(
        f"""SELECT count(DISTINCT (l_orderkey, coalesce(p_brand || p_type, l_partkey::VARCHAR))) FILTER (o_orderkey IS NULL),
                   count(DISTINCT (l_orderkey, l_partkey)) FILTER (p_partkey IS NULL)
        FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey"""
    ).fetchone()
    assert found["order_products.order_id"] == lines > 500 and found["order_products.product_id"] == parts > 500
    assert found["products.aisle_id"] == 0


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    hot = {
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
        "lineitem": "SELECT * REPLACE (CASE WHEN l_suppkey % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey)",
        "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id)",
    }
    for t in TABLES:
        source = os.path.join(SMALL, f"{t}.parquet")
        con.execute(f"COPY ({hot.get(t, 'SELECT *')} FROM read_parquet('{source}')) TO '{folder}/{t}.parquet'")
    return folder, database(folder)


@pytest.mark.parametrize("name", SKEWED)
def test_hot_keys(spark, skewed, name, monkeypatch):
    """The limits are lowered so that the hot user's groups are cut in slices."""
    monkeypatch.setattr(star, "SHORT_MAX", 100)
    monkeypatch.setattr(star, "SLICE_ROWS", 1)
    monkeypatch.setattr(sequence, "SLICE_LENGTH", 16)
    monkeypatch.setattr(recommend, "CONTEXTS_PER_SLICE", 8)
    folder, con = skewed
    same(spark, con, name, folder)


def test_one_user_with_all_orders_on_two_days(spark, tmp_path, monkeypatch):
    """Days alone cannot cut the group: key ranges within a day do."""
    monkeypatch.setattr(star, "SHORT_MAX", 100)
    monkeypatch.setattr(star, "SLICE_ROWS", 50)
    folder, con = str(tmp_path), duckdb.connect()
    one_user = """SELECT * REPLACE (
        1 AS o_custkey,
        CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '1997-01-01' ELSE TIMESTAMP '1997-02-01' END AS o_orderdate)"""
    for t in TABLES:
        chosen = one_user if t == "orders" else "SELECT *"
        source = os.path.join(SMALL, f"{t}.parquet")
        con.execute(f"COPY ({chosen} FROM read_parquet('{source}')) TO '{folder}/{t}.parquet'")
    for name in ("base_orders", "user_product_features"):
        same(spark, database(folder), name, folder)
