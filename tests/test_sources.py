import os
import shutil
import subprocess
import sys
from decimal import Decimal

import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry import schema
from basketry.operators.features import prior_items
from basketry.operators.cleaning import cleaned_orders
from basketry.plans.workspace import INPUTS, open_workspace
from basketry.session import shared_folder, stage
from basketry.sources.csv_tables import load_base_tables, load_csv, write_csv
from basketry.sources.store import FeatureStore, analyze_table, column_catalogue, save_table
from builders import make_items, make_orders


def put(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HEADER = "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"


def test_csv_tables(spark, tmp_path):
    files = {
        "aisles": put(tmp_path, "a.csv", 'aisle_id,aisle\n1,"prepared soups, salads"\n2,"say ""cheese"""\n'),
        "departments": put(tmp_path, "d.csv", "department_id,department\n1,frozen\n"),
        "products": put(tmp_path, "p.csv", 'product_id,product_name,aisle_id,department_id\n1,"Cookies",1,1\n'),
        "orders": put(tmp_path, "o.csv", HEADER + "1,7,prior,1,2,8,\n2,7,test ,2,3,7,15.0\n"),
        "order_products": [
            put(tmp_path, "prior.csv", "order_id,product_id,add_to_cart_order,reordered\n1,1,1,0\n"),
            put(tmp_path, "train.csv", "order_id,product_id,add_to_cart_order,reordered\n2,1,1,1\n"),
        ],
    }
    t = load_base_tables(spark, files)
    assert rows(t["aisles"]) == [(1, "prepared soups, salads"), (2, 'say "cheese"')]
    assert rows(t["orders"]) == [(1, 7, "prior", 1, 2, 8, None), (2, 7, "test", 2, 3, 7, Decimal("15.0"))]
    assert rows(t["order_products"]) == [(1, 1, 1, 0), (2, 1, 1, 1)]
    for name, df in t.items():
        assert [f.dataType for f in df.schema] == [f.dataType for f in schema.BASE_TABLES[name]]


@pytest.mark.parametrize("line", ["1,abc,prior,1,2,8,\n", "1,7,prior,99999,2,8,\n", "1,7,prior,1,2,8,x\n"])
def test_a_bad_value_fails_the_load(spark, tmp_path, line):
    path = put(tmp_path, "o.csv", HEADER + line)
    with pytest.raises(Exception):
        load_csv(spark, schema.ORDERS, path).collect()


def test_a_header_in_another_order_fails_the_load(spark, tmp_path):
    path = put(tmp_path, "a.csv", "aisle,aisle_id\n1,soup\n")
    with pytest.raises(Exception):
        load_csv(spark, schema.AISLES, path).collect()


def test_csv_round_trip(spark, tmp_path):
    orders = make_orders(spark, [(1, 7, "prior", 1, 2, 8, None), (2, 7, "train", 2, 3, 7, 15)])
    write_csv(orders, str(tmp_path / "out"))
    assert rows(load_csv(spark, schema.ORDERS, str(tmp_path / "out"))) == rows(orders)


def test_wide_keys_change_only_the_keys():
    wide = schema.with_wide_keys(schema.ORDERS)
    assert wide["order_id"].dataType.simpleString() == "bigint"
    assert wide["order_number"] == schema.ORDERS["order_number"]


def test_store_versions(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "store"))
    with pytest.raises(LookupError):
        store.read("users")
    first = store.publish("users", spark.range(3), cluster_by=["id"])
    second = store.refresh("users", lambda: spark.range(5))
    assert store.current_version("users") == 2
    assert (store.read("users").count(), store.read("users", 1).count()) == (5, 3)
    assert (first.count(), second.count()) == (3, 5)  # the first reader keeps its files
    store.publish("split", spark.range(4).withColumn("eval_set", F.lit("prior")), partition_by=["eval_set"])
    assert store.read("split").filter("eval_set = 'prior'").count() == 4


def test_half_a_publish_is_not_seen(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "store"))
    store.publish("users", spark.range(3))
    with pytest.raises(Exception):
        store.publish("users", spark.range(3).select(F.raise_error(F.lit("stop")).alias("id")))
    assert store.read("users").count() == 3


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    orders = make_orders(spark, [(i, 1, "prior", i) for i in range(1, 40)])
    items = make_items(spark, [(i, p, 0) for i in range(1, 40) for p in (1, 2)])
    names = {"orders": orders, "order_products": items}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        saved = {
            n: save_table(df, f"bucketed_{n}", str(tmp_path / n), ["order_id"], buckets=4) for n, df in names.items()
        }
        saved = {n: save_table(df, f"bucketed_{n}", str(tmp_path / n), ["order_id"], 4) for n, df in names.items()}
        joined = prior_items(saved["order_products"], cleaned_orders(saved["orders"]))
        assert "Exchange" not in plan(joined)
        assert rows(joined) == rows(prior_items(items, cleaned_orders(orders)))
        analyze_table(spark, "bucketed_orders")
        stats = spark.sql("DESCRIBE EXTENDED bucketed_orders").filter("col_name = 'Statistics'").first()
        assert "39 rows" in stats.data_type
        described = {c.name: c.description for c in spark.catalog.listColumns("bucketed_orders")}
        assert described["order_dow"] == "day of week, Saturday is 0"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{n}")


def test_column_catalogue(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(column_catalogue(df)) == [(1, "a", "int", 0), (2, "b", "string", 1)]


def test_stage_uses_the_shared_folder(spark):
    staged = stage(spark.range(5), "numbers")
    assert shared_folder(spark) in staged.inputFiles()[0]
    assert rows(staged) == [(i,) for i in range(5)]


def test_scratch_can_be_dropped(tmp_path):
    """In a process of its own, so that other tests keep their tables."""
    code = (
        "from basketry.session import *\n"
        "import os\n"
        "spark = local_session('1')\n"
        "spark.sparkContext.setLogLevel('ERROR')\n"
        "stage(spark.range(3), 'n')\n"
        "folder = scratch_folder(spark).removeprefix('file:')\n"
        "assert os.path.isdir(folder)\n"
        "drop_scratch(spark)\n"
        "assert not os.path.exists(folder)\n"
        "from basketry.plans.workspace import open_workspace\n"
        "first = open_workspace(spark, '/root/testdata/sf0.001')\n"
        "n = first.orders.count()\n"
        "drop_scratch(spark)\n"
        "assert open_workspace(spark, '/root/testdata/sf0.001').orders.count() == n == 1500\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, cwd=ROOT)


def test_a_workspace_is_rebuilt_when_a_file_changes(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in INPUTS:
        shutil.copy(f"{source}/{name}.parquet", tmp_path / f"{name}.parquet")
    first = open_workspace(spark, str(tmp_path))
    assert open_workspace(spark, str(tmp_path)) is first
    half = duckdb.connect()
    target = tmp_path / "orders.parquet"
    half.execute(
        f"COPY (FROM read_parquet('{source}/orders.parquet') WHERE o_custkey > 75) TO '{target}' (FORMAT parquet)"
    )
    second = open_workspace(spark, str(tmp_path))
    assert second is not first
    assert second.orders.filter("user_id <= 75").isEmpty() and not second.orders.isEmpty()
