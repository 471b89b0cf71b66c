"""The phases one after the other, from CSV files to ranked lists."""

import re

import pytest
from conftest import rows
from builders import make_requests

from basketry import jobs, schema
from basketry.operators import recommend
from basketry.operators.classifier import GbtSettings
from basketry.plans.feature_build import build_layers, published_layers
from basketry.plans.serving import Serving
from basketry.sources.store import FeatureStore


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def write_files(folder, spoil=False):
    users, products = range(1, 61), range(1, 13)
    orders = ["order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order"]
    items = {"prior": [], "train": []}
    order_id = 0
    for user in users:
        for number in range(1, 6):
            order_id += 1
            last = "test" if user % 5 == 0 else "train"
            eval_set = last if number == 5 else "prior"
            gap = "" if number == 1 else f"{(user + number) % 30}.0"
            orders.append(f"{order_id},{user},{eval_set},{number},{(user + number) % 7},{user % 24},{gap}")
            if eval_set == "test":
                continue
            basket = [p for p in products if (user * p + (number if p > 6 else 0)) % 4 == 0]
            for place, p in enumerate(basket, 1):
                items[eval_set].append(f"{order_id},{p},{place},{int(number > 1)}")
    if spoil:
        items["prior"].append("999999,1,1,0")
    head = "order_id,product_id,add_to_cart_order,reordered"
    texts = {
        "aisles.csv": ["aisle_id,aisle", '1,"soups, salads"', "2,dairy"],
        "departments.csv": ["department_id,department", "1,frozen"],
        "products.csv": ["product_id,product_name,aisle_id,department_id"]
        + [f'{p},"product, {p}",{1 + p % 2},1' for p in products],
        "orders.csv": orders,
        "order_products__prior.csv": [head, *items["prior"]],
        "order_products__train.csv": [head, *items["train"]],
    }
    for name, lines in texts.items():
        (folder / name).write_text("\n".join(lines) + "\n")


def test_from_files_to_lists(spark, tmp_path):
    source, model, out = tmp_path / "csv", str(tmp_path / "model"), str(tmp_path / "out")
    source.mkdir()
    write_files(source)
    store = FeatureStore(spark, str(tmp_path / "store"))
    counts = {r.table_name: r.row_count for r in jobs.load(store, str(source)).collect()}
    assert counts["orders"] == 300 and counts["products"] == 12
    assert dict(store.read("orders").dtypes)["order_number"] == "smallint"
    matrix = jobs.build(store, user_folders=8)
    assert matrix.columns == [*schema.IDENTIFIERS, schema.TARGET, *schema.FEATURES]
    assert matrix.filter("user_id % 5 = 0").isEmpty() and matrix.count() > 100
    settings = GbtSettings(max_rounds=3, max_depth=2, min_rows_per_node=1)
    assert jobs.fit(store, model, settings).auc.first().auc > 0.5
    requests = make_requests(spark, [(1, 1, 10, 0, 7.0, 3), (2, 5, 19, 4, None, 10), (3, 999, 1, 1, None, 10)])
    served = jobs.open_serving(store, model)
    text = plan(served.recommend(requests))
    assert len([x for x in text.splitlines() if "PartitionFilters: [user_mod_8" in x]) == 2
    staged = Serving(
        build_layers(store.read("orders"), store.read("order_products")), served.catalog, served.scorer
    )
    assert rows(served.recommend(requests)) == rows(staged.recommend(requests))
    assert rows(served.summarize(requests)) == rows(staged.summarize(requests))
    layers = published_layers(store)
    one = recommend.lookup_user(layers.pairs, layers.users, layers.products, 5)
    assert rows(one) == rows(recommend.lookup_user(staged.layers.pairs, staged.layers.users, staged.layers.products, 5))
    # The plan shows each scan before and after execution.
    assert len(set(re.findall(r"PartitionFilters: \[[^\]]*user_mod_8", plan(one)))) == 2
    jobs.serve(store, model, requests, out)
    lists = spark.read.parquet(f"{out}/recommendations")
    assert lists.schema.names == schema.RECOMMENDATION.names
    assert lists.filter("request_id = 1").count() <= 3 and not lists.filter("request_id = 2").isEmpty()
    summaries = {r.request_id: r.candidates_scored for r in spark.read.parquet(f"{out}/summaries").collect()}
    assert summaries[3] == 0 and summaries[1] > 0


def test_a_broken_constraint_stops_the_load(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.mkdir(), bad.mkdir()
    write_files(good)
    write_files(bad, spoil=True)
    store = FeatureStore(spark, str(tmp_path / "store"))
    jobs.load(store, str(good))
    before = rows(store.read("order_products"))
    with pytest.raises(ValueError, match="order_products.order_id: 1"):
        jobs.load(store, str(bad))
    assert store.current_version("order_products") == 1
    assert rows(store.read("order_products")) == before


def test_purge_delete_and_check(spark, tmp_path):
    source = tmp_path / "csv"
    source.mkdir()
    write_files(source)
    with open(source / "products.csv", "a") as f:
        f.write('77,"never sold",1,1\n')
    store = FeatureStore(spark, str(tmp_path / "store"))
    jobs.load(store, str(source))
    jobs.build(store, user_folders=2)
    reports = jobs.checks(store)
    assert reports[1].isEmpty()
    assert reports[2].first()[0] == 0 and reports[3].first()[0] == 0
    assert {r.violations for r in reports[5].collect()} == {0}
    unique = reports[8].first()
    assert unique.total_rows == unique.unique_user_product_pairs

    with pytest.raises(ValueError, match="1 of the products"):
        jobs.delete_products(store, spark.createDataFrame([(4,), (77,)], "product_id int"))
    jobs.delete_products(store, spark.createDataFrame([(77,)], "product_id int"))
    assert store.read("products").filter("product_id = 77").isEmpty()

    gone = store.read("orders").filter("user_id = 4").select("order_id")
    ids = [r.order_id for r in gone.collect()]
    jobs.purge(store, gone)
    assert store.read("orders").filter("user_id = 4").isEmpty()
    left = store.read("order_products")
    assert left.filter(left.order_id.isin(ids)).isEmpty() and not left.isEmpty()
    assert jobs.violations(jobs.base_tables(store)).isEmpty()
    assert len(store.read("orders", 1).filter("user_id = 4").collect()) == 5
