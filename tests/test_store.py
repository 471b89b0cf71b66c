"""Commits, parts, statistics, refreshes and readers of the store."""

import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows
from builders import make_requests
from pyspark.sql import functions as F
from test_jobs import plan, write_files

from basketry import jobs
from basketry.operators import features, retention
from basketry.plans.feature_build import build_layers, publish_layers, published_layers
from basketry.plans.refresh import refresh_layers
from basketry.plans.serving import Serving, lookup
from basketry.sources.files import SmallFiles
from basketry.sources.store import CommitConflict, FeatureStore
from basketry.streaming.scoring import answer_stream, request_stream, serving_by_commit


@pytest.fixture
def store(spark, tmp_path):
    return FeatureStore(spark, str(tmp_path / "store"))


# -- commits -------------------------------------------------------------------------


@pytest.mark.parametrize("mounted", [True, False])
def test_a_name_is_taken_once(spark, tmp_path, mounted):
    files = SmallFiles(spark, str(tmp_path / "small"))
    files.mounted = mounted  # by a link, or by a rename as in a remote store
    assert files.names() == []
    assert files.write_once("1.json", "ä first") and not files.write_once("1.json", "second")
    assert files.names() == ["1.json"] and files.read("1.json") == "ä first"


def test_two_writers_get_two_numbers(spark, store):
    drafts = [store.write_version("users", spark.range(n)) for n in range(1, 7)]
    with ThreadPoolExecutor(6) as pool:
        made = list(pool.map(store.commit, drafts))
    assert sorted(s.commit for s in made) == [1, 2, 3, 4, 5, 6]
    assert sorted(s.number("users") for s in made) == [1, 2, 3, 4, 5, 6]
    by_number = {s.number("users"): s.version("users").rows for s in made}
    assert {v.number: v.rows for v in store.versions("users")} == by_number
    assert sorted(by_number.values()) == [1, 2, 3, 4, 5, 6]


def test_layers_are_switched_together(spark, store):
    first = store.commit(store.write_version("a", spark.range(1)), store.write_version("b", spark.range(1)))
    drafts = [store.write_version("a", spark.range(2)), store.write_version("b", spark.range(2))]
    assert store.snapshot().commit == first.commit  # written, not seen
    second = store.commit(*drafts)
    assert [x.read("a").count() + x.read("b").count() for x in (first, second, store.snapshot(1))] == [2, 4, 2]
    assert (second.number("a"), second.number("b"), second.commit) == (2, 2, 2)


def test_a_change_meanwhile_is_a_conflict(spark, store):
    base = store.commit(store.write_version("a", spark.range(1)), store.write_version("b", spark.range(1)))
    draft = store.write_version("a", base.read("a"))
    store.publish("c", spark.range(1))  # another layer: no conflict
    store.commit(draft, base=base)
    with pytest.raises(CommitConflict, match="a"):
        store.commit(store.write_version("a", spark.range(9)), base=base)
    store.publish("b", spark.range(3))
    with pytest.raises(CommitConflict, match="b"):
        store.commit(store.write_version("c", spark.range(9)), base=base, reads=["b"])
    assert store.read("c").count() == 1 and store.read("a").count() == 1


# -- statistics and layouts ----------------------------------------------------------


def test_statistics_live_with_a_version(spark, store):
    df = spark.createDataFrame([(1, 0.5, "x", "p"), (2, None, "y", "p"), (9, 2.5, None, "q")], "k long, v double, t string, part string")
    made = store.commit(store.write_version("layer", df, partition_by=["part"]))
    assert rows(made.statistics("layer")) == sorted([
        ("layer", "k", 3, 0, 1.0, 9.0), ("layer", "v", 3, 1, 0.5, 2.5), ("layer", "t", 3, 1, None, None), ("layer", "part", 3, 0, None, None),
    ], key=repr)
    assert rows(made.read_folders("layer", ["part=q"])) == [(9, 2.5, None, "q")]
    store.publish("layer", df.limit(0))
    assert store.snapshot().version("layer").rows == 0 and made.version("layer").rows == 3
    assert store.read("layer").isEmpty() and store.read("layer").columns == df.columns


def test_a_plan_follows_the_statistics(spark, store):
    made = store.commit(store.write_version("names", spark.range(1000).withColumn("name", F.lit("n"))))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        big = spark.range(5000)
        assert "BroadcastHashJoin" in plan(big.join(made.read_small("names"), "id"))
        assert "SortMergeJoin" in plan(big.join(made.read_small("names", limit=20_000), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)


@pytest.fixture
def loaded(spark, store, tmp_path):
    source = tmp_path / "csv"
    source.mkdir()
    write_files(source)
    jobs.load(store, str(source), buckets=4)
    return store


def test_build_joins_items_and_orders_without_an_exchange(spark, loaded):
    again = FeatureStore(spark, loaded.root)  # as another application opens it
    tables = jobs.base_tables(again)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = features.prior_items(tables["order_products"], jobs.cleaned_orders(tables["orders"]))
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        first = rows(joined)
        retention.extend_orders(loaded, tables["orders"].limit(0), tables["order_products"].limit(0))
        tables = jobs.base_tables(loaded)  # a version with added files is read as plain files
        assert rows(features.prior_items(tables["order_products"], jobs.cleaned_orders(tables["orders"]))) == first
        jobs.purge(loaded, tables["orders"].filter("user_id = 4").select("order_id"))
        tables = jobs.base_tables(loaded)
        assert "Exchange" not in plan(features.prior_items(tables["order_products"], jobs.cleaned_orders(tables["orders"])))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)


def test_one_user_is_one_folder(spark, loaded):
    jobs.build(loaded, user_folders=16)
    now = loaded.snapshot()
    layers = build_layers(now.read("orders"), now.read("order_products"))
    from basketry.operators.recommend import lookup_user

    for user in (5, 17, 999):
        got = lookup(now, user)
        assert rows(got) == rows(lookup_user(layers.pairs, layers.users, layers.products, user))
        files = [f for f in got.inputFiles() if "/product_features/" not in f]
        assert {re.search(r"user_mod_16=\d+", f).group() for f in files} == {re.search(r"user_mod_16=\d+", files[0]).group()}
        assert len(files) <= 2  # one of each layer
        assert plan(got).count(f"EqualTo(user_id,{user})") >= 2


# -- refresh -------------------------------------------------------------------------


def layers_of(orders, items):
    built = build_layers(orders, items)
    return [rows(x, *sorted(x.columns)) for x in (built.pairs, built.users, built.products)]


def published_rows(store, folder):
    layers = published_layers(store)
    return [rows(x.drop(folder), *sorted(set(x.columns) - {folder})) for x in (layers.pairs, layers.users, layers.products)]


def new_order(spark, store, order_id, user_id, number, eval_set, basket):
    """An order in the types of the store."""
    orders, items = store.read("orders").schema, store.read("order_products").schema
    one = spark.createDataFrame([(order_id, user_id, eval_set, number, 3, 9, 7)], "order_id int, user_id int, eval_set string, order_number int, order_dow int, order_hour_of_day int, days_since_prior_order int")
    lines = spark.createDataFrame([(order_id, p, i + 1, 1) for i, p in enumerate(basket)], "order_id int, product_id int, add_to_cart_order int, reordered int")
    cast = lambda df, kind: df.select([F.col(f.name).cast(f.dataType) for f in kind])
    return cast(one, orders), cast(lines, items)


def test_a_refresh_equals_a_rebuild_and_keeps_the_rest(spark, loaded):
    jobs.build(loaded, user_folders=32)
    before = loaded.snapshot()
    assert jobs.refresh(loaded).rewritten == 0  # nothing new

    day = [new_order(spark, loaded, 5001, 7, 6, "train", [1, 2, 3, 12]), new_order(spark, loaded, 5002, 8, 6, "train", [4, 9])]
    day.append(new_order(spark, loaded, 5003, 700, 1, "prior", [1, 5]))  # a new user
    jobs.extend(loaded, day[0][0].union(day[1][0]).union(day[2][0]), day[0][1].union(day[1][1]).union(day[2][1]))
    done = jobs.refresh(loaded)
    now = loaded.snapshot()
    assert not done.rebuilt and 1 <= done.rewritten <= 3 < done.folders
    assert done.files_read <= done.rewritten and 1 <= done.files_written <= done.rewritten
    assert published_rows(loaded, "user_mod_32") == layers_of(now.read("orders"), now.read("order_products"))
    old, new = ({(p.gen, p.folder) for p in s.version("user_product_features").parts} for s in (before, now))
    assert len(new - old) == done.rewritten and len(old & new) >= done.folders - done.rewritten - 1
    assert before.read("user_features").count() == before.version("user_features").rows  # its files are still there

    # a second day, with an order that comes before the last one known, and an item that comes late
    jobs.extend(loaded, *new_order(spark, loaded, 6001, 9, 9, "prior", [1, 12]))
    assert jobs.refresh(loaded).rewritten == 1
    early = new_order(spark, loaded, 6002, 9, 7, "prior", [2, 12])
    item = new_order(spark, loaded, 7, 2, 2, "prior", [10])[1].withColumn("add_to_cart_order", F.lit(99).cast("smallint"))
    jobs.extend(loaded, early[0], early[1].union(item.select(early[1].columns)))
    done, now = jobs.refresh(loaded), loaded.snapshot()
    assert not done.rebuilt and done.rewritten < done.folders
    assert published_rows(loaded, "user_mod_32") == layers_of(now.read("orders"), now.read("order_products"))

    # items rewritten: built anew
    jobs.purge(loaded, now.read("orders").filter("user_id = 11").select("order_id"))
    done, now = jobs.refresh(loaded), loaded.snapshot()
    assert done.rebuilt and published_rows(loaded, "user_mod_32") == layers_of(now.read("orders"), now.read("order_products"))


def test_a_broken_constraint_stops_new_orders(spark, loaded):
    orders, items = new_order(spark, loaded, 1, 7, 6, "train", [1])  # the order id is taken
    at = loaded.snapshot().commit
    with pytest.raises(ValueError, match="pk_orders"):
        jobs.extend(loaded, orders, items)
    assert loaded.snapshot().commit == at


@pytest.mark.parametrize("cut", [1, 2, 3, 4, 5, 6, 7])
def test_merged_pairs_equal_whole_ones(spark, cut):
    """Purchases of some products at some of eight orders, divided after order ``cut``."""
    bought = {10: [1, 2, 3, 7, 8], 11: [2, 4, 6, 8], 12: [1, 8], 13: [5, 6, 7], 14: [3, 4, 8], 15: [1], 16: [8]}
    history = spark.createDataFrame(
        [(1, p, n, int(n > min(o)), n) for p, o in bought.items() for n in o], "user_id int, product_id int, order_id int, reordered int, order_number smallint"
    )
    parts = [features.pair_summary(features.purchase_history(history.filter(c))) for c in (f"order_number <= {cut}", f"order_number > {cut}")]
    whole = features.pair_summary(features.purchase_history(history))
    merged = features.merge_pairs(*parts)
    assert merged.columns == whole.columns and rows(merged) == rows(whole)


# -- a stream that follows -----------------------------------------------------------


def test_a_stream_uses_the_layers_of_its_batch(spark, loaded, tmp_path):
    jobs.build(loaded, user_folders=4)
    incoming, sink, mark, record = (str(tmp_path / n) for n in ("in", "out", "mark", "commits"))

    def scorer(df):
        return df.withColumn("reorder_prob", F.lit(0.9))

    def open_at(at, _):
        return Serving(published_layers(at), at.read("products").select("product_id", "product_name"), scorer)

    def run(checkpoint, requests=None):
        if requests is not None:
            requests.coalesce(1).write.mode("append").parquet(incoming)
        serving = serving_by_commit(loaded, None, open_at, record)
        answer_stream(request_stream(spark, incoming, files_per_trigger=1), serving, sink, checkpoint, available_now=True).awaitTermination()
        return [rows(spark.read.parquet(f"{sink}/batch={i}")) for i in range(len(SmallFiles(spark, record).names()))]

    ask = make_requests(spark, [(1, 7, 10, 0, 7.0, 50)])
    first = run(mark, ask)
    orders, items = new_order(spark, loaded, 5001, 7, 6, "train", [1, 2])
    jobs.extend(loaded, orders, items)
    refresh_layers(loaded)
    again = make_requests(spark, [(2, 7, 10, 0, 7.0, 50)])
    second = run(mark, again)
    assert second[0] == first[0] and len(second) == 2
    fresh = rows(open_at(loaded.snapshot(), None).recommend(again))
    assert second[1] == fresh and [r[1:] for r in fresh] != [r[1:] for r in first[0]]
    # the checkpoint is lost: batches are repeated, each from the commit it was answered from
    repeated = run(str(tmp_path / "other"))
    assert repeated == second


def test_publishing_is_one_commit(spark, loaded):
    now = loaded.snapshot()
    made = publish_layers(loaded, now.read("orders"), now.read("order_products"), 4, now)
    assert made.commit == now.commit + 1
    assert {made.version(x).built_from["orders"] for x in ("user_product_features", "user_features", "product_features")} == {1}
