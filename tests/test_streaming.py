import pytest
from conftest import rows
from builders import make_catalog, make_requests, small_world
from pyspark.sql import functions as F

from basketry.plans.feature_build import build_layers
from basketry.plans.serving import Serving
from basketry.streaming.scoring import answer_stream, request_stream


def test_stream_equals_batch_and_goes_on_after_a_restart(spark, tmp_path):
    layers = build_layers(*small_world(spark))
    served = Serving(
        layers,
        make_catalog(spark, {10: "milk"}),
        lambda df: df.withColumn("reorder_prob", F.col("user_product_total_buys") / 10),
    )
    requests = make_requests(spark, [(i, 1 + i % 4, i % 24, i % 7, None, 2) for i in range(40)])
    incoming, sink, sums, mark = (str(tmp_path / n) for n in ("in", "out", "sums", "mark"))

    def run():
        stream = request_stream(spark, incoming, files_per_trigger=1)
        query = answer_stream(stream, served, sink, mark, summary_sink=sums, available_now=True)
        query.awaitTermination()

    requests.filter("request_id < 25").repartition(3).write.parquet(incoming)
    run()
    first = spark.read.parquet(sink).drop("batch")
    assert rows(first) == rows(served.recommend(requests.filter("request_id < 25")))
    requests.filter("request_id >= 25").repartition(2).write.mode("append").parquet(incoming)
    run()
    answers = spark.read.parquet(sink)
    assert answers.select("batch").distinct().count() >= 4
    assert rows(answers.drop("batch")) == rows(served.recommend(requests))
    assert rows(spark.read.parquet(sums).drop("batch")) == rows(served.summarize(requests))


def test_a_repeated_batch_leaves_no_duplicates(spark, tmp_path):
    layers = build_layers(*small_world(spark))
    served = Serving(
        layers,
        make_catalog(spark, {10: "milk"}),
        lambda df: df.withColumn("reorder_prob", F.col("user_product_total_buys") / 10),
    )
    requests = make_requests(spark, [(1, 1, 1, 1, None, 5)])
    incoming, sink = str(tmp_path / "in"), str(tmp_path / "out")
    requests.write.parquet(incoming)
    # A lost checkpoint makes the stream start over: batch 0 is answered twice.
    for attempt in ("a", "b"):
        query = answer_stream(
            request_stream(spark, incoming), served, sink, str(tmp_path / attempt), available_now=True
        )
        query.awaitTermination()
    assert rows(spark.read.parquet(sink).drop("batch")) == rows(served.recommend(requests))


def test_a_failing_batch_is_answered_after_a_restart(spark, tmp_path):
    layers = build_layers(*small_world(spark))
    failures = {"left": 1}

    def scorer(df):
        if failures["left"]:
            failures["left"] -= 1
            raise RuntimeError("lost")
        return df.withColumn("reorder_prob", F.col("user_product_total_buys") / 10)

    served = Serving(layers, make_catalog(spark, {10: "milk"}), scorer)
    requests = make_requests(spark, [(i, 1 + i % 3, 1, 1, None, 5) for i in range(12)])
    incoming, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    requests.repartition(2).write.parquet(incoming)

    def run():
        stream = request_stream(spark, incoming, files_per_trigger=1)
        answer_stream(stream, served, sink, mark, available_now=True).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert rows(spark.read.parquet(sink).drop("batch")) == rows(served.recommend(requests))
