"""A stream of requests answered from published layers."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from basketry.plans.serving import Serving
from basketry.schema import REQUEST
from basketry.sources.files import SmallFiles
from basketry.sources.store import FeatureStore, Snapshot

#: The serving side of a micro-batch, by its number.
ServingOf = Callable[[int], Serving]


def request_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """New request files as they land in a folder."""
    return (
        spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    )


def serving_by_commit(store: FeatureStore, model, open_at: Callable[[Snapshot, object], Serving], record: str) -> ServingOf:
    """Serving that follows the store: each micro-batch is answered from the commit
    that is current when it begins, all layers of it together.

    The commit is written down before the batch is answered, so a batch repeated
    after a failure gives the same answers although the layers were refreshed
    meanwhile.  ``record`` belongs to the stream's checkpoint: one is of no use
    without the other.
    """
    files, held = SmallFiles(store.spark, record), {}

    def serving(batch_id: int) -> Serving:
        name = f"{batch_id:012d}.json"
        if not files.exists(name):
            files.write_once(name, json.dumps({"commit": store.snapshot().commit}))
        commit = json.loads(files.read(name))["commit"]
        if commit not in held:
            held.clear()
            held[commit] = open_at(store.snapshot(commit), model)
        return held[commit]

    return serving


def answer_stream(
    requests: DataFrame,
    serving: Serving | ServingOf,
    sink: str,
    checkpoint: str,
    summary_sink: str | None = None,
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Rank each micro-batch with the batch operator and store its answers.

    Ranking needs a row-number window, which a streaming plan refuses, so it
    runs per micro-batch.  Each request is answered on its own, hence there is
    no state and no watermark.  A micro-batch owns one folder of the sink and
    overwrites it, so a batch repeated after a failure leaves no duplicates.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            side = serving(batch_id) if callable(serving) else serving
            side.recommend(batch).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
            if summary_sink:
                side.summarize(batch).write.mode("overwrite").parquet(f"{summary_sink}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
