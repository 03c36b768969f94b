"""Streams of observations into the record stores."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from quillon.operators.enrich import REJECTS, route
from quillon.operators.upsert import ParquetStore


def merge_stream(stream: DataFrame, store: ParquetStore, seq: Column, checkpoint: str, available_now: bool = True, every: str | None = None) -> StreamingQuery:
    """Merge a stream of one record type into its store, a micro-batch at a time.

    It ends with what is there now, or, with ``available_now=False``, runs on: as data comes, or at the interval ``every``
    (such as ``5 minutes``).

    The merge is keyed and idempotent, so a batch that is replayed after a failure changes nothing; late and
    corrected rows replace earlier ones by key instead of waiting for a watermark.
    """

    def put(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            store.merge(batch, seq)

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return (writer.trigger(processingTime=every) if every else writer).start()


def route_stream(stream: DataFrame, subscriptions: DataFrame, kinds: Mapping[str, str], stores: Mapping[str, ParquetStore], seq: Callable[[], Column], rejects: str, checkpoint: str) -> StreamingQuery:
    """Split a stream of observations by kind into stores; observations of unknown subscriptions go to ``rejects``.

    ``rejects`` is a Parquet folder with one sub-folder a batch, rewritten if the batch is replayed.
    """

    def put(batch: DataFrame, number: int) -> None:
        parts = route(batch, subscriptions, kinds)
        parts.pop(REJECTS).write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        for kind, rows in parts.items():
            if not rows.isEmpty():
                stores[kind].merge(rows, seq())

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, ts: str, key: str, width: str, lateness: str) -> DataFrame:
    """Rows per key and window of event time, final once the watermark has passed; the time is a zoned timestamp."""
    timed = stream.withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", lateness)
    return timed.groupBy(F.window("at", width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")


class RunLog(StreamingQueryListener):
    """Start, end, rows and failure of each finished run."""

    def __init__(self) -> None:
        self.runs: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        self.runs[str(event.runId)] = {"name": event.name, "rows": 0, "ended": False, "error": None}

    def onQueryProgress(self, event) -> None:
        if run := self.runs.get(str(event.progress.runId)):
            run["rows"] += event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if run := self.runs.get(str(event.runId)):
            run.update(ended=True, error=event.exception)


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    """A stream of Parquet files, at most so many a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
