"""Structured Streaming jobs.

* ``request_metrics_stream`` (S2): request counts and latency sums per
  endpoint and event-time window, with a watermark so state is dropped
  once a window can no longer change; append output.
* ``scoring_stream`` (S1): stateless validation + scoring of a stream of
  vector requests; each micro-batch writes its predictions and errors
  with ``foreachBatch`` (batch id in the output, so a replayed batch
  overwrites instead of duplicating).

Both run with the checkpoint location under ``spark.checkpoint.dir`` so a
restarted query resumes from its offsets and state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.operators.requestlog import LATENCY_BOUNDS, events_as_requests


def windowed_request_metrics(log: DataFrame, window: str = "1 hour", watermark: str = "2 hours",
                             bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """Per (window, endpoint): requests, errors, latency sum and bucket counts."""
    return (
        log.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window).alias("w"), "endpoint")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("status") == "500").alias("errors"),
            F.sum("latency").alias("latency_sum"),
            *[F.count_if(F.col("latency") <= F.lit(b)).alias(f"le_{str(b).replace('.', '_')}") for b in bounds],
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*")
        .drop("w")
    )


def request_metrics_stream(spark: SparkSession, events_dir: str, schema: StructType, out_path: str,
                           checkpoint: str, window: str = "1 hour", watermark: str = "2 hours",
                           output_mode: str = "append", file_glob: str | None = None) -> DataFrame:
    """Run S2 over the files present now (``availableNow``), then return the
    sink as a batch DataFrame.

    ``append`` writes each window once, after the watermark passes its end
    (windows still open when the run stops are emitted by a later run).
    ``update`` writes the windows that a micro-batch changed into a folder of
    that batch (a replayed batch overwrites its own); the result holds the
    latest row of each window, so none is lost, and the watermark frees the
    state of windows that are past.
    """
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    stream = reader.parquet(events_dir)
    metrics = windowed_request_metrics(events_as_requests(stream), window, watermark)
    writer = metrics.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if output_mode == "append":
        q = writer.outputMode("append").format("parquet").option("path", out_path).start()
        q.awaitTermination()
        return spark.read.schema(metrics.schema).parquet(out_path)
    if output_mode != "update":
        raise ValueError(f"unknown output mode {output_mode!r}; expected append or update")

    def changed(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer.outputMode("update").foreachBatch(changed).start().awaitTermination()
    rows = spark.read.parquet(out_path)
    values = [c for c in metrics.columns if c not in ("window_start", "window_end", "endpoint")]
    latest = rows.groupBy("window_start", "window_end", "endpoint").agg(
        F.max_by(F.struct(*values), "batch_id").alias("latest"))
    return latest.select("window_start", "window_end", "endpoint", "latest.*")


def scoring_stream(spark: SparkSession, requests_path: str, schema: StructType, out_path: str,
                   checkpoint: str, score_batch) -> tuple[DataFrame, DataFrame]:
    """Run S1 over the request files present now; ``score_batch(df)`` returns
    (predictions, errors). Outputs land in ``out_path/{predictions,errors}``
    partitioned by batch id; both tables are returned."""
    stream = spark.readStream.schema(schema).parquet(requests_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        preds, errors = score_batch(batch)  # validates once; both tables read its result
        for name, df in (("predictions", preds), ("errors", errors)):
            (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
             .parquet(f"{out_path}/{name}"))

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{out_path}/predictions"), spark.read.parquet(f"{out_path}/errors")
