"""Request metrics over a request log (batch or stream).

Counts per (endpoint, status) and a cumulative latency histogram per
endpoint with fixed upper bounds plus ``+Inf``; only ``/api/`` paths are
timed. Each table is one grouped aggregate (partial aggregation per task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Latency histogram upper bounds in seconds.
LATENCY_BOUNDS = (0.05, 0.1, 0.25, 0.5, 1.0, 2.5)

# The testdata ``events`` table read as a request log: endpoint from the
# event type, status 500 for 'error' events, latency = value / 100 seconds.
LATENCY_SCALE = 100.0


def events_as_requests(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("/api/"), F.col("event_type")).alias("endpoint"),
        F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
        (F.col("value") / F.lit(LATENCY_SCALE)).alias("latency"),
    )


def request_counts(log: DataFrame, by: Sequence[str] = ("endpoint", "status")) -> DataFrame:
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"))


def latency_histogram(log: DataFrame, bounds: Sequence[float] = LATENCY_BOUNDS,
                      by: Sequence[str] = ("endpoint",)) -> DataFrame:
    """Long cumulative histogram: (by..., le, count) with ``le`` '+Inf' last,
    plus the latency sum per group on every row."""
    timed = log.where(F.col("endpoint").startswith("/api/"))
    aggs = [F.count_if(F.col("latency") <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(bounds)]
    wide = timed.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("inf"), F.sum("latency").alias("latency_sum"))
    items = [F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"b{i}").alias("count")) for i, b in enumerate(bounds)]
    items.append(F.struct(F.lit("+Inf").alias("le"), F.col("inf").alias("count")))
    return wide.select(*by, "latency_sum", F.inline(F.array(*items)))
