"""Structured Streaming jobs equal their batch counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators.requestlog import events_as_requests
from panelcast.streaming import jobs as sj

SF = "/root/testdata/sf0.001"


def test_stream_metrics_equal_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    out = sj.request_metrics_stream(spark, SF, events.schema, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                                    output_mode="update", file_glob="events.parquet")
    batch = sj.windowed_request_metrics(events_as_requests(events))
    cols = ["window_start", "endpoint", "requests", "errors"]
    assert sorted(out.select(cols).collect()) == sorted(batch.select(cols).collect())
    assert out.agg(F.sum("requests")).first()[0] == events.count()


def test_append_mode_emits_closed_windows_only(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    out = sj.request_metrics_stream(spark, SF, events.schema, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                                    output_mode="append", file_glob="events.parquet")
    total = out.agg(F.sum("requests")).first()[0] or 0
    assert 0 < total <= events.count()


def test_scoring_stream(spark, tmp_path):
    src = spark.createDataFrame([(i, float(i) - 2) for i in range(5)], "id INT, x DOUBLE")
    src.write.parquet(str(tmp_path / "in"))

    def score(batch):
        ok = F.col("x") >= 0
        return batch.where(ok).withColumn("y", F.col("x") * 2), batch.where(~ok)

    out, errors = sj.scoring_stream(
        spark, str(tmp_path / "in"), src.schema, str(tmp_path / "out"), str(tmp_path / "ckpt"), score)
    assert sorted(r.y for r in out.collect()) == [0.0, 2.0, 4.0]
    assert sorted(r.id for r in errors.collect()) == [0, 1]


def test_updates_of_later_runs_replace_a_window(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    source = str(tmp_path / "in")
    for half in (0, 1):
        events.where(F.pmod(F.xxhash64(*events.columns), F.lit(2)) == half).coalesce(1).write.mode("append").parquet(source)
        out = sj.request_metrics_stream(spark, source, events.schema, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                                        watermark="10000 days", output_mode="update")
    batch = sj.windowed_request_metrics(events_as_requests(events))
    cols = ["window_start", "endpoint", "requests", "errors"]
    assert sorted(out.select(cols).collect()) == sorted(batch.select(cols).collect())
