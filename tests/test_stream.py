"""Streaming: file stream into a snapshot table through foreachBatch; resume
from the checkpoint; a replayed batch leaves silver unchanged."""

import datetime as dt

import pytest
from conftest import rows
from tidewell.plans.streams import BRONZE_SCHEMA, accumulate, accumulate_touched, run_arrivals
from tidewell.session import ddl_schema
from tidewell.sources.tables import SnapshotTable
from tidewell.streaming.refine import refine_stream

T = dt.datetime(2024, 1, 1)


def _orders(spark, recs):
    return spark.createDataFrame([(o, v, a, T + dt.timedelta(minutes=i), "upsert", i)
                                  for i, (o, v, a) in enumerate(recs)], BRONZE_SCHEMA)


def test_resume_processes_only_new_files(spark, tmp_path):
    silver = SnapshotTable(spark, str(tmp_path / "silver"),
                           ddl_schema(spark, "order_id string, amount double, ship_status string"),
                           bucket_key="order_id", buckets=16)
    first = _orders(spark, [("1", 1, 10.0), ("2", 1, 20.0)])
    second = _orders(spark, [("1", 2, 5.0), ("3", 1, 7.0)])
    out = run_arrivals(spark, [first, second], silver, accumulate_touched, "t")
    assert rows(out) == [("1", 15.0, ""), ("2", 20.0, ""), ("3", 7.0, "")]
    assert len(silver.versions()) == 2


def test_replayed_batch_is_skipped(spark, tmp_path):
    silver = SnapshotTable(spark, str(tmp_path / "silver"),
                           ddl_schema(spark, "order_id string, amount double, ship_status string"))
    landing, ckpt = str(tmp_path / "in"), str(tmp_path / "ckpt")
    _orders(spark, [("1", 1, 10.0)]).write.parquet(landing)
    seen = []

    def handle(df, batch_id):
        seen.append(batch_id)
        silver.publish(lambda t: accumulate(t, df.select("order_id", "amount")), "job", batch_id)
        # the same batch delivered again (e.g. after a failure) changes nothing
        silver.publish(lambda t: accumulate(t, df.select("order_id", "amount")), "job", batch_id)

    q = refine_stream(spark, landing, BRONZE_SCHEMA, handle, ckpt)
    assert not q.isActive and seen == [0]
    assert rows(silver.read()) == [("1", 10.0, "")]


def test_stream_flag_and_interval_trigger(spark, tmp_path):
    landing = str(tmp_path / "in")
    _orders(spark, [("1", 1, 1.0)]).write.parquet(landing)
    s = spark.readStream.schema(BRONZE_SCHEMA).parquet(landing)
    assert s.isStreaming
    got = []
    q = refine_stream(spark, landing, BRONZE_SCHEMA, lambda df, i: got.append(df.count()),
                      str(tmp_path / "ck"), trigger="2 seconds", max_files=1)
    q.processAllAvailable()
    assert q.isActive
    q.stop()
    assert not q.isActive and sum(got) == 1


def test_default_trigger_drains_and_stops(spark, tmp_path):
    landing = str(tmp_path / "in")
    _orders(spark, [("1", 1, 1.0), ("2", 1, 2.0)]).write.parquet(landing)
    got = []
    q = refine_stream(spark, landing, BRONZE_SCHEMA, lambda df, i: got.append(df.count()),
                      str(tmp_path / "ck"), trigger=None)
    q.processAllAvailable()
    _orders(spark, [("3", 1, 3.0)]).write.mode("append").parquet(landing)
    q.processAllAvailable()
    assert q.isActive and "isTriggerActive" in q.status and q.lastProgress is not None
    q.stop()
    assert sum(got) == 3 and not q.isActive


def test_byte_limited_batches_drain_the_backlog(spark, tmp_path):
    from tidewell.streaming.refine import size_bytes
    assert size_bytes("4g") == 4 << 30 and size_bytes("512m") == 512 << 20 and size_bytes(7) == 7
    landing = str(tmp_path / "in")
    for i in range(3):
        _orders(spark, [(str(i), 1, float(i))]).write.mode("append").parquet(landing)
    got = []
    refine_stream(spark, landing, BRONZE_SCHEMA, lambda df, b: got.append(df.count()),
                  str(tmp_path / "ck"), max_bytes="1k")
    assert sum(got) == 3 and len(got) >= 2        # several small batches, nothing lost


def test_progress_record_and_drain(spark, tmpdir_str):
    """A slow handler is drained, a record has every batch that ran it, and a
    failing handler's error reaches the caller."""
    import time

    from pyspark.errors import StreamingQueryException

    from tidewell.streaming.progress import Progress, drain
    spark.createDataFrame([(0,)], "id int").limit(0).write.parquet(f"{tmpdir_str}/in")
    seen = []

    def handle(df, batch_id):
        time.sleep(0.5)
        n = df.count()
        seen.append(n)
        if n == 13:
            raise ValueError("thirteen rows")

    with Progress(spark) as p:
        q = refine_stream(spark, f"{tmpdir_str}/in", "id int", handle, f"{tmpdir_str}/ck", trigger="50 milliseconds")
        for n in (3, 5):
            spark.range(n).selectExpr("CAST(id AS INT) AS id").coalesce(1).write.mode("append").parquet(f"{tmpdir_str}/in")
            drain(q, p)
            assert seen[-1] == n
        record = p.record(q.id).filter("input_rows > 0").orderBy("batch").collect()
        assert [r.input_rows for r in record] == [3, 5] and p.totals[str(q.id)][1] == 8
        assert all(r.duration_ms >= r.handler_ms >= 500 and r.started is not None for r in record)
        assert p.record("another").count() == 0
        spark.range(13).selectExpr("CAST(id AS INT) AS id").coalesce(1).write.mode("append").parquet(f"{tmpdir_str}/in")
        with pytest.raises(StreamingQueryException, match="thirteen rows"):
            drain(q, p)
        with pytest.raises(TimeoutError):
            q2 = refine_stream(spark, f"{tmpdir_str}/in", "id int", lambda df, i: time.sleep(3), f"{tmpdir_str}/ck2", trigger="50 milliseconds")
            try:
                drain(q2, timeout=0.5)
            finally:
                q2.stop()
