"""Streams: stream = batch over several micro-batches, restart, replayed batch ids, bounded dedupe."""

from __future__ import annotations

import json

import pytest
from conftest import SMALL, valid_row
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from visitflow.operators import silver
from visitflow.schema import DELIVERY_SEQ, SILVER_STABLE_COLUMNS
from visitflow.session import scratch_path
from visitflow.sinks.files import SilverBatchSink, write_replay_files
from visitflow.sources.fixture import REDELIVERY_OFFSET, read_bronze
from visitflow.sources.messages import replay_stream
from visitflow.sources.tables import read_silver
from visitflow.streaming import silver as streams


def _stable_rows(df):
    return sorted(map(tuple, df.select(*SILVER_STABLE_COLUMNS).collect()), key=repr)


def test_stream_equals_batch_over_many_microbatches(spark):
    bronze = read_bronze(spark, SMALL)
    inbox = scratch_path(spark, "t-inbox")
    out = scratch_path(spark, "t-out")
    ckpt = scratch_path(spark, "t-ckpt")
    sink = SilverBatchSink(out)
    # First deliveries spread over 4 files, redeliveries in a later wave.
    write_replay_files(bronze.filter(F.col(DELIVERY_SEQ) < REDELIVERY_OFFSET).repartition(4), inbox)
    q = streams.start_silver(replay_stream(spark, inbox, 1), sink, ckpt, trigger={"availableNow": True})
    streams.run_to_end(q, 300)
    assert len(sink.counts) >= 4  # one file per micro-batch
    # Restart on the same checkpoint: only the new files are read.
    write_replay_files(bronze.filter(F.col(DELIVERY_SEQ) >= REDELIVERY_OFFSET), inbox)
    q = streams.start_silver(replay_stream(spark, inbox, 1), sink, ckpt, trigger={"availableNow": True})
    streams.run_to_end(q, 300)
    streamed = read_silver(spark, out)
    assert _stable_rows(streamed) == _stable_rows(silver.clean(bronze))
    assert streamed.count() == 693


def test_replayed_batch_id_is_left_as_it_is(spark):
    from conftest import bronze_rows

    out = scratch_path(spark, "t-idem")
    sink = SilverBatchSink(out)
    batch = silver.clean(bronze_rows(spark, [valid_row(id="a"), valid_row(id="b", age=80)]))
    sink(batch, 7)
    sink(batch, 7)  # Spark re-runs the last batch after a failure
    assert read_silver(spark, out).count() == 2
    assert sink.counts[7] == 2


def _write_lines(path, rows):
    import os

    os.makedirs(path, exist_ok=True)
    name = f"{path}/part-{len(os.listdir(path)):03d}.json"
    with open(name, "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")


def test_bounded_dedupe_forgets_after_watermark(spark):
    root = scratch_path(spark, "t-bounded")
    inbox = root.replace("file:", "") + "/inbox"
    out = root + "/out"
    ckpt = root + "/ckpt"
    sink = SilverBatchSink(out)

    def run():
        q = streams.start_silver(
            replay_stream(spark, inbox, 1),
            sink,
            ckpt,
            trigger={"availableNow": True},
            bounded_delay="1 day",
        )
        streams.run_to_end(q, 300)

    day1 = valid_row(id="a", timestamp="2024-01-01T08:00:00", delivery_seq=1)
    _write_lines(inbox, [day1])
    run()
    _write_lines(inbox, [dict(day1, delivery_seq=2)])  # repeat within the delay
    run()
    _write_lines(inbox, [valid_row(id="b", timestamp="2024-01-10T08:00:00", delivery_seq=3)])
    run()
    _write_lines(inbox, [valid_row(id="z", timestamp="2024-01-10T09:00:00", delivery_seq=4)])
    run()  # the watermark has moved past day 1: state of "a" is evicted
    _write_lines(inbox, [valid_row(id="a", timestamp="2024-01-10T10:00:00", delivery_seq=5)])
    run()
    seqs = sorted(r[DELIVERY_SEQ] for r in read_silver(spark, out).collect())
    assert seqs == [1, 3, 4, 5]


def test_bounded_dedupe_keeps_an_id_once_a_clock_state(spark):
    """Known limit: deliveries of an id with and without a trusted clock are deduped apart."""
    root = scratch_path(spark, "t-clocks")
    inbox = root.replace("file:", "") + "/inbox"
    sink = SilverBatchSink(root + "/out")
    timed = valid_row(id="a", timestamp="2024-01-01T08:00:00", delivery_seq=1)
    for rows in ([timed, dict(timed, id="b", timestamp="2999-01-01T08:00:00", delivery_seq=2)],
                 [dict(timed, timestamp=None, delivery_seq=3), dict(timed, id="b", delivery_seq=4)],
                 [dict(timed, delivery_seq=5), dict(timed, timestamp=None, delivery_seq=6)]):
        _write_lines(inbox, rows)
        q = streams.start_silver(
            replay_stream(spark, inbox, 1), sink, root + "/ckpt", trigger={"availableNow": True}, bounded_delay="1 day"
        )
        streams.run_to_end(q, 300)
    seqs = sorted(r[DELIVERY_SEQ] for r in read_silver(spark, root + "/out").collect())
    assert seqs == [1, 2, 3, 4]


def test_live_gold_and_daily_trends_match_batch(spark):
    from visitflow.operators import gold
    from visitflow.plans.catalog import stream_daily_trends, stream_gold_severity

    batch_silver = silver.clean(read_bronze(spark, SMALL))
    live = {r["severity"]: tuple(r) for r in stream_gold_severity(spark, SMALL).collect()}
    batch = {r["severity"]: tuple(r) for r in gold.severity_summary(batch_silver).collect()}
    assert live == batch
    live_days = sorted(map(tuple, stream_daily_trends(spark, SMALL).collect()), key=repr)
    batch_days = sorted(map(tuple, gold.daily_trends(batch_silver).collect()), key=repr)
    assert live_days == batch_days


def test_salted_stream_dedupe_equals_plain(spark):
    """A hot id (many deliveries in one micro-batch) gives the same silver either way."""
    from conftest import bronze_rows

    rows = [valid_row(id="hot", delivery_seq=i, age=40 + i % 3) for i in range(200)]
    rows += [valid_row(id=f"c{i}", delivery_seq=1000 + i) for i in range(20)]
    bronze = bronze_rows(spark, rows)
    results = []
    for salt in (None, 8):
        inbox = scratch_path(spark, "t-salt-inbox")
        out = scratch_path(spark, "t-salt-out")
        write_replay_files(bronze.repartition(3), inbox)
        q = streams.start_silver(
            replay_stream(spark, inbox, 10),
            SilverBatchSink(out),
            scratch_path(spark, "t-salt-ckpt"),
            trigger={"availableNow": True},
            salt_buckets=salt,
        )
        streams.run_to_end(q, 300)
        got = read_silver(spark, out)
        results.append((got.count(), sorted(r["id"] for r in got.collect())))
    assert results[0] == results[1]
    assert results[0][0] == 21


class _CrashAfterWrite(SilverBatchSink):
    """Writes the batch, then fails once: the commit never happens, as after a driver loss."""

    crashed = False

    def __call__(self, batch, batch_id):
        super().__call__(batch, batch_id)
        if not _CrashAfterWrite.crashed:
            _CrashAfterWrite.crashed = True
            raise RuntimeError("simulated failure after the write")


def test_batch_replayed_after_failure_is_not_duplicated(spark):
    _CrashAfterWrite.crashed = False
    bronze = read_bronze(spark, SMALL)
    inbox = scratch_path(spark, "t-crash-inbox")
    out = scratch_path(spark, "t-crash-out")
    ckpt = scratch_path(spark, "t-crash-ckpt")
    write_replay_files(bronze, inbox)
    q = streams.start_silver(
        replay_stream(spark, inbox, 16), _CrashAfterWrite(out), ckpt, trigger={"availableNow": True}
    )
    with pytest.raises(StreamingQueryException, match="simulated failure"):
        q.awaitTermination(300)  # the first attempt failed after writing batch 0
    q = streams.start_silver(
        replay_stream(spark, inbox, 16), SilverBatchSink(out), ckpt, trigger={"availableNow": True}
    )
    streams.run_to_end(q, 300)
    streamed = read_silver(spark, out)
    assert streamed.count() == 693
    assert _stable_rows(streamed) == _stable_rows(silver.clean(bronze))


def test_json_sink_with_bounded_files(spark):
    """Silver batches in JSON (the reference's format), spread over a fixed number of writers."""
    import glob

    bronze = read_bronze(spark, SMALL)
    batch = silver.clean(bronze)
    out = scratch_path(spark, "t-json")
    sink = SilverBatchSink(out, fmt="json", files=2)
    sink(batch, 0)
    back = read_silver(spark, out, fmt="json")
    assert _stable_rows(back) == _stable_rows(batch)
    parts = glob.glob(out.replace("file:", "") + "/stream=manual/batch_id=0/age_group=*/part-*")
    assert 0 < len(parts) <= 2 * 4  # at most one file per writer and age band


def test_live_gold_from_silver_table_is_incremental(spark):
    """Gold kept current from the silver table's new files, batch by batch."""
    import os

    from pyspark.sql import functions as F

    from visitflow.operators import gold
    from visitflow.sources.tables import read_silver_stream

    s = silver.clean(read_bronze(spark, SMALL))
    silver_root = scratch_path(spark, "t-inc-silver")
    os.makedirs(silver_root.replace("file:", ""), exist_ok=True)
    out, ckpt = scratch_path(spark, "t-inc-gold"), scratch_path(spark, "t-inc-ckpt")
    sink = SilverBatchSink(silver_root)
    halves = [s.filter(F.col("age") < 60), s.filter(F.col("age") >= 60)]
    for batch_id, half in enumerate(halves):
        sink(half, batch_id)
        q = streams.start_live_gold_all(
            read_silver_stream(spark, silver_root), out, ckpt, trigger={"availableNow": True}
        )
        streams.run_to_end(q, 300)
    live = sorted(map(tuple, gold.stacked(spark.read.parquet(out)).collect()), key=repr)
    batch = sorted(map(tuple, gold.stacked(gold.aggregate_all(s)).collect()), key=repr)
    assert live == batch


def test_append_layout_without_batch_dirs(spark):
    from conftest import bronze_rows

    out = scratch_path(spark, "t-append")
    sink = SilverBatchSink(out, fmt="json", per_batch_dirs=False)
    sink(silver.clean(bronze_rows(spark, [valid_row(id="a")])), 0)
    sink(silver.clean(bronze_rows(spark, [valid_row(id="b", age=80)])), 1)
    import os

    dirs = sorted(d for d in os.listdir(out.replace("file:", "")) if d.startswith("age_group="))
    assert dirs == ["age_group=ELDERLY", "age_group=MIDDLE_AGED"]  # no batch_id level
    assert sorted(r["id"] for r in read_silver(spark, out, fmt="json").collect()) == ["a", "b"]


def test_daily_trends_late_record_updates_its_day(spark):
    import datetime as dt

    root = scratch_path(spark, "t-late")
    inbox, out, ckpt = root.replace("file:", "") + "/inbox", root + "/out", root + "/ckpt"

    def run():
        q = streams.start_daily_trends(
            streams.silver_stream(replay_stream(spark, inbox, 1)), out, ckpt,
            trigger={"availableNow": True},
        )
        streams.run_to_end(q, 300)

    _write_lines(inbox, [
        valid_row(id="a", timestamp="2024-01-01T08:00:00", delivery_seq=1),
        valid_row(id="b", timestamp="2024-03-01T08:00:00", delivery_seq=2),
    ])
    run()
    _write_lines(inbox, [valid_row(id="c", timestamp="2024-01-01T09:00:00", delivery_seq=3)])
    run()  # two months late: still counted on its own day
    days = {r["date"]: r["patient_per_day"] for r in spark.read.parquet(out).collect()}
    assert days == {dt.date(2024, 1, 1): 2, dt.date(2024, 3, 1): 1}


def test_rocksdb_state_gives_same_silver(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    changelog = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    before, before_changelog = spark.conf.get(key), spark.conf.get(changelog, None)
    try:
        streams.use_rocksdb_state(spark)
        bronze = read_bronze(spark, SMALL)
        inbox, out, ckpt = (scratch_path(spark, f"t-rocks-{x}") for x in ("in", "out", "ck"))
        write_replay_files(bronze, inbox)
        q = streams.start_silver(
            replay_stream(spark, inbox, 16), SilverBatchSink(out), ckpt,
            trigger={"availableNow": True},
        )
        streams.run_to_end(q, 300)
        assert _stable_rows(read_silver(spark, out)) == _stable_rows(silver.clean(bronze))
    finally:
        spark.conf.set(key, before)
        if before_changelog is None:
            spark.conf.unset(changelog)
        else:
            spark.conf.set(changelog, before_changelog)


def test_malformed_lines_in_stream_are_dropped(spark):
    root = scratch_path(spark, "t-junk")
    inbox, out, ckpt = root.replace("file:", "") + "/inbox", root + "/out", root + "/ckpt"
    import os

    os.makedirs(inbox, exist_ok=True)
    good = json.dumps(valid_row(id="ok", delivery_seq=1))
    with open(f"{inbox}/part-000.json", "w") as fh:
        fh.write("not json\n" + good + "\n" + '{"id": "cut", "age": 4' + "\n\n[1, 2]\n")
    q = streams.start_silver(
        replay_stream(spark, inbox, 1), SilverBatchSink(out), ckpt, trigger={"availableNow": True}
    )
    streams.run_to_end(q, 300)
    assert [r["id"] for r in read_silver(spark, out).collect()] == ["ok"]


def test_empty_batch_writes_no_data_files(spark, caplog):
    import glob
    import logging

    from conftest import bronze_rows

    out = scratch_path(spark, "t-empty")
    sink = SilverBatchSink(out)
    empty = silver.clean(bronze_rows(spark, [valid_row(id="x", age=None)]))  # filtered out
    with caplog.at_level(logging.INFO, logger="visitflow.sinks.files"):
        sink(empty, 3)
    assert sink.counts[3] == 0 and "empty" in caplog.text
    assert glob.glob(out.replace("file:", "") + "/stream=manual/batch_id=3/**/*.parquet", recursive=True) == []
