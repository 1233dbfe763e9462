"""Silver and live gold after restarts, replays and odd clocks; gold while it is rewritten."""

from __future__ import annotations

import json
import os
import time

import pytest
from conftest import SMALL, bronze_rows, valid_row
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from visitflow.operators import gold, report, silver
from visitflow.plans import jobs
from visitflow.plans.batch import kpis_from_gold
from visitflow.schema import DELIVERY_SEQ, GOLD_SCHEMAS
from visitflow.session import scratch_path
from visitflow.sinks.files import SilverBatchSink, write_gold, write_replay_files
from visitflow.sources.fixture import kafka_rows, read_bronze
from visitflow.sources.messages import KAFKA_ORDER, decode, from_kafka_rows, replay_stream
from visitflow.sources.tables import MissingInputError, read_gold, read_silver, read_silver_stream
from visitflow.streaming import silver as streams

NOW = {"availableNow": True}


def _lines(folder: str, rows: list[dict]) -> None:
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part-{len(os.listdir(folder)):03d}.json", "w") as fh:
        fh.writelines(json.dumps(r) + "\n" for r in rows)


def _local(spark, label: str) -> str:
    return scratch_path(spark, label).replace("file:", "")


def test_new_checkpoint_keeps_what_silver_holds(spark):
    out = scratch_path(spark, "x-silver")
    for wave in ("old", "new"):
        inbox = _local(spark, f"x-{wave}")
        _lines(inbox, [valid_row(id=f"{wave}{i}", delivery_seq=i) for i in range(3)])
        q = streams.start_silver(
            replay_stream(spark, inbox), SilverBatchSink(out), scratch_path(spark, "x-ckpt"), trigger=NOW
        )
        streams.run_to_end(q, 300)
    assert sorted(r["id"] for r in read_silver(spark, out).collect()) == ["new0", "new1", "new2", "old0", "old1", "old2"]


class _CrashOnce(SilverBatchSink):
    crashed = False

    def __call__(self, batch, batch_id):
        super().__call__(batch, batch_id)
        if not _CrashOnce.crashed:
            _CrashOnce.crashed = True
            raise RuntimeError("lost after the write")


def test_replayed_batch_is_not_counted_twice_by_live_gold(spark):
    _CrashOnce.crashed = False
    bronze = read_bronze(spark, SMALL)
    inbox, out, root = (scratch_path(spark, f"x-replay-{p}") for p in ("in", "silver", "gold"))
    ckpt, gold_ckpt = scratch_path(spark, "x-replay-ckpt"), scratch_path(spark, "x-replay-gold-ckpt")
    write_replay_files(bronze, inbox)

    def live():
        stream = read_silver_stream(spark, out)
        streams.run_to_end(streams.start_gold_tables_stream(stream, root, gold_ckpt, trigger=NOW), 300)

    q = streams.start_silver(replay_stream(spark, inbox, None), _CrashOnce(out), ckpt, trigger=NOW)
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(300)
    live()  # reads the files of the batch that was written but not committed
    q = streams.start_silver(replay_stream(spark, inbox, None), SilverBatchSink(out), ckpt, trigger=NOW)
    streams.run_to_end(q, 300)
    live()
    want = silver.clean(bronze)
    got = read_gold(spark, root)
    for name, builder in gold.BUILDERS.items():
        assert got[name].collect() == builder(want).collect(), name


def test_bounded_stream_keeps_rows_with_odd_clocks(spark):
    inbox, out, ckpt = _local(spark, "x-odd-in"), scratch_path(spark, "x-odd"), scratch_path(spark, "x-odd-ckpt")
    sink = SilverBatchSink(out)

    def run(*rows):
        _lines(inbox, list(rows))
        q = streams.start_silver(
            replay_stream(spark, inbox, None), sink, ckpt, trigger=NOW, bounded_delay="1 day"
        )
        streams.run_to_end(q, 300)

    def row(i, time_text):
        return valid_row(id=f"r{i}", timestamp=time_text, delivery_seq=i)

    run(row(1, "2024-01-01T08:00:00"), row(2, None), row(3, "2024-01-01T25:99"), row(4, "2099-01-01T00:00:00"))
    run(row(5, "2024-01-01T09:00:00"), row(2, None), row(4, "2099-01-01T00:00:00"))
    run(row(6, "2024-01-01T10:00:00"), row(7, "no time"))
    assert sorted(r[DELIVERY_SEQ] for r in read_silver(spark, out).collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert sum(sink.untimed.values()) == 2


def test_late_rows_are_counted(spark):
    inbox, out, ckpt = _local(spark, "x-late-in"), scratch_path(spark, "x-late"), scratch_path(spark, "x-late-ckpt")
    late = 0
    for i, day in enumerate(("2024-02-01", "2024-02-02", "2024-01-01")):
        _lines(inbox, [valid_row(id=f"d{i}", timestamp=f"{day}T08:00:00", delivery_seq=i)])
        q = streams.start_silver(replay_stream(spark, inbox), SilverBatchSink(out), ckpt, trigger=NOW, bounded_delay="1 hour")
        streams.run_to_end(q, 300)
        late += streams.late_rows(q)
    assert late == 1


def test_rows_without_id_never_reach_the_state(spark):
    stream = streams.silver_stream(replay_stream(spark, _made(spark)))
    plan = stream._jdf.queryExecution().analyzed().toString()
    below = plan.split("Deduplicate", 1)[1]  # children stand below their parents
    assert "isnotnull(id" in below and "Filter" in below


def _made(spark) -> str:
    folder = _local(spark, "x-empty-inbox")
    os.makedirs(folder)
    return folder


def test_processing_time_trigger_and_clean_stop(spark):
    inbox, out, ckpt = _local(spark, "x-trigger-in"), scratch_path(spark, "x-trigger"), scratch_path(spark, "x-trigger-ckpt")
    _lines(inbox, [valid_row(id="a", delivery_seq=1)])
    cfg = jobs.JobConfig(silver_path=out, checkpoint_path=ckpt, source="files", input_path=inbox, trigger_interval="1 second", rocksdb_state=False)
    q = jobs.silver_job(spark, cfg, wait=False)
    try:
        for _ in range(120):
            if os.path.isdir(out.replace("file:", "")) and q.lastProgress and q.lastProgress["batchId"] >= 0:
                break
            time.sleep(0.5)
        q.processAllAvailable()
        _lines(inbox, [valid_row(id="b", delivery_seq=2)])
        q.processAllAvailable()
    finally:
        q.stop()
    assert not q.isActive and q.exception() is None
    assert sorted(r["id"] for r in read_silver(spark, out).collect()) == ["a", "b"]


def test_gold_live_without_silver_exits_1(spark, monkeypatch):
    for name in ("SILVER_OUTPUT_PATH", "GOLD_OUTPUT_PATH", "GOLD_CHECKPOINT_PATH"):
        monkeypatch.setenv(name, scratch_path(spark, "x-absent"))
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    monkeypatch.setattr(jobs, "_stop_streams_on_signal", lambda spark: None)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        assert jobs.main(["gold-live"]) == 1
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_failed_rewrite_leaves_the_old_table(spark):
    root = scratch_path(spark, "x-atomic")
    old = spark.createDataFrame([("MALE", 3)], GOLD_SCHEMAS["gender_summary"])
    write_gold(old, root, "gender_summary")
    seen = []

    def fails(batches):
        seen.append(1)
        raise RuntimeError("lost while writing")
        yield from batches

    with pytest.raises(Exception, match="lost while writing"):
        write_gold(old.mapInPandas(fails, old.schema), root, "gender_summary")
    assert [tuple(r) for r in read_gold(spark, root)["gender_summary"].collect()] == [("MALE", 3)]
    write_gold(old.select("gender", (F.col("patient_count") + 1).alias("patient_count")), root, "gender_summary")
    assert [tuple(r) for r in read_gold(spark, root)["gender_summary"].collect()] == [("MALE", 4)]


def test_kpis_of_half_a_gold_folder_are_an_error(spark):
    root = scratch_path(spark, "x-half")
    write_gold(spark.createDataFrame([("MALE", 3)], GOLD_SCHEMAS["gender_summary"]), root, "gender_summary")
    with pytest.raises(MissingInputError, match="age_group_summary"):
        kpis_from_gold(spark, root)


@pytest.mark.parametrize("num,den,want", [(1, 16, 6.2), (3, 16, 18.8), (1, 3, 33.3), (2, 3, 66.7), (0, 5, 0.0), (5, 0, 0.0), (5, 5, 100.0)])
def test_ties_round_to_the_even_digit(spark, num, den, want):
    row = spark.createDataFrame([(num, den)], "num long, den long").select(report.round1_ratio("num", "den", 100))
    assert row.first()[0] == want
    if den:
        assert round(num / den * 100, 1) == want


def test_first_delivery_over_all_partitions(spark):
    rows = kafka_rows(bronze_rows(spark, [valid_row(id="a", age=30, delivery_seq=20), valid_row(id="a", age=50, delivery_seq=20 + 10**9)]))
    assert {r["partition"] for r in rows.collect()} == {0, 1}
    cleaned = silver.clean(decode(from_kafka_rows(rows)), order_by=KAFKA_ORDER)
    assert [r["age"] for r in cleaned.collect()] == [30]


def test_millions_of_doctor_pairs_stay_in_their_part(spark):
    """The doctor set's rows are read by no other table, and nothing is left in the shared folder."""
    s = silver.clean(read_bronze(spark, SMALL))
    agg = gold.store_aggregate(gold.aggregate_all(s), scratch_path(spark, "x-agg"))
    plan = gold.split(agg, ordered=False)["gender_summary"]._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "(grain" in plan
