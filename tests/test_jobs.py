"""Job entry points end to end: replay files -> silver stream -> gold batch -> KPI row."""

from __future__ import annotations

import pytest
from conftest import SMALL

from visitflow.operators import gold, report, silver
from visitflow.plans.jobs import JobConfig, gold_job, kpi_job, silver_job
from visitflow.session import scratch_path
from visitflow.sinks.files import write_replay_files
from visitflow.sources.fixture import read_bronze
from visitflow.sources.tables import MissingInputError
from visitflow.streaming.silver import run_to_end


def test_jobs_end_to_end(spark, monkeypatch):
    monkeypatch.setenv("SILVER_OUTPUT_PATH", scratch_path(spark, "job-silver"))
    monkeypatch.setenv("CHECKPOINT_PATH", scratch_path(spark, "job-ckpt"))
    monkeypatch.setenv("GOLD_OUTPUT_PATH", scratch_path(spark, "job-gold"))
    monkeypatch.setenv("SILVER_SOURCE", "files")
    inbox = scratch_path(spark, "job-inbox")
    monkeypatch.setenv("SILVER_INPUT_PATH", inbox)
    bronze = read_bronze(spark, SMALL)
    write_replay_files(bronze, inbox)
    cfg = JobConfig(rocksdb_state=False)
    q = silver_job(spark, cfg, trigger={"availableNow": True}, wait=False)
    run_to_end(q, 300)
    counts = gold_job(spark, cfg)
    expected_silver = silver.clean(bronze)
    assert counts["gender_summary"] == 3
    expected = report.kpi_summary(
        gold.age_group_summary(expected_silver), gold.gender_summary(expected_silver)
    ).collect()
    assert kpi_job(spark, cfg).collect() == expected


def test_indexed_and_incremental_jobs_end_to_end(spark, monkeypatch):
    """The silver job on the id index, two incremental gold runs and a repair, all by their settings."""
    from visitflow.plans.jobs import gold_incremental_job, repair_job
    from visitflow.sources.tables import read_gold, read_silver

    root = scratch_path(spark, "job-indexed")
    paths = {"SILVER_OUTPUT_PATH": "silver", "CHECKPOINT_PATH": "ckpt", "GOLD_OUTPUT_PATH": "gold", "SILVER_INPUT_PATH": "in", "SILVER_INDEX_PATH": "index"}
    for name, folder in paths.items():
        monkeypatch.setenv(name, f"{root}/{folder}")
    for name, value in {"SILVER_SOURCE": "files", "GOLD_VERSIONED": "1", "DEDUPE_HORIZON_DAYS": "1", "MAX_FILES_PER_TRIGGER": "0"}.items():
        monkeypatch.setenv(name, value)
    bronze = read_bronze(spark, SMALL)
    for wave in (bronze.filter("delivery_seq % 2 = 0"), bronze.filter("delivery_seq % 2 = 1")):
        write_replay_files(wave.filter("delivery_seq < 1000000000"), f"{root}/in")
        run_to_end(silver_job(spark, JobConfig(), trigger={"availableNow": True}, wait=False), 300)
        assert gold_incremental_job(spark, JobConfig())
    assert repair_job(spark, JobConfig()) == 1 and gold_incremental_job(spark, JobConfig())
    expected = silver.clean(bronze.filter("delivery_seq < 1000000000"))
    assert read_silver(spark, f"{root}/silver").count() == expected.count()
    got = gold.stack(read_gold(spark, f"{root}/gold"))
    assert sorted(map(str, got.collect())) == sorted(map(str, gold.stacked(gold.aggregate_all(expected)).collect()))


def test_gold_job_without_silver_fails(spark):
    cfg = JobConfig(silver_path=scratch_path(spark, "absent"), gold_path=scratch_path(spark, "g"))
    with pytest.raises(MissingInputError):
        gold_job(spark, cfg)


def test_missing_settings_are_reported():
    with pytest.raises(ValueError, match="silver_path"):
        JobConfig(silver_path=None, gold_path=None).require("silver_path")


def test_cli_gold_without_silver_exits_1(spark, monkeypatch):
    from visitflow.plans import jobs

    monkeypatch.setenv("SILVER_OUTPUT_PATH", scratch_path(spark, "cli-absent"))
    monkeypatch.setenv("GOLD_OUTPUT_PATH", scratch_path(spark, "cli-gold"))
    # main() stops the session it gets; give it a throwaway handle to the shared one.
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    monkeypatch.setattr(jobs, "_stop_streams_on_signal", lambda spark: None)
    assert jobs.main(["gold"]) == 1
    assert jobs.main([]) == 2


def test_gold_live_job_matches_batch_gold(spark):
    """Live gold from the silver table's files writes the same nine tables as the batch job."""
    from pyspark.sql import functions as F

    from visitflow.plans.jobs import gold_live_job
    from visitflow.sinks.files import SilverBatchSink
    from visitflow.sources.tables import read_gold

    s = silver.clean(read_bronze(spark, SMALL))
    cfg = JobConfig(
        silver_path=scratch_path(spark, "live-silver"),
        gold_path=scratch_path(spark, "live-gold"),
        gold_checkpoint_path=scratch_path(spark, "live-ckpt"),
    )
    sink = SilverBatchSink(cfg.silver_path)
    for batch_id, part in enumerate([s.filter(F.col("age") < 50), s.filter(F.col("age") >= 50)]):
        sink(part, batch_id)
        run_to_end(gold_live_job(spark, cfg, trigger={"availableNow": True}, wait=False), 300)
    live = read_gold(spark, cfg.gold_path)
    batch_root = scratch_path(spark, "batch-gold")
    gold_job(spark, JobConfig(silver_path=cfg.silver_path, gold_path=batch_root))
    batch = read_gold(spark, batch_root)
    assert set(live) == set(batch) == set(gold.BUILDERS)
    for name in batch:
        assert live[name].collect() == batch[name].collect(), name  # same rows, same order


def test_report_job_writes_dashboard_tables(spark):
    from visitflow.operators import report as report_ops
    from visitflow.plans.batch import REPORT_TABLES
    from visitflow.plans.jobs import report_job

    s = silver.clean(read_bronze(spark, SMALL))
    silver_path, gold_root = scratch_path(spark, "rep-silver"), scratch_path(spark, "rep-gold")
    from visitflow.plans.batch import write_silver

    write_silver(s, silver_path)
    gold_job(spark, JobConfig(silver_path=silver_path, gold_path=gold_root))
    root = report_job(spark, JobConfig(gold_path=gold_root))
    for name in REPORT_TABLES:
        assert spark.read.json(f"{root}/{name}").count() > 0, name
    kpi = spark.read.json(f"{root}/kpi_summary").collect()[0]
    expected = report_ops.kpi_from_silver(s).collect()[0]
    assert kpi["total_patients"] == expected["total_patients"]
    assert kpi["severe_pct"] == expected["severe_pct"]
    labels = spark.read.json(f"{root}/top_doctors_labelled").columns
    assert set(labels) == {"Doctor Id", "Doctor Name", "Patients Treated"}


def test_report_job_without_gold_tables_gives_zero_kpis(spark):
    import os

    from visitflow.plans.jobs import report_job

    gold_root = scratch_path(spark, "rep-empty-gold")
    os.makedirs(gold_root.replace("file:", ""), exist_ok=True)
    root = report_job(spark, JobConfig(gold_path=gold_root))
    kpi = spark.read.json(f"{root}/kpi_summary").collect()
    assert len(kpi) == 1 and kpi[0]["total_patients"] == 0 and kpi[0]["male_pct"] == 0.0
