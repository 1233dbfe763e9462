"""Gold by keyed upsert, incremental top 10 and gold from new batches only."""

from __future__ import annotations

import random

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from visitflow.operators import gold, silver
from visitflow.plans.batch import run_gold_incremental, write_gold_tables
from visitflow.session import scratch_path
from visitflow.sinks.files import SilverBatchSink
from visitflow.sinks.versions import KeyedTable, Versions, added, newest
from visitflow.sources.fixture import read_bronze
from visitflow.sources.tables import MissingInputError, read_gold, read_silver_stream
from visitflow.storage import delete, names
from visitflow.streaming import silver as streams
from visitflow.streaming import upsert

NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def visits(spark):
    path = scratch_path(spark, "u-visits")
    silver.clean(read_bronze(spark, SMALL)).write.parquet(path)
    return spark.read.parquet(path)


def rows(df):
    return sorted(map(str, df.collect()))


def files(spark, table: KeyedTable) -> dict[int, list[str]]:
    state = table.versions.current(spark)[1]
    return {int(p.rpartition("=")[2]): names(spark, p) for p in table.paths(state)}


def test_only_changed_buckets_are_written(spark):
    schema = "k string, n long"
    table = KeyedTable(scratch_path(spark, "u-table"), spark.createDataFrame([], schema).schema, ["k"], buckets=16)
    combine = newest(["k"], ["n"])
    table.write(spark.createDataFrame([(f"k{i}", i) for i in range(100)] + [(None, -1)], schema), combine, {})
    before = files(spark, table)
    touched = table.write(spark.createDataFrame([("k7", 700), (None, -2), ("new", 1)], schema), combine, {"at": 2})
    after = files(spark, table)
    assert 1 <= len(touched) <= 3 and len(before) == 16
    assert all(before[b] == after[b] for b in before if b not in touched)
    assert all(before[b] != after[b] for b in touched)
    got = {r["k"]: r["n"] for r in table.read(spark).collect()}
    assert got == {**{f"k{i}": i for i in range(100)}, "k7": 700, None: -2, "new": 1}
    assert table.versions.current(spark)[1]["at"] == 2


def test_versions_are_exclusive_and_old_ones_go(spark):
    versions = Versions(scratch_path(spark, "u-versions"))
    assert versions.current(spark) == (0, {})
    versions.publish(spark, 1, {"a": 1})
    with pytest.raises(FileExistsError):
        versions.publish(spark, 1, {"a": 2})
    assert versions.current(spark) == (1, {"a": 1})
    schema = spark.createDataFrame([], "k long, n long").schema
    table = KeyedTable(scratch_path(spark, "u-retired"), schema, ["k"], buckets=1)
    for i in range(6):
        table.write(spark.createDataFrame([(1, 1)], schema), added(["k"], ["n"]), {})
    assert table.read(spark).collect()[0]["n"] == 6
    assert len(table.versions.numbers(spark)) == 3 and len(names(spark, table.data)) == 3


def live(spark, source, start, root, checkpoint):
    streams.run_to_end(start(read_silver_stream(spark, source), root, checkpoint, trigger=NOW), 300)


def test_upsert_and_top_equal_batch_after_waves(spark, visits):
    """Waves in no order of time or key, the last one small; a restart between any two."""
    source = scratch_path(spark, "u-silver")
    sink = SilverBatchSink(source)
    cut = F.pmod(F.xxhash64("id"), F.lit(10))
    waves = [visits.where(cut >= 6), visits.where((cut < 6) & (cut >= 1)), visits.where(cut < 1).limit(3)]
    roots = {f: (scratch_path(spark, "u-root"), scratch_path(spark, "u-ckpt")) for f in (upsert.start_gold_upsert, upsert.start_top)}
    for number, wave in enumerate(waves):
        sink(wave, number)
        for start, (root, checkpoint) in roots.items():
            live(spark, source, start, root, checkpoint)
    seen = spark.read.parquet(source)
    want = gold.aggregate_all(seen)
    store = upsert.read_store(spark, roots[upsert.start_gold_upsert][0])
    assert rows(gold.stacked(store)) == rows(gold.stacked(want))
    top = upsert.read_top(spark, roots[upsert.start_top][0])
    for name, table in top.items():
        assert [tuple(r) for r in table.collect()] == [tuple(r) for r in gold.build(seen, name).collect()]
    assert upsert.read_store(spark, roots[upsert.start_top][0]).count() <= 2 * gold.TOP_N


def test_replayed_micro_batch_changes_nothing(spark, visits):
    root = scratch_path(spark, "u-replay")
    sink = upsert.UpsertSink(root, buckets=4)
    agg = gold.aggregate_all(visits)
    sink(agg, 0)
    before = upsert.gold_store(spark, root).versions.current(spark)
    sink(agg, 0)
    assert upsert.gold_store(spark, root).versions.current(spark) == before


def test_incremental_top_keeps_ties_as_batch(spark):
    """Random waves of few doctors with many equal counts."""
    rng = random.Random(3)
    schema = "doctor_id int, doctor_name string, diagnosis_code string, diagnosis_desc string, severity string, timestamp string, age int, wbc double, hgb double, severity_score int, age_group string, gender string, wbc_status string, hgb_status string, allergy string"
    root, sink, all_rows = scratch_path(spark, "u-ties"), None, []
    sink = upsert.TopSink(root)
    for number in range(3):
        all_rows += [
            (rng.choice([None, *range(8)]), rng.choice([None, "A", "B"]), rng.choice("xyz"), rng.choice([None, "d"]), *[None] * 11)
            for _ in range(40)
        ]
        df = spark.createDataFrame(all_rows, schema)
        # In update mode a batch holds the new sums of the groups that changed.
        changed = spark.createDataFrame(all_rows[-40:], schema)
        now, fresh = (gold.aggregate_all(d, sorted(gold.LIMITED)) for d in (df, changed))
        keys = F.struct(*gold.AGGREGATE_KEYS)
        touched = {str(r[0]) for r in fresh.select(keys.alias("k")).collect()}
        held = [r for r in now.select("*", keys.cast("string").alias("s")).collect()]
        texts = {r["s"] for r in fresh.select(keys.cast("string").alias("s")).collect()}
        assert touched and texts
        sink(now.where(keys.cast("string").isin(sorted(texts))), number)
        assert len(held) >= len(texts)
        for name, table in upsert.read_top(spark, root).items():
            assert [tuple(r) for r in table.collect()] == [tuple(r) for r in gold.build(df, name).collect()]


def test_second_run_reads_no_old_batch(spark, visits):
    source, store, out, full = (scratch_path(spark, f"u-inc-{p}") for p in ("silver", "store", "gold", "full"))
    with pytest.raises(MissingInputError):
        run_gold_incremental(spark, source, store, out)
    sink = SilverBatchSink(source)
    sink(visits.where("age < 40"), 0)
    assert run_gold_incremental(spark, source, store, out, buckets=4)["gender_summary"] == 3
    # The first batch's rows are gone; were they read again, the sums would show it.
    for folder in names(spark, f"{source}/stream=manual/batch_id=0"):
        if folder.startswith("age_group="):
            delete(spark, f"{source}/stream=manual/batch_id=0/{folder}")
    sink(visits.where("age >= 40"), 1)
    assert run_gold_incremental(spark, source, store, out, buckets=4)
    assert run_gold_incremental(spark, source, store, out, buckets=4) == {}
    write_gold_tables(visits, full)
    assert rows(gold.stack(read_gold(spark, out))) == rows(gold.stack(read_gold(spark, full)))


def test_crash_before_publishing_counts_a_batch_once(spark, visits, monkeypatch):
    source, store = scratch_path(spark, "u-crash-silver"), scratch_path(spark, "u-crash-store")
    SilverBatchSink(source)(visits, 0)
    publish = Versions.publish

    def fail(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(Versions, "publish", fail)
    with pytest.raises(RuntimeError):
        upsert.merge_batches(spark, source, store, buckets=4)
    monkeypatch.setattr(Versions, "publish", publish)
    assert upsert.merge_batches(spark, source, store, buckets=4) == 1
    assert upsert.merge_batches(spark, source, store, buckets=4) == 0
    assert rows(gold.stacked(upsert.read_store(spark, store))) == rows(gold.stacked(gold.aggregate_all(visits)))


def test_readers_see_tables_of_one_run(spark, visits, monkeypatch):
    """Whatever table is being written, a reader gets nine tables of the run before; a failed run changes nothing."""
    from visitflow.sinks import files

    root = scratch_path(spark, "u-version")
    young = visits.where("age < 40")
    write_gold_tables(young, root, versioned=True)
    before, seen = rows(gold.stack(read_gold(spark, root))), []
    write = files.write_gold

    def looking(*args, **kwargs):
        seen.append(rows(gold.stack(read_gold(spark, root))))
        write(*args, **kwargs)

    monkeypatch.setattr(files, "write_gold", looking)
    write_gold_tables(visits, root, versioned=True)
    assert len(seen) == 9 and all(x == before for x in seen)
    after = rows(gold.stack(read_gold(spark, root)))
    assert after == rows(gold.stacked(gold.aggregate_all(visits)))

    def failing(df, path, name, **kwargs):
        if name == "hgb_summary":
            raise RuntimeError("lost")
        write(df, path, name, **kwargs)

    monkeypatch.setattr(files, "write_gold", failing)
    with pytest.raises(RuntimeError):
        write_gold_tables(young, root, versioned=True)
    assert rows(gold.stack(read_gold(spark, root))) == after
    monkeypatch.setattr(files, "write_gold", write)
    write_gold_tables(visits.drop("timestamp"), root, versioned=True)
    assert "daily_trends" not in read_gold(spark, root) and len(read_gold(spark, root)) == 8


def test_closed_days_leave_the_state(spark, visits):
    """Days come in order, one a batch, delay two days: the state holds the last days only, the table all."""
    root = scratch_path(spark, "u-days")
    sink = SilverBatchSink(f"{root}/silver")
    days = [r[0] for r in visits.selectExpr("try_to_date(timestamp) d").where("d is not null").distinct().orderBy("d").limit(8).collect()]
    held = []
    for number, day in enumerate(days):
        sink(visits.where((F.try_to_date("timestamp") == F.lit(day)) | (F.lit(number == 3) & F.try_to_date("timestamp").isNull())), number)
        stream = read_silver_stream(spark, f"{root}/silver")
        queries = streams.start_daily_windows(stream, f"{root}/daily", f"{root}/checkpoint", "2 days", trigger=NOW)
        for query in queries:
            streams.run_to_end(query, 300)
        held.append(queries[0].lastProgress.stateOperators[0].numRowsTotal)
    assert max(held) <= 4 < len(days)
    kept = visits.where(F.try_to_date("timestamp").isNull() | F.try_to_date("timestamp").isin(days))
    assert rows(streams.read_daily_windows(spark, f"{root}/daily")) == rows(gold.build(kept, "daily_trends"))


def test_ledger_ranges():
    held = upsert._with([], [0, 1, 2, 7])
    assert held == [[0, 2], [7, 7]]
    assert upsert._with(held, [3, 6, 4, 5]) == [[0, 7]]
    assert upsert._covers(held, 2) and not upsert._covers(held, 3)
