"""Silver with the id index: exact dedupe, horizon, verdicts, late rows."""

from __future__ import annotations

import json
import os

import pytest
from conftest import SMALL, valid_row
from pyspark.sql import functions as F

from visitflow.operators import silver
from visitflow.schema import SILVER_STABLE_COLUMNS
from visitflow.session import scratch_path
from visitflow.sinks.files import SilverBatchSink, write_replay_files
from visitflow.sinks.versions import Versions
from visitflow.sources.fixture import read_bronze
from visitflow.sources.messages import replay_stream
from visitflow.sources.tables import read_silver
from visitflow.storage import exists, names
from visitflow.streaming import seen

NOW = {"availableNow": True}


class Run:
    """An indexed stream over a folder of replay files."""

    def __init__(self, spark, horizon=None, files=1):
        self.spark, self.files = spark, files
        self.root = scratch_path(spark, "seen").replace("file:", "")
        self.inbox = f"{self.root}/in"
        os.makedirs(self.inbox)
        index = seen.SeenIds(f"{self.root}/index", horizon, buckets=8)
        self.sink = seen.IndexedSilverSink(SilverBatchSink(f"{self.root}/silver"), index, f"{self.root}/rejects", f"{self.root}/late")
        self.fed = 0

    def feed(self, rows):
        with open(f"{self.inbox}/part-{self.fed:03d}.json", "w") as fh:
            fh.writelines((r if isinstance(r, str) else json.dumps({"delivery_seq": self.fed * 1000 + i, **r})) + "\n" for i, r in enumerate(rows))
        os.utime(f"{self.inbox}/part-{self.fed:03d}.json", (1_700_000_000 + self.fed, 1_700_000_000 + self.fed))
        self.fed += 1

    def run(self):
        messages = replay_stream(self.spark, self.inbox, max_files_per_trigger=self.files)
        query = seen.start_indexed_silver(messages, self.sink, f"{self.root}/checkpoint", trigger=NOW)
        assert query.awaitTermination(300) and query.exception() is None
        return query

    def silver(self):
        return read_silver(self.spark, f"{self.root}/silver")

    def ids(self):
        return sorted(r["id"] for r in self.silver().collect()) if exists(self.spark, f"{self.root}/silver") else []


def stable(df):
    return sorted(map(str, df.select(SILVER_STABLE_COLUMNS).collect()))


def test_restarts_and_a_replay_equal_batch(spark):
    """Three runs of one checkpoint, the last batch of the first done twice: silver as in batch, no state kept."""
    run = Run(spark, files=16)
    bronze = read_bronze(spark, SMALL)
    cut = F.col("delivery_seq") % 3
    for at in range(3):
        # Redeliveries come in the last wave, as their numbers say.
        write_replay_files(bronze.where(cut == at).where("delivery_seq < 1000000000"), run.inbox)
        if at == 2:
            write_replay_files(bronze.where("delivery_seq >= 1000000000"), run.inbox)
        query = run.run()
        if at == 0:  # as after a failure before the batch's commit
            last = max(int(n) for n in os.listdir(f"{run.root}/checkpoint/commits") if n.isdigit())
            os.remove(f"{run.root}/checkpoint/commits/{last}")
            crc = f"{run.root}/checkpoint/commits/.{last}.crc"
            if os.path.exists(crc):
                os.remove(crc)
            run.run()
    assert stable(run.silver()) == stable(silver.clean(bronze))
    assert not names(spark, f"{run.root}/checkpoint/state")
    assert all(not p.stateOperators for p in query.recentProgress)
    assert sum(c.rows for c in run.sink.counts.values()) == bronze.count()


@pytest.mark.parametrize("clock_first", [True, False])
def test_an_id_with_and_without_a_clock_stays_once(spark, clock_first):
    run = Run(spark, horizon=5)
    stamps = ["2024-05-01T08:00:00", None] if clock_first else [None, "2024-05-01T08:00:00"]
    for stamp in stamps:
        run.feed([valid_row(id="a", timestamp=stamp), valid_row(id=f"b{stamp}", timestamp="2024-05-01")])
    run.feed([valid_row(id="a", timestamp="2999-01-01T00:00:00"), valid_row(id="a", timestamp="nonsense")])
    query = run.run()
    assert run.ids() == ["a", "b2024-05-01T08:00:00", "bNone"]
    assert sum(p.numInputRows for p in query.recentProgress) == 6  # each message is read once


def test_horizon_forgets_and_keeps_late_rows(spark):
    run = Run(spark, horizon=2)
    run.feed([valid_row(id="old", timestamp="2024-05-01T08:00:00"), valid_row(id="dirty", timestamp="2024-05-01", age=None)])
    run.feed([valid_row(id="new", timestamp="2024-05-20T08:00:00")])
    late = [valid_row(id=i, timestamp="2024-05-01T09:00:00") for i in ("old", "missed", "missed", "dirty")]
    run.feed(late + [valid_row(id="bad", timestamp="2024-05-01", wbc=99.0), valid_row(id="new", timestamp="2024-05-20T09:00:00")])
    run.run()
    assert run.ids() == ["new", "old"]
    assert run.sink.counts[2].verdicts == {"clean": 0, "rejected": 0, "duplicate": 1, "late": 5}
    ledger = f"{run.root}/ledger"

    def repair():
        return seen.repair_late(spark, run.sink.silver, run.sink.rejects, run.sink.late, ledger)

    assert repair() == 1 and repair() == 0
    # "dirty" had a rejected first delivery: a later clean one doesn't count.
    assert run.ids() == ["missed", "new", "old"]
    rejected = {r["id"]: r["reasons"] for r in seen.read_rejects(spark, run.sink.rejects).collect()}
    assert rejected == {"dirty": ["age"], "bad": ["wbc"]}


def test_a_failed_repair_is_done_again(spark, monkeypatch):
    run = Run(spark, horizon=1)
    run.feed([valid_row(id="new", timestamp="2024-05-20")])
    run.feed([valid_row(id="late", timestamp="2024-05-01")])
    run.run()
    ledger, publish, calls = f"{run.root}/ledger", Versions.publish, []

    def fail_second(self, spark, number, state):
        calls.append(number)
        if len(calls) == 2:
            raise RuntimeError("lost")
        publish(self, spark, number, state)

    monkeypatch.setattr(Versions, "publish", fail_second)
    args = (spark, run.sink.silver, run.sink.rejects, run.sink.late, ledger)
    with pytest.raises(RuntimeError):
        seen.repair_late(*args)
    # Another late batch comes in between; it waits for the next repair.
    run.feed([valid_row(id="later", timestamp="2024-05-01")])
    monkeypatch.setattr(Versions, "publish", publish)
    run.run()
    assert seen.repair_late(*args) == 1 and seen.repair_late(*args) == 1 and seen.repair_late(*args) == 0
    assert run.ids() == ["late", "later", "new"]


def test_verdicts_add_up_and_reasons_are_kept(spark):
    run = Run(spark)
    run.feed(
        [
            valid_row(id="a"),
            valid_row(id="a", age=50),
            valid_row(id="b", age=None, hgb=2.0),
            valid_row(id=None),
            valid_row(id=""),
            '{"id": "v',
            "",
            valid_row(id="c", first_name=""),
        ]
    )
    run.feed([valid_row(id="b"), valid_row(id="d", wbc=float("nan")) | {"wbc": "NaN"}])
    run.run()
    first, second = run.sink.counts[0], run.sink.counts[1]
    assert first.rows == 8 and sum(first.verdicts.values()) == 8
    assert first.verdicts == {"clean": 1, "rejected": 6, "duplicate": 1, "late": 0}
    # "b" was rejected first, which suppresses its clean redelivery.
    assert second.verdicts == {"clean": 0, "rejected": 1, "duplicate": 1, "late": 0}
    assert run.ids() == ["a"] and run.silver().collect()[0]["age"] == 40
    texts = {(r["raw_text"] or "")[:9]: r["reasons"] for r in seen.read_rejects(spark, run.sink.rejects).collect()}
    assert texts['{"id": "v'] == ["age", "wbc", "hgb", "id", "first_name"]
    assert first.reasons["id"] == 4 and first.reasons["hgb"] == 3 and first.reasons["first_name"] == 3


def test_runs_are_merged_and_nothing_is_forgotten(spark, monkeypatch):
    monkeypatch.setattr(seen, "RUNS", 2)
    run = Run(spark)
    for at in range(7):
        run.feed([valid_row(id=f"v{i}") for i in range(at, at + 3)])
    run.run()
    assert run.ids() == sorted(f"v{i}" for i in range(9))
    state = run.sink.index.versions.current(spark)[1]
    assert len(state["runs"]) <= 3 and max(r["level"] for r in state["runs"]) >= 2


def test_state_goes_on_in_the_index_with_other_partitions(spark):
    """Four state partitions before, sixteen tasks after: no id passes twice, none is lost."""
    from visitflow.streaming import silver as streams

    run = Run(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        run.feed([valid_row(id=f"v{i}") for i in range(30)] + [valid_row(id="dirty", age=None)])
        old = streams.start_silver(replay_stream(spark, run.inbox), run.sink.silver, f"{run.root}/old", trigger=NOW)
        streams.run_to_end(old, 300)
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        assert seen.seed_from_state(spark, f"{run.root}/old", run.sink.index) == 31
        run.feed([valid_row(id=f"v{i}") for i in range(20, 40)] + [valid_row(id="dirty")])
        run.run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert run.ids() == sorted(f"v{i}" for i in range(40))
