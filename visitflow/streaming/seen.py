"""Silver with the ids seen kept on disk instead of in streaming state.

``IndexedSilverSink`` is a ``foreachBatch`` callback over *decoded* messages. Each micro-batch is
read from its source once and judged row by row:

* ``late`` — its own time lies behind the horizon (only with a horizon): kept in a side table,
  from which ``repair_late`` merges what silver lacks;
* ``rejected`` — it fails a check (or has no id): kept with its text and the reasons;
* ``duplicate`` — another delivery of an id, earlier in the batch or in a batch before;
* ``clean`` — written to silver.

``SeenIds`` remembers ids for ever (``horizon=None``, the semantics of an unbounded dedupe) or for
``horizon`` days of event time. Its parts, all published as one version:

* runs: ids sorted into buckets by hash, a run a batch; ``RUNS`` runs of one size are merged into one
  of the next, so there are few of them however long the stream has run;
* a bitmap of ``BITS`` bits. An id whose bit is clear was never seen and needs no lookup; for
  the others, only the buckets they fall in are read.

An id without a trusted clock (no time, or one too far ahead) is remembered by its arrival day, in the
same index: delivered once with and once without a time, it stays once.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from visitflow.functions import rules
from visitflow.operators import silver as silver_ops
from visitflow.schema import DELIVERY_SEQ
from visitflow.sinks.files import SilverBatchSink
from visitflow.sinks.versions import Versions
from visitflow.sources.messages import decode_envelope
from visitflow.storage import delete, exists, names

log = logging.getLogger(__name__)

#: How far a record's clock may run ahead and still count.
FUTURE_SKEW = "1 DAY"
BUCKETS = 64
#: Bits of the filter; 1 MB, in rows of 4 KB.
BITS = 1 << 23
#: Runs of one size that are merged.
RUNS = 8
RAW = "raw_text"
VERDICTS = ("clean", "rejected", "duplicate", "late")
_ENTRY = "id string, day date, timed boolean"


def _bit() -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(BITS)) + 1


class SeenIds:
    """The index of ids under ``root``; see the module's text."""

    def __init__(self, root: str, horizon: int | None = None, buckets: int = BUCKETS):
        self.root, self.horizon, self.buckets = root.rstrip("/"), horizon, buckets
        self.versions = Versions(self.root)
        self.data = f"{self.root}/data"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(1)), F.lit(self.buckets)).cast("int")

    def cutoff(self, state: dict) -> dt.datetime | None:
        """Records older than this are late: the latest trusted time of the batches before, less the horizon."""
        if self.horizon is None or not state.get("latest"):
            return None
        return dt.datetime.fromisoformat(state["latest"]) - dt.timedelta(days=self.horizon)

    def _alive(self, state: dict) -> Column:
        """Entries that still count: by event time if they have one, else by arrival."""
        cutoff = self.cutoff(state)
        if cutoff is None:
            return F.lit(True)
        arrived = F.date_sub(F.current_date(), self.horizon)
        return F.when(F.col("timed"), F.col("day") >= F.lit(cutoff.date())).otherwise(F.col("day") >= arrived)

    def maybe_seen(self, rows: DataFrame, state: dict) -> DataFrame:
        """``rows`` with ``maybe``: whether the id's bit is set. The bitmap is at most BITS bits, so it is broadcast."""
        if not state.get("bitmap"):
            return rows.withColumn("maybe", F.lit(False))
        bitmap = rows.sparkSession.read.schema("word long, bits binary").parquet(f"{self.data}/{state['bitmap']}")
        keyed = rows.withColumn("word", F.bitmap_bucket_number(_bit())).withColumn("__at", F.bitmap_bit_position(_bit()))
        byte = F.conv(F.hex(F.expr("substring(bits, cast(__at div 8 as int) + 1, 1)")), 16, 10).cast("int")
        hit = F.coalesce(F.getbit(byte, (F.col("__at") % 8).cast("int")) == 1, F.lit(False))
        return keyed.join(F.broadcast(bitmap), "word", "left").withColumn("maybe", hit).drop("word", "__at", "bits")

    def lookup(self, spark: SparkSession, state: dict, buckets: set[int]) -> DataFrame | None:
        """The remembered ids of the named buckets (``id``), or None if there are none."""
        paths = [f"{self.data}/{r['name']}/bucket={b}" for r in state.get("runs", []) for b in r["buckets"] if b in buckets]
        if not paths:
            return None
        return spark.read.schema(_ENTRY).parquet(*paths).where(self._alive(state)).select("id")

    def add(self, ids: DataFrame, notes: dict, name: str) -> None:
        """Remember ``ids`` (id, day, timed) and publish the next version with ``notes``."""
        spark = ids.sparkSession
        number, state = self.versions.current(spark)
        number, state = number + 1, {**state, **notes}
        runs = list(state.get("runs", []))
        run = self._write(ids, f"run-{name}", level=0)
        if run:
            bitmap = spark.read.schema(_ENTRY).parquet(f"{self.data}/{run['name']}")
            words = bitmap.groupBy(F.bitmap_bucket_number(_bit()).alias("word")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position(_bit())).alias("bits")
            )
            if state.get("bitmap"):
                old = spark.read.schema("word long, bits binary").parquet(f"{self.data}/{state['bitmap']}")
                words = old.unionByName(words).groupBy("word").agg(F.bitmap_or_agg("bits").alias("bits"))
            words.coalesce(1).write.mode("overwrite").parquet(f"{self.data}/bitmap-{number}")
            runs, state["bitmap"] = [*runs, run], f"bitmap-{number}"
        self.versions.publish(spark, number, {**state, "runs": self._merged(spark, runs, state, number)})
        self.versions.retire(spark, self.data, lambda s: {*(r["name"] for r in s.get("runs", [])), s.get("bitmap")} - {None})

    def _write(self, ids: DataFrame, name: str, level: int) -> dict | None:
        path = f"{self.data}/{name}"
        out = ids.select("id", "day", "timed", self.bucket().alias("bucket")).repartition("bucket")
        out.write.mode("overwrite").partitionBy("bucket").parquet(path)
        buckets = [int(n.removeprefix("bucket=")) for n in names(ids.sparkSession, path) if n.startswith("bucket=")]
        return {"name": name, "level": level, "buckets": buckets} if buckets else None

    def _merged(self, spark: SparkSession, runs: list[dict], state: dict, number: int) -> list[dict]:
        """Merge the runs of a level while there are RUNS of them; what the horizon has passed is left out."""
        level = 0
        while sum(r["level"] == level for r in runs) >= RUNS:
            old = [r for r in runs if r["level"] == level]
            rows = spark.read.schema(_ENTRY).parquet(*[f"{self.data}/{r['name']}/bucket={b}" for r in old for b in r["buckets"]])
            run = self._write(rows.where(self._alive(state)), f"run-merged-{number}-{level + 1}", level + 1)
            runs = [r for r in runs if r["level"] != level] + ([run] if run else [])
            level += 1
        return runs


@dataclass
class Counts:
    """Rows of one micro-batch by verdict, and rejected rows by reason (a row can have several)."""

    rows: int = 0
    verdicts: dict[str, int] = field(default_factory=dict)
    reasons: dict[str, int] = field(default_factory=dict)


class IndexedSilverSink:
    """``foreachBatch`` callback: silver, rejected and late rows of decoded messages (with ``RAW``)."""

    KEEP_COUNTS = 1000

    def __init__(self, silver: SilverBatchSink, index: SeenIds, rejects: str, late: str):
        self.silver, self.index = silver, index
        self.rejects, self.late = rejects.rstrip("/"), late.rstrip("/")
        self.counts: dict[int, Counts] = {}
        self._tag = uuid.uuid4().hex[:12]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
        number, state = self.index.versions.current(spark)
        if state.get("streams", {}).get(stream, -1) >= batch_id:
            log.info("batch %d: already in silver and in the index", batch_id)
            return
        staged = f"{self.index.root}/_staging/{stream}-{batch_id}"
        rows, latest = self._stage(batch, batch_id, state, f"{staged}/rows")
        counts = self._judge(spark, batch_id, state, f"{staged}/rows", f"{staged}/judged")
        counts.rows = rows
        counts.verdicts["duplicate"] += rows - sum(counts.verdicts.values())  # later deliveries within the batch
        judged = spark.read.schema(self._schema(spark, staged)).parquet(f"{staged}/judged")
        own = batch.columns

        def of(verdict: str) -> DataFrame:
            return judged.where(F.col("verdict") == verdict)

        clean = of("clean").select([c for c in own if c != RAW])
        self.silver(silver_ops.standardise(clean), batch_id)
        for root, verdict, columns in ((self.rejects, "rejected", [RAW, "reasons", DELIVERY_SEQ, "id"]), (self.late, "late", own)):
            if counts.verdicts[verdict]:
                path = f"{root}/stream={stream}/batch_id={batch_id}"
                of(verdict).select(columns).write.mode("overwrite").parquet(path)
        remembered = of("clean").unionByName(of("rejected")).where(rules.present("id")).select("id", "day", "timed")
        latest = max(filter(None, [state.get("latest"), latest.isoformat() if latest else None]), default=None)
        notes = {"streams": {**state.get("streams", {}), stream: batch_id}, "latest": latest}
        self.index.add(remembered, notes, f"{stream}-{batch_id}")
        delete(spark, staged)
        self.counts[batch_id] = counts
        if len(self.counts) > self.KEEP_COUNTS:
            del self.counts[min(self.counts)]
        log.info("batch %d: %s", batch_id, counts)

    def _schema(self, spark: SparkSession, staged: str):
        rows = spark.read.parquet(f"{staged}/rows").schema
        return rows.add("verdict", "string")

    def _stage(self, batch: DataFrame, batch_id: int, state: dict, path: str) -> tuple[int, dt.datetime | None]:
        """Read the batch once: flags, reasons, and the first delivery of each id. Returns its rows and latest trusted time."""
        time = rules.event_time("timestamp")
        timed = F.coalesce(time <= F.current_timestamp() + F.expr(f"INTERVAL {FUTURE_SKEW}"), F.lit(False))
        cutoff = self.index.cutoff(state)
        late = timed & (time < F.lit(cutoff)) & rules.present("id") if cutoff else F.lit(False)
        obs = Observation(f"seen_{self._tag}_{batch_id}")
        flagged = batch.select(
            "*",
            timed.alias("timed"),
            F.coalesce(F.when(timed, time.cast("date")), F.current_date()).alias("day"),
            late.alias("late"),
            rules.reject_reasons().alias("reasons"),
        ).observe(obs, F.count(F.lit(1)).alias("rows"), F.max(F.when(timed, time)).alias("latest"))
        # Rows that take no part in the dedupe are groups of their own.
        alone = F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))
        keyed = flagged.withColumn("__key", F.when(rules.present("id") & ~F.col("late"), F.col("id")).otherwise(alone))
        # An aggregate, not a window: a hot id is cut to a row a task before the shuffle.
        row = F.min_by(F.struct(*flagged.columns), F.coalesce(DELIVERY_SEQ, F.lit(0)))
        first = keyed.groupBy("__key").agg(row.alias("row"))
        first = self.index.maybe_seen(first.select("row.*"), state)
        first.withColumn("bucket", self.index.bucket()).write.mode("overwrite").parquet(path)
        got = obs.get
        return int(got.get("rows", 0) or 0), got.get("latest")

    def _judge(self, spark: SparkSession, batch_id: int, state: dict, path: str, out: str) -> Counts:
        """Look up what the bitmap doesn't clear, and write every row with its verdict."""
        rows = spark.read.parquet(path)
        asked = F.col("maybe") & ~F.col("late") & rules.present("id")
        buckets = {r["bucket"] for r in rows.where(asked).select("bucket").distinct().collect()}  # at most BUCKETS
        known = self.index.lookup(spark, state, buckets) if buckets else None
        if known is None:
            rows = rows.withColumn("known", F.lit(False))
        else:
            known = known.distinct().withColumn("known", F.lit(True))
            looked = rows.where(asked).join(known, "id", "left").withColumn("known", F.coalesce("known", F.lit(False)))
            rows = rows.where(~asked).withColumn("known", F.lit(False)).unionByName(looked)
        verdict = (
            F.when(F.col("late"), "late").when(F.col("known"), "duplicate").when(F.size("reasons") > 0, "rejected").otherwise("clean")
        )
        obs = Observation(f"judged_{self._tag}_{batch_id}")
        judged = rows.withColumn("verdict", verdict).drop("known")
        is_out = F.col("verdict") == "rejected"
        metrics = [F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS]
        metrics += [F.count_if(is_out & F.array_contains("reasons", r)).alias(f"reason_{r}") for r in rules.quality_checks()]
        judged.observe(obs, *metrics).write.mode("overwrite").parquet(out)
        got = obs.get
        reasons = {r: int(got.get(f"reason_{r}", 0) or 0) for r in rules.quality_checks()}
        return Counts(verdicts={v: int(got.get(v, 0) or 0) for v in VERDICTS}, reasons=reasons)


def seed_from_state(spark: SparkSession, checkpoint: str, index: SeenIds) -> int:
    """Remember the ids in the dedupe state of a stopped query (its checkpoint); returns how many.

    The state store's partitions are fixed when a query starts; the index has none. So a stream that kept
    its ids in state goes on with the indexed sink and any number of partitions, and no id passes
    again: start it with a new checkpoint at the old one's offsets, or from the beginning, where what
    silver has is found to be a duplicate. Ids whose first delivery was rejected are in the state, too.
    """
    state = spark.read.format("statestore").option("path", checkpoint).load()
    ids = state.select(F.col("key.id").alias("id"), F.current_date().alias("day"), F.lit(False).alias("timed"))
    ids = ids.where(rules.present("id"))
    count = ids.count()
    index.add(ids, {}, f"seed-{uuid.uuid4().hex}")
    return count


def with_raw(messages: DataFrame, decode_fn=decode_envelope) -> DataFrame:
    """Decoded messages that keep their text as ``RAW``."""
    return decode_fn(messages.withColumn(RAW, F.col("json_data")))


def start_indexed_silver(
    messages: DataFrame, sink: IndexedSilverSink, checkpoint: str, trigger: dict | None = None, decode_fn=decode_envelope
) -> StreamingQuery:
    """Start the silver stream with the id index; the query itself keeps no state."""
    writer = with_raw(messages, decode_fn).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def read_rejects(spark: SparkSession, root: str, but: str = "") -> DataFrame:
    """Rejected rows: their text, the reasons, arrival order and id (``but`` those of one batch folder)."""
    schema = f"{RAW} string, reasons array<string>, {DELIVERY_SEQ} long, id string"
    folders = [f"{s}/{b}" for s in names(spark, root) if s.startswith("stream=") for b in names(spark, f"{root}/{s}")]
    paths = [f"{root}/{f}" for f in folders if f != but]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def repair_late(spark: SparkSession, silver: SilverBatchSink, rejects: str, late: str, ledger: str) -> int:
    """Merge late rows whose id neither silver nor the rejected rows hold; returns the late batches read.

    Of the late deliveries of an id the first counts, as in a batch. The rows become silver batches of
    the stream ``repair``; those that fail a check join the rejected rows. ``ledger`` is a folder that
    remembers which late batches are merged; a repair that failed is done again in full.
    """
    versions = Versions(ledger)
    number, state = versions.current(spark)
    done, repair = set(state.get("done", [])), state.get("repairs", 0) + 1
    new = state.get("pending", [])  # of a repair that failed: done again with the same batches
    if not new:
        folders = [f"{s}/{b}" for s in names(spark, late) if s.startswith("stream=") for b in names(spark, f"{late}/{s}")]
        new = [f for f in folders if f not in done and exists(spark, f"{late}/{f}/_SUCCESS")]
        if not new:
            return 0
        number += 1
        versions.publish(spark, number, {**state, "pending": new})
    rows = spark.read.parquet(*[f"{late}/{f}" for f in new])
    first = silver_ops.dedupe_first_delivery(rows.where(rules.present("id")))
    for held in (_silver_ids(spark, silver, repair), read_rejects(spark, rejects, but=f"stream=repair/batch_id={repair}").select("id")):
        if held is not None:
            first = first.join(held, "id", "left_anti")
    staged = f"{ledger.rstrip('/')}/_staging/{repair}"
    first.withColumn("reasons", rules.reject_reasons()).write.mode("overwrite").parquet(staged)
    judged = spark.read.parquet(staged)
    good = F.size("reasons") == 0
    out = SilverBatchSink(silver.root, silver.fmt, silver.files, stream="repair")
    out(silver_ops.standardise(judged.where(good).drop("reasons", RAW)), repair)
    bad = judged.where(~good).select(RAW, "reasons", DELIVERY_SEQ, "id")
    bad.write.mode("overwrite").parquet(f"{rejects}/stream=repair/batch_id={repair}")
    versions.publish(spark, number + 1, {"done": sorted(done | set(new)), "repairs": repair, "pending": []})
    delete(spark, staged)
    return len(new)


def _silver_ids(spark: SparkSession, silver: SilverBatchSink, number: int) -> DataFrame | None:
    """Ids in silver, without what an unfinished repair of this number may have left."""
    if not exists(spark, silver.root):
        return None
    rows = spark.read.schema("id string, stream string, batch_id long").option("basePath", silver.root).format(silver.fmt).load(silver.root)
    return rows.where(~((F.col("stream") == "repair") & (F.col("batch_id") == number))).select("id")
