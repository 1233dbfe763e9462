"""Live gold by keyed upsert: a trigger writes the groups it changed, not the table.

* ``start_gold_upsert`` — the streaming aggregate in ``update`` mode; each trigger's changed
  groups replace their rows in a bucketed table, and only the buckets that hold them are written.
* ``start_top`` — the two top-10 tables alone. Counts only grow, so the next top 10 is the top 10 of
  the old one and the groups that changed; no full group table is kept or read.
* ``merge_batches`` — the same bucketed table kept without streaming state: every committed silver
  batch is aggregated once and its sums are added; a ledger says which batches are in.

A replayed micro-batch finds its number in the table's current version and changes nothing.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from visitflow.operators import gold
from visitflow.sinks.versions import KeyedTable, added, newest
from visitflow.sources.tables import committed_batches, read_silver_batches

log = logging.getLogger(__name__)


def gold_store(spark: SparkSession, root: str, buckets: int = 64) -> KeyedTable:
    """The bucketed table of all nine tables' groups (``operators.gold.aggregate_all``)."""
    return KeyedTable(root, gold.aggregate_schema(spark), gold.AGGREGATE_KEYS, buckets)


class UpsertSink:
    """``foreachBatch`` callback in update mode: each row holds its group's new sums."""

    def __init__(self, root: str, buckets: int = 64):
        self.root, self.buckets = root, buckets
        self.touched: dict[int, set[int]] = {}

    def combine(self):
        return newest(gold.AGGREGATE_KEYS, gold.AGGREGATE_SUMS)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = gold_store(spark, self.root, self.buckets)
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
        done = store.versions.current(spark)[1].get("streams", {})
        if done.get(stream, -1) >= batch_id:
            # Its rows are in; the plan still runs, so that the state stores move on.
            batch.write.format("noop").mode("overwrite").save()
            log.info("gold batch %d: already merged", batch_id)
            return
        self.touched = {batch_id: store.write(batch, self.combine(), {"streams": {**done, stream: batch_id}})}


class TopSink(UpsertSink):
    """The same with the ``TOP_N`` largest groups of each table only, in one bucket."""

    def __init__(self, root: str):
        super().__init__(root, buckets=1)

    def combine(self):
        keep = super().combine()
        # A row has the keys of its own table only, so one order serves both.
        order = [F.col("n").desc(), *[F.col(k).asc_nulls_last() for n in sorted(gold.LIMITED) for k in gold.GRAINS[n]]]
        place = F.row_number().over(Window.partitionBy("grain").orderBy(*order))

        def combine(rows: DataFrame) -> DataFrame:
            return keep(rows).withColumn("__place", place).where(F.col("__place") <= gold.TOP_N).drop("__place")

        return combine


def _start(aggregate: DataFrame, sink: UpsertSink, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = aggregate.writeStream.outputMode("update").foreachBatch(sink)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def start_gold_upsert(
    silver: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, buckets: int = 64
) -> StreamingQuery:
    """Keep all nine tables' groups current under ``root``.

    Choose ``buckets`` so that a bucket is some MB: a trigger rewrites the buckets
    of its changed groups, at most all of them.
    """
    return _start(gold.aggregate_all(silver), UpsertSink(root, buckets), checkpoint, trigger)


def start_top(silver: DataFrame, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the top doctors and diagnoses current under ``root``: twenty rows and the changed groups a trigger."""
    return _start(gold.aggregate_all(silver, sorted(gold.LIMITED)), TopSink(root), checkpoint, trigger)


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """The stored groups, as ``operators.gold.split`` and ``stacked`` take them."""
    return gold_store(spark, root).read(spark)


def read_top(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """``top_doctors`` and ``diagnosis_summary`` from what ``start_top`` keeps, in order."""
    tables = gold.split(read_store(spark, root))
    return {n: tables[n] for n in sorted(gold.LIMITED)}


# ------------------------------------------------------------------ batches


def _covers(ranges: list[list[int]], number: int) -> bool:
    return any(a <= number <= b for a, b in ranges)


def _with(ranges: list[list[int]], numbers: list[int]) -> list[list[int]]:
    """Ascending ranges that also hold ``numbers``; neighbours join, so a stream's ledger stays short."""
    out: list[list[int]] = []
    for a, b in sorted(ranges + [[n, n] for n in numbers]):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def merge_batches(spark: SparkSession, silver_root: str, root: str, buckets: int = 64) -> int:
    """Add the silver batches that aren't in the store yet; returns how many there were.

    Only these batches' files are read. The sums and the ledger become current together, so a
    crash at any point leaves each batch in once or not at all.
    """
    store = gold_store(spark, root, buckets)
    ledger = store.versions.current(spark)[1].get("merged", {})
    new = committed_batches(spark, silver_root, lambda stream, n: _covers(ledger.get(stream, []), n))
    if not new:
        return 0
    rows = read_silver_batches(spark, silver_root, new)
    by_stream: dict[str, list[int]] = {}
    for stream, number in new:
        by_stream.setdefault(stream, []).append(number)
    merged = {s: _with(ledger.get(s, []), by_stream.get(s, [])) for s in {*ledger, *by_stream}}
    store.write(gold.aggregate_all(rows), added(gold.AGGREGATE_KEYS, gold.AGGREGATE_SUMS), {"merged": merged})
    log.info("merged %d silver batches", len(new))
    return len(new)
