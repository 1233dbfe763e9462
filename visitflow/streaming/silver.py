"""Structured Streaming: silver from a message stream, live gold aggregates.

* ``start_silver`` — decode, dedupe (state store, unbounded as in the
  reference, bounded by a watermark, or salted for hot ids), validate,
  standardise, then an idempotent ``foreachBatch`` sink (a replayed batch id
  overwrites itself).
* ``start_live_gold`` — a streaming aggregate over the silver stream in
  ``complete`` mode; each trigger replaces the small result table.
  ``start_live_gold_all`` keeps all nine gold tables this way, from one
  GROUPING SETS state; ``start_gold_tables_stream`` also rewrites the nine JSON
  gold tables each trigger (fed by the silver stream or by the silver table's
  new files).
* ``start_daily_trends`` — per-day aggregate in ``update`` mode; each trigger
  overwrites only the days it changed (dynamic partition overwrite), so the
  table is always the latest value per day.

Dedupe state holds every id ever seen (the reference's semantics); on a large
stream use the RocksDB state store (``use_rocksdb_state``) so state lives on
local disk and in checkpoints, not on the JVM heap, or the bounded variant.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from visitflow.functions import rules
from visitflow.operators import silver as silver_ops
from visitflow.sinks.files import SilverBatchSink
from visitflow.sources.messages import decode_envelope
from visitflow.schema import GOLD_SCHEMAS
from visitflow.storage import exists, replace

log = logging.getLogger(__name__)

#: How far a record's clock may run ahead and still move the watermark.
FUTURE_SKEW = "1 DAY"

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
_CHANGELOG_KEY = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB (must be set before a checkpoint is first created).

    Changelog checkpointing makes each micro-batch upload only the state changes
    (new ids), not a snapshot of the whole store; snapshots are taken in the
    background. That matters when the dedupe state holds many ids.
    """
    spark.conf.set(_PROVIDER_KEY, ROCKSDB_PROVIDER)
    spark.conf.set(_CHANGELOG_KEY, "true")


def silver_stream(
    messages: DataFrame,
    decode_fn: Callable[[DataFrame], DataFrame] = decode_envelope,
    bounded_delay: str | None = None,
    salt_buckets: int | None = None,
) -> DataFrame:
    """Streaming silver rows from a stream of JSON messages (column ``json_data``).

    ``bounded_delay=None``: unbounded dedupe on ``id`` (reference semantics);
    ``salt_buckets`` spreads hot ids over that many state partitions first
    (unbounded variant only).
    Otherwise dedupe within a watermark on the record's own time (the start of its
    visit date, if only the date can be read). Records whose clock can't be
    trusted — no time at all, or one more than ``FUTURE_SKEW`` ahead of the
    micro-batch — must not move the watermark and can't be bounded by it: they are
    deduped on ``id`` beside it, with a state of their own that holds only their ids.
    The sink counts the rows without a time.

    The two states do not see each other: an id delivered once with a trusted clock and
    once without (no time, or a time too far ahead when it came) stays twice in silver.
    """
    bronze = decode_fn(messages)
    if bounded_delay is None:
        return silver_ops.clean(bronze, salt_buckets=salt_buckets)
    timed = bronze.filter(rules.present("id")).withColumn("visit_time", rules.event_time("timestamp"))
    trusted = F.coalesce(
        F.col("visit_time") <= F.current_timestamp() + F.expr(f"INTERVAL {FUTURE_SKEW}"), F.lit(False)
    )
    bounded = silver_ops.dedupe_within_watermark(timed.filter(trusted), "visit_time", bounded_delay)
    beside = timed.filter(~trusted).dropDuplicates(["id"])
    deduped = bounded.drop("visit_time").unionByName(beside.drop("visit_time"))
    return silver_ops.standardise(silver_ops.quality_filter(deduped))


def start_silver(
    messages: DataFrame,
    sink: SilverBatchSink,
    checkpoint: str,
    trigger: dict | None = None,
    bounded_delay: str | None = None,
    decode_fn: Callable[[DataFrame], DataFrame] = decode_envelope,
    query_name: str | None = None,
    salt_buckets: int | None = None,
) -> StreamingQuery:
    """Start the silver stream into ``sink`` (default trigger: every 10 seconds)."""
    stream = silver_stream(
        messages, decode_fn=decode_fn, bounded_delay=bounded_delay, salt_buckets=salt_buckets
    )
    writer = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


class OverwriteTableSink:
    """``foreachBatch`` callback for complete mode: the batch is the whole table."""

    def __init__(self, path: str, fmt: str = "parquet"):
        self.path = path
        self.fmt = fmt

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        staged = f"{self.path.rstrip('/')}-staged-{uuid.uuid4().hex}"
        batch.write.format(self.fmt).save(staged)
        replace(batch.sparkSession, staged, self.path)


class UpsertPartitionsSink:
    """``foreachBatch`` callback for update mode: overwrite only the partitions in the batch."""

    def __init__(self, path: str, partition_by: str, fmt: str = "parquet"):
        self.path = path
        self.partition_by = partition_by
        self.fmt = fmt

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.partition_by)
            .format(self.fmt)
            .save(self.path)
        )


def start_live_gold(
    silver: DataFrame,
    builder: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A gold aggregate kept current in ``complete`` mode (small, label-keyed tables)."""
    return (
        builder(silver)
        .writeStream.outputMode("complete")
        .foreachBatch(OverwriteTableSink(path))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def start_live_gold_all(
    silver: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """All nine gold tables kept current by one stateful aggregate.

    The state is the GROUPING SETS aggregate of ``operators.gold.aggregate_all``
    (counts and sums per group, so it grows with the number of groups, not with
    the data); each trigger rewrites that table and ``read_live_gold`` cuts the
    nine tables from it. This replaces re-scanning all of silver per gold run.
    """
    from visitflow.operators import gold

    return start_live_gold(silver, gold.aggregate_all, path, checkpoint, trigger)


class GoldTablesSink:
    """``foreachBatch`` callback (complete mode over ``aggregate_all``): rewrite the
    nine gold tables each trigger, in the layout of the batch gold job.

    The aggregate batch is written once under ``<root>/_staging``, partitioned by
    grain; each table is then cut from its own part, so the stateful plan runs once
    per trigger and no table reads another's rows.
    """

    def __init__(self, root: str, fmt: str = "json"):
        self.root = root.rstrip("/")
        self.fmt = fmt

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from visitflow.operators import gold
        from visitflow.sinks.files import write_tables

        agg = gold.store_aggregate(batch, f"{self.root}/_staging/aggregate-{uuid.uuid4().hex}")
        tables = gold.split(agg, ordered=False)
        orders = {n: gold.table_order(n) for n in tables if n not in gold.LIMITED}
        write_tables(tables, self.root, fmt=self.fmt, orders=orders, sizes=gold.stored_sizes(agg))  # removes _staging


def start_gold_tables_stream(
    silver: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, fmt: str = "json"
) -> StreamingQuery:
    """Keep the nine gold tables under ``root`` current from a silver stream."""
    from visitflow.operators import gold

    return (
        gold.aggregate_all(silver)
        .writeStream.outputMode("complete")
        .foreachBatch(GoldTablesSink(root, fmt))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def read_live_gold(spark: SparkSession, path: str, ordered: bool = True) -> dict[str, DataFrame]:
    """The nine gold tables from the table written by ``start_live_gold_all``."""
    from visitflow.operators import gold

    return gold.split(spark.read.parquet(path), ordered=ordered)


def live_severity(silver: DataFrame) -> DataFrame:
    """Severity summary as a streaming aggregate (sorting happens at read time)."""
    from visitflow.operators import gold

    return gold.table_aggregate(silver, "severity_summary")


def live_daily_trends(silver: DataFrame) -> DataFrame:
    """Daily counts keyed on the record's own calendar date (as the batch table).

    The key is the date text of the record, so no time zone enters. State is
    one row per calendar day (a few hundred a year), so it needs no watermark:
    a late record still lands on its own day and the day is rewritten.
    """
    from visitflow.operators import gold

    return gold.table_aggregate(silver, "daily_trends")


def start_daily_trends(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the daily table current: ``update`` mode, each changed day overwritten."""
    return (
        live_daily_trends(silver)
        .writeStream.outputMode("update")
        .foreachBatch(UpsertPartitionsSink(path, "date"))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def windowed_daily_trends(silver: DataFrame, delay: str) -> DataFrame:
    """Daily counts by event-time windows of one day; a day leaves the state once the watermark passes its end.

    Rows more than ``delay`` behind the latest day seen find their day closed and are dropped
    (``late_rows`` counts them), so ``delay`` must exceed the stream's disorder. Rows whose clock runs
    over ``FUTURE_SKEW`` ahead don't move the watermark: they are left out here, and so are
    undated ones; ``undated_trends`` has both.
    """
    day = rules.visit_date("timestamp").cast("timestamp")
    timed = silver.withColumn("visit_day", day).where(_trusted("visit_day")).withWatermark("visit_day", delay)
    daily = timed.groupBy(F.window("visit_day", "1 day")).agg(*_daily_columns())
    return daily.select(F.col("window.start").cast("date").alias("date"), *DAILY_COLUMNS)


def undated_trends(silver: DataFrame) -> DataFrame:
    """The days that have no window: null, and dates too far ahead. Their state is a row each."""
    date = rules.visit_date("timestamp")
    rest = silver.withColumn("date", date).where(~_trusted(date.cast("timestamp")))
    return rest.groupBy("date").agg(*_daily_columns()).select("date", *DAILY_COLUMNS)


DAILY_COLUMNS = ("patient_per_day", "avg_age", "severe_cases")


def _daily_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("patient_per_day"),
        F.round(F.avg("age"), 1).alias("avg_age"),
        F.count_if(F.col("severity") == "SEVERE").alias("severe_cases"),
    ]


def _trusted(time: str | Column) -> Column:
    time = F.col(time) if isinstance(time, str) else time
    return F.coalesce(time <= F.current_timestamp() + F.expr(f"INTERVAL {FUTURE_SKEW}"), F.lit(False))


def start_daily_windows(
    silver: DataFrame, path: str, checkpoint: str, delay: str, trigger: dict | None = None
) -> list[StreamingQuery]:
    """Keep the daily table current with bounded state: two queries, windows and the days without one.

    They write days that don't overlap to one table, each changed day overwritten. ``silver`` is read by both;
    feed them from the silver table's new files.
    """
    queries = []
    for name, rows in (("windows", windowed_daily_trends(silver, delay)), ("undated", undated_trends(silver))):
        writer = rows.writeStream.outputMode("update").foreachBatch(UpsertPartitionsSink(f"{path}/part={name}", "date"))
        writer = writer.option("checkpointLocation", f"{checkpoint}/{name}")
        queries.append(writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start())
    return queries


def read_daily_windows(spark: SparkSession, path: str) -> DataFrame:
    """The daily table that ``start_daily_windows`` keeps."""
    schema = GOLD_SCHEMAS["daily_trends"]
    out = None
    for name in ("windows", "undated"):
        folder = f"{path}/part={name}"
        if exists(spark, folder):
            part = spark.read.schema(schema).option("basePath", folder).parquet(folder).select(*schema.fieldNames())
            out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's last micro-batches dropped as later than the watermark."""
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0) or 0)
        for progress in query.recentProgress
        for op in (progress.get("stateOperators", []) if isinstance(progress, dict) else progress.stateOperators)
    )


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query and report late rows; fail if it errs.

    ``timeout_s`` (for tests) stops a query that takes longer; without it the
    wait has no limit.
    """
    finished = query.awaitTermination() if timeout_s is None else query.awaitTermination(timeout_s)
    late = late_rows(query)
    if late:
        log.warning("streaming query %s dropped %d late rows", query.id, late)
    if timeout_s is not None and not finished:
        query.stop()
        raise TimeoutError(f"streaming query {query.id} did not finish within {timeout_s}s")
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query {query.id} failed: {exc}")
