"""Sinks: silver micro-batch writer, gold writer, bronze encode/publish.

Silver micro-batches go to ``<root>/stream=<query id>/batch_id=<n>/age_group=<band>/``.
The query id lives in the checkpoint, so a stream that starts over with a new
checkpoint (and counts its batches from 0 again) writes beside the old rows, not
over them. A batch whose directory is already committed (``_SUCCESS``) is not
written again: Spark re-runs the last batch after a failure, and files that never
change keep streams that read the table (live gold) from counting them twice.
Each batch is written by one job: no emptiness probe and no second ``count()``
pass — the row count comes from an ``Observation`` filled by the write itself.

Gold tables are written beside their final place and moved there when complete.
"""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from visitflow.functions import rules
from visitflow.schema import BRONZE_COLUMNS, DELIVERY_SEQ
from visitflow.sinks.versions import FolderVersions
from visitflow.storage import delete, exists, replace

log = logging.getLogger(__name__)


def write_partitioned(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: str = "age_group",
    files: int | None = None,
) -> None:
    """Write silver rows partitioned by age band.

    ``files`` spreads rows round-robin over that many write tasks first, which
    bounds the file count per batch without sending one band to one task.
    """
    if files:
        df = df.repartition(files)
    df.write.mode(mode).partitionBy(partition_by).format(fmt).save(path)


class SilverBatchSink:
    """``foreachBatch`` callback: exactly once per stream and batch, partitioned, counted in one pass."""

    # Row counts of the most recent batches kept for callers (bounded history).
    KEEP_COUNTS = 1000

    def __init__(
        self,
        root: str,
        fmt: str = "parquet",
        files: int | None = None,
        per_batch_dirs: bool = True,
        stream: str | None = None,
    ):
        """``stream`` names the batches' folder instead of the running query. ``per_batch_dirs=False`` appends straight under ``<root>/age_group=<band>/``
        (the layout of the pipeline this replaces); that is *not* idempotent: a
        replayed batch is appended twice. Outside a stream, batches go under
        ``stream=manual``."""
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.files = files
        self.per_batch_dirs = per_batch_dirs
        self.stream = stream
        self.counts: dict[int, int] = {}
        self.untimed: dict[int, int] = {}
        self._tag = uuid.uuid4().hex[:12]  # observation names stay unique per sink

    def batch_path(self, batch: DataFrame, batch_id: int) -> str:
        running = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        stream = self.stream or running or "manual"
        return f"{self.root}/stream={stream}/batch_id={batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        obs = Observation(f"silver_{self._tag}_{batch_id}")
        metrics = [F.count(F.lit(1)).alias("rows")]
        if "timestamp" in batch.columns:
            metrics.append(F.count_if(rules.event_time("timestamp").isNull()).alias("untimed"))
        observed = batch.observe(obs, *metrics)
        if self.per_batch_dirs:
            path, mode = self.batch_path(batch, batch_id), "overwrite"
            if exists(batch.sparkSession, f"{path}/_SUCCESS"):
                # Its rows are there; the plan still runs, so that the state stores move on.
                observed.write.format("noop").mode("overwrite").save()
                log.info("silver batch %d: already committed, left as it is", batch_id)
                return
        else:
            path, mode = self.root, "append"
        write_partitioned(observed, path, fmt=self.fmt, mode=mode, files=self.files)
        rows = int(obs.get.get("rows", 0) or 0)
        self.counts[batch_id] = rows
        self.untimed[batch_id] = int(obs.get.get("untimed", 0) or 0)
        for kept in (self.counts, self.untimed):
            if len(kept) > self.KEEP_COUNTS:
                del kept[min(kept)]
        if self.untimed[batch_id]:
            log.info("silver batch %d: %d rows without a time", batch_id, self.untimed[batch_id])
        if rows == 0:
            # An empty partitioned write leaves no data files; probing emptiness
            # first would run the batch (and its state lookups) a second time.
            log.info("silver batch %d: empty, nothing written", batch_id)
        else:
            log.info("silver batch %d: %d rows written", batch_id, rows)


def write_gold(
    df: DataFrame,
    root: str,
    name: str,
    fmt: str = "json",
    order: list | None = None,
    rows: int | None = None,
) -> None:
    """One gold table in the given order, replacing the previous version when complete.

    ``rows``, the table's size, decides its files: up to ``ONE_FILE_ROWS`` rows are one
    sorted file; a larger table (labels are free text) is range-partitioned and sorted,
    so its part files in name order are the ordered table. Without ``order`` the
    frame must already be sorted and small (a top 10). The new version is written under ``_staging`` and moved into place, so a reader
    never sees half a table, and a crash while writing leaves the old one.
    """
    root = root.rstrip("/")
    if not order:
        out = df.coalesce(1)
    elif rows is not None and rows <= ONE_FILE_ROWS:
        out = df.repartition(1).sortWithinPartitions(*order)
    else:
        out = df.orderBy(*order)
    staged = f"{root}/_staging/{name}-{uuid.uuid4().hex}"
    out.write.format(fmt).save(staged)
    replace(df.sparkSession, staged, f"{root}/{name}")


# Tables of up to this many rows are one file.
ONE_FILE_ROWS = 100_000
# Small tables are written as concurrent jobs from at most this many driver threads.
WRITE_THREADS = 9


def write_tables(
    tables: dict[str, DataFrame],
    root: str,
    fmt: str = "json",
    orders: dict[str, list] | None = None,
    sizes: dict[str, int] | None = None,
) -> dict[str, int]:
    """Write several small tables (one file each) as concurrent Spark jobs; returns their rows.

    Each write is latency-bound, so running them side by side shortens the
    whole step. ``sizes``, known from the stored aggregate, decide how many files an ordered
    table gets; rows are counted by the writes themselves.
    """
    orders, sizes = orders or {}, sizes or {}
    tag = uuid.uuid4().hex[:12]

    def write_one(name: str) -> int:
        obs = Observation(f"table_{tag}_{name}")
        out = tables[name].observe(obs, F.count(F.lit(1)).alias("rows"))
        write_gold(out, root, name, fmt=fmt, order=orders.get(name), rows=sizes.get(name))
        rows = int(obs.get.get("rows", 0) or 0)
        log.info("table %s: %d rows", name, rows)
        return rows

    if not tables:
        return {}
    with ThreadPoolExecutor(max_workers=min(len(tables), WRITE_THREADS)) as pool:
        counts = dict(zip(tables, pool.map(write_one, tables)))
    delete(next(iter(tables.values())).sparkSession, f"{root.rstrip('/')}/_staging")
    return counts


def publish_tables(
    tables: dict[str, DataFrame],
    root: str,
    fmt: str = "json",
    orders: dict[str, list] | None = None,
    sizes: dict[str, int] | None = None,
) -> dict[str, int]:
    """``write_tables`` into a new version of ``root``: all tables become current together.

    ``sources.tables.read_gold`` follows the pointer, so a reader never sees tables of two runs. The
    versions that readers may still hold are kept; a table that this run lacks is absent.
    """
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    return FolderVersions(root).write(spark, lambda folder: write_tables(tables, folder, fmt, orders, sizes))


def encode(bronze: DataFrame, with_delivery_seq: bool = False) -> DataFrame:
    """Bronze rows -> JSON message text in ``value`` (null fields are omitted).

    ``delivery_seq`` is kept as its own column (the Kafka offset's role); with
    ``with_delivery_seq`` it is also written inside the JSON, which is the
    layout of replay files.
    """
    fields = ([DELIVERY_SEQ] if with_delivery_seq else []) + BRONZE_COLUMNS
    return bronze.select(
        F.col(DELIVERY_SEQ), F.to_json(F.struct(*[F.col(c) for c in fields])).alias("value")
    )


def publish_kafka(bronze: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Publish bronze rows as JSON messages (no key), as the reference producer does."""
    (
        encode(bronze)
        .select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )


def start_publish_kafka(
    bronze_stream: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str
):
    """Publish a stream of bronze rows as JSON messages, checkpointed (at-least-once)."""
    return (
        encode(bronze_stream)
        .select("value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_replay_files(bronze: DataFrame, path: str) -> None:
    """Write bronze rows as replay files (JSON lines carrying ``delivery_seq``)."""
    encode(bronze, with_delivery_seq=True).select("value").write.mode("append").text(path)
