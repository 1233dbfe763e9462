"""Job entry points: the silver stream, the gold batch (full or incremental), the KPIs.

Configuration comes from environment variables (same names as the pipeline
they replace) and can be overridden by keyword arguments:

===========================  ==========================  ==============================
variable                     meaning                     default
===========================  ==========================  ==============================
``KAFKA_BOOTSTRAP_SERVERS``  Kafka brokers               ``localhost:9092``
``KAFKA_TOPIC``              topic of visit messages     ``test_Topic``
``SILVER_OUTPUT_PATH``       silver table                (required)
``CHECKPOINT_PATH``          silver stream checkpoint    (required)
``TRIGGER_INTERVAL``         micro-batch interval        ``10 seconds``
``MAX_OFFSETS_PER_TRIGGER``  messages per micro-batch    ``200`` (0: no limit)
``MAX_FILES_PER_TRIGGER``    files per micro-batch       ``1`` (0: no limit)
``GOLD_OUTPUT_PATH``         gold tables root            (required)
``SILVER_SOURCE``            ``kafka`` or ``files``      ``kafka``
``SILVER_INPUT_PATH``        replay files (``files``)    -
``SILVER_FORMAT``            silver file format          ``parquet``
``SILVER_FILES_PER_BATCH``   writers per micro-batch     off (one per state partition)
``DEDUPE_WATERMARK_DELAY``   bounded dedupe delay        off (unbounded)
``DEDUPE_SALT_BUCKETS``      salted stream dedupe        off
``KAFKA_MIN_PARTITIONS``     split hot topic partitions  off
``GOLD_CHECKPOINT_PATH``     live gold checkpoint        (required for gold-live)
``GOLD_TRIGGER_INTERVAL``    live gold refresh interval  ``1 minute``
``REPORT_OUTPUT_PATH``       dashboard data tables       ``<GOLD_OUTPUT_PATH>/_report``
``SILVER_INDEX_PATH``        id index of the dedupe      off (ids in streaming state)
``REJECTS_OUTPUT_PATH``      rejected rows (with index)  ``<SILVER_INDEX_PATH>/rejects``
``LATE_OUTPUT_PATH``         late rows (with index)      ``<SILVER_INDEX_PATH>/late``
``DEDUPE_HORIZON_DAYS``      days an id is remembered    off (for ever; with index)
``GOLD_STORE_PATH``          sums of gold-incremental    ``<GOLD_OUTPUT_PATH>/_store``
``GOLD_VERSIONED``           nine tables as one version  off (``1``: on)
===========================  ==========================  ==============================

200 messages every 10 seconds are 20 a second: a topic that gets more, or a large
backlog, never drains at the default. Set ``MAX_OFFSETS_PER_TRIGGER`` to what one
trigger can work off, or to 0.

Run with ``spark-submit --py-files visitflow.zip visitflow/__main__.py <job>`` (jobs:
``silver``, ``gold``, ``gold-incremental``, ``gold-live``, ``repair``, ``kpi``, ``report``)
or ``python -m visitflow …``.
The session comes from ``SparkSession.builder.getOrCreate()``, so the master
and cluster settings are those of the submit command.
"""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from visitflow.plans.batch import kpis_from_gold, run_gold, run_gold_incremental, write_report
from visitflow.sinks.files import SilverBatchSink
from visitflow.sources import messages
from visitflow.sources.tables import MissingInputError
from visitflow.streaming import seen
from visitflow.streaming import silver as streams

log = logging.getLogger(__name__)


def _env(name: str, default: str | None = None) -> str | None:
    value = os.environ.get(name)
    return value if value not in (None, "") else default


@dataclass
class JobConfig:
    # The defaults below (broker, topic, 10 s trigger, 200 messages per
    # trigger) are those of the pipeline this replaces, so existing setups keep working.
    kafka_bootstrap_servers: str = field(default_factory=lambda: _env("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"))
    kafka_topic: str = field(default_factory=lambda: _env("KAFKA_TOPIC", "test_Topic"))
    silver_path: str | None = field(default_factory=lambda: _env("SILVER_OUTPUT_PATH"))
    checkpoint_path: str | None = field(default_factory=lambda: _env("CHECKPOINT_PATH"))
    trigger_interval: str = field(default_factory=lambda: _env("TRIGGER_INTERVAL", "10 seconds"))
    max_offsets_per_trigger: int = field(
        default_factory=lambda: int(_env("MAX_OFFSETS_PER_TRIGGER", "200"))
    )
    max_files_per_trigger: int = field(
        default_factory=lambda: int(_env("MAX_FILES_PER_TRIGGER", "1"))
    )
    gold_path: str | None = field(default_factory=lambda: _env("GOLD_OUTPUT_PATH"))
    source: str = field(default_factory=lambda: _env("SILVER_SOURCE", "kafka"))
    input_path: str | None = field(default_factory=lambda: _env("SILVER_INPUT_PATH"))
    silver_format: str = field(default_factory=lambda: _env("SILVER_FORMAT", "parquet"))
    salt_buckets: int | None = field(
        default_factory=lambda: int(_env("DEDUPE_SALT_BUCKETS", "0")) or None
    )
    kafka_min_partitions: int | None = field(
        default_factory=lambda: int(_env("KAFKA_MIN_PARTITIONS", "0")) or None
    )
    bounded_delay: str | None = field(default_factory=lambda: _env("DEDUPE_WATERMARK_DELAY"))
    gold_checkpoint_path: str | None = field(default_factory=lambda: _env("GOLD_CHECKPOINT_PATH"))
    gold_trigger_interval: str = field(
        default_factory=lambda: _env("GOLD_TRIGGER_INTERVAL", "1 minute")
    )
    report_path: str | None = field(default_factory=lambda: _env("REPORT_OUTPUT_PATH"))
    files_per_batch: int | None = field(
        default_factory=lambda: int(_env("SILVER_FILES_PER_BATCH", "0")) or None
    )
    index_path: str | None = field(default_factory=lambda: _env("SILVER_INDEX_PATH"))
    rejects_path: str | None = field(default_factory=lambda: _env("REJECTS_OUTPUT_PATH"))
    late_path: str | None = field(default_factory=lambda: _env("LATE_OUTPUT_PATH"))
    horizon_days: int | None = field(default_factory=lambda: int(_env("DEDUPE_HORIZON_DAYS", "0")) or None)
    gold_store_path: str | None = field(default_factory=lambda: _env("GOLD_STORE_PATH"))
    gold_versioned: bool = field(default_factory=lambda: _env("GOLD_VERSIONED", "0") == "1")
    rocksdb_state: bool = True

    def require(self, *names: str) -> None:
        missing = [n for n in names if not getattr(self, n)]
        if missing:
            raise ValueError(f"missing job settings: {', '.join(missing)}")


def _messages(spark: SparkSession, cfg: JobConfig) -> tuple[DataFrame, object]:
    if cfg.source == "kafka":
        stream = messages.kafka_stream(
            spark,
            bootstrap_servers=cfg.kafka_bootstrap_servers,
            topic=cfg.kafka_topic,
            max_offsets_per_trigger=cfg.max_offsets_per_trigger,
            min_partitions=cfg.kafka_min_partitions,
        )
        return stream, messages.decode_kafka
    if cfg.source == "files":
        cfg.require("input_path")
        stream = messages.replay_stream(spark, cfg.input_path, cfg.max_files_per_trigger)
        return stream, messages.decode_envelope
    raise ValueError(f"unknown silver source {cfg.source!r}")


def _indexed_sink(cfg: JobConfig) -> seen.IndexedSilverSink:
    cfg.require("silver_path", "index_path")
    root = cfg.index_path.rstrip("/")
    return seen.IndexedSilverSink(
        SilverBatchSink(cfg.silver_path, fmt=cfg.silver_format, files=cfg.files_per_batch),
        seen.SeenIds(root, cfg.horizon_days),
        cfg.rejects_path or f"{root}/rejects",
        cfg.late_path or f"{root}/late",
    )


def silver_job(
    spark: SparkSession, cfg: JobConfig | None = None, trigger: dict | None = None, wait: bool = True
):
    """Start the silver stream; with ``wait`` block until it stops (or fails).

    With ``SILVER_INDEX_PATH`` ids are remembered in an index instead of streaming state, and rejected
    and late rows are kept.
    """
    cfg = cfg or JobConfig()
    cfg.require("silver_path", "checkpoint_path")
    stream, decode_fn = _messages(spark, cfg)
    trigger = trigger or {"processingTime": cfg.trigger_interval}
    if cfg.index_path:
        query = seen.start_indexed_silver(stream, _indexed_sink(cfg), cfg.checkpoint_path, trigger, decode_fn)
    else:
        if cfg.rocksdb_state:
            streams.use_rocksdb_state(spark)
        query = streams.start_silver(
            stream,
            SilverBatchSink(cfg.silver_path, fmt=cfg.silver_format, files=cfg.files_per_batch),
            cfg.checkpoint_path,
            trigger=trigger,
            bounded_delay=cfg.bounded_delay,
            decode_fn=decode_fn,
            query_name="silver",
            salt_buckets=cfg.salt_buckets,
        )
    log.info("silver stream started: %s -> %s", cfg.source, cfg.silver_path)
    if wait:
        query.awaitTermination()
        exc = query.exception()
        if exc is not None:
            raise RuntimeError(f"silver stream failed: {exc}")
    return query


def gold_job(spark: SparkSession, cfg: JobConfig | None = None) -> dict[str, int]:
    """Rebuild the nine gold tables from silver; raises if silver is missing or empty."""
    cfg = cfg or JobConfig()
    cfg.require("silver_path", "gold_path")
    counts = run_gold(
        spark, cfg.silver_path, cfg.gold_path, silver_fmt=cfg.silver_format, versioned=cfg.gold_versioned
    )
    for name, n in counts.items():
        log.info("gold %s: %d rows", name, n)
    return counts


def gold_incremental_job(spark: SparkSession, cfg: JobConfig | None = None) -> dict[str, int]:
    """The same nine tables from stored sums and the silver batches that came since the last run."""
    cfg = cfg or JobConfig()
    cfg.require("silver_path", "gold_path")
    store = cfg.gold_store_path or f"{cfg.gold_path.rstrip('/')}/_store"
    counts = run_gold_incremental(spark, cfg.silver_path, store, cfg.gold_path, versioned=cfg.gold_versioned)
    log.info("gold: %s", counts or "no new silver batches")
    return counts


def repair_job(spark: SparkSession, cfg: JobConfig | None = None) -> int:
    """Merge the late rows that silver lacks; returns the late batches read."""
    cfg = cfg or JobConfig()
    sink = _indexed_sink(cfg)
    ledger = f"{cfg.index_path.rstrip('/')}/repairs"
    batches = seen.repair_late(spark, sink.silver, sink.rejects, sink.late, ledger)
    log.info("late rows: %d batches merged", batches)
    return batches


def gold_live_job(
    spark: SparkSession, cfg: JobConfig | None = None, trigger: dict | None = None, wait: bool = True
):
    """Keep the nine gold tables current from the silver table's new files.

    Same output layout as ``gold_job``, but each refresh reads only the silver
    files added since the last one; the running sums live in streaming state.
    """
    from visitflow.sources.tables import read_silver_stream

    cfg = cfg or JobConfig()
    cfg.require("silver_path", "gold_path", "gold_checkpoint_path")
    if cfg.rocksdb_state:  # the state holds every (doctor id, name) pair
        streams.use_rocksdb_state(spark)
    query = streams.start_gold_tables_stream(
        read_silver_stream(spark, cfg.silver_path, fmt=cfg.silver_format),
        cfg.gold_path,
        cfg.gold_checkpoint_path,
        trigger=trigger or {"processingTime": cfg.gold_trigger_interval},
    )
    if wait:
        query.awaitTermination()
    return query


def kpi_job(spark: SparkSession, cfg: JobConfig | None = None) -> DataFrame:
    """The KPI row from the written gold tables."""
    cfg = cfg or JobConfig()
    cfg.require("gold_path")
    return kpis_from_gold(spark, cfg.gold_path)


def _stop_streams_on_signal(spark: SparkSession) -> None:
    """On SIGTERM / SIGINT stop the running streams, so the job ends cleanly; the
    checkpoint keeps the last committed batch and a restart resumes from it."""
    import signal

    def stop(signum, _frame):
        log.warning("signal %d: stopping %d stream(s)", signum, len(spark.streams.active))
        for query in spark.streams.active:
            query.stop()

    for sig in (signal.SIGTERM, signal.SIGINT):
        signal.signal(sig, stop)


def report_job(spark: SparkSession, cfg: JobConfig | None = None) -> str:
    """Write the dashboard's data tables from the gold tables; returns their folder."""
    cfg = cfg or JobConfig()
    cfg.require("gold_path")
    root = cfg.report_path or f"{cfg.gold_path.rstrip('/')}/_report"
    write_report(spark, cfg.gold_path, root)
    log.info("report tables written to %s", root)
    return root


def main(argv: list[str] | None = None) -> int:
    import sys

    args = list(sys.argv[1:] if argv is None else argv)
    jobs = {
        "silver": silver_job,
        "gold": gold_job,
        "gold-incremental": gold_incremental_job,
        "gold-live": gold_live_job,
        "repair": repair_job,
        "report": report_job,
        "kpi": kpi_job,
    }
    if not args or args[0] not in jobs:
        print(f"usage: python -m visitflow {'|'.join(jobs)}", file=sys.stderr)
        return 2
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    spark = SparkSession.builder.appName(f"visitflow-{args[0]}").getOrCreate()
    _stop_streams_on_signal(spark)
    try:
        done = jobs[args[0]](spark)
        if args[0] == "kpi":
            for row in done.collect():  # one row
                print(row.asDict())
    except MissingInputError as exc:
        log.error("%s; run the silver job first, then retry", exc)
        return 1
    finally:
        spark.stop()
    return 0
