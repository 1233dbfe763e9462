"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query starts from the test-data ``events`` table (through the bronze
fixture recipe) and runs over all of it. Wall-clock stamps (``event_time``,
``processed_date``) are left out of returned frames so that results are
comparable across runs; the library functions still produce them.

Streaming queries replay the bronze rows as JSON files in two arrival waves
(first deliveries, then redeliveries), run ``availableNow`` with a checkpoint,
restart on the same checkpoint for the second wave, and return the table the
stream wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitflow.functions import rules
from visitflow.operators import gold, report, silver
from visitflow.plans.batch import run_gold, run_gold_incremental, write_gold_tables
from visitflow.schema import (
    BRONZE_COLUMNS,
    BRONZE_SCHEMA,
    DELIVERY_SEQ,
    GOLD_SCHEMAS,
    SILVER_STABLE_COLUMNS,
)
from visitflow.session import scratch_path
from visitflow.sinks.files import SilverBatchSink, encode, write_partitioned, write_replay_files
from visitflow.sources.fixture import REDELIVERY_OFFSET, kafka_rows, read_bronze, read_events
from visitflow.sources.messages import KAFKA_ORDER, decode, from_kafka_rows, replay_stream
from visitflow.sources.tables import read_gold, read_silver, read_silver_stream
from visitflow.streaming import seen, upsert
from visitflow.streaming import silver as streams

Query = Callable[[SparkSession, str], DataFrame]

# Replay settings of the streaming queries.
REPLAY_FILES_PER_TRIGGER = 16


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean(read_bronze(spark, sf_dir))


def _stable(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in SILVER_STABLE_COLUMNS if c in df.columns])


# ---------------------------------------------------------------- bronze


def bronze_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows as JSON message text (null fields left out) with their arrival order."""
    return encode(read_bronze(spark, sf_dir))


def bronze_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message bytes in Kafka's row layout decoded with the fixed bronze schema.

    Cut-off, empty, array and wrong-typed messages are among them.
    """
    messages = from_kafka_rows(kafka_rows(read_bronze(spark, sf_dir), malformed=True))
    return decode(messages, BRONZE_SCHEMA, stamp=False).select(DELIVERY_SEQ, *BRONZE_COLUMNS)


def _topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze messages as a backfill reads them from a topic: stored bytes with their envelope."""
    path = scratch_path(spark, "topic")
    kafka_rows(read_bronze(spark, sf_dir)).write.parquet(path)
    return from_kafka_rows(spark.read.parquet(path))


def kafka_rows_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from a two-partition topic; the earliest delivery over both wins."""
    bronze = decode(_topic(spark, sf_dir), stamp=False)
    cleaned = _stable(silver.clean(bronze, order_by=KAFKA_ORDER))
    return cleaned.drop(DELIVERY_SEQ)


# ---------------------------------------------------------------- silver rules


def silver_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First delivery per id, over all bronze rows (null and empty ids are groups)."""
    return silver.dedupe_first_delivery(read_bronze(spark, sf_dir))


def silver_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze rows that pass the range and required-string checks."""
    return silver.quality_filter(read_bronze(spark, sf_dir)).select(
        DELIVERY_SEQ, "id", "first_name", "age", "wbc", "hgb"
    )


def silver_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gender code -> label on every bronze row."""
    return read_bronze(spark, sf_dir).select(
        DELIVERY_SEQ, F.col("gender").alias("gender_raw"), rules.gender_label("gender").alias("gender")
    )


def silver_uppercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper-cased names and severity on every bronze row."""
    return read_bronze(spark, sf_dir).select(
        DELIVERY_SEQ, *[F.upper(F.col(c)).alias(c) for c in rules.UPPERCASE_COLUMNS]
    )


def silver_allergy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: allergy label on every bronze row (null stays null before defaults)."""
    return read_bronze(spark, sf_dir).select(
        DELIVERY_SEQ,
        F.col("allergy").alias("allergy_raw"),
        rules.allergy_label("allergy").alias("allergy"),
    )


def silver_age_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age band on every bronze row (a null age falls to the top band)."""
    return read_bronze(spark, sf_dir).select(DELIVERY_SEQ, "age", rules.age_band("age").alias("age_group"))


def silver_wbc_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White-cell class on every bronze row."""
    return read_bronze(spark, sf_dir).select(DELIVERY_SEQ, "wbc", rules.wbc_class("wbc").alias("wbc_status"))


def silver_hgb_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Haemoglobin class on every bronze row."""
    return read_bronze(spark, sf_dir).select(DELIVERY_SEQ, "hgb", rules.hgb_class("hgb").alias("hgb_status"))


def silver_severity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper-cased severity and its score on every bronze row."""
    upper = F.upper(F.col("severity"))
    return read_bronze(spark, sf_dir).select(
        DELIVERY_SEQ,
        F.col("severity").alias("severity_raw"),
        upper.alias("severity"),
        rules.severity_score(upper).alias("severity_score"),
    )


def silver_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full standardisation, null defaults included, on every bronze row."""
    return silver.standardise(read_bronze(spark, sf_dir)).select(
        DELIVERY_SEQ, *rules.DEFAULTED_COLUMNS
    )


def silver_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table (dedupe, validate, standardise), stamps left out."""
    return _stable(_silver(spark, sf_dir))


def silver_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: number of silver rows."""
    return _silver(spark, sf_dir).agg(F.count(F.lit(1)).alias("silver_rows"))


def silver_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest and processing stamps are on every silver row."""
    bronze = decode(_topic(spark, sf_dir))
    return silver.clean(bronze, order_by=KAFKA_ORDER).agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.count("event_time").alias("event_times"),
        F.count("processed_date").alias("processed_dates"),
    )


def silver_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write silver as JSON partitioned by age band, read it back with the schema."""
    path = scratch_path(spark, "silver-json")
    write_partitioned(_silver(spark, sf_dir), path, fmt="json", mode="overwrite")
    return _stable(read_silver(spark, path, fmt="json"))


# ---------------------------------------------------------------- gold


_GOLD_IDS = {
    "severity_summary": "A1",
    "age_group_summary": "A2",
    "gender_summary": "A3",
    "wbc_summary": "A4",
    "hgb_summary": "A5",
    "daily_trends": "A6, P12",
    "top_doctors": "A7, O4",
    "diagnosis_summary": "A8, O4",
    "allergy_summary": "A9",
}


def _gold(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold.BUILDERS[name](_silver(spark, sf_dir))

    run.__name__ = f"gold_{name}"
    run.__doc__ = f"{_GOLD_IDS[name]}: the {name} gold table, one aggregate over silver."
    return run


def gold_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine tables stacked, cut from one GROUPING SETS aggregate over one silver scan.

    The aggregate is stored once, by table; without that, each branch of the
    stacked result (one projection plus two top-k) would prune it differently
    and recompute silver per branch.
    """
    path = scratch_path(spark, "gold-aggregate")
    return gold.stacked(gold.store_aggregate(gold.aggregate_all(_silver(spark, sf_dir)), path))


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the nine tables as single JSON files, load them back, stack them."""
    root = scratch_path(spark, "gold-json")
    write_gold_tables(_silver(spark, sf_dir), root)
    return gold.stack(read_gold(spark, root))


def gold_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1-O3: position of every row in the written gold tables, as their files hold them."""
    root = scratch_path(spark, "gold-order")
    write_gold_tables(_silver(spark, sf_dir), root)
    out = None
    for name, df in read_gold(spark, root).items():
        at = Window.partitionBy("table_name").orderBy("file", "line")
        rows = df.select(
            F.lit(name).alias("table_name"),
            F.col("_metadata.file_name").alias("file"),
            F.monotonically_increasing_id().alias("line"),
            F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in gold.GRAINS[name]]).alias("row_key"),
        )
        rows = rows.select("table_name", F.row_number().over(at).alias("position"), "row_key")
        out = rows if out is None else out.unionByName(rows)
    return out


def gold_without_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver files without ``timestamp`` give every gold table but the daily one."""
    path, root = scratch_path(spark, "silver-untimed"), scratch_path(spark, "gold-untimed")
    write_partitioned(_silver(spark, sf_dir).drop("timestamp"), path)
    run_gold(spark, path, root)
    return gold.stack(read_gold(spark, root))


# ---------------------------------------------------------------- report


def chart_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of the dashboard's six charts."""
    s = _silver(spark, sf_dir)
    return report.chart_series({name: build(s) for name, build in gold.BUILDERS.items()})


def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI row from silver in one scan (same values as from the two gold tables)."""
    return report.kpi_from_silver(_silver(spark, sf_dir))


def gender_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each gender's share of all patients."""
    return report.gender_share(gold.gender_summary(_silver(spark, sf_dir)))


def severity_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean severity score per band against the reference line at 2."""
    return report.severity_risk(gold.age_group_summary(_silver(spark, sf_dir)))


def top_doctors_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top doctors with display labels as column names."""
    return report.labelled(gold.top_doctors(_silver(spark, sf_dir)))


def age_group_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age-group table restricted to its count and score columns."""
    return report.numeric_view(gold.age_group_summary(_silver(spark, sf_dir)))


# ---------------------------------------------------------------- streaming


def _replay_waves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    bronze = read_bronze(spark, sf_dir)
    first = bronze.filter(F.col(DELIVERY_SEQ) < REDELIVERY_OFFSET)
    again = bronze.filter(F.col(DELIVERY_SEQ) >= REDELIVERY_OFFSET)
    return [first, again]


def _run_waves(
    spark: SparkSession,
    sf_dir: str,
    label: str,
    start: Callable[[DataFrame, str], object],
) -> None:
    """Feed the replay waves one after another through a restartable stream."""
    inbox = scratch_path(spark, f"{label}-inbox")
    checkpoint = scratch_path(spark, f"{label}-checkpoint")
    for wave in _replay_waves(spark, sf_dir):
        write_replay_files(wave, inbox)
        messages = replay_stream(spark, inbox, max_files_per_trigger=REPLAY_FILES_PER_TRIGGER)
        streams.run_to_end(start(messages, checkpoint))


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from a checkpointed, restarted stream of replay files."""
    out = scratch_path(spark, "stream-silver")
    sink = SilverBatchSink(out)
    _run_waves(
        spark,
        sf_dir,
        "stream-silver",
        lambda messages, ckpt: streams.start_silver(
            messages, sink, ckpt, trigger={"availableNow": True}
        ),
    )
    return _stable(read_silver(spark, out))


def stream_silver_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with the watermark-bounded dedupe; rows without a time are kept beside it.

    The replay's files are not in time order, so the delay is the table's whole span.
    """
    span = read_events(spark, sf_dir).agg(F.datediff(F.max("ts"), F.min("ts"))).first()[0] or 0
    out = scratch_path(spark, "stream-silver-bounded")
    sink = SilverBatchSink(out)
    _run_waves(
        spark,
        sf_dir,
        "stream-silver-bounded",
        lambda messages, ckpt: streams.start_silver(
            messages,
            sink,
            ckpt,
            trigger={"availableNow": True},
            bounded_delay=f"{span + 2} days",
        ),
    )
    return _stable(read_silver(spark, out))


def stream_gold_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity table kept by a streaming aggregate in complete mode."""
    out = scratch_path(spark, "stream-gold-severity")
    _run_waves(
        spark,
        sf_dir,
        "stream-gold-severity",
        lambda messages, ckpt: streams.start_live_gold(
            streams.silver_stream(messages),
            streams.live_severity,
            out,
            ckpt,
            trigger={"availableNow": True},
        ),
    )
    return spark.read.schema(GOLD_SCHEMAS["severity_summary"]).parquet(out)


def stream_gold_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine gold tables maintained by one streaming GROUPING SETS aggregate."""
    out = scratch_path(spark, "stream-gold-all")
    _run_waves(
        spark,
        sf_dir,
        "stream-gold-all",
        lambda messages, ckpt: streams.start_live_gold_all(
            streams.silver_stream(messages), out, ckpt, trigger={"availableNow": True}
        ),
    )
    return gold.stacked(spark.read.parquet(out))


def stream_gold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental gold: the nine JSON tables kept from the silver table's new files.

    Silver is computed once and fed to the micro-batch sink in two batches that
    together hold every row (patients under 50, then the rest; silver has no null
    age); after each, the gold stream reads only the new files.
    """
    return _live_gold(spark, sf_dir, "stream-gold-tables", replay=False)


def stream_gold_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with every batch delivered again, as after a failure before its commit."""
    return _live_gold(spark, sf_dir, "stream-gold-replay", replay=True)


def _live_gold(spark: SparkSession, sf_dir: str, label: str, replay: bool) -> DataFrame:
    whole, silver_root, gold_root, checkpoint = (
        scratch_path(spark, f"{label}-{part}") for part in ("whole", "silver", "gold", "checkpoint")
    )
    _silver(spark, sf_dir).write.parquet(whole)
    s = spark.read.parquet(whole)
    sink = SilverBatchSink(silver_root)
    for batch_id, part in enumerate([s.filter(F.col("age") < 50), s.filter(F.col("age") >= 50)]):
        for _ in range(2 if replay else 1):
            sink(part, batch_id)
            stream = read_silver_stream(spark, silver_root)
            streams.run_to_end(
                streams.start_gold_tables_stream(stream, gold_root, checkpoint, trigger={"availableNow": True})
            )
    return gold.stack(read_gold(spark, gold_root))


def stream_daily_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily table kept by a streaming aggregate with per-day upserts."""
    out = scratch_path(spark, "stream-daily-trends")
    _run_waves(
        spark,
        sf_dir,
        "stream-daily-trends",
        lambda messages, ckpt: streams.start_daily_trends(
            streams.silver_stream(messages),
            out,
            ckpt,
            trigger={"availableNow": True},
        ),
    )
    schema = GOLD_SCHEMAS["daily_trends"]
    return spark.read.schema(schema).parquet(out).select(*schema.fieldNames())


def stream_daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table by event-time windows, closed days out of the state, undated rows beside them.

    Silver comes in two batches; the delay is the table's whole span, as batches aren't in time order.
    """
    span = read_events(spark, sf_dir).agg(F.datediff(F.max("ts"), F.min("ts"))).first()[0] or 0
    root, whole = scratch_path(spark, "stream-windows"), scratch_path(spark, "stream-windows-whole")
    _silver(spark, sf_dir).write.parquet(whole)
    s, sink = spark.read.parquet(whole), SilverBatchSink(f"{root}/silver")
    for batch_id, part in enumerate([s.filter(F.col("age") < 50), s.filter(F.col("age") >= 50)]):
        sink(part, batch_id)
        stream = read_silver_stream(spark, f"{root}/silver")
        for query in streams.start_daily_windows(
            stream, f"{root}/daily", f"{root}/checkpoint", f"{span + 2} days", trigger={"availableNow": True}
        ):
            streams.run_to_end(query)
    return streams.read_daily_windows(spark, f"{root}/daily")


def stream_gold_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine tables kept in update mode; a trigger rewrites the buckets it changed."""
    out = scratch_path(spark, "stream-gold-upsert")
    _run_waves(
        spark,
        sf_dir,
        "stream-gold-upsert",
        lambda messages, ckpt: upsert.start_gold_upsert(
            streams.silver_stream(messages), out, ckpt, trigger={"availableNow": True}, buckets=16
        ),
    )
    return gold.stacked(upsert.read_store(spark, out))


def stream_gold_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7, A8, O4 on a stream: the two top-10 tables from the old ten and the groups that changed."""
    out = scratch_path(spark, "stream-gold-top")
    _run_waves(
        spark,
        sf_dir,
        "stream-gold-top",
        lambda messages, ckpt: upsert.start_top(
            streams.silver_stream(messages), out, ckpt, trigger={"availableNow": True}
        ),
    )
    return gold.stack(upsert.read_top(spark, out))


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine tables from stored sums, to which each gold run adds the new silver batches.

    Silver comes in two batches that together hold every row; a gold run follows each.
    """
    whole, silver_root, store, gold_root = (
        scratch_path(spark, f"gold-incremental-{part}") for part in ("whole", "silver", "store", "gold")
    )
    _silver(spark, sf_dir).write.parquet(whole)
    s = spark.read.parquet(whole)
    sink = SilverBatchSink(silver_root)
    for batch_id, part in enumerate([s.filter(F.col("age") < 50), s.filter(F.col("age") >= 50)]):
        sink(part, batch_id)
        run_gold_incremental(spark, silver_root, store, gold_root, buckets=16)
    return gold.stack(read_gold(spark, gold_root))


def gold_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine tables published as one version, twice; readers follow to the second."""
    root, whole = scratch_path(spark, "gold-versioned"), scratch_path(spark, "gold-versioned-silver")
    _silver(spark, sf_dir).write.parquet(whole)
    s = spark.read.parquet(whole)
    for part in (s.filter(F.col("age") < 50), s):
        write_gold_tables(part, root, versioned=True)
    return gold.stack(read_gold(spark, root))


def stream_state_to_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose ids are in a state store goes on with the id index; no id passes twice."""
    root = scratch_path(spark, "stream-seeded")
    sink = SilverBatchSink(f"{root}/silver")
    first, again = _replay_waves(spark, sf_dir)
    write_replay_files(first, f"{root}/inbox")
    messages = replay_stream(spark, f"{root}/inbox", max_files_per_trigger=REPLAY_FILES_PER_TRIGGER)
    streams.run_to_end(streams.start_silver(messages, sink, f"{root}/old", trigger={"availableNow": True}))
    index = seen.SeenIds(f"{root}/index")
    seen.seed_from_state(spark, f"{root}/old", index)
    write_replay_files(again, f"{root}/inbox")
    indexed = seen.IndexedSilverSink(sink, index, f"{root}/rejects", f"{root}/late")
    messages = replay_stream(spark, f"{root}/inbox", max_files_per_trigger=REPLAY_FILES_PER_TRIGGER)
    streams.run_to_end(seen.start_indexed_silver(messages, indexed, f"{root}/new", trigger={"availableNow": True}))
    return _stable(read_silver(spark, f"{root}/silver"))


def _indexed(spark: SparkSession, sf_dir: str, label: str, horizon: int | None) -> tuple[seen.IndexedSilverSink, str]:
    """Replay both waves through the indexed sink; the sink and the folder of its tables."""
    root = scratch_path(spark, label)
    sink = seen.IndexedSilverSink(
        SilverBatchSink(f"{root}/silver"), seen.SeenIds(f"{root}/index", horizon), f"{root}/rejects", f"{root}/late"
    )
    _run_waves(
        spark,
        sf_dir,
        label,
        lambda messages, ckpt: seen.start_indexed_silver(messages, sink, ckpt, trigger={"availableNow": True}),
    )
    return sink, root


def stream_silver_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedupe for ever from an id index on disk; the query has no streaming state."""
    _, root = _indexed(spark, sf_dir, "stream-indexed", None)
    return _stable(read_silver(spark, f"{root}/silver"))


def stream_silver_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedupe bounded by a horizon, in one index and one scan, also for records without a clock."""
    span = read_events(spark, sf_dir).agg(F.datediff(F.max("ts"), F.min("ts"))).first()[0] or 0
    _, root = _indexed(spark, sf_dir, "stream-horizon", span + 2)
    return _stable(read_silver(spark, f"{root}/silver"))


def stream_late_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A horizon of one day sends most of the replay to the late rows; the repair merges them."""
    sink, root = _indexed(spark, sf_dir, "stream-late", 1)
    seen.repair_late(spark, sink.silver, sink.rejects, sink.late, f"{root}/ledger")
    return _stable(read_silver(spark, f"{root}/silver"))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, F2, Q3: the rejected first deliveries with their reasons."""
    _, root = _indexed(spark, sf_dir, "stream-rejects", None)
    rows = seen.read_rejects(spark, f"{root}/rejects")
    return rows.select(DELIVERY_SEQ, "id", F.array_join("reasons", ",").alias("reasons"))


def stream_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by verdict and rejected ones by reason, from the passes that wrote them."""
    sink, _ = _indexed(spark, sf_dir, "stream-verdicts", None)
    total: dict[str, int] = {}
    for counts in sink.counts.values():
        for kind, found in (("verdict", counts.verdicts), ("reason", counts.reasons)):
            for name, n in found.items():
                total[f"{kind}:{name}"] = total.get(f"{kind}:{name}", 0) + n
    rows = [(name, n) for name, n in sorted(total.items())]
    return spark.createDataFrame(rows, "what string, messages long")


QUERIES: dict[str, Query] = {
    "bronze_encode": bronze_encode,
    "bronze_decode": bronze_decode,
    "kafka_rows_dedupe": kafka_rows_dedupe,
    "silver_dedupe": silver_dedupe,
    "silver_quality_filter": silver_quality_filter,
    "silver_gender": silver_gender,
    "silver_uppercase": silver_uppercase,
    "silver_allergy": silver_allergy,
    "silver_age_group": silver_age_group,
    "silver_wbc_status": silver_wbc_status,
    "silver_hgb_status": silver_hgb_status,
    "silver_severity_score": silver_severity_score,
    "silver_defaults": silver_defaults,
    "silver_visits": silver_visits,
    "silver_row_count": silver_row_count,
    "silver_stamps": silver_stamps,
    "silver_partitioned_roundtrip": silver_partitioned_roundtrip,
    **{f"gold_{name}": _gold(name) for name in gold.BUILDERS},
    "gold_one_pass": gold_one_pass,
    "gold_roundtrip": gold_roundtrip,
    "gold_order": gold_order,
    "gold_without_timestamp": gold_without_timestamp,
    "chart_series": chart_series,
    "kpi_summary": kpi_summary,
    "gender_share": gender_share,
    "severity_risk": severity_risk,
    "top_doctors_labelled": top_doctors_labelled,
    "age_group_numeric": age_group_numeric,
    "stream_silver": stream_silver,
    "stream_silver_bounded": stream_silver_bounded,
    "stream_gold_severity": stream_gold_severity,
    "stream_gold_all": stream_gold_all,
    "stream_gold_tables": stream_gold_tables,
    "stream_gold_replay": stream_gold_replay,
    "stream_daily_trends": stream_daily_trends,
    "stream_gold_upsert": stream_gold_upsert,
    "stream_gold_top": stream_gold_top,
    "gold_incremental": gold_incremental,
    "stream_silver_indexed": stream_silver_indexed,
    "stream_silver_horizon": stream_silver_horizon,
    "stream_late_repair": stream_late_repair,
    "stream_rejects": stream_rejects,
    "stream_verdicts": stream_verdicts,
    "stream_daily_windows": stream_daily_windows,
    "gold_versioned": gold_versioned,
    "stream_state_to_index": stream_state_to_index,
}
