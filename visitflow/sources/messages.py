"""Bronze message sources: Kafka topics and replay files, plus JSON decode.

Decode is permissive (``from_json`` with a fixed schema): malformed text gives
a struct of nulls (dropped later by the id check), a wrong-typed field gives
null in that field only, extra fields are ignored, names are case-sensitive.

The Kafka connector is not bundled with Spark; these readers only assemble
options. Add ``org.apache.spark:spark-sql-kafka-0-10`` to the session to use
them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitflow.schema import BRONZE_SCHEMA, DELIVERY_SEQ, ENVELOPE_SCHEMA


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = 200,
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options of the topic subscription.

    ``min_partitions`` lets Spark split a large topic partition over several
    tasks, so one hot partition (a third of the traffic, say) does not become
    one straggler task per micro-batch.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    return opts


def from_kafka_rows(raw: DataFrame) -> DataFrame:
    """Kafka rows -> ``json_data`` (binary value cast to text), ``delivery_seq`` (offset),
    ``kafka_partition`` and ``kafka_timestamp``.

    Offsets order the messages of one topic partition only; ``KAFKA_ORDER`` orders
    those of a whole topic.
    """
    return raw.select(
        F.col("value").cast("string").alias("json_data"),
        F.col("offset").alias(DELIVERY_SEQ),
        F.col("partition").alias("kafka_partition"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


#: Arrival order over all partitions of a topic, for the batch dedupe's ``order_by``.
KAFKA_ORDER = ("kafka_timestamp", "kafka_partition", DELIVERY_SEQ)


def decode_kafka(messages: DataFrame, stamp: bool = True) -> DataFrame:
    """Decode Kafka messages and drop the envelope but for ``delivery_seq`` (for streams)."""
    return decode(messages, stamp=stamp).drop("kafka_partition", "kafka_timestamp")


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """Streaming Kafka scan, with the envelope reduced to ``json_data`` + arrival order.

    ``delivery_seq`` is the Kafka offset, which orders deliveries within one topic
    partition; across partitions a stream takes them as they arrive.
    """
    raw = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return from_kafka_rows(raw)


def kafka_batch(
    spark: SparkSession, bootstrap_servers: str, topic: str, starting_offsets: str = "earliest"
) -> DataFrame:
    """Batch read of a topic (e.g. for a backfill), same columns as ``kafka_stream``.

    Decode it and pass ``order_by=KAFKA_ORDER`` to ``operators.silver.clean``: the first
    delivery over all partitions then wins.
    """
    opts = kafka_options(bootstrap_servers, topic, starting_offsets, max_offsets_per_trigger=None)
    return from_kafka_rows(spark.read.format("kafka").options(**opts).load())


def replay_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """Streaming scan of replay files: one JSON message per line, oldest file first.

    ``max_files_per_trigger=None`` (or 0) takes all files that are there.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select(F.col("value").alias("json_data"))


def decode(
    messages: DataFrame,
    schema: StructType = BRONZE_SCHEMA,
    text_col: str = "json_data",
    stamp: bool = True,
) -> DataFrame:
    """JSON text -> flat bronze columns (+ ``event_time`` ingest stamp).

    Other columns of ``messages`` (e.g. ``delivery_seq`` from the envelope) are
    kept unless the decoded schema has a field of the same name.
    """
    decoded_names = {f.name for f in schema.fields}
    carried = [c for c in messages.columns if c != text_col and c not in decoded_names]
    names = schema.fieldNames()
    parsed = "__decoded"
    out = messages.select(*carried, F.from_json(F.col(text_col), schema).alias(parsed)).select(
        *[F.col(parsed)[c].alias(c) for c in names if c == DELIVERY_SEQ],
        *carried,
        *[F.col(parsed)[c].alias(c) for c in names if c != DELIVERY_SEQ],
    )
    if stamp:
        out = out.withColumn("event_time", F.current_timestamp())
    return out


def decode_envelope(messages: DataFrame, text_col: str = "json_data", stamp: bool = True) -> DataFrame:
    """Decode replay-file lines, which carry ``delivery_seq`` inside the JSON."""
    return decode(messages, ENVELOPE_SCHEMA, text_col=text_col, stamp=stamp)
