"""Bronze visit records derived from the ``events`` table (recipe of FIXTURES.md).

Every event becomes one visit message; every twentieth event is delivered a
second time (a redelivery, later in arrival order). The recipe plants dirty
values with plain integer arithmetic on the event id, so Spark and DuckDB build
the same rows. The recipe is input generation, not a row filter: every event
contributes, and the work grows with the table.

Spark reads ``events`` once: the redelivery is an ``explode`` of a one- or
two-element array, not a second scan plus ``union``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.schema import DELIVERY_SEQ

# The fixture recipe, one SQL expression per bronze column, in
# column order. Inputs: k = event id, u = user id, d = event date,
# redelivered = whether this row is the second delivery.
RECIPE_COLUMNS: list[tuple[str, str]] = [
    (DELIVERY_SEQ, "CASE WHEN redelivered THEN k + 1000000000 ELSE k END"),
    ("id", "CASE WHEN k % 107 = 0 THEN NULL WHEN k % 109 = 0 THEN '' ELSE 'v' || CAST(k AS STRING) END"),
    ("timestamp", "CASE WHEN k % 113 = 0 THEN NULL WHEN k % 127 = 0 THEN 'not a date' WHEN k % 131 = 0 THEN CAST(d AS STRING) || 'T25:99' ELSE CAST(d AS STRING) || 'T08:00:00.000001' END"),
    ("first_name", "CASE WHEN k % 97 = 0 THEN '' WHEN k % 89 = 0 THEN NULL ELSE 'First' || CAST(u % 50 AS STRING) END"),
    ("last_name", "CASE WHEN k % 17 = 0 THEN NULL ELSE 'Last' || CAST(k % 31 AS STRING) END"),
    ("dob", "'1980-01-01'"),
    ("age", "CAST(CASE WHEN redelivered THEN 40 WHEN k % 101 = 0 THEN NULL ELSE k * 7 % 125 - 2 END AS INT)"),
    ("gender", "CASE WHEN k % 11 = 0 THEN 'X' WHEN k % 11 = 1 THEN NULL WHEN k % 2 = 0 THEN 'M' ELSE 'F' END"),
    ("phone", "'555-' || CAST(k AS STRING)"),
    ("address", "'Street ' || CAST(k % 100 AS STRING)"),
    ("doctor_id", "CAST(1000 + u % 40 AS INT)"),
    ("doctor_name", "'Dr. Name' || CAST((u + k) % 7 AS STRING)"),
    ("ward", "CAST(1 + k % 20 AS INT)"),
    ("room", "CAST(1 + k % 30 AS INT)"),
    ("wbc", "CASE WHEN redelivered THEN CAST(5 AS DOUBLE) WHEN k % 103 = 0 THEN NULL ELSE CAST(k * 37 % 340 AS DOUBLE) / 10 END"),
    ("hgb", "CASE WHEN redelivered THEN CAST(13 AS DOUBLE) ELSE CAST(40 + k * 53 % 230 AS DOUBLE) / 10 END"),
    ("allergy", "CASE k % 7 WHEN 0 THEN 'Penicillin' WHEN 1 THEN 'Latex' WHEN 2 THEN 'Peanuts' WHEN 3 THEN 'None' WHEN 4 THEN NULL WHEN 5 THEN 'Latex' ELSE 'none' END"),
    ("severity", "CASE WHEN k * 7 % 125 - 2 >= 70 AND k % 4 <> 0 THEN 'Severe' ELSE CASE (k + u) % 6 WHEN 0 THEN 'Mild' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'Severe' WHEN 3 THEN 'severe' WHEN 4 THEN NULL ELSE 'Critical' END END"),
    ("diagnosis_code", "CASE k % 13 WHEN 0 THEN 'E11.9' WHEN 1 THEN 'I10' WHEN 2 THEN 'J45.9' WHEN 3 THEN 'J18.9' WHEN 4 THEN 'I21.9' WHEN 5 THEN 'N18.3' WHEN 6 THEN 'F32.9' WHEN 7 THEN 'M54.5' WHEN 8 THEN 'K29.7' WHEN 9 THEN 'Z87.891' WHEN 10 THEN 'I10' WHEN 11 THEN 'E11.9' ELSE NULL END"),
    ("diagnosis_desc", "CASE WHEN k % 13 = 12 THEN NULL ELSE 'Desc ' || CAST(CASE WHEN k % 13 = 10 THEN 1 WHEN k % 13 = 11 THEN 12 ELSE k % 13 END AS STRING) END"),
]

# Fixed value: one event in this many is delivered twice.
REDELIVERY_EVERY = 20
# Fixed value: a redelivery's delivery_seq is its event id plus this offset
# (the ``k + 1000000000`` of the recipe), so it arrives after every first delivery.
REDELIVERY_OFFSET = 1_000_000_000


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Bronze rows (message fields plus ``delivery_seq``) from an events frame."""
    src = events.select(
        F.col("event_id").alias("k"),
        F.col("user_id").alias("u"),
        F.col("ts").cast("date").alias("d"),
        F.explode(
            F.when(
                F.col("event_id") % REDELIVERY_EVERY == 0,
                F.array(F.lit(False), F.lit(True)),
            ).otherwise(F.array(F.lit(False)))
        ).alias("redelivered"),
    )
    return src.select(*[F.expr(sql).alias(name) for name, sql in RECIPE_COLUMNS])


# Messages that don't decode, by arrival order modulo MALFORMED_EVERY.
MALFORMED_EVERY = 211
MALFORMED = {
    5: '{"id":"v',
    6: "",
    7: "[1, 2]",
    8: '{"id":7,"age":"old","wbc":[1],"first_name":"Ann"}',
}


def kafka_rows(bronze: DataFrame, malformed: bool = False) -> DataFrame:
    """Bronze rows in the row layout of a Kafka read, in two topic partitions.

    A redelivery comes later, on the other partition and with a smaller offset.
    ``malformed`` replaces some values, and then all rows are one partition whose
    offsets are ``delivery_seq``.
    """
    seq = F.col(DELIVERY_SEQ)
    text = F.to_json(F.struct(*[c for c in bronze.columns if c != DELIVERY_SEQ]))
    if malformed:
        partition, offset = F.lit(0), seq
        for at, value in MALFORMED.items():
            text = F.when(seq % MALFORMED_EVERY == at, F.lit(value)).otherwise(text)
    else:
        again = seq >= REDELIVERY_OFFSET
        key = F.when(again, seq - REDELIVERY_OFFSET).otherwise(seq)
        partition = F.when(again, 1 - key % 2).otherwise(key % 2)
        offset = F.when(again, F.floor(key / REDELIVERY_EVERY)).otherwise(REDELIVERY_OFFSET + F.floor(key / 2))
    return bronze.select(
        F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit("visits").alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        F.timestamp_seconds(F.lit(1_700_000_000) + seq).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def read_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze visit records for a test-data directory."""
    return bronze_from_events(read_events(spark, sf_dir))


def bronze_sql(events_table: str = "events") -> str:
    """The same recipe as one SQL text (DuckDB dialect), for the oracle."""
    cols = ",\n  ".join(f"{sql} AS {name}" for name, sql in RECIPE_COLUMNS)
    return (
        "WITH src AS (\n"
        f"  SELECT event_id AS k, user_id AS u, CAST(ts AS DATE) AS d, FALSE AS redelivered FROM {events_table}\n"
        "  UNION ALL\n"
        f"  SELECT event_id AS k, user_id AS u, CAST(ts AS DATE) AS d, TRUE AS redelivered FROM {events_table} "
        f"WHERE event_id % {REDELIVERY_EVERY} = 0\n"
        ")\n"
        f"SELECT\n  {cols}\nFROM src"
    )
