"""Schemas of every layer: bronze message, silver table, gold tables.

Bronze is a fixed 19-field flat record. Silver appends the ingest stamp and
six derived columns. Readers use these schemas explicitly so that a re-read
keeps ints as ints and timestamps as timestamps (an inferred JSON read turns
ints into longs and timestamps into strings, and drops all-null columns).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The bronze message layout, in message order.
BRONZE_FIELDS: list[tuple[str, object]] = [
    ("id", StringType()),
    ("timestamp", StringType()),
    ("first_name", StringType()),
    ("last_name", StringType()),
    ("dob", StringType()),
    ("age", IntegerType()),
    ("gender", StringType()),
    ("phone", StringType()),
    ("address", StringType()),
    ("doctor_id", IntegerType()),
    ("doctor_name", StringType()),
    ("ward", IntegerType()),
    ("room", IntegerType()),
    ("wbc", DoubleType()),
    ("hgb", DoubleType()),
    ("allergy", StringType()),
    ("severity", StringType()),
    ("diagnosis_code", StringType()),
    ("diagnosis_desc", StringType()),
]

BRONZE_COLUMNS = [name for name, _ in BRONZE_FIELDS]

BRONZE_SCHEMA = StructType([StructField(n, t, True) for n, t in BRONZE_FIELDS])

# Arrival order of a message (Kafka partition/offset, or file position). It is
# not part of the message; it rides next to it so that a batch dedupe can keep
# the first delivery deterministically.
DELIVERY_SEQ = "delivery_seq"

# Bronze message plus its arrival order: the layout of replay files.
ENVELOPE_SCHEMA = StructType(
    [StructField(DELIVERY_SEQ, LongType(), True), *BRONZE_SCHEMA.fields]
)

# Columns that silver appends, in the order they are added.
SILVER_DERIVED_FIELDS: list[tuple[str, object]] = [
    ("age_group", StringType()),
    ("wbc_status", StringType()),
    ("hgb_status", StringType()),
    ("severity_score", IntegerType()),
    ("processed_date", TimestampType()),
    ("data_quality_status", StringType()),
]

# Ingest stamps: wall-clock values, never compared across runs.
STAMP_COLUMNS = ["event_time", "processed_date"]

SILVER_SCHEMA = StructType(
    [
        *ENVELOPE_SCHEMA.fields,
        StructField("event_time", TimestampType(), True),
        *[StructField(n, t, True) for n, t in SILVER_DERIVED_FIELDS],
    ]
)

SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]

# Silver without the wall-clock stamps: the deterministic part of the table.
SILVER_STABLE_COLUMNS = [c for c in SILVER_COLUMNS if c not in STAMP_COLUMNS]

GOLD_SCHEMAS: dict[str, StructType] = {
    "severity_summary": StructType(
        [
            StructField("severity", StringType()),
            StructField("patient_count", LongType()),
            StructField("avg_age", DoubleType()),
            StructField("avg_wbc", DoubleType()),
            StructField("avg_hgb", DoubleType()),
        ]
    ),
    "age_group_summary": StructType(
        [
            StructField("age_group", StringType()),
            StructField("patient_count", LongType()),
            StructField("avg_severity_score", DoubleType()),
            StructField("avg_wbc", DoubleType()),
            StructField("avg_hgb", DoubleType()),
        ]
    ),
    "gender_summary": StructType(
        [StructField("gender", StringType()), StructField("patient_count", LongType())]
    ),
    "wbc_summary": StructType(
        [
            StructField("wbc_status", StringType()),
            StructField("patient_count", LongType()),
            StructField("avg_age", DoubleType()),
        ]
    ),
    "hgb_summary": StructType(
        [StructField("hgb_status", StringType()), StructField("patient_count", LongType())]
    ),
    "daily_trends": StructType(
        [
            StructField("date", DateType()),
            StructField("patient_per_day", LongType()),
            StructField("avg_age", DoubleType()),
            StructField("severe_cases", LongType()),
        ]
    ),
    "top_doctors": StructType(
        [
            StructField("doctor_id", IntegerType()),
            StructField("doctor_name", StringType()),
            StructField("patients_treated", LongType()),
        ]
    ),
    "diagnosis_summary": StructType(
        [
            StructField("diagnosis_code", StringType()),
            StructField("diagnosis_desc", StringType()),
            StructField("patient_count", LongType()),
        ]
    ),
    "allergy_summary": StructType(
        [StructField("allergy", StringType()), StructField("patient_count", LongType())]
    ),
}

GOLD_TABLES = list(GOLD_SCHEMAS)
