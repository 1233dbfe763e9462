"""JSON decode: permissive, per-field nulls, case-sensitive names, junk -> nulls."""

from __future__ import annotations

import math

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from visitflow.sources.messages import decode

SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("age", IntegerType()),
        StructField("wbc", DoubleType()),
    ]
)

CASES = [
    ('{"id":"a","age":30,"wbc":7}', ("a", 30, 7.0)),
    ('{"id":"b","age":"45","wbc":7.5}', ("b", None, 7.5)),
    ('{"id":"c","age":45.5,"wbc":7.5}', ("c", None, 7.5)),
    ('{"id":"e","age":3000000000,"wbc":1}', ("e", None, 1.0)),
    ('{"id":"d2","age":45.0,"wbc":2}', ("d2", None, 2.0)),
    ('[{"id":"g","age":1,"wbc":1}]', (None, None, None)),
    ('{"id":7,"age":20,"wbc":1,"extra":1}', ("7", 20, 1.0)),
    ('{"id":"f","age":20,"wbc":"x"}', ("f", 20, None)),
    ('{"ID":"i","age":22}', (None, 22, None)),
    ('{"id":"h","age":22', (None, None, None)),
    ("not json", (None, None, None)),
    ("", (None, None, None)),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_decode_case(spark, text, expected):
    df = spark.createDataFrame([(text,)], "json_data string")
    row = decode(df, SCHEMA, stamp=False).collect()[0]
    assert tuple(row) == expected


def test_nan_text_decodes_to_nan_and_is_dropped(spark):
    from visitflow.operators import silver
    from visitflow.schema import BRONZE_SCHEMA

    text = '{"id":"d","first_name":"A","age":45,"hgb":13.0,"wbc":"NaN"}'
    df = spark.createDataFrame([(text,)], "json_data string")
    row = decode(df, SCHEMA, stamp=False).collect()[0]
    assert math.isnan(row["wbc"])
    assert silver.quality_filter(decode(df, BRONZE_SCHEMA, stamp=False)).count() == 0
    ok = text.replace('"NaN"', "7.0")
    ok_df = spark.createDataFrame([(ok,)], "json_data string")
    assert silver.quality_filter(decode(ok_df, BRONZE_SCHEMA, stamp=False)).count() == 1


def test_decode_keeps_envelope_columns_and_stamps(spark):
    df = spark.createDataFrame([('{"id":"a"}', 9)], "json_data string, delivery_seq long")
    out = decode(df, SCHEMA)
    assert out.columns == ["delivery_seq", "id", "age", "wbc", "event_time"]
    r = out.collect()[0]
    assert r["delivery_seq"] == 9 and r["event_time"] is not None


def test_encode_decode_roundtrip(spark):
    from conftest import bronze_rows, valid_row

    from visitflow.schema import BRONZE_COLUMNS, BRONZE_SCHEMA
    from visitflow.sinks.files import encode

    bronze = bronze_rows(spark, [valid_row(), valid_row(id="b", age=None, allergy=None)])
    back = decode(encode(bronze).withColumnRenamed("value", "json_data"), BRONZE_SCHEMA, stamp=False)
    cols = ["delivery_seq", *BRONZE_COLUMNS]
    assert sorted(map(tuple, back.select(cols).collect())) == sorted(
        map(tuple, bronze.select(cols).collect())
    )
    # Null fields are left out of the message text.
    texts = [r["value"] for r in encode(bronze).collect()]
    assert any('"age"' not in t for t in texts)


def test_kafka_rows_to_silver(spark):
    """A static frame with Kafka's row layout goes through the same path as the topic."""
    import datetime as dt
    import json as _json

    from conftest import valid_row

    from visitflow.operators import silver
    from visitflow.schema import BRONZE_SCHEMA
    from visitflow.sources.messages import from_kafka_rows

    msgs = [
        _json.dumps(valid_row(id="k1")),
        _json.dumps(valid_row(id="k1", age=None)),  # later redelivery, dirty
        "not json",
    ]
    now = dt.datetime(2024, 1, 1)
    rows = [(None, m.encode(), "visits", 0, i, now, 0) for i, m in enumerate(msgs)]
    raw = spark.createDataFrame(
        rows,
        "key binary, value binary, topic string, partition int, offset long, "
        "timestamp timestamp, timestampType int",
    )
    out = silver.clean(decode(from_kafka_rows(raw), BRONZE_SCHEMA)).collect()
    assert [(r["id"], r["delivery_seq"], r["age"]) for r in out] == [("k1", 0, 40)]
