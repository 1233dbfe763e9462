from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from visitflow.schema import BRONZE_SCHEMA, DELIVERY_SEQ  # noqa: E402
from visitflow.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app_name="visitflow-tests")
    yield s
    s.stop()


def bronze_rows(spark, rows: list[dict]):
    """Bronze frame from hand-made rows; missing fields are null.

    ``delivery_seq`` defaults to the row's position.
    """
    names = [DELIVERY_SEQ] + BRONZE_SCHEMA.fieldNames()
    data = []
    for i, r in enumerate(rows):
        r = dict(r)
        r.setdefault(DELIVERY_SEQ, i)
        data.append(tuple(r.get(n) for n in names))
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField(DELIVERY_SEQ, LongType())] + BRONZE_SCHEMA.fields)
    return spark.createDataFrame(data, schema)


def valid_row(**overrides) -> dict:
    """A bronze row that passes every validity rule."""
    row = {
        "id": "v1",
        "timestamp": "2024-05-01T08:00:00",
        "first_name": "Ann",
        "last_name": "Lee",
        "dob": "1980-01-01",
        "age": 40,
        "gender": "F",
        "phone": "555",
        "address": "Street 1",
        "doctor_id": 1001,
        "doctor_name": "Dr. Who",
        "ward": 1,
        "room": 2,
        "wbc": 7.0,
        "hgb": 13.0,
        "allergy": "Latex",
        "severity": "Mild",
        "diagnosis_code": "I10",
        "diagnosis_desc": "Hypertension",
    }
    row.update(overrides)
    return row
