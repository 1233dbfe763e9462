"""One hand-made row per edge of the silver rules (dedupe order, ranges, labels)."""

from __future__ import annotations

from conftest import bronze_rows, valid_row

from visitflow.operators import silver


def _clean(spark, rows, **kw):
    return {r["id"]: r.asDict() for r in silver.clean(bronze_rows(spark, rows), **kw).collect()}


def test_dirty_first_delivery_suppresses_clean_redelivery(spark):
    rows = [valid_row(id="a", age=None), valid_row(id="a", age=40)]
    assert _clean(spark, rows) == {}
    # The other order of operations keeps the clean copy.
    kept = _clean(spark, rows, dedupe="after_validation")
    assert list(kept) == ["a"] and kept["a"]["age"] == 40


def test_first_delivery_wins_by_arrival_order(spark):
    rows = [
        valid_row(id="a", delivery_seq=5, first_name="Late"),
        valid_row(id="a", delivery_seq=1, first_name="Early"),
    ]
    assert _clean(spark, rows)["a"]["first_name"] == "EARLY"


def test_range_bounds_are_exclusive(spark):
    rows = [
        valid_row(id="age0", age=0),
        valid_row(id="age1", age=1),
        valid_row(id="age119", age=119),
        valid_row(id="age120", age=120),
        valid_row(id="wbc0", wbc=0.0),
        valid_row(id="wbc30", wbc=30.0),
        valid_row(id="wbc29", wbc=29.9),
        valid_row(id="hgb5", hgb=5.0),
        valid_row(id="hgb25", hgb=25.0),
        valid_row(id="hgb51", hgb=5.1),
        valid_row(id="nan", wbc=float("nan")),
    ]
    assert set(_clean(spark, rows)) == {"age1", "age119", "wbc29", "hgb51"}


def test_required_strings(spark):
    rows = [
        valid_row(id=None),
        valid_row(id=""),
        valid_row(id="nofirst", first_name=None),
        valid_row(id="emptyfirst", first_name=""),
        valid_row(id="blankfirst", first_name=" "),
    ]
    # No trimming: a blank first name is present.
    assert set(_clean(spark, rows)) == {"blankfirst"}


def test_gender_map_is_case_sensitive(spark):
    rows = [
        valid_row(id="m", gender="M"),
        valid_row(id="f", gender="F"),
        valid_row(id="lm", gender="m"),
        valid_row(id="x", gender="X"),
        valid_row(id="n", gender=None),
    ]
    out = {k: v["gender"] for k, v in _clean(spark, rows).items()}
    assert out == {"m": "MALE", "f": "FEMALE", "lm": "UNKNOWN", "x": "UNKNOWN", "n": "UNKNOWN"}


def test_allergy_labels(spark):
    rows = [
        valid_row(id="cap", allergy="None"),
        valid_row(id="low", allergy="none"),
        valid_row(id="null", allergy=None),
        valid_row(id="pea", allergy="Peanuts"),
    ]
    out = {k: v["allergy"] for k, v in _clean(spark, rows).items()}
    assert out == {"cap": "NO ALLERGY", "low": "NONE", "null": "UNKNOWN", "pea": "PEANUTS"}


def test_age_band_edges(spark):
    ages = {"a29": 29, "a30": 30, "a49": 49, "a50": 50, "a69": 69, "a70": 70}
    out = _clean(spark, [valid_row(id=k, age=v) for k, v in ages.items()])
    assert {k: v["age_group"] for k, v in out.items()} == {
        "a29": "YOUNG_ADULT",
        "a30": "MIDDLE_AGED",
        "a49": "MIDDLE_AGED",
        "a50": "SENIOR",
        "a69": "SENIOR",
        "a70": "ELDERLY",
    }


def test_lab_class_edges(spark):
    rows = [
        valid_row(id="w39", wbc=3.9),
        valid_row(id="w40", wbc=4.0),
        valid_row(id="w100", wbc=10.0),
        valid_row(id="w101", wbc=10.1),
        valid_row(id="h119", hgb=11.9),
        valid_row(id="h120", hgb=12.0),
        valid_row(id="h150", hgb=15.0),
        valid_row(id="h151", hgb=15.1),
    ]
    out = _clean(spark, rows)
    assert [out[k]["wbc_status"] for k in ("w39", "w40", "w100", "w101")] == [
        "LOW",
        "NORMAL",
        "NORMAL",
        "HIGH",
    ]
    assert [out[k]["hgb_status"] for k in ("h119", "h120", "h150", "h151")] == [
        "LOW",
        "NORMAL",
        "NORMAL",
        "HIGH",
    ]


def test_severity_upper_then_score(spark):
    rows = [
        valid_row(id="s", severity="severe"),
        valid_row(id="m", severity="Moderate"),
        valid_row(id="c", severity="Critical"),
        valid_row(id="n", severity=None),
    ]
    out = _clean(spark, rows)
    assert (out["s"]["severity"], out["s"]["severity_score"]) == ("SEVERE", 3)
    assert (out["m"]["severity"], out["m"]["severity_score"]) == ("MODERATE", 2)
    assert (out["c"]["severity"], out["c"]["severity_score"]) == ("CRITICAL", 0)
    assert (out["n"]["severity"], out["n"]["severity_score"]) == ("UNKNOWN", 0)


def test_no_defaults_for_other_columns(spark):
    out = _clean(spark, [valid_row(id="a", last_name=None, doctor_name=None, diagnosis_code=None)])
    row = out["a"]
    assert row["last_name"] is None and row["doctor_name"] is None and row["diagnosis_code"] is None
    assert row["data_quality_status"] == "CLEAN" and row["processed_date"] is not None


def test_silver_schema_order(spark):
    from visitflow.schema import SILVER_COLUMNS

    from visitflow.sources.messages import decode

    msgs = spark.createDataFrame([('{"id":"a"}', 1)], "json_data string, delivery_seq long")
    df = silver.clean(decode(msgs))
    assert df.columns == SILVER_COLUMNS
    assert dict(df.dtypes)["severity_score"] == "int"


def test_nan_lab_value_orders_above_all_numbers(spark):
    """Spark orders NaN above every number: a NaN wbc classifies as HIGH, and the
    range check (wbc < 30) drops the row, so NaN never reaches silver."""
    row = valid_row(id="n", wbc=float("nan"))
    std = silver.standardise(bronze_rows(spark, [row])).collect()[0]
    assert std["wbc_status"] == "HIGH"
    assert silver.clean(bronze_rows(spark, [row])).count() == 0
