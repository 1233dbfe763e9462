"""KPI golden input (the demo gold tables), shares, risk flags and labels."""

from __future__ import annotations

from visitflow.operators import report
from visitflow.schema import GOLD_SCHEMAS

AGE = [
    ("YOUNG_ADULT", 312, 1.4, None, None),
    ("MIDDLE_AGED", 487, 2.1, None, None),
    ("SENIOR", 634, 2.8, None, None),
    ("ELDERLY", 291, 3.5, None, None),
]
GENDER = [("MALE", 842), ("FEMALE", 882)]


def _frames(spark, age=AGE, gender=GENDER):
    return (
        spark.createDataFrame(age, GOLD_SCHEMAS["age_group_summary"]),
        spark.createDataFrame(gender, GOLD_SCHEMAS["gender_summary"]),
    )


def test_kpi_golden(spark):
    row = report.kpi_summary(*_frames(spark)).collect()[0].asDict()
    assert row == {
        "total_patients": 1724,
        "severe_count": 1412,
        "severe_pct": 81.9,
        "avg_age": 54.6,
        "male_pct": 48.8,
    }


def test_kpi_empty_inputs_give_zero(spark):
    row = report.kpi_summary(*_frames(spark, [], [])).collect()[0].asDict()
    assert row == {
        "total_patients": 0,
        "severe_count": 0,
        "severe_pct": 0.0,
        "avg_age": 0.0,
        "male_pct": 0.0,
    }


def test_kpi_unknown_band_and_missing_score(spark):
    age = [("YOUNG_ADULT", 10, None, None, None), ("OTHER", 10, 3.0, None, None)]
    row = report.kpi_summary(*_frames(spark, age, [("male", 1), ("UNKNOWN", 5)])).collect()[0]
    # Unknown band counts with midpoint 0; missing score counts as 0 (not severe).
    assert row["avg_age"] == 12.5 and row["severe_count"] == 10 and row["severe_pct"] == 50.0
    # Gender matched case-insensitively; UNKNOWN left out of the ratio.
    assert row["male_pct"] == 100.0


def test_exact_ties_round_to_even(spark):
    df = spark.createDataFrame([(1, 8), (1, 16), (0, 0), (2, 3)], "n long, d long")
    got = [r[0] for r in df.select(report.round1_ratio("n", "d", scale=100)).collect()]
    # 12.5 exact; 6.25 -> 6.2 (ties to even, as Python's round); 0/0 -> 0; 66.66.. -> 66.7
    assert got == [12.5, 6.2, 0.0, 66.7]


def test_gender_share(spark):
    _, gd = _frames(spark, gender=[("MALE", 1), ("FEMALE", 3)])
    rows = {r["gender"]: r for r in report.gender_share(gd).collect()}
    assert rows["FEMALE"]["share"] == 0.75 and rows["MALE"]["share_pct"] == 25.0


def test_severity_risk(spark):
    ag, _ = _frames(spark)
    flags = {r["age_group"]: r["above_threshold"] for r in report.severity_risk(ag).collect()}
    assert flags == {"YOUNG_ADULT": False, "MIDDLE_AGED": True, "SENIOR": True, "ELDERLY": True}


def test_labels(spark):
    df = spark.createDataFrame([(1, "Dr. A", 3)], GOLD_SCHEMAS["top_doctors"])
    assert report.labelled(df).columns == ["Doctor Id", "Doctor Name", "Patients Treated"]
    ag, _ = _frames(spark)
    assert report.numeric_view(ag).columns == ["Age Group", "Patient Count", "Avg Severity Score"]


def test_kpi_from_silver_equals_kpi_from_gold(spark):
    from conftest import MEDIUM

    from visitflow.operators import gold, silver
    from visitflow.sources.fixture import read_bronze

    s = silver.clean(read_bronze(spark, MEDIUM))
    from_gold = report.kpi_summary(gold.age_group_summary(s), gold.gender_summary(s)).collect()
    assert report.kpi_from_silver(s).collect() == from_gold
    assert from_gold[0].asDict() == {
        "total_patients": 6815,
        "severe_count": 2846,
        "severe_pct": 41.8,
        "avg_age": 58.0,
        "male_pct": 49.5,
    }
