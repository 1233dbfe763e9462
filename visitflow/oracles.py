"""Reference SQL (DuckDB dialect) for every registered query.

Each text runs on DuckDB with the test tables registered as views. The bronze
rows come from the fixture recipe (shared with Spark: it is input generation);
everything after bronze — dedupe, validation, rules, aggregates, KPIs — is
written here again in plain SQL, independently of the DataFrame code.
"""

from __future__ import annotations

from visitflow.sources.fixture import MALFORMED, MALFORMED_EVERY, bronze_sql

BRONZE_COLS = (
    "id, timestamp, first_name, last_name, dob, age, gender, phone, address, doctor_id, "
    "doctor_name, ward, room, wbc, hgb, allergy, severity, diagnosis_code, diagnosis_desc"
)

DEDUPED = (
    "SELECT * FROM bronze "
    "QUALIFY row_number() OVER (PARTITION BY id ORDER BY delivery_seq) = 1"
)

VALID = (
    "age IS NOT NULL AND age > 0 AND age < 120 "
    "AND wbc IS NOT NULL AND wbc > 0 AND wbc < 30 "
    "AND hgb IS NOT NULL AND hgb > 5 AND hgb < 25 "
    "AND id IS NOT NULL AND id <> '' "
    "AND first_name IS NOT NULL AND first_name <> ''"
)

# First delivery of each id; rows without an id are no one's duplicates.
_FIRST = (
    "SELECT * FROM bronze QUALIFY id IS NULL OR id = '' "
    "OR row_number() OVER (PARTITION BY id ORDER BY delivery_seq) = 1"
)
_CHECKS = {
    "age": "coalesce(age > 0 AND age < 120, FALSE)",
    "wbc": "coalesce(wbc > 0 AND wbc < 30, FALSE)",
    "hgb": "coalesce(hgb > 5 AND hgb < 25, FALSE)",
    "id": "coalesce(id <> '', FALSE)",
    "first_name": "coalesce(first_name <> '', FALSE)",
}
_REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT ({c}) THEN '{n}' END" for n, c in _CHECKS.items()) + ")"

GENDER = "CASE WHEN gender = 'M' THEN 'MALE' WHEN gender = 'F' THEN 'FEMALE' ELSE 'UNKNOWN' END"
ALLERGY = "CASE WHEN allergy = 'None' THEN 'NO ALLERGY' ELSE upper(allergy) END"
AGE_GROUP = (
    "CASE WHEN age < 30 THEN 'YOUNG_ADULT' WHEN age < 50 THEN 'MIDDLE_AGED' "
    "WHEN age < 70 THEN 'SENIOR' ELSE 'ELDERLY' END"
)
WBC_STATUS = "CASE WHEN wbc < 4.0 THEN 'LOW' WHEN wbc > 10.0 THEN 'HIGH' ELSE 'NORMAL' END"
HGB_STATUS = "CASE WHEN hgb < 12.0 THEN 'LOW' WHEN hgb > 15.0 THEN 'HIGH' ELSE 'NORMAL' END"
SCORE = (
    "CAST(CASE upper(severity) WHEN 'MILD' THEN 1 WHEN 'MODERATE' THEN 2 "
    "WHEN 'SEVERE' THEN 3 ELSE 0 END AS INTEGER)"
)


def _standardised(src: str) -> str:
    return f"""SELECT delivery_seq, id, timestamp, upper(first_name) AS first_name,
  upper(last_name) AS last_name, dob, age, {GENDER} AS gender, phone, address, doctor_id,
  upper(doctor_name) AS doctor_name, ward, room, wbc, hgb,
  COALESCE({ALLERGY}, 'UNKNOWN') AS allergy, COALESCE(upper(severity), 'UNKNOWN') AS severity,
  diagnosis_code, diagnosis_desc,
  COALESCE({AGE_GROUP}, 'UNKNOWN') AS age_group, COALESCE({WBC_STATUS}, 'UNKNOWN') AS wbc_status,
  COALESCE({HGB_STATUS}, 'UNKNOWN') AS hgb_status, {SCORE} AS severity_score,
  'CLEAN' AS data_quality_status
FROM {src}"""


def _with(body: str, ctes: str = "", deduped: str = DEDUPED) -> str:
    """Wrap a final SELECT with the bronze / silver CTEs (plus ``ctes``)."""
    return f"""WITH bronze AS (
{bronze_sql()}
),
deduped AS ({deduped}),
valid AS (SELECT * FROM deduped WHERE {VALID}),
silver AS ({_standardised('valid')}){ctes}
{body}"""


def _round1_ratio(num: str, den: str, scale: int = 1) -> str:
    return (
        f"CASE WHEN ({den}) > 0 THEN round_even({scale} * CAST(({num}) AS DOUBLE) / CAST(({den}) AS DOUBLE), 1) "
        f"ELSE CAST(0.0 AS DOUBLE) END"
    )


# ---------------------------------------------------------------- gold bodies
GOLD_BODIES = {
    "severity_summary": """SELECT severity, count(*) AS patient_count, round(avg(age), 1) AS avg_age,
  round(avg(wbc), 1) AS avg_wbc, round(avg(hgb), 1) AS avg_hgb
FROM silver GROUP BY severity""",
    "age_group_summary": """SELECT age_group, count(*) AS patient_count,
  round(avg(severity_score), 2) AS avg_severity_score, round(avg(wbc), 2) AS avg_wbc,
  round(avg(hgb), 2) AS avg_hgb
FROM silver GROUP BY age_group""",
    "gender_summary": "SELECT gender, count(*) AS patient_count FROM silver GROUP BY gender",
    "wbc_summary": """SELECT wbc_status, count(*) AS patient_count, round(avg(age), 1) AS avg_age
FROM silver GROUP BY wbc_status""",
    "hgb_summary": "SELECT hgb_status, count(*) AS patient_count FROM silver GROUP BY hgb_status",
    "daily_trends": """SELECT TRY_CAST(substr(timestamp, 1, 10) AS DATE) AS date, count(*) AS patient_per_day,
  round(avg(age), 1) AS avg_age, count(*) FILTER (WHERE severity = 'SEVERE') AS severe_cases
FROM silver GROUP BY 1""",
    "top_doctors": """SELECT doctor_id, doctor_name, count(*) AS patients_treated
FROM silver GROUP BY doctor_id, doctor_name
ORDER BY patients_treated DESC, doctor_id ASC NULLS LAST, doctor_name ASC NULLS LAST LIMIT 10""",
    "diagnosis_summary": """SELECT diagnosis_code, diagnosis_desc, count(*) AS patient_count
FROM silver GROUP BY diagnosis_code, diagnosis_desc
ORDER BY patient_count DESC, diagnosis_code ASC NULLS LAST, diagnosis_desc ASC NULLS LAST LIMIT 10""",
    "allergy_summary": "SELECT allergy, count(*) AS patient_count FROM silver GROUP BY allergy",
}

STACK_COLUMNS = [
    ("severity", "VARCHAR"),
    ("age_group", "VARCHAR"),
    ("gender", "VARCHAR"),
    ("wbc_status", "VARCHAR"),
    ("hgb_status", "VARCHAR"),
    ("date", "DATE"),
    ("doctor_id", "INTEGER"),
    ("doctor_name", "VARCHAR"),
    ("diagnosis_code", "VARCHAR"),
    ("diagnosis_desc", "VARCHAR"),
    ("allergy", "VARCHAR"),
    ("patient_count", "BIGINT"),
    ("avg_age", "DOUBLE"),
    ("avg_wbc", "DOUBLE"),
    ("avg_hgb", "DOUBLE"),
    ("avg_severity_score", "DOUBLE"),
    ("severe_cases", "BIGINT"),
]

_COUNT_ALIAS = {"top_doctors": "patients_treated", "daily_trends": "patient_per_day"}
_GOLD_COLUMNS = {
    "severity_summary": {"severity", "patient_count", "avg_age", "avg_wbc", "avg_hgb"},
    "age_group_summary": {"age_group", "patient_count", "avg_severity_score", "avg_wbc", "avg_hgb"},
    "gender_summary": {"gender", "patient_count"},
    "wbc_summary": {"wbc_status", "patient_count", "avg_age"},
    "hgb_summary": {"hgb_status", "patient_count"},
    "daily_trends": {"date", "patient_count", "avg_age", "severe_cases"},
    "top_doctors": {"doctor_id", "doctor_name", "patient_count"},
    "diagnosis_summary": {"diagnosis_code", "diagnosis_desc", "patient_count"},
    "allergy_summary": {"allergy", "patient_count"},
}


def _stacked() -> tuple[str, str]:
    ctes = ",\n".join(f"g_{name} AS ({body})" for name, body in GOLD_BODIES.items())
    parts = []
    for name in GOLD_BODIES:
        cols = [f"'{name}' AS table_name"]
        for col, typ in STACK_COLUMNS:
            if col in _GOLD_COLUMNS[name]:
                src = _COUNT_ALIAS.get(name, "patient_count") if col == "patient_count" else col
                cols.append(f"CAST({src} AS {typ}) AS {col}")
            else:
                cols.append(f"CAST(NULL AS {typ}) AS {col}")
        parts.append(f"SELECT {', '.join(cols)} FROM g_{name}")
    return f",\n{ctes}", "\nUNION ALL\n".join(parts)


def _json_field(name: str, kind: str) -> str:
    if kind == "str":
        value = f"to_json({name})"
    else:
        value = f"CAST({name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NOT NULL THEN '\"{name}\":' || {value} END"


_JSON_KINDS = {
    "age": "num", "doctor_id": "num", "ward": "num", "room": "num", "wbc": "num", "hgb": "num",
}


def _encode_sql() -> str:
    fields = [c.strip() for c in BRONZE_COLS.split(",")]
    parts = ", ".join(_json_field(f, _JSON_KINDS.get(f, "str")) for f in fields)
    return f"""WITH bronze AS (
{bronze_sql()}
)
SELECT delivery_seq, '{{' || concat_ws(',', {parts}) || '}}' AS value FROM bronze"""


def _bronze_only(body: str) -> str:
    return f"WITH bronze AS (\n{bronze_sql()}\n)\n{body}"


def _decoded_sql() -> str:
    """Decoded messages: nulls where the text isn't an object, and in fields of a wrong type."""
    nothing = ", ".join(str(at) for at, text in MALFORMED.items() if not text.startswith("{\"id\":7"))
    partly = next(at for at, text in MALFORMED.items() if text.startswith("{\"id\":7"))
    kept = {"id": "'7'", "first_name": "'Ann'"}
    cols = [
        f"CASE WHEN delivery_seq % {MALFORMED_EVERY} IN ({nothing}) THEN NULL "
        f"WHEN delivery_seq % {MALFORMED_EVERY} = {partly} THEN {kept.get(c, 'NULL')} ELSE {c} END AS {c}"
        for c in BRONZE_COLS.split(", ")
    ]
    return f"SELECT delivery_seq, {', '.join(cols)} FROM bronze"


# table -> (key columns, order of its rows)
_ORDERS = {
    "severity_summary": (["severity"], "patient_count DESC, severity ASC NULLS LAST"),
    "age_group_summary": (["age_group"], "age_group ASC"),
    "gender_summary": (["gender"], "patient_count DESC, gender ASC NULLS LAST"),
    "wbc_summary": (["wbc_status"], "patient_count DESC, wbc_status ASC NULLS LAST"),
    "hgb_summary": (["hgb_status"], "patient_count DESC, hgb_status ASC NULLS LAST"),
    "daily_trends": (["date"], "date DESC NULLS LAST"),
    "top_doctors": (["doctor_id", "doctor_name"], "patients_treated DESC, doctor_id ASC NULLS LAST, doctor_name ASC NULLS LAST"),
    "diagnosis_summary": (["diagnosis_code", "diagnosis_desc"], "patient_count DESC, diagnosis_code ASC NULLS LAST, diagnosis_desc ASC NULLS LAST"),
    "allergy_summary": (["allergy"], "patient_count DESC, allergy ASC NULLS LAST"),
}


def _order_body() -> str:
    parts = []
    for name, (keys, order) in _ORDERS.items():
        key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys)
        parts.append(
            f"SELECT '{name}' AS table_name, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position, "
            f"{key} AS row_key FROM g_{name}"
        )
    return "\nUNION ALL\n".join(parts)


def _chart_body() -> str:
    charts = [
        ("age_group_distribution", "age_group_summary", "age_group", "patient_count", "NULL"),
        ("severity_score_by_age_group", "age_group_summary", "age_group", "avg_severity_score", "NULL"),
        ("gender_distribution", "gender_summary", "gender", "patient_count", "NULL"),
        ("wbc_status", "wbc_summary", "wbc_status", "patient_count", "NULL"),
        ("severity_breakdown", "severity_summary", "severity", "patient_count", "NULL"),
        ("top_diagnoses", "diagnosis_summary", "diagnosis_code", "patient_count", "diagnosis_desc"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS chart, {x} AS x, CAST({y} AS DOUBLE) AS y, CAST({d} AS VARCHAR) AS detail FROM g_{t}"
        for c, t, x, y, d in charts
    )


def _kpi_ctes() -> str:
    return f""",
ag AS ({GOLD_BODIES['age_group_summary']}),
gd AS ({GOLD_BODIES['gender_summary']}),
sums AS (
  SELECT
    (SELECT COALESCE(SUM(patient_count), 0) FROM ag) AS total,
    (SELECT COALESCE(SUM(CASE WHEN COALESCE(avg_severity_score, 0) > 2 THEN patient_count END), 0) FROM ag) AS severe,
    (SELECT COALESCE(SUM(CASE age_group WHEN 'YOUNG_ADULT' THEN 25 WHEN 'MIDDLE_AGED' THEN 45
        WHEN 'SENIOR' THEN 65 WHEN 'ELDERLY' THEN 80 ELSE 0 END * patient_count), 0) FROM ag) AS age_sum,
    (SELECT COALESCE(SUM(CASE WHEN upper(gender) = 'MALE' THEN patient_count END), 0) FROM gd) AS male,
    (SELECT COALESCE(SUM(CASE WHEN upper(gender) = 'FEMALE' THEN patient_count END), 0) FROM gd) AS female
)"""


def _kpi_body() -> str:
    return f"""SELECT CAST(total AS BIGINT) AS total_patients, CAST(severe AS BIGINT) AS severe_count,
  {_round1_ratio('severe', 'total', 100)} AS severe_pct,
  {_round1_ratio('age_sum', 'total')} AS avg_age,
  {_round1_ratio('male', 'male + female', 100)} AS male_pct
FROM sums"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per registered query, same column names and types as the Spark result.

    Stream queries share the batch texts (a stream must end with the batch result).
    """
    silver_cols = (
        "delivery_seq, " + BRONZE_COLS + ", age_group, wbc_status, hgb_status, severity_score, "
        "data_quality_status"
    )
    q: dict[str, str] = {
        "bronze_encode": _encode_sql(),
        "bronze_decode": _bronze_only(_decoded_sql()),
        "silver_dedupe": _bronze_only(f"SELECT delivery_seq, {BRONZE_COLS} FROM ({DEDUPED})"),
        "silver_quality_filter": _bronze_only(
            f"SELECT delivery_seq, id, first_name, age, wbc, hgb FROM bronze WHERE {VALID}"
        ),
        "silver_gender": _bronze_only(
            f"SELECT delivery_seq, gender AS gender_raw, {GENDER} AS gender FROM bronze"
        ),
        "silver_uppercase": _bronze_only(
            "SELECT delivery_seq, upper(first_name) AS first_name, upper(last_name) AS last_name, "
            "upper(doctor_name) AS doctor_name, upper(severity) AS severity FROM bronze"
        ),
        "silver_allergy": _bronze_only(
            f"SELECT delivery_seq, allergy AS allergy_raw, {ALLERGY} AS allergy FROM bronze"
        ),
        "silver_age_group": _bronze_only(f"SELECT delivery_seq, age, {AGE_GROUP} AS age_group FROM bronze"),
        "silver_wbc_status": _bronze_only(f"SELECT delivery_seq, wbc, {WBC_STATUS} AS wbc_status FROM bronze"),
        "silver_hgb_status": _bronze_only(f"SELECT delivery_seq, hgb, {HGB_STATUS} AS hgb_status FROM bronze"),
        "silver_severity_score": _bronze_only(
            f"SELECT delivery_seq, severity AS severity_raw, upper(severity) AS severity, "
            f"{SCORE} AS severity_score FROM bronze"
        ),
        "silver_defaults": _bronze_only(
            "SELECT delivery_seq, allergy, severity, age_group, wbc_status, hgb_status FROM ("
            + _standardised("bronze")
            + ")"
        ),
        "silver_visits": _with(f"SELECT {silver_cols} FROM silver"),
        "silver_row_count": _with("SELECT count(*) AS silver_rows FROM silver"),
        "silver_stamps": _with(
            "SELECT count(*) AS silver_rows, count(*) AS event_times, count(*) AS processed_dates FROM silver"
        ),
        "kafka_rows_dedupe": _with(f"SELECT {silver_cols.removeprefix('delivery_seq, ')} FROM silver"),
        "silver_partitioned_roundtrip": _with(f"SELECT {silver_cols} FROM silver"),
    }
    for name, body in GOLD_BODIES.items():
        q[f"gold_{name}"] = _with(body)
    stack_ctes, stack_body = _stacked()
    q["gold_one_pass"] = _with(stack_body, ctes=stack_ctes)
    q["gold_roundtrip"] = q["gold_one_pass"]
    q["gold_without_timestamp"] = _with(f"SELECT * FROM ({stack_body}) WHERE table_name <> 'daily_trends'", ctes=stack_ctes)
    q["gold_order"] = _with(_order_body(), ctes=stack_ctes)
    q["chart_series"] = _with(_chart_body(), ctes=stack_ctes)
    q["kpi_summary"] = _with(_kpi_body(), ctes=_kpi_ctes())
    q["gender_share"] = _with(
        f"""SELECT gender, patient_count,
  CAST(patient_count AS DOUBLE) / CAST(SUM(patient_count) OVER () AS DOUBLE) AS share,
  {_round1_ratio('patient_count', 'SUM(patient_count) OVER ()', 100)} AS share_pct
FROM ({GOLD_BODIES['gender_summary']})"""
    )
    q["severity_risk"] = _with(
        f"""SELECT age_group, avg_severity_score, patient_count,
  COALESCE(avg_severity_score, 0) > 2 AS above_threshold
FROM ({GOLD_BODIES['age_group_summary']})"""
    )
    q["top_doctors_labelled"] = _with(
        f"""SELECT doctor_id AS "Doctor Id", doctor_name AS "Doctor Name",
  patients_treated AS "Patients Treated" FROM ({GOLD_BODIES['top_doctors']})"""
    )
    q["age_group_numeric"] = _with(
        f"""SELECT age_group AS "Age Group", patient_count AS "Patient Count",
  avg_severity_score AS "Avg Severity Score" FROM ({GOLD_BODIES['age_group_summary']})"""
    )
    # Streams: the same records as batch; stamps are not compared.
    q["stream_silver"] = q["silver_visits"]
    q["stream_gold_severity"] = q["gold_severity_summary"]
    q["stream_gold_all"] = q["gold_one_pass"]
    q["stream_gold_tables"] = q["gold_one_pass"]
    q["stream_gold_replay"] = q["gold_one_pass"]
    q["stream_silver_bounded"] = q["silver_visits"]
    q["stream_daily_trends"] = q["gold_daily_trends"]
    q["stream_daily_windows"] = q["gold_daily_trends"]
    q["stream_gold_upsert"] = q["gold_one_pass"]
    q["stream_gold_top"] = _with(
        f"SELECT * FROM ({stack_body}) WHERE table_name IN ('top_doctors', 'diagnosis_summary')", ctes=stack_ctes
    )
    q["gold_incremental"] = q["gold_one_pass"]
    q["gold_versioned"] = q["gold_one_pass"]
    q["stream_state_to_index"] = q["silver_visits"]
    q["stream_silver_indexed"] = q["silver_visits"]
    q["stream_silver_horizon"] = q["silver_visits"]
    q["stream_late_repair"] = q["silver_visits"]
    q["stream_rejects"] = _bronze_only(f"SELECT delivery_seq, id, {_REASONS} AS reasons FROM ({_FIRST}) WHERE NOT ({VALID})")
    verdicts = [
        ("verdict:clean", f"SELECT count(*) FROM firsts WHERE {VALID}"),
        ("verdict:rejected", f"SELECT count(*) FROM firsts WHERE NOT ({VALID})"),
        ("verdict:duplicate", "SELECT (SELECT count(*) FROM bronze) - (SELECT count(*) FROM firsts)"),
        ("verdict:late", "SELECT 0"),
        *[(f"reason:{name}", f"SELECT count(*) FROM firsts WHERE NOT ({check})") for name, check in _CHECKS.items()],
    ]
    q["stream_verdicts"] = f"WITH bronze AS (\n{bronze_sql()}\n),\nfirsts AS ({_FIRST})\n" + "\nUNION ALL\n".join(
        f"SELECT '{what}' AS what, CAST(({body}) AS BIGINT) AS messages" for what, body in verdicts
    )
    return q
