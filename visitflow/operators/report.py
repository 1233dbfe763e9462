"""Report tables derived from gold: KPI row, gender share, risk table, labels.

The KPI row combines two gold tables. Instead of joining two one-row frames,
both tables are stacked with ``unionByName`` and reduced by one global
aggregate of conditional sums; the inputs are gold tables whose row counts are
bounded by their label sets (four age bands, three genders). From silver, one
aggregate by (age band, gender) — twelve groups at most — holds all five KPIs.

Percentages and the band-midpoint average are rounded to one decimal, ties to the
even digit (1 of 16 is 6.2 %), in exact integer arithmetic, so the digits do not
depend on engine or partitioning. Float rounding of the same ratio agrees wherever
a tie is exact in binary (6.25, 18.75, ...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.functions import rules


def round1_ratio(num: Column | str, den: Column | str, scale: int = 1) -> Column:
    """scale * num / den for non-negative integers, to one decimal, ties to even; 0 when den is 0."""
    num = (F.col(num) if isinstance(num, str) else num).cast("bigint")
    den = (F.col(den) if isinstance(den, str) else den).cast("bigint")
    # Exact while 20*scale*num fits in 63 bits. A null divisor stands in for 0.
    tenth = F.lit(10 * scale) * num
    safe = F.nullif(den, F.lit(0))
    down = F.call_function("div", tenth, safe)
    twice = F.lit(2) * (tenth - down * safe)
    up = (twice > safe) | ((twice == safe) & (down % 2 == 1))
    return F.when(den > 0, (down + F.when(up, 1).otherwise(0)).cast("double") / 10.0).otherwise(F.lit(0.0))


def _midpoint(label: Column) -> Column:
    expr = None
    for band, mid in rules.AGE_BAND_MIDPOINTS.items():
        expr = F.when(label == band, mid) if expr is None else expr.when(label == band, mid)
    return expr.otherwise(0)


def _kpi_from_rows(rows: DataFrame) -> DataFrame:
    """KPI row from stacked label rows: ``src`` ('age'/'gender'), ``label``, ``n``, ``score``."""
    is_age = F.col("src") == "age"
    is_gender = F.col("src") == "gender"
    label_up = F.upper(F.coalesce(F.col("label"), F.lit("")))

    def total(cond: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, value)), F.lit(0))

    severe_band = is_age & (
        F.coalesce(F.col("score"), F.lit(0.0)) > rules.SEVERE_SCORE_THRESHOLD
    )
    sums = rows.agg(
        total(is_age, F.col("n")).alias("total"),
        total(severe_band, F.col("n")).alias("severe"),
        total(is_age, _midpoint(F.col("label")) * F.col("n")).alias("age_sum"),
        total(is_gender & (label_up == "MALE"), F.col("n")).alias("male"),
        total(is_gender & (label_up == "FEMALE"), F.col("n")).alias("female"),
    )
    return _kpi_row(sums)


def _kpi_row(sums: DataFrame) -> DataFrame:
    """The five KPIs from their sums (one row)."""
    return sums.select(
        F.col("total").cast("bigint").alias("total_patients"),
        F.col("severe").cast("bigint").alias("severe_count"),
        round1_ratio(F.col("severe"), F.col("total"), scale=100).alias("severe_pct"),
        round1_ratio(F.col("age_sum"), F.col("total")).alias("avg_age"),
        round1_ratio(F.col("male"), F.col("male") + F.col("female"), scale=100).alias("male_pct"),
    )


def kpi_summary(age_groups: DataFrame, genders: DataFrame) -> DataFrame:
    """One row: total_patients, severe_count, severe_pct, avg_age, male_pct, from gold tables.

    * total = sum of band counts;
    * severe_count = patients in bands whose mean severity score (as stored in
      the gold table, rounded to 2 decimals) is above 2; a missing score is 0;
    * avg_age = band midpoints weighted by count (unknown band = 0);
    * male_pct = MALE / (MALE + FEMALE), gender matched case-insensitively.
    """
    ag = age_groups.select(
        F.lit("age").alias("src"),
        F.col("age_group").alias("label"),
        F.col("patient_count").cast("bigint").alias("n"),
        F.col("avg_severity_score").cast("double").alias("score"),
    )
    gd = genders.select(
        F.lit("gender").alias("src"),
        F.col("gender").alias("label"),
        F.col("patient_count").cast("bigint").alias("n"),
        F.lit(None).cast("double").alias("score"),
    )
    return _kpi_from_rows(ag.unionByName(gd))


def kpi_from_silver(silver: DataFrame) -> DataFrame:
    """The same KPI row straight from silver, in one scan.

    The aggregate by (age_group, gender) has at most twelve groups; folded by band it
    gives the band's score, rounded as the gold table stores it, and its genders.
    """
    pairs = silver.groupBy("age_group", "gender").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("severity_score").alias("n_score"),
        F.sum(F.col("severity_score").cast("double")).alias("sum_score"),
    )
    gender = F.upper(F.coalesce(F.col("gender"), F.lit("")))
    n = F.col("n")
    bands = pairs.groupBy("age_group").agg(
        F.sum("n").alias("n"),
        F.round(F.try_divide(F.sum("sum_score"), F.sum("n_score")), 2).alias("score"),
        F.sum(F.when(gender == "MALE", n).otherwise(0)).alias("male"),
        F.sum(F.when(gender == "FEMALE", n).otherwise(0)).alias("female"),
    )
    severe = F.coalesce(F.col("score"), F.lit(0.0)) > rules.SEVERE_SCORE_THRESHOLD
    sums = bands.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(severe, n)), F.lit(0)).alias("severe"),
        F.coalesce(F.sum(_midpoint(F.col("age_group")) * n), F.lit(0)).alias("age_sum"),
        F.coalesce(F.sum("male"), F.lit(0)).alias("male"),
        F.coalesce(F.sum("female"), F.lit(0)).alias("female"),
    )
    return _kpi_row(sums)


# The dashboard's charts — gold table, axis column, value column, detail column.
CHARTS: dict[str, tuple[str, str, str, str | None]] = {
    "age_group_distribution": ("age_group_summary", "age_group", "patient_count", None),
    "severity_score_by_age_group": ("age_group_summary", "age_group", "avg_severity_score", None),
    "gender_distribution": ("gender_summary", "gender", "patient_count", None),
    "wbc_status": ("wbc_summary", "wbc_status", "patient_count", None),
    "severity_breakdown": ("severity_summary", "severity", "patient_count", None),
    "top_diagnoses": ("diagnosis_summary", "diagnosis_code", "patient_count", "diagnosis_desc"),
}


def chart_series(tables: dict[str, DataFrame]) -> DataFrame:
    """The six charts' points in one long table: chart, x, y, detail.

    Each chart is a projection of one gold table; an absent table leaves its chart out.
    """
    out = None
    for chart, (table, x, y, detail) in CHARTS.items():
        if tables.get(table) is None:
            continue
        points = tables[table].select(
            F.lit(chart).alias("chart"),
            F.col(x).alias("x"),
            F.col(y).cast("double").alias("y"),
            (F.col(detail) if detail else F.lit(None).cast("string")).alias("detail"),
        )
        out = points if out is None else out.unionByName(points)
    return out


def gender_share(genders: DataFrame) -> DataFrame:
    """Each gender's share of all patients (the pie chart's percent).

    The window has no partition key, so it runs in one task; its input is the
    gender gold table, which has at most three rows (MALE, FEMALE, UNKNOWN).
    """
    total = F.sum("patient_count").over(Window.partitionBy())
    return genders.select(
        "gender",
        "patient_count",
        (F.col("patient_count").cast("double") / total.cast("double")).alias("share"),
        round1_ratio(F.col("patient_count"), total, scale=100).alias("share_pct"),
    )


def severity_risk(age_groups: DataFrame) -> DataFrame:
    """Risk table: mean severity score per band against the reference line at 2."""
    return age_groups.select(
        "age_group",
        "avg_severity_score",
        "patient_count",
        (F.coalesce(F.col("avg_severity_score"), F.lit(0.0)) > rules.SEVERE_SCORE_THRESHOLD).alias(
            "above_threshold"
        ),
    )


def title_label(name: str) -> str:
    """Column label for display: snake_case -> 'Title Case' (str.title semantics)."""
    return name.replace("_", " ").title()


def labelled(df: DataFrame) -> DataFrame:
    """Rename every column to its display label."""
    return df.toDF(*[title_label(c) for c in df.columns])


def numeric_view(df: DataFrame, markers: tuple[str, ...] = ("Count", "Score")) -> DataFrame:
    """Labelled table restricted to its first (key) column and the count/score columns."""
    lab = labelled(df)
    keep = [lab.columns[0]] + [c for c in lab.columns[1:] if any(m in c for m in markers)]
    return lab.select(*[F.col(f"`{c}`") for c in keep])
