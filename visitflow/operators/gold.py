"""Gold: nine aggregate tables over silver.

Each builder is a plain ``groupBy().agg()``: Spark runs a partial (map-side)
hash aggregate, so only one row per key and map task crosses the shuffle — a
hot key (a third of all rows in one severity, say) costs nothing extra.
Top-10 tables use ``orderBy().limit()``, which Spark plans as a distributed
top-k (``TakeOrderedAndProject``), never a global sort.

``aggregate_all`` computes every table in *one* scan of silver with GROUPING
SETS (Expand + one partial aggregate), and ``split`` cuts the small result into
the nine tables. Keys can be null, so sets are told apart by ``grouping()``
bits, never by null tests on keys.

Ties: the reference sorts by count only; here ties break on the key columns
ascending, nulls last, so top-10 results are deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitflow.functions import rules
from visitflow.schema import SILVER_SCHEMA

TOP_N = 10  # Fixed value: size of the top-doctor and top-diagnosis tables.


def _by_count(count_col: str, *keys: str) -> list[Column]:
    return [F.col(count_col).desc(), *[F.col(k).asc_nulls_last() for k in keys]]


# Each table once: key columns, name of its count, averages as (column, digits), and
# whether it also counts severe cases.
@dataclass(frozen=True)
class Table:
    keys: tuple[str, ...]
    count: str = "patient_count"
    means: tuple[tuple[str, str, int], ...] = ()  # (output, averaged column, digits)
    severe: bool = False
    limit: bool = False  # only the TOP_N largest
    by_key: str = ""  # "asc" or "desc": ordered by the key instead of the count


TABLES: dict[str, Table] = {
    "severity_summary": Table(
        ("severity",), means=(("avg_age", "age", 1), ("avg_wbc", "wbc", 1), ("avg_hgb", "hgb", 1))
    ),
    "age_group_summary": Table(
        ("age_group",),
        means=(("avg_severity_score", "severity_score", 2), ("avg_wbc", "wbc", 2), ("avg_hgb", "hgb", 2)),
        by_key="asc",
    ),
    "gender_summary": Table(("gender",)),
    "wbc_summary": Table(("wbc_status",), means=(("avg_age", "age", 1),)),
    "hgb_summary": Table(("hgb_status",)),
    "daily_trends": Table(
        ("date",), count="patient_per_day", means=(("avg_age", "age", 1),), severe=True, by_key="desc"
    ),
    # A doctor is the (id, name) pair: one id with two names is two rows.
    "top_doctors": Table(("doctor_id", "doctor_name"), count="patients_treated", limit=True),
    "diagnosis_summary": Table(("diagnosis_code", "diagnosis_desc"), limit=True),
    "allergy_summary": Table(("allergy",)),
}
LIMITED = {name for name, t in TABLES.items() if t.limit}


def available(silver: DataFrame) -> list[str]:
    """The tables that can be built: the daily one needs silver's ``timestamp``."""
    return [n for n in TABLES if n != "daily_trends" or "timestamp" in silver.columns]


def _dated(silver: DataFrame) -> DataFrame:
    return silver.withColumn("date", rules.visit_date("timestamp")) if "timestamp" in silver.columns else silver


def table_aggregate(silver: DataFrame, name: str) -> DataFrame:
    """One table's aggregate, unordered (also as a streaming aggregate)."""
    t = TABLES[name]
    cols = [F.count(F.lit(1)).alias(t.count)]
    cols += [F.round(F.avg(c), digits).alias(out) for out, c, digits in t.means]
    if t.severe:
        cols.append(F.count_if(F.col("severity") == "SEVERE").alias("severe_cases"))
    return _dated(silver).groupBy(*t.keys).agg(*cols)


def table_order(name: str) -> list[Column]:
    """Row order of a gold table: count desc, then keys ascending, nulls last (or by key)."""
    t = TABLES[name]
    if t.by_key:
        return [F.col(t.keys[0]).asc() if t.by_key == "asc" else F.col(t.keys[0]).desc()]
    return _by_count(t.count, *t.keys)


def build(silver: DataFrame, name: str) -> DataFrame | None:
    """One ordered gold table; None if silver lacks what it needs (the table is skipped)."""
    if name not in available(silver):
        return None
    out = table_aggregate(silver, name).orderBy(*table_order(name))
    return out.limit(TOP_N) if TABLES[name].limit else out


BUILDERS = {name: partial(build, name=name) for name in TABLES}
severity_summary = BUILDERS["severity_summary"]
age_group_summary = BUILDERS["age_group_summary"]
gender_summary = BUILDERS["gender_summary"]
wbc_summary = BUILDERS["wbc_summary"]
hgb_summary = BUILDERS["hgb_summary"]
daily_trends = BUILDERS["daily_trends"]
top_doctors = BUILDERS["top_doctors"]
diagnosis_summary = BUILDERS["diagnosis_summary"]
allergy_summary = BUILDERS["allergy_summary"]


# --------------------------------------------------------------------------
# One pass: all nine tables from one scan of silver.
# --------------------------------------------------------------------------

# grain -> key columns of that grouping set
GRAINS: dict[str, tuple[str, ...]] = {name: t.keys for name, t in TABLES.items()}

_ALL_KEYS: list[str] = list(dict.fromkeys(k for keys in GRAINS.values() for k in keys))


def aggregate_all(silver: DataFrame, tables: list[str] | None = None) -> DataFrame:
    """One GROUPING SETS aggregate holding the sums and counts of all nine tables (or of ``tables``).

    Output: ``grain`` plus every key column (null outside its own set) plus
    ``n``, ``n_age``, ``sum_age``, ``n_wbc``, ``sum_wbc``, ``n_hgb``, ``sum_hgb``,
    ``n_score``, ``sum_score``, ``severe`` — enough to derive each table's
    averages with the same arithmetic as ``avg``. Without ``timestamp`` in silver
    the daily set is left out; the others still share one scan.
    """
    names = [n for n in available(silver) if tables is None or n in tables]
    keys_used = [k for k in _ALL_KEYS if any(k in GRAINS[n] for n in names)]
    sets = [[F.col(k) for k in GRAINS[n]] for n in names]
    agg = _dated(silver).groupingSets(sets, *[F.col(k) for k in keys_used]).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("age").alias("n_age"),
        F.sum(F.col("age").cast("double")).alias("sum_age"),
        F.count("wbc").alias("n_wbc"),
        F.sum("wbc").alias("sum_wbc"),
        F.count("hgb").alias("n_hgb"),
        F.sum("hgb").alias("sum_hgb"),
        F.count("severity_score").alias("n_score"),
        F.sum(F.col("severity_score").cast("double")).alias("sum_score"),
        F.count_if(F.col("severity") == "SEVERE").alias("severe"),
        *[F.grouping(k).alias(f"__g_{k}") for k in keys_used],
    )
    grain = F.lit(None).cast("string")
    for name in names:
        cond = F.lit(True)
        for k in keys_used:
            cond = cond & (F.col(f"__g_{k}") == (0 if k in GRAINS[name] else 1))
        grain = F.when(cond, name).otherwise(grain)
    types = dict(STACKED_COLUMNS)
    missing = [F.lit(None).cast(types[k]).alias(k) for k in _ALL_KEYS if k not in keys_used]
    kept = [c for c in agg.columns if not c.startswith("__g_")]
    return agg.withColumn("grain", grain).select(*kept, *missing, "grain")


#: Key columns and sums of ``aggregate_all``'s rows. Rows of one key from different parts of silver add up.
AGGREGATE_KEYS = ("grain", *_ALL_KEYS)
AGGREGATE_SUMS = ("n", "n_age", "sum_age", "n_wbc", "sum_wbc", "n_hgb", "sum_hgb", "n_score", "sum_score", "severe")


def aggregate_schema(spark: SparkSession) -> T.StructType:
    """Schema of ``aggregate_all``, keys first."""
    agg = aggregate_all(spark.createDataFrame([], SILVER_SCHEMA))
    return agg.select(*AGGREGATE_KEYS, *AGGREGATE_SUMS).schema


def store_aggregate(agg: DataFrame, path: str) -> DataFrame:
    """Write the aggregate by grain and read it back: a table then reads only its own part.

    The doctor set can hold millions of (id, name) pairs; the other parts are small.
    """
    agg.write.partitionBy("grain").parquet(path)
    schema = T.StructType([f for f in agg.schema.fields if f.name != "grain"] + [agg.schema["grain"]])
    return agg.sparkSession.read.schema(schema).parquet(path)


def stored_sizes(agg: DataFrame) -> dict[str, int]:
    """Rows of each table in a stored aggregate: one small job (the count is read off the file footers)."""
    found = {r["grain"]: r["count"] for r in agg.groupBy("grain").count().collect()}  # nine rows at most
    return {n: min(found.get(n, 0), TOP_N) if n in LIMITED else found.get(n, 0) for n in TABLES}


def _mean(sum_col: str, n_col: str, digits: int) -> Column:
    # Same arithmetic as avg(): double sum / count, null when the count is 0.
    return F.round(
        F.when(F.col(n_col) > 0, F.col(sum_col) / F.col(n_col)), digits
    )


_SUMS = {"age": "age", "wbc": "wbc", "hgb": "hgb", "severity_score": "score"}
_MEANS: dict[str, dict[str, tuple[str, str, int]]] = {
    name: {out: (f"sum_{_SUMS[c]}", f"n_{_SUMS[c]}", digits) for out, c, digits in t.means}
    for name, t in TABLES.items()
}
_EXTRA = {name: {"severe_cases": "severe"} for name, t in TABLES.items() if t.severe}


def _table_columns(name: str) -> list[Column]:
    cols = [F.col(k) for k in GRAINS[name]]
    cols.append(F.col("n").alias(TABLES[name].count))
    cols += [_mean(*spec).alias(out) for out, spec in _MEANS.get(name, {}).items()]
    cols += [F.col(src).alias(out) for out, src in _EXTRA.get(name, {}).items()]
    return cols


def split(agg: DataFrame, ordered: bool = True) -> dict[str, DataFrame]:
    """Cut the ``aggregate_all`` result into the nine gold tables.

    ``ordered=False`` skips the sorts of the tables without a limit (for
    consumers that ignore row order); the top-10 tables always keep their
    ordered limit.
    """
    tables = {}
    for name in GRAINS:
        df = agg.filter(F.col("grain") == name).select(*_table_columns(name))
        if name in LIMITED:
            df = df.orderBy(*table_order(name)).limit(TOP_N)
        elif ordered:
            df = df.orderBy(*table_order(name))
        tables[name] = df
    return tables


def stacked(agg: DataFrame) -> DataFrame:
    """All nine tables in the long form of ``stack``, straight from ``aggregate_all``.

    Every aggregate row belongs to exactly one grain, so the seven tables
    without a limit are one projection of the aggregate (a column takes its
    table's rounding, and is null for other tables); only the two top-10
    tables need their own (distributed top-k) branches.
    """
    grain = F.col("grain")
    cols = []
    for col_name, col_type in STACKED_COLUMNS:
        if col_name == "table_name":
            expr = grain
        elif col_name == "patient_count":
            expr = F.col("n")
        elif col_name in _ALL_KEYS:
            expr = F.col(col_name)
        else:
            expr = None
            for name in GRAINS:
                spec = _MEANS.get(name, {}).get(col_name)
                src = _EXTRA.get(name, {}).get(col_name)
                value = _mean(*spec) if spec else (F.col(src) if src else None)
                if value is None:
                    continue
                expr = (
                    F.when(grain == name, value)
                    if expr is None
                    else expr.when(grain == name, value)
                )
            expr = expr if expr is not None else F.lit(None)
        cols.append(expr.cast(col_type).alias(col_name))
    unlimited = agg.filter(~grain.isin(*LIMITED)).select(*cols)
    tops = split(agg, ordered=False)
    return unlimited.unionByName(stack({name: tops[name] for name in sorted(LIMITED)}))


# Column layout of the stacked (long) form of all nine tables.
STACKED_COLUMNS: list[tuple[str, str]] = [
    ("table_name", "string"),
    ("severity", "string"),
    ("age_group", "string"),
    ("gender", "string"),
    ("wbc_status", "string"),
    ("hgb_status", "string"),
    ("date", "date"),
    ("doctor_id", "int"),
    ("doctor_name", "string"),
    ("diagnosis_code", "string"),
    ("diagnosis_desc", "string"),
    ("allergy", "string"),
    ("patient_count", "bigint"),
    ("avg_age", "double"),
    ("avg_wbc", "double"),
    ("avg_hgb", "double"),
    ("avg_severity_score", "double"),
    ("severe_cases", "bigint"),
]


def stack(tables: dict[str, DataFrame]) -> DataFrame:
    """All gold tables as one long frame (``table_name`` + superset of columns)."""
    out = None
    for name, df in tables.items():
        if df is None:
            continue
        cols = []
        for col_name, col_type in STACKED_COLUMNS:
            if col_name == "table_name":
                cols.append(F.lit(name).alias("table_name"))
            elif col_name == "patient_count" and "patients_treated" in df.columns:
                cols.append(F.col("patients_treated").cast(col_type).alias(col_name))
            elif col_name == "patient_count" and "patient_per_day" in df.columns:
                cols.append(F.col("patient_per_day").cast(col_type).alias(col_name))
            elif col_name in df.columns:
                cols.append(F.col(col_name).cast(col_type).alias(col_name))
            else:
                cols.append(F.lit(None).cast(col_type).alias(col_name))
        part = df.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out
