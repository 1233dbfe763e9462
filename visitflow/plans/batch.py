"""Batch plans: bronze -> silver table, silver -> nine gold tables -> report.

``write_gold_tables`` computes all nine tables from one scan of silver (one
GROUPING SETS aggregate), writes that aggregate by table under
``spark.checkpoint.dir``, cuts the nine tables from it and removes it; the
reference scans silver eighteen times (nine writes plus nine recounts). Row
counts come from observations on the writes, not from recounts.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from visitflow.operators import gold, report, silver
from visitflow.schema import GOLD_SCHEMAS
from visitflow.sinks.files import publish_tables, write_partitioned, write_tables
from visitflow.session import scratch_path
from visitflow.sources.tables import MissingInputError, read_gold, read_silver
from visitflow.storage import delete, exists
from visitflow.streaming.upsert import merge_batches, read_store

log = logging.getLogger(__name__)



def build_silver(bronze: DataFrame, dedupe: str = "before_validation") -> DataFrame:
    """Decoded bronze rows -> silver rows (see ``operators.silver.clean``)."""
    return silver.clean(bronze, dedupe=dedupe)


def write_silver(
    silver_df: DataFrame, path: str, fmt: str = "parquet", files: int | None = None
) -> None:
    """Append batch silver rows under ``path/age_group=<band>/``.

    Use a different root than the stream sink (which adds ``batch_id=<n>/``
    above the band), so partition discovery sees one layout per table.
    """
    write_partitioned(silver_df, path, fmt=fmt, mode="append", files=files)


def build_gold(silver_df: DataFrame, one_pass: bool = True) -> dict[str, DataFrame]:
    """The nine gold tables (``daily_trends`` only when silver has ``timestamp``).

    With ``one_pass`` the tables are cut from one GROUPING SETS aggregate; when
    several of them are executed, store the aggregate first (as
    ``write_gold_tables`` does) so silver is scanned once.
    """
    if not one_pass:
        tables = {name: fn(silver_df) for name, fn in gold.BUILDERS.items()}
        return {k: v for k, v in tables.items() if v is not None}
    return _only(gold.split(gold.aggregate_all(silver_df)), silver_df)


def _only(tables: dict[str, DataFrame], silver_df: DataFrame) -> dict[str, DataFrame]:
    return {name: tables[name] for name in gold.available(silver_df)}


def write_gold_tables(
    silver_df: DataFrame, root: str, fmt: str = "json", one_pass: bool = True, versioned: bool = False
) -> dict[str, int]:
    """Build and write all gold tables; returns rows written per table.

    ``versioned`` publishes them together as one version of ``root``; otherwise each table
    replaces its old one by itself.
    """
    if not one_pass:
        return _write_all(build_gold(silver_df, one_pass=False), root, fmt, versioned=versioned)
    spark = silver_df.sparkSession
    path = scratch_path(spark, "gold-aggregate")
    try:
        agg = gold.store_aggregate(gold.aggregate_all(silver_df), path)
        tables = _only(gold.split(agg, ordered=False), silver_df)
        return _write_all(tables, root, fmt, gold.stored_sizes(agg), versioned)
    finally:
        delete(spark, path)


def _write_all(
    tables: dict[str, DataFrame], root: str, fmt: str, sizes: dict[str, int] | None = None, versioned: bool = False
) -> dict[str, int]:
    orders = {n: gold.table_order(n) for n in tables if n not in gold.LIMITED} if sizes else {}
    write = publish_tables if versioned else write_tables
    return write(tables, root, fmt=fmt, orders=orders, sizes=sizes)


def run_gold(
    spark: SparkSession, silver_path: str, gold_root: str, silver_fmt: str = "parquet", versioned: bool = False
) -> dict[str, int]:
    """The gold job: read silver (must exist and hold rows), write nine tables (``versioned``: together)."""
    silver_df = read_silver(spark, silver_path, fmt=silver_fmt, require_rows=True)
    return write_gold_tables(silver_df, gold_root, versioned=versioned)


def run_gold_incremental(
    spark: SparkSession, silver_path: str, store: str, gold_root: str, buckets: int = 64, versioned: bool = False
) -> dict[str, int]:
    """The gold job without a rescan: add the new silver batches to the stored sums, then write nine tables.

    ``silver_path`` is the table of the silver sink. What is read grows with the new batches and
    the number of groups, not with silver. Nothing new: the tables are left as they are.
    """
    if not exists(spark, silver_path):
        raise MissingInputError(f"silver table not found at {silver_path}")
    if not merge_batches(spark, silver_path, store, buckets):
        return {}
    agg = read_store(spark, store)
    return _write_all(gold.split(agg, ordered=False), gold_root, "json", gold.stored_sizes(agg), versioned)


REPORT_TABLES = ("kpi_summary", "gender_share", "severity_risk", "top_doctors_labelled",
                 "age_group_numeric", "chart_series")


def _loaded(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    """Written gold tables; one that isn't there is empty.

    If some tables exist but one the KPIs need doesn't, the gold job is at work or has
    failed: that is an error, not a report of zeros.
    """
    tables = read_gold(spark, gold_root)
    absent = [n for n in ("age_group_summary", "gender_summary") if n not in tables]
    if tables and absent:
        raise MissingInputError(f"gold tables missing under {gold_root}: {', '.join(absent)}")
    if absent:
        log.warning("no gold tables under %s: the report is empty", gold_root)
    return {n: tables[n] if n in tables else spark.createDataFrame([], GOLD_SCHEMAS[n]) for n in GOLD_SCHEMAS}


def report_tables(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    """The data behind the dashboard, from written gold tables (no tables at all -> empty)."""
    tables = _loaded(spark, gold_root)
    return {
        "kpi_summary": report.kpi_summary(tables["age_group_summary"], tables["gender_summary"]),
        "gender_share": report.gender_share(tables["gender_summary"]),
        "severity_risk": report.severity_risk(tables["age_group_summary"]),
        "top_doctors_labelled": report.labelled(tables["top_doctors"]),
        "age_group_numeric": report.numeric_view(tables["age_group_summary"]),
        "chart_series": report.chart_series(tables),
    }


def write_report(spark: SparkSession, gold_root: str, report_root: str, fmt: str = "json") -> None:
    """Write the report tables, one small file each (overwriting the previous ones)."""
    write_tables(report_tables(spark, gold_root), report_root, fmt=fmt)


def kpis_from_gold(spark: SparkSession, gold_root: str) -> DataFrame:
    """KPI row from written gold tables (zeros if there are none at all)."""
    tables = _loaded(spark, gold_root)
    return report.kpi_summary(tables["age_group_summary"], tables["gender_summary"])


__all__ = [
    "MissingInputError",
    "build_gold",
    "build_silver",
    "kpis_from_gold",
    "report_tables",
    "write_report",
    "run_gold",
    "run_gold_incremental",
    "write_gold_tables",
    "write_silver",
]
