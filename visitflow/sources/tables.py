"""Readers for the silver and gold tables, always with an explicit schema.

An explicit schema skips the inference scan (a full extra pass over silver in
the reference) and keeps column types stable. Missing input raises
``MissingInputError`` instead of returning a silently empty frame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from visitflow.schema import GOLD_SCHEMAS, SILVER_SCHEMA
from visitflow.sinks.versions import FolderVersions
from visitflow.storage import exists, names


class MissingInputError(RuntimeError):
    """The input table does not exist or holds no rows."""


def _path_missing(exc: AnalysisException) -> bool:
    cond = (exc.getCondition() or "") if hasattr(exc, "getCondition") else ""
    return cond == "PATH_NOT_FOUND" or "Path does not exist" in str(exc)


def _silver_schema() -> StructType:
    return StructType(
        [f for f in SILVER_SCHEMA.fields if f.name != "age_group"]
        + [StructField("age_group", StringType(), True)]
    )


def read_silver(
    spark: SparkSession, path: str, fmt: str = "parquet", require_rows: bool = False
) -> DataFrame:
    """Silver table written by the silver sinks (partition columns are discovered).

    ``age_group`` (and ``stream`` and ``batch_id`` for the stream sink) come back as
    partition columns; their types are pinned by the schema. A Parquet table written
    without ``timestamp`` (its files say so) comes back without it, and gold then has
    no daily table; JSON lines name no columns, so there a missing field is null.
    """
    schema = _silver_schema()
    names = SILVER_SCHEMA.fieldNames()
    try:
        df = spark.read.schema(schema).option("basePath", path).format(fmt).load(path)
        df.schema  # resolve now, so a missing path fails here
        if fmt == "parquet" and _lacks(spark, path, "timestamp"):
            names = [n for n in names if n != "timestamp"]
    except AnalysisException as exc:
        if _path_missing(exc):
            raise MissingInputError(f"silver table not found at {path}") from exc
        raise
    if require_rows and df.isEmpty():
        raise MissingInputError(f"silver table at {path} has no rows")
    return df.select(*names)


def _lacks(spark: SparkSession, path: str, column: str) -> bool:
    """Whether a Parquet table's footer has no such column (no files at all: it isn't lacking)."""
    try:
        return column not in spark.read.option("basePath", path).parquet(path).columns
    except AnalysisException as exc:
        if exc.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return False
        raise


def committed_batches(
    spark: SparkSession, path: str, known: Callable[[str, int], bool] = lambda stream, number: False
) -> list[tuple[str, int]]:
    """(stream, batch number) of every batch that a ``SilverBatchSink`` has committed under ``path``.

    Folder names only, one listing a stream; a batch without its ``_SUCCESS`` isn't there yet.
    Those that are ``known`` are left out without a look at them.
    """
    found = []
    for folder in names(spark, path):
        if folder.startswith("stream="):
            stream = folder.removeprefix("stream=")
            batches = [n for n in names(spark, f"{path}/{folder}") if n.startswith("batch_id=")]
            new = [n for n in sorted(int(b.removeprefix("batch_id=")) for b in batches) if not known(stream, n)]
            found += [(stream, n) for n in new if exists(spark, f"{path}/{folder}/batch_id={n}/_SUCCESS")]
    return found


def read_silver_batches(spark: SparkSession, path: str, batches: list[tuple[str, int]], fmt: str = "parquet") -> DataFrame:
    """The rows of the named batches alone."""
    paths = [f"{path}/stream={stream}/batch_id={number}" for stream, number in batches]
    df = spark.read.schema(_silver_schema()).option("basePath", path).format(fmt).load(paths)
    return df.select(*SILVER_SCHEMA.fieldNames())


def read_silver_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """The silver table as a stream of its new files (for incremental gold).

    Each trigger picks up only files added since the last one, so a live gold
    query over this stream never re-reads the whole table. A silver table that
    isn't there raises ``MissingInputError``, as in batch.
    """
    if not exists(spark, path):
        raise MissingInputError(f"silver table not found at {path}")
    reader = spark.readStream.schema(_silver_schema()).option("basePath", path).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(*SILVER_SCHEMA.fieldNames())


def read_gold(
    spark: SparkSession,
    root: str,
    tables: list[str] | None = None,
    fmt: str = "json",
    keep_empty: bool = False,
) -> dict[str, DataFrame]:
    """Gold tables under ``root/<table>``; tables that are absent are left out.

    Part files of a table are read together (one multi-file scan). Tables without
    rows are left out, too, unless ``keep_empty``. If tables were published under
    ``root`` as versions, all come from the version that is current now.
    """
    root = FolderVersions(root).current(spark) or root
    found: dict[str, DataFrame] = {}
    for name in tables or list(GOLD_SCHEMAS):
        path = f"{root.rstrip('/')}/{name}"
        try:
            df = spark.read.schema(GOLD_SCHEMAS[name]).format(fmt).load(path)
            df.schema
        except AnalysisException as exc:
            if _path_missing(exc):
                continue
            raise
        if keep_empty or not df.isEmpty():
            found[name] = df
    return found
