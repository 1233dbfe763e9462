"""Tables published as numbered versions.

A version is one small JSON file under ``<root>/_versions``, written whole or not at all;
the highest number is current. It names the data folders that make up the table, which
are never changed after a version names them, so a reader holds one consistent state from
the version it has read. What it also holds (the batches merged so far, a watermark)
becomes true in the same instant as the data.

``KeyedTable`` is a table of one row per key in buckets by the key's hash. Writing changed keys
rewrites the buckets that hold them; all other buckets stay the files they are.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitflow.storage import delete, names, read_text, write_once

#: Versions kept behind the current one, for readers that still hold them.
KEPT_VERSIONS = 2


class Versions:
    """The numbered versions of one table: state by number, the highest is current."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.folder = f"{self.root}/_versions"

    def numbers(self, spark: SparkSession) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in names(spark, self.folder) if n.endswith(".json") and n[0] != "_")

    def read(self, spark: SparkSession, number: int) -> dict:
        return json.loads(read_text(spark, f"{self.folder}/{number}.json"))

    def current(self, spark: SparkSession) -> tuple[int, dict]:
        """(number, state); (0, {}) before the first version."""
        numbers = self.numbers(spark)
        return (numbers[-1], self.read(spark, numbers[-1])) if numbers else (0, {})

    def publish(self, spark: SparkSession, number: int, state: dict) -> None:
        """Make ``state`` current. Another writer with the same number is an error, not a lost update."""
        write_once(spark, f"{self.folder}/{number}.json", json.dumps(state))

    def retire(self, spark: SparkSession, data: str, in_use: Callable[[dict], set[str]]) -> None:
        """Delete old versions, and the folders under ``data`` that no kept version uses."""
        numbers = self.numbers(spark)
        kept = set().union(*(in_use(self.read(spark, n)) for n in numbers[-1 - KEPT_VERSIONS :]))
        for number in numbers[: -1 - KEPT_VERSIONS]:
            delete(spark, f"{self.folder}/{number}.json")
        for folder in names(spark, data):
            if folder not in kept and not folder.startswith("_"):
                delete(spark, f"{data}/{folder}")


class FolderVersions:
    """Whole folders published one after another: readers follow the pointer to the current one."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.versions = Versions(self.root)

    def current(self, spark: SparkSession) -> str | None:
        """The current folder, or None before the first one."""
        number, state = self.versions.current(spark)
        return f"{self.root}/{state['folder']}" if number else None

    def write(self, spark: SparkSession, fill: Callable[[str], dict]) -> dict:
        """Let ``fill`` write a new folder and make it current; what ``fill`` returns is kept with it.

        Until then readers see the folder before; what a failed run has left is removed first.
        """
        number = self.versions.current(spark)[0] + 1
        folder = f"data/v={number}"
        delete(spark, f"{self.root}/{folder}")
        notes = fill(f"{self.root}/{folder}")
        self.versions.publish(spark, number, {"folder": folder, "notes": notes})
        self.versions.retire(spark, f"{self.root}/data", lambda s: {s["folder"].rpartition("/")[2]})
        return notes


def newest(keys: Sequence[str], values: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Of the rows of a key, the one that came last replaces the others."""

    def combine(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*values), "__turn").alias("last")
        return rows.groupBy("bucket", *keys).agg(last).select("bucket", *keys, "last.*")

    return combine


def added(keys: Sequence[str], values: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """The rows of a key add up."""

    def combine(rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket", *keys).agg(*[F.sum(v).alias(v) for v in values])

    return combine


class KeyedTable:
    """One row per key, in ``buckets`` folders by the key's hash. Null keys are keys."""

    def __init__(self, root: str, schema: StructType, keys: Sequence[str], buckets: int = 64):
        self.root, self.schema, self.keys, self.buckets = root.rstrip("/"), schema, list(keys), buckets
        self.versions = Versions(self.root)
        self.data = f"{self.root}/data"

    def paths(self, state: dict, only: set[int] | None = None) -> list[str]:
        """Folders of the (named) buckets in a version."""
        held = state.get("buckets", {}).items()
        return [f"{self.data}/v={v}/bucket={b}" for b, v in held if only is None or int(b) in only]

    def read(self, spark: SparkSession, state: dict | None = None, only: set[int] | None = None) -> DataFrame:
        """The table (or its buckets ``only``) as the version ``state`` has it; by default the current one."""
        state = self.versions.current(spark)[1] if state is None else state
        paths = self.paths(state, only)
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def write(
        self, changed: DataFrame, combine: Callable[[DataFrame], DataFrame], notes: dict, count: int | None = None
    ) -> set[int]:
        """Combine ``changed`` into the table and publish it with ``notes``; returns the buckets rewritten.

        ``changed`` is evaluated once. ``combine`` gets the old and the new rows of the buckets that
        hold changed keys, with ``bucket`` and ``__turn`` (0 old, 1 new), and returns a row for each key.
        """
        spark = changed.sparkSession
        number, state = self.versions.current(spark)
        number += 1
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        staged, columns = f"{self.root}/_staging/{number}", self.schema.fieldNames()
        kept = changed.select(*columns, bucket.alias("bucket"))
        kept.write.mode("overwrite").partitionBy("bucket").parquet(staged)
        touched = {int(n.removeprefix("bucket=")) for n in names(spark, staged) if n.startswith("bucket=")}
        held = dict(state.get("buckets", {}))
        if touched:
            new = spark.read.schema(self.schema).parquet(*[f"{staged}/bucket={b}" for b in sorted(touched)])
            rows = self.read(spark, state, touched).withColumn("__turn", F.lit(0)).unionByName(new.withColumn("__turn", F.lit(1)))
            out = combine(rows.withColumn("bucket", bucket)).repartition("bucket")
            out.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.data}/v={number}")
            held |= {str(b): number for b in touched}
        self.versions.publish(spark, number, {**state, **notes, "buckets": held})
        delete(spark, staged)
        self.versions.retire(spark, self.data, lambda s: {f"v={v}" for v in s.get("buckets", {}).values()})
        return touched
