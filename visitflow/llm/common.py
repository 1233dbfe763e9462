"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitflow.session import scratch_path
from visitflow.storage import delete

#: Bytes ``[\x20\x09-\x0D]``: the white space that separates words.
SPACES = b" \t\n\v\f\r"
#: Spark SQL / RE2 pattern of one word.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once an application.

    Needed where they don't have it on their path (it was not installed on the
    cluster, nor given with ``--py-files``).
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="visitflow-code-"), "visitflow.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: later jobs read the files, also after executors are lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one run in the shared folder; ``drop`` removes them once the result is stored."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for path in self.paths:
            delete(self.spark, path)
        self.paths = []


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Rows whose label must not be learned: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def bounded_sample(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """The ``n`` rows of smallest ``xxhash64(keys)``; ties by the keys.

    On a large table a threshold on the hash, chosen from the row count, lets about
    ``2 n`` rows through before they are ordered, so no partition sends its own
    ``n``. (Fewer than ``n`` pass with a chance of less than 1 in 10**40 for n >= 400.)
    """
    at = F.xxhash64(*keys)
    total = rows.count()
    if total > 4 * n:
        rows = rows.where(at < int(2 * n / total * 2**64) - 2**63)
    return rows.orderBy(at, *keys).limit(n)


#: Bytes of text in a labelled sample, at most (one row's text may go beyond).
SAMPLE_BYTES = 64 << 20


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_bytes: int = SAMPLE_BYTES
) -> DataFrame:
    """(doc_id, text, label) of labelled rows that may be learned from: at most ``max_rows``, ``max_bytes`` of text.

    The rows are those with the smallest ``xxhash64(doc_id)`` among the ids that
    ``docs`` holds, and of these the first by a hash of id and text, so a sample does not
    depend on partitioning, and labels of absent documents take no room in it. Rows that
    repeat an id are rows of their own and count. A doc_id labelled twice counts with its
    larger label; null ids and null labels are left out. The sampled ids are bounded, so
    the join broadcasts them; the bounds hold after it.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("doc_id"))
        .agg(F.max(F.col(label).cast("int")).alias("label"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(bounded_sample(ids, max_rows, "doc_id")), "doc_id")
    rows = rows.withColumn("_at", F.xxhash64("doc_id", "text"))
    first = rows.orderBy("_at", "doc_id", "text").limit(max_rows)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    upto = F.sum(size).over(Window.orderBy("_at", "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0))
    return first.withColumn("_upto", upto - size).where(F.col("_upto") < max_bytes).select("doc_id", "text", "label")


# ------------------------------------------------------------------ text as bytes


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[ends[0] : ends[-1]], ends - ends[0]


def slices(offsets: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``max_bytes`` bytes, one row at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True


def word_spans(
    body: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word of the rows' bytes, in order; ``space`` says which bytes separate words."""
    if len(body) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~space[body]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    # A row's edge also ends a word.
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(body))]
    begins[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: random byte codes in a polynomial modulo 2**64, then mixed.

    The polynomial is evaluated by Horner's rule over all words at once, one
    character position at a time; the words still long enough are the only ones
    touched, so the work is one step a byte.
    """
    out = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    short = not len(lengths) or int(lengths.max()) < 1 << 16
    order = np.argsort((65535 - lengths).astype(np.uint16) if short else -lengths, kind="stable")  # longest first
    lengths = lengths[order]
    at = starts[order]
    acc = np.zeros(len(starts), np.uint64)
    live = len(starts)
    step = 0
    longest = int(lengths[0]) if len(lengths) else 0
    while step < longest:
        live = int(np.searchsorted(-lengths, -step, "left"))  # words longer than step
        if live < 64 and longest - step > 64:
            break
        acc[:live] = acc[:live] * _MULTIPLIER + _BYTE_CODES[body[at[:live] + step]]
        step += 1
    if step < longest:  # a few very long words: one at a time, over their own bytes
        for i in range(live):
            rest = _BYTE_CODES[body[at[i] + step : at[i] + lengths[i]]]
            powers = np.ones(len(rest) + 1, np.uint64)
            powers[1:] = _MULTIPLIER
            powers = np.cumprod(powers, dtype=np.uint64)
            acc[i] = acc[i] * powers[-1] + (rest * powers[-2::-1]).sum(dtype=np.uint64)
    out[order] = mix64(acc + lengths.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return out
