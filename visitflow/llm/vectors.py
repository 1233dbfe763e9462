"""Blocks of vectors: what the two searches over ``embeddings`` share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _finite(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
    )
    return rows.where(~bad)


def common_length(rows: DataFrame, id_col: str, vector_col: str) -> int:
    """The commonest length among the vectors that can be compared (the shorter on a tie); 0 if there are none."""
    sizes = _finite(rows, id_col, vector_col).groupBy(F.size("v").alias("d")).count()
    first = sizes.orderBy(F.desc("count"), "d").first()
    return first["d"] if first else 0


def usable(rows: DataFrame, id_col: str, vector_col: str, length: int | None = None) -> DataFrame:
    """(id, v): rows that can be compared, ``v`` an array of doubles.

    Left out: null ids, null vectors, vectors holding null or non-finite components, and
    vectors not of ``length``: that of the candidates, also for queries (by default the
    commonest of ``rows`` themselves).
    """
    length = common_length(rows, id_col, vector_col) if length is None else length
    return _finite(rows, id_col, vector_col).where(F.size("v") == length)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column]) if len(column) else np.zeros((0, 0))


def grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Runs of equal keys in rows that arrive sorted by them, piece by piece.

    A run that spans batches comes as several pieces, so no run is held whole.
    """
    for batch in batches:
        if len(batch):
            for key, piece in batch.groupby(keys, sort=False):
                yield key, piece
