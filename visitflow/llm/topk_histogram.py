"""Exact top-k search by distributed histogram selection.

Every (query block, candidate block) pair is scored, several times over:

* each round counts, for each query, the scores falling into equal bins of the
  range that still holds its kth best score; the counts are summed over all
  candidates and the range shrinks to the one bin that holds the kth;
* when every range is one score wide, the kth score is known exactly, and a last
  pass keeps the scores above it and, of those equal to it, the smallest ids.

No list of scores is ever stored or sorted. The state between rounds is one
histogram for each query. Queries and candidates meet in blocks: query blocks are
sent to ``columns`` groups of candidate blocks, candidate blocks to every query block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitflow.llm.common import stored
from visitflow.llm.vectors import common_length, grouped, usable

BINS = 512
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
_EXACT = float(2**53)
_STATE = "q_block long, q_ids binary, q_data binary, low binary, above binary"


def _blocks(rows: DataFrame, size: int, blocks: int) -> DataFrame:
    """(block, ids, data): about ``size`` rows a block; ids and integer components as bytes."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def packed(block: int) -> pd.DataFrame:
            parts = held.pop(block)
            ids = np.concatenate([p[0] for p in parts])
            data = np.concatenate([p[1] for p in parts])
            order = np.argsort(ids, kind="stable")
            return pd.DataFrame({"block": [block], "ids": [ids[order].tobytes()], "data": [data[order].tobytes()]})

        for (block,), piece in grouped(batches, ["block"]):
            for other in [b for b in held if b != block]:
                yield packed(other)
            data = np.stack([np.asarray(v, np.int64) for v in piece["v"]])
            held.setdefault(block, []).append((piece["id"].to_numpy(np.int64), data))
            if sum(len(p[0]) for p in held[block]) >= 2 * size:
                yield packed(block)
        for block in list(held):
            yield packed(block)

    keyed = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    dealt = keyed.repartition("block").sortWithinPartitions("block")
    return dealt.mapInPandas(build, "block int, ids binary, data binary")


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products, by floating-point products where these are exact."""
    if len(q) and len(c) and float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < _EXACT:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def _arrays(row, dim: int) -> tuple[np.ndarray, ...]:
    return (
        np.frombuffer(row.q_ids, np.int64),
        np.frombuffer(row.q_data, np.int64).reshape(-1, dim),
        np.frombuffer(row.low, np.int64),
        np.frombuffer(row.ids, np.int64),
        np.frombuffer(row.data, np.int64).reshape(-1, dim),
    )


def _count_round(pairs: DataFrame, dim: int, width: int, span: int) -> DataFrame:
    """Histograms of each query block, summed over all candidate blocks.

    Only scores in the query's range ``low .. low + span - 1`` are counted.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                q_ids, q, low, ids, c = _arrays(row, dim)
                over = _scores(q, c) - low[:, None]
                counted = (over >= 0) & (over < span) & (q_ids[:, None] != ids[None, :])
                flat = (over // width + np.arange(len(q))[:, None] * BINS)[counted]
                hist = np.bincount(flat, minlength=len(q) * BINS)
                sums[row.q_block] = sums.get(row.q_block, 0) + hist
        for q_block, hist in sums.items():
            yield pd.DataFrame({"q_block": [q_block], "hist": [hist.astype(np.int64).tobytes()]})

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for q_block, hist in zip(batch["q_block"], batch["hist"]):
                sums[q_block] = sums.get(q_block, 0) + np.frombuffer(hist, np.int64)
        for q_block, hist in sums.items():
            yield pd.DataFrame({"q_block": [q_block], "hist": [hist.tobytes()]})

    schema = "q_block long, hist binary"
    return pairs.mapInPandas(count, schema).repartition("q_block").mapInPandas(total, schema)


def _shrink(state: DataFrame, hists: DataFrame, k: int, width: int) -> DataFrame:
    """Shrink each query's range to the bin that holds its kth best score.

    ``above``: scores above the range. A query with fewer than k candidates keeps
    its lowest score's bin, so that all of them pass.
    """

    def narrow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                low, above = np.frombuffer(row.low, np.int64), np.frombuffer(row.above, np.int64)
                hist = np.frombuffer(row.hist, np.int64).reshape(len(low), BINS)
                down = hist[:, ::-1].cumsum(axis=1) + above[:, None]  # scores in this bin or above
                reached = down >= k
                lowest = BINS - 1 - (hist > 0).argmax(axis=1)
                at = np.where(reached.any(axis=1), reached.argmax(axis=1), lowest)
                above = np.where(at > 0, down[np.arange(len(low)), np.maximum(at - 1, 0)], above)
                low = low + (BINS - 1 - at) * width
                out.append((row.q_block, row.q_ids, row.q_data, low.tobytes(), above.tobytes()))
            yield pd.DataFrame(out, columns=["q_block", "q_ids", "q_data", "low", "above"])

    return state.join(hists, "q_block").mapInPandas(narrow, _STATE)


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k candidates of largest integer inner product for each query row.

    Components are taken as ``floor(scale * x)``. A candidate with the query's own id
    is not compared. Returns query_id, rank (from 1), vec_id, score; ties go to the
    smaller vec_id. Fewer than k candidates: all of them.

    Rows with a null id, a null vector, null or non-finite components, or a
    length other than the candidates' commonest take no part. Rows that repeat an id are
    separate candidates and, as queries, separate queries with ranks of their
    own. Zero vectors take part (score 0). Empty tables give an empty result.
    """
    cut = F.transform("v", lambda x: F.floor(x * scale).cast("long"))
    length = common_length(candidates, id_col, vector_col)
    c_rows = stored(usable(candidates, id_col, vector_col, length).select("id", cut.alias("v")), "topk-rows")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, dim, longest = c_rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(squares)).first()
    q_rows = usable(queries, id_col, vector_col, length).select("id", cut.alias("v"))
    q_count, q_longest = q_rows.agg(F.count(F.lit(1)), F.max(squares)).first()
    spark = candidates.sparkSession
    if not n or not q_count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    q_blocks = -(-q_count // QUERY_BLOCK)
    c_blocks = -(-n // CANDIDATE_BLOCK)
    bound = int((longest * q_longest) ** 0.5) + 2  # of any score's size, by Cauchy-Schwarz

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                low, above = (np.full(len(row.ids) // 8, x, np.int64).tobytes() for x in (-bound, 0))
                out.append((row.q_block, row.ids, row.data, low, above))
            yield pd.DataFrame(out, columns=["q_block", "q_ids", "q_data", "low", "above"])

    blocks = _blocks(q_rows, QUERY_BLOCK, q_blocks).withColumn("q_block", F.monotonically_increasing_id())
    blocks = stored(blocks.select("q_block", "ids", "data"), "topk-queries")
    state = stored(blocks.mapInPandas(start, _STATE), "topk-state")
    # Few blocks of each kind: groups of candidate blocks spread one query block's work.
    columns = max(1, min(c_blocks, -(-2 * spark.sparkContext.defaultParallelism // q_blocks)))
    c_packed = _blocks(c_rows, CANDIDATE_BLOCK, c_blocks).withColumn("column", F.col("block") % columns)
    q_names = sorted(r["q_block"] for r in state.select("q_block").collect())  # one for 1,024 queries
    c_spread = stored(c_packed.select("column", "ids", "data"), "topk-blocks").withColumn(
        "q_block", F.explode(F.lit(q_names).cast("array<bigint>"))
    )

    def pairs(state: DataFrame) -> DataFrame:
        wide = state.drop("above").withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
        return wide.repartition(q_blocks * columns, "q_block", "column").join(c_spread, ["q_block", "column"])

    span = 2 * bound + 1
    while span > 1:
        width = -(-span // BINS)
        state = stored(_shrink(state, _count_round(pairs(state), dim, width, span), k, width), "topk-state")
        span = width
    return _collect(pairs(state), dim, k)


def _collect(pairs: DataFrame, dim: int, k: int) -> DataFrame:
    """Scores above each query's kth, and of those equal to it the k smallest ids of each block."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                q_ids, q, kth, ids, c = _arrays(row, dim)
                scores = _scores(q, c)
                passed = (scores >= kth[:, None]) & (q_ids[:, None] != ids[None, :])
                equal = passed & (scores == kth[:, None])
                # ids ascend in a block, so the first k equal ones are the smallest
                passed &= ~(equal & (equal.cumsum(axis=1) > k))
                at, to = np.nonzero(passed)
                yield pd.DataFrame(
                    {"q_block": row.q_block, "at": at, "query_id": q_ids[at], "vec_id": ids[to], "score": scores[at, to]}
                )

    found = pairs.mapInPandas(keep, "q_block long, at long, query_id long, vec_id long, score long")
    best = Window.partitionBy("q_block", "at").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
