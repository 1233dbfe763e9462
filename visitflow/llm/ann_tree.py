"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (``sample_rows``) of distinct unit vectors; its
size is bounded by the sample, so it goes to the tasks with the code. Every row is
then indexed: each distinct vector walks down to one leaf. Runs of leaves make cells of
a bounded size; a query is sent to the cells of the leaves that it visits, where one task
holds the vectors and lets the queries pass.

A query keeps a priority queue of branches by their centre's distance. It opens
the nearest, pushes its children, and goes on until it has visited ``visits`` leaves.
``visits`` is widened on sample vectors until their true neighbours are found with
``target_recall``; that is the calibration. These vectors are set aside before the tree is
fitted, except from a sample too small to spare them.

Rows with equal vectors form one class that carries its ``k + 1`` smallest ids; no
more can be among a query's k nearest. A vector that a third of all rows share is
thus one entry of one leaf.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitflow.llm.common import bounded_sample, mix64, stored
from visitflow.llm.vectors import common_length, grouped, usable

SAMPLE_ROWS = 20_000
BRANCHES = 8
LEAF_SAMPLE = 64
TARGET_RECALL = 0.97
CALIBRATION_QUERIES = 256
#: Queries, and vectors of a leaf, that are multiplied at once.
BLOCK = 1024
#: A cell's vectors, as they are and as unit vectors: what a task holds.
CELL_BYTES = 128 << 20
#: Cells for each core, if there are vectors enough.
CELLS_A_TASK = 4
#: Vectors of the pairs that are scored in double precision at once, on either side.
PAIR_BYTES = 4 << 20


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two (exact), so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) if len(x) else x


def unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@dataclass
class Tree:
    """Nodes by number, 0 the root: children and their centres, or a leaf's number."""

    children: list[np.ndarray]
    centres: list[np.ndarray]
    leaf: list[int]
    leaves: int

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each unit vector walks down to."""
        node = np.zeros(len(x), np.int64)
        moving = np.arange(len(x))
        while len(moving):
            for at in np.unique(node[moving]):
                here = moving[node[moving] == at]
                if self.leaf[at] < 0:
                    node[here] = self.children[at][(x[here] @ self.centres[at].T).argmax(axis=1)]
            moving = moving[[self.leaf[at] < 0 for at in node[moving]]]
        return np.array([self.leaf[at] for at in node], np.int64)

    def visit(self, q: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves that best-bin-first search opens for one unit vector."""
        queue, found = [(0.0, 0)], []
        while queue and len(found) < visits:
            _, at = heapq.heappop(queue)
            if self.leaf[at] >= 0:
                found.append(self.leaf[at])
            else:
                near = -(self.centres[at] @ q)
                for child, distance in zip(self.children[at].tolist(), near.tolist()):
                    heapq.heappush(queue, (distance, child))
        return found


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centres, and each row's centre."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres, (x @ centres.T).argmax(axis=1)


def fit_tree(sample: np.ndarray, branches: int = BRANCHES, leaf_rows: int = LEAF_SAMPLE, seed: int = 3) -> Tree:
    """Split unit vectors by k-means until a node holds ``leaf_rows`` or can't be split."""
    rng = np.random.default_rng(seed)
    tree = Tree([], [], [], 0)

    def grow(x: np.ndarray) -> int:
        at = len(tree.leaf)
        tree.children.append(np.zeros(0, np.int64))
        tree.centres.append(np.zeros((0, x.shape[1])))
        tree.leaf.append(-1)
        if len(x) > leaf_rows:
            centres, nearest = _k_means(x, min(branches, len(x)), rng)
            used = np.unique(nearest)
            if len(used) > 1:
                tree.centres[at] = centres[used]
                tree.children[at] = np.array([grow(x[nearest == c]) for c in used], np.int64)
                return at
        tree.leaf[at] = tree.leaves
        tree.leaves += 1
        return at

    grow(sample)
    return tree


def set_aside(sample: np.ndarray, queries: int) -> tuple[np.ndarray | None, np.ndarray]:
    """About ``queries`` rows to calibrate with, and the rest; none if they are a quarter of the sample or more."""
    if len(sample) <= 4 * queries:
        return None, sample
    held = np.zeros(len(sample), bool)
    held[:: len(sample) // queries] = True
    return sample[held], sample[~held]


def calibrate(
    tree: Tree, sample: np.ndarray, k: int, target: float, queries: int, held: np.ndarray | None = None
) -> int:
    """The fewest leaf visits that find ``target`` of the true neighbours in the sample.

    The queries are ``held``, or about ``queries`` rows of the sample itself.
    """
    chosen = sample[:: max(1, len(sample) // queries)] if held is None else held
    leaf = tree.descend(sample)
    skip = int(held is None)  # the query itself
    order = np.argsort(-(chosen @ sample.T), axis=1)[:, skip : k + skip]
    needed = []
    for q, near in zip(chosen, order):
        place = {at: i + 1 for i, at in enumerate(tree.visit(q, tree.leaves))}
        needed += [place[at] for at in leaf[near].tolist()]
    if not needed:
        return tree.leaves
    needed.sort()
    return needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]


def dealt_cells(tree: Tree, sample: np.ndarray, rows: int, most: int) -> list[range]:
    """The cells of each leaf, which hold about ``most`` rows: runs of leaves, or a part of one larger leaf.

    How many of the table's ``rows`` a leaf has is estimated from the sample.
    """
    expected = np.bincount(tree.descend(sample), minlength=tree.leaves) * (rows / len(sample))
    cells, at, load = [], 0, 0.0
    for n in expected.tolist():
        if load and load + n > most:
            at, load = at + 1, 0.0
        parts = max(1, int(np.ceil(n / most)))
        cells.append(range(at, at + parts))
        at, load = (at + parts, 0.0) if parts > 1 else (at, load + n)
    return cells


def _coded(rows: DataFrame, kind: str, most: int | None = None) -> DataFrame:
    """(id, b): ``v``'s components as bytes of ``kind``; of a batch's rows with equal vectors the ``most`` smallest ids."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(kind) + 0.0  # no negative zeros
                x = x.reshape(batch.num_rows, -1)
                frame = pd.DataFrame({"id": batch.column("id").to_numpy(), "b": [y.tobytes() for y in x]})
                frame = frame.drop_duplicates().sort_values("id")
                if most is not None:
                    frame = frame[frame.groupby("b").cumcount() < most]
                columns = [pa.array(frame["id"], pa.int64()), pa.array(frame["b"], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "b"])

    return rows.select("id", "v").mapInArrow(code, "id long, b binary")


def _decoded(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


class Best:
    """The ``most`` best candidates of each query so far, by score and then by number."""

    def __init__(self, queries: int, most: int):
        self.score = np.full((queries, most), -np.inf)
        self.number = np.full((queries, most), np.iinfo(np.int64).max)

    def add(self, at: np.ndarray, number: np.ndarray, score: np.ndarray) -> None:
        rows, place = np.unique(at, return_inverse=True)
        most = self.score.shape[1]
        place = np.concatenate([np.repeat(np.arange(len(rows)), most), place])
        score = np.concatenate([self.score[rows].ravel(), score])
        number = np.concatenate([self.number[rows].ravel(), number])
        order = np.lexsort((number, -score, place))
        place = place[order]
        first = order[np.arange(len(place)) - np.searchsorted(place, place) < most]
        self.score[rows] = score[first].reshape(-1, most)
        self.number[rows] = number[first].reshape(-1, most)

    def offer(self, at: np.ndarray, q: Block, c: Block) -> None:
        """Take what is better among the candidates ``c`` for ``q``, which are the queries ``at``.

        Products in single precision tell which pairs may be; these are scored in double precision.
        """
        most, dim = self.score.shape[1], q.raw.shape[1]
        slack = np.float32((dim + 16) * 2.0**-24)  # bounds the rounding of a product of unit vectors
        near = q.unit @ c.unit.T
        least = self.score[at, -1].astype(np.float32) - slack
        hot = np.flatnonzero(near.max(axis=1) >= least)
        if not len(hot):
            return
        near, least = near[hot], least[hot]
        passed = near >= least[:, None]
        full = np.flatnonzero(np.count_nonzero(passed, axis=1) > most)
        if len(full):
            some = near[full]
            passed[full] = some >= np.maximum(least[full], np.partition(some, -most, axis=1)[:, -most] - 2 * slack)[:, None]
        of, to = np.nonzero(passed)
        of = hot[of]
        step = max(1, PAIR_BYTES // (8 * dim))
        for i in range(0, len(of), step):
            x, y = of[i : i + step], to[i : i + step]
            self.add(at[x], c.number[y], cosine(q.raw[x].astype(np.float64), c.raw[y].astype(np.float64)))


@dataclass
class Block:
    """Vectors by number, as they are and as unit vectors in single precision."""

    number: np.ndarray
    raw: np.ndarray
    unit: np.ndarray

    @classmethod
    def of(cls, piece: pd.DataFrame, kind: str) -> Block:
        raw = _decoded(piece["b"], kind)
        return cls(piece["key"].to_numpy(np.int64), raw, unit(raw.astype(np.float64)).astype(np.float32))

    def __getitem__(self, at) -> Block:
        return Block(self.number[at], self.raw[at], self.unit[at])

    @staticmethod
    def joined(parts: list[Block]) -> Block:
        return Block(*(np.concatenate(x) for x in zip(*((p.number, p.raw, p.unit) for p in parts))))


def best_of(queries: Block, visited: np.ndarray, stocks: dict[int, list[Block]], most: int) -> Best:
    """The ``most`` best candidates of each query, in those leaves of ``stocks`` that it visits.

    ``visited``: by query and leaf. ``stocks``: each leaf's vectors, in parts, which are joined here.
    """
    best = Best(len(queries.number), most)
    for leaf, parts in stocks.items():
        if len(parts) > 1:
            parts[:] = [Block.joined(parts)]
        who = np.flatnonzero(visited[:, leaf])
        for i in range(0, len(who), BLOCK):
            at = who[i : i + BLOCK]
            asked = queries[at]
            for j in range(0, len(parts[0].number), BLOCK):
                best.offer(at, asked, parts[0][j : j + BLOCK])
    return best


def _is_float(rows: DataFrame, vector_col: str) -> bool:
    return rows.schema[vector_col].dataType.simpleString() == "array<float>"


def search(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    target_recall: float = TARGET_RECALL,
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = 3,
) -> DataFrame:
    """The k nearest candidates found for each query, by cosine in double precision.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id.
    A candidate with the query's own id is left out. At most k candidates in all: all
    of them.

    Rows with a null id, a vector that is null, zero, of another length than the
    candidates' commonest, or holding null or non-finite components take no part. Rows that
    repeat a query's id and vector are one query. Empty tables give an empty result.

    No join here may be broadcast: Spark sizes arrays and exploded rows far too low.
    """
    spark = candidates.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    nonzero = F.exists("v", lambda x: x != 0)
    length = common_length(candidates, id_col, vector_col)
    kind = "f4" if _is_float(candidates, vector_col) and _is_float(queries, vector_col) else "f8"
    rows = _coded(usable(candidates, id_col, vector_col, length).where(nonzero), kind, k + 1)
    # Classes of equal vectors with their k + 1 smallest ids; the window keeps no more.
    first = Window.partitionBy("b").orderBy("id")
    classes = stored(
        rows.withColumn("at", F.dense_rank().over(first))
        .where(F.col("at") <= k + 1)
        .groupBy("b")
        .agg(F.sort_array(F.collect_set("id")).alias("ids"))
        .withColumn("c", F.element_at("ids", 1)),
        "ann-classes",
    )
    wanted = _coded(usable(queries, id_col, vector_col, length).where(nonzero), kind)
    wanted = stored(wanted.distinct(), "ann-queries")
    asked = stored(wanted.groupBy("b").agg(F.min("id").alias("q")), "ann-asked")
    drawn = bounded_sample(classes, sample_rows, "c").select("b").toPandas()
    if not len(drawn):
        return spark.createDataFrame([], schema)
    held, sample = set_aside(unit(_decoded(drawn["b"], kind).astype(np.float64)), CALIBRATION_QUERIES)
    tree = fit_tree(sample, seed=seed)
    visits = calibrate(tree, sample, k, target_recall, CALIBRATION_QUERIES, held)
    total, tasks = classes.count(), spark.sparkContext.defaultParallelism
    leaves, width = tree.leaves, sample.shape[1] * (np.dtype(kind).itemsize + 4)
    cells = dealt_cells(tree, sample, total, max(1, min(CELL_BYTES // width, -(-total // (CELLS_A_TASK * tasks)))))
    parts = np.array([len(x) for x in cells])
    start = np.array([x[0] for x in cells])

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                leaf = tree.descend(unit(_decoded(batch["b"], kind).astype(np.float64)))
                mixed = mix64(batch["key"].to_numpy(np.int64).view(np.uint64))
                part = (mixed % parts[leaf].astype(np.uint64)).astype(np.int64)
                yield batch[["key", "b"]].assign(cell=start[leaf] + part, leaf=leaf)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                into, visited = [], np.zeros((len(batch), leaves), bool)
                for i, q in enumerate(unit(_decoded(batch["b"], kind).astype(np.float64))):
                    found = tree.visit(q, visits)
                    visited[i, found] = True
                    into.append(sorted({cell for leaf in found for cell in cells[leaf]}))
                packed = [x.tobytes() for x in np.packbits(visited, axis=1)]
                yield batch[["key", "b"]].assign(cells=into, visited=packed)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, stocks = None, {}
        for (cell, asks, leaf), piece in grouped(batches, ["cell", "asks", "leaf"]):
            if cell != held:
                held, stocks = cell, {}
            if not asks:
                stocks.setdefault(leaf, []).append(Block.of(piece, kind))
                continue
            visited = np.unpackbits(_decoded(piece["visited"], "u1"), axis=1, count=leaves).view(bool)
            asked = Block.of(piece, kind)
            best = best_of(asked, visited, stocks, k + 1)
            at, to = np.nonzero(best.score > -np.inf)
            yield pd.DataFrame({"q": asked.number[at], "c": best.number[at, to], "score": best.score[at, to]})

    # A cell's candidates come first, by leaf; its queries follow, one vector a row, and meet them in the task.
    leafed = classes.select(F.col("c").alias("key"), "b").mapInPandas(index, "key long, b binary, cell long, leaf long")
    leafed = leafed.withColumn("asks", F.lit(False)).withColumn("visited", F.lit(None).cast("binary"))
    routed = asked.select(F.col("q").alias("key"), "b").repartition(CELLS_A_TASK * tasks)
    routed = routed.mapInPandas(route, "key long, b binary, cells array<long>, visited binary")
    routed = routed.select("key", "b", F.explode("cells").alias("cell"), "visited")
    routed = routed.withColumn("asks", F.lit(True)).withColumn("leaf", F.lit(-1).cast("long"))
    met = leafed.unionByName(routed).repartition(2 * (cells[-1][-1] + 1), "cell")
    met = met.sortWithinPartitions("cell", "asks", "leaf")
    scored = met.mapInPandas(nearest, "q long, c long, score double")
    # A class's best k + 1 are enough for any query of it, whose own id may be among them.
    by_class = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    best = scored.withColumn("at", F.row_number().over(by_class)).where(F.col("at") <= k + 1)
    best = best.hint("merge").join(classes.select("c", "ids"), "c")
    best = stored(best.select("q", "score", F.explode("ids").alias("vec_id")), "ann-best")
    trimmed = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("at", F.row_number().over(trimmed)).where(F.col("at") <= k + 1)
    named = wanted.hint("merge").join(asked, "b").select("q", F.col("id").alias("query_id"))
    ranked = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (
        named.hint("merge")
        .join(best.drop("at"), "q")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of row pairs; each row is summed alone, so equal pairs get equal scores."""
    a, b = _scaled(a), _scaled(b)
    dot, aa, bb = (np.multiply(x, y).sum(axis=1) for x, y in ((a, b), (a, a), (b, b)))
    return dot / (np.sqrt(aa) * np.sqrt(bb))
