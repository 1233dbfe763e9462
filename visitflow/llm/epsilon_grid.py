"""Embedding near-duplicates: an epsilon grid order join.

Two unit vectors have a cosine of at least ``t`` if they are at most ``eps = sqrt(2 - 2 t)``
apart. Projected on any orthonormal directions, vectors only come closer; so vectors
further apart than eps in a few leading principal directions can't link.

Order. Vectors are sorted by their grid cells (of width eps) on the leading principal
directions, cell by cell in lexicographic order, and cut into units of ``UNIT`` vectors.
The directions are fitted on a bounded sample; they decide the order, never a link.

Join. The sequence is joined with itself, interval with interval: an interval has
the box of its projections and a ball around its vectors. Two intervals whose
boxes are more than eps apart are skipped. Two whose balls lie together within eps link
as a whole: their sizes are added to each other's counts, and no pair is compared. Others
are split, into ``FAN`` parts down to units (a Spark join of the pairs with the intervals'
parts, one level at a time), and inside a task by halves down to ``LEAF`` vectors,
whose cosines are computed.

Rows with equal vectors are one class with a size. Links are counted, never listed; for
the components a pair of units gives a star of each piece that hangs together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.ann_tree import cosine, unit
from visitflow.llm.common import Scratch, bounded_sample, stored
from visitflow.llm.components import connected, roots
from visitflow.llm.vectors import matrix, usable

THRESHOLD = 0.95
#: Vectors that the principal directions are fitted on, and how many directions are used.
SAMPLE_ROWS = 4096
LEADING = 12
#: Vectors of a unit, of the smallest interval in a task, and parts of an interval (a power of two).
UNIT = 2048
LEAF = 128
FAN_BITS = 4
#: Rounding is far below this.
SLACK = 1e-9
LOWEST = -(2**63)
_INTERVAL = "node long, size long, rep long, low binary, high binary, centre binary, radius double"


def _floats(column) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.float64) for x in column])


def principal(sample: np.ndarray, leading: int) -> np.ndarray:
    """The directions in which the sample's unit vectors spread most, as columns."""
    off = sample - sample.mean(axis=0)
    _, directions = np.linalg.eigh(off.T @ off)
    return directions[:, ::-1][:, :leading]


def gaps(low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray) -> np.ndarray:
    """Distance between boxes, row by row."""
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return np.sqrt((gap * gap).sum(axis=-1))


class Vectors:
    """A unit's vectors with the boxes of its leaves; ``near`` joins two units."""

    def __init__(self, ids: bytes, sizes: bytes, data: bytes, dim: int, directions: np.ndarray):
        self.ids, self.sizes = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64)
        kind = np.float32 if len(data) == 4 * dim * len(self.ids) else np.float64
        self.raw = np.frombuffer(data, kind).reshape(-1, dim).astype(np.float64)
        self.units = unit(self.raw)
        shown = self.units @ directions
        at = np.arange(0, len(self.ids), LEAF)
        self.low, self.high = np.minimum.reduceat(shown, at), np.maximum.reduceat(shown, at)

    def leaf(self, i: int) -> slice:
        return slice(i * LEAF, min((i + 1) * LEAF, len(self.ids)))


def near_leaves(a: Vectors, b: Vectors, same: bool, eps: float) -> Iterator[tuple[int, int]]:
    """Leaves of two units that may hold links: intervals are halved, and skipped when their boxes are apart."""
    todo = [(0, len(a.low), 0, len(b.low))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        if same and i0 >= j1:
            continue  # the mirrored pair of intervals covers it
        if gaps(a.low[i0:i1].min(0), a.high[i0:i1].max(0), b.low[j0:j1].min(0), b.high[j0:j1].max(0)) > eps:
            continue
        if i1 - i0 == 1 and j1 - j0 == 1:
            yield i0, j0
            continue
        i, j = (i0 + i1 + 1) // 2, (j0 + j1 + 1) // 2
        todo += [(p, q, r, s) for p, q in ((i0, i), (i, i1)) for r, s in ((j0, j), (j, j1)) if p < q and r < s]


def link_units(a: Vectors, b: Vectors, same: bool, threshold: float, eps: float) -> tuple[np.ndarray, ...]:
    """(id, links added) of the vectors that link, and the stars (root, id) of what hangs together."""
    add_a, add_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    for i, j in near_leaves(a, b, same, eps):
        own, other = a.leaf(i), b.leaf(j)
        close = a.units[own] @ b.units[other].T
        x, y = np.nonzero(close >= threshold - SLACK)
        if same and i == j:
            x, y = x[x < y], y[x < y]
        if not len(x):
            continue
        at = np.flatnonzero(close[x, y] < threshold + SLACK)
        if len(at):  # the sum's order may decide: take the measure itself
            sure = np.ones(len(x), bool)
            sure[at] = cosine(a.raw[own][x[at]], b.raw[other][y[at]]) >= threshold
            x, y = x[sure], y[sure]
        x, y = x + own.start, y + other.start
        np.add.at(add_a, x, b.sizes[y])
        np.add.at(add_b, y, a.sizes[x])
        node, root = roots(a.ids[x], b.ids[y])
        ends.append((root[node != root], node[node != root]))
    if not ends:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    ids, added = np.concatenate([a.ids, b.ids]), np.concatenate([add_a, add_b])
    node, root = roots(*(np.concatenate(x) for x in zip(*ends)))
    linked = added > 0
    return ids[linked], added[linked], root[node != root], node[node != root]


def _classes(rows: DataFrame) -> DataFrame:
    """(h1, h2, c, size, v): a row for each distinct vector; c is its smallest id."""
    return rows.groupBy("h1", "h2", "v").agg(F.min("id").alias("c"), F.count(F.lit(1)).alias("size"))


def _units(classes: DataFrame, directions: np.ndarray, eps: float, unit_rows: int) -> DataFrame:
    """The sorted sequence cut into units: vectors as bytes, with box, ball, size and smallest id."""
    dim = directions.shape[0]

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = matrix(batch["v"])
                cell = np.clip(np.floor(unit(x) @ directions / eps) + 128, 0, 255).astype(np.uint8)
                exact = (x.astype(np.float32) == x).all(axis=1)
                data = [(r.astype(np.float32) if e else r).tobytes() for r, e in zip(x, exact)]
                yield batch[["c", "size"]].assign(cell=[r.tobytes() for r in cell], data=data)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def packed(table: pa.Table) -> pa.RecordBatch:
            nonlocal seq
            ids, sizes = table["c"].to_numpy().astype(np.int64), table["size"].to_numpy().astype(np.int64)
            rows = table["data"].to_pylist()
            if all(len(r) == 4 * dim for r in rows):
                data = b"".join(rows)
                x = np.frombuffer(data, np.float32).reshape(-1, dim).astype(np.float64)
            else:
                x = np.stack([np.frombuffer(r, np.float32 if len(r) == 4 * dim else np.float64).astype(np.float64) for r in rows])
                data = x.tobytes()
            u = unit(x)
            shown, centre = u @ directions, u.mean(axis=0)
            radius = float(np.sqrt(((u - centre) ** 2).sum(axis=1).max()))
            out = {"part": part, "seq": seq, "size": int(sizes.sum()), "rep": int(ids.min()), "radius": radius}
            out |= {"low": shown.min(axis=0).tobytes(), "high": shown.max(axis=0).tobytes(), "centre": centre.tobytes()}
            seq += 1
            out |= {"ids": ids.tobytes(), "sizes": sizes.tobytes(), "data": data}
            return pa.RecordBatch.from_pydict({k: [v] for k, v in out.items()})

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= unit_rows:
                table = pa.Table.from_batches(held)
                yield packed(table.slice(0, unit_rows))
                held = table.slice(unit_rows).to_batches()
        if sum(b.num_rows for b in held):
            yield packed(pa.Table.from_batches(held))

    keyed = classes.select("c", "size", "v").mapInPandas(cells, "c long, size long, cell binary, data binary")
    ordered = keyed.repartitionByRange("cell", "c").sortWithinPartitions("cell", "c")
    schema = "part long, seq long, size long, rep long, radius double, low binary, high binary, centre binary"
    return ordered.mapInArrow(pack, schema + ", ids binary, sizes binary, data binary")


def _parents(nodes: DataFrame) -> DataFrame:
    """The intervals one level up: box around the boxes, ball around the balls."""

    def merge(key, rows: pd.DataFrame) -> pd.DataFrame:
        low, high, centres = (_floats(rows[k]) for k in ("low", "high", "centre"))
        weight = rows["size"].to_numpy(np.float64)
        centre = (centres * weight[:, None]).sum(axis=0) / weight.sum()
        radius = float((np.sqrt(((centres - centre) ** 2).sum(axis=1)) + rows["radius"].to_numpy()).max())
        out = {"node": key[0], "size": int(rows["size"].sum()), "rep": int(rows["rep"].min()), "radius": radius}
        out |= {"low": low.min(axis=0).tobytes(), "high": high.max(axis=0).tobytes(), "centre": centre.tobytes()}
        return pd.DataFrame({k: [v] for k, v in out.items()})

    return nodes.groupBy(F.shiftright("node", FAN_BITS).alias("node_up")).applyInPandas(
        lambda key, rows: merge(key, rows), _INTERVAL
    )


def _tested(pairs: DataFrame, nodes: DataFrame, eps: float) -> DataFrame:
    """(i, j, whole, ...) of the pairs of intervals that aren't provably distant; ``whole``: every pair links."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = {k: _floats(batch[k]) for k in ("i_low", "i_high", "i_centre", "j_low", "j_high", "j_centre")}
            reach = batch["i_radius"].to_numpy() + batch["j_radius"].to_numpy()
            apart = np.sqrt(((x["i_centre"] - x["j_centre"]) ** 2).sum(axis=1))
            skip = gaps(x["i_low"], x["i_high"], x["j_low"], x["j_high"]) > eps + SLACK
            skip |= apart - reach > eps + SLACK
            kept = batch[["i", "j", "i_size", "j_size", "i_rep", "j_rep"]].assign(whole=apart + reach < eps - SLACK)
            yield kept[~skip]

    columns = ["low", "high", "centre", "radius", "size", "rep"]
    for end in "ij":
        pairs = pairs.join(nodes.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in columns]), end)
    return pairs.mapInPandas(run, "i long, j long, i_size long, j_size long, i_rep long, j_rep long, whole boolean")


def _near_units(levels: list[DataFrame], eps: float, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """Unit pairs to compare, and the pairs of intervals (level, i, j, ...) that link as a whole."""
    pairs = levels[-1].select(F.col("node").alias("i"), F.col("node").alias("j"))  # one interval holds everything
    whole = None
    for level in range(len(levels) - 1, -1, -1):
        tested = scratch.stored(_tested(pairs, levels[level], eps), "eps-pairs")
        own = tested.where("whole").withColumn("level", F.lit(level))
        whole = own if whole is None else whole.union(own)
        pairs = tested.where("not whole").select("i", "j")
        if level:
            child = levels[level - 1].select(F.col("node").alias("child"), F.shiftright("node", FAN_BITS).alias("parent"))
            for end in "ij":
                pairs = pairs.join(child.withColumnsRenamed({"child": f"{end}_child", "parent": end}), end)
            pairs = pairs.select(F.col("i_child").alias("i"), F.col("j_child").alias("j")).where("i <= j")
    return pairs, whole


def near_duplicates(
    rows: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    unit_rows: int = UNIT,
) -> DataFrame:
    """Links between vectors with a cosine of at least ``threshold`` (over 0), in double precision.

    Returns a row for each row of ``rows``: vec_id, n_links (other rows linked with
    directly), component_id (the smallest vec_id reachable by links, its own included) and
    kept (vec_id = component_id).

    Rows whose vector is null, zero, holds null or non-finite components, or is not of the
    commonest length link with nothing. Rows with equal vectors link with each other, also
    rows alike in everything; of those each is kept if its id is the component's. A null
    vec_id counts as the lowest id and is returned as null. Other columns are not read.
    An empty table gives an empty result.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST))
    v = F.col(vector_col).cast("array<double>")
    hashes = [F.xxhash64("v").alias("h1"), F.xxhash64("v", F.lit(1)).alias("h2")]
    named = rows.select(key.alias("id"), v.alias("v")).select("id", "v", *hashes)
    good = usable(named, "id", "v").where(F.exists("v", lambda x: x != 0)).select("id", "v", *hashes)
    classes = scratch.stored(_classes(good), "eps-classes")
    drawn = bounded_sample(classes, SAMPLE_ROWS, "c").select("v").toPandas()
    if len(drawn):
        per_class = _link_classes(classes, unit(matrix(drawn["v"])), threshold, unit_rows, scratch)
    else:
        per_class = spark.createDataFrame([], "h1 long, h2 long, n_links long, root long")
    out = named.select("id", "h1", "h2").join(per_class, ["h1", "h2"], "left")
    shown = lambda c: F.nullif(c, F.lit(LOWEST))
    component = F.coalesce("root", "id")
    out = out.select(
        shown(F.col("id")).alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        shown(component).alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
    out = stored(out, "eps-result")
    scratch.drop()
    return out


def _link_classes(
    classes: DataFrame, sample: np.ndarray, threshold: float, unit_rows: int, scratch: Scratch
) -> DataFrame:
    """(h1, h2, n_links, root) of every class."""
    eps = float(np.sqrt(2 - 2 * threshold))
    directions = principal(sample, LEADING)
    dim = sample.shape[1]
    units = scratch.stored(_units(classes, directions, eps, unit_rows), "eps-units")
    parts, seqs = units.agg(F.max("part"), F.max("seq")).first()
    seq_bits = -(-int(seqs).bit_length() // FAN_BITS) * FAN_BITS
    units = units.withColumn("node", F.shiftleft("part", seq_bits) + F.col("seq"))
    names = ["node", "size", "rep", "low", "high", "centre", "radius"]
    levels = [units.select(names)]
    top = (int(parts) << seq_bits) + int(seqs)
    while top >> (FAN_BITS * (len(levels) - 1)):
        levels.append(scratch.stored(_parents(levels[-1]), "eps-intervals").select(names))
    pairs, whole = _near_units(levels, eps, scratch)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["i"] == row["j"]
                a = Vectors(row["i_ids"], row["i_sizes"], row["i_data"], dim, directions)
                b = a if same else Vectors(row["j_ids"], row["j_sizes"], row["j_data"], dim, directions)
                ids, added, root, node = link_units(a, b, same, threshold, eps + SLACK)
                # A link count, or an edge (a, b).
                n, m = len(ids), len(node)
                columns = [np.concatenate([ids, root]), np.concatenate([added, np.zeros(m, np.int64)])]
                other = pa.array(np.concatenate([ids, node]), mask=np.repeat([True, False], [n, m]))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0]), other, pa.array(columns[1])], ["a", "b", "added"])

    for end in "ij":
        own = units.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in ("ids", "sizes", "data")])
        pairs = pairs.join(own, end)
    found = scratch.stored(pairs.mapInArrow(compare, "a long, b long, added long"), "eps-found")
    edges = found.where("b is not null").select("a", "b")
    counts = found.where("b is null").select(F.col("a").alias("c"), "added")

    # What links as a whole: counted by interval, handed down to the units, then to their vectors.
    whole = scratch.stored(whole, "eps-whole")
    if whole.head(1):
        both = whole.where("i <> j")
        given = both.select("level", F.col("i").alias("node"), F.col("j_size").alias("more"), F.lit(0).alias("own"))
        given = given.union(both.select("level", "j", "i_size", F.lit(0)))
        given = given.union(whole.where("i = j").select("level", "i", "i_size", F.lit(1)))
        ladder = None
        for level in range(len(levels)):
            up = F.shiftright("node", FAN_BITS * level).alias("node")
            step = units.select(F.col("node").alias("unit"), F.lit(level).alias("level"), up)
            ladder = step if ladder is None else ladder.union(step)
        taken = ladder.join(given, ["level", "node"]).groupBy("unit").agg(F.sum("more").alias("more"), F.max("own").alias("own"))
        taken = scratch.stored(taken, "eps-taken")

        def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    ids, sizes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64)
                    added = row["more"] - sizes if row["own"] else np.full(len(ids), row["more"])
                    rep = np.full(len(ids), row["rep"])
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(rep), pa.array(added)], ["c", "rep", "added"])

        packed = units.join(taken, units["node"] == taken["unit"]).select("ids", "sizes", "rep", "more", "own")
        spread = scratch.stored(packed.mapInArrow(members, "c long, rep long, added long"), "eps-members")
        counts = counts.union(spread.select("c", "added"))
        edges = edges.union(spread.select("rep", "c")).union(both.select("i_rep", "j_rep"))
        nodes = None
        for level, own in enumerate(levels):
            step = own.select(F.lit(level).alias("level"), "node", "rep")
            nodes = step if nodes is None else nodes.union(step)
        heads = ladder.join(given.select("level", "node").distinct(), ["level", "node"]).join(nodes, ["level", "node"])
        own_head = units.select(F.col("node").alias("unit"), F.col("rep").alias("unit_rep"))
        edges = edges.union(heads.join(own_head, "unit").select("unit_rep", "rep"))

    comps = connected(edges, scratch)
    counts = counts.groupBy("c").agg(F.sum("added").alias("added"))
    out = classes.select("h1", "h2", "c", "size").join(counts, "c", "left").join(comps.withColumnRenamed("node", "c"), "c", "left")
    links = F.col("size") - 1 + F.coalesce("added", F.lit(0))
    return out.select("h1", "h2", links.cast("long").alias("n_links"), F.coalesce("root", "c").alias("root"))
