"""N-gram Jaccard join: linked pairs and near-duplicate components by set-relation skipping.

A document's set is its distinct word shingles, as 64-bit hashes. Documents with equal
sets form one class, and only classes are joined.

Index lists. Two sets that link share a hash among the first ``n - ceil(t n) + 1`` of
each, in any order that is the same for all; these prefixes are the index. The order is rare
first: a hash's top bits are its rank, from how often its bucket (of ``2**RANK_BITS``) occurs in all
texts, so that shingles which many documents share enter few prefixes, and the lists stay short. A list (all classes with one
hash) is ordered by set size and skipped by position: a probe reads only the block
of sizes that can link, and of these only entries whose positions leave room for
enough common hashes and whose parity sketches differ in few enough bits. Sizes and positions are
tested on narrow rows: what has no partner in a list leaves it before sketches join, in the second
round also what only meets its own component. In the first round a
sketch is brief (512 bits); in the second, which has few entries, it has some four bits a
hash, so that it also tells sets apart that just miss a link. Pairs found are tested by their prefixes before full sets are fetched. Each bound is exact: it rules
out no pair that links.

Set relations. Round 1 probes each list with leaders only: of the entries not yet close to a
leader, the one of the highest priority (the same in every list) is the next, and the
entries close to it become its followers. Leader-follower pairs are verified on the
full sets, which also gives the number of hashes they differ in, whether they link or not.

Answers are derived from the leader that both sets of a pair were verified with: if A and B
differ from it in x and y hashes, they differ from each other in at most x + y and at
least |x - y|. A sum within a link's allowance is a link, a difference beyond it is
none, and no set is fetched for either. Only the other pairs, and those without a common
leader, are verified.

* ``linked_classes`` probes every list again, by all its entries, for every link.
* ``near_duplicates`` needs no answers inside a component: its second round probes only entries
  outside a list's commonest component, against entries of other components, and leaves out
  what the leaders' answers rule out. What it verifies completes the links between
  components, so components are exact, and a list of m near copies that hang together
  costs m comparisons, not their square.

Lists longer than ``LIST_ROWS`` are dealt into block pairs, each a task's bounded work.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import Scratch, mix64, slices, stored, utf8_column, word_hashes, word_spans
from visitflow.llm.components import connected

#: Least and most bits of a set's sketch, and bits a hash in between.
LEAST_BITS, MOST_BITS, BITS_A_HASH = 512, 8192, 4
#: Buckets that shingles are counted in (a bounded table, 1 MB as ranks), and bits of a rank.
RANK_BITS, CLASS_BITS = 20, 5
#: Ranks for counts about the mean.
FINE = 20
LIST_ROWS = 20_000
#: Neighbours in a list, in size order, that an entry's position is tested against before its sketch joins.
NEAR = 16
#: First prefix hashes that go with an entry in round 2, to give a pair in one of its lists only.
HEAD = 16
#: Rows of lists that are probed together.
ENGINE_ROWS = 100_000
PIECE_BYTES = 1 << 20
LOWEST = -(2**63)
#: Bits of the filter that spares texts which no candidate pair names the shuffle (2 MB).
FILTER_BITS = 1 << 24
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEPS = np.random.default_rng(77).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; link when ``den * intersection >= num * union``."""

    words: int = 3
    num: int = 90
    den: int = 100

    def prefix(self, n):
        return n - -(-self.num * n // self.den) + 1

    def differ(self, sizes):
        """Most hashes in one set only, for two linked sets of ``sizes`` hashes in all."""
        return sizes - 2 * -(-self.num * sizes // (self.num + self.den))

    def fits(self, n_x, pos_x, n_y, pos_y):
        """Whether two sets whose first common hash is at these positions can link; sizes too far apart never fit."""
        sizes, room = n_x + n_y, np.minimum(n_x - pos_x, n_y - pos_y)  # this hash and those after it
        return 2 * room >= sizes - self.differ(sizes)


# ------------------------------------------------------------------ sets


def _grams(body: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every run of ``words`` words (across texts too), hash of every word, first word of each text."""
    body = _LOWER[body]
    starts, ends, rows = word_spans(body, offsets)
    hashes = word_hashes(body, starts, ends)
    first = np.searchsorted(rows, np.arange(len(offsets)))
    m = len(hashes) - words + 1
    grams = np.zeros(max(m, 0), np.uint64)
    for i in range(words if m > 0 else 0):
        grams += hashes[i : i + m] * _STEPS[i % len(_STEPS)] ^ np.uint64(i // len(_STEPS))
    return mix64(grams), hashes, first


def shingle_ranks(docs: DataFrame, rule: Rule) -> np.ndarray:
    """Rank of each bucket of shingles by its occurrences in all texts.

    Ranks below FINE are steps of a quarter of the counts' usual spread (the square root of their mean),
    so that buckets without a frequent shingle come first; above, ranks are doublings.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RANK_BITS, np.int64)
        for batch in batches:
            body, offsets = utf8_column(batch.column("text"))
            for first, last in slices(offsets, 4 * PIECE_BYTES):
                part = body[offsets[first] : offsets[last]]
                grams, _, start = _grams(part, offsets[first : last + 1] - offsets[first], rule.words)
                inside = np.ones(len(grams), bool)
                for back in range(1, rule.words):  # runs that reach into the next text
                    cut = start[1:-1] - back
                    inside[cut[(cut >= 0) & (cut < len(grams))]] = False
                total += np.bincount((grams[inside] >> np.uint64(64 - RANK_BITS)).astype(np.int64), minlength=1 << RANK_BITS)
        parts = [x.astype("<i4").tobytes() for x in np.split(total, 16)]
        yield pa.RecordBatch.from_pydict({"part": list(range(16)), "counts": parts})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts.as_buffer(), "<i4").astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_pydict({"part": list(sums), "counts": [x.tobytes() for x in sums.values()]})

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "part long, counts binary")
    total = np.zeros((16, (1 << RANK_BITS) // 16), np.int64)
    for row in counted.repartition("part").mapInArrow(add, "part long, counts binary").collect():  # 8 MB
        total[row["part"]] += np.frombuffer(row["counts"], np.int64)
    total = total.ravel()
    off = (total - total.mean()) / np.sqrt(max(1.0, total.mean()))
    rank = np.where(off < FINE / 8, np.floor(4 * off) + FINE // 2, FINE + np.log2(np.maximum(8 * off / FINE, 1)))
    return np.clip(rank, 0, (1 << CLASS_BITS) - 1).astype(np.uint8)


def ranked(hashes: np.ndarray, ranks: np.ndarray | None) -> np.ndarray:
    """Hashes whose top bits are their bucket's rank."""
    if ranks is None:
        return hashes
    rank = ranks[(hashes >> np.uint64(64 - RANK_BITS)).astype(np.int64)].astype(np.uint64)
    return rank << np.uint64(64 - CLASS_BITS) | hashes >> np.uint64(CLASS_BITS)


def shingle_sets(body: np.ndarray, offsets: np.ndarray, words: int, ranks: np.ndarray | None = None) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, the rarer first if ``ranks`` are given."""
    grams, hashes, first = _grams(body, offsets, words)
    grams = ranked(grams, ranks)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            own = np.sort(grams[a : b - words + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:  # fewer words than a shingle has: the whole sequence is one
            whole = (hashes[a:b] * _STEPS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(ranked(mix64(np.array([whole ^ np.uint64(0x5851F42D4C957F2D)])), ranks))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_name(own: np.ndarray) -> int:
    """64-bit name of a set. Names collide about once in 2**64 / sets**2 * 2 corpora."""
    total = mix64(own ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64, keepdims=True)
    return int(mix64(total ^ mix64(np.array([len(own)], np.uint64))).view(np.int64)[0])


def sketch(own: np.ndarray, most: int = MOST_BITS) -> bytes:
    """Parity of the number of hashes that fall on each bit; the more hashes, the more bits."""
    bits = LEAST_BITS
    while bits < min(most, BITS_A_HASH * len(own)):
        bits *= 2
    counts = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _text_rows(docs: DataFrame) -> DataFrame:
    """(d, t, text): a document is known by its id and a hash of its text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    return docs.select(d.alias("d"), F.xxhash64(text).alias("t"), text.alias("text"))


def sketches(docs: DataFrame, rule: Rule, ranks: np.ndarray) -> DataFrame:
    """(d, t, n, node, prefix, brief, bits) of every row; node is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = utf8_column(batch.column("text"))
            for first, last in slices(offsets, PIECE_BYTES):
                part = body[offsets[first] : offsets[last]]
                sets = shingle_sets(part, offsets[first : last + 1] - offsets[first], rule.words, ranks)
                rows = batch.slice(first, last - first)
                columns = {
                    "d": rows.column("d"),
                    "t": rows.column("t"),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "node": pa.array([set_name(s) if len(s) else None for s in sets], pa.int64()),
                    "prefix": pa.array([s[: rule.prefix(len(s))].tobytes() if len(s) else b"" for s in sets], pa.binary()),
                    "brief": pa.array([sketch(s, LEAST_BITS) if len(s) else b"" for s in sets], pa.binary()),
                    "bits": pa.array([sketch(s) if len(s) else b"" for s in sets], pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return _text_rows(docs).mapInArrow(run, "d long, t long, n long, node long, prefix binary, brief binary, bits binary")


def _flagged(rows: DataFrame, wanted: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` and ``_maybe``: false only where ``wanted`` doesn't hold the row's keys.

    A bitmap of hashes of the wanted keys is broadcast: FILTER_BITS bits at most,
    however many are wanted. It marks some others too, never one wanted less.
    """
    bit = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS)) + 1
    bits = wanted.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("_bucket"))
    bits = scratch.stored(bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits")), "join-filter")
    keyed = rows.withColumn("_bucket", F.bitmap_bucket_number(bit)).withColumn("_at", F.bitmap_bit_position(bit))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    maybe = F.coalesce(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1, F.lit(False))
    return keyed.join(F.broadcast(bits), "_bucket", "left").select(*rows.columns, maybe.alias("_maybe"))


def _maybe(rows: DataFrame, wanted: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` without most of those whose keys ``wanted`` doesn't hold."""
    return _flagged(rows, wanted, keys, scratch).where("_maybe").select(rows.columns)


def full_sets(docs: DataFrame, wanted: DataFrame, rule: Rule, ranks: np.ndarray, scratch: Scratch) -> DataFrame:
    """(node, hashes) of the wanted classes (node, d, t), from their representatives' texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = utf8_column(batch.column("text"))
            for first, last in slices(offsets, PIECE_BYTES):
                part = body[offsets[first] : offsets[last]]
                sets = shingle_sets(part, offsets[first : last + 1] - offsets[first], rule.words, ranks)
                nodes = batch.column("node").slice(first, last - first)
                yield pa.RecordBatch.from_arrays([nodes, pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "hashes"])

    texts = _maybe(_text_rows(docs), wanted, ["d", "t"], scratch).join(wanted, ["d", "t"]).dropDuplicates(["d", "t"])
    return texts.select("node", "text").mapInArrow(run, "node long, hashes binary")


# ------------------------------------------------------------------ index lists


def _postings(classes: DataFrame) -> DataFrame:
    """(token, node, n, pos) of every prefix hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                prefixes = [np.frombuffer(x, np.int64) for x in part.column("prefix").to_pylist()]
                counts = np.array([len(x) for x in prefixes], np.int64)
                token = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
                pos = np.arange(len(token)) - np.repeat(np.cumsum(counts) - counts, counts)
                node = np.repeat(part.column("node").to_numpy(), counts)
                n = np.repeat(part.column("n").to_numpy(), counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token), pa.array(node), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32))],
                    ["token", "node", "n", "pos"],
                )

    return classes.select("node", "n", "prefix").mapInArrow(run, "token long, node long, n int, pos int")


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by ``keys``, regrouped so that no list is cut: about ENGINE_ROWS at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= ENGINE_ROWS:
            table = pa.Table.from_batches(held)
            new = _starts([table.column(k).to_numpy() for k in keys])
            cut = int(new[-1])
            if cut:
                yield table.slice(0, cut)
                held, rows = table.slice(cut).to_batches(), table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    """First row of each run of equal keys."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def shared_lists(classes: DataFrame, rule: Rule) -> DataFrame:
    """Postings whose list holds another one that sizes and positions allow to link.

    Pairs up to ``NEAR`` rows apart in size order are tested; a posting with more than that
    many of a size that can link stays untested.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Lists are read as a stream; only the last rows wait for the next batch.
        rest, marked = None, np.zeros(0, bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            token, n, pos = (table.column(c).to_numpy().astype(np.int64) for c in ("token", "n", "pos"))
            paired = np.zeros(len(token), bool)
            paired[: len(marked)] = marked
            for off in range(1, min(NEAR, len(token) - 1) + 1):
                x = np.flatnonzero(token[off:] == token[:-off])
                y = x + off
                ok = n[x] * rule.den >= n[y] * rule.num if off == NEAR else rule.fits(n[x], pos[x], n[y], pos[y])
                paired[x[ok]] = paired[y[ok]] = True
            last = max(len(token) - NEAR, 0)
            yield from table.slice(0, last).filter(pa.array(paired[:last])).to_batches()
            rest, marked = table.slice(last), paired[last:]
        if rest is not None:
            yield from rest.filter(pa.array(marked)).to_batches()

    lists = _postings(classes).repartition("token").sortWithinPartitions("token", "n", "node")
    return lists.mapInArrow(run, "token long, node long, n int, pos int")


class Lists:
    """Lists of entries ordered by size, and exact tests between a probe and the entries."""

    def __init__(self, table: pa.Table, rule: Rule):
        col = lambda name: table.column(name).to_numpy()
        self.rule = rule
        self.node, self.n, self.pos = col("node"), col("n").astype(np.int64), col("pos").astype(np.int64)
        self.side = col("block") if "block" in table.column_names else None
        self.cross = col("i") != col("j")
        self.starts = _starts([col("token"), col("i"), col("j")])
        self.ends = np.append(self.starts[1:], table.num_rows)
        self.list_of = np.repeat(np.arange(len(self.starts)), self.ends - self.starts)
        if "bits" in table.column_names:
            bits = table.column("bits").to_pylist()
            self.words = np.array([len(x) // 8 for x in bits], np.int64)  # of each sketch
            self.at = np.cumsum(self.words) - self.words
            self.bits = np.frombuffer(b"".join(bits), np.uint64)
        self.key = self.list_of * (1 << 32) + self.n
        self.token = col("token").view(np.uint64)
        if "head" in table.column_names:
            heads = table.column("head").to_pylist()
            self.heads = np.zeros((table.num_rows, HEAD), np.uint64)
            for at, head in enumerate(heads):
                self.heads[at, : len(head) // 8] = np.frombuffer(head, np.uint64)
            self.head_size = np.array([len(x) // 8 for x in heads], np.int64)

    def window(self, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probe, entry) pairs: each probe with the block of its list whose sizes can link."""
        base, n = self.list_of[probes] * (1 << 32), self.n[probes]
        low = np.searchsorted(self.key, base + -(-n * self.rule.num // self.rule.den), "left")
        high = np.searchsorted(self.key, base + n * self.rule.den // self.rule.num, "right")
        count = high - low
        to = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        return np.repeat(probes, count), to

    def fits(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs sizes and positions don't rule out."""
        ok = (self.node[x] != self.node[y]) & self.rule.fits(self.n[x], self.pos[x], self.n[y], self.pos[y])
        if self.side is not None:
            ok &= ~self.cross[x] | (self.side[x] != self.side[y])
        return ok

    def close(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs no bound rules out."""
        ok = self.fits(x, y)
        at = np.flatnonzero(ok)
        ok[at] = self.alike(x[at], y[at], self.rule.differ(self.n[x[at]] + self.n[y[at]]))
        return ok

    def alike(self, x: np.ndarray, y: np.ndarray, differ: np.ndarray) -> np.ndarray:
        """Which pairs' sketches differ in at most ``differ`` bits, read 8 words at a time until one has more.

        The longer sketch of a pair is folded to the shorter: its halves' parities add up.
        """
        words, unlike = np.minimum(self.words[x], self.words[y]), np.zeros(len(x), np.int64)
        live = np.arange(len(x))
        for word in range(int(words.max(initial=0))):
            if word % 8 == 0:
                live = live[(unlike[live] <= differ[live]) & (words[live] > word)]
                if not len(live):
                    break
            parity = [self._word(z[live], word, words[live]) for z in (x, y)]
            unlike[live] += np.bitwise_count(parity[0] ^ parity[1])
        return unlike <= differ

    def _word(self, z: np.ndarray, word: int, words: np.ndarray) -> np.ndarray:
        out = self.bits[self.at[z] + word]
        folds = self.words[z] // words
        for fold in range(1, int(folds.max(initial=1))):
            more = np.flatnonzero(folds > fold)
            out[more] ^= self.bits[self.at[z[more]] + word + fold * words[more]]
        return out

    def first_of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Pairs whose heads share no hash below this list's: the others are given in an earlier list."""
        out = np.ones(len(x), bool)
        places = np.arange(HEAD)
        for at in range(0, len(x), 50_000):
            i, j = x[at : at + 50_000], y[at : at + 50_000]
            below = [(self.heads[z] < self.token[z, None]) & (places < self.head_size[z, None]) for z in (i, j)]
            same = (self.heads[i][:, :, None] == self.heads[j][:, None, :]) & below[0][:, :, None] & below[1][:, None, :]
            out[at : at + 50_000] = ~same.any(axis=(1, 2))
        return out

    def leaders(self) -> tuple[np.ndarray, np.ndarray]:
        """Round 1: (leader, entry) for every follower, and one pair for a leader that only followers are close to.

        Leaders are taken by a priority that is the same in every list, so lists that share
        entries mostly agree on their leaders.
        """
        order = np.lexsort((mix64(self.node.view(np.uint64)), self.list_of))
        covered = np.zeros(len(self.node), bool)
        at = self.starts.copy()  # each list's next probe, as a place in ``order``
        xs, ys = [], []
        while len(at):
            probes = order[at]
            x, y = self.window(probes)
            ok = self.close(x, y)
            x, y = x[ok], y[ok]
            fresh = ~covered[y]
            old_x, old_at = np.unique(x[~fresh], return_index=True)
            xs += [x[fresh], old_x]
            ys += [y[fresh], y[~fresh][old_at]]
            covered[y[fresh]] = True
            covered[probes] = True
            free = np.append(np.flatnonzero(~covered[order]), len(order))
            to = free[np.searchsorted(free, at + 1)]
            at = to[to < self.ends[self.list_of[probes]]]
        return np.concatenate(xs), np.concatenate(ys)

    def strangers(self, comp: np.ndarray, lead: np.ndarray, gap: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of different components that fit, probed from outside each list's commonest one.

        Pairs whose differences ``gap`` from a common ``lead`` rule a link out are left out.
        """
        order = np.lexsort((comp, self.list_of))
        first = _starts([self.list_of[order], comp[order]])
        size = np.diff(np.append(first, len(order)))
        owner = self.list_of[order[first]]
        by = np.lexsort((-size, owner))
        common = comp[order[first[by[_starts([owner[by]])]]]]
        probes = np.flatnonzero(comp != common[self.list_of])
        work = np.cumsum((self.ends - self.starts)[self.list_of[probes]])
        for some in np.split(probes, np.flatnonzero(np.diff(work // ENGINE_ROWS)) + 1):
            x, y = self.window(some)
            apart = np.abs(gap[x] - gap[y]) > self.rule.differ(self.n[x] + self.n[y])
            other = (comp[x] != comp[y]) & ~((lead[x] == lead[y]) & apart)
            x, y = x[other], y[other]
            ok = self.fits(x, y)
            yield x[ok], y[ok]

    def met(self, comp: np.ndarray, lead: np.ndarray, gap: np.ndarray) -> np.ndarray:
        """Entries that are in a pair of ``strangers``."""
        out = np.zeros(len(self.node), bool)
        for x, y in self.strangers(comp, lead, gap):
            out[x] = out[y] = True
        return out

    def between(self, comp: np.ndarray, lead: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Round 2: pairs of ``strangers`` with close sketches, each in one list."""
        xs, ys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y in self.strangers(comp, lead, gap):
            ok = self.alike(x, y, self.rule.differ(self.n[x] + self.n[y]))
            x, y = x[ok], y[ok]
            ok = self.first_of(x, y)
            xs.append(x[ok])
            ys.append(y[ok])
        return np.concatenate(xs), np.concatenate(ys)

    def answers(self, lead: np.ndarray, gap: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Close pairs (x, y) and whether their differences ``gap`` from a common ``lead`` prove the link.

        Pairs which these differences rule out are left out.
        """
        work = np.cumsum((self.ends - self.starts)[self.list_of])
        for some in np.split(np.arange(len(work)), np.flatnonzero(np.diff(work // ENGINE_ROWS)) + 1):
            x, y = self.window(some)
            once = self.node[x] < self.node[y]
            x, y = x[once], y[once]
            common, differ = lead[x] == lead[y], self.rule.differ(self.n[x] + self.n[y])
            ok = ~(common & (np.abs(gap[x] - gap[y]) > differ))
            ok[ok] = self.close(x[ok], y[ok])
            sure = common & (gap[x] + gap[y] <= differ)
            yield x[ok], y[ok], sure[ok]


def _by_list(entries: DataFrame) -> DataFrame:
    """Entries dealt by block pair, in order."""
    return entries.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "node")


def _met(entries: DataFrame, rule: Rule) -> DataFrame:
    """Entries that meet one of another component which sizes, positions and answers allow to link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["token", "i", "j"]):
            met = Lists(table, rule).met(*(table.column(c).to_numpy() for c in ("root", "lead", "gap")))
            yield from table.filter(pa.array(met)).to_batches()

    return _by_list(entries).mapInArrow(run, entries.schema)


def _entries(lists: DataFrame, classes: DataFrame, rule: Rule, known: DataFrame | None, scratch: Scratch) -> DataFrame:
    """Entries of the lists with sketches and what is ``known`` of a node, dealt by block pair, in order.

    With the ``root`` of every node known, only the entries that meet another component get sketches.
    """
    long = lists.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > LIST_ROWS)
    sketched = classes.select("node", F.col("brief").alias("bits"))
    entries = (
        lists.join(F.broadcast(long), "token", "left")  # at most one row for LIST_ROWS of the lists
        .withColumn("blocks", F.coalesce(F.ceil(F.col("rows") / LIST_ROWS), F.lit(1)).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .drop("rows")
    )

    def dealt(entries: DataFrame) -> DataFrame:
        return (
            entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("block", "other"))
            .withColumn("j", F.greatest("block", "other"))
            .drop("blocks", "other")
        )

    if known is not None:
        sketched = classes.select("node", "bits", F.substring("prefix", 1, 8 * HEAD).alias("head"))
        sketched = _maybe(sketched, known, ["node"], scratch)
        entries = entries.join(known, "node")
        if "root" in known.columns:
            return _by_list(_met(dealt(entries), rule).join(sketched, "node"))
    # Sketches join last: they move once.
    return _by_list(dealt(entries.join(sketched, "node")))


def candidate_pairs(
    lists: DataFrame, classes: DataFrame, rule: Rule, scratch: Scratch, known: DataFrame | None = None
) -> DataFrame:
    """Distinct pairs (a, b) that a round must verify; ``known`` (node, root, lead, gap) makes it round 2."""
    second = known is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["token", "i", "j"]):
            found = Lists(table, rule)
            x, y = found.between(*(table.column(c).to_numpy() for c in ("root", "lead", "gap"))) if second else found.leaders()
            a, b = np.minimum(found.node[x], found.node[y]), np.maximum(found.node[x], found.node[y])
            pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return _entries(lists, classes, rule, known, scratch).mapInArrow(run, "a long, b long").distinct()


def answer_pairs(lists: DataFrame, classes: DataFrame, rule: Rule, leads: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct pairs (a, b) that may link, and ``sure`` if ``leads`` (node, lead, gap) prove it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["token", "i", "j"]):
            found = Lists(table, rule)
            for x, y, sure in found.answers(table.column("lead").to_numpy(), table.column("gap").to_numpy()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.node[x]), pa.array(found.node[y]), pa.array(sure)], ["a", "b", "sure"]
                )

    return _entries(lists, classes, rule, leads, scratch).mapInArrow(run, "a long, b long, sure boolean").distinct()


# ------------------------------------------------------------------ verification


def _both(pairs: DataFrame, by_node: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` with the columns of both nodes, named x_... and y_... ."""
    for end, mark in (("a", "x"), ("b", "y")):
        own = by_node.select(F.col("node").alias(end), *[F.col(c).alias(f"{mark}_{c}") for c in columns])
        pairs = pairs.join(own, end)
    return pairs


def prefix_check(pairs: DataFrame, nodes: DataFrame, classes: DataFrame, rule: Rule, scratch: Scratch) -> DataFrame:
    """Drop pairs whose prefixes alone differ in more hashes than a link allows; ``nodes``: those of the pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for row in batch.itertuples(index=False):
                x, y = np.frombuffer(row.x_prefix, np.uint64), np.frombuffer(row.y_prefix, np.uint64)
                # Up to the nearer end of the two prefixes both sets are known.
                end = min(x[-1], y[-1])
                x, y = x[x <= end], y[y <= end]
                common = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(len(x) + len(y) - 2 * common <= rule.differ(row.x_n + row.y_n))
            yield batch.loc[kept, ["a", "b"]]

    known = _maybe(classes.select("node", "n", "prefix"), nodes, ["node"], scratch)
    return _both(pairs, known, ["n", "prefix"]).mapInPandas(run, "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(a, b, gap, linked) of every pair, on the full sets; ``gap`` hashes are in one set only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked, gaps = [], []
            for x, y in zip(batch["x_hashes"], batch["y_hashes"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(common * rule.den >= (len(x) + len(y) - common) * rule.num)
                gaps.append(len(x) + len(y) - 2 * common)
            yield batch[["a", "b"]].assign(gap=gaps, linked=linked)

    return _both(pairs, sets, ["hashes"]).mapInPandas(run, "a long, b long, gap long, linked boolean")


# ------------------------------------------------------------------ the join


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


class Join:
    """Sets, classes and index lists of ``docs``, and what round 1 found.

    ``rows``: (d, t, n, node, ...) of every row; ``classes``: one row a node, with its representative's
    (d, t); ``lists``: the index; ``seen``: pairs tested; ``verified``: those compared on their full
    sets, with their gap and whether they link; ``marked``: every class that some pair may link.
    """

    def __init__(self, docs: DataFrame, rule: Rule, scratch: Scratch):
        self.docs, self.rule, self.scratch = docs, rule, scratch
        self.ranks = shingle_ranks(docs, rule)
        self.rows = scratch.stored(sketches(docs, rule, self.ranks), "join-sketches")
        self.classes = self.class_rows()
        self.lists = scratch.stored(shared_lists(self.classes, rule), "join-lists")
        self.seen = scratch.stored(candidate_pairs(self.lists, self.classes, rule, scratch), "join-first")
        self.marked = scratch.stored(nodes_of(self.seen), "join-marked")
        self.verified = self.compared(self.seen, self.marked)
        self.found = self.verified.where("linked").select("a", "b", "gap")

    def class_rows(self) -> DataFrame:
        """(node, d, t, n, prefix, brief, bits), one row a node; sets that no other row may equal are read where they are."""
        named = self.rows.where("node is not null")
        copied = named.groupBy("node").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("node")
        flagged = _flagged(named, self.scratch.stored(copied, "join-copied"), ["node"], self.scratch)
        copies = flagged.where("_maybe").groupBy("node").agg(
            F.min(F.struct("d", "t")).alias("rep"),
            F.first("n").alias("n"),
            F.first("prefix").alias("prefix"),
            F.first("brief").alias("brief"),
            F.first("bits").alias("bits"),
        )
        copies = copies.select("node", "rep.d", "rep.t", "n", "prefix", "brief", "bits")
        alone = flagged.where("not _maybe").select(copies.columns)
        return alone.union(self.scratch.stored(copies, "join-classes"))

    def compared(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """(a, b, gap, linked) of the ``pairs`` whose prefixes allow a link; ``nodes``: those of the pairs."""
        scratch = self.scratch
        pairs = scratch.stored(prefix_check(pairs, nodes, self.classes, self.rule, scratch), "join-pairs")
        wanted = scratch.stored(nodes_of(pairs), "join-wanted")
        nodes = _maybe(self.classes.select("node", "d", "t"), wanted, ["node"], scratch).join(wanted, "node")
        sets = scratch.stored(full_sets(self.docs, scratch.stored(nodes, "join-nodes"), self.rule, self.ranks, scratch), "join-sets")
        return scratch.stored(verify(pairs, sets, self.rule), "join-verified")

    def leads(self) -> DataFrame:
        """(node, lead, gap) of every marked class: of the sets it was verified with, the one most were."""
        ends = self.verified.select(F.col("a").alias("lead"), F.col("b").alias("node"), "gap")
        ends = ends.union(self.verified.select("b", "a", "gap"))
        ends = self.scratch.stored(ends.union(ends.select("lead", "lead", F.lit(0).cast("long")).distinct()), "join-ends")
        degree = ends.groupBy("lead").agg(F.count(F.lit(1)).alias("degree"))
        best = F.max_by(F.struct("lead", "gap"), F.struct("degree", "lead"))
        leads = ends.join(degree, "lead").groupBy("node").agg(best.alias("best"))
        return self.marked.join(leads.select("node", "best.lead", "best.gap"), "node", "left").select(
            "node", F.coalesce("lead", "node").alias("lead"), F.coalesce("gap", F.lit(0)).alias("gap")
        )


def linked_classes(join: Join) -> DataFrame:
    """Every pair (a, b) of classes that links, once: derived from a common leader, or verified."""
    scratch = join.scratch
    lists = _maybe(join.lists, join.marked, ["node"], scratch)
    leads = scratch.stored(join.leads(), "join-leads")
    answers = scratch.stored(answer_pairs(lists, join.classes, join.rule, leads, scratch), "join-answers")
    # a < b holds in all of them.
    rest = scratch.stored(answers.where("not sure").select("a", "b").join(join.seen, ["a", "b"], "left_anti"), "join-rest")
    linked = answers.where("sure").select("a", "b").union(join.found.select("a", "b"))
    if rest.head(1):
        linked = linked.union(join.compared(rest, nodes_of(rest)).where("linked").select("a", "b"))
    return linked.distinct()


def similar_pairs(docs: DataFrame, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """The join: every link of ``docs`` (doc_id, text), as (members, pairs).

    ``members`` has doc_id, n_shingles and class_id of every row; rows of one class_id have
    equal sets and link with each other. ``pairs`` has every two classes (a, b) whose
    sets link, a < b, once. Rows without shingles have a null class_id and no links.
    """
    scratch = Scratch(docs.sparkSession)
    join = Join(docs, rule, scratch)
    members = join.rows.select(
        F.nullif(F.col("d"), F.lit(LOWEST)).alias("doc_id"), F.col("n").alias("n_shingles"), F.col("node").alias("class_id")
    )
    out = stored(members, "join-members"), stored(linked_classes(join), "join-answer-links")
    scratch.drop()
    return out


def link_counts(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles and n_links of every row of ``docs`` (doc_id, text): how many other rows it links with."""
    members, pairs = similar_pairs(docs, rule)
    size = members.where("class_id is not null").groupBy("class_id").agg(F.count(F.lit(1)).alias("size"))
    size = stored(size, "join-sizes")
    both = pairs.union(pairs.select("b", "a")).toDF("class_id", "other")
    others = size.select(F.col("class_id").alias("other"), F.col("size").alias("more"))
    more = both.join(others, "other").groupBy("class_id").agg(F.sum("more").alias("more"))
    per_class = size.join(more, "class_id", "left").select(
        "class_id", (F.col("size") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")
    )
    return members.join(per_class, "class_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(d, t, n, component) of every row of ``docs`` (doc_id, text).

    ``d`` is the doc_id (null: the lowest long), ``t`` a hash of the text, ``n`` the set's
    size and ``component`` the smallest (d, t) reachable by links, itself included.
    """
    scratch = Scratch(docs.sparkSession)
    join = Join(docs, rule, scratch)
    # Marked classes without a link yet are components of their own.
    comps = connected(join.found, scratch)
    known = join.leads().join(comps, "node", "left").select("node", "lead", "gap", F.coalesce("root", "node").alias("root"))
    lists = _maybe(join.lists, join.marked, ["node"], scratch)
    pairs = candidate_pairs(lists, join.classes, rule, scratch, scratch.stored(known, "join-known"))
    pairs = scratch.stored(pairs.join(join.seen, ["a", "b"], "left_anti"), "join-later")
    if pairs.head(1):
        more = join.compared(pairs, nodes_of(pairs)).where("linked").select("a", "b")
        if more.head(1):
            # What is known so far, one edge a class, and the new links.
            comps = connected(comps.select(F.col("root").alias("a"), F.col("node").alias("b")).union(more), scratch)

    own = F.struct("d", "t")
    rooted = join.classes.select("node", "d", "t").join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = rooted.groupBy("root").agg(F.min(own).alias("component"))
    by_node = rooted.select("node", "root").join(lowest, "root").select("node", "component")
    out = join.rows.join(by_node, "node", "left").select("d", "t", "n", F.coalesce("component", own).alias("component"))
    out = stored(out, "join-components")
    scratch.drop()
    return out


def components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable by links, the row's own included.
    Null and empty texts, and texts of white space, have no shingles and link with
    nothing. A text with fewer words than a shingle has is one shingle. Repeated
    rows link with each other like any equal texts. A null doc_id counts as the
    lowest id and is returned as null, also as a component_id. A text of any length is
    one set of all its shingles. Other columns are not read. An empty table gives an
    empty result.
    """
    shown = lambda c: F.nullif(F.col(c), F.lit(LOWEST))
    return near_duplicates(docs, rule).select(
        shown("d").alias("doc_id"), F.col("n").alias("n_shingles"), shown("component.d").alias("component_id")
    )


def keep_one(docs: DataFrame, rule: Rule) -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the smallest doc_id stays.

    Rows alike in doc_id and text are one document, which stays once if it has words.
    Texts without words all stay. All columns are kept.
    """
    found = near_duplicates(docs, rule)
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    t = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumn("_join_d", d).withColumn("_join_t", t)
    keys = [F.col("d").alias("_join_d"), F.col("t").alias("_join_t")]
    out = keyed.join(found.where("struct(d, t) <> component").select(*keys).distinct(), ["_join_d", "_join_t"], "left_anti")
    again = found.where("n > 0").groupBy("d", "t").count().where("count > 1").select(*keys)
    if again.head(1):
        once = out.join(again, ["_join_d", "_join_t"], "left_semi").dropDuplicates(["_join_d", "_join_t"])
        out = out.join(again, ["_join_d", "_join_t"], "left_anti").unionByName(once)
    return out.select(*names)
