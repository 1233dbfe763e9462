"""Cross-tokenizer alignment by merge-path partitioning.

A text is encoded by two tokenizers, A (byte-level BPE, over a space and the text) and B
(pieces with byte fallback, which adds the space itself). Both token sequences spell the
same bytes, so their end offsets are two ascending lists, and the merged list of ends cuts
the bytes into stretches that lie in one A token and one B token: the links. Where an
end of A equals one of B, a group closes.

The texts of a batch lie end to end, so one merge serves them all. It is divided along
diagonals: piece ``p`` starts where ``p * PIECE_ENDS`` ends are taken, and a binary search on
that diagonal says how many of them are A's (on equal ends A's comes first). The pieces
are independent and of equal work, however long a text is. Each emits its overlaps and
the ends that close groups; a group that spans pieces is stitched from the cuts around it.

Corpus-wide counts. An id pair's count is the number of documents that hold it linked.
Texts are worked on in blocks of about ``BLOCK_BYTES``. A block's links are stored with its
documents; its distinct pairs, with the number of its documents that hold each, are
summed over all blocks. Each block then gets the counts of its own pairs back, in parts by
A id, so nothing that grows with the corpus is broadcast or held by one task.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import Scratch, slices, stored, utf8_column

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Ends of one piece of a merge.
PIECE_ENDS = 1 << 16
#: Bytes of text tokenised together, and of a block.
SLICE_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20

_DOCS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


# ------------------------------------------------------------------ merge path


def diagonal(a: np.ndarray, b: np.ndarray, d: int) -> int:
    """How many of the first ``d`` ends of the merge are A's (binary search; A first on equal ends)."""
    low, high = max(0, d - len(b)), min(d, len(a))
    while low < high:
        i = (low + high) // 2
        if a[i] <= b[d - i - 1]:
            low = i + 1
        else:
            high = i
    return low


def pieces(a: np.ndarray, b: np.ndarray, size: int = PIECE_ENDS) -> list[tuple[int, int, int, int]]:
    """(i0, i1, j0, j1): the parts of both lists that each piece of the merge takes."""
    total = len(a) + len(b)
    cuts = [(i := diagonal(a, b, d), d - i) for d in range(0, total, size)] + [(len(a), len(b))]
    return [(i0, i1, j0, j1) for (i0, j0), (i1, j1) in zip(cuts[:-1], cuts[1:])]


def merge_piece(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token) of the piece's links in order, and which of them close a group.

    A stretch ends at each distinct end. An end that A has alone lies in the B token whose end is
    next, and the other way round; all searches stay within the piece.
    """
    own_a, own_b = a[i0:i1], b[j0:j1]
    in_b = j0 + np.searchsorted(own_b, own_a, "left")
    in_a = i0 + np.searchsorted(own_a, own_b, "left")
    # B ends that A has too are A's stretch, also if the cut falls between the two.
    equal = np.zeros(len(own_b), bool)
    inside = in_a < i1
    equal[inside] = a[in_a[inside]] == own_b[inside]
    if i0 and len(own_b):
        equal |= own_b == a[i0 - 1]
    x = np.concatenate([np.arange(i0, i1), in_a[~equal]])
    y = np.concatenate([in_b, j0 + np.flatnonzero(~equal)])
    closes = np.zeros(len(x), bool)
    there = in_b < len(b)
    closes[: len(own_a)][there] = b[in_b[there]] == own_a[there]
    order = np.argsort(np.concatenate([own_a, own_b[~equal]]), kind="stable")
    return x[order], y[order], closes[order]


def align(a: np.ndarray, b: np.ndarray, size: int = PIECE_ENDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, closes a group) of every link, from the pieces of the merge one after another."""
    parts = [merge_piece(a, b, *piece) for piece in pieces(a, b, size)]
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*parts))


# ------------------------------------------------------------------ tokenizers


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY_A), public_tokenizers.path(VOCABULARY_B)


class Pair:
    """Both tokenizers and the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        from visitflow.llm.bpe import _byte_characters

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: b for b, c in enumerate(_byte_characters())}
        entries_a = [b""] * (max(self.a.get_vocab(True).values()) + 1)
        for entry, at in self.a.get_vocab(True).items():
            # An entry outside the alphabet is a special one, which no text is encoded to.
            entries_a[at] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        entries_b = []
        for at in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(at)
            entries_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(at) else piece.replace("▁", " ").encode())
        self.entries = (entries_a, entries_b)
        self.sizes = tuple(np.array([len(x) for x in e], np.int64) for e in self.entries)
        self.n_b = len(entries_b)
        if len(entries_a) * self.n_b >= 1 << 31:
            raise ValueError("an id pair must fit in 31 bits")
        # Decimal ids with the mark that follows them: A's "," and "|", B's "," and ";".
        marked = [[f"{i}{mark}" for i in range(len(e))] for e, marks in zip(self.entries, (",|", ",;")) for mark in marks]
        self.marked = np.array(sum(marked, []), object)
        self.marks = np.cumsum([0] + [len(x) for x in marked])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both tokenizers; two empty lists where the tokens don't spell the space and the text."""
        ids_a = [np.array(e.ids, np.int64) for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        ids_b = [np.array(x, np.int64) for x in self.b.encode(texts, num_threads=1)]
        entries_a, entries_b = self.entries
        none = np.zeros(0, np.int64)
        for at, text in enumerate(texts):
            spelt = b" " + text.encode()
            same = bool(text) and all(
                b"".join([entries[i] for i in ids[at].tolist()]) == spelt for entries, ids in ((entries_a, ids_a), (entries_b, ids_b))
            )
            if not same:
                ids_a[at] = ids_b[at] = none
        return ids_a, ids_b


@functools.lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def aligned(pair: Pair, ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
    """For each text n_a, n_b, n_groups, n_links, the groups' digest, its distinct linked pairs and how often each links."""
    count_a, count_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    all_a, all_b = np.concatenate([*ids_a, np.zeros(0, np.int64)]), np.concatenate([*ids_b, np.zeros(0, np.int64)])
    x, y, closes = align(np.cumsum(pair.sizes[0][all_a]), np.cumsum(pair.sizes[1][all_b]))
    # Every text ends a group, so links, groups and tokens all split by text.
    last_a, last_b = np.cumsum(count_a), np.cumsum(count_b)
    link_to = np.searchsorted(x, last_a, "left")
    group_to = np.concatenate([[0], np.cumsum(closes)])[link_to]
    # Tokens in the order they are written: a group's A tokens, then its B tokens.
    shut_a, shut_b = x[closes], y[closes]  # last tokens of each group
    size_a, size_b = np.diff(np.concatenate([[-1], shut_a])), np.diff(np.concatenate([[-1], shut_b]))
    group_a, group_b = np.repeat(np.arange(len(shut_a)), size_a), np.repeat(np.arange(len(shut_b)), size_b)
    before_b = np.cumsum(size_b) - size_b
    code = np.empty(len(all_a) + len(all_b), np.int64)
    ends_a, ends_b = np.zeros(len(all_a), np.int64), np.zeros(len(all_b), np.int64)
    ends_a[shut_a], ends_b[shut_b] = 1, 1
    code[np.arange(len(all_a)) + before_b[group_a]] = pair.marks[ends_a] + all_a
    code[np.arange(len(all_b)) + np.cumsum(size_a)[group_b]] = pair.marks[2 + ends_b] + all_b
    words = pair.marked[code].tolist()
    linked = all_a[x] * pair.n_b + all_b[y]
    link, group, word = 0, 0, 0
    for at in range(len(ids_a)):
        n_a, n_b = int(count_a[at]), int(count_b[at])
        if not n_a:
            yield 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        to, groups = int(link_to[at]), int(group_to[at])
        shown = "".join(words[word : word + n_a + n_b])[:-1]
        pairs, times = np.unique(linked[link:to], return_counts=True)
        yield n_a, n_b, groups - group, to - link, hashlib.sha256(shown.encode()).hexdigest(), pairs, times
        link, group, word = to, groups, word + n_a + n_b


# ------------------------------------------------------------------ corpus


def _aligned_docs(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """A row for each row of ``docs`` with its block, figures and linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(*paths)
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            body, offsets = utf8_column(batch.column("text"))
            for first, last in slices(offsets, SLICE_BYTES):
                size = int(offsets[last] - offsets[first])
                if held and held + size > BLOCK_BYTES:
                    block, held = block + 1, 0
                held += size
                texts = [x or "" for x in batch.column("text").slice(first, last - first).to_pylist()]
                rows = list(aligned(pair, *pair.encode(texts)))
                columns = [list(c) for c in zip(*rows)]
                figures = [pa.array(c, pa.int64()) for c in columns[:4]]
                packed = [pa.array([x.astype("<i4").tobytes() for x in c], pa.binary()) for c in columns[5:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(rows), pa.int64()), batch.column("doc_id").slice(first, last - first), *figures, pa.array(columns[4]), *packed],
                    ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _DOCS)


def _block_pairs(docs: DataFrame) -> DataFrame:
    """(block, pair, docs): a block's distinct pairs and how many of its documents hold each linked.

    A block is one run of rows of one task's part file; should a reader cut it in two, both
    halves ask for their own pairs, which changes no sum.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(block: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            pairs, count = np.unique(np.concatenate(held), return_counts=True)
            if len(pairs):
                blocks = pa.array(np.full(len(pairs), block, np.int64))
                yield pa.RecordBatch.from_arrays([blocks, pa.array(pairs.astype(np.int32)), pa.array(count)], ["block", "pair", "docs"])

        now, held = None, []
        for batch in batches:
            for block, pairs in zip(batch.column("block").to_pylist(), batch.column("pairs")):
                if block != now and held:
                    yield from told(now, held)
                    held = []
                now = block
                held.append(np.frombuffer(pairs.as_buffer(), "<i4"))
        if held:
            yield from told(now, held)

    return docs.select("block", "pairs").mapInArrow(run, "block long, pair int, docs long")


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Alignment of every whole text of ``docs`` (doc_id, text) under two tokenizers.

    Returns for each row doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose
    pair's count is the highest of its A id in the corpus, ties included), count_sum (counts
    summed over links) and groups_sha256 (of the groups' ids, ``a1,a2|b1;a3|b2,b3``).

    ``paths``: the two vocabulary files, on every machine. Texts that are null, empty, or not
    spelt byte for byte by either tokenizer (B normalises some characters, and writes U+2581
    as a space) have no tokens: zeros and an empty digest. A text of any length is tokenised
    whole, in one task. Repeated rows are documents of their own and count each; a null
    doc_id is returned as null. Other columns are not read. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    paths = paths or default_paths()
    per_doc = scratch.stored(_aligned_docs(docs, paths), "align-docs")
    asked = scratch.stored(_block_pairs(per_doc), "align-asked")
    n_b = load(*paths).n_b
    a = F.floor(F.col("pair") / n_b).cast("int")
    counts = asked.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", a)
    counts = scratch.stored(counts, "align-counts")
    best = counts.groupBy("a").agg(F.max("docs").alias("most"))
    counts = counts.join(best, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    told = asked.select("block", "pair").join(counts, "pair").repartition("block").sortWithinPartitions("block", "pair")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def packed() -> pa.RecordBatch:
            pair, count, best = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_pydict(
                {"block": [now], "b_pairs": [pair.tobytes()], "b_docs": [count.tobytes()], "b_best": [best.tobytes()]}
            )

        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]])
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "docs", "best")]
            for x, y in zip(cuts[:-1], cuts[1:]):
                if x == y:
                    continue
                if block[x] != now and held:
                    yield packed()
                    held = []
                now = int(block[x])
                held.append(tuple(c[x:y] for c in columns))
        if held:
            yield packed()

    told = scratch.stored(told.mapInArrow(pack, "block long, b_pairs binary, b_docs binary, b_best binary"), "align-told")

    # A block's answer is some MB: it goes to the block once, ahead of its documents.
    answers = told.select("block", F.lit(0).alias("kind"), "b_pairs", "b_docs", "b_best", *[F.lit(None).alias(c) for c in per_doc.columns[1:]])
    rows = per_doc.select("block", F.lit(1).alias("kind"), *[F.lit(None).cast("binary").alias(c) for c in ("b_pairs", "b_docs", "b_best")], *per_doc.columns[1:])
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = count = best = np.zeros(0, np.int64)
        for batch in batches:
            kinds = batch.column("kind").to_pylist()
            out, n_best, count_sum = [], [], []
            for at, kind in enumerate(kinds):
                if kind == 0:  # the answer of the block whose documents follow
                    pairs, count, best = (
                        np.frombuffer(batch.column(c)[at].as_buffer(), t) for c, t in (("b_pairs", np.int32), ("b_docs", np.int64), ("b_best", bool))
                    )
                    continue
                own, times = (np.frombuffer(batch.column(c)[at].as_buffer(), "<i4") for c in ("pairs", "times"))
                to = np.searchsorted(pairs, own)
                out.append(at)
                n_best.append(int(times[best[to]].sum()) if len(own) else 0)
                count_sum.append(int((times * count[to]).sum()) if len(own) else 0)
            got = batch.select(keep).take(pa.array(out, pa.int64()))
            yield pa.RecordBatch.from_arrays([*got.columns, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())], [*keep, "n_best", "count_sum"])

    dealt = answers.unionByName(rows).repartition("block").sortWithinPartitions("block", "kind")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    out = stored(dealt.mapInArrow(finish, schema), "align-result")
    scratch.drop()
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
