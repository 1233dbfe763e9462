"""Ranked lexical search over a length-stratified index.

A document of ``n`` terms has the integer normaliser ``m = 100 - 25 + (25 * n * N) div L`` (N
documents with terms, L terms in all). Documents with equal m form a stratum: in it a
term's impact depends on its count in the document alone.

Index. Each task packs its documents into blocks of about ``BLOCK_TERMS`` terms. In a
block, the postings (document, tf) of a term are ordered by stratum and, within a
stratum, by tf; the document's place in the block stands for its id. Blocks are stored
as a table and hold every term of every text.

Search. A task takes the index a block at a time. An impact is computed once for each
(term, stratum, tf); the largest tf of a term in a stratum bounds what it adds there, so
the sum over an item's terms bounds every score of the stratum. An item visits strata in the order of
these bounds and stops where a bound is below its 20th best score so far, which
it carries on to the task's next blocks. What tasks keep, at most 20 a task and item, is ranked last.

Terms are known by 64-bit hashes of their lower-cased bytes; two of M distinct terms
share one with a chance of about M**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitflow.llm.common import Scratch, slices, stored, utf8_column, word_hashes, word_spans

#: Terms of a block; a longer text is a block of its own.
BLOCK_TERMS = 2_000_000
PIECE_BYTES = 4 << 20
#: Terms of the items that are searched for together, about.
ITEM_TERMS = 200_000
#: Documents of the strata that an item visits together, at least.
VISIT_DOCS = 512
LOWEST = -(2**63)

# Fixed values of the score: m = BASE + (SLOPE * n * N) div L, impact = (SCALE * tf) div (TF * tf + M * m).
BASE, SLOPE = 75, 25
SCALE, TF, M = 1_000_000_000, 1000, 12

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes outside every term: ASCII but for letters and digits.
_BREAK = np.zeros(256, bool)
_BREAK[:128] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _BREAK[_a:_b] = False

_BLOCK = "docs binary, m binary, terms binary, starts binary, post_doc binary, post_tf binary"


def term_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, row of each term counted from the first, its hash), some MB of text at a time."""
    body, offsets = utf8_column(column)
    for first, last in slices(offsets, PIECE_BYTES):
        part = _LOWER[body[offsets[first] : offsets[last]]]
        starts, ends, rows = word_spans(part, offsets[first : last + 1] - offsets[first], _BREAK)
        yield first, last, rows, word_hashes(part, starts, ends)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """N and L: documents with at least one term, and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for batch in batches:
            body, offsets = utf8_column(batch.column("text"))
            for first, last in slices(offsets, PIECE_BYTES):
                part = body[offsets[first] : offsets[last]]
                _, _, rows = word_spans(part, offsets[first : last + 1] - offsets[first], _BREAK)
                documents += len(np.unique(rows))
                terms += len(rows)
        yield pa.RecordBatch.from_pydict({"documents": [documents], "terms": [terms]})

    counted = _keyed(docs).select("text").mapInArrow(run, "documents long, terms long")
    n, total = counted.agg(F.sum("documents"), F.sum("terms")).first()
    return int(n or 0), int(total or 0)


class Building:
    """Documents of the block being built."""

    def __init__(self, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.clear()

    def clear(self) -> None:
        self.ids, self.lengths, self.rows, self.hashes, self.held = [], [], [], [], 0
        self.documents = 0

    def add(self, ids: np.ndarray, rows: np.ndarray, hashes: np.ndarray) -> None:
        lengths = np.bincount(rows, minlength=len(ids))
        used = np.flatnonzero(lengths)  # a text without terms is not in the index
        place = np.cumsum(lengths > 0) - 1 + self.documents
        self.ids.append(ids[used])
        self.lengths.append(lengths[used])
        self.rows.append(place[rows].astype(np.int32))
        self.hashes.append(hashes)
        self.held += len(rows)
        self.documents += len(used)

    def block(self) -> pa.RecordBatch:
        ids, n = np.concatenate(self.ids), np.concatenate(self.lengths).astype(np.int64)
        m = np.array([BASE + (SLOPE * int(x) * self.n_docs) // self.n_terms for x in n.tolist()], np.int64)
        # Documents are renumbered by stratum, and by id within one.
        order = np.lexsort((ids, m))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        terms, term = np.unique(np.concatenate(self.hashes), return_inverse=True)
        pair = term * len(ids) + place[np.concatenate(self.rows)]
        pair, tf = np.unique(pair, return_counts=True)
        term, doc = pair // len(ids), pair % len(ids)
        stratum = np.unique(m[order], return_inverse=True)[1]
        by = np.lexsort((doc, tf, stratum[doc], term))
        columns = {
            "docs": ids[order],
            "m": m[order],
            "terms": terms,
            "starts": np.searchsorted(term[by], np.arange(len(terms) + 1)),
            "post_doc": doc[by].astype(np.int32),
            "post_tf": tf[by].astype(np.int32),
        }
        self.clear()
        return pa.RecordBatch.from_pydict({k: pa.array([x.tobytes()], pa.large_binary()).cast(pa.binary()) for k, x in columns.items()})


def build(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The index of ``docs`` (doc_id, text), a row a block; see the module's text for its layout."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        building = Building(n_docs, n_terms)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for first, last, rows, hashes in term_hashes(batch.column("text")):
                if building.held and building.held + len(rows) > BLOCK_TERMS:
                    yield building.block()
                if len(rows):
                    building.add(ids[first:last], rows, hashes)
        if building.held:
            yield building.block()

    return _keyed(docs).mapInArrow(run, _BLOCK)


class Block:
    """One block of the index, read."""

    def __init__(self, row: dict):
        self.docs, self.m = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["m"], np.int64)
        self.terms, self.starts = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["starts"], np.int64)
        self.post_doc, self.post_tf = np.frombuffer(row["post_doc"], np.int32), np.frombuffer(row["post_tf"], np.int32)
        self.stratum_m, self.first = np.unique(self.m, return_index=True)
        self.ends = np.append(self.first[1:], len(self.m))

    def at(self, vocabulary: np.ndarray) -> np.ndarray:
        """Place of each term of the sorted ``vocabulary`` in the block, or -1."""
        at = np.searchsorted(self.terms, vocabulary)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == vocabulary, at, -1) if len(self.terms) else np.full(len(vocabulary), -1)


def document_counts(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """In how many documents each term of the sorted ``vocabulary`` (hashes) occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, starts in zip(batch.column("terms"), batch.column("starts")):
                terms, starts = np.frombuffer(terms.as_buffer(), np.uint64), np.frombuffer(starts.as_buffer(), np.int64)
                at = np.searchsorted(terms, vocabulary)
                at[at == len(terms)] = 0
                df += np.where(terms[at] == vocabulary, starts[at + 1] - starts[at], 0)
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(df[found])], ["term", "df"])

    counts = index.select("terms", "starts").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(len(vocabulary), np.int64)
    for row in counts.collect():  # one row a term of the items searched for
        out[row["term"]] = row["df"]
    return out


class Item:
    """Terms of one item (places in the vocabulary) with their weights, repeats included, and its best so far."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, k: int):
        self.terms, self.weights, self.k = terms, weights, k
        self.scores, self.docs = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        """Lowest score that can still enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, docs: np.ndarray) -> None:
        scores, docs = np.concatenate([self.scores, scores]), np.concatenate([self.docs, docs])
        best = np.lexsort((docs, -scores))[: self.k]
        self.scores, self.docs = scores[best], docs[best]


def search_block(block: Block, vocabulary: np.ndarray, items: list[Item]) -> None:
    """Offer every item its best documents of the block."""
    at = block.at(vocabulary)
    here = np.flatnonzero(at >= 0)
    if not len(here):
        return
    size = block.starts[at[here] + 1] - block.starts[at[here]]
    begin = np.concatenate([[0], np.cumsum(size)])
    post = np.arange(begin[-1]) - np.repeat(begin[:-1] - block.starts[at[here]], size)
    doc, tf = block.post_doc[post], block.post_tf[post].astype(np.int64)
    strata = len(block.stratum_m)
    stratum = np.searchsorted(block.first, doc, "right") - 1
    term = np.repeat(np.arange(len(here)), size)
    # One impact for each run of equal (term, stratum, tf).
    new = np.ones(len(doc), bool)
    new[1:] = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1]) | (tf[1:] != tf[:-1])
    run = np.flatnonzero(new)
    run_impact = (SCALE * tf[run]) // (TF * tf[run] + M * block.stratum_m[stratum[run]])
    impact = run_impact[np.cumsum(new) - 1]
    # Postings of a (term, stratum): a range, whose last impact is the largest.
    cell = term * strata + stratum
    bounds = np.searchsorted(cell, np.arange(len(here) * strata + 1)).reshape(-1)
    low, high = bounds[:-1].reshape(-1, strata), bounds[1:].reshape(-1, strata)
    most = np.where(high > low, impact[np.maximum(high - 1, 0)], 0)
    place = np.full(len(vocabulary), -1)
    place[here] = np.arange(len(here))
    docs_in = block.ends - block.first

    for item in items:
        own = place[item.terms]
        used = own >= 0
        own, weight = own[used], item.weights[used]
        if not len(own):
            continue
        bound = (weight[:, None] * most[own]).sum(axis=0)
        order = np.argsort(-bound, kind="stable")
        done = 0
        while done < strata and bound[order[done]] >= max(item.floor, 1):
            upto = done + int(np.searchsorted(np.cumsum(docs_in[order[done:]]), VISIT_DOCS)) + 1
            some = order[done:upto]
            some = some[bound[some] >= item.floor]
            done = upto
            a, b = low[own][:, some].ravel(), high[own][:, some].ravel()
            count = b - a
            to = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(a, count)
            value = impact[to] * np.repeat(np.repeat(weight, len(some)), count)
            # Documents of the visited strata, side by side.
            offset = np.zeros(strata, np.int64)
            width = docs_in[some]
            offset[some] = np.cumsum(width) - width - block.first[some]
            seat = doc[to] + offset[stratum[to]]
            score = np.zeros(int(width.sum()), np.int64)
            np.add.at(score, seat, value)
            passed = np.flatnonzero(score >= item.floor)
            if len(passed) > item.k:
                kth = np.partition(score[passed], -item.k)[-item.k]
                passed = passed[score[passed] >= kth]
            if len(passed):
                back = np.repeat(-offset[some], width)
                item.offer(score[passed], block.docs[passed + back[passed]])


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def _search_some(index: DataFrame, names: np.ndarray, owner: np.ndarray, hashes: np.ndarray, n_docs: int, k: int) -> DataFrame:
    """Best documents of the items ``names``; term i, ``hashes[i]``, belongs to item ``owner[i]``."""
    vocabulary, term = np.unique(hashes, return_inverse=True)
    weight = term_weights(document_counts(index, vocabulary), n_docs)
    pair, repeats = np.unique(owner * len(vocabulary) + term, return_counts=True)
    first = np.searchsorted(pair // max(1, len(vocabulary)), np.arange(len(names) + 1))
    terms = pair % max(1, len(vocabulary))
    weights = weight[terms] * repeats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [Item(terms[a:b], weights[a:b], k) for a, b in zip(first[:-1], first[1:])]
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_buffer() for c in batch.schema.names}
                search_block(Block(row), vocabulary, items)
        count = [len(x.docs) for x in items]
        columns = [np.repeat(np.arange(len(items)), count), np.concatenate([x.docs for x in items]), np.concatenate([x.scores for x in items])]
        yield pa.RecordBatch.from_arrays([pa.array(names[columns[0]]), pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2])], ["item_id", "at", "doc_id", "score"])

    return index.mapInArrow(run, "item_id long, at long, doc_id long, score long")


def search(items: DataFrame, docs: DataFrame, k: int = 20, item_terms: int = ITEM_TERMS) -> DataFrame:
    """The ``k`` highest-scoring documents for each row of ``items`` (item_id, text).

    ``docs`` has doc_id and text. Returns item_id, rank (from 1), doc_id and score; only scores
    above 0, equal scores by ascending doc_id. Whole texts are read.

    Items are searched for in blocks of about ``item_terms`` terms, so that neither the driver nor
    a task holds more items at a time; each block reads the index once.

    Null and empty texts have no terms: such documents count in nothing, such items
    get no rows. A null doc_id counts as the lowest id and is returned as null; rows with a null
    item_id take no part. Rows that repeat a document are documents of their own, and
    may follow each other in the ranks. Items alike in id and text are one; others
    that share an id are ranked apart. Other columns are not read. Empty tables give an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    n_docs, n_terms = corpus_size(docs)
    index = scratch.stored(build(docs, n_docs, max(1, n_terms)), "lexical-index")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = asked.where(F.col("item_id").isNotNull()).distinct()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, rows, hashes in term_hashes(batch.column("text")):
                bounds = np.searchsorted(rows, np.arange(last - first + 1))
                packed = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                count = pa.array(np.diff(bounds))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").slice(first, last - first), pa.array(packed, pa.binary()), count], ["item_id", "terms", "count"]
                )

    asked = scratch.stored(asked.mapInArrow(split, "item_id long, terms binary, count long").where("count > 0"), "lexical-items")
    total = asked.agg(F.sum("count")).first()[0] or 0
    blocks = -(-total // item_terms)
    found = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block)
        rows = sorted((r["item_id"], bytes(r["terms"])) for r in own.select("item_id", "terms").toLocalIterator())
        if not rows:
            continue
        terms = [np.frombuffer(x, np.uint64) for _, x in rows]
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in terms])
        names = np.array([i for i, _ in rows], np.int64)
        part = _search_some(index, names, owner, np.concatenate(terms), n_docs, k).withColumn("block", F.lit(block))
        found = part if found is None else found.unionByName(part)
    if found is None:
        scratch.drop()
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    ranked = Window.partitionBy("block", "at").orderBy(F.desc("score"), "doc_id")
    best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    out = stored(best.select("item_id", "rank", F.nullif("doc_id", F.lit(LOWEST)).alias("doc_id"), "score"), "lexical-result")
    scratch.drop()
    return out
