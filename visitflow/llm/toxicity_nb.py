"""Toxicity: a character n-gram linear classifier on naive Bayes features.

The features are the distinct character n-grams (``ORDERS`` code points of the
lower-cased text) in hashed buckets. Each is scaled by its naive Bayes log-count ratio

    r = log((1 + toxic texts with it) / total) - log((1 + other texts with it) / total)

and a logistic regression is fitted on the scaled features. Buckets seen in fewer than
``MIN_TEXTS`` training texts, or with a ratio near 0, carry no weight.

Training takes one bounded sample of labelled rows (``SAMPLE_ROWS``) in one task;
scoring runs over every whole text, a slice of a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import held_out, labelled_sample, mix64, slices, utf8_column

ORDERS = (3, 4, 5, 6, 7, 8)
BUCKET_BITS = 22
SAMPLE_ROWS = 8192
MIN_TEXTS = 4
MIN_RATIO = 2.0
RIDGE = 0.002
#: Most that a rare class's rows are weighed up.
MOST_WEIGHT = 2.0
ROUNDS = 120
THRESHOLD = 0.7
#: Pairs of a text and a feature that a training step sums together.
STEP_PAIRS = 1 << 19
#: Bytes of text worked on at a time; a longer text is read in overlapping pieces.
PIECE_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _lowered(column: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.utf8_lower(column.fill_null(""))


def ngram_buckets(
    body: np.ndarray, offsets: np.ndarray, cut: tuple[bool, bool] = (False, False)
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: (position, bucket) of the n-grams that lie inside one text; ``body`` holds code points.

    Every text gets a space at both ends, so a word's first and last letters show. Where the
    first text begins or the last one ends at a ``cut`` of a longer text, there is no such space.
    """
    n_rows = len(offsets) - 1
    lengths = np.diff(offsets)
    starts = offsets[:-1] + 2 * np.arange(n_rows) + 1
    padded = np.full(len(body) + 2 * n_rows, 32, body.dtype)
    padded[np.arange(len(body)) + np.repeat(starts - offsets[:-1], lengths)] = body
    last = np.zeros(len(padded), bool)  # closing space of each text
    last[starts + lengths] = True
    code = padded.astype(np.uint64)
    shift = np.uint64(64 - BUCKET_BITS)
    gram, crossing = code.copy(), last.copy()
    for order in range(2, max(ORDERS) + 1):
        m = len(padded) - order + 1
        if m <= 0:
            return
        gram = gram[:m] * _STEP + code[order - 1 :]
        if order > 2:
            crossing = crossing[:m] | last[order - 2 : order - 2 + m]
        else:
            crossing = last[:m].copy()
        if order in ORDERS:
            at = np.flatnonzero(~crossing)
            at = at[(at >= cut[0]) & (at + order <= len(padded) - cut[1])]
            yield at, (mix64(gram[at] ^ (np.uint64(order) << np.uint64(56))) >> shift).astype(np.int64)


def _points(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets as code points and theirs."""
    if not len(body) or body.max() < 128:
        return body, offsets
    points = np.frombuffer(body.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])[offsets]


def _pieces(
    body: np.ndarray, offsets: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, tuple[bool, bool]]]:
    """(code points, offsets, rows, cut) of at most about PIECE_BYTES bytes.

    A long text comes in pieces that overlap by an n-gram; ``cut`` says at which ends a piece is cut,
    so together they hold the n-grams of the whole text, no more and no less.
    """

    def edge(at: int, end: int) -> int:
        while at < end and body[at] & 0xC0 == 0x80:  # inside a character
            at += 1
        return min(at, end)

    for first, last in slices(offsets, PIECE_BYTES):
        own = offsets[first : last + 1]
        if own[-1] - own[0] <= PIECE_BYTES or last - first > 1:
            yield *_points(body[own[0] : own[-1]], own - own[0]), np.arange(first, last), (False, False)
            continue
        begin, end = int(own[0]), int(own[-1])
        for at in range(begin, end, PIECE_BYTES):
            to = edge(at + PIECE_BYTES + 4 * max(ORDERS), end)
            part = body[edge(at, end) : to]
            yield *_points(part, np.array([0, len(part)])), np.array([first]), (at > begin, to < end)
            if to == end:
                break


def _features(column: pa.Array, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs of a batch; ``of`` maps a bucket to its feature or -1."""
    body, offsets = utf8_column(_lowered(column))
    rows, features = [], []
    width = int(of.max()) + 2
    for part, ends, own, cut in _pieces(body, offsets):
        found = []
        starts = ends[:-1] + 2 * np.arange(len(ends) - 1)
        for at, bucket in ngram_buckets(part, ends, cut):
            feature = of[bucket]
            hit = np.flatnonzero(feature >= 0)
            row = np.searchsorted(starts, at[hit], "right") - 1
            found.append(own[row] * width + feature[hit])
        if found:
            pairs = np.unique(np.concatenate(found))
            rows.append(pairs // width)
            features.append(pairs % width)
    if not rows:
        none = np.zeros(0, np.int64)
        return none, none
    pairs = np.unique(np.concatenate(rows) * width + np.concatenate(features))
    return pairs // width, pairs % width


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Model:
    """``of``: bucket -> feature or -1; ``weight``: of each feature, the ratio included; ``bias``."""

    def __init__(self, of: np.ndarray, weight: np.ndarray, bias: float):
        self.of, self.weight, self.bias = of, weight, bias

    def __reduce__(self):
        """Sent to a task as the used buckets and their weights, not as the whole table."""
        used = np.flatnonzero(self.of >= 0)
        return _model, (used[np.argsort(self.of[used])].astype(np.int32), self.weight, self.bias)

    def score(self, column: pa.Array) -> np.ndarray:
        if len(self.weight) == 0:
            return np.full(len(column), float(sigmoid(np.array(self.bias))))
        rows, features = _features(column, self.of)
        return sigmoid(self.bias + np.bincount(rows, self.weight[features], len(column)))


def _model(used: np.ndarray, weight: np.ndarray, bias: float) -> Model:
    of = np.full(1 << BUCKET_BITS, -1, np.int32)
    of[used] = np.arange(len(used))
    return Model(of, weight, bias)


def fit(texts: pa.Array, labels: np.ndarray) -> Model:
    """Fit on labelled texts (in a fixed order). One class only: a constant score."""
    buckets = 1 << BUCKET_BITS
    toxic, n = int(labels.sum()), len(labels)
    prior = float(np.log((toxic + 1) / (n - toxic + 1)))
    none = Model(np.full(buckets, -1, np.int32), np.zeros(0), prior)
    if not 0 < toxic < n:
        return none
    counts = np.zeros((2, buckets), np.int32)
    # A bucket counts once a text: its last text, and the last place it was met at.
    last, place = np.full(buckets, -1, np.int32), np.zeros(buckets, np.int32)
    for at, y in enumerate(labels.tolist()):
        body, offsets = utf8_column(_lowered(texts.slice(at, 1)))
        for part, ends, _, cut in _pieces(body, offsets):
            for _, bucket in ngram_buckets(part, ends, cut):
                here = np.arange(len(bucket), dtype=np.int32)
                place[bucket] = here
                new = bucket[(place[bucket] == here) & (last[bucket] != at)]
                last[new] = at
                counts[y, new] += 1
    del last, place
    seen = np.flatnonzero(counts[0] + counts[1] >= MIN_TEXTS)
    ratio = np.log((counts[1, seen] + 1.0) / (toxic + 2)) - np.log((counts[0, seen] + 1.0) / (n - toxic + 2))
    del counts
    strong = np.abs(ratio) >= MIN_RATIO
    used, scale = seen[strong], ratio[strong]
    if not len(used):
        return none
    of = none.of
    of[used] = np.arange(len(used))
    rows, features = [], []
    for first in range(0, n, 256):
        r, f = _features(texts.slice(first, 256), of)
        rows.append((r + first).astype(np.int32))
        features.append(f.astype(np.int32))
    # Pairs of a text and a feature are kept narrow and summed some at a time.
    rows, features = np.concatenate(rows), np.concatenate(features)
    parts = [slice(i, i + STEP_PAIRS) for i in range(0, len(rows), STEP_PAIRS)]
    # Both classes weigh half, the rarer one at most MOST_WEIGHT times its rows.
    class_weight = np.where(labels == 1, min(MOST_WEIGHT, n / (2 * toxic)), min(MOST_WEIGHT, n / (2 * (n - toxic))))
    w, b = np.zeros(len(used)), prior
    m_w, v_w, m_b, v_b, rate = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0, 0.05
    for step in range(1, ROUNDS + 1):  # Adam on the whole sample
        scaled = w * scale
        margin = sum(np.bincount(rows[part], scaled[features[part]], n) for part in parts)
        off = (sigmoid(b + margin) - labels) * class_weight
        g_w = sum(np.bincount(features[part], off[rows[part]], len(used)) for part in parts) * scale / n + RIDGE * w
        g_b = off.mean()
        m_w, v_w = 0.9 * m_w + 0.1 * g_w, 0.999 * v_w + 0.001 * g_w * g_w
        m_b, v_b = 0.9 * m_b + 0.1 * g_b, 0.999 * v_b + 0.001 * g_b * g_b
        fix_m, fix_v = 1 - 0.9**step, 1 - 0.999**step
        w -= rate * (m_w / fix_m) / (np.sqrt(v_w / fix_v) + 1e-8)
        b -= rate * (m_b / fix_m) / (np.sqrt(v_b / fix_v) + 1e-8)
    return Model(of, w * scale, float(b))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit in one task on at most ``sample_rows`` labelled rows that may be learned from."""
    sample = labelled_sample(docs, labels, label, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            table = pa.Table.from_batches(rows).sort_by([("doc_id", "ascending"), ("text", "ascending")])
            model = fit(table["text"].combine_chunks(), table["label"].to_numpy().astype(np.int64))
            used = np.flatnonzero(model.of >= 0)
            yield pa.RecordBatch.from_pydict(
                {"bucket": [used.astype("<i4").tobytes()], "weight": [model.weight.tobytes()], "bias": [model.bias]}
            )

    got = sample.repartition(1).mapInArrow(run, "bucket binary, weight binary, bias double").first()
    of = np.full(1 << BUCKET_BITS, -1, np.int32)
    if got is None:
        return Model(of, np.zeros(0), -2.0)
    used = np.frombuffer(got["bucket"], "<i4")
    of[used] = np.arange(len(used))
    return Model(of, np.frombuffer(got["weight"], np.float64), got["bias"])


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score every whole text of ``docs`` (doc_id, text) for toxicity.

    Returns doc_id, held_out, score (0 to 1) and predicted (1 if score >= threshold).

    Null and empty texts score as a text without features (the bias). Without
    labels of both classes every text gets one constant score. Repeated rows and null
    ids are scored alike. A text of any length is read whole, in overlapping pieces that hold
    the n-grams of the uncut text. Columns of ``docs`` other than doc_id and text are not read.
    """
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.score(batch["text"]))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    return filter_rows(docs, train(docs, labels), threshold)


def filter_rows(docs: DataFrame, model, threshold: float, above: bool = False) -> DataFrame:
    """Rows of ``docs`` scoring below the threshold (``above``: at least it), all columns kept."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                passed = model.score(batch.column(at)) >= threshold
                yield batch.filter(pa.array(passed if above else ~passed))

    return docs.mapInArrow(run, docs.schema)
