"""Quality: attention-based multiple-instance learning over passages.

A text is a bag of passages of ``PASSAGE_WORDS`` words. Each passage is described by how
often one class of byte follows another (letters, capitals, digits, marks ...), by
word lengths and by repetition, and encoded by a learned layer

    h = tanh(W f + b)

A gated attention weight ``a = softmax(w . (tanh(V h) * sigmoid(U h)))`` over the bag
is learned from the document labels alone; the document's score is the logistic score
of the weighted representation ``sum(a h)``.

The sums over a bag are kept as running totals, so a text of any length is
read piece by piece and whole, in training as in scoring: a step goes over all passages
of its bags, ``STEP_PASSAGES`` at a time. Training takes one bounded sample of labelled
rows (``SAMPLE_ROWS``) in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import (
    held_out,
    labelled_sample,
    slices,
    utf8_column,
    word_hashes,
    word_spans,
)
from visitflow.llm.toxicity_nb import filter_rows, sigmoid

PASSAGE_WORDS = 64
SAMPLE_ROWS = 6000
HIDDEN, GATES = 24, 12
ROUNDS = 400
THRESHOLD = 0.5
SEED = 5
PIECE_BYTES = 2 << 20
#: Passages whose layers are held together in a training step.
STEP_PASSAGES = 1 << 15
#: Sum of exp(attention) is kept relative to this bound of the attention's size.
_CLIP = 15.0


def _classes() -> np.ndarray:
    """Class of each byte: space, newline, lower, upper, digit, stop, quote, symbol, call, other, two of UTF-8."""
    out = np.full(256, 9, np.uint8)
    for at, chars in enumerate((b" \t", b"\n\r\v\f", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".,;:", b"'\"-()", b"#$%&*+/<=>@[\\]^_`{|}~", b"!?")):
        out[list(chars)] = at
    out[128:192], out[192:] = 10, 11
    return out


_CLASS = _classes()
_N_CLASSES = 12
N_FEATURES = _N_CLASSES * _N_CLASSES + 6


def passages(body: np.ndarray, offsets: np.ndarray, after: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, features) of every passage of the texts; a text without words has one of zeros.

    ``after``: the byte that follows, where the last text goes on in another piece.
    """
    starts, ends, rows = word_spans(body, offsets)
    n_rows = len(offsets) - 1
    words = np.bincount(rows, minlength=n_rows)
    first_word = np.concatenate([[0], np.cumsum(words)])[:-1]
    of_row = np.maximum(1, -(-words // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(of_row)])
    bag = np.repeat(np.arange(n_rows), of_row)
    n = int(first[-1])
    features = np.zeros((n, N_FEATURES), np.float32)
    if not len(starts):
        return bag, features
    passage = first[rows] + (np.arange(len(rows)) - first_word[rows]) // PASSAGE_WORDS
    # Byte pairs belong to the passage of the word at or before the first of them.
    cls = _CLASS[body].astype(np.int64)
    owner = np.searchsorted(starts, np.arange(len(body)), "right") - 1
    pair_row = np.repeat(np.arange(n_rows), np.diff(offsets))
    ok = (owner[:-1] >= 0) & (pair_row[:-1] == pair_row[1:])
    ok &= rows[np.maximum(owner[:-1], 0)] == pair_row[:-1]
    flat = passage[owner[:-1][ok]] * (_N_CLASSES**2) + cls[:-1][ok] * _N_CLASSES + cls[1:][ok]
    if after is not None:  # the pair across the cut is the last passage's
        flat = np.append(flat, (n - 1) * (_N_CLASSES**2) + cls[-1] * _N_CLASSES + int(_CLASS[after]))
    pairs = np.bincount(flat, minlength=n * _N_CLASSES**2).reshape(n, -1)
    features[:, : _N_CLASSES**2] = np.sqrt(pairs / np.maximum(1, pairs.sum(axis=1, keepdims=True)))
    # Words: lengths, repeats of the word before, share of distinct words, most frequent word.
    length = (ends - starts).astype(np.float64)
    hashes = word_hashes(body, starts, ends)
    count = np.maximum(1, np.bincount(passage, minlength=n))
    mean = np.bincount(passage, length, n) / count
    spread = np.sqrt(np.maximum(0, np.bincount(passage, length * length, n) / count - mean * mean))
    again = np.zeros(len(starts))
    again[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
    order = np.lexsort((hashes, passage))
    sorted_passage, sorted_hash = passage[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_passage[1:] != sorted_passage[:-1]) | (sorted_hash[1:] != sorted_hash[:-1])
    run = np.diff(np.append(np.flatnonzero(new), len(order)))
    most = np.zeros(n)
    np.maximum.at(most, sorted_passage[new], run)
    extra = features[:, _N_CLASSES**2 :]
    extra[:, 0], extra[:, 1] = np.log1p(mean), np.log1p(spread)
    extra[:, 2] = np.bincount(passage, again, n) / count
    extra[:, 3] = np.bincount(sorted_passage[new], minlength=n) / count
    extra[:, 4] = most / count
    extra[:, 5] = np.minimum(count, PASSAGE_WORDS) / PASSAGE_WORDS
    return bag, features


def _cut(body: np.ndarray, at: int, end: int) -> int:
    """Where a piece of a long text ends: before a word, after whole passages; ``end`` if there are none."""
    size = PIECE_BYTES
    while at + size < end:
        starts, _, _ = word_spans(body[at : at + size], np.array([0, size]))
        whole = (len(starts) - 1) // PASSAGE_WORDS * PASSAGE_WORDS  # the last word may go on
        if whole > 0:
            return at + int(starts[whole])
        size *= 2
    return end


def _pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int | None]]:
    """(bytes, offsets, rows, byte after) of about PIECE_BYTES; a long text is cut between its passages.

    So a text has the same passages however it is read.
    """
    body, offsets = utf8_column(column)
    for first, last in slices(offsets, PIECE_BYTES):
        a, b = int(offsets[first]), int(offsets[last])
        if last - first > 1 or b - a <= PIECE_BYTES:
            yield body[a:b], offsets[first : last + 1] - a, np.arange(first, last), None
            continue
        while a < b:
            to = _cut(body, a, b)
            yield body[a:to], np.array([0, to - a]), np.array([first]), int(body[to]) if to < b else None
            a = to


class Model:
    """Parameters by name, and the features' means and spreads on the training sample."""

    NAMES = ("mean", "spread", "W", "b", "V", "U", "w", "c", "c0")

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    def encode(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encoded passages and their attention before the softmax."""
        p = self.p
        h = np.tanh(((features - p["mean"]) / p["spread"]) @ p["W"] + p["b"])
        gate = np.tanh(h @ p["V"]) * sigmoid(h @ p["U"])
        return h, _CLIP * np.tanh(gate @ p["w"] / _CLIP)

    def score(self, column: pa.Array) -> np.ndarray:
        n = len(column)
        top, norm = np.zeros(n), np.zeros(n)
        for body, offsets, rows, after in _pieces(column):
            bag, features = passages(body, offsets, after)
            h, a = self.encode(features)
            e, row = np.exp(a), rows[bag]
            top += np.bincount(row, e * (h @ self.p["c"]), n)
            norm += np.bincount(row, e, n)
        return sigmoid(top / np.where(norm > 0, norm, 1) + self.p["c0"][0])

    def dump(self) -> dict[str, list[bytes]]:
        return {k: [np.asarray(self.p[k], np.float64).tobytes()] for k in self.NAMES}

    @classmethod
    def load(cls, row) -> Model:
        p = {k: np.frombuffer(row[k], np.float64) for k in cls.NAMES}
        p["W"], p["V"], p["U"] = p["W"].reshape(-1, HIDDEN), p["V"].reshape(HIDDEN, -1), p["U"].reshape(HIDDEN, -1)
        return cls(p)


def constant(score: float) -> Model:
    """Every text scores alike: what is left without labels of both classes."""
    p = {"mean": np.zeros(N_FEATURES), "spread": np.ones(N_FEATURES), "W": np.zeros((N_FEATURES, HIDDEN)), "b": np.zeros(HIDDEN)}
    p |= {"V": np.zeros((HIDDEN, GATES)), "U": np.zeros((HIDDEN, GATES)), "w": np.zeros(GATES), "c": np.zeros(HIDDEN)}
    return Model(p | {"c0": np.array([np.log(score / (1 - score))])})


def _layers(f: np.ndarray, p: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Encoded passages, the two gates, attention, its exponential, and each passage's value."""
    h = np.tanh(f @ p["W"] + p["b"])
    t, s = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
    a = _CLIP * np.tanh((t * s) @ p["w"] / _CLIP)
    return h, t, s, a, np.exp(a), h @ p["c"]


def fit(texts: pa.Array, labels: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Fit all layers together from document labels, by Adam on random batches of bags."""
    n, good = len(labels), float(labels.sum())
    if not 0 < good < n:
        return constant((good + 0.5) / (n + 1))
    bags, parts = [], []
    for body, offsets, rows, after in _pieces(texts):
        bag, features = passages(body, offsets, after)
        bags.append(rows[bag])
        parts.append(features)
    bag, x = np.concatenate(bags), np.concatenate(parts)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 1e-4, spread, 1.0)
    x = np.clip((x - mean) / spread, -8, 8)
    first = np.concatenate([[0], np.cumsum(np.bincount(bag, minlength=n))])
    rng = np.random.default_rng(SEED)
    shapes = {"W": (N_FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATES), "U": (HIDDEN, GATES), "w": (GATES,), "c": (HIDDEN,)}
    p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()}
    p["b"][:] = 0
    p["c0"] = np.array([np.log(good / (n - good))])
    # Both classes weigh half, the rarer one at most four times its rows.
    class_weight = np.where(labels == 1, min(4.0, n / (2 * good)), min(4.0, n / (2 * (n - good))))
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, rounds + 1):
        docs = rng.choice(n, min(n, 256), replace=False)
        k = len(docs)
        at = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
        own_bag = np.repeat(np.arange(k), first[docs + 1] - first[docs])
        pieces = [slice(i, i + STEP_PASSAGES) for i in range(0, len(at), STEP_PASSAGES)]
        top, norm = np.zeros(k), np.zeros(k)
        for piece in pieces:
            f, own = x[at[piece]], own_bag[piece]
            h, t, s, a, e, value = layers = _layers(f, p)
            top += np.bincount(own, e * value, k)
            norm += np.bincount(own, e, k)
        z = top / norm
        off = (sigmoid(z + p["c0"][0]) - labels[docs]) * class_weight[docs] / k
        grads = {key: np.zeros_like(v) for key, v in p.items()}
        grads["c0"] += off.sum()
        for piece in pieces:
            f, own = x[at[piece]], own_bag[piece]
            h, t, s, a, e, value = layers if len(pieces) == 1 else _layers(f, p)
            share = e / norm[own]
            d_value = share * off[own]
            d_a = share * (value - z[own]) * off[own]  # through the softmax
            d_g = d_a * (1 - (a / _CLIP) ** 2)
            d_ts = d_g[:, None] * p["w"]
            d_t, d_s = d_ts * s * (1 - t * t), d_ts * t * s * (1 - s)
            d_h = (d_value[:, None] * p["c"] + d_t @ p["V"].T + d_s @ p["U"].T) * (1 - h * h)
            some = {"W": f.T @ d_h, "b": d_h.sum(axis=0), "V": h.T @ d_t, "U": h.T @ d_s, "w": (t * s).T @ d_g, "c": h.T @ d_value}
            for key, g in some.items():
                grads[key] += g
        rate = 0.01 * (1 - step / (rounds + 1))
        for key, g in grads.items():
            if key in ("W", "V", "U", "w", "c"):
                g = g + 2e-4 * p[key]
            m[key] = 0.9 * m[key] + 0.1 * g
            v2[key] = 0.999 * v2[key] + 0.001 * g * g
            p[key] = p[key] - rate * (m[key] / (1 - 0.9**step)) / (np.sqrt(v2[key] / (1 - 0.999**step)) + 1e-8)
    return Model(p | {"mean": mean, "spread": spread})


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit in one task on at most ``sample_rows`` labelled rows that may be learned from."""
    sample = labelled_sample(docs, labels, label, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            table = pa.Table.from_batches(rows).sort_by([("doc_id", "ascending"), ("text", "ascending")])
            model = fit(table["text"].combine_chunks(), table["label"].to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_pydict(model.dump())

    got = sample.repartition(1).mapInArrow(run, ", ".join(f"{k} binary" for k in Model.NAMES)).first()
    return constant(0.5) if got is None else Model.load(got)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score every whole text of ``docs`` (doc_id, text) for quality.

    Returns doc_id, held_out, score (0 to 1; likelier label 1 is higher) and predicted
    (1 if score >= threshold).

    Null and empty texts, and texts of white space, score as one passage without
    words. Without labels of both classes every text gets one constant score.
    Repeated rows and null ids are scored alike. Other columns are not read.
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


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
    return filter_rows(docs, train(docs, labels), threshold, above=True)
