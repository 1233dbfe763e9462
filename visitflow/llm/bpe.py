"""BPE encoding and decoding with a word-level vocabulary file.

A word is held as a contiguous row of parts with the merge ranks of adjacent pairs
beside it: the row's smallest rank is found by a scan, its boundary is deleted and
the two neighbouring ranks are looked up anew, until no pair merges. The new words
of a piece of text are rows of one array, and each step does one merge in every
row. Words of many parts, where scans would add up, keep the same ranks in a heap;
merges and their order are the same. Each worker keeps the ids of recent words.

The vocabulary file is in the JSON format of the ``tokenizers`` library; normaliser,
word pattern and special tokens are those of the file ``word_bpe_49k.json``.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
WORD_END = "</w>"
#: Up to this many parts a word's ranks are scanned; beyond, a heap holds them.
SCAN_PARTS = 48
#: Bytes of text whose new words are encoded together.
PIECE_BYTES = 4 << 20
#: Encodings kept by a worker, of texts of at most CACHED_CHARS characters.
CACHED_WORDS = 300_000
CACHED_CHARS = 48

_BITS = 20  # of an id
_ID = (1 << _BITS) - 1
_NONE = 1 << 62

# White space as the library's regular expressions take it, and its word pattern.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_BLANK = regex.compile(rf"[{_SPACE}]+")


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else spare))
        spare += b not in shown
    return out


def _lower(text: str) -> str:
    """Lower case character by character: no context rule for the final sigma."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


class _Pairs:
    """(left id, right id) -> rank and merged id in one integer: an open-addressing hash table."""

    _SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, merges: dict[int, int]):
        self.bits = max(4, (4 * len(merges)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int64)
        at = self._slot(np.fromiter(merges, np.int64, len(merges))).tolist()
        for slot, (key, value) in zip(at, merges.items()):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (len(self.keys) - 1)
            self.keys[slot], self.values[slot] = key, value

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self._SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Values of the pairs, ``_NONE`` where there is no merge; negative ids pair with nothing."""
        keys = np.where((left >= 0) & (right >= 0), left << _BITS | right, -2)
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], _NONE)
        open_ = np.flatnonzero(((there != keys) & (there >= 0) & (keys >= 0)).ravel())
        flat, slots, wanted = out.reshape(-1), slot.reshape(-1)[open_], keys.reshape(-1)[open_]
        while len(open_):
            slots = (slots + 1) & (len(self.keys) - 1)
            there = self.keys[slots]
            hit = there == wanted
            flat[open_[hit]] = self.values[slots[hit]]
            on = ~hit & (there >= 0)
            open_, slots, wanted = open_[on], slots[on], wanted[on]
        return out


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary: dict[str, int] = spec["model"]["vocab"]
        # Pair of ids -> rank and merged id, each in one integer, so that ranks compare fast.
        self.merges: dict[int, int] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.merges[vocabulary[a] << _BITS | vocabulary[b]] = rank << _BITS | vocabulary[a + b]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocabulary.values(), *special.values()]))
        for token, at in (vocabulary | special).items():
            self.tokens[at] = token
        chars = _byte_characters()
        self.inner = np.array([vocabulary[c] for c in chars], np.int64)
        self.final = np.array([vocabulary[c + WORD_END] for c in chars], np.int64)
        self.pairs = _Pairs(self.merges)
        self.special = {t: np.array([at], "<u4").tobytes() for t, at in special.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.words: dict[str, bytes] = {}

    def _scan(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of at most SCAN_PARTS bytes, one merge a word and step."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        body = np.frombuffer(b"".join(words), np.uint8)
        width, n = int(lengths.max()), len(words)
        cols = np.arange(width)
        parts = np.full((n, width), -1, np.int64)
        parts[cols < lengths[:, None]] = self.inner[body]
        every = np.arange(n)
        parts[every, lengths - 1] = self.final[body[np.cumsum(lengths) - 1]]
        done = np.full((n, width), -1, np.int64)
        ranks = np.full((n, width), _NONE, np.int64)
        ranks[:, :-1] = self.pairs.find(parts[:, :-1], parts[:, 1:])
        row = every
        while len(row):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(row)), at]
            ended = best == _NONE
            if ended.any():
                done[row[ended]] = parts[ended]
                row, parts, ranks, at, best = (x[~ended] for x in (row, parts, ranks, at, best))
                if not len(row):
                    break
            here, merged = np.arange(len(row)), best & _ID
            # Delete the boundary: what lies right of it moves up by one.
            after = cols > at[:, None]
            parts[:, :-1] = np.where(after[:, :-1], parts[:, 1:], parts[:, :-1])
            parts[:, -1] = -1
            ranks[:, :-1] = np.where(after[:, :-1] | (cols[:-1] == at[:, None]), ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = _NONE
            parts[here, at] = merged
            ranks[here, at] = self.pairs.find(merged, parts[here, np.minimum(at + 1, width - 1)])
            inner = at > 0
            before = at[inner] - 1
            ranks[here[inner], before] = self.pairs.find(parts[here[inner], before], merged[inner])
        kept = done >= 0
        ends = (np.cumsum(kept.sum(axis=1)) * 4).tolist()
        data = done[kept].astype("<u4").tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        raw = [w.encode("utf-8") for w in words]
        out: list[bytes] = [b""] * len(raw)
        order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
        first = 0
        for upto in (8, 12, 20, SCAN_PARTS):  # words of about one length share an array
            last = first
            while last < len(order) and len(raw[order[last]]) <= upto:
                last += 1
            if last > first:
                for i, ids in zip(order[first:last], self._scan([raw[i] for i in order[first:last]])):
                    out[i] = ids
            first = last
        for i in order[first:]:
            parts = self.inner[np.frombuffer(raw[i], np.uint8)].tolist()
            parts[-1] = int(self.final[raw[i][-1]])
            out[i] = np.array(self._heap(parts), "<u4").tobytes()
        return out

    def _heap(self, parts: list[int]) -> list[int]:
        """The same merges for a long word: ranks in a heap, parts in a linked list."""
        get, n = self.merges.get, len(parts)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []

        def offer(at: int) -> None:
            if at >= 0 and right[at] >= 0 and (found := get(parts[at] << _BITS | parts[right[at]])) is not None:
                heapq.heappush(heap, (found, at, parts[at], parts[right[at]]))

        for at in range(n - 1):
            offer(at)
        while heap:
            found, at, a, b = heapq.heappop(heap)
            to = right[at]
            if parts[at] != a or to < 0 or parts[to] != b:
                continue
            parts[at], parts[to] = found & _ID, -1
            right[at] = right[to]
            if right[to] >= 0:
                left[right[to]] = at
            offer(left[at])
            offer(at)
        return [p for p in parts if p >= 0]

    def _runs(self, text: str) -> list[str]:
        """What stands between white space in a stretch without special tokens."""
        text = _lower(unicodedata.normalize("NFC", text))
        # str.split also splits at four separators that are not white space to the pattern.
        return _BLANK.split(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def _learn(self, runs: set[str]) -> dict[str, bytes]:
        """Ids of each run; words never reach over white space."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        found = {run: [run] if run.isalpha() else _WORDS.findall(run) for run in runs}
        known = self.words
        new = list({w for words in found.values() for w in words if w not in known})
        known.update(zip(new, self.encode_words(new)))
        ids = known.__getitem__
        out = {run: ids(words[0]) if len(words) == 1 else b"".join(map(ids, words)) for run, words in found.items()}
        for w in new:
            if len(w) > CACHED_CHARS:
                del known[w]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit integers."""
        out: list[bytes] = []
        piece: list[list] = []
        held = 0
        for text in texts:
            special = self.split is not None and "<|" in text
            stretches = self.split.split(text) if special else [text]
            piece.append([x if x in self.special else self._runs(x) for x in stretches])
            held += len(text)
            if held >= PIECE_BYTES:
                out += self._join(piece)
                piece, held = [], 0
        return out + self._join(piece)

    def _join(self, piece: list[list]) -> list[bytes]:
        runs = {r for stretches in piece for x in stretches if isinstance(x, list) for r in x}
        ids = self._learn(runs).__getitem__
        return [
            b"".join(self.special[x] if isinstance(x, str) else b"".join(map(ids, x)) for x in stretches)
            for stretches in piece
        ]

    def decode(self, ids: bytes) -> str:
        """Tokens joined by spaces: the vocabulary names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def encode_documents(docs: DataFrame, path: str | None = None, keep: bool = False) -> DataFrame:
    """Encode every whole text of ``docs`` and decode it again.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``keep``, ids (array)
    and decoded (string). ``path`` names the vocabulary file on the executors (default:
    the installed one).

    Null and empty texts have no ids and decode to "". Rows are encoded one by
    one: repeated rows and null doc_ids are kept as they are. A text of any length is
    encoded whole, in one task; only its words are cut apart. Other columns are not read.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path or default_path())
        for batch in batches:
            out = []
            for ids in bpe.encode([text or "" for text in batch["text"]]):
                decoded = bpe.decode(ids)
                row = (
                    len(ids) // 4,
                    hashlib.sha256(ids).hexdigest(),
                    hashlib.sha256(decoded.encode("utf-8")).hexdigest(),
                )
                out.append((*row, np.frombuffer(ids, "<u4").astype(np.int64), decoded) if keep else row)
            names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * keep]
            found = pd.DataFrame(out, columns=names)
            found.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield found

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, schema + ", ids array<long>, decoded string" * keep)
