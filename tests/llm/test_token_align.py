"""Alignment against a plain walk over both token lists, and corpus counts against a Counter."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from visitflow.llm import token_align
from visitflow.llm.common import table

pytest.importorskip("sentencepiece")


def walk(ends_a, ends_b):
    """Links (i, j) and, for each, whether the end they share closes a group."""
    out, start = [], 0
    for end in sorted(set(ends_a) | set(ends_b)):
        i = next(k for k, e in enumerate(ends_a) if e >= end)
        j = next(k for k, e in enumerate(ends_b) if e >= end)
        out.append((i, j, ends_a[i] == end == ends_b[j]))
        start = end
    return out


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 40)), st.sets(st.integers(1, 40)), st.integers(1, 9))
def test_pieces_equal_one_walk(a, b, size):
    a, b = sorted(a | {41}), sorted(b | {41})
    got = token_align.align(np.array(a), np.array(b), size)
    assert list(zip(*(x.tolist() for x in got))) == walk(a, b)
    parts = token_align.pieces(np.array(a), np.array(b), size)
    assert all(i1 - i0 + j1 - j0 <= size for i0, i1, j0, j1 in parts)


def brute(rows):
    """The query's rows for (doc_id, text) rows, from each text alone."""
    pair = token_align.load(*token_align.default_paths())
    held, counts = [], Counter()
    for doc_id, text in rows:
        (a,), (b,) = pair.encode([text or ""])
        ends = [np.cumsum(pair.sizes[k][ids]).tolist() for k, ids in enumerate((a, b))]
        links = walk(*ends) if len(a) else []
        groups, own = [], ([], [])
        for i, j, closes in links:
            for side, at in zip(own, (i, j)):
                if at not in side:
                    side.append(at)
            if closes:
                groups.append(",".join(str(a[k]) for k in own[0]) + "|" + ",".join(str(b[k]) for k in own[1]))
                own = ([], [])
        pairs = [(int(a[i]), int(b[j])) for i, j, _ in links]
        counts.update(set(pairs))
        held.append((doc_id, len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest() if len(a) else ""))
    most = {}
    for (x, _), c in counts.items():
        most[x] = max(most.get(x, 0), c)
    return sorted(
        ((d, na, nb, g, len(p), sum(counts[q] == most[q[0]] for q in p), sum(counts[q] for q in p), sha) for d, na, nb, g, p, sha in held),
        key=str,
    )


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    # Only the shorter texts are walked; the counts need all.
    short = {d for d, t in rows if len(t or "") < 3000}
    got = sorted(map(tuple, token_align.alignments(docs).collect()), key=str)
    assert [r for r in got if r[0] in short] == [r for r in brute(rows) if r[0] in short]


ODD = ["", " ", "  two  spaces \n\n", "<|endoftext|> <s></s><unk><0x41>", "a▁b", "éé ﬁ ½", "\U0001f642‍♂", "x" * 5000, "\x00\x01", "tab\tand\r\n", "日本語 テスト", "the the the"]


def test_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "the cat"), (None, None), (3, ODD[3]), (3, ODD[3])]
    docs = spark.createDataFrame([(i, t, 7, "p") for i, t in rows], "doc_id long, text string, n_a int, pairs string")
    got = sorted(map(tuple, token_align.alignments(docs).collect()), key=str)
    assert got == brute(rows)
    assert [r for r in got if r[0] == 0] == [(0, 0, 0, 0, 0, 0, 0, "")]
    assert token_align.alignments(docs.where("false")).collect() == []


def test_very_long_text(spark):
    text = "word number five " * 120_000
    docs = spark.createDataFrame([(1, text), (2, "word number five")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in token_align.alignments(docs.repartition(2)).collect()}
    pair = token_align.load(*token_align.default_paths())
    (a,), (b,) = pair.encode([text])
    assert (got[1]["n_a"], got[1]["n_b"]) == (len(a), len(b)) and got[1]["n_links"] >= max(len(a), len(b))
    assert got[2]["count_sum"] >= got[2]["n_links"] > 0


def test_ids_are_the_libraries(spark):
    from tokenizers import Tokenizer

    path = token_align.default_paths()[0]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = [t for t in ODD if t]
    ours = token_align.Pair(*token_align.default_paths()).a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
    assert [e.ids for e in ours] == [plain.encode(" " + t, add_special_tokens=False).ids for t in texts]
