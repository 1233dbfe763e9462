"""Ranked lexical search against plain arithmetic over all documents."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from visitflow.llm import lexical
from visitflow.llm.common import table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(items, docs, k):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in sorted(set((i, t) for i, t in items if i is not None), key=str):
        weights = {t: q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t, q in Counter(terms(text)).items()}
        scores = []
        for d, c in counted:
            m = 75 + (25 * sum(c.values()) * n) // total
            s = sum(w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, w in weights.items() if c[t])
            if s > 0:
                scores.append((-s, (d is not None, d or 0), d))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def searched(spark, items, docs, **options):
    items = spark.createDataFrame([(i, t, "x", 5) for i, t in items], "item_id long, text string, doc_id string, rank int")
    docs = spark.createDataFrame([(d, t, "x", 5) for d, t in docs], "doc_id long, text string, item_id string, score int")
    return sorted(map(tuple, lexical.search(items, docs, **options).collect()), key=str)


DOCS = [(1, "The cat sat."), (2, "the CAT sat"), (3, None), (4, ""), (5, " ...\n"), (6, "été Été naïve"), (7, "cat " * 3000), (7, "cat dog")]
DOCS += [(None, "a lone cat"), (9, "x\x00y cat-dog"), (10, "dog"), (10, "dog"), (11, "日本語 cat")]
ITEMS = [(1, "cat cat dog"), (1, "cat cat dog"), (1, "the"), (2, None), (3, ""), (4, "Été"), (None, "cat"), (5, "absent words"), (6, "Cat, dog; sat!")]


@pytest.mark.parametrize("item_terms", [lexical.ITEM_TERMS, 3])
def test_odd_rows(spark, item_terms):
    assert searched(spark, ITEMS, DOCS, k=4, item_terms=item_terms) == brute(ITEMS, DOCS, 4)


def test_empty_tables(spark):
    assert searched(spark, ITEMS, [(1, None)]) == [] and searched(spark, [(1, None)], DOCS) == []


def test_whole_table(spark):
    rows = [[tuple(r) for r in table(spark, "/root/testdata/sf0.01", n).select(*c).collect()] for n, c in (("benchmark", ("item_id", "text")), ("documents", ("doc_id", "text")))]
    items, docs = (table(spark, "/root/testdata/sf0.01", n) for n in ("benchmark", "documents"))
    got = sorted(map(tuple, lexical.search(items, docs, k=20).collect()), key=str)
    assert got == brute(*rows, 20)


def test_strata_and_stops():
    """Blocks of many strata and equal scores: visiting by bounds loses nothing."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, rng.integers(1, 60)) % 50) for _ in range(1500)]
    texts += ["w1 w2 w3"] * 400
    docs = list(enumerate(texts))
    column = pa.array(texts)
    n, total = len(texts), sum(len(t.split()) for t in texts)
    parts = []
    for at in range(0, len(texts), 700):
        building = lexical.Building(n, total)
        for first, last, rows, hashes in lexical.term_hashes(column.slice(at, 700)):
            building.add(np.arange(at + first, at + last), rows, hashes)
        built = building.block()
        parts.append(lexical.Block({c: built.column(c)[0].as_buffer() for c in built.schema.names}))
    asked = [(1, "w1 w2 w3 w7"), (2, "w49 w48"), (3, "w1 w1 w1 w30")]
    hashes = {}
    for item, text in asked:
        hashes[item] = next(lexical.term_hashes(pa.array([text])))[3]
    vocabulary = np.unique(np.concatenate(list(hashes.values())))
    df = sum(np.where((p := b.at(vocabulary)) >= 0, b.starts[p + 1] - b.starts[p], 0) for b in parts)
    weight = lexical.term_weights(df, n)
    got = []
    for item, own in hashes.items():
        place, times = np.unique(np.searchsorted(vocabulary, own), return_counts=True)
        best = lexical.Item(place, weight[place] * times, 20)
        for block in parts:
            lexical.search_block(block, vocabulary, [best])
        got += [(item, r + 1, int(d), int(s)) for r, (s, d) in enumerate(zip(best.scores, best.docs))]
    assert sorted(got, key=str) == brute(asked, docs, 20)
