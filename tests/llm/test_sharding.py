"""Sharding against a single sorted list."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest

from visitflow.llm import sharding
from visitflow.llm.common import table
from visitflow.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def brute(rows, shards, law):
    """The weight line by one sort in memory."""
    keyed = []
    for i, text in rows:
        data = (text or "").encode()
        h = int(hashlib.md5(data).hexdigest()[:15], 16)
        size = len(data) + 16
        keyed.append((h, sharding.LOWEST if i is None else i, i, size, zlib.crc32(data), size if law == "bytes" else 1))
    keyed.sort(key=lambda k: k[:2])
    total = sum(k[5] for k in keyed)
    group = defaultdict(int)
    for k in keyed:
        group[k[0]] += k[5]
    at, start, slots, out = 0, {}, defaultdict(int), []
    for h, _, i, size, crc, w in keyed:
        start.setdefault(h, at)
        heavy = law == "rows" or group[h] > total // (shards * sharding.GROUP_SHARE)
        shard = (at if heavy else start[h]) * shards // total
        out.append((i, size, crc, law, shard, slots[shard], None))
        slots[shard] += 1
        at += w
    return out


def result(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[4], r[5]))


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_whole_table(spark, law):
    docs = table(spark, MEDIUM, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = QUERIES["op10_sharding"](spark, MEDIUM) if law == "bytes" else sharding.shard(docs, law="rows")
    assert result(got) == brute(rows, 40, law)


def test_a_hot_group_is_split_and_evened_out(spark):
    rows = [(i, "same text " * 20) for i in range(400)] + [(i, f"own text {i} " * 20) for i in range(400, 1200)]
    docs = spark.createDataFrame([(i, t, 0, 0, 0) for i, t in rows], "doc_id long, text string, size int, shard int, range int")
    got = result(sharding.shard(docs, shards=10, ranges_per_shard=8, samples_per_range=4))
    assert got == brute(rows, 10, "bytes")
    sizes = defaultdict(int)
    for r in got:
        sizes[r[4]] += r[1]
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values())


def test_rows_law_holds_on_groups_of_copies(spark):
    rows = [(i, f"text {i // 9}") for i in range(7000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(sharding.shard(docs, shards=40, law="rows"))
    assert got == brute(rows, 40, "rows")
    counts = defaultdict(int)
    for r in got:
        counts[r[4]] += 1
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 40


def test_odd_rows(spark):
    rows = [(1, None), (None, "x"), (2, ""), (1, None), (3, "é" * 50_000), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(docs, shards=3)
    key = lambda r: (r[4], r[5])
    assert [r[1:] for r in sorted(result(got), key=key)] == [r[1:] for r in brute(rows, 3, "bytes")]
    assert sharding.shard(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(docs, law="none")


def test_main_path_is_native(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    plan = sharding.shard(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
