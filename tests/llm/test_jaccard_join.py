"""Near-duplicate components against all pairs in memory."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from visitflow.llm import jaccard_join as jj
from visitflow.llm.common import Scratch, table, utf8_column


def sets_of(rows, k):
    out = []
    for _, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        grams = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
        out.append(grams or ({tuple(w)} if w else set()))
    return out


def brute(rows, rule):
    sets = sets_of(rows, rule.words)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and rule.den * len(x & y) >= rule.num * len(x | y):
            root[find(a)] = find(b)
    low = {}
    for i in range(len(rows)):
        key = jj.LOWEST if rows[i][0] is None else rows[i][0]
        low[find(i)] = min(low.get(find(i), key), key)
    shown = lambda x: None if x == jj.LOWEST else x
    return sorted(((rows[i][0], len(sets[i]), shown(low[find(i)])) for i in range(len(rows))), key=str)


def result(spark, rows, rule):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, node int")
    return sorted(map(tuple, jj.components(docs, rule).collect()), key=str)


def brute_links(rows, rule):
    """Every two rows that link, and each row's number of links."""
    sets = sets_of(rows, rule.words)
    links = {
        (a, b)
        for a, b in combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and rule.den * len(sets[a] & sets[b]) >= rule.num * len(sets[a] | sets[b])
    }
    counts = [0] * len(rows)
    for pair in links:
        for i in pair:
            counts[i] += 1
    return links, sorted(((rows[i][0], len(sets[i]), counts[i]) for i in range(len(rows))), key=str)


def edited(rng, words, edits):
    words = list(words)
    for at in rng.integers(0, len(words), edits):
        words[at] = f"edit{rng.integers(10**9)}"
    return " ".join(words)


RULES = [jj.Rule(3, 90, 100), jj.Rule(5, 80, 100), jj.Rule(1, 50, 100)]


@pytest.mark.parametrize("rule", RULES)
def test_copies_and_shared_passages(spark, rule):
    rng = np.random.default_rng(rule.words)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(vocabulary, 40))
    rows = []
    for base in range(6):  # chains of ever more edited copies
        words = list(rng.choice(vocabulary, int(rng.integers(30, 200))))
        for _ in range(14):
            words = edited(rng, words, int(rng.integers(0, 4))).split()
            rows.append((len(rows), " ".join(words)))
    for _ in range(40):  # texts that share a passage only
        own = list(rng.choice(vocabulary, int(rng.integers(5, 60))))
        rows.append((len(rows), " ".join(passage + own)))
    rows += [(len(rows) + i, t.upper()) for i, (_, t) in enumerate(rows[:5])]
    assert result(spark, rows, rule) == brute(rows, rule)


@pytest.mark.parametrize("rule", RULES)
@pytest.mark.parametrize("list_rows", [20_000, 16])
def test_every_link_is_given(spark, monkeypatch, rule, list_rows):
    """Pairs of classes, and counts, against all pairs; links between two followers of one leader too."""
    monkeypatch.setattr(jj, "LIST_ROWS", list_rows)
    rng = np.random.default_rng(10 + rule.words)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(4):
        base = list(rng.choice(vocabulary, int(rng.integers(60, 200))))
        for _ in range(20):  # a star of copies, then a chain
            rows.append((len(rows), edited(rng, base, int(rng.integers(0, 6)))))
        for _ in range(8):
            base = edited(rng, base, int(rng.integers(1, 4))).split()
            rows.append((len(rows), " ".join(base)))
    rows += [(len(rows) + i, t.upper()) for i, (_, t) in enumerate(rows[:5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links, counts = brute_links(rows, rule)
    members, pairs = jj.similar_pairs(docs, rule)
    of_class = {}
    for r in members.collect():
        of_class.setdefault(r["class_id"], []).append(r["doc_id"])
    got = [tuple(sorted(p)) for ids in of_class.values() for p in combinations(ids, 2)]
    for r in pairs.collect():
        got += [tuple(sorted((x, y))) for x in of_class[r["a"]] for y in of_class[r["b"]]]
    assert len(got) == len(set(got)) and set(got) == links
    assert sorted(map(tuple, jj.link_counts(docs, rule).collect()), key=str) == counts


def test_links_are_derived_without_the_sets(spark, monkeypatch):
    """Copies of one text with one edit each: every link between two copies follows from the original."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(base[:-1]))] + [(i, edited(rng, base, 1)) for i in range(1, 25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = jj.Join(docs, jj.Rule(), Scratch(spark))
    calls = []
    monkeypatch.setattr(join, "compared", lambda pairs, nodes: calls.append(1))
    assert jj.linked_classes(join).count() == 25 * 24 // 2 and not calls


def test_link_counts_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (4, "a"), (5, "A"), (6, "a b"), (None, "a b"), (6, "a b"), (7, "x y z w"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jj.link_counts(docs).collect()), key=str) == brute_links(rows, jj.Rule())[1]
    assert jj.link_counts(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rule", RULES[:2])
def test_odd_rows(spark, rule):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, "a b"), (None, "a b"), (None, None)]
    rows += [(8, "É a b c d e f"), (9, "é a b c d e f"), (10, "x y z " * 3000), (11, "x y z " * 3001), (6, "a b"), (6, "other words here now ok")]
    rows += [(12, "a b c"), (13, "a b c")]
    assert result(spark, rows, rule) == brute(rows, rule)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jj.components(docs).count() == 0
    assert jj.keep_one(docs, jj.Rule(5, 80, 100)).count() == 0


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rule = jj.Rule(5, 80, 100)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, jj.components(docs, rule).collect()), key=str) == brute(rows, rule)


def test_long_lists_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jj, "LIST_ROWS", 16)
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, edited(rng, base, int(rng.integers(0, 5)))) for i in range(150)]
    rule = jj.Rule(3, 90, 100)
    assert result(spark, rows, rule) == brute(rows, rule)


def test_keep_one(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text, "a"), (3, text + " eleven", "b"), (3, text + " eleven", "b"), (7, "other " + "words " * 9, "c"), (8, None, "d"), (9, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    kept = jj.keep_one(docs, jj.Rule(5, 80, 100))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["node"]) for r in kept.collect()) == [(3, "b"), (7, "c"), (8, "d"), (9, "e")]


def test_bounds_rule_out_no_link():
    rng = np.random.default_rng(9)
    for rule in RULES:
        for _ in range(300):
            n = int(rng.integers(1, 60))
            x = np.sort(rng.choice(10**6, n, replace=False).astype(np.uint64))
            y = np.sort(np.unique(np.concatenate([x[rng.random(n) > 0.1], rng.choice(10**6, int(rng.integers(0, 4))).astype(np.uint64)])))
            common = len(np.intersect1d(x, y))
            if not len(y) or rule.den * common < rule.num * (n + len(y) - common):
                continue
            assert n + len(y) - 2 * common <= rule.differ(n + len(y))
            assert np.intersect1d(x[: rule.prefix(n)], y[: rule.prefix(len(y))]).size
            assert folded_unlike(x, y) <= rule.differ(n + len(y))


def folded_unlike(x, y):
    """Bits in which the sketches differ, the longer one folded."""
    bits = [np.unpackbits(np.frombuffer(jj.sketch(s), np.uint8)) for s in (x, y)]
    while len(bits[0]) != len(bits[1]):
        long = int(len(bits[1]) > len(bits[0]))
        bits[long] = bits[long].reshape(2, -1).sum(axis=0) % 2
    return (bits[0] != bits[1]).sum()


def test_sketches_of_any_length_compare():
    """``alike`` counts the folded difference of any two sketches, and stops only beyond the allowance."""
    rng = np.random.default_rng(12)
    sets = [np.unique(rng.integers(0, 2**62, n).astype(np.uint64)) for n in (3, 120, 130, 250, 260, 600, 2000, 3000)]
    sets += [np.unique(np.concatenate([s[: len(s) * 9 // 10], s[:1] + np.uint64(5)])) for s in sets]
    table = pa.table(
        {
            "token": [1] * len(sets), "node": list(range(len(sets))), "n": [len(s) for s in sets], "pos": [0] * len(sets),
            "i": [0] * len(sets), "j": [0] * len(sets), "bits": [jj.sketch(s) for s in sets],
        }
    )
    lists = jj.Lists(table, jj.Rule())
    x, y = (a.ravel() for a in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    want = np.array([folded_unlike(sets[i], sets[j]) for i, j in zip(x, y)])
    for off in (-1, 0, 1):
        assert lists.alike(x, y, want + off).tolist() == [off >= 0] * len(x)


def shared_passages(rng):
    """Chains of edited copies, and texts that share a short passage with others."""
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [list(rng.choice(vocabulary, 6)) for _ in range(12)]
    rows = []
    for _ in range(5):
        words = list(rng.choice(vocabulary, int(rng.integers(60, 160))))
        for _ in range(8):
            words = edited(rng, words, int(rng.integers(0, 4))).split()
            rows.append((len(rows), " ".join(words)))
    for _ in range(60):
        own = list(rng.choice(vocabulary, int(rng.integers(30, 120))))
        rows.append((len(rows), " ".join(own + passages[int(rng.integers(0, 12))])))
    return rows + [(len(rows) + i, t.upper()) for i, (_, t) in enumerate(rows[:5])]


def lists_of(rows):
    out = {}
    for r in rows:
        out.setdefault(r["token"], []).append(r)
    return out.values()


def may_link(x, y, rule):
    """Whether two postings of one list can be the first common hash of two linked sets."""
    common = min(x["n"] - x["pos"], y["n"] - y["pos"])
    return x["node"] != y["node"] and rule.den * common >= rule.num * (x["n"] + y["n"] - common)


@pytest.mark.parametrize("rule", RULES[:2])
def test_postings_without_a_partner_leave_the_index(spark, monkeypatch, rule):
    """Lists hold what sizes and positions allow to link, however the rows come in batches."""
    docs = spark.createDataFrame(shared_passages(np.random.default_rng(20)), "doc_id long, text string")
    join = jj.Join(docs, rule, Scratch(spark))
    key = lambda r: (r["token"], r["node"], r["n"], r["pos"])
    lists = lists_of(jj._postings(join.classes).collect())
    want = sorted(key(x) for rows in lists for x in rows if any(may_link(x, y, rule) for y in rows))
    assert want and sorted(map(key, join.lists.collect())) == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert sorted(map(key, jj.shared_lists(join.classes, rule).collect())) == want
        monkeypatch.setattr(jj, "NEAR", 2)  # rows of longer lists stay untested; none is lost
        assert set(map(key, jj.shared_lists(join.classes, rule).collect())) >= set(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("list_rows", [20_000, 4])
def test_second_round_gives_sketches_to_strangers_only(spark, monkeypatch, list_rows):
    monkeypatch.setattr(jj, "LIST_ROWS", list_rows)
    rule, scratch = jj.Rule(5, 80, 100), Scratch(spark)
    docs = spark.createDataFrame(shared_passages(np.random.default_rng(21)), "doc_id long, text string")
    join = jj.Join(docs, rule, scratch)
    comps = jj.connected(join.found, scratch)
    known = join.leads().join(comps, "node", "left").selectExpr("node", "lead", "gap", "coalesce(root, node) root")
    about = {r["node"]: r for r in known.collect()}

    def meet(x, y):
        a, b = about[x["node"]], about[y["node"]]
        apart = a["lead"] == b["lead"] and abs(a["gap"] - b["gap"]) > rule.differ(x["n"] + y["n"])
        return a["root"] != b["root"] and not apart and may_link(x, y, rule)

    lists = lists_of([r for r in join.lists.collect() if r["node"] in about])
    want = {(x["token"], x["node"]) for rows in lists for x in rows if any(meet(x, y) for y in rows)}
    got = {(r["token"], r["node"]) for r in jj._entries(join.lists, join.classes, rule, known, scratch).collect()}
    assert want and got == want and len(want) < sum(map(len, lists))


def test_one_class_row_a_set(spark):
    """Copies give one row, the lowest (doc_id, text); sets without copies are not written again."""
    rows = [(3, "a b c d"), (1, "A b c d"), (None, "x y z"), (7, "x y z"), (5, "e f g h"), (4, "i j k"), (9, None), (4, "i j k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = Scratch(spark)
    join = jj.Join(docs, jj.Rule(), scratch)
    assert sorted(r["d"] for r in join.classes.collect()) == [jj.LOWEST, 1, 4, 5]
    assert join.classes.columns == ["node", "d", "t", "n", "prefix", "brief", "bits"]
    written = next(p for p in scratch.paths if "join-classes" in p)
    assert sorted(r["d"] for r in spark.read.parquet(written).collect()) == [jj.LOWEST, 1, 4]


def test_shingles_do_not_depend_on_neighbours():
    texts = ["a b c d", "", "a b c d", "b c d"]
    body, offsets = utf8_column(pa.array(texts))
    one, none, two, three = jj.shingle_sets(body, offsets, 3)
    assert list(one) == list(two) and len(none) == 0 and set(three) < set(one)
