"""The mix against plain arithmetic on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from visitflow.llm import mixing
from visitflow.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def domain(source):
    digits = re.search(r"[0-9]+", source or "")
    return mixing.DOMAINS[int(digits[0][:9]) % len(mixing.DOMAINS) if digits else 0]


def weight(level, name, weights):
    return weights.get(level, {}).get(name, weights.get(level, {}).get("*", 1))


def pour(budget, children, weights, level):
    """children: name -> capacity. The driest first, in doubles as in the operator."""
    order = sorted(children, key=lambda c: (children[c] / weight(level, c, weights), c))
    out, left = {}, sum(weight(level, c, weights) for c in order)
    before = 0
    for at, c in enumerate(order):
        w = weight(level, c, weights)
        if float(children[c]) * float(left) <= float(w) * float(budget - before):
            out[c] = children[c]
            before += children[c]
            left -= w
        else:
            for rest in order[at:]:
                out[rest] = min(children[rest], int(float(weight(level, rest, weights)) * float(budget - before) / float(left)))
            break
    return out


def brute(rows, weights, share, epochs, seed):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    leaves = defaultdict(list)
    for i, text, lang, source, *_ in rows:
        leaves[domain(source), lang or "unknown", source or "unknown"].append((i, text or ""))
    tokens = {leaf: sum(words(t) for _, t in own) for leaf, own in leaves.items()}
    live = {
        leaf: n * epochs for leaf, n in tokens.items()
        if n and all(weight(level, x, weights) > 0 for level, x in zip(mixing.LEVELS, leaf))
    }
    budgets = {(): min(int(sum(tokens.values()) * share), sum(live.values()))}
    for depth, level in enumerate(mixing.LEVELS, 1):
        deeper = {}
        for parent, budget in budgets.items():
            children = Counter()
            for leaf, capacity in live.items():
                if leaf[: depth - 1] == parent:
                    children[leaf[depth - 1]] += capacity
            deeper |= {(*parent, c): b for c, b in pour(budget, children, weights, level).items()}
        budgets = deeper
    out = []
    for leaf, budget in budgets.items():
        full, rest = divmod(budget, tokens[leaf])
        for e in range(1, full + 1):
            out += [(i, t, e) for i, t in leaves[leaf]]
        key = lambda r: hashlib.md5(
            f"{seed}|{full + 1}|{'' if r[0] is None else r[0]}|{hashlib.md5(r[1].encode()).hexdigest()}".encode()
        ).hexdigest()
        spent, groups = 0, defaultdict(list)
        for r in leaves[leaf]:
            groups[key(r)].append(r)
        for k in sorted(groups) if rest else []:
            spent += sum(words(t) for _, t in groups[k])
            if spent > rest:
                break
            out += [(i, t, full + 1) for i, t in groups[k]]
    return sorted(out, key=str)


def taken(df):
    return sorted(((r["doc_id"], r["text"] or "", r["epoch"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("share,epochs", [(0.3, 1), (0.8, 2), (1.7, 3), (9.0, 2)])
def test_whole_table(spark, share, epochs):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = taken(mixing.mix(docs, total_share=share, max_epochs=epochs, epoch_column="epoch"))
    assert got == brute(docs.collect(), mixing.WEIGHTS, share, epochs, mixing.SEED)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    def leaf(domain_, lang, source, tokens):
        return (domain_, lang, source, tokens)

    leaves = spark.createDataFrame(
        [leaf("web", "en", "a", 10), leaf("web", "en", "b", 1000), leaf("web", "fr", "c", 1000), leaf("books", "en", "d", 1000)],
        "domain string, lang string, source string, tokens long",
    )
    even = {"domain": {"*": 1}, "lang": {"*": 1}, "source": {"*": 1}}
    got = {r["source"]: r["budget"] for r in mixing.leaf_budgets(leaves, even, 800 / 3010, 1).collect()}
    # 400 a domain, 200 a language; a's shortage of 90 stays with its sibling b
    assert got == {"a": 10, "b": 190, "c": 200, "d": 400}
    zero = {"domain": {"books": 0, "*": 1}, "lang": {"*": 1}, "source": {"*": 1}}
    got = {r["source"]: r["budget"] for r in mixing.leaf_budgets(leaves, zero, 800 / 3010, 1).collect()}
    assert got["d"] == 0 and sum(got.values()) == 800


def test_odd_rows(spark):
    rows = [(1, None, "en", "src1", 0), (2, "", None, None, 0), (None, "a b c", "fr", "nodigits", 0), (3, "a b", None, "src99999999999", 0)]
    rows += [(4, "x y z", "en", "src1", 0)] * 3 + [(5, "w " * 5000, "en", "src1", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = taken(mixing.mix(docs, epoch_column="epoch"))
    assert got == brute(rows, mixing.WEIGHTS, mixing.TOTAL_SHARE, mixing.MAX_EPOCHS, mixing.SEED)
    assert mixing.mix(docs.limit(0)).count() == 0
    clash = docs.selectExpr("*", "1 as domain", "2 as tokens", "3 as budget", "4 as cut")
    assert mixing.mix(clash).columns == clash.columns


def test_seed_decides(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    a, b, c = (sorted(r["doc_id"] for r in mixing.mix(docs, total_share=0.4, max_epochs=1, seed=s).collect()) for s in (1, 1, 2))
    assert a == b != c
