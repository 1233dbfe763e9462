"""The pipeline's stages, each against a plain computation on what it was given."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as cp
from test_jaccard_join import brute as brute_components
from test_mixing import brute as brute_mix
from visitflow.llm import bpe, mixing, quality_mil, toxicity_nb
from visitflow.llm.common import stored, table

SMALL = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    assert [name for name, _ in cp.STAGES] == ["quality", "toxicity", "near_duplicates", "mixing", "tokens"]
    docs = table(spark, SMALL, "documents")
    labels = table(spark, SMALL, "labels")
    columns = docs.columns
    for name, stage in cp.STAGES:
        given = [tuple(r) for r in docs.collect()]
        out = stored(stage(spark, docs, SMALL), "test-stage")
        got = [tuple(r) for r in out.collect()]
        if name == "quality":
            passed = {r["doc_id"] for r in quality_mil.score_documents(docs, labels).where("score >= 0.5").collect()}
            assert Counter(got) == Counter(r for r in given if r[0] in passed)
        elif name == "toxicity":
            passed = {r["doc_id"] for r in toxicity_nb.score_documents(docs, labels).where("score < 0.7").collect()}
            assert Counter(got) == Counter(r for r in given if r[0] in passed)
        elif name == "near_duplicates":
            groups = brute_components([(r[0], r[1]) for r in given], cp.NEAR)
            assert sorted(r[0] for r in got) == sorted(i for i, _, low in groups if i == low)
        elif name == "mixing":
            want = brute_mix(given, mixing.WEIGHTS, mixing.TOTAL_SHARE, cp.MIX_EPOCHS, mixing.SEED)
            assert sorted(r[0] for r in got) == sorted(i for i, _, _ in want)
        else:
            own = bpe.load(bpe.default_path())
            sizes = {r[0]: len(ids) // 4 for r, ids in zip(given, own.encode([r[1] or "" for r in given]))}
            assert {r[0]: r[1] for r in got} == sizes
        if name != "tokens":
            assert out.columns == columns and got
        docs = out
    whole = sorted(map(tuple, cp.run(spark, SMALL).collect()))
    assert whole == sorted(got)


def test_toxic_and_junk_documents_go(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = {r["doc_id"]: r for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    kept = {r["doc_id"] for r in cp.toxicity(spark, cp.quality(spark, docs, "/root/testdata/sf0.01"), "/root/testdata/sf0.01").collect()}
    clean = [i for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0]
    bad = [i for i, r in labels.items() if r["quality"] == 0 or r["toxic"] == 1]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)
    assert sum(i in kept for i in bad) <= 0.05 * len(bad)


def test_odd_tables_through_all_stages(spark):
    """Nulls, repeats, clashing column names and empty tables, through ``run``."""
    from visitflow.session import scratch_path

    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[i % 20 :] + [f"own{i}"] * 3), "en", "s1", 1, 0.5, "x") for i in range(40)]
    rows += [rows[0], rows[0], (None, None, None, None, None, None, None), (70, "", "en", None, 0, None, "x")]
    rows += [(71, None, "de", "s2", 0, 1.0, "x"), (None, "a null id", "en", "s1", 3, 1.0, "x"), (72, "long " * 30_000, "en", "s1", 9, 1.0, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, node string"
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(None, None, None), (3, 0, 1)], "doc_id long, quality int, toxic int")
    for some in (docs, docs.limit(0)):
        folder = scratch_path(spark, "odd-pipeline")
        some.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        given = some
        for name, stage in cp.STAGES[:-1]:
            given = stored(stage(spark, given, folder), "odd-stage")
            assert given.columns == docs.columns, name
        whole = cp.run(spark, folder).collect()
        assert len(whole) == given.count()
        assert Counter(r["doc_id"] for r in whole) == Counter(r["doc_id"] for r in given.collect())
    assert not whole
