"""Quality and toxicity: held-out accuracy, odd rows, no leak of held-out labels."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from visitflow.llm import quality_mil, toxicity_nb
from visitflow.llm.common import labelled_sample, table, utf8_column, word_hashes, word_spans
from visitflow.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,label,least", [("op2_quality_mil", "quality", 0.95), ("op4_toxicity_nb", "toxic", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    scored = QUERIES[name](spark, MEDIUM)
    rows = scored.join(table(spark, MEDIUM, "labels"), "doc_id").toPandas()
    assert scored.count() == table(spark, MEDIUM, "documents").count()
    assert ((rows["score"] >= 0) & (rows["score"] <= 1)).all()
    want = [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows["doc_id"]]
    assert list(rows["held_out"]) == want
    unseen = rows[rows["held_out"]]
    assert (unseen["predicted"] == unseen[label]).mean() >= least


@pytest.mark.parametrize("scorer", [quality_mil.score_documents, toxicity_nb.score_documents])
def test_odd_rows(spark, scorer):
    good = "the cat sat on the mat and looked at the quiet garden"
    bad = "idiot%%% idiot%%% scum### scum### trash$$$"
    docs = [(i, good + f" number {i}" if i % 3 else bad + f" {i}", i, "x") for i in range(60)]
    docs += [(100, None, 0, "x"), (101, "", 0, "x"), (102, " \n\t ", 0, "x"), (None, good, 0, "x"), (3, docs[3][1], 0, "x")]
    docs += [(103, "word " * 30_000, 0, "x"), (104, "x" * 200_000, 0, "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score long, label string")
    labels = [(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(60)] + [(None, 1, 0), (1, None, None), (5, 1, 0)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = scorer(frame, marks).toPandas()
    assert len(out) == len(docs)
    assert out["score"].notna().all() and out["predicted"].isin([0, 1]).all()
    twice = out[out["doc_id"] == 3]["score"]
    assert len(twice) == 2 and twice.nunique() == 1
    blank = out[out["doc_id"].isin([100, 101])]["score"]
    assert blank.nunique() == 1
    # No labels, no rows: constants and empty results.
    assert scorer(frame, marks.limit(0)).select("score").distinct().count() == 1
    assert scorer(frame.limit(0), marks).count() == 0


def test_held_out_labels_are_never_learned(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(300)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    ids = {r["doc_id"] for r in labelled_sample(docs, labels, "quality", 10_000).collect()}
    assert ids == {i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1}
    assert labelled_sample(docs, labels, "quality", 17).count() == 17


def test_sample_is_bounded_in_rows_and_bytes(spark):
    may = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(may[0], f"row {i}") for i in range(500)] + [(i, "y" * 1000) for i in may[1:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id").distinct().select("doc_id", F.lit(1).alias("quality"))
    assert labelled_sample(docs, labels, "quality", 17).count() == 17
    assert labelled_sample(docs, labels, "quality", 10_000).count() > 500
    size = sum(len(r["text"]) for r in labelled_sample(docs, labels, "quality", 10_000, max_bytes=5000).collect())
    assert 4000 <= size < 6000


def test_labels_of_absent_documents_take_no_room(spark):
    docs = spark.createDataFrame([(i * 1000, "t") for i in range(60)], "doc_id long, text string")
    labels = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    ids = {r["doc_id"] for r in labelled_sample(docs, labels, "quality", 40).collect()}
    may = {i * 1000 for i in range(60) if zlib.crc32(str(i * 1000).encode()) % 3 != 1}
    assert len(ids) == min(40, len(may)) and ids <= may


def test_filters_keep_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "en", 3.5), (2, None, "de", None)], "doc_id long, text string, lang string, x double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = toxicity_nb.drop_toxic(docs, none)
    assert kept.schema == docs.schema and sorted(kept.collect()) == sorted(docs.collect())
    assert quality_mil.keep_good(docs, none).count() == 2  # 0.5 for all


def test_long_texts_score_alike_in_any_batch():
    rng = np.random.default_rng(4)
    texts = ["good words here " * int(n) for n in rng.integers(1, 60, 40)]
    labels = rng.integers(0, 2, 40)
    for model, column in ((quality_mil.fit(pa.array(texts), labels, rounds=5), pa.array([*texts, "ä ö " * 700_000])),
                          (toxicity_nb.fit(pa.array(texts), labels), pa.array([*texts, "ä ö " * 300_000]))):
        whole = model.score(column)
        apart = np.concatenate([model.score(column.slice(i, 1)) for i in range(len(column))])
        assert np.allclose(whole, apart)


def test_training_reads_the_end_of_long_texts(monkeypatch):
    """Bags of over 400 passages, told apart by the last one alone; also in pieces of a step."""
    rng = np.random.default_rng(3)
    vocabulary = np.array([f"{a}{b}" for a in ("ga", "lo", "mi") for b in ("ren", "sta", "tul", "ve")])
    size = quality_mil.PASSAGE_WORDS
    texts, labels = [], np.arange(20) % 2
    for label in labels:
        words = list(rng.choice(vocabulary, size * int(rng.integers(401, 405))))
        texts.append(" ".join(words + ["word" if label else "###9"] * size))
    models = [quality_mil.fit(pa.array(texts), labels, rounds=120)]
    monkeypatch.setattr(quality_mil, "STEP_PASSAGES", 1000, raising=False)
    models.append(quality_mil.fit(pa.array(texts), labels, rounds=120))
    scores = [m.score(pa.array(texts)) for m in models]
    assert ((scores[0] >= 0.5) == labels).all()
    assert np.allclose(*scores, atol=1e-3)


def test_passages_cover_every_word():
    texts = ["", "one", " ".join(map(str, range(130))), "\n\n"]
    body, offsets = utf8_column(pa.array(texts))
    bag, features = quality_mil.passages(body, offsets)
    assert list(bag) == [0, 1, 2, 2, 2, 3]
    assert features.shape == (6, quality_mil.N_FEATURES)


def test_ngrams_stay_inside_texts():
    body, offsets = utf8_column(pa.array(["ab", "", "cd"]))
    grams = {}
    for at, bucket in toxicity_nb.ngram_buckets(body, offsets):
        grams[len(grams)] = len(at)
    # " ab " has two 3-grams, one 4-gram and no 5-gram; two spaces have none
    assert len(grams) == len(toxicity_nb.ORDERS) and {k: n for k, n in grams.items() if n} == {0: 4, 1: 2}


def test_ngrams_are_of_characters(monkeypatch):
    def buckets(*texts):
        parts = toxicity_nb._pieces(*utf8_column(pa.array(texts)))
        return [(at, bucket) for part, ends, _, cut in parts for at, bucket in toxicity_nb.ngram_buckets(part, ends, cut)]

    plain, cyrillic = buckets("ab cde", "", "fg"), buckets("аб вгд", "", "жз")
    assert [list(at) for at, _ in plain] == [list(at) for at, _ in cyrillic]
    text = "дурак é 漢字 word " * 40
    whole = {b for _, bucket in buckets(text) for b in bucket.tolist()}
    monkeypatch.setattr(toxicity_nb, "PIECE_BYTES", 101)  # cuts inside characters
    assert whole == {b for _, bucket in buckets(text) for b in bucket.tolist()}


def test_long_texts_have_the_passages_of_uncut_ones(monkeypatch):
    rng = np.random.default_rng(6)
    text = "  " + " \n".join("".join(rng.choice(list("abcé9.!A"), rng.integers(1, 12))) for _ in range(3000)) + " "
    whole = [(b, f) for body, offsets, _, after in quality_mil._pieces(pa.array([text])) for b, f in [quality_mil.passages(body, offsets, after)]]
    monkeypatch.setattr(quality_mil, "PIECE_BYTES", 1500)
    cut = [quality_mil.passages(body, offsets, after)[1] for body, offsets, _, after in quality_mil._pieces(pa.array([text]))]
    assert len(cut) > 5 and np.array_equal(np.concatenate(cut), whole[0][1])
    long_word = "x" * 9000 + " y"
    assert sum(len(body) for body, *_ in quality_mil._pieces(pa.array([long_word]))) == len(long_word)


def test_toxic_recall(spark):
    """Held-out toxic rows that reach the threshold, and clean rows that do."""
    rows = QUERIES["op4_toxicity_nb"](spark, "/root/testdata/sf0.1").join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").toPandas()
    unseen = rows[rows["held_out"]]
    toxic = unseen["toxic"] == 1
    assert (unseen["predicted"][toxic] == 1).mean() >= 0.75
    assert (unseen["predicted"][~toxic] == 1).mean() <= 0.005


def test_word_hashes_depend_on_the_word_alone():
    texts = ["the cat the", "cat", "x" * 70_000 + " the", "the " + "x" * 70_000]
    body, offsets = utf8_column(pa.array(texts))
    starts, ends, rows = word_spans(body, offsets)
    h = word_hashes(body, starts, ends)
    assert list(rows) == [0, 0, 0, 1, 2, 2, 3, 3]
    assert h[0] == h[2] == h[5] == h[6] and h[1] == h[3] and h[4] == h[7] and len(set(h.tolist())) == 3
