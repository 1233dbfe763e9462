"""BPE against the tokenizers library."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from visitflow.llm import bpe
from visitflow.llm.common import table

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def theirs():
    return tokenizers.Tokenizer.from_file(bpe.default_path())


ODD = ["", " ", "ΑΣ ΣΑΣ'S don't I'LL we've", "<|endoftext|>x<|startoftext|>", "<|endoftext|", "é é İx ½²٣", "a\x1cb\x85c d"]
ODD += ["a" * 3000, "!?" * 300, "日本語 テスト 한국어 🙂👨‍👩‍👧", "abcdefghij" * 40, "x" * 48 + " " + "y" * 49, "ß ﬁ Ǆ"]


def same(texts, theirs):
    own = bpe.load(bpe.default_path())
    for text, ids, other in zip(texts, own.encode(texts), theirs.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == other.ids, text[:80]
        assert own.decode(ids) == theirs.decode(other.ids, skip_special_tokens=False)


def test_odd_texts(theirs):
    same(ODD, theirs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=60), max_size=4))
def test_any_text(texts):
    same(texts, tokenizers.Tokenizer.from_file(bpe.default_path()))


def test_whole_table(spark, theirs):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = {r["doc_id"]: r for r in bpe.encode_documents(docs).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        ids = theirs.encode(text, add_special_tokens=False).ids
        decoded = theirs.decode(ids, skip_special_tokens=False)
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(1, None, 5), (None, "a b", 5), (2, "", 5), (1, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.encode_documents(docs, keep=True).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["decoded"]) for r in got) == [
        ("1", 0, ""), ("1", 0, ""), ("2", 0, ""), ("None", 2, "a</w> b</w>")
    ]
    assert bpe.encode_documents(docs.limit(0)).count() == 0
