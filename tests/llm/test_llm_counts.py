import random

import public_tokenizers
import pytest
from conftest import SF
from llm_tables import DOCUMENTS, clashing, documents, odd_documents
from test_llm_tokens import TEXTS, odd_texts
from tokenizers import Tokenizer

from clamor.llm import token_counts as tc
from clamor.llm.token_queries import op12_token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def size(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def long_texts():
    """Texts that are hard to cut: no blanks, one word, marks, specials, suffixes."""
    rng = random.Random(5)
    prose = " ".join(rng.choices(["alpha", "Straße,", "don't", "42½", "naïve.", "слово"], k=900))
    return [
        prose,
        "x" * 3000,
        prose[:1500] + "y" * 1500 + prose[:1500],
        "日本語のテキスト" * 300,
        "éà " * 700,
        "<|endoftext|>" * 250,
        "'ll're's've" * 300,
        "!?" * 1500,
        "a" + "́" * 2500,
        " " * 4000,
        "각가" * 600,
        "".join(odd_texts(260, 4)),
        ("x" * 400 + " ") * 9,
    ]


def test_chunks_give_the_counts_of_the_library(spark, library):
    texts = [*long_texts(), *TEXTS]
    rows = tc.token_counts(documents(spark, texts), WORDS, chunk=256, reach=16).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {k: size(library, t) for k, t in enumerate(texts)}
    assert {r.doc_id: r.n_bytes for r in rows} == {k: len(t.encode()) for k, t in enumerate(texts)}


def test_overlaps_without_a_common_begin_are_widened(spark, library, monkeypatch):
    rounds, real = [], tc.spliced

    def seen(encoded):
        rows = encoded.select("row", "left", "right_reach").collect()
        rounds.append(rows)
        return real(encoded)

    monkeypatch.setattr(tc, "spliced", seen)
    text = "one two " * 150 + "y" * 200 + " three four" * 146 + "z" * 4000 + " five" * 100
    (row,) = tc.token_counts(documents(spark, [text]), WORDS, chunk=1280, reach=80).collect()
    assert row.n_tokens == size(library, text)
    assert [len(chunks) for chunks in rounds] == [6, 6, 3]  # cuts inside the long word go
    assert {r.right_reach for r in rounds[0]} == {0, 80}
    assert {r.right_reach for r in rounds[1]} == {0, 80, 320} == {r.right_reach for r in rounds[2]}


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = {tuple(r) for r in op12_token_counts(spark, SF).collect()}
    want = {(r.doc_id, len((r.text or "").encode()), size(library, r.text)) for r in docs}
    assert found == {(*r, r[2] > 2048) for r in want}


def test_odd_rows_and_clashing_names(spark, library):
    docs = clashing(odd_documents(spark), "row", "n_tokens", "part", "cuts")
    want = sorted(((r.doc_id, size(library, r.text)) for r in docs.collect()), key=str)
    for chunk in (1 << 16, 5000):
        rows = tc.token_counts(docs, WORDS, chunk=chunk, reach=200).collect()
        assert sorted(((r.doc_id, r.n_tokens) for r in rows), key=str) == want
    assert tc.token_counts(spark.createDataFrame([], DOCUMENTS), WORDS).count() == 0
