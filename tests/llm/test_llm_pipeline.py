"""The pipeline over the smallest tables, each stage on its own input."""

import re
from collections import defaultdict

import public_tokenizers
import pytest
from conftest import SF
from llm_tables import odd_documents
from test_llm_simhash import brute_fingerprint, roots
from test_llm_tokens import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from clamor.llm.toxicity import train, training_rows, with_toxicity


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after each stage."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        found[name] = (docs, after)
        docs = after
    return found


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_order_and_columns(stages):
    assert list(stages) == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "substring_dedup", "packing",
    ]
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_rejected_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = with_toxicity(before, train(training_rows(before, labels))).collect()
    assert set(by_id(after)) == {r.doc_id for r in scored if r.score < 0.5}
    assert 0 < after.count() <= before.count()


def test_one_of_equal_texts_stays(stages):
    before, after = stages["exact_dedup"]
    groups = defaultdict(list)
    for r in before.collect():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append((-len(r.text or ""), r.doc_id))
    assert set(by_id(after)) == {min(g)[1] for g in groups.values()}


def test_one_of_near_copies_stays(stages):
    before, after = stages["simhash_near_dedup"]
    prints = {i: brute_fingerprint(r.text) for i, r in by_id(before).items()}
    ids = sorted(prints)
    near = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if (prints[a] ^ prints[b]).bit_count() <= 2
    ]
    assert set(by_id(after)) == set(roots(ids, near).values())


def test_shared_passages_go(stages):
    before, after = (by_id(x) for x in stages["substring_dedup"])
    assert set(before) == set(after)
    first = {}
    for i in sorted(before):
        words = (before[i].text or "").split()
        for k in range(len(words) - 50):
            first.setdefault(tuple(words[k : k + 51]), i)
    for i, r in after.items():
        words = (r.text or "").split()
        held = [first.get(tuple(words[k : k + 51])) for k in range(len(words) - 50)]
        assert all(h is None or h >= i for h in held)
        if r.text is not None and r.text != before[i].text:
            assert r.n_chars == len(r.text) < len(before[i].text)


def test_every_token_is_packed_once(stages):
    before, after = stages["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {
        r.doc_id: [library.encode(r.text or "", add_special_tokens=False).ids + [1]]
        for r in before.collect()
    }
    check_packing(after.collect(), want)


def test_run_gives_the_rows_of_the_stages(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def documents(frame):
        return sorted({(r.doc_id, r.doc_tokens) for r in frame.select(*columns).collect()})

    assert documents(corpus_pipeline.run(spark, SF)) == documents(stages["packing"][1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_rows_pass_all_stages(spark, tmp_path):
    for size, docs in (("odd", odd_documents(spark)), ("none", odd_documents(spark).limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).write.parquet(f"{tmp_path}/{size}-{name}")
            docs = spark.read.parquet(f"{tmp_path}/{size}-{name}")
        assert (docs.count() > 0) == (size == "odd")
