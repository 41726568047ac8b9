import re
from collections import defaultdict

import pytest
from llm_tables import DOCUMENTS, clashing, documents, odd_documents

from clamor.llm import exact_dedup
from clamor.llm.exact_dedup import drop_exact_copies, exact_groups, heavy_winners


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        text = r["text"] or ""
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append(
            (-len(text), r["doc_id"] is None, r["doc_id"])
        )
    return groups


@pytest.mark.parametrize("heavy", [2, 1024])
def test_groups_match_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)
    texts = ["a b", "ab", "a  b ", "c", "c", "d", None, "", " "] + ["hot text"] * 30
    docs = documents(spark, texts).unionAll(odd_documents(spark))
    rows = docs.collect()
    found = exact_groups(docs).collect()
    assert len(found) == len(rows)
    groups = brute(rows)
    want = sorted((len(g), min(g)[2]) for g in groups.values())
    assert sorted({(f.text_sha256, f.group_size, f.keep_id) for f in found}, key=str) == sorted(
        {(f.text_sha256, f.group_size, f.keep_id) for f in found if f.kept}, key=str
    )
    assert sorted((f.group_size, f.keep_id) for f in found if f.kept and f.keep_id is not None) == [
        w for w in want if w[1] is not None
    ]
    assert sum(f.kept for f in found) == len(groups)
    assert all(f.doc_id == f.keep_id for f in found if f.kept)


@pytest.mark.parametrize("heavy", [2, 1024])
def test_rows_that_stay(spark, monkeypatch, heavy):
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)
    docs = clashing(odd_documents(spark), "digest", "heavy_rows", "PLACE", "size")
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len(brute(docs.collect()))
    assert {r.digest for r in rows} == {"mine"}


def test_every_heavy_digest_is_found(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HEAVY", 10)
    docs = documents(spark, ["hot"] * 40 + ["warm"] * 11 + [f"t{k}" for k in range(59)])
    keys = docs.selectExpr("doc_id", "unhex(sha2(text, 256)) digest", "length(text) size")
    found = heavy_winners(keys, "digest", "size", "doc_id").collect()
    assert sorted((r.heavy_rows, r.top_id) for r in found) == [(11, 40), (40, 0)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCUMENTS)
    assert exact_groups(docs).count() == 0
    assert drop_exact_copies(docs).count() == 0


def test_tied_rows_of_a_heavy_group_stay_where_they_lie(spark, monkeypatch):
    """One row repeated, and copies without a doc_id: one row of each group is shuffled."""
    parts = []
    split = exact_dedup.split
    monkeypatch.setattr(exact_dedup, "split", lambda *a: parts.append(split(*a)) or parts[-1])
    rows = [(7, "one row", "en", "a", 7)] * 300 + [(None, "no id", "en", "a", 5)] * 200
    docs = spark.createDataFrame(rows + [(k, f"t{k}", "en", "a", 2) for k in range(9)], DOCUMENTS)
    found = exact_groups(docs.repartition(8)).collect()
    assert sorted((str(r.doc_id), r.group_size) for r in found if r.kept) == sorted(
        [("7", 300), ("None", 200), *[(str(k), 1) for k in range(9)]]
    )
    assert len(found) == 509 and all(r.doc_id == r.keep_id for r in found)
    settled, others = parts[0]
    assert (settled.count(), others.count()) == (498, 11)


def test_ties_are_cut_in_each_task(spark):
    docs = spark.createDataFrame([(None, "no id", "en", "a", 5)] * 300, DOCUMENTS)
    kept = drop_exact_copies(docs)
    assert kept.count() == 1
    assert "WindowGroupLimit" in kept._jdf.queryExecution().optimizedPlan().toString()
