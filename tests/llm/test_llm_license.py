import re

import pytest
from llm_tables import DOCUMENTS, clashing, documents, odd_documents

from clamor.llm.license_scan import BASE, NOTICES, WORD, license_scan


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def places(text):
    words = re.findall(WORD, lowered(text))
    found = []
    for phrase, label in BASE:
        p = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    return words, found


def test_base_places_match_brute_force(spark):
    texts = [
        "cc by cc by, CC-BY all rights reserved all rights",
        "All\nrights -- reserved. General Public License general public",
        "ccby cc bye cc  by\x00cc\x1fby",
        "the GENERAL public licen\u212ae and worK",
        "all rights reservedé All Rights Reserved é all rights reserved",
        "x cc by " * 500,
        "cc",
    ]
    docs = documents(spark, texts).unionAll(odd_documents(spark))
    rows = {r.doc_id: r for r in license_scan(docs.filter("doc_id IS NOT NULL")).collect()}
    for k, text in enumerate(texts[:1]):
        assert k in rows
    for r in license_scan(documents(spark, texts)).collect():
        words, found = places(texts[r.doc_id])
        assert r.n_words == len(words)
        assert r.n_base == len(found)
        assert r.first_word == min((p for p, _ in found), default=None)
        assert r.last_word == max((p for p, _ in found), default=None)
        assert r.base_labels == ",".join(sorted({label for _, label in found}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1


def test_long_notice_with_gaps(spark):
    notice, label = next((p, m) for p, m in NOTICES if len(p.split()) > 20)
    words = notice.split()
    bent = " ".join([*words[:9], "indeed", "so", *words[9:17], *words[18:]])
    half = " ".join(words[: len(words) // 2])
    exact, changed, partial, clean = license_scan(
        documents(spark, [f"Foo. {notice}", f"Foo {bent} bar", half, "nothing of the sort"])
    ).orderBy("doc_id").collect()
    assert label in exact.labels.split(",") and exact.score == 1
    assert label in changed.labels.split(",") and 0.7 <= changed.score < 1
    assert partial.labels == clean.labels == "" and clean.score == 0


def test_own_phrases(spark):
    """The Kelvin sign is no k, though its lower case is one."""
    docs = documents(spark, ["please do not Keep this", "do not   keep", "do not \u212aeep"])
    rows = license_scan(docs, base=[("do not keep", "private")], notices=[]).collect()
    assert {(r.doc_id, r.base_labels, r.first_word, r.n_words) for r in rows} == {
        (0, "private", 1, 5), (1, "private", 0, 3), (2, "", None, 3),
    }


def test_odd_rows_and_empty_table(spark):
    docs = clashing(odd_documents(spark), "words", "ROW", "label")
    rows = license_scan(docs).collect()
    assert len(rows) == 10
    assert sorted(r.n_words for r in rows) == [0, 0, 0, 0, 1, 6, 6, 6, 7, 60_000]
    assert license_scan(spark.createDataFrame([], DOCUMENTS)).count() == 0


@pytest.mark.parametrize("words", [8, 9])
def test_templates_are_lower_case_words(words):
    for phrase, _ in [*BASE, *NOTICES]:
        assert phrase == " ".join(re.findall(WORD, phrase))
        assert len(phrase.split()) > 1
