import base64
import random

import numpy as np
import pytest
from llm_tables import DOCUMENTS, clashing, documents, odd_documents

from clamor.llm.substring_dedup import (
    GEAR,
    MAX_CHUNK,
    cuts,
    digests,
    drop_repeats,
    gear_hashes,
    repeated_spans,
    with_repeats_removed,
    without,
)


def prose(n, seed):
    rng = random.Random(seed)
    syllables = ["an", "the", "or", "ein", "ou", "st", "qu", "ré", "ing", "ble", "os", "ma"]
    return " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 5))) for _ in range(n))


def test_gear_hash_rolls():
    octets = np.frombuffer(prose(60, 1).encode(), np.uint8)
    h, want = 0, []
    for b in octets.tolist():
        h = (2 * h + int(GEAR[b])) & 0xFFFF
        want.append(h)
    assert gear_hashes(octets).tolist() == want


@pytest.mark.parametrize(
    "text", ["", "a", " ", "short text", prose(500, 2), "x" * 30_000, "é" * 9_000, " " * 10_000,
             "ab" * 4096 + " tail", "\n\n".join(prose(30, k) for k in range(5))]
)
def test_cuts_cover_the_text(text):
    octets = text.encode()
    ends = cuts(np.frombuffer(octets, np.uint8))
    assert ends == sorted(set(ends)) and (ends[-1:] or [0]) == [len(octets)]
    parts = [octets[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    assert all(p.decode() for p in parts)  # no character is cut
    assert all(len(p) <= 2 * MAX_CHUNK for p in parts)


def test_insertions_shift_nothing():
    text = prose(2000, 3)
    other = "some words more, " + text
    def pieces(t):
        octets = t.encode()
        ends = cuts(np.frombuffer(octets, np.uint8))
        return [octets[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    assert len(set(pieces(text)) - set(pieces(other))) <= 3


@pytest.mark.parametrize("words", [51, 60, 120])
def test_shared_passages_go_and_clean_texts_stay(spark, words):
    passages = [prose(words, 1000 + k) for k in range(30)]
    texts = [f"{prose(80, k)}. {p} {prose(70, 500 + k)}" for k, p in enumerate(passages)]
    texts += [f"{prose(40, 2000 + k)}\n{p}\n{prose(90, 3000 + k)}" for k, p in enumerate(passages)]
    texts += [prose(200, 4000 + k) for k in range(30)]
    rows = drop_repeats(documents(spark, texts)).orderBy("doc_id").collect()
    for r in rows[:30] + rows[60:]:
        assert r.text == texts[r.doc_id] and r.n_chars == len(r.text)
    for r in rows[30:60]:
        left = set(passages[r.doc_id - 30].split()) & set(r.text.split())
        assert r.text != texts[r.doc_id] and r.n_chars == len(r.text)
        assert len(r.text.split()) <= 130 + 0.7 * words, left
        assert r.text.startswith(prose(40, 2000 + r.doc_id - 30)[:100])


def test_sources_and_spans(spark):
    passage = prose(100, 5)
    texts = [passage, prose(50, 6), f"{prose(30, 7)} {passage}", f"{passage} {prose(30, 8)}"]
    rows = with_repeats_removed(documents(spark, texts, 10)).orderBy("doc_id").collect()
    assert [r.removed is None for r in rows] == [True, True, False, False]
    for r in rows[2:]:
        assert list(r.removed.sources) == [10] and r.removed.words >= 80
        spans = [tuple(map(int, s.split("-"))) for s in r.removed.spans.split(",")]
        assert without(r.text, [(a, b, 0) for a, b in spans]) == r.removed.text


def test_short_repeats_and_repeats_within_a_text_stay(spark):
    line = prose(8, 9)
    texts = [f"{prose(60, 10 + k)}\n{line}\n{prose(60, 40 + k)}" for k in range(20)]
    texts.append("\n".join([prose(60, 99)] * 5))
    rows = drop_repeats(documents(spark, texts)).collect()
    assert all(r.text == texts[r.doc_id] for r in rows)


def test_whole_copies_and_odd_rows(spark):
    text = prose(300, 11)
    docs = documents(spark, [text, text, text], 20).unionAll(odd_documents(spark))
    docs = clashing(docs, "removed", "DIGESTS", "marked_id")
    rows = drop_repeats(docs)
    assert rows.columns == docs.columns
    kept = {r.doc_id: r for r in rows.collect()}
    assert kept[20].text == text and kept[21].text == kept[22].text == ""
    assert kept[21].n_chars == 0 and kept[1].text is None and kept[4].text == "word " * 60_000
    assert kept[5].text == "x" * 50_000 and rows.count() == docs.count()
    assert drop_repeats(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_rows_without_a_doc_id_and_of_one_doc_id_are_told_apart(spark):
    passage = prose(120, 13)
    texts = [f"{prose(60, 20 + k)} {passage} {prose(60, 50 + k)}" for k in range(6)]
    rows = [(None, t) for t in texts[:3]] + [(7, t) for t in texts[3:]] + [(None, prose(200, 80)), (7, prose(200, 81))]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, marked_key int")
    left = {r.marked_key: r for r in with_repeats_removed(docs).collect()}
    changed = [k for k in range(8) if left[k].removed is not None]
    # One text keeps the passage: one of those with a doc_id.
    assert len(changed) == 5 and {0, 1, 2} <= set(changed) and not {6, 7} & set(changed)
    for k in changed:
        assert list(left[k].removed.sources) == [7] and left[k].removed.words >= 100
    nameless = with_repeats_removed(docs.filter("doc_id IS NULL")).collect()
    assert sum(r.removed is not None for r in nameless) == 2
    assert all(list(r.removed.sources) == [] for r in nameless if r.removed is not None)


def brute_marks(rows):
    """For each row the digests that a row before it in the order of owners holds."""
    held = [set(digests(t.encode(), cuts(np.frombuffer(t.encode(), np.uint8)))) for _, t in rows]
    return [
        {d: min(j for (j, _), other in zip(rows, held, strict=True) if d in other) for d in mine}
        for (i, _), mine in zip(rows, held, strict=True)
    ]


def test_result_equals_brute_force(spark):
    rng = random.Random(14)
    shared = [prose(rng.randrange(20, 90), 100 + k) for k in range(12)]
    rows = []
    for k in range(80):
        parts = [prose(rng.randrange(10, 60), 1000 + 5 * k + n) for n in range(3)]
        parts[1:1] = rng.choices(shared, k=rng.randrange(3))
        rows.append((k, rng.choice([" ", "\n"]).join(parts)))
    found = {r.doc_id: r.removed for r in with_repeats_removed(documents(spark, [t for _, t in rows])).collect()}
    cut = 0
    for (i, text), owners in zip(rows, brute_marks(rows), strict=True):
        spans, sources = repeated_spans(text, {d: o for d, o in owners.items() if o < i})
        got = found[i]
        if spans:
            cut += 1
            assert got.text == without(text, spans) and set(got.sources) == sources
            assert got.spans == ",".join(f"{a}-{b}" for a, b, _ in spans)
        else:
            assert got is None
    assert cut >= 20


def test_unknown_digests_change_nothing():
    assert repeated_spans(prose(100, 12), {}) == ([], set())
    assert repeated_spans("", {1: 2}) == ([], set())


def left_of(passage, seed, between=" "):
    """Bytes of the passage that stay when two texts share it."""
    first = f"{prose(40, seed)}{between}{passage}{between}{prose(45, seed + 1)}".encode()
    before = f"{prose(50, seed + 2)}{between}"
    other = f"{before}{passage}{between}{prose(35, seed + 3)}"
    owned = dict.fromkeys(digests(first, cuts(np.frombuffer(first, np.uint8))), 1)
    spans, _ = repeated_spans(other, owned)
    begin = len(before.encode())
    end = begin + len(passage.encode())
    return end - begin - sum(max(0, min(b, end) - max(a, begin)) for a, b, _ in spans)


@pytest.mark.parametrize("words, times", [(1, 60), (2, 40), (8, 10), (20, 4)])
def test_repeated_lines_are_found(words, times):
    for k in range(300):
        passage = "\n".join([prose(words, 10_000 + k)] * times)
        assert left_of(passage, 5 * k, "\n") < 0.5 * len(passage.encode()), (k, passage[:80])


@pytest.mark.parametrize("letters", ["CJK", "base64"])
@pytest.mark.parametrize("size", [300, 600, 1500, 3000, 4000, 6000])
def test_text_without_blanks_is_found(letters, size):
    rng = random.Random(size)
    for k in range(30):
        if letters == "CJK":
            passage = "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(size // 3))
        else:
            passage = base64.b64encode(rng.randbytes(size * 3 // 4)).decode()
        assert left_of(passage, 5 * k) <= 160, (k, len(passage))
        assert left_of(passage, 5 * k, "") <= 160, (k, len(passage))


def test_passages_just_over_50_words_are_found():
    for k in range(1500):
        passage = prose(51, 10_000 + k)
        assert left_of(passage, 5 * k) < 0.5 * len(passage.encode()), (k, passage)
