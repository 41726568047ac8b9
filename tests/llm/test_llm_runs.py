import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF
from llm_tables import DOCUMENTS, clashing, documents, odd_documents

from clamor.llm import periodic_runs as pr
from clamor.llm.run_queries import op13_periodic_runs


def brute_runs(s):
    """All runs, by comparing every word with the one each period on."""
    known, found = {}, {}
    numbers = np.array([known.setdefault(w, len(known)) for w in s])
    for q in range(1, len(s) // 3 + 1):
        same = np.concatenate([[0], numbers[:-q] == numbers[q:], [0]]).astype(int)
        begins, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for i, j in zip(begins.tolist(), ends.tolist(), strict=True):
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
    return sorted(((a, length, q) for (a, length), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best, gone = None, set()
    for r in runs:
        gone.update(range(r[0] + r[2], r[0] + r[1]))
        if best is None or Fraction(r[1], r[2]) > Fraction(best[1], best[2]):
            best = r
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def random_words(rng):
    """Random words with repeats of many scales, some of them nested or touching."""
    words = []
    for _ in range(rng.randrange(1, 7)):
        words += rng.choices("abcdefghij", k=rng.randrange(30))
        unit = rng.choices("ab" if rng.random() < 0.4 else "abcdefgh", k=rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 70]))
        if rng.random() < 0.3:
            unit = unit * 3 + rng.choices("xy", k=2)
        times = rng.choice([1.5, 2.9, 3, 3.2, 4, 7.5, 30])
        words += (unit * 31)[: int(len(unit) * times)]
    return words


def local_runs(words):
    """Runs by tiles, stitched here."""
    numbers = pr.word_numbers([w.encode() for w in words])
    held, found = {}, {}
    for octave, first, part, anchors in pr.tiles(numbers):
        part, anchors = np.frombuffer(part, np.int32).tolist(), np.frombuffer(anchors, np.int32).tolist()
        for q, low, high in pr.stretches(octave, part, anchors):
            held.setdefault(q, []).append((first + low, first + high))
    for q in sorted(held):
        spans = []
        for low, high in sorted(held[q]):
            if spans and low <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
            else:
                spans.append((low, high))
        for low, high in spans:
            if high - low + q >= max(24, 3 * q):
                found.setdefault((low, high - low + q), q)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("tile", [64, 1024])
def test_tiles_find_every_run(monkeypatch, tile):
    monkeypatch.setattr(pr, "TILE", tile)
    rng, some = random.Random(tile), 0
    for _ in range(200):
        words = random_words(rng)
        want = brute_runs(words)
        some += len(want)
        assert local_runs(words) == want, words
    assert some > 200
    for words in (["a"] * 24, ["a"] * 23, list("ab") * 12, list("abcdefgh") * 3, list("abcdefghi") * 2, []):
        assert local_runs(words) == brute_runs(words)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = {tuple(r) for r in op13_periodic_runs(spark, SF).collect()}
    assert found == {brute_row(r.doc_id, r.text) for r in docs}
    assert len(found) == len(docs) and sum(r[1] > 0 for r in found) > len(docs) // 20


def test_one_long_document_over_many_tasks(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(9000)}" for _ in range(20_000)]
    words[3000:3000 + 7 * 2100] = words[3000:5100] * 7
    words[100:160] = ["x", "y"] * 30
    (row,) = pr.document_runs(documents(spark, [" ".join(words)])).where("period > 2").collect()
    start, end = 3000, 3000 + 7 * 2100
    while words[end] == words[end - 2100]:
        end += 1
    while words[start - 1] == words[start + 2099]:
        start -= 1
    assert tuple(row) == (0, start, end - start, 2100)
    parts = pr.exploded(documents(spark, [" ".join(words)]), "doc_id", "text", None)
    assert parts.where("octave is not null").count() > 2


def test_odd_rows_and_clashing_names(spark):
    docs = clashing(odd_documents(spark), "row", "body", "octave", "start", "words")
    rows = pr.collapse_runs(docs).collect()
    by_text = {}
    for r in docs.collect():
        by_text.setdefault(r.doc_id, []).append(r.text)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, t in by_text.items() for _ in t)
    (row,) = [r for r in rows if r.doc_id == 4]  # one word 60,000 times
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 0, 60_000, 1, 60_000_000)
    assert row.collapsed == "word"
    for r in rows:
        if r.doc_id != 4:
            assert r.n_runs == 0 and r.start is None
    none = pr.collapse_runs(spark.createDataFrame([], DOCUMENTS))
    assert none.count() == 0 and pr.document_runs(spark.createDataFrame([], DOCUMENTS)).count() == 0
