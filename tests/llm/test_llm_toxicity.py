import math
import random
import zlib
from collections import Counter

import pytest
from llm_tables import DOCUMENTS, clashing, documents, odd_documents

from clamor.llm import toxicity
from clamor.llm.ngrams import DistinctPlaces, code_points, hashed
from clamor.llm.toxicity import drop_toxic, is_held_out, toxicity_scores, train, training_rows

LABELS = "doc_id long, quality int, toxic int"
BAD = ["idiotic", "scumbag", "worthless", "pathetic"]


def made_texts(n, seed, first_id=0):
    rng, texts, labels = random.Random(seed), [], []
    parts = ["an", "the", "or", "ein", "ou", "st", "qu", "ing", "ble", "os", "ma", "lo"]
    for k in range(n):
        words = ["".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(rng.randrange(20, 200))]
        bad = int(rng.random() < 0.25)
        for _ in range(rng.randrange(2, 5) * bad):
            words[rng.randrange(len(words))] = rng.choice(BAD)
        texts.append(" ".join(words))
        labels.append((first_id + k, 1, bad))
    return texts, labels


def test_distinct_places_match_a_set():
    distinct = DistinctPlaces((3, 5), 16)
    distinct.SLICE = 40
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 39, 40, 41, 200):
        text = "".join(rng.choices("abÉ 日𝒳", k=n))
        codes = code_points(text.lower())
        want = {int(h) for size in (3, 5) for h in hashed(codes, size, 16)}
        found = distinct.of(text).tolist()
        assert set(found) == want and len(found) == len(want)


def test_held_out_accuracy_and_planted_texts(spark):
    texts, labels = made_texts(900, 2)
    docs = documents(spark, texts)
    rows = toxicity_scores(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    right = [r.predicted == labels[r.doc_id][2] for r in rows if r.held_out]
    assert len(right) > 120 and sum(right) >= 0.95 * len(right)


def test_labels_of_held_out_rows_are_not_used(spark):
    texts, labels = made_texts(300, 3)
    docs = documents(spark, texts)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    both = [
        sorted(toxicity_scores(docs, spark.createDataFrame(x, LABELS)).collect())
        for x in (labels, turned)
    ]
    assert both[0] == both[1]


def test_training_sample_is_bounded(spark):
    texts, labels = made_texts(60, 4)
    docs, table = documents(spark, texts), spark.createDataFrame(labels, LABELS)
    assert training_rows(docs, table, max_rows=10).count() == 10
    every = training_rows(docs, table).count()
    assert every == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(60))


@pytest.mark.parametrize(("label", "score"), [(0, 0), (1, 1), (None, 0)])
def test_one_class_or_none(spark, label, score):
    docs = documents(spark, ["some text", "other text", "", None])
    labels = spark.createDataFrame([(k, 1, label) for k in range(4)], LABELS)
    assert {round(r.score) for r in toxicity_scores(docs, labels).collect()} == {score}


def test_ratios_match_counts_of_all_texts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 1)
    monkeypatch.setattr(toxicity, "ROWS", 7)
    texts, labels = made_texts(40, 5)
    pairs = [(t, x[2]) for t, x in zip(texts, labels, strict=True)]
    model = train(spark.createDataFrame(pairs, "text string, label int"))
    distinct, seen = DistinctPlaces(toxicity.SIZES, toxicity.BITS), [Counter(), Counter()]
    for text, label in pairs:
        seen[label].update(distinct.of(text).tolist())
    toxic = sum(label for _, label in pairs)
    other = len(pairs) - toxic
    share = toxicity.SMOOTHING / len(pairs)
    for place in {*seen[0], *seen[1], 0, 1}:
        of_toxic = (seen[1][place] + share * toxic) / (toxic * (1 + share))
        of_other = (seen[0][place] + share * other) / (other * (1 + share))
        assert model.ratios[place] == pytest.approx(math.log(of_toxic / of_other), abs=1e-5)


def test_rejected_rows_go(spark):
    texts, labels = made_texts(400, 6)
    extra = odd_documents(spark)
    docs = clashing(documents(spark, texts, 1000).unionAll(extra), "score", "places")
    labels = spark.createDataFrame([(i + 1000, q, t) for i, q, t in labels] * 2, LABELS)
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    toxic = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    assert len([i for i in ids if i in toxic]) <= 0.03 * len(toxic)
    clean = {k + 1000 for k in range(400)} - toxic
    assert len(set(ids) & clean) >= 0.97 * len(clean)
    assert spark.createDataFrame([], DOCUMENTS).select(is_held_out()).count() == 0
    assert drop_toxic(spark.createDataFrame([], DOCUMENTS), labels).count() == 0
