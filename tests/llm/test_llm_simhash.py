import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm_tables import DOCUMENTS, clashing, documents, odd_documents

from clamor.llm import simhash
from clamor.llm.components import components
from clamor.llm.simhash import (
    allocate,
    bit_groups,
    drop_near_copies,
    fingerprint,
    flips,
    near_groups,
    near_links,
    shared_neighbours,
)


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)]
    if words and not shingles:
        shingles = [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprints():
    texts = ["", " \t", "A", "a b", "a b c", "A  b\x0bc D", "x\x1cy z\x85 q\xa0r s t", "É é e"]
    texts += [" ".join(random.Random(k).choices("abcdefg", k=k)) for k in range(40)]
    for text in texts:
        assert fingerprint(text) == signed(brute_fingerprint(text)), ascii(text)


def scattered(n, seed, distance):
    """Values around a few centres, some chains, all within few bits of another."""
    rng, values = random.Random(seed), set()
    centres = [rng.getrandbits(64) for _ in range(max(2, n // 40))]
    while len(values) < n:
        value = rng.choice(centres + list(values)[:20])
        for b in rng.sample(range(64), rng.randrange(distance + 3)):
            value ^= 1 << b
        values.add(value)
    return sorted(map(signed, values))


@pytest.mark.parametrize(("distance", "crowd"), [(2, 64), (2, 2), (1, 3), (3, 4), (0, 64)])
def test_links_connect_what_lies_close(spark, monkeypatch, distance, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    values = scattered(250, distance, distance)
    nodes = spark.createDataFrame([(v, v) for v in values], "fp long, first_id long")
    links = near_links(nodes, distance).collect()
    apart = {(a, b): ((a ^ b) & (2**64 - 1)).bit_count() for a, b in combinations(values, 2)}
    assert all(apart[min(r.u, r.v), max(r.u, r.v)] <= distance for r in links)
    want = roots(values, [p for p, d in apart.items() if d <= distance])
    assert roots(values, [(r.u, r.v) for r in links]) == want


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_shared_neighbours_alone_are_exact(spark, distance):
    values = scattered(30, 9 + distance, distance)
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    linked = [(r.u, r.v) for r in shared_neighbours(nodes, distance).collect()]
    near = [
        p for p in combinations(values, 2)
        if ((p[0] ^ p[1]) & (2**64 - 1)).bit_count() <= distance
    ]
    assert roots(values, linked) == roots(values, near)


def test_thresholds_of_least_cost():
    rng = np.random.default_rng(3)
    for parts in (2, 3, 4):
        costs = [{t: float(rng.integers(1, 50)) for t in range(-1, 3)} for _ in range(parts)]
        cost, chosen = allocate(costs, 3 - parts)
        every = [
            sum(c[t] for c, t in zip(costs, ts, strict=True))
            for ts in np.ndindex(*[4] * parts)
            for ts in [tuple(t - 1 for t in ts)]
            if sum(ts) == 3 - parts
        ]
        assert cost == min(every) and sum(chosen) == 3 - parts


def test_bits_that_go_together_share_a_group():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2, (2000, 32))
    bits = np.hstack([base, base])[:, rng.permutation(64)].astype(np.int64)
    groups = bit_groups(bits.T @ bits, len(bits), 2)
    assert sorted(sum(groups, [])) == list(range(64)) and [len(g) for g in groups] == [32, 32]
    for group in groups:
        assert sum((bits[:, a] == bits[:, b]).all() for a, b in combinations(group, 2)) == 16
    assert len(flips(range(64), 2)) == 1 + 64 + 2016


@pytest.mark.parametrize("crowd", [64, 2])
def test_groups_match_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(6)
    base = [rng.choices([f"w{k}" for k in range(300)], k=400) for _ in range(4)]
    texts = [" ".join(b) for b in base]
    for _ in range(40):
        words = list(rng.choice(base))
        for k in rng.sample(range(400), rng.randrange(4)):
            words[k] = "changed"
        texts.append(" ".join(words))
    docs = documents(spark, texts, 100).unionAll(odd_documents(spark).filter("doc_id IS NOT NULL"))
    rows = near_groups(docs).collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    assert len(rows) == docs.count()
    near = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = roots(prints, near)
    for r in rows:
        assert (r.fp, r.component_id) == (signed(prints[r.doc_id]), want[r.doc_id])
    kept = drop_near_copies(clashing(docs, "gone_id", "fp"))
    assert kept.columns == [*docs.columns, "gone_id", "fp"]
    assert sorted({r.doc_id for r in kept.collect()}) == sorted(set(want.values()))


def test_odd_rows_and_empty_table(spark):
    docs = odd_documents(spark)
    rows = near_groups(docs).collect()
    assert len(rows) == 10
    assert {r.component_id for r in rows if r.fp == 0} == {1}
    assert {r.component_id for r in rows if r.doc_id in (0, None) and r.fp} == {0}
    empty = spark.createDataFrame([], DOCUMENTS)
    assert near_groups(empty).count() == drop_near_copies(empty).count() == 0


@pytest.mark.parametrize("shape", ["chain", "star", "random", "loops"])
def test_components(spark, shape):
    rng = random.Random(7)
    pairs = {
        "chain": [(k, k + 1) for k in range(60)],
        "star": [(500, k) for k in range(200)],
        "random": [(rng.randrange(150), rng.randrange(150)) for _ in range(110)],
        "loops": [(3, 3), (1, 2), (2, 1), (1, 2)],
    }[shape]
    links = spark.createDataFrame(pairs, "u long, v long")
    found = {r.node: r.root for r in components(links).collect()}
    linked = [p for p in pairs if p[0] != p[1]]
    assert found == roots({n for p in linked for n in p}, linked)
