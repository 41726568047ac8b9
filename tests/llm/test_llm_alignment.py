import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF
from llm_tables import DOCUMENTS, clashing, documents, odd_documents
from test_llm_tokens import TEXTS, odd_texts
from tokenizers import Tokenizer

from clamor.llm import alignment as al
from clamor.llm.token_queries import op11_token_alignment

NAMES = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.PATTERN,
    public_tokenizers.path("piece_bpe_32k.model"),
)


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(NAMES[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=NAMES[2])


def byte_table():
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def brute_rows(libraries, docs):
    """The contract by the libraries alone, for all (doc_id, text)."""
    first, second = libraries
    letters, per_doc, counts = byte_table(), [], Counter()
    for doc_id, text in docs:
        a, b, want = [], [], " " + (text or "")
        if text:
            ids = first.encode(want, add_special_tokens=False).ids
            a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in ids]
            for i in second.encode(text):
                name = second.id_to_piece(i)
                raw = bytes([int(name[1:-1], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()
                b.append((i, raw))
        if not (b"".join(x for _, x in a) == b"".join(x for _, x in b) == want.encode()):
            a, b = [], []
        spans = []
        for tokens in (a, b):
            at, held = 0, []
            for i, raw in tokens:
                held.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(held)
        pairs, k = [], 0
        for i, low, high in spans[0]:
            while k and spans[1][k - 1][2] > low:
                k -= 1
            while k < len(spans[1]) and spans[1][k][1] < high:
                if spans[1][k][2] > low:
                    pairs.append((i, spans[1][k][0]))
                k += 1
        ends = sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]})
        groups, low = [], 0
        if len(spans[0]) < 3000:
            for end in ends:
                groups.append("|".join(
                    ",".join(str(i) for i, s, e in side if low <= s and e <= end) for side in spans
                ))
                low = end
        counts.update(pairs)
        per_doc.append((doc_id, len(a), len(b), len(ends), pairs, ";".join(groups), len(spans[0]) < 3000))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for doc_id, n_a, n_b, n, pairs, groups, shown in per_doc:
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        rows.append((
            doc_id, n_a, n_b, n, len(pairs), sum(counts[p] == best[p[1]] for p in pairs),
            sum(counts[p] for p in pairs), digest if shown else None,
        ))
    return rows


def as_rows(frame, like):
    """Rows of a frame, without the digest where the brute force has none."""
    bare = {r[:7] for r in like if r[7] is None}
    found = [tuple(r) for r in frame.collect()]
    return sorted(((*r[:7], None) if r[:7] in bare else r for r in found), key=str)


def texts():
    rng = random.Random(3)
    prose = " ".join(rng.choices(["alpha", "Straße,", "don't", "42½", "naïve.", "слово", "日本語", "\n\n  x"], k=1500))
    return [prose, "no-blank-at-all" * 300, "é" * 2000, prose[:3000] + "▁", "a b " * 900, *TEXTS, *odd_texts(60, 9)]


@pytest.mark.parametrize(("size", "span", "fan", "hot"), [(1 << 16, 1 << 14, 16, 1 << 18), (700, 64, 3, 40)])
def test_rows_are_those_of_the_libraries(spark, libraries, size, span, fan, hot):
    docs = list(enumerate(texts()))
    found = al.align(
        documents(spark, [t for _, t in docs]), *NAMES, size=size, span=span, fan=fan, most_hot=hot
    )
    want = brute_rows(libraries, docs)
    assert as_rows(found, want) == sorted(want, key=str)


def test_query_equals_brute_force(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute_rows(libraries, [(r.doc_id, r.text) for r in docs])
    assert as_rows(op11_token_alignment(spark, SF), want) == sorted(want, key=str)


def test_composition_is_associative():
    enc, rng = al.encoders(*NAMES), random.Random(7)
    for text in ("größer naïve 日本語 don't 123 " * 6, "xyzzy" * 40, "é" * 30):
        a, b = enc.both(text)
        ends_a, ends_b = np.cumsum(enc.length_a[a]), np.cumsum(enc.length_b[b])
        shown, n, codes = al.closed(enc, a, b)
        for _ in range(30):
            cuts = sorted({0, ends_a[-1], *(rng.randrange(ends_a[-1]) for _ in range(rng.randrange(12)))})
            parts = []
            for low, high in zip(cuts, cuts[1:], strict=False):
                (p, q), (s, t) = (np.searchsorted(e, [low, high], side="right") for e in (ends_a, ends_b))
                parts.append(al.fragment(enc, a[p:q], b[s:t], ends_a[p:q], ends_b[s:t]))
            while len(parts) > 1:  # any order of neighbours
                k = rng.randrange(len(parts) - 1)
                upto = k + rng.randrange(2, 4)
                parts[k:upto] = [al.compose(enc, parts[k:upto])]
            found = al.finished(enc, parts[0])
            assert found[:3] == (shown, n, len(codes)) and len(parts[0].tail_a) == 0
            assert dict(zip(*found[3:], strict=True)) == dict(zip(*al.counted(codes), strict=True))


def test_odd_rows_and_clashing_names(spark, libraries):
    docs = clashing(odd_documents(spark), "row", "codes", "n_a", "node")
    want = brute_rows(libraries, [(r.doc_id, r.text) for r in docs.collect()])
    assert as_rows(al.align(docs, *NAMES), want) == sorted(want, key=str)
    assert al.align(spark.createDataFrame([], DOCUMENTS), *NAMES).count() == 0
