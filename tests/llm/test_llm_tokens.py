import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_tables import DOCUMENTS, clashing, documents, odd_documents
from tokenizers import Tokenizer

from clamor.llm import byte_bpe, packing, word_tokens
from clamor.llm.byte_bpe import codec, decode_ids, encode_texts, token_digests
from clamor.llm.packing import Packer, pack

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN

TEXTS = [
    "", " ", "  \n\n a", "I'll don't 've 's", "é" * 700, "ab" * 1500 + "x y", "a" * 300,
    " " * 300 + "x" + " " * 700, "\x1c\x1d x \u0085z q᠎​ ", "<|endoftext|> <|x",
    "J̌ é K̇ Å ẛ̣", "größer ŒUVRE İstanbul ΣΑΣ", "日本語のテキスト𝒳𐍈",
    "\U0010ffff퟿", "a.b,c.,d 'S N'T ok.", "٣٤ ½ ²", "word, word. word", "\x00\x01 \x7f",
]


def odd_texts(n, seed):
    rng = random.Random(seed)
    ranges = [(32, 127), (9, 14), (0x80, 0x3000), (0x300, 0x370), (0x3000, 0xD7FF), (0x10000, 0x10FFFF)]
    return [
        "".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(30)))
        for _ in range(n)
    ]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("known", [500_000, 50])
def test_ids_are_those_of_the_library(library, monkeypatch, known):
    monkeypatch.setattr(byte_bpe, "KNOWN", known)
    monkeypatch.setattr(byte_bpe, "BLOCK", 500)
    texts = TEXTS + odd_texts(800, 1)
    own = byte_bpe.Codec(RANKS, PATTERN)
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids == as_bytes(library.encode_ordinary(text)), ascii(text)
        assert own.decode(ids) == text.encode()


def test_long_pieces_merge_as_the_matrix_does():
    own, rng = codec(RANKS, PATTERN), random.Random(2)
    pieces = [bytes(rng.choice(b"abcdest") for _ in range(n)) for n in range(2, 60)]
    sizes, ids = own.encode_matrix(pieces, 64)
    ends = np.cumsum(sizes)
    for piece, end, size in zip(pieces, ends, sizes, strict=True):
        assert own.encode_long(piece).tolist() == ids[end - size : end].tolist()


def test_digests_of_odd_rows(spark, library):
    docs = clashing(odd_documents(spark), "ids", "n_tokens")
    want = []
    for r in docs.collect():
        ids = as_bytes(library.encode_ordinary(r.text or ""))
        text = (r.text or "").encode()
        want.append((r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()))
    found = [tuple(r) for r in token_digests(docs, RANKS, PATTERN).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert token_digests(docs.limit(0), RANKS, PATTERN).count() == 0


def test_round_trip_of_columns(spark):
    docs = clashing(odd_documents(spark), "ids")
    both = decode_ids(encode_texts(docs, RANKS, PATTERN), RANKS, "ids_")
    for r in both.collect():
        assert bytes(r.decoded) == (r.text or "").encode() and r.ids == "mine"


@pytest.mark.parametrize("known", [600_000, 20])
def test_word_ids_are_those_of_the_library(monkeypatch, known):
    monkeypatch.setattr(word_tokens, "KNOWN", known)
    library, own = Tokenizer.from_file(WORDS), word_tokens.WordTokens(WORDS)
    for text in TEXTS + odd_texts(800, 3):
        assert own.encode(text) == as_bytes(library.encode(text, add_special_tokens=False).ids), ascii(text)


@pytest.mark.parametrize("marker", ["<|EndOfText|>", "<|ENDOFTEXT|>", "<|endofTEXT|>", "<|endoftext|>"])
def test_special_tokens_in_any_case(marker):
    library, own = Tokenizer.from_file(WORDS), word_tokens.WordTokens(WORDS)
    for name in {t.content for t in library.get_added_tokens_decoder().values()} | {marker}:
        for form in (name, name.upper(), name.title()):
            for text in (f"a {form} b", form, f"é{form}É.", f"{form}{marker} {form.lower()}"):
                want = as_bytes(library.encode(text, add_special_tokens=False).ids)
                assert own.encode(text) == want, ascii(text)


def check_packing(rows, want):
    """Every id of every document lies in one piece, sequences have no gap."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(want)
    for doc_id, pieces in by_doc.items():
        copies, ids = len(want[doc_id]), want[doc_id][0]
        spans = sorted((p.start, p.length) for p in pieces)
        assert sum(n for _, n in spans) == copies * len(ids)
        for p in pieces:
            assert p.doc_tokens == len(ids) and p.length > 0
            assert zlib.crc32(as_bytes(ids[p.start : p.start + p.length])) == p.ids_crc32
        if copies == 1:
            assert [s for s, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and len({(p.tier, p.step_id) for p in pieces}) == 1
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding, by_sequence


def test_packing_holds_every_id_once(spark):
    library, rng = Tokenizer.from_file(WORDS), random.Random(4)
    texts = [" ".join(rng.choices(["alpha", "beta", "Straße", "42"], k=rng.randrange(1500))) for _ in range(120)]
    docs = documents(spark, texts).coalesce(1)
    rows = pack(docs, WORDS).collect()
    want = {k: [library.encode(t, add_special_tokens=False).ids + [1]] for k, t in enumerate(texts)}
    padding, _ = check_packing(rows, want)
    assert padding < 2048


def test_steps_hold_equally_many_tokens_over_all_partitions(spark):
    rng = random.Random(6)
    texts = [" ".join(["alpha"] * rng.randrange(1500)) for _ in range(150)]
    rows = pack(documents(spark, texts).repartition(5), WORDS, step_tokens=8192).collect()
    windows = {(r.sequence_id, r.tier, r.step_id) for r in rows}
    assert len({s for s, _, _ in windows}) == len(windows)
    sizes = defaultdict(int)
    for _, tier, step in windows:
        sizes[step] += tier
    assert sorted(sizes) == list(range(len(sizes))) and len({s >> 40 for s, _, _ in windows}) == 5
    assert all(sizes[k] == 8192 for k in range(len(sizes) - 1)) and 0 < sizes[max(sizes)] <= 8192


def test_words_beyond_latin_are_remembered_in_bounds(monkeypatch):
    monkeypatch.setattr(word_tokens, "KNOWN", 2000)
    library, own = Tokenizer.from_file(WORDS), word_tokens.WordTokens(WORDS)
    for k in range(60):
        text = f"слово{'а' * k}, grün {'Ж' * (k % 7)}! 42½ it's {k}"
        assert own.ids(text) == library.encode(text, add_special_tokens=False).ids
        assert own.held < 4000


def test_packing_in_small_pools(monkeypatch):
    monkeypatch.setattr(packing, "WAITING", 5)
    packer, rng, total = Packer(3, step_tokens=4096), random.Random(5), 0
    for k in range(300):
        n = rng.randrange(1, 5000)
        total += n
        packer.add(k, as_bytes(range(n)))
    packer.close()
    assert sum(r[2] for r in packer.rows) == total
    sizes, steps = defaultdict(int), defaultdict(set)
    for r in packer.rows:
        sizes[r[5]] += r[2]
        steps[r[8]].add((r[5], r[7]))
    assert sum(n & (n - 1) != 0 for n in sizes.values()) <= 1
    for members in steps.values():
        assert len({tier for _, tier in members}) == 1
        assert sum(tier for _, tier in members) <= 4096
    assert min(sizes) >= 3 << 40


def test_packing_odd_rows_and_empty_table(spark):
    library, want = Tokenizer.from_file(WORDS), defaultdict(list)
    docs = clashing(odd_documents(spark), "start", "tier")
    for r in docs.collect():
        want[r.doc_id].append(library.encode(r.text or "", add_special_tokens=False).ids + [1])
    rows = pack(docs, WORDS).collect()
    assert sum(r.length for r in rows) == sum(len(i) for v in want.values() for i in v)
    assert {r.doc_id for r in rows} == set(want)
    assert pack(spark.createDataFrame([], DOCUMENTS), WORDS).count() == 0
