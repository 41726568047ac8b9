"""Byte-level BPE: encoding in length-bucketed padded matrices, and decoding.

A text is split by the tokenizer's pattern and every distinct match of a batch is
encoded once.  Matches of like length share a matrix with a row each, padded at the
end.  In a round every row merges its leftmost pair of minimum rank; ranks come from
an open-addressing hash table of token pairs, rows are closed up after each merge and
finished rows leave the matrix.  Matches longer than the widest bucket are merged one
by one in the same order from a heap, so that a text without any break costs
n log n steps.

The result is that of the public library for the same ranks and pattern.  A null
text counts as empty and has no ids.  Rows that repeat are encoded one by one.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clamor.llm.common import fresh, text_or_empty

NO_RANK = np.int32(2**31 - 1)
BUCKETS = (4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 256)  # bytes
CELLS = 1 << 19  # of one matrix at most
BLOCK = 1 << 22  # characters split at a time, or one text
KNOWN = 500_000  # matches remembered by a worker; then it starts anew


class PairTable:
    """Ranks by token pair: a hash table with linear probing, read by whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(len(rank) * 4 + 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NO_RANK, np.int32)
        keys = (left.astype(np.int64) << 32) | right
        slots, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[slots[todo]] < 0
            # Of several pairs that want one slot, the last one written has it.
            self.keys[slots[todo[free]]] = keys[todo[free]]
            put = self.keys[slots[todo]] == keys[todo]
            self.ranks[slots[todo[put]]] = rank[todo[put]]
            todo = todo[~put]
            slots[todo] = (slots[todo] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NO_RANK where there is none or a token is padding."""
        keys = ((left.astype(np.int64) << 32) | right).ravel()
        slots = self._slot(keys)
        met = self.keys[slots]
        found = np.where(met == keys, self.ranks[slots], NO_RANK)
        todo = np.flatnonzero((met != keys) & (met >= 0))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & (len(self.keys) - 1)
            met = self.keys[slots[todo]]
            hit = met == keys[todo]
            found[todo[hit]] = self.ranks[slots[todo[hit]]]
            todo = todo[(met >= 0) & ~hit]
        found[((left < 0) | (right < 0)).ravel()] = NO_RANK
        return found.reshape(left.shape)


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        pairs = [
            (self.ranks[token[:k]], self.ranks[token[k:]], rank)
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks
        ]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.known: dict[str, bytes] = {}

    def encode_matrix(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and all ids in turn.  Pieces have 2 to width bytes."""
        sizes = np.array([len(p) for p in pieces])
        result = np.full((len(pieces), width), -1, np.int32)
        result[np.arange(width) < sizes[:, None]] = self.single[
            np.frombuffer(b"".join(pieces), np.uint8)
        ]
        rows, ids = np.arange(len(pieces)), result.copy()
        ranks = self.pairs.find(ids[:, :-1], ids[:, 1:])
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            live = best != NO_RANK
            if not live.all():
                # Finished rows leave the matrix.
                result[rows[~live], : ids.shape[1]] = ids[~live]
                result[rows[~live], ids.shape[1] :] = -1
                if not live.any():
                    break
                rows, ids, ranks, at, best = (x[live] for x in (rows, ids, ranks, at, best))
            line, last = np.arange(len(rows)), ids.shape[1] - 1
            # Close the gap behind the merged pair; the last column falls free.
            behind = np.arange(last) > at[:, None]
            ids = np.where(behind, ids[:, 1:], ids[:, :-1])
            ids[line, at] = best
            if last == 1:
                result[rows, :1], result[rows, 1:] = ids, -1
                break
            ranks = np.where(behind[:, :-1], ranks[:, 1:], ranks[:, :-1])
            inner = np.flatnonzero(at < last - 1)
            ranks[inner, at[inner]] = self.pairs.find(best[inner], ids[inner, at[inner] + 1])
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self.pairs.find(ids[inner, at[inner] - 1], best[inner])
        held = result >= 0
        return held.sum(axis=1), result[held].astype("<u4")

    def encode_long(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece: the same merges in the same order, from a heap."""
        ids = [int(self.single[b]) for b in piece]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        parts = [bytes([b]) for b in piece]
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(ids):
                rank = self.ranks.get(parts[i] + parts[after[i]])
                if rank is not None:
                    heap.append((rank, i, len(parts[i]), len(parts[after[i]])))

        for i in range(len(ids)):
            offer(i)
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if len(parts[i]) != left or j >= len(ids) or len(parts[j]) != right:
                continue  # one of the two has been merged since
            ids[i], parts[i], parts[j] = rank, parts[i] + parts[j], b""
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for k in (before[i], i):
                size = len(heap)
                offer(k)
                if len(heap) > size:
                    heapq._siftdown(heap, 0, size)
        return np.array([x for x, p in zip(ids, parts, strict=True) if p], "<u4")

    def learn(self, words: set[str]) -> None:
        """Encode all matches that are not known yet."""
        buckets: dict[int, list[str]] = {}
        for word in words:
            piece = word.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(piece)
            if rank is not None:
                self.known[word] = np.array([rank], "<u4").tobytes()
            elif len(piece) > BUCKETS[-1]:
                self.known[word] = self.encode_long(piece).tobytes()
            else:
                width = next(b for b in BUCKETS if len(piece) <= b)
                buckets.setdefault(width, []).append((word, piece))
        for width, members in buckets.items():
            step = max(1, CELLS // width)
            for k in range(0, len(members), step):
                part = members[k : k + step]
                sizes, ids = self.encode_matrix([p for _, p in part], width)
                ends = (4 * np.cumsum(sizes)).tolist()
                begin, ids = 0, ids.tobytes()
                for (word, _), end in zip(part, ends, strict=True):
                    self.known[word] = ids[begin:end]
                    begin = end

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for part in blocks(texts):
            split = [self.pattern.findall(t) for t in part]
            known = self.known
            new = set().union(*split).difference(known)
            if len(known) + len(new) > KNOWN:
                known.clear()
                new = set().union(*split)
            self.learn(new)
            for words in split:
                yield b"".join([known[w] for w in words])

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def blocks(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about BLOCK characters."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > BLOCK:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_texts(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """docs with a binary column of ids (little-endian unsigned 32-bit integers).

    path names the rank file on every executor; a clashing name gets an underscore.
    """

    @F.pandas_udf("binary")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for texts in batches:
            yield pd.Series(list(own.encode(texts.tolist())), dtype=object)

    return docs.withColumn(fresh(docs, ids)[0], encoded(text_or_empty(text)))


def decode_ids(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """docs with the bytes that the ids stand for; null ids give no bytes."""

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, "")
        for rows in batches:
            yield pd.Series([own.decode(x) for x in rows], dtype=object)

    return docs.withColumn(fresh(docs, text)[0], decoded(F.coalesce(F.col(ids), F.lit(b""))))


def token_digests(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, then decoded from the ids.

    Only digests leave the Python workers, one record batch at a time.
    """
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for ids in own.encode(batch.column("text").to_pylist()):
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_bytes, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")
    ).mapInArrow(
        digests, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
