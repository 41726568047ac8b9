"""Hierarchical packing of token ids into sequences of several context sizes.

A document is cut into windows of the longest context size; what is left of it is
routed to the shortest tier that holds it.  Tiers are packed from the longest down:
a window takes one rest of its own tier and fills its gap from the shorter tiers,
best fit first, and closes an open gap by cutting the next rest.  Windows of all
tiers are full therefore, but for the last one of a partition, and a full window of
any tier needs no padding.

Every partition is packed by itself and moves nowhere; the rests that wait in memory
are bounded by a number of documents.  Sequence numbers hold the partition and a
count.  The pieces are written once, and windows of all partitions are then dealt to
training steps, the longest tier first: as window sizes are powers of two, every step
but the last holds exactly the same number of tokens, and only counts by partition and
tier are moved for that.

A null or empty text has the end id alone.  Rows that repeat a doc_id are packed one
by one.  An empty table has no pieces.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clamor.llm.common import materialise, text_or_empty
from clamor.llm.word_tokens import word_tokens

TIERS = (2048, 1024, 512, 256)  # powers of two, the longest first
WAITING = 4096  # rests held before they are packed
STEP_TOKENS = 1 << 19  # of one training step

COLUMNS = [
    ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ("tier", pa.int64()), ("step_id", pa.int64()), ("place", pa.int64()),
]


class Rest:
    """Ids of a document that are not placed yet."""

    __slots__ = ("doc_id", "ids", "start", "total")

    def __init__(self, doc_id, ids: bytes, start: int, total: int):
        self.doc_id, self.ids, self.start, self.total = doc_id, ids, start, total

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> Rest:
        """Take the first n ids off."""
        head = Rest(self.doc_id, self.ids[: 4 * n], self.start, self.total)
        self.ids, self.start = self.ids[4 * n :], self.start + n
        return head


class Pool:
    """Rests by length; the longest up to a given length is found by bisection."""

    def __init__(self) -> None:
        self.lengths: list[int] = []
        self.by_length: dict[int, list[Rest]] = {}
        self.count = self.tokens = 0

    def add(self, rest: Rest) -> None:
        n = len(rest)
        if n not in self.by_length:
            bisect.insort(self.lengths, n)
            self.by_length[n] = []
        self.by_length[n].append(rest)
        self.count, self.tokens = self.count + 1, self.tokens + n

    def take(self, at_most: int) -> Rest | None:
        k = bisect.bisect_right(self.lengths, at_most) - 1
        if k < 0:
            return None
        n = self.lengths[k]
        rest = self.by_length[n].pop()
        if not self.by_length[n]:
            del self.by_length[n], self.lengths[k]
        self.count, self.tokens = self.count - 1, self.tokens - n
        return rest


class Packer:
    """Sequences of one partition."""

    def __init__(self, partition: int, tiers=TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = tiers, step_tokens
        self.base, self.made = partition << 40, 0
        self.by_tier = dict.fromkeys(tiers, 0)
        self.pool = Pool()
        self.rows: list[tuple] = []

    def emit(self, parts: list[Rest], tier: int) -> None:
        sequence, offset, place = self.base + self.made, 0, self.by_tier[tier]
        step = place // max(1, self.step_tokens // tier)
        step_id = self.base + (step << 4) + self.tiers.index(tier)
        self.made += 1
        self.by_tier[tier] += 1
        for p in parts:
            crc = zlib.crc32(p.ids)
            self.rows.append(
                (p.doc_id, p.start, len(p), crc, p.total, sequence, offset, tier, step_id, place)
            )
            offset += len(p)

    def add(self, doc_id, ids: bytes) -> None:
        rest = Rest(doc_id, ids, 0, len(ids) // 4)
        while len(rest) >= self.tiers[0]:
            self.emit([rest.cut(self.tiers[0])], self.tiers[0])
        if len(rest):
            self.pool.add(rest)
        if self.pool.count >= WAITING:
            self.pack(self.pool.tokens // 2)

    def tier_of(self, n: int) -> int:
        return min(t for t in self.tiers if t >= n)

    def pack(self, keep: int) -> None:
        """Fill windows until no more than so many tokens wait."""
        while self.pool.tokens > max(keep, self.tiers[0]):
            first = self.pool.take(self.tiers[0])
            tier = self.tier_of(len(first))
            parts, gap = [first], tier - len(first)
            while gap:
                fits = self.pool.take(gap)
                if fits is None:  # only longer ones wait: cut the next of them
                    longer = self.pool.take(self.tiers[0])
                    fits = longer.cut(gap)
                    self.pool.add(longer)
                parts.append(fits)
                gap -= len(fits)
            self.emit(parts, tier)

    def close(self) -> None:
        """Place the last rests, one after another, in full windows as far as they go."""
        self.pack(0)
        parts = []
        while self.pool.count:
            parts.append(self.pool.take(self.tiers[0]))
        while parts:
            left = sum(map(len, parts))
            size = next((t for t in self.tiers if t <= left), left)
            window = []
            while size:
                if len(parts[0]) <= size:
                    window.append(parts.pop(0))
                else:
                    window.append(parts[0].cut(size))
                size -= len(window[-1])
            held = sum(map(len, window))
            self.emit(window, held if held in self.tiers else self.tiers[0])

    def drain(self, kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[] for _ in range(len(COLUMNS) + 1)]
        self.rows = []
        kinds = [("doc_id", kind), *COLUMNS]
        return pa.record_batch(
            [pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)],
            names=[name for name, _ in kinds],
        )


def pack(
    docs: DataFrame,
    path: str,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, tier (the window's size) and step_id (steps of ``step_tokens`` tokens each,
    but for the last).

    path names the tokenizer file on every executor.  tiers are powers of two, in
    descending order, and divide step_tokens.
    """
    end = end_id.to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        packer, kind = Packer(TaskContext.get().partitionId(), tiers, step_tokens), None
        for batch in batches:
            kind = batch.column("doc_id").type
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for key, ids in zip(keys, tokens.encode_all(texts), strict=True):
                packer.add(key, ids + end)
            yield packer.drain(kind)
        if kind is not None:
            packer.close()
            yield packer.drain(kind)

    kind = docs.schema[doc_id].dataType.simpleString()
    pieces = docs.select(
        F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")
    ).mapInArrow(packed, f"doc_id {kind}, " + ", ".join(f"{name} long" for name, _ in COLUMNS))
    return dealt_to_steps(materialise(pieces), step_tokens)


def dealt_to_steps(pieces: DataFrame, step_tokens: int) -> DataFrame:
    """Pieces with the step of their window, in place of the step within its partition.

    Windows are counted by partition and tier, and each such group begins where the ones
    before it end, longer tiers first.
    """
    group = ["tier", "_part"]
    pieces = pieces.withColumn("_part", F.shiftright("sequence_id", 40))
    counts = (
        pieces.where(F.col("offset") == 0)
        .groupBy(*group)
        .agg((F.count("*") * F.col("tier")).alias("_size"))
    )
    earlier = (Window.unboundedPreceding, -1)
    in_tier = Window.partitionBy("tier").orderBy("_part").rowsBetween(*earlier)
    tiers = counts.groupBy("tier").agg(F.sum("_size").alias("_all"))
    longer = Window.orderBy(F.desc("tier")).rowsBetween(*earlier)  # a row for each tier
    before = tiers.select("tier", F.coalesce(F.sum("_all").over(longer), F.lit(0)).alias("_base"))
    starts = counts.withColumn(
        "_start", F.coalesce(F.sum("_size").over(in_tier), F.lit(0))
    ).join(F.broadcast(before), "tier")
    at = F.col("_base") + F.col("_start") + F.col("place") * F.col("tier")
    return (
        pieces.drop("step_id")
        .join(starts.drop("_size"), group)
        .withColumn("step_id", F.floor(at / step_tokens))
        .drop("_part", "_base", "_start", "place")
        .select("doc_id", *[name for name, _ in COLUMNS if name != "place"])
    )
