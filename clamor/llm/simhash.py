"""SimHash near-dedup with a generalised pigeonhole search.

A fingerprint holds the majority bits of the 64-bit hashes of all word shingles of a
text.  Texts are linked where their fingerprints differ by no more than a few bits,
and a group is a connected component of links.

The search works on distinct fingerprints.  Bits that go together (by their
correlation over all fingerprints) share a partition.  If the thresholds of m
partitions add up to the distance less m, plus 1, then a pair within the distance is
within the threshold of some partition, -1 meaning that the partition is not used.
The thresholds are those of least cost, found by dynamic programming over candidate
counts, which are estimated from the sizes of all buckets.  A fingerprint probes the
buckets of all part values within the threshold, and candidates are verified by their
full distance.

A bucket of more than ``CROWD`` fingerprints is not paired up.  Its members, and those
whose probes meet it, are linked through shared neighbours instead: two values are
within 2k bits just where some value is within k bits of both (and within 2k + 1, with
k and k + 1), so each emits its neighbours, and those that meet in one are linked in a
star.  That is exact too and grows with the members, not with their square.

Null and empty texts have fingerprint 0 and are linked like any other.  Rows that
repeat a doc_id are fingerprinted one by one.  An empty table has no groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clamor.llm.common import fresh, materialise, text_or_empty
from clamor.llm.components import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
PARTS = (2, 3, 4)  # numbers of partitions that are compared
CROWD = 64


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """As a signed 64-bit integer."""
    # bytes.lower() and bytes.split() know ASCII letters and white space only.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[:-shingle]]).tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)]
    values = np.array(hashes, np.uint64)
    votes = np.zeros(64, np.int64)
    for k in range(0, len(values), 1 << 16):
        octets = values[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(values), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, text_key (a hash of the text) and fp of every row."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(values, pa.int64())],
                names=["doc_id", "text_key", "fp"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text_or_empty(text)).alias("text_key"),
        text_or_empty(text).alias("text"),
    ).mapInArrow(found, f"doc_id {kind}, text_key long, fp long")


def bit_counts(nodes: DataFrame) -> np.ndarray:
    """How many fingerprints have bits i and j, as a 64 x 64 matrix over all of them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64), np.int64)
        for batch in batches:
            octets = batch.column("fp").to_numpy().view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(octets, axis=1, bitorder="little").astype(np.float32)
            for k in range(0, len(bits), 1 << 16):
                part = bits[k : k + (1 << 16)]
                total += (part.T @ part).astype(np.int64)
        yield pa.record_batch(
            [pa.array(np.arange(4096)), pa.array(total.ravel())], names=["place", "n"]
        )

    rows = (
        nodes.select("fp").mapInArrow(counted, "place long, n long")
        .groupBy("place").agg(F.sum("n").alias("n")).collect()  # 4,096 rows
    )
    total = np.zeros(4096, np.int64)
    for row in rows:
        total[row["place"]] = row["n"]
    return total.reshape(64, 64)


def bit_groups(counts: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """The 64 bits in groups of like size, each grown by the bit that goes with it most."""
    share = np.diag(counts) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    together = np.abs((counts / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(together, 0)
    left, groups = set(range(64)), []
    for k in range(parts):
        size = -(-len(left) // (parts - k))
        rest = sorted(left)
        group = [max(rest, key=lambda b: (together[b, rest].sum(), -b))]
        left.discard(group[0])
        while len(group) < size:
            bit = max(sorted(left), key=lambda b: (together[b, group].sum(), -b))
            group.append(bit)
            left.discard(bit)
        groups.append(sorted(group))
    return groups


def mask_of(bits) -> int:
    """As a signed 64-bit integer."""
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def flips(bits, most: int) -> list[int]:
    """Masks of up to so many of the bits, none first."""
    return [mask_of(c) for k in range(most + 1) for c in combinations(bits, k)]


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of the partitions that add up to the total at the least cost.

    costs[i][t] is the cost of threshold t in partition i.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for reached, (cost, chosen) in best.items():
            for threshold, extra in part.items():
                option = (cost + extra, [*chosen, threshold])
                at = reached + threshold
                if at not in after or option < after[at]:
                    after[at] = option
        best = after
    return best[total]


def plan(nodes: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds, only those that are probed."""
    n = nodes.count()
    counts = bit_counts(nodes)
    share = np.diag(counts) / max(n, 1)
    differ = 2 * share * (1 - share)
    odds = differ / np.maximum(1 - differ, 1e-9)
    options, sums = [], []
    for parts in PARTS:
        groups = bit_groups(counts, n, parts)
        options.append(groups)
        sums += [(parts, k, mask_of(g)) for k, g in enumerate(groups)]
    # Pairs in equal buckets over all fingerprints, a crowd's at the price of its neighbours.
    around = float(sum(1 for _ in flips(range(64), -(-distance // 2))))
    c = F.col("c").cast("double")
    pairs = {
        (r["parts"], r["k"]): r["pairs"]
        for r in nodes.select(
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(p).alias("parts"),
                            F.lit(k).alias("k"),
                            F.col("fp").bitwiseAND(m).alias("value"),
                        )
                        for p, k, m in sums
                    ]
                )
            ).alias("s")
        )
        .groupBy("s.parts", "s.k", "s.value").agg(F.count("*").alias("c"))
        .groupBy("parts", "k").agg(F.sum(F.least(c * (c - 1) / 2, c * around)).alias("pairs"))
        .collect()
    }
    found = []
    for parts, groups in zip(PARTS, options, strict=True):
        costs = []
        for k, group in enumerate(groups):
            # Equal parts grow to near ones by the odds that single bits differ.
            grown, near = [1.0] + [0.0] * distance, {-1: 0.0}
            for o in odds[group]:
                for d in range(distance, 0, -1):
                    grown[d] += grown[d - 1] * o
            for t in range(distance + 1):
                probes = n * len(flips(group, t))
                near[t] = probes + pairs.get((parts, k), 0.0) * sum(grown[: t + 1])
            costs.append(near)
        cost, chosen = allocate(costs, distance - parts + 1)
        found.append((cost, parts, [(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0]))
    return min(found, key=lambda f: f[:2])[2]


def bits_apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def near_links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links u, v between distinct fingerprints fp that connect all that lie within the
    distance of each other."""
    chosen = plan(nodes, distance)

    def values(probe: bool) -> DataFrame:
        """Bucket of each fingerprint in each part; or all buckets that it probes."""
        made = []
        for k, (group, threshold) in enumerate(chosen):
            for flip in flips(group, threshold if probe else 0):
                value = F.col("fp").bitwiseAND(mask_of(group)).bitwiseXOR(flip)
                made.append(F.struct(F.lit(k).alias("part"), value.alias("value")))
        each = nodes.select("fp", F.explode(F.array(*made)).alias("at"))
        return each.select("fp", "at.part", "at.value")

    held, probes = values(probe=False), values(probe=True)
    crowds = materialise(
        held.groupBy("part", "value").agg(F.count("*").alias("n"))
        .filter(F.col("n") > CROWD).select("part", "value")
    )
    place = ["part", "value"]
    u, v = F.col("u"), F.col("v")
    pairs = (
        probes.join(crowds, place, "left_anti").withColumnRenamed("fp", "u")
        .join(held.join(crowds, place, "left_anti").withColumnRenamed("fp", "v"), place)
        .filter((u > v) & (bits_apart(u, v) <= distance))
        .select("u", "v")
    )
    crowded = probes.join(crowds, place, "left_semi").select("fp").distinct()
    return pairs.unionAll(shared_neighbours(crowded, distance))


def shared_neighbours(nodes: DataFrame, distance: int) -> DataFrame:
    """Links between all fingerprints within the distance, through values near both.

    An even distance 2k: all values within k bits.  An odd one: those within k + 1 bits,
    marked by how far they lie; members of a value are linked through one that is
    closest.  A value has no more members than there are flips.
    """
    reach = -(-distance // 2)
    near = [
        F.struct(
            F.col("fp").bitwiseXOR(m).alias("value"),
            F.lit((m & (2**64 - 1)).bit_count()).alias("far"),
        )
        for m in flips(range(64), reach)
    ]
    met = (
        nodes.select("fp", F.explode(F.array(*near)).alias("at"))
        .select("fp", "at.value", "at.far")
        .groupBy("value")
        .agg(F.collect_list(F.struct("far", "fp")).alias("members"))
        .filter(F.size("members") > 1)
        .select(F.array_sort("members").alias("members"))
    )
    first = F.get("members", F.lit(0))
    return met.select(F.explode("members").alias("m"), first.alias("first")).filter(
        (F.col("m.fp") != F.col("first.fp"))
        & (F.col("m.far") + F.col("first.far") <= distance)
    ).select(F.greatest("m.fp", "first.fp").alias("u"), F.least("m.fp", "first.fp").alias("v"))


def near_groups(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, text_key, fp and component_id, the smallest doc_id of the group, of all rows.

    A group in which no row has a doc_id has none as component_id.
    """
    rows = materialise(fingerprints(docs, shingle, doc_id, text))
    nodes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    links = materialise(near_links(nodes, distance).distinct())
    linked = materialise(components(links))
    rooted = nodes.join(linked, nodes.fp == linked.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(found, "fp").select("doc_id", "text_key", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_copies(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of docs that stay: in each group the one with the smallest doc_id.

    Rows that share that id stay together, and so does a group without any id.
    """
    gone_id, gone_key = fresh(docs, "gone_id", "gone_key")
    gone = near_groups(docs, shingle, distance, doc_id, text).filter(
        ~F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
    return docs.join(
        materialise(gone.select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key))),
        F.col(f"`{doc_id}`").eqNullSafe(F.col(gone_id))
        & (F.xxhash64(text_or_empty(text)) == F.col(gone_key)),
        "left_anti",
    )
