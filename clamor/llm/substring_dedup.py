"""Substring dedup over content-defined chunks.

A gear hash rolls over the bytes of a text, and a chunk ends where the hash is the least
of ``WINDOW`` bytes in a row: at the end of a word, or within a word where the window
holds no end.  Thus no chunk is long, except in blanks, and repeated lines are cut in
each turn.  Where chunks end depends on the bytes near by only, so a passage is cut
alike wherever it stands and insertions shift nothing.  Two chunks in a row have one
digest; their repeats are searched over all texts, and the text with the
smallest doc_id that holds a digest owns it; of texts that share a doc_id the one with
the least hash, and one with a doc_id before those that have none.  In every other text
the chunks of owned digests are marked, and runs of marked chunks of at least ``MIN_WORDS`` words (or
``MIN_BYTES`` bytes) are taken out.  For that, a stretch without blanks counts one word
more for each ``LETTERS`` bytes after the first ``LONG_WORD``.

A passage loses its chunks that lie whole in it, thus a few words at its ends may
stay.  Digests have 64 bits: a chance meeting marks two chunks, which are too short a
run to be taken out as a rule.

Rows are told apart by doc_id and a hash of the text, so a third of all rows without
a doc_id is no group.  Repeats within one text stay, and rows that are equal in both
share one fate: exact copies under one doc_id are the matter of exact dedup.  Null and
empty texts have no chunks.  Texts of any length are cut as a whole, in linear time.  An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clamor.llm.common import fresh, materialise, text_or_empty

SEED = 20_771
MIN_CHUNK = 16  # bytes
MAX_CHUNK = 4096  # bytes without a cut (blanks only) before any byte may end a chunk
WINDOW = 48  # bytes in a row of which one ends a chunk, unless they are blank
NOWHERE = 0xFFFFFFFF  # the rank of a byte that ends none
TOGETHER = 2  # chunks with one digest
MIN_WORDS = 20
MIN_BYTES = 400
LONG_WORD = 32  # bytes after which a stretch without blanks counts a word for each
LETTERS = 8  # bytes

GEAR = np.random.default_rng(SEED).integers(0, 1 << 16, 256, dtype=np.uint16)
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def gear_hashes(octets: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash that ends at each byte: h = 2 * h + GEAR[byte], of which
    the last 16 bytes remain.  Runs of 2, 4, 8 and 16 bytes are put together in turn."""
    h = GEAR[octets]
    for k in (1, 2, 4, 8):
        longer = h.copy()
        longer[k:] += h[:-k] << np.uint16(k)
        h = longer
    return h


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or largest value (pick) of each width values in a row."""
    have = 1
    while have < width:
        k = min(have, width - have)
        values = pick(values[k:], values[:-k])
        have += k
    return values


def places_of_cuts(octets: np.ndarray) -> np.ndarray:
    """Where some WINDOW bytes in a row have their least hash, ends of words before
    places within words.  Equal hashes are all least, so a period is cut in each turn."""
    if len(octets) < WINDOW:
        return np.empty(0, np.int64)
    h, white = gear_hashes(octets), WHITE[octets]
    rank = np.full(len(octets), NOWHERE, np.uint32)
    before = h[:-1].astype(np.uint32)
    in_word = ~white[1:] & ~white[:-1] & ((octets[1:] & 0xC0) != 0x80)
    np.copyto(rank[1:], before + np.uint32(1 << 16), where=in_word)
    np.copyto(rank[1:], before, where=white[1:] & ~white[:-1])
    least = np.pad(sliding(rank, WINDOW, np.minimum), WINDOW - 1)
    places = np.flatnonzero((rank < NOWHERE) & (rank == sliding(least, WINDOW, np.maximum)))
    # Of places too near to each other the lesser ones stay, whatever stands before them.
    rank, keep = rank[places], np.ones(len(places), bool)
    for k in range(1, MIN_CHUNK):
        near = places[k:] - places[:-k] < MIN_CHUNK
        if not near.any():
            break
        keep[k:] &= ~(near & (rank[:-k] < rank[k:]))
        keep[:-k] &= ~(near & (rank[k:] < rank[:-k]))
    return places[keep]


def cuts(octets: np.ndarray) -> list[int]:
    """Ends of the chunks, the last one being the end of the text."""
    n = len(octets)
    if not n:
        return []
    found, last = [], 0
    for place in [*places_of_cuts(octets).tolist(), n]:
        if place - last > MAX_CHUNK:
            found += _forced(octets, gear_hashes(octets), last, place)
            last = found[-1] if found else last
        if place - last >= MIN_CHUNK:
            found.append(place)
            last = place
    if last < n:
        # A short rest belongs to the chunk before it.
        if found and n - last < MIN_CHUNK:
            found[-1] = n
        else:
            found.append(n)
    return found


def _forced(octets: np.ndarray, h: np.ndarray, begin: int, end: int) -> list[int]:
    """Cuts in a stretch without any: where the hash has 8 zero bits, else after
    MAX_CHUNK bytes; always before the first byte of a character."""
    lead = (octets[begin:end] & 0xC0) != 0x80
    places = np.flatnonzero(lead[1:] & (h[begin : end - 1] >> np.uint16(8) == 0)) + 1 + begin
    found, last = [], begin
    for place in [*places.tolist(), end]:
        while place - last > MAX_CHUNK:
            last += MAX_CHUNK
            while not lead[last - begin]:
                last -= 1
            found.append(last)
        if place < end and place - last >= MIN_CHUNK:
            found.append(place)
            last = place
    return found


def digests(octets: bytes, ends: list[int]) -> list[int]:
    """One signed 64-bit digest for each TOGETHER chunks in a row; of a text with fewer
    chunks one for all of them."""
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh3_64_intdigest
    last = max(1, len(ends) - TOGETHER + 1)
    half, whole = 1 << 63, 1 << 64
    found = []
    for k in range(min(last, len(ends))):
        value = digest(octets[starts[k] : ends[min(k + TOGETHER, len(ends)) - 1]].strip())
        found.append(value - whole if value >= half else value)
    return found


def text_key(text: str) -> Column:
    """With doc_id this tells rows apart, and is the same when a task runs again."""
    return F.xxhash64(F.col(f"`{text}`"))


def chunk_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key and the distinct digests of each text."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for value in batch.column("text"):
                octets = value.as_py().encode("utf-8", "surrogatepass")
                values.append(
                    np.unique(np.array(digests(octets, cuts(np.frombuffer(octets, np.uint8))), np.int64))
                )
            ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(ends), pa.array(np.concatenate([*values, np.empty(0, np.int64)]))
            )
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("key"), lists], names=["doc_id", "key", "digests"]
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        F.col(doc_id).alias("doc_id"), text_key(text).alias("key"), text_or_empty(text).alias("text")
    ).mapInArrow(found, f"doc_id {kind}, key long, digests array<long>")


def marked_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """marked_id, marked_key, digests, owners, nameless: for each text those of its digests
    that another owns, the doc_ids of their owners, and the digests of owners without one."""
    chunks = materialise(chunk_digests(docs, doc_id, text)).select(
        "doc_id", "key", F.explode("digests").alias("digest")
    )
    # Most digests are in one text only.  Two numbers tell them, which tasks combine by
    # hash; the owner is looked for among the chunks that are left.
    row = F.xxhash64("doc_id", "key")
    several = (
        chunks.groupBy("digest")
        .agg(F.min(row).alias("least"), F.max(row).alias("greatest"))
        .filter("least < greatest")
        .select("digest")
    )
    repeated = materialise(chunks.join(several, "digest", "left_semi"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "key")
    owners = repeated.groupBy("digest").agg(F.min(place).alias("owner"))
    marked = repeated.join(owners, "digest").filter(F.col("owner") < place)
    return (
        marked.groupBy("doc_id", "key")
        .agg(
            F.collect_set(
                F.when(F.col("owner.id").isNotNull(), F.struct("digest", F.col("owner.id").alias("owner")))
            ).alias("marks"),
            F.collect_set(F.when(F.col("owner.id").isNull(), F.col("digest"))).alias("nameless"),
        )
        .select(
            F.col("doc_id").alias("marked_id"),
            F.col("key").alias("marked_key"),
            F.col("marks.digest").alias("digests"),
            F.col("marks.owner").alias("owners"),
            "nameless",
        )
    )


def repeated_spans(text: str, owned: dict[int, int]) -> tuple[list[tuple[int, int, int]], set]:
    """Byte spans (start, end, words) to take out, and the owners of their digests."""
    octets = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(octets, np.uint8)
    ends = cuts(data)
    starts = [0, *ends[:-1]]
    by_chunk: list[set] = [set() for _ in ends]
    for k, value in enumerate(digests(octets, ends)):
        if value in owned:
            for chunk in by_chunk[k : k + TOGETHER]:
                chunk.add(owned[value])
    white = WHITE[data]
    first_bytes = ~white & np.append(True, white[:-1])
    word_starts = np.concatenate([[0], np.cumsum(first_bytes)])
    at = np.arange(len(data))
    inside = at - np.maximum.accumulate(np.where(first_bytes, at, 0))
    further = ~white & (inside >= LONG_WORD) & (inside % LETTERS == 0)
    further = np.concatenate([[0], np.cumsum(further)])
    spans, sources, k = [], set(), 0
    while k < len(ends):
        first = k
        while k < len(ends) and by_chunk[k]:
            k += 1
        if k > first:
            begin, end = starts[first], ends[k - 1]
            words = int(word_starts[end] - word_starts[begin])
            more = int(further[end] - further[begin])
            if words + more >= MIN_WORDS or end - begin >= MIN_BYTES:
                spans.append((begin, end, words))
                sources.update(*by_chunk[first:k])
        else:
            k += 1
    return spans, sources


def without(text: str, spans: list[tuple[int, int, int]]) -> str:
    octets, kept, last = text.encode("utf-8", "surrogatepass"), [], 0
    for begin, end, _ in spans:
        kept.append(octets[last:begin])
        last = end
    rest = b"".join([*kept, octets[last:]])
    if spans and spans[0][0] == 0:
        rest = rest.lstrip()
    return rest.decode("utf-8", "surrogatepass")


def with_repeats_removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one more column ``removed`` (a clashing name gets an underscore): null
    for a text that keeps all, else a struct of the text that is left, the spans taken
    out (bytes, as start-end), their words, and the owners of what went that have a
    doc_id."""
    names = fresh(docs, "marked_id", "marked_key", "digests", "owners", "nameless", "removed")
    marked_id, marked_key, marks, owners, nameless, removed = names
    kind = docs.schema[doc_id].dataType.simpleString()

    @F.pandas_udf(f"text string, spans string, words long, sources array<{kind}>")
    def cleaned(texts: pd.Series, digest: pd.Series, owner: pd.Series, unnamed: pd.Series) -> pd.DataFrame:
        rows = []
        for t, d, o, u in zip(texts, digest, owner, unnamed, strict=True):
            spans, sources = [], set()
            if t is not None:
                spans, sources = repeated_spans(t, dict.fromkeys(u) | dict(zip(d, o, strict=True)))
            if spans:
                named = (s for s in sources if s is not None)
                where = ",".join(f"{a}-{b}" for a, b, _ in spans)
                rows.append((without(t, spans), where, sum(w for *_, w in spans), sorted(named)))
            else:
                rows.append((None, None, None, None))
        return pd.DataFrame(rows, columns=["text", "spans", "words", "sources"])

    found = materialise(marked_digests(docs, doc_id, text)).toDF(*names[:5])
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(marked_id)) & (text_key(text) == F.col(marked_key))
    joined = docs.join(found, same, "left")
    marked_text = F.when(F.col(marks).isNotNull(), F.col(f"`{text}`"))
    whole = joined.withColumn(removed, cleaned(marked_text, F.col(marks), F.col(owners), F.col(nameless)))
    return whole.drop(*names[:5]).withColumn(
        removed, F.when(F.col(removed)["spans"].isNotNull(), F.col(removed))
    )


def drop_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars"
) -> DataFrame:
    """docs with repeated passages taken out of their texts.  The column n_chars, if
    there is one, is the length of the text where the text has changed."""
    removed = fresh(docs, "removed")[0]
    left = F.col(removed)["text"]
    changed = F.col(removed).isNotNull()
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(F.when(changed, left).otherwise(F.col(f"`{c}`")).alias(c))
        elif c == n_chars:
            kind = docs.schema[c].dataType
            columns.append(
                F.when(changed, F.length(left).cast(kind)).otherwise(F.col(f"`{c}`")).alias(c)
            )
        else:
            columns.append(F.col(f"`{c}`"))
    return with_repeats_removed(docs, doc_id, text).select(*columns)
