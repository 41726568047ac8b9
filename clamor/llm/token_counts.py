"""Token counts of whole texts, huge ones in overlapping chunks.

A text of ordinary length is encoded in one call.  A longer one is cut into chunks that
overlap around each cut.  Every chunk is a row, is dealt to a task of its own and is
encoded by the library with offsets.  Two neighbours are spliced at a place in their
overlap where both begin a new piece of the tokenizer's pattern.  Such a place is stable:
the first chunk begins with the text, so its pieces are those of the text; the pattern,
the search for special tokens and the merges read onwards from the begin of a piece, so
from a common begin on both chunks give the same pieces; and begins within MARGIN of a
chunk's right end, or at a character that composes with the one before it, are left out.
So the tokens of a text are, for each chunk, those between its two splices.

Where an overlap has no common begin (one word of thousands of letters, say) it is
widened fourfold and its document encoded once more; past a quarter of a chunk the cut is
given up and both chunks are one.  Rounds end when every overlap has a splice.

Null and empty texts have no tokens.  Null and repeated ids and repeated rows are rows
like any others.  An empty table gives an empty result.  Other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clamor.llm.common import materialise, remove, text_or_empty
from clamor.llm.word_tokens import word_tokens

CHUNK = 1 << 16  # characters between cuts; longer texts are cut
REACH = 1 << 10  # characters of an overlap on either side of its cut, at first
WIDEN = 4
# Characters at a right end that may still change a begin: the longest special token and
# the longest suffix of the pattern are shorter.
MARGIN = 64
SEND = 64  # chunks of a record batch

_CUTS = "array<struct<at: long, reach: long>>"
_CHUNK = pa.schema([
    ("row", pa.int64()), ("part", pa.int64()), ("low", pa.int64()), ("left", pa.int64()),
    ("left_reach", pa.int64()), ("right", pa.int64()), ("right_reach", pa.int64()),
    ("text", pa.string()),
])
_ENCODED = pa.schema([
    ("row", pa.int64()), ("part", pa.int64()), ("left", pa.int64()), ("right", pa.int64()),
    ("right_reach", pa.int64()), ("n_tokens", pa.int64()),
    ("left_places", pa.list_(pa.int64())), ("left_counts", pa.list_(pa.int64())),
    ("right_places", pa.list_(pa.int64())), ("right_counts", pa.list_(pa.int64())),
])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)


def joins_back(character: str) -> bool:
    """Whether a character may compose with the one before it."""
    return unicodedata.category(character)[0] == "M" or "ᄀ" <= character <= "ᇿ"


def begins_of(encoding, text: str, whole_right: bool) -> list[tuple[int, int]]:
    """(place, tokens before it) of each stable begin of a piece in a chunk."""
    found, offsets, pieces = [], encoding.offsets, encoding.word_ids
    last = len(text) if whole_right else len(text) - MARGIN
    for k in range(1, len(offsets)):
        place = offsets[k][0]
        if place > last:
            break
        if pieces[k] != pieces[k - 1] and offsets[k - 1][1] <= place and not joins_back(text[place]):
            found.append((place, k))
    return found


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk of each text, with its overlaps."""
    rows = []
    for batch in batches:
        for r in batch.to_pylist():
            text, cuts = r["text"], [(c["at"], c["reach"]) for c in r["cuts"]]
            edges = [(0, 0), *cuts, (len(text), 0)]
            for part, ((a, before), (b, after)) in enumerate(zip(edges, edges[1:], strict=False)):
                low = a - before
                held = text[low : b + after]
                rows.append((r["row"], part, low, a, before, b, after, held))
                if len(rows) == SEND:
                    yield _batch(rows, _CHUNK)
                    rows = []
    if rows:
        yield _batch(rows, _CHUNK)


def _encoder(path: str):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokens(path).tokenizer
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text, low = r["text"], r["low"]
                found = tokenizer.encode(text, add_special_tokens=False)
                begins = [
                    (low + place, k) for place, k in begins_of(found, text, not r["right_reach"])
                ]
                sides = []
                for at, reach in ((r["left"], r["left_reach"]), (r["right"], r["right_reach"])):
                    near = [(p, k) for p, k in begins if at - reach <= p < at + reach]
                    sides += [[p for p, _ in near], [k for _, k in near]]
                rows.append((
                    r["row"], r["part"], r["left"], r["right"], r["right_reach"], len(found.ids),
                    *sides,
                ))
            yield _batch(rows, _ENCODED)

    return encoded


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.record_batch(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def spliced(encoded: DataFrame) -> DataFrame:
    """(row, at, reach, n_tokens) of each chunk: its cut on the right, and the tokens up to
    the splice there less those before it in the next chunk; null where there is none.

    The last chunk of a text has no cut (reach 0) and counts its tokens.  All values of a
    text add up to its tokens.
    """
    after = encoded.select(
        "row", (F.col("part") - 1).alias("part"),
        F.col("left_places").alias("next_places"), F.col("left_counts").alias("next_counts"),
    )
    place = F.array_min(F.array_intersect("right_places", "next_places"))

    def before(side: str):
        at = F.array_position(f"{side}_places", F.col("place")).cast("int")
        return F.when(at > 0, F.get(f"{side}_counts", at - 1))

    return (
        encoded.join(after, ["row", "part"], "left")
        .withColumn("place", place)
        .select(
            "row", F.col("right").alias("at"), F.col("right_reach").alias("reach"),
            F.when(F.col("right_reach") == 0, F.col("n_tokens"))
            .otherwise(before("right") - before("next")).alias("n_tokens"),
        )
    )


def long_counts(texts: DataFrame, path: str, chunk: int, reach: int) -> DataFrame:
    """(row, n_tokens) of a written table (row, text) of long texts."""
    spark = texts.sparkSession
    first = F.transform(
        F.sequence(F.lit(chunk), F.length("text"), F.lit(chunk)),
        lambda at: F.struct(at.cast("long").alias("at"), F.lit(reach).cast("long").alias("reach")),
    )
    # A cut needs its whole overlap inside the text.
    first = F.filter(first, lambda c: c["at"] + reach < F.length("text"))
    todo, counts = texts.select("row", "text", first.alias("cuts")), []
    while True:
        chunks = todo.mapInArrow(_slices, _ddl(_CHUNK))
        # Chunks of one document leave one task: deal them out before they are encoded.
        dealt = chunks.repartition("row", "part").mapInArrow(_encoder(path), _ddl(_ENCODED))
        encoded = materialise(dealt)
        joined = materialise(spliced(encoded))
        for path_of in {f.rsplit("/", 1)[0] for f in encoded.inputFiles()}:
            remove(spark, path_of)
        by_row = joined.groupBy("row").agg(
            F.bool_and(F.col("n_tokens").isNotNull()).alias("_done"),
            F.sum("n_tokens").alias("n_tokens"),
            F.array_sort(
                F.collect_list(
                    F.when(
                        F.col("reach") > 0,
                        F.struct("at", "reach", F.col("n_tokens").isNull().alias("failed")),
                    )
                )
            ).alias("_cuts"),
        )
        counts.append(by_row.where("_done").select("row", "n_tokens"))
        open_rows = by_row.where("NOT _done")
        if open_rows.isEmpty():
            return _all(counts)
        wide = F.transform(
            F.col("_cuts"),
            lambda c: F.struct(
                c["at"].alias("at"),
                F.when(c["failed"], c["reach"] * WIDEN).otherwise(c["reach"]).alias("reach"),
            ),
        )
        kept = F.filter(wide, lambda c: c["reach"] <= max(chunk // 4, reach))
        # Only ids and cuts meet the texts: those are read, not moved, where few are left.
        todo = texts.join(open_rows.select("row", kept.cast(_CUTS).alias("cuts")), "row")


def _all(frames: list[DataFrame]) -> DataFrame:
    found = frames[0]
    for frame in frames[1:]:
        found = found.unionByName(frame)
    return found


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = 2048,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    reach: int = REACH,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row, as the library for the file counts.

    ``path`` names a word-level tokenizer file on every executor.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        for batch in batches:
            sizes = [len(tokens.ids(t)) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(sizes, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    size = F.octet_length("text").cast("long").alias("n_bytes")
    short = (
        rows.where(F.length("text") <= chunk)
        .select("doc_id", size, "text")
        .mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long")
    )
    held = materialise(
        rows.where(F.length("text") > chunk).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", size, "text"
        )
    )
    counts = long_counts(held.select("row", "text"), path, chunk, reach)
    long = held.select("row", "doc_id", "n_bytes").join(counts, "row").drop("row")
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)
