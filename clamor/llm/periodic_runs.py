"""Runs of words that repeat with a period, found in tiles of one scale each.

A run is a longest stretch of words in which words a period apart are equal, with the
smallest period that it has, of at least 24 words and three periods.  Periods are taken
by octave.  In octave b (periods b to 2b-1) every run holds b equal neighbours at some
multiple of b, an anchor: the b words there are found again one period on.

* Hashes of all windows of b words, made from those of the octave before, tell which
  anchors can lie in a run.  Equal windows have equal hashes, so none is missed, and a
  text without repeats costs n log n numbers and leaves nothing behind.
* Anchors are grouped to tiles that overlap by what an anchor can see, and each tile is
  a row of its own.  Tiles are dealt to tasks, those of one long document to many.
* A task solves its tiles by themselves: two Z-functions at an anchor give, for every
  period of the octave, how far the equality reaches forwards and backwards, exactly.
* The stretches that tiles report are shuffled by document and period and stitched.

A row that holds no anchor is finished in the first pass.  Only the words of the others
are moved, once, to meet their runs.  Rows have a number of their own, so null and
repeated ids and repeated rows are rows like any others.  Null and empty texts have no
words and no runs.  An empty table gives an empty result.  A text is read whole,
however long; its windows take a few numbers for each word in the memory of one task.
Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clamor.llm.common import materialise, text_or_empty

LEAST, TIMES = 24, 3  # words and periods that a run has at least
FIRST = 8  # words between anchors of the first octave, which has all shorter periods
TILE = 1024  # words that a tile has anchors in, or eight times their distance
FLUSH = 4 << 20  # bytes of tiles that wait to be sent

Rewrite = Callable[[object, int], np.ndarray | None]

_TILES = "octave long, first long, words binary, anchors binary"
_NONE = hashlib.sha256(b"").hexdigest()


def word_numbers(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int32)


def anchors_by_octave(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(octave, anchors whose window is found again within the octave's periods)."""
    n = len(numbers)
    if n < LEAST:
        return
    hashes = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(31)
    width = 1
    while width < FIRST:
        hashes, width = _doubled(hashes, width), 2 * width
    places = np.zeros(-(-len(hashes) // FIRST), bool)
    for period in range(1, FIRST):
        again = hashes[period::FIRST]
        places[: len(again)] |= hashes[::FIRST][: len(again)] == again
    if places.any():
        yield FIRST // 2, np.flatnonzero(places) * FIRST
    while width * TIMES <= n:
        # Row r holds the windows one to two widths behind anchor r.
        rows = (len(hashes) - width) // width
        at = hashes[: rows * width : width]
        found = (hashes[width : width + rows * width].reshape(rows, width) == at[:, None]).any(1)
        last = hashes[width + rows * width :]
        found = np.append(found, len(last) > 0 and (last == hashes[rows * width]).any())
        if found.any():
            yield width, np.flatnonzero(found) * width
        hashes, width = _doubled(hashes, width), 2 * width


def _doubled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows of twice the width."""
    mixed = hashes * np.uint64(0xD1342543DE82EF95 + 2 * width)
    mixed ^= mixed >> np.uint64(29)
    return mixed[:-width] + hashes[width:]


def octave_shape(octave: int) -> tuple[int, int, int]:
    """(smallest period, largest period, words between anchors)."""
    return (1, FIRST - 1, FIRST) if octave < FIRST else (octave, 2 * octave - 1, octave)


def tiles(numbers: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(octave, number of the first word, words, anchors counted from it) of each tile."""
    for octave, anchors in anchors_by_octave(numbers):
        apart = octave_shape(octave)[2]
        owner = anchors // max(TILE, 8 * apart)
        for group in np.split(anchors, np.flatnonzero(np.diff(owner)) + 1):
            # An anchor sees one distance back, and two distances and a period on.
            low, high = max(0, int(group[0]) - apart), int(group[-1]) + 4 * apart
            held = numbers[low:high]
            yield octave, low, held.tobytes(), (group - low).astype(np.int32).tobytes()


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on equal those at the start."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def stretches(octave: int, numbers: list[int], anchors: list[int]) -> list[tuple[int, int, int]]:
    """(period, low, high): words low to high-1 equal those one period on.

    Reported is what holds a whole window at an anchor, as far as the anchor sees; parts
    that meet are one.
    """
    smallest, largest, apart = octave_shape(octave)
    found: dict[int, list[tuple[int, int]]] = {}
    for x in anchors:
        low, top = max(0, x - apart), min(len(numbers), x + 2 * apart)
        onward = z_function(numbers[x : x + 4 * apart])
        before = numbers[low:x][::-1]
        backward = None
        for period in range(smallest, min(largest + 1, len(onward))):
            reach = min(onward[period], 2 * apart)
            if reach < apart:
                continue
            if backward is None:  # what ends before the anchor against what ends before each period
                backward = z_function([*before, -1, *numbers[low:top][::-1]])
            back = backward[len(before) + 1 + top - x - period] if before else 0
            spans = found.setdefault(period, [])
            if spans and x - back <= spans[-1][1]:
                spans[-1] = (min(spans[-1][0], x - back), max(spans[-1][1], x + reach))
            else:
                spans.append((x - back, x + reach))
    return [(period, low, high) for period, spans in found.items() for low, high in spans]


def run_lines(runs: list[tuple[int, int, int]]) -> bytes:
    return "".join([f"{start},{length},{period}\n" for start, length, period in runs]).encode()


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words without those that a run repeats after its first period."""
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length by period; ties by start, then period."""
    best = None
    for run in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def exploded(docs: DataFrame, doc_id: str, text: str, rewrite: Rewrite | None) -> DataFrame:
    """A row for each document and one for each of its tiles, told apart by ``octave``.

    A document without tiles has the digest of its words; one with tiles, its words.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, schema = TaskContext.get().partitionId() << 40, None
        for batch in batches:
            if schema is None:
                schema = pa.schema([
                    ("row", pa.int64()), ("doc_id", batch.column("doc_id").type),
                    ("n_words", pa.int64()), ("body", pa.string()), ("digest", pa.string()),
                    ("octave", pa.int64()), ("first", pa.int64()), ("words", pa.binary()),
                    ("anchors", pa.binary()),
                ])
            rows, waiting = [], 0
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for key, value in zip(keys, texts, strict=True):
                words = value.encode().split()  # at ASCII white space
                places = rewrite(key, len(words)) if rewrite else None
                if places is not None:
                    words = [words[k] for k in places.tolist()]
                parts = list(tiles(word_numbers(words)))
                body = b" ".join(words)
                if parts:
                    rows.append((number, key, len(words), body.decode(), None, None, None, None, None))
                    for part in parts:
                        rows.append((number, None, None, None, None, *part))
                        waiting += len(part[2])
                    waiting += len(body)
                else:
                    digest = hashlib.sha256(body).hexdigest()
                    rows.append((number, key, len(words), None, digest, None, None, None, None))
                number += 1
                if waiting > FLUSH:
                    yield _batch(rows, schema)
                    rows, waiting = [], 0
            if rows:
                yield _batch(rows, schema)

    return docs.select(
        F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")
    ).mapInArrow(
        split, f"row long, doc_id {kind}, n_words long, body string, digest string, {_TILES}"
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, periods, lows, highs = [], [], [], []
        for r in batch.to_pylist():
            numbers = np.frombuffer(r["words"], np.int32).tolist()
            anchors = np.frombuffer(r["anchors"], np.int32).tolist()
            for period, low, high in stretches(r["octave"], numbers, anchors):
                rows.append(r["row"])
                periods.append(period)
                lows.append(r["first"] + low)
                highs.append(r["first"] + high)
        yield pa.record_batch(
            [pa.array(c, pa.int64()) for c in (rows, periods, lows, highs)],
            names=["row", "period", "low", "high"],
        )


def runs_of(parts: DataFrame) -> DataFrame:
    """(row, start, length, period) of every run, from the rows of ``exploded``."""
    tile = parts.where(F.col("octave").isNotNull()).select(
        "row", "octave", "first", "words", "anchors"
    )
    # Tiles of one document lie in one file: deal them out before the work.
    found = tile.repartition("row", "octave", "first").mapInArrow(
        _solved, "row long, period long, low long, high long"
    )
    own = Window.partitionBy("row", "period").orderBy("low", "high")
    reached = F.max("high").over(own.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("low") <= F.col("reached"), 0).otherwise(1)
    whole = (
        found.withColumn("reached", reached)
        .withColumn("run", F.sum(begins).over(own.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "period", "run")
        .agg(F.min("low").alias("start"), F.max("high").alias("high"))
        .withColumn("length", F.col("high") - F.col("start") + F.col("period"))
        .where(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
    )
    # A multiple of a period gives the same stretch again.
    return whole.groupBy("row", "start", "length").agg(F.min("period").alias("period"))


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            runs = sorted(
                [(x["start"], x["length"], x["period"]) for x in r["runs"] or []],
                key=lambda x: (x[0], x[2]),
            )
            best = strongest(runs)
            kept = " ".join(kept_words(r["body"].split(" "), runs))
            start, length, period = best or (None, None, None)
            rows.append((
                len(runs), start, length, period, 1000 * length // period if best else None,
                hashlib.sha256(run_lines(runs)).hexdigest(),
                hashlib.sha256(kept.encode()).hexdigest(), kept,
            ))
        columns = list(zip(*rows, strict=True)) or [[]] * 8
        kinds = [pa.int64()] * 5 + [pa.string()] * 3
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("n_words")]
            + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["doc_id", "n_words", *_RESULT],
        )


_RESULT = [
    "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
    "collapsed_sha256", "collapsed",
]


def collapse_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None
) -> DataFrame:
    """A row for each document: doc_id, n_words, n_runs, the strongest run (start, length,
    period, exponent_milli), runs_sha256 over all runs, collapsed_sha256 over the words
    that stay, and ``collapsed``, these words, where the document has an anchor.

    ``rewrite`` gives, for an id and a number of words, the places whose words stand in
    for them, or None.
    """
    parts = materialise(exploded(docs, doc_id, text, rewrite))
    kind = parts.schema["doc_id"].dataType.simpleString()
    rows = parts.where(F.col("octave").isNull())
    runs = runs_of(parts).groupBy("row").agg(
        F.collect_list(F.struct("start", "length", "period")).alias("runs")
    )
    met = rows.where(F.col("body").isNotNull()).join(runs, "row", "left")
    shape = f"doc_id {kind}, n_words long, " + ", ".join(
        f"{name} {'long' if k < 5 else 'string'}" for k, name in enumerate(_RESULT)
    )
    changed = met.select("doc_id", "n_words", "body", "runs").mapInArrow(_finished, shape)
    none = F.lit(None)
    still = rows.where(F.col("body").isNull()).select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_runs"),
        *[none.cast("long").alias(name) for name in _RESULT[1:5]],
        F.lit(_NONE).alias("runs_sha256"), F.col("digest").alias("collapsed_sha256"),
        none.cast("string").alias("collapsed"),
    )
    return still.unionByName(changed)


def document_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, period) of every run of every document."""
    parts = materialise(exploded(docs, doc_id, text, None))
    ids = parts.where(F.col("body").isNotNull()).select("row", "doc_id")
    return runs_of(parts).join(ids, "row").select("doc_id", "start", "length", "period")
