"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes.

A text is the set of its hashed character n-grams.  Each n-gram is scaled by the log
ratio of its document frequencies in toxic and other training texts, each text is
scaled to length 1, and a logistic regression is trained on top.  Smoothing follows
the class sizes, so that an n-gram without evidence has ratio 0.

Training is distributed: features are written once to the shared folder, every step
sends the weights out and adds up one gradient for each of a fixed number of
partitions.  The labelled rows are a sample bounded by ``max_rows``, those with the
smallest hash of their id.

The score is a probability; a text without n-grams (null, empty, short) has the one
of the bias alone.  Labels of one class only give that class for every text, and no
labels give 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clamor.llm.common import fresh, text_or_empty, work_folder
from clamor.llm.ngrams import DistinctPlaces

BITS = 18
SIZES = (4, 5)
MAX_ROWS = 20_000  # labelled rows used for training
PARTS = 6  # tasks of a training step, and gradients added up by the driver
ROWS = 256  # training texts at a time
SMOOTHING = 100.0  # documents
RIDGE = 3e-4
STEPS = 25
RATE = 0.3


@dataclass
class Model:
    ratios: np.ndarray
    weights: np.ndarray  # of the scaled n-grams, times their ratios
    bias: float

    def margin(self, places: np.ndarray) -> float:
        length = float(np.sqrt((self.ratios[places] ** 2).sum()))
        return self.bias + (float(self.weights[places].sum()) / length if length > 0 else 0.0)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by 5; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id",
    text: str = "text", max_rows: int = MAX_ROWS,
) -> DataFrame:
    """text and label of labelled documents that are not held out.

    An id that is labelled several times has its largest label.
    """
    chosen = (
        labels.filter(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1) & ~is_held_out(doc_id))
        .groupBy(F.col(doc_id).alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # At most max_rows pairs of numbers are broadcast.
    return docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    ).select("text", "label")


def features(rows: DataFrame) -> DataFrame:
    """label and the sorted places of each text, stored in the shared folder.

    Places are kept as their steps in 32-bit integers, most of which are small, so that
    they take little more than a byte each once they are compressed.
    """

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct = DistinctPlaces(SIZES, BITS)
        for batch in _pieces(batches):
            places = [
                np.diff(np.sort(distinct.of(t.as_py())), prepend=0).astype(np.int32).tobytes()
                for t in batch.column("text")
            ]
            yield pa.record_batch(
                [batch.column("label"), pa.array(places, pa.binary())], names=["label", "places"]
            )

    with small_batches(rows.sparkSession):
        found = rows.mapInArrow(extracted, "label int, places binary")
        path = work_folder(rows.sparkSession, "features")
        found.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(found.schema).parquet(path).coalesce(PARTS)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Record batches of ROWS rows for the jobs inside: rows are long lists of places."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def _summed(rows: DataFrame, part: Callable, size: int) -> np.ndarray:
    """The sum of part(labels, places, sizes) over all rows; a vector for each of at most
    PARTS tasks comes to the driver."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in _pieces(batches):
            labels = batch.column("label").to_numpy()
            held = [np.cumsum(np.frombuffer(x.as_py(), np.int32)) for x in batch.column("places")]
            keep = np.array([len(x) > 0 for x in held], bool)
            if keep.any():
                sizes = np.array([len(x) for x in held if len(x)])
                places = np.concatenate([x for x in held if len(x)])
                total += part(labels[keep], places, sizes)
        summed = total.astype(np.float32).tobytes()
        yield pa.record_batch([pa.array([summed], pa.binary())], names=["sum"])

    total = np.zeros(size)
    with small_batches(rows.sparkSession):
        vectors_of_tasks = rows.mapInArrow(vectors, "sum binary").collect()
    for row in vectors_of_tasks:
        total += np.frombuffer(row["sum"], np.float32)
    return total


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)[:-1]])


def train(rows: DataFrame) -> Model:
    """Train from text and label (0 or 1)."""
    space = 1 << BITS
    counts = dict(rows.groupBy("label").count().collect())
    toxic, other = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not other:
        bias = np.inf if toxic else -np.inf
        return Model(np.zeros(space, np.float32), np.zeros(space, np.float32), bias)
    stored = features(rows)

    def frequencies(labels, places, sizes):
        of = np.repeat(labels, sizes) == 1
        return np.concatenate(
            [np.bincount(places[of], minlength=space), np.bincount(places[~of], minlength=space)]
        )

    seen = _summed(stored, frequencies, 2 * space)
    share = SMOOTHING / (toxic + other)
    ratios = np.log((seen[:space] + share * toxic) / (toxic * (1 + share)))
    ratios -= np.log((seen[space:] + share * other) / (other * (1 + share)))
    ratios = ratios.astype(np.float32)

    def gradient_of(weights: np.ndarray, bias: float) -> Callable:
        def gradient(labels, places, sizes):
            scaled, starts = ratios[places], _starts(sizes)
            length = np.sqrt(np.add.reduceat(scaled * scaled, starts))
            scale = 1 / np.maximum(length, 1e-6)
            z = scale * np.add.reduceat(weights[places] * scaled, starts) + bias
            # Both classes weigh the same.
            miss = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels
            miss *= np.where(labels == 1, other / toxic, 1.0)
            each = np.repeat(miss * scale, sizes) * scaled
            return np.append(np.bincount(places, weights=each, minlength=space), miss.sum())

        return gradient

    # Steps of its own size for each weight, from the sum of its squared gradients.
    weights, bias = np.ones(space, np.float32), 0.0
    squares, bias_squares = np.zeros(space), 0.0
    for _ in range(STEPS):
        total = _summed(stored, gradient_of(weights, bias), space + 1) / (toxic + other)
        slope = total[:-1] + RIDGE * weights
        squares += slope**2
        bias_squares += total[-1] ** 2
        weights = (weights - RATE * slope / np.sqrt(squares + 1e-12)).astype(np.float32)
        bias -= RATE * total[-1] / np.sqrt(bias_squares + 1e-12)
    return Model(ratios, weights * ratios, float(bias))


def with_toxicity(docs: DataFrame, model: Model, text: str = "text", score: str = "score"):
    """docs with the probability that a text is toxic; a clashing name gets an underscore."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        distinct = DistinctPlaces(SIZES, BITS)
        for texts in batches:
            margins = np.array([model.margin(distinct.of(t)) for t in texts], dtype=float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(margins, -50, 50))))

    return docs.withColumn(fresh(docs, score)[0], scored(text_or_empty(text)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    model = train(training_rows(docs, labels, max_rows=max_rows))
    return with_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id",
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows that the classifier, trained on the labelled ones, does not reject."""
    model = train(training_rows(docs, labels, max_rows=max_rows))
    score = fresh(docs, "score")[0]
    return (
        with_toxicity(docs, model, score=score)
        .filter(F.col(score) < 0.5)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
