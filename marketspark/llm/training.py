"""What the trained classifiers share: folds, bounded samples of labelled rows, and models on their way to tasks."""

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.words import text_bytes

#: Bound of the training sample: rows of each class, and bytes of a text that may be drawn. All texts are scored.
PER_CLASS = 2500
TRAIN_BYTES = 1 << 16


def remainder(id_column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % divisor


def known_labels(labels: DataFrame, label: str, learn: Column) -> DataFrame:
    """``doc_id``, ``label`` (0 or 1) of the rows for which ``learn`` holds."""
    return labels.where(learn & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))


def chosen_ids(labels: DataFrame, label: str, learn: Column, per_class: int = PER_CLASS) -> DataFrame:
    """At most ``per_class`` of these of each class, in the order of a hash of the id."""
    known = known_labels(labels, label, learn)
    chosen = [known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for value in (0, 1)]
    return chosen[0].unionByName(chosen[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int = PER_CLASS) -> DataFrame:
    """``text`` (bytes), ``label``, ``lang`` of at most ``per_class`` rows of each class for which ``learn`` holds (a
    condition on ``doc_id``), in the order of a hash of the id. The chosen ids, so bounded, are broadcast."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    texts = docs.select("doc_id", text_bytes().alias("bytes"), F.col("lang").cast("string").alias("lang"))
    drawn = texts.where(F.octet_length("bytes") <= TRAIN_BYTES).join(F.broadcast(chosen_ids(labels, label, learn, per_class)), "doc_id")
    return drawn.orderBy(*order).limit(2 * per_class).select(F.col("bytes").alias("text"), "label", "lang")


def class_shares(labels: DataFrame, label: str, learn: Column) -> float:
    """Log odds of label 1 among all rows to learn from, with one row added to each class."""
    row = labels.where(learn).agg(F.sum((F.col(label) == 1).cast("long")).alias("ones"), F.sum((F.col(label) == 0).cast("long")).alias("zeros")).first()
    return float(np.log(((row["ones"] or 0) + 1) / ((row["zeros"] or 0) + 1)))


def log_odds(labels: np.ndarray) -> np.ndarray:
    """The same for labels at hand."""
    return np.array([np.log((labels.sum() + 1) / ((1 - labels).sum() + 1))])


def fit(sample: DataFrame, train: Callable[[list[bytes], np.ndarray, list], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Trains in one task on a bounded sample and returns the model's arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        model = train([row["text"] for row in rows], np.array([row["label"] for row in rows], dtype=np.float32), [row["lang"] for row in rows])
        yield pa.RecordBatch.from_pydict({"model": [packed(model)]})

    found = sample.coalesce(1).mapInArrow(run, "model binary").collect()
    return unpacked(bytes(found[0]["model"])) if found else train([], np.zeros(0, dtype=np.float32), [])


def packed(model: dict[str, np.ndarray]) -> bytes:
    file = io.BytesIO()
    np.savez(file, **model)
    return file.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as file:
        return {name: file[name] for name in file.files}


class Adam:
    """Adam over named arrays."""

    def __init__(self, model: dict[str, np.ndarray], rate: float):
        self.rate, self.step = rate, 0
        self.mean = {name: np.zeros_like(x) for name, x in model.items()}
        self.square = {name: np.zeros_like(x) for name, x in model.items()}

    def update(self, model: dict[str, np.ndarray], gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for name, gradient in gradients.items():
            mean, square = self.mean[name], self.square[name]
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient * gradient - square)
            model[name] -= (scale * mean / (np.sqrt(square) + 1e-8)).astype(model[name].dtype)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def first_at_maximum(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray, tops: np.ndarray) -> np.ndarray:
    """For each segment and column, the first row that holds the segment's maximum."""
    found = np.empty(tops.shape, dtype=np.int64)
    for column in range(values.shape[1]):
        hits = np.flatnonzero(values[:, column] == np.repeat(tops[:, column], sizes))
        found[:, column] = hits[np.searchsorted(hits, begins)]
    return found
