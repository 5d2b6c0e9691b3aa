"""Quality by a convolutional network over bytes, in NumPy.

A text's UTF-8 bytes are embedded and cut into overlapping windows of ``WIDTH`` bytes every ``STRIDE`` bytes, from
the first byte to the last. Learned filters give a value for each window. The largest of each filter is taken
in every chunk of ``CHUNK`` windows; mean and maximum of the chunks and the logarithm of the length go through one hidden layer
into one probability. Repetitive texts show few different windows, so that their chunks' maxima stay low; odd
bytes show in filters of their own.

The model learns from a bounded sample of labelled texts and is corrected for the classes' true shares. Labels,
language, source and id are no inputs of a score. A null or empty text is one window of padding. Repeated rows
are scored repeatedly; without labels of both classes every score is the shares' alone. An empty table gives an
empty one. Other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm import training
from marketspark.llm.words import slices, text_bytes

WIDTH, STRIDE, DIMENSIONS = 8, 4, 6
FILTERS, HIDDEN = 24, 16
CHUNK = 128
EPOCHS = 6
#: A small sample is gone through more often, until so many steps are done.
STEPS = 600
BATCH = 32
RATE = 0.01
#: Bytes of texts that are worked on together.
SLICE = 1 << 19


class Windows:
    """The windows of some texts: rows of byte numbers (0 is padding, a byte b is b + 1)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        sizes = np.diff(offsets)
        steps = (np.maximum(sizes - WIDTH, 0) + STRIDE - 1) // STRIDE
        lengths = WIDTH + STRIDE * steps
        begins = np.cumsum(lengths) - lengths
        padded = np.zeros(int(lengths.sum()), dtype=np.int16)
        padded[np.arange(len(data)) + np.repeat(begins - offsets[:-1], sizes)] = data.astype(np.int16) + 1
        self.sizes = sizes
        self.counts = steps + 1
        self.padded = padded
        self.places = STRIDE * (np.arange(int(self.counts.sum())) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)) + np.repeat(begins, self.counts)
        chunks = -(-self.counts // CHUNK)
        self.chunks = chunks
        rank = np.arange(int(chunks.sum())) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        self.chunk_starts = np.repeat(np.cumsum(self.counts) - self.counts, chunks) + CHUNK * rank
        self.chunk_sizes = np.diff(np.append(self.chunk_starts, int(self.counts.sum())))

    def inputs(self, table: np.ndarray) -> np.ndarray:
        """One row of embedded bytes for each window."""
        flat = table[self.padded].reshape(-1)
        view = np.lib.stride_tricks.sliding_window_view(flat, WIDTH * DIMENSIONS)[::DIMENSIONS]
        return view[self.places]


class Network:
    def __init__(self, model: dict[str, np.ndarray]):
        self.model = model

    @classmethod
    def fresh(cls) -> "Network":
        random = np.random.default_rng(4)
        return cls({
            name: random.normal(0, scale, shape).astype(np.float32)
            for name, scale, shape in (
                ("table", 0.5, (257, DIMENSIONS)), ("filters", 0.3, (WIDTH * DIMENSIONS, FILTERS)), ("hidden", 0.15, (2 * FILTERS + 1, HIDDEN)),
                ("shift", 0.0, (HIDDEN,)), ("out", 0.3, (HIDDEN,)), ("bias", 0.0, (1,)),
            )
        })

    def features(self, windows: Windows):
        """Mean and maximum over chunks of each filter's largest value, and log length; with what led to them."""
        inputs = windows.inputs(self.model["table"])
        values = inputs @ self.model["filters"]
        tops = np.maximum.reduceat(values, windows.chunk_starts, axis=0)
        first = np.cumsum(windows.chunks) - windows.chunks
        mean = np.add.reduceat(tops, first, axis=0) / windows.chunks[:, None]
        most = np.maximum.reduceat(tops, first, axis=0)
        length = np.log1p(windows.sizes)[:, None] / 10
        return np.hstack([mean, most, length]).astype(np.float32), inputs, values, tops, first

    def head(self, features: np.ndarray):
        hidden = np.tanh(features @ self.model["hidden"] + self.model["shift"])
        return hidden @ self.model["out"] + self.model["bias"], hidden

    def logits(self, windows: Windows) -> np.ndarray:
        return self.head(self.features(windows)[0])[0]

    def gradients(self, windows: Windows, labels: np.ndarray) -> dict[str, np.ndarray]:
        features, inputs, values, tops, first = self.features(windows)
        logits, hidden = self.head(features)
        error = ((training.sigmoid(logits) - labels) / len(labels)).astype(np.float32)
        back = error[:, None] * self.model["out"] * (1 - hidden * hidden)
        found = {"out": hidden.T @ error, "bias": error.sum(keepdims=True), "hidden": features.T @ back, "shift": back.sum(axis=0)}
        into = back @ self.model["hidden"].T
        mean, most = into[:, :FILTERS], into[:, FILTERS : 2 * FILTERS]
        slope = np.repeat(mean / windows.chunks[:, None], windows.chunks, axis=0)
        chunk = training.first_at_maximum(tops, first, windows.chunks, features[:, FILTERS : 2 * FILTERS])
        best = training.first_at_maximum(values, windows.chunk_starts, windows.chunk_sizes, tops)
        filters = np.zeros_like(self.model["filters"])
        table = np.zeros_like(self.model["table"])
        for f in range(FILTERS):
            np.add.at(slope[:, f], chunk[:, f], most[:, f])
            filters[:, f] = inputs[best[:, f]].T @ slope[:, f]
            weights = self.model["filters"][:, f].reshape(WIDTH, DIMENSIONS)
            for k in range(WIDTH):
                np.add.at(table, windows.padded[windows.places[best[:, f]] + k], slope[:, f, None] * weights[k])
        return found | {"filters": filters, "table": table}


def train(texts: list[bytes], labels: np.ndarray, langs: list) -> dict[str, np.ndarray]:
    network = Network.fresh()
    if len(set(labels.tolist())) < 2:
        network.model["out"][:] = 0
        return network.model | {"drawn": np.zeros(1)}
    adam = training.Adam(network.model, RATE)
    random = np.random.default_rng(5)
    epochs = max(EPOCHS, -(-STEPS * BATCH // len(texts)))
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / epochs)
        order = random.permutation(len(texts))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            offsets = np.cumsum([0, *(len(texts[k]) for k in chosen)])
            windows = Windows(np.frombuffer(b"".join(texts[k] for k in chosen), dtype=np.uint8), offsets)
            adam.update(network.model, network.gradients(windows, labels[chosen]))
    return network.model | {"drawn": training.log_odds(labels)}


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: Column | None = None, per_class: int = training.PER_CLASS) -> dict[str, np.ndarray]:
    """Trains on labelled rows for which ``rows`` holds. Runs jobs. The model has a fixed size."""
    rows = F.lit(True) if rows is None else rows
    model = training.fit(training.labelled_sample(docs, labels, label, rows, per_class), train)
    shift = training.class_shares(labels, label, rows) - float(model.pop("drawn")[0])
    model["bias"] = model["bias"] + np.float32(shift)
    return model


def score(docs: DataFrame, model: dict[str, np.ndarray], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``score``: the probability of label 1. A map over the documents."""
    sent = docs.sparkSession.sparkContext.broadcast(training.packed(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(training.unpacked(sent.value))
        for batch in batches:
            for rows, data, offsets in slices(batch, "text", SLICE):
                scores = training.sigmoid(network.logits(Windows(data, offsets)).astype(np.float64))
                yield pa.RecordBatch.from_arrays([rows.column("key"), pa.array(scores)], ["key", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    inputs = docs.select(F.col(id_column).alias("key"), text_bytes(text_column).alias("text"))
    return inputs.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", id_column)
