"""Toxicity by a convolutional network over hashed word embeddings, trained in NumPy.

A word's embedding is the sum of three rows of one table, found by hashes of the lower-cased (A-Z) word and of
its first four and five bytes, so that inflected and punctuated forms share what they have in common. Filters of
several widths run over the words of the whole text; the largest value of each filter goes into one logistic
unit. The table's first column is the log odds of each bucket among the texts learned from, and stays so; while
filters are trained, a text sees the odds that all other texts give, or its rare words would give it away. The
other columns start from small random numbers.

The model learns from a bounded sample of labelled texts (``training.PER_CLASS`` of each class) and is corrected
for the classes' true shares. Labels, language, source and id are no inputs of a score. For decisions, each
language has a threshold of its own, calibrated on all labelled texts to learn from (``flagged``).

A null or empty text scores what the unit gives without words. Repeated rows are scored repeatedly; a null
language has the threshold of all; without labels of both classes every score is the shares' alone. An empty table
gives an empty one.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm import training
from marketspark.llm.words import Words, releasing, slices, text_bytes

TABLE = 1 << 18
DIMENSIONS = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5)
EPOCHS = 4
#: A small sample is gone through more often, until so many steps are done.
STEPS = 600
BATCH = 64
RATE = 0.01
#: Rows of a bucket that the prior of its log odds counts for.
PRIOR = 2.0
#: Step of the table's other columns.
TABLE_RATE = 0.002
#: Positive texts of a language below which it shares the threshold of all.
LEAST = 20


def word_buckets(words: Words) -> np.ndarray:
    """Rows of the table for each word, one column for each hash."""
    hashes = [words.hashes(), *(words.hashes(prefix) ^ np.uint64(prefix) for prefix in PREFIXES)]
    return np.stack([(x & np.uint64(TABLE - 1)).astype(np.int32) for x in hashes], axis=1)


class Network:
    def __init__(self, model: dict[str, np.ndarray]):
        self.model = model

    @classmethod
    def fresh(cls, odds: np.ndarray) -> "Network":
        random = np.random.default_rng(6)
        table = random.normal(0, 0.05, (TABLE, DIMENSIONS)).astype(np.float32)
        table[:, 0] = odds
        model = {"table": table, "bias": np.zeros(1, dtype=np.float32)}
        for width in WIDTHS:
            filters = random.normal(0, 0.2, (width * DIMENSIONS, FILTERS)).astype(np.float32)
            filters[::DIMENSIONS, 0] = 1.0
            model[f"filters{width}"] = filters
            model[f"out{width}"] = np.full(FILTERS, 0.1, dtype=np.float32)
        return cls(model)

    def pooled(self, buckets: np.ndarray, sizes: np.ndarray, width: int, embedded: np.ndarray):
        """Largest filter values per text, with the texts that have them, and what gradients need. A text with
        fewer words than the filter is wide is followed by empty words."""
        padded = np.maximum(sizes, width) * (sizes > 0)
        begins = np.cumsum(padded) - padded
        rows = np.zeros((max(int(padded.sum()), 1) + width - 1, DIMENSIONS), dtype=np.float32)
        at = np.arange(len(embedded)) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
        rows[at] = embedded
        windows = np.lib.stride_tricks.sliding_window_view(rows.reshape(-1), width * DIMENSIONS)[::DIMENSIONS]
        counts = (padded - width + 1) * (sizes > 0)
        full = np.flatnonzero(counts)
        # Windows that reach into the next text are left out.
        inside = np.arange(int(counts.sum())) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
        values = windows[inside] @ self.model[f"filters{width}"] if len(inside) else np.zeros((0, FILTERS), dtype=np.float32)
        starts = (np.cumsum(counts) - counts)[full]
        tops = np.maximum.reduceat(values, starts, axis=0) if len(full) else values
        return full, tops, values, starts, counts[full], inside, windows, at

    def embed(self, buckets: np.ndarray, odds: np.ndarray | None = None) -> np.ndarray:
        """``odds``: instead of the first column, for each word and hash."""
        table = self.model["table"]
        embedded = table[buckets[:, 0]]
        for column in range(1, buckets.shape[1]):
            embedded += table[buckets[:, column]]
        if odds is not None:
            embedded[:, 0] = odds.sum(axis=1)
        return embedded

    def logits(self, buckets: np.ndarray, sizes: np.ndarray, odds: np.ndarray | None = None) -> np.ndarray:
        found = np.full(len(sizes), float(self.model["bias"][0]))
        embedded = self.embed(buckets, odds)
        for width in WIDTHS:
            full, tops, *_ = self.pooled(buckets, sizes, width, embedded)
            found[full] += tops @ self.model[f"out{width}"]
        return found

    def gradients(self, buckets: np.ndarray, sizes: np.ndarray, labels: np.ndarray, odds: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """Of the small arrays; and of the table, as rows and their gradients."""
        embedded = self.embed(buckets, odds)
        parts = {width: self.pooled(buckets, sizes, width, embedded) for width in WIDTHS}
        logits = np.full(len(sizes), float(self.model["bias"][0]))
        for width, (full, tops, *_) in parts.items():
            logits[full] += tops @ self.model[f"out{width}"]
        error = ((training.sigmoid(logits) - labels) / len(labels)).astype(np.float32)
        found = {"bias": np.array([error.sum()], dtype=np.float32)}
        into = np.zeros_like(embedded)
        for width, (full, tops, values, starts, counts, inside, windows, at) in parts.items():
            out, filters = self.model[f"out{width}"], self.model[f"filters{width}"]
            found[f"out{width}"] = tops.T @ error[full]
            best = inside[training.first_at_maximum(values, starts, counts, tops)] if len(full) else np.zeros((0, FILTERS), dtype=np.int64)
            slope = error[full][:, None] * out
            gradient = np.zeros_like(filters)
            rows = np.zeros((len(windows) + width, DIMENSIONS), dtype=np.float32)
            for f in range(FILTERS):
                gradient[:, f] = windows[best[:, f]].T @ slope[:, f]
                for k in range(width):
                    np.add.at(rows, best[:, f] + k, slope[:, f, None] * filters[k * DIMENSIONS : (k + 1) * DIMENSIONS, f])
            found[f"filters{width}"] = gradient
            into += rows[at]
        into[:, 0] = 0
        some = np.flatnonzero(into.any(axis=1))
        return found, buckets[some].reshape(-1), np.repeat(into[some], buckets.shape[1], axis=0)


def _buckets_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.cumsum([0, *map(len, texts)])
    words = Words(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets, lower=True)
    return word_buckets(words), words.counts()


def train(texts: list[bytes], labels: np.ndarray, langs: list) -> dict[str, np.ndarray]:
    """The model's arrays, and for each class the odds without one of its texts for the choice of thresholds."""
    if len(set(labels.tolist())) < 2:
        model = Network.fresh(np.zeros(TABLE, dtype=np.float32)).model
        return model | {"others": np.zeros((2, TABLE), dtype=np.float32), "drawn": np.zeros(1)}
    parts = [_buckets_of(texts[k : k + 256]) for k in range(0, len(texts), 256)]
    buckets = np.concatenate([part[0] for part in parts])
    sizes = np.concatenate([part[1] for part in parts])
    ends = np.cumsum(sizes)
    # Texts of each class that hold a bucket.
    seen = np.zeros((2, TABLE), dtype=np.float32)
    for k, end in enumerate(ends):
        seen[int(labels[k])][np.unique(buckets[end - sizes[k] : end])] += 1
    share = labels.mean()

    def odds(own: int | None) -> np.ndarray:
        """Without one text of a class that holds the bucket."""
        ones, zeros = seen[1] - (own == 1), seen[0] - (own == 0)
        found = np.log((np.maximum(ones, 0) + PRIOR * share) / (np.maximum(zeros, 0) + PRIOR * (1 - share)))
        return (found - np.log(share / (1 - share))).astype(np.float32)

    network, others = Network.fresh(odds(None)), np.stack([odds(0), odds(1)])
    small = {name: x for name, x in network.model.items() if name != "table"}
    adam, squares = training.Adam(small, RATE), np.full(TABLE, 1e-8, dtype=np.float32)
    random = np.random.default_rng(7)
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(sizes)))):
        order = random.permutation(len(sizes))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            rows = np.concatenate([np.arange(ends[k] - sizes[k], ends[k]) for k in chosen])
            classes = np.repeat(labels[chosen].astype(np.int64), sizes[chosen])
            gradients, places, into = network.gradients(buckets[rows], sizes[chosen], labels[chosen], others[classes[:, None], buckets[rows]])
            adam.update(network.model, gradients)
            # The table takes AdaGrad steps on the rows that were met.
            np.add.at(squares, places, np.einsum("ij,ij->i", into, into) / DIMENSIONS)
            np.add.at(network.model["table"], places, -TABLE_RATE * into / np.sqrt(squares[places])[:, None])
    return network.model | {"others": others, "drawn": training.log_odds(labels)}


def cut_counts(docs: DataFrame, labels: DataFrame, label: str, rows: Column, per_class: int, model: dict[str, np.ndarray], others: np.ndarray, cuts: np.ndarray) -> DataFrame:
    """``lang``, ``label``, ``place``, ``count`` of all labelled rows for which ``rows`` holds: how many of the sorted
    ``cuts`` a text's logit reaches. Texts trained on see the odds that all other texts give. Only places, not texts,
    are joined to the labels."""
    sent = docs.sparkSession.sparkContext.broadcast(training.packed(model | {"others": others, "cuts": cuts}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = training.unpacked(sent.value)
        network, others = Network(arrays), arrays["others"]
        for batch in batches:
            for own, data, offsets in slices(batch, "text"):
                words = Words(data, offsets, lower=True)
                buckets, sizes = word_buckets(words), words.counts()
                drawn = np.repeat(own.column("drawn").to_numpy(), sizes)[:, None]
                odds = np.where(drawn >= 0, others[np.maximum(drawn, 0), buckets], arrays["table"][buckets, 0])
                place = np.searchsorted(arrays["cuts"], network.logits(buckets, sizes, odds), side="right")
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("lang"), pa.array(place)], ["doc_id", "lang", "place"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = training.chosen_ids(labels, label, rows, per_class).groupBy("doc_id").agg(F.min("label").alias("drawn"))
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), text_bytes().alias("text"))
    known = F.when(F.octet_length("text") <= training.TRAIN_BYTES, F.col("drawn"))
    inputs = texts.join(F.broadcast(chosen), "doc_id", "left").select("doc_id", "lang", "text", F.coalesce(known, F.lit(-1)).alias("drawn"))
    placed = inputs.mapInArrow(run, f"doc_id {kind}, lang string, place long")
    return placed.join(training.known_labels(labels, label, rows), "doc_id").groupBy("lang", "label", "place").count()


def thresholds(counts: list, cuts: np.ndarray, even: float) -> dict[str, np.ndarray]:
    """From the rows of ``cut_counts``, the cut with the fewest errors for each language, and for all (""). Cuts
    within one standard error of the best count as equal, and the one nearest to ``even`` is taken."""
    found = {"": np.zeros((2, len(cuts) + 1), dtype=np.int64)}
    for row in counts:
        for name in {"", row["lang"]}:
            found.setdefault(name, np.zeros_like(found[""]))[row["label"], row["place"]] += row["count"]

    def best(own: np.ndarray) -> float:
        if own[1].sum() < LEAST:
            return float("nan")
        # Toxic texts below a cut, and others that reach it.
        errors = np.cumsum(own[1])[:-1] + own[0].sum() - np.cumsum(own[0])[:-1]
        good = cuts[errors <= errors.min() + np.sqrt(errors.min() + 1)]
        return float(good[np.argmin(np.abs(good - even))])

    names = sorted(found)
    limits = np.array([best(found[name]) for name in names])
    if np.isnan(limits[0]):
        limits[0] = even
    return {"languages": np.array(names), "thresholds": np.where(np.isnan(limits), limits[0], limits)}


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: Column | None = None, per_class: int = training.PER_CLASS) -> dict[str, np.ndarray]:
    """Trains on labelled rows for which ``rows`` holds, and sets the thresholds on all of them. Runs jobs. The model
    has a fixed size but for the languages."""
    rows = F.lit(True) if rows is None else rows
    model = training.fit(training.labelled_sample(docs, labels, label, rows, per_class), train)
    others = model.pop("others")
    # The sample has other class shares than the labels.
    shift = training.class_shares(labels, label, rows) - float(model.pop("drawn")[0])
    model["bias"] = model["bias"] + np.float32(shift)
    cuts = np.sort(np.append(np.linspace(-4, 6, 201) + shift, 0.0))
    return model | thresholds(cut_counts(docs, labels, label, rows, per_class, model, others, cuts).collect(), cuts, 0.0)


def _scorer(arrays: dict[str, np.ndarray]):
    """From a batch with ``text`` (bytes) and languages to scores and thresholds."""
    network = Network(arrays)
    limits = {str(lang): float(limit) for lang, limit in zip(arrays["languages"], arrays["thresholds"], strict=True)}

    def run(texts: pa.Array, langs: list) -> tuple[np.ndarray, np.ndarray]:
        logits = [np.zeros(0)]
        for _, data, offsets in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            words = Words(data, offsets, lower=True)
            logits.append(network.logits(word_buckets(words), words.counts()))
        cuts = np.array([limits.get(lang or "", limits[""]) for lang in langs], dtype=np.float64)
        return training.sigmoid(np.concatenate(logits)), training.sigmoid(cuts)

    return run


def score(docs: DataFrame, model: dict[str, np.ndarray], id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """``id_column``, ``score``, ``threshold`` of the text's language, ``flagged``. A map over the documents."""
    sent = docs.sparkSession.sparkContext.broadcast(training.packed(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(training.unpacked(sent.value))
        for batch in batches:
            scores, thresholds = scorer(batch.column("text"), batch.column("lang").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scores), pa.array(thresholds), pa.array(scores >= thresholds)], ["key", "score", "threshold", "flagged"])

    kind = docs.schema[id_column].dataType.simpleString()
    inputs = docs.select(F.col(id_column).alias("key"), text_bytes(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    return inputs.mapInArrow(run, f"key {kind}, score double, threshold double, flagged boolean").withColumnRenamed("key", id_column)


def without_toxic(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """The documents that are not flagged, with all their columns. A map, without a join."""
    sent = docs.sparkSession.sparkContext.broadcast(training.packed(model))
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(training.unpacked(sent.value))
        for batch in batches:
            texts = batch.column(text).fill_null("").cast(pa.binary())
            scores, thresholds = scorer(texts, batch.column(lang).to_pylist())
            yield batch.filter(pa.array(scores < thresholds))

    return docs.mapInArrow(releasing(run), docs.schema)
