"""A bigram language model whose counts lie in a log-frequency Bloom filter.

Words are lower-cased (A-Z) and cut at white space; an end token closes every text. All words and all pairs of
neighbours in the documents to learn from are counted, whatever their number. A pair with n occurrences has the
level floor(log2(n)); a level stands for one number of occurrences, the middle of its range.

Words with at least one in ``FREQUENT`` of all tokens are broadcast with their exact counts, which are ``FREQUENT`` at
most. Pairs of two of them lie in log-frequency Bloom filters: (pair, 1) to (pair, level), or (pair, 0) for a pair that
occurs once. There is one filter for each part of the pairs by their hash, filled where the pairs are counted and
probed there by the tokens that ask; it holds all levels. A further one is broadcast and answers for common pairs, also
those of a frequent word and a rare one. It is as large as its entries need; where they would be more than ``PAIRS``, it
holds the levels from the lowest one with which they are not, and says so with ``base``. Rare words, pairs after rare
words, and pairs before rare words below the base are joined exactly to the tokens that ask for them. So the bounds say
where a count is looked up, not what the model knows. A pair's level is found by asking the filter for one level after the other.

The model backs off: P(w | h) is the pair's share of h, scaled so that all pairs of h have c(h) / (c(h) + different
words after h) at most (Witten and Bell); for a pair that was not met it is the word's own probability
(c + 1) / (N + V + 1), scaled so that the probabilities of a context add up to one.

A null or empty text is its end token alone. A null id is learned from. Repeated rows count and are scored
repeatedly. Without a text to learn from, all counts are zero; an empty table gives an empty one.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.llm import bloom
from marketspark.llm.training import packed, unpacked
from marketspark.llm.words import Words, mix, release, releasing, row_key, slices, text_bytes
from marketspark.sources.scratch import emptied, new_folder, stored

FREQUENT = 1 << 22
PAIRS = 1 << 25
#: Frequent words have their places as codes; codes of rare words have this bit and 62 bits of the hash.
RARE = 1 << 62
#: Ids of pairs with a rare word have this bit and 61 bits of a hash.
MIXED = 1 << 61
SIGN = -(1 << 63)
#: What stands for the end of a text among the hashes of words.
END = np.uint64(0x5DEECE66D)
#: Pairs and keys are split by hash into one part for so many tokens to learn from. A part of a table fits a task.
PART = 1 << 19
#: A task adds up so many entries, and gives them out when half as many different keys are left. Asks are dealt in the same numbers.
ANSWERS = 1 << 20
#: Scored texts are put together in groups by hash, so many at least, of about so many texts.
GROUPS, GROUP = 256, 1 << 17
#: About so many asks of a part are looked up at once.
ASKED = 1 << 17
#: Rows of the joined table that a task deals to parts at once.
TOLD = 1 << 18
#: The middle of a level, as a multiple of its lower end.
MIDDLE = 2**0.5


class Tokens:
    """Hashes of all tokens of some texts, each text closed by its end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets, lower=True)
        counts = words.counts()
        self.sizes = counts + 1
        self.ends = np.cumsum(self.sizes) - 1
        self.hashes = np.empty(len(words) + len(counts), dtype=np.uint64)
        self.hashes[self.ends] = END
        inner = np.ones(len(self.hashes), dtype=bool)
        inner[self.ends] = False
        self.hashes[inner] = words.hashes()
        self.starts = self.ends - counts


class Sums:
    """Adds up values by key as they come, in bounded memory."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def total(self) -> tuple[np.ndarray, ...]:
        """The different keys and the sum of each of their values."""
        key, *values = (np.concatenate(arrays) for arrays in zip(*self.held, strict=True))
        keys, back = np.unique(key, return_inverse=True)
        return keys, *[np.bincount(back, x, len(keys)).astype(x.dtype) for x in values]

    def add(self, *arrays: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Takes keys and their values; gives the sums out if they are too many to hold."""
        self.held.append(arrays)
        self.size += len(arrays[0])
        if self.size > ANSWERS:
            self.held = [self.total()]
            self.size = len(self.held[0][0])
            if self.size > ANSWERS // 2:
                yield from self.rest()

    def rest(self) -> Iterator[tuple[np.ndarray, ...]]:
        if self.size:
            yield self.total()
        self.held, self.size = [], 0


def word_counts(docs: DataFrame) -> DataFrame:
    """``hash``, ``n`` of every token of ``text`` (bytes)."""

    def given(found: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["hash", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            for _, data, offsets in slices(batch, "text"):
                for one in sums.add(*np.unique(Tokens(data, offsets).hashes, return_counts=True)):
                    yield given(*one)
        for one in sums.rest():
            yield given(*one)

    return docs.select("text").mapInArrow(releasing(run), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def pair_ids(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One number for each pair of codes."""
    spread = mix(mix(h.view(np.uint64)) + w.view(np.uint64)) >> np.uint64(3)
    return np.where((h < RARE) & (w < RARE), h << 32 | w, (spread | np.uint64(MIXED)).view(np.int64))


def worth(level: np.ndarray) -> np.ndarray:
    """Log10 of the occurrences that a level stands for."""
    return np.where(level > 0, level * np.log10(2.0) + np.log10(MIDDLE), 0.0)


class Vocabulary:
    """The frequent words: their sorted hashes and counts."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.hashes, self.counts = arrays["hashes"], arrays["counts"]

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each token, -1 for a rare one."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, dtype=np.int64)
        asked, back = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
        return np.where(self.hashes[at] == asked, at, -1)[back]

    def codes(self, hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
        return np.where(places >= 0, places, (hashes >> np.uint64(2) | np.uint64(RARE)).view(np.int64))

    def neighbours(self, tokens: Tokens, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of each token's context and of the token. The first token's context is the end of a text."""
        codes = self.codes(tokens.hashes, places)
        end = np.array([END])
        before = np.empty_like(codes)
        before[1:] = codes[:-1]
        before[tokens.starts] = self.codes(end, self.places(end))[0]
        return before, codes

    def pairs(self, tokens: Tokens, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code of each token's context, and the pairs."""
        before, codes = self.neighbours(tokens, places)
        return before, pair_ids(before, codes)


def dealt(keys: np.ndarray, parts: int, kind: int, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows ``part, kind, packed``: the columns (int64) of all keys of a part, low and high halves of each column one
    behind the other, which compresses well."""
    part = (mix(keys.view(np.uint64)) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, dtype=np.int64)
    halves = np.stack([column[order] for column in columns]).view(np.uint32).reshape(len(columns), -1, 2)
    packed = [halves[:, begin:end].transpose(0, 2, 1).tobytes() for begin, end in zip(starts, [*starts[1:], len(part)], strict=True)]
    kinds = np.full(len(starts), kind, dtype=np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int64)), pa.array(kinds), pa.array(packed, pa.binary())], ["part", "kind", "packed"])


DEALT = "part long, kind int, packed binary"
#: What the broadcast tables know of a text.
COUNTS, SUMS = ["n_tokens", "n_frequent", "n_seen"], ["single", "model"]
COUNTED = pa.schema([("h", pa.int64()), ("w", pa.int64()), ("level", pa.int32()), ("c", pa.int64()), ("part", pa.int64()), ("bits", pa.binary())])


def gathered(blobs: list, columns: int) -> np.ndarray:
    """One row for each column of such buffers together, filled in one by one."""
    halves = [np.frombuffer(blob, dtype=np.uint32).reshape(columns, 2, -1) for blob in blobs]
    found = np.empty((columns, sum(half.shape[2] for half in halves), 2), dtype=np.uint32)
    start = 0
    for half in halves:
        found[:, start : start + half.shape[2]] = half.transpose(0, 2, 1)
        start += half.shape[2]
    return found.view(np.int64)[:, :, 0]


def _items(pairs: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    return pairs.astype(np.uint64) + (np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, dtype=np.uint64))


def unary(pairs: np.ndarray, level: np.ndarray, base: int) -> np.ndarray:
    """The entries of pairs in a filter that holds the levels from ``base``."""
    times = np.maximum(level - max(base, 1) + 1, 1)
    rank = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(level > 0, times)
    return _items(np.repeat(pairs, times), rank)


def pair_counts(docs: DataFrame, vocabulary, parts: int) -> DataFrame:
    """Codes ``h``, ``w`` and ``level`` of all pairs, in the order of their ids, and ``c``, the count of w if it is frequent.
    Counted within slices first, so a very common pair is few entries; then part by part. One more row of each part,
    without codes, has the filter of the part's pairs of frequent words in ``part``, ``bits``."""
    words: list[np.ndarray] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(unpacked(vocabulary.value))
        for batch in batches:
            for _, data, offsets in slices(batch, "text"):
                tokens = Tokens(data, offsets)
                h, w = known.neighbours(tokens, known.places(tokens.hashes))
                pairs = pair_ids(h, w)
                order = np.argsort(pairs)
                pairs = pairs[order]
                starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
                first = order[starts]
                yield from dealt(pairs[starts], parts, 0, [h[first], w[first], np.diff(np.append(starts, len(pairs)))])

    def count(rows: pa.Table) -> pa.Table:
        h, w, n = gathered([blob.as_buffer() for blob in rows.column("packed")], 3)
        ids = pair_ids(h, w)
        order = np.argsort(ids)
        ids = ids[order]
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        level = (np.frexp(np.add.reduceat(n[order], starts).astype(np.float64))[1] - 1).astype(np.int32)
        order, ids = order[starts], ids[starts]
        frequent = ids < MIXED
        entered = unary(ids[frequent], level[frequent].astype(np.int64), 0)
        filled = bloom.filled(entered, bloom.blocks_for(len(entered)))
        if not words:
            # A task's copy of the function counts part after part.
            words.append(unpacked(vocabulary.value)["counts"])
        h, w = h[order], w[order]
        rare = w >= RARE
        c = pa.array(np.append(words[0], 0)[np.where(rare, -1, w)], mask=rare)
        one = {"h": [None], "w": [None], "level": [None], "c": [None], "part": [rows.column("part")[0].as_py()], "bits": [filled.tobytes()]}
        none = pa.nulls(len(order))
        found = pa.concat_tables([
            pa.table({"h": h, "w": w, "level": level, "c": c, "part": none.cast(pa.int64()), "bits": none.cast(pa.binary())}, COUNTED),
            pa.table(one, COUNTED),
        ])
        del h, w, n, c, rare, order, rows, ids, entered
        release()
        return found

    return docs.select("text").mapInArrow(releasing(run), DEALT).groupBy("part").applyInArrow(count, "h long, w long, level int, c long, part long, bits binary")


def coded_counts(counted: DataFrame, vocabulary) -> DataFrame:
    """``code``, ``n`` of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(unpacked(vocabulary.value))
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(known.codes(hashes, known.places(hashes))), batch.column(1)], ["code", "n"])

    return counted.select("hash", "n").mapInArrow(run, "code long, n long")


def with_words(pairs: DataFrame, coded: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """``h``, ``w``, ``level``, and ``c``, the count of w: of frequent words, which have it, and of rare ones. Only rare
    words are joined, so no key has many rows; these pairs are stored in ``folder``, as they are read repeatedly. Runs a job."""
    words = coded.where(F.col("code") >= RARE).select(F.col("code").alias("w"), F.col("n").alias("c"))
    rare = pairs.where(F.col("w") >= RARE).select("h", "w", "level").join(words, "w").select("h", "w", "level", "c")
    return pairs.where(F.col("w") < RARE).select("h", "w", "level", "c"), stored(rare, folder)


def contexts(priced: DataFrame, coded: DataFrame, total: int) -> DataFrame:
    """``h``, ``c``, ``shrink``, ``backoff`` (log10) of all contexts. ``total``: N + V + 1."""
    amount = F.when(F.col("level") > 0, F.pow(F.lit(2.0), "level") * MIDDLE).otherwise(1.0)
    sums = priced.groupBy("h").agg(F.sum(amount).alias("taken"), F.sum((F.col("c") + 1) / F.lit(float(total))).alias("single"), F.count("*").alias("words"))
    words = coded.select(F.col("code").alias("h"), F.col("n").alias("c"))
    share = F.col("taken") / F.col("c")
    # Middles of levels can add up to more than the context has.
    shrink = F.least(F.lit(1.0), F.col("c") / (F.col("c") + F.col("words")) / share)
    left = F.greatest(1 - share * shrink, F.lit(1e-12)) / F.greatest(1 - F.col("single"), F.lit(1e-3))
    return sums.join(words, "h").select("h", "c", F.log10(shrink).alias("shrink"), F.log10(left).alias("backoff"))


def entries(sizes: dict[int, int], base: int) -> int:
    """What the filter holds of so many pairs of each level if it holds the levels from ``base``."""
    return sum(n * max(1, level - max(base, 1) + 1) for level, n in sizes.items() if level >= base)


def count_filter(kept: DataFrame, base: int, size: int) -> np.ndarray:
    """The filter over the levels of ``h``, ``w``, ``level``, with ``size`` entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = pair_ids(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            items = unary(pairs, batch.column(2).to_numpy().astype(np.int64), base)
            yield pa.RecordBatch.from_arrays([pa.array(items.view(np.int64))], ["item"])

    return bloom.build(kept.select("h", "w", "level").mapInArrow(run, "item long"), bloom.blocks_for(size))


def levels(pairs: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """The level of each pair, by probes for one level after the other; 0 if the filter holds none."""
    found = np.zeros(len(pairs), dtype=np.int64)
    left = np.flatnonzero(pairs >= 0)
    level = 1
    while len(left):
        left = left[bloom.contains(_items(pairs[left], level), filled)]
        found[left] = level
        level += 1
    return found


def met(pairs: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The level of each pair in a filter that holds all levels, and whether the pair is there at all."""
    level = levels(pairs, filled)
    there = level > 0
    rest = np.flatnonzero(~there)
    there[rest[bloom.contains(_items(pairs[rest], 0), filled)]] = True
    return level, there


def log_total(model: dict[str, np.ndarray]) -> float:
    """Log10 of what the words' own probabilities are shares of."""
    return float(np.log10(model["n"][0] + model["v"][0] + 1))


def weights(arrays: dict[str, np.ndarray]) -> np.ndarray:
    """Log10 of what an occurrence of a pair is worth after each frequent word."""
    return arrays["shrink"] - np.log10(np.maximum(arrays["counts"], 1))


def joined_counts(before_frequent: DataFrame, before_rare: DataFrame, coded: DataFrame, found: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """What is neither broadcast nor in the parts' filters: ``key`` and ``gain``, in single precision for a small shuffle.
    The pairs come as ``with_words`` gives them.

    Keys are codes of rare words and their complements, for words whose pair the filter knows, both with the word's
    count, which is less than 2^24; codes of rare contexts with the sign bit, with what they add to a score; and ids
    of pairs, which put the pair's probability in place of the word's own.
    """
    base, none = int(model["base"][0]), log_total(model)
    sent = coded.sparkSession.sparkContext.broadcast(packed({name: model[name] for name in ("counts", "shrink", "backoff")}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = unpacked(sent.value)
        gains = np.append(weights(arrays) - arrays["backoff"], 0.0)
        for batch in batches:
            h, w, level, c = (column.to_numpy() for column in batch.columns)
            gain = worth(level) - np.log10(c + 1.0) + none + gains[np.where(h < RARE, h, -1)]
            yield pa.RecordBatch.from_arrays([pa.array(pair_ids(h, w)), pa.array(h), pa.array(gain)], ["key", "h", "gain"])

    rare = F.col("h") >= RARE
    shape = "key long, h long, gain double"
    after_frequent = before_rare.where(~rare & (F.col("level") < base)).mapInArrow(run, shape)
    rare_contexts = found.where(rare)
    gain = F.col("gain") + F.col("shrink") - F.log10("c") - F.col("backoff")
    after_rare = before_frequent.where(rare).unionByName(before_rare.where(rare)).mapInArrow(run, shape).join(rare_contexts, "h")
    words = coded.where(F.col("code") >= RARE)
    columns = lambda key, gain: [key.alias("key"), gain.cast("float").alias("gain")]
    parts = [
        words.select(*columns(F.col("code"), F.col("n"))),
        words.select(*columns(F.bitwise_not("code"), F.col("n"))),
        rare_contexts.select(*columns(F.col("h").bitwiseXOR(F.lit(SIGN)), F.col("backoff"))),
        after_rare.select(*columns(F.col("key"), gain)),
        after_frequent.select(*columns(F.col("key"), F.col("gain"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def parts_for(n: int) -> int:
    return max(1, -(-n // PART))


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to tables of about ``TOLD`` rows, which make fewer and longer rows of each part."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= TOLD:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def widened(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """The batch with nulls in the columns of the schema that it does not have."""
    own = set(batch.schema.names)
    return pa.RecordBatch.from_arrays([batch.column(one.name) if one.name in own else pa.nulls(len(batch), one.type) for one in schema], schema=schema)


def answered(asks: DataFrame, joined: DataFrame, filters: DataFrame, model: dict[str, np.ndarray], groups: int) -> DataFrame:
    """What ``joined`` and the parts' ``filters`` answer to the ``asks`` (kind 1), part by part. A task holds the filter and the
    sorted table of one part; what is asked streams by. Out of all its parts a task adds up the answers to each row, and
    deals ``row``, ``known``, ``single``, ``model`` to groups by the row; texts (kind 2) go to the same groups unchanged."""
    parts, below, none = parts_for(int(model["n"][0])), int(model["base"][0]) - 1, log_total(model)
    sent = asks.sparkSession.sparkContext.broadcast(packed({name: model[name] for name in ("counts", "shrink", "backoff")}))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in together(batches):
            key, gain = (column.to_numpy() for column in some.columns)
            yield from dealt(key, parts, 0, [key, gain.view(np.int32).astype(np.int64)])

    def found(asking: list, blobs: list, filled: np.ndarray | None, table: list, arrays: tuple) -> Iterator[tuple[np.ndarray, ...]]:
        logs, after, backoff = arrays
        if not table:
            keys, bits = gathered(blobs, 2)
            order = np.argsort(keys)
            table += [keys[order], bits[order].astype(np.int32).view(np.float32).astype(np.float64)]
            blobs.clear()
        asked, row = gathered(asking, 2)
        both = (asked >= 0) & (asked < MIXED)
        if filled is not None and both.any():
            pairs = asked[both]
            level, hit = met(pairs, filled)
            # Higher levels are in the filter that was asked before.
            pairs, level = pairs[hit], np.minimum(level[hit], below)
            h, w = pairs >> 32, pairs & 0xFFFFFFFF
            gain = np.minimum(worth(level) + after[h], 0) - logs[w] + none - backoff[h]
            yield row[both][hit], np.zeros(len(gain), dtype=np.int64), np.zeros(len(gain)), gain
        asked, row = asked[~both], row[~both]
        at = np.searchsorted(table[0], asked)
        at[at == len(table[0])] = 0
        hit = table[0][at] == asked if len(table[0]) else np.zeros(len(asked), dtype=bool)
        asked, gain = asked[hit], table[1][at[hit]]
        # A word's code is positive, its complement is negative; both have the other bits of a code.
        word = asked >= RARE
        either = word | (asked < -RARE)
        log = np.log10(np.where(either, gain, 0.0) + 1)
        yield row[hit], either.astype(np.int64), np.where(either, log, 0.0), np.where(word, log, np.where(either, 0.0, gain))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = unpacked(sent.value)
        known = np.log10(arrays["counts"] + 1.0), weights(arrays), arrays["backoff"]
        part, blobs, table, filled = -1, [], [], None
        asking, size = [], 0
        sums, schema = Sums(), None

        def given(row: np.ndarray, count: np.ndarray, single: np.ndarray, gain: np.ndarray) -> Iterator[pa.RecordBatch]:
            for one in dealt(row, groups, 1, [row, count, single.view(np.int64), gain.view(np.int64)]):
                yield widened(one, schema)

        def told() -> Iterator[pa.RecordBatch]:
            nonlocal asking, size
            if size:
                for one in found(asking, blobs, filled, table, known):
                    for full in sums.add(*one):
                        yield from given(*full)
            asking, size = [], 0

        for batch in batches:
            schema, kinds = batch.schema, batch.column("kind").to_numpy()
            if (kinds == 2).any():
                texts = batch.filter(pa.array(kinds == 2))
                group = mix(texts.column("row").to_numpy().view(np.uint64)) % np.uint64(groups)
                yield texts.set_column(schema.get_field_index("part"), schema.field("part"), pa.array(group.astype(np.int64)))
            for own, kind, blob in zip(batch.column("part").to_pylist(), kinds.tolist(), batch.column("packed"), strict=True):
                if own != part:
                    yield from told()
                    part, blobs, table, filled = own, [], [], None
                if kind < 0:
                    filled = np.frombuffer(blob.as_buffer(), dtype=np.uint8)
                elif kind == 0:
                    blobs.append(blob.as_buffer())
                elif kind == 1:
                    asking.append(blob.as_buffer())
                    size += len(asking[-1]) // 16
                    if size >= ASKED:
                        yield from told()
            # What is held of a batch goes with it.
            yield from told()
        for full in sums.rest():
            yield from given(*full)

    tells = joined.select("key", "gain").mapInArrow(tell, DEALT)
    every = tells.unionByName(filters.select("part", F.lit(-1).alias("kind"), F.col("bits").alias("packed")))
    both = asks.unionByName(every, allowMissingColumns=True)
    return both.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(releasing(find), asks.schema)


def finished(answers: DataFrame) -> DataFrame:
    """The texts of ``answered`` with ``more_known``, ``more_single``, ``more_model``, the sums of their answers. A task holds the
    texts of a group and their sums; the answers stream by. Equal texts of one id have one row; each of them has asked."""
    shape = answers.drop("part", "kind", "packed", "row").schema
    names = list(shape.names)

    def given(texts: list[pa.RecordBatch], sums: tuple[np.ndarray, ...] | None) -> Iterator[pa.RecordBatch]:
        for one in texts:
            more = [np.zeros(len(one), dtype=np.int64), np.zeros(len(one)), np.zeros(len(one))]
            if sums is not None:
                rows, copies, *added = sums
                at = np.searchsorted(rows, one.column("row").to_numpy())
                more = [added[0][at] // copies[at], added[1][at] / copies[at], added[2][at] / copies[at]]
            yield pa.RecordBatch.from_arrays([*[one.column(name) for name in names], *map(pa.array, more)], [*names, "more_known", "more_single", "more_model"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, texts, sums = -1, [], None
        for batch in batches:
            if not len(batch):
                continue
            groups, kinds = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
            cuts = (np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist()
            for begin, until in zip([0, *cuts], [*cuts, len(groups)], strict=True):
                if groups[begin] != group:
                    yield from given(texts, sums)
                    group, texts, sums = groups[begin], [], None
                first = begin + int((kinds[begin:until] == 2).sum())
                if first > begin:
                    texts.append(batch.slice(begin, first - begin))
                for blob in batch.column("packed").slice(first, until - first):
                    if sums is None:
                        rows, copies = np.unique(np.concatenate([one.column("row").to_numpy() for one in texts]), return_counts=True)
                        sums = rows, copies, np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows)), np.zeros(len(rows))
                    row, known, single, model = gathered([blob.as_buffer()], 4)
                    # A row is in a buffer once.
                    at = np.searchsorted(sums[0], row)
                    sums[2][at] += known
                    sums[3][at] += single.view(np.float64)
                    sums[4][at] += model.view(np.float64)
        yield from given(texts, sums)

    shape = shape.add("more_known", "long").add("more_single", "double").add("more_model", "double")
    return answers.repartition("part").sortWithinPartitions("part", F.desc("kind")).mapInArrow(releasing(run), shape)


def _release(spark: SparkSession) -> None:
    """Lets Spark delete the files of shuffles whose results are stored; it does so when the driver collects garbage."""
    spark.sparkContext._jvm.System.gc()


def learn(texts: DataFrame) -> tuple[tuple[DataFrame, DataFrame], dict[str, np.ndarray]]:
    """From ``text`` (bytes): the table of what has to be joined and that of the parts' filters, and the model's arrays.
    Runs jobs."""
    spark = texts.sparkSession
    folders = [new_folder(spark) for _ in range(4)]
    counted = stored(word_counts(texts), folders[0])
    whole = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = whole["n"], whole["v"]
    common = counted.where(F.col("n") * FREQUENT >= n).toArrow()
    hashes = common.column("hash").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    counts = common.column("n").to_numpy().astype(np.int64)[order]
    model = {"hashes": hashes[order], "counts": counts}
    sent = spark.sparkContext.broadcast(packed(model))
    both = stored(pair_counts(texts, sent, parts_for(n)), folders[1])
    pairs = both.where(F.col("h").isNotNull()).select("h", "w", "level", "c")
    filters = stored(both.where(F.col("bits").isNotNull()).select("part", "bits"))
    _release(spark)
    coded = coded_counts(counted, sent)
    priced = with_words(pairs, coded, folders[2])
    found = stored(contexts(priced[0].unionByName(priced[1]), coded, n + v + 1), folders[3])
    shrink, backoff = np.zeros(len(counts)), np.zeros(len(counts))
    table = found.where(F.col("h") < RARE).select("h", "shrink", "backoff").toArrow()
    at = table.column("h").to_numpy().astype(np.int64)
    shrink[at], backoff[at] = table.column("shrink").to_numpy(), table.column("backoff").to_numpy()
    after_frequent = pairs.where(F.col("h") < RARE)
    sizes = {row["level"]: row["count"] for row in after_frequent.groupBy("level").count().collect()}
    base = next(base for base in range(65) if entries(sizes, base) <= PAIRS)
    filled = count_filter(after_frequent.where(F.col("level") >= base), base, entries(sizes, base))
    model |= {"backoff": backoff, "shrink": shrink, "filter": filled, "base": np.array([base]), "n": np.array([n]), "v": np.array([v])}
    _release(spark)
    joined = stored(joined_counts(*priced, coded, found, model))
    # The shuffles of these joins and what they read are not needed beside those of the scoring.
    for one, folder in zip((counted, both, priced[1], found), folders, strict=True):
        emptied(one, folder)
    _release(spark)
    return (joined, filters), model


def score(docs: DataFrame, joined: tuple[DataFrame, DataFrame], model: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of ``doc_id``, ``text`` (bytes).

    One pass over the texts sums what the broadcast tables know and deals the keys of what they do not to the parts of what
    ``learn`` returns. Texts go the same way, so that nothing of this is stored, and meet the sums of their answers.
    """
    parts, groups = parts_for(int(model["n"][0])), max(GROUPS, -(-docs.count() // GROUP))
    sent = docs.sparkSession.sparkContext.broadcast(packed(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = unpacked(sent.value)
        known, filled, base = Vocabulary(arrays), arrays["filter"], int(arrays["base"][0])
        logs = np.log10(arrays["counts"] + 1.0)
        after = weights(arrays)
        held, size, schema = [], 0, None

        def asks() -> Iterator[pa.RecordBatch]:
            keys, row = (np.concatenate(arrays) for arrays in zip(*held, strict=True))
            for one in dealt(keys, parts, 1, [keys, row]):
                yield widened(one, schema)

        for batch in batches:
            ids = [("row", pa.int64()), ("doc_id", batch.column("doc_id").type)]
            schema = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("packed", pa.binary()), *ids, *[(name, pa.int64()) for name in COUNTS], *[(name, pa.float64()) for name in SUMS]])
            for rows, data, offsets in slices(batch, "text"):
                tokens = Tokens(data, offsets)
                places = known.places(tokens.hashes)
                before, codes = known.neighbours(tokens, places)
                pairs = pair_ids(before, codes)
                frequent, some = places >= 0, before < RARE
                single = np.zeros(len(places))
                single[frequent] = logs[places[frequent]]
                model_part = single.copy()
                model_part[some] += arrays["backoff"][before[some]]
                different, back = np.unique(np.where(some, pairs, -1), return_inverse=True)
                level = levels(different, filled)[back]
                seen = level > 0
                level[seen] += max(base, 1) - 1
                if base == 0:
                    rest = np.flatnonzero(some & ~seen)
                    seen[rest[bloom.contains(_items(pairs[rest], 0), filled)]] = True
                # A pair that the filter takes for its own may stand for more than its context has.
                model_part[seen] = np.minimum(worth(level[seen]) + after[before[seen]], 0)
                add = lambda x: np.add.reduceat(x, tokens.starts)
                asked = np.stack([~frequent, ~some, ~seen & (~some | (base > 0))], axis=1)
                keys = np.stack([np.where(seen, ~codes, codes), before ^ SIGN, pairs], axis=1)[asked]
                row = rows.column("row").to_numpy()
                held.append((keys, np.repeat(row, add(asked.sum(axis=1)))))
                size += len(keys)
                if size >= ANSWERS // 2:
                    yield from asks()
                    held, size = [], 0
                to = [pa.array((mix(row.view(np.uint64)) % np.uint64(parts)).astype(np.int64)), pa.array(np.full(len(row), 2, dtype=np.int32))]
                columns = [tokens.sizes, add(frequent.astype(np.int64)), add(seen.astype(np.int64)), add(single), add(model_part)]
                found = [*to, rows.column("row"), rows.column("doc_id"), *map(pa.array, columns)]
                yield widened(pa.RecordBatch.from_arrays(found, ["part", "kind", "row", "doc_id", *COUNTS, *SUMS]), schema)
        if size:
            yield from asks()

    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = [f"{DEALT}, row long, doc_id {kind}", *[f"{name} long" for name in COUNTS], *[f"{name} double" for name in SUMS]]
    asked = docs.select("doc_id", row_key("doc_id", "text").alias("row"), "text").mapInArrow(releasing(run), ", ".join(shape))
    n = int(model["n"][0])
    none = F.lit(log_total(model))
    both = lambda own, more: F.col(own) + F.col(more)
    return finished(answered(asked, *joined, model, groups)).select(
        "doc_id", "n_tokens", both("n_frequent", "more_known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (both("single", "more_single") - F.col("n_tokens") * none).alias("base_score"),
        (both("model", "more_model") - (F.col("n_tokens") - F.col("n_seen")) * none).alias("score"),
    )


def score_corpus(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learns from the documents that are not held out (``held_out`` is a condition on ``doc_id``) and scores all."""
    texts = docs.select("doc_id", text_bytes().alias("text"))
    held = F.coalesce(held_out, F.lit(False))
    joined, model = learn(texts.where(~held).select("text"))
    scored = score(texts, joined, model)
    return scored.select("doc_id", held.alias("held_out"), *[name for name in scored.columns if name != "doc_id"])
