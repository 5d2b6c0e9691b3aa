"""Substring deduplication: words of windows that also start in a document of smaller id are removed.

A window is ``WINDOW`` consecutive words. Its anchor is the run of ``ANCHOR`` words in it with the smallest hash, so equal
windows have equal anchors wherever they stand. Neighbouring windows with the same anchor form a segment, and a
segment's text is all that its anchor's other occurrences must be compared with: documents are streamed to the
shard of each anchor instead of to all shards.

1. Anchors are counted over the whole corpus. Those that occur once need no further look. The others, and those
   among them that have different segments, go into two Bloom filters of bounded size; what a full filter lets
   through too much costs time and changes nothing.
2. A second pass over the texts emits the segments of repeated anchors. Segments of the same words are one text
   with its smallest id.
3. A shard holds the different segments of its anchors in a compressed FM-index over a wavelet matrix. Each window
   is searched backwards over its full length; the smallest id in its range of suffixes says whether the window
   starts in an earlier document. An anchor with more than ``HOT`` different segments is not put into one shard:
   its windows are grouped by hash and the smallest id is taken of each group.
4. The windows found come back to their documents, and the words that they cover are removed.

Nothing is removed on account of a document with the same id or a null id, and nothing from a document without an
id. Repeated rows give repeated results; a null text has no words; an empty table gives an empty one.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm import bloom
from marketspark.llm.fm_index import Index
from marketspark.llm.training import packed, unpacked
from marketspark.llm.words import _BASE, _INVERSE, Words, _power, mix, releasing, row_key, slices, text_bytes
from marketspark.operators.projections import unused
from marketspark.sources.scratch import stored

WINDOW = 13
ANCHOR = 5
HOT = 256
#: Blocks of a filter, 128 KiB each.
MOST_BLOCKS = 256
#: Words of one index; an anchor's segments are never cut apart.
SHARD_WORDS = 1 << 18
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


class Segments:
    """The segments of some documents: their first word, number of windows, anchor and hash."""

    def __init__(self, words: Words, window: int = WINDOW, anchor: int = ANCHOR):
        self.words = words
        n = len(words)
        ends = np.repeat(words.first[1:], words.counts())
        hashes = words.hashes()
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * _power("base", _BASE, n), out=sums[1:])
        back = _power("inverse", _INVERSE, n)
        places = np.arange(n)
        grams = np.full(n, _NEVER, dtype=np.uint64)
        some = np.flatnonzero(places + anchor <= ends)
        grams[some] = mix((sums[some + anchor] - sums[some]) * back[some])
        windows = np.flatnonzero(places + window <= ends)
        at = _smallest(grams, window - anchor + 1)[windows] if len(windows) else windows
        new = np.ones(len(windows), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)
        begins = np.flatnonzero(new)
        self.start = windows[begins]
        self.n = np.diff(np.append(begins, len(windows)))
        self.end = self.start + self.n + window - 1
        self.anchor = (grams[at[begins]] & np.uint64((1 << 48) - 1)).view(np.int64)
        self.hash = mix((sums[self.end] - sums[self.start]) * back[self.start]).view(np.int64)
        self.document = np.searchsorted(words.first, self.start, side="right") - 1


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of the ``width`` values from each place on, the first of equal ones."""
    least, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        first = least[:-step] <= least[step:] if step < len(least) else np.zeros(0, dtype=bool)
        m = len(first)
        least = np.where(first, least[:m], least[step:])
        at = np.where(first, at[:m], at[step:])
        have += step
    return np.append(at, np.zeros(len(values) - len(at), dtype=np.int64))


def anchors(texts: DataFrame) -> DataFrame:
    """``anchor``, ``n``, ``varied``: how often each anchor occurs and whether its segments differ. Counted in the
    tasks first, so that a common passage is few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in slices(batch, "text"):
                found = Segments(Words(data, offsets))
                yield pa.RecordBatch.from_arrays([pa.array(found.anchor), pa.array(found.hash)], ["anchor", "segment"])

    found = texts.select("text").mapInArrow(run, "anchor long, segment long")
    counted = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("segment").alias("low"), F.max("segment").alias("high"))
    return counted.where("n > 1").select("anchor", "n", (F.col("low") != F.col("high")).alias("varied"))


def members(texts: DataFrame, filters) -> DataFrame:
    """``anchor``, ``segment``, ``row``, ``doc_id``, ``start``, ``n``, ``words``: the segments of repeated anchors. The words
    come along where an anchor's segments differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = unpacked(filters.value)
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                found = Segments(Words(data, offsets))
                keep = bloom.contains(found.anchor.view(np.uint64), arrays["repeated"])
                varied = np.zeros(len(found.anchor), dtype=bool)
                varied[bloom.contains(found.anchor.view(np.uint64), arrays["varied"])] = True
                first, last = found.words.starts[found.start], found.words.ends[found.end - 1]
                whole = data.tobytes()
                texts = [b" ".join(whole[first[k] : last[k]].split()) if varied[k] else None for k in keep]
                document = found.document[keep]
                start = found.start[keep] - found.words.first[document]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.anchor[keep]), pa.array(found.hash[keep]), rows.column("row").take(pa.array(document)), rows.column("doc_id").take(pa.array(document)),
                        pa.array(start.astype(np.int32)), pa.array(found.n[keep].astype(np.int32)), pa.array(texts, pa.binary()),
                    ],
                    ["anchor", "segment", "row", "doc_id", "start", "n", "words"],
                )

    return texts.select("row", "doc_id", "text").mapInArrow(run, "anchor long, segment long, row long, doc_id long, start int, n int, words binary")


def earlier_windows(classes: DataFrame) -> DataFrame:
    """For ``anchor``, ``segment``, ``least``, ``words``: ``anchor``, ``segment``, ``mask``, whose bit k is set if the window k of the
    segment stands in a segment with a smaller id. One FM-index for some anchors at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            # The rows of a partition are in the order of their anchors; the last anchor may go on.
            own = batch.column("anchor").to_numpy()
            for part in np.split(np.arange(len(own)), np.flatnonzero(own[1:] != own[:-1]) + 1):
                if not len(part):
                    continue
                rows = batch.slice(part[0], len(part))
                if size >= SHARD_WORDS and own[part[0]] != held[-1].column("anchor")[-1].as_py():
                    yield _masks(pa.Table.from_batches(held).combine_chunks())
                    held, size = [], 0
                held.append(rows)
                size += 20 * len(part)
        if held:
            yield _masks(pa.Table.from_batches(held).combine_chunks())

    sharded = classes.select("anchor", "segment", "least", "words").repartition("anchor").sortWithinPartitions("anchor")
    return sharded.mapInArrow(run, "anchor long, segment long, mask long")


def _masks(rows: pa.Table) -> pa.RecordBatch:
    texts = rows.column("words").to_pylist()
    least = rows.column("least").to_numpy()
    words = Words(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)]))
    numbers = np.unique(words.hashes(), return_inverse=True)[1].astype(np.int64) + 1
    counts = words.counts()
    # A 0 behind each text.
    symbols = np.zeros(len(numbers) + len(counts), dtype=np.int64)
    begins = np.cumsum(counts + 1) - (counts + 1)
    symbols[np.arange(len(numbers)) + np.repeat(np.arange(len(counts)), counts)] = numbers
    owner = np.repeat(np.arange(len(counts)), counts + 1)
    index = Index(symbols)
    windows = np.maximum(counts - WINDOW + 1, 0)
    of = np.repeat(np.arange(len(counts)), windows)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = begins[of] + offset
    masks = np.zeros(len(counts), dtype=np.int64)
    ids = np.append(least[owner[index.suffixes]], np.iinfo(np.int64).max)
    for at in range(0, len(starts), 1 << 16):
        part = slice(at, at + (1 << 16))
        low, high = index.search(symbols[starts[part, None] + np.arange(WINDOW)])
        # Equal windows have the same range: its smallest id is looked up once.
        ranges, which = np.unique(low * (index.length + 1) + high, return_inverse=True)
        edges = np.stack([ranges // (index.length + 1), ranges % (index.length + 1)], axis=1).reshape(-1)
        smallest = np.minimum.reduceat(ids, edges)[::2][which]
        hit = smallest < least[of[part]]
        np.bitwise_or.at(masks, of[part][hit], np.int64(1) << offset[part][hit])
    return pa.RecordBatch.from_arrays([rows.column("anchor").combine_chunks(), rows.column("segment").combine_chunks(), pa.array(masks)], ["anchor", "segment", "mask"])


def hot_windows(classes: DataFrame) -> DataFrame:
    """The same answer for anchors with very many segments, by hashes of their windows. No group is collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "words"):
                words = Words(data, offsets)
                hashes, counts = words.hashes(), words.counts()
                sums = np.zeros(len(words) + 1, dtype=np.uint64)
                np.cumsum(hashes * _power("base", _BASE, len(words)), out=sums[1:])
                windows = np.maximum(counts - WINDOW + 1, 0)
                of = np.repeat(np.arange(len(counts)), windows)
                offset = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
                start = words.first[of] + offset
                found = mix((sums[start + WINDOW] - sums[start]) * _power("inverse", _INVERSE, len(words) + 1)[start])
                taken = [rows.column(name).take(pa.array(of)) for name in ("anchor", "segment", "least")]
                yield pa.RecordBatch.from_arrays([*taken, pa.array(offset), pa.array(found.view(np.int64))], ["anchor", "segment", "least", "offset", "window"])

    windows = stored(classes.select("anchor", "segment", "least", "words").mapInArrow(run, "anchor long, segment long, least long, offset long, window long"))
    smallest = stored(windows.groupBy("anchor", "window").agg(F.min("least").alias("smallest")))
    hit = windows.join(smallest, ["anchor", "window"]).where("smallest < least")
    return hit.groupBy("anchor", "segment").agg(F.bit_or(F.expr("shiftleft(1L, cast(offset AS int))")).alias("mask"))


def repeated_windows(texts: DataFrame) -> DataFrame:
    """``row``, ``spans`` of the documents (``row``, ``doc_id``, ``text`` as bytes) from which words are to be removed. A span is
    the place of a segment's first word, times 512, plus the mask of its windows. Runs jobs."""
    known = texts.where("doc_id IS NOT NULL")
    repeated = stored(anchors(known))
    size = repeated.agg(F.count("*").alias("n"), F.count_if("varied").alias("varied")).first()
    filters = {
        "repeated": bloom.build(repeated.select(F.col("anchor").alias("item")), bloom.blocks_for(size["n"], MOST_BLOCKS)),
        "varied": bloom.build(repeated.where("varied").select(F.col("anchor").alias("item")), bloom.blocks_for(size["varied"], MOST_BLOCKS)),
    }
    found = stored(members(known, texts.sparkSession.sparkContext.broadcast(packed(filters))))
    alone = found.where("words IS NULL").groupBy("anchor", "segment").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    alone = alone.where("least < most").select("anchor", "segment", "least", F.lit(0).cast("long").alias("mask"))
    varied = found.where("words IS NOT NULL").groupBy("anchor", "segment").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.first("words").alias("words"))
    varied = stored(varied)
    sizes = stored(varied.groupBy("anchor").agg(F.count("*").alias("segments")).where("segments > 1"))
    sized = varied.join(sizes, "anchor")
    masks = earlier_windows(sized.where(F.col("segments") <= HOT)).unionByName(hot_windows(sized.where(F.col("segments") > HOT)))
    masked = varied.drop("words").join(stored(masks.where("mask != 0")), ["anchor", "segment"], "left")
    masked = masked.withColumn("mask", F.coalesce("mask", F.lit(0).cast("long"))).where("least < most OR mask != 0")
    decided = stored(alone.unionByName(masked.select("anchor", "segment", "least", "mask")))
    hits = found.select("anchor", "segment", "row", "doc_id", "start", "n").join(decided, ["anchor", "segment"])
    whole = F.expr("shiftleft(1L, n) - 1")
    mask = F.when(F.col("doc_id") > F.col("least"), whole).otherwise(F.col("mask"))
    spans = hits.select("row", (F.col("start").cast("long") * 512 + mask).alias("span"), mask.alias("mask")).where("mask != 0")
    return spans.groupBy("row").agg(F.collect_list("span").alias("spans"))


def _kept(n: int, spans: np.ndarray) -> np.ndarray:
    """Which of n words stay."""
    change = np.zeros(n + 1, dtype=np.int64)
    for bit in range(WINDOW - ANCHOR + 1):
        starts = (spans[(spans >> bit) & 1 == 1] >> 9) + bit
        np.add.at(change, starts, 1)
        np.add.at(change, np.minimum(starts + WINDOW, n), -1)
    return np.cumsum(change[:-1]) == 0


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(row_key("doc_id", "text").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` (the kept words joined by one space)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, digest = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_py().split()
                counts.append(len(words))
                if spans.is_valid:
                    words = [words[k] for k in np.flatnonzero(_kept(len(words), spans.values.to_numpy()))]
                removed.append(counts[-1] - len(words))
                digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    texts = _texts(docs)
    joined = texts.join(repeated_windows(texts).hint("shuffle_hash"), "row", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with all their columns and the repeated words cut out of ``text``; ``n_chars`` follows, where there
    is one. What stands between the words that stay is kept."""
    text = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[:-1]
            texts = columns[text].to_pylist()
            for k, spans in enumerate(batch.column(batch.num_columns - 1)):
                if spans.is_valid:
                    data = texts[k].encode()
                    words = Words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
                    stays = np.flatnonzero(_kept(len(words), spans.values.to_numpy()))
                    after = np.append(words.starts[1:], len(data))
                    texts[k] = b"".join(data[words.starts[i] : after[i]] for i in stays).decode().rstrip(" ")
            columns[text] = pa.array(texts, pa.string())
            if chars is not None:
                columns[chars] = pa.array([None if x is None else len(x) for x in texts], pa.int64()).cast(columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    key, spans = unused(docs, "_key"), unused(docs, "_spans")
    found = repeated_windows(_texts(docs)).select(F.col("row").alias(key), F.col("spans").alias(spans)).hint("shuffle_hash")
    joined = docs.withColumn(key, row_key("doc_id", "text")).join(found, key, "left").select(*docs.columns, spans)
    return joined.mapInArrow(releasing(run), docs.schema)
