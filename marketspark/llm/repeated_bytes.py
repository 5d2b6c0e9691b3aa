"""Byte strings that occur more than once are removed: suffix-array deduplication by bounded interval expansion.

A *window* is ``LENGTH`` bytes of one text. Equal windows must meet in one index, wherever they stand; a window's anchor is the
smallest hash of the ``ANCHOR``-byte strings in it, which equal windows share. Neighbouring windows of one anchor form a
*segment*, ``RUN`` windows at most, whose bytes are all that its windows need.

1. Anchors are counted over the whole corpus. Those that occur once hold no repeated window. The others go into a Bloom
   filter of bounded size; what a full filter lets through too much costs time and changes nothing.
2. A second pass emits the segments of repeated anchors. Segments of the same bytes become one text with a weight.
3. A shard holds the segments of some anchors in a Burrows-Wheeler transform, on which ``interval_expansion`` finds the
   windows whose weights add up to two or more.
4. An anchor with more than ``HOT`` different segments would make one shard that grows with the corpus, for example
   where a common passage has different surroundings in every text. Its windows get a longer anchor: all of their bytes.
   Windows that are alone by that are dropped, the others go through indexes like the rest, dealt by the new anchor.
5. The windows found come back to their texts, and the bytes that they cover are removed.

A text is its UTF-8 bytes, a null text none. Ids play no part: texts without id and repeated rows are texts like others, so a
row that is there twice loses all windows. An empty table gives an empty one.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm import bloom
from marketspark.llm.interval_expansion import repeated
from marketspark.llm.substrings import _smallest
from marketspark.llm.training import packed, unpacked
from marketspark.llm.words import _BASE, _INVERSE, _power, mix, row_key, slices, text_bytes
from marketspark.sources.scratch import stored

LENGTH = 200
ANCHOR = 32
#: Windows of one segment, four longs of bits.
RUN = 256
HOT = 1024
#: Bytes of one index; an anchor's segments are never cut apart.
SHARD_BYTES = 1 << 20
#: Blocks of the filter, 128 KiB each.
MOST_BLOCKS = 256
_MASK = ["m0", "m1", "m2", "m3"]


class Segments:
    """The segments of some texts: their first byte, number of windows, anchor and hash, and whether the anchor is in them
    more than once."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
        n = len(data)
        back = _power("inverse", _INVERSE, n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("base", _BASE, n), out=sums[1:])
        windows = np.maximum(np.diff(offsets) - length + 1, 0)
        total = int(windows.sum())
        document = np.repeat(np.arange(len(windows)), windows)
        place = np.arange(total) + np.repeat(offsets[:-1] - (np.cumsum(windows) - windows), windows)
        grams = mix((sums[anchor:] - sums[: max(n + 1 - anchor, 0)]) * back[: max(n + 1 - anchor, 0)])
        at = _smallest(grams, length - anchor + 1)[place] if total else place
        own = grams[at]
        new = np.ones(total, dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (document[1:] != document[:-1])
        begin = np.maximum.accumulate(np.where(new, np.arange(total), 0)) if total else place
        new |= (np.arange(total) - begin) % RUN == 0
        begins = np.flatnonzero(new)
        self.start = place[begins]
        self.n = np.diff(np.append(begins, total))
        self.end = self.start + self.n + length - 1
        self.document = document[begins]
        # Windows of one segment can be equal only if the anchor's first place moves on from one to the other.
        self.inside = at[np.append(begins[1:], total) - 1] != at[begins] if total else at.astype(bool)
        self.anchor = own[begins].view(np.int64)
        self.hash = mix((sums[self.end] - sums[self.start]) * back[self.start]).view(np.int64)


def anchors(texts: DataFrame) -> DataFrame:
    """``item``: the anchors that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in slices(batch, "text"):
                found = Segments(data, offsets)
                yield pa.RecordBatch.from_arrays([pa.array(found.anchor), pa.array(found.inside.astype(np.int64) + 1)], ["item", "n"])

    return texts.select("text").mapInArrow(run, "item long, n long").groupBy("item").agg(F.sum("n").alias("n")).where("n > 1").select("item")


def members(texts: DataFrame, known) -> DataFrame:
    """``anchor``, ``segment``, ``row``, ``start``, ``n``, ``bytes``: the segments of the anchors in a filter. Of equal segments that are
    met together the first has the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = unpacked(known.value)["anchors"]
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                found = Segments(data, offsets)
                keep = bloom.contains(found.anchor.view(np.uint64), bits)
                held = [None] * len(keep)
                whole = data.tobytes()
                for k in np.unique(found.hash[keep], return_index=True)[1]:
                    held[k] = whole[found.start[keep[k]] : found.end[keep[k]]]
                document = found.document[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.anchor[keep]), pa.array(found.hash[keep]), rows.column("row").take(pa.array(document)),
                        pa.array((found.start[keep] - offsets[document]).astype(np.int64)), pa.array(found.n[keep].astype(np.int32)), pa.array(held, pa.binary()),
                    ],
                    ["anchor", "segment", "row", "start", "n", "bytes"],
                )

    return texts.select("row", "text").mapInArrow(run, "anchor long, segment long, row long, start long, n int, bytes binary")


def _indexed(classes: DataFrame) -> DataFrame:
    """For ``anchor``, ``segment``, ``weight``, ``bytes``: ``anchor``, ``segment`` and a mask in four longs, whose bit k is set if the
    window k of the segment occurs again. One index for some anchors at a time."""
    length = LENGTH

    def decided(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        texts = rows.column("bytes").to_pylist()
        sizes = np.array([len(text) for text in texts])
        ends = np.cumsum(sizes + 1) - 1
        symbols = np.zeros(ends[-1] + 1, dtype=np.int64)
        inside = np.ones(len(symbols), dtype=bool)
        inside[ends] = False
        symbols[inside] = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int64) + 1
        again = repeated(symbols, np.repeat(rows.column("weight").to_numpy(), sizes + 1), length)
        bits = np.zeros((len(texts), RUN), dtype=bool)
        text = np.repeat(np.arange(len(texts)), sizes + 1)
        hits = np.flatnonzero(again)
        bits[text[hits], hits - (ends - sizes)[text[hits]]] = True
        masks = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
        some = np.flatnonzero(masks.any(axis=1))
        keys = [rows.column(name).to_numpy()[some] for name in ("anchor", "segment")]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (*keys, *masks[some].T.copy())], ["anchor", "segment", *_MASK])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            # The rows of a partition are in the order of their anchors; the last anchor may go on.
            own = batch.column("anchor").to_numpy()
            sizes = np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy())
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            begin = 0
            for first, until in zip(cuts, cuts[1:]):
                before = int(sizes[first - 1]) if first else 0
                if size + before - (int(sizes[begin - 1]) if begin else 0) >= SHARD_BYTES and own[first] != last:
                    if first > begin:
                        held.append(batch.slice(begin, first - begin))
                    yield decided(held)
                    held, size, begin = [], 0, first
                last = own[until - 1]
            if len(own) > begin:
                held.append(batch.slice(begin, len(own) - begin))
                size += int(sizes[-1]) - (int(sizes[begin - 1]) if begin else 0)
        if held:
            yield decided(held)

    dealt = classes.select("anchor", "segment", "weight", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "anchor long, segment long, " + ", ".join(f"{name} long" for name in _MASK))


def _hot_windows(classes: DataFrame) -> DataFrame:
    """The same for anchors with very many segments, through a longer anchor. Equal windows of a slice of segments are one row
    with all their places, so that a window which is in every segment is joined once for each slice. A slice goes by its
    first segment; one more row of each, without a window, has the keys of its segments."""
    length = LENGTH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "bytes"):
                every = Segments(data, offsets, length, length)
                # With an anchor as long as a window each window that differs from its neighbour is a segment.
                place = np.repeat(every.start, every.n) + np.arange(every.n.sum()) - np.repeat(np.cumsum(every.n) - every.n, every.n)
                document = np.repeat(every.document, every.n)
                window = np.repeat(every.anchor, every.n)
                order = np.argsort(window, kind="stable")
                window, document = window[order], document[order]
                places = (document * RUN + place[order] - offsets[document]).astype(np.int32)
                starts = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
                anchor, segment, weight = (rows.column(name).to_numpy() for name in ("anchor", "segment", "weight"))
                blobs = [places[begin:end].tobytes() for begin, end in zip(starts, [*starts[1:], len(places)], strict=True)]
                one, n = document[starts], len(starts) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, anchor[0])), pa.array(np.full(n, segment[0])),
                        *[pa.array(np.append(x, 0), mask=np.arange(n) == n - 1) for x in (window[starts], np.add.reduceat(weight[document], starts), anchor[one], segment[one], places[starts] % RUN)],
                        pa.array([*blobs, np.stack([anchor, segment]).tobytes()], pa.binary()),
                    ],
                    ["slice_anchor", "slice_segment", "window", "weight", "anchor", "segment", "place", "places"],
                )

    def masks(rows: pa.Table) -> pa.Table:
        hit = rows.column("window").is_valid()
        anchor, segment = np.frombuffer(rows.filter(pc.invert(hit)).column("places")[0].as_buffer(), dtype=np.int64).reshape(2, -1)
        bits = np.zeros(len(anchor) * RUN, dtype=bool)
        for blob in rows.filter(hit).column("places"):
            bits[np.frombuffer(blob.as_buffer(), dtype=np.int32)] = True
        found = np.packbits(bits.reshape(-1, RUN), axis=1, bitorder="little").view(np.int64)
        some = np.flatnonzero(found.any(axis=1))
        return pa.table([pa.array(x) for x in (anchor[some], segment[some], *found[some].T.copy())], ["anchor", "segment", *_MASK])

    shape = "slice_anchor long, slice_segment long, window long, weight long, anchor long, segment long, place long, places binary"
    sliced = stored(classes.select("anchor", "segment", "weight", "bytes").mapInArrow(run, shape))
    windows = sliced.where("window IS NOT NULL")
    again = windows.groupBy("window").agg(F.sum("weight").alias("total"), F.min(F.struct("anchor", "segment", "place")).alias("one")).where("total > 1")
    again = again.select("window", "total", "one.*").join(classes.select("anchor", "segment", "bytes"), ["anchor", "segment"])
    whole = again.select(F.col("window").alias("anchor"), F.col("window").alias("segment"), F.col("total").alias("weight"), F.substring("bytes", F.col("place").cast("int") + 1, F.lit(length)).alias("bytes"))
    found = stored(_indexed(whole).select(F.col("segment").alias("window")))
    columns = ["slice_anchor", "slice_segment", "window", "places"]
    hits = windows.join(found, "window").select(*columns).unionByName(sliced.where("window IS NULL").select(*columns))
    return hits.groupBy("slice_anchor", "slice_segment").applyInArrow(masks, "anchor long, segment long, " + ", ".join(f"{name} long" for name in _MASK))


def repeated_windows(texts: DataFrame) -> DataFrame:
    """``row``, ``spans`` (the start of a segment and its mask) of the texts (``row``, ``text`` as bytes) with repeated windows. Runs
    jobs."""
    many = stored(anchors(texts))
    bits = bloom.build(many, bloom.blocks_for(many.count(), MOST_BLOCKS))
    found = stored(members(texts, texts.sparkSession.sparkContext.broadcast(packed({"anchors": bits}))))
    classes = stored(found.groupBy("anchor", "segment").agg(F.count("*").alias("weight"), F.max("bytes").alias("bytes")))
    sizes = stored(classes.groupBy("anchor").agg(F.count("*").alias("segments")).where(F.col("segments") > HOT).withColumn("hot", F.lit(True)))
    marked = classes.join(sizes.select("anchor", "hot"), "anchor", "left")
    masks = stored(_indexed(marked.where("hot IS NULL")).unionByName(_hot_windows(marked.where("hot"))))
    hits = found.select("anchor", "segment", "row", "start").join(masks, ["anchor", "segment"])
    return hits.groupBy("row").agg(F.collect_list(F.struct("start", *_MASK)).alias("spans"))


def covered(size: int, spans: pa.StructArray | None, length: int = LENGTH) -> np.ndarray:
    """Which of a text's bytes the repeated windows cover."""
    change = np.zeros(size + 1, dtype=np.int64)
    if spans is not None:
        start = spans.field("start").to_numpy()
        masks = np.stack([spans.field(name).to_numpy() for name in _MASK], axis=1)
        segment, place = np.nonzero(np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little"))
        starts = np.unique(start[segment] + place)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + length, -1)
    return np.cumsum(change[:-1]) > 0


def _joined(docs: DataFrame) -> DataFrame:
    texts = docs.select(row_key("doc_id", "text").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    return texts.join(repeated_windows(texts).hint("shuffle_hash"), "row", "left").select("doc_id", "text", "spans")


def _runs(gone: np.ndarray) -> np.ndarray:
    """Begin and end of each maximal run, a row each."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    return edges.reshape(-1, 2)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``kept`` (the bytes that stay; a cut may go through a character) and ``removed``, the spans of the others
    as (begin, end) in bytes of the text. Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = np.frombuffer(text.as_py(), dtype=np.uint8)
                gone = covered(len(data), spans.values if spans.is_valid else None)
                kept.append(data[~gone].tobytes())
                removed.append([{"begin": int(begin), "end": int(end)} for begin, end in _runs(gone)])
            kinds = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(removed, kinds)], ["doc_id", "kept", "removed"])

    return _joined(docs).mapInArrow(run, "doc_id long, kept binary, removed array<struct<begin: long, end: long>>")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                whole = text.as_py()
                if not spans.is_valid:
                    rows.append((len(whole), 0, 0, hashlib.sha256(whole).hexdigest()))
                    continue
                data = np.frombuffer(whole, dtype=np.uint8)
                gone = covered(len(data), spans.values)
                rows.append((len(data), int(gone.sum()), len(_runs(gone)), hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            columns = [pa.array([row[place] for row in rows], pa.string() if place == 3 else pa.int64()) for place in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    return _joined(docs).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
