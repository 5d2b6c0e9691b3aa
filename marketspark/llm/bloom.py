"""Bloom filters of 64-bit items that tasks fill block by block."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketspark.llm.words import mix

BITS = 12
PROBES = 6
#: Bits of a block; all bits of an item are in one block.
BLOCK = 1 << 20
#: Items that a task deals to blocks at once.
TOLD = 1 << 18


def blocks_for(items: int, most: int | None = None) -> int:
    """Blocks for so many items, ``most`` at most: beyond that the filter takes more items for its own."""
    blocks = max(1, -(-items * BITS // BLOCK))
    return blocks if most is None else min(blocks, most)


def _positions(items: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each item, and a number from which its bits in the block follow."""
    key = mix(items)
    return (key % np.uint64(blocks)).astype(np.int64), mix(key + np.uint64(1))


def _bit(spread: np.ndarray, probe: int) -> np.ndarray:
    step = (spread >> np.uint64(32)) | np.uint64(1)
    return ((spread & np.uint64(0xFFFFFFFF)) + step * np.uint64(probe)) & np.uint64(BLOCK - 1)


def build(items: DataFrame, blocks: int) -> np.ndarray:
    """The filter over the column ``item``, as bytes. Blocks are filled by tasks, as a stream; the driver receives
    the finished blocks. Runs a job."""

    def dealt(held: list[np.ndarray]) -> pa.RecordBatch:
        """A row for each block, with what its items' bits follow from one behind the other."""
        block, spread = _positions(np.concatenate(held).view(np.uint64), blocks)
        order = np.argsort(block.astype(np.uint16 if blocks <= 1 << 16 else np.int64), kind="stable")
        block, spread = block[order], spread[order]
        starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        spreads = [spread[begin:end].tobytes() for begin, end in zip(starts, [*starts[1:], len(block)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(block[starts]), pa.array(spreads, pa.binary())], ["block", "spreads"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            size += len(batch)
            if size >= TOLD:
                yield dealt(held)
                held, size = [], 0
        if size:
            yield dealt(held)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled: dict[int, np.ndarray] = {}
        for batch in batches:
            for one, spreads in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if one not in filled:
                    if len(filled) > 64:
                        # More blocks than fit are given out as they are; parts of a block are put together later.
                        yield _given(filled)
                        filled = {}
                    filled[one] = np.zeros(BLOCK, dtype=bool)
                own = np.frombuffer(spreads.as_buffer(), dtype=np.uint64)
                for probe in range(PROBES):
                    filled[one][_bit(own, probe)] = True
        yield _given(filled)

    by_block = items.select("item").mapInArrow(deal, "block long, spreads binary").repartition("block").sortWithinPartitions("block")
    whole = np.zeros(blocks * BLOCK // 8, dtype=np.uint8)
    for row in by_block.mapInArrow(fill, "block long, bits binary").collect():
        start = row["block"] * BLOCK // 8
        whole[start : start + BLOCK // 8] |= np.frombuffer(row["bits"], dtype=np.uint8)
    return whole


def _given(filled: dict[int, np.ndarray]) -> pa.RecordBatch:
    bits = [np.packbits(x, bitorder="little").tobytes() for x in filled.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(filled), pa.int64()), pa.array(bits, pa.binary())], ["block", "bits"])


def filled(items: np.ndarray, blocks: int) -> np.ndarray:
    """The filter over items at hand, as bytes."""
    block, spread = _positions(items.view(np.uint64), blocks)
    bits = np.zeros(blocks * BLOCK, dtype=bool)
    for probe in range(PROBES):
        bits[block * BLOCK + _bit(spread, probe).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def contains(items: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Places of the items that the filter takes for its own."""
    left = np.arange(len(items))
    block, spread = _positions(items, len(filled) // (BLOCK // 8))
    # Bits are counted modulo a power of two below 2^32, so halves are enough for them.
    begin, bit, step = block * (BLOCK // 8), spread.astype(np.uint32), (spread >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    for _ in range(PROBES):
        own = bit & np.uint32(BLOCK - 1)
        hit = np.flatnonzero((filled[begin + (own >> np.uint32(3))] >> (own & np.uint32(7)).astype(np.uint8)) & np.uint8(1))
        left, begin, step = left[hit], begin[hit], step[hit]
        bit = bit[hit] + step
    return left
