"""Words of whole texts in tasks: spans and 64-bit hashes of all words of many documents in one NumPy pass.

A word is a run of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 is the same as a run of code points
other than those. Hashes are polynomials modulo 2**64 with an avalanche step; equal words have equal hashes,
different words collide with a chance of about 2**-64.
"""

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts of so many bytes are worked on together; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def text_bytes(column: str = "text") -> Column:
    """The UTF-8 bytes of a text; a null text is an empty one."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def row_key(*columns: str) -> Column:
    """One long for rows that are equal in these columns, for joins back to them."""
    return F.xxhash64(*columns)


def release() -> None:
    """Gives the worker's free memory back to the system: an idle worker keeps it otherwise."""
    _powers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def releasing(run):
    """The map, which gives its worker's free memory back when a task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < size:
        steps = np.full(max(size, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if size <= SLICE_BYTES + 1:
            _powers[name] = known
    return known[:size]


class Words:
    """All words of some documents. ``starts`` and ``ends`` are byte places in ``data``; the words of document
    d are those from ``first[d]`` to ``first[d + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        if lower:
            data = data + ((data - np.uint8(65)) < 26).view(np.uint8) * np.uint8(32)
        self.data, self.offsets = data, offsets
        inside = (data != 0x20) & ((data - np.uint8(0x09)) > 0x0D - 0x09)
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        # A word ends with its document even if the next document begins with a word.
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        starts[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self._sums = None

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def documents(self) -> np.ndarray:
        """The place of each word's document."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """The hash of each word, or of its first bytes."""
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            own = np.add(self.data, 1, dtype=np.uint64)
            np.multiply(own, _power("base", _BASE, len(self.data)), out=own)
            np.cumsum(own, out=self._sums[1:])
        ends = self.ends if prefix is None else np.minimum(self.ends, self.starts + prefix)
        if not len(self):
            return np.zeros(0, dtype=np.uint64)
        return mix((self._sums[ends] - self._sums[self.starts]) * _power("inverse", _INVERSE, len(self.data))[self.starts])


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with about ``size`` bytes of the binary column: the part, its bytes and the offsets."""
    place = batch.schema.get_field_index(column)
    array = batch.column(place)
    width = np.int64 if pa.types.is_large_binary(array.type) else np.int32
    if not len(array):
        return
    offsets = np.frombuffer(array.buffers()[1], dtype=width)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(array.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(array):
        until = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        until = min(until, len(array))
        yield batch.slice(row, until - row), data[offsets[row] : offsets[until]], offsets[row : until + 1] - offsets[row]
        row = until
