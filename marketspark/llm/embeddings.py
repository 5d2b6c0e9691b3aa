"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors of unit length have a cosine of at least t exactly if their squared distance is at most 2 - 2t. All are
turned by the same rotation and cut into blocks of a few dimensions. The rotation is fitted on a sample of about
``SAMPLE`` vectors: its axes are the sample's principal axes, dealt to the blocks in turn, so that every block starts
with a wide one. It bears on the work only; any rotation gives the same links. If two vectors are that close,
then in some block their squared distance is at most the block's share of the budget, in proportion to its
dimensions. So every block is joined on its own by range: its first coordinate is cut into slabs as wide as
the block's radius, only neighbouring slabs meet, and inside them distances in the block are compared. The
union of the candidates is verified with the exact cosine in double precision; a pair that several blocks find
counts in the first.

Slabs are split into chunks of bounded size, and pairs of chunks are the tasks' groups, so no group grows with
the data. Equal vectors are one class before the join; a group reports counts of links and a forest over the
linked classes, never all pairs.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, neither do vectors
of different length. Repeated rows are vectors of their own with their own links. A null id is carried along.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.components import components
from marketspark.sources.scratch import stored

THRESHOLD = 0.9
BLOCKS = 4
#: Rows of one side of a group.
CHUNK = 16384
#: Vectors that the rotation is fitted on.
SAMPLE = 4096
#: Added to squared distances of candidates, so that rounding loses none.
SLACK = 1e-5
SEED = 20


def usable(vector: Column) -> Column:
    """Whether a vector can be compared at all."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


class Blocks:
    """The rotation and the blocks for vectors of one length. Without a rotation for the length it is a random one."""

    def __init__(self, size: int, threshold: float, blocks: int, rotations: dict[int, np.ndarray] | None = None):
        self.rotation = (rotations or {}).get(size)
        if self.rotation is None:
            turn = np.random.default_rng(SEED + size).standard_normal((size, size))
            self.rotation = np.linalg.qr(turn)[0]
        self.parts = [part for part in np.array_split(np.arange(size), min(blocks, size)) if len(part)]
        self.budgets = [(2 - 2 * threshold) * len(part) / size for part in self.parts]
        self.widths = [max(np.sqrt(budget + SLACK), 1e-3) + 1e-6 for budget in self.budgets]

    def rotated(self, units: np.ndarray) -> np.ndarray:
        return units @ self.rotation

    def slabs(self, turned: np.ndarray) -> np.ndarray:
        """The slab of every vector in every block."""
        return np.stack([np.floor(turned[:, part[0]] / width).astype(np.int64) for part, width in zip(self.parts, self.widths, strict=True)], axis=1)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _by_size(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.diff(batch.column(column).offsets.to_numpy())
    for size in np.unique(sizes):
        yield int(size), batch.filter(pa.array(sizes == size)) if (sizes != size).any() else batch


def principal_axes(classes: DataFrame, blocks: int) -> dict[int, np.ndarray]:
    """By vector length, a rotation whose columns are principal axes, the widest ones first in their blocks. Fitted on the
    classes whose ``node``, a hash, is in a range that holds about ``SAMPLE`` of them."""
    share = min(1.0, SAMPLE / max(1, classes.count()))
    sample = classes.where(F.col("node") <= int(-(2.0**63) + share * 2.0**64) - 1 if share < 1 else F.lit(True)).select("vector").toArrow()
    rotations = {}
    for batch in sample.to_batches():
        for size, rows in _by_size(batch, "vector"):
            units = unit(_matrix(rows.column("vector"), size))
            rotations[size] = rotations.get(size, 0) + units.T @ units
    for size, moments in rotations.items():
        axes = np.linalg.eigh(moments)[1][:, ::-1]
        rotations[size] = np.concatenate([axes[:, block::blocks] for block in range(min(blocks, size))], axis=1)
    return rotations


def slab_counts(classes: DataFrame, threshold: float, blocks: int, rotations: dict[int, np.ndarray]) -> dict[tuple[int, int, int], int]:
    """Rows by vector length, block and slab. A block has at most 2 / width slabs, whatever the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows in _by_size(batch, "vector"):
                cut = Blocks(size, threshold, blocks, rotations)
                slabs = cut.slabs(cut.rotated(unit(_matrix(rows.column("vector"), size))))
                for block in range(slabs.shape[1]):
                    found, counts = np.unique(slabs[:, block], return_counts=True)
                    yield pa.RecordBatch.from_pydict({"size": np.full(len(found), size), "block": np.full(len(found), block), "slab": found, "n": counts})

    counted = classes.select("vector").mapInArrow(run, "size long, block long, slab long, n long")
    return {(row["size"], row["block"], row["slab"]): row["n"] for row in counted.groupBy("size", "block", "slab").agg(F.sum("n").alias("n")).collect()}


def linked(classes: DataFrame, threshold: float = THRESHOLD, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """For classes (``node`` long, ``vector``, ``n`` rows): rows ``a, b, rows``. With ``b`` null, the node a has
    ``rows`` more rows linked to it; else a and b are linked, and such rows connect all that links connect."""
    rotations = principal_axes(classes, blocks)
    counts = slab_counts(classes, threshold, blocks, rotations)
    chunks = {key: -(-n // chunk) for key, n in counts.items()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every row goes to all pairs of its own chunk and a chunk of its own or a neighbouring slab."""
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                for size, rows in _by_size(batch.slice(start, 2048), "vector"):
                    cut = Blocks(size, threshold, blocks, rotations)
                    slabs = cut.slabs(cut.rotated(unit(_matrix(rows.column("vector"), size))))
                    nodes = rows.column("node").to_numpy()
                    for block in range(slabs.shape[1]):
                        for slab in np.unique(slabs[:, block]):
                            at = np.flatnonzero(slabs[:, block] == slab)
                            own = nodes[at] % chunks[size, block, slab]
                            for other in (slab - 1, slab, slab + 1):
                                for piece in range(chunks.get((size, block, other), 0)):
                                    # The smaller (slab, chunk) of a group is its left side.
                                    left = (slab < other) | ((slab == other) & (own <= piece))
                                    low = np.where(left, own, piece)
                                    high = np.where(left, piece, own)
                                    base = min(slab, other)
                                    out = rows.take(pa.array(at))
                                    alone = (slab == other) & (own == piece)
                                    yield pa.RecordBatch.from_arrays(
                                        [
                                            pa.array(np.full(len(at), size)), pa.array(np.full(len(at), block)), pa.array(np.full(len(at), base)),
                                            pa.array(np.full(len(at), max(slab, other))), pa.array(low), pa.array(high),
                                            pa.array(np.where(alone, 0, np.where(left, 1, 2)).astype(np.int32)), out.column("node"), out.column("n"), out.column("vector"),
                                        ],
                                        ["size", "block", "slab", "next", "low", "high", "side", "node", "n", "vector"],
                                    )

    kind = classes.schema["vector"].dataType.simpleString()
    dealt = classes.select("node", "n", "vector").mapInArrow(
        deal, f"size long, block long, slab long, next long, low long, high long, side int, node long, n long, vector {kind}"
    )

    def compare(rows: pa.Table) -> pa.Table:
        size, block = rows.column("size")[0].as_py(), rows.column("block")[0].as_py()
        cut = Blocks(size, threshold, blocks, rotations)
        side, nodes, weights = (rows.column(name).to_numpy() for name in ("side", "node", "n"))
        return _compare(side, nodes, weights, _matrix(rows.column("vector").combine_chunks(), size), cut, block, threshold)

    return dealt.groupBy("size", "block", "slab", "next", "low", "high").applyInArrow(compare, "a long, b long, rows long")


def _compare(side: np.ndarray, nodes: np.ndarray, weights: np.ndarray, vectors: np.ndarray, cut: Blocks, block: int, threshold: float) -> pa.Table:
    """One pair of chunks, or a chunk with itself (side 0)."""
    units = unit(vectors)
    turned = cut.rotated(units)
    part, budget, width = cut.parts[block], cut.budgets[block], cut.widths[block]
    order = np.argsort(turned[:, part[0]], kind="stable")
    side, nodes, weights = side[order], nodes[order], weights[order]
    units, turned = units[order], turned[order]
    own = np.flatnonzero(side <= 1)
    other = np.flatnonzero(side != 1)
    near = turned[:, part].astype(np.float32)
    squares = np.einsum("ij,ij->i", near, near)
    # One product gives squared distances less the budget. What rounding can add to one in single precision is allowed for.
    loose = np.float32(budget + SLACK / 2 + 4 * (len(part) + 2) * np.finfo(np.float32).eps)
    ones = np.ones_like(squares)
    rows, columns = np.column_stack([-2 * near, squares - loose, ones]), np.column_stack([near, ones, squares]).T.copy()
    line = turned[:, part[0]]
    links = np.zeros(len(nodes), dtype=np.int64)
    label = np.arange(len(nodes))
    for start in range(0, len(own), 512):
        left = own[start : start + 512]
        low, high = np.searchsorted(line[other], [line[left[0]] - width, line[left[-1]] + width])
        if side[0] == 0:
            low = start
        for begin in range(low, high, 4096):
            right = other[begin : min(begin + 4096, high)]
            i, j = np.divmod(np.flatnonzero(rows[left] @ columns[:, right] <= 0), len(right))
            i, j = left[i], right[j]
            if side[0] == 0:
                i, j = i[i < j], j[i < j]
            for at in range(0, len(i), 1 << 16):
                a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                # The same order of the two rows in every group, so that all blocks see the same rounding.
                swap = nodes[a] > nodes[b]
                a, b = np.where(swap, b, a), np.where(swap, a, b)
                close = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
                a, b = a[close], b[close]
                for earlier in range(block):
                    gap = turned[a][:, cut.parts[earlier]] - turned[b][:, cut.parts[earlier]]
                    apart = np.einsum("ij,ij->i", gap, gap) > cut.budgets[earlier] + SLACK / 2
                    a, b = a[apart], b[apart]
                gap = turned[a][:, part] - turned[b][:, part]
                found = np.einsum("ij,ij->i", gap, gap) <= budget + SLACK / 2
                a, b = a[found], b[found]
                links += np.bincount(a, weights[b], len(nodes)).astype(np.int64) + np.bincount(b, weights[a], len(nodes)).astype(np.int64)
                _join(label, a, b)
    some = np.flatnonzero(links)
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    ends = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(nodes[label[tied]])])
    return pa.table({"a": np.concatenate([nodes[some], nodes[tied]]), "b": ends, "rows": np.concatenate([links[some], np.zeros(len(tied), dtype=np.int64)])})


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Gives the rows that pairs connect one label, the smallest place among them."""
    while len(a):
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label[label], label):
            label[:] = label[label]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, blocks: int = BLOCKS, chunk: int = CHUNK, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``. Runs jobs; classes and links are written
    to the shared folder."""
    vector = F.col(vector_column)
    known = vectors.select(F.col(id_column).alias("id"), F.when(usable(vector), vector).alias("vector"))
    known = known.withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    classes = stored(known.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.first("vector").alias("vector")))
    found = stored(linked(classes, threshold, blocks, chunk))
    links = found.where("b IS NULL").groupBy("a").agg(F.sum("rows").alias("links")).withColumnRenamed("a", "node")
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    rooted = classes.select("node", "n", "least").join(links, "node", "left").join(roots, "node", "left")
    rooted = rooted.select("node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "least", F.coalesce("root", "node").alias("root"))
    named = stored(rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "n_links", "component_id"))
    rows = known.select("id", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    return rows.select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component, F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
