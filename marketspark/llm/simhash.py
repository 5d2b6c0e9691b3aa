"""Near-duplicate texts by SimHash fingerprints.

Texts are lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and shingles of consecutive words, repeats
included; a shorter text is one shingle, one without words has the fingerprint zero and is linked like any
other. A fingerprint bit is 1 if it is set in over half the XXH64 (seed 42) of the shingles.

For at most d differing bits the 64 bits are cut into d // 2 + 1 segments: one of them differs in at most one
bit. Each segment is written with every one of its bits deleted in turn; two fingerprints that agree in such
a variant are candidates, which an equality join finds and a count of the differing bits verifies.

Equal fingerprints are one class before anything is joined. A null text is an empty one; repeated rows are
rows of one class; a null id is carried along and never names a component that has another id.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.components import components
from marketspark.operators.projections import unused
from marketspark.sources.scratch import stored

SHINGLE = 3
MAX_BITS = 3
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Hashes that are counted together.
_SLICE = 1 << 20
_LANES = np.int64(0x0001000100010001)


def shingle_hashes(text: Column, size: int) -> Column:
    """XXH64 of every shingle, as an array of longs."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    words = F.regexp_extract_all(lowered, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def of(words: Column) -> Column:
        whole = F.when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))
        parts = [F.lit(" ")] * (2 * size - 1)
        at = lambda i: F.concat(*[F.get(words, i + k // 2) if k % 2 == 0 else part for k, part in enumerate(parts)])
        return F.when(F.size(words) < size, whole).otherwise(F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(at(i))))

    # The words are an argument of a function, so that they are found once and not once for each use.
    return F.element_at(F.transform(F.array(words), of), 1)


def _majority(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One fingerprint for each run of hashes. Four 16-bit counters share a number, so runs are cut at 65,535."""
    sizes = np.diff(offsets)
    found = np.zeros(len(sizes), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return found
    pieces = (sizes[full] + 65534) // 65535
    owner = np.repeat(np.arange(len(full)), pieces)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begins = offsets[full][owner] + 65535 * rank
    first = np.flatnonzero(rank == 0)
    for shift in range(16):
        sums = np.add.reduceat((values >> np.int64(shift)) & _LANES, begins)
        for lane in range(4):
            counts = np.add.reduceat((sums >> np.int64(16 * lane)) & np.int64(0xFFFF), first)
            found[full] |= (2 * counts > sizes[full]).astype(np.uint64) << np.uint64(shift + 16 * lane)
    return found


def fingerprints(docs: DataFrame, size: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``bits``: the fingerprint of every text, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(1)
            values, offsets = hashes.values.to_numpy(), hashes.offsets.to_numpy().astype(np.int64)
            found, row = [], 0
            while row < batch.num_rows:
                until = min(batch.num_rows, max(row + 1, int(np.searchsorted(offsets, offsets[row] + _SLICE, side="right")) - 1))
                found.append(_majority(values[offsets[row] : offsets[until]], offsets[row : until + 1] - offsets[row]))
                row = until
            bits = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], ["key", "bits"])

    kind = docs.schema[id_column].dataType.simpleString()
    hashed = docs.select(F.col(id_column).alias("key"), shingle_hashes(F.col(text_column), size).alias("hashes"))
    return hashed.mapInArrow(run, f"key {kind}, bits long").withColumnRenamed("key", id_column)


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def near_pairs(distinct: DataFrame, max_bits: int = MAX_BITS, node: str = "node", bits: str = "bits") -> DataFrame:
    """``a``, ``b``: the nodes of all pairs of different fingerprints that differ in at most ``max_bits`` bits,
    each pair once. Takes one row per fingerprint.

    A pair meets in several variants where a whole segment agrees; it is reported in the first of them, so that
    no step behind the join has to remove repeats. Spark splits the rows of a variant that many share. It takes the
    variants for as many rows as there are fingerprints, so the join is told not to broadcast them.
    """
    if max_bits <= 0:
        return distinct.select(F.col(node).alias("a"), F.col(node).alias("b")).limit(0)
    n = max_bits // 2 + 1
    edges = [64 * k // n for k in range(n + 1)]
    segments = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    masks = [segments[k] & ~(1 << bit) for k in range(n) for bit in range(edges[k], edges[k + 1])]
    variants = F.posexplode(F.array(*[F.col(bits).bitwiseAND(F.lit(_signed(mask))) for mask in masks])).alias("slot", "variant")
    keyed = distinct.select(node, bits, variants)
    left = keyed.select("slot", "variant", F.col(node).alias("a"), F.col(bits).alias("bits_a"))
    right = keyed.select("slot", "variant", F.col(node).alias("b"), F.col(bits).alias("bits_b"))
    differing = F.col("bits_a").bitwiseXOR(F.col("bits_b"))
    first, earlier = F.lit(False), F.lit(True)
    for k, segment in enumerate(segments):
        own = differing.bitwiseAND(F.lit(_signed(segment)))
        here = F.col("left.slot").between(edges[k], edges[k + 1] - 1)
        first = first | (here & earlier & ((own != 0) | (F.col("left.slot") == edges[k])))
        earlier = earlier & (F.bit_count(own) > 1)
    on = (F.col("left.slot") == F.col("right.slot")) & (F.col("left.variant") == F.col("right.variant"))
    on = on & (F.col("bits_a") < F.col("bits_b")) & (F.bit_count(differing) <= max_bits) & first
    return left.alias("left").hint("merge").join(right.alias("right").hint("merge"), on).select("a", "b")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id that
    it reaches over links. Runs jobs; fingerprints and links are written to the shared folder."""
    known = stored(fingerprints(docs, size, id_column, text_column).withColumnRenamed(id_column, "id"))
    distinct = stored(known.groupBy("bits").agg(F.min("id").alias("least")))
    # Fingerprints are the nodes: an id may stand in several rows.
    pairs = near_pairs(distinct.select(F.col("bits").alias("node"), "bits"), max_bits)
    roots = components(pairs).select(F.col("node").alias("bits"), "root")
    rooted = distinct.join(roots, "bits", "left").select("bits", "least", F.coalesce("root", "bits").alias("root"))
    named = stored(rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("bits", "component_id"))
    rows = known.join(named, "bits")
    fingerprint = F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint")
    return rows.select(F.col("id").alias(id_column), fingerprint, "component_id")


def first_of_groups(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id, of several with this id the one with
    the smallest hash of the whole row. Rows of other groups stay, also under the same id; rows without an id stay."""
    row = unused(docs, "_row")
    keyed = docs.withColumn(row, F.xxhash64(*docs.columns))
    place = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", row)).alias("place")
    found = near_duplicates(keyed.select(place, "text"), size, max_bits, id_column="place")
    kept = stored(found.where("place = component_id").select("place.doc_id", f"place.{row}").distinct())
    named = keyed.join(kept, ["doc_id", row], "left_semi").dropDuplicates(["doc_id", row])
    return named.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
