"""The trie of conversations by their turns, grown as a burst trie.

Conversations of the same turns are one *suffix* with a count, so that a conversation that very many share is one row. All
suffixes start in one container under the root. A container whose suffixes hold more than ``CONTAINER_TURNS`` turns is
burst: the turns that all of them share become heads of the trie, and every suffix goes on, by its next turn's id,
into a container under the new head. One grouped pass decides which containers burst, another deals their
suffixes, until none is too large; a suffix alone never bursts. What remains is dealt to tasks by container, sorted and
swept: neighbours' common turns tell which nodes are open, and a node is finished when a suffix leaves it. Sums over
subtrees come from the sweep and climb from head to head, one join a round.

A turn's id is the MD5 of its role and text, so that texts travel no further than the first scan.
"""

import hashlib
from collections.abc import Iterator
from itertools import groupby
from os.path import commonprefix

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.sources.scratch import stored

#: Turns left in the suffixes of a container, at most, unless it holds one suffix alone.
CONTAINER_TURNS = 1 << 16
#: Hexadecimal digits of a turn's id.
_ID = 32
#: Ids of conversations packed into one row on their way to a digest.
_PACK = 4096
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``seq`` (the ids of its turns in order), ``chars`` (code points of their texts) of every conversation.

    Turns are ordered by ``turn``, null first; equal ones by their id. A null role or text is an empty one. Rows without
    ``conv_id`` belong to no conversation. A conversation is one row: 36 bytes a turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").alias("turn"), digest.alias("id"), F.length(text).alias("chars")).alias("one")
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    return ordered.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars"))


def rebuilt(sequences: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """``conv_id``, ``seq``, ``chars``: the first h turns of the conversation ``conv_id - conv_id % every``, then a
    conversation's own after its first h, where h is crc32(conv_id) % (most + 1). The seq is the joined ids."""
    own = sequences.withColumns({"h": (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int"), "base": F.col("conv_id") - F.col("conv_id") % every})
    bases = sequences.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("ids", 1, most).alias("base_ids"), F.slice("chars", 1, most).alias("base_chars"))
    joined = own.join(bases, "base", "left")

    def spliced(column: str):
        before = F.coalesce(F.slice(f"base_{column}", F.lit(1), F.col("h")), F.slice(column, F.lit(1), F.lit(0)))
        return F.concat(before, F.slice(column, F.col("h") + 1, F.size(column)))

    return joined.select("conv_id", F.array_join(spliced("ids"), "").alias("seq"), spliced("chars").alias("chars"))


def _digests(members: DataFrame) -> DataFrame:
    """``key``, ``ends``: the digest of the ids (conv_id) of each key, ascending and joined by commas.

    Ids are ordered by ranges of key and id, so that the many of one key are spread; tasks join them into rows of some
    thousands, and the digest is carried on over these.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids = None, []
        for batch in batches:
            keys, first, packed = [], [], []
            for key, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if key != held or len(ids) >= _PACK:
                    if ids:
                        keys.append(held), first.append(ids[0]), packed.append(",".join(map(str, ids)))
                    held, ids = key, []
                ids.append(conv)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(first, pa.int64()), pa.array(packed, pa.string())], ["key", "first", "packed"])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["key", "first", "packed"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            keys, ends = [], []
            for key, packed in zip(batch.column("key").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if key == held:
                    state.update(b"," + packed.encode())
                    continue
                if state is not None:
                    keys.append(held), ends.append(state.hexdigest())
                held, state = key, hashlib.sha256(packed.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ends, pa.string())], ["key", "ends"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([state.hexdigest()])], ["key", "ends"])

    ordered = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    packed = ordered.mapInArrow(pack, "key string, first long, packed string")
    return packed.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key string, ends string")


def nodes(members: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The nodes of the trie over (conv_id, seq, chars): ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. No conversation gives no node. Runs jobs."""
    members = stored(members.select("conv_id", "seq", "chars", F.md5("seq").alias("key")))
    suffixes = members.groupBy("key").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.min("seq").alias("seq"), F.first("chars").alias("chars")
    )
    suffixes = suffixes.join(_digests(members.select("key", "conv_id")), "key").withColumn("size", F.size("chars"))
    root = F.md5(F.lit(""))
    suffixes = stored(suffixes.select("seq", "chars", "size", "n", "least", "ends", root.alias("head"), F.lit(None).cast("string").alias("up"), F.lit(0).alias("depth")))
    heads, settled = [], []
    while True:
        burst = _oversized(suffixes, container_turns)
        if burst.isEmpty():
            break
        heads.append(burst)
        marked = suffixes.join(burst.select("head", "tail", "tail_depth"), "head", "left")
        settled.append(marked.where("tail IS NULL").select(*suffixes.columns))
        # What ends at the new head is its own; everything else goes on by its next turn.
        going = marked.where("tail IS NOT NULL AND size > tail_depth")
        depth = F.col("tail_depth") + 1
        suffixes = stored(
            going.select("seq", "chars", "size", "n", "least", "ends", F.md5(F.substring("seq", F.lit(1), depth * _ID)).alias("head"), F.col("tail").alias("up"), depth.alias("depth"))
        )
    remaining = suffixes
    for one in settled:
        remaining = remaining.unionByName(one)
    swept = stored(_swept(remaining))
    inner = swept.where("up IS NULL")
    found = [inner.drop("up")]
    # Heads from the deepest up: what hangs below them is known then.
    below = swept.where("up IS NOT NULL")
    for burst in reversed(heads):
        sums = below.groupBy("up").agg(F.count("*").alias("below_children"), F.sum("n_leaves").alias("below_leaves"), F.sum("saved_tokens").alias("below_saved"))
        whole = stored(burst.join(sums.withColumnRenamed("up", "tail"), "tail"))
        hung = below.join(whole.select(F.col("tail").alias("up"), F.col("least").alias("above")), "up", "left")
        found.append(hung.where("above IS NOT NULL").select(*[F.col("above").alias(name) if name == "parent_conv_id" else F.col(name) for name in inner.columns if name != "up"]))
        chain = _chain(whole)
        found.append(chain.where("NOT first").drop("first", "up"))
        rest = hung.where("above IS NULL").drop("above").select(*below.columns)
        below = stored(rest.unionByName(chain.where("first").drop("first")))
    found.append(below.drop("up"))
    result = found[0]
    for one in found[1:]:
        result = result.unionByName(one)
    return result


def _oversized(suffixes: DataFrame, container_turns: int) -> DataFrame:
    """The containers to burst: ``head``, ``depth``, ``up``, ``tail`` and ``tail_depth`` (the head at the end of the turns that all
    suffixes share), ``n``, ``least``, ``shared`` (code points of the turns from the head to the tail), ``ends``."""
    sized = suffixes.groupBy("head").agg(
        F.min("depth").alias("depth"), F.min("up").alias("up"), F.count("*").alias("suffixes"), F.sum(F.col("size") - F.col("depth")).alias("turns"),
        F.sum("n").alias("n"), F.min("least").alias("least"), F.min("seq").alias("low"), F.max("seq").alias("high"),
        F.min_by("chars", "seq").alias("low_chars"), F.min_by("ends", "seq").alias("low_ends"),
    )
    large = sized.where((F.col("suffixes") > 1) & (F.col("turns") > container_turns))
    # All suffixes share what the first and the last in order share.
    large = large.withColumn("tail_depth", _shared_turns("low", "high"))
    # The shortest sequence of all comes first: only that can end at the tail.
    ends = F.when(F.length("low") == F.col("tail_depth") * _ID, F.col("low_ends")).otherwise(NO_ENDS)
    own = F.when(F.col("depth") > 0, F.slice("low_chars", F.greatest(F.col("depth"), F.lit(1)), F.col("tail_depth") - F.col("depth") + 1)).otherwise(
        F.concat(F.array(F.lit(0)), F.slice("low_chars", F.lit(1), F.col("tail_depth")))
    )
    return stored(
        large.select("head", "depth", "up", F.md5(F.substring("low", F.lit(1), F.col("tail_depth") * _ID)).alias("tail"), "tail_depth", "n", "least", own.alias("shared"), ends.alias("ends"))
    )


def _shared_turns(low: str, high: str) -> Column:
    def shared(low: pd.Series, high: pd.Series) -> pd.Series:
        return pd.Series([len(commonprefix([a, b])) // _ID for a, b in zip(low, high, strict=True)], dtype="int32")

    return F.pandas_udf(shared, "int")(low, high)


def _chain(heads: DataFrame) -> DataFrame:
    """One node for each turn from a head to its tail; ``first`` marks the head, whose parent is still to come."""
    length = F.size("shared")
    numbered = heads.select("*", F.posexplode("shared").alias("place", "own"))
    rest = F.aggregate(F.slice("shared", F.col("place") + 1, length), F.lit(0).cast("long"), lambda total, x: total + x)
    last = F.col("place") == length - 1
    return numbered.select(
        F.col("least").alias("conv_id"), (F.col("depth") + F.col("place")).cast("long").alias("depth"),
        F.when(F.col("place") > 0, F.col("least")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("below_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("below_leaves").alias("n_leaves"),
        (F.col("below_saved") + (F.col("n") - 1) * rest).alias("saved_tokens"), F.when(last, F.col("ends")).otherwise(NO_ENDS).alias("ends_sha256"),
        "up", (F.col("place") == 0).alias("first"),
    )


class _Node:
    __slots__ = ("depth", "chars", "n", "least", "leaves", "saved", "ends", "children")

    def __init__(self, depth: int, chars: int):
        self.depth, self.chars = depth, chars
        self.n = self.leaves = self.saved = self.children = 0
        self.least, self.ends = None, NO_ENDS


def _close(stack: list[tuple[_Node, list[tuple]]]) -> list[tuple]:
    """Finish the innermost open node. Its row waits with the node above until that one's smallest member is known; the
    rows that wait with itself, (row before the parent, row behind it), are returned whole."""
    node, waiting = stack.pop()
    node.leaves = node.leaves or 1
    node.saved += (node.n - 1) * node.chars
    rows = [(*left, node.least, *right) for left, right in waiting]
    if stack:
        above, own = stack[-1]
        above.n += node.n
        above.least = node.least if above.least is None else min(above.least, node.least)
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved
        own.append(_halves(node))
    return rows


def _halves(node: _Node) -> tuple[tuple, tuple]:
    return (node.least, node.depth), (node.n, node.children, node.leaves, node.saved, node.ends)


def _sweep(depth: int, container: list[dict]) -> Iterator[tuple]:
    """The nodes of a container whose suffixes, in order, all share their first ``depth`` turns; its top comes last, without
    a parent."""
    chars = container[0]["chars"]
    top = _Node(depth, chars[depth - 1] if depth else 0)
    stack, before = [(top, [])], []
    for row in container:
        ids = [row["seq"][at : at + _ID] for at in range(depth * _ID, len(row["seq"]), _ID)]
        shared = 0
        while shared < min(len(ids), len(before)) and ids[shared] == before[shared]:
            shared += 1
        while len(stack) > shared + 1:
            yield from _close(stack)
        for place in range(shared, len(ids)):
            stack.append((_Node(depth + place + 1, row["chars"][depth + place]), []))
        last = stack[-1][0]
        last.n, last.least, last.ends = row["n"], row["least"], row["ends"]
        before = ids
    while stack:
        yield from _close(stack)
    left, right = _halves(top)
    yield (*left, None, *right)


def _swept(suffixes: DataFrame) -> DataFrame:
    """The nodes of all containers; ``up`` is the head above for the tops that have one."""
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "up"]
    kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def given():
            arrays = [pa.array([row[place] for row in rows], kind) for place, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(arrays, columns)

        for (_, up, depth), container in groupby(ordered(batches), key=lambda row: (row["head"], row["up"], row["depth"])):
            swept = None
            for swept in _sweep(depth, list(container)):
                rows.append((*swept, None))
                if len(rows) >= 10_000:
                    last = rows.pop()
                    yield given()
                    rows = [last]
            rows[-1] = (*swept, up)
        yield given()

    dealt = suffixes.repartition("head").sortWithinPartitions("head", "seq")
    return dealt.mapInArrow(run, _NODE + ", up string")


def prefix_trie(conversations: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The nodes of the trie over the rebuilt conversations of (conv_id, turn, role, text); other columns are not read.

    Repeated rows are turns of their own. Rows without conv_id are left out; a conversation without rows does not
    exist, one whose rebuilt form has no turns ends at the root. An empty table gives no node.
    """
    return nodes(rebuilt(sequences(conversations)), container_turns)
