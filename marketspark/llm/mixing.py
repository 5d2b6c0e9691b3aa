"""Mixing sources to target weights by temperature, in DataFrame functions alone.

A source's share of the tokens (words) is raised to an exponent between 0 (all sources alike) and 1 (as they
are) and normalised. The exponent is bisected: the largest that reaches a target entropy, or the smallest
that keeps every source within a limit of repetitions, and the larger of the two if both are asked for. The
weights and a budget of tokens say how often a source is read: so many whole epochs and a part of one. Without
a budget the mix is the smallest that reads every document at least once, so no document is lost.

Each epoch of a source is a permutation of its documents, by a hash of seed, epoch and id; the part of an epoch
is the beginning of its permutation, up to its quota of tokens. The permutations are laid end to end and cut
into blocks: every block holds the same share of each source's stream, so the weights hold in every block, and
a second hash permutes the documents of a block.

A null source is a source of its own. A source without a token keeps weight 0 and its documents come once. A
null text has no words. Equal rows are equal documents and are all kept; ids may repeat. An empty table gives
an empty one.
"""

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketspark.sources.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEATS = 2.0
BLOCK_TOKENS = 1 << 20
SEED = 11
#: Exponents are multiples of one part in so many; a round of the bisection looks at ``WAYS`` of them.
STEPS = 1 << 16
WAYS = 16


def words(column: str = "text") -> Column:
    """The number of words: each becomes one letter, blanks go. No array of a text's words is made."""
    letters = F.regexp_replace(F.coalesce(F.col(column), F.lit("")), F.lit(WORD), F.lit("x"))
    return F.length(F.translate(letters, " \t\n\x0b\x0c\r", "")).cast("long")


def source_tokens(rows: DataFrame) -> DataFrame:
    """Tokens of each source, from rows with ``source_key``, ``tokens`` (of all equal rows together)."""
    return rows.groupBy("source_key").agg(F.sum("tokens").alias("source_tokens"))


def _bisect(fits, rising: bool) -> float:
    """The exponent at which ``fits`` changes. ``rising``: it fails below and holds above, and the smallest that
    holds is returned; else the largest. ``fits(steps)`` gives the steps among some that fit."""
    low, high = 0, STEPS
    ends = fits([low, high])
    if (low if rising else high) in ends:
        return (low if rising else high) / STEPS
    if (high if rising else low) not in ends:
        return 1.0
    while high - low > 1:
        tried = sorted({low + (high - low) * k // WAYS for k in range(1, WAYS)} - {low, high})
        good = fits(tried)
        for step in tried:
            if (step in good) == rising:
                high = min(high, step)
            else:
                low = max(low, step)
    return (high if rising else low) / STEPS


def exponent(sources: DataFrame, entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, budget: int | None = None) -> float:
    """The exponent for a table of sources. ``entropy`` is a share of the largest possible. Every round of the
    bisection is one aggregation over the sources; the driver sees one row for each exponent tried."""
    known = sources.where("source_tokens > 0")
    whole = known.agg(F.count("*").alias("n"), F.sum("source_tokens").alias("tokens"), F.max("source_tokens").alias("largest")).first()
    if not whole["n"]:
        return 1.0

    def tried(steps: list[int]) -> DataFrame:
        alpha = F.col("step") / STEPS
        powers = known.select("source_tokens", F.explode(F.array(*map(F.lit, steps))).alias("step"))
        mass = F.pow(F.col("source_tokens") / whole["tokens"], alpha)
        return powers.select("step", "source_tokens", alpha.alias("alpha"), mass.alias("mass"))

    def enough(steps: list[int]) -> set[int]:
        # H = log(sum m) - sum(m log m) / sum m for the weights m / sum m.
        found = tried(steps).groupBy("step").agg(F.sum("mass").alias("z"), F.sum(F.col("mass") * F.log("mass")).alias("s"))
        return {row["step"] for row in found.where(F.log("z") - F.col("s") / F.col("z") >= entropy * log(whole["n"]) - 1e-12).collect()}

    def bounded(steps: list[int]) -> set[int]:
        if budget is None:
            often = F.max(F.pow(whole["largest"] / F.col("source_tokens"), 1 - F.col("alpha")))
        else:
            often = F.max(F.col("mass") / F.col("source_tokens")) * budget / F.sum("mass")
        return {row["step"] for row in tried(steps).groupBy("step").agg(often.alias("often")).where(F.col("often") <= max_repeats).collect()}

    alpha = 0.0
    if entropy is not None:
        alpha = _bisect(enough, rising=False)
    if max_repeats is not None:
        alpha = max(alpha, _bisect(bounded, rising=True))
    return alpha


def weights(sources: DataFrame, alpha: float, budget: int | None = None) -> DataFrame:
    """``source_key``, ``source_tokens``, ``weight`` and ``repeats``: how often the source is read."""
    whole = sources.agg(F.coalesce(F.sum("source_tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.max("source_tokens"), F.lit(0)).alias("largest")).first()
    some = F.col("source_tokens") > 0
    mass = F.when(some, F.pow(F.col("source_tokens") / max(whole["tokens"], 1), F.lit(alpha))).otherwise(F.lit(0.0))
    total = sources.agg(F.sum(mass).alias("z")).first()["z"] or 1.0
    if budget is None:
        repeats = F.pow(whole["largest"] / F.col("source_tokens"), F.lit(1 - alpha))
    else:
        repeats = mass / total * budget / F.col("source_tokens")
    return sources.select("source_key", "source_tokens", (mass / total).alias("weight"), F.round(F.when(some, repeats).otherwise(F.lit(1.0)), 9).alias("repeats"))


def schedule(docs: DataFrame, entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """Which copy of which row comes in which block, from ``doc_id``, ``text``, ``source``.

    One row for each copy: ``row_key``, ``doc_id``, ``source``, ``n_words``, ``epoch``, ``block``, ``place`` (the order in
    a block) and ``same``, the number of equal rows that it stands for. Running sums over a source are taken in
    256 parts of its permutation and put together from the parts' sums, so no task holds a source.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    rows = docs.select(F.xxhash64("doc_id", "source", "text").alias("row_key"), "doc_id", "source", key.alias("source_key"), words().alias("n_words"))
    rows = rows.groupBy("row_key", "doc_id", "source", "source_key", "n_words").agg(F.count("*").alias("same"))
    rows = stored(rows.withColumn("tokens", F.col("n_words") * F.col("same")))
    sources = stored(source_tokens(rows))
    read = weights(sources, exponent(sources, entropy, max_repeats, budget), budget)
    total = read.agg(F.sum(F.col("repeats") * F.col("source_tokens")).alias("n")).first()["n"] or 0.0
    blocks = max(1, -(-round(total) // block_tokens))
    copies = rows.join(read, "source_key").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.floor("repeats").cast("int"))))
    order = F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("epoch"), F.coalesce(F.col("doc_id"), F.lit(-1))))
    placed = copies.withColumn("order", order).withColumn("part", F.substring("order", 1, 2))
    group = ["source_key", "epoch", "part"]
    within = Window.partitionBy(*group).orderBy("order", "row_key").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("source_key", "epoch").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    parts = placed.groupBy(*group).agg(F.sum("tokens").alias("part_tokens"))
    parts = parts.select(*group, F.coalesce(F.sum("part_tokens").over(across), none).alias("earlier"))
    summed = placed.withColumn("inside", F.coalesce(F.sum("tokens").over(within), none)).join(parts, group)
    before = F.col("earlier") + F.col("inside")
    whole = F.floor("repeats")
    kept = summed.where((F.col("epoch") < whole) | (before < (F.col("repeats") - whole) * F.col("source_tokens")))
    stream = F.col("epoch") * F.col("source_tokens") + before
    block = F.least(F.lit(blocks - 1), F.floor(stream / (F.col("repeats") * F.greatest("source_tokens", F.lit(1))) * blocks)).cast("long")
    place = F.md5(F.concat_ws("/", F.lit("block"), F.lit(str(seed)), F.col("epoch"), F.coalesce(F.col("doc_id"), F.lit(-1))))
    return kept.select("row_key", "doc_id", "source", "n_words", "epoch", block.alias("block"), place.alias("place"), "same")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """One row for each copy of each document: ``doc_id``, ``source``, ``n_words``, ``epoch``, ``block``, ``place``."""
    planned = schedule(docs, **options)
    return planned.select("doc_id", "source", "n_words", "epoch", "block", "place", F.explode(F.sequence(F.lit(1), F.col("same").cast("int"))).alias("copy")).drop("copy")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents in their copies, with their own columns, ordered by block and by place in the block."""
    planned = stored(schedule(docs, **options).select("row_key", "block", "place"))
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "source", "text").alias("row_key"))
    copies = keyed.join(planned, "row_key").repartitionByRange("block", "place").sortWithinPartitions("block", "place")
    return copies.select("row.*")
