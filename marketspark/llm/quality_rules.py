"""Quality rules: form statistics and a log-likelihood ratio of hashed n-grams, in DataFrame functions alone.

The n-grams of a text are its words, its pairs of neighbouring words (a pair of equal words is one n-gram,
whatever the word) and the last two characters of its words, each hashed to one of ``BUCKETS`` buckets. Over all
documents two multinomials are counted: the raw corpus, and the trusted target, which is the documents that
pass strict rules of form (``trusted``). A document's score is the mean of log(p_target / p_raw) over its
n-grams; it is kept if its form statistics do not fail it and the score reaches the threshold.

A null text has no words. A text without n-grams has the score 0, and its form fails it. Rows are kept one
by one, so repeated rows give repeated results; an empty table gives an empty one. Other columns are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
WINDOW = 8
#: Fixed values of the form rules.
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Mean log ratio below which a document is rejected. Clean texts score about zero, as most of the corpus is clean.
THRESHOLD = -0.25
#: Shares of words that make a text untrusted: with symbols, in capitals, equal to their neighbour.
TRUST = {"symbols": 0.02, "capitals": 0.3, "equal": 0.05}

NO_LONGS = "array<bigint>"


def with_words(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id``, ``text`` and the columns that all rules start from."""
    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    words = texts.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    sized = words.withColumn("n", F.size("words")).withColumn("n_symbols", F.regexp_count("text", F.lit(SYMBOLS)))
    return sized.withColumn("hashes", F.transform("words", lambda word: F.xxhash64(word)))


def _between(first: int, last: Column, function) -> Column:
    """An array from a function of the places ``first`` to ``last``, empty where there are none."""
    return F.when(last >= first, F.transform(F.sequence(F.lit(first), last), function)).otherwise(F.array().cast(NO_LONGS))


def buckets() -> Column:
    """The buckets of a text's n-grams. The three kinds are told apart by a seed."""
    pairs = _between(
        0,
        F.col("n") - 2,
        lambda i: F.when(F.get("hashes", i) == F.get("hashes", i + 1), F.lit(1)).otherwise(F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1))).cast("long"),
    )
    tails = F.transform("words", lambda word: F.xxhash64(F.substring(word, -2, 2), F.lit(2)))
    return F.transform(F.concat("hashes", pairs, tails), lambda x: x.bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))


def trusted() -> Column:
    """Strict rules of form for the target: enough words, few symbols, capitals and equal neighbours."""
    n = F.col("n")
    capitals = F.size(F.filter("words", lambda word: (F.upper(word) == word) & (F.lower(word) != word)))
    equal = F.size(F.filter("hashes", lambda x, i: x == F.coalesce(F.get("hashes", i + 1), F.lit(0))))
    return (n >= MIN_WORDS) & (F.col("n_symbols") <= TRUST["symbols"] * n) & (capitals <= TRUST["capitals"] * n) & (equal <= TRUST["equal"] * n)


def log_ratios(worded: DataFrame) -> DataFrame:
    """One row with ``ratios``: log(p_target / p_raw) of each bucket, with one added to every count. Counts cover
    all documents; the row has ``BUCKETS`` numbers whatever the corpus."""
    # Both are columns before rows are made, or trust would be asked for again with every n-gram; and an inner
    # explode would ask for the size of the buckets in a filter at the scan, with all that leads to them.
    judged = worded.select(trusted().cast("int").alias("target"), buckets().alias("buckets"))
    grams = judged.select("target", F.explode_outer("buckets").alias("bucket")).where("bucket IS NOT NULL")
    counted = grams.groupBy("bucket").agg(F.sum("target").alias("target"), F.count("*").alias("raw"))
    every = worded.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("target"), F.lit(0).cast("long").alias("raw"))
    whole = counted.unionByName(every).groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))
    listed = F.sort_array(F.collect_list(F.struct("bucket", "target", "raw"))).alias("listed")
    row = whole.agg(listed, (F.sum("target") + BUCKETS).alias("n_target"), (F.sum("raw") + BUCKETS).alias("n_raw"))
    ratio = lambda x: F.log((x["target"] + 1) / F.col("n_target")) - F.log((x["raw"] + 1) / F.col("n_raw"))
    return row.select(F.transform("listed", ratio).alias("ratios"))


def with_form(worded: DataFrame) -> DataFrame:
    """The form statistics. Windows are compared by hashes; only a text in which two are equal is looked at further."""
    n = F.col("n")
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    windows = _between(0, n - WINDOW, lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]))
    form = worded.withColumn("lines", lines).withColumn("windows", windows)
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    form = form.withColumn("placed", F.when(repeats, placed))
    again = F.filter(
        "placed",
        lambda w, k: F.coalesce((k > 0) & (F.get("placed", k - 1)["x"] == w["x"]), F.lit(False)) | F.coalesce(F.get("placed", k + 1)["x"] == w["x"], F.lit(False)),
    )
    form = form.withColumn("again", F.sort_array(F.transform(again, lambda w: w["i"])))
    # A window adds its words up to the next repeated window.
    added = F.transform("again", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("again", k + 1) - i, F.lit(WINDOW))).cast("long"))
    repeated = F.coalesce(F.aggregate(added, F.lit(0).cast("long"), lambda x, y: x + y), F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return (
        form.withColumn("n_words", n.cast("long"))
        .withColumn("word_chars", F.char_length(F.array_join("words", "")).cast("long"))
        .withColumn("n_symbols", F.col("n_symbols").cast("long"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .withColumn("n_repeat_words", repeated)
        .withColumn("base_failed", failed)
    )


def judge(docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept`` and ``score``. Counting and scoring are two scans; no text is shuffled."""
    worded = with_words(docs, id_column, text_column)
    ratios = log_ratios(worded).scalar()
    formed = with_form(worded).withColumn("buckets", buckets()).withColumn("ratios", ratios)
    total = F.aggregate("buckets", F.lit(0.0), lambda x, b: x + F.get("ratios", b))
    score = F.when(F.size("buckets") > 0, total / F.size("buckets")).otherwise(F.lit(0.0))
    scored = formed.withColumn("score", score)
    # Not deterministic in name only: a caller's filter on the result is not copied down to the scan.
    here = F.monotonically_increasing_id() >= 0
    return scored.select(
        F.col("doc_id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (here & ~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"), "score",
    )
