"""The corpus pipeline: documents are freed of toxic texts, near-duplicates and repeated passages, mixed by source and
encoded. Every stage takes ``(spark, docs, sf_dir)``, works on all that the stage before it kept and returns the
columns of ``documents``; the last returns token ids. Each stage's result is written as Parquet and read again.
"""

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parent)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from marketspark.llm import bpe, mixing, simhash, substrings, toxicity  # noqa: E402
from marketspark.llm.queries import ORACLES as _ORACLES  # noqa: E402
from marketspark.llm.queries import QUERIES as _QUERIES  # noqa: E402
from marketspark.llm.training import remainder  # noqa: E402
from marketspark.sources.scratch import stored  # noqa: E402


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier flags by their language's threshold. It learns from the labelled
    documents of the four folds that op6 learns from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.learn(docs, labels, rows=remainder("doc_id", 5) != 0))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.first_of_groups(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of the texts."""
    return substrings.without_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to twice, in blocks that hold the mix."""
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens``, ``ids``, and whether the ids decode to the text."""
    encoded = bpe.encode(docs, keep=("source",), decoded=False)
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", simhash_stage),
    ("substring_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: Hashes, fingerprints and a trained network have no SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**_QUERIES, "pipeline": run}
ORACLES = dict(_ORACLES) | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
