"""The pipeline's stages, each against brute force on what the stage before it kept."""

import re
from collections import Counter

import pytest
from conftest import TINY
from test_llm_texts import fingerprint, groups, kept_words

import corpus_pipeline
from marketspark.llm import simhash, toxicity
from marketspark.llm.training import remainder
from marketspark.sources.scratch import stored


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returned, by name."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = stored(stage(spark, docs, TINY))
    return found


def rows(frame):
    return [tuple(row) for row in frame.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_order_and_columns(stages):
    assert list(stages) == ["documents", "toxicity", "simhash_near_dedup", "substring_dedup", "mixing", "bpe"]
    for name in list(stages)[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_toxicity(spark, stages):
    docs, labels = stages["documents"], spark.read.parquet(f"{TINY}/labels.parquet")
    model = toxicity.learn(docs, labels, rows=remainder("doc_id", 5) != 0)
    clean = {row.doc_id for row in toxicity.score(docs, model).where("NOT flagged").collect()}
    assert Counter(rows(stages["toxicity"])) == Counter(row for row in rows(docs) if row[0] in clean)


def test_simhash(stages):
    before = rows(stages["toxicity"])
    first = groups({row[0]: fingerprint(row[1]) for row in before}, 3)
    assert Counter(rows(stages["simhash_near_dedup"])) == Counter(row for row in before if first[row[0]] == row[0])


def test_simhash_stage_broadcasts_no_variants(spark, monkeypatch):
    """Spark's estimate of the exploded fingerprints leaves out that they are exploded."""
    joins, pairs = [], simhash.near_pairs

    def seen(*args, **options):
        joins.append(pairs(*args, **options))
        return joins[-1]

    monkeypatch.setattr(simhash, "near_pairs", seen)
    assert corpus_pipeline.simhash_stage(spark, spark.read.parquet(f"{TINY}/documents.parquet"), TINY).count()
    plan = joins[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_substrings(stages):
    before = rows(stages["simhash_near_dedup"])
    words = {row[0]: (row[1] or "").encode().split() for row in rows(stages["substring_dedup"])}
    assert words == {key: kept for key, _, kept in kept_words(before)}


def test_mixing(stages):
    before, after = rows(stages["substring_dedup"]), rows(stages["mixing"])
    assert set(after) == set(before)
    assert set(Counter(after).values()) <= {1, 2}
    tokens = Counter()
    for row in before:
        tokens[row[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", row[1]))
    largest = max(tokens, key=tokens.get)
    assert all(n == 1 for row, n in Counter(after).items() if row[3] == largest)


def test_bpe(stages):
    found = stages["bpe"].collect()
    assert all(row.round_trip for row in found)
    assert Counter(row.doc_id for row in found) == Counter(row[0] for row in rows(stages["mixing"]))


def test_run(spark, stages):
    found = corpus_pipeline.run(spark, TINY)
    assert Counter((row.doc_id, row.n_tokens) for row in found.collect()) == Counter((row.doc_id, row.n_tokens) for row in stages["bpe"].collect())
