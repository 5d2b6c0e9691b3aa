import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from marketspark import fixed_values as fv
from marketspark.operators import pivots
from marketspark.operators import retrieval as rt
from marketspark.plans import reports

FILINGS = "ticker string, form_type string, entity_name string, period_of_report string, file_date string, accession_no string"
NEWS = "ticker string, title string, sentiment string, sentiment_score double, source string, published_at string, url string"


@pytest.fixture
def filings(spark):
    return spark.createDataFrame(
        [("AAPL", "10-K", "Apple Inc.", "2023-09-30", "2023-11-03", "0000320193-23-000106"), ("XOM", "10-Q", None, None, "2024-05-01", "0000034088-24-000029")],
        FILINGS,
    )


@pytest.fixture
def news(spark):
    return spark.createDataFrame(
        [("NVDA", "Chips boom", "positive", 0.125, "Wire", "2024-01-01", "u1"), ("F", "", "neutral", 0.5, "Wire", None, "u2"),
         ("GM", "Recall", "negative", 0.9, None, None, "u3"), ("GE", None, "negative", 0.9, None, None, "u4")],
        NEWS,
    )


def test_document_texts(filings, news):
    texts = {row["id"]: row["text"] for row in rows_of(rt.filing_documents(filings))}
    assert texts["filing_0000320193-23-000106"] == (
        "Apple Inc. (AAPL) filed a 10-K on 2023-11-03 for the period ending 2023-09-30. Accession number: 0000320193-23-000106."
    )
    assert texts["filing_0000034088-24-000029"].startswith("None (XOM) filed a 10-Q on 2024-05-01 for the period ending None.")
    rows = {row["meta"].ticker: row for row in rows_of(rt.news_documents(news))}
    assert set(rows) == {"NVDA", "GM"}  # no title, no document
    assert rows["NVDA"]["text"] == "[POSITIVE] NVDA: Chips boom (confidence: 0.12, source: Wire, date: 2024-01-01)"
    assert rows["GM"]["text"] == "[NEGATIVE] GM: Recall (confidence: 0.90, source: None, date: None)"
    assert rows["GM"]["meta"].score == 0.9
    both = {row["meta"].ticker: row["meta"] for row in rows_of(rt.build_documents(filings, news))}
    assert both["GM"].form_type is None and both["GM"].sentiment == "negative"
    assert both["AAPL"].form_type == "10-K" and both["AAPL"].score is None and both["AAPL"].period == "2023-09-30"


def test_ids_do_not_depend_on_partitioning(news):
    first = {row["id"] for row in rows_of(rt.news_documents(news))}
    assert first == {row["id"] for row in rows_of(rt.news_documents(news.repartition(5)))}


def test_repeated_landing(spark, filings, news):
    """What was landed twice is one document, with the text of the later landing."""
    assert rt.build_documents(filings.unionByName(filings), news.unionByName(news)).count() == rt.build_documents(filings, news).count()
    twice = filings.withColumn("day", F.lit(2)).unionByName(filings.withColumn("day", F.lit(1)).withColumn("entity_name", F.lit("Old")))
    texts = [row["text"] for row in rows_of(rt.filing_documents(twice, ("day",)))]
    assert len(texts) == filings.count() and not any(text.startswith("Old ") for text in texts)
    assert rt.news_documents(news).count() == 2


def vectors(spark, count, seed, dimensions=4, grid=None):
    rng = random.Random(seed)
    draw = (lambda: rng.randrange(grid) * 1.0) if grid else rng.random
    return [(n, [draw() for _ in range(dimensions)]) for n in range(count)]


def brute(questions, documents, k):
    found = set()
    for question, vector in questions:
        for collection in {one[0] for one in documents}:
            near = sorted(
                (round(sum((a - b) ** 2 for a, b in zip(vector, other)), 6), name)
                for held, name, other in documents if held == collection
            )
            found |= {(question, collection, name, distance, rank) for rank, (distance, name) in enumerate(near[:k], 1)}
    return found


# A grid of whole numbers gives many ties; five partitions cut the documents.
@pytest.mark.parametrize("grid", [None, 3])
@pytest.mark.parametrize("options", [None, {}, {"block_questions": 7, "block_rows": 40}])
def test_nearest_against_brute_force(spark, grid, options):
    asked = vectors(spark, 20, 1, grid=grid)
    stored = [("big" if n % 4 else "small", f"d{n}", vector) for n, vector in vectors(spark, 200, 2, grid=grid)]
    stored.append(("tiny", "only", [0.5] * 4))
    questions = spark.createDataFrame(asked, "question_id bigint, embedding array<double>")
    documents = spark.createDataFrame(stored, "collection string, id string, embedding array<double>").repartition(5)
    found = rt.nearest(questions, documents, 5) if options is None else rt.nearest_join(questions, documents, 5, **options)
    assert {tuple(row[name] for name in ("question_id", "collection", "id", "distance", "rank")) for row in rows_of(found)} == brute(asked, stored, 5)


@pytest.mark.parametrize("spread", [0.01, 1.0])
def test_pivots_against_brute_force(spark, spread):
    """Clusters, a third of all documents equal, questions among and beside the documents; many small rings."""
    rng = random.Random(7)
    centres = [[10 * rng.random() for _ in range(5)] for _ in range(12)]

    def draw(n):
        return [x + rng.gauss(0, spread) for x in centres[n % 12]]

    stored = [("c" if n % 5 else "few", f"d{n:04}", centres[0] if n % 3 == 0 else draw(n)) for n in range(900)]
    asked = [(n, draw(n) if n % 4 else centres[0]) for n in range(120)]
    questions = spark.createDataFrame(asked, "question_id bigint, embedding array<double>").repartition(3)
    documents = spark.createDataFrame(stored, "collection string, id string, embedding array<double>").repartition(5)
    found = rt.nearest_join(questions, documents, 4, block_questions=16, block_rows=20)
    assert {tuple(row[name] for name in ("question_id", "collection", "id", "distance", "rank")) for row in rows_of(found)} == brute(asked, stored, 4)


def test_small_blocks_copy_no_questions(spark, monkeypatch):
    """Blocks of 20 rows make no more rings, to each of which questions are copied, than large ones; smaller rings agree."""
    stored = [("c" if n % 5 else "few", f"d{n:04}", vector) for n, vector in vectors(spark, 900, 3)]
    asked = vectors(spark, 120, 4)
    questions = spark.createDataFrame(asked, "question_id bigint, embedding array<double>").repartition(3)
    documents = spark.createDataFrame(stored, "collection string, id string, embedding array<double>").repartition(5)
    names = ("question_id", "collection", "id", "distance", "rank")
    made, chosen = [], pivots.Rings

    def rings(*options):
        made.append(chosen(*options))
        return made[-1]

    monkeypatch.setattr(pivots, "Rings", rings)
    for rows in (8192, 50):
        monkeypatch.setattr(pivots, "RING_ROWS", rows, raising=False)
        found = rt.nearest_join(questions, documents, 4, block_questions=16, block_rows=20)
        assert {tuple(row[name] for name in names) for row in rows_of(found)} == brute(asked, stored, 4)
    assert made[0].rings.count() == 2  # one of each collection, not one for every 20 rows


def test_questions_meet_few_rings_of_clusters(spark):
    """Ten times the clusters are ten times the rings, but a question meets no more of them."""
    met = []
    for clusters in (20, 200):
        rng = random.Random(clusters)
        centres = [[100 * rng.random() for _ in range(6)] for _ in range(clusters)]
        stored = [("c", f"d{n}", [x + rng.gauss(0, 0.1) for x in centres[n % clusters]]) for n in range(clusters * 25)]
        documents = spark.createDataFrame(stored, "collection string, id string, embedding array<double>")
        asked = spark.createDataFrame([(n, stored[7 * n][2]) for n in range(60)], "question_id bigint, embedding array<double>")
        rings = pivots.Rings(documents, 3, 10)
        asked = asked.withColumn("row", F.col("question_id"))
        homes = rings.homes(asked)
        kth = rings.meet(homes, 6, 100).groupBy("row").agg(F.max("distance").alias("kth"))
        near = homes.join(kth, "row").withColumn("reach", F.least("reach", F.sqrt("kth") + 1e-6)).select(*homes.columns)
        assert rings.rings.count() >= 2 * clusters
        met.append(rings.others(near).count() / 60)
    assert met[1] < 2 * met[0] + 2 and met[1] < 20


def test_too_many_questions(spark):
    questions = spark.createDataFrame([(n, [1.0]) for n in range(5)], "question_id int, embedding array<double>")
    documents = spark.createDataFrame([("c", "x", [1.0])], "collection string, id string, embedding array<double>")
    with pytest.raises(ValueError, match="nearest_join"):
        rt.nearest(questions, documents, max_questions=4)
    assert rt.nearest(questions, documents, max_questions=5).count() == 5


def test_many_copies_of_one_document(spark):
    """A third of all documents are the same text; the smallest ids win."""
    stored = [("c", f"{n:04}", [1.0, 0.0] if n % 3 == 0 else [float(n), 1.0]) for n in range(600)]
    documents = spark.createDataFrame(stored, "collection string, id string, embedding array<double>").repartition(4)
    questions = spark.createDataFrame([(1, [1.0, 0.0])], "question_id int, embedding array<double>")
    rows = rows_of(rt.nearest(questions, documents, 3), "rank")
    assert [row["id"] for row in rows] == ["0000", "0003", "0006"]


def test_default_embedder(spark):
    texts = spark.createDataFrame([(1, "Rates rise again"), (2, "rates RISE, again!"), (3, "Oil falls"), (4, ""), (5, None)], "id int, text string")
    found = {row["id"]: row["embedding"] for row in rows_of(rt.embed(texts))}
    assert found[1] == found[2] != found[3]
    assert sum(x * x for x in found[1]) == pytest.approx(1, abs=1e-6)
    assert set(found[4]) == set(found[5]) == {0.0}


def test_default_embedder_counts_words(spark):
    from pyspark.ml.feature import HashingTF

    place = HashingTF(numFeatures=256).indexOf
    text = "Öl steigt: oil, oil and GAS in 2024"
    counts = [0.0] * 256
    for word in ("öl", "steigt", "oil", "oil", "and", "gas", "in", "2024"):
        counts[place(word)] += 1
    length = sum(count * count for count in counts) ** 0.5
    (row,) = rows_of(rt.embed(spark.createDataFrame([(text,)], "text string")))
    assert list(row["embedding"]) == pytest.approx([count / length for count in counts], abs=1e-6)


def test_model_embedder(spark):
    def load():
        return lambda texts: [[float(len(text)), 1.0] for text in texts]

    texts = spark.createDataFrame([("abc",), ("z",)], "text string")
    found = {row["text"]: list(row["embedding"]) for row in rows_of(rt.embed(texts, embedder=rt.model_embedder(load, 1)))}
    assert found == {"abc": [3.0, 1.0], "z": [1.0, 1.0]}


def test_retrieve(spark, filings, news):
    documents = rt.build_documents(filings, news)
    sizes = {row["collection"]: row["documents"] for row in rows_of(rt.collection_sizes(documents))}
    assert sizes == {fv.FILINGS_COLLECTION: 2, fv.NEWS_COLLECTION: 2}
    questions = spark.createDataFrame([(1, "Which 10-K did Apple Inc. file?"), (2, "chips boom")], "question_id int, question string")
    first, second = rows_of(reports.retrieve(questions, documents, 1), "question_id")
    assert first["sources_used"] == 2
    assert first["context"].startswith("Apple Inc. (AAPL)")  # filings come first
    assert first["context"].count("\n\n") == 1
    assert "Chips boom" in second["context"]
    assert first["prompt"].endswith("QUESTION: Which 10-K did Apple Inc. file?\n\nANSWER:")
    everything = rows_of(reports.retrieve(questions, documents, 50))
    assert {row["sources_used"] for row in everything} == {4}


def test_retrieve_without_documents(spark, filings, news):
    documents = rt.build_documents(filings, news).limit(0)
    questions = spark.createDataFrame([(1, "Anything?")], "question_id int, question string")
    (row,) = rows_of(reports.retrieve(questions, documents))
    assert row["context"] == fv.NO_DOCUMENTS and row["sources_used"] == 0


def test_retrieve_takes_any_number_of_questions(spark, filings, news):
    documents = rt.build_documents(filings, news)
    questions = spark.range(1100).select(F.col("id").alias("question_id"), F.concat(F.lit("chips boom "), "id").alias("question"))
    found = rows_of(reports.retrieve(questions, documents, 1))
    assert {row["question_id"] for row in found} == set(range(1100)) and {row["sources_used"] for row in found} == {2}


def test_no_question(spark, filings, news):
    documents = rt.build_documents(filings, news)
    nobody = spark.createDataFrame([], "question_id int, question string")
    assert reports.retrieve(nobody, documents).isEmpty()


def test_search_moves_no_documents(spark, filings, news):
    documents = rt.build_documents(filings, news)
    questions = rt.embed(spark.createDataFrame([(1, "x")], "question_id int, text string"))
    plan = rt.nearest(questions, documents)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "WindowGroupLimit" in plan
    assert documents.select(F.size("embedding")).first()[0] == 256


def test_retrieve_deals_only_many_questions_to_rings(spark, filings, news, monkeypatch):
    """Few questions are answered by one scan, with the same contexts as those that the rings give."""
    documents = rt.build_documents(filings, news)
    questions = spark.createDataFrame([(1, "T1 annual report"), (2, "good news"), (2, "bad news"), (None, "T2")], "question_id int, question string")
    asked = []
    rings = rt.nearest_join
    monkeypatch.setattr(rt, "nearest_join", lambda *given: asked.append(given) or rings(*given))
    scanned = [tuple(row) for row in reports.retrieve(questions, documents, 2).orderBy("question_id", "question").collect()]
    assert not asked
    monkeypatch.setattr(rt, "FEW_QUESTIONS", 3)
    assert [tuple(row) for row in reports.retrieve(questions, documents, 2).orderBy("question_id", "question").collect()] == scanned
    assert len(asked) == 1
