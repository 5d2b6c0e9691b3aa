"""Document collections, embeddings, exact nearest documents and context assembly.

An *embedder* is a function ``(df, text_column) -> df`` that adds an ``embedding`` array column.
"""

from collections.abc import Callable
from typing import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.text import filing_text, news_text
from .projections import unused, with_doc_id, with_meta
from .combine import union_sources
from .pivots import nearest_rings
from .windows import dedup_last

Embedder = Callable[[DataFrame, str], DataFrame]

INSTRUCTION = (
    "Answer the question from the context alone. "
    "If the context does not hold the answer, say so. Keep to the facts and be brief."
)


def hashing_embedder(dimensions: int = 256) -> Embedder:
    """Hashed word counts scaled to unit length, inside the JVM."""

    def embed_column(df: DataFrame, text: str) -> DataFrame:
        from pyspark.ml.feature import HashingTF, Normalizer
        from pyspark.ml.functions import vector_to_array

        tokens = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
        words, counts, unit = (unused(df, name) for name in ("_words", "_counts", "_unit"))
        df = df.withColumn(words, F.array_remove(tokens, ""))
        df = HashingTF(inputCol=words, outputCol=counts, numFeatures=dimensions).transform(df)
        df = Normalizer(inputCol=counts, outputCol=unit).transform(df)
        return df.withColumn("embedding", vector_to_array(unit, "float32")).drop(words, counts, unit)

    return embed_column


def column_embedder(expression: Callable[[Column], Column]) -> Embedder:
    return lambda df, text: df.withColumn("embedding", expression(F.col(text)))


def model_embedder(load: Callable[[], Callable[[list], list]], batch_size: int = 64) -> Embedder:
    """``load()`` returns a function from a list of texts to vectors; it runs once per worker."""

    import pandas as pd

    @F.pandas_udf("array<float>")
    def batches(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for texts in parts:
            vectors = []
            for start in range(0, len(texts), batch_size):
                vectors.extend(encode(texts.iloc[start : start + batch_size].tolist()))
            yield pd.Series(vectors, dtype="object")

    return column_embedder(batches)


def embed(df: DataFrame, text: str = "text", embedder: Embedder | None = None) -> DataFrame:
    return (embedder or hashing_embedder())(df, text)


def filing_documents(filings: DataFrame, landed=()) -> DataFrame:
    """One document per filing. Of a filing landed repeatedly the last row counts, by the arrival columns ``landed``
    and then by all others."""
    filings = dedup_last(filings, ["accession_no"], landed)
    fields = {"ticker": "ticker", "form_type": "form_type", "file_date": "file_date", "period": "period_of_report"}
    tagged = with_meta(filings, {name: F.col(column) for name, column in fields.items()})
    return with_doc_id(tagged, "filing", ["accession_no"]).select(
        F.lit(fv.FILINGS_COLLECTION).alias("collection"), "id", filing_text().alias("text"), "meta"
    )


def news_documents(news: DataFrame, keys=("ticker", "url"), landed=()) -> DataFrame:
    """One document per titled article, the last landed; ``first_n_docs`` in front of it limits their number."""
    titled = dedup_last(news.filter(F.col("title") != ""), list(keys), landed)
    fields = {"ticker": "ticker", "sentiment": "sentiment", "score": "sentiment_score", "source": "source"}
    tagged = with_meta(titled, {name: F.col(column) for name, column in fields.items()})
    return with_doc_id(tagged, "news", keys, digest=True).select(
        F.lit(fv.NEWS_COLLECTION).alias("collection"), "id", news_text().alias("text"), "meta"
    )


def build_documents(filings: DataFrame, news: DataFrame, embedder: Embedder | None = None, landed=()) -> DataFrame:
    """Both collections as one frame (collection, id, text, meta, embedding); no id stands twice in a collection.

    The union gives ``meta`` the fields of both kinds; those of the other kind are null.
    """
    return embed(union_sources(filing_documents(filings, landed), news_documents(news, landed=landed)), "text", embedder)


def collection_sizes(documents: DataFrame) -> DataFrame:
    return documents.groupBy("collection").agg(F.count(F.lit(1)).alias("documents"))


def _best(k: int, places: int):
    """(question ids, question matrix, document batches) -> the k nearest rows per question and collection.

    Distances to all questions come from one matrix product, which ranks well but is not exact in its
    last digits; so everything within a safe margin of the k-th place is measured again directly.
    Nested and self-contained, so it travels to the workers by value.
    """

    def best(question_ids, matrix, batches):
        from heapq import nsmallest
        from itertools import chain

        import numpy as np
        import pandas as pd

        held = {}  # (question position, collection) -> up to k (distance, document id), in order
        lengths = (matrix**2).sum(axis=1)
        for batch in batches:
            for collection, part in batch.groupby("collection", sort=False):
                ids = part["id"].to_numpy(dtype=object)
                vectors = np.stack(part["embedding"].to_numpy()).astype("float64")
                sizes = (vectors**2).sum(axis=1)
                rough = lengths[:, None] + sizes - 2 * matrix @ vectors.T
                margin = 10.0**-places + 1e-9 * (sizes.max() + lengths)
                for at, question in enumerate(matrix):
                    before = held.get((at, collection), [])
                    limit = before[-1][0] if len(before) == k else np.inf
                    if len(ids) > k:
                        limit = min(limit, np.partition(rough[at], k - 1)[k - 1])
                    near = np.flatnonzero(rough[at] <= limit + margin[at])
                    if not len(near):
                        continue
                    distances = np.round(((vectors[near] - question) ** 2).sum(axis=1), places)
                    names = ids[near]
                    if len(near) > k:
                        first = distances <= np.partition(distances, k - 1)[k - 1]
                        distances, names = distances[first], names[first]
                    found = zip(distances.tolist(), names.tolist())
                    held[at, collection] = nsmallest(k, chain(before, found))
        rows = [
            (question_ids[at], collection, name, distance)
            for (at, collection), hits in held.items()
            for distance, name in hits
        ]
        return pd.DataFrame(rows, columns=["question_id", "collection", "id", "distance"])

    return best


#: Questions that one scan of the documents answers.
FEW_QUESTIONS = 1024


def nearest(questions: DataFrame, documents: DataFrame, k: int = 5, places: int = 6,
            max_questions: int = FEW_QUESTIONS) -> DataFrame:
    """The k nearest documents of each collection for a few questions, by exact squared distance.

    ``questions``: (question_id, embedding); ``documents``: (collection, id, embedding). Distances
    are rounded to ``places`` before ranking, ties go to the smaller id.

    The questions are sent to the tasks, which scan the documents where they lie and keep k candidates
    each. More than ``max_questions`` raise an error: those are a join, ``nearest_join``.
    """
    wanted, stored, shape = _vectors_of(questions, documents)
    best = _best(k, places)
    few = wanted.limit(max_questions + 1).collect()
    if len(few) > max_questions:
        raise ValueError(f"more than {max_questions} questions: use nearest_join")
    sent = documents.sparkSession.sparkContext.broadcast(
        ([row.question_id for row in few], [[float(x) for x in row.embedding] for row in few])
    )

    def scan(batches):
        import numpy as np

        question_ids, vectors = sent.value
        if question_ids:
            yield best(question_ids, np.asarray(vectors, dtype="float64"), batches)

    return _ranked(stored.mapInPandas(scan, shape), k)


def _vectors_of(questions: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    kind = dict(questions.dtypes)["question_id"]
    wanted = questions.select("question_id", "embedding").filter(F.col("embedding").isNotNull())
    stored = documents.select("collection", F.col("id").cast("string").alias("id"), "embedding").filter(
        F.col("embedding").isNotNull()
    )
    return wanted, stored, f"question_id {kind}, collection string, id string, distance double"


def nearest_join(questions: DataFrame, documents: DataFrame, k: int = 5, places: int = 6,
                 block_questions: int = 4096, block_rows: int = 8192) -> DataFrame:
    """The same for any number of questions, through the pivot partition of ``pivots``: documents are stored once in rings,
    and a question meets only the rings that the radius of its k-th candidate reaches. Where vectors form clusters these are
    few; where they do not, every ring is in reach. A task compares ``block_questions`` with ``block_rows`` at a time; rings hold
    at least ``pivots.RING_ROWS``, as questions are copied to each. Vectors have one length. Runs jobs.
    """
    wanted, held, _ = _vectors_of(questions, documents)
    return _ranked(nearest_rings(wanted, held, k, places, block_questions, block_rows), k)


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("question_id", "collection").orderBy("distance", "id")
    kept = candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return kept.withColumn("rank", F.col("rank").cast("bigint"))


def with_text(hits: DataFrame, documents: DataFrame) -> DataFrame:
    return hits.join(documents.select("collection", F.col("id").cast("string").alias("id"), "text"), ["collection", "id"])


def assemble_context(hits: DataFrame) -> DataFrame:
    """Texts of a question's hits, filings before news, nearest first, parted by blank lines."""
    place = F.struct(
        F.when(F.col("collection") == fv.FILINGS_COLLECTION, 0).otherwise(1).alias("part"), "rank", "text"
    )
    # At most k hits per collection and question are gathered.
    ordered = F.array_sort(F.collect_list(place))
    return hits.groupBy("question_id").agg(
        F.count(F.lit(1)).alias("sources_used"),
        F.array_join(F.transform(ordered, lambda hit: hit["text"]), "\n\n").alias("context"),
    )


def prompt_of(question: Column, context: Column, instruction: str = INSTRUCTION) -> Column:
    return F.format_string(fv.PROMPT, F.lit(instruction), context, question)
