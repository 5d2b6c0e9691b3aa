"""Batch scoring of texts into class probabilities, a label and its score.

A *scorer* is a function from a text column to a struct column with the fields ``positive``,
``negative`` and ``neutral``. ``word_list_scorer`` stays in column expressions; ``model_scorer``
wraps any Python model in an iterator pandas UDF that loads it once per worker.
"""

from collections.abc import Callable, Iterable, Sequence
from typing import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.numeric import half_up
from ..functions.text import count_words, words
from .projections import unused

Scorer = Callable[[Column], Column]

POSITIVE_WORDS = (
    "beat", "beats", "boost", "gain", "gains", "growth", "high", "jump", "jumps", "profit",
    "rally", "record", "rise", "rises", "strong", "surge", "surges", "up", "upgrade", "win",
)
NEGATIVE_WORDS = (
    "cut", "cuts", "decline", "down", "downgrade", "drop", "drops", "fall", "falls", "fear",
    "lawsuit", "loss", "losses", "low", "miss", "misses", "plunge", "risk", "slump", "weak",
)


def softmax(logits: Sequence[Column]) -> list[Column]:
    top = F.greatest(*logits)
    powers = [F.exp(one - top) for one in logits]
    total = sum(powers[1:], powers[0])
    return [one / total for one in powers]


def word_list_scorer(positive: Iterable[str] = POSITIVE_WORDS, negative: Iterable[str] = NEGATIVE_WORDS, bias: float = 1.0) -> Scorer:
    """Softmax over the counts of listed words, with a constant for neutral. Reads whole texts."""

    positive, negative = tuple(positive), tuple(negative)

    def score(text: Column) -> Column:
        listed = F.filter(words(F.coalesce(text, F.lit(""))), lambda word: word.isin(*positive, *negative))

        def counts(found: Column) -> Column:
            return F.struct(count_words(found, positive).cast("double").alias("p"), count_words(found, negative).cast("double").alias("n"))

        def shares(logits: Column) -> Column:
            return F.struct(*[share.alias(label) for share, label in zip(softmax([logits["p"], logits["n"], F.lit(bias)]), fv.SENTIMENT_LABELS)])

        # Arguments of functions are computed once: the text is cut once, and the few listed words are counted.
        counted = F.transform(F.array(listed), counts)
        return F.element_at(F.transform(counted, shares), 1)

    return score


def model_scorer(load: Callable[[], Callable[[list], list]], batch_size: int = 16) -> Scorer:
    """``load()`` returns a function from a list of texts to rows of three probabilities."""

    import pandas as pd

    @F.pandas_udf("positive double, negative double, neutral double")
    def batches(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = load()
        for texts in parts:
            rows = []
            for start in range(0, len(texts), batch_size):
                rows.extend(predict(texts.iloc[start : start + batch_size].tolist()))
            yield pd.DataFrame(rows, columns=["positive", "negative", "neutral"], dtype="float64")

    return batches


def score_sentiment(df: DataFrame, text: str = "title", scorer: Scorer | None = None, rounding=half_up) -> DataFrame:
    """Label, score and the three probabilities, added to the rows they belong to.

    The label is the most probable class, the first of (positive, negative, neutral) on a tie.
    """
    shares = unused(df, "_shares")
    scored = df.withColumn(shares, (scorer or word_list_scorer())(F.col(text)))
    share = {label: F.col(f"{shares}.{label}") for label in fv.SENTIMENT_LABELS}
    best = F.greatest(*share.values())
    first_best = F.coalesce(*[F.when(value == best, F.lit(label)) for label, value in share.items()])
    return scored.withColumns(
        {
            "sentiment": first_best,
            "sentiment_score": rounding(best, 4),
            **{f"prob_{label}": rounding(value, 4) for label, value in share.items()},
        }
    ).drop(shares)
