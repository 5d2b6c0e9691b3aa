"""User-facing reports, built from the operators."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.labels import macd_sign, rsi_band
from ..functions.numeric import half_up
from ..operators import aggregates as ag
from ..operators import filters as fl
from ..operators import ranking as rk
from ..operators import retrieval as rt
from ..operators.projections import indicator_view
from ..operators.windows import latest_n
from ..sources.scratch import stored


class SentimentReport(NamedTuple):
    summary: DataFrame
    articles: DataFrame


def sentiment_report(news: DataFrame, ticker: str, limit: int = 10, rounding=half_up) -> SentimentReport:
    """Summary and most confident articles of a ticker; both empty if it has none."""
    mine = fl.for_ticker(news, ticker)
    return SentimentReport(ag.sentiment_summary(mine, rounding=rounding), rk.top_articles(mine, limit=limit, rounding=rounding))


def interpretation(view: DataFrame) -> DataFrame:
    return view.select(
        "ticker",
        "date",
        rsi_band(F.col("rsi_14")).alias("rsi_signal"),
        macd_sign(F.col("macd_line")).alias("macd_signal"),
        "ma_signal",
        "vwap_signal",
    )


class IndicatorReport(NamedTuple):
    latest: DataFrame
    interpretation: DataFrame
    history: DataFrame


def indicator_report(indicators: DataFrame, ticker: str | None = None, n: int = 5, rounding=half_up) -> IndicatorReport:
    """Latest values, what they mean and the last n rows, for one ticker or for all of them."""
    if ticker is not None:
        indicators = fl.for_ticker(indicators, ticker)
    view = indicator_view(indicators, rounding)
    latest = latest_n(view, 1)
    return IndicatorReport(latest, interpretation(latest), latest_n(view, n))


def latest_rsi_band(indicators: DataFrame) -> DataFrame:
    """The last bar of every ticker with its RSI and band."""
    return latest_n(indicators, 1).select("ticker", "date", "close", "rsi_14", rsi_band(F.col("rsi_14")).alias("rsi_signal"))


class MoversReport(NamedTuple):
    date: DataFrame
    gainers: DataFrame
    losers: DataFrame


def top_movers(movers: DataFrame) -> MoversReport:
    shown = movers.select(
        "ticker", F.col("price_date").cast("string").alias("price_date"), "close_price",
        "daily_return_pct", "mover_type", "gainer_rank", "loser_rank",
    ).orderBy(F.col("daily_return_pct").desc(), "ticker")
    return MoversReport(shown.agg(F.max("price_date").alias("date")), fl.gainers(shown), fl.losers(shown))


def performance(returns: DataFrame, limit: int = 10) -> DataFrame:
    return rk.top_performers(returns, limit).select(*fv.HEADINGS["performance"])


def retrieve(questions: DataFrame, documents: DataFrame, n: int = 5, embedder: rt.Embedder | None = None, instruction: str = rt.INSTRUCTION) -> DataFrame:
    """Context and prompt for every row of (question_id, question), whatever their number. Runs jobs: the documents are
    stored first, as search and text both read them. Up to ``rt.FEW_QUESTIONS`` are sent to the documents; for more these are dealt to rings."""
    documents = stored(documents.select("collection", "id", "text", "embedding"))
    asked = rt.embed(questions, "question", embedder)
    few = asked.limit(rt.FEW_QUESTIONS + 1).count() <= rt.FEW_QUESTIONS
    hits = rt.with_text((rt.nearest if few else rt.nearest_join)(asked, documents, n), documents)
    found = questions.join(rt.assemble_context(hits), "question_id", "left")
    context = F.coalesce(F.col("context"), F.lit(fv.NO_DOCUMENTS))
    return found.select(
        "question_id",
        "question",
        F.coalesce(F.col("sources_used"), F.lit(0)).alias("sources_used"),
        context.alias("context"),
        rt.prompt_of(F.col("question"), context, instruction).alias("prompt"),
    )


def indicator_history(indicators: DataFrame, ticker: str, n: int = 252, rounding=half_up) -> DataFrame:
    return rk.last_n_ascending(indicator_view(indicators, rounding), ticker, n)


class SentimentBreakdown(NamedTuple):
    shares: DataFrame
    mean: DataFrame
    quantiles: DataFrame


def sentiment_breakdown(news: DataFrame, ticker: str, rounding=half_up) -> SentimentBreakdown:
    mine = fl.for_ticker(news, ticker)
    mean = mine.agg(
        F.count(F.lit(1)).alias("total_articles"),
        rounding(F.avg(F.round("sentiment_score", 4)), 2).alias("avg_confidence"),
    )
    return SentimentBreakdown(ag.label_distribution(mine, rounding=rounding), mean, ag.confidence_quantiles(mine))
