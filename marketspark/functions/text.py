"""Text columns: blanks, document texts, registrant ids, words."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv


def or_blank(column) -> Column:
    return F.coalesce(column if isinstance(column, Column) else F.col(column), F.lit(""))


def _shown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(fv.MISSING_TEXT))


def filing_text() -> Column:
    names = ("entity_name", "ticker", "form_type", "file_date", "period_of_report", "accession_no")
    return F.format_string(fv.FILING_TEXT, *[_shown(name) for name in names])


def news_text() -> Column:
    # format_number rounds ties to even.
    confidence = F.coalesce(F.format_number("sentiment_score", 2), F.lit("nan"))
    return F.format_string(
        fv.NEWS_TEXT,
        F.upper(_shown("sentiment")),
        _shown("ticker"),
        _shown("title"),
        confidence,
        _shown("source"),
        _shown("published_at"),
    )


def cik_of(accession: Column) -> Column:
    """Registrant id: the part before the first dash, without leading zeros."""
    return F.regexp_replace(F.split_part(accession, F.lit("-"), F.lit(1)), "^0+", "")


def ticker_of_file(path: Column) -> Column:
    """Ticker of a one-ticker file: its name without the last extension, upper-cased."""
    return F.upper(F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1))


def words(text: Column) -> Column:
    """Lower-case runs of ASCII letters (an empty string may lead or trail)."""
    return F.split(F.lower(text), "[^a-z]+")


def count_words(tokens: Column, wanted) -> Column:
    return F.size(F.filter(tokens, lambda word: word.isin(*wanted)))
