"""Independent SQL for the registered queries, over the given tables.

Written for DuckDB. Rounding that must not depend on the last bits of a floating-point sum is spelled
out by ``stable``. ``+ 0e0`` turns a negative zero into zero.
"""

import re
from textwrap import dedent

ORACLES: dict[str, str] = {}


def stable(value: str, places: int) -> str:
    return f"(floor(round({value}, {places + 4}) * 1e{places} + 0.5e0) / 1e{places})"


def rounded(value: str, places: int) -> str:
    return f"(round({value}, {places}) + 0e0)"


def add(name: str, body: str, *parts: str) -> None:
    """``parts`` are names of common table expressions from ``PARTS``, in order of dependency."""
    ORACLES[name] = _with(parts) + dedent(body).strip()


def _with(parts) -> str:
    wanted: list[str] = []

    def visit(part):
        needs, _ = PARTS[part]
        for need in needs:
            visit(need)
        if part not in wanted:
            wanted.append(part)

    for part in parts:
        visit(part)
    if not wanted:
        return ""
    return "WITH " + ",\n".join(f"{part} AS (\n{dedent(PARTS[part][1]).strip()}\n)" for part in wanted) + "\n"


GOOD = "'the', 'that', 'with', 'le', 'der'"
BAD = "'of', 'and', 'un', 'die'"
WORDS = "string_split_regex(lower(title), '[^a-z]+')"

LETTERS = "aein0123456789"


def letters(text: str) -> str:
    counts = [f"(length(lower({text})) - length(replace(lower({text}), '{letter}', '')))" for letter in LETTERS]
    total = f"length(regexp_replace(lower({text}), '[^a-z0-9]', '', 'g'))"
    return "[" + ", ".join(f"coalesce({count}::DOUBLE / nullif({total}, 0), 0e0)" for count in counts) + "]"


def trailing(rows: int) -> str:
    return f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


#: name -> (names it builds on, select)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "bars": (
        (),
        """
        SELECT 'T' || l_suppkey AS ticker, l_shipdate AS date,
               min(l_extendedprice) AS open, max(l_extendedprice * (1e0 + l_tax)) AS high,
               min(l_extendedprice * (1e0 - l_discount)) AS low, max(l_extendedprice) AS close,
               sum(l_quantity) AS volume
        FROM lineitem GROUP BY l_suppkey, l_shipdate
        """,
    ),
    "featured": (
        ("bars",),
        f"""
        SELECT *, round(high - low, 4) AS price_range,
               round((high + low + close) / 3, 4) AS typical_price,
               {rounded("close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1", 6)} AS daily_return
        FROM bars
        """,
    ),
    "silver": (
        ("featured",),
        """
        SELECT ticker, date, open, high, low, close, volume, daily_return, price_range, typical_price,
               round(price_range / close * 100, 4) AS range_pct, 'feed' AS data_source
        FROM featured
        """,
    ),
    "raw_prices": (
        (),
        """
        SELECT CASE WHEN l_orderkey % 73 = 0 THEN NULL ELSE 'T' || l_suppkey END AS ticker,
               l_shipdate AS date, l_extendedprice AS open,
               CASE WHEN l_orderkey % 83 = 0 THEN l_extendedprice * 0.5e0
                    ELSE l_extendedprice * (1e0 + l_tax) END AS high,
               l_extendedprice * (1e0 - l_discount) AS low,
               CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN 0e0
                    ELSE l_extendedprice END AS close,
               CASE WHEN l_orderkey % 79 = 0 THEN NULL WHEN l_orderkey % 71 = 0 THEN -1e0
                    ELSE l_quantity END AS volume,
               l_orderkey AS a1, l_linenumber AS a2, l_partkey AS a3
        FROM lineitem
        """,
    ),
    "keyed": (
        ("raw_prices",),
        "SELECT * FROM raw_prices WHERE ticker IS NOT NULL AND date IS NOT NULL AND close IS NOT NULL",
    ),
    "sane": (
        ("keyed",),
        "SELECT * FROM keyed WHERE close > 0 AND (high IS NULL OR low IS NULL OR high >= low)",
    ),
    "newest": (
        ("sane",),
        """
        SELECT * FROM sane QUALIFY row_number() OVER (
            PARTITION BY ticker, date
            ORDER BY a1 DESC, a2 DESC, a3 DESC, close DESC, volume DESC NULLS LAST, open DESC, high DESC, low DESC) = 1
        """,
    ),
    "valid": (
        ("newest",),
        """
        SELECT * FROM newest
        WHERE length(ticker) BETWEEN 1 AND 15 AND coalesce(open > 0, true) AND coalesce(high > 0, true)
          AND coalesce(low > 0, true) AND close > 0 AND coalesce(volume >= 0, true)
        """,
    ),
    "stepped": (
        ("silver",),
        """
        SELECT *, close - lag(close) OVER (PARTITION BY ticker ORDER BY date) AS change FROM silver
        """,
    ),
    "rolled": (
        ("stepped",),
        f"""
        SELECT *,
               avg(CASE WHEN change > 0 THEN change ELSE 0e0 END) OVER {trailing(14)} AS up,
               avg(CASE WHEN change < 0 THEN -change ELSE 0e0 END) OVER {trailing(14)} AS down,
               {stable(f"avg(close) OVER {trailing(12)} - avg(close) OVER {trailing(26)}", 4)} AS macd_line,
               {stable(f"avg(close) OVER {trailing(20)}", 4)} AS bb_middle,
               stddev_samp(close) OVER {trailing(20)} AS spread,
               {stable(f"sum(typical_price * volume) OVER {trailing(20)} / nullif(sum(volume) OVER {trailing(20)}, 0)", 4)} AS vwap,
               {stable(f"avg(close) OVER {trailing(50)}", 4)} AS sma_50,
               {stable(f"avg(close) OVER {trailing(200)}", 4)} AS sma_200
        FROM stepped
        """,
    ),
    "banded": (
        ("rolled",),
        f"""
        SELECT *,
               {stable(f"avg(macd_line) OVER {trailing(9)}", 4)} AS macd_signal,
               {stable("bb_middle + 2 * spread", 4)} AS bb_upper,
               {stable("bb_middle - 2 * spread", 4)} AS bb_lower
        FROM rolled
        """,
    ),
    "gold": (
        ("banded",),
        f"""
        SELECT ticker, date, open, high, low, close, volume, daily_return, price_range, typical_price, range_pct,
               data_source,
               {stable("100 - 100 / (1 + CASE WHEN down = 0 THEN 100e0 ELSE up / down END)", 2)} AS rsi_14,
               macd_line, macd_signal, {stable("macd_line - macd_signal", 4)} AS macd_histogram,
               bb_middle, bb_upper, bb_lower,
               {stable("(bb_upper - bb_lower) / nullif(bb_middle, 0) * 100", 4)} AS bb_bandwidth,
               {stable("(close - bb_lower) / nullif(bb_upper - bb_lower, 0)", 4)} AS bb_pct_b,
               vwap,
               CASE WHEN close > vwap THEN 'above' WHEN close < vwap THEN 'below' ELSE 'at' END AS vwap_signal,
               sma_50, sma_200,
               CASE WHEN sma_50 > sma_200 THEN 'golden' WHEN sma_50 < sma_200 THEN 'death' ELSE 'neutral' END AS ma_signal
        FROM banded
        """,
    ),
    "viewed": (
        ("gold",),
        f"""
        SELECT date::DATE AS date, ticker, {stable("close", 2)} AS close, {stable("rsi_14", 2)} AS rsi_14,
               {stable("macd_line", 4)} AS macd_line, {stable("macd_signal", 4)} AS macd_signal,
               {stable("macd_histogram", 4)} AS macd_histogram, {stable("bb_upper", 2)} AS bb_upper,
               {stable("bb_middle", 2)} AS bb_middle, {stable("bb_lower", 2)} AS bb_lower,
               {stable("bb_bandwidth", 4)} AS bb_bandwidth, {stable("vwap", 2)} AS vwap, vwap_signal,
               {stable("sma_50", 2)} AS sma_50, {stable("sma_200", 2)} AS sma_200, ma_signal
        FROM gold
        """,
    ),
}


def _cleaned(name: str, how) -> None:
    PARTS[name] = (
        ("valid",),
        f"""
        SELECT ticker, date, open, high, low, close, volume,
               {how("close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1", 6)} AS daily_return,
               {how("high - low", 4)} AS price_range, {how("(high + low + close) / 3", 4)} AS typical_price,
               {how(how("high - low", 4) + " / close * 100", 4)} AS range_pct, 'feed' AS data_source
        FROM valid
        """,
    )


def _staging(name: str, source: str, how) -> None:
    places = {
        "open_price": ("open", 4), "high_price": ("high", 4), "low_price": ("low", 4), "close_price": ("close", 4),
        "daily_return": ("daily_return", 6), "price_range": ("price_range", 4),
        "typical_price": ("typical_price", 4), "range_pct": ("range_pct", 4),
    }
    columns = ", ".join(f"{how(column, n)} AS {title}" for title, (column, n) in places.items())
    PARTS[name] = (
        (source,),
        f"""
        SELECT date::DATE AS price_date, ticker, CAST(volume AS BIGINT) AS volume, data_source, {columns}
        FROM {source}
        WHERE close > 0 AND date IS NOT NULL AND ticker IS NOT NULL
        """,
    )


def _returns(name: str, staging: str) -> None:
    percent = {
        "avg_daily_return_pct": "avg(daily_return)", "volatility_pct": "stddev_samp(daily_return)",
        "best_day_pct": "max(daily_return)", "worst_day_pct": "min(daily_return)",
    }
    columns = [f"{stable(value + ' * 100', 4)} AS {title}" for title, value in percent.items()]
    columns += [f"{stable(f'{how}(close_price)', 2)} AS {how}_close" for how in ("avg", "max", "min")]
    PARTS[name] = (
        (staging,),
        f"""
        SELECT ticker, count(*) AS trading_days, {", ".join(columns)}, {stable("avg(volume)", 0)} AS avg_volume,
               min(price_date) AS first_date, max(price_date) AS last_date,
               {stable("coalesce(avg(daily_return) / nullif(stddev_samp(daily_return), 0), 0e0)", 4)} AS return_risk_ratio
        FROM {staging} WHERE daily_return IS NOT NULL GROUP BY ticker
        """,
    )


def _movers(name: str, staging: str) -> None:
    """A rank is one more than the number of strictly better (or worse) returns of the day."""
    PARTS[f"{name}_day"] = (
        (staging,),
        f"SELECT * FROM {staging} WHERE daily_return IS NOT NULL AND price_date = (SELECT max(price_date) FROM {staging})",
    )
    PARTS[name] = (
        (f"{name}_day",),
        f"""
        SELECT ticker, price_date, close_price, {rounded("daily_return * 100", 4)} AS daily_return_pct, volume,
               round(range_pct, 4) AS range_pct, gainer_rank, loser_rank,
               CASE WHEN gainer_rank <= 10 THEN 'top_gainer' ELSE 'top_loser' END AS mover_type
        FROM (SELECT day.*, 1 + (SELECT count(*) FROM {name}_day better WHERE better.daily_return > day.daily_return) AS gainer_rank,
                     1 + (SELECT count(*) FROM {name}_day worse WHERE worse.daily_return < day.daily_return) AS loser_rank
              FROM {name}_day day)
        WHERE gainer_rank <= 10 OR loser_rank <= 10
        """,
    )


_cleaned("cleaned", rounded)
_cleaned("cleaned_stable", stable)
_staging("stg", "silver", rounded)
_staging("stg_clean", "cleaned_stable", stable)
#: The indicators over cleaned rows: the same steps, each on the one before.
for _step, _base in (("stepped", "silver"), ("rolled", "stepped"), ("banded", "rolled"), ("gold", "banded")):
    _from = "cleaned_stable" if _base == "silver" else _base + "_clean"
    PARTS[_step + "_clean"] = ((_from,), re.sub(rf"FROM {_base}\b", f"FROM {_from}", PARTS[_step][1]))
for _suffix in ("", "_clean"):
    _returns("returns" + _suffix, "stg" + _suffix)
    _movers("movers" + _suffix, "stg" + _suffix)

PARTS |= {
    "scored_news": (
        (),
        f"""
        SELECT 'T' || user_id AS ticker, props AS title, event_type AS source,
               CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'signup' THEN 'positive'
                               WHEN 'error' THEN 'negative' ELSE 'neutral' END AS sentiment,
               {stable("0.34e0 + 0.66e0 * value / (value + 100e0)", 4)} AS sentiment_score,
               ts AS published_at, 'event/' || event_id AS url
        FROM events
        """,
    ),
    "headlines": (
        (),
        """
        SELECT 'T' || (doc_id % 50) AS ticker,
               CASE WHEN doc_id % 41 = 0 THEN '' WHEN doc_id % 43 = 0 THEN NULL ELSE text END AS title,
               lang AS description, 'doc/' || doc_id AS url, source, doc_id::VARCHAR AS published_at
        FROM documents
        """,
    ),
    "hits": (
        ("headlines",),
        f"""
        SELECT *, len(list_filter({WORDS}, lambda w: w IN ({GOOD})))::DOUBLE AS good,
               len(list_filter({WORDS}, lambda w: w IN ({BAD})))::DOUBLE AS bad
        FROM headlines WHERE title <> ''
        """,
    ),
    "powers": (
        ("hits",),
        """
        SELECT *, exp(good - greatest(good, bad, 1e0)) AS p, exp(bad - greatest(good, bad, 1e0)) AS n,
               exp(1e0 - greatest(good, bad, 1e0)) AS u
        FROM hits
        """,
    ),
    "scored_headlines": (
        ("powers",),
        f"""
        SELECT ticker, title, description, url, source, published_at,
               CASE WHEN p >= n AND p >= u THEN 'positive' WHEN n >= u THEN 'negative' ELSE 'neutral' END AS sentiment,
               {stable("greatest(p, n, u) / (p + n + u)", 4)} AS sentiment_score,
               {stable("p / (p + n + u)", 4)} AS prob_positive, {stable("n / (p + n + u)", 4)} AS prob_negative,
               {stable("u / (p + n + u)", 4)} AS prob_neutral
        FROM powers
        """,
    ),
    "filings": (
        (),
        """
        SELECT 'T' || o_custkey AS ticker, CASE o_orderstatus WHEN 'F' THEN '10-K' ELSE '10-Q' END AS form_type,
               c_name AS entity_name, strftime(o_orderdate, '%Y-%m-01') AS period_of_report,
               strftime(o_orderdate, '%Y-%m-%d') AS file_date,
               lpad(o_custkey::VARCHAR, 10, '0') || '-' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') || '-'
                 || lpad(o_orderkey::VARCHAR, 8, '0') AS accession_no
        FROM orders JOIN customer ON c_custkey = o_custkey
        """,
    ),
    "filing_docs": (
        ("filings",),
        """
        SELECT 'sec_filings' AS collection, 'filing_' || accession_no AS id,
               entity_name || ' (' || ticker || ') filed a ' || form_type || ' on ' || file_date
                 || ' for the period ending ' || period_of_report || '. Accession number: ' || accession_no || '.' AS text,
               ticker, form_type, file_date, period_of_report AS period
        FROM filings
        """,
    ),
    "news_docs": (
        ("scored_headlines",),
        """
        SELECT 'news_sentiment' AS collection, 'news_' || sha256(ticker || '|' || url) AS id,
               '[' || upper(sentiment) || '] ' || ticker || ': ' || title || ' (confidence: '
                 || printf('%.2f', sentiment_score) || ', source: ' || source || ', date: ' || published_at || ')' AS text,
               ticker, sentiment, sentiment_score AS score, source
        FROM scored_headlines
        """,
    ),
    "vectors": (
        (),
        """
        SELECT vec_id, CASE WHEN label % 2 = 0 THEN 'sec_filings' ELSE 'news_sentiment' END AS collection,
               embedding::DOUBLE[] AS v
        FROM embeddings
        """,
    ),
    "docs": (
        ("filing_docs", "news_docs"),
        """
        SELECT collection, id, text FROM filing_docs UNION ALL SELECT collection, id, text FROM news_docs
        """,
    ),
    "doc_vectors": (("docs",), f"SELECT collection, id, text, {letters('text')} AS v FROM docs"),
    "question_vectors": ((), f"SELECT item_id, text, {letters('text')} AS v FROM benchmark"),
    "near": (
        ("doc_vectors", "question_vectors"),
        """
        SELECT item_id, collection, d.text, row_number() OVER (
                   PARTITION BY item_id, collection ORDER BY round(list_distance(q.v, d.v) ** 2, 6), id) AS place
        FROM question_vectors q, doc_vectors d QUALIFY place <= 5
        """,
    ),
    "contexts": (
        ("near",),
        """
        SELECT item_id, count(*) AS sources_used,
               string_agg(text, chr(10) || chr(10) ORDER BY collection DESC, place) AS context
        FROM near GROUP BY item_id
        """,
    ),
}

# --- indicators -----------------------------------------------------------------
add("bars", "SELECT ticker, date, open, high, low, close, volume FROM bars", "bars")
add("prev_close", "SELECT ticker, date, close, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS prev_close FROM bars", "bars")
add("daily_return", "SELECT ticker, date, close, daily_return FROM silver", "silver")
add("price_features", "SELECT ticker, date, price_range, typical_price, range_pct, year(date) AS year FROM silver", "silver")
add("rsi", "SELECT ticker, date, close, rsi_14 FROM gold", "gold")
add(
    "latest_rsi_band",
    """
    SELECT ticker, date, close, rsi_14,
           CASE WHEN rsi_14 > 70 THEN 'overbought' WHEN rsi_14 < 30 THEN 'oversold' ELSE 'neutral' END AS rsi_signal
    FROM gold QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1
    """,
    "gold",
)
add(
    "macd",
    """
    SELECT ticker, date, macd_line, macd_signal, macd_histogram, if(macd_line > 0, 'bullish', 'bearish') AS macd_sign
    FROM gold
    """,
    "gold",
)
add("bollinger", "SELECT ticker, date, bb_middle, bb_upper, bb_lower, bb_bandwidth, bb_pct_b FROM gold", "gold")
add("vwap", "SELECT ticker, date, vwap, vwap_signal FROM gold", "gold")
add("sma", "SELECT ticker, date, sma_50, sma_200, ma_signal FROM gold", "gold")
add("indicators", "SELECT * FROM gold", "gold")
add("indicators_split", "SELECT * FROM gold", "gold")
add("indicators_since", "SELECT * FROM gold WHERE date >= TIMESTAMP '1999-01-01'", "gold")
add("latest_indicators", "SELECT * FROM gold QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 5", "gold")
add("indicator_view", "SELECT * FROM viewed", "viewed")
add("indicator_report", "SELECT * FROM viewed QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 5", "viewed")
add(
    "indicator_interpretation",
    """
    SELECT ticker, date,
           CASE WHEN rsi_14 > 70 THEN 'overbought' WHEN rsi_14 < 30 THEN 'oversold' ELSE 'neutral' END AS rsi_signal,
           if(macd_line > 0, 'bullish', 'bearish') AS macd_signal, ma_signal, vwap_signal
    FROM viewed QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1
    """,
    "viewed",
)
add("indicator_report_ticker", "SELECT * FROM viewed WHERE ticker = 'T7' ORDER BY date DESC LIMIT 1", "viewed")
add("indicator_history", "SELECT * FROM (SELECT * FROM viewed WHERE ticker = 'T7' ORDER BY date DESC LIMIT 252) ORDER BY date", "viewed")

# --- cleaning -------------------------------------------------------------------
add(
    "safe_cast",
    """
    SELECT ticker, CASE WHEN a1 % 19 = 0 THEN NULL ELSE date END AS date,
           CASE WHEN a1 % 17 = 0 OR a1 % 23 = 0 THEN NULL ELSE a2::DOUBLE END AS close, a3::DOUBLE AS volume, a1,
           NULL::DOUBLE AS open, NULL::DOUBLE AS high, NULL::DOUBLE AS low
    FROM raw_prices
    """,
    "raw_prices",
)
add("clean_prices", "SELECT * FROM cleaned", "cleaned")
add("clean_prices_split", "SELECT * FROM cleaned", "cleaned")
_STATS = """
    SELECT 'feed' AS source, (SELECT count(*) FROM raw_prices) AS input_rows, (SELECT count(*) FROM valid) AS output_rows,
           (SELECT count(*) FROM raw_prices) - (SELECT count(*) FROM keyed) AS dropped_nulls,
           (SELECT count(*) FROM keyed) - (SELECT count(*) FROM sane) AS dropped_zeros,
           (SELECT count(*) FROM keyed WHERE close > 0 AND high < low) AS dropped_ohlc,
           (SELECT count(*) FROM sane) - (SELECT count(*) FROM newest) AS dropped_dupes,
           (SELECT count(*) FROM newest) - (SELECT count(*) FROM valid) AS validation_errors
"""
add("clean_stats", _STATS, "valid")
add("refresh_stats", _STATS, "valid")
add("rejects", "SELECT ticker, date, volume, 'volume_not_negative' AS failed_rules FROM newest WHERE volume < 0", "newest")
add(
    "dedup_last",
    """
    SELECT * FROM keyed QUALIFY row_number() OVER (
        PARTITION BY ticker, date
        ORDER BY a1 DESC, a2 DESC, a3 DESC, close DESC, volume DESC NULLS LAST, open DESC, high DESC, low DESC) = 1
    """,
    "keyed",
)
add("price_filters", "SELECT * FROM sane", "sane")

# --- staging and marts ----------------------------------------------------------
add("stg_prices", "SELECT * FROM stg", "stg")
add("staging_view", "SELECT * FROM stg", "stg")
add("mart_daily_returns", "SELECT * FROM returns ORDER BY avg_daily_return_pct DESC, ticker", "returns")
add("mart_top_movers", "SELECT * FROM movers ORDER BY daily_return_pct DESC, ticker", "movers")
_BOTH_RANKS = """
    SELECT ticker, price_date, daily_return, (rank() OVER (ORDER BY daily_return DESC))::BIGINT AS gainer_rank,
           (rank() OVER (ORDER BY daily_return))::BIGINT AS loser_rank
    FROM stg WHERE daily_return IS NOT NULL
"""
add("rank_movers", _BOTH_RANKS, "stg")
add(
    "rank_movers_odd",
    """
    SELECT *, (rank() OVER (ORDER BY daily_return DESC))::BIGINT AS gainer_rank,
           (rank() OVER (ORDER BY daily_return))::BIGINT AS loser_rank
    FROM (SELECT ticker, price_date, CASE WHEN day(price_date) % 2 = 0 THEN 0e0 ELSE daily_return END AS daily_return
          FROM stg WHERE daily_return IS NOT NULL AND day(price_date) NOT IN (3, 5))
    """,
    "stg",
)
add(
    "rank_movers_ranges",
    """
    SELECT *, (rank() OVER (ORDER BY daily_return DESC))::BIGINT AS gainer_rank,
           (rank() OVER (ORDER BY daily_return))::BIGINT AS loser_rank
    FROM (SELECT ticker, price_date, CASE WHEN day(price_date) % 3 = 0 THEN 0e0 ELSE daily_return END AS daily_return
          FROM stg WHERE daily_return IS NOT NULL)
    """,
    "stg",
)
add("keep_movers", f"SELECT * FROM ({_BOTH_RANKS}) WHERE gainer_rank <= 25 OR loser_rank <= 25", "stg")
add("latest_date", "SELECT max(price_date) AS max_date FROM stg", "stg")
add("at_latest_date", "SELECT ticker, price_date, close_price FROM stg WHERE price_date = (SELECT max(price_date) FROM stg)", "stg")
for _side in ("gainer", "loser"):
    add(
        f"top_{_side}s",
        f"""
        SELECT ticker, price_date::VARCHAR AS price_date, close_price, daily_return_pct, mover_type, gainer_rank, loser_rank
        FROM movers WHERE mover_type = 'top_{_side}'
        """,
        "movers",
    )
_PERFORMANCE = """
    SELECT ticker, trading_days, avg_daily_return_pct, volatility_pct, best_day_pct, worst_day_pct, return_risk_ratio, avg_close
    FROM returns ORDER BY avg_daily_return_pct DESC, ticker LIMIT 10
"""
add("performance", _PERFORMANCE, "returns")
add(
    "display_names",
    f"""
    SELECT ticker AS "Ticker", trading_days AS "Days", avg_daily_return_pct AS "Avg Return %", volatility_pct AS "Volatility %",
           best_day_pct AS "Best Day %", worst_day_pct AS "Worst Day %", return_risk_ratio AS "Risk Ratio", avg_close AS "Avg Price"
    FROM ({_PERFORMANCE})
    """,
    "returns",
)

add("movers_date", "SELECT max(price_date)::VARCHAR AS date FROM movers", "movers")
add(
    "display_movers",
    """
    SELECT ticker AS "Ticker", close_price AS "Price ($)", daily_return_pct AS "Return (%)" FROM movers
    WHERE mover_type = 'top_gainer' ORDER BY daily_return_pct DESC, ticker
    """,
    "movers",
)

# --- sentiment ------------------------------------------------------------------
_SCORES = "SELECT ticker, url, sentiment, sentiment_score, prob_positive, prob_negative, prob_neutral FROM scored_headlines"
add("score_sentiment", _SCORES, "scored_headlines")
add("score_sentiment_model", _SCORES, "scored_headlines")


def _labels(names: dict[str, str]) -> str:
    return ", ".join(f"count(*) FILTER (sentiment = '{label}') AS {name}" for label, name in names.items())


def _summary(table: str, where: str = "") -> str:
    shown = _labels({"positive": "bullish", "negative": "bearish", "neutral": "neutral"})
    return f"""
        SELECT ticker, count(*) AS total_articles, {shown}, {stable("avg(sentiment_score)", 4)} AS avg_confidence
        FROM {table} {where} GROUP BY ticker
    """


_BY_TICKER = f"""
    SELECT ticker, count(*) AS total, {_labels({name: name for name in ("positive", "negative", "neutral")})},
           {stable("avg(sentiment_score)", 4)} AS avg_confidence
    FROM scored_news GROUP BY ticker
"""
add("sentiment_summary", _summary("scored_news"), "scored_news")
add("sentiment_by_ticker", _BY_TICKER, "scored_news")
add("csv_summary", _BY_TICKER, "scored_news")
add(
    "sentiment_distribution",
    f"""
    SELECT sentiment, count(*) AS count, {stable("count(*) * 100e0 / (SELECT count(*) FROM scored_news)", 1)} AS pct
    FROM scored_news GROUP BY sentiment
    """,
    "scored_news",
)
add(
    "sentiment_distribution_by_ticker",
    f"""
    SELECT ticker, sentiment, n AS count, {stable("n * 100e0 / sum(n) OVER (PARTITION BY ticker)", 1)} AS pct
    FROM (SELECT ticker, sentiment, count(*) AS n FROM scored_news GROUP BY ALL)
    """,
    "scored_news",
)
add(
    "sentiment_breakdown_quantiles",
    """
    SELECT sentiment, count(*) AS count, min(sentiment_score) AS minimum, round(quantile_cont(sentiment_score, 0.25), 6) AS q1,
           round(quantile_cont(sentiment_score, 0.5), 6) AS median, round(quantile_cont(sentiment_score, 0.75), 6) AS q3,
           max(sentiment_score) AS maximum
    FROM scored_news WHERE ticker = 'T7' GROUP BY sentiment
    """,
    "scored_news",
)
add(
    "confidence_quantiles",
    """
    SELECT sentiment, count(*) AS count, min(sentiment_score) AS minimum, round(quantile_cont(sentiment_score, 0.25), 6) AS q1,
           round(quantile_cont(sentiment_score, 0.5), 6) AS median, round(quantile_cont(sentiment_score, 0.75), 6) AS q3,
           max(sentiment_score) AS maximum
    FROM scored_news GROUP BY sentiment
    """,
    "scored_news",
)
_ARTICLES = """
    SELECT ticker, title, sentiment, sentiment_score AS confidence, source, published_at
    FROM scored_news {where} ORDER BY sentiment_score DESC, published_at, title, url LIMIT {n}
"""
add("top_articles", _ARTICLES.format(where="", n=25), "scored_news")
add(
    "display_articles",
    """
    SELECT title AS "Title", sentiment AS "Sentiment", confidence AS "Confidence", source AS "Source", published_at AS "Published"
    FROM (""" + _ARTICLES.format(where="", n=25) + ")",
    "scored_news",
)
add(
    "newest_articles",
    """
    SELECT ticker, url, published_at FROM scored_news
    QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY published_at DESC, url) <= 100
    """,
    "scored_news",
)


def _metrics(where: str = "", seconds: str = "2e0", extra: str = "") -> str:
    per_label = ", ".join(
        f"count(*) FILTER (sentiment = '{label}') AS {label}_count, "
        f"{stable(f'''count(*) FILTER (sentiment = '{label}') * 100e0 / greatest(count(*), 1)''', 2)} AS {label}_pct"
        for label in ("positive", "negative", "neutral")
    )
    return f"""
        SELECT count(*) AS total_headlines, {stable(f"count(*) / {seconds}", 2)} AS headlines_per_second,
               {seconds} AS elapsed_seconds, {per_label}{extra}
        FROM scored_news {where}
    """


add("run_metrics", _metrics(extra=", '16' AS batch_size"), "scored_news")
add(
    "run_history",
    " UNION ALL ".join(
        _metrics(f"WHERE source {kind} ('view', 'click')", "4e0", f", 'run-{run}' AS run_id, '{day}T00:00:00' AS start_time")
        for run, kind, day in (("a", "IN", "2024-01-01"), ("b", "NOT IN", "2024-01-02"))
    ),
    "scored_news",
)
add("sentiment_report_summary", _summary("scored_news", "WHERE ticker = 'T7'"), "scored_news")
add("sentiment_report_articles", _ARTICLES.format(where="WHERE ticker = 'T7'", n=10), "scored_news")
add(
    "sentiment_breakdown",
    f"""
    SELECT sentiment, n AS count, {stable("n * 100e0 / sum(n) OVER ()", 1)} AS pct
    FROM (SELECT sentiment, count(*) AS n FROM scored_news WHERE ticker = 'T7' GROUP BY sentiment)
    """,
    "scored_news",
)
add(
    "sentiment_breakdown_mean",
    f"SELECT count(*) AS total_articles, {stable('avg(sentiment_score)', 2)} AS avg_confidence FROM scored_news WHERE ticker = 'T7'",
    "scored_news",
)
add("sentiment_gold", _summary("scored_headlines"), "scored_headlines")

# --- documents and retrieval ----------------------------------------------------
add("filing_docs", "SELECT * FROM filing_docs", "filing_docs")
add("news_docs", "SELECT * FROM news_docs", "news_docs")
add("sample_rows", "SELECT * FROM scored_news ORDER BY md5(url || '|0'), url LIMIT 500", "scored_news")
add("first_docs", "SELECT ticker, url FROM headlines WHERE title <> '' ORDER BY ticker, url LIMIT 1000", "headlines")
add(
    "documents_written",
    "SELECT collection, id, text, ticker FROM filing_docs UNION ALL SELECT collection, id, text, ticker FROM news_docs",
    "filing_docs", "news_docs",
)
add(
    "documents_default",
    "SELECT collection, id, text, ticker FROM filing_docs UNION ALL SELECT collection, id, text, ticker FROM news_docs",
    "filing_docs", "news_docs",
)


def _murmur(word: str) -> str:
    """32-bit MurmurHash3 of a word's UTF-8 bytes with seed 42: blocks of four bytes, then the rest, then the last mix."""
    mask = "4294967295::UBIGINT"

    def turned(value, bits):
        return f"(((({value}) << {bits}) | (({value}) >> {32 - bits})) & {mask})"

    def mixed(block):
        return f"(({turned(f'((({block}) * 3432918353::UBIGINT) & {mask})', 15)} * 461845907::UBIGINT) & {mask})"

    def byte(place):
        return f"((instr('0123456789ABCDEF', h[2 * ({place}) + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * ({place}) + 2]) - 1)::UBIGINT"

    def block(start):
        return " | ".join(f"({byte(f'{start} + {n}')} << {8 * n})" for n in range(4))

    rest = " | ".join(f"(CASE WHEN n % 4 > {k} THEN {byte(f'n - n % 4 + {k}')} << {8 * k} ELSE 0::UBIGINT END)" for k in range(3))
    return f"""
        SELECT word, xor(f, f >> 16) & 255 AS place FROM (
        SELECT word, (xor(e, e >> 13) * 3266489909::UBIGINT) & {mask} AS f FROM (
        SELECT word, (xor(d, d >> 16) * 2246822507::UBIGINT) & {mask} AS e FROM (
        SELECT word, xor(CASE WHEN n % 4 > 0 THEN xor(c, {mixed("r")}) ELSE c END, n::UBIGINT) AS d FROM (
        SELECT word, n, {rest} AS r, list_reduce(list_prepend(42::UBIGINT, list_transform(range(0, n // 4), lambda i: {mixed(block("4 * i"))})),
                                   lambda x, k: ({turned("xor(x, k)", 13)} * 5 + 3864292196::UBIGINT) & {mask}) AS c
        FROM (SELECT word, hex(encode(word)) AS h, octet_length(encode(word)) AS n FROM ({word}))))))"""


add(
    "embed_documents",
    f"""
    WITH texts AS (SELECT doc_id, unnest(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM documents),
         counted AS (SELECT doc_id, word, count(*) AS n FROM texts WHERE word <> '' GROUP BY ALL),
         hashed AS ({_murmur("SELECT DISTINCT word FROM counted")}),
         sums AS (SELECT doc_id, place, sum(n)::DOUBLE AS n FROM counted JOIN hashed USING (word) GROUP BY ALL),
         maps AS (SELECT doc_id, map(list(place), list(n)) AS m, sqrt(sum(n * n)) AS size FROM sums GROUP BY doc_id)
    SELECT doc_id, list_transform(range(0, 256), lambda i: (coalesce(m[i::UBIGINT], 0e0) / coalesce(size, 1e0))::FLOAT) AS embedding
    FROM documents LEFT JOIN maps USING (doc_id)
    """,
)
add(
    "model_embedder",
    """
    SELECT doc_id, [strlen(coalesce(text, '')), length(coalesce(text, '')) - length(replace(coalesce(text, ''), ' ', '')),
                    length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), ''))]::FLOAT[] AS embedding
    FROM documents
    """,
)
add("collection_sizes", "SELECT collection, count(*) AS documents FROM docs GROUP BY collection", "docs")
_KNN = """
    SELECT q.vec_id AS question_id, d.collection, d.vec_id::VARCHAR AS id,
           round(list_distance(q.v, d.v) ** 2, 6) AS distance,
           row_number() OVER (PARTITION BY q.vec_id, d.collection
                              ORDER BY round(list_distance(q.v, d.v) ** 2, 6), d.vec_id::VARCHAR) AS rank
    FROM vectors q, vectors d QUALIFY rank <= 5
"""
add("knn", _KNN, "vectors")
add("knn_blocks", _KNN, "vectors")
add(
    "knn_scan",
    f"""
    SELECT n_nationkey AS question_id, collection, id, round(list_distance(q.v, d.v) ** 2, 6) AS distance,
           row_number() OVER (PARTITION BY n_nationkey, collection ORDER BY round(list_distance(q.v, d.v) ** 2, 6), id) AS rank
    FROM (SELECT n_nationkey, {letters("n_name || ' quarterly report'")} AS v FROM nation) q, doc_vectors d QUALIFY rank <= 5
    """,
    "doc_vectors",
)
add(
    "retrieve",
    """
    SELECT item_id AS question_id, text AS question, sources_used, context,
           'Answer the question from the context alone. If the context does not hold the answer, say so. '
             || 'Keep to the facts and be brief.' || chr(10) || chr(10) || 'CONTEXT:' || chr(10) || context || chr(10) || chr(10)
             || 'QUESTION: ' || text || chr(10) || chr(10) || 'ANSWER:' AS prompt
    FROM benchmark JOIN contexts USING (item_id)
    """,
    "contexts",
)
ORACLES["retrieve_relanded"] = ORACLES["retrieve"]

# --- quality --------------------------------------------------------------------


def _check(name: str, passes: str, value: str, expected: str, source: str, otherwise: str = "failed") -> str:
    return (
        f"SELECT '{name}' AS \"check\", CASE WHEN {passes} THEN 'passed' ELSE '{otherwise}' END AS status, "
        f"({value})::VARCHAR AS value, '{expected}' AS expected FROM {source}"
    )


def _null_check(column: str, source: str) -> str:
    bad = f"count(*) FILTER ({column} IS NULL)"
    return _check(f"not_null_{column}", f"{bad} = 0", bad, "0", source)


def _unique_check(keys: tuple[str, ...], source: str) -> str:
    listed = ", ".join(keys)
    grouped = f"(SELECT {listed} FROM {source} WHERE {' AND '.join(key + ' IS NOT NULL' for key in keys)} GROUP BY {listed} HAVING count(*) > 1)"
    return _check("unique_" + "_".join(keys), "count(*) = 0", "count(*)", "0", grouped)


_PRICE_CHECKS = [
    _check("min_rows", "count(*) >= 70000", "count(*)", ">= 70000", "raw_prices"),
    _check("positive_close", "count(*) FILTER (close <= 0 OR close IS NULL) = 0", "count(*) FILTER (close <= 0 OR close IS NULL)", "0", "raw_prices"),
    _check("date_starts_in_year", "year(min(date)) = 2019", "min(date)::DATE", "2019", "raw_prices"),
    _check("ticker_count", "count(DISTINCT ticker) = 50", "count(DISTINCT ticker)", "50", "raw_prices"),
    _check("date_not_in_future", "count(*) FILTER (date > current_date) = 0", "count(*) FILTER (date > current_date)", "0", "raw_prices"),
]
_SHARE = "round(count(*) FILTER (title <> '') * 100e0 / greatest(count(*), 1), 1)"
_NEWS_CHECKS = [
    _check("min_news", "count(*) >= 500", "count(*)", ">= 500", "headlines"),
    _check("title_present_pct", f"{_SHARE} >= 90", _SHARE, ">= 90.0", "headlines", "warned"),
    _check("description_has_values", "count(DISTINCT description) FILTER (description IN ('en', 'fr', 'xx')) = 3",
           "count(DISTINCT description) FILTER (description IN ('en', 'fr', 'xx'))", "3", "headlines"),
]
_FILING_CHECKS = [
    _check("min_filings", "count(*) >= 400", "count(*)", ">= 400", "filings"),
    _check("form_type_has_values", "count(DISTINCT form_type) FILTER (form_type IN ('10-K', '10-Q')) = 2",
           "count(DISTINCT form_type) FILTER (form_type IN ('10-K', '10-Q'))", "2", "filings"),
]


def _all(checks) -> str:
    return "\nUNION ALL\n".join(checks)


add("dq_not_null", _all(_null_check(name, "raw_prices") for name in ("ticker", "date", "open", "close", "volume")), "raw_prices")
add("dq_unique", _all([_unique_check(("l_orderkey", "l_linenumber"), "lineitem"), _unique_check(("ticker", "date"), "bars")]), "bars")
add("dq_thresholds", _all(_PRICE_CHECKS), "raw_prices")
add("dq_news", _all(_NEWS_CHECKS), "headlines")
add("dq_filings", _all(_FILING_CHECKS), "filings")
add(
    "dq_universe",
    _all(
        [
            _check("universe_size", "count(DISTINCT ticker) = 50", "count(DISTINCT ticker)", "50", "bars"),
            *[
                _check(f"universe_has_{name}", f"bool_or(ticker = '{name}')", f"count(DISTINCT ticker) FILTER (ticker = '{name}')", "> 0", "bars")
                for name in ("T0", "T7")
            ],
            _check("universe_without_PXD", "NOT bool_or(ticker = 'PXD')", "count(DISTINCT ticker) FILTER (ticker = 'PXD')", "0", "bars"),
        ]
    ),
    "bars",
)
add(
    "dq_tally",
    f"SELECT status, count(*) AS checks FROM ({_all(_PRICE_CHECKS + _FILING_CHECKS + _NEWS_CHECKS)}) GROUP BY status",
    "raw_prices", "filings", "headlines",
)
add(
    "dq_test_summary",
    """
    SELECT count(*) AS failures, count(*) <> 0 AS should_warn, count(*) <> 0 AS should_error
    FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    """,
)
add(
    "dataset_health",
    "\nUNION ALL\n".join(
        [f"SELECT '{name}' AS dataset, 'healthy' AS status, count(*) AS rows, NULL::VARCHAR AS error FROM {name}" for name in ("lineitem", "events", "documents")]
        + ["SELECT 'no_such_table', 'healthy', NULL, 'PATH_NOT_FOUND'"]
    ),
)
add(
    "health_broken",
    """
    SELECT 'good' AS dataset, 'healthy' AS status, count(*) AS rows, NULL::VARCHAR AS error FROM nation
    UNION ALL SELECT 'mixed', 'healthy', count(*), 'UNREADABLE_FILES: 1' FROM region
    UNION ALL SELECT 'text', 'healthy', NULL, 'UNREADABLE_FILES: 1'
    UNION ALL SELECT 'gone', 'healthy', NULL, 'PATH_NOT_FOUND'
    """,
)
add(
    "missing_columns",
    """
    SELECT without, kind, CASE kind WHEN 'clean' THEN 0 ELSE (SELECT count(*) FROM raw_prices) END::BIGINT AS rows
    FROM (SELECT unnest(['ticker', 'date', 'close']) AS without), (SELECT unnest(['clean', 'input']) AS kind)
    """,
    "raw_prices",
)
add("dataset_counts", "SELECT count(*) AS rows, count(DISTINCT ticker) AS keys FROM raw_prices", "raw_prices")
add("date_span", "SELECT min(date)::DATE AS min_date, max(date)::DATE AS max_date FROM raw_prices", "raw_prices")
add(
    "share_non_empty",
    f"""
    SELECT count(*) AS total, count(*) FILTER (coalesce(title, '') = '') AS empty,
           {stable("count(*) FILTER (title <> '') * 100e0 / greatest(count(*), 1)", 1)} AS pct_ok
    FROM headlines
    """,
    "headlines",
)
add("form_counts", "SELECT form_type, count(*) AS n FROM filings GROUP BY form_type", "filings")
add("duplicates", "SELECT ticker, date, count(*) AS n_records FROM raw_prices WHERE ticker IS NOT NULL AND date IS NOT NULL GROUP BY ticker, date HAVING count(*) > 1", "raw_prices")

# --- landing: sources, sinks, coverage ------------------------------------------
add("bulk_csv_roundtrip", "SELECT date, ticker, open, high, low, close, volume, 'bulk' AS source, 0e0 AS open_interest FROM bars", "bars")
add(
    "bulk_load_summary",
    "SELECT count(*) AS total_rows, count(DISTINCT (ticker, day(date) % 2)) AS converted, 0::BIGINT AS skipped FROM bars",
    "bars",
)
PARTS["bulk_lines"] = (
    ("bars",),
    """
    SELECT ticker, substr(ticker, 2)::INTEGER AS number, date, floor(close) AS close, floor(volume) AS volume,
           length(strftime(date, '%Y-%m-%d') || ',' || floor(close)::BIGINT || ',' || floor(volume)::BIGINT) + 1 AS size
    FROM bars WHERE substr(ticker, 2)::INTEGER % 7 <> 0
    """,
)
add(
    "bulk_first_files",
    """
    SELECT date, ticker_name AS ticker, close, volume
    FROM (SELECT *, 't' || lpad(substr(ticker, 2), 9, '0') AS ticker_name FROM bulk_lines)
    WHERE number % 11 <> 0 AND ticker IN (SELECT ticker FROM bars GROUP BY ticker ORDER BY 't' || lpad(substr(ticker, 2), 9, '0') LIMIT 3)
    """,
    "bulk_lines",
)
add(
    "bulk_load_sizes",
    """
    SELECT count(*) AS total_rows, count(DISTINCT ticker) AS converted, (SELECT count(DISTINCT ticker) FROM bars) - count(DISTINCT ticker) AS skipped,
           (sum(size) + count(DISTINCT ticker) * length('Date,Close,Vol ') )::BIGINT AS raw_bytes, true AS written_agrees, true AS savings_agree
    FROM bulk_lines WHERE number % 11 <> 0
    """,
    "bulk_lines",
)
add("bulk_csv_breaks", "SELECT date, ticker, close FROM bars", "bars")
add(
    "bulk_csv_quoted",
    "SELECT date, ticker, CASE WHEN day(date) <> 1 THEN open END AS open, close, volume, 7e0 AS open_interest FROM bars",
    "bars",
)
add("normalise_prices", "SELECT date, ticker, open, high, low, close, volume, 'feed' AS source FROM bars", "bars")
PARTS["articles"] = (
    (),
    """
    SELECT 'T' || (doc_id % 50) AS ticker, CASE WHEN doc_id % 11 = 0 THEN '' ELSE text END AS title,
           CASE WHEN doc_id % 7 = 0 THEN '' ELSE lang END AS description, 'doc/' || doc_id AS url,
           CASE WHEN doc_id % 5 = 0 THEN '' ELSE source END AS source, doc_id::VARCHAR AS published_at, '' AS content
    FROM documents WHERE doc_id % 13 <> 0
    UNION ALL
    SELECT 'T' || (doc_id % 50), lang, '', 'short/' || doc_id, '', doc_id::VARCHAR, source
    FROM documents WHERE doc_id % 13 <> 0 AND doc_id % 2 = 0
    """,
)
add("news_flatten", "SELECT * FROM articles", "articles")
add("news_run_dated", "SELECT ticker, url, source, published_at, DATE '2024-01-31' AS date, '2024-01-31' AS ingestion_date, true AS stamped FROM articles", "articles")
add(
    "filings_top5",
    """
    SELECT 'T' || o_custkey AS ticker,
           CASE WHEN place % 3 <> 0 THEN '10-K' WHEN o_orderstatus = 'F' THEN '10-K' ELSE '10-Q' END AS form_type,
           'Customer ' || o_custkey AS entity_name,
           CASE WHEN place % 4 <> 1 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS period_of_report,
           strftime(o_orderdate, '%Y-%m-%d') AS file_date,
           lpad(o_orderkey::VARCHAR, 10, '0') || '-00-' || place AS accession_no, place - 1 AS position,
           CASE WHEN o_orderkey = 0 THEN '' ELSE o_orderkey::VARCHAR END AS cik
    FROM orders, LATERAL (SELECT unnest(range(1, least(o_orderkey % 9, 5) + 1)) AS place)
    WHERE o_orderkey % 17 <> 0
    """,
)
add(
    "filings_all_hits",
    """
    SELECT 'T' || o_custkey AS ticker,
           CASE WHEN place % 3 <> 0 THEN '10-K' WHEN o_orderstatus = 'F' THEN '10-K' ELSE '10-Q' END AS form_type,
           'Customer ' || o_custkey AS entity_name,
           CASE WHEN place % 4 <> 1 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS period_of_report,
           strftime(o_orderdate, '%Y-%m-%d') AS file_date,
           lpad(o_orderkey::VARCHAR, 10, '0') || '-00-' || place AS accession_no, place - 1 AS position,
           CASE WHEN o_orderkey = 0 THEN '' ELSE o_orderkey::VARCHAR END AS cik, 'sec_edgar' AS source, true AS stamped
    FROM orders, LATERAL (SELECT unnest(range(1, o_orderkey % 9 + 1)) AS place)
    WHERE o_orderkey % 17 <> 0
    """,
)
add(
    "first_hits",
    """
    SELECT ticker, form_type, file_date, accession_no FROM filings
    QUALIFY row_number() OVER (PARTITION BY ticker, form_type ORDER BY file_date, accession_no) <= 5
    """,
    "filings",
)
add(
    "coverage",
    """
    SELECT u.ticker, count(b.date) AS rows, min(b.date) AS first_date, max(b.date) AS last_date,
           CASE WHEN count(b.date) > 0 THEN 'succeeded' ELSE 'failed' END AS status
    FROM (SELECT 'T' || s_suppkey AS ticker FROM supplier UNION SELECT n_name FROM nation) u
    LEFT JOIN bars b USING (ticker) GROUP BY u.ticker
    """,
    "bars",
)
add("in_universe", "SELECT ticker, url FROM scored_news WHERE ticker IN (SELECT ticker FROM bars)", "scored_news", "bars")
add("for_values", "SELECT ticker, accession_no FROM filings WHERE form_type = '10-K'", "filings")
add("between_dates", "SELECT ticker, date, close FROM bars WHERE date::DATE BETWEEN DATE '1996-03-01' AND DATE '1998-06-30'", "bars")
add("news_last_days", "SELECT ticker, url FROM scored_news WHERE published_at::DATE >= DATE '2024-01-13'", "scored_news")
add("gold_roundtrip", "SELECT * FROM gold", "gold")
add("written_years", "SELECT year(date) AS year, count(*) AS rows FROM bars GROUP BY 1", "bars")
add("written_year_sizes", "SELECT year(date) AS year, count(*) AS rows, true AS sizes_agree FROM bars GROUP BY 1", "bars")
add(
    "footprint_landed",
    """
    SELECT 'region' AS dataset, count(*) AS files, sum(strlen(r_name) + 1)::BIGINT AS bytes FROM region
    UNION ALL SELECT 'nation', count(*), sum(strlen(n_name) + 1)::BIGINT FROM nation
    """,
)
add("first_years", "SELECT ticker, date, close FROM bars WHERE year(date) IN (1995, 1996)", "bars")
add("upper_ticker", "SELECT upper(s_name) AS ticker, s_suppkey FROM supplier")
add("rows_by_year", "SELECT year(date) AS year, count(*) AS rows FROM bars GROUP BY 1", "bars")
add("silver_roundtrip", "SELECT *, year(date) AS year FROM cleaned", "cleaned")
add(
    "union_sources",
    "SELECT ticker, url, NULL::VARCHAR AS form_type FROM scored_news UNION ALL SELECT ticker, accession_no, form_type FROM filings",
    "scored_news", "filings",
)
add("blank_nulls", "SELECT url, coalesce(title, '') AS title, coalesce(description, '') AS description FROM headlines", "headlines")
add("refresh_returns", "SELECT * FROM returns_clean", "returns_clean")
add("incremental_silver", "SELECT * FROM cleaned_stable", "cleaned_stable")
add("incremental_returns", "SELECT * FROM returns_clean", "returns_clean")
add(
    "incremental_gold",
    "SELECT ticker, date, close, rsi_14, macd_line, macd_signal, bb_middle, bb_upper, vwap, sma_50, sma_200, ma_signal, vwap_signal FROM gold_clean",
    "gold_clean",
)
add("bucketed_table", "SELECT ticker, date, close, rsi_14 FROM gold", "gold")
add("refresh_movers", "SELECT * FROM movers_clean", "movers_clean")
add(
    "refresh_checks",
    _all([_null_check(name, "stg_clean") for name in ("ticker", "price_date", "close_price")]
         + [_null_check(name, "returns_clean") for name in ("ticker", "avg_daily_return_pct")]
         + [_unique_check(("ticker",), "returns_clean")]),
    "stg_clean", "returns_clean",
)
