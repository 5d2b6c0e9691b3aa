"""Lists, labels and text formats that results must reproduce exactly.

Everything here is data, not logic. Change a value and stored results change with it.
"""

# --- Fixed values: default ticker universe, five sectors of ten -----------------
TICKERS = (
    "AAPL", "MSFT", "GOOGL", "NVDA", "META", "AMZN", "TSM", "AVGO", "ORCL", "AMD",
    "JPM", "BAC", "WFC", "GS", "MS", "BLK", "SCHW", "AXP", "V", "MA",
    "JNJ", "UNH", "LLY", "ABBV", "PFE", "MRK", "TMO", "ABT", "DHR", "BMY",
    "XOM", "CVX", "COP", "SLB", "EOG", "KMI", "MPC", "PSX", "VLO", "OXY",
    "WMT", "HD", "MCD", "NKE", "SBUX", "TGT", "COST", "LOW", "TJX", "DG",
)
UNIVERSE_SIZE = 50
UNIVERSE_REQUIRED = ("KMI",)
UNIVERSE_FORBIDDEN = ("PXD",)

# --- Fixed values: ingestion window and search parameters -----------------------
FILINGS_SOURCE = "sec_edgar"
FORM_TYPES = ("10-K", "10-Q")
HITS_PER_FORM = 5
ARTICLES_PER_TICKER = 100
NEWS_DAYS = 7

# --- Fixed values: column order of landed prices, header aliases ----------------
PRICE_COLUMNS = ("date", "ticker", "open", "high", "low", "close", "volume", "source", "ingested_at")
HEADER_ALIASES = {"vol": "volume", "openint": "open_interest"}

# --- Fixed values: sentiment labels, in the order ties are resolved -------------
SENTIMENT_LABELS = ("positive", "negative", "neutral")

# --- Fixed values: minimum row counts expected of each dataset ------------------
MIN_ROWS = {"prices": 70_000, "news": 500, "filings": 400}

# --- Fixed values: document collections and their text formats ------------------
FILINGS_COLLECTION = "sec_filings"
NEWS_COLLECTION = "news_sentiment"
FILING_TEXT = "%s (%s) filed a %s on %s for the period ending %s. Accession number: %s."
NEWS_TEXT = "[%s] %s: %s (confidence: %s, source: %s, date: %s)"
MISSING_TEXT = "None"
NEWS_DOCUMENTS = 1000
PROMPT = "%s\n\nCONTEXT:\n%s\n\nQUESTION: %s\n\nANSWER:"
NO_DOCUMENTS = "No relevant documents found in the vector store."

# --- Fixed values: report headings ----------------------------------------------
HEADINGS = {
    "movers": {
        "ticker": "Ticker",
        "close_price": "Price ($)",
        "daily_return_pct": "Return (%)",
    },
    "performance": {
        "ticker": "Ticker",
        "trading_days": "Days",
        "avg_daily_return_pct": "Avg Return %",
        "volatility_pct": "Volatility %",
        "best_day_pct": "Best Day %",
        "worst_day_pct": "Worst Day %",
        "return_risk_ratio": "Risk Ratio",
        "avg_close": "Avg Price",
    },
    "articles": {
        "title": "Title",
        "sentiment": "Sentiment",
        "confidence": "Confidence",
        "source": "Source",
        "published_at": "Published",
    },
}
