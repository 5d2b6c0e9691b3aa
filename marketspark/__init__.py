"""Market data analytics as Spark jobs: prices, indicators, sentiment, retrieval, quality checks."""

__version__ = "0.1.0"
