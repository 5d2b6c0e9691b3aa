"""Declared schemas, one per dataset, so that no scan has to infer types."""

from pyspark.sql import types as T


def _fields(spec):
    return T.StructType([T.StructField(name, kind) for name, kind in spec])


_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampNTZType()

_BARS = [("date", _TS), ("ticker", _S), ("open", _D), ("high", _D), ("low", _D), ("close", _D), ("volume", _D)]
_ENRICHED = [(name, _D) for name in ("daily_return", "price_range", "typical_price", "range_pct")]
_INDICATORS = [
    (name, _D)
    for name in (
        "rsi_14", "macd_line", "macd_signal", "macd_histogram",
        "bb_middle", "bb_upper", "bb_lower", "bb_bandwidth", "bb_pct_b",
        "vwap", "sma_50", "sma_200",
    )
]

SILVER_PRICES = _fields(
    _BARS + _ENRICHED
    + [("silver_processed_at", T.TimestampType()), ("data_source", _S), ("year", T.IntegerType())]
)

GOLD_INDICATORS = _fields(
    _BARS + _ENRICHED + [("silver_processed_at", T.TimestampType())] + _INDICATORS
    + [
        ("vwap_signal", _S),
        ("ma_signal", _S),
        ("indicators_computed_at", T.TimestampType()),
        ("data_source", _S),
    ]
)

NEWS = _fields(
    [(name, _S) for name in ("ticker", "title", "description", "url", "source", "published_at", "content")]
)

# One landed search response per line, tagged with the ticker that was asked for.
NEWS_PAYLOAD = _fields(
    [
        ("ticker", _S),
        ("status", _S),
        (
            "articles",
            T.ArrayType(
                _fields(
                    [
                        ("title", _S), ("description", _S), ("url", _S),
                        ("source", _fields([("name", _S)])),
                        ("publishedAt", _S), ("content", _S),
                    ]
                )
            ),
        ),
    ]
)

# One landed filing search per line, tagged with the ticker and form that were asked for.
FILINGS_PAYLOAD = _fields(
    [
        ("ticker", _S),
        ("form", _S),
        ("status", _L),
        (
            "hits",
            _fields(
                [
                    (
                        "hits",
                        T.ArrayType(
                            _fields(
                                [
                                    (
                                        "_source",
                                        _fields(
                                            [
                                                (name, _S)
                                                for name in (
                                                    "form_type", "entity_name", "period_of_report",
                                                    "file_date", "accession_no",
                                                )
                                            ]
                                        ),
                                    )
                                ]
                            )
                        ),
                    )
                ]
            ),
        ),
    ]
)
