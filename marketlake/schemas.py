"""Fixed schemas: landing shapes (vendor JSON) and target tables.

Every read passes an explicit schema, so a day whose file is just ``[]``
still yields a typed, empty DataFrame and a type cannot drift between days.
"""

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- landing shapes -------------------------------------------------------
# The vendor's field names and types (landing JSON), the
# vendor→column renames and the target column lists below must equal the
# source data and the warehouse DDL.

MARKETS = _struct(
    ("market_type", S), ("region", S), ("primary_exchanges", S), ("local_open", S),
    ("local_close", S), ("current_status", S), ("notes", S))

COMPANIES_RAW = _struct(
    ("name", S), ("ticker", S), ("isDelisted", B), ("category", S), ("currency", S),
    ("location", S), ("industry", S), ("sector", S), ("exchange", S), ("sic", S),
    ("sicIndustry", S), ("sicSector", S))

# single-letter vendor fields of a daily aggregate bar
OHLC_RAW = _struct(
    ("T", S), ("v", D), ("vw", D), ("o", D), ("c", D), ("h", D), ("l", D),
    ("t", L), ("n", L), ("otc", B))

TOPIC = _struct(("topic", S), ("relevance_score", S))
TICKER_SENTIMENT = _struct(
    ("ticker", S), ("relevance_score", S), ("ticker_sentiment_score", S),
    ("ticker_sentiment_label", S))

NEWS_RAW = T.StructType([
    T.StructField("title", S), T.StructField("url", S),
    T.StructField("time_published", S),
    T.StructField("authors", T.ArrayType(S)), T.StructField("summary", S),
    T.StructField("source", S), T.StructField("overall_sentiment_score", D),
    T.StructField("overall_sentiment_label", S),
    T.StructField("topics", T.ArrayType(TOPIC)),
    T.StructField("ticker_sentiment", T.ArrayType(TICKER_SENTIMENT)),
])

# response envelopes: required key (feed, markets) vs optional key (results)
NEWS_ENVELOPE = T.StructType([T.StructField("feed", T.ArrayType(NEWS_RAW))])
MARKETS_ENVELOPE = T.StructType([T.StructField("markets", T.ArrayType(MARKETS))])
OHLC_ENVELOPE = T.StructType([T.StructField("results", T.ArrayType(OHLC_RAW))])

# vendor field -> our column, for the daily bars
OHLC_RENAMES = {
    "T": "ticker", "v": "volume", "vw": "volume_weighted", "o": "open", "c": "close",
    "h": "high", "l": "low", "t": "time_stamp", "n": "num_of_trades", "otc": "is_otc",
}

# The same bars under our names.  "T" (ticker) and "t" (timestamp) differ
# only in case, and Spark resolves names case-insensitively, so the rename
# is done positionally: a struct cast maps fields by position, not name.
OHLC = T.StructType([T.StructField(OHLC_RENAMES[f.name], f.dataType, True)
                     for f in OHLC_RAW.fields])

# camelCase vendor field -> snake_case column, for companies
COMPANY_RENAMES = {
    "name": "name", "ticker": "ticker", "isDelisted": "is_delisted", "category": "category",
    "currency": "currency", "location": "location", "industry": "industry",
    "sector": "sector", "exchange": "exchange", "sicIndustry": "sic_industry",
    "sicSector": "sic_sector",
}

# ---- normalised tables (no ids: ids are added at load) --------------------

REGIONS = _struct(("region", S), ("local_open", S), ("local_close", S))
EXCHANGES = _struct(("name", S), ("region", S))
INDUSTRIES = _struct(("industry", S), ("sector", S))
SIC_INDUSTRIES = _struct(("id", S), ("sic_industry", S), ("sic_sector", S))
COMPANIES = _struct(
    ("name", S), ("ticker", S), ("is_delisted", B), ("category", S), ("currency", S),
    ("location", S), ("industry", S), ("sector", S), ("exchange", S),
    ("sic_industry", S), ("sic_sector", S))

# ---- warehouse -------------------------------------------------------------

DIM_TIME = T.StructType([
    T.StructField("id", T.IntegerType(), False), T.StructField("date", T.DateType(), False),
    T.StructField("day_of_week", S), T.StructField("month", S),
    T.StructField("quarter", S), T.StructField("year", T.IntegerType()),
])

DIM_COMPANIES = T.StructType(
    [T.StructField("id", L, False)]
    + [T.StructField(n, t) for n, t in (
        ("name", S), ("ticker", S), ("is_delisted", B), ("category", S), ("currency", S),
        ("location", S), ("exchange", S), ("region", S), ("industry", S), ("sector", S),
        ("sic_industry", S), ("sic_sector", S))]
    + [T.StructField("updated_time", T.TimestampNTZType())])

DIM_TOPICS = _struct(("id", L), ("name", S))

# News tables carry ``published_day`` (yyyymmdd of ``time_published``) as
# their partition column: the natural key contains the publication time, so
# an insert-if-new only has to read the partitions of the batch's days.
DIM_NEWS = _struct(
    ("id", L), ("title", S), ("url", S), ("time_published", S)).add(
    "authors", T.ArrayType(S)).add("summary", S).add("source", S).add(
    "overall_sentiment_score", D).add("overall_sentiment_label", S).add(
    "time_id", T.IntegerType()).add("published_day", T.IntegerType())

FACT_CANDLES = _struct(
    ("id", L), ("company_id", L), ("volume", L), ("volume_weighted", D), ("open", D),
    ("close", D), ("high", D), ("low", D), ("time_stamp", S), ("num_of_trades", L),
    ("is_otc", B)).add("time_id", T.IntegerType())

FACT_NEWS_COMPANIES = _struct(
    ("id", L), ("company_id", L), ("new_id", L), ("relevance_score", D),
    ("ticker_sentiment_score", D), ("ticker_sentiment_label", S)).add(
    "published_day", T.IntegerType())

FACT_NEWS_TOPICS = _struct(("id", L), ("new_id", L), ("topic_id", L), ("relevance_score", D)).add(
    "published_day", T.IntegerType())

WAREHOUSE_DDL = {
    "dim_time": DIM_TIME,
    "dim_companies": DIM_COMPANIES,
    "dim_topics": DIM_TOPICS,
    "dim_news": DIM_NEWS,
    "fact_candles": FACT_CANDLES,
    "fact_news_companies": FACT_NEWS_COMPANIES,
    "fact_news_topics": FACT_NEWS_TOPICS,
}
WAREHOUSE_TABLES = tuple(WAREHOUSE_DDL)

# NOT NULL columns, text widths and foreign keys of the
# warehouse DDL (the data-quality rules checked by jobs.warehouse_quality).
NOT_NULL = {
    "dim_time": ["date"],
    "dim_companies": ["ticker", "is_delisted", "exchange", "region"],
    "dim_topics": ["name"],
    "dim_news": ["title", "url", "time_published", "overall_sentiment_score",
                 "overall_sentiment_label"],
    "fact_candles": ["company_id", "volume", "volume_weighted", "open", "close", "high",
                     "low", "time_stamp", "num_of_trades"],
    "fact_news_companies": ["company_id", "new_id", "relevance_score",
                            "ticker_sentiment_score", "ticker_sentiment_label"],
    "fact_news_topics": ["new_id", "topic_id", "relevance_score"],
}

MAX_LENGTH = {
    "dim_time": {"day_of_week": 10, "month": 10, "quarter": 10},
    "dim_companies": {"name": 255, "ticker": 10, "category": 255, "currency": 10,
                      "location": 255, "exchange": 100, "region": 50, "industry": 255,
                      "sector": 255, "sic_industry": 255, "sic_sector": 255},
    "dim_topics": {"name": 255},
    "dim_news": {"time_published": 15, "overall_sentiment_label": 255},
    "fact_candles": {"time_stamp": 15},
    "fact_news_companies": {"ticker_sentiment_label": 100},
    "fact_news_topics": {},
}

FOREIGN_KEYS = [  # (child table, child column, parent table)
    ("dim_news", "time_id", "dim_time"),
    ("fact_candles", "company_id", "dim_companies"),
    ("fact_candles", "time_id", "dim_time"),
    ("fact_news_companies", "company_id", "dim_companies"),
    ("fact_news_companies", "new_id", "dim_news"),
    ("fact_news_topics", "new_id", "dim_news"),
    ("fact_news_topics", "topic_id", "dim_topics"),
]
