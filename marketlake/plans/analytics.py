"""Analytic questions over the warehouse (QRY-1..QRY-17).

Each function takes warehouse-shaped DataFrames (column names of SURVEY
§1.4) and returns a DataFrame; nothing is collected.  Counts and sums run as
partial + final hash aggregates, so a popular ticker costs one row per map
partition in the shuffle.  Sorted outputs carry a unique tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import epoch_ms_to_ts, parse_compact_ts
from ..functions.text import is_blank, last_token
from ..operators.keys import latest_per_key
from ..session import materialise


def latest_companies(dim_companies: DataFrame) -> DataFrame:
    """QRY-1: the latest row per ticker (by ``updated_time``, then ``id``)."""
    return latest_per_key(dim_companies, ["ticker"], ["updated_time", "id"])


def company_count(dim_companies: DataFrame) -> DataFrame:
    """QRY-1 (AGG-6): number of tickers after taking the latest row each."""
    return latest_companies(dim_companies).agg(F.count(F.lit(1)).alias("companies"))


def count_by(df: DataFrame, col: str, out: str = "count", drop_blank: bool = False,
             label: str | None = None) -> DataFrame:
    """QRY-2/4/5/13 (AGG-1, SRT-1, FLT-6): rows per value of ``col``, most first.

    ``drop_blank`` removes null and white-space-only groups; the test is on
    the grouping key, so Catalyst applies it below the aggregate."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias(out))
    if drop_blank:
        g = g.where(~is_blank(col))
    if label:
        g = g.withColumnRenamed(col, label)
        col = label
    return g.orderBy(F.desc(out), F.asc(col))


def count_by_country(companies: DataFrame, location_col: str = "location",
                     sep: str = ";", out: str = "count") -> DataFrame:
    """QRY-3 (FN-2): companies per country = last ``;`` token of the location,
    kept untrimmed."""
    return count_by(companies.withColumn("country", last_token(location_col, sep)),
                    "country", out)


def listing_status_counts(companies: DataFrame, out: str = "count") -> DataFrame:
    """QRY-6 (PRJ-7): active vs delisted companies."""
    status = (F.when(F.col("is_delisted") == F.lit(True), F.lit("delisted"))
              .otherwise(F.lit("active")))
    return count_by(companies.withColumn("status", status), "status", out)


def typed_candles(fact_candles: DataFrame) -> DataFrame:
    """QRY-7 (FN-12, FN-13): epoch-ms text → timestamp, null OTC flag → false."""
    return (fact_candles
            .withColumn("time_stamp", epoch_ms_to_ts("time_stamp"))
            .withColumn("is_otc", F.coalesce(F.col("is_otc"), F.lit(False))))


def daily_totals(candles: DataFrame, ts_col: str = "time_stamp") -> DataFrame:
    """QRY-8 (FN-9, AGG-3, AGG-4): volume, trades and OTC rows per day."""
    return (candles.groupBy(F.to_date(ts_col).alias("trade_date"))
            .agg(F.sum("volume").alias("total_volume"),
                 F.sum("num_of_trades").alias("total_trades"),
                 F.count_if(F.col("is_otc")).cast("long").alias("otc_rows"))
            .orderBy(F.desc("trade_date")))


def candles_with_companies(candles: DataFrame, companies: DataFrame) -> DataFrame:
    """QRY-9 (JON-6, PRJ-8): candles joined to company rows.

    Both sides carry ``id``; the output names are prefixed (``candle_*`` for
    the fact's own columns) instead of duplicating names."""
    clash = set(candles.columns) & set(companies.columns)
    c = candles.select(*[F.col(x).alias(f"candle_{x}") if x in clash else F.col(x)
                         for x in candles.columns])
    return c.join(companies, c["company_id"] == companies["id"])


def top_volume(joined: DataFrame, k: int = 10, key: str = "ticker",
               volume_col: str = "volume") -> DataFrame:
    """QRY-10 (AGG-3, SRT-3): the ``k`` tickers with the largest total volume.
    ``orderBy().limit()`` plans as TakeOrderedAndProject (a per-partition
    top-k, then a merge of k rows per partition)."""
    return (joined.groupBy(key).agg(F.sum(volume_col).alias("total_volume"))
            .orderBy(F.desc("total_volume"), F.asc(key)).limit(k))


def top_volume_tickers(candles: DataFrame, companies: DataFrame, k: int = 10,
                       volume_col: str = "volume") -> DataFrame:
    """QRY-9/10: :func:`top_volume` of candles joined to their companies, the
    candles summed per company before the join: the fact is shuffled as
    partial sums only, and the join meets one row per company."""
    sums = candles.groupBy("company_id").agg(F.sum(volume_col).alias(volume_col))
    return top_volume(candles_with_companies(sums, companies), k=k, volume_col=volume_col)


def price_trend(joined: DataFrame, tickers, key: str = "ticker",
                ts_col: str = "time_stamp", price_col: str = "close") -> DataFrame:
    """QRY-11 (FLT-3, AGG-5, SRT-2): mean close per (ticker, time) for the
    chosen tickers.  ``tickers`` is a list (``isin``) or a DataFrame of
    tickers (semi join — it may be derived, e.g. the top movers)."""
    if isinstance(tickers, DataFrame):
        chosen = joined.join(tickers.select(key), key, "left_semi")
    else:
        chosen = joined.where(F.col(key).isin(list(tickers)))
    return (chosen.groupBy(key, ts_col).agg(F.avg(price_col).alias("avg_close"))
            .orderBy(key, ts_col))


def typed_news(dim_news: DataFrame, wide=("authors", "summary", "url")) -> DataFrame:
    """QRY-12 (FN-11, PRJ-6): parse ``YYYYMMDDTHHMMSS`` and drop wide columns."""
    return (dim_news.withColumn("time_published", parse_compact_ts("time_published"))
            .drop(*[c for c in wide if c in dim_news.columns]))


def count_by_hour(news: DataFrame, ts_col: str = "time_published",
                  out: str = "articles") -> DataFrame:
    """QRY-14 (FN-10): articles per hour of day."""
    return count_by(news.withColumn("hour", F.hour(ts_col)), "hour", out)


def mentions_per_day(fact_news_companies: DataFrame, dim_news: DataFrame,
                     companies: DataFrame, dim_time: DataFrame) -> DataFrame:
    """QRY-15 (JON-7, AGG-2, SRT-2): mentions per (ticker, date).

    Star join fact → news, then mentions counted per company and day before they meet company and
    calendar: a hot ticker reaches the company join as one row a day.  ``dim_time`` is bounded by the
    calendar and is broadcast; news and companies are left to AQE, which
    broadcasts them only when their measured size is under the threshold."""
    f = fact_news_companies.select("new_id", "company_id")
    n = dim_news.select(F.col("id").alias("new_id"), "time_id")
    c = companies.select(F.col("id").alias("company_id"), "ticker")
    t = F.broadcast(dim_time.select(F.col("id").alias("time_id"), "date"))
    counts = f.join(n, "new_id").groupBy("company_id", "time_id").agg(F.count(F.lit(1)).alias("num_mentions"))
    return (counts.join(c, "company_id").join(t, "time_id")
            .groupBy("ticker", "date").agg(F.sum("num_mentions").alias("num_mentions"))
            .orderBy(F.asc("date"), F.desc("num_mentions"), F.asc("ticker")))


#: Shares of the rows whose largest values a quantile summary returns, from all down to 4e-12.
_SHARES = [4.0 ** -i for i in range(20)]


def rank_threshold(rows: DataFrame, col: str, want: int):
    """SRT-4: a value of ``col`` at or below which about ``want`` rows lie or more (None: all rows are wanted).

    One pass builds quantile summaries per partition and merges them (a few KB each, whatever the table's size); as the
    summary's error is a share of the rows, a second pass repeats it over what the first left, so the rows
    that remain don't grow with the table.  Nothing is sorted or limited."""
    at = None
    for _ in range(2):
        kept = rows.where(F.col(col).isNotNull() if at is None else F.col(col) <= F.lit(at))
        r = kept.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(col, _SHARES, 10000).alias("at")).first()
        enough = [v for share, v in zip(_SHARES, r["at"] or []) if share * r["n"] >= 2 * want]
        if not enough:
            return at
        at = enough[-1]
    return at


def lowest_sentiment(fact_news_companies: DataFrame, dim_news: DataFrame,
                     companies: DataFrame, k: int = 10) -> DataFrame:
    """QRY-16 (JON-7, SRT-4): the ``k`` most negative ticker mentions.

    Only mentions at or below a threshold (:func:`rank_threshold`, ties included) meet their article and
    company.  Where fewer than ``k`` of those have both parents, the threshold is raised to a rank 16 times as high; a
    mention without parents never takes another one's place."""
    score = "ticker_sentiment_score"
    f = fact_news_companies.select("new_id", "company_id", score)
    n = dim_news.select(F.col("id").alias("new_id"), "title")
    c = companies.select(F.col("id").alias("company_id"), "ticker")

    def top(rows: DataFrame) -> DataFrame:
        return (rows.join(n, "new_id").join(c, "company_id").select("ticker", "title", score)
                .orderBy(F.asc_nulls_last(score), F.asc("ticker"), F.asc("title")).limit(k))

    want = 4 * k
    while (at := rank_threshold(f.select(score), score, want)) is not None:
        found = materialise(top(f.where(F.col(score) <= F.lit(at))), "lowest")  # k rows
        if found.count() >= k:
            return found.orderBy(F.asc_nulls_last(score), F.asc("ticker"), F.asc("title"))
        want *= 16
    return top(f)
