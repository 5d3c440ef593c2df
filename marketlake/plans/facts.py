"""Warehouse facts (FCT-1..FCT-3, KEY-3, JON-2/3, FLT-4/5, PRJ-2/5).

Scale notes: every fact row derives its news id from the article row
(day and hash of title, url, time_published; a small map names the keys whose hashes meet), so the link to
``dim_news`` is an existence check on one long, not a join on long text.  The bridges are
partitioned by the article's publication day (also derived from the row),
so the daily insert-if-new reads only the partitions of the batch's days,
not the whole history.  Topic and company
dimensions are looked up with inner equi-joins that AQE turns into broadcast
joins while they are small; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import day_hash_id
from ..functions.temporal import epoch_ms_to_ts, published_day, time_id
from ..operators.hot import split_join
from ..operators.keys import latest_id_per_key, mapped_ids
from ..operators.merge import insert_new
from .dims import NEWS_KEY


def _first_cols(news: DataFrame, first_by: str | None) -> list:
    return [F.col(first_by).alias("_first")] if first_by else []


def with_day(news: DataFrame) -> DataFrame:
    """Articles with their publication day; one that is stored with them is not derived again."""
    return news if "published_day" in news.columns else news.withColumn("published_day", published_day("time_published"))


def with_new_ids(news: DataFrame, id_map: DataFrame | None = None) -> DataFrame:
    """Articles with their publication day and ``new_id``."""
    return mapped_ids(with_day(news), NEWS_KEY, "published_day", "dim_news", "new_id", id_map)


def topic_links(news: DataFrame, dim_topics: DataFrame, dim_news: DataFrame,
                first_by: str | None = None, id_map: DataFrame | None = None) -> DataFrame:
    """FCT-1 rows: one (new_id, topic_id, relevance_score) per article topic.

    Explode first, then resolve: the topic name against ``dim_topics`` (inner
    join: unknown topics are dropped), the article against ``dim_news``
    (semi join on the derived id: articles not stored are dropped)."""
    exploded = with_new_ids(news, id_map).select("new_id", *_first_cols(news, first_by),
                                                 "published_day", F.explode("topics").alias("t"))
    links = exploded.select(
        "new_id", "published_day", *(["_first"] if first_by else []),
        F.col("t.topic").alias("name"),
        F.col("t.relevance_score").try_cast("double").alias("relevance_score"))
    topics = dim_topics.select(F.col("id").alias("topic_id"), "name")
    return (links.join(topics, "name")
            .join(_stored_news(dim_news, news), ["published_day", "new_id"], "left_semi")
            .select("new_id", "topic_id", "relevance_score", "published_day",
                    *(["_first"] if first_by else [])))


def _news_days(news: DataFrame) -> DataFrame:
    """Publication days of the batch's articles — read off the article rows
    (one pruned column), a superset of the days of any bridge row."""
    return with_day(news).select("published_day")


def _stored_news(dim_news: DataFrame, news: DataFrame) -> DataFrame:
    """Keys of the stored articles of the batch's publication days: the days
    (one per calendar day: a bounded broadcast) prune dim_news to their
    partitions, so its history is not read."""
    days = F.broadcast(_news_days(news).distinct())
    return (dim_news.select("published_day", F.col("id").alias("new_id"))
            .join(days, "published_day", "left_semi"))


def _dedupe_order(first_by, *tie):
    """Inside one run the largest ``tie`` wins; over a range the earliest run
    date wins first (negated day number), then the same ``tie`` rule — what a
    sequence of daily runs would have kept."""
    if first_by:
        return dict(order_by=[F.datediff(F.lit("1970-01-01"), F.col("_first")), *tie])
    return dict(order_by=list(tie))


def new_topic_links(fact: DataFrame, news: DataFrame, dim_topics: DataFrame,
                    dim_news: DataFrame, first_by: str | None = None,
                    id_map: DataFrame | None = None) -> DataFrame:
    """FCT-1: bridge rows not stored yet (key new_id, topic_id), with ids."""
    rows = insert_new(fact, topic_links(news, dim_topics, dim_news, first_by, id_map),
                      ["new_id", "topic_id", "published_day"], prune_on="published_day",
                      touched=_news_days(news), **_dedupe_order(first_by, "relevance_score"))
    return rows.select(day_hash_id(["new_id", "topic_id"], F.col("published_day")).alias("id"), "new_id", "topic_id",
                       "relevance_score", "published_day")


def company_links(news: DataFrame, dim_companies: DataFrame, dim_news: DataFrame,
                  first_by: str | None = None, id_map: DataFrame | None = None, split_hot: bool = False) -> DataFrame:
    """FCT-2 rows: one mention per (article, ticker) with its sentiment; each
    ticker resolves to the id of its latest company row (KEY-3).  ``split_hot`` keeps the mentions of
    hot tickers out of the shuffle (for company tables too large for a broadcast)."""
    exploded = with_new_ids(news, id_map).select("new_id", *_first_cols(news, first_by),
                                                 "published_day", F.explode("ticker_sentiment").alias("s"))
    links = exploded.select(
        "new_id", "published_day", *(["_first"] if first_by else []),
        F.col("s.ticker").alias("ticker"),
        F.col("s.relevance_score").try_cast("double").alias("relevance_score"),
        F.col("s.ticker_sentiment_score").try_cast("double").alias("ticker_sentiment_score"),
        F.col("s.ticker_sentiment_label").alias("ticker_sentiment_label"))
    latest = latest_id_per_key(dim_companies, "ticker", ["updated_time", "id"]) \
        .withColumnRenamed("id", "company_id")
    links = split_join(links, latest, ["ticker"]) if split_hot else links.join(latest, "ticker")
    return (links
            .join(_stored_news(dim_news, news), ["published_day", "new_id"], "left_semi")
            .select("new_id", "company_id", "relevance_score", "ticker_sentiment_score",
                    "ticker_sentiment_label", "published_day",
                    *(["_first"] if first_by else [])))


def new_company_links(fact: DataFrame, news: DataFrame, dim_companies: DataFrame,
                      dim_news: DataFrame, first_by: str | None = None,
                      id_map: DataFrame | None = None, split_hot: bool = False) -> DataFrame:
    """FCT-2: bridge rows not stored yet (key new_id, company_id), with ids."""
    rows = insert_new(fact, company_links(news, dim_companies, dim_news, first_by, id_map, split_hot),
                      ["new_id", "company_id", "published_day"], prune_on="published_day",
                      touched=_news_days(news),
                      **_dedupe_order(first_by, "ticker_sentiment_score", "relevance_score"))
    return rows.select(day_hash_id(["new_id", "company_id"], F.col("published_day")).alias("id"), "new_id", "company_id",
                       "relevance_score", "ticker_sentiment_score", "ticker_sentiment_label",
                       "published_day")


def storable_volume() -> F.Column:
    """A missing volume, or one that rounds to a long (a cast would cut it off)."""
    return F.col("volume").isNull() | F.rint("volume").try_cast("long").isNotNull()


def candle_rows(bars: DataFrame, dim_companies: DataFrame, run_date=None, split_hot: bool = False) -> DataFrame:
    """FCT-3 rows from the vendor's daily bars.

    ``bars`` carries our column names (:func:`sources.read_bars` /
    :func:`sources.rename_bars` do the PRJ-2 rename).  Resolve the ticker to
    its latest company id (inner join: unknown tickers drop), drop bars
    without a weighted price (FLT-5) or with a volume no long can hold, round
    the volume to the nearest whole number, default a missing OTC flag to false.
    ``time_id`` is the run date's (PRJ-5) when ``run_date`` is given — one
    daily drop — else it is derived from each bar's own epoch-ms timestamp
    (bars of many days, e.g. a backfill).  ``split_hot`` as in :func:`company_links`."""
    if run_date is None:
        day = epoch_ms_to_ts("time_stamp")
    elif isinstance(run_date, F.Column):
        day = run_date.cast("date")
    else:
        day = F.lit(run_date).cast("date")
    latest = latest_id_per_key(dim_companies, "ticker", ["updated_time", "id"]) \
        .withColumnRenamed("id", "company_id")
    known = split_join(bars, latest, ["ticker"]) if split_hot else bars.join(latest, "ticker")
    rows = (known
            .where(F.col("volume_weighted").isNotNull() & storable_volume())
            .select("company_id",
                    F.rint("volume").try_cast("long").alias("volume"),
                    "volume_weighted", "open", "close", "high", "low",
                    F.col("time_stamp").cast("string").alias("time_stamp"),
                    F.col("num_of_trades").cast("long").alias("num_of_trades"),
                    F.coalesce(F.col("is_otc"), F.lit(False)).alias("is_otc"),
                    time_id(day).alias("time_id")))
    return rows


def new_candles(fact: DataFrame, bars: DataFrame, dim_companies: DataFrame,
                run_date=None, days=None, split_hot: bool = False) -> DataFrame:
    """FCT-3: candles whose (company_id, time_id) is not stored yet.  The
    anti-join reads only the fact partitions (time_id) the batch touches:
    ``days`` when the caller knows them (a list: a run date, a backfill
    range; or a cheap DataFrame superset with a ``time_id`` column), else
    the batch's own days."""
    if days is None and run_date is not None and not isinstance(run_date, F.Column):
        days = [int(str(run_date).replace("-", "")[:8])]
    rows = insert_new(fact, candle_rows(bars, dim_companies, run_date, split_hot), ["company_id", "time_id"],
                      order_by=["time_stamp"], prune_on="time_id",
                      touched=days)
    return rows.select(day_hash_id(["company_id", "time_id"], F.col("time_id")).alias("id"), *rows.columns)
