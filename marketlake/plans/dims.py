"""Warehouse dimensions (DIM-1..DIM-5, MRG-4, KEY-1/2).

Each builder returns the rows to append to its dimension.  Ids:

* ``dim_time.id`` is the date as ``yyyymmdd`` — computed, never looked up;
* ``dim_companies`` / ``dim_topics`` are small: dense ids continuing from the
  current maximum, assigned without a single-task sort
  (:func:`assign_dense_ids`);
* ``dim_news`` grows with the article stream: publication day and hash of the
  natural key (title, url, time_published), so facts derive ``new_id`` from the
  article row itself and never need a shuffle-join back to the dimension; the
  few keys whose hashes meet are in a map (``operators.keys.settle_ids``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import day_hash_id
from ..functions.temporal import calendar_columns, published_day, time_id
from ..operators.keys import assign_dense_ids, max_id
from ..operators.merge import insert_new
from ..sources.landing import day_range

NEWS_KEY = ["title", "url", "time_published"]


def as_date(run_date) -> F.Column:
    """A run date given as text/date (one run) or as a column (a range)."""
    if isinstance(run_date, F.Column):
        return run_date.cast("date")
    return F.lit(run_date).cast("date")


def company_extract(companies: DataFrame, exchanges: DataFrame, regions: DataFrame,
                    industries: DataFrame, sic_industries: DataFrame,
                    as_of=None) -> DataFrame:
    """DIM-1 (JON-1, FLT-8, SRC-4): the denormalised company rows of one day.

    Four left joins along the foreign keys.  All four tables hold vendor text, so
    none is forced into a broadcast: AQE decides from their measured size.  ``as_of`` keeps
    the rows changed on that calendar day, written as a range on
    ``updated_time`` so it reaches the scan."""
    c = companies if as_of is None else companies.where(day_range("updated_time", as_of))
    e = exchanges.select(F.col("id").alias("exchange_id"), F.col("name").alias("exchange"),
                         F.col("region_id"))
    r = regions.select(F.col("id").alias("region_id"), "region")
    i = industries.select(F.col("id").alias("industry_id"), "industry", "sector")
    s = sic_industries.select(F.col("id").alias("sic_id"), "sic_industry", "sic_sector")
    out = (c.join(e, "exchange_id", "left")
           .join(r, "region_id", "left")
           .join(i, "industry_id", "left")
           .join(s, "sic_id", "left"))
    return out.select("name", "ticker", "is_delisted", "category", "currency", "location",
                      "exchange", "region", "industry", "sector", "sic_industry", "sic_sector",
                      "updated_time")


def new_companies(dim_companies: DataFrame, extract: DataFrame) -> DataFrame:
    """DIM-2: company rows whose ticker is not in the dimension yet, one per
    ticker (latest ``updated_time``, then listed before delisted), with
    dense ids after the current maximum."""
    rows = insert_new(dim_companies, extract, ["ticker"],
                      order_by=["updated_time", F.col("is_delisted").cast("int") * -1])
    return assign_dense_ids(rows, ["ticker"], start=max_id(dim_companies))


def calendar_rows(dates: DataFrame, date_col: str = "date") -> DataFrame:
    """FN-14: distinct dates → dim_time rows."""
    d = dates.select(F.col(date_col).cast("date").alias("_d")).where("_d is not null").distinct()
    return d.select(*calendar_columns("_d"))


def new_dates(dim_time: DataFrame, dates: DataFrame, date_col: str = "date") -> DataFrame:
    """DIM-3 / MRG-4 / JON-11: calendar rows for dates not in dim_time yet."""
    return insert_new(dim_time, calendar_rows(dates, date_col), ["date"], dedupe_batch=False)


def topic_names(news: DataFrame) -> DataFrame:
    """DIM-4 first half (FN-3, PRJ-4): distinct topic names of the articles;
    articles with null/empty ``topics`` contribute nothing."""
    return (news.select(F.explode("topics").alias("t"))
            .select(F.col("t.topic").alias("name")).where("name is not null").distinct())


def new_topics(dim_topics: DataFrame, news: DataFrame, first_by: str | None = None
               ) -> DataFrame:
    """DIM-4: topic names not in dim_topics yet, with dense ids.

    With ``first_by`` (a run-date column, for a backfill over many days) the
    ids follow (first run date, name) — the ids a sequence of daily runs
    would have given."""
    if first_by is None:
        rows = insert_new(dim_topics, topic_names(news), ["name"], dedupe_batch=False)
        return assign_dense_ids(rows, ["name"], start=max_id(dim_topics))
    seen = (news.select(F.col(first_by).alias("_first"), F.explode("topics").alias("t"))
            .select("_first", F.col("t.topic").alias("name")).where("name is not null")
            .groupBy("name").agg(F.min("_first").alias("_first")))
    rows = insert_new(dim_topics, seen, ["name"], dedupe_batch=False)
    return assign_dense_ids(rows, ["_first", "name"], start=max_id(dim_topics)).drop("_first")


def news_rows(news: DataFrame, run_date) -> DataFrame:
    """DIM-5 shape: article columns + ``time_id`` of the run date + hash id.
    ``run_date`` is one date or a column (each article's own run date)."""
    cols = ["title", "url", "time_published", "authors", "summary", "source",
            "overall_sentiment_score", "overall_sentiment_label"]
    return news.select(day_hash_id(NEWS_KEY, published_day("time_published")).alias("id"), *cols,
                       time_id(as_date(run_date)).alias("time_id"),
                       published_day("time_published").alias("published_day"))


def new_news(dim_news: DataFrame, news: DataFrame, run_date) -> DataFrame:
    """DIM-5: articles not in dim_news yet (key title, url, time_published),
    one row per key — for a range, the one of the earliest run date (its
    ``time_id``), as daily runs would have stored.  A row whose publication
    time does not parse has no ``published_day`` and is left out (it would
    break the CHAR(15) rule; see ``warehouse_quality`` / ``null_key_rows``)."""
    rows = news_rows(news, run_date)
    tie = ["source", "url"]    # inside one run: the largest, by all columns in the end
    # published_day is a function of the key, so the target is read only in
    # the partitions (publication days) the batch touches
    keys = NEWS_KEY + ["published_day"]
    days = news.select(published_day("time_published").alias("published_day"))
    if isinstance(run_date, F.Column):       # over a range: earliest run first
        return insert_new(dim_news, rows, keys, order_by=[F.col("time_id") * -1, *tie],
                          prune_on="published_day", touched=days)
    return insert_new(dim_news, rows, keys, order_by=tie, prune_on="published_day",
                      touched=days)
