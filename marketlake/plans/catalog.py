"""Driver queries: every operator of the inventory run on the driver's tables.

The driver's tables are a TPC-H-like star (plus events and documents); each
query maps them onto the market shapes the operators expect (FIXTURES.md §5)
and runs the library operator on the WHOLE tables.  Each entry is a
``(spark, sf_dir) -> DataFrame`` plus, where SQL can express it, the
equivalent DuckDB SQL used as the correctness oracle.  Column names are
aliased identically on both sides; float results are rounded on both sides.

Stand-ins used below:

* company versions = ``orders`` (one version per order: id ``o_orderkey``,
  ticker ``o_custkey``, updated_time ``o_orderdate``), attributes from
  ``customer`` / ``nation`` / ``region``;
* candles = ``lineitem`` rows (company = part, volume = quantity), or
  per-(user, day) bars shaped from ``events``;
* articles = ``orders`` (mentions = ``lineitem``, sentiment = discount − tax)
  or ``documents`` (topics = words of the text found in the vocabulary of the
  ``benchmark`` passages).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from ..functions import (day_hash_id, epoch_ms_to_ts, exact_mean, format_compact_ts, round_half_up, row_hash_concat,
                         row_hash_json, time_id, ts_to_epoch_ms, word_tokens)
from ..schemas import WAREHOUSE_DDL
from ..session import materialise, scratch_path
from ..sinks.publish import read_published
from ..sinks.writers import append_rows, export_tables, write_json, write_json_arrays, write_run_date, write_snapshots
from ..sources import (DRIVER_TABLES, Tables, day_range, empty_frame, filter_time_id, read_lake,
                       read_landing, read_landing_range, read_table, rename_bars, unwrap_envelope)
from ..streaming.increment import run_increment, run_increment_load
from . import analytics as qa
from . import dims, facts, normalize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# Fixed parameters of the driver queries (run dates).  Every query reads its
# whole tables; the UPSERT_* dates split orders into a stored base and an
# overlapping delta.
RUN_DAY = "1997-03-15"
RUN_TS = "2025-07-10 00:00:00"
RUN_TIME_ID = 20250710
READ_TIME_ID = 19970601
UPSERT_BASE_BEFORE = "1999-01-01"
UPSERT_DELTA_FROM = "1998-01-01"


def _latest_orders_sql(cols="*"):
    return (f"(SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
            f"ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)")


# ---------------------------------------------------------------------------
# stand-in views
# ---------------------------------------------------------------------------

def company_versions(t: Tables) -> DataFrame:
    """dim_companies stand-in: each order is a version of its customer."""
    o = t.orders
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("ticker"),
                    (F.col("o_orderstatus") == "F").alias("is_delisted"),
                    F.when(F.col("o_orderpriority") == "5-LOW", F.lit("  "))
                    .otherwise(F.col("o_orderpriority")).alias("sic_sector"),
                    F.col("o_orderdate").alias("updated_time"))


def latest_company_profiles(t: Tables) -> DataFrame:
    """Latest version per ticker, then the static attributes.

    The window runs on the narrow version rows first (its partial
    WindowGroupLimit shrinks each ticker before the shuffle); only the
    survivors are joined to customer, and nation/region (bounded) are
    broadcast."""
    latest = qa.latest_companies(company_versions(t))
    c, n, r = t.customer, t.nation, t.region
    return (latest.join(c, latest.ticker == c.c_custkey)
            .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .select("id", "ticker", "is_delisted", "sic_sector", "updated_time",
                    F.col("c_name").alias("name"), F.col("n_name").alias("exchange"),
                    F.concat_ws("; ", "n_name", "r_name").alias("location"),
                    F.nullif(F.col("c_mktsegment"), F.lit("AUTOMOBILE")).alias("sector")))


def part_candles(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Candles stand-in: lineitem rows, and their companies: parts."""
    candles = t.lineitem.select(
        F.col("l_partkey").alias("company_id"), F.col("l_quantity").alias("volume"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("close"),
        F.to_date("l_shipdate").alias("trade_date"))
    companies = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("ticker"))
    return candles, companies


def _sentiment():
    return F.round(F.col("l_discount") - F.col("l_tax"), 4) + F.lit(0.0)


# ---------------------------------------------------------------------------
# analytics (QRY-*)
# ---------------------------------------------------------------------------

@query("topk_volume", """
SELECT p_name AS ticker, sum(l_quantity) AS total_volume
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_name ORDER BY total_volume DESC, ticker LIMIT 10
""")
def topk_volume(spark, d):
    return qa.top_volume_tickers(*part_candles(Tables(spark, d)), k=10)


@query("price_trend", """
WITH j AS (SELECT p_name AS ticker, CAST(l_shipdate AS DATE) AS trade_date,
                  l_extendedprice / l_quantity AS close, l_quantity
           FROM lineitem JOIN part ON l_partkey = p_partkey),
     top AS (SELECT ticker FROM j GROUP BY ticker
             ORDER BY sum(l_quantity) DESC, ticker LIMIT 3)
SELECT ticker, trade_date, floor(avg(close) * 1000000.0 + 0.501) / 1000000.0 AS avg_close
FROM j WHERE ticker IN (SELECT ticker FROM top)
GROUP BY ticker, trade_date
""")
def price_trend(spark, d):
    candles, companies = part_candles(Tables(spark, d))
    # the few companies of the chosen tickers first: candles of others never reach the join's shuffle
    chosen = companies.join(qa.top_volume_tickers(candles, companies, k=3).select("ticker"), "ticker", "left_semi")
    out = qa.price_trend(qa.candles_with_companies(candles, chosen), chosen.select("ticker").distinct(),
                         ts_col="trade_date")
    return out.withColumn("avg_close", round_half_up("avg_close", 6))


@query("daily_totals", """
SELECT CAST(l_shipdate AS DATE) AS trade_date,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_volume,
       CAST(sum(CAST(l_linenumber AS BIGINT)) AS BIGINT) AS total_trades,
       CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS otc_rows
FROM lineitem GROUP BY 1
""")
def daily_totals(spark, d):
    li = Tables(spark, d).lineitem
    candles = li.select(F.col("l_quantity").cast("long").alias("volume"),
                        F.col("l_linenumber").cast("long").alias("num_of_trades"),
                        (F.col("l_returnflag") == "R").alias("is_otc"),
                        F.col("l_shipdate").alias("time_stamp"))
    return qa.daily_totals(candles)


@query("latest_per_key", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM {_latest_orders_sql()}
""")
def latest_per_key(spark, d):
    o = Tables(spark, d).orders
    return op.latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("company_count", f"""
SELECT count(*) AS companies FROM {_latest_orders_sql('o_custkey')}
""")
def company_count(spark, d):
    return qa.company_count(company_versions(Tables(spark, d)))


_PROFILE_SQL = f"""
(SELECT l.o_custkey, c_name, n_name, r_name, c_mktsegment, l.o_orderstatus, l.o_orderpriority
 FROM {_latest_orders_sql()} l JOIN customer ON l.o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


@query("count_by_exchange", f"""
SELECT n_name AS exchange, count(*) AS num_companies FROM {_PROFILE_SQL} p GROUP BY n_name
""")
def count_by_exchange(spark, d):
    return qa.count_by(latest_company_profiles(Tables(spark, d)), "exchange", "num_companies")


@query("count_by_country", f"""
SELECT list_extract(string_split(n_name || '; ' || r_name, ';'), -1) AS country,
       count(*) AS num_companies
FROM {_PROFILE_SQL} p GROUP BY 1
""")
def count_by_country(spark, d):
    return qa.count_by_country(latest_company_profiles(Tables(spark, d)), out="num_companies")


@query("count_by_sector", f"""
SELECT sector, count(*) AS num_companies
FROM (SELECT nullif(c_mktsegment, 'AUTOMOBILE') AS sector FROM {_PROFILE_SQL} p)
WHERE sector IS NOT NULL AND trim(sector) <> '' GROUP BY sector
""")
def count_by_sector(spark, d):
    return qa.count_by(latest_company_profiles(Tables(spark, d)), "sector", "num_companies",
                       drop_blank=True)


@query("count_by_sic", f"""
SELECT sic_sector, count(*) AS num_companies
FROM (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN '  ' ELSE o_orderpriority END
             AS sic_sector FROM {_PROFILE_SQL} p)
WHERE sic_sector IS NOT NULL AND trim(sic_sector) <> '' GROUP BY sic_sector
""")
def count_by_sic(spark, d):
    return qa.count_by(latest_company_profiles(Tables(spark, d)), "sic_sector", "num_companies",
                       drop_blank=True)


@query("count_by_status", f"""
SELECT CASE WHEN o_orderstatus = 'F' THEN 'delisted' ELSE 'active' END AS status,
       count(*) AS num_companies
FROM {_PROFILE_SQL} p GROUP BY 1
""")
def count_by_status(spark, d):
    return qa.listing_status_counts(latest_company_profiles(Tables(spark, d)), "num_companies")


@query("typed_candles", """
SELECT event_id, epoch_ms(CAST(floor(epoch_us(ts) / 1000) AS BIGINT)) AS time_stamp,
       coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE event_type = 'purchase' END,
                false) AS is_otc
FROM events
""")
def typed_candles(spark, d):
    ev = Tables(spark, d).events
    raw = ev.select("event_id",
                    ts_to_epoch_ms("ts").cast("string").alias("time_stamp"),
                    F.when(F.col("event_type") == "error", F.lit(None).cast("boolean"))
                    .otherwise(F.col("event_type") == "purchase").alias("is_otc"))
    return qa.typed_candles(raw)


def _events_as_news(t: Tables) -> DataFrame:
    ev = t.events
    return ev.select(F.col("event_id").alias("id"), F.col("event_type").alias("source"),
                     format_compact_ts("ts").alias("time_published"),
                     F.col("props").alias("summary"))


@query("typed_news", """
SELECT event_id AS id, event_type AS source,
       strptime(strftime(ts, '%Y%m%dT%H%M%S'), '%Y%m%dT%H%M%S') AS time_published
FROM events
""")
def typed_news(spark, d):
    return qa.typed_news(_events_as_news(Tables(spark, d)))


@query("count_by_source", """
SELECT source, count(*) AS articles FROM documents GROUP BY source
""")
def count_by_source(spark, d):
    return qa.count_by(Tables(spark, d).documents, "source", "articles")


@query("count_by_hour", """
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS articles FROM events GROUP BY 1
""")
def count_by_hour(spark, d):
    return qa.count_by_hour(qa.typed_news(_events_as_news(Tables(spark, d))))


def _mention_star(t: Tables):
    fnc = t.lineitem.select(F.col("l_orderkey").alias("new_id"),
                            F.col("l_suppkey").alias("company_id"),
                            _sentiment().alias("ticker_sentiment_score"))
    news = t.orders.select(F.col("o_orderkey").alias("id"),
                           time_id("o_orderdate").alias("time_id"),
                           F.concat("o_orderpriority", F.lit(" #"),
                                    F.col("o_orderkey").cast("string")).alias("title"))
    companies = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("ticker"))
    cal = dims.calendar_rows(t.orders.select(F.col("o_orderdate").alias("date")))
    return fnc, news, companies, cal


@query("mentions_star", """
SELECT s_name AS ticker, CAST(o_orderdate AS DATE) AS "date", count(*) AS num_mentions
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY 1, 2
""")
def mentions_star(spark, d):
    return qa.mentions_per_day(*_mention_star(Tables(spark, d)))


@query("bottomk_sentiment", """
SELECT s_name AS ticker, o_orderpriority || ' #' || CAST(o_orderkey AS VARCHAR) AS title,
       round(l_discount - l_tax, 4) + 0.0 AS ticker_sentiment_score
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
ORDER BY 3, 1, 2 LIMIT 10
""")
def bottomk_sentiment(spark, d):
    fnc, news, companies, _ = _mention_star(Tables(spark, d))
    return qa.lowest_sentiment(fnc, news, companies, k=10)


@query("read_by_time", f"""
SELECT *, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS time_id FROM lineitem
WHERE CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) = {READ_TIME_ID}
""")
def read_by_time(spark, d):
    li = filter_time_id(Tables(spark, d).lineitem, str(READ_TIME_ID), date_col="l_shipdate")
    return li.withColumn("time_id", time_id("l_shipdate"))


# ---------------------------------------------------------------------------
# sources, projections, filters (SRC-*, PRJ-*, FLT-*)
# ---------------------------------------------------------------------------

@query("scan_run_date", f"""
SELECT *, CAST(o_orderdate AS DATE) AS run_date FROM orders
WHERE o_orderdate >= TIMESTAMP '{RUN_DAY}' AND o_orderdate < TIMESTAMP '{RUN_DAY}' + INTERVAL 1 DAY
""")
def scan_run_date(spark, d):
    o = Tables(spark, d).orders
    return o.where(day_range("o_orderdate", RUN_DAY)).withColumn("run_date",
                                                                  F.to_date("o_orderdate"))


@query("day_snapshot", f"""
SELECT c_custkey, c_name, o_orderkey, o_orderdate AS updated_time
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE date_trunc('day', o_orderdate) = DATE '{RUN_DAY}'
""")
def day_snapshot(spark, d):
    t = Tables(spark, d)
    changed = t.orders.where(day_range("o_orderdate", RUN_DAY))
    return (changed.join(t.customer, changed.o_custkey == t.customer.c_custkey)
            .select("c_custkey", "c_name", "o_orderkey",
                    F.col("o_orderdate").alias("updated_time")))


@query("envelope_unwrap", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type <> 'error'
""")
def envelope_unwrap(spark, d):
    ev = Tables(spark, d).events
    # one landed response body per event; 'error' responses lack the
    # optional "results" key and contribute no rows
    bodies = ev.select("event_id", F.when(F.col("event_type") == "error", F.lit("{}"))
                       .otherwise(F.concat(F.lit('{"results": ['), F.col("props"), F.lit("]}")))
                       .alias("body"))
    payload = T.StructType([T.StructField("k", T.LongType())])
    return unwrap_envelope(bodies, "body", "results", payload, required=False) \
        .select("event_id", "k")


@query("empty_batch", """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events FROM events GROUP BY 1, 2
""")
def empty_batch(spark, d):
    ev = Tables(spark, d).events
    schema = ev.schema
    # a non-trading day: the drop is "[]" — typed and empty, it must be a no-op
    quiet_day = empty_frame(spark, schema)
    batch = ev.unionByName(quiet_day)
    return (batch.groupBy(F.to_date("ts").alias("day"), "event_type")
            .agg(F.count(F.lit(1)).alias("events")))


@query("rename_project", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS exchange_id,
       c_acctbal AS market_cap, c_mktsegment AS sector FROM customer
""")
def rename_project(spark, d):
    c = Tables(spark, d).customer
    return op.rename_fields(c, {"c_custkey": "id", "c_name": "name", "c_nationkey": "exchange_id",
                                "c_acctbal": "market_cap", "c_mktsegment": "sector"})


@query("drop_null_distinct", """
SELECT DISTINCT return_flag, line_status, ship_year FROM (
  SELECT nullif(l_returnflag, 'N') AS return_flag, l_linestatus AS line_status,
         CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM lineitem)
WHERE return_flag IS NOT NULL AND line_status IS NOT NULL AND ship_year IS NOT NULL
""")
def drop_null_distinct(spark, d):
    li = Tables(spark, d).lineitem
    rows = li.select(F.nullif(F.col("l_returnflag"), F.lit("N")).alias("return_flag"),
                     F.col("l_linestatus").alias("line_status"),
                     F.year("l_shipdate").alias("ship_year"))
    return op.drop_incomplete_distinct(rows)


@query("sic_presence_distinct", """
SELECT DISTINCT nullif(p_type, 'PROMO') AS id, p_brand AS sic_industry, p_name AS sic_sector
FROM part WHERE nullif(p_type, 'PROMO') IS NOT NULL
""")
def sic_presence_distinct(spark, d):
    p = Tables(spark, d).part
    raw = p.select(F.nullif(F.col("p_type"), F.lit("PROMO")).alias("sic"),
                   F.col("p_brand").alias("sicIndustry"), F.col("p_name").alias("sicSector"))
    return normalize.sic_industries(raw)


@query("split_explode_trim", """
SELECT DISTINCT trim(tok) AS name, p_type AS region
FROM (SELECT unnest(string_split(replace(p_name, ' ', ',  '), ',')) AS tok, p_type FROM part)
""")
def split_explode_trim(spark, d):
    p = Tables(spark, d).part
    markets = p.select(F.regexp_replace("p_name", " ", ",  ").alias("primary_exchanges"),
                       F.col("p_type").alias("region"))
    return normalize.exchanges(markets)


@query("allowlist_filter", """
SELECT c_custkey, c_name, c_mktsegment, 'USD' AS currency FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal >= 0
""")
def allowlist_filter(spark, d):
    c = Tables(spark, d).customer
    rows = c.select("c_custkey", "c_name", "c_mktsegment",
                    F.when(F.col("c_acctbal") >= 0, F.lit("USD")).otherwise(F.lit("EUR"))
                    .alias("currency"))
    return op.allowlist(rows, "c_mktsegment", ["BUILDING", "MACHINERY"], currency="USD")


# ---------------------------------------------------------------------------
# joins and keys (JON-*, KEY-*, DQ-5)
# ---------------------------------------------------------------------------

@query("denormalise_chain", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus, c_name,
       n_name AS exchange, r_name AS region
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
""")
def denormalise_chain(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", F.col("n_name").alias("exchange"), "n_regionkey")
    r = t.region.select("r_regionkey", F.col("r_name").alias("region"))
    out = (li.join(o, li.l_orderkey == o.o_orderkey, "left")
           .join(c, o.o_custkey == c.c_custkey, "left")
           .join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
           .join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderstatus",
                      "c_name", "exchange", "region")


def _known_keys(t: Tables) -> DataFrame:
    """Suppliers as the dimension: it holds some of the customers' keys, not all."""
    return t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("key"))


@query("fk_lookup", """
SELECT customer.*, s_suppkey AS exchange_id FROM customer JOIN supplier ON c_custkey = s_suppkey
""")
def fk_lookup(spark, d):
    t = Tables(spark, d)
    matched, _ = op.resolve_fk(t.customer, _known_keys(t), {"c_custkey": "key"}, alias="exchange_id")
    return matched


@query("fk_quarantine", """
SELECT customer.*, 'unknown c_custkey' AS reason FROM customer
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)
""")
def fk_quarantine(spark, d):
    t = Tables(spark, d)
    _, missed = op.resolve_fk(t.customer, _known_keys(t), {"c_custkey": "key"}, alias="exchange_id")
    return missed


@query("fk_several", """
SELECT o_orderkey, c_custkey AS company_id, s_suppkey AS venue_id, CAST(NULL AS VARCHAR) AS reason
FROM orders JOIN customer ON o_custkey = c_custkey JOIN supplier ON o_custkey = s_suppkey
UNION ALL
SELECT o_orderkey, NULL, NULL, CASE WHEN c_custkey IS NULL THEN 'unknown o_custkey' ELSE 'unknown venue' END
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON o_custkey = s_suppkey
WHERE c_custkey IS NULL OR s_suppkey IS NULL
""")
def fk_several(spark, d):
    """JON-4/5, DQ-5: two foreign keys of orders resolved in one pass, matched and missed rows."""
    t = Tables(spark, d)
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_custkey").alias("venue"))
    matched, missed = op.resolve_fks(rows, [
        (t.customer.select(F.col("c_custkey").alias("id"), "c_custkey"), {"o_custkey": "c_custkey"}, "company_id"),
        (t.supplier.select(F.col("s_suppkey").alias("id"), "s_suppkey"), {"venue": "s_suppkey"}, "venue_id")])
    cols = ["o_orderkey", "company_id", "venue_id", "reason"]
    return matched.withColumn("reason", F.lit(None).cast("string")).select(*cols).unionByName(
        missed.withColumns({"company_id": F.lit(None).cast("long"), "venue_id": F.lit(None).cast("long")}).select(*cols))


@query("surrogate_ids", """
WITH d AS (SELECT p_brand, p_type, row_number() OVER (ORDER BY p_brand, p_type) AS id
           FROM (SELECT DISTINCT p_brand, p_type FROM part))
SELECT p_partkey, id AS industry_id FROM part JOIN d USING (p_brand, p_type)
""")
def surrogate_ids(spark, d):
    p = Tables(spark, d).part
    industries = op.assign_dense_ids(p.select("p_brand", "p_type").distinct(),
                                     ["p_brand", "p_type"])
    matched, _ = op.resolve_fk(p, industries, ["p_brand", "p_type"], alias="industry_id")
    return matched.select("p_partkey", "industry_id")


@query("row_hash_concat", """
SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR) || c_name || CAST(c_nationkey AS VARCHAR)
                      || c_mktsegment) AS hash_row FROM customer
""")
def row_hash_concat_q(spark, d):
    c = Tables(spark, d).customer
    return c.select("c_custkey", row_hash_concat(
        ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]).alias("hash_row"))


@query("row_hash_json", """
SELECT c_custkey, md5(to_json({'c_custkey': c_custkey, 'c_mktsegment': c_mktsegment,
                               'c_name': c_name, 'c_nationkey': c_nationkey})) AS hash_row
FROM customer
""")
def row_hash_json_q(spark, d):
    c = Tables(spark, d).customer
    return c.select("c_custkey", row_hash_json(
        ["c_nationkey", "c_name", "c_custkey", "c_mktsegment"]).alias("hash_row"))


# ---------------------------------------------------------------------------
# merges (MRG-*, DIM-*, FCT-*)
# ---------------------------------------------------------------------------

_UPSERT_COLS = ["o_custkey", "o_orderstatus", "o_orderpriority"]


def _upsert_inputs(t: Tables):
    o = t.orders
    base = o.where(F.col("o_orderdate") < F.lit(UPSERT_BASE_BEFORE).cast("timestamp_ntz")).select(
        "o_orderkey", *_UPSERT_COLS, row_hash_json(_UPSERT_COLS).alias("hash_row"),
        F.col("o_orderdate").alias("updated_time"))
    delta = o.where(F.col("o_orderdate") >= F.lit(UPSERT_DELTA_FROM).cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("X"))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority", "o_orderdate")
    return base, delta


_UPSERT_HASH = ("md5(to_json({'o_custkey': o_custkey, 'o_orderpriority': o_orderpriority, "
                "'o_orderstatus': o_orderstatus}))")


@query("upsert_changed", f"""
WITH b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
                  {_UPSERT_HASH} AS hash_row, o_orderdate AS updated_time
           FROM orders WHERE o_orderdate < TIMESTAMP '{UPSERT_BASE_BEFORE}'),
     d AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
                  {_UPSERT_HASH} AS hash_row
           FROM (SELECT o_orderkey, o_custkey, o_orderpriority,
                        CASE WHEN o_orderpriority = '1-URGENT' THEN 'X'
                             ELSE o_orderstatus END AS o_orderstatus
                 FROM orders WHERE o_orderdate >= TIMESTAMP '{UPSERT_DELTA_FROM}')),
     j AS (SELECT b.o_orderkey AS bk, d.o_orderkey AS dk, b.o_custkey AS b_c, d.o_custkey AS d_c,
                  b.o_orderstatus AS b_s, d.o_orderstatus AS d_s,
                  b.o_orderpriority AS b_p, d.o_orderpriority AS d_p,
                  b.hash_row AS b_h, d.hash_row AS d_h, b.updated_time AS b_t,
                  CASE WHEN b.o_orderkey IS NULL THEN 'inserted'
                       WHEN d.o_orderkey IS NULL THEN 'kept'
                       WHEN b.hash_row IS DISTINCT FROM d.hash_row THEN 'updated'
                       ELSE 'unchanged' END AS action
           FROM b FULL OUTER JOIN d ON b.o_orderkey = d.o_orderkey)
SELECT coalesce(dk, bk) AS o_orderkey,
       CASE WHEN action IN ('inserted', 'updated') THEN d_c ELSE b_c END AS o_custkey,
       CASE WHEN action IN ('inserted', 'updated') THEN d_s ELSE b_s END AS o_orderstatus,
       CASE WHEN action IN ('inserted', 'updated') THEN d_p ELSE b_p END AS o_orderpriority,
       CASE WHEN action IN ('inserted', 'updated') THEN d_h ELSE b_h END AS hash_row,
       CASE WHEN action IN ('inserted', 'updated') THEN TIMESTAMP '{RUN_TS}' ELSE b_t END
           AS updated_time,
       action
FROM j
""")
def upsert_changed(spark, d):
    base, delta = _upsert_inputs(Tables(spark, d))
    return op.upsert(base, delta, ["o_orderkey"], _UPSERT_COLS, order_by=["o_orderdate"],
                     run_ts=RUN_TS)


@query("upsert_report", f"""
SELECT action, count(*) AS "rows" FROM (
  SELECT CASE WHEN b.o_orderkey IS NULL THEN 'inserted'
              WHEN d.o_orderkey IS NULL THEN 'kept'
              WHEN b.o_orderstatus IS DISTINCT FROM d.o_orderstatus THEN 'updated'
              ELSE 'unchanged' END AS action
  FROM (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{UPSERT_BASE_BEFORE}') b
  FULL OUTER JOIN (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X'
                                           ELSE o_orderstatus END AS o_orderstatus
                   FROM orders WHERE o_orderdate >= TIMESTAMP '{UPSERT_DELTA_FROM}') d
  ON b.o_orderkey = d.o_orderkey) GROUP BY action
""")
def upsert_report(spark, d):
    return op.merge_report(upsert_changed(spark, d))


@query("insert_ignore", """
SELECT DISTINCT p_brand, p_type, false AS inserted FROM part WHERE p_size <= 25
UNION ALL
SELECT DISTINCT p_brand, p_type, true AS inserted FROM part p
WHERE NOT EXISTS (SELECT 1 FROM part q WHERE q.p_size <= 25
                  AND q.p_brand = p.p_brand AND q.p_type = p.p_type)
""")
def insert_ignore(spark, d):
    p = Tables(spark, d).part
    target = p.where(F.col("p_size") <= 25).select("p_brand", "p_type").distinct()
    return op.insert_ignore(target, p.select("p_brand", "p_type"), ["p_brand", "p_type"])


@query("insert_new_single", """
SELECT * FROM customer
WHERE c_custkey NOT IN (SELECT l_suppkey FROM lineitem)
""")
def insert_new_single(spark, d):
    t = Tables(spark, d)
    target = t.lineitem.select(F.col("l_suppkey").alias("c_custkey"))
    return op.insert_new(target, t.customer, ["c_custkey"], dedupe_batch=False)


_LI_ALL_DESC = ("l_shipdate DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, "
                "l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC")


@query("insert_new_composite", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey
                               ORDER BY {_LI_ALL_DESC}) AS rn
  FROM lineitem b WHERE l_shipdate >= TIMESTAMP '1997-01-01'
    AND NOT EXISTS (SELECT 1 FROM lineitem t WHERE t.l_shipdate < TIMESTAMP '1998-01-01'
                    AND t.l_orderkey = b.l_orderkey AND t.l_partkey = b.l_partkey
                    AND t.l_suppkey = b.l_suppkey))
WHERE rn = 1
""")
def insert_new_composite(spark, d):
    li = Tables(spark, d).lineitem
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    target = li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    batch = li.where(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    order = ["l_shipdate", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus"]
    return op.insert_new(target, batch, keys, order_by=order) \
        .select(*keys, "l_linenumber", "l_quantity", "l_shipdate")


@query("insert_new_exists", """
WITH b AS (SELECT l_suppkey AS company_id,
                  CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS time_id,
                  sum(l_quantity) AS volume
           FROM lineitem GROUP BY 1, 2)
SELECT * FROM b WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = b.company_id
  AND CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) = b.time_id)
""")
def insert_new_exists(spark, d):
    t = Tables(spark, d)
    batch = (t.lineitem.groupBy(F.col("l_suppkey").alias("company_id"),
                                time_id("l_shipdate").alias("time_id"))
             .agg(F.sum("l_quantity").alias("volume")))
    target = t.orders.select(F.col("o_custkey").alias("company_id"),
                             time_id("o_orderdate").alias("time_id"))
    return op.insert_new(target, batch, ["company_id", "time_id"], dedupe_batch=False)


@query("dim_time", """
SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS id, d AS "date",
       dayname(d) AS day_of_week, monthname(d) AS month,
       CAST(quarter(d) AS VARCHAR) AS quarter, CAST(year(d) AS INTEGER) AS year
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(ts AS DATE) FROM events)
WHERE d NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)
""")
def dim_time(spark, d):
    t = Tables(spark, d)
    existing = dims.calendar_rows(t.lineitem.select(F.col("l_shipdate").alias("date")))
    dates = t.orders.select(F.to_date("o_orderdate").alias("date")).unionByName(
        t.events.select(F.to_date("ts").alias("date")))
    return dims.new_dates(existing, dates)


@query("explode_struct_topics", """
WITH t AS (SELECT DISTINCT name FROM (
    SELECT CAST(l_partkey AS VARCHAR) AS name FROM lineitem WHERE l_returnflag <> 'N'
    UNION ALL
    SELECT 'supp' || CAST(l_suppkey AS VARCHAR) FROM lineitem WHERE l_returnflag <> 'N'))
SELECT row_number() OVER (ORDER BY name) AS id, name FROM t
""")
def explode_struct_topics(spark, d):
    li = Tables(spark, d).lineitem
    topic = lambda name, score: F.struct(name.alias("topic"),
                                         score.cast("string").alias("relevance_score"))
    news = li.select(F.when(F.col("l_returnflag") == "N", F.array().cast(
        T.ArrayType(T.StructType([T.StructField("topic", T.StringType()),
                                  T.StructField("relevance_score", T.StringType())]))))
        .otherwise(F.array(topic(F.col("l_partkey").cast("string"), F.col("l_discount")),
                           topic(F.concat(F.lit("supp"), F.col("l_suppkey").cast("string")),
                                 F.col("l_tax")))).alias("topics"))
    existing = spark.createDataFrame([], "id long, name string")
    return dims.new_topics(existing, news).select("id", "name")


@query("dim_news_load", f"""
SELECT doc_id, text, source, lang, {RUN_TIME_ID} AS time_id FROM (
  SELECT *, row_number() OVER (PARTITION BY text, source, lang ORDER BY doc_id DESC) AS rn
  FROM documents) WHERE rn = 1
""")
def dim_news_load(spark, d):
    docs = Tables(spark, d).documents
    news = docs.select("doc_id", F.col("text").alias("title"), F.col("source").alias("url"),
                       F.col("lang").alias("time_published"), "source")
    existing = spark.createDataFrame([], "title string, url string, time_published string")
    rows = op.insert_new(existing, news, dims.NEWS_KEY, order_by=["doc_id"])
    return rows.select("doc_id", F.col("title").alias("text"), "source",
                       F.col("time_published").alias("lang"),
                       time_id(F.to_date(F.lit(RUN_TS))).alias("time_id"))


@query("bridge_news_topics", r"""
WITH vocab AS (SELECT name, row_number() OVER (ORDER BY name) AS topic_id FROM (
                 SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS name
                 FROM benchmark) WHERE name <> ''),
     toks AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS name
              FROM documents)
SELECT doc_id AS new_id, topic_id, CAST(count(*) AS DOUBLE) AS relevance_score
FROM toks JOIN vocab USING (name) GROUP BY 1, 2
""")
def bridge_news_topics(spark, d):
    t = Tables(spark, d)
    # topic vocabulary: the words of the benchmark passages (quoted by documents)
    vocab_words = t.benchmark.select(F.explode(word_tokens("text")).alias("name")).distinct()
    topics = op.assign_dense_ids(vocab_words, ["name"]).withColumnRenamed("id", "topic_id")
    words = t.documents.select(F.col("doc_id").alias("new_id"),
                               F.explode(word_tokens("text")).alias("name"))
    # words outside the vocabulary go before anything is shuffled (AQE broadcasts the vocabulary where its measured size
    # allows it, else splits a hot word's partition); a document's words are counted within its task
    links = (words.join(topics, "name").groupBy("new_id", "topic_id")
             .agg(F.count(F.lit(1)).cast("double").alias("relevance_score")))
    existing = spark.createDataFrame([], "new_id long, topic_id long")
    return op.insert_new(existing, links, ["new_id", "topic_id"], dedupe_batch=False)


_LABEL = ("CASE WHEN ticker_sentiment_score < 0 THEN 'Bearish' "
          "WHEN ticker_sentiment_score > 0 THEN 'Bullish' ELSE 'Neutral' END")


@query("bridge_news_companies", f"""
WITH latest AS (SELECT o_custkey AS ticker, o_orderkey AS company_id FROM {_latest_orders_sql()}),
     m AS (SELECT l_orderkey AS new_id, company_id, l_quantity AS relevance_score,
                  round(l_discount - l_tax, 4) + 0.0 AS ticker_sentiment_score
           FROM lineitem JOIN latest ON l_suppkey = ticker
           WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)),
     d AS (SELECT *, row_number() OVER (PARTITION BY new_id, company_id
                                        ORDER BY ticker_sentiment_score DESC,
                                                 relevance_score DESC) AS rn FROM m)
SELECT new_id, company_id, relevance_score, ticker_sentiment_score,
       {_LABEL} AS ticker_sentiment_label
FROM d WHERE rn = 1
""")
def bridge_news_companies(spark, d):
    t = Tables(spark, d)
    latest = op.latest_id_per_key(company_versions(t), "ticker", ["updated_time", "id"]) \
        .withColumnRenamed("id", "company_id")
    mentions = t.lineitem.select(F.col("l_orderkey").alias("new_id"),
                                 F.col("l_suppkey").alias("ticker"),
                                 F.col("l_quantity").alias("relevance_score"),
                                 _sentiment().alias("ticker_sentiment_score"))
    score = F.col("ticker_sentiment_score")
    links = (mentions.join(latest, "ticker")
             .join(t.orders.select(F.col("o_orderkey").alias("new_id")), "new_id", "left_semi")
             .withColumn("ticker_sentiment_label",
                         F.when(score < 0, F.lit("Bearish")).when(score > 0, F.lit("Bullish"))
                         .otherwise(F.lit("Neutral"))))
    existing = spark.createDataFrame([], "new_id long, company_id long")
    rows = op.insert_new(existing, links, ["new_id", "company_id"],
                         order_by=["ticker_sentiment_score", "relevance_score"])
    return rows.select("new_id", "company_id", "relevance_score", "ticker_sentiment_score",
                       "ticker_sentiment_label")


def _event_bars(events: DataFrame) -> DataFrame:
    """Daily bars per (user, day): built in the vendor's single-letter shape
    (T, v, vw, o, c, h, l, t, n, otc), then renamed positionally (PRJ-2)."""
    day = F.to_date("ts")
    order = F.struct("ts", "event_id")
    agg = (events.groupBy(F.col("user_id").cast("string").alias("_T"), day.alias("_day"))
           .agg(F.count(F.lit(1)).alias("_n"),
                exact_mean("value", 2).alias("_vw"),          # values are in cents
                F.min_by("value", order).alias("_o"),
                F.max_by("value", order).alias("_c"),
                F.max("value").alias("_h"), F.min("value").alias("_l")))
    vendor = F.struct(F.col("_T").alias("T"), F.col("_n").cast("double").alias("v"),
                      F.col("_vw").alias("vw"), F.col("_o").alias("o"), F.col("_c").alias("c"),
                      F.col("_h").alias("h"), F.col("_l").alias("l"),
                      ts_to_epoch_ms(F.col("_day").cast("timestamp_ntz")).alias("t"),
                      F.col("_n").alias("n"), F.lit(None).cast("boolean").alias("otc"))
    return agg.select(rename_bars(vendor).alias("bar")).select("bar.*")


@query("fact_candles", """
WITH e AS (SELECT *, CAST(ts AS DATE) AS day,
                  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                     ORDER BY ts, event_id) AS r_first,
                  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                     ORDER BY ts DESC, event_id DESC) AS r_last
           FROM events)
SELECT c_custkey AS company_id, count(*) AS volume,
       CAST(sum(CAST(round(value * 100.0) AS BIGINT)) AS DOUBLE) / count(value) / 100.0
       AS volume_weighted,
       max(value) FILTER (WHERE r_first = 1) AS open, max(value) FILTER (WHERE r_last = 1) AS close,
       max(value) AS high, min(value) AS low,
       CAST(epoch_ms(CAST(day AS TIMESTAMP)) AS VARCHAR) AS time_stamp,
       count(*) AS num_of_trades, false AS is_otc,
       CAST(strftime(day, '%Y%m%d') AS INTEGER) AS time_id
FROM e JOIN customer ON c_custkey = user_id
WHERE day >= DATE '2024-01-10'
GROUP BY c_custkey, day
""")
def fact_candles(spark, d):
    t = Tables(spark, d)
    companies = t.customer.select(F.col("c_custkey").alias("id"),
                                  F.col("c_custkey").cast("string").alias("ticker"),
                                  F.lit(RUN_TS).cast("timestamp_ntz").alias("updated_time"))
    early = t.events.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    stored = facts.candle_rows(_event_bars(early), companies)
    # the bars' days, read straight off the raw event times (a superset of
    # the candle days) — pruning the stored facts without re-running the bars
    days = t.events.select(time_id(F.to_date("ts")).alias("time_id"))
    rows = facts.new_candles(stored, _event_bars(t.events), companies, days=days)
    return rows.drop("id")


@query("typed_candles_epoch", """
SELECT event_id, epoch_ms(CAST(floor(epoch_us(ts) / 1000) AS BIGINT)) AS time_stamp
FROM events
""")
def typed_candles_epoch(spark, d):
    ev = Tables(spark, d).events
    ms_text = ts_to_epoch_ms("ts").cast("string")
    return ev.select("event_id", epoch_ms_to_ts(ms_text).alias("time_stamp"))


# ---------------------------------------------------------------------------
# sets, quality, export, backfill, stream (SET-*, DQ-*, SNK-*, BKF-1, STR-1)
# ---------------------------------------------------------------------------

@query("union_sources", """
SELECT 'clicks' AS source, event_id, ts, user_id, value, NULL AS props, NULL AS event_type
FROM events WHERE event_type = 'click'
UNION ALL
SELECT 'views', event_id, ts, user_id, NULL, props, NULL FROM events WHERE event_type = 'view'
UNION ALL
SELECT 'other', event_id, ts, NULL, NULL, NULL, event_type FROM events
WHERE event_type NOT IN ('click', 'view')
""")
def union_sources(spark, d):
    ev = Tables(spark, d).events
    clicks = ev.where("event_type = 'click'").select("event_id", "ts", "user_id", "value")
    views = ev.where("event_type = 'view'").select("event_id", "ts", "user_id", "props")
    other = ev.where("event_type NOT IN ('click', 'view')").select("event_id", "ts", "event_type")
    return op.union_sources([clicks, views, other], tag_col="source",
                            tags=["clicks", "views", "other"])


# the vendor's cap: the mean number of events a day, so that at every size some days reach it
_CAPPED_SQL = """
WITH e AS (SELECT *, CAST(ts AS DATE) AS run_date FROM events),
     n AS (SELECT run_date, count(*) AS n FROM e GROUP BY run_date),
     c AS (SELECT CAST(floor(avg(n)) AS BIGINT) AS cap FROM n)
"""


def _zones(spark, d):
    """All events requested three times: whole days, mornings, afternoons; and the cap."""
    ev = Tables(spark, d).events.select("event_id", "ts", F.to_date("ts").alias("run_date"))
    cap = ev.groupBy("run_date").count().agg(F.floor(F.avg("count"))).first()[0]
    zone = F.explode(F.array(F.lit(1), F.when(F.hour("ts") < 12, F.lit(2)).otherwise(F.lit(3))))
    return ev.select("*", zone.alias("zone")), int(cap or 0)


@query("capped_batches", _CAPPED_SQL + """
SELECT event_id, run_date,
       CASE WHEN n < cap THEN 1 WHEN hour(ts) < 12 THEN 2 ELSE 3 END AS zone
FROM e JOIN n USING (run_date) CROSS JOIN c
""")
def capped_batches(spark, d):
    batches, cap = _zones(spark, d)
    return op.assemble_capped(batches, cap).select("event_id", "run_date", "zone")


def _landed(day):
    """What landed of a day: by its date, without the afternoon, without both halves, or without the full day."""
    return f"""CASE WHEN day({day}) % 4 = 1 THEN 'no afternoon' WHEN day({day}) % 4 = 2 THEN 'no halves'
               WHEN day({day}) % 4 = 3 THEN 'no full day' ELSE 'all' END"""


def _landed_zones(spark, d):
    batches, cap = _zones(spark, d)
    state = F.expr(_landed("run_date"))
    lost = (((state == "no afternoon") & (F.col("zone") == 3)) | ((state == "no halves") & (F.col("zone") > 1))
            | ((state == "no full day") & (F.col("zone") == 1)))
    return batches.where(~lost), cap


@query("capped_incomplete", _CAPPED_SQL + f"""
, z AS (SELECT event_id, run_date, n, cap, unnest([1, CASE WHEN hour(ts) < 12 THEN 2 ELSE 3 END]) AS zone,
               {_landed("run_date")} AS state
        FROM e JOIN n USING (run_date) CROSS JOIN c),
  l AS (SELECT * FROM z WHERE NOT (state = 'no afternoon' AND zone = 3) AND NOT (state = 'no halves' AND zone > 1)
        AND NOT (state = 'no full day' AND zone = 1))
SELECT event_id, run_date, zone FROM l
WHERE CASE WHEN state <> 'no full day' AND n < cap THEN zone = 1
           WHEN state = 'all' THEN zone > 1 ELSE true END
""")
def capped_incomplete(spark, d):
    """SET-2 where parts of a day are missing: no day is lost."""
    batches, cap = _landed_zones(spark, d)
    return op.assemble_capped(batches, cap).select("event_id", "run_date", "zone")


@query("capped_days_report", _CAPPED_SQL + f"""
, s AS (SELECT run_date, n, cap, {_landed("run_date")} AS state, greatest(am, n - am) AS most
        FROM n JOIN (SELECT run_date, count(*) FILTER (WHERE hour(ts) < 12) AS am FROM e GROUP BY 1) USING (run_date) CROSS JOIN c)
SELECT run_date, CASE WHEN state IN ('no afternoon', 'no halves') THEN 'full day at the cap, halves missing'
                      ELSE 'a half at the cap' END AS reason
FROM s WHERE (state IN ('no afternoon', 'no halves') AND n >= cap)
   OR (state = 'all' AND n >= cap AND most >= cap) OR (state = 'no full day' AND most >= cap)
""")
def capped_days_report(spark, d):
    """SET-2: the days whose batch may be incomplete."""
    batches, cap = _landed_zones(spark, d)
    return op.capped_report(batches, cap)


@query("envelope_required", """
SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       event_type IN ('error', 'view') AS envelope_error
FROM events
""")
def envelope_required(spark, d):
    """SRC-7: a required key; responses without it and truncated ones are marked, not lost."""
    ev = Tables(spark, d).events
    whole = F.concat(F.lit('{"results": ['), F.col("props"), F.lit("]}"))
    body = F.when(F.col("event_type") == "error", F.lit("{}")).when(F.col("event_type") == "view", F.concat(F.lit('{"results": [{"k": '))).otherwise(whole)
    payload = T.StructType([T.StructField("k", T.LongType())])
    out = unwrap_envelope(ev.select("event_id", body.alias("body")), "body", "results", payload, required=True)
    return out.select("event_id", "k", F.col("_envelope_error").alias("envelope_error"))


# ---------------------------------------------------------------------------
# increments against tables that already hold rows; storage round trips
# ---------------------------------------------------------------------------

def _order_news(t: Tables, lines: DataFrame) -> DataFrame:
    """Orders as articles: their lines are topics (parts) and mentions (suppliers)."""
    text = lambda c: F.col(c).cast("string")
    topic = F.struct(text("l_partkey").alias("topic"), text("l_discount").alias("relevance_score"))
    score = _sentiment()
    label = F.when(score < 0, F.lit("Bearish")).when(score > 0, F.lit("Bullish")).otherwise(F.lit("Neutral"))
    mention = F.struct(text("l_suppkey").alias("ticker"), text("l_quantity").alias("relevance_score"),
                       score.cast("string").alias("ticker_sentiment_score"), label.alias("ticker_sentiment_label"))
    # an order's few lines; they are moved as numbers, and collected where they meet
    met = lines.repartition("l_orderkey").select("l_orderkey", topic.alias("topic"), mention.alias("mention"), (F.col("l_returnflag") == "R").alias("returned"))
    per = met.groupBy("l_orderkey").agg(F.collect_list("topic").alias("topics"), F.collect_list("mention").alias("ticker_sentiment"),
                                        F.collect_list(F.when(F.col("returned"), F.col("topic"))).alias("returned_topics"),
                                        F.collect_list(F.when(F.col("returned"), F.col("mention"))).alias("returned_mentions"))
    o = t.orders
    return o.join(per, o.o_orderkey == per.l_orderkey, "left").select(
        F.concat("o_orderpriority", F.lit(" #"), text("o_orderkey")).alias("title"), F.concat(F.lit("order/"), text("o_orderkey")).alias("url"),
        format_compact_ts("o_orderdate").alias("time_published"), F.array(text("o_custkey")).alias("authors"), F.col("o_orderstatus").alias("summary"),
        F.lit("orders").alias("source"), F.col("o_totalprice").cast("double").alias("overall_sentiment_score"), F.lit("Neutral").alias("overall_sentiment_label"),
        "topics", "ticker_sentiment", "returned_topics", "returned_mentions")


def _written_news(t: Tables, links: str, returned: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The orders' articles with their ``links``, joined and written once with their day; the same with the links of
    returned lines alone; the keys of a dimension that holds them."""
    lists = ("topics", "ticker_sentiment", "returned_topics", "returned_mentions")
    written = materialise(facts.with_day(_order_news(t, t.lineitem).drop(*[c for c in lists if c not in (links, returned)])), "articles")
    news = written.drop(returned)
    stored = materialise(dims.news_rows(news, RUN_TS[:10]).select("published_day", "id"), "stored-articles")
    return news, written.drop(links).withColumnRenamed(returned, links), stored


def _order_of(rows: DataFrame, news: DataFrame) -> DataFrame:
    """Rows with the order key instead of the article's hash id."""
    keys = facts.with_new_ids(news).select("new_id", F.substring_index("url", "/", -1).cast("long").alias("o_orderkey"))
    return rows.join(keys, "new_id").drop("new_id", "id")


@query("new_news_increment", f"""
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS published_day, {RUN_TIME_ID} AS time_id, o_orderstatus AS summary
FROM orders WHERE o_orderstatus <> 'F'
""")
def new_news_increment(spark, d):
    """DIM-5 on a dimension that holds the finished orders' articles; every article comes twice."""
    t = Tables(spark, d)
    news = _order_news(t, t.lineitem)
    stored = dims.news_rows(news.where("summary = 'F'"), RUN_TS[:10])
    again = news.unionByName(news.withColumn("summary", F.lit("A")))  # the larger summary wins
    rows = dims.new_news(stored, again, RUN_TS[:10])
    return rows.select(F.substring_index("url", "/", -1).cast("long").alias("o_orderkey"), "published_day", "time_id", "summary")


@query("topic_links_increment", """
SELECT l_orderkey AS o_orderkey, l_partkey AS topic_id, max(l_discount) AS relevance_score,
       any_value(CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER)) AS published_day
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2 HAVING count(*) FILTER (WHERE l_returnflag = 'R') = 0
""")
def topic_links_increment(spark, d):
    """FCT-1 on a bridge that holds the links of returned lines."""
    t = Tables(spark, d)
    news, returned, stored_news = _written_news(t, "topics", "returned_topics")
    topics = t.part.select(F.col("p_partkey").alias("id"), F.col("p_partkey").cast("string").alias("name"))
    stored = facts.topic_links(returned, topics, stored_news)
    return _order_of(facts.new_topic_links(stored, news, topics, stored_news), news)


@query("company_links_increment", f"""
WITH latest AS (SELECT o_custkey AS ticker, o_orderkey AS company_id FROM {_latest_orders_sql()}),
     m AS (SELECT l_orderkey AS o_orderkey, company_id, CAST(l_quantity AS DOUBLE) AS relevance_score, l_returnflag,
                  round(l_discount - l_tax, 4) + 0.0 AS ticker_sentiment_score
           FROM lineitem JOIN latest ON l_suppkey = ticker JOIN orders o ON l_orderkey = o.o_orderkey),
     s AS (SELECT DISTINCT o_orderkey, company_id FROM m WHERE l_returnflag = 'R'),
     r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey, company_id ORDER BY ticker_sentiment_score DESC, relevance_score DESC) AS rn
           FROM m ANTI JOIN s USING (o_orderkey, company_id))
SELECT o_orderkey, company_id, relevance_score, ticker_sentiment_score, {_LABEL} AS ticker_sentiment_label,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS published_day
FROM r JOIN orders USING (o_orderkey) WHERE rn = 1
""")
def company_links_increment(spark, d):
    """FCT-2 on a bridge that holds the mentions of returned lines."""
    t = Tables(spark, d)
    news, returned, stored_news = _written_news(t, "ticker_sentiment", "returned_mentions")
    companies = company_versions(t).withColumn("ticker", F.col("ticker").cast("string"))
    stored = facts.company_links(returned, companies, stored_news)
    return _order_of(facts.new_company_links(stored, news, companies, stored_news), news)


@query("new_companies_increment", f"""
WITH x AS (SELECT CAST(o_custkey AS VARCHAR) AS ticker, o_orderstatus = 'F' AS is_delisted, o_orderdate AS updated_time, o_orderkey FROM orders),
     n AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY updated_time DESC, is_delisted, o_orderkey DESC) AS rn FROM x
           WHERE ticker NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier))
SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY ticker) AS id, ticker, is_delisted, updated_time
FROM n WHERE rn = 1
""")
def new_companies_increment(spark, d):
    """DIM-2 on a dimension that holds the suppliers' tickers; ids go on from its largest."""
    t = Tables(spark, d)
    stored = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").cast("string").alias("ticker"))
    extract = t.orders.select(F.col("o_custkey").cast("string").alias("ticker"), (F.col("o_orderstatus") == "F").alias("is_delisted"),
                              F.col("o_orderdate").alias("updated_time"), F.col("o_orderkey").alias("version"))
    return dims.new_companies(stored, extract).select("id", "ticker", "is_delisted", "updated_time")


@query("landing_array", "SELECT * FROM orders")
def landing_array(spark, d):
    """SRC-1, SNK-1: a dated drop of JSON arrays, read by several tasks a file."""
    o, base = Tables(spark, d).orders, scratch_path(spark, "landing")
    write_json_arrays(o, f"{base}/orders-{RUN_TIME_ID}.json")
    return read_landing(spark, base, RUN_TS[:10], o.schema)


@query("landing_missing", """
SELECT event_id, user_id, event_type, value, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN DATE '2024-01-09' ELSE DATE '2024-01-11' END AS run_date
FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-10'
""")
def landing_missing(spark, d):
    """SRC-2: drops of JSON arrays of which one run date never landed, by a range scan and by a daily read."""
    ev, base = Tables(spark, d).events, scratch_path(spark, "landing")
    rows = ev.select("event_id", "user_id", "event_type", "value")
    write_json_arrays(rows.where(ev.ts < F.lit("2024-01-10").cast("timestamp_ntz")), f"{base}/events-20240109.json")
    write_json_arrays(rows.where(ev.ts >= F.lit("2024-01-11").cast("timestamp_ntz")), f"{base}/events-20240111.json")
    ranged = read_landing_range(spark, base, ["2024-01-09", "2024-01-10", "2024-01-11"], rows.schema)
    absent = read_landing(spark, base, "2024-01-10", rows.schema, missing="skip")
    return ranged.unionByName(absent.withColumn("run_date", F.lit("2024-01-10").cast("date")))


@query("landing_json_roundtrip", "SELECT * FROM customer")
def landing_json_roundtrip(spark, d):
    """SNK-1: a dated drop of JSON Lines, written and read with its schema."""
    c, base = Tables(spark, d).customer, scratch_path(spark, "landing")
    write_json(c, f"{base}/customer-{RUN_TIME_ID}.json")
    return read_landing(spark, base, RUN_TS[:10], c.schema, multiline=False)


@query("lake_days", """
SELECT event_id, user_id, CAST(ts AS DATE) AS run_date FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'
""")
def lake_days(spark, d):
    """SNK-2, SRC-3: the whole table into run-date partitions, a range of days read back."""
    base = scratch_path(spark, "lake")
    write_run_date(Tables(spark, d).events.withColumn("run_date", F.to_date("ts")), base, "events")
    return read_lake(spark, base, "events", ("2024-01-10", "2024-01-12")).select("event_id", "user_id", "run_date")


_STORED_CANDLES = """
SELECT user_id AS company_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS time_id, count(*) AS num_of_trades FROM events GROUP BY 1, 2
"""


def _append_candles(spark, d) -> str:
    base = scratch_path(spark, "warehouse")
    rows = Tables(spark, d).events.groupBy(F.col("user_id").alias("company_id"), time_id("ts").alias("time_id")).agg(F.count(F.lit(1)).alias("num_of_trades"))
    cols = ["company_id", "num_of_trades", "time_id"]
    for part in (rows.where("company_id % 2 = 0"), rows.where("company_id % 2 <> 0")):  # two appends hold the whole table
        append_rows(part, f"{base}/fact_candles", cols, partition_by="time_id")
    return base


@query("append_read_back", _STORED_CANDLES)
def append_read_back(spark, d):
    """SNK-4, SRC-5: two appends into a day-partitioned table, read back by name."""
    return read_table(spark, _append_candles(spark, d), "fact_candles").select("company_id", "time_id", "num_of_trades")


@query("read_table_time", f"SELECT * FROM ({_STORED_CANDLES}) WHERE time_id = 20240115")
def read_table_time(spark, d):
    """QRY-17: one day of a warehouse table (its partition alone is read)."""
    return read_table(spark, _append_candles(spark, d), "fact_candles", time_id="20240115").select("company_id", "time_id", "num_of_trades")


@query("dq_profile", """
SELECT 'not_null' AS "check", 'o_orderstatus' AS column_name,
       count(*) FILTER (WHERE nullif(o_orderstatus, 'P') IS NULL) AS violations FROM orders
UNION ALL
SELECT 'not_null', 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM orders
UNION ALL
SELECT 'length<=8', 'o_orderpriority', count(*) FILTER (WHERE length(o_orderpriority) > 8)
FROM orders
""")
def dq_profile(spark, d):
    o = Tables(spark, d).orders
    rows = o.select(F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
                    "o_orderpriority")
    return op.profile(rows, not_null=["o_orderstatus", "o_orderpriority"],
                      limits={"o_orderpriority": 8})


@query("dq_not_null", """
SELECT o_orderkey, 'null: o_orderstatus' AS reason FROM orders WHERE o_orderstatus = 'P'
""")
def dq_not_null(spark, d):
    o = Tables(spark, d).orders
    rows = o.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
                    "o_orderpriority")
    return op.check_not_null(rows, ["o_orderstatus", "o_orderpriority"]).select("o_orderkey",
                                                                                 "reason")


@query("dq_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1
""")
def dq_unique(spark, d):
    return op.check_unique(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_fk", """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = o_custkey)
""")
def dq_fk(spark, d):
    t = Tables(spark, d)
    return op.check_fk(t.orders, t.supplier, {"o_custkey": "s_suppkey"}).select("o_orderkey", "o_custkey")


@query("dq_length", """
SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10
""")
def dq_length(spark, d):
    return op.check_length(Tables(spark, d).part, {"p_name": 10}).select("p_partkey", "p_name")


@query("heavy_keys", """
SELECT l_suppkey, count(*) AS "rows" FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1
HAVING count(*) >= CAST(0.01 AS DOUBLE) * (SELECT count(*) FROM lineitem WHERE l_suppkey IS NOT NULL)
""")
def heavy_keys(spark, d):
    """Tickers with a hundredth of all mentions or more, and how many they have."""
    return op.heavy_keys(Tables(spark, d).lineitem, ["l_suppkey"])


@query("hot_key_join", """
SELECT l_suppkey AS ticker, s_name AS name, count(*) AS mentions, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON s_suppkey = l_suppkey GROUP BY 1, 2
""")
def hot_key_join(spark, d):
    """JON-2/7, KEY-3: mentions with their companies; hot tickers' rows never move for the join."""
    t = Tables(spark, d)
    companies = t.supplier.where("s_acctbal >= 0").select(F.col("s_suppkey").alias("ticker"), F.col("s_name").alias("name"))
    mentions = t.lineitem.select(F.col("l_suppkey").alias("ticker"), F.col("l_quantity").cast("long").alias("quantity"))
    return (op.split_join(mentions, companies, ["ticker"], "left").groupBy("ticker", "name")
            .agg(F.count(F.lit(1)).alias("mentions"), F.sum("quantity").alias("quantity")))


_DQ_MONTH = "1997-03"


@query("dq_days", f"""
WITH latest AS (SELECT o_custkey AS ticker, o_orderkey AS company_id, o_orderstatus AS status FROM {_latest_orders_sql()}),
     f AS (SELECT o.o_orderkey AS new_id, company_id, status, o.o_orderstatus
           FROM lineitem JOIN latest ON l_suppkey = ticker JOIN orders o ON l_orderkey = o.o_orderkey
           WHERE strftime(o.o_orderdate, '%Y-%m') = '{_DQ_MONTH}')
SELECT 'fact_news_companies' AS "table", 'unique' AS "check", 'id' AS column_name,
       (SELECT count(*) FROM (SELECT 1 FROM f GROUP BY new_id, company_id HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'fact_news_companies', 'fk->dim_news', 'new_id', (SELECT count(*) FROM f WHERE o_orderstatus = 'P')
UNION ALL SELECT 'fact_news_companies', 'fk->dim_companies', 'company_id', (SELECT count(*) FROM f WHERE status = 'F')
UNION ALL SELECT 'dim_news', 'unique', 'id', 0
UNION ALL SELECT 'dim_companies', 'unique', 'id', 0
""")
def dq_days(spark, d):
    """DQ-2, DQ-3 over the partitions of one month: mentions not deduplicated, some without their article or company."""
    from .jobs import warehouse_quality
    t = Tables(spark, d)
    news = materialise(_order_news(t, t.lineitem).drop("returned_topics", "returned_mentions"), "dq-articles")
    companies = company_versions(t).withColumn("ticker", F.col("ticker").cast("string"))
    stored = dims.news_rows(news, RUN_TS[:10])
    links = facts.company_links(news, companies, stored)
    ids = links.withColumn("id", day_hash_id(["new_id", "company_id"], F.col("published_day")))
    wh = {"fact_news_companies": materialise(ids, "dq-days"), "dim_companies": companies.where("NOT is_delisted"),
          "dim_news": stored.where("summary <> 'P'").select("id", "published_day")}
    wh = {n: df.select("*", *[F.lit("").alias(c) for c in WAREHOUSE_DDL[n].names if c not in df.columns]) for n, df in wh.items()}
    days = [int(f"{_DQ_MONTH.replace('-', '')}{i:02d}") for i in range(1, 32)]
    report = warehouse_quality(wh, days)
    return report.where("check = 'unique' OR check LIKE 'fk->%'")


@query("export_manifest", " UNION ALL ".join(
    f"SELECT '{n}' AS name, count(*) AS \"rows\", 'ok' AS status FROM {n}" for n in DRIVER_TABLES))
def export_manifest(spark, d):
    t = Tables(spark, d)
    out = scratch_path(spark, "export")
    return export_tables(spark, {n: getattr(t, n) for n in DRIVER_TABLES}, out, fmt="json")


@query("backfill_range", """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS run_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01')
WHERE rn = 1
""")
def backfill_range(spark, d):
    from .jobs import first_occurrence
    o = Tables(spark, d).orders.withColumn("run_date", F.to_date("o_orderdate"))
    rows = first_occurrence(o, ["o_custkey"], ("1996-01-01", "1996-12-31"),
                            tie_break=["o_orderkey"])
    return rows.select("o_custkey", "o_orderkey", "run_date")


_LANDED = """
WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 997 = 7 THEN 0 WHEN o_orderkey % 50 = 3 THEN 1 ELSE 2 + o_orderkey % 4 END AS first_day FROM orders),
     landed AS (SELECT o_orderkey, o_custkey, first_day AS day FROM o UNION ALL
                SELECT o_orderkey, o_custkey, first_day + 1 FROM o WHERE o_orderkey % 7 = 0),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY o_orderkey) AS rn, count(*) OVER (PARTITION BY day) AS n FROM landed),
     kept AS (SELECT o_orderkey, o_custkey, min(day) AS day FROM ranked
              WHERE n < 200 OR day <> 3 OR o_orderkey % 2 = 0 OR rn <= 200 GROUP BY 1, 2)
"""
BACKFILL_CAP = 200


def _land_responses(t: Tables, base: str) -> None:
    """Six run dates of raw capped news responses (orders as articles; some come again a day later) and of bars.

    A full-day request returns BACKFILL_CAP articles at most, the halves all of theirs; of the fourth day the second half
    never landed.  A file holds up to about a thousand articles, so files grow in number, not in size."""
    day = F.expr("CASE WHEN o_orderkey % 997 = 7 THEN 0 WHEN o_orderkey % 50 = 3 THEN 1 ELSE 2 + o_orderkey % 4 END")
    o = t.orders.select("o_orderkey", "o_custkey", day.alias("day"))
    landed = o.unionByName(o.where("o_orderkey % 7 = 0").withColumn("day", F.col("day") + 1))
    token = lambda c: F.date_format(F.date_add(F.lit("2025-07-10").cast("date"), F.col(c).cast("int")), "yyyyMMdd")
    key = F.col("o_orderkey").cast("string")
    topic = F.struct(F.concat(F.lit("topic "), F.col("o_orderkey") % 5).alias("topic"), F.lit("0.5").alias("relevance_score"))
    mention = F.struct(F.concat(F.lit("T"), F.col("o_custkey")).alias("ticker"), F.lit("0.25").alias("relevance_score"),
                       F.lit("-0.5").alias("ticker_sentiment_score"), F.lit("Bearish").alias("ticker_sentiment_label"))
    article = F.struct(F.concat(F.lit("order "), key).alias("title"), key.alias("url"),
                       F.concat(F.lit("202507"), F.lpad((F.lit(1) + F.col("o_orderkey") % 9).cast("string"), 2, "0"), F.lit("T101500")).alias("time_published"),
                       F.array(F.lit("a")).alias("authors"), F.lit("s").alias("summary"), F.lit("orders").alias("source"),
                       F.lit(0.5).alias("overall_sentiment_score"), F.lit("Neutral").alias("overall_sentiment_label"),
                       F.array(topic).alias("topics"), F.array(mention).alias("ticker_sentiment"))
    rows = landed.select("day", "o_orderkey", article.alias("article"))
    rank = F.row_number().over(Window.partitionBy("day").orderBy("o_orderkey"))  # keeps BACKFILL_CAP rows a partition
    full = rows.withColumn("rn", rank).where(F.col("rn") <= BACKFILL_CAP).drop("rn").withColumn("zone", F.lit(1))
    halves = rows.withColumn("zone", F.lit(2) + (F.col("o_orderkey") % 2).cast("int")).where("NOT (day = 3 AND zone = 3)")
    count = max(1, t.orders.count() // 8000)
    files = full.withColumn("part", F.lit(0)).unionByName(halves.withColumn("part", F.pmod(F.xxhash64("o_orderkey"), F.lit(count)).cast("int")))
    body = F.to_json(F.struct(F.collect_list("article").alias("feed")))
    bodies = files.groupBy("day", "zone", "part").agg(body.alias("value"))
    name = F.format_string("n%d-%d-%s.json", "part", "zone", token("day"))
    bodies.select("value", name.alias("drop")).write.partitionBy("drop").text(f"{base}/news")
    ms = lambda c: F.unix_millis(F.date_add(F.lit("2025-07-10").cast("date"), F.col(c).cast("int")).cast("timestamp"))
    c = t.customer.select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("day"))
    bar = F.struct(F.concat(F.lit("T"), F.col("c_custkey")).alias("T"), F.lit(7.0).alias("v"), F.when(F.col("c_custkey") % 10 > 0, 1.5).alias("vw"), F.lit(1.0).alias("o"), F.lit(2.0).alias("c"),
                   F.lit(2.0).alias("h"), F.lit(1.0).alias("l"), ms("day").alias("t"), F.col("c_custkey").cast("long").alias("n"))
    bars = c.select("day", F.pmod(F.xxhash64("c_custkey"), F.lit(max(1, t.customer.count() // 500))).alias("part"), bar.alias("bar"))
    bars = bars.groupBy("day", "part").agg(F.to_json(F.struct(F.collect_list("bar").alias("results"))).alias("value"))
    bars.select("value", F.format_string("b%d-%s.json", "part", token("day")).alias("drop")).write.partitionBy("drop").text(f"{base}/ohlcs")


def _store_reference(t: Tables, root: str) -> None:
    """Reference snapshots of which the customers are the companies."""
    spark = t.spark
    stamp = F.lit(RUN_TS).cast("timestamp_ntz").alias("updated_time")
    one = spark.range(1)
    tables = {
        "regions": one.select(F.lit(1).cast("long").alias("id"), F.lit("R").alias("region")),
        "exchanges": one.select(F.lit(1).cast("long").alias("id"), F.lit(1).cast("long").alias("region_id"), F.lit("X").alias("name")),
        "industries": one.select(F.lit(1).cast("long").alias("id"), F.lit("I").alias("industry"), F.lit("S").alias("sector")),
        "sic_industries": one.select(F.lit(1).cast("long").alias("id"), F.lit("SI").alias("sic_industry"), F.lit("SS").alias("sic_sector")),
        "companies": t.customer.select(F.col("c_custkey").cast("long").alias("id"), *[F.lit(1).cast("long").alias(f"{x}_id") for x in ("exchange", "industry", "sic")],
                                       F.col("c_name").alias("name"), F.concat(F.lit("T"), F.col("c_custkey")).alias("ticker"), F.lit(False).alias("is_delisted"),
                                       F.lit("CS").alias("category"), F.lit("USD").alias("currency"), F.lit("NY").alias("location"), stamp),
    }
    write_snapshots(spark, tables, root)


@query("run_backfill_tables", _LANDED + """
SELECT 'dim_news' AS "table", day, count(*) AS "rows", CAST(sum(o_orderkey) AS BIGINT) AS keys FROM kept GROUP BY 2
UNION ALL SELECT 'fact_news_topics', day, count(*), CAST(sum(o_orderkey) AS BIGINT) FROM kept GROUP BY 2
UNION ALL SELECT 'fact_news_companies', day, count(*), CAST(sum(o_orderkey) AS BIGINT) FROM kept JOIN customer ON o_custkey = c_custkey GROUP BY 2
UNION ALL SELECT 'fact_candles', day, count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer, (VALUES (0), (1)) d(day) WHERE c_custkey % 10 > 0 GROUP BY 2
UNION ALL SELECT 'dim_time', day, 1, 0 FROM range(0, 7) d(day)
UNION ALL SELECT 'news_incomplete', day, 1, 0 FROM ranked GROUP BY day HAVING max(n) >= 200 AND (day = 3 OR count(DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END) < 2
  OR greatest(count(*) FILTER (o_orderkey % 2 = 0), count(*) FILTER (o_orderkey % 2 = 1)) >= 200)
""")
def run_backfill_tables(spark, d):
    """BKF-1, flow B: ``run_backfill`` itself over landed capped responses of seven run dates, then what it stored per run date."""
    from .jobs import run_backfill
    t, base = Tables(spark, d), scratch_path(spark, "backfill")
    _land_responses(t, f"{base}/landing")
    _store_reference(t, f"{base}/ref")
    run_backfill(spark, f"{base}/landing", f"{base}/ref", f"{base}/wh", "2025-07-10", "2025-07-16", news_cap=BACKFILL_CAP)
    wh = {n: read_table(spark, f"{base}/wh", n) for n in ("dim_news", "dim_time", "fact_candles", "fact_news_topics", "fact_news_companies", "dim_companies")}
    day = lambda c: (F.col(c) - 20250710).cast("long")
    news = wh["dim_news"].select(F.col("id").alias("new_id"), "published_day", F.col("url").cast("long").alias("key"), day("time_id").alias("day"))
    companies = wh["dim_companies"].select(F.col("id").alias("company_id"), F.substring("ticker", 2, 20).cast("long").alias("key"))
    found = {
        "dim_news": news.select("day", "key"),
        "fact_news_topics": wh["fact_news_topics"].join(news, ["new_id", "published_day"]).select("day", "key"),
        "fact_news_companies": wh["fact_news_companies"].join(news, ["new_id", "published_day"]).select("day", "key"),
        "fact_candles": wh["fact_candles"].select("company_id", day("time_id").alias("day")).join(companies, "company_id").select("day", "key"),
        "dim_time": wh["dim_time"].select(day("id").alias("day"), F.lit(0).cast("long").alias("key")),
        "news_incomplete": read_published(spark, f"{base}/wh", "_lake/news_incomplete", T.StructType([T.StructField("run_date", T.DateType()), T.StructField("reason", T.StringType())]))
        .select(day_number("run_date").alias("day"), F.lit(0).cast("long").alias("key")),
    }
    parts = [rows.groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.sum("key").alias("keys")).select(F.lit(n).alias("table"), "day", "rows", "keys") for n, rows in found.items()]
    return reduce(DataFrame.unionByName, parts)


def day_number(c: str) -> F.Column:
    return F.datediff(F.col(c), F.lit("2025-07-10")).cast("long")


@query("hash_id_collisions", """
SELECT count(*) AS "rows", count(*) AS ids, count(*) AS found, CAST(0 AS BIGINT) AS changed FROM orders
""")
def hash_id_collisions(spark, d):
    """KEY-1 with a hash so narrow that ids meet, in two loads: ids are unique, found again from the key, and stable over a re-run."""
    o = Tables(spark, d).orders
    bits = max(4, o.count()).bit_length() + 1
    rows = o.select("o_orderkey", (F.year("o_orderdate") * 10000 + 101).cast("int").alias("day"), "o_orderstatus", F.lit(None).cast("long").alias("id"))
    cols = ["o_orderkey", "day", "id"]
    empty = spark.createDataFrame([], "o_orderkey long, day int, id long")
    done, maps = empty, spark.createDataFrame([], op.ID_MAP)
    for part in (rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus <> 'F'")):
        new, moved = op.settle_ids(part.select(*cols), done, ["o_orderkey"], "day", "orders", bits)
        done = materialise(done.unionByName(new.select(*cols)), "settled")
        maps = maps if moved is None else materialise(maps.unionByName(moved), "id-map")
    again, _ = op.settle_ids(rows.where("o_orderstatus = 'F'").select(*cols), empty, ["o_orderkey"], "day", "orders", bits)
    looked = op.mapped_ids(rows.select("o_orderkey", "day"), ["o_orderkey"], "day", "orders", "looked_up", maps, bits)
    both = done.join(looked, ["o_orderkey", "day"]).join(again.select("o_orderkey", F.col("id").alias("again")), "o_orderkey", "left")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.count_if(F.col("id") == F.col("looked_up")).alias("found"),
                    F.count_if(F.col("again") != F.col("id")).alias("changed"))


@query("stream_late_rows", """
WITH e AS (SELECT event_id, user_id, ts FROM events), m AS (SELECT max(ts) AS newest FROM e),
     again AS (SELECT 10000000000 + event_id AS event_id, user_id, ts FROM e, m WHERE ts < TIMESTAMP '2024-01-05' OR ts >= newest - INTERVAL 2 DAY)
SELECT event_id, user_id, false AS late FROM e
UNION ALL SELECT event_id, user_id, ts < newest - INTERVAL 7 DAY FROM again, m
""")
def stream_late_rows(spark, d):
    """STR-1: three drops one after the other (the second overlaps the first, the third holds late rows), each twice offered to the stream."""
    ev = Tables(spark, d).events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    base = scratch_path(spark, "stream")
    newest = ev.agg(F.max("ts")).first()[0]
    at = lambda x: F.lit(x).cast("timestamp")
    third = ev.where((F.col("ts") < at("2024-01-05")) | (F.col("ts") >= at(newest) - F.expr("INTERVAL 2 DAYS"))).withColumn("event_id", F.col("event_id") + 10_000_000_000)
    for i, drop in enumerate((ev.where(F.col("ts") < at("2024-01-20")), ev.where(F.col("ts") >= at("2024-01-10")), third)):
        drop.write.parquet(f"{base}/landing/drop={i}")
        for _ in range(2):  # the second run finds nothing new
            run_increment_load(spark, f"{base}/landing/*", ev.schema, f"{base}/wh", "stream_events", ["event_id"], "ts", "7 DAYS", f"{base}/_checkpoint")
    schema = T.StructType([*ev.schema.fields, T.StructField("time_id", T.IntegerType())])
    late = read_published(spark, f"{base}/wh", "stream_events_late", schema.add("batch_id", T.LongType()))
    kept = read_published(spark, f"{base}/wh", "stream_events", T.StructType(schema.fields[:4]))
    return kept.select("event_id", "user_id", F.lit(False).alias("late")).unionByName(late.select("event_id", "user_id", F.lit(True).alias("late")))


@query("stream_increment", """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05'
""")
def stream_increment(spark, d):
    # a watermark needs an instant; the session's zone is UTC, so the cast keeps the wall-clock time
    ev = Tables(spark, d).events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    base = scratch_path(spark, "stream")
    landing, out, ckpt = f"{base}/landing", f"{base}/out", f"{base}/_checkpoint"
    # two overlapping drops land in the same directory
    ev.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp")) \
        .write.mode("overwrite").parquet(f"{landing}/drop=1")
    ev.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp")) \
        .write.mode("overwrite").parquet(f"{landing}/drop=2")
    target = ev.where(F.col("ts") < F.lit("2024-01-05").cast("timestamp"))
    # the watermark bounds the state; both drops lie within its delay
    run_increment(spark, f"{landing}/*", ev.schema, target, ["event_id"], out, ckpt, watermark=("ts", "60 days"))
    return spark.read.schema(ev.schema).parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# ---------------------------------------------------------------------------
# LOD-1: the monthly reference load on drops derived from the driver tables
# ---------------------------------------------------------------------------

def _reference_drops(t: Tables):
    """markets / companies drops in the vendor shapes, from nation, region
    and customer (venue = nation, region = region, sector = region,
    industry = market segment, SIC code = nation key)."""
    n, r, c = t.nation, t.region, t.customer
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    markets = geo.select(F.lit("Equity").alias("market_type"), F.col("r_name").alias("region"),
                         F.col("n_name").alias("primary_exchanges"),
                         F.lit("09:30").alias("local_open"), F.lit("16:00").alias("local_close"),
                         F.lit("open").alias("current_status"), F.lit("").alias("notes"))
    companies = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey).select(
        F.col("c_name").alias("name"),
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
        (F.col("c_acctbal") < 0).alias("isDelisted"), F.lit("CS").alias("category"),
        F.lit("USD").alias("currency"), F.col("n_name").alias("location"),
        F.col("c_mktsegment").alias("industry"), F.col("r_name").alias("sector"),
        F.col("n_name").alias("exchange"), F.col("c_nationkey").cast("string").alias("sic"),
        F.col("c_mktsegment").alias("sicIndustry"), F.col("n_name").alias("sicSector"))
    return markets, companies


def _reference_tables(spark, d):
    from .jobs import REF_SCHEMAS, reference_load
    markets, companies_raw = _reference_drops(Tables(spark, d))
    normalised = normalize.normalise_all(markets, companies_raw, kept_exchanges=None)
    current = {n: spark.createDataFrame([], ddl) for n, ddl in REF_SCHEMAS.items()}
    return reference_load(current, normalised, RUN_TS)


_REF_SQL = f"""
WITH geo AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
     co AS (SELECT c_name AS name, 'T' || CAST(c_custkey AS VARCHAR) AS ticker,
                   c_acctbal < 0 AS is_delisted, n_name, r_name, c_mktsegment
            FROM customer JOIN geo ON c_nationkey = n_nationkey),
     ex AS (SELECT n_name, row_number() OVER (ORDER BY n_name) AS exchange_id
            FROM (SELECT DISTINCT n_name FROM geo)),
     ind AS (SELECT c_mktsegment, r_name, row_number() OVER (ORDER BY c_mktsegment, r_name)
                    AS industry_id FROM (SELECT DISTINCT c_mktsegment, r_name FROM co)),
     sic AS (SELECT c_mktsegment, n_name, row_number() OVER (ORDER BY c_mktsegment, n_name)
                    AS sic_id FROM (SELECT DISTINCT c_mktsegment, n_name FROM co)),
     j AS (SELECT co.*, exchange_id, industry_id, sic_id FROM co
           JOIN ex USING (n_name) JOIN ind USING (c_mktsegment, r_name)
           JOIN sic USING (c_mktsegment, n_name))
SELECT row_number() OVER (ORDER BY ticker, is_delisted) AS id, exchange_id, industry_id, sic_id,
       name, ticker, is_delisted, 'CS' AS category, 'USD' AS currency, n_name AS location,
       md5(to_json({{'category': 'CS', 'currency': 'USD', 'exchange_id': exchange_id,
                    'industry_id': industry_id, 'location': n_name, 'name': name,
                    'sic_id': sic_id}})) AS hash_row,
       TIMESTAMP '{RUN_TS}' AS updated_time, 'inserted' AS action
FROM j
"""


@query("reference_load", _REF_SQL)
def reference_load_q(spark, d):
    tables, _, _ = _reference_tables(spark, d)
    return tables["companies"].select(
        "id", "exchange_id", "industry_id", "sic_id", "name", "ticker", "is_delisted",
        "category", "currency", "location", "hash_row", "updated_time", "action")


@query("reference_load_report", """
WITH geo AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
     co AS (SELECT * FROM customer JOIN geo ON c_nationkey = n_nationkey)
SELECT 'regions' AS "table", 'inserted' AS action, count(DISTINCT r_name) AS "rows" FROM geo
UNION ALL SELECT 'exchanges', 'inserted', count(DISTINCT n_name) FROM geo
UNION ALL SELECT 'industries', 'inserted',
                 count(*) FROM (SELECT DISTINCT c_mktsegment, r_name FROM co)
UNION ALL SELECT 'sic_industries', 'inserted',
                 count(*) FROM (SELECT DISTINCT c_mktsegment, n_name FROM co)
UNION ALL SELECT 'companies', 'inserted', count(*) FROM co
""")
def reference_load_report(spark, d):
    _, _, report = _reference_tables(spark, d)
    return report


@query("company_extract", f"""
WITH geo AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT c_name AS name, 'T' || CAST(c_custkey AS VARCHAR) AS ticker, c_acctbal < 0 AS is_delisted,
       'CS' AS category, 'USD' AS currency, n_name AS location, n_name AS exchange,
       r_name AS region, c_mktsegment AS industry, r_name AS sector,
       c_mktsegment AS sic_industry, n_name AS sic_sector, TIMESTAMP '{RUN_TS}' AS updated_time
FROM customer JOIN geo ON c_nationkey = n_nationkey
""")
def company_extract_q(spark, d):
    """DIM-1 over the loaded reference snapshot: the companies changed on
    the run day, denormalised through four left joins."""
    tables, _, _ = _reference_tables(spark, d)
    return dims.company_extract(tables["companies"], tables["exchanges"], tables["regions"],
                                tables["industries"], tables["sic_industries"],
                                as_of=RUN_TS[:10])


@query("reference_load_second_run", """
WITH co AS (SELECT 'T' || CAST(c_custkey AS VARCHAR) AS ticker, c_acctbal < 0 AS is_delisted, n_name, c_mktsegment
            FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT ticker, is_delisted, CASE WHEN c_mktsegment = 'BUILDING' THEN n_name || ' B' ELSE n_name END AS location,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'updated' WHEN 'MACHINERY' THEN 'kept' ELSE 'unchanged' END AS action
FROM co
UNION ALL
SELECT 'S' || CAST(s_suppkey AS VARCHAR), false, n_name, 'inserted' FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def reference_load_second_run(spark, d):
    """LOD-1 on loaded tables: changed, unchanged, new and missing companies, changed ones twice."""
    from .jobs import reference_load
    t = Tables(spark, d)
    markets, companies = _reference_drops(t)
    current = {n: df.drop("action") for n, df in _reference_tables(spark, d)[0].items()}
    building = companies.where("industry = 'BUILDING'")
    n, r, s = t.nation, t.region, t.supplier
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    suppliers = s.join(F.broadcast(geo), s.s_nationkey == geo.n_nationkey).select(
        F.col("s_name").alias("name"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"), F.lit(False).alias("isDelisted"),
        F.lit("CS").alias("category"), F.lit("USD").alias("currency"), F.col("n_name").alias("location"), F.lit("SUPPLY").alias("industry"),
        F.col("r_name").alias("sector"), F.col("n_name").alias("exchange"), F.col("s_nationkey").cast("string").alias("sic"),
        F.lit("SUPPLY").alias("sicIndustry"), F.col("n_name").alias("sicSector"))
    batch = (companies.where("industry NOT IN ('BUILDING', 'MACHINERY')").unionByName(suppliers)
             .unionByName(building.withColumn("location", F.concat("location", F.lit(" B"))))
             .unionByName(building.withColumn("location", F.concat("location", F.lit(" A")))))
    tables, _, _ = reference_load(current, normalize.normalise_all(markets, batch, kept_exchanges=None), "2025-08-10 00:00:00")
    return tables["companies"].select("ticker", "is_delisted", "location", "action")


def entry_query(spark, sf_dir):
    """The flagship query (QRY-9/10): top-10 tickers by traded volume."""
    return topk_volume(spark, sf_dir)
