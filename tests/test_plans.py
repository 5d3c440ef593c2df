"""Plan assertions: the physical plans we rely on for scale."""

import contextlib
import io
import os

import pytest

from tests.conftest import ROOT  # noqa: F401

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")
Q = E.queries()


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_anti_joins_are_hash_joins_not_nested_loops(spark):
    for name in ("insert_new_composite", "insert_new_single", "insert_new_exists", "dim_time",
                 "dq_fk"):
        p = plan(Q[name](spark, SF))
        assert "NestedLoopJoin" not in p, name
        assert "LeftAnti" in p, name
    # FK resolution is one left hash join, split into matched / missed rows
    p = plan(Q["fk_quarantine"](spark, SF))
    assert "BroadcastHashJoin LeftOuter" in p and "NestedLoopJoin" not in p


def test_day_filter_reaches_the_scan(spark):
    p = plan(Q["scan_run_date"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p


def test_latest_per_key_limits_before_the_shuffle(spark):
    p = plan(Q["latest_per_key"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_topk_is_take_ordered(spark):
    p = plan(Q["topk_volume"](spark, SF), mode="simple")
    assert "TakeOrderedAndProject" in p


def test_bounded_dimensions_are_broadcast(spark):
    p = plan(Q["denormalise_chain"](spark, SF))
    assert p.count("BroadcastHashJoin") >= 2


def test_column_pruning(spark):
    p = plan(Q["count_by_source"](spark, SF))
    assert "ReadSchema: struct<source:string>" in p


def test_no_exchange_below_the_first_aggregate(spark):
    """Tables are plain scans: the fact is shuffled as partial sums, never whole."""
    for name in ("topk_volume", "daily_totals", "count_by_hour"):
        p = plan(Q[name](spark, SF), "simple")
        lines = p.splitlines()
        scans = [i for i, line in enumerate(lines) if "FileScan" in line and ("l_quantity" in line or "ts#" in line)]
        first = min(scans)
        below = next(line for line in reversed(lines[:first]) if "HashAggregate" in line or "Exchange" in line)
        assert "partial_" in below, (name, below)


def test_day_filter_reaches_the_scan(spark):
    p = plan(Q["read_by_time"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p


def test_bridges_read_only_the_days_of_the_batch(spark, tmp_dir):
    """dim_news is pruned to the publication days of the batch."""
    from marketlake import schemas
    from marketlake.plans import dims, facts
    news = spark.createDataFrame([("t", "u", "20250710T101500", None, None, None, None, None, [("a", "0.5")], [])], schemas.NEWS_RAW)
    dims.news_rows(news, "2025-07-10").write.partitionBy("published_day").parquet(f"{tmp_dir}/n")
    news.write.parquet(f"{tmp_dir}/batch")
    stored = spark.read.parquet(f"{tmp_dir}/n")
    topics = spark.createDataFrame([(1, "a")], "id long, name string")
    fact = spark.createDataFrame([], "new_id long, topic_id long, published_day int")
    rows = facts.new_topic_links(fact, spark.read.schema(schemas.NEWS_RAW).parquet(f"{tmp_dir}/batch").where("url is not null"), topics, stored)
    assert "dynamicpruningexpression(published_day" in plan(rows)
    assert rows.count() == 1


def test_insert_new_reads_only_touched_partitions(spark, tmp_dir):
    """A day-partitioned target is pruned at run time to the days of a batch
    read from the lake (dynamic partition pruning through the broadcast
    semi join of ``prune_on``)."""
    from pyspark.sql import functions as F
    from marketlake import operators as op
    spark.range(0, 3000).select((F.col("id") % 1000).alias("k"),
                                (F.lit(20250701) + F.col("id") / 1000).cast("int").alias("day")) \
        .write.partitionBy("day").parquet(f"{tmp_dir}/t")
    spark.createDataFrame([(1, 20250702, "2025-07-10"), (5000, 20250702, "2025-07-10"),
                           (7, 20250703, "2025-07-09")], "k long, day int, run_date string") \
        .write.partitionBy("run_date").parquet(f"{tmp_dir}/lake")
    target = spark.read.parquet(f"{tmp_dir}/t")
    batch = spark.read.parquet(f"{tmp_dir}/lake").where(F.col("run_date") == "2025-07-10") \
        .drop("run_date")
    new = op.insert_new(target, batch, ["k", "day"], dedupe_batch=False, prune_on="day")
    assert "dynamicpruningexpression(day" in plan(new)
    assert sorted(tuple(r) for r in new.collect()) == [(5000, 20250702)]


def test_hot_day_is_never_shuffled_by_day(spark):
    """SET-2 on a batch where one day holds most rows: the per-day counts are
    broadcast back, so no exchange partitions the rows by run_date."""
    p = plan(Q["capped_batches"](spark, SF))
    assert "BroadcastHashJoin" in p
    assert "Exchange hashpartitioning(run_date" not in p


def test_counts_combine_before_the_shuffle(spark):
    for name in ("count_by_exchange", "dq_unique", "daily_totals", "mentions_star"):
        p = plan(Q[name](spark, SF), "simple")
        assert "partial_count" in p or "partial_sum" in p, name


def test_mentions_are_counted_before_they_meet_their_company(spark):
    """QRY-15: a hot ticker reaches the company join as one row a day."""
    p = plan(Q["mentions_star"](spark, SF), "simple")
    company = next(i for i, line in enumerate(p.splitlines()) if "FileScan" in line and "s_name" in line)
    below = [line for line in p.splitlines()[:company] if "HashAggregate" in line]
    assert sum("partial_count" in line for line in below) == 1


def test_increments_of_links_join_the_articles_once(spark):
    """the articles are written once; no later step joins or collects their lines again."""
    for name in ("company_links_increment", "topic_links_increment"):
        p = plan(Q[name](spark, SF))
        assert "lineitem" not in p and "collect_list" not in p, name


def test_the_links_of_returned_lines(spark):
    from marketlake.plans import catalog
    day = "timestamp_ntz'1995-03-01 00:00:00'"
    orders = spark.sql(f"SELECT * FROM VALUES (1L, 7L, 'F', 1.0D, {day}, '5-LOW'), (2L, 7L, 'O', 2.0D, {day}, '1-URGENT'), (3L, 8L, 'P', 3.0D, {day}, '1-URGENT') "
                       "AS t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)")
    lines = spark.sql("SELECT * FROM VALUES (1L, 5L, 6L, 9.0D, 0.1D, 0.0D, 'R'), (1L, 5L, 6L, 4.0D, 0.1D, 0.2D, 'N'), (2L, 5L, NULL, 1.0D, 0.0D, 0.0D, NULL) "
                      "AS t(l_orderkey, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag)")
    t = type("T", (), {"orders": orders, "lineitem": lines})()
    news, returned, stored = catalog._written_news(t, "ticker_sentiment", "returned_mentions")
    pick = lambda df: {r["url"][6:]: r["m"] for r in df.selectExpr("url", "transform(ticker_sentiment, m -> m.relevance_score || m.ticker_sentiment_label) AS m").collect()}
    assert {k: v and sorted(v) for k, v in pick(news).items()} == {"1": ["4.0Bearish", "9.0Bullish"], "2": ["1.0Neutral"], "3": None}
    assert {k: v or [] for k, v in pick(returned).items()} == {"1": ["9.0Bullish"], "2": [], "3": []}
    assert stored.count() == 3 and stored.columns == ["published_day", "id"] and "topics" not in news.columns
