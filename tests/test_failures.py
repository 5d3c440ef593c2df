"""Bad input and broken runs: nothing passes for an empty day, nothing is overwritten,
nothing depends on the order of rows."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from marketlake import operators as op
from marketlake import schemas
from marketlake.plans import dims, facts, jobs
from marketlake.sinks import (current_version, read_snapshot, versions, write_run_date, write_snapshot,
                              write_snapshots)
from marketlake.sources import MissingRunDate, read_bars, read_lake, read_landing, unwrap_envelope
from tests.conftest import rows
from tests.test_jobs import COMPANIES, MARKETS, company, land, landing, news_item  # noqa: F401

BAR = {"T": "AAA", "v": 10, "vw": 1.0, "o": 1, "c": 1, "h": 1, "l": 1, "t": 1752105600000, "n": 1}


def _cut(base, prefix, token, payload):
    land(base, prefix, token, payload)
    path = os.path.join(base, prefix, f"crawl_{prefix}-{token}.json")
    text = open(path).read()
    open(path, "w").write(text[:len(text) // 2])


@pytest.mark.parametrize("payload", [[BAR, BAR], {"results": [BAR, BAR]}])
def test_truncated_bars_fail_the_read(spark, tmp_dir, payload):
    _cut(tmp_dir, "ohlcs", "20250710", payload)
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        read_bars(spark, f"{tmp_dir}/ohlcs", "2025-07-10").collect()


def test_empty_bars_file_fails_the_read(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/ohlcs")
    open(f"{tmp_dir}/ohlcs/x-20250710.json", "w").write("  \n")
    with pytest.raises(Exception, match="empty response body"):
        read_bars(spark, f"{tmp_dir}/ohlcs", "2025-07-10").collect()


def test_truncated_news_fail_the_read(spark, tmp_dir):
    _cut(tmp_dir, "news", "20250710", [news_item("a", "20250710T101500", [], []), news_item("b", "20250710T101500", [], [])])
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        read_landing(spark, f"{tmp_dir}/news", "2025-07-10", schemas.NEWS_RAW).collect()


def test_envelopes(spark):
    from pyspark.sql import types as T
    payload = T.StructType([T.StructField("k", T.LongType())])
    bodies = [(1, '{"feed": [{"k": 1}, {"k": 2}]}'), (2, '{"feed": []}'), (3, '{"other": 1}'), (4, '{"feed": [{"k": 1}'), (5, None), (6, " ")]
    df = spark.createDataFrame(bodies, "id long, body string")
    required = rows(unwrap_envelope(df, "body", "feed", payload), "id", "_envelope_error")
    assert required == [(1, False), (1, False), (3, True), (4, True), (5, True), (6, True)]
    optional = rows(unwrap_envelope(df, "body", "feed", payload, required=False), "id", "_envelope_error")
    assert optional == [(1, False), (1, False), (4, True), (5, True), (6, True)]


def test_missing_run_dates_raise(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.date(2025, 7, 10)), (2, dt.date(2025, 7, 12))], "k long, run_date date")
    write_run_date(df, tmp_dir, "lake")
    assert read_lake(spark, tmp_dir, "lake", "2025-07-12").count() == 1
    for dates in ("2025-07-11", ("2025-07-10", "2025-07-12"), ["2025-07-10", "2025-07-13"]):
        with pytest.raises(MissingRunDate):
            read_lake(spark, tmp_dir, "lake", dates)
    with pytest.raises(MissingRunDate):
        read_lake(spark, tmp_dir, "nowhere", "2025-07-10")


def test_unreadable_paths_are_not_empty_tables(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/wh/dim_news")
    open(f"{tmp_dir}/wh/dim_news/part-0.parquet", "w").write("not parquet")
    with pytest.raises(Exception):
        jobs.read_warehouse(spark, f"{tmp_dir}/wh", "dim_news").count()
    assert jobs.read_warehouse(spark, f"{tmp_dir}/wh", "dim_time").count() == 0  # never written


def test_an_emptied_day_replaces_its_rows(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.date(2025, 7, 10)), (2, dt.date(2025, 7, 11))], "k long, run_date date")
    write_run_date(df, tmp_dir, "lake", run_dates=["2025-07-10", "2025-07-11"])
    write_run_date(df.where("k = 9"), tmp_dir, "lake", run_dates=["2025-07-10"])
    assert rows(read_lake(spark, tmp_dir, "lake", None), "k") == [(2,)]


def test_a_crash_between_steps_keeps_the_last_commit(spark, tmp_dir):
    one = spark.range(1).withColumn("v", F.lit(1))
    assert write_snapshots(spark, {"a": one, "b": one}, tmp_dir) == {"a": 1, "b": 1}
    one.withColumn("v", F.lit(2)).write.parquet(f"{tmp_dir}/a/v=2")       # a load that died before b
    os.makedirs(f"{tmp_dir}/_commits/2")                                    # ... or while committing
    assert versions(spark, tmp_dir) == {"a": 1, "b": 1}
    assert read_snapshot(spark, tmp_dir, "a").first()["v"] == 1
    assert write_snapshot(spark, one.withColumn("v", F.lit(3)), tmp_dir, "a") == 3  # v=2 is not written over
    assert versions(spark, tmp_dir) == {"a": 3, "b": 1}
    assert spark.read.parquet(f"{tmp_dir}/a/v=2").first()["v"] == 2
    assert current_version(spark, tmp_dir, "c") is None


def test_an_unreadable_commit_is_an_error(spark, tmp_dir):
    write_snapshot(spark, spark.range(1), tmp_dir, "a")
    for f in os.listdir(f"{tmp_dir}/_commits/1"):
        if f.startswith("part-"):
            open(f"{tmp_dir}/_commits/1/{f}", "w").write("{broken\n")
            crc = f"{tmp_dir}/_commits/1/.{f}.crc"
            if os.path.exists(crc):
                os.remove(crc)
    with pytest.raises(Exception):
        read_snapshot(spark, tmp_dir, "a")


def test_published_day_needs_a_whole_time(spark):
    from marketlake.functions import published_day
    times = ["20250710T134500", "20259999T999999", "99999999xx", "20250710", "20250710T1345", None, ""]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    assert [r[0] for r in df.select(published_day("t")).collect()] == [20250710] + [None] * 6


def test_merges_do_not_depend_on_row_order(spark):
    batch = [("X", "a", 1), ("X", "b", 2), ("X", "b", 1), ("Y", None, 3), ("Y", "a", None), (None, "q", 1)]
    target = spark.createDataFrame([("Z", "z", 0, "h", dt.datetime(2025, 1, 1))], "k string, u string, v int, hash_row string, updated_time timestamp_ntz")
    seen = set()
    for seed in range(6):
        random.Random(seed).shuffle(batch)
        df = spark.createDataFrame(batch, "k string, u string, v int").repartition(seed + 1)
        merged = op.upsert(target, df, ["k"], ["u", "v"], order_by=None, run_ts="2025-07-10 00:00:00")
        new = op.insert_new(target.select("k"), df, ["k"])
        seen.add((str(rows(merged, "k", "u", "v", "action")), str(rows(new))))
    assert len(seen) == 1
    assert op.duplicate_count(spark.createDataFrame(batch, "k string, u string, v int"), ["k"]).first()["rows"] == 3


def test_duplicate_keys_in_a_monthly_drop(spark, tmp_dir):
    out = []
    for order in (1, -1):
        base, ref = f"{tmp_dir}/l{order}", f"{tmp_dir}/r{order}"
        land(base, "markets", "20250501", (MARKETS + [dict(MARKETS[0], local_open="08:00")])[::order])
        land(base, "companies", "20250501", (COMPANIES + [company("AAA", name="AAA Two")])[::order])
        _, report = jobs.run_reference_load(spark, base, ref, "2025-05-01", "2025-05-01 00:00:00")
        assert {(r["table"], r["rows"]) for r in report.collect() if r["action"] == "duplicate"} == {("regions", 1), ("companies", 1)}
        out.append((rows(read_snapshot(spark, ref, "regions"), "region", "local_open"), rows(read_snapshot(spark, ref, "companies"), "ticker", "is_delisted", "name")))
        assert os.path.isdir(f"{ref}/_normalised/regions/run_date=2025-05-01")
    assert out[0] == out[1]


def test_volumes_round_and_out_of_range_ones_are_quarantined(spark):
    bars = spark.createDataFrame([("A", 2.5, 1.0), ("A", 3.7, 1.0), ("A", 1e30, 1.0), ("A", None, 1.0)], "ticker string, volume double, volume_weighted double")
    for c in schemas.OHLC.fields:
        if c.name not in bars.columns:
            bars = bars.withColumn(c.name, F.lit(None).cast(c.dataType))
    companies = spark.createDataFrame([(1, "A", dt.datetime(2025, 1, 1))], "id long, ticker string, updated_time timestamp_ntz")
    assert sorted(str(r["volume"]) for r in facts.candle_rows(bars, companies, "2025-07-10").collect()) == ["2", "4", "None"]
    news = spark.createDataFrame([], schemas.NEWS_RAW)
    assert rows(jobs.daily_quarantine(news, bars, companies, "2025-07-10"), "reason") == [("volume out of range",)]


def test_hash_ids_that_meet_are_an_error(spark):
    new = spark.createDataFrame([(20250710, 5), (20250710, 6)], "published_day int, id long")
    jobs.check_hash_ids(new, spark.createDataFrame([(20250711, 5)], "published_day int, id long"), "published_day")
    with pytest.raises(jobs.HashIdCollision):
        jobs.check_hash_ids(new, spark.createDataFrame([(20250710, 6)], "published_day int, id long"), "published_day")


def test_backfill_writes_its_quarantine(spark, landing, tmp_dir):  # noqa: F811
    ref = f"{tmp_dir}/ref"
    jobs.run_reference_load(spark, landing, ref, "2025-05-01", "2025-05-01 00:00:00")
    land(landing, "news", "20250711", [news_item("bad", "20259999T999999", [], [])])
    added = jobs.run_backfill(spark, landing, ref, f"{tmp_dir}/wh", "2025-07-10", "2025-07-12")
    q = spark.read.parquet(f"{tmp_dir}/wh/_quarantine")
    assert added["quarantine"] == q.count() == 3
    assert rows(q, "run_date", "reason") == [(dt.date(2025, 7, 10), "null volume_weighted"), (dt.date(2025, 7, 10), "unknown ticker"),
                                             (dt.date(2025, 7, 11), "unparseable time_published")]


def test_daily_load_of_capped_responses(spark, landing, tmp_dir):  # noqa: F811
    ref, wh = f"{tmp_dir}/ref", f"{tmp_dir}/wh"
    jobs.run_reference_load(spark, landing, ref, "2025-05-01", "2025-05-01 00:00:00")
    item = lambda i: news_item(f"n{i}", "20250712T101500", [], [])
    for zone, body in ((1, {"feed": [item(i) for i in range(3)]}), (2, {"feed": [item(i) for i in range(2)]}), (3, {"feed": [item(2), item(3)]})):
        with open(f"{landing}/news/zone-{zone}-20250712.json", "w") as f:
            json.dump(body, f)
    added = jobs.run_daily_load(spark, landing, ref, wh, "2025-07-12", news_cap=3)
    assert added["dim_news"] == 4                      # the halves, as the full day hit the cap
    assert not os.path.isdir(f"{wh}/_lake/news_incomplete/run_date=2025-07-12")
    open(f"{landing}/news/zone-3-20250712.json", "w").write('{"feed": [{"title"')
    jobs.run_daily_load(spark, landing, ref, wh, "2025-07-12", news_cap=3)
    assert rows(spark.read.parquet(f"{wh}/_lake/news_bad"), "reason") == [("malformed response or no feed",)]
    assert rows(spark.read.parquet(f"{wh}/_lake/news_incomplete"), "reason") == [("full day at the cap, halves missing",)]


def test_no_local_scratch_on_a_cluster():
    from types import SimpleNamespace
    from marketlake.session import ensure_checkpoint_dir
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None)))


def test_news_ties_are_broken_by_content(spark):
    a = news_item("t", "20250710T101500", [], [])
    b = dict(a, summary="zz")
    got = set()
    for pair in ([a, b], [b, a]):
        df = spark.createDataFrame([tuple(x.get(f.name) for f in schemas.NEWS_RAW.fields) for x in pair], schemas.NEWS_RAW).repartition(2)
        stored = spark.createDataFrame([], "title string, url string, time_published string, published_day int")
        got.add(tuple(r["summary"] for r in dims.new_news(stored, df, "2025-07-10").collect()))
    assert got == {("zz",)}
