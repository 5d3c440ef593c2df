"""Loads that become visible at once, and what a crash, a second writer, or a replay leaves behind."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import operators as op
from marketlake import schemas
from marketlake.plans import analytics, jobs
from marketlake.sinks import Load, compact, expire, export_tables, last_commit, published, read_published
from marketlake.sinks.publish import ConcurrentLoad
from marketlake.sources import read_table
from marketlake.streaming import LateRows, apply_batch, run_increment_load
from tests.conftest import rows
from tests.test_jobs import landing, news_item  # noqa: F401

KV = T.StructType([T.StructField("k", T.LongType()), T.StructField("p", T.IntegerType())])
DAYS = T.StructType([T.StructField("k", T.LongType()), T.StructField("run_date", T.DateType())])


def _kv(spark, *ks):
    return spark.createDataFrame([(k, k % 3) for k in ks], KV)


def _days(spark, *pairs):
    return spark.createDataFrame([(k, dt.date(2025, 7, d)) for k, d in pairs], DAYS)


def test_nothing_is_visible_before_the_commit(spark, tmp_dir):
    first = Load(spark, tmp_dir)
    assert first.append("a", _kv(spark, 1, 2), partition_by="p") == 2 and first.append("b", _kv(spark)) == 0
    first.replace("lake", _days(spark, (1, 10), (2, 11)), ["2025-07-10", "2025-07-11"])
    assert rows(first.read("a", KV)) == [(1, 1), (2, 2)] and read_published(spark, tmp_dir, "a", KV).count() == 0
    first.commit()
    broken = Load(spark, tmp_dir)  # dies between two of its writes
    broken.append("a", _kv(spark, 3), partition_by="p")
    broken.replace("lake", _days(spark, (9, 10)), ["2025-07-10", "2025-07-11"])
    os.makedirs(f"{tmp_dir}/_published/2")  # ... or while it commits
    assert last_commit(spark, tmp_dir) == 1
    assert rows(read_published(spark, tmp_dir, "a", KV)) == [(1, 1), (2, 2)]
    assert rows(read_published(spark, tmp_dir, "lake", DAYS), "k") == [(1,), (2,)]
    again = Load(spark, tmp_dir)
    again.append("a", _kv(spark, 4), partition_by="p")
    again.replace("lake", _days(spark, (7, 11)), ["2025-07-10", "2025-07-11"])  # the 10th is empty now
    assert again.commit() == 3
    again.clean()
    assert rows(read_published(spark, tmp_dir, "a", KV)) == [(1, 1), (2, 2), (4, 1)]
    assert rows(read_published(spark, tmp_dir, "lake", DAYS, ["2025-07-11"]), "k") == [(7,)]
    assert read_published(spark, tmp_dir, "lake", DAYS, ["2025-07-10"]).count() == 0
    with pytest.raises(ValueError):
        Load(spark, tmp_dir).replace("lake", _days(spark, (7, 12)), ["2025-07-11"])


def test_second_writer_compaction_and_expiry(spark, tmp_dir):
    one, two = Load(spark, tmp_dir), Load(spark, tmp_dir)
    one.append("a", _kv(spark, 1), partition_by="p")
    two.append("a", _kv(spark, 2), partition_by="p")
    one.commit()
    with pytest.raises(ConcurrentLoad):
        two.commit()
    for k in (5, 6, 7):
        load = Load(spark, tmp_dir)
        load.append("a", _kv(spark, k), partition_by="p")
        load.commit()
    assert compact(spark, tmp_dir, "a", KV, partition_by="p") == 4
    assert len(published(spark, tmp_dir)) == 1 and len(published(spark, tmp_dir, 4)) == 4
    assert expire(spark, tmp_dir, keep=1) == 9  # five loads that were united or never committed, four commits
    assert rows(read_published(spark, tmp_dir, "a", KV), "k") == [(1,), (5,), (6,), (7,)] and expire(spark, tmp_dir, keep=1) == 0


def _zone(base, zone, day, items):
    os.makedirs(f"{base}/news", exist_ok=True)
    json.dump({"feed": items}, open(f"{base}/news/n-{zone}-{day}.json", "w"))


def _same(spark, one, two):
    for name in schemas.WAREHOUSE_TABLES:
        a, b = read_table(spark, one, name), read_table(spark, two, name)
        cols = [c for c in a.columns if c != "authors"]
        assert rows(a, *cols) == rows(b, *cols), name


def test_backfill_of_capped_responses_equals_daily_loads_and_resumes(spark, landing, tmp_dir, monkeypatch):  # noqa: F811
    os.remove(f"{landing}/news/crawl_news-20250710.json")
    item = lambda i, t: news_item(f"n{i}", "20250710T101500", [{"topic": t, "relevance_score": "0.5"}],
                                  [{"ticker": "AAA", "relevance_score": "0.8", "ticker_sentiment_score": "-0.3", "ticker_sentiment_label": "Bearish"}])
    for day, (full, am, pm) in {"20250710": ((0, 1), (0,), (1,)), "20250711": ((1, 2, 3), (1, 2), (3, 4)), "20250712": ((5, 6, 0), (5, 6), None)}.items():
        for zone, ids in ((1, full), (2, am), (3, pm)):
            if ids is not None:
                _zone(landing, zone, day, [item(i, f"t{i % 4}") for i in ids])
    ref = f"{tmp_dir}/ref"
    jobs.run_reference_load(spark, landing, ref, "2025-05-01", "2025-05-01 00:00:00")
    daily, ranged = f"{tmp_dir}/daily", f"{tmp_dir}/ranged"
    for day in ("2025-07-10", "2025-07-11", "2025-07-12"):
        jobs.run_daily_load(spark, landing, ref, daily, day, news_cap=3)
    assert read_table(spark, daily, "dim_news").count() == 7
    with pytest.raises(Exception, match="(?i)malformed"):  # without the cap a raw response is no array of articles
        jobs.run_backfill(spark, landing, ref, f"{tmp_dir}/none", "2025-07-10", "2025-07-12")

    # a backfill that dies in its second chunk: the first one is there, the second not at all; the next call goes on
    chunk, done = jobs._backfill_chunk, []

    def dying(load, landing, ref, days, *rest):
        out = chunk(load, landing, ref, days, *rest)
        if len(done) == 1:
            done.append("died")
            raise RuntimeError("lost")
        done.append(days)
        return out

    monkeypatch.setattr(jobs, "_backfill_chunk", dying)
    args = (spark, landing, ref, ranged, "2025-07-10", "2025-07-12")
    with pytest.raises(RuntimeError):
        jobs.run_backfill(*args, news_cap=3, chunk_days=2)
    assert read_table(spark, ranged, "dim_news").count() == 5 and read_table(spark, ranged, "dim_time").count() == 2
    jobs.run_backfill(*args, news_cap=3, chunk_days=2)
    assert done == [["2025-07-10", "2025-07-11"], "died", ["2025-07-12"]]
    _same(spark, daily, ranged)


def test_ids_that_meet_are_settled(spark):
    new = spark.createDataFrame([(i, 20250710 + i % 2, None) for i in range(60)], "k long, day int, id long")
    none = new.limit(0)
    first, moved = op.settle_ids(new.where("k < 30"), none, ["k"], "day", "x", bits=8)
    first = spark.createDataFrame(first.collect(), new.schema)
    second, more = op.settle_ids(new.where("k >= 30"), first, ["k"], "day", "x", bits=8)
    both = first.unionByName(second)
    assert both.select("id").distinct().count() == both.count() == 60
    maps = [m for m in (moved, more) if m is not None]
    assert maps
    maps = maps[0] if len(maps) == 1 else maps[0].unionByName(maps[1])
    assert {r["kind"] for r in maps.collect()} == {"x"}
    looked = {r["k"]: r["i"] for r in op.mapped_ids(new.select("k", "day"), ["k"], "day", "x", "i", maps, bits=8).collect()}
    assert looked == {r["k"]: r["id"] for r in both.collect()}
    assert op.settle_ids(new, none, ["k"], "day", "x")[1] is None


def test_stream_batches_are_idempotent_and_late_rows_are_kept(spark, tmp_dir):
    t0 = dt.datetime(2025, 7, 10)
    ev = lambda *ids: spark.createDataFrame([(i, t0 + dt.timedelta(days=i % 20)) for i in ids], "event_id long, ts timestamp")
    late = LateRows("ts", "7 DAYS")
    call = lambda batch, i: apply_batch(batch, i, "s", tmp_dir, "t", ["event_id"], "time_id", late)
    odd = spark.createDataFrame([(None, t0), (99, None)], "event_id long, ts timestamp")
    assert call(ev(0, 1, 2, 2, 15).unionByName(odd), 0) == {"new": 4, "late": 2}
    assert call(ev(0, 1, 2, 2, 15).unionByName(odd), 0) == {"new": 0, "late": 0}  # the same batch again
    assert call(ev(2, 15, 35, 21), 1) == {"new": 1, "late": 1}  # 2 and 15 are stored; 21 is of day 1, more than 7 days before day 15
    assert call(ev().limit(0), 2) == {"new": 0, "late": 0}
    schema = T.StructType([*ev().schema.fields, T.StructField("time_id", T.IntegerType())])
    assert rows(read_published(spark, tmp_dir, "t", schema), "event_id") == [(0,), (1,), (2,), (15,), (35,)]
    ev(*range(8)).write.parquet(f"{tmp_dir}/in/d1")
    for _ in range(2):
        run_increment_load(spark, f"{tmp_dir}/in/*", ev().schema, f"{tmp_dir}/wh", "e", ["event_id"], "ts", "7 DAYS", f"{tmp_dir}/ck")
    assert read_published(spark, f"{tmp_dir}/wh", "e", schema).count() == 8


def test_rank_thresholds(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).alias("v"))
    at = analytics.rank_threshold(df, "v", 40)
    assert 79 <= at < 2_000
    assert analytics.rank_threshold(df.limit(30), "v", 40) is None
    assert analytics.rank_threshold(df.select(F.lit(1).alias("v")), "v", 40) == 1
    news = spark.createDataFrame([(i, f"t{i:03d}") for i in range(300, 400)], "id long, title string")
    companies = spark.createDataFrame([(1, "A")], "id long, ticker string")
    fact = spark.createDataFrame([(i % 400, 1 + i // 3000, float(i // 8)) for i in range(4000)] + [(350, 1, None)], "new_id long, company_id long, ticker_sentiment_score double")
    got = [(r.title, r.ticker_sentiment_score) for r in analytics.lowest_sentiment(fact, news, companies, 10).collect()]
    want = sorted(((float(i // 8), f"t{i % 400:03d}") for i in range(3000) if i % 400 >= 300))[:10]
    assert got == [(t, v) for v, t in want]


def test_exports_are_compressed_in_files_of_bounded_rows(spark, tmp_dir):
    """plain JSON is many times the size of the tables; the bundle is compressed, and no file outgrows a task."""
    rows = spark.range(0, 5000, 1, 1).selectExpr("id AS a_rather_long_column_name", "concat('text ', id) AS another_long_column_name")
    for fmt in ("json", "csv"):
        done = export_tables(spark, {"t": rows}, f"{tmp_dir}/{fmt}", fmt, file_rows=2000).collect()
        assert [tuple(r) for r in done] == [("t", 5000, "ok")]
        files = [f for f in os.listdir(f"{tmp_dir}/{fmt}/t") if f.startswith("part-")]
        assert len(files) == 3 and all(f.endswith(f".{fmt}.gz") for f in files)
        back = spark.read.schema(rows.schema).option("header", "true").format(fmt).load(f"{tmp_dir}/{fmt}/t")
        assert back.exceptAll(rows).isEmpty() and back.count() == 5000
    assert export_tables(spark, {"t": rows}, f"{tmp_dir}/plain", compression="none").first()["rows"] == 5000
    plain = sum(os.path.getsize(f"{tmp_dir}/plain/t/{f}") for f in os.listdir(f"{tmp_dir}/plain/t") if f.endswith(".json"))
    assert sum(os.path.getsize(f"{tmp_dir}/json/t/{f}") for f in os.listdir(f"{tmp_dir}/json/t")) * 4 < plain
