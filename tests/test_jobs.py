"""Landing reads, normalisation, LOD-1 and the daily warehouse load, end to
end on small landed JSON fixtures written into a fresh temporary directory."""

import datetime as dt
import json
import os

import pytest

from marketlake import schemas
from marketlake.plans import analytics as qa
from marketlake.plans import jobs, normalize
from marketlake.sinks import read_snapshot, write_run_date
from marketlake.sources import MissingRunDate, read_bars, read_lake, read_landing, read_table
from tests.conftest import rows

MARKETS = [
    {"market_type": "Equity", "region": "United States", "primary_exchanges": "NASDAQ, NYSE",
     "local_open": "09:30", "local_close": "16:00", "current_status": "open", "notes": ""},
    {"market_type": "Forex", "region": "Global", "primary_exchanges": "",
     "local_open": "00:00", "local_close": "23:59", "current_status": "open", "notes": ""},
    {"market_type": "Crypto", "region": "Global", "primary_exchanges": None,
     "local_open": "00:00", "local_close": "23:59", "current_status": "open", "notes": ""},
    {"market_type": "Equity", "region": "Japan", "primary_exchanges": "Tokyo,,\tOsaka ",
     "local_open": "09:00", "local_close": "15:00", "current_status": "closed", "notes": ""},
]


def company(ticker, **kw):
    base = {"name": f"{ticker} Inc", "ticker": ticker, "isDelisted": False, "category": "CS",
            "currency": "USD", "location": "NY; U.S.A", "industry": "Software",
            "sector": "Technology", "exchange": "NASDAQ", "sic": "7372",
            "sicIndustry": "Prepackaged Software", "sicSector": "Services"}
    base.update(kw)
    return base


COMPANIES = [
    company("AAA"),
    company("BBB", exchange="NYSE", sector=""),            # empty string survives
    company("CCC", location=None),                         # a null field → dropped
    company("DDD", exchange="LSE"),                        # not on a kept venue
    company("EEE", currency="EUR"),                        # not in the kept currency
    company("AAA", isDelisted=True, name="AAA Old"),       # listed + delisted versions
]


def news_item(title, published, topics, tickers, url=None):
    return {"title": title, "url": url or f"https://n/{title}", "time_published": published,
            "authors": ["a"], "summary": "s", "source": "Wire",
            "overall_sentiment_score": 0.1, "overall_sentiment_label": "Neutral",
            "topics": topics, "ticker_sentiment": tickers}


def land(base, prefix, date, payload):
    d = os.path.join(base, prefix)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"crawl_{prefix}-{date}.json"), "w") as fh:
        json.dump(payload, fh)


@pytest.fixture()
def landing(tmp_dir):
    base = os.path.join(tmp_dir, "landing")
    land(base, "markets", "20250501", MARKETS)
    land(base, "companies", "20250501", COMPANIES)
    ms = int(dt.datetime(2025, 7, 10).timestamp() * 1000)
    land(base, "ohlcs", "20250710", {"results": [
        {"T": "AAA", "v": 3e9, "vw": 10.5, "o": 10, "c": 11, "h": 12, "l": 9, "t": ms, "n": 7},
        {"T": "BBB", "v": 100, "vw": None, "o": 1, "c": 1, "h": 1, "l": 1, "t": ms, "n": 1},
        {"T": "ZZZ", "v": 100, "vw": 1.0, "o": 1, "c": 1, "h": 1, "l": 1, "t": ms, "n": 1}]})
    land(base, "ohlcs", "20250712", [])                      # weekend: empty array
    land(base, "news", "20250710", [
        news_item("Up", "20250710T101500",
                  [{"topic": "Technology", "relevance_score": "0.9"},
                   {"topic": "Nope", "relevance_score": "0.1"}],
                  [{"ticker": "AAA", "relevance_score": "0.8", "ticker_sentiment_score": "-0.3",
                    "ticker_sentiment_label": "Bearish"},
                   {"ticker": "ZZZ", "relevance_score": "0.5", "ticker_sentiment_score": "0.1",
                    "ticker_sentiment_label": "Neutral"}]),
        news_item("Up", "20250710T101500", [{"topic": "Technology", "relevance_score": "0.9"}],
                  []),                                         # same article twice
        news_item("Quiet", "20250710T230000", [], None),       # no topics, no tickers
    ])
    return base


def test_read_landing_modes(spark, landing):
    m = read_landing(spark, f"{landing}/markets", "2025-05-01", schemas.MARKETS)
    assert m.count() == 4
    with pytest.raises(MissingRunDate):
        read_landing(spark, f"{landing}/markets", "2025-06-01", schemas.MARKETS)
    empty = read_landing(spark, f"{landing}/markets", "2025-06-01", schemas.MARKETS,
                         missing="skip")
    assert empty.count() == 0 and empty.schema == schemas.MARKETS


def test_read_bars_shapes(spark, landing):
    bars = read_bars(spark, f"{landing}/ohlcs", "2025-07-10")
    assert bars.columns == [f.name for f in schemas.OHLC.fields]
    assert rows(bars, "ticker", "time_stamp")[0][0] == "AAA"
    weekend = read_bars(spark, f"{landing}/ohlcs", "2025-07-12")
    assert weekend.count() == 0 and weekend.schema == schemas.OHLC
    assert read_bars(spark, f"{landing}/ohlcs", "2025-07-13").count() == 0   # missing file


def test_normalise_golden_shapes(spark, landing):
    m = read_landing(spark, f"{landing}/markets", "2025-05-01", schemas.MARKETS)
    c = read_landing(spark, f"{landing}/companies", "2025-05-01", schemas.COMPANIES_RAW)
    n = normalize.normalise_all(m, c)
    assert rows(n["regions"]) == [("Global", "00:00", "23:59"), ("Japan", "09:00", "15:00"),
                                  ("United States", "09:30", "16:00")]
    assert rows(n["exchanges"]) == [("", "Japan"), ("NASDAQ", "United States"),
                                    ("NYSE", "United States"), ("Osaka", "Japan"),
                                    ("Tokyo", "Japan")]
    assert rows(n["industries"]) == [("Software", ""), ("Software", "Technology")]
    assert rows(n["sic_industries"]) == [("7372", "Prepackaged Software", "Services")]
    assert rows(n["companies"], "ticker", "is_delisted", "sector") == [
        ("AAA", False, "Technology"), ("AAA", True, "Technology"), ("BBB", False, "")]


def test_reference_load_and_daily_load(spark, landing, tmp_dir):
    ref = os.path.join(tmp_dir, "ref")
    wh = os.path.join(tmp_dir, "wh")
    quarantine, report = jobs.run_reference_load(spark, landing, ref, "2025-05-01",
                                                 "2025-05-01 00:00:00")
    # exchange '' (from "Tokyo,,Osaka") resolves to Japan; all FKs resolve here
    assert quarantine.count() == 0
    rep = {(r["table"], r["action"]): r["rows"] for r in report.collect()}
    assert rep[("regions", "inserted")] == 3 and rep[("companies", "inserted")] == 3
    comp = read_snapshot(spark, ref, "companies")
    assert sorted(r["id"] for r in comp.collect()) == [1, 2, 3]

    # running the same month again changes nothing
    _, report2 = jobs.run_reference_load(spark, landing, ref, "2025-05-01", "2025-06-01 00:00:00")
    assert {r["action"] for r in report2.collect()} <= {"unchanged", "kept"}
    comp2 = read_snapshot(spark, ref, "companies")
    assert rows(comp2, "id", "ticker", "updated_time") == rows(comp, "id", "ticker",
                                                               "updated_time")

    added = jobs.run_daily_load(spark, landing, ref, wh, "2025-07-10")
    assert added["dim_companies"] == 2            # AAA (latest row) and BBB, one per ticker
    assert added["dim_news"] == 2                 # "Up" once, "Quiet"
    assert added["dim_topics"] == 2               # Technology, Nope (dimension of names seen)
    assert added["fact_candles"] == 1             # BBB null vw dropped, ZZZ unknown dropped
    assert added["fact_news_topics"] == 2         # Up×Technology, Up×Nope ("Quiet" has none)
    assert added["fact_news_companies"] == 1      # AAA only; ZZZ not a company
    assert added["quarantine"] == 2               # ZZZ bar (unknown ticker), BBB bar (null vw)
    q = spark.read.parquet(os.path.join(wh, "_quarantine"))
    assert rows(q, "source", "reason") == [("ohlcs", "null volume_weighted"),
                                           ("ohlcs", "unknown ticker")]
    candles = read_table(spark, wh, "fact_candles", time_id="20250710")
    c = candles.first()
    assert c["volume"] == 3_000_000_000 and c["is_otc"] is False
    with pytest.raises(ValueError):
        read_table(spark, wh, "fact_candles", time_id="x")
    with pytest.raises(KeyError):
        read_table(spark, wh, "nope")

    # the whole warehouse passes its DDL rules
    report = jobs.warehouse_quality({n: read_table(spark, wh, n) for n in schemas.WAREHOUSE_TABLES})
    bad = [tuple(r) for r in report.collect() if r["violations"]]
    assert bad == []
    per_column = sum(len(schemas.NOT_NULL[t]) + len(schemas.MAX_LENGTH[t])
                     for t in schemas.WAREHOUSE_TABLES)
    assert report.count() == per_column + 7 + len(schemas.FOREIGN_KEYS)

    # a re-run of the day appends nothing
    again = jobs.run_daily_load(spark, landing, ref, wh, "2025-07-10")
    assert {v for k, v in again.items() if k != "quarantine"} == {0}
    # the day's quarantine is rewritten, not appended, on a re-run
    assert spark.read.parquet(os.path.join(wh, "_quarantine")).count() == 2
    # an empty trading day is a no-op, not an error
    assert set(jobs.run_daily_load(spark, landing, ref, wh, "2025-07-12").values()) <= {0, 1}

    # analytics over the loaded warehouse
    fnc = read_table(spark, wh, "fact_news_companies")
    news = read_table(spark, wh, "dim_news")
    dcomp = read_table(spark, wh, "dim_companies")
    dtime = read_table(spark, wh, "dim_time")
    assert rows(qa.mentions_per_day(fnc, news, dcomp, dtime)) == [
        ("AAA", dt.date(2025, 7, 10), 1)]
    low = qa.lowest_sentiment(fnc, news, dcomp).collect()
    assert [(r[0], r[2]) for r in low] == [("AAA", -0.3)]
    typed = qa.typed_news(news)
    assert "summary" not in typed.columns
    assert rows(qa.count_by_hour(typed)) == [(10, 1), (23, 1)]
    assert rows(qa.count_by_country(dcomp)) == [(" U.S.A", 2)]


def test_write_run_date_is_idempotent(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.date(2025, 7, 10)), (2, dt.date(2025, 7, 11))],
                               "k long, run_date date")
    write_run_date(df, tmp_dir, "lake")
    write_run_date(df.where("k = 1"), tmp_dir, "lake")      # re-run of one day
    got = read_lake(spark, tmp_dir, "lake", ("2025-07-10", "2025-07-11"))
    assert rows(got, "k") == [(1,), (2,)]
    assert rows(read_lake(spark, tmp_dir, "lake", "2025-07-11"), "k") == [(2,)]


def test_first_occurrence_equals_daily_runs(spark):
    df = spark.createDataFrame(
        [("A", dt.date(2025, 7, 10), 1), ("A", dt.date(2025, 7, 11), 2),
         ("B", dt.date(2025, 7, 11), 3), ("B", dt.date(2025, 7, 12), 4),
         ("C", dt.date(2025, 7, 20), 5)], "k string, run_date date, v int")
    got = rows(jobs.first_occurrence(df, ["k"], ("2025-07-10", "2025-07-12"), tie_break=["v"]),
               "k", "v")
    assert got == [("A", 1), ("B", 3)]


def test_stream_increment_rerun_adds_nothing(spark, tmp_dir):
    from marketlake.streaming import run_increment
    ev = spark.createDataFrame([(i, f"e{i}") for i in range(10)], "event_id long, x string")
    landing = os.path.join(tmp_dir, "in")
    ev.where("event_id < 7").write.parquet(f"{landing}/d1")
    ev.where("event_id >= 3").write.parquet(f"{landing}/d2")
    target = ev.where("event_id < 2")
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    run_increment(spark, f"{landing}/*", ev.schema, target, ["event_id"], out, ck)
    got = spark.read.parquet(out)
    assert rows(got, "event_id") == [(i,) for i in range(2, 10)]
    run_increment(spark, f"{landing}/*", ev.schema, target, ["event_id"], out, ck)
    assert spark.read.parquet(out).count() == 8


def scratch_files(spark):
    base = os.path.join(spark.conf.get("spark.checkpoint.dir"), "marketlake")
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(base) for f in fs if f.endswith(".parquet"))


def test_scratch_scope(spark):
    from marketlake.session import materialise, scratch_scope
    before = scratch_files(spark)
    with pytest.raises(ValueError):
        with scratch_scope(spark):
            with scratch_scope(spark):
                assert materialise(spark.range(5), "scope-inner").count() == 5
            assert scratch_files(spark) == before
            assert materialise(spark.range(7), "scope").count() == 7
            raise ValueError("a job that fails leaves nothing either")
    assert scratch_files(spark) == before
    materialise(spark.range(3), "kept")
    assert len(scratch_files(spark)) > len(before)


def test_backfill_equals_daily_loads(spark, landing, tmp_dir):
    """BKF-1 invariant: one range job gives the same warehouse as daily runs."""
    ms = int(dt.datetime(2025, 7, 11).timestamp() * 1000)
    land(landing, "ohlcs", "20250711", [
        {"T": "AAA", "v": 5, "vw": 11.0, "o": 11, "c": 12, "h": 12, "l": 10, "t": ms, "n": 2},
        {"T": "BBB", "v": 6, "vw": 2.0, "o": 2, "c": 2, "h": 2, "l": 2, "t": ms, "n": 1}])
    land(landing, "news", "20250711", [
        # re-published: same key as on 07-10 → stays with its first run date
        news_item("Up", "20250710T101500", [{"topic": "Technology", "relevance_score": "0.2"},
                                             {"topic": "Energy", "relevance_score": "0.7"}],
                  [{"ticker": "BBB", "relevance_score": "0.4", "ticker_sentiment_score": "0.2",
                    "ticker_sentiment_label": "Bullish"}]),
        news_item("Down", "20250711T090000", [{"topic": "Alpha", "relevance_score": "0.5"}],
                  [{"ticker": "AAA", "relevance_score": "0.9", "ticker_sentiment_score": "-0.5",
                    "ticker_sentiment_label": "Bearish"}]),
    ])
    ref = os.path.join(tmp_dir, "ref")
    jobs.run_reference_load(spark, landing, ref, "2025-05-01", "2025-05-01 00:00:00")
    daily, ranged = os.path.join(tmp_dir, "daily"), os.path.join(tmp_dir, "range")
    scratch = scratch_files(spark)
    for day in ("2025-07-10", "2025-07-11", "2025-07-12"):
        jobs.run_daily_load(spark, landing, ref, daily, day)
    added = jobs.run_backfill(spark, landing, ref, ranged, "2025-07-10", "2025-07-12", split_hot=True)
    assert added["fact_candles"] == 3
    assert scratch_files(spark) == scratch  # what the loads wrote between their steps is gone
    for name in schemas.WAREHOUSE_TABLES:
        a = read_table(spark, daily, name)
        b = read_table(spark, ranged, name)
        cols = [c for c in a.columns if c != "authors"]
        assert rows(a, *cols) == rows(b, *cols), name
    topics = dict((r["name"], r["id"]) for r in read_table(spark, ranged, "dim_topics").collect())
    assert topics == {"Nope": 1, "Technology": 2, "Alpha": 3, "Energy": 4}


def test_command_line(spark, landing, tmp_dir, capsys):
    from marketlake.__main__ import main
    ref, wh = os.path.join(tmp_dir, "ref"), os.path.join(tmp_dir, "wh")
    assert main(["reference-load", "--landing", landing, "--ref", ref,
                 "--run-date", "2025-05-01"], spark) == 0
    assert main(["backfill", "--landing", landing, "--ref", ref, "--warehouse", wh,
                 "--start", "2025-07-10", "--end", "2025-07-12"], spark) == 0
    out = capsys.readouterr().out
    added = json.loads(out.strip().splitlines()[-1])
    assert added["fact_candles"] == 1 and added["dim_news"] == 2
    q = os.path.join(tmp_dir, "quality")
    assert main(["quality", "--warehouse", wh, "--out", q], spark) == 0
    assert spark.read.json(q).where("violations > 0").count() == 0
    e = os.path.join(tmp_dir, "export")
    assert main(["export", "--warehouse", wh, "--out", e, "--format", "csv"], spark) == 0
    assert spark.read.option("header", True).csv(f"{e}/dim_news").count() == 2


def test_stream_increment_with_watermark(spark, tmp_dir):
    """Bounded-state form: dedupe within a watermark on the event time."""
    from marketlake.streaming import run_increment
    t0 = dt.datetime(2025, 7, 10)
    ev = spark.createDataFrame([(i, t0 + dt.timedelta(minutes=i)) for i in range(10)],
                               "event_id long, ts timestamp_ntz")
    ev = ev.selectExpr("event_id", "cast(ts as timestamp) as ts")
    landing = os.path.join(tmp_dir, "in")
    ev.where("event_id < 7").write.parquet(f"{landing}/d1")
    ev.where("event_id >= 3").write.parquet(f"{landing}/d2")
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    run_increment(spark, f"{landing}/*", ev.schema, ev.where("event_id < 2"), ["event_id"],
                  out, ck, watermark=("ts", "1 day"))
    assert rows(spark.read.parquet(out), "event_id") == [(i,) for i in range(2, 10)]
