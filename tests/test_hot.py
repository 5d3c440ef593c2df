"""Hot keys: exact counts, joins equal to plain ones, and plans that leave hot rows where they lie."""

import collections

import pytest
from pyspark.sql import functions as F

from marketlake import operators as op
from marketlake import schemas
from marketlake.plans import facts
from tests.conftest import rows
from tests.test_plans import plan

N = 3000


@pytest.fixture(scope="module")
def mentions(spark):
    """A third of the rows name one ticker, a tenth none, the others 500 tickers."""
    i = F.col("id")
    ticker = F.when(i % 3 == 0, F.lit("HOT")).when(i % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("t"), (i % 500).cast("string")))
    return spark.range(N).select(ticker.alias("ticker"), i.alias("n"))


@pytest.fixture(scope="module")
def companies(spark):
    return spark.range(250).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("ticker"), F.col("id").alias("company_id")) \
        .unionByName(spark.createDataFrame([("HOT", 1000), (None, 1001)], "ticker string, company_id long"))


def test_heavy_keys_are_exact(spark, mentions):
    seen = collections.Counter(r["ticker"] for r in mentions.collect() if r["ticker"] is not None)
    for share in (0.3, 0.01, 0.002):
        want = sorted((k, n) for k, n in seen.items() if n >= share * sum(seen.values()))
        assert rows(op.heavy_keys(mentions, ["ticker"], share)) == want, share
    pairs = mentions.withColumn("other", F.lit(1))
    assert rows(op.heavy_keys(pairs, ["ticker", "other"], 0.3)) == [("HOT", 1, 1000)]


def test_heavy_keys_of_nothing(spark, mentions):
    assert op.heavy_keys(mentions.where("false"), ["ticker"]).count() == 0
    assert op.heavy_keys(mentions.where("ticker is null"), ["ticker"]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_the_plain_join(spark, mentions, companies, how):
    key = lambda r: tuple((v is None, v) for v in r)
    got = op.split_join(mentions, companies, ["ticker"], how)
    want = mentions.join(companies, ["ticker"], how)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    for rows_, dim in ((mentions.where("false"), companies), (mentions, companies.where("false"))):
        assert op.split_join(rows_, dim, ["ticker"], how).count() == rows_.join(dim, ["ticker"], how).count()


def test_split_join_refuses_what_it_cannot_do(mentions, companies):
    with pytest.raises(ValueError, match="how"):
        op.split_join(mentions, companies, ["ticker"], "full")
    with pytest.raises(ValueError, match="ticker is"):
        op.split_join(mentions, companies.withColumn("ticker", F.col("company_id")), ["ticker"])
    with pytest.raises(ValueError, match="share"):
        op.heavy_keys(mentions, ["ticker"], 0.0001)


def test_hot_rows_are_not_shuffled(spark, mentions, companies, tmp_dir):
    """The largest shuffle partition of the join holds no hot ticker: only rows of others are exchanged."""
    mentions.write.parquet(f"{tmp_dir}/m")
    companies.write.parquet(f"{tmp_dir}/c")
    m, c = spark.read.parquet(f"{tmp_dir}/m"), spark.read.parquet(f"{tmp_dir}/c")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(op.split_join(m, c, ["ticker"]), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hot, cold = p[:p.index("LeftAnti")], p[p.index("LeftAnti"):]
    assert "Union" in p and "BroadcastHashJoin [ticker" in hot
    assert "SortMergeJoin" in p and hot.count("LeftSemi") >= 1
    # a row is exchanged by its ticker only above the anti join that takes the hot ones out
    assert "hashpartitioning(ticker" not in hot.split("SortMergeJoin")[0]
    assert "partial_approx_top_k" in cold or "partial_approx_top_k" in hot


def test_facts_with_a_hot_ticker(spark):
    """Bars and mentions of which a third are one ticker's give the same facts with and without the split."""
    dim = spark.createDataFrame([(i, f"T{i}", None) for i in range(40)] + [(100, "T0", None)],
                                "id long, ticker string, updated_time timestamp_ntz")
    i = F.col("id")
    ticker = F.when(i % 3 == 0, F.lit("T0")).otherwise(F.concat(F.lit("T"), (i % 50).cast("string")))
    bars = spark.range(600).select(
        ticker.alias("ticker"), i.cast("double").alias("volume"), F.lit(1.0).alias("volume_weighted"),
        *[F.lit(2.0).alias(c) for c in ("open", "close", "high", "low")], (i * 86400000).alias("time_stamp"),
        i.alias("num_of_trades"), F.lit(None).cast("boolean").alias("is_otc"))
    got = facts.candle_rows(bars, dim, split_hot=True)
    assert rows(got) == rows(facts.candle_rows(bars, dim))
    assert got.where("company_id = 100").count() == 200 + 8  # every third bar, and every fiftieth of the others
    assert set(schemas.WAREHOUSE_DDL["fact_candles"].names) - {"id"} == set(got.columns)
