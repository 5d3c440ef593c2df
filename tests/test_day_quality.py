"""Quality checks of the days that a load touched: equal to the full check, day by day, and reading those days only."""

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.plans.jobs import PARTITIONS, warehouse_quality
from tests.conftest import rows
from tests.test_plans import plan

DAYS = [20250701, 20250702, 20250703]


@pytest.fixture()
def warehouse(spark, tmp_dir):
    """Articles and mentions of three days; an id twice, an article and a company that aren't stored, a null."""
    def table(name, values, cols):
        ddl = schemas.WAREHOUSE_DDL[name]
        df = spark.createDataFrame(values, cols)
        df = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ddl.fields])
        out = df.write.partitionBy(PARTITIONS[name]) if name in PARTITIONS else df.write
        out.parquet(f"{tmp_dir}/{name}")
        return spark.read.schema(ddl).parquet(f"{tmp_dir}/{name}")

    news = [(day * 10 + k, f"t{k}", day) for day in DAYS for k in range(3)]
    news.append((DAYS[1] * 10, "again", DAYS[1]))
    mentions = [(day * 100 + k, day * 10 + k % 4, k % 2 + 1, day) for day in DAYS for k in range(8)]
    mentions.append((DAYS[2] * 100, DAYS[2] * 10, 77, DAYS[2]))
    return {"dim_news": table("dim_news", news, "id long, title string, published_day int"),
            "fact_news_companies": table("fact_news_companies", mentions, "id long, new_id long, company_id long, published_day int"),
            "dim_companies": table("dim_companies", [(1, "A"), (2, "B")], "id long, ticker string")}


def test_days_add_up_to_the_full_check(spark, warehouse):
    dated = [n for n in warehouse if n in PARTITIONS]
    full = warehouse_quality(warehouse).where(F.col("table").isin(dated))
    parts = [warehouse_quality(warehouse, [d]).where(F.col("table").isin(dated)) for d in DAYS]
    added = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("table", "check", "column_name").agg(F.sum("violations").alias("violations"))
    want = rows(full)
    assert rows(added) == want
    found = {r[:3]: r[3] for r in want}
    assert found["dim_news", "unique", "id"] == 1 and found["fact_news_companies", "unique", "id"] == 1
    assert found["fact_news_companies", "fk->dim_news", "new_id"] == 6  # two of eight a day name a fourth article
    assert found["fact_news_companies", "fk->dim_companies", "company_id"] == 1
    assert rows(warehouse_quality(warehouse, DAYS)) == rows(warehouse_quality(warehouse))


def test_only_the_days_partitions_are_read(spark, warehouse):
    p = plan(warehouse_quality(warehouse, DAYS[:1]))
    scans = [b for b in p.split("\n\n") if "Scan parquet" in b and "published_day" in b]
    assert scans and all(f"published_day#" in b and str(DAYS[0]) in b.split("PartitionFilters")[1] for b in scans)
    assert warehouse_quality(warehouse, []).where("table = 'fact_news_companies' AND violations > 0").count() == 0
