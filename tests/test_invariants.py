"""Invariants: a range backfill equals day-by-day insert-only
runs; dense ids are a gap-free ordered numbering; splitting agrees with a
plain-Python reading of the rule."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake import operators as op
from marketlake.functions import split_explode
from marketlake.plans.jobs import first_occurrence
from tests.conftest import rows


def test_backfill_equals_daily_runs(spark):
    rnd = random.Random(7)
    start = dt.date(2025, 7, 10)
    data = [(f"K{rnd.randrange(40)}", start + dt.timedelta(days=rnd.randrange(11)), i)
            for i in range(400)]
    df = spark.createDataFrame(data, "k string, run_date date, v int")
    one_job = rows(first_occurrence(df, ["k"], ("2025-07-10", "2025-07-20"), tie_break=["v"]),
                   "k", "v")
    # day by day: insert-if-new against what earlier days stored
    stored = spark.createDataFrame([], "k string, run_date date, v int")
    for day in range(11):
        d = start + dt.timedelta(days=day)
        batch = df.where(F.col("run_date") == F.lit(d))
        new = op.insert_new(stored, batch, ["k"], order_by=[F.col("v") * -1])
        stored = stored.unionByName(new).checkpoint()   # each day is a written table
    assert rows(stored, "k", "v") == one_job


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="abcxyz", min_size=1, max_size=4), min_size=0, max_size=60,
                unique=True),
       st.integers(min_value=0, max_value=1000), st.integers(min_value=1, max_value=9))
def test_dense_ids_property(spark, names, start, parts):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = sorted((r["name"], r["id"]) for r in
                 op.assign_dense_ids(df, ["name"], start=start, num_partitions=parts).collect())
    assert got == [(n, start + i + 1) for i, n in enumerate(sorted(names))]


@settings(max_examples=12, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="ab ,\t", max_size=12)))
def test_split_explode_matches_rule(spark, s):
    df = spark.createDataFrame([(1, s)], "k int, s string")
    got = [r["t"] for r in split_explode(df, "s", ",", out="t").collect()]
    expect = [] if not s else [p.strip() for p in s.split(",")]
    assert sorted(got) == sorted(expect)
