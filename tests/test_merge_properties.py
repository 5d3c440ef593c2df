"""Property tests: upsert and insert_new against brute-force Python models on
random small tables (keys may repeat in a batch, values may be null)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from marketlake import operators as op
from marketlake.functions import row_hash_json

T0 = dt.datetime(2025, 1, 1)
RUN = dt.datetime(2025, 7, 10)

keys = st.integers(min_value=0, max_value=6)
vals = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
base_rows = st.dictionaries(keys, st.tuples(vals, vals), max_size=6)
batch_rows = st.lists(st.tuples(keys, vals, vals), max_size=10)


def model_upsert(base, batch):
    """Row by row semantics of the change-detecting upsert, last row wins."""
    last = {}
    for seq, (k, a, b) in enumerate(batch):
        last[k] = (a, b)                       # later rows overwrite earlier ones
    out = {}
    for k, (a, b) in base.items():
        if k not in last:
            out[k] = (a, b, T0, "kept")
        elif last[k] != (a, b):
            out[k] = (*last[k], RUN, "updated")
        else:
            out[k] = (a, b, T0, "unchanged")
    for k, v in last.items():
        if k not in base:
            out[k] = (*v, RUN, "inserted")
    return out


@settings(max_examples=8, deadline=None)
@given(base_rows, batch_rows)
def test_upsert_matches_model(spark, base, batch):
    b = spark.createDataFrame([(k, a, c, T0) for k, (a, c) in base.items()],
                              "k long, a string, b string, updated_time timestamp_ntz")
    b = b.withColumn("hash_row", row_hash_json(["a", "b"]))
    d = spark.createDataFrame([(k, a, c, i) for i, (k, a, c) in enumerate(batch)],
                              "k long, a string, b string, seq int")
    got = {r["k"]: (r["a"], r["b"], r["updated_time"], r["action"])
           for r in op.upsert(b, d, ["k"], ["a", "b"], ["seq"], "2025-07-10 00:00:00").collect()}
    assert got == model_upsert(base, batch)


@settings(max_examples=8, deadline=None)
@given(st.sets(keys, max_size=5), batch_rows)
def test_insert_new_matches_model(spark, stored, batch):
    target = spark.createDataFrame([(k,) for k in stored], "k long")
    d = spark.createDataFrame([(k, a, c, i) for i, (k, a, c) in enumerate(batch)],
                              "k long, a string, b string, seq int")
    got = sorted(tuple(r) for r in
                 op.insert_new(target, d, ["k"], order_by=["seq"]).select("k", "seq").collect())
    last = {}
    for i, (k, _, _) in enumerate(batch):
        if k not in stored:
            last[k] = i
    assert got == sorted(last.items())
