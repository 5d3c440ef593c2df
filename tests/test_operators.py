"""Operator edge cases (FIXTURES.md §4) on tiny inline rows."""

import datetime as dt

from pyspark.sql import functions as F

from marketlake import operators as op
from marketlake.functions import (distinct_from, epoch_ms_to_ts, last_token, parse_compact_ts,
                                  round_half_up, row_hash_concat, row_hash_json, split_explode,
                                  time_id, word_tokens)
from marketlake.functions.temporal import calendar_columns
from tests.conftest import rows


def test_split_explode_edge_cases(spark):
    df = spark.createDataFrame(
        [(1, "A, B"), (2, ""), (3, None), (4, "A,,B"), (5, "\tX \t,  Y\n")],
        "k int, s string")
    out = rows(split_explode(df, "s", ",", out="name"))
    assert out == [(1, "A"), (1, "B"), (4, ""), (4, "A"), (4, "B"), (5, "X"), (5, "Y")]


def test_last_token_untrimmed(spark):
    df = spark.createDataFrame([("NY; U.S.A",), ("Paris",)], "loc string")
    assert rows(df.select(last_token("loc", ";"))) == [(" U.S.A",), ("Paris",)]


def test_word_tokens_whole_text(spark):
    df = spark.createDataFrame([("Élan, the THE-the 42 été",)], "t string")
    assert df.select(word_tokens("t")).first()[0] == ["élan", "the", "the", "the", "été"]


def test_row_hash_modes(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", None)], "x string, y string")
    out = df.select(row_hash_concat(["x", "y"]).alias("c"), row_hash_json(["x", "y"]).alias("j"))
    got = [tuple(r) for r in out.collect()]
    assert got[0][0] == got[1][0]            # concat mode collides
    assert got[0][1] != got[1][1]            # json mode does not
    assert got[2][0] is None                 # a null part → null hash (concat)
    assert got[2][1] is not None             # json mode is null-safe


def test_distinct_from_null_safe(spark):
    df = spark.createDataFrame([(None, None), ("a", None), ("a", "a")], "x string, y string")
    assert [r[0] for r in df.select(distinct_from("x", "y")).collect()] == [False, True, False]


def test_time_parsers(spark):
    df = spark.createDataFrame([("20250710T134500", "1752105600000", "bad")],
                               "a string, b string, c string")
    r = df.select(parse_compact_ts("a"), epoch_ms_to_ts("b"), parse_compact_ts("c"),
                  time_id(F.lit("2025-07-10").cast("date"))).first()
    assert r[0] == dt.datetime(2025, 7, 10, 13, 45)
    assert r[1] == dt.datetime(2025, 7, 10, 0, 0)
    assert r[2] is None
    assert r[3] == 20250710


def test_calendar_columns(spark):
    df = spark.createDataFrame([(dt.date(2025, 7, 10),)], "d date")
    r = df.select(*calendar_columns("d")).first()
    assert tuple(r) == (20250710, dt.date(2025, 7, 10), "Thursday", "July", "3", 2025)


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (-0.004,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x", 2)).collect()] == [0.13, 2.5, -0.0]


def test_latest_per_key_ties_and_listing(spark):
    t = dt.datetime(2025, 7, 1)
    df = spark.createDataFrame(
        [(1, "AAA", False, t), (2, "AAA", True, t), (3, "BBB", True, t),
         (4, "BBB", False, t + dt.timedelta(days=1))],
        "id long, ticker string, is_delisted boolean, updated_time timestamp_ntz")
    out = rows(op.latest_per_key(df, ["ticker"], ["updated_time", "id"]), "ticker", "id")
    assert out == [("AAA", 2), ("BBB", 4)]     # tie on time → higher id; else latest time
    first = rows(op.latest_per_key(df, ["ticker"], ["updated_time", "id"], descending=False),
                 "ticker", "id")
    assert first == [("AAA", 1), ("BBB", 3)]


def test_insert_new_rules(spark):
    target = spark.createDataFrame([("A", 1), ("B", 1)], "k string, d int")
    batch = spark.createDataFrame([("A", 1, 10), ("C", 1, 5), ("C", 1, 7), (None, 1, 1),
                                   ("B", 2, 3)], "k string, d int, v int")
    new = op.insert_new(target, batch, ["k", "d"], order_by=["v"])
    assert rows(new) == [("B", 2, 3), ("C", 1, 7)]   # null key out, last wins per key
    assert rows(op.null_key_rows(batch, ["k", "d"]), "v") == [(1,)]
    every = op.insert_new(target, batch, ["k", "d"], dedupe_batch=False)
    assert len(every.collect()) == 3
    # a second run over the appended target adds nothing (idempotent)
    after = target.unionByName(new.select("k", "d"))
    assert op.insert_new(after, batch, ["k", "d"], order_by=["v"]).count() == 0


def test_insert_new_prunes_target_to_batch_days(spark):
    target = spark.createDataFrame([(1, 20250710), (1, 20250711)], "c long, time_id int")
    batch = spark.createDataFrame([(1, 20250711), (2, 20250711)], "c long, time_id int")
    new = op.insert_new(target, batch, ["c", "time_id"], prune_on="time_id")
    assert rows(new) == [(2, 20250711)]


def test_upsert_actions(spark):
    t0 = dt.datetime(2025, 1, 1)
    base = spark.createDataFrame(
        [(1, "same", "x", t0), (2, "old", "y", t0), (3, "kept", "z", t0)],
        "k long, a string, b string, updated_time timestamp_ntz")
    base = base.withColumn("hash_row", row_hash_json(["a", "b"])).withColumn("id", F.col("k") * 10)
    batch = spark.createDataFrame(
        [(1, "same", "x", 1), (2, "new", "y", 1), (4, "first", "w", 1), (4, "second", "w", 2)],
        "k long, a string, b string, seq int")
    out = op.upsert(base, batch, ["k"], ["a", "b"], order_by=["seq"], run_ts="2025-07-10 00:00:00")
    got = {r["k"]: r for r in out.collect()}
    run = dt.datetime(2025, 7, 10)
    assert got[1]["action"] == "unchanged" and got[1]["updated_time"] == t0
    assert got[2]["action"] == "updated" and got[2]["a"] == "new" and got[2]["updated_time"] == run
    assert got[3]["action"] == "kept" and got[3]["updated_time"] == t0
    assert got[4]["action"] == "inserted" and got[4]["a"] == "second"   # last wins
    assert got[2]["id"] == 20 and got[4]["id"] is None                   # ids carried
    rep = dict(rows(op.merge_report(out)))
    assert rep == {"inserted": 1, "updated": 1, "unchanged": 1, "kept": 1}


def test_upsert_concat_mode_misses_null_change(spark):
    """Parity mode: md5 of a concat with a null part is null on both sides,
    and null vs null is 'not distinct' → the change is missed (kept for
    parity); the json default catches it."""
    t0 = dt.datetime(2025, 1, 1)
    base = spark.createDataFrame([(1, None, "x", t0)],
                                 "k long, a string, b string, updated_time timestamp_ntz")
    batch = spark.createDataFrame([(1, None, "y", 1)], "k long, a string, b string, seq int")
    for mode, expect in (("concat", "unchanged"), ("json", "updated")):
        b = base.withColumn("hash_row", row_hash_concat(["a", "b"]) if mode == "concat"
                            else row_hash_json(["a", "b"]))
        out = op.upsert(b, batch, ["k"], ["a", "b"], ["seq"], "2025-07-10 00:00:00", hash_mode=mode)
        assert out.first()["action"] == expect


def test_insert_ignore(spark):
    target = spark.createDataFrame([("Tech", "IT")], "industry string, sector string")
    batch = spark.createDataFrame([("Tech", "IT"), ("", ""), ("", "")],
                                  "industry string, sector string")
    out = rows(op.insert_ignore(target, batch, ["industry", "sector"]))
    assert out == [("", "", True), ("Tech", "IT", False)]   # blank pair kept, once


def test_resolve_fk_quarantine(spark):
    dim = spark.createDataFrame([(7, "NYSE")], "id long, name string")
    df = spark.createDataFrame([("A", "NYSE"), ("B", "LSE"), ("C", None)],
                               "ticker string, exchange string")
    ok, bad = op.resolve_fk(df, dim, {"exchange": "name"}, alias="exchange_id")
    assert rows(ok) == [("A", "NYSE", 7)]
    assert rows(bad) == [("B", "LSE", "unknown exchange"), ("C", None, "null exchange")]


def test_assign_dense_ids(spark):
    df = spark.range(0, 500).select(F.format_string("k%04d", "id").alias("name"))
    out = op.assign_dense_ids(df, ["name"], start=100, num_partitions=7)
    got = sorted((r["id"], r["name"]) for r in out.collect())
    assert [g[0] for g in got] == list(range(101, 601))
    assert [g[1] for g in got] == sorted(g[1] for g in got)   # ids follow the order


def test_hash_ids_unique_check(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "x string, y int")
    ids = op.assign_hash_ids(df, ["x", "y"])
    assert op.check_unique(ids, ["id"]).count() == 0


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "abc", None), (1, "abcdef", 5), (2, None, 3)],
                               "k int, s string, v int")
    assert rows(op.check_not_null(df, ["s", "v"]), "k", "reason") == [
        (1, "null: v"), (2, "null: s")]
    assert rows(op.check_unique(df, ["k"])) == [(1, 2)]
    assert rows(op.check_length(df, {"s": 4}), "k") == [(1,)]
    parent = spark.createDataFrame([(1,)], "k int")
    assert rows(op.check_fk(df, parent, ["k"]), "k") == [(2,)]
    prof = {(r[0], r[1]): r[2] for r in op.profile(df, ["s", "v"], {"s": 4}).collect()}
    assert prof == {("not_null", "s"): 1, ("not_null", "v"): 1, ("length<=4", "s"): 1}


def _batches(spark, data):
    """(id, d1.., zone) rows with the day as a date."""
    days = {"d1": "2025-07-01", "d2": "2025-07-02", "d3": "2025-07-03", "d4": "2025-07-04", None: None}
    df = spark.createDataFrame([(i, days[d], z, d) for i, d, z in data], "id string, run_date string, zone int, d string")
    return df.withColumn("run_date", df.run_date.cast("date"))


def test_assemble_capped_never_loses_a_day(spark):
    def day(d, n, zone):
        return [(f"{d}-{zone}-{i}", d, zone) for i in range(n)]
    data = (day("d1", 10, 1)                                         # at the cap, halves missing
            + day("d2", 4, 2) + day("d2", 5, 3)                      # halves without a full day
            + day("d3", 10, 1) + day("d3", 10, 2) + day("d3", 3, 3)  # a half at the cap
            + day("d4", 10, 1) + day("d4", 6, 2)                     # at the cap, one half missing
            + day(None, 2, 1))
    df = _batches(spark, data)
    kept = sorted((r["d"], r["zone"], r["n"]) for r in op.assemble_capped(df, 10).groupBy("d", "zone").count()
                  .withColumnRenamed("count", "n").collect())
    assert kept == [("d1", 1, 10), ("d2", 2, 4), ("d2", 3, 5), ("d3", 2, 10), ("d3", 3, 3), ("d4", 1, 10), ("d4", 2, 6)]
    report = {str(r["run_date"]): r["reason"] for r in op.capped_report(df, 10).collect()}
    assert report == {"2025-07-01": "full day at the cap, halves missing", "2025-07-03": "a half at the cap",
                      "2025-07-04": "full day at the cap, halves missing"}
    assert op.capped_quarantine(df).count() == 2


def test_assemble_capped_at_the_cap(spark):
    def day(d, n, zone):
        return [(f"{d}-{zone}-{i}", d, zone) for i in range(n)]
    data = (day("d1", 999, 1) + day("d1", 500, 2) + day("d1", 499, 3)
            + day("d2", 1000, 1) + day("d2", 600, 2) + day("d2", 700, 3))
    df = _batches(spark, data)
    out = op.assemble_capped(df, 1000)
    got = {(r[0], r[1]): r[2] for r in out.groupBy("run_date", "zone").count().collect()}
    assert {(str(d), z): n for (d, z), n in got.items()} == {("2025-07-01", 1): 999, ("2025-07-02", 2): 600, ("2025-07-02", 3): 700}


def test_union_sources_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id int, b double")
    out = op.union_sources([a, b], tag_col="src", tags=["A", "B"])
    assert sorted(out.columns) == ["a", "b", "id", "src"]
    assert rows(out, "id", "a", "b", "src") == [(1, "x", None, "A"), (2, None, 3.0, "B")]


def test_allowlist_and_drop_incomplete(spark):
    df = spark.createDataFrame([("NYSE", "USD", "x"), ("LSE", "USD", "y"), ("NYSE", "EUR", "z"),
                                ("NYSE", "USD", "x"), ("NYSE", "USD", None), ("NYSE", "USD", "")],
                               "exchange string, currency string, sector string")
    clean = op.drop_incomplete_distinct(df)
    kept = op.allowlist(clean, "exchange", ["NASDAQ", "NYSE"], currency="USD")
    assert rows(kept, "sector") == [("",), ("x",)]


def test_unwrap_envelope_required_and_optional(spark):
    from pyspark.sql import types as T
    from marketlake.sources import unwrap_envelope
    payload = T.StructType([T.StructField("k", T.LongType())])
    df = spark.createDataFrame([(1, '{"feed": [{"k": 1}, {"k": 2}]}'), (2, '{"feed": []}'),
                                (3, '{"other": 1}')], "id int, body string")
    req = unwrap_envelope(df, "body", "feed", payload, required=True)
    assert rows(req, "id", "_envelope_error", "k") == [(1, False, 1), (1, False, 2),
                                                       (3, True, None)]
    opt = unwrap_envelope(df, "body", "feed", payload, required=False)
    assert rows(opt, "id", "k") == [(1, 1), (1, 2)]
