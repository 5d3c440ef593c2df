"""The splittable scan of JSON arrays against json.loads, and bodies that it must reject."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.sinks import write_json_arrays
from marketlake.sources import read_landing, read_landing_range
from marketlake.sources import json_array
from marketlake.sources.json_array import SEPARATOR, array_elements, read_array

def _struct(**fields):
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


SCHEMA = _struct(k=T.LongType(), s=T.StringType(), n=T.ArrayType(_struct(a=T.IntegerType())), o=_struct(z=_struct(y=T.StringType())))


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "10"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _rows(n=1500):
    rng = random.Random(1)
    odd = ['a,"}],[{\\', "é🙂", '},{"', "plain", "\\\\", "x" * 300, '\\"},', "line\nbreak\t", ""]
    return [{"k": i, "s": rng.choice(odd), "n": [{"a": rng.randint(0, 9)}] * rng.randint(0, 3), "o": {"z": {"y": rng.choice(["],", "},"])}}} for i in range(n)]


@pytest.mark.parametrize("form", [{}, {"indent": 2, "ensure_ascii": False}, {"separators": (",", ":")}])
@pytest.mark.parametrize("segment_bytes", [500, 4 << 20])
def test_many_tasks_give_the_elements_of_the_array(spark, tmp_dir, small_splits, form, segment_bytes):
    want = _rows()
    path = f"{tmp_dir}/a-20250710.json"
    open(path, "w").write(" \n" + json.dumps(want, **form) + "\n")
    assert spark.read.option("lineSep", "},").text(path).rdd.getNumPartitions() > 20
    got = [json.loads(r["text"]) for r in array_elements(spark, path, segment_bytes).collect()]
    assert sorted(got, key=lambda r: r["k"]) == want
    got = [r.asDict(recursive=True) for r in read_array(spark, path, SCHEMA, segment_bytes).drop("_path").collect()]
    assert sorted(got, key=lambda r: r["k"]) == want


def test_a_huge_element_spans_segments(spark, tmp_dir, small_splits):
    want = [{"k": 1, "n": [{"a": i} for i in range(4000)]}, {"k": 2, "n": []}]
    open(f"{tmp_dir}/a.json", "w").write(json.dumps(want))
    got = read_array(spark, f"{tmp_dir}/a.json", SCHEMA, 200).collect()
    assert sorted((r.k, len(r.n)) for r in got) == [(1, 4000), (2, 0)]


@pytest.mark.parametrize("body", [
    '{"a": 1}', '{"feed": [{"k": 1}]}', '[{"k": 1}, {"k": 2}', '[{"k": 1}, {"k', '[{"k": 1}] [{"k": 2}]', '[{"k": 1}, 3]', '[{"k": 1},]', '[,{"k": 1}]', "", "  \n",
    "[null]", '[{"k": 1}]x', '[[{"k": 1}]]', '[{"k": 1}]]', '"[{}]"', '[{"k": 1}, {"k":}]', '[{"k": [1}]', '[{"k": "1}]', "[{]}"])
def test_other_bodies_fail(spark, tmp_dir, body):
    open(f"{tmp_dir}/a-20250710.json", "w").write(body)
    open(f"{tmp_dir}/b-20250710.json", "w").write('[{"k": 7}]')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_landing(spark, tmp_dir, "2025-07-10", SCHEMA).collect()


def test_empty_arrays_and_several_files(spark, tmp_dir):
    for name, body in {"a-20250710": "[]", "b-20250710": " [ \n] ", "c-20250710": "﻿[{\"k\": 5}, {}]", "d-20250711": '[{"k": 6}]'}.items():
        open(f"{tmp_dir}/{name}.json", "w").write(body)
    got = read_landing(spark, tmp_dir, "2025-07-10", SCHEMA)
    assert got.schema == SCHEMA and sorted(r.k or 0 for r in got.collect()) == [0, 5]
    got = read_landing_range(spark, tmp_dir, ["2025-07-10", "2025-07-11"], SCHEMA)
    assert sorted((str(r.run_date), r.k or 0) for r in got.collect()) == [("2025-07-10", 0), ("2025-07-10", 5), ("2025-07-11", 6)]


def test_arrays_written_by_tasks(spark, tmp_dir):
    df = spark.range(1000).selectExpr("id AS k", "concat('\"},', id) AS s").repartition(7)
    write_json_arrays(df, f"{tmp_dir}/x-20250710.json")
    write_json_arrays(df.where("k < 0"), f"{tmp_dir}/y-20250710.json")
    got = read_landing(spark, tmp_dir, "2025-07-10", df.schema)
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, f'"}},{i}') for i in range(1000))


@pytest.mark.parametrize("between", ["\n,", " , ", ",\n", ","])
def test_no_text_is_held_beyond_an_element(spark, tmp_dir, between):
    path = f"{tmp_dir}/a-20250710.json"
    open(path, "w").write("[" + between.join('{"k": %d, "s": "}"}' % i for i in range(20_000)) + "]")
    pieces = spark.read.option("lineSep", SEPARATOR).text(path)
    assert pieces.agg(F.max(F.length("value"))).first()[0] < 100
    assert read_array(spark, path, SCHEMA).agg(F.count("k"), F.sum("k")).first() == (20_000, 199_990_000)


@pytest.mark.parametrize("body", ['[{"k": 1}]}', '[{"k": 1}]},', "[]}", '[{"k": 1}', "﻿[{}]}"])
def test_a_body_that_ends_with_the_separator_fails(spark, tmp_dir, body):
    open(f"{tmp_dir}/a-20250710.json", "w").write(body)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_array(spark, f"{tmp_dir}/a-20250710.json", SCHEMA).collect()


def test_a_split_is_read_a_few_kb_at_a_time(spark):
    """The cutter gives the elements of a split while it reads it, and holds none but the open one."""
    state = [False, 0, True, True, True]
    texts = [*('%s{"k": %d' % ("[" if not i else ",", i) for i in range(300)), "]"]
    names = ["value", "path", "start", "in_string", "depth", "first", "last", "unclosed"]
    given = []

    def batches():
        for i in range(0, len(texts), 10):
            part = texts[i:i + 10]
            given.append(len(part))
            yield pa.RecordBatch.from_pydict({n: c for n, c in zip(names, [part, *([v] * len(part) for v in ["p", 0, *state])])})

    seen = [(len(given), b.num_rows) for b in json_array._cut(100)(batches())]
    assert sum(n for _, n in seen) == 300 and max(n for _, n in seen) < 20 and seen[0][0] <= 2


def test_the_pieces_of_written_arrays_are_rows(spark, tmp_dir):
    """The arrays that tasks write have their commas at the start of a line; a range scan takes them row by row all the same."""
    df = spark.range(30_000).selectExpr("id AS k", "concat('s', id) AS s")
    write_json_arrays(df.where("k < 20000").coalesce(1), f"{tmp_dir}/e-20250709.json")
    write_json_arrays(df.where("k >= 20000").coalesce(1), f"{tmp_dir}/e-20250711.json")
    pieces = spark.read.option("lineSep", SEPARATOR).text([f"{tmp_dir}/e-20250709.json", f"{tmp_dir}/e-20250711.json"])
    assert pieces.agg(F.max(F.length("value"))).first()[0] < 100
    got = read_landing_range(spark, tmp_dir, ["2025-07-09", "2025-07-10", "2025-07-11"], df.schema)
    assert sorted(tuple(map(str, r)) for r in got.groupBy("run_date").count().collect()) == [("2025-07-09", "20000"), ("2025-07-11", "10000")]
