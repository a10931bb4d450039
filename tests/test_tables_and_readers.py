import json
import os

import pytest
from pyspark.sql import functions as F
from strata.operators import dedup, recoding
from strata.sources import readers, sinks
from strata.streaming.ingest import stream_bronze

SCHEMA = "id int, t string, into string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- recoding from a table

def test_recode_from_table(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "A ", "x"), (3, "zz", "x"), (4, None, "x"), (5, "n", "x")], SCHEMA)
    table = spark.createDataFrame([("A", "one"), (None, "lost"), ("N", None), ("B", "two")], "k string, v string")
    norm = F.upper(F.trim("t"))
    got = {u: [r[2] for r in rows_of(recoding.recode_from_table(df, norm, "into", table, "k", "v", unknown=u))]
           for u in (recoding.KEEP, recoding.NULL)}
    assert got == {"keep": ["one", "one", "ZZ", None, None], "null": ["one", "one", None, None, None]}
    other = recoding.recode_from_table(df, norm, "code", table, "k", "v", unknown=F.lit("?"))
    assert other.columns == ["id", "t", "into", "code"]
    assert [r[3] for r in rows_of(other)] == ["one", "one", "?", "?", None]


def test_a_repeated_key_of_the_map_raises_or_takes_the_least(spark):
    df = spark.createDataFrame([(1, "q", "")], SCHEMA)
    table = spark.createDataFrame([("q", "1"), ("b", "9"), ("b", "3"), ("b", None)], "k string, v string")
    with pytest.raises(Exception, match="repeats in the map: b"):
        recoding.recode_from_table(df, "t", "into", table, "k", "v").collect()
    assert rows_of(recoding.map_of(table, "k", "v", "least")) == [("b", "3"), ("q", "1")]
    empty = table.limit(0)
    assert rows_of(recoding.recode_from_table(df, "t", "into", empty, "k", "v")) == [(1, "q", "q")]
    assert rows_of(recoding.recode_from_table(df.limit(0), "t", "into", empty, "k", "v")) == []


def test_a_hot_key_meets_a_large_map_without_a_forced_broadcast(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("t"))
    table = spark.range(6000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).cast("string").alias("v")) \
        .unionByName(spark.createDataFrame([("hot", "H")], "k string, v string"))
    out = recoding.recode_from_table(df, "t", "into", table, "k", "v")
    assert "broadcast" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert out.where((F.col("t") == "hot") & (F.col("into") == "H")).count() == 2000
    assert out.where("into = cast(id * 2 as string)").count() == 4000


# -- best row by aggregate

def test_best_row_aggregate_is_the_windows(spark):
    data = [(k % 7 or None, (k * 37) % 11 or None, k, f"t{k}") for k in range(300)]
    df = spark.createDataFrame(data, "k int, d int, n int, t string")
    for asc in (True, False):
        order = [F.col("d").asc_nulls_last() if asc else F.col("d").desc_nulls_last(), F.col("n")]
        for keep in (True, False):
            assert rows_of(dedup.best_row_aggregate(df, "k", [("d", asc), ("n", True)], keep)) == \
                rows_of(dedup.best_row_per_key(df, "k", order, keep))
    assert dedup.best_row_aggregate(df.limit(0), "k", [("n", True)]).collect() == []


def test_best_row_aggregate_sends_one_row_of_a_hot_key_per_task(spark):
    df = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    out = dedup.best_row_aggregate(df, "k", [("id", False)])
    assert out.where("k = -1").collect()[0].id == 29_997
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") and "Window" not in plan and plan.count("Exchange") == 1


# -- partition-wise replacement

def test_replace_named_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("m1", 1), ("m2", 2), ("m3", 3)], "m string, v int")
    sinks.write_layer(old, path, ["m"])
    kept = sorted(os.listdir(f"{path}/m=m1"))
    sinks.replace_partitions(spark.createDataFrame([("m2", 20), ("m2", 21), ("m4", 40)], "m string, v int"), path, "m",
                             ["m2", "m3", "m4"])
    assert rows_of(spark.read.parquet(path).select("m", "v")) == [("m1", 1), ("m2", 20), ("m2", 21), ("m4", 40)]
    assert sorted(os.listdir(f"{path}/m=m1")) == kept
    with pytest.raises(Exception, match="not a named m: m[13]"):
        sinks.replace_partitions(old, path, "m", ["m2"])
    assert rows_of(spark.read.parquet(path).select("m", "v")) == [("m1", 1), ("m2", 20), ("m2", 21), ("m4", 40)]


def test_a_busy_month_is_written_by_more_tasks_as_it_grows(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        files = []
        for n in (5_000, 40_000):
            path = str(tmp_path / str(n))
            df = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 == 0, "busy").otherwise(F.concat(F.lit("m"), F.col("id") % 20)).alias("m"),
                                               F.sha2(F.col("id").cast("string"), 256).alias("v"))
            sinks.write_layer(df, path, ["m"])
            assert spark.read.parquet(path).count() == n
            files.append(len([f for f in os.listdir(f"{path}/m=busy") if f.startswith("part-")]))
        assert files[1] >= 3 * files[0]
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)


# -- readers

def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_json_arrays_keep_the_text_of_numbers(spark, tmp_path):
    numbers = ["30.0", "30.00", "1e2", "-0.10", "7", "123456789012345678901234567890.5", "true", "null", '"x\\"y é"']
    records = ",\n ".join(f'{{"id": {i}, "v": {n}, "rest": {{"deep": [1.50]}}}}' for i, n in enumerate(numbers))
    write(tmp_path / "a" / "one.json", f"[\n {records}\n]\n")
    write(tmp_path / "a" / "two.json", '[{"v": 8.10, "id": 100}]')
    write(tmp_path / "a" / "none.json", "[]")
    got = {r.id: (r.v, r.rest) for r in readers.read_json_text(spark, str(tmp_path / "a"), ["id", "v", "rest"], multi_line=True).collect()}
    want = {str(i): n for i, n in enumerate(numbers)} | {"7": None, "8": 'x"y é', "100": "8.10"}
    assert {k: v[0] for k, v in got.items()} == want
    assert json.loads(got["0"][1]) == {"deep": [1.5]}


def test_json_with_other_names_or_broken_raises(spark, tmp_path):
    write(tmp_path / "names" / "a.json", '[{"x": 1, "y": 2}]')
    for read in (lambda: readers.read_json_text(spark, str(tmp_path / "names"), ["id"], multi_line=True),
                 lambda: readers.read_json_typed(spark, str(tmp_path / "names"), "id int, t string", multi_line=True)):
        with pytest.raises(Exception, match="none of the fields id"):
            read().collect()
    write(tmp_path / "broken" / "a.json", '[{"id": 1}, {"id": ')
    with pytest.raises(Exception):
        readers.read_json_text(spark, str(tmp_path / "broken"), ["id"], multi_line=True).collect()


def test_inferred_types_beside_missing_values(spark, tmp_path):
    write(tmp_path / "t.csv", "a,b,c,d,e\n2.5,1,true,x,NA\nNA,NA,null,1,\nnull,30000000000,False,,n/a\n")
    df = readers.read_csv_typed(spark, str(tmp_path / "t.csv"))
    assert [t for _, t in df.dtypes] == ["double", "bigint", "boolean", "string", "string"]
    assert rows_of(df) == sorted([(2.5, 1, True, "x", None), (None, None, None, "1", None), (None, 30000000000, False, None, None)], key=repr)


def test_stream_binds_by_header_with_the_batch_dialect(spark, tmp_path):
    source = tmp_path / "in"
    write(source / "1.csv", 'b,a\n"x ""q"" y",1\n')
    args = (["a", "b"], str(tmp_path / "out"), str(tmp_path / "ckpt"))
    stream_bronze(spark, str(source), *args)
    write(source / "2.csv", "b,a\n z ,2\nNA,3\n")
    stream_bronze(spark, str(source), *args)
    got = rows_of(spark.read.parquet(str(tmp_path / "out")).select("a", "b"))
    assert got == [("1", 'x "q" y'), ("2", " z "), ("3", None)]
    assert got == rows_of(readers.read_csv_text(spark, str(source), ["a", "b"]))
    write(source / "3.csv", "a,b\n4,w\n")
    with pytest.raises(Exception):
        stream_bronze(spark, str(source), *args)
    with pytest.raises(ValueError, match="no column c"):
        stream_bronze(spark, str(source), ["a", "c"], str(tmp_path / "out2"), str(tmp_path / "ckpt2"))
