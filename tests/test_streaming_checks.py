"""Incremental loads and record checks (2.8)."""

import os

from pyspark.sql import functions as F

from postroom.operators import checks as V
from postroom.streaming.incremental import incremental_load, read_sink


def test_incremental_once(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    df.repartition(2).write.parquet(src)
    fn = lambda b: b.where(F.col("g") != 0)
    assert incremental_load(spark, src, df.schema, ck, sink, fn) >= 1
    assert incremental_load(spark, src, df.schema, ck, sink, fn) == 0
    assert read_sink(spark, sink).count() == 66
    spark.range(100, 103).withColumn("g", F.lit(1)).write.mode("append").parquet(src)
    assert incremental_load(spark, src, df.schema, ck, sink, fn) == 1
    assert read_sink(spark, sink).count() == 69


def test_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, "x.csv", "x", None), (None, None, 20, "y.csv", "z", "u"), (3, "c", 7, "q.csv", "q", None)],
        "k long, name string, n int, file string, stem string, extra string",
    )
    rules = {
        "k": {"required": True, "type": "integer"},
        "name": {"dependencies": ["k"], "allowed": ["a", "b"]},
        "n": {"oneof": [{"max": 10}, {"min": 6}]},
        "stem": {"match_filename": True},
    }
    out = V.check_records(df, rules, file_col="file")
    got = {r.k: r.violations for r in out.collect()}
    assert got[1] == []
    assert got[None] == ["k: required", "stem: match_filename", "extra: unknown field"]
    assert got[3] == ["name: allowed", "n: oneof"]
    counts = V.check_counts(out).first()
    assert (counts.n_total, counts.n_valid, counts.n_invalid) == (3, 1, 2)
