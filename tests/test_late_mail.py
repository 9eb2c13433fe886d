"""Loads that take each id once, with state that expires."""

import pytest

from postroom.streaming import incremental as INC


def export(spark, folder, *rows):
    spark.createDataFrame(list(rows), "id string, at string").selectExpr("id", "CAST(at AS TIMESTAMP_NTZ) AS at").coalesce(1).write.mode("append").parquet(folder)


def test_once_late_and_forgotten(spark, tmp_dir):
    src, sink, ckpt = (f"{tmp_dir}/{n}" for n in ("in", "out", "ckpt"))

    def load():
        schema = spark.read.parquet(src).schema
        return INC.load_once(spark, src, schema, ckpt, sink, ["id"], "at", "2 days")

    export(spark, src, ("a", "2024-01-01"), ("b", "2024-01-02"), ("b", "2024-01-02"))
    first = load()
    assert (first.repeated, first.late) == (1, 0)
    # a again, one that is late but within bounds, and what moves the watermark on
    export(spark, src, ("a", "2024-01-02"), ("c", "2024-01-01 12:00:00"), ("d", "2024-01-20"))
    second = load()
    assert (second.repeated, second.late) == (1, 0)
    export(spark, src, ("e", "2024-01-10"), ("d", "2024-01-20"), ("f", "2024-01-19"))
    third = load()
    assert (third.repeated, third.late) == (1, 1)
    # a, b and c are forgotten
    assert third.held == 2
    assert load() == (0, 0, 0, 0)
    assert sorted(r.id for r in INC.read_sink(spark, sink).collect()) == ["a", "b", "c", "d", "f"]


def test_null_time_fails(spark, tmp_dir):
    export(spark, f"{tmp_dir}/in", ("a", None))
    with pytest.raises(Exception, match="at is null"):
        INC.load_once(spark, f"{tmp_dir}/in", spark.read.parquet(f"{tmp_dir}/in").schema, f"{tmp_dir}/ckpt", f"{tmp_dir}/out", ["id"], "at", "2 days")
