"""Ingest: upsert by key, cleaning, log partitions."""

from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.sources import ingest as I


def test_upsert_newest_wins_and_delta_wins_ties(spark):
    base = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-05"), (3, "c", "2024-01-01")],
                                 "k long, v string, ts string")
    delta = spark.createDataFrame([(1, "a2", "2024-01-02"), (2, "b2", "2024-01-04"), (3, "c2", "2024-01-01")],
                                  "k long, v string, ts string")
    got = {r.k: r.v for r in I.upsert(base, delta, ["k"], "ts").collect()}
    assert got == {1: "a2", 2: "b", 3: "c2"}
    # order independent: the same result whatever the input order
    got2 = {r.k: r.v for r in I.upsert(base.orderBy(F.desc("k")), delta.orderBy("k"), ["k"], "ts").collect()}
    assert got2 == got


def test_clean_text_and_title(spark):
    df = spark.createDataFrame([("a,b\r\nc\x01d",)], "s string")
    r = df.select(T.clean_title(F.col("s")).alias("t"), T.drop_delims(F.col("s")).alias("d")).first()
    assert r.t == "a bc\x01d" and r.d == "a,bcd"
    assert I.clean_text_columns(df).first().s == "a,bcd"


def test_strip_html_keeps_tag_broken_by_newline(spark):
    df = spark.createDataFrame([("<p>x</p><a\nhref=1>y",)], "h string")
    assert df.select(T.strip_html(F.col("h"))).first()[0] == "x<a\nhref=1>y"


def test_log_partition_gate(spark, tmp_path):
    path = str(tmp_path / "user_action")
    spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "dt string, v int") \
        .write.partitionBy("dt").parquet(path)
    day = I.log_partition(spark, path, "2024-01-02")
    assert [r.v for r in day.collect()] == [2]
    assert I.log_partition(spark, path, "2024-01-09") is None
    assert I.log_partition(spark, str(tmp_path / "missing"), "2024-01-01") is None
    assert sorted(r.v for r in I.log_range(spark, path, "2024-01-01").collect()) == [1, 2]


def test_incremental_slice(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-03 00:00:00")], "k long, t string") \
        .withColumn("t", F.to_timestamp("t"))
    assert [r.k for r in I.incremental_slice(df, "t", "2024-01-02 00:00:00").collect()] == [2]
