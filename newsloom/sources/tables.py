"""Readers for the input tables and adapters onto the news data model.

The driver tables are mapped onto the reference's tables (see README, "Data
model"). Each adapter is a projection/derivation that Catalyst folds into the
consumer's plan, so column pruning and filter pushdown reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the data mapping.
AS_OF = "2024-02-01 00:00:00"          # the clock of every batch job
EVENT_SPLIT = "2024-01-20 00:00:00"    # base / delta cut of the behaviour log
ORDER_DELTA_FROM = "2001-01-01 00:00:00"
ALGORITHM_COMBINE = "C2"


# Runtime setting: spread every scan over this many partitions before per-row work. Unset (the
# default) means that the plan is the bare scan; the plan never depends on file or core counts.
# It is for tables laid out as one large row group, which Spark cannot split.
SCAN_PARTITIONS = "newsloom.scan.partitions"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one input table (spread only if ``newsloom.scan.partitions`` is set)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    partitions = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(partitions), df.columns[0]) if partitions else df


# --------------------------------------------------------------------------- articles

def channel_of_source(source: Column) -> Column:
    """'src7' -> channel 8."""
    return (F.substring(source, 4, 16).cast("int") + F.lit(1)).cast("int")


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def news_article_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """article_id, channel_id, title, update_time.

    update_time spreads articles over the 24 hours before AS_OF so that the
    hourly incremental scan (S8) has work in every hour.
    """
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("article_id"),
        channel_of_source(F.col("source")).alias("channel_id"),
        first_line(F.col("text")).alias("title"),
        F.timestamp_seconds(F.unix_timestamp(F.lit(AS_OF)) - 86400 + (F.col("doc_id") * 7919) % 86400)
        .alias("update_time"),
    )


def news_article_with_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 and T2 from their one source table in a single scan: (article_id,
    channel_id, title, content). Equal to T1 inner-join T2 on article_id, which the
    general ``merge_article_data`` performs when the two are separate tables."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("article_id"), channel_of_source(F.col("source")).alias("channel_id"),
                    first_line(F.col("text")).alias("title"), F.col("text").alias("content"))


def news_article_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 with its review status: 2 (approved) unless moderation flagged it toxic (3)."""
    basic = news_article_basic(spark, sf_dir)
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("article_id"), "toxic")
    return (basic.join(labels, "article_id", "left")
            .withColumn("status", F.when(F.col("toxic") == 1, F.lit(3)).otherwise(F.lit(2)))
            .drop("toxic"))


def news_article_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """article_id, content (the whole text)."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("article_id"), F.col("text").alias("content"))


def news_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel dimension, one row per channel (bounded by the channel count)."""
    d = read_table(spark, sf_dir, "documents")
    return (d.select(channel_of_source(F.col("source")).alias("channel_id"), F.col("source"))
            .groupBy("channel_id").agg(F.min("source").alias("channel_name")))


def article_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """article_id -> channel_id lookup."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("article_id"), channel_of_source(F.col("source")).alias("channel_id"))


# --------------------------------------------------------------------------- user log

ACTION_OF_EVENT = {  # fixed values: event_type -> reference action name
    "view": "exposure",
    "click": "click",
    "purchase": "share",
    "signup": "collect",
    "error": "read",
}


def _action_expr(event_type: Column) -> Column:
    expr = None
    for ev, act in ACTION_OF_EVENT.items():
        expr = (F.when(event_type == ev, F.lit(act)) if expr is None
                else expr.when(event_type == ev, F.lit(act)))
    return expr


def user_action(spark: SparkSession, sf_dir: str, since: str | None = None, before: str | None = None) -> DataFrame:
    """The click log with its nested ``param`` struct and ``dt`` partition value; ``since``
    and ``before`` bound the event time [since, before) and reach the scan."""
    events = read_table(spark, sf_dir, "events")
    if since:
        events = events.where(F.col("ts") >= F.lit(since).cast(events.schema["ts"].dataType))
    if before:
        events = events.where(F.col("ts") < F.lit(before).cast(events.schema["ts"].dataType))
    return user_action_from(events, article_channel(spark, sf_dir))


def user_action_from(events: DataFrame, channels: DataFrame) -> DataFrame:
    """T6 from an events frame (batch or streaming) and the article -> channel map.

    ``k`` of the event props is the article; an exposure (view) lists the two
    articles ``[k, (k+1) % 100]``; readTime is the text of floor(value*20) ms;
    channelId is the channel of article k.
    """
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    action = _action_expr(F.col("event_type"))
    article_id_text = F.when(
        F.col("event_type") == "view",
        F.format_string("[%d, %d]", k, (k + 1) % 100),
    ).otherwise(k.cast("string"))
    base = events.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("actionTime"),
        F.floor(F.col("value") * 20).cast("bigint").cast("string").alias("readTime"),
        k.alias("_k"),
        F.struct(
            article_id_text.alias("articleId"),
            F.lit(ALGORITHM_COMBINE).alias("algorithmCombine"),
            action.alias("action"),
            F.col("user_id").cast("string").alias("userId"),
        ).alias("param"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )
    ch = channels.select(F.col("article_id").alias("_k"), "channel_id")
    return (base.join(ch, "_k", "left")
            .select("actionTime", "readTime", F.col("channel_id").alias("channelId"), "param", "dt"))


# --------------------------------------------------------------------------- users

def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: user_id, gender (boolean), birthday ('yyyy-MM-dd' or the text 'null')."""
    c = read_table(spark, sf_dir, "customer")
    bday = F.date_add(F.to_date(F.lit("1960-01-01")), ((F.col("c_custkey") * 37) % 16000).cast("int"))
    return c.select(
        F.col("c_custkey").alias("user_id"),
        ((F.col("c_custkey") % 2) == 1).alias("gender"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit("null"))
        .otherwise(F.date_format(bday, "yyyy-MM-dd")).alias("birthday"),
    )


# --------------------------------------------------------------------------- vectors

def article_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """article_id, channel_id, articleVector array<double>."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("article_id"),
        (F.col("label") + 1).cast("int").alias("channel_id"),
        F.col("embedding").cast("array<double>").alias("articleVector"),
    )


# --------------------------------------------------------------------------- ratings (ALS)

def item_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel of a rated item: 'Brand#7' -> channel 7 (25 brands, 25 channels)."""
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("article_id"),
                    F.substring(F.col("p_brand"), 7, 8).cast("int").alias("channel_id"))


def purchase_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_article_basic for ALS at scale: (user_id, article_id, clicked) from orders x lineitem.

    A bought line counts as a click unless it was returned ('R').
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return (j.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("article_id"))
            .agg(F.max((F.col("l_returnflag") != "R").cast("int")).alias("clicked")))


# --------------------------------------------------------------------------- upsert source

def orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.col("o_orderdate").alias("update_time"))


def orders_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed rows: open orders since ORDER_DELTA_FROM are fulfilled 30 days later;
    pending ones are re-sent with an unchanged timestamp (ties go to the delta)."""
    o = read_table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.to_timestamp(F.lit(ORDER_DELTA_FROM)))
    o = o.where(F.col("o_orderstatus").isin("O", "P"))
    return o.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") == "O", F.lit("F")).otherwise(F.lit("P")).alias("o_orderstatus"),
        F.round(F.col("o_totalprice") * 1.05, 2).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
        .otherwise(F.col("o_orderdate")).alias("update_time"),
    )
