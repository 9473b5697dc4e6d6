"""User behaviour: log flattening (F9/F10), merge (U1/A1), interest weights (F5-F8),
topic profile (M16) and basic profile (M17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import behavior as B
from newsloom.operators.topk import latest_by_key

BASIC_COLUMNS = ["user_id", "action_time", "article_id", "channel_id", "shared", "clicked",
                 "collected", "exposure", "read_time"]


def flatten_actions(user_action: DataFrame) -> DataFrame:
    """T6 -> T7 rows: one row per (event, article); an exposure yields one row per listed id.

    Flags: share -> shared, click/read -> clicked, collect -> collected, every row is an
    exposure; an unknown action sets no flag. read_time is parsed to ms (blank -> 0).
    """
    a = F.col("param.action")
    return user_action.select(
        F.col("param.userId").try_cast("bigint").alias("user_id"),
        F.col("actionTime").alias("action_time"),
        F.explode(B.article_ids(a, F.col("param.articleId"))).alias("article_id"),
        F.col("channelId").cast("int").alias("channel_id"),
        B.shared(a).alias("shared"),
        B.clicked(a).alias("clicked"),
        B.collected(a).alias("collected"),
        F.lit(True).alias("exposure"),
        B.read_ms(F.col("readTime")).alias("read_time"),
    ).where(F.col("article_id").isNotNull())


def merge_behavior(*parts: DataFrame) -> DataFrame:
    """U1 + A1: bag union of the old table and new rows, then one row per (user, article).

    max over every column; read_time is numeric (Q6). ``max`` is partially aggregated,
    so merging a delta into a large table shuffles at most one row per key per task,
    and merging the same delta twice is a no-op (idempotent).
    """
    u = parts[0].select(*BASIC_COLUMNS)
    for p in parts[1:]:
        u = u.unionByName(p.select(*BASIC_COLUMNS))
    return u.groupBy("user_id", "article_id").agg(
        F.max("action_time").alias("action_time"),
        F.max("channel_id").alias("channel_id"),
        F.max("shared").alias("shared"),
        F.max("clicked").alias("clicked"),
        F.max("collected").alias("collected"),
        F.max("exposure").alias("exposure"),
        F.max("read_time").alias("read_time"),
    ).select(*BASIC_COLUMNS)


def interest_weights(basic: DataFrame, as_of: str) -> DataFrame:
    """F5-F8 per (user, article): elapsed days and the decayed interest weight."""
    return basic.select(
        "user_id", "article_id", "channel_id", "action_time",
        B.elapsed_days(as_of, F.col("action_time")).alias("days_elapsed"),
        B.interest_weight(as_of, F.col("action_time"), F.col("shared"), F.col("collected"),
                          F.col("clicked"), F.col("read_time")).alias("weight"),
    )


def user_topic_weights(basic: DataFrame, article_topics: DataFrame, as_of: str,
                       agg: str = "latest") -> DataFrame:
    """(user_id, channel_id, topic, weight) from behaviour x article topics.

    J8 is an inner join (an article without topics contributes nothing); the channel is
    the article's. Q13: the reference keeps whichever article was written last for a
    (user, channel, topic); here ``agg='latest'`` keeps the latest action_time, then the
    greatest article_id, deterministically; ``agg='sum'`` adds the weights up.
    """
    w = basic.select("user_id", "article_id", "action_time",
                     B.interest_weight(as_of, F.col("action_time"), F.col("shared"), F.col("collected"),
                                       F.col("clicked"), F.col("read_time")).alias("weight"))
    j = w.join(article_topics.select("article_id", "channel_id", "topics"), "article_id")
    # dealt with the topics still in a list: a user's articles of a channel meet, and are exploded there
    # (as many parts as any shuffle: the size of the lists does not tell how many rows they hold)
    parts = int(basic.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = j.repartition(parts, "user_id", "channel_id").select("user_id", "channel_id", F.explode("topics").alias("topic"),
                                                                "action_time", "article_id", "weight")
    if agg == "sum":
        return rows.groupBy("user_id", "channel_id", "topic").agg(F.sum("weight").alias("weight"))
    latest = latest_by_key(rows, ["user_id", "channel_id", "topic"], ["action_time", "article_id"])
    return latest.select("user_id", "channel_id", "topic", "weight")


def user_basic(user_profile: DataFrame, as_of: str) -> DataFrame:
    """(user_id, gender, age) with the birthday-not-yet rule; 'null' -> 0."""
    return user_profile.select("user_id", "gender", B.age_at(as_of, F.col("birthday")).alias("age"))
