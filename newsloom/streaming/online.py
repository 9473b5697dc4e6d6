"""Online content recall with Structured Streaming (ST1-ST7, J19, X5).

Click messages (the JSON value of the click topic) arrive in micro-batches;
each batch keeps the click / collect / share actions, joins the clicked articles
with their top-10 similar articles (static K1 table), removes what the user was
already given in that channel (the K3 history store as of the batch start), and
writes the recall rows and the new history rows. Writes go to a folder named by
the batch id with overwrite, and a batch reads the history of earlier batches only,
so a replayed batch (restart from the checkpoint) sees what it saw the first time and
replaces its own output. The history is a snapshot, partitioned by a hash of the user, and a
tail of later batches that is merged into it now and then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.behavior import CLICK_ACTIONS
from newsloom.operators import recall as RC
from newsloom.operators.topk import latest_by_key, top_k
from newsloom.sources.versions import VersionedTable

CLICK_SCHEMA = ("actionTime string, readTime string, channelId int, "
                "param struct<action:string, userId:string, articleId:string, algorithmCombine:string>")
BATCH_INTERVAL = "60 seconds"   # fixed value: micro-batch interval of the reference


def click_messages(user_action: DataFrame) -> DataFrame:
    """ST1 message shape: one JSON document per event (column ``value``)."""
    return user_action.select(F.to_json(F.struct("actionTime", "readTime", "channelId", "param")).alias("value"))


def kafka_messages(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """S12 / ST1: the click topic as a stream (needs the spark-sql-kafka package)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load()
            .select(F.col("value").cast("string").alias("value")))


def parse_clicks(messages: DataFrame) -> DataFrame:
    """ST2 + ST3: decode the JSON value (malformed -> dropped) and keep the
    click / collect / share actions: (user_id, article_id, channel_id, action, action_time)."""
    e = messages.select(F.from_json("value", CLICK_SCHEMA).alias("e")).where(F.col("e").isNotNull())
    return e.select(
        F.col("e.param.userId").try_cast("bigint").alias("user_id"),
        F.col("e.param.articleId").try_cast("bigint").alias("article_id"),
        F.col("e.channelId").alias("channel_id"),
        F.col("e.param.action").alias("action"),
        F.col("e.actionTime").alias("action_time"),
    ).where(F.col("action").isin(*CLICK_ACTIONS) & F.col("user_id").isNotNull() & F.col("article_id").isNotNull())


def recall_for_clicks(clicks: DataFrame, similar: DataFrame, history: DataFrame, k: int = 10) -> DataFrame:
    """J19 set-based: top-k similar of every clicked article, minus the history of
    (user, channel) as of the batch start; (user_id, channel_id, article_id)."""
    cand = RC.content_candidates(clicks, similar, k)
    return RC.filter_history(cand, history)


HISTORY_SCHEMA = "user_id long, channel_id int, article_id long, version_ts string, batch int"
RECALL_SCHEMA = "user_id long, source string, channel_id int, article_id long, batch int"
HISTORY_PARTS = 16     # parts of a history snapshot, by user
COMPACT_EVERY = 16     # batches after which the tail is merged into a new snapshot


def history_part(user_id: Column) -> Column:
    return F.pmod(F.xxhash64(user_id), F.lit(HISTORY_PARTS)).cast("int")


class HistoryStore:
    """K3: what each user was given, as a snapshot and a tail.

    The snapshot holds the batches up to some number, one row per (user, channel, article), partitioned by
    a hash of the user; it is replaced as a whole by a commit pointer. The tail has one folder for
    each later batch. Every ``compact_every`` batches the tail is merged, so a batch reads a bounded
    number of folders however long the stream runs.

    A snapshot that is made while batch n runs ends with batch n - 1, which the stream has committed.
    So a replay of batch n sees what it saw the first time, whether or not it had compacted.
    """

    def __init__(self, spark: SparkSession, store_dir: str, compact_every: int = COMPACT_EVERY,
                 max_versions: int | None = None):
        self.spark, self.dir, self.compact_every, self.max_versions = spark, store_dir.rstrip("/"), compact_every, max_versions
        self.snapshots = VersionedTable(spark, f"{self.dir}/history-snapshot")

    def _snapshot(self, before: int):
        """The newest snapshot whose batches are all earlier than ``before``, and its last batch."""
        for commit in self.snapshots.commits():
            if int(commit.version) < before:
                return commit, int(commit.version)
        return None, None

    def write(self, rows: DataFrame, batch_id: int) -> None:
        # the folder is the batch's own and is cleared first, also if there is nothing to write
        rows.write.mode("overwrite").parquet(f"{self.dir}/history/batch={batch_id}")

    def read(self, before: int, parts: list[int] | None = None) -> DataFrame:
        """All history of earlier batches; of the snapshot only the given parts."""
        commit, upto = self._snapshot(before)
        tail = self.spark.read.schema(HISTORY_SCHEMA).parquet(f"{self.dir}/history").where(F.col("batch") < before)
        columns = ["user_id", "channel_id", "article_id", "version_ts"]
        if commit is None:
            return tail.select(*columns)
        old = self.spark.read.schema(HISTORY_SCHEMA + ", part int").parquet(f"{self.snapshots.path}/{commit.folder}")
        if parts is not None:
            old = old.where(F.col("part").isin(parts))
        return old.select(*columns).unionByName(tail.where(F.col("batch") > upto).select(*columns))

    def compact(self, batch_id: int) -> bool:
        """Merge the batches before ``batch_id`` into a new snapshot, if it is time; drops what it replaces."""
        _, upto = self._snapshot(batch_id)
        if batch_id <= 0 or batch_id - (upto if upto is not None else -1) <= self.compact_every:
            return False
        whole = self.read(batch_id)
        whole = whole.groupBy("user_id", "channel_id", "article_id").agg(F.min("version_ts").alias("version_ts"))
        if self.max_versions is not None:  # the newest versions of a (user, channel)
            versions = top_k(whole.select("user_id", "channel_id", "version_ts").distinct(), ["user_id", "channel_id"],
                             [F.col("version_ts").desc()], self.max_versions)
            whole = whole.join(versions, ["user_id", "channel_id", "version_ts"], "left_semi")
        rows = whole.withColumn("batch", F.lit(batch_id - 1)).withColumn("part", history_part(F.col("user_id")))
        self.snapshots.publish(rows.repartition("part"), str(batch_id - 1), ["part"], keep=2)
        kept = [int(c.version) for c in self.snapshots.commits()]
        self._drop_tail(min(kept) if len(kept) > 1 else -2)
        return True

    def _drop_tail(self, upto: int) -> None:
        """Delete the tail folders that the older of the kept snapshots holds too."""
        fs, path = self.snapshots._fs, self.snapshots._hadoop(f"{self.dir}/history")
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("batch=") and int(name[6:]) <= upto:
                fs.delete(status.getPath(), True)


def make_batch_writer(similar: DataFrame, store_dir: str, k: int = 10, compact_every: int = COMPACT_EVERY,
                      max_versions: int | None = None):
    """ST4 / ST5 / ST6: the foreachBatch body, idempotent per batch id.

    ``similar`` should be a written table (K1): it is read by every batch. Only the list of
    the batch's history parts (at most HISTORY_PARTS numbers) reaches the driver.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = HistoryStore(spark, store_dir, compact_every, max_versions)
        store.compact(batch_id)
        clicks = parse_clicks(batch).select("user_id", "article_id", "channel_id").distinct().persist()
        try:
            parts = [r[0] for r in clicks.select(history_part(F.col("user_id"))).distinct().collect()]
            rows = recall_for_clicks(clicks, similar, store.read(batch_id, parts), k)
            out = f"{store_dir}/recall/batch={batch_id}"
            (rows.select("user_id", F.lit("online").alias("source"), "channel_id", "article_id")
             .write.mode("overwrite").parquet(out))
            written = spark.read.schema("user_id long, source string, channel_id int, article_id long").parquet(out)
            store.write(written.select("user_id", "channel_id", "article_id",
                                       F.lit(f"online-{batch_id:012d}").alias("version_ts")), batch_id)
        finally:
            clicks.unpersist()

    return write_batch


def seed_history(history: DataFrame, store_dir: str) -> None:
    """Initial K3 contents (batch = -1)."""
    HistoryStore(history.sparkSession, store_dir).write(
        history.select("user_id", "channel_id", "article_id", F.col("version_ts").cast("string")), -1)


def start_online_recall(messages: DataFrame, similar: DataFrame, store_dir: str, checkpoint: str,
                        available_now: bool = False, interval: str = BATCH_INTERVAL, k: int = 10,
                        compact_every: int = COMPACT_EVERY):
    """Start the streaming query; ``available_now`` drains what is there and stops (tests, backfill).
    ``similar`` is a written K1 table."""
    w = messages.writeStream.foreachBatch(make_batch_writer(similar, store_dir, k, compact_every)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def read_recall(spark: SparkSession, store_dir: str) -> DataFrame:
    return spark.read.schema(RECALL_SCHEMA).parquet(f"{store_dir}/recall")


# --------------------------------------------------------------------------- ST7 (declared only in the reference)

def hot_articles(clicks: DataFrame, k: int = 10, salt: int = 8) -> DataFrame:
    """Hot-article recall: the ``k`` most clicked articles per channel (ties by id).
    Counts are partially aggregated; a hot channel is ranked in ``salt`` pieces."""
    c = clicks.groupBy("channel_id", "article_id").agg(F.count(F.lit(1)).alias("clicks"))
    return top_k(c, ["channel_id"], [F.col("clicks").desc(), F.col("article_id").asc()], k,
                 rank_col="rank", salt=salt)


def new_articles(articles: DataFrame, k: int = 10, salt: int = 8) -> DataFrame:
    """New-article recall: the ``k`` most recently updated articles per channel."""
    a = articles.select("channel_id", "article_id", "update_time")
    return top_k(a, ["channel_id"], [F.col("update_time").desc(), F.col("article_id").desc()], k,
                 rank_col="rank", salt=salt)


HOT_SCHEMA = "window_start timestamp, channel_id int, article_id long, clicks long, batch int"
NEW_SCHEMA = "channel_id int, article_id long, update_time timestamp, rank int, batch int"
HOT_WINDOW, HOT_LATENESS = "1 day", "2 days"


def _drain(query_writer, checkpoint: str, available_now: bool, interval: str):
    w = query_writer.option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()


def start_hot_counts(messages: DataFrame, store_dir: str, checkpoint: str, window: str = HOT_WINDOW,
                     lateness: str = HOT_LATENESS, available_now: bool = False, interval: str = BATCH_INTERVAL):
    """ST7, hot articles as a stream: clicks per (window, channel, article), kept as state by Spark until the
    watermark passes the window's end; clicks later than ``lateness`` are not counted any more.

    A batch writes the counts that it changed to its own folder (a replay replaces it); the newest
    count of a key is in force. Bounded state: windows older than the watermark leave it.
    """
    clicks = parse_clicks(messages).withColumn("at", F.try_to_timestamp("action_time")).where(F.col("at").isNotNull())
    counts = (clicks.withWatermark("at", lateness)
              .groupBy(F.window("at", window).alias("window"), "channel_id", "article_id").agg(F.count("*").alias("clicks"))
              .select(F.col("window.start").alias("window_start"), "channel_id", "article_id", "clicks"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store_dir}/hot/batch={batch_id}")

    return _drain(counts.writeStream.outputMode("update").foreachBatch(write_batch), checkpoint, available_now, interval)


def hot_counts(spark: SparkSession, store_dir: str) -> DataFrame:
    """The counts in force: (window_start, channel_id, article_id, clicks)."""
    rows = spark.read.schema(HOT_SCHEMA).parquet(f"{store_dir}/hot")
    return latest_by_key(rows, ["window_start", "channel_id", "article_id"], ["batch"]).drop("batch")


def hot_of_windows(counts: DataFrame, k: int = 10, salt: int = 8) -> DataFrame:
    """The ``k`` most clicked articles of every (window, channel), ties by id."""
    return top_k(counts, ["window_start", "channel_id"], [F.col("clicks").desc(), F.col("article_id").asc()], k,
                 rank_col="rank", salt=salt)


def start_new_articles(articles: DataFrame, store_dir: str, checkpoint: str, k: int = 10, available_now: bool = False,
                       interval: str = BATCH_INTERVAL):
    """ST7, new articles as a stream: every batch of (channel_id, article_id, update_time) is merged with the
    lists of the batch before, ``k`` rows a channel, and written as the lists of this batch. An article that
    comes again counts with its latest time. A replay starts from the same lists."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.select("channel_id", "article_id", "update_time")
        if batch_id > 0:
            before = spark.read.schema(NEW_SCHEMA).parquet(f"{store_dir}/new").where(F.col("batch") == batch_id - 1)
            fresh = fresh.unionByName(before.select("channel_id", "article_id", "update_time"))
        newest = latest_by_key(fresh, ["channel_id", "article_id"], ["update_time"])
        new_articles(newest, k).write.mode("overwrite").parquet(f"{store_dir}/new/batch={batch_id}")

    return _drain(articles.writeStream.foreachBatch(write_batch), checkpoint, available_now, interval)


def new_lists(spark: SparkSession, store_dir: str) -> DataFrame:
    """The lists of the last batch."""
    rows = spark.read.schema(NEW_SCHEMA).parquet(f"{store_dir}/new")
    last = rows.agg(F.max("batch")).first()[0]
    return rows.where(F.col("batch") == F.lit(last)).drop("batch")
