"""Sinks (K-S1 ... K-S10): the reference's Hive appends and key-value puts become
partitioned table writes that are safe to re-run.

* a run overwrites its own partition folder (``run=...`` / ``version=...``), so re-running an
  hour replaces that hour (Q2), also by no rows at all, and a lost task or a replayed
  stream batch never duplicates rows;
* a table rebuilt from itself plus a delta (K-S2) is written to a new folder that a commit
  pointer makes the table -- a path is never read and overwritten at once;
* nothing is collected to the driver (the reference's batched put after collect()).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.sources.versions import VersionedTable


def write_run_partition(df: DataFrame, path: str, column: str, value: str) -> None:
    """K-S1 / K-S4 / K-S5 / K-S6 / K-S7 / K-S8 / K-S9: write ``df`` as partition
    ``column=value`` of the table at ``path``, replacing only that partition. The folder is
    named explicitly, so an empty result clears it."""
    df.drop(column).write.mode("overwrite").parquet(f"{path}/{column}={value}")


def read_partition(spark: SparkSession, path: str, column: str, value: str) -> DataFrame:
    """Read one run / version (partition pruning on the literal)."""
    return spark.read.parquet(path).where(F.col(column) == F.lit(value))


def latest_partition_value(spark: SparkSession, path: str, column: str) -> str | None:
    """The greatest ``column`` value of a partitioned table (one scalar)."""
    row = spark.read.parquet(path).select(F.max(column).alias("m")).first()
    return row.m if row else None


def replace_table(df: DataFrame, path: str, version: str) -> DataFrame:
    """K-S2: a table rebuilt from itself plus a delta gets new contents, visible all at once by a commit
    pointer (``versions``); returns a reader of them. The same version may be written again."""
    return VersionedTable(df.sparkSession, path).publish(df, version)


def write_similar(similar: DataFrame, path: str, run: str) -> None:
    """K-S3: (article_id, similar_id, distance rounded to 4 places), self pairs removed,
    partitioned by channel and run. ``exact_distance`` is kept for the next update of the lists."""
    out = similar.where(~F.col("article_id").eqNullSafe(F.col("similar_id"))) \
        .select("channel_id", "article_id", "similar_id", F.round("distance", 4).alias("distance"), "rank",
                F.col("distance").alias("exact_distance"))
    if out.isEmpty():  # a partitioned write of no rows would leave no file to read the schema from
        out.write.mode("overwrite").parquet(f"{path}/run={run}")
    else:
        out.write.mode("overwrite").partitionBy("channel_id").parquet(f"{path}/run={run}")


def read_similar(spark: SparkSession, path: str, before: str | None = None) -> DataFrame:
    """The lists in force: of every article those of its newest run (earlier than ``before``). A run
    names an article whose list became empty by a row without ``similar_id``."""
    rows = spark.read.parquet(path).withColumn("run", F.col("run").cast("string"))
    if before is not None:
        rows = rows.where(F.col("run") < before)
    newest = rows.groupBy("article_id").agg(F.max("run").alias("run"))
    kept = rows.join(newest, ["article_id", "run"], "left_semi").where(F.col("similar_id").isNotNull())
    return kept.select("article_id", F.col("channel_id").cast("int").alias("channel_id"), "similar_id",
                       F.col("exact_distance").alias("distance"), "rank")
