"""Per-group ranking: top-k (W1-W5), latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
          rank_col: str | None = None, salt: int = 0) -> DataFrame:
    """Keep the first ``k`` rows of every ``keys`` group under ``order`` (a total order).

    Spark cuts every group to ``k`` rows in each task before the shuffle (a window group limit), as long as ``k``
    is within its threshold. Beyond it ``salt > 0`` makes it skew-safe: a first pass ranks inside (keys, salt) so a
    hot group is spread over ``salt`` tasks, and only <= k x salt survivors per group
    reach the final pass. The result is identical because the order is total.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if salt and salt > 1 and k > limit:
        salt_col = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt))
        w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", salt_col)
              .withColumn("_r1", F.row_number().over(w1))
              .where(F.col("_r1") <= k)
              .drop("_r1", "_salt"))
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    if rank_col:
        return out.withColumnRenamed("_rank", rank_col)
    return out.drop("_rank")


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (ties -> any equal row).

    Expressed as ``max(struct(order..., rest...))`` so it is partially aggregated on the
    map side: a hot key costs one row per map task, never a whole group in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_m"))
    return agg.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in order + rest]).select(*df.columns)
