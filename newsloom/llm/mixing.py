"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key. Rows are range-partitioned by (source, key), so one hot
source spreads over many tasks; each partition adds up its sizes per source, a prefix sum over
those few totals gives every partition its offset, and a running sum inside the partition gives
every document the number of words in front of it in its source. The source's budget is cut
there: a whole number of epochs for all its documents, then one more for those in front of the
cut; the document on the cut gives the words that are missing.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a
null id takes part like any other; repeated rows are mixed as separate documents, in the order
of their place in the input where key and id tie; a source whose size is 0 has target 0; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import ROW, materialise, stable, with_all_columns, with_row_id, word_count

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2


def water_level(sources: DataFrame, share: float, max_epochs: int) -> float:
    """The level L with sum(min(max_epochs * size, L * weight)) = share * sum(size).

    Each round re-shares what the sources at their cap leave over; only sums reach the driver.
    """
    cap = F.col("size") * max_epochs
    total = sources.agg(F.sum("size")).first()[0] or 0
    level = 0.0
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        capped, weight = sources.agg(F.sum(F.when(full, cap).otherwise(0)),
                                     F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if not weight:
            return level
        raised = (share * total - capped) / weight
        if raised <= level:
            return level
        level = raised


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
                seed: str = "mix") -> DataFrame:
    """One row per input row: ``_row``, ``id``, ``source``, ``size``, ``source_size``, ``target``,
    ``taken`` (words over all epochs). Reruns agree: the keys are hashes of the ids."""
    spark = docs.sparkSession
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    sized = materialise(with_row_id(
        docs, F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"), F.md5(F.concat(F.lit(f"{seed}:"), id_text)).alias("key")),
        "mix-sizes")
    # one row per source; UTF-8 byte order is code-point order
    sources = sized.groupBy("source").agg(F.sum("size").alias("size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = sources.select("source", "size", place.alias("place"))
    ladder = F.array(*[F.lit(w) for w in weights])
    sources = materialise(sources.withColumn(
        "weight", F.element_at(ladder, (F.col("place") % len(weights) + 1).cast("int"))), "mix-sources")
    level = water_level(sources, share, max_epochs)
    target = F.least((F.col("size") * max_epochs).cast("double"), F.lit(level) * F.col("weight"))
    sources = materialise(sources.select(F.col("source").alias("_source"), "place", F.col("size").alias("source_size"),
                                         target.alias("target")), "mix-targets")

    # range sort by (source, key): the hot source spans many partitions
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("id"), F.col(ROW)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(sized.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "mix-dealt")
    totals = dealt.groupBy("part", "source").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(totals.select(F.col("part").alias("_part"), F.col("source").alias("_psource"),
                                        F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("offset")),
                          "mix-offsets")
    inside = (Window.partitionBy("part", "source").orderBy("key", "id", ROW)
              .rowsBetween(Window.unboundedPreceding, -1))
    running = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = running.join(offsets, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_psource")))
    placed = materialise(placed.select(ROW, "id", "source", "size", (F.col("offset") + F.col("inside")).alias("before")),
                         "mix-placed")
    joined = placed.join(sources, F.col("source").eqNullSafe(F.col("_source")))
    budget = F.floor(F.col("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return joined.select(ROW, "id", "source", "size", "source_size", "target",
                         (epochs * F.col("size") + cut).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, ``mix_epoch`` (from 1) and ``mix_words``, a row for
    every time a document is taken; the last time may ask for fewer words than it has. Columns of
    these two names that ``docs`` has already (an earlier mix) are replaced."""
    docs = stable(docs)
    taken = mix_sources(docs, **options).filter("taken > 0").select(ROW, "size", "taken")
    rows, columns = with_all_columns(docs.drop("mix_epoch", "mix_words"))
    # a row for nearly every document: never a broadcast, at any size
    joined = rows.join(materialise(taken, "mix-taken").hint("merge"), ROW)
    epoch = F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int")))
    words = F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    return joined.withColumn("epoch", epoch).select(
        *columns, F.col("epoch").alias("mix_epoch"), words.cast("long").alias("mix_words"))
