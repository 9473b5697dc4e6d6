"""Shared helpers of the training-data operators."""

from __future__ import annotations

import gc
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import scratch_path

#: Separators of ``[^\x20\x09-\x0D]+`` words; ``bytes.split()`` splits at exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROW = "_row"
#: Bits for a row's place in its file. Inputs of more files than MAX_FILES are written once first.
ROWS_BITS = 40
MAX_FILES = 20_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def _plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` reads Parquet files with nothing but deterministic projections and filters on top."""
    node = df._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias") and node.deterministic():
        node = node.child()
    if node.getClass().getSimpleName() != "LogicalRelation":
        return False
    relation = node.relation()
    return relation.getClass().getSimpleName() == "HadoopFsRelation" and relation.fileFormat().toString() == "Parquet"


def stable(df: DataFrame) -> DataFrame:
    """``df`` itself if it reads Parquet files, else its rows written once and read back: a frame in
    which ``with_row_id`` gives a row the same number in every scan."""
    if _plain_scan(df) and len(df.inputFiles()) <= MAX_FILES:
        return df
    return materialise(df, "rows")


def _file_bases(spark: SparkSession, files: list[str]) -> DataFrame:
    """``_path``, ``_base``: the first row number of every file, in the order of their names."""
    paths = sorted(re.sub(r"^(\w+):///", r"\1:/", f) for f in files)
    return spark.range(1).select(F.posexplode(F.split(F.lit("\n".join(paths)), "\n")).alias("_number", "_path")).select(
        "_path", F.shiftleft(F.col("_number").cast("long"), ROWS_BITS).alias("_base"))


def with_row_id(df: DataFrame, *columns: Column) -> DataFrame:
    """The given (named) columns and ``_row``, a number that tells apart rows with equal values.

    It is made of the file's place among the sorted names and the row's place in its file, so it
    is the same in every scan, whatever the number of cores or the way files are split. Operators
    that scan their input more than once call ``stable`` first and keep its result.
    """
    df = stable(df)
    meta = df.metadataColumn("_metadata")
    rows = df.select(meta["file_path"].alias("_path"), meta["row_index"].alias("_at"), *columns)
    names = rows.columns[2:]
    # at most MAX_FILES short rows
    bases = F.broadcast(_file_bases(df.sparkSession, df.inputFiles()))
    known = F.coalesce("_base", F.raise_error(F.concat(F.lit("rows of an unlisted file: "), F.col("_path"))).cast("long"))
    return rows.join(bases, "_path", "left").select((known + F.col("_at")).alias(ROW), *names)


def with_all_columns(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``_row`` and all columns of ``docs`` carried under names of ours (they cannot clash with an
    operator's helper columns), and the expressions that give them their names back."""
    held = [f"_in{k}" for k in range(len(docs.columns))]
    rows = with_row_id(docs, *[F.col(f"`{c}`").alias(h) for c, h in zip(docs.columns, held)])
    return rows, [F.col(h).alias(c) for c, h in zip(docs.columns, held)]


def drop_rows(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """``docs`` (as given by ``stable``) without the rows whose ``_row`` is in ``gone``; columns as they are."""
    rows, columns = with_all_columns(docs)
    return rows.join(materialise(gone.select(ROW), name), ROW, "left_anti").select(*columns)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts the lineage, so a
    lost executor re-reads files, and gives joins plain exchanges that AQE can split."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.scratch = path
    return written


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialise`` wrote for these frames, once all that reads them is written."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def global_ranks(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``rank`` (1, 2, 3, ...) in ``order``, which must be total.

    A range sort deals the rows into ordered partitions; each numbers its own rows, and prefix sums
    over the partitions' sizes (one number a partition) give their offsets.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # partition number, then place in the partition
    dealt = materialise(dealt.withColumn("_place", place), name)
    part, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = sorted(dealt.groupBy(part.alias("part")).count().collect())  # one row a partition
    bases, total = [], 0
    for number, size in sizes:
        bases += [F.lit(number), F.lit(total)]
        total += size
    base = F.element_at(F.create_map(*bases), part) if bases else F.lit(0)
    return dealt.withColumn("rank", (base + inside + 1).cast("long")).drop("_place")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of frames that are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. All-ASCII strings take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of words, 0 for null, as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
