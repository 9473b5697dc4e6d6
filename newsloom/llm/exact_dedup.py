"""Exact dedup by progressive refinement, in DataFrame operations only.

Texts are equal when identical after lower-casing A-Z. Rows are grouped by byte length, then by
a hash of the normalised first ``prefix`` characters, then by SHA-256 of the whole normalised
text; each level only sees the rows whose group at the level before has two or more members,
so the full content is hashed for survivors alone.

Defined results: a null text counts as empty; of equal texts the largest id stays (a null id is
smaller than any other); rows that tie on the id too are told apart by their place in the
input, so exactly one row of a group stays; an empty table gives an empty result. Columns other
than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import ROW, ascii_lower, drop_rows, materialise, stable, with_row_id

PREFIX_CHARS = 256


def text_digest(text: Column) -> Column:
    """SHA-256 (hex) of the normalised text in UTF-8."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 prefix: int = PREFIX_CHARS) -> DataFrame:
    """One row per input row: ``_row``, ``id``, ``keep_id``, ``group_size``, ``kept``.

    Groups of copies are counted with partial aggregates and joined back from written tables,
    so a group that holds a third of all rows is split like any skewed join side.
    """
    docs = stable(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    length, head = F.octet_length(text), F.xxhash64(ascii_lower(F.substring(text, 1, prefix)))
    small = materialise(with_row_id(docs, F.col(id_col).alias("id"), length.alias("length"), head.alias("head")),
                        "exact-heads")
    # level 1: lengths that occur twice; level 2: of those, prefixes that occur twice
    lengths = materialise(small.groupBy("length").count().filter("count > 1").select("length"), "exact-lengths")
    heads = (small.join(lengths, "length", "left_semi").groupBy("length", "head").count()
             .filter("count > 1").select("length", "head"))
    heads = materialise(heads, "exact-prefixes")
    # level 3: whole content, of the survivors only
    survivors = (with_row_id(docs, F.col(id_col).alias("id"), text.alias("text"), length.alias("length"),
                             head.alias("head"))
                 .join(heads, ["length", "head"], "left_semi")
                 .select(ROW, "id", text_digest(F.col("text")).alias("digest")))
    survivors = materialise(survivors, "exact-digests")
    groups = (survivors.groupBy("digest")
              .agg(F.max(F.struct("id", ROW)).alias("best"), F.count("*").alias("group_size"))
              .filter("group_size > 1")
              .select("digest", "group_size", F.col("best.id").alias("keep_id"), F.col(f"best.{ROW}").alias("keep_row")))
    grouped = survivors.join(materialise(groups, "exact-groups"), "digest").select(
        ROW, "keep_id", "keep_row", "group_size")
    grouped = materialise(grouped, "exact-members")
    alone = F.col("group_size").isNull()
    return small.select(ROW, "id").join(grouped, ROW, "left").select(
        ROW, "id",
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_row") == F.col(ROW))).alias("kept"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that exact dedup drops; all columns are kept as they are."""
    docs = stable(docs)
    return drop_rows(docs, exact_groups(docs, id_col, text_col).filter(~F.col("kept")), "exact-dropped")
