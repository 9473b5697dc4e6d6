"""Maintained vocabulary (A7, A8, A10): corpus counts that follow the articles, and the exact top terms.

The state has one row per token with its corpus count and document frequency, and one row without a
token whose ``df`` is the number of documents. All of it is sums over articles, so a change of some articles
is a delta with signs: what they count for now less what they counted for before. Deltas merge in
any order and grouping; the sum of hourly deltas is the full recount. Tokens that no document holds
any more leave the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.articles import VOCAB_SIZE, vocab_idf_of

STATE = "token string, total long, df long"


def counts_of(tf: DataFrame, articles: DataFrame) -> DataFrame:
    """State of some articles: their term counts ``tf`` (article_id, token, tf; one row a pair), and
    ``articles`` (article_id) for the number of documents, also of those without a term."""
    tokens = tf.groupBy("token").agg(F.sum("tf").cast("long").alias("total"), F.count("*").alias("df"))
    documents = articles.select("article_id").distinct().agg(F.count("*").alias("df"))
    return tokens.unionByName(documents.select(F.lit(None).cast("string").alias("token"), F.lit(0).cast("long").alias("total"), "df"))


def merge(*states: DataFrame) -> DataFrame:
    """Sum of states and deltas; a hot token is summed per task first."""
    whole = states[0]
    for s in states[1:]:
        whole = whole.unionByName(s)
    return whole.groupBy("token").agg(F.sum("total").alias("total"), F.sum("df").alias("df")).where(
        (F.col("df") != 0) | (F.col("total") != 0) | F.col("token").isNull())


def negated(state: DataFrame) -> DataFrame:
    return state.select("token", (-F.col("total")).alias("total"), (-F.col("df")).alias("df"))


def delta(new_tf: DataFrame, new_articles: DataFrame, old_tf: DataFrame, old_articles: DataFrame) -> DataFrame:
    """What changes when ``new_articles`` arrive: their counts, less those of the ones among them that were
    there before (``old_tf`` and ``old_articles`` hold all articles so far)."""
    changed = new_articles.select("article_id").distinct()
    gone = counts_of(old_tf.join(changed, "article_id", "left_semi"), old_articles.join(changed, "article_id", "left_semi"))
    return merge(counts_of(new_tf, new_articles), negated(gone))


def vocabulary(state: DataFrame, size: int = VOCAB_SIZE) -> DataFrame:
    """T9 (keyword, idf, index) of the state: exactly that of a full recount."""
    n_docs = state.where(F.col("token").isNull()).agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    return vocab_idf_of(state.where(F.col("token").isNotNull()), n_docs, size)
